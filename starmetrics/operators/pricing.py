"""Elasticity and price optimisation PR-1 … PR-10.

* PR-1 is exact OLS with month-of-year fixed effects, computed in closed form
  (Frisch–Waugh) from per (group, month) moments: one aggregate, no per-group
  Python, no collect.  Groups of any size cost the same.
* The discount grid is crossed with the *candidate* table (segment × product),
  never with lines; the grid is a fixed table of at most 17 values.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmetrics.functions.exprs import clip

# Pricing rules.
GRID = [round(0.02 * i, 2) for i in range(1, 18)]      # 0.02 … 0.34
MIN_OBS = 60
MIN_SD_LOG_P = 0.02
ELASTICITY_BOUNDS = (-4.0, -0.20)
MIN_MARGIN_PCT = 0.15
DOH_MIN, DOH_MAX = 30, 90
SHORT_LOT_DAYS = 180
DEFAULT_DAYS_TO_EXPIRY = 720
TOP_PER_SEGMENT = 5
DEMAND_CAP = 3.0


def log_price_quantity(lines: DataFrame) -> DataFrame:
    """Lines with positive units and amount → log q, log p (unit net price in USD), month of year."""
    d = lines.filter((F.col("unidades") > 0) & (F.col("importe_usd_c") > 0))
    return d.select("*", F.ln(F.col("unidades").cast("double")).alias("lq"),
                    F.ln(F.col("importe_usd_c").cast("double") / 100.0 / F.col("unidades").cast("double")).alias("lp"),
                    F.month("fecha").alias("mes"))


def fe_ols(df: DataFrame, keys: list[str], min_obs: int = MIN_OBS) -> DataFrame:
    """PR-1: slope of lq on lp with month fixed effects, R², n per ``keys``.

    Σp̃q̃ = Σ_m(Σpq − ΣpΣq/n_m), Σp̃² likewise; β = Σp̃q̃/Σp̃²;
    R² = 1 − (Σq̃² − βΣp̃q̃)/(Σq² − (Σq)²/n).  NULL if n < min_obs or sd(lp) < 0.02.
    """
    m = df.groupBy(*keys, "mes").agg(
        F.count(F.lit(1)).cast("double").alias("nm"), F.sum("lq").alias("sq"), F.sum("lp").alias("sp"),
        F.sum(F.col("lq") * F.col("lq")).alias("sqq"), F.sum(F.col("lp") * F.col("lp")).alias("spp"),
        F.sum(F.col("lp") * F.col("lq")).alias("spq"))
    g = m.groupBy(*keys).agg(
        F.sum("nm").alias("n"),
        F.sum(F.col("spq") - F.col("sp") * F.col("sq") / F.col("nm")).alias("pq_t"),
        F.sum(F.col("spp") - F.col("sp") * F.col("sp") / F.col("nm")).alias("pp_t"),
        F.sum(F.col("sqq") - F.col("sq") * F.col("sq") / F.col("nm")).alias("qq_t"),
        F.sum("sq").alias("sq"), F.sum("sqq").alias("sqq"), F.sum("sp").alias("sp"), F.sum("spp").alias("spp"))
    n = F.col("n")
    sd_p = F.sqrt(F.greatest((F.col("spp") - F.col("sp") * F.col("sp") / n) / (n - 1), F.lit(0.0)))
    ok = (n >= min_obs) & (sd_p >= MIN_SD_LOG_P) & (F.col("pp_t") > 0)
    beta = F.col("pq_t") / F.col("pp_t")
    sst = F.col("sqq") - F.col("sq") * F.col("sq") / n
    r2 = F.lit(1.0) - (F.col("qq_t") - beta * F.col("pq_t")) / F.nullif(sst, F.lit(0.0))
    return g.select(*keys, F.when(ok, beta).alias("elast"), F.when(ok, r2).alias("r2"), n.cast("bigint").alias("n"))


def elasticities(lines: DataFrame, products: DataFrame, min_obs: int = MIN_OBS) -> DataFrame:
    """PR-2: product → atc3 → atc1 → global fallback, level label, clip to bounds."""
    d = log_price_quantity(lines.join(products.select("id_producto", "atc1", "atc3"), "id_producto"))
    lv_p = fe_ols(d, ["id_producto"], min_obs).select("id_producto", F.col("elast").alias("e_p"))
    lv_3 = fe_ols(d, ["atc3"], min_obs).select("atc3", F.col("elast").alias("e_3"))
    lv_1 = fe_ols(d, ["atc1"], min_obs).select("atc1", F.col("elast").alias("e_1"))
    lv_g = fe_ols(d.withColumn("_all", F.lit(1)), ["_all"], min_obs).select(F.col("elast").alias("e_g"))
    out = (products.select("id_producto", "atc1", "atc3").join(lv_p, "id_producto", "left")
           .join(lv_3, "atc3", "left").join(lv_1, "atc1", "left").crossJoin(lv_g))
    lvl = (F.when(F.col("e_p").isNotNull(), "Producto").when(F.col("e_3").isNotNull(), "ATC3")
           .when(F.col("e_1").isNotNull(), "ATC1").otherwise("Global"))
    e = F.coalesce("e_p", "e_3", "e_1", "e_g")
    return out.select("id_producto", clip(e, *ELASTICITY_BOUNDS).alias("elasticidad"), lvl.alias("nivel_estimacion"))


def discount_grid(lines: DataFrame, spark) -> DataFrame:
    """PR-3: grid values ≤ floor(p95(historical discount)·50)/50."""
    top = lines.agg((F.floor(F.percentile(F.col("descuento_pct_int") / 100.0, 0.95) * 50) / 50).alias("tope"))
    grid = spark.createDataFrame([(d,) for d in GRID], "d double")
    return grid.crossJoin(top).filter(F.col("d") <= F.col("tope") + 1e-9).select("d")


def acceptance_curve(d: Column) -> Column:
    """Acceptance probability of an offer at discount ``d`` (binding's rule: 0.30 + 4·d)."""
    return clip(F.lit(0.30) + F.lit(4.0) * d, 0.0, 1.0)


def evaluate_grid(cand: DataFrame, grid: DataFrame, p_accept=acceptance_curve) -> DataFrame:
    """PR-5 / PR-6: counterfactual demand, margin, risk, rescued stock and objective per grid value (``grid`` None:
    ``cand`` has a discount ``d`` in each row already)."""
    g = cand if grid is None else cand.crossJoin(F.broadcast(grid))
    d = F.col("d")
    g = g.withColumn("precio_neto", F.col("precio_lista") * (F.lit(1.0) - d))
    g = g.withColumn("demanda", F.least(F.col("q_base") * F.pow(F.lit(1.0) - d, F.col("elasticidad")),
                                        F.lit(DEMAND_CAP) * F.col("q_base")))
    g = g.withColumn("prob_aceptacion", p_accept(d))
    g = g.withColumn("margen_unitario", F.col("precio_neto") - F.col("costo"))
    g = g.withColumn("margen_pct", F.col("margen_unitario") / F.col("precio_neto"))
    g = g.withColumn("margen_esperado", F.col("prob_aceptacion") * F.col("demanda") * F.col("margen_unitario"))
    exceso = clip((F.col("dias_cobertura") - F.lit(float(DOH_MAX))) / F.lit(float(DOH_MAX)), 0.0, 1.5)
    g = g.withColumn("riesgo_devolucion", clip(F.col("riesgo_dev_base") * (
        F.lit(1.0) + F.lit(1.20) * exceso + F.lit(0.90) * (F.col("dias_a_vencer") < SHORT_LOT_DAYS).cast("double")
        + F.lit(1.50) * d), 0.0, 0.60))
    g = g.withColumn("margen_neto", F.col("margen_esperado") * (F.lit(1.0) - F.col("riesgo_devolucion")))
    g = g.withColumn("valor_rescate", F.least(F.col("prob_aceptacion") * F.col("demanda"),
                                              F.col("unidades_por_vencer").cast("double")) * F.col("costo"))
    return g.withColumn("objetivo", F.col("margen_neto") + F.col("valor_rescate"))


SEGMENT = ["segmento"]          # customer segment; candidates are segment × product


def optimise(evaluated: DataFrame, grid: DataFrame) -> DataFrame:
    """PR-7 / PR-8 / W-9 / W-10: margin floor, argmax per segment × product (objective desc,
    discount asc), gain vs no offer, positive gains only, top 5 per segment."""
    feas = evaluated.filter(F.col("margen_pct") >= MIN_MARGIN_PCT)
    w = Window.partitionBy(*SEGMENT, "id_producto").orderBy(F.col("objetivo").desc(), F.col("d"))
    best = feas.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") == 1).drop("_r")
    gmax = grid.agg(F.max("d").alias("_gmax"))
    best = (best.crossJoin(F.broadcast(gmax))
            .withColumn("en_borde_de_soporte", (F.col("d") >= F.col("_gmax") - 1e-9).cast("int")).drop("_gmax"))
    best = best.withColumn("objetivo_sin_oferta", F.col("q_base") * (F.col("precio_lista") - F.col("costo"))
                           * (F.lit(1.0) - F.col("riesgo_dev_base")))
    best = best.withColumn("ganancia", F.col("objetivo") - F.col("objetivo_sin_oferta")).filter(F.col("ganancia") > 0)
    ws = Window.partitionBy(*SEGMENT).orderBy(F.col("objetivo").desc(), F.col("id_producto"))
    return (best.withColumn("rank_segmento", F.row_number().over(ws))
            .filter(F.col("rank_segmento") <= TOP_PER_SEGMENT))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


# ---------------------------------------------------------------- the engine at branch × channel × segment × product
CELL = ["id_filial", "canal", "segmento"]
#: Where a cell's demand finds support, from the cell itself upwards.
SUPPORT = {"filial × canal × segmento × producto": [*CELL, "id_producto"], "filial × segmento × producto": ["id_filial", "segmento", "id_producto"],
           "filial × producto": ["id_filial", "id_producto"], "segmento × producto": ["segmento", "id_producto"], "producto": ["id_producto"]}
MIN_CUSTOMERS = 3
SHRINK = 3.0          # customers that the level's mean counts as
MONTHS_BASE = 6.0     # months of the base period (180 days)


def supported_cells(recent: DataFrame) -> DataFrame:
    """PR-4: cells (branch × channel × segment × product) with sales in the base period, and their monthly base demand.

    A cell with enough customers stands by itself.  A smaller one looks for the finest level above it that has enough,
    and its demand is drawn towards the mean cell of that level: (customers · own + SHRINK · mean) / (customers +
    SHRINK).  Cells without support at any level are no candidates.  ``recent``: lines with channel and segment."""
    grain = SUPPORT[next(iter(SUPPORT))]
    cells = recent.groupBy(*grain).agg(F.sum("unidades").cast("bigint").alias("unidades"), F.count_distinct("id_cliente").alias("clientes"),
                                       F.avg("dias_a_vencer").alias("dias_a_vencer"))
    # a customer belongs to one branch, channel and segment, but buys in several lines: distinct pairs first
    buyers = recent.select(*grain, "id_cliente").distinct()
    out, found, mean = cells, F.lit(None).cast("int"), F.lit(None).cast("double")
    for k, keys in reversed(list(enumerate(SUPPORT.values()))):
        if k == 0:
            enough, level = F.col("clientes") >= MIN_CUSTOMERS, F.col("unidades").cast("double") / MONTHS_BASE
        else:
            per = buyers.groupBy(*keys).agg(F.count_distinct("id_cliente").alias(f"_c{k}")).join(
                cells.groupBy(*keys).agg((F.sum("unidades").cast("double") / MONTHS_BASE / F.count(F.lit(1)).cast("double")).alias(f"_m{k}")), keys)
            out = out.join(per, keys, "left")
            enough, level = F.col(f"_c{k}") >= MIN_CUSTOMERS, F.col(f"_m{k}")
        found, mean = F.when(enough, F.lit(k)).otherwise(found), F.when(enough, level).otherwise(mean)
    own, n = F.col("unidades").cast("double") / MONTHS_BASE, F.col("clientes").cast("double")
    out = out.withColumn("_k", found).filter("_k IS NOT NULL")
    demand = F.when(F.col("_k") == 0, own).otherwise((n * own + F.lit(SHRINK) * mean) / (n + F.lit(SHRINK)))
    names = F.array(*[F.lit(x) for x in SUPPORT])
    return out.select(*grain, "unidades", "clientes", "dias_a_vencer", F.element_at(names, F.col("_k") + 1).alias("nivel_soporte"),
                      F.greatest(F.round(demand, 9), F.lit(1.0)).alias("q_base"))


def optimise_cells(evaluated: DataFrame, grid: DataFrame) -> DataFrame:
    """PR-7, PR-8, W-9, W-10 at the grain of cells: margin floor, best discount of each cell (the lower one among
    equals), gain against no offer, gains only, the five best products of each branch × channel × segment."""
    feasible = evaluated.filter(F.col("margen_pct") >= MIN_MARGIN_PCT)
    row = F.struct(F.col("objetivo"), (-F.col("d")).alias("_d"), F.struct(*evaluated.columns).alias("row"))
    best = feasible.groupBy(*CELL, "id_producto").agg(F.max(row).alias("_b")).select("_b.row.*")
    top = grid.agg(F.max("d").alias("_gmax"))
    best = best.crossJoin(F.broadcast(top)).withColumn("en_borde_de_soporte", (F.col("d") >= F.col("_gmax") - 1e-9).cast("int")).drop("_gmax")
    best = best.withColumn("objetivo_sin_oferta", F.col("q_base") * (F.col("precio_lista") - F.col("costo")) * (F.lit(1.0) - F.col("riesgo_dev_base")))
    best = best.withColumn("ganancia", F.col("objetivo") - F.col("objetivo_sin_oferta")).filter(F.col("ganancia") > 0)
    w = Window.partitionBy(*CELL).orderBy(F.col("objetivo").desc(), F.col("id_producto"))
    return best.withColumn("rank_segmento", F.row_number().over(w)).filter(F.col("rank_segmento") <= TOP_PER_SEGMENT)
