"""The price engine at branch × channel × segment × product: candidates, grid, recommendations, their measures."""

from __future__ import annotations

from pyspark.sql import functions as F

from starmetrics.functions import exprs as X
from starmetrics.operators import learn as L
from starmetrics.operators import pricing as P
from starmetrics.operators import scores as S
from starmetrics.operators.star import model
from starmetrics.plans import pricing_q as PQ
from starmetrics.plans.catalog import query
from starmetrics.plans.cleansing import CLASS_EXPR, CLASS_EXPR_DUCK, SEASONAL_SQL, seasonal_table
from starmetrics.plans.oracle import CTES, sql
from starmetrics.plans.windows_q import line_risk

_GRAIN = ["id_filial", "canal", "segmento", "id_producto"]


def recent_lines(m):
    last = m.sellin.agg(F.max("fecha").alias("_u"))
    d = m.sellin.crossJoin(F.broadcast(last)).filter(F.col("fecha") >= F.date_sub("_u", 180)).drop("_u")  # one row
    return d.join(m.keyed("customers", "id_cliente", "canal", "segmento"), "id_cliente", "left")


def branch_stock(m):
    """Stock by branch (a depot belongs to one) and product: the last snapshot that a depot has of a product within the
    base period.  Where every depot reports every product each month, that is the last month."""
    since = m.sellin.agg(F.trunc(F.date_sub(F.max("fecha"), 180), "MM").alias("_since"))
    s = m.fact_stock.crossJoin(F.broadcast(since)).filter(F.col("fecha") >= F.col("_since"))  # one row
    cols = ["stock_unidades", "unidades_por_vencer_180d", "dias_cobertura"]
    s = s.groupBy("id_deposito", "id_producto").agg(F.max_by(F.struct(*cols), "anio_mes").alias("_l")).select("id_deposito", "id_producto", "_l.*")
    s = s.join(m.depots.select("id_deposito", "id_filial"), "id_deposito")
    return s.groupBy("id_filial", "id_producto").agg(
        F.sum("stock_unidades").alias("stock_unidades"), F.sum("unidades_por_vencer_180d").alias("unidades_por_vencer"), F.avg("dias_cobertura").alias("dias_cobertura"))


def cell_candidates(m, scored):
    """PR-4 at its grain.  ``scored``: lines with ``prob`` (return risk), averaged by branch and product (A-6)."""
    recent = recent_lines(m)
    cells = P.supported_cells(recent)
    prod = m.keyed("products", "id_producto", "atc1", "precio_lista_c", "costo_std_c").select("id_producto", "atc1", (F.col("precio_lista_c") / 100.0).alias("precio_lista"), (F.col("costo_std_c") / 100.0).alias("costo"), "costo_std_c")
    margin = recent.join(prod, "id_producto").groupBy("id_filial", "id_producto").agg(F.sum(F.col("importe_usd_c") - F.col("costo_std_c") * F.col("unidades")).alias("_m"))
    share = margin.join(margin.groupBy("id_filial").agg(F.sum("_m").alias("_t")), "id_filial").select("id_filial", "id_producto", X.safe_div("_m", "_t").alias("aporte_margen_pct"))
    risk = scored.groupBy("id_filial", "id_producto").agg(F.round(F.avg("prob"), 9).alias("riesgo_dev_base"))
    overall = scored.agg(F.round(F.avg("prob"), 9).alias("_rall"))
    target = m.sellin.agg(((F.max("mes_idx") + 1) % 12 + 1).alias("mes_nro"))
    where = ["id_filial", "id_producto"]
    c = (cells.join(prod.drop("costo_std_c"), "id_producto", "left").join(PQ.pr_elasticities(m).select("id_producto", "elasticidad", "nivel_estimacion"), "id_producto", "left")
         .join(branch_stock(m), where, "left").join(risk, where, "left").join(share, where, "left").crossJoin(F.broadcast(overall)).crossJoin(F.broadcast(target)))
    c = c.select(*_GRAIN, "atc1", "unidades", "clientes", "nivel_soporte", "q_base", "precio_lista", "costo", "elasticidad", "nivel_estimacion",
                 F.coalesce("stock_unidades", F.lit(0)).alias("stock_unidades"), F.coalesce("unidades_por_vencer", F.lit(0)).alias("unidades_por_vencer"),
                 F.coalesce("dias_cobertura", F.lit(float(P.DOH_MIN))).alias("dias_cobertura"),
                 F.coalesce("dias_a_vencer", F.lit(float(P.DEFAULT_DAYS_TO_EXPIRY))).alias("dias_a_vencer"), F.coalesce("riesgo_dev_base", "_rall").alias("riesgo_dev_base"),
                 F.coalesce("aporte_margen_pct", F.lit(0.0)).alias("aporte_margen_pct"), "mes_nro", F.expr(CLASS_EXPR).alias("clase"))
    return c.join(F.broadcast(seasonal_table(m.spark)), ["clase", "mes_nro"], "left")  # 84 rows


def cell_recommendations(m):
    """With the binding's acceptance curve and the smoothed product rates: what SQL can say as well."""
    def build():
        grid = P.discount_grid(m.sellin, m.spark)
        return P.optimise_cells(P.evaluate_grid(cell_candidates(m, line_risk(m)), grid), grid)
    return m.shared("cell_recommendations", build)


# ---------------------------------------------------------------- with the trained models
def accepted_grid(m, cand, grid):
    """PR-5, PR-10: the whole candidate × discount table scored in one batch by the offer model, as direct discounts."""
    from starmetrics.plans.ml_models_q import _offer_model
    trees, iso, feats = _offer_model(m.spark, m.sf_dir)
    prior = feats.agg(F.avg("aceptada").alias("_prior"))
    g = P.evaluate_grid(cand, grid).crossJoin(F.broadcast(prior))
    n = F.greatest(F.round("demanda"), F.lit(1.0))
    value = n * F.col("precio_lista")
    x = g.withColumns({"tipo_oferta": F.lit("DTO"), "descuento_pct": F.col("d") * 100, "unidades_ofertadas": n, "valor_oferta_usd": value, "descuento_usd": value * F.col("d"),
                       "descuento_vs_medio_tipo": F.col("d") / 0.115, "cobertura_cliente_dias": F.col("dias_cobertura"), "cierre_trimestre": F.col("mes_nro").isin(3, 6, 9, 12).cast("double"),
                       **{c: F.col("_prior") for c in ("tasa_acept_cliente_hist", "tasa_acept_producto_hist", "tasa_acept_tipo_hist")}})
    x = x.withColumn("mes_nro", F.col("mes_nro").cast("double"))
    s = L.score(trees, iso, x)
    # the curve's probability gives way to the model's, and what follows from it is made again
    keep = [c for c in cand.columns if c != "mes_nro"]
    s = s.select(*keep, F.col("mes_nro").cast("int").alias("mes_nro"), "d", F.col("prob").alias("_p"))
    return P.evaluate_grid(s, None, lambda d: F.col("_p")).drop("_p")


def model_recommendations(m):
    """W-9, W-10, PR-5 … PR-8 with the offer model's acceptance and the stored return scores."""
    def build():
        grid = P.discount_grid(m.sellin, m.spark)
        cand = m.shared("cell_candidates_scored", lambda: cell_candidates(m, S.return_scores(m)))
        return P.optimise_cells(accepted_grid(m, cand, grid), grid)
    return m.shared("model_recommendations", build)


# ---------------------------------------------------------------- SQL
def _support_sql() -> str:
    levels = list(SUPPORT_KEYS.items())
    joins, found, mean = "", "NULL", "NULL"
    for k, (_, keys) in reversed(list(enumerate(levels))):
        if k == 0:
            enough, level = f"c.clientes >= {P.MIN_CUSTOMERS}", f"CAST(c.unidades AS DOUBLE) / {P.MONTHS_BASE}"
        else:
            using = ", ".join(keys)
            joins += (f" LEFT JOIN (SELECT {using}, count(DISTINCT id_cliente) AS c{k} FROM recent_c GROUP BY ALL) a{k} USING ({using})"
                      f" LEFT JOIN (SELECT {using}, CAST(sum(unidades) AS DOUBLE) / {P.MONTHS_BASE} / CAST(count(*) AS DOUBLE) AS m{k} FROM cells GROUP BY ALL) b{k} USING ({using})")
            enough, level = f"c{k} >= {P.MIN_CUSTOMERS}", f"m{k}"
        found, mean = f"CASE WHEN {enough} THEN {k} ELSE {found} END", f"CASE WHEN {enough} THEN {level} ELSE {mean} END"
    names = "[" + ", ".join(f"'{n}'" for n, _ in levels) + "]"
    own = f"CAST(unidades AS DOUBLE) / {P.MONTHS_BASE}"
    return f"""SELECT id_filial, canal, segmento, id_producto, unidades, clientes, dav, list_extract({names}, CAST(k + 1 AS INT)) AS nivel_soporte,
      greatest(round(CASE WHEN k = 0 THEN {own} ELSE (CAST(clientes AS DOUBLE) * ({own}) + {P.SHRINK} * mean) / (CAST(clientes AS DOUBLE) + {P.SHRINK}) END, 9), 1.0) AS q_base
      FROM (SELECT c.*, {found} AS k, {mean} AS mean FROM cells c{joins}) x WHERE k IS NOT NULL"""


SUPPORT_KEYS = P.SUPPORT
CTES.update({
    "recent_c": (["recent", "dim_cliente"], "SELECT r.*, c.canal, c.segmento FROM recent r LEFT JOIN (SELECT id_cliente, canal, segmento FROM dim_cliente) c USING (id_cliente)"),
    "cells": (["recent_c"], """SELECT id_filial, canal, segmento, id_producto, CAST(sum(unidades) AS BIGINT) AS unidades, count(DISTINCT id_cliente) AS clientes, avg(dias_a_vencer) AS dav
      FROM recent_c GROUP BY ALL"""),
    "cells_q": (["cells", "recent_c"], _support_sql()),
    "cand_c": (["cells_q", "recent_c", "dim_producto", "elast", "stock", "dim_deposito", "line_risk"], f"""SELECT b.*, p.atc1, CAST(p.precio_lista_c AS DOUBLE) / 100.0 AS precio_lista,
      CAST(p.costo_std_c AS DOUBLE) / 100.0 AS costo, e.elasticidad, e.nivel_estimacion, coalesce(st.su, 0) AS stock_unidades, coalesce(st.pv, 0) AS unidades_por_vencer,
      coalesce(st.dc, {float(P.DOH_MIN)}) AS dias_cobertura, coalesce(b.dav, {float(P.DEFAULT_DAYS_TO_EXPIRY)}) AS dias_a_vencer,
      coalesce(r.r, (SELECT round(avg(prob), 9) FROM line_risk)) AS riesgo_dev_base, coalesce(a.aporte, 0.0) AS aporte_margen_pct,
      CAST((SELECT max(mes_idx) FROM sellin) + 1 AS INT) % 12 + 1 AS mes_nro, {CLASS_EXPR_DUCK.replace('id_producto', 'b.id_producto')} AS clase
      FROM cells_q b LEFT JOIN dim_producto p USING (id_producto) LEFT JOIN elast e USING (id_producto)
      LEFT JOIN (SELECT d.id_filial, s.id_producto, sum(s.stock_unidades) AS su, sum(s.unidades_por_vencer_180d) AS pv, avg(s.dias_cobertura) AS dc
        FROM (SELECT * FROM stock WHERE fecha >= (SELECT CAST(date_trunc('month', max(fecha) - INTERVAL 180 DAY) AS DATE) FROM sellin)
          QUALIFY row_number() OVER (PARTITION BY id_deposito, id_producto ORDER BY anio_mes DESC) = 1) s JOIN dim_deposito d USING (id_deposito) GROUP BY ALL) st ON st.id_filial = b.id_filial AND st.id_producto = b.id_producto
      LEFT JOIN (SELECT id_filial, id_producto, round(avg(prob), 9) AS r FROM line_risk GROUP BY ALL) r ON r.id_filial = b.id_filial AND r.id_producto = b.id_producto
      LEFT JOIN (SELECT id_filial, id_producto, CAST(mm AS DOUBLE) / nullif(CAST(sum(mm) OVER (PARTITION BY id_filial) AS DOUBLE), 0) AS aporte FROM
        (SELECT s.id_filial, s.id_producto, sum(s.importe_usd_c - q.costo_std_c * s.unidades) AS mm FROM recent_c s JOIN dim_producto q USING (id_producto) GROUP BY ALL)) a
        ON a.id_filial = b.id_filial AND a.id_producto = b.id_producto"""),
    "cand_cs": (["cand_c"], f"SELECT c.*, t.indice_estacional FROM cand_c c LEFT JOIN ({SEASONAL_SQL}) t USING (clase, mes_nro)"),
})
for _new, _old, _from, _to in (("g1c", "g1", "cand_s", "cand_cs"), ("g2c", "g2", "g1", "g1c"), ("g3c", "g3", "g2", "g2c"), ("best_c", "best", "g3", "g3c"), ("reco_c", "reco", "best", "best_c"),
                               ("reco_c_txt", "reco_txt", "reco", "reco_c")):
    _deps, _text = CTES[_old]
    _text = _text.replace(f"FROM {_from}", f"FROM {_to}").replace("PARTITION BY segmento", "PARTITION BY id_filial, canal, segmento")
    CTES[_new] = ([_to if d == _from else d for d in _deps], _text)

_CAND_COLS = ["unidades", "clientes", "nivel_soporte", "q_base", "precio_lista", "costo", "elasticidad", "nivel_estimacion", "stock_unidades", "unidades_por_vencer", "dias_cobertura",
              "dias_a_vencer", "riesgo_dev_base", "aporte_margen_pct", "indice_estacional"]


@query("pr04_cells_with_nested_support", sql(
    "SELECT id_filial, canal, segmento, id_producto, " + ", ".join(f"CAST({c} AS BIGINT) AS {c}" if c in ("clientes", "stock_unidades", "unidades_por_vencer") else c for c in _CAND_COLS) + " FROM cand_cs", "cand_cs"))
def pr04c(spark, sf_dir):
    m = model(spark, sf_dir)
    c = cell_candidates(m, line_risk(m))
    return c.select(*_GRAIN, *[F.col(x).cast("bigint").alias(x) if x in ("clientes", "stock_unidades", "unidades_por_vencer") else x for x in _CAND_COLS])


_RECO_COLS = ["q_base", "precio_neto", "demanda", "prob_aceptacion", "margen_unitario", "riesgo_devolucion", "valor_rescate", "objetivo", "objetivo_sin_oferta", "ganancia"]


@query("pr07_w09_w10_recommendations_by_cell", sql(
    "SELECT id_filial, canal, segmento, id_producto, d, nivel_soporte, CAST(rank_segmento AS BIGINT) AS rank_segmento, en_borde_de_soporte, justificativo, "
    + ", ".join(f"round({c}, 6) AS {c}" for c in _RECO_COLS) + " FROM reco_c_txt", "reco_c_txt"))
def pr07c(spark, sf_dir):
    r = cell_recommendations(model(spark, sf_dir))
    return r.select(*_GRAIN, "d", "nivel_soporte", F.col("rank_segmento").cast("bigint").alias("rank_segmento"), "en_borde_de_soporte", PQ.justification(r).alias("justificativo"),
                    *[F.round(c, 6).alias(c) for c in _RECO_COLS])


@query("a11_recommendation_summary_by_cell", sql(
    """SELECT CAST(count(DISTINCT (id_filial, canal, segmento)) AS BIGINT) AS segmentos, CAST(count(*) AS BIGINT) AS recomendaciones, round(avg(d), 9) AS descuento_medio,
       round(sum(ganancia), 4) AS ganancia_total, round(sum(valor_rescate), 4) AS stock_rescatado, CAST(sum(en_borde_de_soporte) AS BIGINT) AS en_borde FROM reco_c""", "reco_c"))
def a11c(spark, sf_dir):
    r = cell_recommendations(model(spark, sf_dir))
    return r.agg(F.count_distinct(F.struct(*P.CELL)).alias("segmentos"), F.count(F.lit(1)).alias("recomendaciones"), F.round(F.avg("d"), 9).alias("descuento_medio"),
                 F.round(F.sum("ganancia"), 4).alias("ganancia_total"), F.round(F.sum("valor_rescate"), 4).alias("stock_rescatado"),
                 F.sum("en_borde_de_soporte").cast("bigint").alias("en_borde"))


@query("o02_cell_recommendations_ordered", sql(
    """SELECT id_filial, canal, segmento, CAST(rank_segmento AS BIGINT) AS rank_segmento, id_producto,
       CAST(row_number() OVER (ORDER BY id_filial, canal, segmento, rank_segmento) AS BIGINT) AS orden FROM reco_c""", "reco_c"))
def o02c(spark, sf_dir):
    from starmetrics.operators.windows import global_position
    r = cell_recommendations(model(spark, sf_dir)).select(*P.CELL, F.col("rank_segmento").cast("bigint").alias("rank_segmento"), "id_producto")
    return global_position(r, [F.col(c) for c in (*P.CELL, "rank_segmento")], pos="orden").withColumn("orden", F.col("orden").cast("bigint"))


@query("pr10_recommendations_with_model_acceptance")
def pr10c(spark, sf_dir):
    r = model_recommendations(model(spark, sf_dir))
    return r.select(*_GRAIN, "d", "nivel_soporte", "rank_segmento", "en_borde_de_soporte", PQ.justification(r).alias("justificativo"), *[F.round(c, 6).alias(c) for c in _RECO_COLS])
