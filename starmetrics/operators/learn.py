"""Learned models M-2, M-3, M-11 … M-18 and PR-10 with MLlib.

* Feature tables are joins of the point-in-time window features (W-1 … W-8):
  every historical rate uses strictly earlier months.
* Classifiers: ``StringIndexer`` + ``VectorAssembler`` + ``GBTClassifier`` with
  balanced class weights and an early-stopping validation column, calibrated by
  ``IsotonicRegression`` on the validation months.
* Ridge forecasts are solved from Gram matrices: one aggregate per month gives
  Σx, Σy, Σxxᵀ, Σxy (a few dozen numbers per month); folds over distinct months
  (D4) and the whole α path are then solved on the driver from those sums, so
  the cost does not grow with the number of rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmetrics import config as K
from starmetrics.functions import exprs as X
from starmetrics.operators import evaluate as E
from starmetrics.operators import windows as W
from starmetrics.session import release


def return_features(m, scratch: list[str] | None = None) -> DataFrame:
    """M-2: FC-line feature table for the return model (numeric + categorical).  With ``scratch`` the rows are
    written half way, and it gets their folder, which the caller removes when the result is written.

    The lines move by customer and by product (and by carrier, when the carriers are too many to broadcast), each time
    with the columns they need only; texts and other attributes join after that.  All lookups by one key share its
    shuffle: a rate is a map month → rate in one row per key.  What customer and product share needs no table: it is a
    window over the lines, which already lie together by customer.
    """
    from starmetrics.plans.cleansing import CLASS_EXPR, seasonal_table
    from starmetrics.plans.windows_q import fc_lines, hist_rate, prior_dev

    fc = fc_lines(m)
    prior = F.broadcast(prior_dev(m))  # one row, as the two medians below
    rates = [("tasa_dev_cliente_hist", ["id_cliente"], K.ALPHA_CUSTOMER, None),
             ("tasa_dev_producto_hist", ["id_producto"], K.ALPHA_PRODUCT, None),
             ("tasa_dev_transportista_hist", ["id_transportista"], K.ALPHA_CARRIER, None),
             ("tasa_dev_cliente_producto_hist", ["id_cliente", "id_producto"], K.ALPHA_CUSTOMER_PRODUCT, None),
             ("tasa_dev_filial_hist", ["id_filial"], K.ALPHA_BRANCH, 3),
             ("tasa_dev_deposito_hist", ["id_deposito"], K.ALPHA_DEPOT, 3)]
    maps = {keys[0]: W.by_month(hist_rate(m, keys, alpha, win), keys, "tasa_prev", f"_{name}") for name, keys, alpha, win in rates if len(keys) == 1}
    rate_at = {keys[0]: F.col(f"_{name}")[F.col("anio_mes")].alias(name) for name, keys, *_ in rates if len(keys) == 1}

    def look_up(d: DataFrame, key: str, fixed: bool = False) -> DataFrame:
        j = d.join(F.broadcast(maps[key]) if fixed else maps[key], key, "left")
        return j.select(*d.columns, rate_at[key])

    d = fc.select("id_linea", "anio_mes", F.month("fecha").alias("mes_nro"), "devuelta", "importe_usd_c", "id_filial", "id_cliente", "id_producto",
                  "id_deposito", "id_transportista", "unidades", "descuento_pct_int", "dias_a_vencer", "lead_time_dias", "sla_dias", "otif", "tipo_oferta")
    # by customer
    d = d.repartition("id_cliente")
    pair, both = W.before_in(["id_cliente", "id_producto"]), F.col("id_cliente").isNotNull() & F.col("id_producto").isNotNull()
    unit_median = fc.agg(F.percentile("unidades", 0.5).alias("_gmed"))
    d = d.withColumns({"_s": F.sum("devuelta").over(pair), "_u": F.sum("unidades").over(pair), "_c": F.count(F.lit(1)).over(pair)})
    d = d.crossJoin(prior).crossJoin(F.broadcast(unit_median))
    alpha = F.lit(float(K.ALPHA_CUSTOMER_PRODUCT))
    d = d.withColumns({
        "tasa_dev_cliente_producto_hist": F.when(both, (F.coalesce(F.col("_s").cast("double"), F.lit(0.0)) + F.col("prior") * alpha)
                                                 / (F.col("_c").cast("double") + alpha)),
        "media_prev": F.when(both, F.coalesce(F.try_divide(F.col("_u").cast("double"), F.col("_c").cast("double")), "_gmed"))})
    d = look_up(d.drop("_s", "_u", "_c", "_gmed"), "id_cliente").join(m.customers.select("id_cliente", "canal", "segmento"), "id_cliente", "left")
    # by product
    p = m.products.select("id_producto", "atc1", "cadena_frio", "vida_util_meses", "margen_std_pct",
                          (F.col("precio_lista_c") / 100.0).alias("precio_lista"))
    sku_median = fc.groupBy("id_producto").agg(F.percentile("unidades", 0.5).alias("_gm"))
    d = look_up(d, "id_producto").join(sku_median, "id_producto", "left")
    d = d.withColumn("ratio_unidades_vs_sku", X.clip(F.col("unidades") / F.greatest("_gm", F.lit(1.0)), 0.0, 40.0)).drop("_gm")
    d = d.join(p, "id_producto", "left")
    if scratch is not None:  # the shuffles by customer and product go before the lines move by carrier
        d = m.written("return_features_by_product", lambda d=d: d, scratch)
    # by carrier
    t = m.carriers.select("id_transportista", "transportista", "control_frio", "confiabilidad")
    by_carrier = fc.groupBy("id_transportista").agg(F.count(F.lit(1)).alias("_n"))
    med_conf = by_carrier.join(t, "id_transportista", "left").agg(F.percentile("confiabilidad", 0.5, F.col("_n")).alias("_mc"))
    d = look_up(d, "id_transportista").join(t, "id_transportista", "left")
    d = d.crossJoin(F.broadcast(med_conf)).withColumn("confiabilidad", F.coalesce(F.col("confiabilidad").cast("double"), "_mc"))
    # branches and depots: nations, months and classes, all of fixed size
    d = look_up(look_up(d, "id_filial", fixed=True), "id_deposito", fixed=True)
    d = d.join(F.broadcast(m.branches.select("id_filial", "region")), "id_filial", "left").withColumn("clase", F.expr(CLASS_EXPR))
    d = d.join(F.broadcast(seasonal_table(m.spark)), ["clase", "mes_nro"], "left")
    for name, *_ in rates:
        d = d.withColumn(name, F.coalesce(name, "prior"))
    return d.select(
        "id_linea", "anio_mes", "devuelta", "importe_usd_c", "id_filial", "id_cliente", "id_producto",
        F.col("unidades").cast("double").alias("unidades"),
        (F.col("importe_usd_c") / 100.0).alias("importe_usd"),
        F.col("descuento_pct_int").cast("double").alias("descuento_pct"), "precio_lista", "margen_std_pct",
        F.col("vida_util_meses").cast("double").alias("vida_util_meses"),
        F.col("dias_a_vencer").cast("double").alias("dias_a_vencer"),
        F.col("lead_time_dias").cast("double").alias("lead_time_dias"), F.col("sla_dias").cast("double").alias("sla_dias"),
        F.greatest(F.col("lead_time_dias") - F.col("sla_dias"), F.lit(0)).cast("double").alias("exceso_lead_time"),
        F.col("otif").cast("double").alias("otif"), F.col("cadena_frio").cast("double").alias("cadena_frio"),
        ((F.col("cadena_frio") == 1) & ~F.coalesce(F.col("control_frio") == 1, F.lit(False))).cast("double")
        .alias("frio_sin_control"),
        "confiabilidad", F.col("mes_nro").cast("double").alias("mes_nro"), "indice_estacional",
        X.clip(F.col("unidades").cast("double") / F.greatest("media_prev", F.lit(1.0)), 0.0, 25.0).alias("ratio_unidades_vs_hist"),
        X.clip(F.col("dias_a_vencer").cast("double") / (F.col("vida_util_meses") * 30).cast("double"), 0.0, 1.0)
        .alias("vida_util_remanente_pct"),
        (F.col("dias_a_vencer") < K.SHELF_LIFE_ALERT_DAYS).cast("double").alias("lote_critico"),
        (F.col("ratio_unidades_vs_sku") > K.DISPROPORTION_RATIO).cast("double").alias("pedido_desproporcionado"),
        F.col("tipo_oferta").isin("BON", "COM").cast("double").alias("oferta_de_carga"), "ratio_unidades_vs_sku",
        *[n for n, *_ in rates],
        "atc1", "canal", "segmento", "region", "tipo_oferta", "transportista")


RETURN_CAT = ["atc1", "canal", "segmento", "region", "tipo_oferta"]
RETURN_NUM = ["unidades", "importe_usd", "descuento_pct", "precio_lista", "margen_std_pct", "vida_util_meses",
              "dias_a_vencer", "lead_time_dias", "sla_dias", "exceso_lead_time", "otif", "cadena_frio",
              "frio_sin_control", "confiabilidad", "mes_nro", "indice_estacional", "ratio_unidades_vs_hist",
              "vida_util_remanente_pct", "lote_critico", "pedido_desproporcionado", "oferta_de_carga",
              "ratio_unidades_vs_sku", "tasa_dev_cliente_hist", "tasa_dev_producto_hist",
              "tasa_dev_transportista_hist", "tasa_dev_cliente_producto_hist", "tasa_dev_filial_hist",
              "tasa_dev_deposito_hist"]


def offer_features(m) -> DataFrame:
    """M-3: offer feature table (point-in-time acceptance rates + offer economics)."""
    o = m.fact_ofertas
    prior = o.filter(F.col("anio_mes") <= K.CUT_TRAIN).agg(F.avg("aceptada").alias("prior"))
    d = o.join(m.products.select("id_producto", "atc1", (F.col("precio_lista_c") / 100.0).alias("precio_lista")),
               "id_producto", "left").join(m.customers.select("id_cliente", "canal", "segmento"), "id_cliente", "left")
    for name, keys, alpha in [("tasa_acept_cliente_hist", ["id_cliente"], 12.0),
                              ("tasa_acept_producto_hist", ["id_producto"], 20.0),
                              ("tasa_acept_tipo_hist", ["tipo_oferta"], 50.0)]:
        agg = W.month_counts(o, keys, "aceptada").crossJoin(prior)
        r = W.smoothed_rate_before(agg, keys, F.col("prior"), alpha).select(*keys, "anio_mes",
                                                                            F.col("tasa_prev").alias(name))
        d = d.join(r, keys + ["anio_mes"], "left")
    d = d.crossJoin(prior)
    mean_disc = o.groupBy("tipo_oferta").agg(F.avg("descuento_pct_int").alias("_md"))
    d = d.join(mean_disc, "tipo_oferta", "left")
    return d.select(
        "id_oferta", "anio_mes", "aceptada", "id_filial", "tipo_oferta", "atc1", "canal", "segmento",
        F.col("descuento_pct_int").cast("double").alias("descuento_pct"),
        F.col("unidades_ofertadas").cast("double").alias("unidades_ofertadas"),
        (F.col("unidades_ofertadas") * F.col("precio_lista")).alias("valor_oferta_usd"),
        (F.col("unidades_ofertadas") * F.col("precio_lista") * F.col("descuento_pct_int") / 100.0).alias("descuento_usd"),
        X.safe_div("descuento_pct_int", "_md").alias("descuento_vs_medio_tipo"),
        F.col("cobertura_cliente_dias").cast("double").alias("cobertura_cliente_dias"),
        F.month("fecha").cast("double").alias("mes_nro"),
        F.month("fecha").isin(3, 6, 9, 12).cast("double").alias("cierre_trimestre"),
        *[F.coalesce(c, "prior").alias(c) for c in ("tasa_acept_cliente_hist", "tasa_acept_producto_hist",
                                                   "tasa_acept_tipo_hist")])


OFFER_CAT = ["tipo_oferta", "atc1", "canal", "segmento"]
OFFER_NUM = ["descuento_pct", "unidades_ofertadas", "valor_oferta_usd", "descuento_usd", "descuento_vs_medio_tipo",
             "cobertura_cliente_dias", "mes_nro", "cierre_trimestre", "tasa_acept_cliente_hist",
             "tasa_acept_producto_hist", "tasa_acept_tipo_hist"]


def split(df: DataFrame) -> DataFrame:
    """M-1 split label: train ≤ CUT_TRAIN < valid ≤ CUT_VALID < holdout."""
    return df.withColumn("particion", F.when(F.col("anio_mes") <= K.CUT_TRAIN, "train")
                         .when(F.col("anio_mes") <= K.CUT_VALID, "valid").otherwise("holdout"))


def fit_classifier(df: DataFrame, label: str, num: list[str], cat: list[str], balanced: bool,
                   max_iter: int = 40, seed: int = 7):
    """M-12 / M-13: boosted trees on train (+valid for early stopping), isotonic calibration on valid."""
    d = split(df).withColumn("_val", F.col("particion") == "valid")
    if balanced:
        w = d.filter(F.col("particion") == "train").agg(F.avg(F.col(label).cast("double")).alias("_pos"))
        d = d.crossJoin(w).withColumn("_w", F.when(F.col(label) == 1, 0.5 / F.col("_pos"))
                                      .otherwise(0.5 / (1 - F.col("_pos"))))
    else:
        d = d.withColumn("_w", F.lit(1.0))
    idx = [StringIndexer(inputCol=c, outputCol=f"{c}_ix", handleInvalid="keep") for c in cat]
    asm = VectorAssembler(inputCols=num + [f"{c}_ix" for c in cat], outputCol="features", handleInvalid="keep")
    gbt = GBTClassifier(labelCol=label, featuresCol="features", weightCol="_w", maxIter=max_iter, maxDepth=4,
                        maxBins=64, stepSize=0.1, seed=seed, validationIndicatorCol="_val", validationTol=0.001)
    train = d.filter(F.col("particion") != "holdout").withColumn(label, F.col(label).cast("double"))
    model = Pipeline(stages=idx + [asm, gbt]).fit(train)
    raw = lambda x: model.transform(x).withColumn("p_raw", vector_to_array("probability")[1])
    val = raw(d.filter(F.col("particion") == "valid")).select(F.col("p_raw"), F.col(label).cast("double").alias("y"))
    iso = IsotonicRegression(featuresCol="p_raw", labelCol="y", predictionCol="prob").fit(
        val.withColumn("p_raw", F.col("p_raw")))
    release(df.sparkSession)
    return model, iso, d


def score(model, iso, df: DataFrame) -> DataFrame:
    s = model.transform(df).withColumn("p_raw", vector_to_array("probability")[1])
    return iso.transform(s)


def permutation_importance(model, iso, df: DataFrame, label: str, features: list[str], repeats: int = 3,
                           seed: int = 1) -> DataFrame:
    """M-11: AUC drop when one feature is permuted (mean and std over repeats), over all rows of ``df``.

    A permutation is the rows re-attached to themselves through two global orders (row id vs a seeded random key): no
    collect, no single task.  The features of a row are its model vector, so a repeat joins the vectors of the permuted
    rows once; each row is then scored once for each feature, with that one place taken from the other row, and the
    ranks of all features come from one histogram.
    """
    *prepare, trees = model.stages
    places = [c.removesuffix("_ix") for c in prepare[-1].getInputCols()]
    vectors = PipelineModel(prepare).transform(df).select(F.col(label).alias("_y"), vector_to_array("features").alias("_x"))
    # written once, with its order: the rows' own order is the same for every repeat
    base = W.global_position(vectors.withColumn("_id", F.monotonically_increasing_id()), [F.col("_id")], pos="_k")

    def aucs(rows: DataFrame) -> DataFrame:
        s = score(trees, iso, rows.withColumn("features", array_to_vector("_x")))
        return E.roc_auc(s, "prob", "_y", by=["_f"])

    def without(f: str):
        i = places.index(f)
        return F.concat(F.slice("_x", 1, i), F.slice("_z", i + 1, 1), F.slice("_x", i + 2, len(places)))

    auc0 = aucs(base.withColumn("_f", F.lit(""))).first()["roc_auc"]
    drops: dict[str, list[float]] = {f: [] for f in features}
    for r in range(repeats):
        b = W.global_position(base.select(F.col("_x").alias("_z"), F.rand(seed + r).alias("_rk"), "_id"),
                              [F.col("_rk"), F.col("_id")], pos="_k").select("_k", "_z")
        each = F.explode(F.array(*[F.struct(F.lit(f).alias("_f"), without(f).alias("_x")) for f in features])).alias("_e")
        perm = base.join(b, "_k").select("_y", each).select("_y", "_e.*")
        for row in aucs(perm).collect():  # one row per feature
            drops[row["_f"]].append(auc0 - row["roc_auc"])
        release(df.sparkSession)
    rows = [(f, float(np.mean(d)), float(np.std(d))) for f, d in drops.items()]
    return df.sparkSession.createDataFrame(rows, "feature string, importancia double, desvio double") \
        .orderBy(F.col("importancia").desc())


# ------------------------------------------------------------------ ridge from Gram matrices
def month_gram(df: DataFrame, features: list[str], target: str, month: str = "anio_mes") -> DataFrame:
    """Per month: n, Σx, Σy, Σxxᵀ (upper triangle), Σxy, Σy²."""
    aggs = [F.count(F.lit(1)).alias("n"), F.sum(target).alias("sy"), F.sum(F.col(target) ** 2).alias("syy")]
    for i, a in enumerate(features):
        aggs += [F.sum(a).alias(f"sx{i}"), F.sum(F.col(a) * F.col(target)).alias(f"sxy{i}")]
        for j in range(i, len(features)):
            aggs.append(F.sum(F.col(a) * F.col(features[j])).alias(f"sxx{i}_{j}"))
    return df.groupBy(month).agg(*aggs)


def _solve(rows, k, alpha):
    n = sum(r["n"] for r in rows)
    sx = np.array([sum(r[f"sx{i}"] for r in rows) for i in range(k)])
    sy = sum(r["sy"] for r in rows)
    sxx = np.zeros((k, k))
    for i in range(k):
        for j in range(i, k):
            sxx[i, j] = sxx[j, i] = sum(r[f"sxx{i}_{j}"] for r in rows)
    sxy = np.array([sum(r[f"sxy{i}"] for r in rows) for i in range(k)])
    mx, my = sx / n, sy / n
    cov = sxx / n - np.outer(mx, mx)
    sd = np.sqrt(np.maximum(np.diag(cov), 1e-12))
    cxx = (sxx - n * np.outer(mx, mx)) / np.outer(sd, sd)
    cxy = (sxy - n * mx * my) / sd
    w_std = np.linalg.solve(cxx + alpha * np.eye(k), cxy)
    w = w_std / sd
    return w, my - mx @ w


def ridge_fit(df: DataFrame, features: list[str], target: str, alphas=None, n_folds: int = 3) -> tuple[np.ndarray, float, float]:
    """M-17 / M-18: (weights, intercept, α) of a ridge with standardised features; α chosen by time-ordered folds over
    the distinct months of the training period (D4); refit on train+valid."""
    alphas = alphas if alphas is not None else np.logspace(-2, 3, 30)
    d = df.dropna(subset=features + [target])
    gram = {r["anio_mes"]: r for r in month_gram(d.filter(F.col("anio_mes") <= K.CUT_VALID), features, target).collect()}
    # one row per month: the collect is bounded by the number of months
    months = sorted(gram)
    k = len(features)
    cut = np.array_split(np.array(months[len(months) // 2:]), n_folds)
    best, best_err = alphas[0], np.inf
    for a in alphas:
        err = 0.0
        for fold in cut:
            if not len(fold):
                continue
            tr = [gram[mm] for mm in months if mm < fold[0]]
            w, b = _solve(tr, k, a)
            for mm in fold:
                r = gram[mm]
                # Σ(y − ŷ)² from the month's sums
                sxx = np.zeros((k, k))
                for i in range(k):
                    for j in range(i, k):
                        sxx[i, j] = sxx[j, i] = r[f"sxx{i}_{j}"]
                sx = np.array([r[f"sx{i}"] for i in range(k)])
                sxy = np.array([r[f"sxy{i}"] for i in range(k)])
                err += (r["syy"] - 2 * (w @ sxy + b * r["sy"]) + w @ sxx @ w + 2 * b * (w @ sx) + r["n"] * b * b)
        if err < best_err:
            best, best_err = a, err
    w, b = _solve([gram[mm] for mm in months], k, best)
    return w, float(b), float(best)


def ridge_forecast(df: DataFrame, features: list[str], target: str, alphas=None, n_folds: int = 3) -> tuple[DataFrame, float]:
    """``df`` with the fitted ridge's ``pred`` of every row, and α."""
    w, b, best = ridge_fit(df, features, target, alphas, n_folds)
    pred = F.lit(b)
    for i, f in enumerate(features):
        pred = pred + F.lit(float(w[i])) * F.col(f)
    return df.withColumn("pred", pred), best
