"""Stored scores and forecasts, which the measures read.

* Return scores (M-12, M-13, M-15): walk-forward.  The model of a cut sees the months up to it, of which the last ones
  only calibrate; it scores the months up to the next cut.  So no line is scored by a model that saw it, or any line
  of its month or later.  Before the first cut there is no model: a line's score is its product's smoothed rate of
  earlier months (model 0).  The table is written by month in one atomic version, with the model's number and the last
  month it saw.
* Forecasts (M-17, M-18): ridge from Gram matrices, one row a branch and month: lags, calendar and the drivers known
  before the month.  One step ahead for every month, and several steps fed with their own values from the last
  training month on, also past the data.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmetrics import config as K
from starmetrics.functions import exprs as X
from starmetrics.operators import learn as L
from starmetrics.operators import windows as W
from starmetrics.operators.star import _first_of_month
from starmetrics.session import release, remove, shared_dir
from starmetrics.sources import snapshots


# ---------------------------------------------------------------- classifier
def months_before(cut: int, n: int) -> int:
    """yyyymm of n months before ``cut``."""
    i = cut // 100 * 12 + cut % 100 - 1 - n
    return i // 12 * 100 + i % 12 + 1


def fit_until(df: DataFrame, label: str, key: str, num: list[str], cat: list[str], cut: int, balanced: bool = True, max_iter: int = 40, seed: int = 7):
    """Boosted trees on the months up to ``cut`` less the calibration months, stopped early by a fixed share of those
    rows (by hash of ``key``), and isotonic calibration on the calibration months."""
    last_fit = months_before(cut, K.CALIBRATION_MONTHS)
    y = F.col(label).cast("double")
    d = df.filter(F.col("anio_mes") <= last_fit).withColumn("_y", y)
    d = d.withColumn("_stop", F.pmod(F.xxhash64(key), F.lit(100)) < K.EARLY_STOP_PCT)
    pos = d.agg(F.avg("_y").alias("_pos"))
    weight = F.when(F.col("_y") == 1, 0.5 / F.col("_pos")).otherwise(0.5 / (1 - F.col("_pos"))) if balanced else F.lit(1.0)
    d = d.crossJoin(F.broadcast(pos)).withColumn("_w", weight)  # one row
    index = [StringIndexer(inputCol=c, outputCol=f"{c}_ix", handleInvalid="keep") for c in cat]
    vector = VectorAssembler(inputCols=num + [f"{c}_ix" for c in cat], outputCol="features", handleInvalid="keep")
    trees = GBTClassifier(labelCol="_y", featuresCol="features", weightCol="_w", maxIter=max_iter, maxDepth=4, maxBins=64, stepSize=0.1, seed=seed,
                          validationIndicatorCol="_stop", validationTol=0.001)
    model = Pipeline(stages=[*index, vector, trees]).fit(d)
    late = df.filter((F.col("anio_mes") > last_fit) & (F.col("anio_mes") <= cut)).withColumn("_y", y)
    raw = model.transform(late).select(vector_to_array("probability")[1].alias("p_raw"), "_y")
    iso = IsotonicRegression(featuresCol="p_raw", labelCol="_y", predictionCol="prob").fit(raw)
    release(df.sparkSession)
    return model, iso


def walk_forward(df: DataFrame, label: str, key: str, num: list[str], cat: list[str], history: str, cuts=K.WALK_CUTS, balanced: bool = True) -> DataFrame:
    """``df`` with ``prob_sin_calibrar``, ``prob``, ``modelo`` and ``entrenado_hasta``."""
    first = df.filter(F.col("anio_mes") <= cuts[0]).withColumns({
        "prob_sin_calibrar": F.col(history), "prob": F.col(history), "modelo": F.lit(0), "entrenado_hasta": F.lit(None).cast("int")})
    out = [first]
    for k, cut in enumerate(cuts, 1):
        block = df.filter(F.col("anio_mes") > cut)
        if k < len(cuts):
            block = block.filter(F.col("anio_mes") <= cuts[k])
        model, iso = fit_until(df, label, key, num, cat, cut, balanced)
        s = L.score(model, iso, block)
        out.append(s.withColumns({"prob_sin_calibrar": F.col("p_raw"), "modelo": F.lit(k), "entrenado_hasta": F.lit(cut)}))
    cols = [*df.columns, "prob_sin_calibrar", "prob", "modelo", "entrenado_hasta"]
    from functools import reduce
    return reduce(DataFrame.unionByName, [o.select(*cols) for o in out])


def _features(m) -> DataFrame:
    scratch: list[str] = []
    out = m.shared("return_features", lambda: L.return_features(m, scratch))
    for path in scratch:
        remove(m.spark, path)
    return out


def return_scores(m, cuts=K.WALK_CUTS) -> DataFrame:
    """The stored score table of the sale lines, with risk bands (quantiles of all scores) and the keys of the
    dimensions; written once per model."""
    memo = m.__dict__.setdefault("_scores", {})
    if cuts not in memo:
        from starmetrics.plans.windows_q import fc_lines
        s = walk_forward(_features(m), "devuelta", "id_linea", L.RETURN_NUM, L.RETURN_CAT, "tasa_dev_producto_hist", cuts)
        s = s.select("id_linea", "anio_mes", "devuelta", "importe_usd_c", *[F.round(c, 5).alias(c) for c in ("prob_sin_calibrar", "prob")], "modelo", "entrenado_hasta")
        keys = fc_lines(m).select("id_linea", "fecha", "id_cliente", "id_producto", "id_filial", "id_deposito", "id_transportista", "tipo_oferta")
        types = m.offer_types.select(F.col("cod_tipo_oferta").alias("tipo_oferta"), "id_tipo_oferta")
        path = shared_dir(m.spark, f"scores-{snapshots._new_version(0)}")
        snapshots.create(s.join(keys, "id_linea").join(F.broadcast(types), "tipo_oferta", "left"), path, "fecha", "anio_mes")
        release(m.spark)
        stored = snapshots.read(m.spark, path)
        q = W.exact_quantiles(stored, "prob", list(K.RISK_BAND_QUANTILES))
        p = F.col("prob")
        band = (F.when(p <= F.col("q_60"), K.RISK_BANDS[0]).when(p <= F.col("q_85"), K.RISK_BANDS[1])
                .when(p <= F.col("q_95"), K.RISK_BANDS[2]).otherwise(K.RISK_BANDS[3]))
        memo[cuts] = stored.crossJoin(F.broadcast(q)).withColumn("banda_riesgo", band).drop("q_60", "q_85", "q_95")
    return memo[cuts]


# ---------------------------------------------------------------- forecasts
#: What the return rate of a branch depends on besides its lags: shares and means of the month before.
DRIVERS = {"pct_frio_sin_control": "frio_sin_control", "pct_oferta_carga": "oferta_de_carga", "exceso_lead_time_medio": "exceso_lead_time"}
RATE_FEATURES = ["y_lag1", "y_lag2", "y_ma3", "mes_sin", "mes_cos", *[f"{d}_lag1" for d in DRIVERS]]
INVEST_FEATURES = ["y_lag1", "y_lag2", "y_lag3", "y_ma3", "tasa_acept_lag1", "valor_ofertado_log", "cierre_trimestre", "mes_sin", "mes_cos"]


def _calendar(df: DataFrame) -> DataFrame:
    mes = F.col("anio_mes") % 100
    return df.withColumns({"mes_sin": X.month_sin(mes), "mes_cos": X.month_cos(mes), "cierre_trimestre": mes.isin(3, 6, 9, 12).cast("double"),
                           "es_holdout": (F.col("anio_mes") > K.CUT_VALID).cast("int"), "fecha": _first_of_month()})


def rate_frame(m) -> DataFrame:
    """Branch and month: value return rate (its logit ``y``), lags, and the drivers of the month before."""
    from starmetrics.plans.windows_q import branch_month
    b = branch_month(m).select("id_filial", "anio_mes", "importe_c", "devuelto_c", "tasa_dev_valor")
    d = _features(m).groupBy("id_filial", "anio_mes").agg(*[F.avg(c).alias(n) for n, c in DRIVERS.items()])
    b = b.join(d, ["id_filial", "anio_mes"], "left").withColumn("y", X.logit("tasa_dev_valor"))
    b = W.mean_prev3_complete(W.lags(b, ["id_filial"], "anio_mes", "y"), ["id_filial"], "anio_mes", "y", "y_ma3")
    w = Window.partitionBy("id_filial").orderBy("anio_mes")
    return _calendar(b.withColumns({f"{n}_lag1": F.lag(n, 1).over(w) for n in DRIVERS}))


def returns_forecast(m) -> DataFrame:
    """M-17: branch and month with real and projected rate (clipped), projected amount and ``es_holdout``."""
    def build():
        pred, alpha = L.ridge_forecast(rate_frame(m), RATE_FEATURES, "y")
        rate = X.clip(X.inv_logit("pred"), 0.0, K.FORECAST_RATE_MAX)
        return pred.filter("pred IS NOT NULL").select(
            "id_filial", "anio_mes", "fecha", "importe_c", "devuelto_c", "tasa_dev_valor", rate.alias("tasa_proyectada"),
            F.round(rate * F.col("importe_c").cast("double"), 2).alias("devuelto_proyectado_c"), X.inv_logit("y_lag1").alias("tasa_ingenua"),
            "es_holdout", F.lit(alpha).alias("alpha"))
    return m.shared("returns_forecast", build)


def returns_outlook(m, months: int = K.OUTLOOK_MONTHS) -> DataFrame:
    """M-17 several steps ahead: ``id_filial, anio_mes, paso, tasa_proyectada`` from the month after the last training
    month to ``months`` after the data.  Each step's lags are the steps before it; the drivers keep their last known
    values.  A branch is one row with the array of its steps, so the recursion stays inside an expression."""
    f = rate_frame(m)
    w, b, _ = L.ridge_fit(f, RATE_FEATURES, "y")
    weight = dict(zip(RATE_FEATURES, map(float, w)))
    last = f.agg(F.max(X.month_index("anio_mes")).alias("_end"))
    known = f.filter(F.col("anio_mes") <= K.CUT_VALID)
    at = F.struct("anio_mes", "y", *DRIVERS)
    per = known.groupBy("id_filial").agg(F.slice(F.reverse(F.array_sort(F.collect_list(at))), 1, 3).alias("h")).filter(F.size("h") == 3)
    start = K.CUT_VALID // 100 * 12 + K.CUT_VALID % 100 - 1
    per = per.crossJoin(F.broadcast(last)).withColumn("steps", F.sequence(F.lit(start + 1), F.col("_end") + months))

    def step(s: Column, i: Column) -> Column:
        mes = i % 12 + 1
        z = F.lit(b) + s.l1 * weight["y_lag1"] + s.l2 * weight["y_lag2"] + (s.l1 + s.l2 + s.l3) / 3.0 * weight["y_ma3"]
        z = z + X.month_sin(mes) * weight["mes_sin"] + X.month_cos(mes) * weight["mes_cos"]
        for d in DRIVERS:
            z = z + F.col("h")[0][d] * weight[f"{d}_lag1"]
        p = X.clip(X.inv_logit(z), K.RETURN_RATE_CLIP[0], K.FORECAST_RATE_MAX)
        return F.struct(X.logit(p).alias("l1"), s.l1.alias("l2"), s.l2.alias("l3"), F.array_append(s.out, F.struct(i.cast("int").alias("i"), p.alias("p"))).alias("out"))

    state = F.struct(F.col("h")[0]["y"].alias("l1"), F.col("h")[1]["y"].alias("l2"), F.col("h")[2]["y"].alias("l3"),
                     F.array().cast("array<struct<i:int,p:double>>").alias("out"))
    per = per.withColumn("run", F.aggregate("steps", state, step).getField("out"))
    return per.select("id_filial", F.explode("run").alias("r")).select(
        "id_filial", X.index_to_month(F.col("r.i")).alias("anio_mes"), (F.col("r.i") - start).alias("paso"), F.col("r.p").alias("tasa_proyectada"))


def investment_frame(m) -> DataFrame:
    """Branch and month: accepted discount (``y`` = log1p of USD), its lags, and the value on offer."""
    o = m.fact_ofertas.join(m.products.select("id_producto", "precio_lista_c"), "id_producto")
    value = F.col("unidades_ofertadas") * F.col("precio_lista_c")
    g = o.groupBy("id_filial", "anio_mes").agg(
        F.count(F.lit(1)).alias("ofertas"), F.sum("aceptada").alias("aceptadas"), F.sum(value).cast("bigint").alias("valor_c"),
        F.sum(F.when(F.col("aceptada") == 1, value * F.col("descuento_pct_int")).otherwise(0)).cast("bigint").alias("real_cpct"))
    g = g.withColumn("y", F.log1p(F.col("real_cpct") / 10_000.0))
    g = W.mean_prev3_complete(W.lags(g, ["id_filial"], "anio_mes", "y"), ["id_filial"], "anio_mes", "y", "y_ma3")
    w = Window.partitionBy("id_filial").orderBy("anio_mes")
    g = g.withColumns({"tasa_acept_lag1": F.lag(X.safe_div("aceptadas", "ofertas"), 1).over(w), "valor_ofertado_log": F.log1p(F.col("valor_c") / 100.0)})
    return _calendar(g)


def investment_forecast(m) -> DataFrame:
    """M-18: branch and month with real and projected investment (hundredths of cents, not below 0) and ``es_holdout``."""
    def build():
        pred, alpha = L.ridge_forecast(investment_frame(m), INVEST_FEATURES, "y")
        usd = X.clip(F.expm1("pred"), 0.0)
        return pred.filter("pred IS NOT NULL").select(
            "id_filial", "anio_mes", "fecha", "real_cpct", F.round(usd * 10_000.0).cast("bigint").alias("forecast_cpct"),
            F.round(F.expm1("y_lag1") * 10_000.0).cast("bigint").alias("ingenuo_cpct"), "es_holdout", F.lit(alpha).alias("alpha"))
    return m.shared("investment_forecast", build)
