"""Registered learned-model queries (rows/invariant checks only: learned output) M-2, M-3, M-11 … M-18, PR-10."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from starmetrics import config as K
from starmetrics.functions import exprs as X
from starmetrics.operators import learn as L
from starmetrics.operators import pricing as P
from starmetrics.operators import scores as S
from starmetrics.operators import windows as W
from starmetrics.operators.star import model
from starmetrics.session import ensure_checkpoint_dir
from starmetrics.plans.catalog import query
from starmetrics.plans.cleansing import CLASS_EXPR_DUCK, SEASONAL_SQL
from starmetrics.plans.oracle import sql
from starmetrics.plans.windows_q import _VOL_SQL, _rate_sql

_FITTED: dict = {}


def _return_model(spark, sf_dir):
    key = ("dev", id(spark), sf_dir)
    if key not in _FITTED:
        ensure_checkpoint_dir(spark)
        feats = S._features(model(spark, sf_dir))
        mdl, iso, d = L.fit_classifier(feats, "devuelta", L.RETURN_NUM, L.RETURN_CAT, balanced=True)
        _FITTED[key] = (mdl, iso, feats)
    return _FITTED[key]


def _offer_model(spark, sf_dir):
    key = ("of", id(spark), sf_dir)
    if key not in _FITTED:
        ensure_checkpoint_dir(spark)
        m = model(spark, sf_dir)
        feats = m.shared("offer_features", lambda: L.offer_features(m))
        mdl, iso, d = L.fit_classifier(feats, "aceptada", L.OFFER_NUM, L.OFFER_CAT, balanced=False)
        _FITTED[key] = (mdl, iso, feats)
    return _FITTED[key]


_R_RATES = [("tasa_dev_cliente_hist", "id_cliente", K.ALPHA_CUSTOMER, "UNBOUNDED PRECEDING"),
            ("tasa_dev_producto_hist", "id_producto", K.ALPHA_PRODUCT, "UNBOUNDED PRECEDING"),
            ("tasa_dev_transportista_hist", "id_transportista", K.ALPHA_CARRIER, "UNBOUNDED PRECEDING"),
            ("tasa_dev_cliente_producto_hist", "id_cliente, id_producto", K.ALPHA_CUSTOMER_PRODUCT,
             "UNBOUNDED PRECEDING"),
            ("tasa_dev_filial_hist", "id_filial", K.ALPHA_BRANCH, "3 PRECEDING"),
            ("tasa_dev_deposito_hist", "id_deposito", K.ALPHA_DEPOT, "3 PRECEDING")]

_RF_BASE = f"""SELECT f.*, p.atc1, p.cadena_frio, p.vida_util_meses,
    1.0 - CAST(p.costo_std_c AS DOUBLE) / nullif(CAST(p.precio_lista_c AS DOUBLE), 0) AS margen_std_pct,
    CAST(p.precio_lista_c AS DOUBLE) / 100.0 AS precio_lista, c.canal, c.segmento, b.region, t.transportista,
    t.control_frio, t.confiabilidad AS conf_raw, CAST(month(f.fecha) AS INT) AS mes_nro,
    {CLASS_EXPR_DUCK.replace('id_producto', 'f.id_producto')} AS clase
    FROM fc f LEFT JOIN dim_producto p ON p.id_producto = f.id_producto
    LEFT JOIN dim_cliente c ON c.id_cliente = f.id_cliente LEFT JOIN dim_filial b ON b.id_filial = f.id_filial
    LEFT JOIN dim_transportista t ON t.id_transportista = f.id_transportista"""

M02_SQL = sql(
    "SELECT r.id_linea, r.anio_mes, r.devuelta, r.importe_usd_c, r.id_filial, r.id_cliente, r.id_producto, "
    "CAST(r.unidades AS DOUBLE) AS unidades, CAST(r.importe_usd_c AS DOUBLE) / 100.0 AS importe_usd, "
    "CAST(r.descuento_pct_int AS DOUBLE) AS descuento_pct, r.precio_lista, r.margen_std_pct, "
    "CAST(r.vida_util_meses AS DOUBLE) AS vida_util_meses, CAST(r.dias_a_vencer AS DOUBLE) AS dias_a_vencer, "
    "CAST(r.lead_time_dias AS DOUBLE) AS lead_time_dias, CAST(r.sla_dias AS DOUBLE) AS sla_dias, "
    "CAST(greatest(r.lead_time_dias - r.sla_dias, 0) AS DOUBLE) AS exceso_lead_time, "
    "CAST(r.otif AS DOUBLE) AS otif, CAST(r.cadena_frio AS DOUBLE) AS cadena_frio, "
    "CAST(CAST(r.cadena_frio = 1 AND NOT coalesce(r.control_frio = 1, false) AS INT) AS DOUBLE) AS frio_sin_control, "
    "coalesce(CAST(r.conf_raw AS DOUBLE), (SELECT quantile_cont(conf_raw, 0.5) FROM rf_base)) AS confiabilidad, "
    "CAST(r.mes_nro AS DOUBLE) AS mes_nro, s.indice_estacional, "
    "least(greatest(CAST(r.unidades AS DOUBLE) / greatest(v.media_prev, 1.0), 0.0), 25.0) AS ratio_unidades_vs_hist, "
    "least(greatest(CAST(r.dias_a_vencer AS DOUBLE) / CAST(r.vida_util_meses * 30 AS DOUBLE), 0.0), 1.0) "
    "AS vida_util_remanente_pct, "
    f"CAST(CAST(r.dias_a_vencer < {K.SHELF_LIFE_ALERT_DAYS} AS INT) AS DOUBLE) AS lote_critico, "
    f"CAST(CAST(least(greatest(CAST(r.unidades AS DOUBLE) / greatest(q.msku, 1.0), 0.0), 40.0) > {K.DISPROPORTION_RATIO} "
    "AS INT) AS DOUBLE) AS pedido_desproporcionado, "
    "CAST(CAST(r.tipo_oferta IN ('BON', 'COM') AS INT) AS DOUBLE) AS oferta_de_carga, "
    "least(greatest(CAST(r.unidades AS DOUBLE) / greatest(q.msku, 1.0), 0.0), 40.0) AS ratio_unidades_vs_sku, "
    + ", ".join(f"coalesce(r{i}.tasa_prev, pr.prior) AS {n}" for i, (n, *_) in enumerate(_R_RATES))
    + ", r.atc1, r.canal, r.segmento, r.region, r.tipo_oferta, r.transportista FROM rf_base r "
    f"LEFT JOIN ({SEASONAL_SQL}) s USING (clase, mes_nro) "
    + " ".join(f"LEFT JOIN ({_rate_sql(k, a, rows)}) r{i} USING ({k}, anio_mes)"
               for i, (_, k, a, rows) in enumerate(_R_RATES))
    + f" LEFT JOIN ({_VOL_SQL}) v USING (id_cliente, id_producto, anio_mes)"
    " JOIN (SELECT id_producto, quantile_cont(unidades, 0.5) AS msku FROM rf_base GROUP BY 1) q USING (id_producto)"
    " CROSS JOIN prior_dev pr",
    "fc", "prior_dev", "dim_producto", "dim_cliente", "dim_filial", "dim_transportista",
    extra={"rf_base": (["fc", "dim_producto", "dim_cliente", "dim_filial", "dim_transportista"], _RF_BASE)})

_O_RATES = [("tasa_acept_cliente_hist", "id_cliente", 12.0), ("tasa_acept_producto_hist", "id_producto", 20.0),
            ("tasa_acept_tipo_hist", "tipo_oferta", 50.0)]


def _acc_rate_sql(key, alpha):
    return f"""SELECT {key}, anio_mes, (coalesce(sum(s) OVER w, 0) + prior * {alpha}) / (coalesce(sum(c) OVER w, 0)
       + {alpha}) AS tasa_prev FROM (SELECT {key}, anio_mes, CAST(sum(aceptada) AS DOUBLE) AS s,
       CAST(count(*) AS DOUBLE) AS c FROM ofertas GROUP BY ALL) g CROSS JOIN op
       WINDOW w AS (PARTITION BY {key} ORDER BY anio_mes ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""


M03_SQL = sql(
    "SELECT o.id_oferta, o.anio_mes, o.aceptada, o.id_filial, o.tipo_oferta, p.atc1, c.canal, c.segmento, "
    "CAST(o.descuento_pct_int AS DOUBLE) AS descuento_pct, CAST(o.unidades_ofertadas AS DOUBLE) AS unidades_ofertadas, "
    "o.unidades_ofertadas * (CAST(p.precio_lista_c AS DOUBLE) / 100.0) AS valor_oferta_usd, "
    "o.unidades_ofertadas * (CAST(p.precio_lista_c AS DOUBLE) / 100.0) * o.descuento_pct_int / 100.0 AS descuento_usd, "
    "CAST(o.descuento_pct_int AS DOUBLE) / nullif(md.md, 0.0) AS descuento_vs_medio_tipo, "
    "CAST(o.cobertura_cliente_dias AS DOUBLE) AS cobertura_cliente_dias, CAST(month(o.fecha) AS DOUBLE) AS mes_nro, "
    "CAST(CAST(month(o.fecha) IN (3, 6, 9, 12) AS INT) AS DOUBLE) AS cierre_trimestre, "
    + ", ".join(f"coalesce(r{i}.tasa_prev, op.prior) AS {n}" for i, (n, _, _) in enumerate(_O_RATES))
    + " FROM ofertas o LEFT JOIN dim_producto p ON p.id_producto = o.id_producto "
    "LEFT JOIN dim_cliente c ON c.id_cliente = o.id_cliente "
    + " ".join(f"LEFT JOIN ({_acc_rate_sql(k, a)}) r{i} ON r{i}.{k} = o.{k} AND r{i}.anio_mes = o.anio_mes"
               for i, (_, k, a) in enumerate(_O_RATES))
    + " CROSS JOIN op LEFT JOIN (SELECT tipo_oferta, avg(descuento_pct_int) AS md FROM ofertas GROUP BY 1) md"
    " ON md.tipo_oferta = o.tipo_oferta",
    "ofertas", "dim_producto", "dim_cliente",
    extra={"op": (["ofertas"], f"SELECT avg(aceptada) AS prior FROM ofertas WHERE anio_mes <= {K.CUT_TRAIN}")})


@query("m02_return_feature_table", M02_SQL)
def m02(spark, sf_dir):
    return L.return_features(model(spark, sf_dir))


@query("m03_offer_feature_table", M03_SQL)
def m03(spark, sf_dir):
    return L.offer_features(model(spark, sf_dir))


@query("m12_m13_m15_return_model_scoring")
def m12(spark, sf_dir):
    mdl, iso, feats = _return_model(spark, sf_dir)
    s = L.score(mdl, iso, feats).select("id_linea", "anio_mes", "importe_usd_c", "devuelta",
                                        F.round("p_raw", 5).alias("prob_sin_calibrar"), F.round("prob", 5).alias("prob"))
    q = W.exact_quantiles(s, "prob", list(K.RISK_BAND_QUANTILES))
    p = F.col("prob")
    band = (F.when(p <= F.col("q_60"), K.RISK_BANDS[0]).when(p <= F.col("q_85"), K.RISK_BANDS[1])
            .when(p <= F.col("q_95"), K.RISK_BANDS[2]).otherwise(K.RISK_BANDS[3]))
    return (s.crossJoin(F.broadcast(q)).withColumn("banda_riesgo", band)
            .withColumn("importe_en_riesgo_c", F.round(p * F.col("importe_usd_c"), 2))
            .drop("q_60", "q_85", "q_95"))


@query("m12_holdout_classification_metrics")
def m12b(spark, sf_dir):
    from starmetrics.operators import evaluate as E
    mdl, iso, feats = _return_model(spark, sf_dir)
    s = L.score(mdl, iso, L.split(feats).filter(F.col("particion") == "holdout"))
    auc = E.roc_auc(s, "prob", "devuelta")
    ap = E.average_precision(s, "prob", "devuelta")
    cap = E.decile_capture(s, "prob", "devuelta", "id_linea")
    br = E.brier(s, "prob", "devuelta")
    return auc.crossJoin(ap).crossJoin(br).crossJoin(cap)


@query("m16_offer_model_scoring_priority")
def m16(spark, sf_dir):
    mdl, iso, feats = _offer_model(spark, sf_dir)
    s = L.score(mdl, iso, feats).select("id_oferta", "valor_oferta_usd", "descuento_pct", "aceptada",
                                        F.round("prob", 5).alias("prob_aceptacion"))
    s = s.withColumn("valor_esperado_usd", F.round(F.col("prob_aceptacion") * F.col("valor_oferta_usd")
                                                   * (1 - F.col("descuento_pct") / 100.0), 2))
    n = s.agg(F.count(F.lit(1)).alias("_n"))
    pos = W.global_position(s, [F.col("prob_aceptacion"), F.col("id_oferta")]).crossJoin(F.broadcast(n))
    labels = F.array(*[F.lit(x) for x in K.PRIORITY_LABELS])
    return pos.withColumn("prioridad", F.element_at(labels, W.ntile_expr(F.col("_pos"), F.col("_n"), 4))) \
        .drop("_pos", "_n")


@query("m11_permutation_importance")
def m11(spark, sf_dir):
    mdl, iso, feats = _return_model(spark, sf_dir)
    hold = L.split(feats).filter(F.col("particion") == "holdout").drop("particion")
    return L.permutation_importance(mdl, iso, hold, "devuelta", [*L.RETURN_NUM, *L.RETURN_CAT])


def _rate_frame(m):
    from starmetrics.plans.windows_q import branch_month
    b = branch_month(m).select("id_filial", "anio_mes", "tasa_dev_valor", "otif_medio", "lote_critico_medio")
    b = b.withColumn("y", X.logit("tasa_dev_valor"))
    b = W.lags(b, ["id_filial"], "anio_mes", "y")
    b = W.mean_prev3_complete(b, ["id_filial"], "anio_mes", "y", "y_ma3")
    w = Window.partitionBy("id_filial").orderBy("anio_mes")
    return (b.withColumn("otif_lag1", F.lag("otif_medio", 1).over(w))
            .withColumn("lote_lag1", F.lag("lote_critico_medio", 1).over(w))
            .withColumn("mes_sin", X.month_sin(F.col("anio_mes") % 100))
            .withColumn("mes_cos", X.month_cos(F.col("anio_mes") % 100)))


_RATE_FEATS = ["y_lag1", "y_lag2", "y_lag3", "y_ma3", "otif_lag1", "lote_lag1", "mes_sin", "mes_cos"]


@query("m17_ridge_return_rate_forecast")
def m17(spark, sf_dir):
    f = _rate_frame(model(spark, sf_dir))
    pred, alpha = L.ridge_forecast(f, _RATE_FEATS, "y")
    return (pred.filter(F.col("anio_mes") > K.CUT_VALID)
            .select("id_filial", "anio_mes", "tasa_dev_valor", X.inv_logit("pred").alias("tasa_pronosticada"),
                    F.lit(alpha).alias("alpha")))


@query("m18_ridge_investment_forecast")
def m18(spark, sf_dir):
    from starmetrics.plans.measures_ops_q import investment_series
    s = investment_series(model(spark, sf_dir)).withColumn("y", F.log1p(F.col("real_cpct") / 10000.0))
    s = W.lags(s, ["id_filial"], "anio_mes", "y")
    s = W.mean_prev3_complete(s, ["id_filial"], "anio_mes", "y", "y_ma3")
    s = (s.withColumn("mes_sin", X.month_sin(F.col("anio_mes") % 100))
         .withColumn("mes_cos", X.month_cos(F.col("anio_mes") % 100))
         .withColumn("cierre_trimestre", (F.col("anio_mes") % 100).isin(3, 6, 9, 12).cast("double"))
         .withColumn("en_temporada", (F.col("anio_mes") % 100).isin(5, 6, 7, 8).cast("double")))
    feats = ["y_lag1", "y_lag2", "y_lag3", "y_ma3", "mes_sin", "mes_cos", "cierre_trimestre", "en_temporada"]
    pred, alpha = L.ridge_forecast(s, feats, "y")
    return (pred.filter(F.col("anio_mes") > K.CUT_VALID)
            .select("id_filial", "anio_mes", (F.col("real_cpct") / 10000.0).alias("inversion_usd"),
                    F.expm1("pred").alias("inversion_pronosticada_usd"), F.lit(alpha).alias("alpha")))


@query("pr10_acceptance_model_over_grid")
def pr10(spark, sf_dir):
    from starmetrics.plans.pricing_q import candidates
    m = model(spark, sf_dir)
    mdl, iso, _ = _offer_model(spark, sf_dir)
    grid = P.discount_grid(m.sellin, spark)
    g = candidates(m).crossJoin(F.broadcast(grid))
    dem = F.least(F.col("q_base") * F.pow(F.lit(1.0) - F.col("d"), F.col("elasticidad")), F.lit(3.0) * F.col("q_base"))
    feats = g.select(
        "segmento", "id_producto", "d", F.lit("DTO").alias("tipo_oferta"), "atc1", F.lit("General").alias("canal"),
        (F.col("d") * 100).alias("descuento_pct"), F.greatest(F.round(dem), F.lit(1.0)).alias("unidades_ofertadas"),
        (F.greatest(F.round(dem), F.lit(1.0)) * F.col("precio_lista")).alias("valor_oferta_usd"),
        (F.greatest(F.round(dem), F.lit(1.0)) * F.col("precio_lista") * F.col("d")).alias("descuento_usd"),
        (F.col("d") / 0.115).alias("descuento_vs_medio_tipo"), F.col("dias_cobertura").alias("cobertura_cliente_dias"),
        F.col("mes_nro").cast("double").alias("mes_nro"),
        F.col("mes_nro").isin(3, 6, 9, 12).cast("double").alias("cierre_trimestre"),
        F.lit(0.55).alias("tasa_acept_cliente_hist"), F.lit(0.55).alias("tasa_acept_producto_hist"),
        F.lit(0.55).alias("tasa_acept_tipo_hist"))
    return L.score(mdl, iso, feats).select("segmento", "id_producto", "d", F.round("prob", 5).alias("prob_aceptacion"))
