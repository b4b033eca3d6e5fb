"""Registered window queries W-1 … W-19 (+ J-6 point-in-time join)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from starmetrics import config as K
from starmetrics.functions import exprs as X
from starmetrics.operators import windows as W
from starmetrics.operators.star import model
from starmetrics.plans.catalog import query
from starmetrics.plans.oracle import CTES, sql

def FC():
    return F.col("tipo_documento") == "FC"

# shared oracle CTEs of this module
CTES.update({
    "fc": (["sellin"], "SELECT * FROM sellin WHERE tipo_documento = 'FC'"),
    "prior_dev": (["fc"], f"SELECT avg(devuelta) AS prior FROM fc WHERE anio_mes <= {K.CUT_TRAIN}"),
    "branch_month": (["fc"], f"""SELECT anio_mes, id_filial, CAST(sum(importe_usd_c) AS BIGINT) AS importe_c,
        CAST(sum(importe_devuelto_usd_c) AS BIGINT) AS devuelto_c, CAST(sum(unidades) AS BIGINT) AS unidades,
        CAST(count(*) AS BIGINT) AS lineas, avg(lead_time_dias) AS lead_time_medio,
        avg(dias_a_vencer) AS dias_a_vencer_medio, avg(otif) AS otif_medio, avg(descuento_pct_int) AS descuento_medio,
        avg(entrega_completa) AS completas_medio, avg(CASE WHEN dias_a_vencer < {K.SHELF_LIFE_ALERT_DAYS} THEN 1 ELSE 0 END)
        AS lote_critico_medio,
        least(greatest(CAST(sum(importe_devuelto_usd_c) AS DOUBLE) / nullif(CAST(sum(importe_usd_c) AS DOUBLE), 0),
        {K.RETURN_RATE_CLIP[0]}), {K.RETURN_RATE_CLIP[1]}) AS tasa_dev_valor FROM fc GROUP BY 1, 2"""),
    "net_month_branch": (["fv"], """SELECT id_filial, anio_mes, CAST(sum(importe_usd_c * signo) AS BIGINT) AS neto_c
        FROM fv GROUP BY 1, 2"""),
})


def fc_lines(m):
    return m.sellin.filter(FC())


def prior_dev(m):
    """One row, written once per model: every historical rate reads it."""
    return m.shared("prior_dev", lambda: fc_lines(m).filter(F.col("anio_mes") <= K.CUT_TRAIN).agg(F.avg("devuelta").alias("prior")))


def branch_month(m):
    """A-1: monthly branch drivers (sums + means) and clipped value return rate."""
    s = fc_lines(m)
    return s.groupBy("anio_mes", "id_filial").agg(
        F.sum("importe_usd_c").cast("bigint").alias("importe_c"),
        F.sum("importe_devuelto_usd_c").cast("bigint").alias("devuelto_c"),
        F.sum("unidades").cast("bigint").alias("unidades"),
        F.count(F.lit(1)).alias("lineas"),
        F.avg("lead_time_dias").alias("lead_time_medio"),
        F.avg("dias_a_vencer").alias("dias_a_vencer_medio"),
        F.avg("otif").alias("otif_medio"),
        F.avg("descuento_pct_int").alias("descuento_medio"),
        F.avg("entrega_completa").alias("completas_medio"),
        F.avg((F.col("dias_a_vencer") < K.SHELF_LIFE_ALERT_DAYS).cast("int")).alias("lote_critico_medio"),
    ).withColumn("tasa_dev_valor", X.clip(X.safe_div("devuelto_c", "importe_c"), *K.RETURN_RATE_CLIP))


def _rate_sql(key, alpha, rows="UNBOUNDED PRECEDING"):
    return f"""SELECT {key}, anio_mes, (coalesce(sum(s) OVER w, 0) + prior * {alpha}) / (coalesce(sum(c) OVER w, 0)
       + {alpha}) AS tasa_prev FROM (SELECT {key}, anio_mes, CAST(sum(devuelta) AS DOUBLE) AS s,
       CAST(count(*) AS DOUBLE) AS c FROM fc GROUP BY ALL) g CROSS JOIN prior_dev
       WINDOW w AS (PARTITION BY {key} ORDER BY anio_mes ROWS BETWEEN {rows} AND 1 PRECEDING)"""


def hist_rate(m, keys, alpha, window=None):
    agg = W.month_counts(fc_lines(m), keys, "devuelta").crossJoin(prior_dev(m))
    return W.smoothed_rate_before(agg, keys, F.col("prior"), alpha, window).select(*keys, "anio_mes", "tasa_prev")


@query("w01_expanding_smoothed_rate", sql(_rate_sql("id_producto", K.ALPHA_PRODUCT), "fc", "prior_dev"))
def w01(spark, sf_dir):
    return hist_rate(model(spark, sf_dir), ["id_producto"], K.ALPHA_PRODUCT)


@query("w02_recent_smoothed_rate_3_months", sql(_rate_sql("id_filial", K.ALPHA_BRANCH, "3 PRECEDING"),
                                                "fc", "prior_dev"))
def w02(spark, sf_dir):
    return hist_rate(model(spark, sf_dir), ["id_filial"], K.ALPHA_BRANCH, window=3)


_VOL_SQL = """SELECT id_cliente, id_producto, anio_mes, coalesce(sum(s) OVER w / sum(c) OVER w,
    (SELECT quantile_cont(unidades, 0.5) FROM fc)) AS media_prev FROM (SELECT id_cliente, id_producto, anio_mes,
    CAST(sum(unidades) AS DOUBLE) AS s, CAST(count(*) AS DOUBLE) AS c FROM fc GROUP BY ALL) g
    WINDOW w AS (PARTITION BY id_cliente, id_producto ORDER BY anio_mes ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""


def hist_volume(m):
    fc = fc_lines(m)
    agg = W.month_counts(fc, ["id_cliente", "id_producto"], "unidades")
    med = fc.agg(F.percentile("unidades", 0.5).alias("_gmed"))
    return (W.mean_before(agg, ["id_cliente", "id_producto"]).crossJoin(med)
            .select("id_cliente", "id_producto", "anio_mes", F.coalesce("media_prev", "_gmed").alias("media_prev")))


@query("w03_historical_mean_volume", sql(_VOL_SQL, "fc"))
def w03(spark, sf_dir):
    return hist_volume(model(spark, sf_dir))


@query("j06_point_in_time_feature_join", sql(
    f"""SELECT f.id_linea, coalesce(r.tasa_prev, (SELECT prior FROM prior_dev)) AS tasa_dev_cliente_hist
       FROM fc f LEFT JOIN ({_rate_sql('id_cliente', K.ALPHA_CUSTOMER)}) r USING (id_cliente, anio_mes)""",
    "fc", "prior_dev"))
def j06(spark, sf_dir):
    m = model(spark, sf_dir)
    r = hist_rate(m, ["id_cliente"], K.ALPHA_CUSTOMER)
    return (fc_lines(m).select("id_linea", "id_cliente", "anio_mes").join(r, ["id_cliente", "anio_mes"], "left")
            .crossJoin(prior_dev(m))
            .select("id_linea", F.coalesce("tasa_prev", "prior").alias("tasa_dev_cliente_hist")))


@query("a01_monthly_branch_drivers", sql("SELECT * FROM branch_month", "branch_month"))
def a01(spark, sf_dir):
    return branch_month(model(spark, sf_dir))


@query("w04_w05_w06_lags_and_complete_ma3", sql(
    """SELECT anio_mes, id_filial, tasa_dev_valor,
       lag(tasa_dev_valor, 1) OVER w AS tasa_dev_valor_lag1, lag(tasa_dev_valor, 2) OVER w AS tasa_dev_valor_lag2,
       lag(tasa_dev_valor, 3) OVER w AS tasa_dev_valor_lag3,
       round(CASE WHEN count(tasa_dev_valor) OVER w3 = 3 THEN avg(tasa_dev_valor) OVER w3 END, 12) AS tasa_ma3_prev,
       lag(otif_medio, 1) OVER w AS otif_medio_lag1, lag(lote_critico_medio, 1) OVER w AS lote_critico_lag1
       FROM branch_month WINDOW w AS (PARTITION BY id_filial ORDER BY anio_mes),
       w3 AS (PARTITION BY id_filial ORDER BY anio_mes ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)""", "branch_month"))
def w04(spark, sf_dir):
    b = branch_month(model(spark, sf_dir))
    b = W.lags(b, ["id_filial"], "anio_mes", "tasa_dev_valor")
    b = W.mean_prev3_complete(b, ["id_filial"], "anio_mes", "tasa_dev_valor", "tasa_ma3_prev")
    w = Window.partitionBy("id_filial").orderBy("anio_mes")
    b = b.withColumn("otif_medio_lag1", F.lag("otif_medio", 1).over(w)) \
        .withColumn("lote_critico_lag1", F.lag("lote_critico_medio", 1).over(w))
    out = b.select("anio_mes", "id_filial", "tasa_dev_valor", "tasa_dev_valor_lag1", "tasa_dev_valor_lag2",
                   "tasa_dev_valor_lag3", "tasa_ma3_prev", "otif_medio_lag1", "lote_critico_lag1")
    return out.withColumn("tasa_ma3_prev", F.round("tasa_ma3_prev", 12))


@query("w07_ratio_to_sku_median_flag", sql(
    f"""SELECT id_linea, least(greatest(CAST(unidades AS DOUBLE) / greatest(m, 1.0), 0.0), 40.0) AS ratio_unidades_vs_sku,
       CAST(least(greatest(CAST(unidades AS DOUBLE) / greatest(m, 1.0), 0.0), 40.0) > {K.DISPROPORTION_RATIO} AS INT)
       AS pedido_desproporcionado FROM fc JOIN (SELECT id_producto, quantile_cont(unidades, 0.5) AS m FROM fc
       GROUP BY 1) q USING (id_producto)""", "fc"))
def w07(spark, sf_dir):
    d = W.ratio_to_group_median(fc_lines(model(spark, sf_dir)), "id_producto", "unidades", 0.0, 40.0,
                                "ratio_unidades_vs_sku")
    return d.select("id_linea", "ratio_unidades_vs_sku",
                    (F.col("ratio_unidades_vs_sku") > K.DISPROPORTION_RATIO).cast("int").alias("pedido_desproporcionado"))


@query("w08_ratio_to_customer_product_history", sql(
    f"""SELECT f.id_linea, least(greatest(CAST(f.unidades AS DOUBLE) / greatest(v.media_prev, 1.0), 0.0), 25.0)
       AS ratio_unidades_vs_hist FROM fc f JOIN ({_VOL_SQL}) v USING (id_cliente, id_producto, anio_mes)""", "fc"))
def w08(spark, sf_dir):
    m = model(spark, sf_dir)
    v = hist_volume(m)
    return (fc_lines(m).join(v, ["id_cliente", "id_producto", "anio_mes"])
            .select("id_linea", X.clip(F.col("unidades").cast("double") / F.greatest("media_prev", F.lit(1.0)),
                                       0.0, 25.0).alias("ratio_unidades_vs_hist")))


# ---------------- W-11 / W-12: global orders ----------------
def offer_scores(m):
    """Acceptance score of each offer: customer's smoothed acceptance rate before the month."""
    o = m.fact_ofertas
    prior = o.filter(F.col("anio_mes") <= K.CUT_TRAIN).agg(F.avg("aceptada").alias("prior"))
    agg = W.month_counts(o, ["id_cliente"], "aceptada").crossJoin(prior)
    r = W.smoothed_rate_before(agg, ["id_cliente"], F.col("prior"), K.ALPHA_CUSTOMER_PRODUCT)
    return (o.join(r.select("id_cliente", "anio_mes", "tasa_prev"), ["id_cliente", "anio_mes"], "left")
            .crossJoin(prior).withColumn("score", F.coalesce("tasa_prev", "prior")).drop("tasa_prev", "prior"))


OFFER_SCORE_SQL = f"""SELECT o.*, coalesce(r.tasa_prev, p.prior) AS score FROM ofertas o
    LEFT JOIN (SELECT id_cliente, anio_mes, (coalesce(sum(s) OVER w, 0) + prior * {K.ALPHA_CUSTOMER_PRODUCT})
       / (coalesce(sum(c) OVER w, 0) + {K.ALPHA_CUSTOMER_PRODUCT}) AS tasa_prev FROM
       (SELECT id_cliente, anio_mes, CAST(sum(aceptada) AS DOUBLE) AS s, CAST(count(*) AS DOUBLE) AS c
        FROM ofertas GROUP BY ALL) g CROSS JOIN (SELECT avg(aceptada) AS prior FROM ofertas WHERE anio_mes <= {K.CUT_TRAIN}) pp
       WINDOW w AS (PARTITION BY id_cliente ORDER BY anio_mes ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) r
    USING (id_cliente, anio_mes)
    CROSS JOIN (SELECT avg(aceptada) AS prior FROM ofertas WHERE anio_mes <= {K.CUT_TRAIN}) p"""
CTES["offer_scores"] = (["ofertas"], OFFER_SCORE_SQL)

_PRIO = ", ".join(f"'{x}'" for x in K.PRIORITY_LABELS)


@query("w11_priority_quartiles_ntile", sql(
    f"""SELECT id_oferta, list_extract([{_PRIO}], CAST(ntile(4) OVER (ORDER BY score, id_oferta) AS INT)) AS prioridad
       FROM offer_scores""", "offer_scores"))
def w11(spark, sf_dir):
    s = offer_scores(model(spark, sf_dir)).select("id_oferta", "score")
    n = s.agg(F.count(F.lit(1)).alias("_n"))
    pos = W.global_position(s, [F.col("score"), F.col("id_oferta")]).crossJoin(F.broadcast(n))
    labels = F.array(*[F.lit(x) for x in K.PRIORITY_LABELS])
    return pos.select("id_oferta", F.element_at(labels, W.ntile_expr(F.col("_pos"), F.col("_n"), 4)).alias("prioridad"))


#: What the readers of the risk of a line use: its keys, dates and amounts, not its texts and other measures.
RISK_COLS = ["id_linea", "fecha", "anio_mes", "id_cliente", "id_producto", "id_filial", "id_deposito", "id_transportista", "tipo_oferta", "id_motivo",
             "devuelta", "importe_usd_c"]


def line_risk(m):
    """Return-risk score of each FC line: product's smoothed return rate before the month
    (shared by the risk bands, the evaluation metrics and the price engine: computed once)."""
    def build():
        r = hist_rate(m, ["id_producto"], K.ALPHA_PRODUCT)
        return (fc_lines(m).select(*RISK_COLS).join(r, ["id_producto", "anio_mes"], "left").crossJoin(prior_dev(m))
                .withColumn("prob", F.coalesce("tasa_prev", "prior")).drop("tasa_prev", "prior"))
    return m.shared("line_risk", build)


CTES["line_risk"] = (["fc", "prior_dev"], f"""SELECT f.*, coalesce(r.tasa_prev, (SELECT prior FROM prior_dev)) AS prob
    FROM fc f LEFT JOIN ({_rate_sql('id_producto', K.ALPHA_PRODUCT)}) r USING (id_producto, anio_mes)""")

_BANDS = K.RISK_BANDS


def risk_bands(m):
    """The scored lines with their band.  Only the three quantiles are written, not the lines a second time."""
    lr = line_risk(m)
    q = m.shared("risk_quantiles", lambda: W.exact_quantiles(lr, "prob", list(K.RISK_BAND_QUANTILES)))
    p = F.col("prob")
    band = (F.when(p <= F.col("q_60"), _BANDS[0]).when(p <= F.col("q_85"), _BANDS[1])
            .when(p <= F.col("q_95"), _BANDS[2]).otherwise(_BANDS[3]))
    return lr.crossJoin(F.broadcast(q)).withColumn("banda_riesgo", band)


CTES["risk_bands"] = (["line_risk"], f"""SELECT l.*, CASE WHEN prob <= q60 THEN '{_BANDS[0]}' WHEN prob <= q85
    THEN '{_BANDS[1]}' WHEN prob <= q95 THEN '{_BANDS[2]}' ELSE '{_BANDS[3]}' END AS banda_riesgo FROM line_risk l
    CROSS JOIN (SELECT quantile_cont(prob, 0.6) AS q60, quantile_cont(prob, 0.85) AS q85,
    quantile_cont(prob, 0.95) AS q95 FROM line_risk) q""")


@query("w12_quantile_risk_bands", sql("SELECT id_linea, prob, banda_riesgo FROM risk_bands", "risk_bands"))
def w12(spark, sf_dir):
    return risk_bands(model(spark, sf_dir)).select("id_linea", "prob", "banda_riesgo")


# ---------------- time intelligence windows ----------------
@query("w14_year_to_date", sql(
    """SELECT anio_mes, neto_c, CAST(sum(neto_c) OVER (PARTITION BY anio_mes // 100 ORDER BY anio_mes) AS BIGINT)
       AS neto_ytd_c FROM (SELECT anio_mes, CAST(sum(neto_c) AS BIGINT) AS neto_c FROM net_month_branch GROUP BY 1) t""",
    "net_month_branch"))
def w14(spark, sf_dir):
    fv = model(spark, sf_dir).fact_ventas
    g = fv.groupBy("anio_mes").agg(F.sum(F.col("importe_usd_c") * F.col("signo")).cast("bigint").alias("neto_c"))
    # one row per month: the year partitions are bounded by 12 rows
    w = Window.partitionBy(F.floor(F.col("anio_mes") / 100)).orderBy("anio_mes") \
        .rowsBetween(Window.unboundedPreceding, 0)
    return g.withColumn("neto_ytd_c", F.sum("neto_c").over(w).cast("bigint"))


def dense_branch_months(m):
    """Calendar-dense (branch × month) grid with net sales (NULL where no sale)."""
    b = m.fact_ventas.groupBy("id_filial", "anio_mes").agg(
        F.sum(F.col("importe_usd_c") * F.col("signo")).cast("bigint").alias("neto_c"),
        F.count_distinct("fecha").alias("dias_con_venta"))
    rng = m.sellin.agg(F.min("mes_idx").alias("a"), F.max("mes_idx").alias("b"))
    months = rng.select(F.explode(F.sequence("a", "b")).alias("mes_idx"))
    grid = months.crossJoin(m.branches.select("id_filial"))
    return grid.withColumn("anio_mes", X.index_to_month("mes_idx")).join(b, ["id_filial", "anio_mes"], "left")


CTES["dense_bm"] = (["sellin", "fv", "dim_filial"], """SELECT g.id_filial, g.mes_idx,
    CAST(floor(g.mes_idx / 12) * 100 + g.mes_idx % 12 + 1 AS INT) AS anio_mes, b.neto_c, b.dias_con_venta
    FROM (SELECT f.id_filial, m.mes_idx FROM (SELECT unnest(generate_series(min(mes_idx), max(mes_idx))) AS mes_idx
      FROM sellin) m CROSS JOIN dim_filial f) g
    LEFT JOIN (SELECT id_filial, anio_mes, CAST(sum(importe_usd_c * signo) AS BIGINT) AS neto_c,
      CAST(count(DISTINCT fecha) AS BIGINT) AS dias_con_venta FROM fv GROUP BY 1, 2) b
    ON b.id_filial = g.id_filial AND b.anio_mes = CAST(floor(g.mes_idx / 12) * 100 + g.mes_idx % 12 + 1 AS INT)""")


@query("w15_w16_mat_and_moving_average", sql(
    """SELECT id_filial, anio_mes, CAST(sum(neto_c) OVER w12 AS BIGINT) AS mat_c,
       avg(neto_c) OVER w3 AS ma3_mensual,
       CAST(sum(neto_c) OVER w3 AS DOUBLE) / nullif(CAST(sum(dias_con_venta) OVER w3 AS DOUBLE), 0) AS ma3_diaria
       FROM dense_bm WINDOW w12 AS (PARTITION BY id_filial ORDER BY mes_idx RANGE BETWEEN 11 PRECEDING AND CURRENT ROW),
       w3 AS (PARTITION BY id_filial ORDER BY mes_idx RANGE BETWEEN 2 PRECEDING AND CURRENT ROW)""", "dense_bm"))
def w15(spark, sf_dir):
    d = dense_branch_months(model(spark, sf_dir))
    w12 = Window.partitionBy("id_filial").orderBy("mes_idx").rangeBetween(-11, 0)
    w3 = Window.partitionBy("id_filial").orderBy("mes_idx").rangeBetween(-2, 0)
    return d.select("id_filial", "anio_mes", F.sum("neto_c").over(w12).cast("bigint").alias("mat_c"),
                    F.avg("neto_c").over(w3).alias("ma3_mensual"),
                    X.safe_div(F.sum("neto_c").over(w3), F.sum("dias_con_venta").over(w3)).alias("ma3_diaria"))


@query("w17_pareto_cumulative_with_ties", sql(
    """SELECT id_producto, v, CAST(sum(v) OVER (ORDER BY v DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
       AS DOUBLE) / CAST(sum(v) OVER () AS DOUBLE) AS acumulado_pct,
       CAST(CAST(sum(v) OVER (ORDER BY v DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE)
       / CAST(sum(v) OVER () AS DOUBLE) <= 0.8 AS INT) AS dentro_80
       FROM (SELECT id_producto, CAST(sum(importe_usd_c * signo) AS BIGINT) AS v FROM fv GROUP BY 1) t""", "fv"))
def w17(spark, sf_dir):
    fv = model(spark, sf_dir).fact_ventas.withColumn("neto_c", F.col("importe_usd_c") * F.col("signo"))
    return W.pareto(fv, "id_producto", "neto_c").select("id_producto", F.col("v").cast("bigint").alias("v"),
                                                        "acumulado_pct", "dentro_80")


@query("w18_share_of_total_and_parent", sql(
    """SELECT region, pais, neto_c, CAST(neto_c AS DOUBLE) / CAST(sum(neto_c) OVER () AS DOUBLE) AS pct_total,
       CAST(neto_c AS DOUBLE) / CAST(sum(neto_c) OVER (PARTITION BY region) AS DOUBLE) AS pct_padre
       FROM (SELECT region, pais, CAST(sum(importe_usd_c * signo) AS BIGINT) AS neto_c FROM fv
       JOIN dim_filial USING (id_filial) GROUP BY 1, 2) t""", "fv", "dim_filial"))
def w18(spark, sf_dir):
    m = model(spark, sf_dir)
    g = (m.fact_ventas.join(m.branches.select("id_filial", "region", "pais"), "id_filial")
         .groupBy("region", "pais").agg(F.sum(F.col("importe_usd_c") * F.col("signo")).cast("bigint").alias("neto_c")))
    reg = g.groupBy("region").agg(F.sum("neto_c").alias("_r"))
    tot = g.agg(F.sum("neto_c").alias("_t"))
    return (g.join(reg, "region").crossJoin(tot)
            .select("region", "pais", "neto_c", X.safe_div("neto_c", "_t").alias("pct_total"),
                    X.safe_div("neto_c", "_r").alias("pct_padre")))


@query("w19_contribution_ignoring_one_dimension", sql(
    """SELECT id_motivo, id_filial, d, CAST(d AS DOUBLE) / nullif(CAST(sum(d) OVER (PARTITION BY id_filial) AS DOUBLE), 0)
       AS contribucion FROM (SELECT id_motivo, id_filial, CAST(sum(importe_devuelto_usd_c) AS BIGINT) AS d
       FROM fdev GROUP BY 1, 2) t""", "fdev"))
def w19(spark, sf_dir):
    d = model(spark, sf_dir).fact_devoluciones
    g = d.groupBy("id_motivo", "id_filial").agg(F.sum("importe_devuelto_usd_c").cast("bigint").alias("d"))
    tot = g.groupBy("id_filial").agg(F.sum("d").alias("_t"))
    return g.join(tot, "id_filial").select("id_motivo", "id_filial", "d", X.safe_div("d", "_t").alias("contribucion"))
