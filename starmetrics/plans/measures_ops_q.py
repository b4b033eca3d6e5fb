"""Registered measure queries: offers (Of-1 … Of-22) and logistics (Lo-1 … Lo-38)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from starmetrics import config as K
from starmetrics.functions import exprs as X
from starmetrics.functions import text as T
from starmetrics.operators import measures as M
from starmetrics.operators.star import model
from starmetrics.plans.catalog import query
from starmetrics.plans.oracle import CTES, sql
from starmetrics.plans.windows_q import risk_bands

def NET():
    return F.sum(F.col("importe_usd_c") * F.col("signo"))

# Labels of the offer and logistics measures.
ROI_NOTE = ("ROI comparativo, no causal: incluye ventas que podrían haber ocurrido sin oferta. "
            "Para medir impacto incremental hace falta un grupo de control.")
ROI_LIGHT = ("🟢 Alto", "🟡 Aceptable", "🔴 La oferta no se paga")
OTIF_LIGHT = ("🟢 En objetivo", "🟡 Por debajo del objetivo", "🔴 Nivel de servicio crítico")
COVERAGE = ("🔴 Riesgo de quiebre", "🟢 En rango", "🟡 Sobrestock — candidato a oferta", "🔴 Sobrestock severo")
COLD_OK = "🟢 Todo el producto de frío viaja con control de temperatura"


# ---------------- Of-1 … Of-19 by offer type ----------------
CTES["of_type"] = (["ofertas", "dim_producto", "dim_cliente", "dim_tipo_oferta"], """SELECT t.cod_tipo_oferta,
    t.costo_relativo, CAST(count(*) AS BIGINT) AS emitidas, CAST(sum(o.aceptada) AS BIGINT) AS aceptadas,
    CAST(sum(o.unidades_ofertadas * p.precio_lista_c) AS BIGINT) AS valor_c,
    CAST(sum(CASE WHEN o.aceptada = 1 THEN o.unidades_ofertadas * p.precio_lista_c ELSE 0 END) AS BIGINT) AS valor_acept_c,
    CAST(sum(CASE WHEN o.aceptada = 1 THEN o.unidades_ofertadas * p.precio_lista_c * o.descuento_pct_int ELSE 0 END)
      AS BIGINT) AS inv_cpct,
    CAST(sum(CASE WHEN o.aceptada = 1 AND c.segmento = 'A' THEN o.unidades_ofertadas * p.precio_lista_c
      * o.descuento_pct_int ELSE 0 END) AS BIGINT) AS inv_a_cpct
    FROM ofertas o JOIN dim_producto p USING (id_producto) LEFT JOIN dim_cliente c USING (id_cliente)
    JOIN dim_tipo_oferta t ON t.id_tipo_oferta = o.id_tipo_oferta GROUP BY 1, 2""")
CTES["sales_type"] = (["fv"], """SELECT tipo_oferta AS cod_tipo_oferta, CAST(sum(importe_usd_c * signo) AS BIGINT) AS neto_c,
    CAST(sum((importe_usd_c - costo_usd_c) * signo) AS BIGINT) AS margen_c FROM fv GROUP BY 1""")

_INV = "(CAST(inv_cpct AS DOUBLE) / 100.0)"
_ADJ = f"({_INV} * costo_relativo)"
_MCO = "(CASE WHEN cod_tipo_oferta <> 'SIN' THEN margen_c END)"


@query("of01_19_offer_measures_by_type", sql(
    f"""SELECT cod_tipo_oferta, emitidas, aceptadas, CAST(aceptadas AS DOUBLE) / nullif(CAST(emitidas AS DOUBLE), 0) AS tasa_aceptacion,
       CAST(valor_acept_c AS DOUBLE) / nullif(CAST(valor_c AS DOUBLE), 0) AS tasa_aceptacion_valor, valor_c,
       {_INV} AS inversion_c, {_ADJ} AS inversion_ajustada_c,
       {_INV} / nullif(CAST(valor_c AS DOUBLE), 0) AS descuento_medio_ponderado,
       {_INV} / nullif(CAST(neto_c AS DOUBLE), 0) AS inversion_sobre_ventas,
       CASE WHEN cod_tipo_oferta <> 'SIN' THEN neto_c END AS ventas_con_oferta_c,
       CASE WHEN cod_tipo_oferta = 'SIN' THEN neto_c END AS ventas_sin_oferta_c,
       {_MCO} AS margen_con_oferta_c,
       (CAST({_MCO} AS DOUBLE) - {_ADJ}) / nullif({_ADJ}, 0) AS roi,
       '{ROI_NOTE}' AS nota_roi,
       CASE WHEN (CAST({_MCO} AS DOUBLE) - {_ADJ}) / nullif({_ADJ}, 0) >= 3 THEN '{ROI_LIGHT[0]}'
         WHEN (CAST({_MCO} AS DOUBLE) - {_ADJ}) / nullif({_ADJ}, 0) >= 1 THEN '{ROI_LIGHT[1]}'
         WHEN (CAST({_MCO} AS DOUBLE) - {_ADJ}) / nullif({_ADJ}, 0) IS NOT NULL THEN '{ROI_LIGHT[2]}' END AS semaforo_roi,
       CAST({_MCO} AS DOUBLE) / nullif({_ADJ}, 0) AS margen_por_usd,
       CASE WHEN CAST({_MCO} AS DOUBLE) / nullif({_ADJ}, 0) IS NOT NULL THEN CAST(dense_rank() OVER
         (ORDER BY CAST({_MCO} AS DOUBLE) / nullif({_ADJ}, 0) DESC NULLS LAST) AS INT) END AS ranking_eficiencia,
       CAST(inv_a_cpct AS DOUBLE) / nullif(CAST(inv_cpct AS DOUBLE), 0) AS inversion_clientes_a
       FROM of_type LEFT JOIN sales_type USING (cod_tipo_oferta)""", "of_type", "sales_type"))
def of01(spark, sf_dir):
    m = model(spark, sf_dir)
    o = (m.fact_ofertas.join(m.products.select("id_producto", "precio_lista_c"), "id_producto")
         .join(m.customers.select("id_cliente", "segmento"), "id_cliente", "left")
         .join(m.offer_types.select("id_tipo_oferta", "cod_tipo_oferta", "costo_relativo"), "id_tipo_oferta"))
    val = F.col("unidades_ofertadas") * F.col("precio_lista_c")
    acc = F.col("aceptada") == 1
    g = o.groupBy("cod_tipo_oferta", "costo_relativo").agg(
        F.count(F.lit(1)).alias("emitidas"), F.sum("aceptada").cast("bigint").alias("aceptadas"),
        F.sum(val).cast("bigint").alias("valor_c"),
        F.sum(F.when(acc, val).otherwise(0)).cast("bigint").alias("valor_acept_c"),
        F.sum(F.when(acc, val * F.col("descuento_pct_int")).otherwise(0)).cast("bigint").alias("inv_cpct"),
        F.sum(F.when(acc & (F.col("segmento") == "A"), val * F.col("descuento_pct_int")).otherwise(0))
        .cast("bigint").alias("inv_a_cpct"))
    s = m.fact_ventas.groupBy(F.col("tipo_oferta").alias("cod_tipo_oferta")).agg(
        NET().cast("bigint").alias("neto_c"),
        F.sum((F.col("importe_usd_c") - F.col("costo_usd_c")) * F.col("signo")).cast("bigint").alias("margen_c"))
    d = g.join(s, "cod_tipo_oferta", "left")
    inv = F.col("inv_cpct").cast("double") / 100.0
    adj = inv * F.col("costo_relativo")
    mco = F.when(F.col("cod_tipo_oferta") != "SIN", F.col("margen_c"))
    roi = X.safe_div(mco.cast("double") - adj, adj)
    eff = X.safe_div(mco, adj)
    # six offer types: the ranking window runs over six rows
    rank = F.when(eff.isNotNull(), F.dense_rank().over(Window.orderBy(eff.desc_nulls_last())).cast("int"))
    return d.select(
        "cod_tipo_oferta", "emitidas", "aceptadas", X.safe_div("aceptadas", "emitidas").alias("tasa_aceptacion"),
        X.safe_div("valor_acept_c", "valor_c").alias("tasa_aceptacion_valor"), "valor_c",
        inv.alias("inversion_c"), adj.alias("inversion_ajustada_c"),
        X.safe_div(inv, F.col("valor_c")).alias("descuento_medio_ponderado"),
        X.safe_div(inv, F.col("neto_c")).alias("inversion_sobre_ventas"),
        F.when(F.col("cod_tipo_oferta") != "SIN", F.col("neto_c")).alias("ventas_con_oferta_c"),
        F.when(F.col("cod_tipo_oferta") == "SIN", F.col("neto_c")).alias("ventas_sin_oferta_c"),
        mco.alias("margen_con_oferta_c"), roi.alias("roi"), F.lit(ROI_NOTE).alias("nota_roi"),
        F.when(roi >= 3, ROI_LIGHT[0]).when(roi >= 1, ROI_LIGHT[1]).when(roi.isNotNull(), ROI_LIGHT[2])
        .alias("semaforo_roi"),
        eff.alias("margen_por_usd"), rank.alias("ranking_eficiencia"),
        X.safe_div("inv_a_cpct", "inv_cpct").alias("inversion_clientes_a"))


@query("of12_share_of_sales_with_offer", sql(
    """SELECT id_filial, CAST(sum(CASE WHEN tipo_oferta <> 'SIN' THEN importe_usd_c * signo ELSE 0 END) AS BIGINT)
       AS con_oferta_c, CAST(sum(importe_usd_c * signo) AS BIGINT) AS neto_c,
       CAST(sum(CASE WHEN tipo_oferta <> 'SIN' THEN importe_usd_c * signo ELSE 0 END) AS DOUBLE)
       / nullif(CAST(sum(importe_usd_c * signo) AS DOUBLE), 0) AS pct_con_oferta FROM fv GROUP BY 1""", "fv"))
def of12(spark, sf_dir):
    fv = model(spark, sf_dir).fact_ventas
    g = fv.groupBy("id_filial").agg(
        F.sum(F.when(F.col("tipo_oferta") != "SIN", F.col("importe_usd_c") * F.col("signo")).otherwise(0))
        .cast("bigint").alias("con_oferta_c"), NET().cast("bigint").alias("neto_c"))
    return g.withColumn("pct_con_oferta", X.safe_div("con_oferta_c", "neto_c"))


# ---------------- Of-20 … Of-22: investment vs its forecast (naive lag-1 forecast, M-19) ----------------
def investment_series(m):
    o = m.fact_ofertas.join(m.keyed("products", "id_producto", "precio_lista_c"), "id_producto")
    g = o.groupBy("id_filial", "anio_mes").agg(F.sum(F.when(F.col("aceptada") == 1, F.col("unidades_ofertadas")
                                                            * F.col("precio_lista_c") * F.col("descuento_pct_int"))
                                                     .otherwise(0)).cast("bigint").alias("real_cpct"))
    w = Window.partitionBy("id_filial").orderBy("anio_mes")
    return g.withColumn("forecast_cpct", F.lag("real_cpct", 1).over(w))


CTES["inv_series"] = (["ofertas", "dim_producto"], """SELECT id_filial, anio_mes, real_cpct,
    lag(real_cpct, 1) OVER (PARTITION BY id_filial ORDER BY anio_mes) AS forecast_cpct FROM
    (SELECT o.id_filial, o.anio_mes, CAST(sum(CASE WHEN o.aceptada = 1 THEN o.unidades_ofertadas * p.precio_lista_c
       * o.descuento_pct_int ELSE 0 END) AS BIGINT) AS real_cpct FROM ofertas o JOIN dim_producto p USING (id_producto)
     GROUP BY 1, 2) g""")


@query("of20_22_investment_forecast_measures", sql(
    f"""SELECT anio_mes, CAST(sum(real_cpct) AS BIGINT) AS real_cpct, CAST(sum(forecast_cpct) AS BIGINT) AS forecast_cpct,
       CAST(sum(real_cpct) - sum(forecast_cpct) AS DOUBLE) / nullif(CAST(sum(forecast_cpct) AS DOUBLE), 0) AS desvio,
       CASE WHEN anio_mes > {K.CUT_VALID} THEN 1.0 - CAST(sum(abs(real_cpct - forecast_cpct)) AS DOUBLE)
         / nullif(CAST(sum(real_cpct) AS DOUBLE), 0) END AS precision_forecast
       FROM inv_series GROUP BY 1""", "inv_series"))
def of20(spark, sf_dir):
    s = investment_series(model(spark, sf_dir))
    g = s.groupBy("anio_mes").agg(F.sum("real_cpct").cast("bigint").alias("real_cpct"),
                                  F.sum("forecast_cpct").cast("bigint").alias("forecast_cpct"),
                                  F.sum(F.abs(F.col("real_cpct") - F.col("forecast_cpct"))).alias("_ae"))
    return g.select("anio_mes", "real_cpct", "forecast_cpct",
                    X.safe_div(F.col("real_cpct") - F.col("forecast_cpct"), F.col("forecast_cpct")).alias("desvio"),
                    F.when(F.col("anio_mes") > K.CUT_VALID, F.lit(1.0) - X.safe_div("_ae", "real_cpct"))
                    .alias("precision_forecast"))


# ---------------- Lo-1 … Lo-10: service level ----------------
_OTIF = "CAST(lineas_otif AS DOUBLE) / nullif(CAST(lineas AS DOUBLE), 0)"


@query("lo01_10_service_level", sql(
    f"""SELECT id_filial, anio, lineas, {_OTIF} AS otif_pct,
       CAST(lineas_completas AS DOUBLE) / nullif(CAST(lineas AS DOUBLE), 0) AS fill_rate,
       CAST(lineas_otif AS DOUBLE) / nullif(CAST(lineas_completas AS DOUBLE), 0) AS entregas_a_tiempo,
       CAST(lt AS DOUBLE) / nullif(CAST(lineas AS DOUBLE), 0) AS lead_time_promedio, sla AS sla_objetivo,
       CAST(lt AS DOUBLE) / nullif(CAST(lineas AS DOUBLE), 0) - sla AS exceso_sla, otif_aa,
       ({_OTIF} - otif_aa) * 100 AS var_otif_pp,
       CASE WHEN {_OTIF} >= 0.95 THEN '{OTIF_LIGHT[0]}' WHEN {_OTIF} >= 0.88 THEN '{OTIF_LIGHT[1]}'
         ELSE '{OTIF_LIGHT[2]}' END AS semaforo_otif FROM
       (SELECT id_filial, CAST(anio_mes // 100 AS INT) AS anio, CAST(sum(lineas) AS BIGINT) AS lineas,
         CAST(sum(lineas_otif) AS BIGINT) AS lineas_otif, CAST(sum(lineas_completas) AS BIGINT) AS lineas_completas,
         CAST(sum(lead_time_dias_x_linea) AS BIGINT) AS lt FROM fv GROUP BY 1, 2) a
       JOIN (SELECT id_filial, CAST(sla_entrega_dias AS DOUBLE) AS sla FROM dim_filial) f USING (id_filial)
       LEFT JOIN (SELECT id_filial, CAST(anio_mes // 100 AS INT) + 1 AS anio,
         CAST(sum(lineas_otif) AS DOUBLE) / nullif(CAST(sum(lineas) AS DOUBLE), 0) AS otif_aa FROM fv GROUP BY 1, 2) p
       USING (id_filial, anio)""", "fv", "dim_filial"))
def lo01(spark, sf_dir):
    m = model(spark, sf_dir)
    fv = m.fact_ventas.withColumn("anio", F.floor(F.col("anio_mes") / 100).cast("int"))
    a = fv.groupBy("id_filial", "anio").agg(*[F.sum(c).cast("bigint").alias(n) for c, n in [
        ("lineas", "lineas"), ("lineas_otif", "lineas_otif"), ("lineas_completas", "lineas_completas"),
        ("lead_time_dias_x_linea", "lt")]])
    p = a.select("id_filial", (F.col("anio") + 1).alias("anio"), X.safe_div("lineas_otif", "lineas").alias("otif_aa"))
    sla = m.branches.select("id_filial", F.col("sla_entrega_dias").cast("double").alias("sla"))
    d = a.join(sla, "id_filial").join(p, ["id_filial", "anio"], "left")
    otif = X.safe_div("lineas_otif", "lineas")
    lt = X.safe_div("lt", "lineas")
    return d.select("id_filial", "anio", "lineas", otif.alias("otif_pct"),
                    X.safe_div("lineas_completas", "lineas").alias("fill_rate"),
                    X.safe_div("lineas_otif", "lineas_completas").alias("entregas_a_tiempo"),
                    lt.alias("lead_time_promedio"), F.col("sla").alias("sla_objetivo"),
                    (lt - F.col("sla")).alias("exceso_sla"), "otif_aa", ((otif - F.col("otif_aa")) * 100).alias("var_otif_pp"),
                    F.when(otif >= 0.95, OTIF_LIGHT[0]).when(otif >= 0.88, OTIF_LIGHT[1]).otherwise(OTIF_LIGHT[2])
                    .alias("semaforo_otif"))


# ---------------- Lo-11 … Lo-20: returns ----------------
_TV = "CAST(d.dev_c AS DOUBLE) / nullif(CAST(s.bruto_c AS DOUBLE), 0)"


@query("lo11_20_returns_measures", sql(
    f"""SELECT id_filial, anio, d.dev_u AS unidades_devueltas, d.dev_c AS importe_devuelto_c, {_TV} AS tasa_dev_valor,
       CAST(d.dev_u AS DOUBLE) / nullif(CAST(s.fc_u AS DOUBLE), 0) AS tasa_dev_unidades, p.tasa_aa AS tasa_dev_valor_aa,
       ({_TV} - p.tasa_aa) * 100 AS var_tasa_pp, d.evit_c AS evitables_c,
       CAST(d.evit_c AS DOUBLE) / nullif(CAST(d.dev_c AS DOUBLE), 0) AS pct_evitables,
       CAST(d.dev_c AS DOUBLE) * (CAST(s.margen_c AS DOUBLE) / nullif(CAST(s.neto_c AS DOUBLE), 0)) AS margen_perdido_c,
       t.motivo || ' (' || {T.sql_pct0('CAST(t.dmax AS DOUBLE) / nullif(CAST(d.dev_c AS DOUBLE), 0)')} || ' del total)'
         AS motivo_principal
       FROM (SELECT r.id_filial, CAST(year(r.fecha) AS INT) AS anio, CAST(sum(r.unidades_devueltas) AS BIGINT) AS dev_u,
           CAST(sum(r.importe_devuelto_usd_c) AS BIGINT) AS dev_c,
           CAST(sum(CASE WHEN m.es_evitable = 1 THEN r.importe_devuelto_usd_c ELSE 0 END) AS BIGINT) AS evit_c
         FROM fdev r JOIN dim_motivo m USING (id_motivo) GROUP BY 1, 2) d
       FULL JOIN (SELECT id_filial, CAST(anio_mes // 100 AS INT) AS anio,
           CAST(sum(CASE WHEN tipo_documento = 'FC' THEN importe_usd_c ELSE 0 END) AS BIGINT) AS bruto_c,
           CAST(sum(CASE WHEN tipo_documento = 'FC' THEN unidades ELSE 0 END) AS BIGINT) AS fc_u,
           CAST(sum(importe_usd_c * signo) AS BIGINT) AS neto_c,
           CAST(sum((importe_usd_c - costo_usd_c) * signo) AS BIGINT) AS margen_c FROM fv GROUP BY 1, 2) s
         USING (id_filial, anio)
       LEFT JOIN (SELECT d2.id_filial, d2.anio + 1 AS anio, CAST(d2.dev_c AS DOUBLE) / nullif(CAST(s2.bruto_c AS DOUBLE), 0)
           AS tasa_aa FROM (SELECT id_filial, CAST(year(fecha) AS INT) AS anio, sum(importe_devuelto_usd_c) AS dev_c
           FROM fdev GROUP BY 1, 2) d2 JOIN (SELECT id_filial, CAST(anio_mes // 100 AS INT) AS anio,
           sum(CASE WHEN tipo_documento = 'FC' THEN importe_usd_c ELSE 0 END) AS bruto_c FROM fv GROUP BY 1, 2) s2
           USING (id_filial, anio)) p USING (id_filial, anio)
       LEFT JOIN (SELECT id_filial, anio, motivo, dmax FROM (SELECT r.id_filial, CAST(year(r.fecha) AS INT) AS anio,
           m.motivo, sum(r.importe_devuelto_usd_c) AS dmax, row_number() OVER (PARTITION BY r.id_filial,
           CAST(year(r.fecha) AS INT) ORDER BY sum(r.importe_devuelto_usd_c) DESC, min(r.id_motivo)) AS rn
           FROM fdev r JOIN dim_motivo m USING (id_motivo) GROUP BY 1, 2, 3) z WHERE rn = 1) t USING (id_filial, anio)""",
    "fdev", "fv", "dim_motivo"))
def lo11(spark, sf_dir):
    m = model(spark, sf_dir)
    r = m.fact_devoluciones.join(m.reasons.select("id_motivo", "motivo", "es_evitable"), "id_motivo") \
        .withColumn("anio", F.year("fecha"))
    d = r.groupBy("id_filial", "anio").agg(
        F.sum("unidades_devueltas").cast("bigint").alias("dev_u"),
        F.sum("importe_devuelto_usd_c").cast("bigint").alias("dev_c"),
        F.sum(F.when(F.col("es_evitable") == 1, F.col("importe_devuelto_usd_c")).otherwise(0)).cast("bigint")
        .alias("evit_c"))
    top = (r.groupBy("id_filial", "anio", "id_motivo", "motivo").agg(F.sum("importe_devuelto_usd_c").alias("dm"))
           .groupBy("id_filial", "anio").agg(F.max_by("motivo", F.struct(F.col("dm"), -F.col("id_motivo")))
                                             .alias("motivo"), F.max("dm").alias("dmax")))
    fv = m.fact_ventas.withColumn("anio", F.floor(F.col("anio_mes") / 100).cast("int"))
    fc = F.col("tipo_documento") == "FC"
    s = fv.groupBy("id_filial", "anio").agg(
        F.sum(F.when(fc, F.col("importe_usd_c")).otherwise(0)).cast("bigint").alias("bruto_c"),
        F.sum(F.when(fc, F.col("unidades")).otherwise(0)).cast("bigint").alias("fc_u"),
        NET().cast("bigint").alias("neto_c"),
        F.sum((F.col("importe_usd_c") - F.col("costo_usd_c")) * F.col("signo")).cast("bigint").alias("margen_c"))
    j = M.drill_across([d, s], ["id_filial", "anio"])
    tv = X.safe_div("dev_c", "bruto_c")
    prev = j.select("id_filial", (F.col("anio") + 1).alias("anio"), tv.alias("tasa_aa"))
    j = j.join(prev, ["id_filial", "anio"], "left").join(top, ["id_filial", "anio"], "left")
    return j.select(
        "id_filial", "anio", F.col("dev_u").alias("unidades_devueltas"), F.col("dev_c").alias("importe_devuelto_c"),
        tv.alias("tasa_dev_valor"), X.safe_div("dev_u", "fc_u").alias("tasa_dev_unidades"),
        F.col("tasa_aa").alias("tasa_dev_valor_aa"), ((tv - F.col("tasa_aa")) * 100).alias("var_tasa_pp"),
        F.col("evit_c").alias("evitables_c"), X.safe_div("evit_c", "dev_c").alias("pct_evitables"),
        (F.col("dev_c").cast("double") * X.safe_div("margen_c", "neto_c")).alias("margen_perdido_c"),
        F.concat("motivo", F.lit(" ("), T.pct0(X.safe_div("dmax", "dev_c")), F.lit(" del total)"))
        .alias("motivo_principal"))


# ---------------- Lo-21 … Lo-27: stock ----------------
_COV = "CAST(cxs AS DOUBLE) / nullif(CAST(stock_u AS DOUBLE), 0)"


@query("lo21_27_stock_measures", sql(
    f"""SELECT id_deposito, stock_u, valor_c, {_COV} AS dias_cobertura,
       CASE WHEN {_COV} < 30 THEN '{COVERAGE[0]}' WHEN {_COV} <= 90 THEN '{COVERAGE[1]}'
         WHEN {_COV} <= 150 THEN '{COVERAGE[2]}' WHEN {_COV} IS NOT NULL THEN '{COVERAGE[3]}' END AS estado_cobertura,
       por_vencer_u, riesgo_venc_c, CAST(por_vencer_u AS DOUBLE) / nullif(CAST(stock_u AS DOUBLE), 0) AS pct_por_vencer
       FROM (SELECT s.id_deposito, CAST(sum(s.stock_unidades) AS BIGINT) AS stock_u, CAST(sum(s.valor_stock_c) AS BIGINT)
         AS valor_c, CAST(sum(s.dias_cobertura * s.stock_unidades) AS BIGINT) AS cxs,
         CAST(sum(s.unidades_por_vencer_180d) AS BIGINT) AS por_vencer_u,
         CAST(sum(s.unidades_por_vencer_180d * p.costo_std_c) AS BIGINT) AS riesgo_venc_c
         FROM stock s JOIN dim_producto p USING (id_producto)
         WHERE s.anio_mes = (SELECT max(anio_mes) FROM stock) GROUP BY 1) t""", "stock", "dim_producto"))
def lo21(spark, sf_dir):
    m = model(spark, sf_dir)
    s = M.last_snapshot(m.fact_stock).join(m.products.select("id_producto", "costo_std_c"), "id_producto")
    g = s.groupBy("id_deposito").agg(
        F.sum("stock_unidades").cast("bigint").alias("stock_u"), F.sum("valor_stock_c").cast("bigint").alias("valor_c"),
        F.sum(F.col("dias_cobertura") * F.col("stock_unidades")).cast("bigint").alias("cxs"),
        F.sum("unidades_por_vencer_180d").cast("bigint").alias("por_vencer_u"),
        F.sum(F.col("unidades_por_vencer_180d") * F.col("costo_std_c")).cast("bigint").alias("riesgo_venc_c"))
    cov = X.safe_div("cxs", "stock_u")
    return g.select("id_deposito", "stock_u", "valor_c", cov.alias("dias_cobertura"),
                    F.when(cov < 30, COVERAGE[0]).when(cov <= 90, COVERAGE[1]).when(cov <= 150, COVERAGE[2])
                    .when(cov.isNotNull(), COVERAGE[3]).alias("estado_cobertura"),
                    "por_vencer_u", "riesgo_venc_c", X.safe_div("por_vencer_u", "stock_u").alias("pct_por_vencer"))


# ---------------- Lo-28 … Lo-32: risk scoring measures ----------------
@query("lo28_32_risk_scoring_measures", sql(
    f"""SELECT b.id_filial, round(sum(b.prob * CAST(b.importe_usd_c AS DOUBLE)), 2) AS importe_en_riesgo_c,
       CAST(count(*) FILTER (WHERE b.banda_riesgo = 'Crítico') AS BIGINT) AS pedidos_criticos,
       round(avg(b.prob), 12) AS prob_media,
       CAST(sum(CASE WHEN b.prob >= c.corte THEN b.devuelta ELSE 0 END) AS DOUBLE) / nullif(CAST(sum(b.devuelta) AS DOUBLE), 0)
         AS captura_top10,
       'Revisando el 10% de pedidos con mayor riesgo se anticipan el ' ||
       {T.sql_pct0('CAST(sum(CASE WHEN b.prob >= c.corte THEN b.devuelta ELSE 0 END) AS DOUBLE) / nullif(CAST(sum(b.devuelta) AS DOUBLE), 0)')}
       || ' de las devoluciones. Exposición estimada del período: USD ' ||
       {T.sql_thousands('round(sum(b.prob * CAST(b.importe_usd_c AS DOUBLE)) / 100.0)')} || '.' AS lectura
       FROM risk_bands b JOIN (SELECT id_filial, quantile_cont(prob, 0.9) AS corte FROM risk_bands GROUP BY 1) c
       USING (id_filial) GROUP BY 1""", "risk_bands"))
def lo28(spark, sf_dir):
    b = risk_bands(model(spark, sf_dir))
    # equal scores are counted first: the exact percentile sees distinct scores only
    h = b.groupBy("id_filial", "prob").agg(F.count(F.lit(1)).alias("n"))
    cut = h.groupBy("id_filial").agg(F.percentile("prob", 0.9, F.col("n")).alias("corte"))
    j = b.join(cut, "id_filial")
    g = j.groupBy("id_filial").agg(
        F.sum(F.col("prob") * F.col("importe_usd_c").cast("double")).alias("_r"),
        F.count_if(F.col("banda_riesgo") == "Crítico").alias("pedidos_criticos"),
        F.round(F.avg("prob"), 12).alias("prob_media"),
        F.sum(F.when(F.col("prob") >= F.col("corte"), F.col("devuelta")).otherwise(0)).alias("_top"),
        F.sum("devuelta").alias("_dev"))
    cap = X.safe_div("_top", "_dev")
    return g.select("id_filial", F.round("_r", 2).alias("importe_en_riesgo_c"), "pedidos_criticos", "prob_media",
                    cap.alias("captura_top10"),
                    F.concat(F.lit("Revisando el 10% de pedidos con mayor riesgo se anticipan el "), T.pct0(cap),
                             F.lit(" de las devoluciones. Exposición estimada del período: USD "),
                             T.thousands(F.round(F.col("_r") / 100.0)), F.lit(".")).alias("lectura"))


# ---------------- Lo-33 … Lo-35: projected returns (naive lag-1 rate forecast) ----------------
@query("lo33_35_projected_returns", sql(
    """SELECT id_filial, anio_mes, tasa_proyectada, round(tasa_proyectada * CAST(importe_c AS DOUBLE), 2) AS devuelto_proyectado_c,
       round(tasa_proyectada * CAST(importe_c AS DOUBLE), 2) AS provision_sugerida_c FROM
       (SELECT id_filial, anio_mes, importe_c, lag(tasa_dev_valor, 1) OVER (PARTITION BY id_filial ORDER BY anio_mes)
        AS tasa_proyectada FROM branch_month) t""", "branch_month"))
def lo33(spark, sf_dir):
    from starmetrics.plans.windows_q import branch_month
    b = branch_month(model(spark, sf_dir))
    b = b.withColumn("tasa_proyectada", F.lag("tasa_dev_valor", 1).over(Window.partitionBy("id_filial").orderBy("anio_mes")))
    proj = F.round(F.col("tasa_proyectada") * F.col("importe_c").cast("double"), 2)
    return b.select("id_filial", "anio_mes", "tasa_proyectada", proj.alias("devuelto_proyectado_c"),
                    proj.alias("provision_sugerida_c"))


# ---------------- Lo-37, Lo-38: cold chain without control ----------------
@query("lo37_38_cold_chain_exposure", sql(
    f"""SELECT id_filial, expuesto_c, CASE WHEN expuesto_c > 0 THEN '🔴 USD ' || {T.sql_thousands('round(expuesto_c / 100.0)')}
       || ' despachados en cadena de frío por operadores sin control de temperatura' ELSE '{COLD_OK}' END AS alerta_frio
       FROM (SELECT fv.id_filial, CAST(sum(CASE WHEN p.cadena_frio = 1 AND t.control_frio = 0
         THEN fv.importe_usd_c * fv.signo ELSE 0 END) AS BIGINT) AS expuesto_c
       FROM fv JOIN dim_producto p USING (id_producto) JOIN dim_transportista t USING (id_transportista)
       GROUP BY 1) x""", "fv", "dim_producto", "dim_transportista"))
def lo37(spark, sf_dir):
    m = model(spark, sf_dir)
    d = M.enrich(m, m.fact_ventas, ["cadena_frio", "control_frio"])
    g = d.groupBy("id_filial").agg(F.sum(F.when((F.col("cadena_frio") == 1) & (F.col("control_frio") == 0),
                                                F.col("importe_usd_c") * F.col("signo")).otherwise(0))
                                   .cast("bigint").alias("expuesto_c"))
    return g.select("id_filial", "expuesto_c", F.when(
        F.col("expuesto_c") > 0, F.concat(F.lit("🔴 USD "), T.thousands(F.round(F.col("expuesto_c") / 100.0)),
                                          F.lit(" despachados en cadena de frío por operadores sin control de temperatura")))
        .otherwise(F.lit(COLD_OK)).alias("alerta_frio"))
