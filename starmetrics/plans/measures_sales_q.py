"""Registered measure queries: base (Ba-9 … Ba-23) and sales/variance (Va-1 … Va-27)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from starmetrics.functions import exprs as X
from starmetrics.functions import text as T
from starmetrics.operators import measures as M
from starmetrics.operators import quality as Q
from starmetrics.operators import windows as W
from starmetrics.operators.star import model
from starmetrics.plans.catalog import query
from starmetrics.plans.oracle import CTES, sql

def NET():
    return F.sum(F.col("importe_usd_c") * F.col("signo"))

# Status labels of the measures.
FRESHNESS = ("🟢 Al día", "🟡 Con atraso", "🔴 Fuera de SLA")
TARGET_LIGHT = ("🟢", "🟡", "🔴")
CHANNEL_ALERT = ("🔴 Carga de canal: el sell-in supera la demanda real en más de 25%",
                 "🟡 Sell-in por encima del sell-out — vigilar stock del canal",
                 "🔵 El canal está desabastecido: se vende más de lo que se le entrega",
                 "🟢 Sell-in alineado con la demanda")
BRIDGE_OK = "🟢 El puente cierra"
BRIDGE_BAD = "🔴 Descuadre de "


def _months_global(m):
    rng = m.sellin.agg(F.min("mes_idx").alias("a"), F.max("mes_idx").alias("b"))
    return rng.select(F.explode(F.sequence("a", "b")).alias("mes_idx")) \
        .withColumn("anio_mes", X.index_to_month("mes_idx"))


CTES["months_g"] = (["sellin"], """SELECT i AS mes_idx, CAST(floor(i / 12) * 100 + i % 12 + 1 AS INT) AS anio_mes
    FROM (SELECT unnest(generate_series(min(mes_idx), max(mes_idx))) AS i FROM sellin) t""")


# ---------------- Ba-9 … Ba-19: time intelligence over a dense month axis ----------------
@query("ba09_19_time_intelligence", sql(
    f"""SELECT anio_mes, neto_c, neto_aa_c, CAST(neto_c - neto_aa_c AS DOUBLE) / nullif(CAST(neto_aa_c AS DOUBLE), 0)
       AS var_pct, neto_c - neto_aa_c AS var_c, ytd_c, mat_c, mat_aa_c,
       CAST(mat_c - mat_aa_c AS DOUBLE) / nullif(CAST(mat_aa_c AS DOUBLE), 0) AS mat_var_pct, ma3_c,
       CAST(ultimo AS VARCHAR) AS ultimo_dato, atraso AS dias_atraso,
       CASE WHEN atraso <= 5 THEN '{FRESHNESS[0]}' WHEN atraso <= 10 THEN '{FRESHNESS[1]}' ELSE '{FRESHNESS[2]}' END
       AS estado_vigencia FROM (
         SELECT d.anio_mes, d.neto_c, p.neto_c AS neto_aa_c, d.ytd_c, d.mat_c, p.mat_c AS mat_aa_c, d.ma3_c
         FROM (SELECT mes_idx, anio_mes, neto_c,
             CAST(sum(neto_c) OVER (PARTITION BY anio_mes // 100 ORDER BY mes_idx) AS BIGINT) AS ytd_c,
             CAST(sum(neto_c) OVER (ORDER BY mes_idx RANGE BETWEEN 11 PRECEDING AND CURRENT ROW) AS BIGINT) AS mat_c,
             avg(neto_c) OVER (ORDER BY mes_idx RANGE BETWEEN 2 PRECEDING AND CURRENT ROW) AS ma3_c
           FROM months_g LEFT JOIN (SELECT anio_mes, CAST(sum(importe_usd_c * signo) AS BIGINT) AS neto_c FROM fv
             GROUP BY 1) g USING (anio_mes)) d
         LEFT JOIN (SELECT mes_idx + 12 AS mes_idx, neto_c,
             CAST(sum(neto_c) OVER (ORDER BY mes_idx RANGE BETWEEN 11 PRECEDING AND CURRENT ROW) AS BIGINT) AS mat_c
           FROM months_g LEFT JOIN (SELECT anio_mes, CAST(sum(importe_usd_c * signo) AS BIGINT) AS neto_c FROM fv
             GROUP BY 1) g USING (anio_mes)) p USING (mes_idx)) x
       CROSS JOIN (SELECT max(fecha) AS ultimo, CAST(datediff('day', max(fecha), last_day(max(fecha))) AS INT) AS atraso
         FROM fv) u""", "fv", "months_g"))
def ba09(spark, sf_dir):
    m = model(spark, sf_dir)
    g = m.fact_ventas.groupBy("anio_mes").agg(NET().cast("bigint").alias("neto_c"))
    d = _months_global(m).join(g, "anio_mes", "left")
    # one row per month: these global windows run over a bounded number of rows
    o = Window.orderBy("mes_idx")
    d = (d.withColumn("ytd_c", F.sum("neto_c").over(Window.partitionBy(F.floor(F.col("anio_mes") / 100))
                                                       .orderBy("mes_idx").rowsBetween(Window.unboundedPreceding, 0))
                      .cast("bigint"))
         .withColumn("mat_c", F.sum("neto_c").over(o.rangeBetween(-11, 0)).cast("bigint"))
         .withColumn("ma3_c", F.avg("neto_c").over(o.rangeBetween(-2, 0))))
    prev = d.select((F.col("mes_idx") + 12).alias("mes_idx"), F.col("neto_c").alias("neto_aa_c"),
                    F.col("mat_c").alias("mat_aa_c"))
    d = d.join(prev, "mes_idx", "left")
    last = m.fact_ventas.agg(F.max("fecha").alias("_u"))
    last = last.select(F.col("_u").cast("string").alias("ultimo_dato"),
                       F.datediff(F.last_day("_u"), "_u").alias("dias_atraso"))
    a = F.col("dias_atraso")
    return d.crossJoin(last).select(
        "anio_mes", "neto_c", "neto_aa_c",
        X.safe_div(F.col("neto_c") - F.col("neto_aa_c"), F.col("neto_aa_c")).alias("var_pct"),
        (F.col("neto_c") - F.col("neto_aa_c")).alias("var_c"), "ytd_c", "mat_c", "mat_aa_c",
        X.safe_div(F.col("mat_c") - F.col("mat_aa_c"), F.col("mat_aa_c")).alias("mat_var_pct"), "ma3_c",
        "ultimo_dato", "dias_atraso",
        F.when(a <= 5, FRESHNESS[0]).when(a <= 10, FRESHNESS[1]).otherwise(FRESHNESS[2]).alias("estado_vigencia"))


# ---------------- Ba-20, Ba-22, Ba-23 ----------------
@query("ba20_22_23_review_context_label", sql(
    f"""SELECT region, anio_mes, neto_c, CAST(rev_c AS DOUBLE) / nullif(CAST(neto_c AS DOUBLE), 0) AS en_revision_pct,
       'Ventas de ' || CASE WHEN n_clase = 1 THEN clase ELSE 'todas las clases' END || ' en ' ||
       CASE WHEN n_pais = 1 THEN pais ELSE 'todas las filiales' END || ' · ' || periodo AS titulo,
       {T.sql_usd_label('neto_c')} AS etiqueta FROM (
       SELECT f.region, fv.anio_mes, CAST(sum(fv.importe_usd_c * fv.signo) AS BIGINT) AS neto_c,
       CAST(sum(CASE WHEN fv.lineas_en_revision > 0 THEN fv.importe_usd_c * fv.signo ELSE 0 END) AS BIGINT) AS rev_c,
       count(DISTINCT p.atc1) AS n_clase, max(p.atc1) AS clase, count(DISTINCT f.pais) AS n_pais, max(f.pais) AS pais,
       strftime(min(fv.fecha), '%Y-%m') AS periodo
       FROM fv JOIN dim_filial f USING (id_filial) JOIN dim_producto p USING (id_producto) GROUP BY 1, 2) t""",
    "fv", "dim_filial", "dim_producto"))
def ba20(spark, sf_dir):
    m = model(spark, sf_dir)
    d = M.enrich(m, m.fact_ventas, ["region", "pais", "atc1"])
    g = d.groupBy("region", "anio_mes").agg(
        NET().cast("bigint").alias("neto_c"),
        F.sum(F.when(F.col("lineas_en_revision") > 0, F.col("importe_usd_c") * F.col("signo")).otherwise(F.lit(0)))
        .alias("rev_c"),
        X.selected_value("atc1", "todas las clases").alias("clase"),
        X.selected_value("pais", "todas las filiales").alias("pais"),
        F.date_format(F.min("fecha"), "yyyy-MM").alias("periodo"))
    return g.select("region", "anio_mes", "neto_c", X.safe_div("rev_c", "neto_c").alias("en_revision_pct"),
                    F.concat(F.lit("Ventas de "), "clase", F.lit(" en "), "pais", F.lit(" · "), "periodo")
                    .alias("titulo"), T.usd_label(F.col("neto_c")).alias("etiqueta"))


# ---------------- Ba-21: confidence header from the DQ registry ----------------
def confidence_header(reg):
    s = Q.summary(reg)
    c, a = F.col("controles_criticos"), F.col("controles_alerta")
    return s.select(F.when(c > 0, F.concat(F.lit("🔴 "), c.cast("string"),
                                           F.lit(" control(es) crítico(s) — cifra no publicable")))
                    .when(a > 0, F.concat(F.lit("🟡 "), a.cast("string"),
                                          F.lit(" alerta(s) de calidad — revisar antes de decidir")))
                    .otherwise(F.lit("🟢 Validado contra origen")).alias("encabezado"))


def _header_sql():
    from starmetrics.plans import quality_q as QQ
    return sql("""SELECT CASE WHEN c > 0 THEN '🔴 ' || CAST(c AS VARCHAR) || ' control(es) crítico(s) — cifra no publicable'
       WHEN a > 0 THEN '🟡 ' || CAST(a AS VARCHAR) || ' alerta(s) de calidad — revisar antes de decidir'
       ELSE '🟢 Validado contra origen' END AS encabezado FROM (SELECT count(*) FILTER (WHERE estado = 'CRÍTICO') AS c,
       count(*) FILTER (WHERE estado = 'ALERTA') AS a FROM reg) t""", *QQ._NEEDS, extra=QQ._EXTRA)


@query("ba21_confidence_header", _header_sql())
def ba21(spark, sf_dir):
    return confidence_header(Q.registry(model(spark, sf_dir)))


# ---------------- Va-1 … Va-5: targets (drill-across) ----------------
CTES["workdays"] = (["sellin"], """SELECT CAST(year(d) * 100 + month(d) AS INT) AS anio_mes,
    count(*) FILTER (WHERE isodow(d) <= 5) AS habiles_mes,
    count(*) FILTER (WHERE isodow(d) <= 5 AND d <= u) AS habiles_transcurridos
    FROM (SELECT CAST(unnest(generate_series(make_date(CAST(year(min(fecha)) AS INT), 1, 1),
      make_date(CAST(year(max(fecha)) AS INT), 12, 31), INTERVAL 1 DAY)) AS DATE) AS d, max(fecha) AS u FROM sellin) c
    GROUP BY 1""")


@query("va01_05_targets_drill_across", sql(
    f"""SELECT id_filial, anio_mes, neto_c, objetivo_c, CAST(neto_c AS DOUBLE) / nullif(CAST(objetivo_c AS DOUBLE), 0)
       AS cumplimiento, neto_c - objetivo_c AS gap_c,
       (CAST(neto_c AS DOUBLE) * CAST(habiles_mes AS DOUBLE) / nullif(CAST(habiles_transcurridos AS DOUBLE), 0))
       / nullif(CAST(objetivo_c AS DOUBLE), 0) AS cumplimiento_proyectado,
       CASE WHEN CAST(neto_c AS DOUBLE) / nullif(CAST(objetivo_c AS DOUBLE), 0) >= 1 THEN '{TARGET_LIGHT[0]}'
       WHEN CAST(neto_c AS DOUBLE) / nullif(CAST(objetivo_c AS DOUBLE), 0) >= 0.9 THEN '{TARGET_LIGHT[1]}'
       WHEN CAST(neto_c AS DOUBLE) / nullif(CAST(objetivo_c AS DOUBLE), 0) IS NULL THEN NULL
       ELSE '{TARGET_LIGHT[2]}' END AS semaforo
       FROM (SELECT id_filial, anio_mes, CAST(sum(importe_usd_c * signo) AS BIGINT) AS neto_c FROM fv GROUP BY 1, 2) a
       FULL OUTER JOIN (SELECT id_filial, anio_mes, CAST(sum(objetivo_importe_c) AS BIGINT) AS objetivo_c
         FROM objetivos GROUP BY 1, 2) b USING (id_filial, anio_mes)
       LEFT JOIN workdays w USING (anio_mes)""", "fv", "objetivos", "workdays"))
def va01(spark, sf_dir):
    m = model(spark, sf_dir)
    a = m.fact_ventas.groupBy("id_filial", "anio_mes").agg(NET().cast("bigint").alias("neto_c"))
    b = m.fact_objetivos.groupBy("id_filial", "anio_mes").agg(
        F.sum("objetivo_importe_c").cast("bigint").alias("objetivo_c"))
    cal = m.calendar.groupBy(F.col("anio_mes_orden").cast("int").alias("anio_mes")).agg(
        F.count_if(F.col("es_habil") == 1).alias("habiles_mes"),
        F.count_if((F.col("es_habil") == 1) & (F.col("es_pasado") == 1)).alias("habiles_transcurridos"))
    d = M.drill_across([a, b], ["id_filial", "anio_mes"]).join(cal, "anio_mes", "left")
    c = X.safe_div("neto_c", "objetivo_c")
    proj = X.safe_div(F.col("neto_c").cast("double") * F.col("habiles_mes").cast("double"),
                      F.col("habiles_transcurridos"))
    return d.select("id_filial", "anio_mes", "neto_c", "objetivo_c", c.alias("cumplimiento"),
                    (F.col("neto_c") - F.col("objetivo_c")).alias("gap_c"),
                    X.safe_div(proj, F.col("objetivo_c")).alias("cumplimiento_proyectado"),
                    F.when(c >= 1, TARGET_LIGHT[0]).when(c >= 0.9, TARGET_LIGHT[1])
                    .when(c.isNotNull(), TARGET_LIGHT[2]).alias("semaforo"))


# ---------------- Va-6 … Va-16: sell-out, market share ----------------
CTES["so_bm"] = (["sellout"], """SELECT id_filial, anio_mes, CAST(sum(importe_sellout_c) AS BIGINT) AS sellout_c,
    CAST(sum(unidades_sellout) AS BIGINT) AS sellout_u, CAST(sum(importe_mercado_c) AS BIGINT) AS mercado_c,
    CAST(sum(unidades_mercado) AS BIGINT) AS mercado_u FROM sellout GROUP BY 1, 2""")


def _share_origin(mi, mk):
    return (F.when((mi < 0) & (mk < 0), F.concat(F.lit("Cae el mercado y caemos con él ("), T.pct1(mk),
                                                  F.lit(" el mercado)")))
            .when((mi < 0) & (mk >= 0), F.concat(F.lit("Problema propio: el mercado creció "), T.pct1(mk),
                                                  F.lit(" y nosotros "), T.pct1(mi)))
            .when((mi >= 0) & (mk > mi), F.concat(F.lit("Crecemos menos que el mercado ("), T.pct1(mi),
                                                   F.lit(" vs "), T.pct1(mk), F.lit(")")))
            .when(mi.isNotNull() & mk.isNotNull(),
                  F.concat(F.lit("Ganamos share: crecemos "), T.pct1(mi), F.lit(" contra un mercado de "), T.pct1(mk))))


def _share_origin_sql(mi, mk):
    return (f"""CASE WHEN {mi} < 0 AND {mk} < 0 THEN 'Cae el mercado y caemos con él (' || {T.sql_pct1(mk)} || ' el mercado)'
      WHEN {mi} < 0 AND {mk} >= 0 THEN 'Problema propio: el mercado creció ' || {T.sql_pct1(mk)} || ' y nosotros ' || {T.sql_pct1(mi)}
      WHEN {mi} >= 0 AND {mk} > {mi} THEN 'Crecemos menos que el mercado (' || {T.sql_pct1(mi)} || ' vs ' || {T.sql_pct1(mk)} || ')'
      WHEN {mi} IS NOT NULL AND {mk} IS NOT NULL THEN 'Ganamos share: crecemos ' || {T.sql_pct1(mi)} || ' contra un mercado de ' || {T.sql_pct1(mk)}
      END""")


_MI = "(CAST(s.sellout_c AS DOUBLE) / nullif(CAST(p.sellout_c AS DOUBLE), 0) - 1.0)"
_MK = "(CAST(s.mercado_c AS DOUBLE) / nullif(CAST(p.mercado_c AS DOUBLE), 0) - 1.0)"


@query("va06_16_sellout_and_market_share", sql(
    f"""SELECT id_filial, anio_mes, u.unidades, s.sellout_c, s.sellout_u,
       CAST(u.unidades - s.sellout_u AS DOUBLE) / nullif(CAST(s.sellout_u AS DOUBLE), 0) AS brecha,
       CASE WHEN CAST(u.unidades - s.sellout_u AS DOUBLE) / nullif(CAST(s.sellout_u AS DOUBLE), 0) > 0.25 THEN '{CHANNEL_ALERT[0]}'
         WHEN CAST(u.unidades - s.sellout_u AS DOUBLE) / nullif(CAST(s.sellout_u AS DOUBLE), 0) > 0.12 THEN '{CHANNEL_ALERT[1]}'
         WHEN CAST(u.unidades - s.sellout_u AS DOUBLE) / nullif(CAST(s.sellout_u AS DOUBLE), 0) < -0.15 THEN '{CHANNEL_ALERT[2]}'
         WHEN CAST(u.unidades - s.sellout_u AS DOUBLE) / nullif(CAST(s.sellout_u AS DOUBLE), 0) IS NOT NULL THEN '{CHANNEL_ALERT[3]}'
       END AS alerta_canal, s.mercado_c, s.mercado_u,
       CAST(s.sellout_c AS DOUBLE) / nullif(CAST(s.mercado_c AS DOUBLE), 0) AS share_valor,
       CAST(s.sellout_u AS DOUBLE) / nullif(CAST(s.mercado_u AS DOUBLE), 0) AS share_unidades,
       CAST(p.sellout_c AS DOUBLE) / nullif(CAST(p.mercado_c AS DOUBLE), 0) AS share_valor_aa,
       (CAST(s.sellout_c AS DOUBLE) / nullif(CAST(s.mercado_c AS DOUBLE), 0)
        - CAST(p.sellout_c AS DOUBLE) / nullif(CAST(p.mercado_c AS DOUBLE), 0)) * 100 AS var_share_pp,
       {_share_origin_sql(_MI, _MK)} AS origen_variacion
       FROM (SELECT id_filial, anio_mes, CAST(sum(unidades * signo) AS BIGINT) AS unidades FROM fv GROUP BY 1, 2) u
       FULL OUTER JOIN so_bm s USING (id_filial, anio_mes)
       LEFT JOIN (SELECT id_filial, anio_mes + 100 AS anio_mes, sellout_c, mercado_c FROM so_bm) p
       USING (id_filial, anio_mes)""", "fv", "so_bm"))
def va06(spark, sf_dir):
    m = model(spark, sf_dir)
    u = m.fact_ventas.groupBy("id_filial", "anio_mes").agg(
        F.sum(F.col("unidades") * F.col("signo")).cast("bigint").alias("unidades"))
    s = m.fact_sellout.groupBy("id_filial", "anio_mes").agg(
        F.sum("importe_sellout_c").cast("bigint").alias("sellout_c"),
        F.sum("unidades_sellout").cast("bigint").alias("sellout_u"),
        F.sum("importe_mercado_c").cast("bigint").alias("mercado_c"),
        F.sum("unidades_mercado").cast("bigint").alias("mercado_u"))
    p = s.select("id_filial", (F.col("anio_mes") + 100).alias("anio_mes"),
                 F.col("sellout_c").alias("p_sellout_c"), F.col("mercado_c").alias("p_mercado_c"))
    d = M.drill_across([u, s], ["id_filial", "anio_mes"]).join(p, ["id_filial", "anio_mes"], "left")
    br = X.safe_div(F.col("unidades") - F.col("sellout_u"), F.col("sellout_u"))
    sv = X.safe_div("sellout_c", "mercado_c")
    sva = X.safe_div("p_sellout_c", "p_mercado_c")
    mi = X.safe_div("sellout_c", "p_sellout_c") - F.lit(1.0)
    mk = X.safe_div("mercado_c", "p_mercado_c") - F.lit(1.0)
    return d.select(
        "id_filial", "anio_mes", "unidades", "sellout_c", "sellout_u", br.alias("brecha"),
        F.when(br > 0.25, CHANNEL_ALERT[0]).when(br > 0.12, CHANNEL_ALERT[1]).when(br < -0.15, CHANNEL_ALERT[2])
        .when(br.isNotNull(), CHANNEL_ALERT[3]).alias("alerta_canal"),
        "mercado_c", "mercado_u", sv.alias("share_valor"),
        X.safe_div("sellout_u", "mercado_u").alias("share_unidades"), sva.alias("share_valor_aa"),
        ((sv - sva) * 100).alias("var_share_pp"), _share_origin(mi, mk).alias("origen_variacion"))


# ---------------- Va-17 … Va-20: price-volume-mix ----------------
CTES["pvm_base"] = (["fv", "dim_producto"], """SELECT p.atc1, fv.id_producto, CAST(fv.anio_mes // 100 AS INT) AS anio,
    CAST(sum(fv.importe_usd_c * fv.signo) AS BIGINT) AS v, CAST(sum(fv.unidades * fv.signo) AS BIGINT) AS u
    FROM fv JOIN dim_producto p USING (id_producto) GROUP BY 1, 2, 3""")


_VOL = "(CAST(c.u - p.u AS DOUBLE) * (CAST(p.v AS DOUBLE) / nullif(CAST(p.u AS DOUBLE), 0)))"
_GAP = f"abs(round({_VOL}, 4) + round(s.precio_sku, 4) + round(CAST(c.v - p.v AS DOUBLE) - {_VOL} - s.precio_sku, 4) - CAST(c.v - p.v AS DOUBLE))"


@query("va17_20_price_volume_mix", sql(
    f"""SELECT c.atc1, c.anio, c.v - p.v AS variacion_c,
       round(CAST(c.u - p.u AS DOUBLE) * (CAST(p.v AS DOUBLE) / nullif(CAST(p.u AS DOUBLE), 0)), 4) AS efecto_volumen,
       round((CAST(c.v AS DOUBLE) / nullif(CAST(c.u AS DOUBLE), 0) - CAST(p.v AS DOUBLE) / nullif(CAST(p.u AS DOUBLE), 0))
         * CAST(c.u AS DOUBLE), 4) AS efecto_precio,
       round(CAST(c.v - p.v AS DOUBLE) - CAST(c.u - p.u AS DOUBLE) * (CAST(p.v AS DOUBLE) / nullif(CAST(p.u AS DOUBLE), 0))
         - (CAST(c.v AS DOUBLE) / nullif(CAST(c.u AS DOUBLE), 0) - CAST(p.v AS DOUBLE) / nullif(CAST(p.u AS DOUBLE), 0))
         * CAST(c.u AS DOUBLE), 2) + 0.0 AS efecto_mix,
       CASE WHEN {_GAP} < 1.0 THEN '{BRIDGE_OK}' WHEN {_GAP} IS NOT NULL THEN '{BRIDGE_BAD}' || {T.sql_thousands(f'round({_GAP} / 100.0)')} END AS control_cierre,
       round(s.precio_sku, 4) AS efecto_precio_sku,
       round(CAST(c.v - p.v AS DOUBLE) - CAST(c.u - p.u AS DOUBLE) * (CAST(p.v AS DOUBLE) / nullif(CAST(p.u AS DOUBLE), 0))
         - s.precio_sku, 4) AS efecto_mix_sku
       FROM (SELECT atc1, anio, CAST(sum(v) AS BIGINT) AS v, CAST(sum(u) AS BIGINT) AS u FROM pvm_base GROUP BY 1, 2) c
       JOIN (SELECT atc1, anio + 1 AS anio, CAST(sum(v) AS BIGINT) AS v, CAST(sum(u) AS BIGINT) AS u FROM pvm_base GROUP BY 1, 2) p USING (atc1, anio)
       LEFT JOIN (SELECT a.atc1, a.anio, sum(CAST(a.u AS DOUBLE) * (CAST(a.v AS DOUBLE) / nullif(CAST(a.u AS DOUBLE), 0)
           - CAST(b.v AS DOUBLE) / nullif(CAST(b.u AS DOUBLE), 0))) AS precio_sku
         FROM pvm_base a JOIN pvm_base b ON b.id_producto = a.id_producto AND b.anio = a.anio - 1
         WHERE a.u <> 0 AND b.u <> 0 GROUP BY 1, 2) s USING (atc1, anio)""", "pvm_base"))
def va17(spark, sf_dir):
    m = model(spark, sf_dir)
    d = M.enrich(m, m.fact_ventas, ["atc1"]).withColumn("anio", F.floor(F.col("anio_mes") / 100).cast("int"))
    base = d.groupBy("atc1", "id_producto", "anio").agg(
        NET().cast("bigint").alias("v"), F.sum(F.col("unidades") * F.col("signo")).cast("bigint").alias("u"))
    agg = base.groupBy("atc1", "anio").agg(F.sum("v").alias("v"), F.sum("u").alias("u"))
    prev = agg.select("atc1", (F.col("anio") + 1).alias("anio"), F.col("v").alias("v0"), F.col("u").alias("u0"))
    a = base.filter(F.col("u") != 0).alias("a")
    b = base.filter(F.col("u") != 0).select("id_producto", (F.col("anio") + 1).alias("anio"),
                                            F.col("v").alias("bv"), F.col("u").alias("bu"))
    sku = (a.join(b, ["id_producto", "anio"])
           .groupBy("atc1", "anio").agg(F.sum(F.col("u").cast("double") * (X.safe_div("v", "u") - X.safe_div("bv", "bu")))
                                        .alias("precio_sku")))
    j = agg.join(prev, ["atc1", "anio"]).join(sku, ["atc1", "anio"], "left")
    p0 = X.safe_div("v0", "u0")
    vol = (F.col("u") - F.col("u0")).cast("double") * p0
    total, price = (F.col("v") - F.col("v0")).cast("double"), (X.safe_div("v", "u") - p0) * F.col("u").cast("double")
    # Va-20: the three effects at SKU level (each rounded as shown) add up to the variation, to a cent
    mix_sku = F.round(total - vol - F.col("precio_sku"), 4)
    gap = F.abs(F.round(vol, 4) + F.round("precio_sku", 4) + mix_sku - total)
    return j.select("atc1", "anio", (F.col("v") - F.col("v0")).alias("variacion_c"),
                    F.round(vol, 4).alias("efecto_volumen"),
                    F.round((X.safe_div("v", "u") - p0) * F.col("u").cast("double"), 4).alias("efecto_precio"),
                    (F.round(total - vol - price, 2) + F.lit(0.0)).alias("efecto_mix"),
                    F.when(gap < 1.0, F.lit(BRIDGE_OK)).when(gap.isNotNull(), F.concat(F.lit(BRIDGE_BAD), T.thousands(F.round(gap / 100.0))))
                    .alias("control_cierre"),
                    F.round("precio_sku", 4).alias("efecto_precio_sku"),
                    F.round((F.col("v") - F.col("v0")).cast("double") - vol - F.col("precio_sku"), 4)
                    .alias("efecto_mix_sku"))


# ---------------- Va-21 … Va-23 ----------------
@query("va21_23_pareto_count_and_branch_share", sql(
    """SELECT id_filial, neto_c, CAST(neto_c AS DOUBLE) / CAST(sum(neto_c) OVER () AS DOUBLE) AS share_filial,
       CAST(n80 + 1 AS BIGINT) AS skus_80 FROM (SELECT id_filial, CAST(sum(v) AS BIGINT) AS neto_c,
       count(*) FILTER (WHERE acum <= 0.8) AS n80 FROM (SELECT id_filial, id_producto, v,
         CAST(sum(v) OVER (PARTITION BY id_filial ORDER BY v DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE)
         / CAST(sum(v) OVER (PARTITION BY id_filial) AS DOUBLE) AS acum
         FROM (SELECT id_filial, id_producto, CAST(sum(importe_usd_c * signo) AS BIGINT) AS v FROM fv GROUP BY 1, 2) g) x
       GROUP BY 1) t""", "fv"))
def va21(spark, sf_dir):
    fv = model(spark, sf_dir).fact_ventas
    g = fv.groupBy("id_filial", "id_producto").agg(NET().cast("bigint").alias("v"))
    tot = g.groupBy("id_filial").agg(F.sum("v").alias("neto_c"))
    # cumulative share with ties (RANGE semantics): running sum over the distinct values of each
    # branch, through the grouped global order (a branch with most SKUs is not one task)
    byv = g.groupBy("id_filial", "v").agg(F.count(F.lit(1)).alias("k"))
    cum = W.global_position(byv, [F.col("v").desc()], group=["id_filial"], cum_of=F.col("v") * F.col("k"),
                            cum="_cum").select("id_filial", "v", "_cum")
    x = g.join(cum, ["id_filial", "v"]).join(tot, "id_filial") \
        .withColumn("acum", X.safe_div("_cum", "neto_c"))
    per = x.groupBy("id_filial").agg(F.first("neto_c").alias("neto_c"),
                                     (F.count_if(F.col("acum") <= 0.8) + 1).cast("bigint").alias("skus_80"))
    allt = tot.agg(F.sum("neto_c").alias("_t"))
    return per.crossJoin(allt).select("id_filial", "neto_c", X.safe_div("neto_c", "_t").alias("share_filial"),
                                      "skus_80")


# ---------------- Va-24 … Va-27 ----------------
@query("va24_27_margin_prior_year_and_net_of_returns", sql(
    """SELECT id_filial, anio, a.neto_c, a.margen_c, p.margen_c AS margen_aa_c,
       (CAST(a.margen_c AS DOUBLE) / nullif(CAST(a.neto_c AS DOUBLE), 0)
        - CAST(p.margen_c AS DOUBLE) / nullif(CAST(p.neto_c AS DOUBLE), 0)) * 100 AS var_margen_pp,
       a.margen_c - coalesce(d.dev_c, 0) AS margen_neto_dev_c,
       CAST(a.margen_c - coalesce(d.dev_c, 0) AS DOUBLE) / nullif(CAST(a.neto_c AS DOUBLE), 0) AS margen_neto_dev_pct
       FROM (SELECT id_filial, CAST(anio_mes // 100 AS INT) AS anio, CAST(sum(importe_usd_c * signo) AS BIGINT) AS neto_c,
         CAST(sum((importe_usd_c - costo_usd_c) * signo) AS BIGINT) AS margen_c FROM fv GROUP BY 1, 2) a
       LEFT JOIN (SELECT id_filial, CAST(anio_mes // 100 AS INT) + 1 AS anio, CAST(sum(importe_usd_c * signo) AS BIGINT) AS neto_c,
         CAST(sum((importe_usd_c - costo_usd_c) * signo) AS BIGINT) AS margen_c FROM fv GROUP BY 1, 2) p USING (id_filial, anio)
       LEFT JOIN (SELECT id_filial, CAST(year(fecha) AS INT) AS anio, CAST(sum(importe_devuelto_usd_c) AS BIGINT) AS dev_c
         FROM fdev GROUP BY 1, 2) d USING (id_filial, anio)""", "fv", "fdev"))
def va24(spark, sf_dir):
    m = model(spark, sf_dir)
    fv = m.fact_ventas.withColumn("anio", F.floor(F.col("anio_mes") / 100).cast("int"))
    a = fv.groupBy("id_filial", "anio").agg(
        NET().cast("bigint").alias("neto_c"),
        F.sum((F.col("importe_usd_c") - F.col("costo_usd_c")) * F.col("signo")).cast("bigint").alias("margen_c"))
    p = a.select("id_filial", (F.col("anio") + 1).alias("anio"), F.col("neto_c").alias("p_neto"),
                 F.col("margen_c").alias("margen_aa_c"))
    d = m.fact_devoluciones.groupBy("id_filial", F.year("fecha").alias("anio")).agg(
        F.sum("importe_devuelto_usd_c").cast("bigint").alias("dev_c"))
    j = a.join(p, ["id_filial", "anio"], "left").join(d, ["id_filial", "anio"], "left")
    mnd = F.col("margen_c") - F.coalesce("dev_c", F.lit(0))
    return j.select("id_filial", "anio", "neto_c", "margen_c", "margen_aa_c",
                    ((X.safe_div("margen_c", "neto_c") - X.safe_div("margen_aa_c", "p_neto")) * 100).alias("var_margen_pp"),
                    mnd.alias("margen_neto_dev_c"), X.safe_div(mnd, F.col("neto_c")).alias("margen_neto_dev_pct"))
