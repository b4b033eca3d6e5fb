"""Registered pricing queries PR-1 … PR-9, A-11, O-2, Of-23 … Of-30."""

from __future__ import annotations

from pyspark.sql import functions as F

from starmetrics.functions import exprs as X
from starmetrics.functions import text as T
from starmetrics.operators import pricing as P
from starmetrics.operators.star import model
from starmetrics.plans.aggregates_q import latest_stock
from starmetrics.plans.catalog import query
from starmetrics.plans.cleansing import CLASS_EXPR, CLASS_EXPR_DUCK, LABELS, SEASONAL_SQL, seasonal_table
from starmetrics.plans.oracle import CTES, sql
from starmetrics.plans.windows_q import line_risk

# Class descriptions (by class letter) and Spanish month names for the texts.
CLASS_NAMES = {
    "A": "Aparato digestivo y metabolismo", "C": "Sistema cardiovascular", "J": "Antiinfecciosos vía general",
    "L": "Agentes antineoplásicos", "M": "Sistema musculoesquelético", "N": "Sistema nervioso",
    "R": "Sistema respiratorio",
}
MONTHS_FULL = ["enero", "febrero", "marzo", "abril", "mayo", "junio", "julio", "agosto", "septiembre", "octubre",
               "noviembre", "diciembre"]
EDGE_NOTE = (" NOTA: el óptimo cae en el borde del rango de descuentos con evidencia histórica. El modelo NO "
             "extrapola más allá — si se quiere explorar un descuento mayor, corresponde un test controlado sobre "
             "un subconjunto de clientes antes de generalizar.")
R9 = 9


# ---------------------------------------------------------------- Spark side
def pr_elasticities(m, min_obs=P.MIN_OBS):
    e = P.elasticities(m.sellin, m.keyed("products", "id_producto", "atc1", "atc3"), min_obs)
    return e.withColumn("elasticidad", F.round("elasticidad", R9))


def candidates(m):
    """PR-4: segment × product candidates with stock, risk, contribution, elasticity and defaults."""
    s = m.sellin
    last = s.agg(F.max("fecha").alias("_u"), F.max("mes_idx").alias("_mi"))
    recent = s.crossJoin(F.broadcast(last)).filter(F.col("fecha") >= F.date_sub("_u", 180))
    cust = m.customers.select("id_cliente", "canal", "segmento")
    base = (recent.join(cust, "id_cliente", "left").groupBy(*P.SEGMENT, "id_producto")
            .agg(F.sum("unidades").alias("unidades"), F.count_distinct("id_cliente").alias("clientes"),
                 F.avg("dias_a_vencer").alias("dias_a_vencer"))
            .filter(F.col("clientes") >= 3)
            .withColumn("q_base", F.greatest(F.col("unidades").cast("double") / 6.0, F.lit(1.0))))
    prod = m.products.select("id_producto", "atc1", (F.col("precio_lista_c") / 100.0).alias("precio_lista"),
                             (F.col("costo_std_c") / 100.0).alias("costo"), F.col("costo_std_c"))
    mg = (recent.join(prod, "id_producto").groupBy("id_producto")
          .agg(F.sum(F.col("importe_usd_c") - F.col("costo_std_c") * F.col("unidades")).alias("_m")))
    mg_t = mg.agg(F.sum("_m").alias("_t"))
    aporte = mg.crossJoin(mg_t).select("id_producto", X.safe_div("_m", "_t").alias("aporte_margen_pct"))
    st = latest_stock(m).groupBy("id_producto").agg(F.sum("stock_unidades").alias("stock_unidades"),
                                                    F.avg("dias_cobertura").alias("dias_cobertura"))
    pv = m.fact_stock.join(m.fact_stock.agg(F.max("anio_mes").alias("anio_mes")), "anio_mes", "left_semi") \
        .groupBy("id_producto").agg(F.sum("unidades_por_vencer_180d").alias("unidades_por_vencer"))
    lr = line_risk(m)
    risk = lr.groupBy("id_producto").agg(F.round(F.avg("prob"), 12).alias("riesgo_dev_base"))
    risk_all = lr.agg(F.round(F.avg("prob"), 12).alias("_rall"))
    target_m = last.select(((F.col("_mi") + 1) % 12 + 1).alias("mes_nro"))
    c = (base.join(prod.drop("costo_std_c"), "id_producto", "left")
         .join(pr_elasticities(m).drop("atc1", "atc3"), "id_producto", "left")
         .join(st, "id_producto", "left").join(pv, "id_producto", "left")
         .join(risk, "id_producto", "left").join(aporte, "id_producto", "left")
         .crossJoin(risk_all).crossJoin(target_m))
    c = c.select(
        *P.SEGMENT, "id_producto", "atc1", "unidades", "clientes", "q_base", "precio_lista", "costo", "elasticidad",
        "nivel_estimacion", F.coalesce("stock_unidades", F.lit(0)).alias("stock_unidades"),
        F.coalesce("unidades_por_vencer", F.lit(0)).alias("unidades_por_vencer"),
        F.coalesce(F.col("dias_cobertura"), F.lit(float(P.DOH_MIN))).alias("dias_cobertura"),
        F.coalesce(F.col("dias_a_vencer"), F.lit(float(P.DEFAULT_DAYS_TO_EXPIRY))).alias("dias_a_vencer"),
        F.coalesce("riesgo_dev_base", "_rall").alias("riesgo_dev_base"),
        F.coalesce("aporte_margen_pct", F.lit(0.0)).alias("aporte_margen_pct"), "mes_nro",
        F.expr(CLASS_EXPR).alias("clase"))
    # 84-row fixed table: broadcast with a proven bound
    return c.join(F.broadcast(seasonal_table(m.spark)), ["clase", "mes_nro"], "left")


def recommendations(m):
    def build():
        c = candidates(m)
        grid = P.discount_grid(m.sellin, m.spark)
        return P.optimise(P.evaluate_grid(c, grid), grid)
    return m.shared("recommendations", build)


def _fixed2(x):
    cents = F.round(F.abs(x) * 100).cast("bigint")
    return F.concat(F.when(x < 0, F.lit("-")).otherwise(F.lit("")), F.format_number((cents / 100).cast("bigint"), 0),
                    F.lit("."), F.lpad((cents % 100).cast("string"), 2, "0"))


def justification(r):
    """PR-9: explanation text from the recommendation's own columns (no UDF)."""
    cls = F.lower(F.element_at(F.create_map(*[x for k, v in CLASS_NAMES.items() for x in (F.lit(k), F.lit(v))]),
                               F.col("clase")))
    mes = F.element_at(F.array(*[F.lit(x) for x in MONTHS_FULL]), F.col("mes_nro"))
    ie = F.col("indice_estacional")
    parts = [
        F.when(ie >= 1.20, F.concat(F.lit("entra en temporada alta de "), cls, F.lit(" (índice "), _fixed2(ie),
                                    F.lit(" en "), mes, F.lit(")")))
        .when(ie <= 0.90, F.concat(F.lit("está fuera de temporada (índice "), _fixed2(ie),
                                   F.lit("), por eso el descuento compensa la menor demanda natural"))),
        F.when(F.col("dias_cobertura") > P.DOH_MAX,
               F.concat(F.lit("hay sobrestock: "), F.round("dias_cobertura").cast("bigint").cast("string"),
                        F.lit(f" días de cobertura contra un máximo deseado de {P.DOH_MAX}")))
        .when(F.col("dias_cobertura") < P.DOH_MIN,
              F.concat(F.lit("ATENCIÓN: la cobertura es de solo "), F.round("dias_cobertura").cast("bigint").cast("string"),
                       F.lit(" días — ofertar acá puede provocar quiebre de stock"))),
        F.when(F.col("unidades_por_vencer") > 0,
               F.concat(T.thousands(F.col("unidades_por_vencer")), F.lit(f" unidades vencen en menos de {P.SHORT_LOT_DAYS} días (USD "),
                        T.thousands(F.round("valor_rescate")), F.lit(" rescatables)"))),
        F.when(F.col("aporte_margen_pct") >= 0.02,
               F.concat(F.lit("el SKU aporta el "), T.pct1(F.col("aporte_margen_pct")),
                        F.lit(" del margen de la filial (está entre los que mueven la aguja)"))),
        F.concat(F.lit("elasticidad estimada "), _fixed2(F.col("elasticidad")), F.lit(" (nivel "), F.col("nivel_estimacion"),
                 F.lit("), con margen unitario de USD "), _fixed2(F.col("margen_unitario")), F.lit(" ("),
                 F.round(F.lit(100.0) * F.col("margen_unitario") / F.col("precio_neto")).cast("bigint").cast("string"),
                 F.lit("% sobre precio neto)")),
        F.concat(F.lit("probabilidad de aceptación estimada "), T.pct0(F.col("prob_aceptacion"))),
        F.when(F.col("riesgo_devolucion") > 0.20,
               F.concat(F.lit("riesgo de devolución ALTO ("), T.pct0(F.col("riesgo_devolucion")),
                        F.lit("): condicionar la oferta a que el cliente no supere su cobertura objetivo")))
        .otherwise(F.concat(F.lit("riesgo de devolución controlado ("), T.pct0(F.col("riesgo_devolucion")), F.lit(")"))),
    ]
    body = F.concat_ws("; ", *parts)
    body = F.concat(F.upper(F.substring(body, 1, 1)), F.lower(F.substring(body, 2, 1_000_000)))
    close = F.concat(F.lit("El "), T.pct0(F.col("d")), F.lit(" maximiza el margen esperado neto: USD "),
                     T.thousands(F.round("objetivo")), F.lit(" contra USD "), T.thousands(F.round("objetivo_sin_oferta")),
                     F.lit(" sin oferta (+USD "), T.thousands(F.round("ganancia")), F.lit(")."),
                     F.when(F.col("en_borde_de_soporte") == 1, F.lit(EDGE_NOTE)).otherwise(F.lit("")))
    return F.concat(body, F.lit(". "), close)


# ---------------------------------------------------------------- oracle side
def _fe_sql(key):
    return f"""SELECT {key}, CASE WHEN n >= {P.MIN_OBS} AND sqrt(greatest((spp - sp * sp / n) / (n - 1), 0.0)) >= {P.MIN_SD_LOG_P}
      AND pp_t > 0 THEN pq_t / pp_t END AS elast,
      CASE WHEN n >= {P.MIN_OBS} AND sqrt(greatest((spp - sp * sp / n) / (n - 1), 0.0)) >= {P.MIN_SD_LOG_P} AND pp_t > 0
      THEN 1.0 - (qq_t - (pq_t / pp_t) * pq_t) / nullif(sqq - sq * sq / n, 0.0) END AS r2, CAST(n AS BIGINT) AS n
      FROM (SELECT {key}, sum(nm) AS n, sum(spq - sp * sq / nm) AS pq_t, sum(spp - sp * sp / nm) AS pp_t,
        sum(sqq - sq * sq / nm) AS qq_t, sum(sq) AS sq, sum(sqq) AS sqq, sum(sp) AS sp, sum(spp) AS spp
        FROM (SELECT {key}, mes, CAST(count(*) AS DOUBLE) AS nm, sum(lq) AS sq, sum(lp) AS sp, sum(lq * lq) AS sqq,
          sum(lp * lp) AS spp, sum(lp * lq) AS spq FROM pr_lines GROUP BY ALL) m GROUP BY 1) g"""


CTES.update({
    "pr_lines": (["sellin", "dim_producto"], """SELECT s.*, p.atc1, p.atc3, 1 AS all_, ln(CAST(s.unidades AS DOUBLE)) AS lq,
        ln(CAST(s.importe_usd_c AS DOUBLE) / 100.0 / CAST(s.unidades AS DOUBLE)) AS lp, CAST(month(s.fecha) AS INT) AS mes
        FROM sellin s JOIN dim_producto p USING (id_producto) WHERE s.unidades > 0 AND s.importe_usd_c > 0"""),
    "elast": (["pr_lines", "dim_producto"], f"""SELECT id_producto,
        round(least(greatest(coalesce(a.elast, b.elast, c.elast, g.elast), {P.ELASTICITY_BOUNDS[0]}), {P.ELASTICITY_BOUNDS[1]}), {R9})
          AS elasticidad,
        CASE WHEN a.elast IS NOT NULL THEN 'Producto' WHEN b.elast IS NOT NULL THEN 'ATC3'
          WHEN c.elast IS NOT NULL THEN 'ATC1' ELSE 'Global' END AS nivel_estimacion
        FROM dim_producto p LEFT JOIN ({_fe_sql('id_producto')}) a USING (id_producto)
        LEFT JOIN ({_fe_sql('atc3')}) b USING (atc3) LEFT JOIN ({_fe_sql('atc1')}) c USING (atc1)
        CROSS JOIN ({_fe_sql('all_')}) g"""),
    "recent": (["sellin"], "SELECT * FROM sellin WHERE fecha >= (SELECT max(fecha) FROM sellin) - INTERVAL 180 DAY"),
    "cand": (["recent", "dim_cliente", "dim_producto", "elast", "stock", "dim_deposito", "line_risk"], f"""
        SELECT b.*, p.atc1, CAST(p.precio_lista_c AS DOUBLE) / 100.0 AS precio_lista, CAST(p.costo_std_c AS DOUBLE) / 100.0 AS costo,
          e.elasticidad, e.nivel_estimacion, coalesce(st.stock_unidades, 0) AS stock_unidades,
          coalesce(pv.unidades_por_vencer, 0) AS unidades_por_vencer,
          coalesce(st.dias_cobertura, {float(P.DOH_MIN)}) AS dias_cobertura,
          coalesce(b.dav, {float(P.DEFAULT_DAYS_TO_EXPIRY)}) AS dias_a_vencer,
          coalesce(r.riesgo_dev_base, (SELECT round(avg(prob), 12) FROM line_risk)) AS riesgo_dev_base,
          coalesce(a.aporte_margen_pct, 0.0) AS aporte_margen_pct,
          CAST((SELECT max(mes_idx) FROM sellin) + 1 AS INT) % 12 + 1 AS mes_nro,
          {CLASS_EXPR_DUCK.replace('id_producto', 'b.id_producto')} AS clase
        FROM (SELECT c.segmento, s.id_producto, sum(s.unidades) AS unidades,
            count(DISTINCT s.id_cliente) AS clientes, avg(s.dias_a_vencer) AS dav,
            greatest(CAST(sum(s.unidades) AS DOUBLE) / 6.0, 1.0) AS q_base
          FROM recent s LEFT JOIN dim_cliente c USING (id_cliente) GROUP BY 1, 2 HAVING count(DISTINCT s.id_cliente) >= 3) b
        LEFT JOIN dim_producto p USING (id_producto) LEFT JOIN elast e USING (id_producto)
        LEFT JOIN (SELECT id_producto, sum(stock_unidades) AS stock_unidades, avg(dias_cobertura) AS dias_cobertura
          FROM (SELECT id_deposito, id_producto, sum(stock_unidades) AS stock_unidades, max(dias_cobertura) AS dias_cobertura
                FROM stock WHERE anio_mes = (SELECT max(anio_mes) FROM stock) GROUP BY 1, 2) s GROUP BY 1) st USING (id_producto)
        LEFT JOIN (SELECT id_producto, sum(unidades_por_vencer_180d) AS unidades_por_vencer FROM stock
          WHERE anio_mes = (SELECT max(anio_mes) FROM stock) GROUP BY 1) pv USING (id_producto)
        LEFT JOIN (SELECT id_producto, round(avg(prob), 12) AS riesgo_dev_base FROM line_risk GROUP BY 1) r USING (id_producto)
        LEFT JOIN (SELECT id_producto, CAST(m AS DOUBLE) / nullif(CAST(sum(m) OVER () AS DOUBLE), 0)
            AS aporte_margen_pct FROM (SELECT s.id_producto, sum(s.importe_usd_c - p2.costo_std_c * s.unidades) AS m
            FROM recent s JOIN dim_producto p2 USING (id_producto) GROUP BY 1) mm) a USING (id_producto)"""),
    "cand_s": (["cand"], f"SELECT c.*, t.indice_estacional FROM cand c LEFT JOIN ({SEASONAL_SQL}) t USING (clase, mes_nro)"),
    "grid": (["sellin"], "SELECT CAST(d AS DOUBLE) AS d FROM (VALUES " + ", ".join(f"({d})" for d in P.GRID) + """) g(d)
        WHERE d <= (SELECT floor(quantile_cont(descuento_pct_int / 100.0, 0.95) * 50) / 50 FROM sellin) + 1e-9"""),
    "g1": (["cand_s", "grid"], """SELECT c.*, grid.d, c.precio_lista * (1.0 - grid.d) AS precio_neto,
        least(c.q_base * pow(1.0 - grid.d, c.elasticidad), 3.0 * c.q_base) AS demanda,
        least(greatest(0.30 + 4.0 * grid.d, 0.0), 1.0) AS prob_aceptacion FROM cand_s c CROSS JOIN grid"""),
    "g2": (["g1"], f"""SELECT *, precio_neto - costo AS margen_unitario, (precio_neto - costo) / precio_neto AS margen_pct,
        prob_aceptacion * demanda * (precio_neto - costo) AS margen_esperado,
        least(greatest(riesgo_dev_base * (1.0 + 1.20 * least(greatest((dias_cobertura - {float(P.DOH_MAX)}) / {float(P.DOH_MAX)}, 0.0), 1.5)
          + 0.90 * CAST(CAST(dias_a_vencer < {P.SHORT_LOT_DAYS} AS INT) AS DOUBLE) + 1.50 * d), 0.0), 0.60) AS riesgo_devolucion,
        least(prob_aceptacion * demanda, CAST(unidades_por_vencer AS DOUBLE)) * costo AS valor_rescate FROM g1"""),
    "g3": (["g2"], """SELECT *, margen_esperado * (1.0 - riesgo_devolucion) AS margen_neto,
        margen_esperado * (1.0 - riesgo_devolucion) + valor_rescate AS objetivo FROM g2"""),
    "best": (["g3", "grid"], """SELECT b.*, CAST(b.d >= (SELECT max(d) FROM grid) - 1e-9 AS INT) AS en_borde_de_soporte,
        b.q_base * (b.precio_lista - b.costo) * (1.0 - b.riesgo_dev_base) AS objetivo_sin_oferta,
        b.objetivo - b.q_base * (b.precio_lista - b.costo) * (1.0 - b.riesgo_dev_base) AS ganancia
        FROM g3 b WHERE margen_pct >= 0.15 QUALIFY row_number() OVER (PARTITION BY segmento, id_producto
        ORDER BY objetivo DESC, d) = 1"""),
    "reco": (["best"], """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY segmento
        ORDER BY objetivo DESC, id_producto) AS rank_segmento FROM best WHERE ganancia > 0) x WHERE rank_segmento <= 5"""),
})

_R6 = ["q_base", "precio_neto", "demanda", "prob_aceptacion", "margen_unitario", "riesgo_devolucion", "valor_rescate",
       "objetivo", "objetivo_sin_oferta", "ganancia"]


@query("pr01_pr02_elasticity_fe_ols_with_fallback", sql("SELECT * FROM elast", "elast"))
def pr01(spark, sf_dir):
    return pr_elasticities(model(spark, sf_dir))


@query("pr03_discount_grid_in_support", sql("SELECT d FROM grid", "grid"))
def pr03(spark, sf_dir):
    m = model(spark, sf_dir)
    return P.discount_grid(m.sellin, spark)


@query("pr04_candidate_table", sql(
    """SELECT segmento, id_producto, CAST(unidades AS BIGINT) AS unidades, CAST(clientes AS BIGINT) AS clientes,
       q_base, precio_lista, costo, elasticidad, nivel_estimacion, CAST(stock_unidades AS BIGINT) AS stock_unidades,
       CAST(unidades_por_vencer AS BIGINT) AS unidades_por_vencer, dias_cobertura, dias_a_vencer, riesgo_dev_base,
       aporte_margen_pct, indice_estacional FROM cand_s""", "cand_s"))
def pr04(spark, sf_dir):
    c = candidates(model(spark, sf_dir))
    return c.select(*P.SEGMENT, "id_producto", F.col("unidades").cast("bigint").alias("unidades"),
                    F.col("clientes").cast("bigint").alias("clientes"), "q_base", "precio_lista", "costo", "elasticidad",
                    "nivel_estimacion", F.col("stock_unidades").cast("bigint").alias("stock_unidades"),
                    F.col("unidades_por_vencer").cast("bigint").alias("unidades_por_vencer"), "dias_cobertura",
                    "dias_a_vencer", "riesgo_dev_base", "aporte_margen_pct", "indice_estacional")


@query("pr05_pr06_grid_objective", sql(
    "SELECT segmento, id_producto, d, " + ", ".join(f"round({c}, 6) AS {c}" for c in _R6[:-3])
    + ", round(margen_pct, 9) AS margen_pct FROM g3", "g3"))
def pr05(spark, sf_dir):
    m = model(spark, sf_dir)
    g = P.evaluate_grid(candidates(m), P.discount_grid(m.sellin, spark))
    return g.select(*P.SEGMENT, "id_producto", "d", *[F.round(c, 6).alias(c) for c in _R6[:-3]],
                    F.round("margen_pct", 9).alias("margen_pct"))


@query("pr07_pr08_w09_w10_top5_recommendations", sql(
    "SELECT segmento, id_producto, d, rank_segmento, en_borde_de_soporte, "
    f"CASE WHEN en_borde_de_soporte = 1 THEN '{LABELS['confianza'][0]}' ELSE '{LABELS['confianza'][1]}' END AS confianza, "
    + ", ".join(f"round({c}, 6) AS {c}" for c in _R6) + " FROM reco", "reco"))
def pr07(spark, sf_dir):
    r = recommendations(model(spark, sf_dir))
    yes, no = LABELS["confianza"]          # C-13: recommendation confidence label
    return r.select(*P.SEGMENT, "id_producto", "d", F.col("rank_segmento").cast("bigint").alias("rank_segmento"),
                    "en_borde_de_soporte",
                    F.when(F.col("en_borde_de_soporte") == 1, yes).otherwise(no).alias("confianza"),
                    *[F.round(c, 6).alias(c) for c in _R6])


def _sql_fixed2(x):
    return (f"(CASE WHEN {x} < 0 THEN '-' ELSE '' END || format('{{:,}}', CAST(CAST(round(abs({x}) * 100) AS BIGINT) // 100 AS BIGINT))"
            f" || '.' || lpad(CAST(CAST(round(abs({x}) * 100) AS BIGINT) % 100 AS VARCHAR), 2, '0'))")


_CLASS_CASE = "CASE clase " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in CLASS_NAMES.items()) + " END"
_MES_LIST = "[" + ", ".join(f"'{x}'" for x in MONTHS_FULL) + "]"
_BODY = f"""concat_ws('; ',
  CASE WHEN indice_estacional >= 1.20 THEN 'entra en temporada alta de ' || lower({_CLASS_CASE}) || ' (índice '
       || {_sql_fixed2('indice_estacional')} || ' en ' || list_extract({_MES_LIST}, mes_nro) || ')'
       WHEN indice_estacional <= 0.90 THEN 'está fuera de temporada (índice ' || {_sql_fixed2('indice_estacional')}
       || '), por eso el descuento compensa la menor demanda natural' END,
  CASE WHEN dias_cobertura > {P.DOH_MAX} THEN 'hay sobrestock: ' || CAST(CAST(round(dias_cobertura) AS BIGINT) AS VARCHAR)
       || ' días de cobertura contra un máximo deseado de {P.DOH_MAX}'
       WHEN dias_cobertura < {P.DOH_MIN} THEN 'ATENCIÓN: la cobertura es de solo ' || CAST(CAST(round(dias_cobertura) AS BIGINT) AS VARCHAR)
       || ' días — ofertar acá puede provocar quiebre de stock' END,
  CASE WHEN unidades_por_vencer > 0 THEN {T.sql_thousands('unidades_por_vencer')} || ' unidades vencen en menos de {P.SHORT_LOT_DAYS} días (USD '
       || {T.sql_thousands('round(valor_rescate)')} || ' rescatables)' END,
  CASE WHEN aporte_margen_pct >= 0.02 THEN 'el SKU aporta el ' || {T.sql_pct1('aporte_margen_pct')}
       || ' del margen de la filial (está entre los que mueven la aguja)' END,
  'elasticidad estimada ' || {_sql_fixed2('elasticidad')} || ' (nivel ' || nivel_estimacion || '), con margen unitario de USD '
       || {_sql_fixed2('margen_unitario')} || ' (' || CAST(CAST(round(100.0 * margen_unitario / precio_neto) AS BIGINT) AS VARCHAR)
       || '% sobre precio neto)',
  'probabilidad de aceptación estimada ' || {T.sql_pct0('prob_aceptacion')},
  CASE WHEN riesgo_devolucion > 0.20 THEN 'riesgo de devolución ALTO (' || {T.sql_pct0('riesgo_devolucion')}
       || '): condicionar la oferta a que el cliente no supere su cobertura objetivo'
       ELSE 'riesgo de devolución controlado (' || {T.sql_pct0('riesgo_devolucion')} || ')' END)"""
_CLOSE = f"""'El ' || {T.sql_pct0('d')} || ' maximiza el margen esperado neto: USD ' || {T.sql_thousands('round(objetivo)')}
  || ' contra USD ' || {T.sql_thousands('round(objetivo_sin_oferta)')} || ' sin oferta (+USD ' || {T.sql_thousands('round(ganancia)')}
  || ').' || CASE WHEN en_borde_de_soporte = 1 THEN '{EDGE_NOTE}' ELSE '' END"""
CTES["reco_txt"] = (["reco"], f"""SELECT *, upper(substr(b, 1, 1)) || lower(substr(b, 2)) || '. ' || {_CLOSE} AS justificativo
    FROM (SELECT *, {_BODY} AS b FROM reco) x""")


@query("pr09_justification_text", sql(
    "SELECT segmento, id_producto, justificativo FROM reco_txt", "reco_txt"))
def pr09(spark, sf_dir):
    r = recommendations(model(spark, sf_dir))
    return r.select(*P.SEGMENT, "id_producto", justification(r).alias("justificativo"))


@query("a11_recommendation_summary", sql(
    """SELECT CAST(count(DISTINCT segmento) AS BIGINT) AS segmentos, CAST(count(*) AS BIGINT) AS recomendaciones,
       round(avg(d), 9) AS descuento_medio, round(sum(ganancia), 4) AS ganancia_total, round(sum(valor_rescate), 4) AS stock_rescatado,
       CAST(sum(en_borde_de_soporte) AS BIGINT) AS en_borde FROM reco""", "reco"))
def a11(spark, sf_dir):
    r = recommendations(model(spark, sf_dir))
    return r.agg(F.count_distinct(*P.SEGMENT).alias("segmentos"), F.count(F.lit(1)).alias("recomendaciones"),
                 F.round(F.avg("d"), 9).alias("descuento_medio"), F.round(F.sum("ganancia"), 4).alias("ganancia_total"),
                 F.round(F.sum("valor_rescate"), 4).alias("stock_rescatado"),
                 F.sum("en_borde_de_soporte").cast("bigint").alias("en_borde"))


@query("o02_recommendations_ordered", sql(
    """SELECT segmento, CAST(rank_segmento AS BIGINT) AS rank_segmento, id_producto,
       CAST(row_number() OVER (ORDER BY segmento, rank_segmento) AS BIGINT) AS orden FROM reco""", "reco"))
def o02(spark, sf_dir):
    from starmetrics.operators.windows import global_position
    r = recommendations(model(spark, sf_dir)).select(*P.SEGMENT, F.col("rank_segmento").cast("bigint").alias("rank_segmento"),
                                                     "id_producto")
    o = global_position(r, [F.col(c) for c in P.SEGMENT] + [F.col("rank_segmento")], pos="orden")
    return o.withColumn("orden", F.col("orden").cast("bigint"))


@query("of23_30_recommendation_measures", sql(
    f"""SELECT segmento, round(avg(d), 9) AS descuento_recomendado, round(sum(ganancia), 4) AS ganancia_estimada,
       round(sum(valor_rescate), 4) AS stock_rescatado, CAST(count(*) AS BIGINT) AS recomendaciones_activas,
       CAST(sum(en_borde_de_soporte) AS BIGINT) AS requieren_test,
       CASE WHEN count(DISTINCT justificativo) = 1 THEN max(justificativo)
         ELSE 'Seleccioná una recomendación para ver por qué el motor la propone.' END AS justificativo_seleccionado,
       {T.sql_thousands('count(*)')} || ' recomendaciones · ' || {T.sql_thousands('round(sum(ganancia))')}
       || ' USD de margen incremental estimado · ' || {T.sql_thousands('round(sum(valor_rescate))')}
       || ' USD de stock crítico rescatado' || CASE WHEN sum(en_borde_de_soporte) > 0 THEN ' · '
       || CAST(sum(en_borde_de_soporte) AS VARCHAR) || ' requieren test controlado antes de generalizar' ELSE '' END AS titular
       FROM reco_txt GROUP BY 1""", "reco_txt"))
def of23(spark, sf_dir):
    r = recommendations(model(spark, sf_dir))
    r = r.withColumn("justificativo", justification(r))
    g = r.groupBy(*P.SEGMENT).agg(
        F.round(F.avg("d"), 9).alias("descuento_recomendado"), F.round(F.sum("ganancia"), 4).alias("ganancia_estimada"),
        F.round(F.sum("valor_rescate"), 4).alias("stock_rescatado"), F.count(F.lit(1)).alias("recomendaciones_activas"),
        F.sum("en_borde_de_soporte").cast("bigint").alias("requieren_test"),
        X.selected_value("justificativo", "Seleccioná una recomendación para ver por qué el motor la propone.")
        .alias("justificativo_seleccionado"),
        F.sum("ganancia").alias("_g"), F.sum("valor_rescate").alias("_v"))
    t = F.col("requieren_test")
    return g.select(*P.SEGMENT, "descuento_recomendado", "ganancia_estimada", "stock_rescatado", "recomendaciones_activas",
                    "requieren_test", "justificativo_seleccionado",
                    F.concat(T.thousands(F.col("recomendaciones_activas")), F.lit(" recomendaciones · "),
                             T.thousands(F.round("_g")), F.lit(" USD de margen incremental estimado · "),
                             T.thousands(F.round("_v")), F.lit(" USD de stock crítico rescatado"),
                             F.when(t > 0, F.concat(F.lit(" · "), t.cast("string"),
                                                    F.lit(" requieren test controlado antes de generalizar")))
                             .otherwise(F.lit(""))).alias("titular"))
