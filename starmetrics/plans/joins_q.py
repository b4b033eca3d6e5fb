"""Registered join queries J-1 … J-13 and set operations U-1 … U-4."""

from __future__ import annotations

from pyspark.sql import functions as F

from starmetrics.functions import exprs as X
from starmetrics.operators import joins as J
from starmetrics.operators import measures as M
from starmetrics.operators.star import model
from starmetrics.plans.catalog import query
from starmetrics.plans.oracle import sql


def _months(m):
    """Distinct contiguous month range of the sales (yyyymm INT), built from min/max."""
    b = m.sellin.agg(F.min("mes_idx").alias("a"), F.max("mes_idx").alias("b"))
    return b.select(F.explode(F.sequence("a", "b")).alias("i")).select(X.index_to_month("i").alias("anio_mes"))


_MONTHS_SQL = """SELECT CAST(floor(i / 12) * 100 + i % 12 + 1 AS INT) AS anio_mes
    FROM (SELECT unnest(generate_series(min(mes_idx), max(mes_idx))) AS i FROM sellin) t"""


@query("j01_validated_many_to_one_join", sql(
    "SELECT s.id_linea, f.tc_x100 FROM sellin s LEFT JOIN fx f USING (anio_mes, moneda)", "sellin", "fx"))
def j01(spark, sf_dir):
    m = model(spark, sf_dir)
    return J.validated_left_join(m.sellin.select("id_linea", "anio_mes", "moneda"), m.fx, ["anio_mes", "moneda"]) \
        .select("id_linea", "tc_x100")


@query("j02_inner_join_two_keys", sql(
    """SELECT s.moneda, CAST(count(*) AS BIGINT) AS lineas, CAST(sum(f.tc_x100) AS BIGINT) AS suma_tc
       FROM sellin s JOIN fx f USING (anio_mes, moneda) GROUP BY 1""", "sellin", "fx"))
def j02(spark, sf_dir):
    m = model(spark, sf_dir)
    j = m.sellin.select("anio_mes", "moneda").join(m.fx, ["anio_mes", "moneda"], "inner")
    return j.groupBy("moneda").agg(F.count(F.lit(1)).alias("lineas"), F.sum("tc_x100").cast("bigint").alias("suma_tc"))


@query("j03_star_enrichment", sql(
    """SELECT s.id_linea, p.atc1, p.cadena_frio, c.canal, c.segmento, f.region, t.transportista, t.control_frio
       FROM sellin s LEFT JOIN dim_producto p USING (id_producto) LEFT JOIN dim_cliente c USING (id_cliente)
       LEFT JOIN dim_filial f ON f.id_filial = s.id_filial LEFT JOIN dim_transportista t USING (id_transportista)
       WHERE s.tipo_documento = 'FC'""", "sellin", "dim_producto", "dim_cliente", "dim_filial", "dim_transportista"))
def j03(spark, sf_dir):
    m = model(spark, sf_dir)
    s = m.sellin.filter(F.col("tipo_documento") == "FC").select("id_linea", "id_producto", "id_cliente",
                                                                 "id_filial", "id_transportista")
    return (s.join(m.products.select("id_producto", "atc1", "cadena_frio"), "id_producto", "left")
            .join(m.customers.select("id_cliente", "canal", "segmento"), "id_cliente", "left")
            .join(m.branches.select("id_filial", "region"), "id_filial", "left")
            .join(m.carriers.select("id_transportista", "transportista", "control_frio"), "id_transportista", "left")
            .select("id_linea", "atc1", "cadena_frio", "canal", "segmento", "region", "transportista",
                    "control_frio"))


MISSING_SQL = sql(
    f"""SELECT g.anio_mes, g.id_filial, f.cod_filial, f.pais FROM
       (SELECT m.anio_mes, b.id_filial FROM ({_MONTHS_SQL}) m CROSS JOIN (SELECT id_filial FROM dim_filial) b
        EXCEPT SELECT DISTINCT anio_mes, id_filial FROM sellout) g JOIN dim_filial f USING (id_filial)""",
    "sellin", "dim_filial", "sellout")


def missing_branch_months(m):
    miss = J.expected_grid_missing(_months(m), m.branches.select("id_filial"), m.fact_sellout,
                                   ["anio_mes", "id_filial"])
    return miss.join(m.branches.select("id_filial", "cod_filial", "pais"), "id_filial") \
        .select("anio_mes", "id_filial", "cod_filial", "pais")


@query("j04_u01_expected_grid_missing_branch_months", MISSING_SQL)
def j04(spark, sf_dir):
    return missing_branch_months(model(spark, sf_dir))


@query("j05_referential_orphans", sql(
    """SELECT (SELECT CAST(count(*) AS BIGINT) FROM dedup d WHERE NOT EXISTS (SELECT 1 FROM dim_producto p WHERE p.id_producto = d.id_producto))
       AS huerfanos_producto,
       (SELECT CAST(count(*) AS BIGINT) FROM dedup d WHERE NOT EXISTS (SELECT 1 FROM dim_cliente c WHERE c.id_cliente = d.id_cliente))
       AS huerfanos_cliente,
       (SELECT CAST(count(*) AS BIGINT) FROM ofertas WHERE id_cliente NOT IN
        (SELECT id_cliente FROM dim_cliente WHERE segmento = 'A')) AS ofertas_fuera_segmento_a""",
    "dedup", "dim_producto", "dim_cliente", "ofertas"))
def j05(spark, sf_dir):
    m = model(spark, sf_dir)
    # among the lines before any join: the clean ones have lost those without a customer
    a = J.orphans(m.deduped, m.products, "id_producto").agg(F.count(F.lit(1)).alias("huerfanos_producto"))
    b = J.orphans(m.deduped, m.customers, "id_cliente").agg(F.count(F.lit(1)).alias("huerfanos_cliente"))
    c = J.orphans(m.fact_ofertas, m.customers.filter(F.col("segmento") == "A"), "id_cliente") \
        .agg(F.count(F.lit(1)).alias("ofertas_fuera_segmento_a"))
    return a.crossJoin(b).crossJoin(c)


@query("j08_related_list_value", sql(
    """SELECT p.atc1, CAST(sum(fv.unidades * fv.signo * p.precio_lista_c) AS BIGINT) AS venta_a_lista_c
       FROM fv JOIN dim_producto p USING (id_producto) GROUP BY 1""", "fv", "dim_producto"))
def j08(spark, sf_dir):
    m = model(spark, sf_dir)
    d = M.enrich(m, m.fact_ventas, ["atc1", "precio_lista_c"])
    return d.groupBy("atc1").agg(F.sum(F.col("unidades") * F.col("signo") * F.col("precio_lista_c"))
                                 .cast("bigint").alias("venta_a_lista_c"))


@query("j09_role_playing_order_date", sql(
    """SELECT 'envio' AS rol, CAST(year(fecha) * 100 + month(fecha) AS INT) AS anio_mes,
       CAST(sum(importe_usd_c * signo) AS BIGINT) AS ventas_netas_c FROM sellin GROUP BY 2
       UNION ALL SELECT 'pedido', CAST(year(fecha_pedido) * 100 + month(fecha_pedido) AS INT),
       CAST(sum(importe_usd_c * signo) AS BIGINT) FROM sellin GROUP BY 2""", "sellin"))
def j09(spark, sf_dir):
    s = model(spark, sf_dir).sellin
    net = F.sum(F.col("importe_usd_c") * F.col("signo")).cast("bigint").alias("ventas_netas_c")
    a = s.groupBy(X.month_int("fecha").alias("anio_mes")).agg(net).select(F.lit("envio").alias("rol"), "*")
    b = s.groupBy(X.month_int("fecha_pedido").alias("anio_mes")).agg(net).select(F.lit("pedido").alias("rol"), "*")
    return a.unionByName(b)


@query("j10_prior_year_self_join", sql(
    """SELECT a.anio_mes, a.ventas_netas_c, b.ventas_netas_c AS ventas_netas_aa_c
       FROM g a LEFT JOIN g b ON b.anio_mes = a.anio_mes - 100""", "fv", extra={"g": (["fv"],
    "SELECT anio_mes, CAST(sum(importe_usd_c * signo) AS BIGINT) AS ventas_netas_c FROM fv GROUP BY 1")}))
def j10(spark, sf_dir):
    fv = model(spark, sf_dir).fact_ventas
    g = fv.groupBy("anio_mes").agg(F.sum(F.col("importe_usd_c") * F.col("signo")).cast("bigint")
                                   .alias("ventas_netas_c"))
    prev = g.select((F.col("anio_mes") + 100).alias("anio_mes"), F.col("ventas_netas_c").alias("ventas_netas_aa_c"))
    return g.join(prev, "anio_mes", "left")


@query("j11_row_level_security", sql(
    """SELECT s.email, fv.id_filial, CAST(sum(fv.importe_usd_c * fv.signo) AS BIGINT) AS ventas_netas_c
       FROM fv JOIN seguridad s ON s.id_filial = fv.id_filial WHERE s.email = 'user1@example.com'
       GROUP BY 1, 2""", "fv", "seguridad"))
def j11(spark, sf_dir):
    m = model(spark, sf_dir)
    user = "user1@example.com"
    f = J.restrict_by_bridge(m.fact_ventas, m.security, user)
    return f.groupBy("id_filial").agg(F.sum(F.col("importe_usd_c") * F.col("signo")).cast("bigint")
                                      .alias("ventas_netas_c")).select(F.lit(user).alias("email"), "*")


@query("j12_scalar_total_cross_join", sql(
    """SELECT g.id_filial, g.v AS ventas_netas_c, t.total AS total_c,
       CAST(g.v AS DOUBLE) / CAST(t.total AS DOUBLE) AS participacion
       FROM (SELECT id_filial, CAST(sum(importe_usd_c * signo) AS BIGINT) AS v FROM fv GROUP BY 1) g
       CROSS JOIN (SELECT CAST(sum(importe_usd_c * signo) AS BIGINT) AS total FROM fv) t""", "fv"))
def j12(spark, sf_dir):
    fv = model(spark, sf_dir).fact_ventas
    net = F.sum(F.col("importe_usd_c") * F.col("signo")).cast("bigint")
    g = fv.groupBy("id_filial").agg(net.alias("ventas_netas_c"))
    t = fv.agg(net.alias("total_c"))          # one row: the cross join is a broadcast of one row
    return g.crossJoin(t).withColumn("participacion", X.safe_div("ventas_netas_c", "total_c"))


REL_SQL = " UNION ALL ".join(
    f"""SELECT '{name}' AS relacion, (SELECT CAST(count(*) AS BIGINT) FROM {many}) AS filas_muchos,
        CAST(count(*) AS BIGINT) AS filas_uno, CAST(count(DISTINCT {okey}) AS BIGINT) AS claves_distintas,
        CAST(count(*) - count(DISTINCT {okey}) AS BIGINT) AS claves_repetidas,
        (SELECT CAST(count(*) AS BIGINT) FROM {many} WHERE {mkey} NOT IN (SELECT {okey} FROM {one} WHERE {okey} IS NOT NULL)
         OR {mkey} IS NULL) AS huerfanos,
        CAST(count(*) = count(DISTINCT {okey}) AS INT) AS uno_es_unico FROM {one}"""
    for name, many, mkey, one, okey in [
        ("ventas-producto", "fv", "id_producto", "dim_producto", "id_producto"),
        ("ventas-cliente", "fv", "id_cliente", "dim_cliente", "id_cliente"),
        ("ventas-transportista", "fv", "id_transportista", "dim_transportista", "id_transportista"),
        ("cliente-filial", "dim_cliente", "id_filial", "dim_filial", "id_filial"),
        ("sellout-sku", "sellout", "id_producto", "fv", "id_producto"),
    ])


@query("j13_relationship_cardinality_profile", sql(
    REL_SQL, "fv", "dim_producto", "dim_cliente", "dim_transportista", "dim_filial", "sellout"))
def j13(spark, sf_dir):
    m = model(spark, sf_dir)
    return J.relationship_profile([
        ("ventas-producto", m.fact_ventas, "id_producto", m.products, "id_producto"),
        ("ventas-cliente", m.fact_ventas, "id_cliente", m.customers, "id_cliente"),
        ("ventas-transportista", m.fact_ventas, "id_transportista", m.carriers, "id_transportista"),
        ("cliente-filial", m.customers, "id_filial", m.branches, "id_filial"),
        ("sellout-sku", m.fact_sellout, "id_producto", m.fact_ventas, "id_producto"),
    ])


# ---------------- set operations ----------------
@query("u02_expected_fx_months_minus_rates", sql(
    f"""SELECT m.anio_mes, b.moneda FROM ({_MONTHS_SQL}) m CROSS JOIN (SELECT moneda FROM dim_filial) b
       EXCEPT SELECT anio_mes, moneda FROM fx""", "sellin", "dim_filial", "fx"))
def u02(spark, sf_dir):
    m = model(spark, sf_dir)
    grid = _months(m).crossJoin(m.branches.select("moneda"))
    return grid.exceptAll(m.fx.select("anio_mes", "moneda")).distinct()


@query("u03_union_all_frames", sql(
    """SELECT 'FC' AS tipo, CAST(count(*) AS BIGINT) AS filas FROM sellin WHERE tipo_documento = 'FC'
       UNION ALL SELECT 'NC', CAST(count(*) AS BIGINT) FROM sellin WHERE tipo_documento = 'NC'
       UNION ALL SELECT 'OF', CAST(count(*) AS BIGINT) FROM ofertas""", "sellin", "ofertas"))
def u03(spark, sf_dir):
    m = model(spark, sf_dir)
    s = m.sellin
    cnt = F.count(F.lit(1)).alias("filas")
    return (s.filter(F.col("tipo_documento") == "FC").agg(cnt).select(F.lit("FC").alias("tipo"), "filas")
            .unionByName(s.filter(F.col("tipo_documento") == "NC").agg(cnt).select(F.lit("NC").alias("tipo"), "filas"))
            .unionByName(m.fact_ofertas.agg(cnt).select(F.lit("OF").alias("tipo"), "filas")))


@query("u04_distinct_pairs", sql("SELECT DISTINCT anio_mes, id_filial FROM sellin", "sellin"))
def u04(spark, sf_dir):
    return model(spark, sf_dir).sellin.select("anio_mes", "id_filial").distinct()
