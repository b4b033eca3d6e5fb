"""Registered template queries G-1 … G-11 and exercise patterns E-1 … E-5."""

from __future__ import annotations

from pyspark.sql import functions as F

from starmetrics.functions import exprs as X
from starmetrics.operators import measures as M
from starmetrics.operators import templates as G
from starmetrics.operators.star import model
from starmetrics.plans.catalog import query
from starmetrics.plans.oracle import CTES, sql

def NETV():
    return F.col("importe_usd_c") * F.col("signo")

CTES["fve"] = (["fv", "dim_cliente", "dim_filial", "dim_producto"], """SELECT fv.*, importe_usd_c * signo AS neto,
    c.canal, c.segmento, f.region, f.pais, p.atc1 FROM fv JOIN dim_cliente c USING (id_cliente)
    JOIN dim_filial f ON f.id_filial = fv.id_filial JOIN dim_producto p USING (id_producto)""")


def fve(m):
    return M.enrich(m, m.fact_ventas, ["canal", "segmento", "region", "pais", "atc1"])


@query("g01_total", sql("SELECT canal, CAST(sum(neto) AS BIGINT) AS total FROM fve GROUP BY 1", "fve"))
def g01(spark, sf_dir):
    return G.total(fve(model(spark, sf_dir)), NETV(), ["canal"]).withColumn("total", F.col("total").cast("bigint"))


@query("g02_average", sql(
    "SELECT p.atc1, avg(s.importe_usd_c) AS promedio FROM sellin s JOIN dim_producto p USING (id_producto) GROUP BY 1",
    "sellin", "dim_producto"))
def g02(spark, sf_dir):
    m = model(spark, sf_dir)
    return G.average(M.enrich(m, m.sellin, ["atc1"]), F.col("importe_usd_c"), ["atc1"])


@query("g03_min_max", sql(
    "SELECT p.atc1, min(s.unidades) AS minimo, max(s.unidades) AS maximo FROM sellin s JOIN dim_producto p USING (id_producto) GROUP BY 1",
    "sellin", "dim_producto"))
def g03(spark, sf_dir):
    m = model(spark, sf_dir)
    return G.min_max(M.enrich(m, m.sellin, ["atc1"]), F.col("unidades"), ["atc1"])


@query("g04_distinct_count", sql(
    "SELECT region, CAST(count(DISTINCT id_cliente) AS BIGINT) AS distintos FROM fve GROUP BY 1", "fve"))
def g04(spark, sf_dir):
    return G.distinct_count(fve(model(spark, sf_dir)), "id_cliente", ["region"])


@query("g05_row_count", sql("SELECT tipo_documento, CAST(count(*) AS BIGINT) AS filas FROM sellin GROUP BY 1", "sellin"))
def g05(spark, sf_dir):
    return G.row_count(model(spark, sf_dir).sellin, ["tipo_documento"])


@query("g06_pct_of_total", sql(
    """SELECT canal, CAST(sum(neto) AS BIGINT) AS v, CAST(sum(neto) AS DOUBLE) / CAST(sum(sum(neto)) OVER () AS DOUBLE)
       AS pct_total FROM fve GROUP BY 1""", "fve"))
def g06(spark, sf_dir):
    return G.pct_of_total(fve(model(spark, sf_dir)), NETV(), ["canal"]).withColumn("v", F.col("v").cast("bigint"))


@query("g07_year_to_date", sql(
    """SELECT region, anio_mes, v, CAST(sum(v) OVER (PARTITION BY region, anio_mes // 100 ORDER BY anio_mes) AS BIGINT) AS ytd
       FROM (SELECT region, anio_mes, CAST(sum(neto) AS BIGINT) AS v FROM fve GROUP BY 1, 2) t""", "fve"))
def g07(spark, sf_dir):
    r = G.ytd(fve(model(spark, sf_dir)), NETV(), "fecha", ["region"])
    return r.select("region", "anio_mes", F.col("v").cast("bigint").alias("v"), F.col("ytd").cast("bigint").alias("ytd"))


@query("g08_variation_vs_previous_year", sql(
    """SELECT a.canal, a.anio_mes, a.v, b.v AS v_aa, CAST(a.v - b.v AS DOUBLE) / nullif(CAST(b.v AS DOUBLE), 0) AS var_pct
       FROM (SELECT canal, anio_mes, CAST(sum(neto) AS BIGINT) AS v FROM fve GROUP BY 1, 2) a
       LEFT JOIN (SELECT canal, anio_mes + 100 AS anio_mes, CAST(sum(neto) AS BIGINT) AS v FROM fve GROUP BY 1, 2) b
       USING (canal, anio_mes)""", "fve"))
def g08(spark, sf_dir):
    r = G.vs_previous_year(fve(model(spark, sf_dir)), NETV(), "fecha", ["canal"])
    return r.select("canal", "anio_mes", F.col("v").cast("bigint").alias("v"), F.col("v_aa").cast("bigint").alias("v_aa"),
                    "var_pct")


@query("g09_n_month_moving_average", sql(
    """SELECT region, anio_mes, v, avg(v) OVER (PARTITION BY region ORDER BY mi RANGE BETWEEN 2 PRECEDING AND CURRENT ROW)
       AS media_3m FROM (SELECT region, anio_mes, CAST(sum(neto) AS BIGINT) AS v,
       CAST((anio_mes // 100) * 12 + anio_mes % 100 - 1 AS INT) AS mi FROM fve GROUP BY 1, 2) t""", "fve"))
def g09(spark, sf_dir):
    r = G.moving_average(fve(model(spark, sf_dir)), NETV(), "fecha", 3, ["region"])
    return r.select("region", "anio_mes", F.col("v").cast("bigint").alias("v"), "media_3m")


@query("g10_dense_ranking", sql(
    """SELECT region, id_producto, v, CAST(dense_rank() OVER (PARTITION BY region ORDER BY v DESC) AS INT) AS ranking
       FROM (SELECT region, id_producto, CAST(sum(neto) AS BIGINT) AS v FROM fve GROUP BY 1, 2) t""", "fve"))
def g10(spark, sf_dir):
    r = G.dense_ranking(fve(model(spark, sf_dir)), NETV(), "id_producto", ["region"])
    return r.select("region", "id_producto", F.col("v").cast("bigint").alias("v"), F.col("ranking").cast("int"))


@query("g11_top_n_filter", sql(
    """SELECT id_producto, CAST(sum(neto) AS BIGINT) AS v FROM fve GROUP BY 1 ORDER BY v DESC, id_producto LIMIT 10""",
    "fve"))
def g11(spark, sf_dir):
    return G.top_n(fve(model(spark, sf_dir)), NETV(), "id_producto", 10).withColumn("v", F.col("v").cast("bigint"))


# ---------------- exercise patterns ----------------
@query("e01_safe_division_margin_pct", sql(
    """SELECT atc1, CAST(sum((importe_usd_c - costo_usd_c) * signo) AS DOUBLE) / nullif(CAST(sum(neto) AS DOUBLE), 0)
       AS margen_pct FROM fve GROUP BY 1""", "fve"))
def e01(spark, sf_dir):
    d = fve(model(spark, sf_dir))
    g = d.groupBy("atc1").agg(F.sum((F.col("importe_usd_c") - F.col("costo_usd_c")) * F.col("signo")).alias("_m"),
                              F.sum(NETV()).alias("_n"))
    return g.select("atc1", X.safe_div("_m", "_n").alias("margen_pct"))


@query("e02_context_override_fixed_segment", sql(
    """SELECT canal, CAST(sum(neto) AS BIGINT) AS neto, CAST(sum(CASE WHEN segmento = 'A' THEN neto ELSE 0 END) AS BIGINT)
       AS neto_segmento_a FROM fve GROUP BY 1""", "fve"))
def e02(spark, sf_dir):
    d = fve(model(spark, sf_dir))
    return d.groupBy("canal").agg(F.sum(NETV()).cast("bigint").alias("neto"),
                                  F.sum(F.when(F.col("segmento") == "A", NETV()).otherwise(0)).cast("bigint")
                                  .alias("neto_segmento_a"))


@query("e03_ratio_all_filters_of_one_table_removed", sql(
    """SELECT atc1, anio, v, CAST(v AS DOUBLE) / CAST(sum(v) OVER (PARTITION BY anio) AS DOUBLE) AS pct_todos_productos
       FROM (SELECT atc1, CAST(anio_mes // 100 AS INT) AS anio, CAST(sum(neto) AS BIGINT) AS v FROM fve GROUP BY 1, 2) t""",
    "fve"))
def e03(spark, sf_dir):
    d = fve(model(spark, sf_dir)).withColumn("anio", F.floor(F.col("anio_mes") / 100).cast("int"))
    g = d.groupBy("atc1", "anio").agg(F.sum(NETV()).cast("bigint").alias("v"))
    t = g.groupBy("anio").agg(F.sum("v").alias("_t"))
    return g.join(t, "anio").select("atc1", "anio", "v", X.safe_div("v", "_t").alias("pct_todos_productos"))


@query("e04_single_selected_value_else_varios", sql(
    """SELECT region, CASE WHEN count(DISTINCT pais) = 1 THEN max(pais) ELSE 'Varios' END AS pais,
       CASE WHEN count(DISTINCT canal) = 1 THEN max(canal) ELSE 'Varios' END AS canal FROM fve GROUP BY 1""", "fve"))
def e04(spark, sf_dir):
    d = fve(model(spark, sf_dir))
    return d.groupBy("region").agg(X.selected_value("pais", "Varios").alias("pais"),
                                   X.selected_value("canal", "Varios").alias("canal"))


@query("e05_new_customers_of_period", sql(
    """SELECT anio_mes, CAST(count(*) AS BIGINT) AS clientes_nuevos FROM (SELECT id_cliente,
       CAST(year(min(fecha)) * 100 + month(min(fecha)) AS INT) AS anio_mes FROM fv GROUP BY 1) t GROUP BY 1""", "fv"))
def e05(spark, sf_dir):
    fv = model(spark, sf_dir).fact_ventas
    first = fv.groupBy("id_cliente").agg(F.min("fecha").alias("_f"))
    return first.groupBy(X.month_int("_f").alias("anio_mes")).agg(F.count(F.lit(1)).alias("clientes_nuevos"))
