"""Registered measure queries (base measures, sales/variance, offers, logistics)."""

from __future__ import annotations

from pyspark.sql import functions as F

from starmetrics.operators import measures as M
from starmetrics.operators.star import model
from starmetrics.plans.catalog import query
from starmetrics.plans.oracle import sql

# --------------------------------------------------------------------------
# Ba-1 … Ba-8: base sales measures by region × month (flagship query)
# --------------------------------------------------------------------------
def BASE_PARTS():
    return {
        "ventas_brutas_c": M.GROSS_C(), "ventas_netas_c": M.NET_C(), "unidades": M.UNITS(), "costo_c": M.COST_C(),
        "venta_a_lista_c": F.sum(F.col("unidades") * F.col("signo") * F.col("precio_lista_c")),
    }


def base_measures(df, by):
    g = df.groupBy(*by).agg(*[p.cast("bigint").alias(n) for n, p in BASE_PARTS().items()])
    return g.select(
        *by, "ventas_brutas_c", "ventas_netas_c", "unidades", "costo_c",
        (F.col("ventas_netas_c") - F.col("costo_c")).alias("margen_bruto_c"),
        M.safe_div(F.col("ventas_netas_c") - F.col("costo_c"), F.col("ventas_netas_c")).alias("margen_bruto_pct"),
        M.safe_div(F.col("ventas_netas_c"), F.col("unidades") * 100).alias("precio_promedio_usd"),
        M.safe_div(F.col("venta_a_lista_c") - F.col("ventas_netas_c"), F.col("venta_a_lista_c"))
        .alias("descuento_efectivo_pct"))


def q_ba_base(spark, sf_dir):
    m = model(spark, sf_dir)
    df = M.enrich(m, m.fact_ventas, ["region", "precio_lista_c"])
    return base_measures(df, ["region", "anio_mes"])


BASE_SQL = sql("""SELECT region, anio_mes,
    CAST(sum(CASE WHEN tipo_documento = 'FC' THEN importe_usd_c ELSE 0 END) AS BIGINT) AS ventas_brutas_c,
    CAST(sum(importe_usd_c * signo) AS BIGINT) AS ventas_netas_c,
    CAST(sum(unidades * signo) AS BIGINT) AS unidades,
    CAST(sum(costo_usd_c * signo) AS BIGINT) AS costo_c,
    CAST(sum(importe_usd_c * signo) - sum(costo_usd_c * signo) AS BIGINT) AS margen_bruto_c,
    CAST(sum(importe_usd_c * signo) - sum(costo_usd_c * signo) AS DOUBLE)
        / nullif(CAST(sum(importe_usd_c * signo) AS DOUBLE), 0) AS margen_bruto_pct,
    CAST(sum(importe_usd_c * signo) AS DOUBLE) / nullif(CAST(sum(unidades * signo) * 100 AS DOUBLE), 0)
        AS precio_promedio_usd,
    CAST(sum(unidades * signo * precio_lista_c) - sum(importe_usd_c * signo) AS DOUBLE)
        / nullif(CAST(sum(unidades * signo * precio_lista_c) AS DOUBLE), 0) AS descuento_efectivo_pct
    FROM fv JOIN dim_filial USING (id_filial) JOIN dim_producto USING (id_producto)
    GROUP BY region, anio_mes""", "fv", "dim_filial", "dim_producto")

query("ba01_08_base_measures_region_month", BASE_SQL)(q_ba_base)


# --------------------------------------------------------------------------
# Va-2 over the geography hierarchy with subtotals (A-14) through the generic evaluate():
# two facts aggregated separately, rolled up, drill-across on the null-safe keys, ratio last.
# --------------------------------------------------------------------------
def q_target_rollup(spark, sf_dir):
    m = model(spark, sf_dir)
    ms = [
        M.Measure("ventas_netas_c", "fact_ventas", {"neto_c": M.NET_C().cast("bigint")}),
        M.Measure("objetivo_c", "fact_objetivos", {"obj_c": F.sum("objetivo_importe_c").cast("bigint")}),
        M.Measure("cumplimiento", "fact_ventas", {"neto_c": M.NET_C().cast("bigint")},
                  combine=M.ratio("neto_c", "obj_c")),
    ]
    return M.evaluate(m, ms, ["region", "pais"], rollup=True)


TARGET_ROLLUP_SQL = sql("""SELECT coalesce(a.region, b.region) AS region, coalesce(a.pais, b.pais) AS pais,
    coalesce(a.nivel, b.nivel) AS nivel, a.neto_c AS ventas_netas_c, b.obj_c AS objetivo_c,
    CAST(a.neto_c AS DOUBLE) / nullif(CAST(b.obj_c AS DOUBLE), 0) AS cumplimiento
    FROM (SELECT region, pais, CAST(GROUPING(region) * 2 + GROUPING(pais) AS INT) AS nivel,
            CAST(sum(importe_usd_c * signo) AS BIGINT) AS neto_c FROM fv JOIN dim_filial USING (id_filial)
            GROUP BY ROLLUP (region, pais)) a
    FULL OUTER JOIN (SELECT region, pais, CAST(GROUPING(region) * 2 + GROUPING(pais) AS INT) AS nivel,
            CAST(sum(objetivo_importe_c) AS BIGINT) AS obj_c FROM objetivos JOIN dim_filial USING (id_filial)
            GROUP BY ROLLUP (region, pais)) b
    ON a.region IS NOT DISTINCT FROM b.region AND a.pais IS NOT DISTINCT FROM b.pais AND a.nivel = b.nivel""",
    "fv", "objetivos", "dim_filial")

query("va02_a14_target_compliance_hierarchy_rollup", TARGET_ROLLUP_SQL)(q_target_rollup)
