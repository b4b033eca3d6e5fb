"""Registered queries of the dimension and fact builders B-1 … B-11."""

from __future__ import annotations

from pyspark.sql import functions as F

from starmetrics.operators.star import model
from starmetrics.plans.catalog import query
from starmetrics.plans.oracle import sql
from starmetrics.sources import binding as B

_MONTHS_DUCK = "[" + ", ".join(f"'{m}'" for m in B.MONTH_NAMES) + "]"


def _s(c):
    return F.col(c).cast("string").alias(c)


@query("b01_calendar", sql(
    f"""SELECT CAST(d AS VARCHAR) AS fecha, CAST(year(d) AS INT) AS anio, CAST(month(d) AS INT) AS mes_nro,
       list_extract({_MONTHS_DUCK}, CAST(month(d) AS INT)) AS mes_nombre, strftime(d, '%Y-%m') AS anio_mes,
       CAST(year(d) * 100 + month(d) AS INT) AS anio_mes_orden, 'Q' || CAST(quarter(d) AS VARCHAR) AS trimestre,
       CAST(year(d) AS VARCHAR) || '-Q' || CAST(quarter(d) AS VARCHAR) AS anio_trimestre,
       CAST(isodow(d) AS INT) AS dia_semana, CAST(isodow(d) <= 5 AS INT) AS es_habil,
       CAST(d <= hasta AS INT) AS es_pasado, CAST(d = last_day(d) AS INT) AS es_ultimo_dia_mes,
       CAST(month(d) IN (5, 6, 7, 8) AS INT) AS temporada_respiratoria
       FROM (SELECT CAST(unnest(generate_series(make_date(CAST(year(min(fecha)) AS INT), 1, 1),
             make_date(CAST(year(max(fecha)) AS INT), 12, 31), INTERVAL 1 DAY)) AS DATE) AS d,
             max(fecha) AS hasta FROM sellin) t""", "sellin"))
def b01(spark, sf_dir):
    c = model(spark, sf_dir).calendar
    return c.select(_s("fecha"), *[x for x in c.columns if x != "fecha"])


@query("b02_return_reason_dim", sql(
    "SELECT id_motivo, cod_motivo, motivo, area_responsable, es_evitable FROM dim_motivo", "dim_motivo"))
def b02(spark, sf_dir):
    return model(spark, sf_dir).reasons.select("id_motivo", "cod_motivo", "motivo", "area_responsable",
                                               "es_evitable")


@query("b03_offer_type_dim", sql("SELECT * FROM dim_tipo_oferta", "dim_tipo_oferta"))
def b03(spark, sf_dir):
    return model(spark, sf_dir).offer_types


@query("b04_unknown_member", sql("SELECT * FROM dim_transportista", "dim_transportista"))
def b04(spark, sf_dir):
    return model(spark, sf_dir).carriers


@query("b05_flatten_representative", sql(
    "SELECT id_cliente, cod_cliente, canal, segmento, id_filial, nombre_rep, supervisor FROM dim_cliente",
    "dim_cliente"))
def b05(spark, sf_dir):
    return model(spark, sf_dir).customers.select("id_cliente", "cod_cliente", "canal", "segmento", "id_filial",
                                                 "nombre_rep", "supervisor")


FV_COLS = ["fecha", "id_cliente", "id_producto", "id_filial", "id_deposito", "id_transportista", "id_tipo_oferta",
           "tipo_documento", "unidades", "importe_usd_c", "costo_usd_c", "importe_local_c", "lineas",
           "lineas_otif", "lineas_completas", "lead_time_dias_x_linea", "unidades_devueltas",
           "importe_devuelto_usd_c", "lineas_devueltas", "lineas_en_revision", "dias_a_vencer_x_linea"]


@query("b06_fact_ventas", sql(
    "SELECT " + ", ".join("CAST(fecha AS VARCHAR) AS fecha" if c == "fecha" else c for c in FV_COLS)
    + " FROM (SELECT fv.*, t.id_tipo_oferta FROM fv LEFT JOIN dim_tipo_oferta t ON t.cod_tipo_oferta = fv.tipo_oferta) x",
    "fv", "dim_tipo_oferta"))
def b06(spark, sf_dir):
    fv = model(spark, sf_dir).fact_ventas
    return fv.select(*[_s(c) if c == "fecha" else c for c in FV_COLS])


@query("b07_fact_devoluciones", sql(
    """SELECT CAST(fecha AS VARCHAR) AS fecha, id_cliente, id_producto, id_filial, id_transportista, id_motivo,
       unidades_devueltas, importe_devuelto_usd_c, lineas FROM fdev""", "fdev"))
def b07(spark, sf_dir):
    d = model(spark, sf_dir).fact_devoluciones
    return d.select(_s("fecha"), "id_cliente", "id_producto", "id_filial", "id_transportista", "id_motivo",
                    "unidades_devueltas", "importe_devuelto_usd_c", "lineas")


OF_COLS = ["id_oferta", "fecha", "id_cliente", "id_producto", "id_filial", "id_tipo_oferta", "descuento_pct_int",
           "unidades_ofertadas", "cobertura_cliente_dias", "aceptada"]


@query("b08_fact_ofertas", sql(
    "SELECT " + ", ".join("CAST(fecha AS VARCHAR) AS fecha" if c == "fecha" else c for c in OF_COLS)
    + " FROM ofertas", "ofertas"))
def b08(spark, sf_dir):
    o = model(spark, sf_dir).fact_ofertas
    return o.select(*[_s(c) if c == "fecha" else c for c in OF_COLS])


@query("b09_month_facts_shared_date", sql(
    """SELECT 'sellout' AS hecho, CAST(fecha AS VARCHAR) AS fecha, CAST(count(*) AS BIGINT) AS filas,
       CAST(sum(unidades_sellout) AS BIGINT) AS u1, CAST(sum(importe_mercado_c) AS BIGINT) AS u2
       FROM sellout GROUP BY fecha
       UNION ALL SELECT 'objetivos', CAST(fecha AS VARCHAR), CAST(count(*) AS BIGINT),
       CAST(sum(objetivo_unidades) AS BIGINT), CAST(sum(objetivo_importe_c) AS BIGINT) FROM objetivos GROUP BY fecha
       UNION ALL SELECT 'stock', CAST(fecha AS VARCHAR), CAST(count(*) AS BIGINT),
       CAST(sum(stock_unidades) AS BIGINT), CAST(sum(valor_stock_c) AS BIGINT) FROM stock GROUP BY fecha
       UNION ALL SELECT 'tipo_cambio', CAST(make_date(CAST(anio_mes / 100 AS INT), CAST(anio_mes % 100 AS INT), 1)
       AS VARCHAR), CAST(count(*) AS BIGINT), CAST(sum(tc_x100) AS BIGINT), CAST(0 AS BIGINT) FROM fx GROUP BY anio_mes""",
    "sellout", "objetivos", "stock", "fx"))
def b09(spark, sf_dir):
    m = model(spark, sf_dir)

    def agg(df, name, a, b):
        return df.groupBy(_s("fecha")).agg(F.count(F.lit(1)).alias("filas"), F.sum(a).cast("bigint").alias("u1"),
                                           F.sum(b).cast("bigint").alias("u2")) \
            .select(F.lit(name).alias("hecho"), "fecha", "filas", "u1", "u2")

    fx = m.fx.withColumn("fecha", F.make_date((F.col("anio_mes") / 100).cast("int"),
                                              (F.col("anio_mes") % 100).cast("int"), F.lit(1))) \
        .withColumn("cero", F.lit(0))
    return (agg(m.fact_sellout, "sellout", "unidades_sellout", "importe_mercado_c")
            .unionByName(agg(m.fact_objetivos, "objetivos", "objetivo_unidades", "objetivo_importe_c"))
            .unionByName(agg(m.fact_stock, "stock", "stock_unidades", "valor_stock_c"))
            .unionByName(agg(fx, "tipo_cambio", "tc_x100", "cero")))


@query("b11_grain_reduction_evidence", sql(
    """SELECT (SELECT CAST(count(*) AS BIGINT) FROM sellin) AS filas_linea,
       (SELECT CAST(count(*) AS BIGINT) FROM fv) AS filas_analiticas,
       (SELECT CAST(count(DISTINCT id_linea) AS BIGINT) FROM sellin) AS id_linea_eliminados,
       1.0 - CAST((SELECT count(*) FROM fv) AS DOUBLE) / CAST((SELECT count(*) FROM sellin) AS DOUBLE)
       AS reduccion""", "sellin", "fv"))
def b11(spark, sf_dir):
    m = model(spark, sf_dir)
    a = m.sellin.agg(F.count(F.lit(1)).alias("filas_linea"),
                     F.count_distinct("id_linea").alias("id_linea_eliminados"))
    b = m.fact_ventas.agg(F.count(F.lit(1)).alias("filas_analiticas"))
    return a.crossJoin(b).select(
        "filas_linea", "filas_analiticas", "id_linea_eliminados",
        (F.lit(1.0) - F.col("filas_analiticas").cast("double") / F.col("filas_linea").cast("double"))
        .alias("reduccion"))
