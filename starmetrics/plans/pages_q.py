"""Report-page datasets V-1 … V-13: one ``visual(category, measures, filters)`` per page visual."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmetrics.functions import exprs as X
from starmetrics.operators import measures as M
from starmetrics.operators.star import model
from starmetrics.plans.catalog import query
from starmetrics.plans.oracle import sql
from starmetrics.plans import measures_ops_q, windows_q  # noqa: F401  (their CTEs are used here)
from starmetrics.plans.templates_q import fve

def NET():
    return F.sum(F.col("importe_usd_c") * F.col("signo"))


def visual(m, fact: str, category: list[str], measures: dict[str, Column], filters: Column | None = None) -> DataFrame:
    """One page visual: filter (slicers) → join the dimensions it needs → group by the category."""
    df = M.enrich(m, getattr(m, fact), category)
    if filters is not None:
        df = df.filter(filters)
    return df.groupBy(*category).agg(*[c.alias(n) for n, c in measures.items()])


@query("v01_executive_net_vs_target_by_month", sql(
    """SELECT anio_mes, a.neto_c, b.objetivo_c, CAST(a.neto_c AS DOUBLE) / nullif(CAST(b.objetivo_c AS DOUBLE), 0) AS cumplimiento
       FROM (SELECT anio_mes, CAST(sum(importe_usd_c * signo) AS BIGINT) AS neto_c FROM fv GROUP BY 1) a
       FULL OUTER JOIN (SELECT anio_mes, CAST(sum(objetivo_importe_c) AS BIGINT) AS objetivo_c FROM objetivos GROUP BY 1) b
       USING (anio_mes)""", "fv", "objetivos"))
def v01(spark, sf_dir):
    m = model(spark, sf_dir)
    a = visual(m, "fact_ventas", ["anio_mes"], {"neto_c": NET().cast("bigint")})
    b = visual(m, "fact_objetivos", ["anio_mes"], {"objetivo_c": F.sum("objetivo_importe_c").cast("bigint")})
    return M.drill_across([a, b], ["anio_mes"]).withColumn("cumplimiento", X.safe_div("neto_c", "objetivo_c"))


@query("v01_top10_brands_filtered_by_country", sql(
    """SELECT p.marca, CAST(sum(fv.importe_usd_c * fv.signo) AS BIGINT) AS neto_c FROM fv JOIN dim_producto p USING (id_producto)
       JOIN dim_filial f ON f.id_filial = fv.id_filial WHERE f.region = 'AMERICA' GROUP BY 1
       ORDER BY neto_c DESC, p.marca LIMIT 10""", "fv", "dim_producto", "dim_filial"))
def v01b(spark, sf_dir):
    m = model(spark, sf_dir)
    d = M.enrich(m, m.fact_ventas, ["marca", "region"]).filter(F.col("region") == "AMERICA")
    return (d.groupBy("marca").agg(NET().cast("bigint").alias("neto_c"))
            .orderBy(F.col("neto_c").desc(), F.col("marca")).limit(10))


@query("v02_pvm_variation_by_month", sql(
    """SELECT a.anio_mes, a.v - b.v AS variacion_c FROM (SELECT anio_mes, CAST(sum(importe_usd_c * signo) AS BIGINT) AS v
       FROM fv GROUP BY 1) a JOIN (SELECT anio_mes + 100 AS anio_mes, CAST(sum(importe_usd_c * signo) AS BIGINT) AS v
       FROM fv GROUP BY 1) b USING (anio_mes)""", "fv"))
def v02(spark, sf_dir):
    m = model(spark, sf_dir)
    a = visual(m, "fact_ventas", ["anio_mes"], {"v": NET().cast("bigint")})
    b = a.select((F.col("anio_mes") + 100).alias("anio_mes"), F.col("v").alias("v0"))
    return a.join(b, "anio_mes").select("anio_mes", (F.col("v") - F.col("v0")).alias("variacion_c"))


@query("v03_sellin_vs_sellout_by_month", sql(
    """SELECT anio_mes, a.unidades, b.sellout_u FROM (SELECT anio_mes, CAST(sum(unidades * signo) AS BIGINT) AS unidades
       FROM fv GROUP BY 1) a FULL OUTER JOIN (SELECT anio_mes, CAST(sum(unidades_sellout) AS BIGINT) AS sellout_u
       FROM sellout GROUP BY 1) b USING (anio_mes)""", "fv", "sellout"))
def v03(spark, sf_dir):
    m = model(spark, sf_dir)
    a = visual(m, "fact_ventas", ["anio_mes"], {"unidades": F.sum(F.col("unidades") * F.col("signo")).cast("bigint")})
    b = visual(m, "fact_sellout", ["anio_mes"], {"sellout_u": F.sum("unidades_sellout").cast("bigint")})
    return M.drill_across([a, b], ["anio_mes"])


@query("v04_customer_product_month_detail", sql(
    """SELECT id_cliente, id_producto, anio_mes, CAST(sum(importe_usd_c * signo) AS BIGINT) AS neto_c,
       CAST(sum(unidades * signo) AS BIGINT) AS unidades FROM fv GROUP BY 1, 2, 3""", "fv"))
def v04(spark, sf_dir):
    return visual(model(spark, sf_dir), "fact_ventas", ["id_cliente", "id_producto", "anio_mes"],
                  {"neto_c": NET().cast("bigint"), "unidades": F.sum(F.col("unidades") * F.col("signo")).cast("bigint")})


@query("v05_offer_investment_by_segment", sql(
    """SELECT c.segmento, CAST(sum(CASE WHEN o.aceptada = 1 THEN o.unidades_ofertadas * p.precio_lista_c * o.descuento_pct_int
       ELSE 0 END) AS BIGINT) AS inversion_cpct, CAST(count(*) AS BIGINT) AS ofertas
       FROM ofertas o JOIN dim_producto p USING (id_producto) JOIN dim_cliente c USING (id_cliente) GROUP BY 1""",
    "ofertas", "dim_producto", "dim_cliente"))
def v05(spark, sf_dir):
    m = model(spark, sf_dir)
    inv = F.sum(F.when(F.col("aceptada") == 1, F.col("unidades_ofertadas") * F.col("precio_lista_c")
                       * F.col("descuento_pct_int")).otherwise(0)).cast("bigint")
    d = M.enrich(m, m.fact_ofertas, ["segmento", "precio_lista_c"])
    return d.groupBy("segmento").agg(inv.alias("inversion_cpct"), F.count(F.lit(1)).alias("ofertas"))


@query("v07_investment_real_vs_forecast_by_branch", sql(
    "SELECT id_filial, CAST(sum(real_cpct) AS BIGINT) AS real_cpct, CAST(sum(forecast_cpct) AS BIGINT) AS forecast_cpct "
    "FROM inv_series GROUP BY 1", "inv_series"))
def v07(spark, sf_dir):
    from starmetrics.plans.measures_ops_q import investment_series
    s = investment_series(model(spark, sf_dir))
    return s.groupBy("id_filial").agg(F.sum("real_cpct").cast("bigint").alias("real_cpct"),
                                      F.sum("forecast_cpct").cast("bigint").alias("forecast_cpct"))


@query("v08_service_level_by_month_and_carrier", sql(
    """SELECT anio_mes, id_transportista, CAST(sum(lineas) AS BIGINT) AS lineas,
       CAST(sum(lineas_otif) AS DOUBLE) / nullif(CAST(sum(lineas) AS DOUBLE), 0) AS otif_pct FROM fv GROUP BY 1, 2""", "fv"))
def v08(spark, sf_dir):
    g = visual(model(spark, sf_dir), "fact_ventas", ["anio_mes", "id_transportista"],
               {"lineas": F.sum("lineas").cast("bigint"), "_o": F.sum("lineas_otif")})
    return g.select("anio_mes", "id_transportista", "lineas", X.safe_div("_o", "lineas").alias("otif_pct"))


@query("v09_returns_by_reason_pareto", sql(
    """SELECT motivo, d, CAST(sum(d) OVER (ORDER BY d DESC, motivo ROWS UNBOUNDED PRECEDING) AS DOUBLE)
       / CAST(sum(d) OVER () AS DOUBLE) AS acumulado FROM (SELECT m.motivo, CAST(sum(r.importe_devuelto_usd_c) AS BIGINT) AS d
       FROM fdev r JOIN dim_motivo m USING (id_motivo) GROUP BY 1) t""", "fdev", "dim_motivo"))
def v09(spark, sf_dir):
    from pyspark.sql import Window
    g = visual(model(spark, sf_dir), "fact_devoluciones", ["motivo"],
               {"d": F.sum("importe_devuelto_usd_c").cast("bigint")})
    # seven reasons: the cumulative window runs over seven rows
    w = Window.orderBy(F.col("d").desc(), F.col("motivo")).rowsBetween(Window.unboundedPreceding, 0)
    t = g.agg(F.sum("d").alias("_t"))
    return g.crossJoin(t).select("motivo", "d", (F.sum("d").over(w).cast("double") / F.col("_t").cast("double"))
                                 .alias("acumulado"))


@query("v10_risk_by_band", sql(
    """SELECT banda_riesgo, CAST(count(*) AS BIGINT) AS pedidos, round(sum(prob * CAST(importe_usd_c AS DOUBLE)), 2) AS importe_en_riesgo_c
       FROM risk_bands GROUP BY 1""", "risk_bands"))
def v10(spark, sf_dir):
    from starmetrics.plans.windows_q import risk_bands
    b = risk_bands(model(spark, sf_dir))
    return b.groupBy("banda_riesgo").agg(F.count(F.lit(1)).alias("pedidos"),
                                         F.round(F.sum(F.col("prob") * F.col("importe_usd_c").cast("double")), 2)
                                         .alias("importe_en_riesgo_c"))


@query("v10_order_work_list_by_probability", sql(
    """SELECT id_linea, id_cliente, prob, banda_riesgo FROM risk_bands""",
    "risk_bands"))
def v10b(spark, sf_dir):
    from starmetrics.plans.windows_q import risk_bands
    b = risk_bands(model(spark, sf_dir))
    return b.select("id_linea", "id_cliente", "prob", "banda_riesgo").orderBy(F.col("prob").desc(), "id_linea")


@query("v11_stock_coverage_by_depot_and_class", sql(
    """SELECT s.id_deposito, p.atc1, CAST(sum(s.dias_cobertura * s.stock_unidades) AS DOUBLE)
       / nullif(CAST(sum(s.stock_unidades) AS DOUBLE), 0) AS dias_cobertura FROM stock s JOIN dim_producto p USING (id_producto)
       WHERE s.anio_mes = (SELECT max(anio_mes) FROM stock) GROUP BY 1, 2""", "stock", "dim_producto"))
def v11(spark, sf_dir):
    m = model(spark, sf_dir)
    g = M.enrich(m, M.last_snapshot(m.fact_stock), ["atc1"]).groupBy("id_deposito", "atc1").agg(
        F.sum(F.col("dias_cobertura") * F.col("stock_unidades")).alias("_c"), F.sum("stock_unidades").alias("_s"))
    return g.select("id_deposito", "atc1", X.safe_div("_c", "_s").alias("dias_cobertura"))


@query("v12_matrix_pivot_otif", sql(
    """SELECT id_filial, id_transportista, CAST(sum(lineas_otif) AS DOUBLE) / nullif(CAST(sum(lineas) AS DOUBLE), 0) AS otif_pct
       FROM fv GROUP BY 1, 2""", "fv"))
def v12(spark, sf_dir):
    """Branch × carrier matrix as cells (branch, carrier, OTIF): any branch or carrier of the data has its cells."""
    g = visual(model(spark, sf_dir), "fact_ventas", ["id_filial", "id_transportista"],
               {"_o": F.sum("lineas_otif"), "_n": F.sum("lineas")})
    return g.select("id_filial", "id_transportista", X.safe_div("_o", "_n").alias("otif_pct"))


# ---------------- the other visuals of the pages: one fact, one category each ----------------
_INV_SQL = "CASE WHEN aceptada = 1 THEN unidades_ofertadas * precio_lista_c * descuento_pct_int ELSE 0 END"

#: key → (fact, its CTE, categories, [(measure, SQL over the fact joined to its dimensions)], slicer)
_VISUALS = {
    "v01_net_sales_by_branch": ("fact_ventas", "fv", ["id_filial"], [("neto_c", "importe_usd_c * signo")], None),
    "v01_net_sales_by_sku_in_one_class": ("fact_ventas", "fv", ["id_producto", "atc1"], [("neto_c", "importe_usd_c * signo")], "atc1 = 'PROMO'"),
    "v03_sellout_and_market_by_sku": ("fact_sellout", "sellout", ["id_producto"],
                                      [("sellout_u", "unidades_sellout"), ("mercado_u", "unidades_mercado")], None),
    "v04_customer_detail": ("fact_ventas", "fv", ["id_cliente", "canal", "segmento"],
                            [("neto_c", "importe_usd_c * signo"), ("unidades", "unidades * signo"), ("lineas", "lineas")], None),
    "v05_offer_investment_by_month": ("fact_ofertas", "ofertas", ["anio_mes"], [("inversion_cpct", _INV_SQL), ("aceptadas", "aceptada")], None),
    "v05_offer_investment_by_instrument": ("fact_ofertas", "ofertas", ["tipo_oferta"], [("inversion_cpct", _INV_SQL), ("aceptadas", "aceptada")], None),
    "v05_offer_investment_by_branch": ("fact_ofertas", "ofertas", ["id_filial"], [("inversion_cpct", _INV_SQL), ("aceptadas", "aceptada")], None),
    "v08_service_level_by_branch": ("fact_ventas", "fv", ["id_filial"], [("lineas", "lineas"), ("otif", "lineas_otif"), ("completas", "lineas_completas")], None),
    "v09_returns_by_area": ("fact_devoluciones", "fdev", ["area_responsable"], [("devuelto_c", "importe_devuelto_usd_c")], None),
    "v09_returns_by_branch": ("fact_devoluciones", "fdev", ["id_filial"], [("devuelto_c", "importe_devuelto_usd_c")], None),
    "v09_return_rate_vs_volume_by_customer": ("fact_ventas", "fv", ["id_cliente"],
                                              [("unidades", "unidades"), ("devueltas", "unidades_devueltas")], "tipo_documento = 'FC'"),
    "v11_expiry_value_by_sku": ("fact_stock", "stock", ["id_producto"],
                                [("por_vencer_u", "unidades_por_vencer_180d"), ("riesgo_c", "unidades_por_vencer_180d * costo_std_c")], None),
}
_DIM_CTES = {"products": ("dim_producto", "id_producto"), "customers": ("dim_cliente", "id_cliente"), "reasons": ("dim_motivo", "id_motivo")}


def _visual_query(key, fact, cte, by, measures, slicer):
    """Registers one visual: DataFrame calls on one side, plain SQL on the other."""
    import re
    names = {w for _, e in measures for w in re.findall(r"[a-z_]\w*", e)} | set(by)
    dims = sorted({M.DIM_OF[n][0] for n in names if n in M.DIM_OF and M.DIM_OF[n][0] in _DIM_CTES and n != M.DIM_OF[n][1]} - ({"customers"} if "id_filial" in by else set()))
    joins = "".join(f" LEFT JOIN (SELECT * FROM {_DIM_CTES[d][0]}) {d} USING ({_DIM_CTES[d][1]})" for d in dims)
    where = [w for w in (slicer, "anio_mes = (SELECT max(anio_mes) FROM stock)" if cte == "stock" else None) if w]
    cols = ", ".join(f"f.{c}" if c not in M.DIM_OF or M.DIM_OF[c][0] not in dims else c for c in by)
    text = (f"SELECT {cols}, " + ", ".join(f"CAST(sum({e}) AS BIGINT) AS {n}" for n, e in measures)
            + f" FROM {cte} f{joins}" + (f" WHERE {' AND '.join(where)}" if where else "") + " GROUP BY ALL")

    @query(key, sql(text, cte, *[_DIM_CTES[d][0] for d in dims]))
    def build(spark, sf_dir):
        m = model(spark, sf_dir)
        df = getattr(m, fact)
        df = M.last_snapshot(df) if fact == "fact_stock" else df
        df = M.enrich(m, df, sorted(names))
        df = df.filter(slicer) if slicer else df
        return df.groupBy(*by).agg(*[F.sum(F.expr(e)).cast("bigint").alias(n) for n, e in measures])


for _key, _spec in _VISUALS.items():
    _visual_query(_key, *_spec)


def auto_summary(df: DataFrame, date: str, measures: list[str], dims: list[str]) -> DataFrame:
    """V-13: for any star: the first five measures over time and by two text dimensions,
    as long rows (vista, clave, medida, valor)."""
    ms = measures[:5]
    frames = []
    views = [("tiempo", (F.year(date) * 100 + F.month(date)).cast("string"))] + [(d, F.col(d).cast("string")) for d in dims[:2]]
    for name, key in views:
        g = df.groupBy(key.alias("clave")).agg(*[F.sum(c).cast("bigint").alias(c) for c in ms])
        stack = ", ".join(f"'{c}', {c}" for c in ms)
        frames.append(g.selectExpr(f"'{name}' AS vista", "clave", f"stack({len(ms)}, {stack}) AS (medida, valor)"))
    return reduce(DataFrame.unionByName, frames)


_AUTO_MS = ["unidades", "importe_usd_c", "costo_usd_c", "importe_local_c", "lineas"]


@query("v13_automatic_summary_pages", sql(
    " UNION ALL ".join(
        f"SELECT '{v}' AS vista, CAST({k} AS VARCHAR) AS clave, '{c}' AS medida, CAST(sum({c}) AS BIGINT) AS valor "
        f"FROM fve GROUP BY 2" for v, k in [("tiempo", "year(fecha) * 100 + month(fecha)"), ("canal", "canal"),
                                              ("region", "region")] for c in _AUTO_MS), "fve"))
def v13(spark, sf_dir):
    return auto_summary(fve(model(spark, sf_dir)), "fecha", _AUTO_MS, ["canal", "region"])
