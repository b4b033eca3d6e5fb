"""Registered aggregation and top-k queries A-2 … A-14, O-3 … O-6."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from starmetrics import config as K
from starmetrics.functions import exprs as X
from starmetrics.operators import measures as M
from starmetrics.operators.star import model
from starmetrics.plans.catalog import query
from starmetrics.plans.oracle import sql
from starmetrics.plans.windows_q import fc_lines, line_risk
from starmetrics.sources import binding as B


@query("a02_offers_with_conditional_accepted_aggregate", sql(
    """SELECT o.anio_mes, o.id_filial, CAST(count(*) AS BIGINT) AS ofertas,
       CAST(sum(o.unidades_ofertadas * p.precio_lista_c) AS BIGINT) AS valor_c,
       CAST(coalesce(sum(o.aceptada), 0) AS BIGINT) AS aceptadas,
       CAST(coalesce(sum(CASE WHEN o.aceptada = 1 THEN o.unidades_ofertadas * p.precio_lista_c * o.descuento_pct_int
            ELSE 0 END), 0) AS BIGINT) AS inversion_c_pct
       FROM ofertas o LEFT JOIN dim_producto p USING (id_producto) GROUP BY 1, 2""", "ofertas", "dim_producto"))
def a02(spark, sf_dir):
    m = model(spark, sf_dir)
    o = m.fact_ofertas.join(m.products.select("id_producto", "precio_lista_c"), "id_producto", "left")
    val = F.col("unidades_ofertadas") * F.col("precio_lista_c")
    return o.groupBy("anio_mes", "id_filial").agg(
        F.count(F.lit(1)).alias("ofertas"), F.sum(val).cast("bigint").alias("valor_c"),
        F.coalesce(F.sum("aceptada"), F.lit(0)).cast("bigint").alias("aceptadas"),
        F.coalesce(F.sum(F.when(F.col("aceptada") == 1, val * F.col("descuento_pct_int")).otherwise(F.lit(0))),
                   F.lit(0)).cast("bigint").alias("inversion_c_pct"))


def latest_stock(m):
    """A-3: state at the latest snapshot month (semi-additive stock)."""
    s = m.fact_stock
    last = s.agg(F.max("anio_mes").alias("anio_mes"))
    return (s.join(F.broadcast(last), "anio_mes", "left_semi")
            .groupBy("id_deposito", "id_producto")
            .agg(F.sum("stock_unidades").cast("bigint").alias("stock_unidades"),
                 F.sum("valor_stock_c").cast("bigint").alias("valor_stock_c"),
                 F.max("dias_cobertura").alias("dias_cobertura")))


@query("a03_latest_snapshot_stock", sql(
    """SELECT id_deposito, id_producto, CAST(sum(stock_unidades) AS BIGINT) AS stock_unidades,
       CAST(sum(valor_stock_c) AS BIGINT) AS valor_stock_c, max(dias_cobertura) AS dias_cobertura
       FROM stock WHERE anio_mes = (SELECT max(anio_mes) FROM stock) GROUP BY 1, 2""", "stock"))
def a03(spark, sf_dir):
    return latest_stock(model(spark, sf_dir))


def base_demand(m, days: int = 180, min_customers: int = 3):
    """A-4: Σunits/6 (min 1) over the last ``days`` days per segment × product,
    kept when at least ``min_customers`` distinct customers bought."""
    s = m.sellin.join(m.customers.select("id_cliente", "segmento"), "id_cliente")
    last = m.sellin.agg(F.max("fecha").alias("_u"))
    s = s.crossJoin(F.broadcast(last)).filter(F.col("fecha") > F.date_sub("_u", days))
    g = s.groupBy("segmento", "id_producto").agg(
        F.greatest(F.sum("unidades").cast("double") / 6.0, F.lit(1.0)).alias("q_base"),
        F.count_distinct("id_cliente").alias("n_clientes"))
    return g.filter(F.col("n_clientes") >= min_customers)


BASE_DEMAND_SQL = """SELECT c.segmento, s.id_producto, greatest(CAST(sum(s.unidades) AS DOUBLE) / 6.0, 1.0) AS q_base,
    CAST(count(DISTINCT s.id_cliente) AS BIGINT) AS n_clientes FROM sellin s JOIN dim_cliente c USING (id_cliente)
    WHERE s.fecha > (SELECT max(fecha) FROM sellin) - INTERVAL 180 DAY GROUP BY 1, 2
    HAVING count(DISTINCT s.id_cliente) >= 3"""


@query("a04_base_demand_last_180_days", sql(BASE_DEMAND_SQL, "sellin", "dim_cliente"))
def a04(spark, sf_dir):
    return base_demand(model(spark, sf_dir))


@query("a05_sku_contribution_to_branch_margin", sql(
    """SELECT id_filial, id_producto, margen_c, CAST(margen_c AS DOUBLE) / nullif(CAST(sum(margen_c) OVER
       (PARTITION BY id_filial) AS DOUBLE), 0) AS contribucion FROM (SELECT s.id_filial, s.id_producto,
       CAST(sum((s.importe_usd_c - p.costo_std_c * s.unidades) * s.signo) AS BIGINT) AS margen_c
       FROM sellin s JOIN dim_producto p USING (id_producto)
       WHERE s.fecha > (SELECT max(fecha) FROM sellin) - INTERVAL 180 DAY GROUP BY 1, 2) t""", "sellin", "dim_producto"))
def a05(spark, sf_dir):
    """The last 180 days at standard cost."""
    m = model(spark, sf_dir)
    last = m.sellin.agg(F.max("fecha").alias("_u"))
    s = m.sellin.crossJoin(F.broadcast(last)).filter(F.col("fecha") > F.date_sub("_u", 180))
    s = s.join(m.products.select("id_producto", "costo_std_c"), "id_producto")
    g = s.groupBy("id_filial", "id_producto").agg(
        F.sum((F.col("importe_usd_c") - F.col("costo_std_c") * F.col("unidades")) * F.col("signo")).cast("bigint").alias("margen_c"))
    tot = g.groupBy("id_filial").agg(F.sum("margen_c").alias("_t"))
    return g.join(tot, "id_filial").select("id_filial", "id_producto", "margen_c",
                                           X.safe_div("margen_c", "_t").alias("contribucion"))


@query("a06_mean_risk_by_branch_product", sql(
    """SELECT id_filial, id_producto, round(avg(prob), 12) AS riesgo_medio FROM line_risk GROUP BY 1, 2""",
    "line_risk"))
def a06(spark, sf_dir):
    lr = line_risk(model(spark, sf_dir))
    return lr.groupBy("id_filial", "id_producto").agg(F.round(F.avg("prob"), 12).alias("riesgo_medio"))


@query("a07_cumulative_purchases_before_month", sql(
    """SELECT id_cliente, id_producto, anio_mes, u, CAST(coalesce(sum(u) OVER (PARTITION BY id_cliente, id_producto
       ORDER BY anio_mes ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS compras_previas
       FROM (SELECT id_cliente, id_producto, anio_mes, CAST(sum(unidades) AS BIGINT) AS u FROM fc GROUP BY ALL) g""",
    "fc"))
def a07(spark, sf_dir):
    g = fc_lines(model(spark, sf_dir)).groupBy("id_cliente", "id_producto", "anio_mes") \
        .agg(F.sum("unidades").cast("bigint").alias("u"))
    w = Window.partitionBy("id_cliente", "id_producto").orderBy("anio_mes").rowsBetween(Window.unboundedPreceding, -1)
    return g.withColumn("compras_previas", F.coalesce(F.sum("u").over(w), F.lit(0)).cast("bigint"))


@query("a08_pearson_correlation", sql(
    """SELECT p.atc1, round(corr(CAST(f.descuento_pct_int AS DOUBLE), CAST(f.unidades AS DOUBLE)), 9) AS correlacion
       FROM fc f JOIN dim_producto p USING (id_producto) GROUP BY 1""", "fc", "dim_producto"))
def a08(spark, sf_dir):
    m = model(spark, sf_dir)
    d = fc_lines(m).join(m.products.select("id_producto", "atc1"), "id_producto")
    return d.groupBy("atc1").agg(F.round(F.corr(F.col("descuento_pct_int").cast("double"),
                                                F.col("unidades").cast("double")), 9).alias("correlacion"))


@query("a09_exact_distinct_counts", sql(
    """SELECT id_filial, CAST(count(DISTINCT id_cliente) AS BIGINT) AS clientes,
       CAST(count(DISTINCT id_producto) AS BIGINT) AS skus FROM sellin GROUP BY 1""", "sellin"))
def a09(spark, sf_dir):
    return model(spark, sf_dir).sellin.groupBy("id_filial").agg(
        F.count_distinct("id_cliente").alias("clientes"), F.count_distinct("id_producto").alias("skus"))


@query("a10_exact_median_and_percentile", sql(
    """SELECT p.atc1, quantile_cont(s.unidades, 0.5) AS mediana, quantile_cont(s.unidades, 0.9) AS p90
       FROM sellin s JOIN dim_producto p USING (id_producto) GROUP BY 1
       UNION ALL SELECT 'TOTAL', quantile_cont(unidades, 0.5), quantile_cont(unidades, 0.9) FROM sellin""",
    "sellin", "dim_producto"))
def a10(spark, sf_dir):
    m = model(spark, sf_dir)
    s = m.sellin.join(m.products.select("id_producto", "atc1"), "id_producto")
    aggs = [F.percentile("unidades", 0.5).alias("mediana"), F.percentile("unidades", 0.9).alias("p90")]
    return s.groupBy("atc1").agg(*aggs).unionByName(m.sellin.agg(*aggs).select(F.lit("TOTAL").alias("atc1"), "*"))


def sales_monitor(spark, sf_dir):
    """A-13: sales, buyers, gross, downloads, count per plan, commission, net."""
    rec = B.sale_records(spark, sf_dir).dropDuplicates(["id"])
    ev = B.read_table(spark, sf_dir, "events")
    dl = ev.filter(F.col("event_type") == "click").agg(F.count(F.lit(1)).alias("descargas"))
    g = rec.agg(F.count(F.lit(1)).alias("ventas"), F.count_distinct("email").alias("clientes"),
                F.sum("usd_c").cast("bigint").alias("bruto_c"),
                F.count_if(F.col("plan") == "perpetua").alias("ventas_perpetua"),
                F.count_if(F.col("plan") == "mensual").alias("ventas_mensual"))
    com = F.round(F.col("bruto_c").cast("double") * K.COMMISSION_RATE * K.COMMISSION_TAX).cast("bigint")
    return g.crossJoin(dl).withColumn("comision_c", com).withColumn("neto_c", F.col("bruto_c") - F.col("comision_c"))


@query("a13_sales_monitor", sql(
    f"""SELECT ventas, clientes, bruto_c, ventas_perpetua, ventas_mensual, descargas,
       CAST(round(CAST(bruto_c AS DOUBLE) * {K.COMMISSION_RATE} * {K.COMMISSION_TAX}) AS BIGINT) AS comision_c,
       bruto_c - CAST(round(CAST(bruto_c AS DOUBLE) * {K.COMMISSION_RATE} * {K.COMMISSION_TAX}) AS BIGINT) AS neto_c
       FROM (SELECT CAST(count(*) AS BIGINT) AS ventas, CAST(count(DISTINCT email) AS BIGINT) AS clientes,
       CAST(sum(usd_c) AS BIGINT) AS bruto_c, CAST(count(*) FILTER (WHERE plan = 'perpetua') AS BIGINT) AS ventas_perpetua,
       CAST(count(*) FILTER (WHERE plan = 'mensual') AS BIGINT) AS ventas_mensual FROM (SELECT DISTINCT * FROM sales_rec) r) a
       CROSS JOIN (SELECT CAST(count(*) AS BIGINT) AS descargas FROM events WHERE event_type = 'click') b""", "sales_rec"))
def a13(spark, sf_dir):
    return sales_monitor(spark, sf_dir)


@query("a14_hierarchy_subtotals_rollup", sql(
    """SELECT region, pais, CAST(GROUPING(region) * 2 + GROUPING(pais) AS INT) AS nivel,
       CAST(sum(importe_usd_c * signo) AS BIGINT) AS neto_c,
       CAST(sum((importe_usd_c - costo_usd_c) * signo) AS DOUBLE) / nullif(CAST(sum(importe_usd_c * signo) AS DOUBLE), 0)
       AS margen_pct FROM fv JOIN dim_filial USING (id_filial) GROUP BY ROLLUP (region, pais)""", "fv", "dim_filial"))
def a14(spark, sf_dir):
    m = model(spark, sf_dir)
    d = M.enrich(m, m.fact_ventas, ["region", "pais"])
    g = d.rollup("region", "pais").agg(
        F.grouping_id("region", "pais").cast("int").alias("nivel"),
        F.sum(F.col("importe_usd_c") * F.col("signo")).cast("bigint").alias("neto_c"),
        F.sum((F.col("importe_usd_c") - F.col("costo_usd_c")) * F.col("signo")).alias("_m"))
    return g.select("region", "pais", "nivel", "neto_c", X.safe_div("_m", "neto_c").alias("margen_pct"))


# ---------------- top-k ----------------
@query("o03_top1_reason_with_share", sql(
    """SELECT id_filial, id_motivo AS motivo_principal, CAST(d AS DOUBLE) / CAST(t AS DOUBLE) AS participacion FROM
       (SELECT id_filial, id_motivo, d, sum(d) OVER (PARTITION BY id_filial) AS t,
        row_number() OVER (PARTITION BY id_filial ORDER BY d DESC, id_motivo) AS rn FROM
        (SELECT id_filial, id_motivo, sum(importe_devuelto_usd_c) AS d FROM fdev GROUP BY 1, 2) g) x WHERE rn = 1""",
    "fdev"))
def o03(spark, sf_dir):
    d = model(spark, sf_dir).fact_devoluciones
    g = d.groupBy("id_filial", "id_motivo").agg(F.sum("importe_devuelto_usd_c").alias("d"))
    top = g.groupBy("id_filial").agg(
        F.max_by("id_motivo", F.struct(F.col("d"), -F.col("id_motivo"))).alias("motivo_principal"),
        F.max("d").alias("_dmax"), F.sum("d").alias("_t"))
    return top.select("id_filial", "motivo_principal", X.safe_div("_dmax", "_t").alias("participacion"))


def top_n_members(df, member: str, measure, n: int):
    """O-4 / G-11: the n members with the largest measure (total order: measure desc, member)."""
    g = df.groupBy(member).agg(measure.alias("_v"))
    return g.orderBy(F.col("_v").desc(), F.col(member)).limit(n).select(member)


@query("o04_top_n_then_aggregate", sql(
    """SELECT anio_mes, CAST(sum(importe_usd_c * signo) AS BIGINT) AS neto_top10_c FROM fv WHERE id_producto IN
       (SELECT id_producto FROM fv GROUP BY 1 ORDER BY sum(importe_usd_c * signo) DESC, id_producto LIMIT 10)
       GROUP BY 1""", "fv"))
def o04(spark, sf_dir):
    fv = model(spark, sf_dir).fact_ventas
    net = F.sum(F.col("importe_usd_c") * F.col("signo"))
    top = top_n_members(fv, "id_producto", net, 10)
    # n rows: the semi join broadcasts a side bounded by n
    return (fv.join(F.broadcast(top), "id_producto", "left_semi").groupBy("anio_mes")
            .agg(net.cast("bigint").alias("neto_top10_c")))


@query("o05_sort_by_column_month_names", sql(
    """SELECT mes_nombre, mes_nro, CAST(row_number() OVER (ORDER BY mes_nro) AS INT) AS orden FROM
       (SELECT DISTINCT list_extract(['Ene','Feb','Mar','Abr','May','Jun','Jul','Ago','Sep','Oct','Nov','Dic'],
        CAST(month(fecha) AS INT)) AS mes_nombre, CAST(month(fecha) AS INT) AS mes_nro FROM sellin) t""", "sellin"))
def o05(spark, sf_dir):
    c = model(spark, sf_dir).sellin.select(F.month("fecha").alias("mes_nro")).distinct()
    names = F.array(*[F.lit(x) for x in B.MONTH_NAMES])
    # at most 12 rows
    return c.select(F.element_at(names, F.col("mes_nro")).alias("mes_nombre"), "mes_nro",
                    F.row_number().over(Window.orderBy("mes_nro")).cast("int").alias("orden"))


@query("o06_latest_sales_with_downloads", sql(
    """SELECT r.id, r.email, r.usd_c, CAST(r.cuando AS VARCHAR) AS cuando, r.plan,
       CAST(coalesce(d.descargas, 0) AS BIGINT) AS descargas FROM (SELECT DISTINCT * FROM sales_rec) r
       LEFT JOIN (SELECT user_id AS email, count(*) AS descargas FROM events WHERE event_type = 'click' GROUP BY 1) d
       USING (email) ORDER BY r.cuando DESC, r.id DESC LIMIT 10""", "sales_rec"))
def o06(spark, sf_dir):
    rec = B.sale_records(spark, sf_dir).dropDuplicates(["id"])
    ev = B.read_table(spark, sf_dir, "events")
    dl = ev.filter(F.col("event_type") == "click").groupBy(F.col("user_id").alias("email")) \
        .agg(F.count(F.lit(1)).alias("descargas"))
    return (rec.join(dl, "email", "left").orderBy(F.col("cuando").desc(), F.col("id").desc()).limit(10)
            .select("id", "email", "usd_c", F.col("cuando").cast("string").alias("cuando"), "plan",
                    F.coalesce("descargas", F.lit(0)).cast("bigint").alias("descargas")))
