"""Registered source/sink (S-*) and streaming (T-*) queries.

Each query writes to a fresh folder under the shared checkpoint folder,
reads the result back and returns it, so the oracle checks the round trip.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmetrics.operators import quality as Q
from starmetrics.operators.star import model
from starmetrics.plans import quality_q as QQ
from starmetrics.plans.catalog import query
from starmetrics.plans.oracle import sql
from starmetrics.sources import binding as B
from starmetrics.sources import sinks as S
from starmetrics.sources import snapshots
from starmetrics.streaming import sales as T

_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


@query("s01_read_tables_by_name", sql(" UNION ALL ".join(
    f"SELECT '{t}' AS tabla, CAST(count(*) AS BIGINT) AS filas FROM {t}" for t in _TABLES)))
def s01(spark, sf_dir):
    frames = [B.read_table(spark, sf_dir, t).agg(F.count(F.lit(1)).alias("filas")).select(F.lit(t).alias("tabla"), "filas")
              for t in _TABLES]
    return reduce(DataFrame.unionByName, frames)


_BY_MONTH_SQL = sql("""SELECT anio_mes, CAST(count(*) AS BIGINT) AS filas, CAST(sum(importe_usd_c * signo) AS BIGINT) AS neto_c
    FROM fv GROUP BY 1""", "fv")


def _by_month(df):
    return df.groupBy(F.col("anio_mes").cast("int").alias("anio_mes")).agg(
        F.count(F.lit(1)).alias("filas"), F.sum(F.col("importe_usd_c") * F.col("signo")).cast("bigint").alias("neto_c"))


@query("s02_write_partitioned_layer", _BY_MONTH_SQL)
def s02(spark, sf_dir):
    fv = model(spark, sf_dir).fact_ventas
    path = S.write_layer(fv, S.scratch(spark, "star-fact_ventas"), ["anio_mes"])
    return _by_month(spark.read.parquet(path))


_SO_SCHEMA = "anio_mes int, id_filial int, id_producto bigint, unidades_sellout bigint, importe_sellout_c bigint"


@query("s03_s04_csv_write_and_typed_read", sql(
    "SELECT anio_mes, id_filial, id_producto, unidades_sellout, importe_sellout_c FROM sellout", "sellout"))
def s03(spark, sf_dir):
    so = model(spark, sf_dir).fact_sellout.select("anio_mes", "id_filial", "id_producto", "unidades_sellout",
                                                  "importe_sellout_c")
    path = S.write_csv(so, S.scratch(spark, "out-sellout-csv"))
    return S.read_csv(spark, path, _SO_SCHEMA)


@query("s05_json_run_summary", sql(
    """SELECT CAST(count(*) AS BIGINT) AS controles_ejecutados,
       CAST(count(*) FILTER (WHERE estado = 'OK') AS BIGINT) AS controles_ok,
       CAST(count(*) FILTER (WHERE estado = 'ALERTA') AS BIGINT) AS controles_alerta,
       CAST(count(*) FILTER (WHERE estado = 'CRÍTICO') AS BIGINT) AS controles_criticos FROM reg""",
    *QQ._NEEDS, extra=QQ._EXTRA))
def s05(spark, sf_dir):
    summ = Q.summary(Q.registry(model(spark, sf_dir)))
    path = S.write_json(summ.coalesce(1), S.scratch(spark, "out-resumen-json"))
    return spark.read.schema("controles_ejecutados bigint, controles_ok bigint, controles_alerta bigint, "
                             "controles_criticos bigint").json(path)


@query("s06_switchable_source_business_columns", sql(
    'SELECT p_partkey AS "Id producto", p_brand AS "Marca", p_type AS "Clase" FROM part'))
def s06(spark, sf_dir):
    return S.load(spark, "part", "parquet", location=sf_dir,
                  columns={"p_partkey": "Id producto", "p_brand": "Marca", "p_type": "Clase"})


def _late_corrections(fv):
    """(old, extract, stale): the table as loaded 20 days before the last date, with lines after the cutoff still
    uncorrected and some later cancelled; the extract of the last 45 days; an incomplete extract older than the table.
    The cutoff falls inside a month."""
    last = fv.agg(F.max("fecha").alias("_u"))
    dated = fv.crossJoin(F.broadcast(last))
    after = F.col("fecha") > F.date_sub("_u", 45)
    old = dated.filter(F.col("fecha") <= F.date_sub("_u", 20))
    old = old.withColumn("importe_usd_c", F.when(after, F.col("importe_usd_c") + 1).otherwise(F.col("importe_usd_c")).cast("bigint"))
    cancelled = old.filter(after & (F.col("id_cliente") % 7 == 0))
    stale = old.filter((F.col("id_producto") % 3 == 0) & (F.col("fecha") <= F.date_sub("_u", 30)))
    return old.unionByName(cancelled).drop("_u"), dated.filter(after).drop("_u"), stale.drop("_u")


@query("s08_incremental_refresh_last_45_days", _BY_MONTH_SQL)
def s08(spark, sf_dir):
    old, extract, stale = _late_corrections(model(spark, sf_dir).fact_ventas)
    path = S.scratch(spark, "star-fact_ventas-incr")
    snapshots.create(old, path, "fecha", "anio_mes")
    S.incremental_refresh(spark, extract, path, "fecha", 45, "anio_mes")
    S.incremental_refresh(spark, stale, path, "fecha", 45, "anio_mes")  # takes nothing away
    return _by_month(snapshots.read(spark, path))


_REC_SQL = sql("""SELECT DISTINCT id, email, usd_c, CAST(cuando AS VARCHAR) AS cuando, plan FROM sales_rec""", "sales_rec")


def _with_retries(spark, sf_dir):
    """Sale records in two deliveries; the second repeats a third of the first."""
    rec = B.sale_records(spark, sf_dir)
    folder = S.scratch(spark, "in-sales")
    rec.filter(F.col("id") % 5 != 0).write.parquet(folder + "/a")
    return rec, folder, lambda: rec.filter((F.col("id") % 5 == 0) | (F.col("id") % 3 == 0)).write.parquet(folder + "/b")


def _txt(df):
    return df.select("id", "email", "usd_c", F.col("cuando").cast("string").alias("cuando"), "plan")


@query("s09_keyed_idempotent_save", _REC_SQL)
def s09(spark, sf_dir):
    rec = B.sale_records(spark, sf_dir)
    retries = rec.filter(F.col("id") % 3 == 0)
    return _txt(S.keyed_save(rec, retries, "id", "cuando"))


@query("s10_normalise_payment_notices", sql(
    """SELECT event_id AS id, 'pago' AS tipo, CASE WHEN CAST(json_extract_string(props, '$.k') AS BIGINT) % 2 = 0
       THEN 'perpetua' ELSE 'mensual' END AS plan, user_id AS email, CAST(round(value * 100) AS BIGINT) AS usd_c,
       CAST(ts AS VARCHAR) AS cuando FROM events WHERE event_type = 'purchase' AND json_extract_string(props, '$.k') IS NOT NULL
       UNION ALL SELECT event_id, 'suscripcion', 'mensual', user_id, CAST(round(value * 100) AS BIGINT), CAST(ts AS VARCHAR)
       FROM events WHERE event_type = 'signup' AND value > 0"""))
def s10(spark, sf_dir):
    n = S.normalise_notices(B.read_table(spark, sf_dir, "events"))
    return n.withColumn("cuando", F.col("cuando").cast("string"))


@query("t01_retry_safe_stream_ingestion", _REC_SQL)
def t01(spark, sf_dir):
    _, folder, deliver = _with_retries(spark, sf_dir)
    out, ckpt = S.scratch(spark, "out-sales-dedup"), S.scratch(spark, "ckpt-dedup")
    T.run_dedup(spark, folder + "/*", out, ckpt)
    deliver()  # the job is started again on the same output and checkpoint
    return _txt(T.run_dedup(spark, folder + "/*", out, ckpt))


@query("t02_live_sales_monitor_running_totals", sql(
    """SELECT plan, CAST(count(*) AS BIGINT) AS ventas, CAST(sum(usd_c) AS BIGINT) AS bruto_c
       FROM (SELECT DISTINCT * FROM sales_rec) r GROUP BY 1""", "sales_rec"))
def t02(spark, sf_dir):
    _, folder, deliver = _with_retries(spark, sf_dir)
    out, ckpt = S.scratch(spark, "out-monitor"), S.scratch(spark, "ckpt-monitor")
    T.run_monitor(spark, folder + "/*", out, ckpt)
    deliver()
    got = T.run_monitor(spark, folder + "/*", out, ckpt)
    return got.select("plan", F.col("ventas").cast("bigint"), F.col("bruto_c").cast("bigint"))


@query("t03_incremental_fact_refresh_stream", _BY_MONTH_SQL)
def t03(spark, sf_dir):
    fv = model(spark, sf_dir).fact_ventas.select("fecha", "anio_mes", "importe_usd_c", "signo", "id_cliente",
                                                 "id_producto", "tipo_documento")
    old, extract, stale = _late_corrections(fv)
    out = S.scratch(spark, "star-fact-stream")
    snapshots.create(old, out, "fecha", "anio_mes")
    folder, ckpt = S.scratch(spark, "in-fact-extract"), S.scratch(spark, "ckpt-incr")
    schema = ("fecha date, anio_mes int, importe_usd_c bigint, signo int, id_cliente bigint, id_producto bigint, "
              "tipo_documento string")
    run = lambda: T.run_incremental(spark, folder, schema, out, "fecha", 45, "anio_mes", ckpt)
    # two overlapping extracts in one trigger, then an older one that comes late
    wrong = extract.withColumn("importe_usd_c", (F.col("importe_usd_c") + 2).cast("bigint"))
    wrong.write.parquet(folder + "/extract=1")
    extract.write.parquet(folder + "/extract=2")
    run()
    stale.write.parquet(folder + "/extract=3")
    return _by_month(run())
