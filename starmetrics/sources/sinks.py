"""Sources and sinks S-1 … S-10.

Every writer targets a folder under the session's shared checkpoint folder
(``spark.checkpoint.dir``, set by the cluster) unless a path is given; no
machine-local temporary folder is used.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmetrics.session import shared_dir
from starmetrics.sources import snapshots


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared folder for one write."""
    return shared_dir(spark, f"{name}-{uuid.uuid4().hex[:12]}")


def write_layer(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "overwrite") -> str:
    """S-2: write a stage/star table as Parquet, partitioned (dynamic partition overwrite)."""
    w = df.write.mode(mode).option("partitionOverwriteMode", "dynamic")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """S-3: CSV with header and declared types (no inference)."""
    return spark.read.schema(schema).option("header", True).csv(path)


def write_csv(df: DataFrame, path: str) -> str:
    """S-4: CSV deliverable with header."""
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def write_json(df: DataFrame, path: str) -> str:
    """S-5: run summary (a one-row aggregate) as JSON."""
    df.write.mode("overwrite").json(path)
    return path


def load(spark: SparkSession, table: str, source: str = "parquet", location: str | None = None,
         jdbc_url: str | None = None, columns: dict[str, str] | None = None) -> DataFrame:
    """S-6: switchable source converging on the same business columns.

    ``parquet``: ``{location}/{table}.parquet``; ``jdbc``: the database view
    ``table`` (not testable here).  ``columns`` maps physical → business name.
    """
    if source == "parquet":
        df = spark.read.parquet(f"{location.rstrip('/')}/{table}.parquet")
    elif source == "jdbc":
        df = spark.read.format("jdbc").option("url", jdbc_url).option("dbtable", table).load()
    else:
        raise ValueError(f"unknown source {source}")
    if columns:
        df = df.select(*[F.col(p).alias(b) for p, b in columns.items()])
    return df


def incremental_refresh(spark: SparkSession, extract: DataFrame, path: str, date_col: str, days: int,
                        partition_col: str) -> None:
    """S-8 / T-3: the last ``days`` days of ``extract`` replace those of the table at ``path`` in one atomic step
    (see ``snapshots``: read the table with ``snapshots.read``, load it first with ``snapshots.create``)."""
    snapshots.refresh(spark, extract, path, date_col, days, partition_col)


def keyed_save(existing: DataFrame | None, incoming: DataFrame, key: str, order_col: str) -> DataFrame:
    """S-9: keyed idempotent save: the same id overwrites, never duplicates (latest ``order_col`` wins)."""
    u = incoming if existing is None else existing.unionByName(incoming)
    w = Window.partitionBy(key).orderBy(F.col(order_col).desc())
    return u.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def normalise_notices(events: DataFrame) -> DataFrame:
    """S-10: two kinds of payment notice → one sale record.

    One-off approved payments are ``purchase`` events (plan from ``props.k``:
    even → perpetua, odd → mensual; a notice without a known plan is dropped);
    subscriptions in force are ``signup`` events with a positive amount (plan
    mensual).  Other notices are dropped.
    """
    k = F.get_json_object("props", "$.k").cast("bigint")
    one_off = (events.filter((F.col("event_type") == "purchase") & k.isNotNull())
               .select(F.col("event_id").alias("id"), F.lit("pago").alias("tipo"),
                       F.when(k % 2 == 0, "perpetua").otherwise("mensual").alias("plan"),
                       F.col("user_id").alias("email"), F.round(F.col("value") * 100).cast("bigint").alias("usd_c"),
                       F.col("ts").alias("cuando")))
    subs = (events.filter((F.col("event_type") == "signup") & (F.col("value") > 0))
            .select(F.col("event_id").alias("id"), F.lit("suscripcion").alias("tipo"), F.lit("mensual").alias("plan"),
                    F.col("user_id").alias("email"), F.round(F.col("value") * 100).cast("bigint").alias("usd_c"),
                    F.col("ts").alias("cuando")))
    return one_off.unionByName(subs)
