"""Structured Streaming jobs T-1 … T-3.

* T-1 retry-safe ingestion: the same notification delivered several times counts once, however late the repeat comes.
  The ids are keyed state of the stream: a micro-batch looks up the ids it brings and reads nothing of what earlier
  ones wrote.  The state has no horizon; it lives in RocksDB (on the executors' disks, its changes in the checkpoint
  folder), not in memory.  A batch that is run again replaces its own rows.
* T-2 live sales monitor: running totals per plan.  A micro-batch adds the totals of its new notices; they are stored
  by batch, so a retry replaces them.
* T-3 incremental refresh of a partitioned fact from new extracts.

All jobs use ``trigger(availableNow=True)`` here so a test drives them to the end; in production the same code runs
with a processing-time trigger.  The checkpoint folder is an argument and has to stay the same for the same output:
a restarted job goes on after the last committed batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmetrics.sources import snapshots
from starmetrics.sources.sinks import incremental_refresh

SALE_SCHEMA = "id bigint, email bigint, usd_c bigint, cuando timestamp_ntz, plan string"
BATCH = "_batch"


def sale_stream(spark: SparkSession, folder: str, max_files: int = 1000) -> DataFrame:
    return (spark.readStream.schema(SALE_SCHEMA).option("maxFilesPerTrigger", max_files).parquet(folder))


def notices(stream: DataFrame) -> DataFrame:
    """Stateful: for every id of a micro-batch its first delivery (the earliest of the first micro-batch that brought
    it), with the time of its first and its latest micro-batch.

    ``current_timestamp`` is one value per micro-batch, the same when the batch is run again.  Partial aggregation
    makes an id delivered many times one row per task before the shuffle."""
    cols = [c for c in stream.columns if c != "id"]
    first = F.min(F.struct("at", "cuando", *[c for c in cols if c != "cuando"])).alias("r")
    state = stream.withColumn("at", F.current_timestamp()).groupBy("id").agg(first, F.max("at").alias("last"))
    return state.select("id", *[F.col("r")[c].alias(c) for c in cols], F.col("r.at").alias("first"), "last")


def new_notices(batch: DataFrame) -> DataFrame:
    """Of a micro-batch of ``notices``, the ids that no earlier one brought."""
    return batch.filter(F.col("first") == F.col("last")).drop("first", "last")


def store(batch: DataFrame, epoch: int, out: str) -> None:
    """The rows of one batch; run again, they replace themselves."""
    (batch.withColumn(BATCH, F.lit(epoch).cast("long")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(BATCH).parquet(out))


#: Keyed state on disk; a checkpoint stores the changes of a batch, not all ids.
STATE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
         "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true"}


def _drive(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> None:
    conf = stream.sparkSession.conf
    before = {k: conf.get(k, None) for k in STATE}
    for k, v in STATE.items():
        conf.set(k, v)
    try:
        q = stream.writeStream.outputMode(mode).foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:  # a started query keeps the settings it began with
        for k, v in before.items():
            conf.unset(k) if v is None else conf.set(k, v)
    q.awaitTermination()


def run_dedup(spark: SparkSession, folder: str, out: str, checkpoint: str, max_files: int = 1000) -> DataFrame:
    """T-1: ``out`` holds every notice id of ``folder`` once."""
    _drive(notices(sale_stream(spark, folder, max_files)), lambda batch, epoch: store(new_notices(batch), epoch, out), checkpoint, "update")
    return spark.read.parquet(out).drop(BATCH)


def run_monitor(spark: SparkSession, folder: str, out: str, checkpoint: str, max_files: int = 1000) -> DataFrame:
    """T-2: running totals per plan over the notices that T-1 keeps; ``out`` holds both."""
    def sink(batch: DataFrame, epoch: int) -> None:
        store(new_notices(batch), epoch, out + "/notices")
        # one folder: the filter is on the folders' column
        mine = spark.read.schema(f"{SALE_SCHEMA}, {BATCH} long").parquet(out + "/notices").filter(F.col(BATCH) == epoch)
        store(mine.groupBy("plan").agg(F.count(F.lit(1)).alias("ventas"), F.sum("usd_c").alias("bruto_c")), epoch, out + "/totals")

    _drive(notices(sale_stream(spark, folder, max_files)), sink, checkpoint, "update")
    return spark.read.parquet(out + "/totals").groupBy("plan").agg(F.sum("ventas").alias("ventas"), F.sum("bruto_c").alias("bruto_c"))


def run_incremental(spark: SparkSession, folder: str, schema: str, out: str, date_col: str, days: int,
                    partition_col: str, checkpoint: str) -> DataFrame:
    """T-3: extracts ``folder/extract=<number>/…`` replace the last ``days`` days of ``out``, in order of their numbers.

    An extract is published as a whole; a trigger takes every file present (no cap), so none is split.
    """
    def sink(batch: DataFrame, epoch: int) -> None:
        numbers = sorted(r[0] for r in batch.select("extract").distinct().collect())  # extracts since the last trigger
        for n in numbers:
            incremental_refresh(spark, batch.filter(F.col("extract") == n).drop("extract"), out, date_col, days, partition_col)

    _drive(spark.readStream.schema(schema + ", extract int").parquet(folder), sink, checkpoint)
    return snapshots.read(spark, out)
