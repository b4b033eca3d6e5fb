"""Partitioned tables that a refresh replaces in one atomic step (S-8, T-3).

A table is a folder with ``data/version=<n>-<tag>/<column>=<value>/…`` and ``manifest/``.  A refresh writes the
partitions it touches into a version folder of its own, and then appends one row to the manifest: which version holds
each partition now, and which extracts the table has seen.  The row is a file that Spark's commit renames into place,
so readers see the old table or the new one.  A job that dies before leaves a version folder nobody names; run again,
it starts from the same table.  One writer at a time; two manifests of one version are reported.

An extract is the truth about the days it covers, as of its last date.  Extracts may come late or in any order: for
each day the one with the latest last date counts, among all the table has seen, so an extract older than the table
takes nothing from it.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import uuid
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_MANIFEST = ("version long, partitions map<string, string>, applied array<struct<last: date, days: int>>, "
             "high_water date, partition_col string, table_schema string")


class Snapshot(NamedTuple):
    version: int
    partitions: dict[str, str]  # "column=value" → version folder
    applied: list[tuple[dt.date, int | None]]  # last date and days of each extract; None: all days up to the last
    high_water: dt.date | None
    partition_col: str
    schema: T.StructType


def latest(spark: SparkSession, path: str) -> Snapshot | None:
    """The table as of its last manifest; None if there is none."""
    try:
        rows = spark.read.schema(_MANIFEST).json(f"{path}/manifest").orderBy(F.desc("version")).limit(2).collect()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = []
    if not rows:
        return None
    if len(rows) == 2 and rows[0]["version"] == rows[1]["version"]:
        raise RuntimeError(f"{path}: two writers committed version {rows[0]['version']}")
    r = rows[0]
    return Snapshot(r["version"], dict(r["partitions"] or {}), [(a["last"], a["days"]) for a in r["applied"]], r["high_water"],
                    r["partition_col"], T.StructType.fromJson(json.loads(r["table_schema"])))


def commit(spark: SparkSession, path: str, snap: Snapshot) -> None:
    """The last step of a refresh: one file appears in the manifest."""
    row = (snap.version, snap.partitions, snap.applied, snap.high_water, snap.partition_col, json.dumps(snap.schema.jsonValue()))
    spark.createDataFrame([row], _MANIFEST).coalesce(1).write.mode("append").json(f"{path}/manifest")


def _folders(spark: SparkSession, path: str, schema: T.StructType, folders: list[str]) -> DataFrame:
    """Rows of some partition folders; the partition column comes from the folder names, so filters on it skip folders."""
    if not folders:
        return spark.createDataFrame([], schema)
    full = T.StructType([*schema.fields, T.StructField("version", T.StringType())])
    return spark.read.schema(full).option("basePath", f"{path}/data").parquet(*folders).select(*schema.names)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The table as of its last manifest."""
    snap = latest(spark, path)
    if snap is None:
        raise FileNotFoundError(f"{path} has no manifest")
    return _folders(spark, path, snap.schema, [f"{path}/data/version={v}/{d}" for d, v in sorted(snap.partitions.items())])


def _written(spark: SparkSession, folder: str, schema: T.StructType) -> set[str]:
    """Names ``column=value`` of the partitions with files in a version folder (file names come as URIs)."""
    return {unquote(os.path.basename(os.path.dirname(f))) for f in spark.read.schema(schema).parquet(folder).inputFiles()}


def _new_version(n: int) -> str:
    return f"{n:08d}-{uuid.uuid4().hex[:8]}"


def create(df: DataFrame, path: str, date_col: str, partition_col: str) -> None:
    """A full load: the truth about all days up to its last date."""
    spark = df.sparkSession
    snap = latest(spark, path)
    n = snap.version + 1 if snap else 0
    version = _new_version(n)
    folder = f"{path}/data/version={version}"
    df.write.partitionBy(partition_col).parquet(folder)
    last = spark.read.schema(df.schema).parquet(folder).agg(F.max(date_col)).first()[0]
    commit(spark, path, Snapshot(n, dict.fromkeys(_written(spark, folder, df.schema), version), [(last, None)] if last else [], last, partition_col, df.schema))


def owned(applied: list[tuple[dt.date, int | None]], last: dt.date, days: int) -> tuple[dt.date, dt.date] | None:
    """(after, until]: the days of an extract that no extract with a later last date covers."""
    after, until = last - dt.timedelta(days=days), last
    for other, n in applied:
        if other > last:
            until = min(until, dt.date.min if n is None else other - dt.timedelta(days=n))
    return (after, until) if until > after else None


def refresh(spark: SparkSession, extract: DataFrame, path: str, date_col: str, days: int, partition_col: str) -> None:
    """The last ``days`` days of ``extract`` replace those of the table, but for days that a later extract covers.

    Rows after the extract's last date, rows before its window and rows without a date stay.  Partitions that the
    window touches are written anew as their other rows and the extract's; a partition left without rows goes."""
    last = extract.agg(F.max(date_col)).first()[0]
    if last is None:
        return
    snap = latest(spark, path) or _first(spark, path, partition_col, extract.schema)
    window = owned(snap.applied, last, days)
    if window is None:
        return
    inside = (F.col(date_col) > F.lit(window[0])) & (F.col(date_col) <= F.lit(window[1]))
    version = _new_version(snap.version + 1)
    folder = f"{path}/data/version={version}"
    extract.select(*snap.schema.names).filter(inside).write.partitionBy(partition_col).parquet(folder)
    touched = _written(spark, folder, snap.schema) | _hit(spark, path, snap, inside)
    rest = _folders(spark, path, snap.schema, [f"{path}/data/version={snap.partitions[d]}/{d}" for d in sorted(touched & snap.partitions.keys())])
    rest.filter(~F.coalesce(inside, F.lit(False))).write.mode("append").partitionBy(partition_col).parquet(folder)
    partitions = {d: v for d, v in snap.partitions.items() if d not in touched} | dict.fromkeys(_written(spark, folder, snap.schema), version)
    water = max(d for d in (snap.high_water, last) if d)
    commit(spark, path, Snapshot(snap.version + 1, partitions, [*snap.applied, (last, days)], water, partition_col, snap.schema))


def _first(spark: SparkSession, path: str, partition_col: str, schema: T.StructType) -> Snapshot:
    """An empty table, before its first manifest."""
    try:
        plain = spark.read.schema(schema).parquet(f"{path}/{partition_col}=*").inputFiles()
    except AnalysisException:  # no such folders
        plain = []
    if plain:
        raise ValueError(f"{path} holds plain Parquet: load it into a new folder with create()")
    return Snapshot(-1, {}, [], None, partition_col, schema)


def _hit(spark: SparkSession, path: str, snap: Snapshot, inside: Column) -> set[str]:
    """Partitions of the table with rows in the window: their names, one row each."""
    old = _folders(spark, path, snap.schema, [f"{path}/data/version={v}/{d}" for d, v in sorted(snap.partitions.items())])
    at = F.element_at(F.split(F.input_file_name(), "/"), -2)
    return {unquote(r[0]) for r in old.filter(inside).select(at).distinct().collect()}


def expire(spark: SparkSession, path: str) -> None:
    """Remove the version folders that the last manifest doesn't name (call it when no reader uses older ones)."""
    snap = latest(spark, path)
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/data")
    fs = fs_path.getFileSystem(spark._jsc.hadoopConfiguration())
    named = {f"version={v}" for v in snap.partitions.values()} if snap else set()
    for status in fs.listStatus(fs_path):
        if status.getPath().getName() not in named:
            fs.delete(status.getPath(), True)
