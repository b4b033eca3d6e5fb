"""Operator 1 — mixing sources to target weights.

Every document gets a hash-random key.  The (narrow) rows are range-sorted by source and key, a running sum of
sizes is taken inside each range and shifted by the sizes of the earlier ranges of the same source, and each
source is cut at its exact budget.  A source whose target exceeds its size is repeated: whole epochs first, the
remainder from the front of the sorted order.  A hot source is simply spread over many ranges; the only tables
that are not spread hold one row per (range, source) or per source.

Targets: the sources' weights share the total size; a target stops at ``max_epochs`` times its source's size and
the excess is shared again by weight until none is above.

Edge cases: a null text has size 0 and is never cut; a null source is a source of its own, last in order; ties of
the key are broken by doc_id and a hash of the text, and fully repeated rows are interchangeable; a source
without words has target 0; an empty table gives an empty result; other columns are ignored by ``mix_plan`` and
kept by ``mix_documents``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starmetrics.llm.common import frugal, n_words, shuffle_partitions, stage, table
from starmetrics.operators.windows import global_position

#: Weights of the sources in order of code point (null last), repeating.
WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = "mix"


def random_key(doc_id: Column) -> Column:
    return F.md5(F.concat(F.lit(SEED + ":"), F.coalesce(doc_id.cast("string"), F.lit(""))))


def with_size(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """doc_id, source, size, and the sort columns (null sources last)."""
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), n_words(F.col(text)).alias("size"),
                       F.col(source).isNull().alias("_none"), random_key(F.col(doc_id)).alias("_key"),
                       F.xxhash64(text).alias("_tie"))


def targets(sizes: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per source: ``source_size`` and ``target``.

    The capped sources are found in rounds; each round is one aggregate over the sources that returns the weight
    and size still to share, and a source once capped stays so."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    per = stage(per, "mix-sources")
    ranked = global_position(per, [F.col("source").isNull(), F.col("source")], pos="_rank")
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod(F.col("_rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    per = stage(ranked.select("source", "source_size", w.alias("_w"), (F.col("source_size") * max_epochs).cast("double").alias("_most")), "mix-ranked")
    total = per.agg(F.sum("source_size")).first()[0] or 0
    level = None  # words for each unit of weight
    while True:
        capped = F.lit(False) if level is None else F.col("_w") * F.lit(level) >= F.col("_most")
        row = per.agg(F.sum(F.when(~capped, F.col("_w"))), F.coalesce(F.sum(F.when(capped, F.col("_most"))), F.lit(0.0))).first()
        nxt = (total - row[1]) / row[0] if row[0] else level
        if nxt is None or (level is not None and nxt <= level):
            break
        level = nxt
    return per.select("source", F.col("source_size").cast("long").alias("source_size"),
                      F.least(F.col("_w") * F.lit(level or 0.0), F.col("_most")).alias("target"))


def running_sizes(sizes: DataFrame) -> DataFrame:
    """``sizes`` with ``before``: the words of the source that come earlier in the random order."""
    spark = sizes.sparkSession
    order = ["_none", "source", "_key", "doc_id", "_tie"]
    sorted_ = sizes.repartitionByRange(shuffle_partitions(spark), *order).sortWithinPartitions(*order).withColumn("_range", F.spark_partition_id())
    schema = sorted_.drop("_tie").schema.simpleString()[7:-1] + ",_local:bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, carry = object(), 0
        for b in batches:
            if not b.num_rows:
                continue
            size = b.column("size").to_numpy(zero_copy_only=False)
            code = pc.dictionary_encode(b.column("source"), null_encoding="encode").indices.to_numpy()
            cum = np.cumsum(size) - size
            first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
            base = np.repeat(cum[first], np.diff(np.append(first, len(code))))
            src = b.column("source")
            local = cum - base
            if src[0].as_py() == last:
                local[: first[1] if len(first) > 1 else len(code)] += carry
            last, carry = src[len(src) - 1].as_py(), int(local[-1] + size[-1])
            keep = b.drop_columns(["_tie"])
            yield pa.RecordBatch.from_arrays([*keep.columns, pa.array(local, pa.int64())], [*keep.schema.names, "_local"])

    local = stage(sorted_.mapInArrow(frugal(run), schema), "mix-sorted")
    per = local.groupBy("_range", "source").agg(F.sum("size").alias("_n"))
    w = Window.partitionBy("source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offs = per.select("_range", F.col("source").alias("_s"), F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    return (local.join(offs.withColumnRenamed("_range", "_r"), (F.col("_range") == F.col("_r")) & F.col("source").eqNullSafe(F.col("_s")))
            .withColumn("before", F.col("_local") + F.col("_off")).drop("_r", "_s", "_off", "_local", "_range"))


def mix_plan(docs: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per document: ``doc_id, source, size, before, source_size, target, epochs`` (whole passes of its
    source) and ``taken`` (words the mix takes: all of them in every epoch, and in the last, broken pass those
    before the cut; the document at the cut gives the words that fit, so each source meets round(target) exactly)."""
    sizes = stage(with_size(docs), "mix-sizes")
    t = targets(sizes, weights, max_epochs).withColumnRenamed("source", "_src")
    out = running_sizes(sizes).join(t, F.col("source").eqNullSafe(F.col("_src"))).drop("_src")
    budget = F.floor(F.col("target") + 0.5)
    out = out.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0)).cast("long"))
    rest = budget - F.col("epochs") * F.col("source_size")
    return out.withColumn("taken", (F.col("epochs") * F.col("size")
                                    + F.least(F.col("size"), F.greatest(F.lit(0), rest - F.col("before")))).cast("long"))


def mix_documents(docs: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """The mixed corpus in the columns of ``docs``: each document as often as its source's budget takes it.

    Documents stay whole: the one at the cut is taken if at least half of it fits.  The cut of a source is its
    last taken (key, doc_id, tie), one row per source, so the texts are not sorted or joined by document."""
    plan = mix_plan(docs, weights, max_epochs)
    budget = F.floor(F.col("target") + 0.5)
    rest = budget - F.col("epochs") * F.col("source_size")
    cut = plan.groupBy(F.col("source").alias("_src")).agg(
        F.max("epochs").alias("_epochs"),
        F.max(F.when((F.col("size") > 0) & (2 * (rest - F.col("before")) >= F.col("size")), F.struct("_key", "doc_id"))).alias("_cut"))
    cut = stage(cut, "mix-cuts")
    key = F.struct(random_key(F.col("doc_id")).alias("_key"), F.col("doc_id"))
    copies = F.col("_epochs") + F.when(key <= F.col("_cut"), 1).otherwise(0)
    rows = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", "source", (n_words(F.col("text")) > 0).alias("worded"))
    out = rows.filter("worded").join(cut, F.col("source").eqNullSafe(F.col("_src"))).withColumn("copies", copies.cast("long"))
    return out.filter("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("row.*")


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_plan(table(spark, sf_dir, "documents").select("doc_id", "source", "text")).select(
        "doc_id", "size", "source_size", "target", "taken")


def sql() -> str:
    arr = "[" + ", ".join(f"{float(x)}" for x in WEIGHTS) + "]"
    return rf"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('{SEED}:' || coalesce(doc_id::VARCHAR, '')) AS k FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         {arr}[((row_number() OVER (ORDER BY source IS NULL, source) - 1) % {len(WEIGHTS)} + 1)::INT] AS w
  FROM d GROUP BY source
), o AS (
  SELECT *, {MAX_EPOCHS}.0::DOUBLE * source_size / w AS ratio, row_number() OVER (ORDER BY {MAX_EPOCHS}.0::DOUBLE * source_size / w, source) AS i FROM s
), c AS (
  SELECT *, coalesce(sum({MAX_EPOCHS} * source_size) OVER (ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS capped,
         sum(w) OVER (ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_w,
         (sum(source_size) OVER ())::DOUBLE AS total FROM o
), lv AS (
  SELECT min_by((total - capped) / open_w, i) AS level FROM c WHERE (total - capped) / open_w < ratio
), t AS (
  SELECT source, source_size, least(coalesce(w * level, 1e300), ({MAX_EPOCHS} * source_size)::DOUBLE) AS target FROM s LEFT JOIN lv ON true
), r AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, floor(t.target + 0.5)::BIGINT AS budget,
         (sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id ROWS UNBOUNDED PRECEDING) - d.size)::BIGINT AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), e AS (
  SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS epochs FROM r
)
SELECT doc_id, size, source_size, target,
       (epochs * size + least(size, greatest(0, budget - epochs * source_size - before)))::BIGINT AS taken FROM e"""
