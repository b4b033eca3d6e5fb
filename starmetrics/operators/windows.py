"""Window operators W-1 … W-19 and scalable global ordering.

Per-key windows run over rows that were first aggregated to (key, month), so a
hot key contributes at most one row per month to its window partition.

Global orders (ntile, exact quantiles, decile capture, Pareto) never use an
unpartitioned window: ``global_position`` range-partitions the rows, numbers
them inside each partition and adds the row count of all earlier partitions
(a table with one row per partition).
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmetrics.functions.exprs import clip
from starmetrics.session import release, shared_dir


# ---------------------------------------------------------------- per key
def month_counts(df: DataFrame, keys: list[str], target: str, month: str = "anio_mes") -> DataFrame:
    """(keys, month) → s = Σtarget, c = count (the input of W-1 … W-3)."""
    return df.groupBy(*keys, month).agg(F.sum(target).cast("double").alias("s"),
                                        F.count(F.lit(1)).cast("double").alias("c"))


def smoothed_rate_before(agg: DataFrame, keys: list[str], prior: Column, alpha: float,
                         window: int | None = None, month: str = "anio_mes", out: str = "tasa_prev") -> DataFrame:
    """W-1 (expanding, ``window=None``) / W-2 (last ``window`` present months):
    (Σprev + prior·α) / (nprev + α), strictly earlier months only."""
    lo = Window.unboundedPreceding if window is None else -window
    w = Window.partitionBy(*keys).orderBy(month).rowsBetween(lo, -1)
    sp = F.coalesce(F.sum("s").over(w), F.lit(0.0))
    cp = F.coalesce(F.sum("c").over(w), F.lit(0.0))
    return agg.withColumn(out, (sp + prior * F.lit(float(alpha))) / (cp + F.lit(float(alpha))))


def before_in(keys: list[str], month: str = "anio_mes"):
    """The rows of the same keys in strictly earlier months, as a window over lines (for keys that few lines share)."""
    return Window.partitionBy(*keys).orderBy(month).rangeBetween(Window.unboundedPreceding, -1)


def by_month(df: DataFrame, keys: list[str], value: str, out: str, month: str = "anio_mes") -> DataFrame:
    """One row per key with a map month → value (at most one entry a month): joined on the key alone, so that all
    lookups by a key share one shuffle of the lines."""
    return df.filter(F.col(month).isNotNull()).groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct(month, value))).alias(out))


def mean_before(agg: DataFrame, keys: list[str], month: str = "anio_mes", out: str = "media_prev") -> DataFrame:
    """W-3: historical mean volume per row before the month (NULL when no history)."""
    w = Window.partitionBy(*keys).orderBy(month).rowsBetween(Window.unboundedPreceding, -1)
    return agg.withColumn(out, F.sum("s").over(w) / F.sum("c").over(w))


def lags(df: DataFrame, key: list[str], order: str, col: str, ks=(1, 2, 3)) -> DataFrame:
    """W-4: lag k of ``col`` per key."""
    w = Window.partitionBy(*key).orderBy(order)
    return df.withColumns({f"{col}_lag{k}": F.lag(col, k).over(w) for k in ks})


def mean_prev3_complete(df: DataFrame, key: list[str], order: str, col: str, out: str) -> DataFrame:
    """W-5: mean of the three preceding rows, NULL unless all three exist."""
    w = Window.partitionBy(*key).orderBy(order).rowsBetween(-3, -1)
    return df.withColumn(out, F.when(F.count(col).over(w) == 3, F.avg(col).over(w)))


def ratio_to_group_median(df: DataFrame, key: str, value: str, lo: float, hi: float, out: str) -> DataFrame:
    """W-7: value / max(group median, 1), clipped (median is a grouped aggregate joined back)."""
    med = df.groupBy(key).agg(F.percentile(value, 0.5).alias("_gm"))
    return (df.join(med, key, "left")
            .withColumn(out, clip(F.col(value) / F.greatest(F.col("_gm"), F.lit(1.0)), lo, hi)).drop("_gm"))


# ---------------------------------------------------------------- global order
def global_position(df: DataFrame, order: list[Column], partitions: int | None = None,
                    pos: str = "_pos", cum_of: Column | None = None, cum: str = "_cum",
                    group: list[str] | tuple = ()) -> DataFrame:
    """1-based row number (and optionally the running sum of ``cum_of``) under a total
    ``order`` — within each ``group`` when given — without a single-task window.

    Rows are range-partitioned and sorted on (group, order), and each gets its place in its range in the same stage
    (the low bits of ``monotonically_increasing_id``).  The frame is written to the shared folder, so the ranges can't
    change afterwards; the sizes of the earlier ranges of the same group (a table of about ranges + groups rows) are
    added.  A hot group is spread over several tasks, and positions need no second shuffle of the rows.
    """
    spark = df.sparkSession
    group = list(group)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [*[F.col(g) for g in group], *order]
    r = df if cum_of is None else df.withColumn("_cv", cum_of)
    r = r.repartitionByRange(n, *keys).sortWithinPartitions(*keys).withColumn("_place", F.monotonically_increasing_id())
    path = shared_dir(spark, f"order-{uuid.uuid4().hex[:12]}")
    r.write.parquet(path)
    schema = r.schema
    del r
    release(spark)
    r = spark.read.schema(schema).parquet(path).withColumns({
        "_pid": F.shiftright("_place", 33), "_place": F.col("_place").bitwiseAND((1 << 33) - 1)})
    aggs = [F.count(F.lit(1)).alias("_sz"), F.min("_place").alias("_first")]
    if cum_of is not None:
        aggs.append(F.sum("_cv").alias("_ssum"))
    sizes = r.groupBy("_pid", *group).agg(*aggs)
    # one row per (range, group): the running offsets are computed over a bounded frame
    wo = Window.partitionBy(*group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = sizes.withColumn("_off", F.coalesce(F.sum("_sz").over(wo), F.lit(0)) - F.col("_first"))
    keep = [F.col("_pid").alias("_p"), *[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)], "_off"]
    if cum_of is not None:
        offs = offs.withColumn("_coff", F.coalesce(F.sum("_ssum").over(wo), F.lit(0)))
        keep.append("_coff")
        wl = Window.partitionBy("_pid", *group).orderBy("_place").rowsBetween(Window.unboundedPreceding, 0)
        r = r.withColumn("_lcum", F.sum("_cv").over(wl))
    offs = offs.select(*keep)
    same = F.col("_pid") == F.col("_p")
    for i, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    out = r.join(offs if group else F.broadcast(offs), same).withColumn(pos, F.col("_place") + F.col("_off") + 1)
    if cum_of is not None:
        out = out.withColumn(cum, F.col("_lcum") + F.col("_coff")).drop("_lcum", "_coff", "_cv")
    return out.drop("_pid", "_p", "_place", "_off", *[f"_g{i}" for i in range(len(group))])


def ntile_expr(pos: Column, n: Column, k: int) -> Column:
    """Spark/SQL NTILE(k) bucket of 1-based position ``pos`` among ``n`` rows."""
    q = F.floor(n / k)
    rem = n % k
    big = rem * (q + 1)
    return F.when(pos <= big, F.floor((pos - 1) / (q + 1)) + 1) \
        .otherwise(rem + F.floor((pos - 1 - big) / q) + 1).cast("int")


def exact_quantiles(df: DataFrame, value: str, probs: list[float]) -> DataFrame:
    """Exact linear-interpolated quantiles (``quantile_cont``) of a continuous column
    from the global order: one-row frame with columns ``q_<p>``."""
    vals = df.select(F.col(value).alias("_v")).filter(F.col("_v").isNotNull())
    # a tie-breaker lets the range partitioner split a value held by many rows
    ranked = global_position(vals.withColumn("_tb", F.monotonically_increasing_id()), [F.col("_v"), F.col("_tb")])
    n = vals.agg(F.count(F.lit(1)).alias("_n"))
    aggs = []
    for p in probs:
        h = (F.col("_n") - 1) * F.lit(p)
        lo = F.floor(h) + 1
        frac = h - F.floor(h)
        name = f"q_{int(round(p * 100))}"
        aggs.append(
            (F.max(F.when(F.col("_pos") == lo, F.col("_v")))
             + F.lit(0.0)).alias(f"{name}_lo"))
        aggs.append(F.max(F.when(F.col("_pos") == lo + 1, F.col("_v"))).alias(f"{name}_hi"))
        aggs.append(F.max(frac).alias(f"{name}_fr"))
    t = ranked.crossJoin(F.broadcast(n)).agg(*aggs)
    return t.select(*[
        (F.col(f"q_{int(round(p * 100))}_lo")
         + F.coalesce(F.col(f"q_{int(round(p * 100))}_hi") - F.col(f"q_{int(round(p * 100))}_lo"), F.lit(0.0))
         * F.col(f"q_{int(round(p * 100))}_fr")).alias(f"q_{int(round(p * 100))}") for p in probs])


def pareto(df: DataFrame, item: str, value: str, threshold: float = 0.8) -> DataFrame:
    """W-17: per item its value, cumulative share with ties (RANGE frame semantics:
    every item with the same value shares the cumulative sum) and the flag
    ``cum <= threshold``.  Items are first aggregated; the cumulative sum runs over
    the distinct values through ``global_position``."""
    it = df.groupBy(item).agg(F.sum(value).alias("v"))
    byv = it.groupBy("v").agg(F.count(F.lit(1)).alias("k"))
    cum = global_position(byv, [F.col("v").desc()], cum_of=F.col("v") * F.col("k"), cum="cum_v")
    total = it.agg(F.sum("v").alias("total"))
    return (it.join(cum.select("v", "cum_v"), "v").crossJoin(F.broadcast(total))
            .withColumn("acumulado_pct", F.col("cum_v").cast("double") / F.col("total").cast("double"))
            .withColumn("dentro_80", (F.col("acumulado_pct") <= threshold).cast("int"))
            .drop("cum_v", "total"))
