"""The eleven reusable measure templates G-1 … G-11 as DataFrame functions.

``template(df, value, group, date, n)``: ``value`` is a column expression,
``group`` a list of grouping columns, ``date`` a DATE column.  Time templates
aggregate to months first; their windows then run over one row per
(group, month), never over lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmetrics.functions.exprs import month_index, safe_div


def total(df: DataFrame, value: Column, group: list[str]) -> DataFrame:           # G-1
    return df.groupBy(*group).agg(F.sum(value).alias("total"))


def average(df: DataFrame, value: Column, group: list[str]) -> DataFrame:         # G-2
    return df.groupBy(*group).agg(F.avg(value).alias("promedio"))


def min_max(df: DataFrame, value: Column, group: list[str]) -> DataFrame:         # G-3
    return df.groupBy(*group).agg(F.min(value).alias("minimo"), F.max(value).alias("maximo"))


def distinct_count(df: DataFrame, col: str, group: list[str]) -> DataFrame:       # G-4
    return df.groupBy(*group).agg(F.count_distinct(col).alias("distintos"))


def row_count(df: DataFrame, group: list[str]) -> DataFrame:                      # G-5
    return df.groupBy(*group).agg(F.count(F.lit(1)).alias("filas"))


def pct_of_total(df: DataFrame, value: Column, group: list[str]) -> DataFrame:    # G-6
    g = df.groupBy(*group).agg(F.sum(value).alias("v"))
    t = g.agg(F.sum("v").alias("_t"))
    return g.crossJoin(t).select(*group, "v", safe_div("v", "_t").alias("pct_total"))


def _monthly(df: DataFrame, value: Column, date: str, group: list[str]) -> DataFrame:
    return df.groupBy(*group, (F.year(date) * 100 + F.month(date)).cast("int").alias("anio_mes")) \
        .agg(F.sum(value).alias("v"))


def ytd(df: DataFrame, value: Column, date: str, group: list[str] = ()) -> DataFrame:   # G-7
    g = _monthly(df, value, date, list(group))
    w = Window.partitionBy(*group, F.floor(F.col("anio_mes") / 100)).orderBy("anio_mes") \
        .rowsBetween(Window.unboundedPreceding, 0)
    return g.withColumn("ytd", F.sum("v").over(w))


def vs_previous_year(df: DataFrame, value: Column, date: str, group: list[str] = ()) -> DataFrame:  # G-8
    g = _monthly(df, value, date, list(group))
    p = g.select(*group, (F.col("anio_mes") + 100).alias("anio_mes"), F.col("v").alias("v_aa"))
    j = g.join(p, list(group) + ["anio_mes"], "left")
    return j.withColumn("var_pct", safe_div(F.col("v") - F.col("v_aa"), F.col("v_aa")))


def moving_average(df: DataFrame, value: Column, date: str, n: int, group: list[str] = ()) -> DataFrame:  # G-9
    g = _monthly(df, value, date, list(group)).withColumn("_mi", month_index("anio_mes"))
    w = Window.partitionBy(*group).orderBy("_mi").rangeBetween(-(n - 1), 0)
    return g.withColumn(f"media_{n}m", F.avg("v").over(w)).drop("_mi")


def dense_ranking(df: DataFrame, value: Column, item: str, group: list[str] = ()) -> DataFrame:  # G-10
    g = df.groupBy(*group, item).agg(F.sum(value).alias("v"))
    # dense rank = position of the value among the distinct values of its group; the distinct
    # values are numbered through the grouped global order, so no group sits in one task
    from starmetrics.operators.windows import global_position
    vals = g.select(*group, "v").distinct()
    ranks = global_position(vals, [F.col("v").desc()], group=list(group), pos="ranking")
    return g.join(ranks.select(*group, "v", "ranking"), [*group, "v"])


def top_n(df: DataFrame, value: Column, item: str, n: int) -> DataFrame:         # G-11
    g = df.groupBy(item).agg(F.sum(value).alias("v"))
    return g.orderBy(F.col("v").desc(), F.col(item)).limit(n)
