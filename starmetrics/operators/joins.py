"""Join operators J-1 … J-13."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class ManyToOneViolation(ValueError):
    pass


def validated_left_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """J-1: left join that fails when the right side repeats a key (many-to-one).

    The check is one aggregate whose result is a single number on the driver.
    """
    dups = right.groupBy(*keys).count().filter(F.col("count") > 1).limit(1).count()
    if dups:
        raise ManyToOneViolation(f"right side repeats keys {keys}")
    return left.join(right, keys, "left")


def expected_grid_missing(months: DataFrame, members: DataFrame, present: DataFrame,
                          keys: list[str]) -> DataFrame:
    """J-4 / U-1: expected (month × member) grid minus the pairs present.

    Both grid sides are small distinct sets (months, branches); the anti join
    against the distinct present pairs never touches line-level rows.
    """
    grid = months.crossJoin(members)
    return grid.join(present.select(*keys).distinct(), keys, "left_anti")


def orphans(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """J-5: fact rows whose key is missing from the dimension."""
    return fact.join(dim.select(key), key, "left_anti")


def restrict_by_bridge(fact: DataFrame, bridge: DataFrame, user: str, key: str = "id_filial",
                       user_col: str = "email") -> DataFrame:
    """J-11: row-level security: keep fact rows whose ``key`` the user may see."""
    allowed = bridge.filter(F.col(user_col) == F.lit(user)).select(key)
    return fact.join(allowed, key, "left_semi")


def relationship_profile(rels: list[tuple[str, DataFrame, str, DataFrame, str]]) -> DataFrame:
    """J-13: per relationship (name, many side, key, one side, key): rows, distinct
    one-side keys, repeated one-side keys and orphan many-side rows."""
    frames = []
    for name, many, mkey, one, okey in rels:
        one_stats = one.agg(F.count(F.lit(1)).alias("filas_uno"),
                            F.count_distinct(okey).alias("claves_distintas"))
        orph = many.select(F.col(mkey).alias("_k")).join(
            one.select(F.col(okey).alias("_k")).distinct(), "_k", "left_anti").agg(
            F.count(F.lit(1)).alias("huerfanos"))
        many_rows = many.agg(F.count(F.lit(1)).alias("filas_muchos"))
        frames.append(one_stats.crossJoin(orph).crossJoin(many_rows).select(
            F.lit(name).alias("relacion"), "filas_muchos", "filas_uno", "claves_distintas",
            (F.col("filas_uno") - F.col("claves_distintas")).alias("claves_repetidas"), "huerfanos",
            ((F.col("filas_uno") == F.col("claves_distintas"))).cast("int").alias("uno_es_unico")))
    return reduce(DataFrame.unionByName, frames)
