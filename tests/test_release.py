"""What a written table's plan held goes when the table is there, not when the driver happens to collect its garbage."""

from __future__ import annotations

import glob
import time

import pytest
from pyspark.sql import functions as F

from starmetrics.operators import learn as L
from starmetrics.operators import scores as S
from starmetrics.operators import windows as W
from starmetrics.operators.star import StarModel
from starmetrics.plans.windows_q import fc_lines
from starmetrics.session import ensure_checkpoint_dir
from tests.conftest import SF_SMALL


def shuffle_files(spark) -> set[str]:
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    return {n for i in range(files.size()) if (n := files.apply(i).getName()).startswith("shuffle_")}


def left(spark, before: set[str]) -> set[str]:
    for _ in range(50):  # the cleaner works in a thread of its own
        new = shuffle_files(spark) - before
        if not new:
            break
        time.sleep(0.1)
    return new


@pytest.mark.parametrize("write", [
    lambda m, df: m.shared("t", lambda: df.repartition(3, "k").groupBy("v").agg(F.sum("k").alias("k"))),
    lambda m, df: W.global_position(df, [F.col("v"), F.col("k")])])
def test_shuffles_go_with_the_plan_of_a_written_table(spark, write):
    before = shuffle_files(spark)
    out = write(StarModel(spark, SF_SMALL), spark.range(1000).select(F.col("id").alias("k"), (F.col("id") % 10).alias("v")))
    assert not left(spark, before)
    assert out.agg(F.sum("k")).first()[0] == 499500


def test_features_are_written_half_way(spark):
    """The shuffles by customer and product don't wait for the one by carrier, and the rows half way go at the end."""
    m = StarModel(spark, SF_SMALL)
    scratch: list[str] = []
    plan = L.return_features(m, scratch)._jdf.queryExecution().optimizedPlan().toString()
    assert len(scratch) == 1 and "RepartitionByExpression" not in plan
    found = lambda: set(glob.glob(f"{ensure_checkpoint_dir(spark)}/stage-return_features_by_product-*"))
    before = found()
    assert before and S._features(m).count() == fc_lines(m).count()
    assert found() == before
