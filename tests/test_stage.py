"""The stage tables: which copy of a line stays, who is an outlier, how often the lines move; squares of large amounts."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from starmetrics.operators import cleanse as C
from starmetrics.operators import evaluate as E
from starmetrics.operators import learn as L
from starmetrics.operators import measures as M
from starmetrics.operators.star import StarModel
from starmetrics.plans import windows_q as WQ
from starmetrics.sources import binding as B
from tests.conftest import SF_SMALL


@pytest.fixture()
def sort_merge(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_squares_of_large_amounts(spark):
    """the square of an error of 4e9 leaves the range of a long."""
    df = spark.createDataFrame([(0, 4_000_000_000), (10, 8_000_000_010)], "y bigint, yhat bigint")
    r = E.forecast_metrics(df, "y", "yhat").first()
    assert r["rmse"] == pytest.approx((80e18 / 2) ** 0.5) and r["mae"] == 6e9 and r["n_periodos"] == 2


def test_lines_are_marked_where_the_orders_leave_them(spark, sort_merge):
    raw, by_order = B.lines_by_order(spark, SF_SMALL)
    assert by_order
    marked = C.mark_first(C.with_parsed_date(raw), ["_l_orderkey", "id_linea"], B.DEDUP_ORDER)
    plan = marked._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and "hashpartitioning(id_linea" not in plan and plan.count("hashpartitioning(_l_orderkey") == 0


def test_marks_equal_dedup_first(spark):
    m = StarModel(spark, SF_SMALL)
    want = C.dedup_first(C.drop_unparsed(C.with_parsed_date(B.raw_sellin(spark, SF_SMALL))), ["id_linea"], B.DEDUP_ORDER)
    assert m.deduped.select(want.columns).exceptAll(want).count() == 0 and m.deduped.count() == want.count()
    assert m.parsed.count() == B.read_table(spark, SF_SMALL, "lineitem").count()


def test_ids_shared_by_two_orders(spark, tmp_path):
    """Line 10 of order k has the id of line 0 of order k + 1: one of them stays, as before."""
    for t in B.TABLES:
        if t != "lineitem":
            os.symlink(f"{SF_SMALL}/{t}.parquet", tmp_path / f"{t}.parquet")
    li = B.read_table(spark, SF_SMALL, "lineitem")
    two = li.orderBy("l_orderkey", "l_linenumber").filter("l_tax > 0 AND l_orderkey > 0").limit(1)
    pair = two.withColumn("l_linenumber", F.lit(10)).unionByName(two.withColumns({"l_orderkey": F.col("l_orderkey") + 1, "l_linenumber": F.lit(0)}))
    li.unionByName(pair.select(li.columns)).write.parquet(str(tmp_path / "lineitem.parquet"))
    assert not B.lines_by_order(spark, str(tmp_path))[1]
    m = StarModel(spark, str(tmp_path))
    assert m.deduped.groupBy("id_linea").count().filter("count > 1").isEmpty()


def test_outliers_against_the_median(spark):
    rows = [(1, 1), (1, 1), (1, 26), (1, 25), (2, 2), (2, 100), (2, 3), (None, 26), (None, 3), (3, None)]
    df = spark.createDataFrame(rows, "id_producto bigint, unidades bigint")
    got = sorted((r[0] or 0, r[1] or 0, r[2]) for r in C.flag_outliers(df).select("id_producto", "unidades", "flag_revision").collect())
    # medians 13, 3; without a product: 25
    want = sorted([(1, 1, 0), (1, 1, 0), (1, 26, 0), (1, 25, 0), (2, 2, 0), (2, 100, 1), (2, 3, 0), (0, 26, 1), (0, 3, 0), (3, 0, None)])
    assert got == want


def test_sellin_moves_no_wide_lines(spark):
    """F19 … F36: once the lines are written, the clean lines need no shuffle of them."""
    m = StarModel(spark, SF_SMALL)
    assert m.sellin.count() > 0
    assert set(m._shared) == {"lines", "fx", "outlier_limits", "sellin"}


def test_features_move_the_lines_three_times(spark, sort_merge):
    """by customer, by product and by carrier; before, each of six rates and two medians moved them again."""
    m = StarModel(spark, SF_SMALL)
    plan = L.return_features(m)._jdf.queryExecution().executedPlan()

    def moves(p):
        node = "Exchange hashpartitioning" in p.toString().split("\n")[0] and "id_linea" in p.output().mkString(",")
        return int(node) + sum(moves(p.children().apply(i)) for i in range(p.children().size()))
    assert moves(plan.initialPlan()) == 3


def test_risk_bands_write_the_lines_once(spark):
    """the scored lines hold what their readers use, and the bands add three quantiles to them."""
    m = StarModel(spark, SF_SMALL)
    bands = WQ.risk_bands(m)
    assert {"line_risk", "risk_quantiles"} <= set(m._shared) and "risk_bands" not in m._shared
    assert m._shared["line_risk"].columns == [*(c for c in ("id_producto", "anio_mes")), *(c for c in WQ.RISK_COLS if c not in ("id_producto", "anio_mes")), "prob"]
    assert bands.count() == WQ.fc_lines(m).count()


def test_lines_are_written_narrow(spark):
    """the written lines hold the source columns; before, all 35 derived ones were sorted and written."""
    m = StarModel(spark, SF_SMALL)
    assert {"_first", "fecha", "importe_local_c", "_l_tax"} <= set(m.lines.columns)
    assert m._shared["lines"].columns == [*B.LINE_COLS, "_first"]
    raw = B.raw_sellin(spark, SF_SMALL)
    assert m.parsed.drop("fecha").schema == raw.schema and m.parsed.drop("fecha").exceptAll(raw).isEmpty()


def test_only_rows_above_the_lowest_limit_meet_the_limits(spark, sort_merge):
    """before, every line moved to meet the limits of the few products that have outliers."""
    rows = [(1, 1), (1, 1), (1, 26), (1, 25), (2, 2), (2, 100), (2, 3), (None, 26), (None, 3), (3, None), (4, 90), (4, 90)]
    df = spark.createDataFrame(rows, "id_producto bigint, unidades bigint")
    limits = C.outlier_limits(df).localCheckpoint()      # product 1 has a median of 13, product 2 of 3: limit 75
    assert [tuple(r) for r in limits.collect()] == [(2, 75.0)]
    got = C.flag_outliers(df, limits=limits)
    assert got.exceptAll(C.flag_outliers(df)).isEmpty() and got.count() == len(rows)
    plan = got._jdf.queryExecution().optimizedPlan()
    assert plan.toString().startswith("Union") and str(plan.children().apply(1)).count("Join") == 0
    none = C.flag_outliers(df.filter("unidades < 26"), limits=limits.filter("false"))
    assert none.count() == 6 and none.filter("flag_revision <> 0").isEmpty()


def test_rollup_reads_the_fact_once(spark, sort_merge):
    """a single pass over the sales fact writes nothing, groups the one part it needs, and no line moves by branch."""
    m = StarModel(spark, SF_SMALL)
    net = M.Measure("ventas_netas_c", "fact_ventas", {"neto_c": M.NET_C().cast("bigint")})
    df = M.evaluate(m, [net], ["region", "pais"], rollup=True)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "fact_ventas" not in m._shared and "lineas_otif" not in plan and "sum(unidades" not in plan
    assert "hashpartitioning(id_filial" not in plan and "SortMergeJoin [id_filial" not in plan
    want = {r[0]: r[1] for r in m.fact_ventas.join(m.branches, "id_filial", "left").groupBy("pais").agg(M.NET_C()).collect()}
    assert {r["pais"]: r["ventas_netas_c"] for r in df.filter("nivel = 0").collect()} == want
    assert "fact_ventas" in m._shared and m.read_once("fact_ventas") is m.fact_ventas
