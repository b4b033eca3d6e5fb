"""T-1 and T-2 keep ids as keyed state: nothing written is read again, and batches may run twice."""

from __future__ import annotations

import shutil

from starmetrics.sources import sinks as S
from starmetrics.streaming import sales as T


def deliver(spark, folder, name, rows):
    """rows: (id, minute, plan)."""
    df = spark.createDataFrame([(i, i * 10, 100 * i, f"2024-01-01 00:{m:02d}:00", p) for i, m, p in rows], "id bigint, email bigint, usd_c bigint, c string, plan string")
    df.selectExpr("id", "email", "usd_c", "CAST(c AS TIMESTAMP_NTZ) AS cuando", "plan").coalesce(1).write.parquet(f"{folder}/{name}")


def test_history_is_not_read(spark):
    """Rows of earlier batches may be moved away (archived): their ids still count as seen."""
    folder, out, ckpt = (S.scratch(spark, n) for n in ("test-in", "test-out", "test-ckpt"))
    deliver(spark, folder, "a", [(1, 5, "mensual"), (2, 0, "mensual"), (1, 3, "mensual")])
    first = {(r["id"], r["cuando"].minute) for r in T.run_dedup(spark, folder + "/*", out, ckpt).collect()}
    assert first == {(1, 3), (2, 0)}  # the earliest delivery of the first batch
    shutil.rmtree(f"{out}/{T.BATCH}=0")
    deliver(spark, folder, "b", [(1, 1, "mensual"), (3, 0, "perpetua"), (2, 9, "mensual")])
    again = T.run_dedup(spark, folder + "/*", out, ckpt)
    assert {r["id"] for r in again.collect()} == {3}


def test_a_batch_runs_twice(spark, monkeypatch):
    """The job dies after a batch has stored its rows and before it is committed."""
    folder, out, ckpt = (S.scratch(spark, n) for n in ("test-in", "test-mon", "test-ckpt"))
    deliver(spark, folder, "a", [(1, 0, "mensual"), (2, 0, "perpetua")])
    T.run_monitor(spark, folder + "/*", out, ckpt)
    deliver(spark, folder, "b", [(2, 1, "perpetua"), (3, 1, "mensual"), (4, 1, "mensual")])
    real, calls = T.store, []

    def dies_after(batch, epoch, path):
        real(batch, epoch, path)
        calls.append(path)
        raise RuntimeError("killed")

    monkeypatch.setattr(T, "store", dies_after)
    try:
        T.run_monitor(spark, folder + "/*", out, ckpt)
        raise AssertionError("the batch should have died")
    except Exception as e:  # noqa: BLE001
        assert "killed" in str(e)
    monkeypatch.setattr(T, "store", real)
    assert calls
    got = {r["plan"]: (r["ventas"], r["bruto_c"]) for r in T.run_monitor(spark, folder + "/*", out, ckpt).collect()}
    assert got == {"mensual": (3, 800), "perpetua": (1, 200)}
    assert sorted(r["id"] for r in spark.read.parquet(out + "/notices").collect()) == [1, 2, 3, 4]
