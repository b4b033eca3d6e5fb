"""Atomic refresh (S-8, T-3) against a day-by-day version."""

from __future__ import annotations

import datetime as dt
import itertools

import pytest

from starmetrics.sources import sinks as S
from starmetrics.sources import snapshots
from starmetrics.streaming import sales as T

SCHEMA = "fecha date, v int, anio_mes int"


def day(k):
    return dt.date(2024, 1, 1) + dt.timedelta(days=k)


def frame(spark, days):
    """days: number → value."""
    return spark.createDataFrame([(day(k), v, day(k).year * 100 + day(k).month) for k, v in days.items()], SCHEMA)


def rows(spark, path):
    return sorted((r["fecha"], r["v"]) for r in snapshots.read(spark, path).collect())


def want(base, extracts):
    """Each day comes from the extract with the latest last date that covers it; ``extracts``: (days back, rows)."""
    out = dict(base)
    known = max(base) if base else -1
    for back, ext in sorted(extracts, key=lambda e: max(e[1])):
        last = max(ext)
        if last < known and base:
            continue
        out = {k: v for k, v in out.items() if not last - back < k <= last} | {k: v for k, v in ext.items() if k > last - back}
    return sorted((day(k), v) for k, v in out.items())


def fresh(spark, base):
    path = S.scratch(spark, "test-snapshot")
    snapshots.create(frame(spark, base), path, "fecha", "anio_mes")
    return path


def test_window_inside_a_month(spark):
    """Rows before the cutoff stay, rows after it are the extract's, also those it withdrew."""
    base = dict.fromkeys(range(61), 0)
    path = fresh(spark, base)
    extract = {k: 1 for k in range(10, 71) if k not in (55, 60)}
    for _ in range(2):  # and again
        S.incremental_refresh(spark, frame(spark, extract), path, "fecha", 20, "anio_mes")
        assert rows(spark, path) == want(base, [(20, extract)]) == [(day(k), int(k > 50)) for k in range(71) if k not in (55, 60)]
    S.incremental_refresh(spark, frame(spark, {0: 9}).limit(0), path, "fecha", 20, "anio_mes")
    assert len(rows(spark, path)) == 69


def test_older_extract_deletes_nothing(spark):
    base = dict.fromkeys(range(91), 0)
    path = fresh(spark, base)
    S.incremental_refresh(spark, frame(spark, dict.fromkeys(range(36, 81), 1)), path, "fecha", 45, "anio_mes")
    assert rows(spark, path) == [(day(k), 0) for k in range(91)]
    newer = dict.fromkeys(range(80, 101), 2)
    S.incremental_refresh(spark, frame(spark, newer), path, "fecha", 21, "anio_mes")
    late = dict.fromkeys(range(60, 96), 3)  # last day 95: days 92 on belong to nobody older, 80 on to the newer one
    S.incremental_refresh(spark, frame(spark, late), path, "fecha", 36, "anio_mes")
    assert rows(spark, path) == [(day(k), 2 if k > 79 else 3 if k > 59 else 0) for k in range(101)]
    assert snapshots.latest(spark, path).high_water == day(100)


def test_any_order(spark):
    base = dict.fromkeys(range(30), 0)
    extracts = [(20, {k: 1 for k in range(20, 41)}), (25, {k: 2 for k in range(30, 66) if k % 4}), (10, {k: 3 for k in range(60, 71)})]
    expect = want(base, extracts)
    for order in itertools.permutations(extracts):
        path = fresh(spark, base)
        for back, ext in order:
            S.incremental_refresh(spark, frame(spark, ext), path, "fecha", back, "anio_mes")
        assert rows(spark, path) == expect


def test_killed_and_run_again(spark, monkeypatch):
    """Before the commit, after the commit, with half the partitions written: the table is that of an unbroken run."""
    base = dict.fromkeys(range(91), 0)
    extract = {k: 1 for k in range(50, 101) if k % 5}
    expect = want(base, [(45, extract)])
    path = fresh(spark, base)
    real = snapshots.commit

    def dead(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(snapshots, "commit", dead)
    with pytest.raises(KeyboardInterrupt):
        S.incremental_refresh(spark, frame(spark, extract), path, "fecha", 45, "anio_mes")
    assert rows(spark, path) == [(day(k), 0) for k in range(91)]
    # died between two partitions: one folder of the next version is there, and nobody names it
    frame(spark, {95: 7}).write.partitionBy("anio_mes").parquet(f"{path}/data/version={snapshots._new_version(1)}")
    assert rows(spark, path) == [(day(k), 0) for k in range(91)]
    monkeypatch.setattr(snapshots, "commit", real)
    for _ in range(2):  # the second: committed, but the caller didn't hear of it
        S.incremental_refresh(spark, frame(spark, extract), path, "fecha", 45, "anio_mes")
        assert rows(spark, path) == expect
    snapshots.expire(spark, path)
    assert rows(spark, path) == expect


def test_emptied_and_untouched_partitions(spark):
    base = dict.fromkeys(range(91), 0)
    path = fresh(spark, base)
    before = snapshots.latest(spark, path).partitions
    S.incremental_refresh(spark, frame(spark, {91: 1}), path, "fecha", 40, "anio_mes")  # March is withdrawn but for its last day
    after = snapshots.latest(spark, path).partitions
    assert rows(spark, path) == [(day(k), 0) for k in range(52)] + [(day(91), 1)]
    assert after["anio_mes=202401"] == before["anio_mes=202401"] and "anio_mes=202403" not in after


def test_nulls_names_and_first_extract(spark):
    schema = "fecha date, v int, area string"
    df = spark.createDataFrame([(day(0), 1, "a b/c=d%"), (None, 2, None), (day(9), 3, None), (day(9), 4, "é:x")], schema)
    path = S.scratch(spark, "test-snapshot")
    S.incremental_refresh(spark, df, path, "fecha", 5, "area")  # no table yet: the window only
    assert sorted(r["v"] for r in snapshots.read(spark, path).collect()) == [3, 4]
    path = S.scratch(spark, "test-snapshot")
    snapshots.create(df, path, "fecha", "area")
    more = spark.createDataFrame([(day(10), 5, "a b/c=d%"), (day(11), 6, None)], schema)
    S.incremental_refresh(spark, more, path, "fecha", 3, "area")
    got = {(r["fecha"], r["v"], r["area"]) for r in snapshots.read(spark, path).collect()}
    assert got == {(day(0), 1, "a b/c=d%"), (None, 2, None), (day(10), 5, "a b/c=d%"), (day(11), 6, None)}
    plain = S.write_layer(df, S.scratch(spark, "test-plain"), ["area"])
    with pytest.raises(ValueError):
        S.incremental_refresh(spark, more, plain, "fecha", 3, "area")


def test_stream_of_extracts(spark):
    """T-3 with an extract that comes late, after a restart."""
    base = dict.fromkeys(range(60), 0)
    path, folder, ckpt = fresh(spark, base), S.scratch(spark, "test-ext"), S.scratch(spark, "test-ext-ckpt")
    late, newest = {k: 1 for k in range(40, 71)}, {k: 2 for k in range(55, 81) if k != 58}

    def run():
        return T.run_incremental(spark, folder, SCHEMA, path, "fecha", 25, "anio_mes", ckpt)

    frame(spark, newest).write.parquet(folder + "/extract=2")
    run()
    frame(spark, late).write.parquet(folder + "/extract=1")
    got = sorted((r["fecha"], r["v"]) for r in run().collect())
    assert got == want(base, [(25, late), (25, newest)])
