"""Operator tests: brute force on small fixtures and invariants on the test tables."""

from __future__ import annotations

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL


# ---------------------------------------------------------------- global order helpers
def test_global_position_matches_row_number(spark):
    from starmetrics.operators.windows import global_position
    rows = [(i, (i * 37) % 11) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, v int")
    got = {r["id"]: r["_pos"] for r in global_position(df, [F.col("v"), F.col("id")]).collect()}
    expect = {id_: k + 1 for k, (id_, _) in enumerate(sorted(rows, key=lambda r: (r[1], r[0])))}
    assert got == expect


def test_global_position_running_sum(spark):
    from starmetrics.operators.windows import global_position
    rows = [(i, float(i % 7)) for i in range(100)]
    df = spark.createDataFrame(rows, "id int, v double")
    got = {r["id"]: r["_cum"] for r in global_position(df, [F.col("id")], cum_of=F.col("v")).collect()}
    run = 0.0
    for i, v in rows:
        run += v
        assert got[i] == pytest.approx(run)


@pytest.mark.parametrize("n", [1, 5, 8, 13])
def test_ntile_expr_matches_sql_ntile(spark, n):
    from starmetrics.operators.windows import ntile_expr
    df = spark.range(1, n + 1).withColumnRenamed("id", "pos").withColumn("n", F.lit(n))
    got = [r["b"] for r in df.select(ntile_expr(F.col("pos"), F.col("n"), 4).alias("b")).orderBy("pos").collect()]
    ref = [r["b"] for r in spark.sql(f"SELECT ntile(4) OVER (ORDER BY id) AS b FROM range(1, {n + 1})").collect()]
    assert got == ref


def test_exact_quantiles_match_numpy(spark):
    from starmetrics.operators.windows import exact_quantiles
    vals = [float((i * 7919) % 1000) / 7.0 for i in range(333)] + [3.0] * 50
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = exact_quantiles(df, "x", [0.6, 0.85, 0.95]).first()
    for p, name in [(0.6, "q_60"), (0.85, "q_85"), (0.95, "q_95")]:
        assert got[name] == pytest.approx(float(np.quantile(vals, p)), rel=1e-12)


def test_pareto_ties_share_cumulative(spark):
    from starmetrics.operators.windows import pareto
    df = spark.createDataFrame([("a", 50), ("b", 30), ("c", 30), ("d", 10)], "k string, v long")
    got = {r["k"]: (r["acumulado_pct"], r["dentro_80"]) for r in pareto(df, "k", "v").collect()}
    assert got["a"] == (pytest.approx(50 / 120), 1)
    assert got["b"] == got["c"] == (pytest.approx(110 / 120), 0)    # tied values share the cumulative sum
    assert got["d"] == (pytest.approx(1.0), 0)


# ---------------------------------------------------------------- evaluation metrics
def _fixture(spark):
    rng = np.random.default_rng(3)
    s = np.round(rng.random(300), 2)          # ties on purpose
    y = (rng.random(300) < s).astype(int)
    return spark.createDataFrame([(i, float(a), int(b)) for i, (a, b) in enumerate(zip(s, y))],
                                 "id int, s double, y int"), s, y


def test_roc_auc_equals_pairwise(spark):
    from starmetrics.operators.evaluate import roc_auc
    df, s, y = _fixture(spark)
    pos, neg = s[y == 1], s[y == 0]
    brute = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a, b in itertools.product(pos, neg)) / (len(pos) * len(neg))
    assert roc_auc(df, "s", "y").first()["roc_auc"] == pytest.approx(brute, abs=1e-12)


def test_average_precision_brute_force(spark):
    from starmetrics.operators.evaluate import average_precision
    df, s, y = _fixture(spark)
    ap, prev_r = 0.0, 0.0
    for t in sorted(set(s), reverse=True):
        sel = s >= t
        tp = y[sel].sum()
        r = tp / y.sum()
        ap += (r - prev_r) * tp / sel.sum()
        prev_r = r
    assert average_precision(df, "s", "y").first()["pr_auc"] == pytest.approx(ap, abs=1e-12)


def test_threshold_grid_brute_force(spark):
    from starmetrics.operators.evaluate import threshold_grid
    df, s, y = _fixture(spark)
    best_f1, u_f1, best_c, u_c = -1, None, math.inf, None
    for i in range(2, 91):
        u = round(i / 100, 2)
        p = s >= u
        tp, fp, fn = int((p & (y == 1)).sum()), int((p & (y == 0)).sum()), int((~p & (y == 1)).sum())
        f1 = 2 * tp / (2 * tp + fp + fn) if (2 * tp + fp + fn) else 0.0
        c = 4 * fn + fp
        if f1 > best_f1:
            best_f1, u_f1 = f1, u
        if c < best_c:
            best_c, u_c = c, u
    r = threshold_grid(df, "s", "y").first()
    assert (r["umbral_f1"], r["umbral_costo"]) == (u_f1, u_c)
    assert r["f1"] == pytest.approx(best_f1)


def test_decile_capture_brute_force(spark):
    from starmetrics.operators.evaluate import decile_capture
    df, s, y = _fixture(spark)
    order = sorted(range(len(s)), key=lambda i: (-s[i], i))
    r = decile_capture(df, "s", "y", "id").first()
    for pct in (10, 20, 30):
        k = max(int(len(s) * pct / 100), 1)
        assert r[f"captura_top{pct}"] == pytest.approx(sum(y[i] for i in order[:k]) / y.sum())


# ---------------------------------------------------------------- elasticity OLS
def test_fixed_effect_ols_equals_dummy_regression(spark):
    from starmetrics.operators.pricing import fe_ols
    rng = np.random.default_rng(5)
    n = 240
    mes = rng.integers(1, 13, n)
    lp = rng.normal(2.0, 0.3, n)
    lq = 1.0 - 1.7 * lp + 0.2 * mes + rng.normal(0, 0.1, n)
    df = spark.createDataFrame([(1, int(a), float(b), float(c)) for a, b, c in zip(mes, lp, lq)],
                               "g int, mes int, lp double, lq double")
    got = fe_ols(df, ["g"], min_obs=60).first()
    D = np.column_stack([np.ones(n), lp] + [(mes == k).astype(float) for k in range(2, 13)])
    beta, *_ = np.linalg.lstsq(D, lq, rcond=None)
    resid = lq - D @ beta
    r2 = 1 - (resid ** 2).sum() / ((lq - lq.mean()) ** 2).sum()
    assert got["elast"] == pytest.approx(beta[1], abs=1e-9)
    assert got["r2"] == pytest.approx(r2, abs=1e-9)


def test_fixed_effect_ols_requires_enough_rows(spark):
    from starmetrics.operators.pricing import fe_ols
    df = spark.createDataFrame([(1, 1, float(i), float(i)) for i in range(10)], "g int, mes int, lp double, lq double")
    assert fe_ols(df, ["g"], min_obs=60).first()["elast"] is None


# ---------------------------------------------------------------- pricing on a hand-made candidate
def test_grid_argmax_brute_force(spark):
    from starmetrics.operators import pricing as P
    cand = spark.createDataFrame(
        [("A", 1, 100.0, 10.0, 4.0, -2.0, 120.0, 60.0, 0.05, 200)],
        "segmento string, id_producto long, q_base double, precio_lista double, costo double, elasticidad double, "
        "dias_cobertura double, dias_a_vencer double, riesgo_dev_base double, unidades_por_vencer long")
    grid = spark.createDataFrame([(d,) for d in P.GRID[:6]], "d double")
    best = P.optimise(P.evaluate_grid(cand, grid), grid).first()

    def objective(d):
        pn = 10.0 * (1 - d)
        dem = min(100.0 * (1 - d) ** -2.0, 300.0)
        pa = min(max(0.30 + 4.0 * d, 0.0), 1.0)
        exc = min(max((120.0 - 90) / 90, 0.0), 1.5)
        risk = min(max(0.05 * (1 + 1.2 * exc + 0.9 * 1 + 1.5 * d), 0.0), 0.6)
        return pa * dem * (pn - 4.0) * (1 - risk) + min(pa * dem, 200) * 4.0, (pn - 4.0) / pn

    feas = [(objective(d)[0], -d, d) for d in P.GRID[:6] if objective(d)[1] >= 0.15]
    assert best["d"] == pytest.approx(max(feas)[2])
    assert best["objetivo"] == pytest.approx(max(feas)[0])
    assert best["en_borde_de_soporte"] == int(abs(best["d"] - P.GRID[5]) < 1e-9)


# ---------------------------------------------------------------- model invariants on the test tables
def test_stage_invariants(spark):
    from starmetrics.operators import cleanse as C
    from starmetrics.operators.star import model
    from starmetrics.sources import binding as B
    m = model(spark, SF_SMALL)
    s = m.sellin
    agg = s.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("id_linea").alias("ids"),
                F.min("unidades").alias("min_u"), F.min("importe_usd_c").alias("min_i"),
                F.count_if((F.col("tipo_documento") == "NC") != (F.col("signo") == -1)).alias("bad_sign")).first()
    assert agg["n"] == agg["ids"]                 # one row per line id
    assert agg["min_u"] >= 0 and agg["min_i"] >= 0  # amounts are absolute, the sign is separate
    assert agg["bad_sign"] == 0
    again = C.dedup_first(m.deduped, ["id_linea"], B.DEDUP_ORDER)
    assert again.count() == m.deduped.count()     # dedup is idempotent


def test_fact_reconciles_with_lines(spark):
    from starmetrics.operators.star import model
    m = model(spark, SF_SMALL)
    a = m.sellin.agg(F.sum(F.col("unidades") * F.col("signo")).alias("u"), F.sum("importe_usd_c").alias("i")).first()
    b = m.fact_ventas.agg(F.sum(F.col("unidades") * F.col("signo")).alias("u"), F.sum("importe_usd_c").alias("i")).first()
    assert (a["u"], a["i"]) == (b["u"], b["i"])


def test_shares_sum_to_one_and_bridge_closes(spark):
    from __spark_entry__ import queries
    q = queries()
    w18 = q["w18_share_of_total_and_parent"](spark, SF_SMALL).agg(F.sum("pct_total").alias("t")).first()
    assert w18["t"] == pytest.approx(1.0)
    pvm = q["va17_20_price_volume_mix"](spark, SF_SMALL).collect()
    for r in pvm:
        total = r["efecto_volumen"] + (r["efecto_precio_sku"] or 0) + (r["efecto_mix_sku"] or 0)
        if r["efecto_precio_sku"] is not None:
            assert total == pytest.approx(r["variacion_c"], abs=1e-2)


def test_history_features_use_earlier_months_only(spark):
    from starmetrics.operators.star import model
    from starmetrics.plans.windows_q import hist_rate, prior_dev
    m = model(spark, SF_SMALL)
    r = hist_rate(m, ["id_producto"], 40.0)
    first = r.groupBy("id_producto").agg(F.min("anio_mes").alias("anio_mes")).join(r, ["id_producto", "anio_mes"])
    prior = prior_dev(m).first()["prior"]
    vals = {round(x["tasa_prev"], 12) for x in first.collect()}
    assert vals == {round(prior, 12)}            # first month of every key sees no history


def test_publication_gate_blocks_on_critical(spark, tmp_path):
    from starmetrics.operators import quality as Q
    reg = spark.createDataFrame([("Q01", "CRÍTICO", "Validez")], "id_control string, estado string, dimension string")
    with pytest.raises(Q.PublicationBlocked):
        Q.publish(reg, spark.range(3), str(tmp_path / "out"))
    ok = spark.createDataFrame([("Q01", "OK", "Validez")], "id_control string, estado string, dimension string")
    Q.publish(ok, spark.range(3), str(tmp_path / "out2"))
    assert spark.read.parquet(str(tmp_path / "out2")).count() == 3


def test_validated_join_rejects_many_to_many(spark):
    from starmetrics.operators import joins as J
    left = spark.createDataFrame([(1,), (2,)], "k int")
    right = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    with pytest.raises(J.ManyToOneViolation):
        J.validated_left_join(left, right, ["k"])


def test_materialize_keeps_results(spark, tmp_path):
    from starmetrics.operators.star import StarModel
    m = StarModel(spark, SF_SMALL)
    before = m.fact_ventas.agg(F.count(F.lit(1)).alias("n"), F.sum("importe_usd_c").alias("s")).first()
    m2 = StarModel(spark, SF_SMALL)
    m2.materialize(str(tmp_path / "stage"))
    after = m2.fact_ventas.agg(F.count(F.lit(1)).alias("n"), F.sum("importe_usd_c").alias("s")).first()
    assert before == after
    assert m2.sellin.count() == m.sellin.count()


def test_grouped_global_position_restarts_per_group(spark):
    from starmetrics.operators.windows import global_position
    rows = [(g, i, float(i)) for g in ("a", "b", "c") for i in range(40 if g == "a" else 7)]
    df = spark.createDataFrame(rows, "g string, i int, v double")
    got = {(r["g"], r["i"]): (r["_pos"], r["_cum"])
           for r in global_position(df, [F.col("i")], group=["g"], cum_of=F.col("v")).collect()}
    for g, i, _ in rows:
        assert got[(g, i)] == (i + 1, pytest.approx(i * (i + 1) / 2))


# ---------------------------------------------------------------- refresh and restart
def test_streams_resume_after_restart(spark):
    from starmetrics.sources import sinks as S
    from starmetrics.streaming import sales as T
    folder = S.scratch(spark, "test-in")

    def deliver(name, ids):
        spark.sql(f"SELECT * FROM VALUES {', '.join(f'({i})' for i in ids)} AS t(id)").selectExpr(
            "CAST(id AS BIGINT) AS id", "CAST(id AS BIGINT) AS email", "CAST(100 AS BIGINT) AS usd_c",
            "TIMESTAMP_NTZ'2024-01-01 00:00:00' AS cuando", "'mensual' AS plan").write.parquet(f"{folder}/{name}")

    out, ckpt = S.scratch(spark, "test-out"), S.scratch(spark, "test-ckpt")
    mon, mckpt = S.scratch(spark, "test-mon"), S.scratch(spark, "test-mckpt")
    seen = set()
    for name, ids in (("a", [1, 2, 2]), ("b", [2, 3]), ("c", [1, 3, 4, 4])):
        deliver(name, ids)
        seen |= set(ids)
        got = T.run_dedup(spark, folder + "/*", out, ckpt)
        assert sorted(r["id"] for r in got.collect()) == sorted(seen)
        total = T.run_monitor(spark, folder + "/*", mon, mckpt, max_files=1).collect()
        assert [(r["ventas"], r["bruto_c"]) for r in total] == [(len(seen), 100 * len(seen))]
