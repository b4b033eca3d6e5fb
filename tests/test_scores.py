"""Stored scores and forecasts: who scored what, the measures from the stored rows, ridge by normal equations."""

from __future__ import annotations

import numpy as np
import pytest

from starmetrics import config as K
from starmetrics.operators import learn as L
from starmetrics.operators import scores as S
from starmetrics.operators.star import model
from starmetrics.plans import graph_q as GQ
from starmetrics.plans.windows_q import fc_lines
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def m(spark):
    return model(spark, SF_SMALL)


@pytest.fixture(scope="module")
def stored(m):
    return S.return_scores(m).toPandas()


def test_no_model_saw_its_rows(m, stored):
    assert len(stored) == fc_lines(m).count() and stored.id_linea.is_unique
    own = stored[stored.modelo > 0]
    assert (own.entrenado_hasta < own.anio_mes).all() and set(own.modelo) == {1, 2, 3}
    assert (stored[stored.modelo == 0].anio_mes <= K.WALK_CUTS[0]).all()
    assert stored.prob.between(0, 1).all()
    assert S.months_before(199803, 5) == 199710 and S.months_before(200012, 5) == 200007


def test_later_labels_change_nothing(m, stored):
    """With every label after the first cut turned round, the first model and its scores stay the same."""
    f = S._features(m)
    cut = K.WALK_CUTS[0]
    turned = f.withColumn("devuelta", S.F.when(S.F.col("anio_mes") > cut, 1 - S.F.col("devuelta")).otherwise(S.F.col("devuelta")))
    trees, iso = S.fit_until(turned, "devuelta", "id_linea", L.RETURN_NUM, L.RETURN_CAT, cut)
    again = L.score(trees, iso, f.filter((S.F.col("anio_mes") > cut) & (S.F.col("anio_mes") <= K.WALK_CUTS[1]))).select("id_linea", S.F.round("prob", 5).alias("p")).toPandas()
    both = stored[stored.modelo == 1].merge(again, on="id_linea")
    assert len(both) == (stored.modelo == 1).sum() and np.allclose(both.prob, both.p, atol=1e-5)


def test_measures_from_the_stored_scores(m, stored):
    q = np.quantile(stored.prob, K.RISK_BAND_QUANTILES)
    band = np.array(K.RISK_BANDS)[np.searchsorted(q, stored.prob, side="left")]
    assert (band == stored.banda_riesgo).all()
    region = {r["id_filial"]: r["region"] for r in m.branches.collect()}
    d = stored.assign(region=stored.id_filial.map(region), anio=stored.anio_mes // 100)
    got = {(r["anio"], r["region"]): r for r in GQ.measures(m, ["importe_en_riesgo", "pedidos_criticos", "prob_media_devolucion", "captura_top10"], ["anio", "region"]).collect()}
    assert len(got) == d.groupby(["anio", "region"]).ngroups
    for key, g in d.groupby(["anio", "region"]):
        r = got[key]
        assert r["importe_en_riesgo"] == pytest.approx((g.prob * g.importe_usd_c).sum())
        assert r["pedidos_criticos"] == (g.banda_riesgo == "Crítico").sum() and r["prob_media_devolucion"] == pytest.approx(g.prob.mean())
        top = g.devuelta[g.prob >= np.quantile(g.prob, 0.9) - 1e-12].sum()
        assert r["captura_top10"] == pytest.approx(top / g.devuelta.sum()) if g.devuelta.sum() else r["captura_top10"] is None


def normal_equations(d, features, alpha):
    train = d[(d.anio_mes <= K.CUT_VALID)].dropna(subset=[*features, "y"])
    x, y = train[features].astype(float).to_numpy(), train.y.to_numpy()
    mu, sd = x.mean(axis=0), x.std(axis=0)
    z = (x - mu) / np.maximum(sd, 1e-6)
    w = np.linalg.solve(z.T @ z + alpha * np.eye(len(features)), z.T @ (y - y.mean())) / np.maximum(sd, 1e-6)
    return w, y.mean() - mu @ w


def test_returns_forecast(m):
    d = S.rate_frame(m).toPandas().sort_values(["id_filial", "anio_mes"])
    got = S.returns_forecast(m).toPandas()
    w, b = normal_equations(d, S.RATE_FEATURES, got.alpha.iloc[0])
    full = d.dropna(subset=S.RATE_FEATURES)
    rate = np.clip(1 / (1 + np.exp(-(full[S.RATE_FEATURES].astype(float).to_numpy() @ w + b))), 0, K.FORECAST_RATE_MAX)
    j = full.assign(want=rate).merge(got, on=["id_filial", "anio_mes"], suffixes=("", "_g"))
    assert len(j) == len(full) == len(got) and np.allclose(j.want, j.tasa_proyectada, atol=1e-7)
    assert np.allclose(j.devuelto_proyectado_c, (j.tasa_proyectada * j.importe_c).round(2), atol=0.02)
    assert (j.es_holdout_g == (j.anio_mes > K.CUT_VALID)).all() and j.es_holdout_g.sum() > 0


def test_outlook_feeds_on_itself(m):
    d = S.rate_frame(m).toPandas().sort_values(["id_filial", "anio_mes"])
    w, b = L.ridge_fit(S.rate_frame(m), S.RATE_FEATURES, "y")[:2]
    got = {(r["id_filial"], r["anio_mes"]): r["tasa_proyectada"] for r in S.returns_outlook(m).collect()}
    end = max(d.anio_mes // 100 * 12 + d.anio_mes % 100 - 1) + K.OUTLOOK_MONTHS
    start = K.CUT_VALID // 100 * 12 + K.CUT_VALID % 100 - 1
    seen = 0
    for branch, g in d[d.anio_mes <= K.CUT_VALID].groupby("id_filial"):
        if len(g) < 3:
            continue
        lags = list(g.y.iloc[-3:][::-1])
        drivers = [g[n].iloc[-1] for n in S.DRIVERS]
        for i in range(start + 1, end + 1):
            mes = i % 12 + 1
            x = [lags[0], lags[1], sum(lags) / 3, np.sin(2 * np.pi * mes / 12), np.cos(2 * np.pi * mes / 12), *drivers]
            p = min(max(1 / (1 + np.exp(-(np.dot(w, x) + b))), K.RETURN_RATE_CLIP[0]), K.FORECAST_RATE_MAX)
            assert got[branch, i // 12 * 100 + mes] == pytest.approx(p, rel=1e-9)
            lags = [np.log(p / (1 - p)), *lags[:2]]
            seen += 1
    assert seen == len(got) > 0


def test_investment_forecast(m):
    d = S.investment_frame(m).toPandas()
    got = S.investment_forecast(m).toPandas()
    w, b = normal_equations(d, S.INVEST_FEATURES, got.alpha.iloc[0])
    full = d.dropna(subset=S.INVEST_FEATURES)
    usd = np.maximum(np.expm1(full[S.INVEST_FEATURES].astype(float).to_numpy() @ w + b), 0)
    j = full.assign(want=usd * 10_000).merge(got, on=["id_filial", "anio_mes"], suffixes=("", "_g"))
    assert len(j) == len(got) and np.allclose(j.want, j.forecast_cpct, rtol=1e-6, atol=1)
    total = GQ.measures(m, ["inversion_proyectada", "precision_forecast"], []).first()
    assert total["inversion_proyectada"] == pytest.approx(got.forecast_cpct.sum() / 100)
    h = got[got.es_holdout == 1]
    assert total["precision_forecast"] == pytest.approx(1 - (h.real_cpct - h.forecast_cpct).abs().sum() / h.real_cpct.sum())
