"""Price engine at branch × channel × segment × product: nested support by hand, and the model-scored grid."""

from __future__ import annotations

import random

import numpy as np
import pytest

from starmetrics.operators import pricing as P
from starmetrics.operators.star import model
from starmetrics.plans import price_cells_q as PC
from tests.conftest import SF_SMALL


def test_nested_support(spark):
    rng = random.Random(4)
    home = {c: (rng.randrange(3), rng.choice("xy"), rng.choice("AB")) for c in range(40)}
    rows = [(*home[c], rng.randrange(6), c, rng.randrange(1, 50), rng.randrange(400)) for c in [rng.randrange(40) for _ in range(160)]]
    rows.append((9, "z", "C", 99, 77, 5, 10))  # one customer, one product, nobody else anywhere
    df = spark.createDataFrame(rows, "id_filial int, canal string, segmento string, id_producto int, id_cliente int, unidades int, dias_a_vencer int")
    got = {(r["id_filial"], r["canal"], r["segmento"], r["id_producto"]): r for r in P.supported_cells(df).collect()}
    names, col = list(P.SUPPORT), {"id_filial": 0, "canal": 1, "segmento": 2, "id_producto": 3}
    cells = {r[:4] for r in rows}
    for cell in cells:
        want = None
        for name in names:
            at = [col[k] for k in P.SUPPORT[name]]
            own = [r for r in rows if all(r[i] == cell[i] for i in at)]
            if len({r[4] for r in own}) >= 3:
                mean = sum(r[5] for r in own) / 6 / len({r[:4] for r in own})
                mine = [r for r in rows if r[:4] == cell]
                q, n = sum(r[5] for r in mine) / 6, len({r[4] for r in mine})
                want = (name, max(1.0, q if name == names[0] else (n * q + 3 * mean) / (n + 3)))
                break
        if want is None:
            assert cell not in got
        else:
            assert got[cell]["nivel_soporte"] == want[0] and got[cell]["q_base"] == pytest.approx(want[1], abs=1e-8)
    assert {r["nivel_soporte"] for r in got.values()} > {names[0]} and (9, "z", "C", 99) not in got


def test_model_scored_grid(spark):
    m = model(spark, SF_SMALL)
    grid = P.discount_grid(m.sellin, spark)
    cand = PC.cell_candidates(m, PC.line_risk(m))
    g = PC.accepted_grid(m, cand, grid).toPandas()
    assert len(g) == cand.count() * grid.count() and g.prob_aceptacion.between(0, 1).all() and g.prob_aceptacion.nunique() > 1
    d = g.d
    dem = np.minimum(g.q_base * (1 - d) ** g.elasticidad, 3 * g.q_base)
    unit = g.precio_lista * (1 - d) - g.costo
    risk = np.clip(g.riesgo_dev_base * (1 + 1.2 * np.clip((g.dias_cobertura - 90) / 90, 0, 1.5) + 0.9 * (g.dias_a_vencer < 180) + 1.5 * d), 0, 0.6)
    want = g.prob_aceptacion * dem * unit * (1 - risk) + np.minimum(g.prob_aceptacion * dem, g.unidades_por_vencer) * g.costo
    assert np.allclose(g.objetivo, want)
    best = P.optimise_cells(PC.accepted_grid(m, cand, grid), grid).toPandas()
    keys = ["id_filial", "canal", "segmento", "id_producto"]
    ok = g[(unit / (g.precio_lista * (1 - d))) >= 0.15].sort_values(["objetivo", "d"], ascending=[False, True]).drop_duplicates(keys)
    gain = ok.objetivo - ok.q_base * (ok.precio_lista - ok.costo) * (1 - ok.riesgo_dev_base)
    assert len(best) == min((gain > 0).sum(), len(best)) and (best.ganancia > 0).all() and (best.rank_segmento <= 5).all()
    assert set(map(tuple, best[keys + ["d"]].values.tolist())) <= set(map(tuple, ok[keys + ["d"]].values.tolist()))
