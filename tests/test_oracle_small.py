"""DuckDB oracle on the smallest tables for a representative subset (the full set runs
with ``tools/check_oracle.py`` at sf0.01)."""

from __future__ import annotations

import pytest

from tests.conftest import SF_SMALL

KEYS = [
    "ba01_08_base_measures_region_month", "c16_stage_sellin_without_latent_columns", "b06_fact_ventas",
    "q01_q20_dq_control_registry", "va06_16_sellout_and_market_share", "lo11_20_returns_measures",
    "w12_quantile_risk_bands", "m06_roc_auc_with_ties", "pr01_pr02_elasticity_fe_ols_with_fallback",
    "t01_retry_safe_stream_ingestion", "v12_matrix_pivot_otif", "g10_dense_ranking",
]


def _rows(df):
    from tools.check_oracle import rows_of
    return rows_of(df)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck, key):
    from __spark_entry__ import oracle_sql, queries
    s = queries()[key](spark, SF_SMALL).toPandas()
    o = duck.execute(oracle_sql()[key]).fetchdf()
    sc, sr = _rows(s)
    oc, orr = _rows(o)
    assert sc == oc
    assert sr == orr


def test_entry_smoke(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.count() > 0
    assert "margen_bruto_pct" in df.columns
