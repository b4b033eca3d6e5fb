"""Orphans on tables from which customers and parts were removed: counted, named, and nothing lost unseen."""

from __future__ import annotations

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from starmetrics.sources import sinks as S
from tests.conftest import SF_SMALL
from tools.check_oracle import rows_of

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


@pytest.fixture(scope="module")
def holes(spark):
    """sf0.001 without every 20th customer and part."""
    folder = S.scratch(spark, "test-holes")
    for t in TABLES:
        df = spark.read.parquet(f"{SF_SMALL}/{t}.parquet")
        if t in ("customer", "part"):
            df = df.filter(f"{t[0]}_{'cust' if t == 'customer' else 'part'}key % 20 <> 3")
        df.coalesce(1).write.parquet(f"{folder}/{t}.parquet")
    return folder


KEYS = ["j05_referential_orphans", "q01_q20_dq_control_registry", "q06_q14_rejected_lines_reconciliation"]


def test_orphans_against_sql(spark, holes):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{holes}/{t}.parquet/*.parquet')")
    got = {k: queries()[k](spark, holes).toPandas() for k in KEYS}
    for k in KEYS:
        assert rows_of(got[k]) == rows_of(con.execute(oracle_sql()[k]).df()), k
    reg = got["q01_q20_dq_control_registry"].set_index("id_control")
    assert reg.loc["Q14", "filas_afectadas"] > 100 and reg.loc["Q06", "filas_afectadas"] == 0 and reg.loc["Q13", "filas_afectadas"] > 100
    rec = got["q06_q14_rejected_lines_reconciliation"].iloc[0]
    assert rec["rechazadas_cliente"] == reg.loc["Q14", "filas_afectadas"] == got["j05_referential_orphans"].iloc[0]["huerfanos_cliente"]
    assert rec["cuadra"] == 1 and rec["rechazadas_cambio"] == 0


def test_missing_rate_is_no_orphan(spark, holes):
    """A month without a rate for one currency."""
    from starmetrics.operators import quality as Q
    from starmetrics.operators.star import StarModel
    m = StarModel(spark, SF_SMALL)
    all_fx = m.fx
    row = m.deduped.groupBy("anio_mes", "moneda").count().orderBy("count", "anio_mes", "moneda").first()
    m.__dict__["fx"] = all_fx.filter(f"NOT (anio_mes = {row['anio_mes']} AND moneda = '{row['moneda']}')")
    rec = Q.reconcile_rejected(m).first()
    assert rec["rechazadas_cambio"] == row["count"] and rec["rechazadas_cliente"] == 0 and rec["cuadra"] == 1
