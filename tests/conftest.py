import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from starmetrics.session import get_session
    s = get_session(master="local[4]", shuffle_partitions=4)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb
    con = duckdb.connect()
    for v in ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]:
        con.execute(f"CREATE VIEW {v} AS SELECT * FROM read_parquet('{SF_SMALL}/{v}.parquet')")
    return con
