"""Every registered query with an oracle must equal DuckDB on sf0.001."""

import math

import duckdb
import pandas as pd
import pytest

from paths import SF_SMALL
from kestrel.plans import all_oracles, all_queries
from kestrel.sources.tables import TABLES

SLOW = ("m1_m7", "v10_mllib", "m8_m10", "m9_batch")
ORACLES = all_oracles()
NAMES = sorted(n for n in all_queries() if n in ORACLES)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if not isinstance(v, (list, tuple, str)) and pd.isna(v):
        return None
    if isinstance(v, float):
        return v + 0.0
    return v.item() if hasattr(v, "item") else v


def _rows(pdf):
    cols = sorted(pdf.columns)
    rows = [tuple(_norm(v) for v in r) for r in pdf[cols].itertuples(index=False, name=None)]
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    got = all_queries()[name](spark, SF_SMALL).toPandas()
    want = con.execute(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert _rows(got) == _rows(want)


def test_every_query_registered_is_callable():
    qs = all_queries()
    assert len(qs) >= 90
    assert not [n for n in qs if "pipeline" in n or n.startswith("op")]
