"""Every registered query against its DuckDB statement (small scale factor)."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as se
from scarp.plans import catalog
from scarp.plans.oracle import ORACLE

SF_SMALL = "/root/testdata/sf0.001"

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()
STREAMING = {"stream_alerts_append", "stream_alerts_upsert", "stream_alert_log", "stream_gnss_forward_fill"}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if hasattr(v, "to_pydatetime"):
        v = v.to_pydatetime()
    if type(v).__name__ == "Decimal":
        return float(v)
    if hasattr(v, "item"):
        return v.item()
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    rows = [tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False)]
    return cols, sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def test_every_query_has_an_oracle():
    # (queries of the optional subpackage may do without one: theirs are tested there)
    assert set(catalog.QUERIES) == set(ORACLE) <= set(se.oracle_sql()) <= set(se.queries())


@pytest.mark.parametrize("name", [n for n in se.oracle_sql() if n not in STREAMING])
def test_query_matches_oracle(spark, con, name):
    sp = se.queries()[name](spark, SF_SMALL).toPandas()
    dk = con.execute(se.oracle_sql()[name]).df()
    sc, sr = _rows(sp)
    dc, dr = _rows(dk)
    assert sc == dc
    assert len(sr) == len(dr)
    assert sr == dr


def test_entry_smoke(spark):
    df = se.entry(spark)
    assert df.count() > 0
    assert "alert_level" in df.columns
