"""Every registered query against its SQL oracle (DuckDB) on the smallest scale factor."""

import datetime as dt
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from pricepanel.plans import catalog

TABLES = ["region", "nation", "supplier", "part", "lineitem", "events"]
NAMES = sorted(catalog.QUERIES)


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    if hasattr(v, "to_pydatetime"):
        v = v.to_pydatetime()
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, dt.date):
        return dt.datetime(v.year, v.month, v.day)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(records, cols):
    return sorted((tuple(_norm(r[c]) for c in cols) for r in records), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t)}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(catalog.ORACLES) == set(catalog.QUERIES)
    assert set(catalog.QUERIES) <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert {"day", "gpu_type", "avg_price_per_gpu_hour", "listings"} <= set(df.columns)


SPARK_TO_SQL = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                "boolean": "BOOLEAN", "date": "DATE", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP"}


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    sdf = entry.queries()[name](spark, SF_SMALL)
    srecs = [r.asDict(recursive=True) for r in sdf.collect()]
    sql = entry.oracle_sql()[name]
    ddf = con.execute(sql).df()
    assert sorted(sdf.columns) == sorted(ddf.columns)
    sql_types = {r[0]: r[1] for r in con.execute(f"DESCRIBE ({sql})").fetchall()}
    for f in sdf.schema.fields:
        assert SPARK_TO_SQL.get(f.dataType.simpleString()) == sql_types[f.name], (f.name, f.dataType, sql_types[f.name])
    cols = sorted(sdf.columns)
    assert _rows(srecs, cols) == _rows(ddf.to_dict("records"), cols)
