"""Every query with SQL gives its SQL's rows on the smallest tables."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from spanlake import catalog

FOLDER = "/root/testdata/sf0.001"


def rows(df):
    def plain(v):
        v = v.tolist() if hasattr(v, "tolist") else v
        if v is None or v is pd.NaT or v is pd.NA or v != v:
            return None
        return round(v, 6) if isinstance(v, float) else v

    return sorted((tuple(plain(v) for v in r) for r in df[sorted(df.columns)].itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query(spark, name):
    con = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    assert rows(catalog.QUERIES[name](spark, FOLDER).toPandas()) == rows(con.execute(catalog.ORACLES[name]).df())


def test_entry(spark):
    assert entry.entry(spark).count() > 0 and set(entry.oracle_sql()) <= set(entry.queries())
