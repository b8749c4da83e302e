"""Comparing a query with its SQL on the small test tables."""

from pathlib import Path

import duckdb
import pandas as pd
import pytest

SF_DIR = "/root/testdata/sf0.001"

needs_tables = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="the test tables are not there")


def _rows(frame):
    def plain(v):
        if pd.isna(v):
            return None
        return str(v) if isinstance(v, (str, bool)) else round(float(v), 5)

    return [tuple(map(plain, r)) for r in frame[sorted(frame.columns)].itertuples(index=False)]


def same(spark, query, sql):
    with duckdb.connect() as db:
        for path in Path(SF_DIR).glob("*.parquet"):
            db.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
        want = db.sql(sql).df()
    got = query(spark, SF_DIR).toPandas()
    assert set(got.columns) == set(want.columns)
    key = lambda rows: sorted(map(repr, rows))
    assert key(_rows(got.astype(object))) == key(_rows(want.astype(object)))
