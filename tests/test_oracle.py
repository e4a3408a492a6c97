"""Every registered query equals its DuckDB oracle (sf0.001)."""
import math
import os

import duckdb
import pytest

import __spark_entry__ as E

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        p = f"{sf}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def _norm(v):
    import pandas as pd
    if v is None or (not isinstance(v, (list, tuple, bytes)) and pd.api.types.is_scalar(v) and pd.isna(v)):
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v.item() if hasattr(v, "item") else v


def _rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted((tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False, name=None)),
                        key=repr)


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_oracle(spark, sf, con, name):
    s = _rows(E.queries()[name](spark, sf).toPandas())
    d = _rows(con.execute(E.oracle_sql()[name]).df())
    assert s[0] == d[0]
    assert s[1] == d[1]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "word_count" in df.columns
