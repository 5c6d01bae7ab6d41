"""Every query with SQL gives DuckDB's rows."""

import duckdb
import pandas as pd
import pytest

from tidemill import catalog

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows(df: pd.DataFrame) -> list:
    df = df[sorted(df.columns)]
    return sorted(map(repr, df.astype(object).where(df.notna(), None).map(lambda x: x.isoformat() if hasattr(x, "isoformat") else float(x) if isinstance(x, float) else x).values.tolist()))


@pytest.fixture(scope="module")
def duck():
    out = duckdb.connect()
    for t in TABLES:
        out.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return out


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_matches_sql(spark, duck, name):
    made = catalog.queries()[name](spark, DATA).toPandas()
    want = duck.sql(catalog.oracle_sql()[name]).df()
    assert len(want) > 0
    assert sorted(made.columns) == sorted(want.columns)
    assert rows(made) == rows(want)
