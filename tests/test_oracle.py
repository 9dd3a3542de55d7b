"""End to end: every registered query with an oracle equals DuckDB on the same parquet tables."""

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from kredo.plans import catalog
from tools.compare import TABLES, digest, type_mismatches


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_oracle(spark, sf_dir, con, name):
    frame = queries()[name](spark, sf_dir)
    got = frame.toPandas()
    want = con.execute(oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert type_mismatches(frame.schema, con.sql(oracle_sql()[name])) == {}
    assert len(got) == len(want)
    assert digest(got) == digest(want)


def test_every_query_has_an_oracle_or_is_a_model():
    no_oracle = set(catalog.QUERIES) - set(catalog.ORACLE)
    assert all(n.startswith(("boost_", "gbt_", "kmeans_", "hyperparam_", "logreg_", "rf_", "model_")) for n in no_oracle)


def test_entry_smoke(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert len(df.columns) == 62 and df.count() >= 0
