"""The driver contract, and a sample of registered queries against their SQL."""

import duckdb
import pytest

import __spark_entry__ as contract
from check_oracles import compare
from derrick.plans import catalog

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
HEAVY = ("m1_knn_impute_rows", "k13", "x1", "m9", "m10", "m12", "m13", "m15", "m17", "k6", "x2", "x3")


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def test_entry_has_a_stable_schema(spark):
    result = contract.entry(spark)
    assert result.columns[:4] == ["DAYTIME", "OIL_VOL", "GAS_VOL", "WAT_VOL"] and result.count() == 2281


def test_every_oracle_belongs_to_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", [n for n in catalog.queries() if not n.startswith(HEAVY)])
def test_query_matches_sql(spark, sql, name):
    line = compare(spark, sql, name, FOLDER)
    assert line.startswith(("ok", "rows")), line
