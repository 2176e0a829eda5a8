import math
import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as contract  # noqa: E402
from quillgraph.registry import TABLES  # noqa: E402

SLOW = {"louvain", "top_communities", "lsh_sweep", "lsh_sweep_pivot", "same_as_edges", "er_train_metrics", "er_title_train_metrics", "same_as_all_types"}


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9) + 0.0
    return value


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_sql(spark, sf, name):
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    ours = contract.queries()[name](spark, sf)
    theirs = connection.sql(contract.oracle_sql()[name])
    columns = sorted(ours.columns)
    assert columns == sorted(theirs.columns)
    at = [theirs.columns.index(c) for c in columns]
    left = sorted(repr([plain(row[c]) for c in columns]) for row in ours.collect())
    right = sorted(repr([plain(row[i]) for i in at]) for row in theirs.fetchall())
    assert left == right


@pytest.mark.parametrize("name", sorted(set(contract.queries()) - set(contract.oracle_sql()) - SLOW))
def test_query_without_sql_runs(spark, sf, name):
    assert contract.queries()[name](spark, sf).columns


@pytest.mark.parametrize("name", ["lsh_sweep_pivot", "top_communities", "er_title_train_metrics", "same_as_all_types"])
def test_slow_query_runs_to_its_end(spark, sf, name):
    rows = contract.queries()[name](spark, sf).collect()
    assert rows
    if name == "er_title_train_metrics":
        assert rows[0]["entity_type"] == "DIAGNOSIS" and rows[0]["weighted_f1"] > 0.9 and not rows[0]["in_sample"]
    if name == "same_as_all_types":
        assert {r["label"] for r in rows} <= {"Medication", "Diagnosis"} and all(0.5 <= r["confidence"] <= 1 for r in rows)
