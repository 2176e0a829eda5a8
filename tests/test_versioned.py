import os

import pytest
from pyspark.sql import functions as F

from quillgraph.sources.upsert import upsert_edges, upsert_nodes
from quillgraph.sources.versioned import VersionConflict, VersionedTable, merge_edges, merge_nodes


def files_of(table):
    return {int(b): tuple(names) for b, names in table.manifest["files"].items()}


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def nodes(spark):
    return spark.range(1000).select("id", F.concat(F.lit("n"), "id").alias("name"), (F.col("id") % 7).alias("v"))


def test_untouched_buckets_keep_their_files(spark, tmp_path, nodes):
    path = str(tmp_path / "t")
    first = VersionedTable.create(nodes, path, ("id",), 16)
    assert rows_of(first.read()) == rows_of(nodes) and len(files_of(first)) == 16
    incoming = spark.createDataFrame([(3, "new"), (3, "newer"), (5000, None), (None, "x")], "id long, name string").withColumn("extra", F.lit(1))
    second = merge_nodes(first, incoming)
    touched = {b for b in files_of(second) if files_of(second)[b] != files_of(first).get(b)}
    placed = {r[0] for r in incoming.dropna(subset=["id"]).select(first.bucket_of()).distinct().collect()}
    assert touched == placed and 1 <= len(touched) <= 2
    for names in files_of(first).values():
        assert all(os.path.exists(f"{path}/{n}") for n in names)
    want = upsert_nodes(nodes, incoming, "id")
    assert rows_of(second.read().select(want.columns)) == rows_of(want)
    assert rows_of(first.read()) == rows_of(nodes)  # the old version is still there to read
    again = VersionedTable(spark, path)
    assert again.version == 2 and rows_of(again.read()) == rows_of(second.read())
    assert again.merge(incoming.filter("id IS NULL"), lambda a, b: a).version == 2
    assert again.vacuum() == 0 and rows_of(again.read()) == rows_of(second.read())


def test_failed_and_lost_writes_leave_the_old_version(spark, tmp_path, nodes):
    path = str(tmp_path / "t")
    table = VersionedTable.create(nodes, path, ("id",), 4)
    incoming = spark.createDataFrame([(1, "a", 1)], "id long, name string, v long")
    broken = F.raise_error(F.lit("stopped half way"))
    with pytest.raises(Exception, match="stopped half way"):
        table.merge(incoming, lambda current, rows: current.unionByName(rows).withColumn("v", F.when(F.col("name") == "a", broken).otherwise(F.col("v")).cast("long")))
    now = VersionedTable(spark, path)
    assert now.version == 1 and rows_of(now.read()) == rows_of(nodes)
    other = VersionedTable(spark, path)
    won = merge_nodes(other, incoming)
    with pytest.raises(VersionConflict):
        merge_nodes(now, incoming.withColumn("name", F.lit("late")))
    assert rows_of(VersionedTable(spark, path).read()) == rows_of(won.read())
    with pytest.raises(VersionConflict):
        VersionedTable.create(nodes, path, ("id",), 4)
    assert won.vacuum() >= 1  # what the failed and the lost write have left
    assert rows_of(VersionedTable(spark, path).read()) == rows_of(upsert_nodes(nodes, incoming, "id"))
    with pytest.raises(FileNotFoundError):
        VersionedTable(spark, str(tmp_path / "none"))


def test_edges_with_identity_and_new_columns(spark, tmp_path):
    ends = spark.range(20).select("id")
    old = spark.createDataFrame([(i % 20, i * 7 % 20, i % 3, f"w{i}") for i in range(60)], "src long, dst long, k int, w string")
    start = upsert_edges(None, old, ends, ends, ("k",))
    incoming = spark.createDataFrame([(1, 7, 1, "t"), (1, 7, 1, "s"), (2, 99, 0, "t"), (3, 4, 9, None)], "src int, dst int, k int, tag string")
    table = VersionedTable.create(start, str(tmp_path / "e"), ("src", "dst"), 8, files_per_bucket=2)
    merged = merge_edges(table, incoming, ends, ends, ("k",))
    want = upsert_edges(start, incoming, ends, ends, ("k",))
    assert rows_of(merged.read().select(want.columns)) == rows_of(want)


def test_empty_table(spark, tmp_path, nodes):
    table = VersionedTable.create(nodes.limit(0), str(tmp_path / "t"), ("id",), 4)
    assert table.read().collect() == [] and table.read().schema == nodes.schema
    assert rows_of(merge_nodes(table, nodes).read().select(nodes.columns)) == rows_of(nodes)
