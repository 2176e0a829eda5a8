import math
import os

import duckdb
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from quillgraph.llm.queries import ORACLE, QUERIES

from . import cases
from .test_tokens import check_packing

TABLES = ["documents", "embeddings", "pages", "labels", "benchmark"]


def plain(value):
    return ("nan" if math.isnan(value) else round(value, 9) + 0.0) if isinstance(value, float) else value


def test_every_operator_is_registered():
    names = [n for n in contract.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in contract.queries()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, sf, name):
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    ours, theirs = QUERIES[name](spark, sf), connection.sql(ORACLE[name])
    columns = sorted(ours.columns)
    assert columns == sorted(theirs.columns)
    at = [theirs.columns.index(c) for c in columns]
    left = sorted(repr([plain(r[c]) for c in columns]) for r in ours.collect())
    assert left == sorted(repr([plain(r[i]) for i in at]) for r in theirs.fetchall())


def test_repeated_strings_over_the_table(spark, sf):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op4_suffix_dedup"](spark, sf).collect()}
    assert got == cases.strings(texts)


@pytest.mark.parametrize("name", ["op2_warc", "op3_sentencepiece", "op6_quality", "op7_pack", "op8_token_counts"])
def test_queries_without_sql_run(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0


def test_pipeline_stage_by_stage(spark, sf, tmp_path):
    from tokenizers import Tokenizer

    from quillgraph.llm.byte_bpe import default_path

    docs = spark.read.parquet(os.path.join(sf, "documents.parquet"))
    columns, held = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, held[-1], sf).write.parquet(str(tmp_path / name))
        held.append(spark.read.parquet(str(tmp_path / name)))
    good, exact, near, cut, packed = held[1:]
    for table in (good, exact, near, cut):
        assert table.columns == columns
    texts = [{r["doc_id"]: r["text"] for r in t.collect()} for t in (docs, good, exact, near, cut)]

    judged = QUERIES["op6_quality"](spark, sf).filter("keep").collect()
    assert set(texts[1]) == {r["doc_id"] for r in judged}
    last = {}
    for i, t in texts[1].items():
        last[cases.lower(t)] = max(i, last.get(cases.lower(t), i))
    assert set(texts[2]) == set(last.values())
    assert set(texts[3]) == {i for i, (_, c) in cases.jaccard(texts[2]).items() if i == c}
    for i, (words, removed, sha) in cases.passages(texts[3]).items():
        if removed:
            assert cases.sha(texts[4][i].encode()) == sha and len(cases.WORD.findall(texts[4][i])) == words - removed
        else:
            assert texts[4][i] == texts[3][i]
    assert {r["doc_id"]: r["n_chars"] for r in cut.collect()} == {i: len(t) for i, t in texts[4].items()}
    tokenizer = Tokenizer.from_file(default_path())
    ids_of = {i: tokenizer.encode(t, add_special_tokens=False).ids for i, t in texts[4].items()}
    used, least = check_packing(packed.collect(), ids_of)
    assert used <= 1.02 * least + 2
