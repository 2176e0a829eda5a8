import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quillgraph.llm.packing import OpenBins, pack_documents
from quillgraph.llm.sentencepiece_fst import Transducer, decode_ids, default_path, encode_texts, load
from quillgraph.llm.token_counts import context_limits, encoded_lengths, length_histogram

from . import cases

ODD = ["<|endoftext|> a<|endoftext|>", "don't  we'll\r\n\t x  ", "日本語 ½ ²³ ٣   x", "́e\u0000﻿", "🙂" * 50, "ſ K"]


@pytest.fixture(scope="module")
def texts():
    return cases.messy_texts() | {1000 + i: t for i, t in enumerate(ODD)}


@pytest.fixture(scope="module")
def ids_of(texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return {i: tokenizer.encode(t or "", add_special_tokens=False).ids for i, t in texts.items()}


def check_packing(rows, ids_of, size=1024):
    pieces, places = {}, {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert set(pieces) == set(ids_of)
    for i, own in pieces.items():
        ids, at = np.array([*ids_of[i], 2], "<u4"), 0
        own.sort(key=lambda r: r["piece"])
        for k, r in enumerate(own):
            part = ids[at : at + r["length"]]
            assert (r["piece"], r["start"], r["length"]) == (k, at, len(part))
            assert r["ids_crc32"] == zlib.crc32(part.tobytes())
            assert r["length"] == size or k == 0
            at += r["length"]
        assert at == len(ids) and (len(ids) > size or len(own) == 1)
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= size
    return len(places), -(-sum(len(ids) + 1 for ids in ids_of.values()) // size)


def test_packing(spark, texts, ids_of):
    docs = cases.table(spark, texts)
    used, least = check_packing(pack_documents(docs).collect(), ids_of)
    assert used <= 1.02 * least + 2


def test_packing_in_many_rounds(spark, texts, ids_of):
    rows = pack_documents(cases.table(spark, texts, 9), open_bins=2, fan_in=2).collect()
    check_packing(rows, ids_of)


def test_the_fullest_bin_closes_first():
    bins = OpenBins(10, 2)
    assert list(bins.add("a", 6)) == [] and list(bins.add("b", 7)) == []
    assert list(bins.add("c", 5)) == [[("b", 0)]]
    assert list(bins.add("d", 4)) == [[("a", 0), ("d", 6)]]
    assert list(bins.rest()) == [[("c", 0)]]


def test_packing_of_empty_and_odd_tables(spark):
    docs = cases.table(spark, {1: None, 2: "a"})
    assert pack_documents(docs.filter("doc_id > 5")).collect() == []
    rows = spark.createDataFrame([(None, "a"), (4, "b"), (4, "b"), (7, None)], "doc_id long, text string")
    found = pack_documents(rows).collect()
    assert sorted((r["doc_id"], r["length"]) for r in found) == [(4, 2), (4, 2), (7, 1)]
    assert sorted(r["offset"] for r in found) == [0, 2, 4]


def test_token_counts(spark, texts, ids_of):
    lengths = encoded_lengths(cases.table(spark, texts))
    got = {r["doc_id"]: r["length"] for r in lengths.collect()}
    assert got == {i: len(ids) for i, ids in ids_of.items()}
    all_ = sorted(got.values())
    for block in (3, 1024):
        rows = context_limits(length_histogram(lengths), block).collect()
        assert sorted(r["length"] for r in rows) == sorted(set(all_))
        for r in rows:
            longer = [n for n in all_ if n > r["length"]]
            assert (r["n_docs"], r["n_tokens"]) == (all_.count(r["length"]), all_.count(r["length"]) * r["length"])
            assert (r["longer_docs"], r["longer_tokens"]) == (len(longer), sum(longer))
            assert (r["total_docs"], r["total_tokens"]) == (len(all_), sum(all_))
            assert r["truncated_tokens"] == sum(min(n, r["length"]) for n in all_)
            assert r["share"] == pytest.approx(1 - len(longer) / len(all_))


def test_token_counts_of_nothing_and_nulls(spark):
    empty = cases.table(spark, {1: "a"}).filter("doc_id < 0")
    assert context_limits(length_histogram(encoded_lengths(empty))).collect() == []
    rows = spark.createDataFrame([(None, None), (1, None), (1, "a")], "doc_id long, text string")
    assert sorted(r["length"] for r in encoded_lengths(rows).collect()) == [0, 0, 1]
    nulls = spark.createDataFrame([(None,), (3,)], "length long")
    assert [tuple(r) for r in length_histogram(nulls).collect()] == [(3, 1)]


def test_sentencepiece_equals_the_library(spark, texts):
    reference = sentencepiece.SentencePieceProcessor(model_file=default_path())
    encoded = encode_texts(cases.table(spark, texts))
    rows = encoded.collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r["ids"] == reference.encode(texts[r["doc_id"]] or "")
        assert r["n_ids"] == len(r["ids"]) and r["round_trip"]
    back = {r["doc_id"]: r["text"] for r in decode_ids(encoded).collect()}
    assert back == {i: t or "" for i, t in texts.items()}


def test_sentencepiece_on_random_texts():
    reference, model, draw = sentencepiece.SentencePieceProcessor(model_file=default_path()), load(default_path()), random.Random(3)
    for _ in range(3000):
        text = "".join(draw.choices(" \n\taabetnr  ▁é日本ö😀0129,.!&_²%$#<>s/x\u0000", k=draw.randint(0, 50))) + " " * draw.choice([0, 0, 1, 15, 31, 70])
        ids = reference.encode(text)
        assert model.encode(text) == ids
        assert model.decode(ids) == reference.decode(ids)


def test_unigram_models_take_the_path_of_least_weight(tmp_path):
    from sentencepiece import sentencepiece_model_pb2 as proto

    spec = proto.ModelProto()
    spec.trainer_spec.model_type = 1
    spec.normalizer_spec.remove_extra_whitespaces = False
    spec.trainer_spec.byte_fallback = True
    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3), *((f"<0x{b:02X}>", 0.0, 6) for b in range(256))]
    draw = random.Random(5)
    known = ["▁", "a", "b", "c", "ab", "bc", "abc", "▁a", "▁ab", "ca", "cab", "bb", "▁▁"]
    pieces += [(p, -draw.uniform(1, 6), 1) for p in known]
    for piece, score, kind in pieces:
        spec.pieces.add(piece=piece, score=score, type=kind)
    reference = sentencepiece.SentencePieceProcessor(model_proto=spec.SerializeToString())
    model = Transducer(spec.SerializeToString())
    for _ in range(500):
        text = "".join(draw.choices("aabbc é", k=draw.randint(0, 20)))
        ours, theirs = model.encode(text), reference.encode(text)
        assert model.decode(ours) == text  # paths of equal weight may differ
        assert sum(model.score[i] for i in ours) == pytest.approx(sum(model.score[i] for i in theirs), rel=1e-5)


def test_decoding_of_nulls_and_foreign_ids(spark):
    rows = spark.createDataFrame([(1, None), (2, []), (3, [None, 10**9, 5])], "doc_id long, ids array<int>")
    assert {r["doc_id"]: r["text"] for r in decode_ids(rows).collect()} == {1: "", 2: "", 3: " ⁇  ⁇ \x02"}


def test_encoding_is_not_shuffled(spark, texts):
    plan = encode_texts(cases.table(spark, texts).filter(F.col("doc_id") > 0))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1  # that of the fixture
