import corpus_pipeline

from . import cases


def near_links(texts, size=5, percent=80):
    sets = {i: cases.shingles(t, size) for i, t in texts.items()}
    links = {i: {j for j, b in sets.items() if i == j or a & b and 100 * len(a & b) >= percent * len(a | b)} for i, a in sets.items()}
    return cases.components(links)


def test_near_copies_at_five_words_and_four_fifths(spark, sf):
    words = [f"w{i}" for i in range(122)]
    texts = {1: " ".join(words[:100]), 2: " ".join(words), 3: " ".join(words[:100] + [f"v{i}" for i in range(30)])}
    texts |= {i + 10: t for i, t in cases.messy_texts().items()}
    kept = {r["doc_id"] for r in corpus_pipeline.drop_near_copies(spark, cases.table(spark, texts), sf).collect()}
    assert {1, 3} <= kept and 2 not in kept
    assert kept == {i for i, c in near_links(texts).items() if i == c}


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)


def pairs(docs):
    return sorted((r["doc_id"], r["text"]) for r in docs.collect())


def test_exact_copies_under_repeated_ids(spark, sf):
    rows = [(5, "a"), (5, "b"), (9, "a"), (7, "c"), (7, "c"), (8, "D"), (8, "d"), (3, "e"), (2, "e")]
    kept = corpus_pipeline.drop_copies(spark, documents(spark, rows), sf)
    assert pairs(kept) == [(3, "e"), (5, "b"), (7, "c"), (8, "D"), (9, "a")]


def test_near_copies_under_repeated_ids(spark, sf, tmp_path):
    one, two = ([f"{c}{i}" for i in range(60)] for c in "xy")
    texts = [" ".join(w) for w in (one, two, [*one, "end"], [*two, "end"], [f"z{i}" for i in range(20)])]
    rows = [(5, texts[0]), (5, texts[1]), (9, texts[2]), (4, texts[3]), (6, texts[4]), (6, texts[4])]
    documents(spark, rows).write.parquet(str(tmp_path / "docs"))
    kept = corpus_pipeline.drop_near_copies(spark, spark.read.parquet(str(tmp_path / "docs")), sf)
    assert pairs(kept) == sorted([(5, texts[0]), (4, texts[3]), (6, texts[4])])


def test_passages_under_repeated_ids(spark, sf, tmp_path):
    shared, own = [f"s{i}" for i in range(20)], [f"o{i}" for i in range(30)]
    rows = [(1, " ".join(shared)), (5, " ".join(own + shared)), (5, "short text of its own"), (7, "x")]
    documents(spark, rows).write.parquet(str(tmp_path / "docs"))
    cut = corpus_pipeline.cut_passages(spark, spark.read.parquet(str(tmp_path / "docs")), sf)
    assert pairs(cut) == sorted([rows[0], (5, " ".join(own)), rows[2], rows[3]])
    assert all(r["n_chars"] == len(r["text"]) for r in cut.collect())


CLASHES = ["row", "key", "kept_text", "digest", "_digest", "_row_key", "_sha256", "n", "kept", "component_id", "mark", "text_sha256"]


def test_stages_pass_any_columns_through(spark, sf, tmp_path):
    """Null ids leave, null texts count as empty, and columns named like those inside a stage come out as they went in."""
    texts = {i * 3: t for i, t in enumerate(list(cases.messy_texts().values())[:40])}
    rows = [(i, t, "en", "s", None if t is None else len(t), *[f"{c}{i}" for c in CLASHES]) for i, t in texts.items()]
    rows += [(None, "no id", "en", "s", 5, *["x"] * len(CLASHES)), (200, None, None, None, None, *["x"] * len(CLASHES))]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHES)
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.schema.simpleString() == docs.schema.simpleString(), name
        for r in out.collect():
            assert r["doc_id"] is not None and (r["doc_id"] == 200 or all(r[c] == f"{c}{r['doc_id']}" for c in CLASHES)), name
        empty = stage(spark, docs.filter("doc_id < 0"), sf)
        assert empty.columns == docs.columns and empty.collect() == []
    name, pack = corpus_pipeline.STAGES[-1]
    assert {r["doc_id"] for r in pack(spark, docs, sf).collect()} == {i for i, *_ in rows if i is not None}
    assert pack(spark, docs.filter("doc_id < 0"), sf).collect() == []


def test_run_leaves_only_its_result(spark, sf):
    import os

    from quillgraph.session import shared_dir

    scratch = os.path.join(shared_dir(spark), spark.sparkContext.applicationId)
    before = set(os.listdir(scratch)) if os.path.isdir(scratch) else set()
    out = corpus_pipeline.run(spark, sf)
    assert out.count() > 0
    left = set(os.listdir(scratch)) - before
    assert len(left) == 1 and next(iter(left)).startswith("best-fit-packing")
