import json

from pyspark.sql import functions as F

from quillgraph.operators.mentions import keyword_dictionary
from quillgraph.streaming import notes


def message(i, text="some heart text"):
    return json.dumps({"row_id": str(i), "subject_id": "7", "hadm_id": "1", "charttime": "", "text": text})


def run(spark, folder, **options):
    stream = notes.note_stream(spark, "text", path=str(folder / "in"), **options)
    query = notes.land(stream, str(folder / "out"), str(folder / "progress"), every=None)
    notes.finish(query)
    return notes.read_landed(spark, str(folder / "out"))


def test_landing_survives_a_restart_and_a_repeated_batch(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for i in range(3):
        (tmp_path / "in" / f"{i}.txt").write_text("\n".join(message(10 * i + k) for k in range(4)))
    assert run(spark, tmp_path, maxFilesPerTrigger=1).count() == 12
    (tmp_path / "in" / "late.txt").write_text(message(99))
    landed = run(spark, tmp_path, maxFilesPerTrigger=1)
    assert landed.count() == 13 and landed.select("row_id").distinct().count() == 13
    assert landed.filter(F.col("ingested_at").isNull()).count() == 0
    # the last commit is lost: the batch runs again and overwrites its own directory
    commits = sorted((tmp_path / "progress" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    commits[-1].rename(tmp_path / "lost-commit")
    for crc in (tmp_path / "progress" / "commits").glob(f".{commits[-1].name}.crc"):
        crc.rename(tmp_path / "lost-commit-crc")
    assert run(spark, tmp_path, maxFilesPerTrigger=1).count() == 13


def test_trigger_interval_and_stop(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text(message(1))
    stream = notes.note_stream(spark, "text", path=str(tmp_path / "in"))
    query = notes.land(stream, str(tmp_path / "out"), str(tmp_path / "progress"), every="1 second")
    notes.finish(query, timeout=1)
    assert not query.isActive
    assert notes.read_landed(spark, str(tmp_path / "out")).count() == 1


def test_mentions_follow_each_batch(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("\n".join([message(1), message(2, "none"), message(3, "Heart heart")]))
    dictionary = keyword_dictionary(spark.createDataFrame([("heart",)], "t string"), "t")
    step = notes.mentions_of_batches(dictionary, "row_id", "text", str(tmp_path / "mentions"))
    stream = notes.note_stream(spark, "text", path=str(tmp_path / "in"))
    notes.finish(notes.land(stream, str(tmp_path / "out"), str(tmp_path / "progress"), None, step))
    rows = notes.read_landed(spark, str(tmp_path / "mentions")).collect()
    assert sorted((r["note_id"], r["char_start"]) for r in rows) == [("1", 5), ("3", 0), ("3", 6)]


def test_bad_messages_are_null_rows_and_counted(spark):
    raw = spark.createDataFrame([(message(1),), ("not json",), ('{"row_id": "2"}',)], "value string")
    parsed = notes.parse_messages(raw, notes.NOTE_SCHEMA)
    assert {r["row_id"] for r in parsed.collect()} == {"1", None, "2"}
    row = notes.malformed_count(parsed).first()
    assert (row["messages"], row["malformed"]) == (3, 1)


def test_note_messages_are_ordered_by_event_time(spark):
    schema = "ROW_ID int, SUBJECT_ID int, HADM_ID int, CHARTDATE string, CHARTTIME string, CATEGORY string, DESCRIPTION string, TEXT string"
    rows = [
        (1, 5, 9, "2100-01-03", None, "c", "d", "x"),
        (2, 6, 9, "2100-01-01", "2100-01-01 05:00:00", "c", None, "y"),
        (3, 4, 9, None, None, "c", "d", "z"),
    ]
    sent = notes.note_messages(spark.createDataFrame(rows, schema)).collect()
    assert [r["key"] for r in sent] == ["6", "5", "4"]
    assert json.loads(sent[0]["value"]) == {
        "row_id": "2", "subject_id": "6", "hadm_id": "9", "charttime": "2100-01-01 05:00:00", "category": "c", "description": None, "text": "y",
    }
    assert notes.note_messages(spark.createDataFrame(rows, schema), 1).count() == 1
