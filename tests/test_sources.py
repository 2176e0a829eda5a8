import pytest

from quillgraph.plans.graph import Graph, load_graph, pack_endpoints
from quillgraph.plans.ontology import HOSPITAL
from quillgraph.session import scratch_path
from quillgraph.sources import files, hospital
from quillgraph.sources.ingest import ingest_all
from quillgraph.sources.upsert import upsert_edges, upsert_nodes

NOTES = '''ROW_ID,SUBJECT_ID,HADM_ID,CHARTDATE,CHARTTIME,STORETIME,CATEGORY,DESCRIPTION,CGID,ISERROR,TEXT
1,7,100,2100-01-01,,,Nursing,Report,,,"first line
second ""quoted"" line"
2,7,100,2100-01-02,2100-01-02 10:00:00,,Nursing,,5,,plain
'''


def write(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text)


def test_csv_keeps_lines_zeros_and_nulls(spark, tmp_path):
    write(tmp_path, "n.csv", NOTES)
    rows = files.read_delimited(spark, str(tmp_path / "n.csv"), hospital.SCHEMAS["noteevents"]).orderBy("row_id").collect()
    assert len(rows) == 2
    assert rows[0]["text"] == 'first line\nsecond "quoted" line' and rows[0]["charttime"] is None and rows[0]["cgid"] is None
    write(tmp_path, "p.csv", "ROW_ID,SUBJECT_ID,HADM_ID,SEQ_NUM,ICD9_CODE\n1,1,1,1,0066\n")
    row = files.read_delimited(spark, str(tmp_path / "p.csv"), hospital.SCHEMAS["procedures_icd"]).first()
    assert row["icd9_code"] == "0066"


def test_csv_by_name_whatever_order(spark, tmp_path):
    write(tmp_path, "a.csv", "B,A,EXTRA\n1,x,z\n")
    row = files.read_delimited(spark, str(tmp_path / "a.csv"), "a string, b int, c double").first()
    assert row.asDict() == {"a": "x", "b": 1, "c": None, "extra": "z"}


def hospital_tables(tmp_path):
    source = tmp_path / "csv"
    write(source, "PATIENTS.csv", "ROW_ID,SUBJECT_ID,GENDER,DOB,DOD,DOD_HOSP,DOD_SSN,EXPIRE_FLAG\n1,7,F,2050-01-01 00:00:00,,,,0\n")
    write(source, "NOTEEVENTS.csv", NOTES)
    write(source, "D_LABITEMS.csv", "ROW_ID,ITEMID,LABEL,FLUID,CATEGORY,LOINC_CODE\n1,50818,pCO2,Blood,Blood Gas,\n")
    return source


def test_ingest_skips_absent_tables_and_flags_nulls(spark, tmp_path):
    source, target = hospital_tables(tmp_path), str(tmp_path / "out")
    report = {r["table_name"]: r for r in ingest_all(spark, str(source), target, hospital.SCHEMAS, hospital.PARTITION_KEYS).collect()}
    assert set(report) == {"patients", "noteevents", "d_labitems"}
    assert report["noteevents"]["row_count"] == 2
    assert "dod" in report["patients"]["high_null_columns"].split(",")
    assert spark.read.parquet(f"{target}/noteevents").count() == 2
    assert files.read_bucket_of(spark, f"{target}/noteevents", "subject_id", 7, 4, "int").count() == 2
    files.write_report(spark.createDataFrame([("a", 1)], "k string, n int"), f"{target}/report")
    assert files.read_report(spark, f"{target}/report", "k string, n int").collect()[0]["n"] == 1


def test_optional_and_present_paths(spark, tmp_path):
    assert files.read_if_present(spark, str(tmp_path / "none")) is None
    files.write_table(spark.range(3).toDF("id"), str(tmp_path / "t"))
    assert files.read_if_present(spark, str(tmp_path / "t")).count() == 3
    found, absent = files.present_inputs(spark, [str(tmp_path / "t"), str(tmp_path / "none")])
    assert (len(found), len(absent)) == (1, 1)


def test_pruned_read_reads_one_bucket(spark, tmp_path):
    files.write_bucketed(spark.range(1000).withColumnRenamed("id", "k"), str(tmp_path / "b"), "k", 8, files_per_bucket=2)
    df = files.read_bucket_of(spark, str(tmp_path / "b"), "k", 17, 8, "bigint")
    assert df.count() == 1
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan


def test_upserts_are_idempotent(spark):
    old = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "id int, name string, w double")
    new = spark.createDataFrame([(2, "x", 1), (2, "y", 2), (3, "z", 1), (None, "q", 1)], "id int, name string, v int")
    once = upsert_nodes(old, new, "id", "v")
    twice = upsert_nodes(once, new, "id", "v")
    expected = {(1, "a", 1.0), (2, "y", 2.0), (3, "z", None)}
    assert {tuple(r) for r in once.collect()} == {tuple(r) for r in twice.collect()} == expected

    nodes = spark.createDataFrame([(1,), (2,)], "id int")
    rows = spark.createDataFrame([(1, 2, 9.0), (1, 2, 8.0), (1, 5, 1.0), (None, 2, 1.0)], "src int, dst int, p double")
    first = upsert_edges(None, rows, nodes, nodes)
    again = upsert_edges(first, rows, nodes, nodes)
    assert {tuple(r) for r in first.collect()} == {tuple(r) for r in again.collect()} == {(1, 2, 8.0)}
    assert upsert_edges(None, rows, nodes, nodes, ("p",)).count() == 2


def test_saved_graph_of_hospital_tables(spark, tmp_path):
    source, target = hospital_tables(tmp_path), str(tmp_path / "out")
    write(source, "ADMISSIONS.csv", "ROW_ID,SUBJECT_ID,HADM_ID,ADMITTIME,DIAGNOSIS\n1,7,100,2100-01-01 00:00:00,CHF\n2,8,101,,X\n")
    write(source, "D_ICD_DIAGNOSES.csv", "ROW_ID,ICD9_CODE,SHORT_TITLE,LONG_TITLE\n1,4280,CHF NOS,CHF\n")
    write(source, "DIAGNOSES_ICD.csv", "ROW_ID,SUBJECT_ID,HADM_ID,SEQ_NUM,ICD9_CODE\n1,7,100,1,4280\n2,7,100,2,4280\n3,7,100,3,\n")
    ingest_all(spark, str(source), target, hospital.SCHEMAS, hospital.PARTITION_KEYS)

    def table(name):
        present = files.read_if_present(spark, f"{target}/{name}")
        if present is not None:
            return present
        schema = hospital.SCHEMAS.get(name, "note_id int, concept_id string, name string, score double")
        return spark.createDataFrame([], schema)

    graph = Graph(HOSPITAL, table)
    graph.save(f"{target}/graph")
    saved = load_graph(spark, f"{target}/graph", HOSPITAL)
    assert saved.nodes("Patient").first().asDict() == {
        "id": 7, "gender": "F", "dob": "2050-01-01 00:00:00", "dod": None, "expire_flag": 0,
    }
    assert {(r["src"], r["dst"]) for r in saved.raw_edges("HAS_ADMISSION").collect()} == {(7, 100)}  # patient 8 is no node
    assert saved.links("HAS_DIAGNOSIS").count() == 2 and saved.pairs("HAS_DIAGNOSIS").count() == 1
    assert saved.raw_edges("DOCUMENTED_IN").count() == 2
    graph.merge_into(saved, f"{target}/graph2")
    merged = load_graph(spark, f"{target}/graph2", HOSPITAL)
    for rule in HOSPITAL.edges:
        assert merged.raw_edges(rule.type).count() == saved.raw_edges(rule.type).count()
    packed = pack_endpoints(saved.links("HAS_DIAGNOSIS"), "Admission", "Diagnosis").first()
    assert packed["source"]["label"] == "Admission" and packed["target"]["id"] == "4280"


def test_shared_folder_is_the_one_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert named is None or scratch_path(spark, "x").startswith(named)


def test_csv_headers_follow_the_options(spark, tmp_path):
    write(tmp_path, "s.csv", "NAME;id\n'a;b';1\nplain;2\n")
    found = files.read_delimited(spark, str(tmp_path / "s.csv"), "id bigint, name string", sep=";", quote="'")
    assert found.columns == ["id", "name"] and sorted(map(tuple, found.collect())) == [(1, "a;b"), (2, "plain")]
    write(tmp_path, "e.csv", '"a\nb",C\n"x\\"y",2\n')
    found = files.read_delimited(spark, str(tmp_path / "e.csv"), "c int", escape="\\")
    assert found.columns == ["c", "a\nb"] and found.first()["a\nb"] == 'x"y'
    (tmp_path / "l.csv").write_bytes("id,näme\n1,été\n".encode("latin-1"))
    found = files.read_delimited(spark, str(tmp_path / "l.csv"), "id int, `näme` string", encoding="ISO-8859-1")
    assert tuple(found.first()) == (1, "été")
    write(tmp_path, "empty.csv", "")
    assert files.read_delimited(spark, str(tmp_path / "empty.csv"), "id int").collect() == []


def csv_field(draw):
    text = "".join(draw.choices(["a", "b ", ",", "\n", '"', "\r\n", "é", ";"], k=draw.choice([0, 1, 3, 10, 300])))
    return text if draw.random() < 0.9 else 'in "the" middle'


@pytest.mark.parametrize("dialect", [{}, {"sep": ";"}, {"escape": "\\"}])
def test_csv_split_at_any_byte_gives_the_rows_of_one_task(spark, tmp_path, dialect):
    """Splits of 700 bytes fall into quoted fields, line breaks and doubled quotes; some fields span several splits."""
    import random

    draw = random.Random(9)
    sep, escape = dialect.get("sep", ","), dialect.get("escape", '"')
    rows = [(i, csv_field(draw) if i % 50 else "x\n" * 1500, draw.choice(["", "plain", 'quote " inside', "q\n"])) for i in range(400)]

    def cell(value):
        if value == 'in "the" middle' or value == 'quote " inside':
            return value if value.startswith(("in", "quote")) and escape == '"' else '"' + value.replace('"', escape + '"') + '"'
        return '"' + value.replace('"', escape + '"') + '"' if any(c in value for c in f'{sep}"\n\r') else value

    text = f"ID{sep}TEXT{sep}NOTE\n" + "".join(f"{i}{sep}{cell(t)}{sep}{cell(n)}\n" for i, t, n in rows) + "\n"
    (tmp_path / "a.csv").write_bytes(text.encode())
    (tmp_path / "b.csv").write_bytes(text.replace("\nquote", "\nQuote").encode())
    schema = "id int, text string, note string"
    whole = files.read_delimited(spark, str(tmp_path), schema, **dialect)
    want = sorted(map(str, whole.collect()))
    usual = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        split = files.read_delimited(spark, str(tmp_path), schema, **dialect)
        got = sorted(map(str, split.collect()))
        assert "MapInArrow" in split._jdf.queryExecution().toString()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", usual)
    assert len(want) == 800 and got == want
