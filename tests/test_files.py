import json
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from dimflow import storage
from dimflow.schemas import AUDIT, CUSTOMER, EVENT_LOG, struct, STRING, INT
from dimflow.sources.files import archive_loaded, base_name, convert_to_parquet, csv_layouts, extension, merge_csv
from dimflow.sources import json_arrays
from dimflow.sources.jdbc import DIALECTS, ReadSplit, export_table, jdbc_options, read_jdbc
from dimflow.sources.json_arrays import read_json_array
from dimflow.sources.tables import compact, read_csv, read_json, read_table, write_csv, write_parquet, write_table
from tests.conftest import rows


def test_csv_declared_inferred_or_strings(spark, tmp_path):
    (tmp_path / "c.csv").write_text('customer_id,address,zip\nC1,"1 Main St, Apt 2",05565\n')
    path = str(tmp_path / "c.csv")
    assert rows(read_csv(spark, path)) == [("C1", "1 Main St, Apt 2", "05565")]
    assert read_csv(spark, path, infer=True).first().zip == 5565
    declared = struct(customer_id=STRING, address=STRING, zip=INT)
    assert read_csv(spark, path, declared).schema == declared


def test_json_lines_and_multi_line_arrays(spark, tmp_path):
    (tmp_path / "lines.json").write_text('{"log_id": "1"}\n{"log_id": "2"}\n')
    (tmp_path / "array.json").write_text(json.dumps([{"log_id": "1"}, {"log_id": "2"}], indent=1))
    assert rows(read_json(spark, str(tmp_path / "lines.json"), EVENT_LOG), "log_id") == [("1",), ("2",)]
    assert rows(read_json(spark, str(tmp_path / "array.json"), EVENT_LOG, multi_line=True), "log_id") == [("1",), ("2",)]


def test_tables(spark, tmp_path):
    path = {"path": str(tmp_path / "t")}
    assert read_table(spark, "parquet", path, schema=AUDIT, missing_ok=True).count() == 0
    write_table(spark.range(3), "parquet", path)
    write_table(spark.range(3), "parquet", path)
    assert read_table(spark, "parquet", path).count() == 6
    write_table(spark.range(2), "parquet", path, mode="overwrite")
    assert read_table(spark, "parquet", path).count() == 2
    assert not write_parquet(spark.range(0), path["path"], skip_empty=True)
    assert read_table(spark, "parquet", path).count() == 2


def test_compact_writes_one_file_per_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    many = spark.range(0, 1000, 1, 8).selectExpr("id", "id % 2 AS day")
    write_table(compact(many, "day"), "parquet", {"path": path}, partition_by=["day"])
    assert len(list((tmp_path / "t").rglob("*.parquet"))) == 2
    write_table(compact(many), "parquet", {"path": path + "2"})
    assert len(list((tmp_path / "t2").glob("*.parquet"))) == 1


def test_merge_reads_each_file_in_its_encoding_and_matches_columns_by_name(spark, tmp_path):
    (tmp_path / "sub dir").mkdir()
    (tmp_path / "a.csv").write_text("id,name\n1,Zoë\n", encoding="utf-8")
    (tmp_path / "sub dir/b.csv").write_bytes("id,name\n2,José\n".encode("latin-1"))
    (tmp_path / "c.csv").write_text("name,id,city\nAnn,3,Oslo\n")
    (tmp_path / "d.csv").write_text("id,name\n4,Bob\n")
    (tmp_path / "notes.txt").write_text("id,name\n9,skip\n")
    out = merge_csv(spark, str(tmp_path))
    assert rows(out, "id", "name", "city") == [("1", "Zoë", None), ("2", "José", None), ("3", "Ann", "Oslo"), ("4", "Bob", None)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 3, "files of one layout share a scan"


def test_encoding_is_judged_on_the_whole_file(spark, tmp_path):
    lines = [f"{i},name{i}" for i in range(20000)] + ["20000,José"]
    (tmp_path / "late.csv").write_bytes(("id,name\n" + "\n".join(lines) + "\n").encode("latin-1"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        out = merge_csv(spark, str(tmp_path))
        assert out.count() == 20001 and out.where("id = '20000'").first().name == "José"
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_names_with_special_characters(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    for i, name in enumerate(["a b.csv", "50%20off.csv", "x[1].csv", "{y}.csv", "é#.csv"]):
        (src / name).write_text(f"id\n{i}\n")
    assert rows(merge_csv(spark, str(src))) == [(str(i),) for i in range(5)]
    manifest = convert_to_parquet(spark, str(src), str(tmp_path / "out"))
    assert rows(manifest, "status", "row_count") == [("loaded", 1)] * 5
    journal = archive_loaded(spark, manifest, str(src), str(tmp_path / "arc"), "2024-06-30")
    assert rows(journal, "state") == [("moved",)] * 5 and not list(src.glob("[!.]*"))
    targets = [r.target for r in manifest.collect()]
    assert rows(spark.read.parquet(*targets)) == [(str(i),) for i in range(5)]


def test_layouts_are_found_by_hash_aggregation(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id\n1\n")
    plan = csv_layouts(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "ObjectHashAggregate" not in plan


def test_blank_lines_before_differing_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("\n  \nid,name\n1,x\n")
    (tmp_path / "b.csv").write_text("\nname,id\ny,2\n")
    assert rows(merge_csv(spark, str(tmp_path)), "id", "name") == [("1", "x"), ("2", "y")]


def test_arrays_and_malformed_records_are_told_per_file(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "lines.json").write_text('{"a": 1}\n{"a": 2}\n')
    (raw / "array.json").write_text('\n[\n{"a": 1},\n{"a": 2}\n]\n')
    (raw / "some.json").write_text('{"a": 1}\n{"a": \n')
    (raw / "typed.csv").write_text("a\n1\nx\n")
    manifest = convert_to_parquet(spark, str(raw), str(tmp_path / "out"), schemas={"typed": struct(a=INT)})
    found = {r.path.rsplit("/", 1)[-1]: (r.status, r.row_count, r.error) for r in manifest.collect()}
    assert found == {
        "lines.json": ("loaded", 2, None), "array.json": ("loaded", 2, None),
        "some.json": ("loaded", 2, "1 malformed records"), "typed.csv": ("loaded", 2, "1 malformed records"),
    }
    targets = {r.path.rsplit("/", 1)[-1]: r.target for r in manifest.collect()}
    assert rows(spark.read.parquet(targets["array.json"])) == [(1,), (2,)]
    assert spark.read.parquet(targets["typed.csv"]).columns == ["a"]


def test_merge_without_files(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    with pytest.raises(FileNotFoundError):
        merge_csv(spark, str(tmp_path / "empty"))


def test_names(spark):
    df = spark.createDataFrame([("file:/x/a.b.csv",), ("/x/y/plain",), ("/x.d/c.JSON",)], "p string")
    assert [tuple(r) for r in df.select(base_name(F.col("p")), extension(F.col("p"))).collect()] == [
        ("a.b", "csv"), ("plain", ""), ("c", "json")
    ]


def test_conversion_isolates_failures(spark, tmp_path):
    raw, bronze = tmp_path / "raw", tmp_path / "bronze"
    (raw / "east").mkdir(parents=True)
    (raw / "customer data.csv").write_text("customer_id,zip\nC1,05565\nC2,12345\n")
    (raw / "events.json").write_text('{"log_id": "1"}\n{"log_id": "2"}\n{"log_id": "3"}\n')
    (raw / "array.json").write_text(json.dumps([{"a": 1}, {"a": 2}], indent=1))
    (raw / "broken.json").write_text('{"a": \n')
    (raw / "book.xlsx").write_bytes(b"PK")
    (raw / "twin.csv").write_text("a\n1\n")
    (raw / "east/twin.json").write_text('{"a": 1}\n')
    manifest = convert_to_parquet(spark, str(raw), str(bronze), schemas={"events": EVENT_LOG})
    found = {r.path.rsplit("/", 1)[-1]: (r.status, r.row_count) for r in manifest.collect()}
    assert found == {
        "customer data.csv": ("loaded", 2), "events.json": ("loaded", 3), "array.json": ("loaded", 2),
        "broken.json": ("failed", None),
        "book.xlsx": ("unsupported", None), "twin.csv": ("failed", None), "twin.json": ("failed", None),
    }
    assert all(r.error for r in manifest.where("status = 'failed'").collect())
    targets = {r.path.rsplit("/", 1)[-1]: r.target for r in manifest.where("target is not null").collect()}
    assert all(t.startswith(f"file:{bronze}/") or t.startswith(f"file://{bronze}/") for t in targets.values())
    assert rows(spark.read.parquet(targets["customer data.csv"])) == [("C1", "05565"), ("C2", "12345")]
    assert spark.read.parquet(targets["events.json"]).columns == EVENT_LOG.names

    journal = archive_loaded(spark, manifest, str(raw), str(tmp_path / "archive"), "2024-06-30")
    assert rows(journal, "state") == [("moved",)] * 3
    assert sorted(p.name for p in (tmp_path / "archive/RAW_ARCHIVE/2024-06-30").iterdir() if not p.name.startswith(".")) == [
        "array.json", "customer data.csv", "events.json"
    ]
    assert (raw / "broken.json").exists() and not (raw / "events.json").exists()


def test_multi_line_json_conversion(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw/array.json").write_text(json.dumps([{"a": 1}, {"a": 2}], indent=1))
    manifest = convert_to_parquet(spark, str(tmp_path / "raw"), str(tmp_path / "out"))
    assert rows(manifest, "status", "row_count") == [("loaded", 2)]


def test_malformed_record_can_fail_the_file(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw/r.csv").write_text("a,b\n1,2\n3\n")
    convert = lambda out, **o: rows(convert_to_parquet(spark, str(tmp_path / "raw"), str(tmp_path / out), **o), "status", "row_count")
    assert convert("one") == [("loaded", 2)]
    assert convert("two", mode="FAILFAST") == [("failed", None)]


def test_scratch_is_under_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert storage.scratch_dir(spark, "x").startswith(shared)
    assert storage.scratch_dir(spark, "x") != storage.scratch_dir(spark, "x")


# --- JDBC: options only, as no database may be started ------------------------------------


@pytest.mark.parametrize("db_type, port", [("postgresql", 5432), ("mysql", 3306), ("mssql", 1433), ("oracle", 1521)])
def test_default_ports(db_type, port):
    options = jdbc_options(db_type.upper(), {"host": "h", "dbname": "d", "user": "u"})
    assert f"h:{port}" in options["url"] and "d" in options["url"]
    assert options["user"] == "u" and options["driver"] == DIALECTS[db_type][2]
    assert "h:9999" in jdbc_options(db_type, {"host": "h", "dbname": "d", "port": "9999"})["url"]


def test_file_and_account_databases():
    assert jdbc_options("sqlite", {"dbname": "/x/y.db"})["url"] == "jdbc:sqlite:/x/y.db"
    url = jdbc_options("snowflake", dict(account="a", dbname="d", schema="s", warehouse="w", role="r"))["url"]
    assert url == "jdbc:snowflake://a.snowflakecomputing.com/?db=d&schema=s&warehouse=w&role=r"


def test_unknown_or_incomplete_connection():
    with pytest.raises(ValueError, match="unsupported"):
        jdbc_options("dbase", {})
    with pytest.raises(ValueError, match="host"):
        jdbc_options("mysql", {"dbname": "d"})


def test_a_table_is_never_read_by_one_task(spark):
    with pytest.raises(ValueError, match="split"):
        read_jdbc(spark, jdbc_options("mysql", {"host": "h", "dbname": "d"}), "t")
    assert ReadSplit("id", "0", "100", 10).partitions == 10


def test_export_by_job_name(spark, tmp_path):
    write_parquet(spark.range(5), str(tmp_path / "t.parquet"))
    jobs = {"ids_export": {"db_type": "parquet", "table_name": "t"}, "bad": {"db_type": "parquet"}}
    out = export_table(spark, "ids_export", jobs, {"parquet": {"path": str(tmp_path)}}, str(tmp_path / "out"))
    assert out.endswith("/ids_export.csv") and rows(read_csv(spark, out)) == [(str(i),) for i in range(5)]
    for job in ("bad", "missing"):
        with pytest.raises(ValueError, match="must define"):
            export_table(spark, job, jobs, {}, str(tmp_path))


def test_write_csv_round_trip(spark, tmp_path):
    data = [("C1", "Ann", None, None, "F", 'He said "hi", twice', "Oslo", "OS", "05565")]
    df = spark.createDataFrame(data, CUSTOMER)
    write_csv(df, str(tmp_path / "c"))
    assert rows(read_csv(spark, str(tmp_path / "c"), CUSTOMER, escape='"')) != []


def jobs_of(spark, work):
    """The result of ``work`` and how many Spark jobs it took."""
    tracker, group = spark.sparkContext.statusTracker(), f"count-{time.monotonic_ns()}"
    spark.sparkContext.setJobGroup(group, "counted")
    try:
        return work(), len(tracker.getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_jobs_grow_with_layouts_not_files(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    for i in range(1000):
        (raw / f"orders_{i}.csv").write_text("id,zip\n" + f"{i},0{i}\n" * (i % 3))
    manifest, jobs = jobs_of(spark, lambda: convert_to_parquet(spark, str(raw), str(tmp_path / "out"), parallel_jobs=1))
    assert rows(manifest.groupBy("status").agg(F.count("*"), F.sum("row_count"))) == [("loaded", 1000, sum(i % 3 for i in range(1000)))]
    assert manifest.where("target is null and row_count > 0").isEmpty()
    assert jobs < 10
    found = spark.read.parquet(*[r.target for r in manifest.where("target is not null").limit(5).collect()])
    assert found.columns == ["id", "zip"]
    _, jobs = jobs_of(spark, lambda: archive_loaded(spark, manifest, str(raw), str(tmp_path / "arc"), "d"))
    assert jobs < 10 and not list(raw.glob("[!.]*"))


def test_only_malformed_files_fail_and_converting_again_replaces(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    for i in range(6):
        (raw / f"f{i}.csv").write_text("a,b\n1,2\n" + ("3\n" if i == 4 else "3,4\n"))
    convert = lambda **o: convert_to_parquet(spark, str(raw), str(tmp_path / "out"), **o)
    manifest = convert(mode="FAILFAST")
    assert rows(manifest, "status", "row_count", "error") == [("failed", None, "1 malformed records")] + [("loaded", 2, None)] * 5
    (raw / "f4.csv").write_text("a,b\n5,6\n")
    assert rows(convert(mode="FAILFAST"), "status", "row_count") == [("loaded", 1)] + [("loaded", 2)] * 5
    assert spark.read.parquet(*{r.target.rsplit("/", 1)[0] for r in manifest.where("target is not null").collect()}).count() == 11


def test_files_without_rows_or_with_clashing_columns(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "empty.csv").write_text("")
    (raw / "header.csv").write_text("source_file,_source_file\n")
    (raw / "one.csv").write_text("source_file,_source_file\nx,y\n")
    (raw / "plus+ and 50%.json").write_text('[{"source_file": "x"}]')
    manifest = convert_to_parquet(spark, str(raw), str(tmp_path / "out"))
    found = {r.path.rsplit("/", 1)[-1]: r for r in manifest.collect()}
    assert {(r.status, r.row_count) for n, r in found.items() if n in ("header.csv", "one.csv")} == {("loaded", 0), ("loaded", 1)}
    assert rows(spark.read.parquet(found["one.csv"].target)) == [("x", "y")]
    (plus,) = (r for n, r in found.items() if n.endswith("json"))
    assert (plus.status, plus.row_count) == ("loaded", 1) and rows(spark.read.parquet(plus.target)) == [("x",)]


def test_archive_repeats_a_half_done_run(spark, tmp_path):
    source, archive = tmp_path / "raw/deep", tmp_path / "arc/RAW_ARCHIVE/d/deep"
    source.mkdir(parents=True)
    archive.mkdir(parents=True)
    for i in range(8):
        (source / f"{i}.csv").write_text(f"a\n{i}\n")
    manifest = convert_to_parquet(spark, str(tmp_path / "raw"), str(tmp_path / "out"))
    for i in range(3):  # what an executor did before it was lost
        (source / f"{i}.csv").rename(archive / f"{i}.csv")
    (source / "7.csv").unlink()  # gone without a trace
    for _ in range(2):
        journal = archive_loaded(spark, manifest, str(tmp_path / "raw"), str(tmp_path / "arc"), "d")
        assert rows(journal.groupBy("state").count()) == [("missing", 1), ("moved", 7)]
    assert sorted(p.name for p in archive.glob("[!.]*")) == [f"{i}.csv" for i in range(7)]


# --- JSON arrays ---------------------------------------------------------------------------


def awkward_records(n):
    texts = ["plain", 'quote " and {brace}', "} ] [ {", "back\\slash", 'ends \\"', "\\", "line\nend", "é😀\u2028", "", '"}"', "\\\"},{"]
    return [{"id": i, "text": texts[i % len(texts)] * (i % 4), "more": {"list": [{"x": i}, {"x": [1, 2]}], "none": None}} for i in range(n)]


RECORD = "id long, text string, more struct<list: array<struct<x: string>>, none: string>"


@pytest.mark.parametrize("indent", [None, 1])
@pytest.mark.parametrize("block", [300, 5000, 10**8])
def test_json_arrays_in_blocks_of_any_size(spark, tmp_path, indent, block):
    records = awkward_records(400)
    (tmp_path / "one.json").write_text("\ufeff \n" + json.dumps(records, indent=indent), encoding="utf-8")
    (tmp_path / "two.json").write_text(json.dumps(records[:7], indent=indent, ensure_ascii=False) + "\n\n", encoding="utf-8")
    (tmp_path / "none.json").write_text("[]")
    (tmp_path / "empty.json").write_text("")
    (tmp_path / "single.json").write_text(json.dumps(records[5], indent=indent))
    (tmp_path / "mixed.json").write_text('[1, "a{\\"b}", {"id": -1, "text": "t"}, null, {"id": -2}, "{"]')
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    try:
        found = read_json_array(spark, str(tmp_path), StructType.fromDDL(RECORD))
        got = sorted((r.id, r.text, r.more and [x.x for x in r.more.list]) for r in found.collect())
        text = spark.read.option("lineSep", "}").text(str(tmp_path / "one.json"))
        assert block > 10**6 or text.rdd.getNumPartitions() > 3, "the document is read by several tasks"
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    expected = [(r["id"], r["text"], [str(r["more"]["list"][0]["x"]), "[1,2]"]) for r in [*records, *records[:7], records[5]]]
    assert got == sorted([*expected, (-1, "t", None), (-2, None, None)], key=lambda r: (r[0], r[1] or ""))


def test_json_arrays_without_schema_and_cut_off(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"a": 1, "b": "x\\ny"}, {"a": 2}]')
    assert rows(read_json_array(spark, str(tmp_path / "a.json"))) == [(1, "x\ny"), (2, None)]
    (tmp_path / "cut.json").write_text('[{"a": 1}, {"a": [2, ')
    schema = StructType.fromDDL("a string, _corrupt_record string")
    found = read_json_array(spark, str(tmp_path / "cut.json"), schema).collect()
    assert sorted((r.a, r._corrupt_record is not None) for r in found if r.a) == [("1", False)] and len(found) == 2


def test_json_array_states_meet_in_a_join_beyond_the_bound(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(json_arrays, "BROADCAST_BLOCKS", 0)
    records = awkward_records(50)
    (tmp_path / "one.json").write_text(json.dumps(records))
    assert read_json_array(spark, str(tmp_path), StructType.fromDDL(RECORD)).count() == 50
