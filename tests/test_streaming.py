import time

from pyspark.sql import functions as F

from dimflow.functions.rules import Rule, UniqueRule
from dimflow.schemas import INT, STRING, struct
from dimflow.streaming.ingest import file_stream, ingest_stream, validate_stream
from tests.conftest import rows

SCHEMA = struct(id=INT, name=STRING)


def drop(folder, name, *records):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("id,name\n" + "".join(f"{i},{n}\n" for i, n in records))


def test_uniqueness_does_not_depend_on_batches(spark, tmp_path):
    src = tmp_path / "src"
    drop(src, "a.csv", (1, "x"), (2, "y"), (3, "y"))
    drop(src, "b.csv", (4, "x"))
    found = []
    for n in (None, 1):
        out = str(tmp_path / f"out{n}")
        stream = file_stream(spark, str(src), SCHEMA, files_per_batch=n)
        validate_stream(stream, [UniqueRule("unique_name", ("name",))], out, str(tmp_path / f"ckpt{n}"))
        found.append(rows(spark.read.parquet(out), "id", "unique_name"))
    assert found[0] == found[1] == [(1, True), (2, False), (3, False), (4, True)]


def test_each_file_is_ingested_once(spark, tmp_path):
    src, out, ckpt = tmp_path / "src", str(tmp_path / "out"), str(tmp_path / "ckpt")
    run = lambda: ingest_stream(file_stream(spark, str(src), SCHEMA, files_per_batch=1), out, ckpt)
    drop(src, "a.csv", (1, "x"), (2, "y"))
    run()
    run()
    drop(src, "b.csv", (3, "z"))
    drop(src, "c.csv", (4, "w"))
    run()
    assert rows(spark.read.parquet(out)) == [(1, "x"), (2, "y"), (3, "z"), (4, "w")]


def test_processed_files_are_archived_by_the_next_batch(spark, tmp_path):
    src, archive = tmp_path / "src", tmp_path / "archive"
    run = lambda: ingest_stream(
        file_stream(spark, str(src), SCHEMA, archive_dir=str(archive)), str(tmp_path / "out"), str(tmp_path / "ckpt")
    )
    drop(src, "a.csv", (1, "x"))
    run()
    drop(src, "b.csv", (2, "y"))
    run()
    deadline = time.time() + 20
    while (src / "a.csv").exists() and time.time() < deadline:
        time.sleep(0.2)
    assert not (src / "a.csv").exists() and list(archive.rglob("a.csv"))
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == [(1, "x"), (2, "y")]


def test_batches_are_validated_and_split(spark, tmp_path):
    src, out = tmp_path / "src", str(tmp_path / "out")
    rules = [Rule("positive", F.col("id") > 0), UniqueRule("unique_name", ("name",))]
    run = lambda: validate_stream(file_stream(spark, str(src), SCHEMA), rules, out, str(tmp_path / "ckpt"))
    drop(src, "a.csv", (1, "x"), (2, "y"), (3, "y"), (-4, "z"))
    run()
    drop(src, "b.csv", (5, "x"))  # unique within its own batch
    run()
    run()
    table = spark.read.parquet(out)
    assert rows(table.where("outcome = 'valid'"), "id") == [(1,), (5,)]
    assert rows(table.where("outcome = 'quarantine'"), "id", "positive", "unique_name") == [
        (-4, False, True), (2, True, False), (3, True, False)
    ]
