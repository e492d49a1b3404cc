from datetime import datetime
from multiprocessing.pool import ThreadPool

import pytest

from dimflow import storage
from dimflow.operators import incremental

from dimflow.operators.incremental import audit_rows, incremental_extract, insert_ignore, run_incremental
from dimflow.schemas import AUDIT
from tests.conftest import rows

SOURCE = "id int, last_updated_date {}"


def source(spark, *days, kind="timestamp"):
    text = spark.createDataFrame([(d, f"2024-01-{d:02d} 10:00:00.000001") for d in days], "id int, at string")
    return text.selectExpr("id", f"CAST(at AS {kind}) AS last_updated_date")


def audit(spark, *entries):
    return spark.createDataFrame([(j, "r", datetime.fromisoformat(t) if t else None) for j, t in entries], AUDIT)


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_only_newer_rows(spark, kind):
    trail = audit(spark, ("orders", "2024-01-02T10:00:00.000001"), ("orders", "2024-01-01T00:00:00"))
    assert rows(incremental_extract(source(spark, 1, 2, 3, kind=kind), trail, "orders", "last_updated_date"), "id") == [(3,)]


def test_date_watermark(spark):
    trail = audit(spark, ("orders", "2024-01-02T00:00:00"))
    assert rows(incremental_extract(source(spark, 1, 2, 3, kind="date"), trail, "orders", "last_updated_date"), "id") == [(3,)]


def test_other_jobs_do_not_move_the_watermark(spark):
    trail = audit(spark, ("orders", "2024-01-01T12:00:00"), ("customers", "2024-01-09T00:00:00"))
    assert incremental_extract(source(spark, 1, 2, 3), trail, "orders", "last_updated_date").count() == 2


def test_no_audit_or_null_watermark_means_full_load(spark):
    for trail in (audit(spark), audit(spark, ("orders", None))):
        assert incremental_extract(source(spark, 1, 2), trail, "orders", "last_updated_date").count() == 2


def test_watermark_is_pushed_into_the_scan(spark, tmp_path):
    source(spark, 1, 2, 3).write.parquet(str(tmp_path / "src"))
    trail = audit(spark, ("orders", "2024-01-02T10:00:00.000001"))
    out = incremental_extract(spark.read.parquet(str(tmp_path / "src")), trail, "orders", "last_updated_date")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(last_updated_date" in plan
    assert rows(out, "id") == [(3,)]


def test_audit_rows(spark):
    out = audit_rows(source(spark, 1, 3), "orders", "run-7", "last_updated_date")
    assert [f.name for f in out.schema] == AUDIT.names
    assert rows(out) == [("orders", "run-7", datetime(2024, 1, 3, 10, 0, 0, 1))]


def test_runs_load_each_row_once(spark, tmp_path):
    trail, target = str(tmp_path / "audit"), str(tmp_path / "target")

    def run(run_id, *days, **options):
        return run_incremental(spark, source(spark, *days), trail, target, "orders", run_id, "last_updated_date", **options)

    assert run("r1", 1, 2) == 2
    assert run("r2", 1, 2) == 0  # nothing new: nothing written, the mark repeated
    assert run("r3", 1, 2, 3, 4, compact_files=True) == 2
    assert run("r3", 1, 2, 3, 4, 5) == 0  # already recorded
    assert rows(spark.read.parquet(target), "id", "run_id") == [(1, "r1"), (2, "r1"), (3, "r3"), (4, "r3")]
    assert rows(spark.read.parquet(trail)) == [
        ("orders", "r1", datetime(2024, 1, 2, 10, 0, 0, 1)),
        ("orders", "r2", datetime(2024, 1, 2, 10, 0, 0, 1)),
        ("orders", "r3", datetime(2024, 1, 4, 10, 0, 0, 1)),
    ]


def test_late_rows_with_the_stamp_of_the_mark_or_none(spark, tmp_path):
    trail, target = str(tmp_path / "audit"), str(tmp_path / "target")

    def run(run_id, *arrived, **options):
        df = spark.createDataFrame([(i, datetime(2024, 1, d) if d else None) for i, d in arrived], "id int, at timestamp")
        return run_incremental(spark, df, trail, target, "orders", run_id, "at", **options)

    first, late = [(1, 1), (2, 2)], [(3, 2), (4, None), (5, 1)]
    assert run("r1", *first, keys=["id"]) == 2
    assert run("r2", *first, *late, keys=["id"]) == 2  # not the row below the mark
    assert run("r3", *first, *late, keys=["id"]) == 0
    assert rows(spark.read.parquet(target), "id", "run_id") == [(1, "r1"), (2, "r1"), (3, "r2"), (4, "r2")]
    assert [r[2] for r in rows(spark.read.parquet(trail))] == [datetime(2024, 1, 2)] * 3


def test_a_source_without_stamps_is_recorded(spark, tmp_path):
    trail, target = str(tmp_path / "audit"), str(tmp_path / "target")
    df = spark.createDataFrame([(1, None), (2, None)], "id int, at timestamp")
    assert run_incremental(spark, df, trail, target, "orders", "r1", "at") == 0
    assert run_incremental(spark, df, trail, target, "orders", "r2", "at", keys=["id"]) == 2
    assert run_incremental(spark, df, trail, target, "orders", "r3", "at", keys=["id"]) == 0
    assert rows(spark.read.parquet(trail), "runid", "lastrundate") == [("r1", None), ("r2", None), ("r3", None)]


def test_the_target_is_reduced_before_the_anti_join(spark, tmp_path):
    spark.range(1000).selectExpr("id", "id AS v").write.parquet(str(tmp_path / "target"))
    spark.createDataFrame([(1, 0), (5000, 0)], "id long, v long").write.parquet(str(tmp_path / "incoming"))
    target, incoming = (spark.read.parquet(str(tmp_path / n)) for n in ("target", "incoming"))
    plan = insert_ignore(target, incoming, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in plan and plan.index("LeftAnti") < plan.index("LeftSemi")


def test_failed_write_leaves_the_watermark(spark, tmp_path):
    trail = str(tmp_path / "audit")
    broken = source(spark, 1, 2).selectExpr("last_updated_date", "1 / (id - 2) AS id")
    with pytest.raises(Exception):
        run_incremental(spark, broken, trail, str(tmp_path / "t"), "orders", "r1", "last_updated_date")
    assert not (tmp_path / "audit").exists()
    assert run_incremental(spark, source(spark, 1, 2), trail, str(tmp_path / "t"), "orders", "r1", "last_updated_date") == 2


def test_insert_ignore(spark):
    target = spark.createDataFrame([(1, "old"), (5, "old")], "id int, v string")
    incoming = spark.createDataFrame([(1, "x"), (2, "b"), (2, "a"), (None, "n")], "id int, v string")
    assert rows(insert_ignore(target, incoming, ["id"])) == [(2, "a")]
    assert rows(insert_ignore(target, incoming, ["id"], order_by=[incoming.v.desc()])) == [(2, "b")]


def test_overlapping_runs_load_each_row_once(spark, tmp_path, monkeypatch):
    trail, target = str(tmp_path / "audit"), str(tmp_path / "target")

    def run(run_id, *days, **options):
        return run_incremental(spark, source(spark, *days), trail, target, "orders", run_id, "last_updated_date", **options)

    commit = incremental._CommitLog.commit

    def interrupted(self, number, load):
        monkeypatch.setattr(incremental._CommitLog, "commit", commit)
        assert run("fast", 1, 2) == 2  # while the slow run is between its write and its commit
        return commit(self, number, load)

    monkeypatch.setattr(incremental._CommitLog, "commit", interrupted)
    assert run("slow", 1, 2, 3) == 1
    assert rows(spark.read.parquet(target), "id", "run_id") == [(1, "fast"), (2, "fast"), (3, "slow")]
    assert not list((tmp_path / "target").glob("_staged*"))


def test_a_commit_whose_writer_was_lost_is_completed(spark, tmp_path, monkeypatch):
    trail, target = str(tmp_path / "audit"), str(tmp_path / "target")

    def run(run_id, *days):
        return run_incremental(spark, source(spark, *days), trail, target, "or/ders", run_id, "last_updated_date", keys=["id"])

    repair, calls = incremental._CommitLog.repair, []

    def lost(self):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return repair(self)

    monkeypatch.setattr(incremental._CommitLog, "repair", lost)
    with pytest.raises(RuntimeError):
        run("r1", 1, 2)
    monkeypatch.setattr(incremental._CommitLog, "repair", repair)
    assert run("r1", 1, 2) == 0 and run("r2", 1, 2, 3) == 1
    assert rows(spark.read.parquet(target), "id", "run_id") == [(1, "r1"), (2, "r1"), (3, "r2")]
    assert rows(spark.read.parquet(trail), "runid") == [("r1",), ("r2",)]


def test_one_of_many_writers_wins(spark, tmp_path):
    path = str(tmp_path / "deep/commit")
    with ThreadPool(8) as pool:
        won = pool.map(lambda i: storage.put_if_absent(spark, path, f"writer {i}"), range(16))
    assert sum(won) == 1 and storage.read_text(spark, path) == f"writer {won.index(True)}"
    assert [p.name for p in (tmp_path / "deep").iterdir() if not p.name.endswith(".crc")] == ["commit"]
