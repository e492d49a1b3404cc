import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from dimflow.entities import CUSTOMER, ENTITIES, HOSPITAL, POLICY, WEBSHOP_CUSTOMER, WEBSHOP_TYPE1_TRACKED
from dimflow.operators.cleanse import prepare
from dimflow.operators.scd import scd1_merge, scd2_history, scd2_merge
from dimflow.schemas import DIM_CUSTOMER_TYPE1, DIM_CUSTOMER_TYPE2, POLICY as POLICY_SCHEMA, RAW_CUSTOMER
from dimflow.sources.dimension_store import DimensionStore, read_dimension
from tests.conftest import rows

T0, T1, T2 = "2024-01-01 00:00:00", "2024-02-01 00:00:00", "2024-03-01 00:00:00"
D0, D1, D2 = (datetime.fromisoformat(t) for t in (T0, T1, T2))


def hospitals(spark, *data):
    return spark.createDataFrame(list(data), HOSPITAL.schema)


def state(df):
    return rows(df, "hospital_id", "location", "accreditation", "insert_date", "update_date", "is_active", "end_date")


def start(spark):
    return scd2_merge(
        None, hospitals(spark, ("H1", "A", "Oslo", "ISO"), ("H2", "B", "Rome", None), ("H3", "C", "Bonn", "ISO")), HOSPITAL, T0
    )


def test_first_load(spark):
    out = start(spark)
    assert out.columns == HOSPITAL.dim_schema.fieldNames()
    assert state(out)[0] == ("H1", "Oslo", "ISO", D0, D0, True, None)


def test_every_row_class(spark):
    source = hospitals(spark, ("H1", "A", "Oslo", "ISO"), ("H2", "B", "Rome", "NABH"), ("H4", "D", "Kiel", "ISO"))
    assert state(scd2_merge(start(spark), source, HOSPITAL, T1)) == [
        ("H1", "Oslo", "ISO", D0, D1, True, None),  # unchanged
        ("H2", "Rome", "NABH", D1, None, True, None),  # opened
        ("H2", "Rome", None, D0, D1, False, D1),  # closed
        ("H3", "Bonn", "ISO", D0, D0, True, None),  # absent
        ("H4", "Kiel", "ISO", D1, None, True, None),  # new
    ]


@pytest.mark.parametrize("policy, expected", [
    ("keep", [("H1", True, D0, None), ("H2", True, D0, None), ("H3", True, D0, None)]),
    ("expire", [("H1", True, D0, None), ("H2", False, D0, D1), ("H3", False, D0, D1)]),
    ("drop", [("H1", True, D0, None)]),
])
def test_absent_keys(spark, policy, expected):
    out = scd2_merge(start(spark), hospitals(spark, ("H1", "A", "Oslo", "ISO")), HOSPITAL, T1, absent=policy)
    assert rows(out, "hospital_id", "is_active", "insert_date", "end_date") == expected


def test_unknown_absent_policy(spark):
    with pytest.raises(ValueError, match="absent"):
        scd2_merge(start(spark), hospitals(spark), HOSPITAL, T1, absent="forget")


def test_null_tracked_value_is_a_change_both_ways_and_equal_to_null(spark):
    same = hospitals(spark, ("H1", "A", "Oslo", "ISO"), ("H2", "B", "Rome", None), ("H3", "C", "Bonn", "ISO"))
    assert scd2_merge(start(spark), same, HOSPITAL, T1).count() == 3
    to_null = hospitals(spark, ("H1", "A", "Oslo", None), ("H2", "B", "Rome", "ISO"), ("H3", "C", "Bonn", "ISO"))
    assert scd2_merge(start(spark), to_null, HOSPITAL, T1).count() == 5


def test_history_survives_later_merges(spark):
    once = scd2_merge(start(spark), hospitals(spark, ("H1", "A", "Bergen", "ISO")), HOSPITAL, T1)
    twice = scd2_merge(once, hospitals(spark, ("H1", "A", "Tromso", "ISO")), HOSPITAL, T2)
    h1 = [r for r in state(twice) if r[0] == "H1"]
    assert [(r[1], r[3], r[5], r[6]) for r in h1] == [
        ("Bergen", D1, False, D2), ("Oslo", D0, False, D1), ("Tromso", D2, True, None)
    ]


def test_duplicate_source_keys_open_one_version(spark):
    source = hospitals(spark, ("H1", "A", "Oslo2", "ISO"), ("H1", "A", "Oslo1", "ISO"), ("H9", "Z", "b", None), ("H9", "Z", "a", None))
    out = scd2_merge(start(spark), source, HOSPITAL, T1).where("is_active")
    assert [r[1] for r in state(out) if r[0] in ("H1", "H9")] == ["Oslo1", "a"]
    latest = scd2_merge(start(spark), source, HOSPITAL, T1, order_by=[F.desc("location")]).where("is_active")
    assert [r[1] for r in state(latest) if r[0] in ("H1", "H9")] == ["Oslo2", "b"]


def test_source_rows_without_key_are_ignored(spark):
    out = scd2_merge(start(spark), hospitals(spark, (None, "X", "Oslo", None), (None, "Y", "Oslo", None)), HOSPITAL, T1)
    assert state(out) == state(start(spark))


def test_policy_versions_end_in_their_own_column(spark):
    data = [("P1", "Auto", "Fire", date(2024, 1, 1), date(2024, 12, 31), None)]
    first = scd2_merge(None, spark.createDataFrame(data, POLICY_SCHEMA), POLICY, T0)
    changed = spark.createDataFrame([("P1", "Home", "Fire", date(2024, 1, 1), date(2025, 12, 31), None)], POLICY_SCHEMA)
    out = scd2_merge(first, changed, POLICY, T1)
    assert rows(out, "policy_type", "end_date", "end_date_version", "is_active") == [
        ("Auto", date(2024, 12, 31), D1, False), ("Home", date(2025, 12, 31), None, True)
    ]


def test_customer_output_feeds_the_next_run(spark):
    data = [("C1", "Ann", "Lee", date(1990, 1, 1), "F", "Oak", "Oslo", "OS", "01234")]
    source = prepare(spark.createDataFrame(data, CUSTOMER.schema), CUSTOMER, T0)
    first = scd2_merge(None, source, CUSTOMER, T0)
    moved = spark.createDataFrame([data[0][:8] + ("1234",)], CUSTOMER.schema)
    out = scd2_merge(scd2_merge(first, moved, CUSTOMER, T1), moved, CUSTOMER, T2)
    assert out.columns == CUSTOMER.dim_schema.fieldNames()
    assert rows(out, "zip", "is_active") == [("01234", False), ("1234", True)]


def test_gender_only_change_leaves_one_current_row(spark):
    a = (1, "Ann", "Lee", "F", "a@b.co", date(1990, 1, 1), 5)
    dim = scd2_merge(None, spark.createDataFrame([a], RAW_CUSTOMER), WEBSHOP_CUSTOMER, "2024-01-01")
    out = scd2_merge(dim, spark.createDataFrame([a[:3] + ("X",) + a[4:]], RAW_CUSTOMER), WEBSHOP_CUSTOMER, "2024-02-01")
    assert set(out.columns) == set(DIM_CUSTOMER_TYPE2.names)
    assert rows(out, "gender", "is_current", "start_date", "end_date") == [
        ("F", False, date(2024, 1, 1), date(2024, 2, 1)), ("X", True, date(2024, 2, 1), None)
    ]


def test_untracked_column_keeps_the_stored_value(spark):
    a = (1, "Ann", "Lee", "F", "a@b.co", date(1990, 1, 1), 5)
    dim = scd2_merge(None, spark.createDataFrame([a], RAW_CUSTOMER), WEBSHOP_CUSTOMER, "2024-01-01")
    source = spark.createDataFrame([a[:5] + (date(1999, 9, 9), 5)], RAW_CUSTOMER)
    assert rows(scd2_merge(dim, source, WEBSHOP_CUSTOMER, "2024-02-01"), "dateofbirth") == [(date(1990, 1, 1),)]


@pytest.mark.parametrize("seed", range(3))
def test_invariants_over_random_snapshots(spark, seed):
    rng = random.Random(seed)
    dim, closed_before = None, set()
    for step in range(3):
        keys = rng.sample(range(30), 20)
        data = [(f"H{k}", "n", rng.choice(["a", "b", "c"]), rng.choice(["x", None])) for k in keys + keys[:3]]
        source = hospitals(spark, *data)
        at = f"2024-0{step + 1}-01 00:00:00"
        merged = scd2_merge(dim, source, HOSPITAL, at, absent=rng.choice(["keep", "expire"]))
        out = spark.createDataFrame(merged.collect(), HOSPITAL.dim_schema)
        active = [r.hospital_id for r in out.where("is_active").collect()]
        assert len(active) == len(set(active))
        assert {f"H{k}" for k in keys} <= set(active)
        closed = set(rows(out.where("NOT is_active")))
        assert closed_before <= closed
        replay = scd2_merge(out, source, HOSPITAL, "2024-09-01 00:00:00")
        assert replay.count() == out.count()
        dim, closed_before = out, closed


def test_every_entity_tracks_and_requires_its_own_columns():
    for spec in ENTITIES.values():
        assert {*spec.key, *spec.tracked, *spec.required} <= set(spec.columns)
        assert not set(spec.key) & set(spec.tracked)
        assert spec.end not in spec.columns


def test_type1_merge(spark):
    dim = spark.createDataFrame(
        [(1, "Ann", "Lee", "F", "a@b.co", date(1990, 1, 1), 5, date(2023, 1, 1), None),
         (2, "Bob", "Ray", "M", None, date(1991, 1, 1), 6, date(2023, 1, 1), None),
         (3, "Cy", "Fox", "M", "c@b.co", date(1992, 1, 1), 7, date(2023, 1, 1), date(2023, 5, 5))],
        DIM_CUSTOMER_TYPE1,
    )
    source = spark.createDataFrame(
        [(1, "Ann", "Lee", "X", "a@b.co", date(1999, 1, 1), 5),  # gender and birth date are not compared
         (2, "Bob", "Ray", "X", "b@b.co", date(1999, 1, 1), 6),
         (4, "Di", "Orr", "F", None, date(1993, 1, 1), None),
         (None, "No", "Key", "F", None, None, None)],
        RAW_CUSTOMER,
    )
    out = scd1_merge(dim, source, ["id"], WEBSHOP_TYPE1_TRACKED, "2024-06-30")
    assert out.schema.names == DIM_CUSTOMER_TYPE1.names
    assert rows(out) == [
        (1, "Ann", "Lee", "F", "a@b.co", date(1990, 1, 1), 5, date(2023, 1, 1), None),
        (2, "Bob", "Ray", "M", "b@b.co", date(1991, 1, 1), 6, date(2023, 1, 1), date(2024, 6, 30)),
        (3, "Cy", "Fox", "M", "c@b.co", date(1992, 1, 1), 7, date(2023, 1, 1), date(2023, 5, 5)),
        (4, "Di", "Orr", "F", None, date(1993, 1, 1), None, date(2024, 6, 30), None),
    ]


def test_one_shuffle_per_side(spark, tmp_path):
    start(spark).write.parquet(str(tmp_path / "dim"))
    hospitals(spark, ("H1", "A", "Oslo", "ISO")).write.parquet(str(tmp_path / "src"))
    out = scd2_merge(spark.read.parquet(str(tmp_path / "dim")), spark.read.parquet(str(tmp_path / "src")), HOSPITAL, T1)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2


# --- stored dimension ---------------------------------------------------------------------


def test_store_keeps_versions_and_full_history(spark, tmp_path):
    store = DimensionStore(spark, str(tmp_path / "dim_hospital"), HOSPITAL)
    assert store.read() is None and read_dimension(spark, str(tmp_path / "none"), HOSPITAL) is None
    assert store.merge(hospitals(spark, ("H1", "A", "Oslo", "ISO"), ("H2", "B", "Rome", None)), T0) == 1
    assert store.merge(hospitals(spark, ("H1", "A", "Bergen", "ISO")), T1) == 2
    assert store.merge(hospitals(spark, ("H1", "A", "Tromso", "ISO")), T2) == 3
    assert rows(store.read(), "hospital_id", "location", "is_active", "end_date") == [
        ("H1", "Bergen", False, D2), ("H1", "Oslo", False, D1), ("H1", "Tromso", True, None), ("H2", "Rome", True, None)
    ]
    assert store.read_open().count() == 2
    (third,) = (tmp_path / "dim_hospital").glob("version=3.*")
    closed = spark.read.parquet(str(third / "row_state=closed"))
    assert rows(closed, "location") == [("Bergen",)], "a version stores only the rows it closed"


def test_store_ignores_an_unfinished_version(spark, tmp_path):
    store = DimensionStore(spark, str(tmp_path / "dim"), HOSPITAL)
    store.merge(hospitals(spark, ("H1", "A", "Oslo", "ISO")), T0)
    (tmp_path / "dim/version=2/row_state=open").mkdir(parents=True)
    assert store.versions() == [1] and store.read().count() == 1
    assert store.merge(hospitals(spark, ("H1", "A", "Bergen", "ISO")), T1) == 2
    assert store.read().count() == 2


def test_store_never_drops_history(spark, tmp_path):
    with pytest.raises(ValueError, match="never removed"):
        DimensionStore(spark, str(tmp_path), HOSPITAL).merge(hospitals(spark), T0, absent="drop")


def test_a_version_taken_by_another_load_is_merged_again(spark, tmp_path, monkeypatch):
    store = DimensionStore(spark, str(tmp_path / "dim"), HOSPITAL)
    store.merge(hospitals(spark, ("H1", "A", "Oslo", "ISO")), T0)
    write, other = DimensionStore.write, DimensionStore(spark, str(tmp_path / "dim"), HOSPITAL)

    def interrupted(self, merged, version):
        monkeypatch.setattr(DimensionStore, "write", write)
        assert other.merge(hospitals(spark, ("H2", "B", "Rome", None)), T1) == 2  # while this load is on its way
        return write(self, merged, version)

    monkeypatch.setattr(DimensionStore, "write", interrupted)
    assert store.merge(hospitals(spark, ("H1", "A", "Bergen", "ISO")), T2) == 3
    assert rows(store.read(), "hospital_id", "location", "is_active") == [("H1", "Bergen", True), ("H1", "Oslo", False), ("H2", "Rome", True)]
    assert len(list((tmp_path / "dim").glob("version=2*"))) == 1, "the load that came second left nothing behind"


def history(spark, dim, *changes):
    source = spark.createDataFrame(list(changes), "hospital_id string, hospital_name string, location string, accreditation string, at string")
    return scd2_history(dim, source, HOSPITAL, "at", T2)


def timeline(df):
    return rows(df, "hospital_id", "location", "insert_date", "end_date", "is_active", "update_date")


def test_changes_split_the_versions_they_fall_into(spark):
    day = lambda d: datetime(2024, 1, d)
    dim = history(spark, None, ("H1", "A", "Oslo", "I", "2024-01-10"), ("H1", "A", "Rome", "I", "2024-01-20"), ("H2", "B", "Kiel", "I", "2024-01-10"))
    assert timeline(dim) == [
        ("H1", "Oslo", day(10), day(20), False, None), ("H1", "Rome", day(20), None, True, None), ("H2", "Kiel", day(10), None, True, None),
    ]
    late = history(
        spark, dim, ("H1", "A", "Bonn", "I", "2024-01-15"), ("H1", "A", "Graz", "I", "2024-01-05"), ("H1", "A", "Rome", "I", "2024-01-25"),
        ("H1", "A", "Paris", "I", "2024-01-15"), (None, "A", "Lost", "I", "2024-01-15"), ("H1", "A", "Lost", "I", None),
    )
    assert timeline(late) == [
        ("H1", "Bonn", day(15), day(20), False, None), ("H1", "Graz", day(5), day(10), False, None),
        ("H1", "Oslo", day(10), day(15), False, D2), ("H1", "Rome", day(20), None, True, None), ("H2", "Kiel", day(10), None, True, None),
    ]
    again = history(spark, late, ("H1", "A", "Rome", "I", "2024-01-15"))  # in place of a version, with the values of the next
    assert [r for r in timeline(again) if r[0] == "H1"][-1] == ("H1", "Rome", day(15), None, True, None)


def test_random_histories_equal_what_is_in_force_day_by_day(spark):
    rng, kinds = random.Random(3), ["ISO", "NABH", None]
    dim, found = None, []
    for _ in range(3):
        changes = [(f"H{rng.randint(1, 6)}", "N", rng.choice("abc"), rng.choice(kinds), f"2024-01-{rng.randint(1, 28):02d}") for _ in range(25)]
        changes = list({(c[0], c[4]): c for c in changes}.values())
        truth = {(r.hospital_id, r.insert_date): (r.location, r.accreditation) for r in found}
        truth |= {(c[0], datetime.fromisoformat(c[4])): c[2:4] for c in changes}
        found = history(spark, dim, *changes).collect()
        dim = spark.createDataFrame(found, HOSPITAL.dim_schema)
        for key in {k for k, _ in truth}:
            versions = sorted((r for r in found if r.hospital_id == key), key=lambda r: r.insert_date)
            assert all(a.end_date == b.insert_date for a, b in zip(versions, versions[1:])) and versions[-1].end_date is None
            assert all((a.location, a.accreditation) != (b.location, b.accreditation) for a, b in zip(versions, versions[1:]))
            for d in range(1, 29):
                at = datetime(2024, 1, d)
                past = max((t for k, t in truth if k == key and t <= at), default=None)
                force = [(r.location, r.accreditation) for r in versions if r.insert_date <= at and (r.end_date is None or at < r.end_date)]
                assert force == ([] if past is None else [truth[key, past]])


def test_gaps_stay_until_a_change_fills_them(spark):
    dim = scd2_merge(start(spark), hospitals(spark), HOSPITAL, T1, absent="expire")
    late = timeline(history(spark, dim, ("H1", "A", "Oslo", "ISO", "2024-02-10"), ("H2", "B", "Wien", None, "2024-01-20")))
    assert [r[:4] for r in late] == [
        ("H1", "Oslo", D0, D1), ("H1", "Oslo", datetime(2024, 2, 10), None),
        ("H2", "Rome", D0, datetime(2024, 1, 20)), ("H2", "Wien", datetime(2024, 1, 20), D1), ("H3", "Bonn", D0, D1),
    ]
