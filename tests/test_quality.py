import pytest
from pyspark.sql import functions as F

from dimflow.functions.rules import (
    CUSTOMER_ID_UNIQUE, Rule, UniqueRule, customer_rules, iso_date, rule_names, years_between,
)
from dimflow.operators.profile import flag_email, flag_phone, null_nan_profile
from dimflow.operators.quality import load_validated, read_split, rule_report, split, validate, write_split
from dimflow.schemas import CUSTOMER_VALIDATION, INT, struct
from dimflow.sources.tables import read_csv
from tests.conftest import rows

NOW = "2024-06-15 12:00:00"
GOOD = dict(
    customer_id="1", full_name="Ann Lee", email="ann.lee@example.com", age="34", date_of_birth="1990-01-20",
    phone_number="9876543210", country="UK",
)


CASES = [
    ("customer_id_valid", "customer_id", "30", True),
    ("customer_id_valid", "customer_id", "0", False),
    ("customer_id_valid", "customer_id", "-5", False),
    ("customer_id_valid", "customer_id", "x7", False),
    ("customer_id_valid", "customer_id", "99999999999", True),
    ("customer_id_valid", "customer_id", None, False),
    ("full_name_valid", "full_name", "Zoe 7 Quill", False),
    ("full_name_valid", "full_name", "Tim & Sons", False),
    ("full_name_valid", "full_name", None, False),
    ("email_valid", "email", "no.dot@host", False),
    ("email_valid", "email", "two@@signs.org", False),
    ("email_valid", "email", "a+b%c@d-e.co", True),
    ("email_valid", "email", None, False),
    ("age_valid", "age", "1", True),
    ("age_valid", "age", "120", True),
    ("age_valid", "age", "0", False),
    ("age_valid", "age", "121", False),
    ("age_valid", "age", "29.5", False),
    ("age_valid", "age", None, False),
    ("dob_valid", "date_of_birth", "1996-4-2", True),
    ("dob_valid", "date_of_birth", "1989-02-29", False),
    ("dob_valid", "date_of_birth", "1995-14-10", False),
    ("dob_valid", "date_of_birth", "2028-01-01", False),
    ("dob_valid", "date_of_birth", "1900-12-31", False),
    ("dob_valid", "date_of_birth", "1901-01-01", True),
    ("dob_valid", "date_of_birth", "2024-06-15", True),  # midnight today is past
    ("dob_valid", "date_of_birth", "2024-06-16", False),
    ("dob_valid", "date_of_birth", "12/04/1996", False),
    ("dob_valid", "date_of_birth", None, False),
    ("phone_valid", "phone_number", "12345", False),
    ("phone_valid", "phone_number", "abcdefghij", False),
    ("phone_valid", "phone_number", "9876543210.0", False),
    ("phone_valid", "phone_number", None, False),
    ("country_valid", "country", "Ireland", True),
    ("country_valid", "country", "Mars", False),
    ("country_valid", "country", "uk", False),
    ("country_valid", "country", None, False),
    ("not_null", "country", None, False),
    ("age_consistency", "age", "35", True),
    ("age_consistency", "age", "33", True),
    ("age_consistency", "age", "36", False),
    ("age_consistency", "age", "unknown", False),
    ("age_consistency", "date_of_birth", "1990-13-01", False),
]


def test_customer_rules(spark):
    schema = struct(case=INT, **{f.name: f.dataType for f in CUSTOMER_VALIDATION})
    data = [(i, *(GOOD | {column: value}).values()) for i, (_, column, value, _) in enumerate(CASES)]
    row_rules = [r for r in customer_rules(NOW) if isinstance(r, Rule)]
    found = {r.case: r for r in validate(spark.createDataFrame(data, schema), row_rules).collect()}
    wrong = [case for i, case in enumerate(CASES) if found[i][case[0]] is not case[3]]
    assert not wrong


def test_a_good_row_passes_all_ten(spark):
    row = validate(spark.createDataFrame([tuple(GOOD.values())], CUSTOMER_VALIDATION), customer_rules(NOW)).first()
    assert row.is_valid and len(row) == len(GOOD) + 11


def test_one_bad_age_does_not_fail_the_other_rows(spark):
    df = spark.createDataFrame(
        [tuple((GOOD | {"customer_id": str(i), "full_name": n, "age": a}).values()) for i, n, a in
         [(1, "Ann", "34"), (2, "Bob", None), (3, "Cy", "oops")]],
        CUSTOMER_VALIDATION,
    )
    out = validate(df, customer_rules(NOW))
    assert rows(out, "customer_id", "age_valid") == [("1", True), ("2", False), ("3", False)]
    assert rows(split(out)[0], "customer_id") == [("1",)]


def test_every_member_of_a_duplicate_group_fails_nulls_included(spark):
    df = spark.createDataFrame(
        [(1, "Ann", "1990"), (2, "Ann", "1990"), (3, "Ann", None), (4, None, None), (5, None, None), (6, "Bo", None)],
        "id int, name string, dob string",
    )
    out = validate(df, [UniqueRule("ok", ("name", "dob"))])
    assert rows(out, "id", "ok") == [(1, False), (2, False), (3, True), (4, False), (5, False), (6, True)]


def test_duplicates_agree_when_nothing_is_broadcast(spark, no_broadcast):
    df = spark.range(3000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN NULL WHEN id < 900 THEN id ELSE id % 1500 END AS k", "id % 2 AS j")
    out = validate(df, [UniqueRule("ok", ("k", "j"))])
    seen = {}
    for r in df.collect():
        seen.setdefault((r.k, r.j), []).append(r.id)
    expected = sorted((i, len(ids) == 1) for ids in seen.values() for i in ids)
    assert sorted((r.id, r.ok) for r in out.collect()) == expected


def test_birthday_on_29_february(spark):
    ages = spark.sql("SELECT date'2000-02-29' AS born").select(
        *(years_between(F.col("born"), F.lit(d).cast("date")) for d in ("2023-02-28", "2023-03-01", "2024-02-28", "2024-02-29"))
    ).first()
    assert tuple(ages) == (22, 23, 23, 24)


def test_iso_date_is_strict_about_its_form(spark):
    df = spark.createDataFrame([("1996-04-12",), ("96-04-12",), ("1996-04-12x",), ("1996-00-12",), ("",), (None,)], "d string")
    assert [r[0] is not None for r in df.select(iso_date(F.col("d"))).collect()] == [True] + [False] * 5


def test_report_counts_each_rule(spark):
    df = spark.createDataFrame([(1,), (2,), (2,), (None,)], "customer_id int")
    rules = [Rule("small", F.col("customer_id") < 2), CUSTOMER_ID_UNIQUE]
    assert rows(rule_report(validate(df, rules), rules)) == [
        ("customer_id_unique", 2, 2), ("is_valid", 1, 3), ("small", 1, 3),
    ]
    assert rule_names(rules) == ["small", "customer_id_unique"]


def test_rule_columns_must_be_new(spark):
    with pytest.raises(ValueError, match="already exist"):
        validate(spark.range(1), [Rule("id", F.lit(True))])


def test_user_supplied_pandas_rule(spark):
    @F.pandas_udf("boolean")
    def even(s):
        return s % 2 == 0

    assert rows(validate(spark.range(4), [Rule("even", even("id"))]), "id", "even") == [
        (0, True), (1, False), (2, True), (3, False)
    ]


def test_split_is_written_once_and_a_date_replaces_itself(spark, tmp_path):
    rules = [Rule("small", F.col("id") < 3)]
    path = str(tmp_path / "split")
    write_split(validate(spark.range(5), rules), path, "2024-06-14")
    write_split(validate(spark.range(6), rules), path, "2024-06-15")
    write_split(validate(spark.range(2), rules), path, "2024-06-15")  # no quarantine this time
    valid, quarantined = read_split(spark, path)
    assert valid.count() == 5 and quarantined.count() == 2
    assert rows(quarantined, "id", "small") == [(3, False), (4, False)]


def test_validated_load(spark, tmp_path):
    rules = [Rule("small", F.col("id") < 3)]
    run = lambda n, date: load_validated(
        spark, spark.range(n), rules, str(tmp_path / "split"), str(tmp_path / "target"), date, ["id"]
    )
    assert rows(run(2, "2024-06-14")) == [("is_valid", 2, 0), ("small", 2, 0)]
    assert rows(run(5, "2024-06-15")) == [("is_valid", 3, 2), ("small", 3, 2)]
    run(5, "2024-06-15")
    assert rows(spark.read.parquet(str(tmp_path / "target"))) == [(0,), (1,), (2,)]
    assert read_split(spark, str(tmp_path / "split"))[1].count() == 2


def test_strings_survive_the_csv_reader(spark, tmp_path):
    (tmp_path / "c.csv").write_text(",".join(CUSTOMER_VALIDATION.names) + "\n1,Ann Lee,,34,1990-1-20,0123456789,UK\n")
    row = read_csv(spark, str(tmp_path / "c.csv"), CUSTOMER_VALIDATION).first()
    assert (row.phone_number, row.email) == ("0123456789", None)


def test_profile_counts_null_and_nan_in_one_pass(spark):
    df = spark.createDataFrame(
        [(1.0, "a", None), (float("nan"), None, None), (None, "NaN", 3)], "x double, `dotted.name` string, n int"
    )
    assert rows(null_nan_profile(df)) == [("dotted.name", 1, 0), ("n", 2, 0), ("x", 1, 1)]


def test_flags(spark):
    df = spark.createDataFrame([("a@b.co", "+4915112345678"), ("a@b", "0123"), (None, None), ("x y@b.co", "12-34 567")], "email string, phone string")
    assert [r.email_valid for r in flag_email(df, "email").collect()] == [True, False, False, False]
    assert [r.phone_valid for r in flag_phone(df, "phone").collect()] == [True, False, False, False]
    assert [r.phone_valid for r in flag_phone(df, "phone", "length").collect()] == [True, False, False, True]
    with pytest.raises(ValueError):
        flag_phone(df, "phone", "guess")
