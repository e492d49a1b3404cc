"""Validation rules: named boolean columns that are never NULL."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, functions as F

from dimflow.functions.predicates import all_present

# Accepted formats, ranges and countries.
NAME_PATTERN = r"^[A-Za-z ]+$"
EMAIL_PATTERN = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"
PHONE_PATTERN = r"^[0-9]{10}$"
COUNTRIES = ("USA", "UK", "India", "Canada", "Australia", "Ireland")
MIN_AGE, MAX_AGE = 1, 120
BORN_AFTER_YEAR = 1900
MAX_AGE_GAP = 1
MANDATORY = ("customer_id", "full_name", "email", "age", "date_of_birth", "phone_number", "country")


@dataclass(frozen=True)
class Rule:
    """A row passes when ``check``, any boolean Column, holds; NULL fails."""

    name: str
    check: Column

    @property
    def column(self) -> Column:
        return F.coalesce(self.check, F.lit(False)).alias(self.name)


@dataclass(frozen=True)
class UniqueRule:
    """A row passes when no other row has the same ``keys``; NULL keys are equal."""

    name: str
    keys: tuple[str, ...]


def matches(col: Column, pattern: str) -> Column:
    return F.coalesce(col.rlike(pattern), F.lit(False))


def whole_number(col: Column) -> Column:
    """Integer value of a column that may hold text; NULL when it is not an integer."""
    return col.try_cast("long")


def iso_date(col: Column) -> Column:
    """Date of a year-month-day text, one-digit month and day allowed; NULL when invalid."""
    text = col.cast("string")
    return F.when(text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), F.try_to_date(text, "yyyy-M-d"))


def years_between(born: Column, today: Column) -> Column:
    """Completed years of age; a birthday on 29 February is reached on 1 March."""
    month_day = lambda d: F.month(d) * 100 + F.dayofmonth(d)
    return F.year(today) - F.year(born) - (month_day(today) < month_day(born)).cast("int")


def customer_rules(as_of: str) -> list[Rule | UniqueRule]:
    """The ten customer checks, evaluated as of a given moment."""
    now = F.lit(as_of).cast("timestamp_ntz")
    today = now.cast("date")
    age = whole_number(F.col("age"))
    born = iso_date(F.col("date_of_birth"))
    return [
        Rule("customer_id_valid", whole_number(F.col("customer_id")) > 0),
        Rule("full_name_valid", F.col("full_name").rlike(NAME_PATTERN)),
        Rule("email_valid", F.col("email").rlike(EMAIL_PATTERN)),
        Rule("age_valid", age.between(MIN_AGE, MAX_AGE)),
        Rule("dob_valid", (born.cast("timestamp_ntz") < now) & (F.year(born) > BORN_AFTER_YEAR)),
        Rule("phone_valid", F.col("phone_number").cast("string").rlike(PHONE_PATTERN)),
        Rule("country_valid", F.col("country").isin(*COUNTRIES)),
        Rule("not_null", all_present(MANDATORY)),
        UniqueRule("no_duplicates", ("full_name", "date_of_birth")),
        Rule("age_consistency", F.abs(years_between(born, today) - age) <= MAX_AGE_GAP),
    ]


# Available, but not among the ten: identifiers must not repeat.
CUSTOMER_ID_UNIQUE = UniqueRule("customer_id_unique", ("customer_id",))


def rule_names(rules: Sequence[Rule | UniqueRule]) -> list[str]:
    return [r.name for r in rules]
