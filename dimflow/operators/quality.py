"""Rule-based validation and the valid/quarantine split."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession, functions as F

from dimflow.functions.rules import Rule, UniqueRule, rule_names
from dimflow.operators.incremental import insert_ignore
from dimflow.operators.lookup import flag_unique
from dimflow.sources.key_ranges import rows_of_files
from dimflow.sources.tables import read_table, write_table

Rules = Sequence[Rule | UniqueRule]


def validate(df: DataFrame, rules: Rules) -> DataFrame:
    """``df`` with one boolean column per rule and ``is_valid``, their conjunction."""
    clash = set(rule_names(rules)) & set(df.columns)
    if clash:
        raise ValueError(f"rule columns {sorted(clash)} already exist")
    flagged = df
    for rule in rules:
        if isinstance(rule, UniqueRule):
            flagged = flag_unique(flagged, rule.keys, rule.name)
    flagged = flagged.select("*", *(r.column for r in rules if isinstance(r, Rule)))
    is_valid = reduce(and_, (F.col(n) for n in rule_names(rules)), F.lit(True))
    return flagged.select(*df.columns, *rule_names(rules), is_valid.alias("is_valid"))


def split(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid) rows. To write both from one pass use ``write_split``."""
    return validated.where("is_valid").drop("is_valid"), validated.where("NOT is_valid").drop("is_valid")


def rule_report(validated: DataFrame, rules: Rules) -> DataFrame:
    """(rule, passed, failed) per rule, and for ``is_valid`` over all rules; one pass."""
    counts = [
        F.struct(
            F.lit(n).alias("rule"), F.count_if(F.col(n)).alias("passed"), F.count_if(~F.col(n)).alias("failed")
        )
        for n in [*rule_names(rules), "is_valid"]
    ]
    return validated.agg(F.array(*counts).alias("counts")).select(F.inline("counts"))


def write_split(validated: DataFrame, path: str, load_date: str) -> None:
    """Write valid and quarantined rows in one pass, under ``load_date=/outcome=``.

    Writing a load date again replaces that date and no other.
    """
    outcome = F.when(F.col("is_valid"), "valid").otherwise("quarantine")
    (
        validated.withColumn("outcome", outcome)
        .drop("is_valid")
        .write.mode("overwrite")
        .partitionBy("outcome")
        .parquet(f"{path}/load_date={load_date}")
    )


def read_split(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(valid, quarantined) rows written by ``write_split``; each reads its own partitions only."""
    rows = spark.read.parquet(path)
    return rows.where("outcome = 'valid'").drop("outcome"), rows.where("outcome = 'quarantine'").drop("outcome")


def load_validated(
    spark: SparkSession,
    df: DataFrame,
    rules: Rules,
    split_path: str,
    target_path: str,
    load_date: str,
    keys: Sequence[str],
    key_ranges: bool = False,
) -> DataFrame:
    """Validate a load, quarantine its bad rows and insert the good ones that ``target_path`` lacks.

    Rows are validated once, on their way into ``split_path``. Loading a date again
    replaces its split and inserts nothing twice. With ``key_ranges`` the target's files are indexed, and those that cannot
    hold one of the keys are not read; worth its jobs on a large target. Returns the date's rule report.
    """
    write_split(validate(df, rules), split_path, load_date)
    day = spark.read.parquet(f"{split_path}/load_date={load_date}")
    valid = day.where("outcome = 'valid'").select(*df.columns)
    if key_ranges:
        target = rows_of_files(spark, target_path, valid, keys)
    else:
        target = read_table(spark, "parquet", {"path": target_path}, schema=valid.schema, missing_ok=True)
    write_table(insert_ignore(target, valid, keys), "parquet", {"path": target_path}, mode="append")
    return rule_report(day.withColumn("is_valid", F.col("outcome") == "valid"), rules)
