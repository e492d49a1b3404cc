"""Registry of runnable queries: each is a Spark plan over the given tables, with its SQL check."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Build = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Build
    sql: str | None


REGISTRY: dict[str, Query] = {}


def register(name: str, build: Build, sql: str | None = None) -> None:
    if name in REGISTRY:
        raise ValueError(f"query {name} is registered twice")
    REGISTRY[name] = Query(name, build, sql)


def query(sql: str | None = None) -> Callable[[Build], Build]:
    """Register the decorated function under its own name."""

    def wrap(build: Build) -> Build:
        register(build.__name__, build, sql)
        return build

    return wrap


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
