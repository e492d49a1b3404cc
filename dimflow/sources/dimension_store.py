"""Versioned Parquet storage of a type 2 dimension.

Layout::

    <root>/_commits/7                            the folder of version 7
    <root>/version=7.<run>/row_state=open/...    every open row as of version 7
    <root>/version=7.<run>/row_state=closed/...  the rows version 7 closed

A load writes a new version beside the ones being read, so a dimension is never
overwritten while it is read, and a failed load leaves the last version in force.
A version counts once its commit exists, which only one of several loads can create;
a load that comes second merges again into the version that came before it.
Closed rows are written once and never again: a load costs the open rows and the
change, however long the history grows.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from dimflow import storage
from dimflow.entities import EntitySpec
from dimflow.operators.scd import scd2_merge


class DimensionStore:
    def __init__(self, spark: SparkSession, root: str, spec: EntitySpec):
        self.spark, self.root, self.spec = spark, root.rstrip("/"), spec

    def _folders(self) -> dict[int, str]:
        """The folder of every committed version; one without commit, as once written, counts when it is complete."""
        names = [n for n in storage.list_names(self.spark, self.root) if n.removeprefix("version=").isdigit()]
        found = {int(n.removeprefix("version=")): n for n in names if storage.exists(self.spark, f"{self.root}/{n}/_SUCCESS")}
        commits = [n for n in storage.list_names(self.spark, f"{self.root}/_commits") if n.isdigit()]
        return found | {int(n): storage.read_text(self.spark, f"{self.root}/_commits/{n}") for n in commits}

    def versions(self) -> list[int]:
        """Committed versions, oldest first."""
        return sorted(self._folders())

    def _read(self, folders: Sequence[str], state: str) -> DataFrame:
        paths = [f"{self.root}/{folder}/row_state={state}" for folder in folders]
        paths = [p for p in paths if storage.exists(self.spark, p)]
        if not paths:
            return self.spark.createDataFrame([], self.spec.dim_schema)
        return self.spark.read.schema(self.spec.dim_schema).parquet(*paths)

    def read_open(self) -> DataFrame | None:
        """The open rows, or None before the first load."""
        folders = self._folders()
        return self._read([folders[max(folders)]], "open") if folders else None

    def read(self) -> DataFrame | None:
        """Open rows and full history, or None before the first load."""
        folders = self._folders()
        if not folders:
            return None
        return self._read([folders[max(folders)]], "open").unionByName(self._read(list(folders.values()), "closed"))

    def write(self, rows: DataFrame, version: int) -> bool:
        """Write open and newly closed rows as ``version``; False, and nothing written, if another load has taken it."""
        state = F.when(F.col(self.spec.active), "open").otherwise("closed")
        folder = f"version={version}.{uuid.uuid4().hex[:12]}"
        (
            rows.select(*self.spec.dim_schema.fieldNames(), state.alias("row_state"))
            .write.partitionBy("row_state")
            .parquet(f"{self.root}/{folder}")
        )
        if storage.put_if_absent(self.spark, f"{self.root}/_commits/{version}", folder):
            return True
        storage.delete(self.spark, f"{self.root}/{folder}")
        return False

    def merge(
        self,
        source: DataFrame,
        as_of: str,
        absent: str = "keep",
        order_by: Sequence[Column | str] = (),
    ) -> int:
        """Merge ``source`` into the open rows and write the result as the next version; returns its number."""
        if absent == "drop":
            raise ValueError("stored history is never removed; use absent='keep' or 'expire'")
        while True:
            folders = self._folders()
            last = max(folders, default=0)
            dim = self._read([folders[last]], "open") if folders else None
            merged = scd2_merge(dim, source, self.spec, as_of, absent=absent, order_by=order_by, include_history=False)
            if self.write(merged, last + 1):
                return last + 1


def read_dimension(spark: SparkSession, root: str, spec: EntitySpec) -> DataFrame | None:
    """A stored dimension with its history, or None when it was never loaded."""
    return DimensionStore(spark, root, spec).read()
