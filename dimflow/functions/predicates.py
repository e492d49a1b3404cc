"""Predicates shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_

from pyspark.sql import Column, functions as F


def all_present(columns: Iterable[str]) -> Column:
    """Every column is non-NULL. Unlike ``na.drop`` this is pushed down into scans."""
    return reduce(and_, (F.col(c).isNotNull() for c in columns), F.lit(True))
