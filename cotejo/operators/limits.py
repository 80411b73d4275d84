"""Ordered and limited reads that behave like a resumable run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def top_then(df: DataFrame, n: int, first: Sequence[str], then: Sequence[str]) -> DataFrame:
    """The first n rows by one order, given in another."""
    return df.orderBy(*first).limit(n).orderBy(*then)


def limited(df: DataFrame, n: int, order: Sequence[str]) -> tuple[DataFrame, bool]:
    """The first n rows, and whether there were more: one row is looked ahead, so the answer is exact."""
    ahead = df.orderBy(*order).limit(n + 1)
    return ahead.limit(n), ahead.count() > n


def resume_from(df: DataFrame, page: str, row: str, at: tuple[int, int]) -> DataFrame:
    """Rows at or behind a confirmed place; a range filter the scan can use."""
    return df.filter((F.col(page) > at[0]) | ((F.col(page) == at[0]) & (F.col(row) >= at[1])))


def new_rows(df: DataFrame, known: DataFrame, keys: Sequence[str], n: int, order: Sequence[str]) -> DataFrame:
    """The first n rows whose key is not known yet; known rows do not count."""
    return df.join(known.select(*keys).distinct(), list(keys), "left_anti").orderBy(*order).limit(n)


def collated(df: DataFrame, column: str, language_order: bool = True) -> DataFrame:
    """Ordered as a reader expects (Unicode collation), or by code point."""
    return df.orderBy(F.collate(F.col(column), "UNICODE") if language_order else F.col(column))
