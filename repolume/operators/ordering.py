"""Sorted listings, pages and picks by position."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repolume.functions.ranking import slice_by_position

# Rows that a task may hold in a heap to find a page.
TOP = 100_000


def _order(columns: Sequence[str], ascending: bool) -> list[Column]:
    return [F.col(c).asc() if ascending else F.col(c).desc() for c in columns]


def sort_by_update(
    df: DataFrame, updated_at: str = "updated_at", key: str = "id", ascending: bool = True
) -> DataFrame:
    """Sort by update time; the key decides ties, so that the order is total."""
    return df.orderBy(*_order([updated_at, key], ascending))


def page(
    df: DataFrame, limit: int, offset: int = 0, updated_at: str = "updated_at", key: str = "id",
    ascending: bool = True,
) -> DataFrame:
    """``limit`` rows of the sorted listing, after ``offset`` rows.

    A page near the top is a heap in each task; beyond ``TOP`` rows only the key ranges that reach into it are read.
    """
    if offset + limit <= TOP:
        return sort_by_update(df, updated_at, key, ascending).offset(offset).limit(limit)
    picked = slice_by_position(df, [updated_at, key], offset, limit, ascending=ascending)
    return sort_by_update(picked, updated_at, key, ascending)


def nth(
    df: DataFrame, ordinal: int, updated_at: str = "updated_at", key: str = "id", newest_first: bool = True
) -> DataFrame:
    """The record at a zero-based position; no row past the end."""
    return page(df, 1, ordinal, updated_at, key, not newest_first)


def first_per_parent(
    df: DataFrame, parent: Sequence[str], order: Sequence[str], limit: int, ascending: bool = True
) -> DataFrame:
    """At most ``limit`` rows of each parent, in order."""
    return slice_by_position(df, order, 0, limit, parent, ascending)


def listing(
    df: DataFrame, state: str = "all", state_column: str = "state", updated_at: str = "updated_at", key: str = "id",
    ascending: bool = True,
) -> DataFrame:
    """Sorted listing of one state, or of all; the state filter reaches the scan."""
    if state != "all":
        df = df.where(F.col(state_column) == state)
    return sort_by_update(df, updated_at, key, ascending)
