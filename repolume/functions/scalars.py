"""Small scalar and array expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repolume.fixed_values import DATE_PATTERN

_URL_KEY = "/repos/([^/]+/[^/]+)/[a-z]+/([0-9]+)$"


def field_of(structs: Column, field: str) -> Column:
    """Array of structs -> array of one field; a missing array reads as an empty one."""
    return F.coalesce(structs[field], F.array())


def without_nulls(values: Column) -> Column:
    return F.array_compact(F.coalesce(values, F.array()))


def apply_datetime_format(
    df: DataFrame, source: str, destination: str | None = None, pattern: str = DATE_PATTERN, strict: bool = True
) -> DataFrame:
    """Parse ``source`` by ``pattern`` into ``destination`` (in place when absent).

    ``strict`` fails on text that does not fit; otherwise such text becomes NULL.
    """
    if strict:
        parsed = F.to_timestamp(F.col(source), pattern)
    else:
        parsed = F.try_to_timestamp(F.col(source), F.lit(pattern))
    return df.withColumn(destination or source, parsed)


def split_list(text: Column, separator: str = ",") -> Column:
    return F.split(text, f"\\Q{separator}\\E")


def owner_of(full_name: Column) -> Column:
    return F.split_part(full_name, F.lit("/"), F.lit(1))


def contains_any(text: Column, patterns: Iterable[str]) -> Column:
    """Is any of the (literal, case-sensitive) substrings in ``text``."""
    return reduce(lambda found, pattern: found | text.contains(pattern), patterns, F.lit(False))


def url_repository(url: Column) -> Column:
    """``owner/name`` out of a record url, NULL where the url has another form."""
    return F.nullif(F.regexp_extract(url, _URL_KEY, 1), F.lit(""))


def url_number(url: Column) -> Column:
    """Trailing number (or id) of a record url, NULL where the url has another form."""
    return F.nullif(F.regexp_extract(url, _URL_KEY, 2), F.lit("")).cast("long")


# Up to this length the plain distance is cheap; longer texts are stripped of their common ends first.
_SHORT = 256


def _once(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _common_end(old: Column, new: Column, part: Callable[[Column, Column, Column], Column]) -> Column:
    """Characters that two texts share at one end, found by halving; ``part`` is a text's piece of a length that lies
    so many characters from that end."""
    longest = F.least(F.length(old), F.length(new))

    def longer(known: Column, step: Column) -> Column:
        fits = (known + step <= longest) & (part(old, known, step) == part(new, known, step))
        return F.when(fits, known + step).otherwise(known)

    return F.aggregate(F.array(*(F.lit(1 << power) for power in reversed(range(30)))), F.lit(0), longer)


def _strip_start(old: Column, new: Column) -> Column:
    same = _common_end(old, new, lambda text, known, step: F.substring(text, known + 1, step))
    rest = lambda text, n: F.substring(text, n + 1, F.length(text))
    return _once(same, lambda n: F.struct(rest(old, n).alias("old"), rest(new, n).alias("new")))


def _strip_end(old: Column, new: Column) -> Column:
    same = _common_end(old, new, lambda text, known, step: F.substring(text, F.length(text) - known - step + 1, step))
    rest = lambda text, n: F.substring(text, F.lit(1), F.length(text) - n)
    return _once(same, lambda n: F.struct(rest(old, n).alias("old"), rest(new, n).alias("new")))


def edit_distance(old: Column, new: Column) -> Column:
    """Levenshtein distance of two texts in characters; an absent text counts as empty.

    Long texts lose their common ends first, so the work grows with the square of what lies between the first and the
    last change, not with that of the file.
    """
    old, new = F.coalesce(old, F.lit("")), F.coalesce(new, F.lit(""))
    long = _once(
        F.struct(old.alias("old"), new.alias("new")),
        lambda pair: _once(
            _strip_start(pair["old"], pair["new"]),
            lambda pair: _once(_strip_end(pair["old"], pair["new"]), lambda pair: F.levenshtein(pair["old"], pair["new"])),
        ),
    )
    short = F.least(F.length(old), F.length(new)) <= _SHORT
    return F.when(old == new, F.lit(0)).when(short, F.levenshtein(old, new)).otherwise(long)


def changed(old: Column, new: Column) -> Column:
    """NULL-safe inequality."""
    return ~old.eqNullSafe(new)
