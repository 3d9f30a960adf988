"""Array helpers shared by every operator. Missing lists are empty lists; missing text is NULL."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

WHITESPACE = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85   　"


def strip(c: Column) -> Column:
    """Text without leading and trailing white space."""
    return F.btrim(c, F.lit(WHITESPACE))


def text(c: Column) -> Column:
    """Stripped text with NULL as the empty string."""
    return F.coalesce(strip(c.cast("string")), F.lit(""))


def blank_to_null(c: Column) -> Column:
    return F.nullif(strip(c.cast("string")), F.lit(""))


def is_blank(c: Column) -> Column:
    return text(c) == ""


def strings(values: Iterable[str]) -> Column:
    values = list(values)
    if not values:
        return F.array().cast("array<string>")
    return F.array(*[F.lit(v) for v in values])


def or_empty(c: Column) -> Column:
    return F.coalesce(c, F.array().cast("array<string>"))


def clean_list(c: Column) -> Column:
    """Stripped, non-blank items in order; NULL list gives an empty list."""
    return F.filter(F.transform(or_empty(c), lambda x: text(x)), lambda x: x != "")


def distinct_labels(c: Column) -> Column:
    """Non-blank items, the first spelling winning among items equal up to case, order kept.

    The items are bound: a lambda that named their expression would compute all of it anew for each item.
    """

    def first_spellings(items: Column, lowered: Column) -> Column:
        return F.filter(items, lambda x, i: F.array_position(lowered, F.lower(x)) == (i + 1).cast("bigint"))

    return bind(clean_list(c), lambda items: bind(F.transform(items, F.lower), lambda lowered: first_spellings(items, lowered)))


def compact(*items: Column) -> Column:
    """Array of the non-null items: tag lists are built as ``when(cond, tag)`` items."""
    return F.array_compact(F.array(*items))


def tag_if(cond: Column, tag: str | Column) -> Column:
    return F.when(cond, F.lit(tag) if isinstance(tag, str) else tag)


def joined(c: Column, sep: str = ", ") -> Column:
    return F.array_join(c, sep)


def contains_any(haystack: Column, needles: Iterable[str]) -> Column:
    cond = F.lit(False)
    for needle in needles:
        cond = cond | F.contains(haystack, F.lit(needle))
    return cond


def overlaps(a: Column, b: Column) -> Column:
    return F.arrays_overlap(a, b)


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def tag_pairs(c: Column) -> Column:
    """A list of (tag, count) as the VARIANT ``[[tag, count], ..]``, which is how such lists are stored and exported."""
    quoted = lambda t: F.regexp_replace(F.to_json(F.array(t["tag"])), r"^\[|\]$", "")
    pairs = F.transform(c, lambda t: F.concat(F.lit("["), quoted(t), F.lit(","), F.coalesce(t["count"].cast("string"), F.lit("null")), F.lit("]")))
    return F.parse_json(F.concat(F.lit("["), F.array_join(pairs, ","), F.lit("]")))


def is_tag_list(kind: T.DataType) -> bool:
    return isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType) and kind.elementType.names == ["tag", "count"]
