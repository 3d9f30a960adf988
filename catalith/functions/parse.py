"""Numbers, years and dates out of text, JSON values and provider formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from catalith.functions.lists import blank_to_null, strip, text


def variant_at(payload: Column, path: str, type_: str = "variant") -> Column:
    """Value at a JSON path of a VARIANT, NULL when absent or of another shape."""
    return F.try_variant_get(payload, path, type_)


def _kind(v: Column) -> Column:
    return F.schema_of_variant(v)


def _is_number(v: Column) -> Column:
    return _kind(v).rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)")


def strict_int(v: Column) -> Column:
    """JSON integer or integral float as BIGINT; text and booleans give NULL."""
    d = F.try_variant_get(v, "$", "double")
    return F.when(_kind(v) == "BIGINT", F.try_variant_get(v, "$", "bigint")).when(
        _is_number(v) & (d == F.floor(d)), d.try_cast("bigint")
    )


def strict_float(v: Column) -> Column:
    """JSON number as DOUBLE; text and booleans give NULL."""
    return F.when(_is_number(v), F.try_variant_get(v, "$", "double"))


def json_text(v: Column) -> Column:
    """JSON scalar as stripped text; NULL gives the empty string."""
    return text(F.try_variant_get(v, "$", "string"))


def int_from_text(v: Column) -> Column:
    """Integer from a JSON number or from digit text."""
    s = F.when(_kind(v) == "STRING", strip(F.try_variant_get(v, "$", "string")))
    return F.coalesce(strict_int(v), F.when(s.rlike(r"^-?\d+$"), s.try_cast("bigint")))


def float_from_text(v: Column) -> Column:
    """Float from a JSON number or from numeric text."""
    s = F.when(_kind(v) == "STRING", strip(F.try_variant_get(v, "$", "string")))
    return F.coalesce(strict_float(v), s.try_cast("double"))


def plain_int(c: Column) -> Column:
    """Integer from text that may use thousands commas and spaces."""
    s = F.regexp_replace(text(c), r"[,\s]", "")
    return F.when(s.rlike(r"^-?\d+$"), s.try_cast("bigint"))


def plain_float(c: Column) -> Column:
    """Finite float from text."""
    d = blank_to_null(c).try_cast("double")
    return F.when(~F.isnan(d) & (F.abs(d) != float("inf")), d)


def positive_hours(c: Column) -> Column:
    h = plain_float(c)
    return F.when(h > 0, h)


def owner_range(c: Column) -> tuple[Column, Column, Column]:
    """(low, high, mid) of ``1,000 .. 2,000`` or ``1000-2000``; reversed bounds are swapped, mid rounds half-even."""
    pattern = r"^\s*([\d,\s]+)\s*(?:\.\.|-)\s*([\d,\s]+)\s*$"
    s = text(c)
    a = plain_int(F.regexp_extract(s, pattern, 1))
    b = plain_int(F.regexp_extract(s, pattern, 2))
    ok = (a > 0) & (b > 0)
    low, high = F.when(ok, F.least(a, b)), F.when(ok, F.greatest(a, b))
    return low, high, F.bround((low + high) / F.lit(2.0)).cast("bigint")


def year_from_text(c: Column) -> Column:
    """Year from ``YYYY-..`` or from the first year in free text."""
    s = text(c)
    lead = F.regexp_extract(s, r"^(\d{4})", 1).try_cast("int")
    free = F.regexp_extract(s, r"\b(19\d{2}|20\d{2})\b", 1).try_cast("int")
    return F.coalesce(F.when(lead.between(1900, 2100), lead), free)


def leading_year(c: Column) -> Column:
    """First four characters as a year when they are digits."""
    return F.regexp_extract(text(c), r"^(\d{4})", 1).try_cast("int")


def date_from_epoch(seconds: Column) -> Column:
    """UTC date of epoch seconds, whatever the session time zone."""
    return F.date_add(F.lit("1970-01-01").cast("date"), F.floor(seconds / F.lit(86400)).cast("int"))


def year_from_epoch(seconds: Column) -> Column:
    return F.when(seconds > 0, F.year(date_from_epoch(seconds)))


def claim_date(c: Column) -> Column:
    """``+YYYY-MM-DDT..`` as ``YYYY-MM-DD`` text, blank otherwise."""
    return F.regexp_extract(text(c), r"^[+-](\d{4}-\d{2}-\d{2})", 1)


def claim_year(c: Column) -> Column:
    return F.regexp_extract(text(c), r"^[+-]?(\d{4})", 1).try_cast("int")


def iso_date(c: Column) -> Column:
    """Strict ``YYYY-MM-DD`` as DATE."""
    s = text(c)
    return F.when(s.rlike(r"^\d{4}-\d{2}-\d{2}$"), s.try_cast("date"))


def stamp_date(c: Column) -> Column:
    """``YYYYMMDD00`` as DATE."""
    s = text(c)
    dashed = F.concat_ws("-", F.substring(s, 1, 4), F.substring(s, 5, 2), F.substring(s, 7, 2))
    return F.when(s.rlike(r"^\d{8}00$"), dashed.try_cast("date"))


def date_stamp(d: Column) -> Column:
    return F.concat(F.date_format(d, "yyyyMMdd"), F.lit("00"))


def window_key(c: Column) -> dict[str, Column]:
    """Parts of ``project|access|user|article|daily|start|end``; the article may itself hold the separator.

    ``valid`` tells whether the key is one of that form with an ordered date range.
    """
    parts = F.split(F.coalesce(c, F.lit("")), r"\|")
    n = F.size(parts)
    start, end = stamp_date(F.try_element_at(parts, F.lit(-2))), stamp_date(F.try_element_at(parts, F.lit(-1)))
    well_formed = (
        (n >= 7)
        & (F.try_element_at(parts, F.lit(3)) == "user")
        & (F.try_element_at(parts, F.lit(-3)) == "daily")
    )
    return {
        "project": F.try_element_at(parts, F.lit(1)),
        "access": F.try_element_at(parts, F.lit(2)),
        "article": F.when(n >= 7, F.array_join(F.slice(parts, F.lit(4), F.greatest(n - 6, F.lit(0))), "|")),
        "start": start,
        "end": end,
        "days": F.date_diff(end, start) + 1,
        "valid": F.coalesce(well_formed & (end >= start), F.lit(False)),
    }


def is_yes(c: Column) -> Column:
    return F.upper(text(c)).isin("YES", "Y", "TRUE", "1")


def is_game_type(c: Column) -> Column:
    """Store type test: blank counts as a game."""
    return F.lower(text(c)).isin("", "game")
