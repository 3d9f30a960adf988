"""Schema-level steps: which columns a frame has, in what order and under which names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalith.constants import DEPRECATED_COLUMNS, NOT_FOUND, PIN_COLUMNS, PROVIDER_PREFIX
from catalith.functions.lists import clean_list, is_blank, text
from catalith.functions.parse import is_yes
from catalith.functions.text import valid_year, year_hint
from catalith.sources.registry import Registry

_PREFIXES = tuple(PROVIDER_PREFIX.values())
_FRONT = ("RowId", "Name", "Disabled", "YearHint", "Platform")


def with_missing_columns(df: DataFrame, defaults: dict[str, str | None]) -> DataFrame:
    """Add the columns a frame lacks, with their defaults."""
    add = {c: F.lit(v).cast("string") for c, v in defaults.items() if c not in df.columns}
    return df.withColumns(add) if add else df


def active_rows(df: DataFrame, name: str = "Name", disabled: str = "Disabled") -> DataFrame:
    """Rows with a name that are not disabled."""
    out = df.where(~is_blank(F.col(name)))
    return out.where(~is_yes(F.col(disabled))) if disabled in df.columns else out


def is_processed(df: DataFrame, required: list[str]) -> Column:
    """Whether all required columns are filled."""
    cond = F.lit(True)
    for c in required:
        cond = cond & (~is_blank(F.col(c)) if c in df.columns else F.lit(False))
    return cond


def clear_when_not_found(df: DataFrame, pin: str, prefix: str) -> DataFrame:
    """Blank all columns of a provider where its pin says the user knows there is no match."""
    gone = text(F.col(pin)) == NOT_FOUND
    cols = {
        c: F.when(gone, F.lit(None).cast(df.schema[c].dataType)).otherwise(F.col(c))
        for c in df.columns
        if c.startswith(prefix) and c != pin
    }
    cols[pin] = F.when(gone, F.lit(None).cast("string")).otherwise(F.col(pin))
    return df.withColumns(cols)


def fill_year_hint(df: DataFrame) -> DataFrame:
    """Fill blank ``YearHint`` of active rows from the title."""
    if "YearHint" not in df.columns:
        return df
    off = is_yes(F.col("Disabled")) if "Disabled" in df.columns else F.lit(False)
    own = text(F.col("YearHint"))
    return df.withColumn(
        "YearHint",
        F.when(off | (own != ""), own).otherwise(F.coalesce(year_hint(F.col("Name")).cast("string"), F.lit(""))),
    )


def derived_year_hint(year_hint_column: Column, rawg: Column, igdb: Column, steam: Column) -> Column:
    """Year to search with: the user's hint, else the year of the RAWG, IGDB or store payload, in that order."""
    return F.coalesce(*[valid_year(c.cast("string")) for c in (year_hint_column, rawg, igdb, steam)])


def fallback_titles(steam: Column, rawg: Column, igdb: Column) -> Column:
    """Titles to try next: the store's, RAWG's and IGDB's names, distinct and non-blank."""
    return F.array_distinct(clean_list(F.array(steam, rawg, igdb)))


def personal_base(df: DataFrame, diagnostic_columns: set[str]) -> DataFrame:
    """User columns and pins only: what a fresh enrichment starts from."""
    keep = {"RowId", "Name", *PIN_COLUMNS}
    return df.select(
        *[c for c in df.columns if c not in diagnostic_columns and (c in keep or not c.startswith(_PREFIXES))]
    )


def drop_diagnostics(df: DataFrame, diagnostic_columns: set[str]) -> DataFrame:
    return df.drop(*[c for c in diagnostic_columns if c in df.columns])


def drop_deprecated(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in DEPRECATED_COLUMNS if c in df.columns])


def provider_columns(columns: list[str], prefix: str, extra: tuple[str, ...] = ()) -> list[str]:
    """Id, name and the columns of one provider, plus extras that exist."""
    out = [c for c in ("RowId", "Name") if c in columns]
    out += [c for c in columns if c.startswith(prefix) and c not in out]
    return out + [c for c in extra if c in columns and c not in out]


def column_order(columns: list[str], registry: Registry) -> list[str]:
    """Front columns, pins, user columns, derived metrics, provider metrics by provider, diagnostics, the rest."""
    have = set(columns)
    groups: list[list[str]] = [
        [c for c in _FRONT if c in have],
        [c for c in PIN_COLUMNS if c in have],
        [
            c
            for c in columns
            if not c.startswith("__") and c not in registry.by_column and c not in registry.diagnostic_columns
        ],
    ]
    blended = {c for k, (c, _t) in registry.by_key.items() if k.startswith(("derived.", "composite."))}
    groups.append(sorted(c for c in blended if c in have))
    for head in (*PROVIDER_PREFIX, "wikipedia"):
        own = {c for k, (c, _t) in registry.by_key.items() if k.split(".", 1)[0].lower() == head}
        groups.append(sorted(c for c in own - set(PIN_COLUMNS) if c in have))
    groups.append(sorted(c for c in registry.diagnostic_columns if c in have))
    groups.append(list(columns))
    return list(dict.fromkeys(c for g in groups for c in g))


def reorder(df: DataFrame, registry: Registry) -> DataFrame:
    return df.select(*column_order(df.columns, registry))


def is_metric_candidate(column: str, registry: Registry) -> bool:
    """Whether a column is a metric (registered or provider-prefixed) rather than a user column."""
    return bool(column) and (column in registry.by_column or column.startswith(_PREFIXES))


def selected_columns(columns: list[str], registry: Registry) -> list[str]:
    """Column selection by registry: unmapped metric columns are left out, user columns stay."""
    return [
        c
        for c in columns
        if c in PIN_COLUMNS or c == "RowId" or c in registry.by_column or not is_metric_candidate(c, registry)
    ]


def select_registered(df: DataFrame, registry: Registry) -> DataFrame:
    """Apply the registry's selection to a wide frame."""
    return df.select(*[c for c in df.columns if c == "RowId" or c in registry.by_column or not is_metric_candidate(c, registry)])


def personal_columns(columns: list[str], registry: Registry) -> list[str]:
    return [
        c
        for c in columns
        if c != "RowId"
        and c not in registry.diagnostic_columns
        and c not in PIN_COLUMNS
        and not is_metric_candidate(c, registry)
    ]


def _name_words(name: str) -> list[str]:
    """Words of a column name: apart at blanks, hyphens and underscores, before a capital after a small letter, and between letters and digits."""
    words, last = [""], ""
    for c in name:
        kind = "A" if "A" <= c <= "Z" else "a" if "a" <= c <= "z" else "0" if "0" <= c <= "9" else "_" if c in " -_" else "?"
        if kind == "_" or last + kind in ("aA", "A0", "a0", "0A", "0a"):
            words.append("")
        words[-1] += "" if kind == "_" else c
        last = kind
    return [w for w in words if w]


def auto_metric_key(column: str) -> str:
    """Dotted key for an unregistered metric column: the provider with the longest matching prefix, then the words and numbers of the rest."""
    named = column.strip()
    if not named:
        return "derived.unknown"
    fitting = [(len(prefix), head) for head, prefix in PROVIDER_PREFIX.items() if named.startswith(prefix)]
    length, head = max(fitting, default=(0, "derived"))
    return f"{head}.{'_'.join(_name_words(named[length:].strip())).casefold() or 'value'}"


def apply_registry(df: DataFrame, metrics: dict[str, Column], registry: Registry) -> DataFrame:
    """Write metric expressions into their registered columns; keys the registry leaves out are not computed."""
    return df.withColumns({registry.by_key[k][0]: v for k, v in metrics.items() if k in registry.by_key})


def parse_sources(raw: str, allowed: tuple[str, ...], aliases: dict[str, list[str]] | None = None) -> list[str]:
    """Provider list from ``all``, an alias or a comma list: distinct, in order, unknown names rejected."""
    words = [w.strip().lower() for w in (raw or "").split(",") if w.strip()]
    if not words:
        raise ValueError("no source given")
    if words == ["all"]:
        return sorted(allowed)
    wanted = [x for w in words for x in (aliases or {}).get(w, [w])]
    unknown = [x for x in wanted if x not in allowed]
    if unknown:
        raise ValueError(f"unknown provider: {', '.join(unknown)}; allowed: {', '.join(sorted(allowed))}")
    return list(dict.fromkeys(wanted))


def registry_check(df: DataFrame, registry: Registry) -> DataFrame:
    """Header against registry: unmapped metric columns and unused registry keys, as ``(issue, name)`` rows."""
    header = [c for c in df.columns if c not in PIN_COLUMNS and c.startswith(_PREFIXES)]
    spark = df.sparkSession
    cols = spark.createDataFrame([(c,) for c in header], "name string")
    mapped = spark.createDataFrame([(c,) for c in registry.by_column], "name string")
    keyed = spark.createDataFrame([(c, k) for c, (k, _t) in registry.by_column.items()], "name string, key string")
    present = spark.createDataFrame([(c,) for c in df.columns], "name string")
    unmapped = cols.exceptAll(mapped).select(F.lit("unmapped_column").alias("issue"), "name")
    unused = keyed.join(present, "name", "left_anti").select(F.lit("unused_key").alias("issue"), F.col("key").alias("name"))
    return unmapped.unionByName(unused)


def columns_with_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row telling for each column whether any row fills it."""
    return df.agg(
        *[
            F.coalesce(F.max(~is_blank(F.col(c).cast("string"))), F.lit(False)).alias(c)
            if c in df.columns
            else F.lit(False).alias(c)
            for c in columns
        ]
    )
