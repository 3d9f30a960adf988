"""Row envelopes ``{row_id, personal, pins, metrics, diagnostics, meta}`` as JSON lines, with manifest and export views.

Metrics are a VARIANT, so values keep their JSON types; everything user-owned is text.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from catalith.constants import PIN_COLUMNS, PROVIDER_PREFIX
from catalith.functions.lists import is_blank, is_tag_list, strip, tag_pairs, text
from catalith.functions.parse import strict_float, strict_int
from catalith.operators.columns import auto_metric_key, is_metric_candidate, personal_columns, selected_columns
from catalith.operators.keys import last_per_key
from catalith.session import materialize
from catalith.sources.registry import SPARK_TYPES, Registry
from catalith.sources.tables import read_csv, rendered

ENVELOPE_SCHEMA = (
    "row_id string, personal map<string,string>, pins map<string,string>, metrics variant, "
    "diagnostics map<string,string>, meta map<string,string>"
)
_NO_TEXT = "map<string,string>"
#: Metrics that are lists of [tag, count].
TAG_LISTS = ("steamspy.popularity.tags_top",)


@dataclass(frozen=True)
class Manifest:
    """Column order of an export and the metric key behind each metric column."""

    columns: list[str]
    column_to_key: dict[str, str]

    def to_json(self) -> str:
        body: dict[str, object] = {"columns": self.columns}
        if self.column_to_key:
            body["column_to_metric_key"] = self.column_to_key
        return json.dumps(body, ensure_ascii=False, indent=2)

    @staticmethod
    def from_json(raw: str) -> Manifest:
        data = json.loads(raw or "{}")
        columns = [str(c).strip() for c in data.get("columns") or [] if str(c or "").strip()]
        keys = {str(k).strip(): str(v).strip() for k, v in (data.get("column_to_metric_key") or {}).items()}
        return Manifest(columns, {k: v for k, v in keys.items() if k and v})


def manifest_of(columns: list[str], registry: Registry, all_metrics: bool = False) -> Manifest:
    kept = list(columns) if all_metrics else selected_columns(columns, registry)
    keys: dict[str, str] = {}
    for c in kept:
        if c == "RowId" or c in registry.diagnostic_columns or c in PIN_COLUMNS:
            continue
        if c in registry.by_column:
            keys[c] = registry.by_column[c][0]
        elif is_metric_candidate(c, registry):
            keys[c] = auto_metric_key(c)
    return Manifest(kept, keys)


def manifest_rows(spark: SparkSession, manifest: Manifest) -> DataFrame:
    rows = [(i, c, manifest.column_to_key.get(c)) for i, c in enumerate(manifest.columns)]
    return spark.createDataFrame(rows, "pos int, column string, metric_key string")


def write_manifest(spark: SparkSession, manifest: Manifest, path: str) -> None:
    """Write the sidecar next to the envelope folder, on whatever file system the path names."""
    spark.createDataFrame([(json.dumps(json.loads(manifest.to_json()), ensure_ascii=False),)], "value string").coalesce(
        1
    ).write.mode("overwrite").text(path)


def read_manifest(spark: SparkSession, path: str) -> Manifest:
    """Read the sidecar: one small JSON document."""
    return Manifest.from_json("\n".join(r.value for r in spark.read.text(path).collect()))


def coerce(df: DataFrame, c: str, type_: str) -> Column:
    """Registry typing of a column: whole doubles become integers, blank text NULL, text where a number belongs fails."""
    kind, col = df.schema[c].dataType, F.col(f"`{c}`")
    kind_name = kind.typeName()
    number = isinstance(kind, T.NumericType)
    target = SPARK_TYPES.get(type_, "string")
    if isinstance(kind, T.NullType):
        return F.lit(None).cast(target)
    if type_ not in SPARK_TYPES or type_ == "string":
        return F.nullif(strip(col.cast("string")), F.lit(""))
    if kind_name == "string":
        problem = F.concat(F.lit(f"metric {c} expects {type_}, got text: "), col)
        return F.when(is_blank(col), F.lit(None)).otherwise(F.raise_error(problem)).cast(target)
    if type_ == "int":
        return F.when(col == F.floor(col), col.cast("bigint")) if number else F.lit(None).cast(target)
    if type_ == "float":
        return col.cast("double") if number else F.lit(None).cast(target)
    if type_ == "bool":
        return col if kind_name == "boolean" else F.lit(None).cast(target)
    nested = kind_name == "array" or (type_ == "json" and kind_name in ("struct", "map", "variant"))
    return col if nested else F.lit(None).cast(target)


def to_envelope(
    df: DataFrame, registry: Registry, include_diagnostics: bool = False, provider: str | None = None, all_metrics: bool = False
) -> DataFrame:
    """Wide frame to row envelopes: blanks are left out, rows without an id are skipped."""
    personal = personal_columns(df.columns, registry)
    pins = [c for c in sorted(PIN_COLUMNS) if c in df.columns]
    diagnostics = [c for c in sorted(registry.diagnostic_columns) if c in df.columns] if include_diagnostics else []
    fields = []
    for c in df.columns:
        if c == "RowId" or c in registry.diagnostic_columns or c in PIN_COLUMNS or c in personal:
            continue
        if c in registry.by_column:
            key, type_ = registry.by_column[c]
        elif all_metrics and is_metric_candidate(c, registry):
            key, type_ = auto_metric_key(c), "string"
        else:
            continue
        value = coerce(df, c, type_)
        if df.schema[c].dataType.typeName() in ("array", "map"):
            value = F.when(F.size(value) > 0, value)
        if is_tag_list(df.schema[c].dataType):
            value = F.when(F.size(F.col(f"`{c}`")) > 0, tag_pairs(F.col(f"`{c}`")))
        fields.append(value.alias(key))

    def filled(cols: list[str]) -> Column:
        if not cols:
            return F.create_map().cast(_NO_TEXT)
        pairs = F.create_map(*[x for c in cols for x in (F.lit(c), text(cell_text(df, c)))])
        return F.map_filter(pairs, lambda _k, v: v != "")

    metrics = F.parse_json(F.to_json(F.struct(*fields))) if fields else F.parse_json(F.lit("{}"))
    meta = F.create_map(F.lit("provider"), F.lit(provider)) if provider else F.create_map().cast(_NO_TEXT)
    return df.where(~is_blank(F.col("RowId"))).select(
        strip(F.col("RowId").cast("string")).alias("row_id"),
        filled(personal).alias("personal"),
        filled(pins).alias("pins"),
        metrics.alias("metrics"),
        filled(diagnostics).alias("diagnostics"),
        meta.alias("meta"),
    )


def cell_text(df: DataFrame, c: str) -> Column:
    kind = df.schema[c].dataType.typeName()
    return F.to_json(F.col(c)) if kind in ("array", "map", "struct") else F.col(c).cast("string")


def write_envelope(envelope: DataFrame, path: str) -> None:
    """JSON lines, one envelope per line."""
    envelope.write.mode("overwrite").option("ignoreNullFields", True).json(path)


def _parsed(lines: DataFrame, mode: str) -> DataFrame:
    body = lines.select(strip(F.col("value")).alias("value")).where("value <> ''")
    return body.withColumn("r", F.from_json("value", ENVELOPE_SCHEMA, {"mode": mode}))


def read_envelope(spark: SparkSession, path: str) -> DataFrame:
    """Lenient reader: blank, broken and non-object lines are skipped."""
    rows = _parsed(spark.read.text(path), "PERMISSIVE")
    ok = F.col("value").startswith("{") & F.try_parse_json("value").isNotNull()
    return rows.where(ok).select("r.*")


def _numbered(spark: SparkSession, path: str) -> DataFrame:
    """Non-blank lines as (value, ok, file, start, at): ``start`` is the split's place in its file, and ``at`` grows along a split without gaps in all its lines."""
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("at")
    )
    body = lines.withColumn("value", strip(F.col("value")))
    ok = F.col("value").startswith("{") & F.try_parse_json("value").isNotNull()
    return body.withColumn("ok", (F.col("value") == "") | ok)


def broken_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, value) of the lines that are no JSON objects, counted from 1 in each file; blank lines count but are not broken.

    Files are read in splits, so a line's number is its place in its split behind the lines of the splits before it: one count per split, summed along each
    file. Only broken lines meet the counts.
    """
    lines = _numbered(spark, path)
    splits = lines.groupBy("file", "start").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select("file", "start", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    line = (F.col("before") + F.col("at") - F.col("first") + 1).alias("line")
    return lines.where(~F.col("ok")).join(splits, ["file", "start"]).select("file", line, "value")


def _refuse(spark: SparkSession, path: str) -> None:
    """Raise with file, line and text of the first broken line."""
    bad = broken_lines(spark, path).orderBy("file", "line").head(1)
    if bad:
        raise ValueError(f"invalid envelope line {bad[0].line} in {bad[0].file}: {bad[0].value[:200]}")


def _checked_once(spark: SparkSession, path: str, registry: Registry | None, context: str) -> DataFrame:
    """Envelope rows, parsed and type-checked while they are written to the shared folder; the lines are read once, and again only to name a broken one."""
    seen = Observation()
    rows = _numbered(spark, path).where("value <> ''").withColumn("r", F.from_json("value", ENVELOPE_SCHEMA)).select("ok", "r.*")
    wrong = F.get(row_violations(registry), F.lit(0)) if registry else F.lit(None).cast(_VIOLATION)
    first = F.min(F.when(F.col("ok") & F.col("__wrong").isNotNull(), F.col("__wrong"))).alias("wrong")
    watched = rows.withColumn("__wrong", wrong).observe(seen, F.count_if(~F.col("ok")).alias("broken"), first).drop("__wrong")
    stored = materialize(watched.where("ok").drop("ok"), "envelope")
    if seen.get["broken"]:
        _refuse(spark, path)
    bad = seen.get["wrong"]
    if bad is not None:
        raise ValueError(f"{context}: metric {bad['metric_key'] or bad['row_id']} expected {bad['expected']}, got {bad['got']}")
    return stored


def read_envelope_strict(spark: SparkSession, path: str) -> DataFrame:
    """Strict reader: a broken or non-object line fails the job with its file and line number. The rows are stored as they are checked."""
    return _checked_once(spark, path, None, path)


def latest_rows(envelope: DataFrame, order: str) -> DataFrame:
    """Last envelope per row id in input order."""
    return last_per_key(envelope, "row_id", order)


def _metric(key: str, type_: str = "variant") -> Column:
    return F.try_variant_get("metrics", f'$["{key}"]', type_)


def typed_metric(key: str, type_: str) -> Column:
    """Metric of a registered type out of the envelope's VARIANT."""
    if type_ == "int":
        return strict_int(_metric(key))
    if type_ == "float":
        return strict_float(_metric(key))
    if key in TAG_LISTS:
        items = _metric(key, "array<variant>")
        return F.transform(items, lambda v: F.struct(F.try_variant_get(v, "$[0]", "string").alias("tag"), F.try_variant_get(v, "$[1]", "bigint").alias("count")))
    return _metric(key, SPARK_TYPES.get(type_, "string"))


_VIOLATION = "struct<row_id: string, metric_key: string, expected: string, got: string>"


def row_violations(registry: Registry) -> Column:
    """A row's departures from the registry's types as a list of (row_id, metric_key, expected, got); no join, as the registry's types are a literal map."""
    row_id = F.coalesce("row_id", F.lit(""))
    types = F.create_map(*[F.lit(x) for key, (_, kind) in sorted(registry.by_key.items()) for x in (key, kind)])
    kind = F.schema_of_variant("metrics")

    def wrong(id_: Column, key: Column, expected: Column, got: Column) -> Column:
        return F.struct(id_.alias("row_id"), key.alias("metric_key"), expected.alias("expected"), got.alias("got")).cast(_VIOLATION)

    def fits(expected: Column, got: Column, v: Column) -> Column:
        return (
            F.when(expected == "string", got == "STRING")
            .when(expected == "int", strict_int(v).isNotNull())
            .when(expected == "float", got.rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)"))
            .when(expected == "bool", got == "BOOLEAN")
            .when(expected == "json", got.rlike("^(ARRAY|OBJECT)"))
            .when(expected == "list_csv", got.startswith("ARRAY"))
            .otherwise(True)
        )

    def judged(e: Column) -> Column:
        got, expected = F.schema_of_variant(e["value"]), F.try_element_at(types, e["key"])
        return F.when((got != "VOID") & ~fits(expected, got, e["value"]), wrong(row_id, e["key"], expected, got))

    values = F.map_entries(F.when(kind.startswith("OBJECT"), F.try_variant_get("metrics", "$", "map<string,variant>")))
    named = F.filter(values, lambda e: F.try_element_at(types, e["key"]).isNotNull())
    no_id = F.when(is_blank(F.col("row_id")), wrong(F.lit(""), F.lit(""), F.lit("row_id"), F.lit("missing")))
    shape = F.when(
        F.col("metrics").isNotNull() & ~kind.startswith("OBJECT") & (kind != "VOID"), wrong(row_id, F.lit(""), F.lit("object"), kind)
    )
    own = F.coalesce(F.transform(named, judged), F.array().cast(f"array<{_VIOLATION}>"))
    return F.array_compact(F.concat(F.array(no_id, shape), own))


def violations(envelope: DataFrame, registry: Registry) -> DataFrame:
    """Type check of envelopes against the registry as ``(row_id, metric_key, expected, got)`` rows."""
    return envelope.select(F.inline(row_violations(registry)))


def require_valid(envelope: DataFrame, registry: Registry, context: str) -> DataFrame:
    """Fail on the first type violation: an eager check before an export or reuse."""
    bad = violations(envelope, registry).head(1)
    if bad:
        raise ValueError(f"{context}: metric {bad[0].metric_key or bad[0].row_id} expected {bad[0].expected}, got {bad[0].got}")
    return envelope


def _map_keys(envelope: DataFrame, column: str) -> list[str]:
    """User column names present in a map column: a distinct over keys, as many rows as there are columns."""
    keys = envelope.select(F.explode(F.map_keys(column)).alias("k")).where(~is_blank(F.col("k"))).distinct()
    return sorted(r.k for r in keys.collect())


def catalog_view(envelope: DataFrame, include_diagnostics: bool = True, columns: dict[str, list[str]] | None = None) -> DataFrame:
    """Envelope to catalog: user values, pins and diagnostics as columns.

    Pass ``columns`` (``{"personal": [..], "pins": [..], "diagnostics": [..]}``) to skip the pass that finds the names.
    """
    maps = ["personal", "pins"] + (["diagnostics"] if include_diagnostics else [])
    names = columns or {m: _map_keys(envelope, m) for m in maps}
    source: dict[str, Column] = {}
    for m in maps:
        for k in names.get(m, []):
            source[k] = F.try_element_at(m, F.lit(k))
    return envelope.where(~is_blank(F.col("row_id"))).select(
        strip(F.col("row_id")).alias("RowId"), *[v.alias(k) for k, v in source.items() if k != "RowId"]
    )


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def load_catalog(
    spark: SparkSession, csv_path: str, registry: Registry, columns: dict[str, list[str]] | None = None, use_lines: bool = True, multiline: bool = False
) -> DataFrame:
    """Catalog of ``x.csv``: the envelope lines ``jsonl/x.jsonl`` beside it when there are any, read strictly and validated; else the CSV.

    ``columns`` names the user columns, as for :func:`catalog_view`. A blank cell is an empty text from either source. ``multiline`` is for CSV files whose
    cells hold line breaks, which the library's own never do; such a file is read by one task. Paths may be of any file system that Spark reads.
    """
    folder, _, name = csv_path.rpartition("/")
    lines = f"{folder}/jsonl/{name.removesuffix('.csv')}.jsonl"
    if use_lines and _exists(spark, lines):
        view = catalog_view(_checked_once(spark, lines, registry, name), True, columns)
        return view.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in view.columns])
    return read_csv(spark, csv_path, multiline=multiline)


def registered_view(envelope: DataFrame, registry: Registry, keys: list[str] | None = None) -> DataFrame:
    """Envelope to typed metric columns named by the registry."""
    wanted = {k: registry.by_key[k] for k in (keys or registry.by_key)}
    return envelope.where(~is_blank(F.col("row_id"))).select(
        strip(F.col("row_id")).alias("RowId"), *[typed_metric(k, t).alias(c) for k, (c, t) in wanted.items()]
    )


def _metric_key(column: str, manifest: Manifest, registry: Registry) -> str | None:
    return manifest.column_to_key.get(column) or (registry.by_column[column][0] if column in registry.by_column else None)


def export_values(envelope: DataFrame, manifest: Manifest, registry: Registry) -> DataFrame:
    """Export columns in manifest order as VARIANT values.

    Lookup precedence by presence: row id, user value, pin, manifest key, registry key.
    """
    out = []
    for c in manifest.columns:
        if c == "RowId":
            out.append(F.to_variant_object(F.struct(strip(F.col("row_id")).alias("v"))).alias(c))
            continue
        key = _metric_key(c, manifest, registry)
        metric = _metric(key) if key else F.lit(None).cast("variant")
        own = F.lit(c)

        def wrapped(m: str, own: Column = own) -> Column:
            value = F.try_element_at(F.col(m), own)
            return F.when(F.map_contains_key(F.coalesce(F.col(m), F.create_map().cast(_NO_TEXT)), own), F.parse_json(
                F.to_json(F.struct(value.alias("v")))))

        value = F.coalesce(wrapped("personal"), wrapped("pins"), F.parse_json(F.to_json(F.struct(metric.alias("v")))))
        out.append(value.alias(c))
    return envelope.where(~is_blank(F.col("row_id"))).select(*out)


def _rendered_variant(c: str, type_: str | None) -> Column:
    v = F.try_variant_get(c, "$.v", "variant")
    if type_ == "float":
        return F.coalesce(F.try_variant_get(v, "$", "double").cast("string"), F.lit("")).alias(c)
    kind = F.schema_of_variant(v)
    as_text = F.try_variant_get(v, "$", "string")
    flat = strip(F.regexp_replace(F.translate(as_text, "\r\n\t", "   "), r"\s{2,}", " "))
    items = F.filter(
        F.transform(F.try_variant_get(v, "$", "array<string>"), lambda x: strip(F.coalesce(x, F.lit("")))), lambda x: x != ""
    )
    nested = kind.startswith("OBJECT") | kind.rlike(r"^ARRAY<(ARRAY|OBJECT|VARIANT)")
    return (
        F.when(v.isNull() | (kind == "VOID"), "")
        .when(kind == "BOOLEAN", F.when(F.try_variant_get(v, "$", "boolean"), "YES").otherwise(""))
        .when(kind == "STRING", F.when(F.lower(strip(as_text)) == "nan", "").otherwise(flat))
        .when(nested, F.to_json(v))
        .when(kind.startswith("ARRAY"), F.array_join(items, ", "))
        .otherwise(as_text)
        .alias(c)
    )


def export_csv_view(envelope: DataFrame, manifest: Manifest, registry: Registry) -> DataFrame:
    """Spreadsheet view: manifest order, every value rendered as a cell."""
    values = export_values(envelope, manifest, registry)
    types = {c: registry.by_key[k][1] for c in manifest.columns if (k := _metric_key(c, manifest, registry)) in registry.by_key}
    return values.select(*[F.coalesce(_rendered_variant(c, types.get(c)), F.lit("")).alias(c) for c in manifest.columns])


def export_json_view(envelope: DataFrame, manifest: Manifest, registry: Registry) -> DataFrame:
    """JSON view, one ``value`` per row: types and arrays kept, missing values left out."""
    values = export_values(envelope, manifest, registry)
    body = F.create_map(*[x for c in manifest.columns for x in (F.lit(c), F.try_variant_get(c, "$.v", "variant"))])
    kept = F.map_filter(body, lambda _k, v: v.isNotNull() & (F.schema_of_variant(v) != "VOID"))
    return values.select(F.to_json(kept).alias("value"))


def write_json_lines(view: DataFrame, path: str) -> None:
    view.write.mode("overwrite").text(path)


def json_document(view: DataFrame) -> DataFrame:
    """Lines of one JSON array over all rows, in the rows' order, across the part files a text writer makes of them.

    Rows are numbered as they are read and stored once, so the number that takes no comma is looked up on what is written; rows are range-sorted by
    number, and no task holds the array.
    """
    rows = materialize(view.select(F.monotonically_increasing_id().alias("ordinal"), "value"), "json-rows")
    first = rows.agg(F.min("ordinal")).first()[0]
    body = rows.select(
        F.lit(1).alias("part"), "ordinal", F.when(F.col("ordinal") == first, F.col("value")).otherwise(F.concat(F.lit(","), F.col("value"))).alias("value")
    )
    edges = view.sparkSession.createDataFrame([(0, 0, "["), (2, 0, "]")], "part int, ordinal bigint, value string")
    return edges.unionByName(body).orderBy("part", "ordinal").select("value")


def provider_view(envelope: DataFrame, provider: str, registry: Registry) -> DataFrame:
    """Provider export without a manifest: id, name and the provider's registered columns that hold a value anywhere."""
    prefix = PROVIDER_PREFIX[provider]
    own = {c: k for k, (c, _t) in registry.by_key.items() if c.startswith(prefix)}
    has = envelope.agg(*[F.max(_metric(k).isNotNull()).alias(c) for c, k in own.items()]).first()
    columns = ["RowId", "Name", *[c for c in own if has[c]]]
    return export_csv_view(envelope, Manifest(columns, {}), registry)


def export(envelope: DataFrame, manifest: Manifest, registry: Registry, fmt: str = "csv") -> DataFrame:
    """Validated export view in ``csv``, ``json`` (one document) or ``jsonl`` form."""
    if not manifest.columns:
        raise ValueError("export needs a manifest with columns; write it with the envelope")
    require_valid(envelope, registry, "export")
    if fmt == "csv":
        return export_csv_view(envelope, manifest, registry)
    view = export_json_view(envelope, manifest, registry)
    return json_document(view) if fmt == "json" else view


def rendered_frame(df: DataFrame) -> DataFrame:
    """Wide frame with every cell rendered for CSV."""
    return rendered(df)
