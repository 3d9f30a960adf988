"""CSV, edited exports, identity overrides, tier maps and provider payload stores."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalith.constants import PIN_COLUMNS, PROVIDER_PREFIX
from catalith.functions.company import fold_key, normalize_company
from catalith.functions.lists import is_blank, is_tag_list, strip, tag_pairs, text
from catalith.session import shared_dir
from catalith.operators.columns import provider_columns


def read_csv(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """CSV with a header, every column text, empty cells as empty text.

    Rendered cells hold no line breaks, so large files are split. ``multiline=True`` is for others' files with line breaks inside cells; then one
    task reads a file.
    """
    df = (
        spark.read.option("header", True)
        .option("inferSchema", False)
        .option("multiLine", multiline)
        .option("quote", '"')
        .option("escape", '"')
        .csv(path)
    )
    return df.na.fill("")


def cell(df: DataFrame, c: str) -> Column:
    """Column rendered as one CSV cell: YES for true, joined simple lists, JSON for nested values, never ``nan``."""
    kind, col = df.schema[c].dataType, F.col(f"`{c}`")
    if isinstance(kind, T.BooleanType):
        out = F.when(col, "YES")
    elif isinstance(kind, T.StringType):
        flat = strip(F.regexp_replace(F.translate(col, "\r\n\t", "   "), r"\s{2,}", " "))
        out = F.when(F.lower(strip(col)) != "nan", flat)
    elif isinstance(kind, T.ArrayType) and not isinstance(kind.elementType, (T.ArrayType, T.StructType, T.MapType)):
        items = F.transform(col, lambda x: strip(x.cast("string")))
        out = F.array_join(F.filter(items, lambda x: x != ""), ", ")
    elif is_tag_list(kind):
        out = F.to_json(tag_pairs(col))
    elif isinstance(kind, (T.ArrayType, T.StructType, T.MapType, T.VariantType)):
        out = F.to_json(col)
    elif isinstance(kind, (T.DoubleType, T.FloatType)):
        out = F.when(~F.isnan(col), col.cast("string"))
    else:
        out = col.cast("string")
    return F.coalesce(out, F.lit("")).alias(c)


def rendered(df: DataFrame) -> DataFrame:
    return df.select(*[cell(df, c) for c in df.columns])


def write_csv(df: DataFrame, path: str) -> None:
    """Write rendered cells as CSV part files."""
    rendered(df).write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').option(
        "emptyValue", ""
    ).csv(path)


def write_provider_csv(df: DataFrame, path: str, provider: str, extra: tuple[str, ...] = ()) -> None:
    """Write one provider's slice: id, name, its columns and extras."""
    write_csv(df.select(*provider_columns(df.columns, PROVIDER_PREFIX[provider], extra)), path)


def read_edited(spark: SparkSession, path: str) -> DataFrame:
    """Edited export: CSV, or JSON (array of objects or JSON lines) read as text columns."""
    if not path.lower().endswith((".json", ".jsonl")):
        return read_csv(spark, path, multiline=True)
    whole = path.lower().endswith(".json")
    return spark.read.option("multiLine", whole).option("primitivesAsString", True).json(path)


def identity_overrides(df: DataFrame) -> DataFrame:
    """RowId plus trimmed pins, for the rows that have an id."""
    pins = [text(F.col(c)).alias(c) if c in df.columns else F.lit("").alias(c) for c in PIN_COLUMNS]
    return df.where(~is_blank(F.col("RowId"))).select(strip(F.col("RowId")).alias("RowId"), *pins)


TIER_SCHEMA = "kind string, label string, tier string"


def tier_rows(spark: SparkSession, spec: dict) -> DataFrame:
    """Tier map ``{publishers: {label: tier | {tier: ..}}, developers: ..}`` as ``(kind, label, tier)`` rows."""
    rows = []
    for section, kind in (("publishers", "publisher"), ("developers", "developer")):
        for label, value in (spec.get(section) or {}).items():
            tier = value.get("tier") if isinstance(value, dict) else value
            rows.append((kind, str(label).strip(), str(tier or "").strip()))
    return spark.createDataFrame(rows, TIER_SCHEMA)


def tier_dimension(tiers: DataFrame) -> DataFrame:
    """Tier lookup ``(kind, company_key, tier, tier_label)``: blank tiers and unusable names dropped, one row per key.

    When several labels share a key the last one in label order stands.
    """
    named = tiers.select(
        "kind", text(F.col("tier")).alias("tier"), strip(F.col("label")).alias("tier_label"), normalize_company(F.col("label")).alias("__n")
    )
    keyed = named.where((F.col("tier") != "") & (F.col("__n") != "")).withColumn("company_key", fold_key(F.col("__n")))
    return (
        keyed.groupBy("kind", "company_key")
        .agg(F.max(F.struct("tier_label", "tier")).alias("t"))
        .select("kind", "company_key", "t.tier", "t.tier_label")
    )


def payload_rows(files: DataFrame, provider: str) -> DataFrame:
    """Payload stores ``{"by_id": {id: payload}, "by_query": {query: [hit, ..]}}`` as one row per id.

    ``files`` has one JSON document per row in ``value`` (many store files load in parallel; convert big stores to
    :func:`payload_lines` input once). A null payload stays as a row with ``payload`` NULL: known to be missing.
    """
    doc = F.from_json("value", "by_id map<string, variant>")
    return files.select(F.explode(doc.getField("by_id")).alias("id", "payload")).select(
        F.lit(provider).alias("provider"),
        F.regexp_replace("id", r"^[a-z]{2}:", "").alias("id"),
        F.when(F.schema_of_variant("payload") != "VOID", F.col("payload")).alias("payload"),
    )


def stored_payloads(payloads: DataFrame, buckets: int = 64, key: str = "id") -> DataFrame:
    """Payload rows as a table laid out by id, written once to the shared folder: look-ups by id find it partitioned and sorted (see ``keys.lookup_stored``).

    Take about as many buckets as a look-up has shuffle partitions, or more; rows of one id lie in one bucket.
    """
    spark = payloads.sparkSession
    name = f"payloads_{uuid.uuid4().hex}"
    payloads.write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", shared_dir(spark, "payloads")).saveAsTable(name)
    return spark.table(name)


def query_rows(files: DataFrame, provider: str) -> DataFrame:
    """Stored searches as ``(provider, query, pos, hit)``; a search without hits keeps one row with ``hit`` NULL."""
    doc = F.from_json("value", "by_query map<string, array<variant>>")
    return files.select(F.explode(doc.getField("by_query")).alias("query", "hits")).select(
        F.lit(provider).alias("provider"), "query", F.posexplode_outer("hits").alias("pos", "hit")
    )


def payload_lines(lines: DataFrame, provider: str) -> DataFrame:
    """Splittable form of a payload store: one ``{"id": .., "payload": ..}`` object per line."""
    return lines.select(F.from_json("value", "id string, payload variant").alias("r")).where("r.id is not null").select(
        F.lit(provider).alias("provider"),
        F.col("r.id").alias("id"),
        F.when(F.schema_of_variant("r.payload") != "VOID", F.col("r.payload")).alias("payload"),
    )


def work_list(wanted: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Keys still to be looked up: wanted ones without a stored fact, negative facts included."""
    return wanted.select(key).where(~is_blank(F.col(key))).distinct().join(known.select(key), key, "left_anti")
