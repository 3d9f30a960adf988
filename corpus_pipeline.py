"""Training-data pipeline: quality rules, line dedup, near duplicates, source mixing and packing, each stage on what the one before it kept.

Rows equal in doc_id and text are one document to the stages that cut or mix texts. NULL ids are kept where a rule does not reject their text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalith.llm import jaccard, lines, mixing, packing, quality
from catalith.llm.common import WORD, stored, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _row() -> Column:
    """What tells a document from others even where ids repeat."""
    return F.struct(F.col("doc_id").alias("id"), F.xxhash64("text").alias("text"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the rules nor their host's verdict reject."""
    judged = quality.host_rules(docs.select("source", "text", _row().alias("row")))
    kept = judged.where("kept").select(F.col("row").alias("_row"), F.col("source").alias("_s")).distinct()
    on = (_row() == F.col("_row")) & F.col("source").eqNullSafe(F.col("_s"))
    return docs.select(*COLUMNS).join(kept, on, "left_semi")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated chunks of lines; a document that has no word left after a removal goes."""
    out = lines.deduped_lines(docs.select(*COLUMNS))
    left = (F.col("removed_chunks") == 0) | F.col("text").rlike(WORD)
    return out.where(left).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id, and of its texts the smallest hash, of each group of similar documents; of rows equal in id and text, the smallest."""
    rows = docs.where("doc_id is not null").select(*COLUMNS).withColumn("_row", _row())
    found = jaccard.similar_documents(rows, key="_row")
    kept = found.where("_row = component_id").groupBy(F.col("_row").alias("_r")).agg((F.count("*") > 1).alias("_again"))
    joined = rows.join(kept, F.col("_row") == F.col("_r"))
    once = joined.where("not _again").select(*COLUMNS)
    again = joined.where("_again").groupBy("_row").agg(F.min(F.struct(*COLUMNS)).alias("_least")).select("_least.*")
    return once.unionByName(again).unionByName(docs.where("doc_id is null").select(*COLUMNS))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document with the words that the mix takes: a second round's words follow the text; a document of which nothing is taken goes."""
    rows = docs.select(*COLUMNS).withColumn("_row", _row())
    sized = rows.select("_row", "source", mixing.word_count(F.col("text")).alias("size")).distinct()
    pieces, _ = mixing.mix_pieces(sized, key="_row")
    spans = pieces.groupBy(F.col("_row").alias("_r"), F.col("source").alias("_s"), "round").agg(F.min("from").alias("first"), F.max("to").alias("last"))
    spans = spans.groupBy("_r", "_s").agg(F.sort_array(F.collect_list(F.struct("round", "first", "last"))).alias("spans"))
    joined = rows.join(spans, (F.col("_row") == F.col("_r")) & F.col("source").eqNullSafe(F.col("_s")))
    return mixing.taken_texts(joined, "spans").withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of the mix and its place in a sequence."""
    return packing.packed_documents(docs)


STAGES = [
    ("quality_rules", quality_rules), ("line_dedup", line_dedup), ("near_duplicates", near_duplicates), ("source_mix", source_mix),
    ("sequence_packing", sequence_packing),
]
#: SQL has no tokenizer, so the whole run is tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
