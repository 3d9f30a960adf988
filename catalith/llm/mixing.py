"""Mixing sources to target weights by a low-discrepancy schedule of equal-token blocks."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from catalith.llm.common import WORD, stored, values

#: Fixed value: the fractional part of the golden ratio.
GOLDEN = 0.6180339887498949


@dataclass(frozen=True)
class MixConfig:
    """``weights`` repeat over the sources in order of code points; ``share`` of all words is dealt; ``most`` is how often a document may be taken.

    ``block`` is the length in words that blocks come near to, ``run`` the number of slots ranked in one task.
    """

    weights: tuple[int, ...] = (3, 1, 2)
    share: tuple[int, int] = (3, 2)
    most: int = 2
    block: int = 1024
    run: int = 16384


def word_count(text: Column) -> Column:
    """Words of a text; NULL has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, config: MixConfig = MixConfig()) -> DataFrame:
    """(source, source_size, weight, target) out of one row (source, source_size) per source.

    A source's target is its weight's part of the budget, stopped at ``most`` times its size; what is cut off goes to the others by weight. That ends
    where every target is the lesser of its stop and weight times one level: the level follows from running sums over the sources in order of
    stop per weight. The windows are over one small row per source.
    """
    total = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in config.weights]), (F.pmod(place, F.lit(len(config.weights))) + 1).cast("int"))
    num, den = config.share
    s = sizes.select("source", "source_size", weight.cast("long").alias("weight"))
    s = s.withColumn("budget", num * F.sum("source_size").over(total) / F.lit(den))
    s = s.withColumn("stop", config.most * F.col("source_size")).withColumn("ratio", F.col("stop") / F.col("weight"))
    order = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    s = s.withColumn("k", F.row_number().over(order))
    below = order.rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumn("level", (F.col("budget") - F.coalesce(F.sum("stop").over(below), F.lit(0))) / (
        F.sum("weight").over(total) - F.coalesce(F.sum("weight").over(below), F.lit(0))))
    # The first source, in order of ratio, whose stop is not below its level fixes the level for it and all after it.
    level = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("k", "level"))).over(total)["level"]
    s = s.withColumn("level", level)
    target = F.when(F.col("level").isNull() | (F.col("ratio") < F.col("level")), F.col("stop").cast("double")).otherwise(F.col("level") * F.col("weight"))
    return s.select("source", "source_size", "weight", target.cast("double").alias("target"))


def shuffled_stream(sized: DataFrame, key: str = "doc_id") -> DataFrame:
    """``sized`` with ``start``: the words before the row in its source's own shuffled order.

    The order is that of a digest of the key (then the key, then the size). Running sums are taken in three steps: over the 256 parts of a source by the
    digest's first byte, over the 256 of each part by the second, and inside those; so no task holds a source.
    """
    digest = F.md5(F.coalesce(F.col(key).cast("string"), F.lit("null")))
    rows = sized.withColumn("digest", digest).withColumn("b1", F.substring("digest", 1, 2)).withColumn("b2", F.substring("digest", 3, 2))
    below = lambda *by: Window.partitionBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    fine = rows.groupBy("source", "b1", "b2").agg(F.sum("size").alias("n"))
    coarse = fine.groupBy("source", "b1").agg(F.sum("n").alias("n"))
    coarse = coarse.select(
        F.col("source").alias("_s"), F.col("b1").alias("_b"), F.coalesce(F.sum("n").over(below("source").orderBy("b1")), F.lit(0)).alias("far")
    )
    fine = fine.withColumn("near", F.coalesce(F.sum("n").over(below("source", "b1").orderBy("b2")), F.lit(0)))
    fine = fine.join(coarse, F.col("source").eqNullSafe(F.col("_s")) & (F.col("b1") == F.col("_b"))).select(
        F.col("source").alias("_t"), F.col("b1").alias("_1"), F.col("b2").alias("_2"), (F.col("far") + F.col("near")).alias("base")
    )
    order = below("source", "b1", "b2").orderBy("digest", F.col(key).asc_nulls_last(), "size")
    rows = rows.withColumn("inside", F.coalesce(F.sum("size").over(order), F.lit(0)))
    joined = rows.join(fine, F.col("source").eqNullSafe(F.col("_t")) & (F.col("b1") == F.col("_1")) & (F.col("b2") == F.col("_2")))
    return joined.withColumn("start", F.col("base") + F.col("inside")).drop("digest", "b1", "b2", "_t", "_1", "_2", "base", "inside")


def slot_schedule(targets: DataFrame, config: MixConfig = MixConfig()) -> DataFrame:
    """The mix in order: (slot, source, rank, n_slots), ``rank`` counting a source's slots from 0.

    Slot i is the point frac(i * golden ratio) on the line of cumulative targets; so every stretch of the schedule holds each source about by its share.
    Points find their source by an equality join on a grid of [0, 1): a source lies in as many cells as it touches. A source whose share is
    too small to be met gets one slot after the others. Ranks are running counts inside runs of slots plus what earlier runs hold.
    """
    spark = targets.sparkSession
    n_sources, total = targets.agg(F.count("*"), F.sum("target")).first()
    if not total:
        return spark.createDataFrame([], "slot bigint, source string, rank bigint, n_slots bigint")
    slots = -int(-total // config.block)
    cells = 4 * n_sources
    line = Window.orderBy(F.col("source").asc_nulls_last())
    high = F.sum("target").over(line) / total
    low = F.coalesce(F.sum("target").over(line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)) / total
    spans = targets.where("target > 0").select("source", low.alias("low"), F.when(high >= 1 - 1e-12, 1.0).otherwise(high).alias("high"))
    spans = spans.select("source", "low", "high", F.explode(F.sequence(F.floor(F.col("low") * cells), F.floor(F.col("high") * cells))).alias("cell"))
    point = F.col("slot") * GOLDEN
    points = spark.range(slots).withColumnRenamed("id", "slot").withColumn("point", (point - F.floor(point)).cast("double"))
    points = points.withColumn("cell", F.floor(F.col("point") * cells))
    met = points.join(spans, (points.cell == spans.cell) & (F.col("point") >= F.col("low")) & (F.col("point") < F.col("high"))).select("slot", "source")
    met = stored(met, "slots")
    unmet = targets.where("target > 0").select("source").join(
        met.select(F.col("source").alias("_s")).distinct(), F.col("source").eqNullSafe(F.col("_s")), "left_anti"
    )
    extra = unmet.select((F.lit(slots) + F.row_number().over(line) - 1).cast("long").alias("slot"), "source")
    dealt = met.unionByName(extra).withColumn("run", F.floor(F.col("slot") / config.run))
    runs = dealt.groupBy("source", "run").agg(F.count("*").alias("n"))
    by_source = Window.partitionBy("source")
    before = by_source.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        F.col("source").alias("_s"), F.col("run").alias("_r"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"),
        F.sum("n").over(by_source).alias("n_slots"),
    )
    inner = F.row_number().over(Window.partitionBy("source", "run").orderBy("slot")) - 1
    ranked = dealt.withColumn("inner", inner).join(runs, F.col("source").eqNullSafe(F.col("_s")) & (F.col("run") == F.col("_r")))
    return ranked.select("slot", "source", (F.col("base") + F.col("inner")).alias("rank"), "n_slots")


def scheduled_blocks(targets: DataFrame, config: MixConfig = MixConfig()) -> DataFrame:
    """The schedule with each slot's block, as words [block_start, block_end) of the source's shuffled stream, which starts anew at ``source_size``.

    A source's blocks are equal but for rounding and together as long as its target rounded down, so at most ``most`` times the stream.
    """
    s = slot_schedule(targets, config).withColumnRenamed("source", "_s")
    joined = s.join(targets, F.col("_s").eqNullSafe(F.col("source"))).drop("_s")
    edge = "cast(floor(target) as decimal(20,0)) * cast({} as decimal(18,0)) div cast(n_slots as decimal(18,0))"
    return joined.selectExpr(
        "slot", "source", "rank", "n_slots", "source_size", "target", edge.format("rank") + " as block_start", edge.format("rank + 1") + " as block_end"
    )


def mix_pieces(sized: DataFrame, config: MixConfig = MixConfig(), key: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """The mix: (pieces, targets) out of rows (key, source, size).

    A piece is (slot, key, source, round, from, to): words [from, to) of the document, in the given round over the source's documents. Documents meet the
    blocks they overlap by equality of (source, rank): a document lists the ranks it spans in each round, so a source that holds most rows
    is spread over its blocks. Rows that repeat are documents of their own.
    """
    sized = stored(sized.select(key, "source", "size"), "sized")
    targets = stored(source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), config), "targets")
    blocks = stored(scheduled_blocks(targets, config), "blocks")
    counts = targets.select(F.col("source").alias("_s"), "source_size", F.floor("target").cast("long").alias("whole")).join(
        blocks.select(F.col("source").alias("_t"), "n_slots").distinct(), F.col("_s").eqNullSafe(F.col("_t"))).drop("_t")
    stream = shuffled_stream(sized, key).where("size > 0")
    rows = stream.join(stored(counts, "counts"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    rows = rows.withColumn("round", F.explode(F.array(*[F.lit(i) for i in range(config.most)])))
    rows = rows.withColumn("begin", F.col("start") + F.col("round") * F.col("source_size")).where("begin < whole")
    rows = rows.withColumn("finish", F.least(F.col("begin") + F.col("size"), F.col("whole")))
    # Block r starts at floor(whole * r / n): the block that holds word w is floor(((w + 1) * n - 1) / whole).
    held = "(cast({} + 1 as decimal(19,0)) * cast(n_slots as decimal(18,0)) - 1) div cast(whole as decimal(19,0))"
    rows = rows.withColumn("rank", F.expr(f"explode(sequence({held.format('begin')}, {held.format('finish - 1')}))"))
    b = blocks.select("slot", F.col("source").alias("_s"), F.col("rank").alias("_r"), "block_start", "block_end")
    met = rows.join(b, F.col("source").eqNullSafe(F.col("_s")) & (F.col("rank") == F.col("_r")))
    low, high = F.greatest("begin", "block_start"), F.least("finish", "block_end")
    pieces = met.select("slot", key, "source", "round", "start", (low - F.col("begin")).alias("from"), (high - F.col("begin")).alias("to")).where("from < to")
    return pieces, targets


def mixed_documents(docs: DataFrame, config: MixConfig = MixConfig(), key: str = "doc_id") -> DataFrame:
    """Per row of ``docs``: key, source, size, source_size, target, taken (words that the mix takes of it, repeats counted).

    NULL sources are one source, last in order; NULL or empty texts have size 0 and nothing is taken of them; an empty table gives an empty result. Rows
    that repeat share a stream but are told apart by their place in it. Reruns agree.
    """
    sized = stored(docs.select(key, "source", word_count(F.col("text")).alias("size")), "sized")
    pieces, targets = mix_pieces(sized, config, key)
    taken = pieces.groupBy("source", key, "start").agg(F.sum(F.col("to") - F.col("from")).alias("taken"))
    taken = taken.select(F.col("source").alias("_s"), F.col(key).alias("_k"), F.col("start").alias("_p"), "taken")
    rows = shuffled_stream(sized, key)
    on = F.col("source").eqNullSafe(F.col("_s")) & F.col(key).eqNullSafe(F.col("_k")) & (F.col("start") == F.col("_p")) & (F.col("size") > 0)
    rows = rows.join(taken, on, "left").drop("_s", "_k", "_p", "start")
    t = targets.select(F.col("source").alias("_s"), "source_size", "target")
    rows = rows.join(t, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    return rows.select(key, "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def taken_texts(rows: DataFrame, spans: str, text: str = "text") -> DataFrame:
    """``rows`` with the text cut to its ``spans``, a list of (round, first, last) in words: the rounds' parts follow each other, a line feed between."""
    word = re.compile(WORD)
    keep = [c for c in rows.columns if c != spans]

    def cut(body: str, first: int, last: int) -> str:
        start, end = (0 if not first else None), len(body)
        for k, m in enumerate(word.finditer(body)):
            if k == first and first:
                start = m.start()
            if k == last:
                end = before
                break
            before = m.end()
        return body[start:end]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = []
            for body, parts in zip(values(batch, text), values(batch, spans), strict=True):
                bodies.append("\n".join(cut(body, p["first"], p["last"]) for p in parts))
            yield pa.RecordBatch.from_arrays([pa.array(bodies, pa.string()) if c == text else batch.column(c) for c in keep], names=keep)

    return rows.mapInArrow(run, rows.select(*keep).schema)
