"""Line dedup: content-defined chunks of lines; chunks that repeat anywhere are removed but once, after a comparison of bytes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalith.llm.common import discard, release, small_batches, stored, values, widened

#: Fixed values of the rolling hash over two neighbouring line hashes.
MULTIPLIER, MODULUS = 31, 4294967291


def line_hash(line: bytes) -> int:
    """The first 32 bits of a line's digest."""
    return int.from_bytes(hashlib.md5(line).digest()[:4], "big")


def chunk_bounds(lines: list[bytes]) -> list[int]:
    """Line numbers at which chunks start, 0 first.

    The rolling hash of a line covers it and the line before. A chunk ends after each line whose hash is above those of both neighbours, but never
    after the first line or before the last. So a bound depends on four lines only, wherever they stand, and every chunk of a text with two lines
    or more has two lines or more.
    """
    n = len(lines)
    h = [line_hash(x) for x in lines]
    r = [-1] + [(h[i - 1] * MULTIPLIER + h[i]) % MODULUS for i in range(1, n)]
    return [0] + [i + 1 for i in range(1, n - 2) if r[i - 1] < r[i] > r[i + 1]]


def line_chunks(text: str) -> list[list[bytes]]:
    """The lines of a text, chunk by chunk."""
    lines = text.encode().split(b"\n")
    bounds = chunk_bounds(lines) + [len(lines)]
    return [lines[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]


def chunk_keys(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, text_digest, chunk, chunk_digest) of every chunk that holds two lines or more and a word."""
    schema = widened(docs.select(key).schema, "text_digest binary, chunk bigint, chunk_digest binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, text):
            at, whole, number, digests = [], [], [], []
            for i, body in enumerate(values(batch, text)):
                if body is None or "\n" not in body:
                    continue
                own = hashlib.md5(body.encode()).digest()
                for k, lines in enumerate(line_chunks(body)):
                    raw = b"\n".join(lines)
                    if raw.split(None, 1):
                        at.append(i)
                        whole.append(own)
                        number.append(k)
                        digests.append(hashlib.md5(raw).digest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(key).take(pa.array(at, pa.int32())), pa.array(whole, pa.binary()), pa.array(number, pa.int64()), pa.array(digests, pa.binary())],
                names=[key, "text_digest", "chunk", "chunk_digest"],
            )

    return docs.select(key, text).mapInArrow(run, schema)


def repeated_chunks(chunks: DataFrame, key: str = "doc_id") -> tuple[DataFrame, tuple[DataFrame, ...]]:
    """(The chunks whose digest is found elsewhere, the stored tables behind them). ``first`` is set on the one that stays: that of the smallest
    (key, text, place), NULL keys last.

    The first of a digest is a minimum with partial aggregation and meets the other chunks in a join, so a chunk that stands in a third of all documents is
    no group in one task.
    """
    place = F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("key"), F.col("text_digest").alias("digest"), F.col("chunk").alias("chunk"))
    chunks = stored(chunks.distinct(), "chunks")
    firsts = stored(
        chunks.groupBy("chunk_digest").agg(F.count("*").alias("n"), F.min(place).alias("at")).where("n > 1").drop("n"), "first-chunks"
    )
    met = chunks.join(firsts.withColumnRenamed("chunk_digest", "_c"), F.col("chunk_digest") == F.col("_c"))
    return met.select(*chunks.columns, (F.col("at") == place).alias("first")), (chunks, firsts)


def deduped_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with repeated chunks taken out of the text, and the counts n_lines, n_chunks, removed_chunks, removed_lines (BIGINT).

    Kept chunks are joined by line feeds; a text that loses all is empty, a NULL text stays NULL with no lines. A text of one line is never touched, nor is a
    chunk without a word. Rows equal in key and text are one document and share its result. Columns of the counts' names are replaced.

    Chunks are found by digest, and removed only when the bytes of the first chunk of that digest are the same: documents with repeated chunks send those
    chunks' texts, and no others, to the comparison, which is a minimum and a maximum per digest, aggregated before they are shuffled. Only where those differ
    are chunks compared with the first one by one. Whole texts meet their lists of chunks twice, by a merge join at every size: those with line feeds for the
    comparison, and all for the result. A very long text is held whole, as lines, by the task that has its row.
    """
    fresh = ("n_lines", "n_chunks", "removed_chunks", "removed_lines")
    docs = docs.drop(*(c for c in fresh if c not in (key, text)))
    found, used = repeated_chunks(chunk_keys(docs, key, text), key)
    lists = stored(found.groupBy(F.col(key).alias("__key"), F.col("text_digest").alias("__digest")).agg(
        F.sort_array(F.collect_list(F.struct("chunk", "first"))).alias("__found")
    ), "chunk-lists")
    discard(*used)
    marked = _with_lists(docs.where(F.contains(text, F.lit("\n"))), lists, key, text, "inner")
    texts = stored(_found_texts(marked, key, text), "chunk-texts")
    sides = texts.groupBy("chunk_digest").agg(F.min("bytes").alias("low"), F.max("bytes").alias("high"))
    unequal = texts.join(sides.where("low <> high").select("chunk_digest"), "chunk_digest", "left_semi")
    first = unequal.where("first").select(F.col("chunk_digest").alias("_c"), F.col("bytes").alias("_b")).dropDuplicates(["_c"])
    differ = unequal.where("not first").join(first, (F.col("chunk_digest") == F.col("_c")) & (F.col("bytes") != F.col("_b")))
    differ = differ.groupBy(F.col("own").alias("__whose"), F.col("key").alias("__of")).agg(F.collect_set("chunk").alias("__other"))
    kept = F.when(F.col("__other").isNull(), F.col("__found")).otherwise(F.filter("__found", lambda f: ~F.array_contains("__other", f["chunk"])))
    checked = lists.join(differ, (F.col("__digest") == F.col("__whose")) & F.col("__key").eqNullSafe(F.col("__of")), "left")
    checked = stored(checked.select("__key", "__digest", kept.alias("__found")), "checked-lists")
    discard(texts, lists)
    release()
    return _without(_with_lists(docs, checked, key, text, "left"), docs.columns, text, fresh)


def _with_lists(docs: DataFrame, lists: DataFrame, key: str, text: str, how: str) -> DataFrame:
    own = docs.withColumn("__own", F.unhex(F.md5(F.col(text).cast("binary"))))
    same = (F.col("__own") == F.col("__digest")) & F.col(key).eqNullSafe(F.col("__key"))
    return own.join(lists.hint("merge"), same, how).drop("__key", "__digest")


def _found_texts(marked: DataFrame, key: str, text: str) -> DataFrame:
    own = marked.select(F.col(key).alias("key"), F.col("__own").alias("own")).schema
    schema = widened(own, "chunk bigint, first boolean, chunk_digest binary, bytes binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, text):
            at, rows = [], []
            for i, (body, found) in enumerate(zip(values(batch, text), values(batch, "__found"), strict=True)):
                chunks = line_chunks(body)
                for f in found:
                    raw = b"\n".join(chunks[f["chunk"]])
                    at.append(i)
                    rows.append((f["chunk"], f["first"], hashlib.md5(raw).digest(), raw))
            take = pa.array(at, pa.int32())
            columns = [batch.column(key).take(take), batch.column("__own").take(take)]
            columns += [pa.array([r[j] for r in rows], kind) for j, kind in enumerate((pa.int64(), pa.bool_(), pa.binary(), pa.binary()))]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return marked.select(key, text, "__own", "__found").mapInArrow(run, schema)


def _without(whole: DataFrame, columns: list[str], text: str, fresh: tuple[str, ...]) -> DataFrame:
    schema = widened(whole.select(*columns).schema, ", ".join(f"{name} bigint" for name in fresh))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, text):
            bodies, counts = [], []
            for body, found in zip(values(batch, text), values(batch, "__found"), strict=True):
                chunks = [] if body is None else line_chunks(body)
                gone = {f["chunk"] for f in found or () if not f["first"]}
                if gone:
                    body = b"\n".join([x for k, lines in enumerate(chunks) if k not in gone for x in lines]).decode()
                bodies.append(body)
                counts.append((sum(map(len, chunks)), len(chunks), len(gone), sum(len(chunks[k]) for k in gone)))
            arrays = [pa.array(bodies, pa.string()) if c == text else batch.column(c) for c in columns]
            arrays += [pa.array([c[j] for c in counts], pa.int64()) for j in range(len(fresh))]
            yield pa.RecordBatch.from_arrays(arrays, names=[*columns, *fresh])

    return whole.select(*columns, "__found").mapInArrow(run, schema)
