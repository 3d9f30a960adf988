"""Packing documents into sequences: byte-level BPE ids, cut at the sequence length, first-fit decreasing in randomised groups."""

from __future__ import annotations

import functools
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalith.llm.common import stored, values, widened


@dataclass(frozen=True)
class PackConfig:
    """``vocabulary``: path of a byte-level BPE tokenizer file that workers can read; None takes the public 50k one where the job runs.

    ``length`` tokens a sequence at most, ``end`` closes each document, ``group`` pieces are packed together on average, ``cache`` distinct
    segments are remembered by a worker, ``seed`` deals the groups.
    """

    vocabulary: str | None = None
    length: int = 2048
    end: int = 1
    group: int = 4096
    cache: int = 800_000
    seed: int = 8


#: Stretches of text that byte-level BPE never joins: a run of other characters with the space before it, and white space apart.
SEGMENT = re.compile(r" ?\S+|\s+(?!\S)|\s")
#: Separators that Python counts as white space and the tokenizer does not.
ODD = re.compile("[\x1c-\x1f]")


#: How byte-level BPE splits a text before merging (fixed value).
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_pieces(vocabulary: dict[str, int]) -> dict[bytes, int]:
    """A byte-level vocabulary with its pieces as bytes: visible Latin-1 characters stand for themselves, the other bytes for the characters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letter = {chr(b): b for b in plain}
    letter |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}
    return {bytes(letter[c] for c in piece): i for piece, i in vocabulary.items() if all(c in letter for c in piece)}


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit bytes.

    Byte-level BPE splits a text before it merges bytes, and always before a space that a visible character follows; so a text's ids are the ids of its
    segments in a row. Segments are encoded once while a worker remembers them; the memory is emptied when full. Ids of a vocabulary grow in
    the order of its merges, so it serves as ranks.
    """

    def __init__(self, vocabulary: str | None, cache: int) -> None:
        import tiktoken
        from tokenizers import Tokenizer

        if vocabulary is None:
            import public_tokenizers

            vocabulary = public_tokenizers.path("byte_bpe_50k.json")
        tokenizer = Tokenizer.from_file(vocabulary)
        ranks = byte_pieces(tokenizer.get_vocab(with_added_tokens=False))
        special = {t.content: i for i, t in tokenizer.get_added_tokens_decoder().items()}
        ranks = {piece: i for piece, i in ranks.items() if i not in set(special.values())}
        self.tokenizer, self.special = tokenizer, tuple(special)
        self.fast = tiktoken.Encoding("byte-level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.widths = np.zeros(max(ranks.values()) + 1, np.int64)
        self.widths[list(ranks.values())] = [len(piece) for piece in ranks]
        self.cache = cache
        self.known: dict[str, bytes] = {}

    def _learn(self, parts: list[str]) -> dict[str, bytes]:
        """Ids of distinct segments. Visible ones are encoded as one text: each starts with its own space or gets a line feed, which is one id."""
        out = {p: np.array(self.fast.encode_ordinary(p), "<u4").tobytes() for p in parts if p.isspace()}
        seen = [p for p in parts if not p.isspace()]
        ids = np.array(self.fast.encode_ordinary("".join([p if p[0] == " " else "\n" + p for p in seen])), "<u4")
        ends = np.cumsum(self.widths[ids])
        marked = np.array([p[0] != " " for p in seen], np.int64)
        stops = np.searchsorted(ends, np.cumsum(np.array([len(p.encode()) for p in seen], np.int64) + marked), "left") + 1
        raw, at = ids.tobytes(), 0
        for p, extra, stop in zip(seen, marked.tolist(), stops.tolist(), strict=True):
            out[p] = raw[4 * (at + extra) : 4 * stop]
            at = stop
        return out

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text; NULL has none."""
        known, join = self.known, b"".join
        out: list[bytes] = []
        later: list[tuple[int, list[str]]] = []
        for i, text in enumerate(texts):
            raw = b""
            if text:
                if ODD.search(text) or any(x in text for x in self.special):
                    raw = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
                else:
                    parts = SEGMENT.findall(text)
                    try:
                        raw = join(map(known.__getitem__, parts))
                    except KeyError:
                        later.append((i, parts))
            out.append(raw)
        if later:
            if len(known) > self.cache:
                known.clear()
            own = self._learn(list({p for _, parts in later for p in parts if p not in known}))
            known.update((p, ids) for p, ids in own.items() if len(p) <= 64)
            own = {p: ids for p, ids in own.items() if len(p) > 64}
            for i, parts in later:
                out[i] = join([known[p] if p in known else own[p] for p in parts])
        return out


@functools.cache
def encoder(vocabulary: str | None, cache: int) -> Encoder:
    """The worker's encoder: tasks that one worker runs in turn share what it remembers."""
    return Encoder(vocabulary, cache)


def encode_in_turn(encode: Encoder, texts: list[str | None], step: int = 128) -> Iterator[bytes]:
    """Ids of texts, some at a time."""
    for i in range(0, len(texts), step):
        yield from encode(texts[i : i + step])


def cut_pieces(docs: DataFrame, config: PackConfig = PackConfig(), key: str = "doc_id", text: str = "text", keep_ids: bool = False) -> DataFrame:
    """Pieces of every document: key, start, length, ids_crc32, doc_tokens, dealt (even over [0, 1)), and ``ids`` when asked for.

    A document's ids are cut into pieces of the sequence length; the last is what is left. A NULL text is empty, so its only id is the end id.
    """
    fields = "start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint" + ", ids array<bigint>" * keep_ids
    schema = widened(docs.select(key).schema, fields)
    size, end = config.length, np.array([config.end], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(config.vocabulary, config.cache)
        for batch in batches:
            at: list[int] = []
            rows: list[tuple[int, int, int, int]] = []
            ids: list[np.ndarray] = []
            for i, body in enumerate(encode_in_turn(encode, values(batch, text))):
                raw = body + end
                n = len(raw) // 4
                for start in range(0, n, size):
                    piece = raw[4 * start : 4 * (start + size)]
                    at.append(i)
                    rows.append((start, len(piece) // 4, zlib.crc32(piece), n))
                    if keep_ids:
                        ids.append(np.frombuffer(piece, "<u4").astype(np.int64))
            columns = [batch.column(key).take(pa.array(at, pa.int32()))] + [pa.array([r[j] for r in rows], pa.int64()) for j in range(4)]
            names = [key, "start", "length", "ids_crc32", "doc_tokens"]
            if keep_ids:
                columns.append(pa.array(ids, pa.list_(pa.int64())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select(key, text).mapInArrow(run, schema).withColumn("dealt", F.rand(config.seed))


def first_fit(sizes: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each size, taken in the given order, each in the first bin with room for it.

    The tournament tree holds in each node the most room that a bin below it has; an unopened bin has all its room, so descending from the root to the left
    wherever the left has room finds the first fit in the logarithm of the bins.
    """
    n = len(sizes)
    leaves = 1 << max(0, n - 1).bit_length()
    tree = [room] * (2 * leaves)
    where, offset = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for i, size in enumerate(sizes.tolist()):
        node = 1
        while node < leaves:
            node *= 2
            if tree[node] < size:
                node += 1
        where[i], offset[i] = node - leaves, room - tree[node]
        tree[node] -= size
        while node > 1:
            node //= 2
            most = max(tree[2 * node], tree[2 * node + 1])
            if tree[node] == most:
                break
            tree[node] = most
    return where, offset


def packed(pieces: DataFrame, config: PackConfig = PackConfig(), key: str = "doc_id") -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: the place of each piece in a sequence.

    Pieces are dealt into groups at random, as many groups as the pieces need, and each group is packed by itself, largest first; equal sizes go by key,
    start and digest. The groups, not the keys, decide the task, so repeated rows and a hot key are spread like any others. A piece as long as a
    sequence fills one. An empty table gives an empty result.
    """
    pieces = stored(pieces, "pieces")
    n = pieces.count()
    groups = max(1, -(-n // config.group))
    schema = widened(pieces.schema, "sequence_id bigint, offset bigint")
    names = schema.names

    def pack(group: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", key, "start", "ids_crc32"], ascending=[False, True, True, True], kind="stable", na_position="last")
        where, offset = first_fit(rows["length"].to_numpy(np.int64), config.length)
        rows["sequence_id"] = (int(group[0]) << 32) + where
        rows["offset"] = offset
        return rows[names]

    dealt = pieces.withColumn("_group", F.floor(F.col("dealt") * groups).cast("long"))
    typed = dealt.groupBy("_group").applyInPandas(pack, schema)
    return typed.drop("dealt")


def packed_documents(docs: DataFrame, config: PackConfig = PackConfig(), key: str = "doc_id", text: str = "text", keep_ids: bool = False) -> DataFrame:
    """Every document cut and packed: key, start, length, ids_crc32, doc_tokens, sequence_id, offset, and ``ids`` when asked for.

    Repeated rows are documents of their own; other columns of ``docs`` are not read, so they may have any name.
    """
    return packed(cut_pieces(docs, config, key, text, keep_ids), config, key)
