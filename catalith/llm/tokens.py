"""Token counts: greedy longest-match word pieces counted by an automaton in one pass over a word, without building the pieces."""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from catalith.llm.common import small_batches, values, widened
from catalith.llm.packing import byte_pieces


@dataclass(frozen=True)
class CountConfig:
    """``vocabulary``: path of a tokenizer file whose pieces are bytes, that workers can read; None takes the public 49k word vocabulary where the job runs.

    ``suffix`` ends pieces that close a word; it is taken off. A worker remembers the counts of ``memory`` words and empties that when full.
    """

    vocabulary: str | None = None
    suffix: str = "</w>"
    memory: int = 1_000_000


class LongestMatch:
    """Counts the pieces that greedy longest match takes from a word, in time linear in the word.

    ``first`` holds the pieces that may start a word, ``inner`` those that may follow. Both are tries. A node stands for the bytes read since the last
    piece was taken for certain. Where it has no child for the next byte, the longest piece at the front of those bytes is popped, and with it
    every further one that the rest settles: ``fail`` is the node of what is left and ``pops`` how many went. A word with a stretch that no
    piece begins is one unknown token, as is an empty set of pieces' word.
    """

    def __init__(self, first: Iterable[bytes], inner: Iterable[bytes]) -> None:
        self.child: dict[int, int] = {}
        self.fail: list[int] = [-1, -1]
        self.pops: list[int] = [0, 0]
        whole = [False, False]
        above: list[tuple[int, int]] = [(-1, 0), (-1, 0)]
        depth = [0, 0]
        for root, pieces in ((0, first), (1, inner)):
            for piece in pieces:
                node = root
                for byte in piece:
                    step = node << 8 | byte
                    if step not in self.child:
                        self.child[step] = len(self.fail)
                        self.fail.append(-1)
                        self.pops.append(0)
                        whole.append(False)
                        above.append((node, byte))
                        depth.append(depth[node] + 1)
                    node = self.child[step]
                whole[node] = node > 1
        for node in sorted(range(2, len(depth)), key=depth.__getitem__):
            if whole[node]:
                self.fail[node], self.pops[node] = 1, 1
                continue
            parent, byte = above[node]
            at, popped = self.fail[parent], self.pops[parent]
            while at >= 0 and (at << 8 | byte) not in self.child:
                popped += self.pops[at]
                at = self.fail[at]
            if at >= 0:
                self.fail[node], self.pops[node] = self.child[at << 8 | byte], popped

    def count(self, word: bytes) -> int:
        """Pieces of one word; 0 for an empty one."""
        child, fail, pops = self.child, self.fail, self.pops
        node = total = 0
        for byte in word:
            step = child.get(node << 8 | byte)
            while step is None:
                total += pops[node]
                node = fail[node]
                if node < 0:
                    return 1
                step = child.get(node << 8 | byte)
            node = step
        while node > 1:
            total += pops[node]
            node = fail[node]
        return total if node >= 0 else 1


class WordCounts(dict):
    """Counts of words, remembered."""

    def __init__(self, automaton: LongestMatch) -> None:
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: bytes) -> int:
        n = self.automaton.count(word)
        if len(word) <= 64:
            self[word] = n
        return n


def vocabulary_pieces(config: CountConfig) -> set[bytes]:
    """The pieces of a vocabulary file as bytes."""
    from tokenizers import Tokenizer

    path = config.vocabulary
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    added = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
    names = {p.removesuffix(config.suffix) for p in tokenizer.get_vocab() if p not in added}
    return set(byte_pieces(dict.fromkeys(names - {""}, 0)))


@functools.cache
def word_counts(config: CountConfig) -> WordCounts:
    """The worker's automaton and memory."""
    pieces = vocabulary_pieces(config)
    return WordCounts(LongestMatch(pieces, pieces))


def token_counts(docs: DataFrame, config: CountConfig = CountConfig(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, n_words, n_tokens (BIGINT). Words are split at ASCII white space, A-Z lower-cased, and matched as UTF-8 bytes.

    NULL, empty and blank texts have 0 of both. Rows may repeat and keys may be NULL: each row is counted by itself, in one pass without a shuffle. Other
    columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = word_counts(config)
        for batch in small_batches(batches, text):
            words, tokens = [], []
            for body in values(batch, text):
                if len(counts) > config.memory:
                    counts.clear()
                split = body.encode().lower().split() if body else []
                words.append(len(split))
                tokens.append(sum(map(counts.__getitem__, split)))
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(words, pa.int64()), pa.array(tokens, pa.int64())], names=[key, "n_words", "n_tokens"])

    return docs.select(key, text).mapInArrow(run, widened(docs.select(key).schema, "n_words bigint, n_tokens bigint"))
