"""Quality rules per document, and verdicts per host from how often a host's documents fail them."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalith.llm.common import SPACES, stored, values, widened

#: The characters that count as symbols.
SYMBOLS = "#*$%&|<>"
WINDOW = 5


@dataclass(frozen=True)
class QualityConfig:
    """Limits of the rules.

    A document fails with fewer than ``min_words`` words or with more than ``max_repeat_percent`` of its words in repeated windows. A host is turned
    down when its shrunk failure rate is above ``max_host_rate``; with fewer than ``min_hosts`` hosts there is no spread to learn a prior from,
    and one failure in two pseudo-documents stands in.
    """

    min_words: int = 10
    max_repeat_percent: int = 20
    max_host_rate: float = 0.5
    min_hosts: int = 2


def repeated_words(words: list) -> int:
    """Words that lie in a five-word window which is found twice or more; the first find counts as well."""
    windows = list(zip(words, words[1:], words[2:], words[3:], words[4:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    seen: set = set()
    twice: set = set()
    for w in windows:
        (twice if w in seen else seen).add(w)
    covered, end = 0, 0
    for i, w in enumerate(windows):
        if w in twice:
            covered += i + WINDOW - max(i, end)
            end = i + WINDOW
    return covered


def _measures(text: str | None) -> tuple[int, int, int, int, int]:
    text = text or ""
    raw = text.encode()
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x.strip(SPACES.encode())]
    chars = len(text) - sum(text.count(c) for c in SPACES)
    return len(words), chars, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated_words(words)


NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def text_measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """The columns of ``docs`` but ``text``, and five measures of the whole text as BIGINT.

    ``n_words``; ``word_chars``: code points in words; ``n_symbols``; ``n_dup_lines``: lines with a word that equal an earlier line; ``n_repeat_words``.
    A NULL text has no words. One pass without a shuffle; a measure replaces a column of its name.
    """
    keep = [c for c in docs.columns if c not in (text, *NAMES)]
    schema = docs.select(*keep).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [_measures(t) for t in values(batch, text)]
            found = [pa.array([r[i] for r in rows], pa.int64()) for i in range(len(NAMES))]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + found, names=[*keep, *NAMES])

    schema = widened(schema, ", ".join(f"{n} bigint" for n in NAMES))
    return docs.select(*keep, text).mapInArrow(run, schema)


def base_failed(config: QualityConfig) -> Column:
    """The rules on one document."""
    return (F.col("n_words") < config.min_words) | (100 * F.col("n_repeat_words") > config.max_repeat_percent * F.col("n_words"))


def host_verdicts(judged: DataFrame, host: str, config: QualityConfig) -> DataFrame:
    """One row per host (NULL is a host): ``host_docs``, ``host_failed``, ``host_rate``, ``host_kept`` out of rows with ``base_failed``.

    The prior is a beta distribution with the mean and variance of the hosts' own rates (method of moments), so that a host with few documents is
    judged mostly by what hosts are like, and a host with many by itself. Counts are aggregated per task before they are shuffled.
    """
    hosts = stored(
        judged.groupBy(host).agg(F.count("*").alias("host_docs"), F.sum(F.col("base_failed").cast("long")).alias("host_failed")), "hosts"
    )
    rate = F.col("host_failed") / F.col("host_docs")
    n, mean, spread = hosts.agg(F.count("*"), F.avg(rate), F.var_pop(rate)).first()
    alpha, beta = beta_prior(n, mean, spread, config)
    shrunk = (F.col("host_failed") + F.lit(alpha)) / (F.col("host_docs") + F.lit(alpha + beta))
    return hosts.withColumn("host_rate", shrunk).withColumn("host_kept", F.col("host_rate") <= config.max_host_rate)


def beta_prior(n: int, mean: float | None, spread: float | None, config: QualityConfig) -> tuple[float, float]:
    """Parameters of the prior; hosts that all have one rate give a prior as heavy as a thousand documents."""
    if n < config.min_hosts:
        return 1.0, 1.0
    weight = 1000.0 if not spread else min(1000.0, max(0.0, mean * (1 - mean) / spread - 1))
    return mean * weight, (1 - mean) * weight


def host_rules(docs: DataFrame, config: QualityConfig = QualityConfig(), host: str = "source", text: str = "text") -> DataFrame:
    """All columns of ``docs`` but the text, its measures, ``base_failed``, the host's figures, and ``kept``.

    ``kept`` is false where the document itself fails; else it is its host's verdict. Rows may repeat: each is judged and counted. An empty table gives
    an empty result; NULL hosts are one host. Columns of ``docs`` with the names of results are replaced.
    """
    fresh = (*NAMES, "base_failed", "host_docs", "host_failed", "host_rate", "host_kept", "kept")
    docs = docs.drop(*(c for c in fresh if c not in (host, text)))
    judged = stored(text_measures(docs, text).withColumn("base_failed", base_failed(config)), "quality")
    hosts = stored(host_verdicts(judged, host, config), "host-verdicts").withColumnRenamed(host, "__host")
    joined = judged.join(hosts, F.col(host).eqNullSafe(F.col("__host"))).drop("__host")
    return joined.withColumn("kept", ~F.col("base_failed") & F.col("host_kept"))
