"""Fuzzy title score (0..100): token-sort similarity with a guarded partial match.

The similarity is the normalised Indel similarity, ``1 - (|a| + |b| - 2 LCS) / (|a| + |b|)``. Spark has no LCS, so that
one number comes from an Arrow UDF that works on whole batches with 64-bit masks; everything around it is built-in.
Equal and empty titles never reach Python.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalith.constants import MATCH_EDITION_TOKENS
from catalith.functions.lists import strings
from catalith.functions.text import normalize_title, tokens

_WORD = 64


def _codes(texts: list[str], width: int) -> np.ndarray:
    padded = "".join(t.ljust(width, "\0") for t in texts)
    return np.frombuffer(padded.encode("utf-32-le"), dtype="<u4").reshape(len(texts), width)


def _lcs_words(pairs: list[tuple[str, str]], words: int) -> np.ndarray:
    """LCS lengths of pairs whose first text fits ``words`` machine words; a bit per character of it, all pairs advance together.

    A step adds the matched bits to the open ones; the carry of that sum runs from word to word.
    """
    n, width = len(pairs), words * _WORD
    x_len = np.array([len(x) for x, _ in pairs])
    y_width = max(len(y) for _, y in pairs)
    xs = np.full((n, width), 0xFFFFFFFF, dtype=np.uint32)
    codes = _codes([x for x, _ in pairs], int(x_len.max()))
    inside = np.arange(codes.shape[1]) < x_len[:, None]
    xs[:, : codes.shape[1]][inside] = codes[inside]
    ys = _codes([y for _, y in pairs], y_width)
    v = np.full((words, n), np.iinfo(np.uint64).max, dtype=np.uint64)
    for j in range(y_width):
        hit = np.packbits(xs == ys[:, j : j + 1], axis=1, bitorder="little").view("<u8").T
        carry = np.zeros(n, bool)
        for w in range(words):
            u = v[w] & hit[w]
            total = v[w] + u
            over = total < u
            if w:
                total = total + carry
                over |= carry & (total == 0)
            v[w] = total | (v[w] - u)
            carry = over
    left = np.clip(x_len[None, :] - _WORD * np.arange(words)[:, None], 0, _WORD)
    kept = np.where(left == _WORD, np.iinfo(np.uint64).max, (np.uint64(1) << (left % _WORD).astype(np.uint64)) - np.uint64(1))
    return np.bitwise_count(~v & kept).sum(0)


def lcs_lengths(a: list[str], b: list[str], cells: int = 1 << 22) -> np.ndarray:
    """LCS length of each pair, in runs of pairs whose shorter texts take equally many machine words; a run holds about ``cells`` characters."""
    out = np.zeros(len(a), dtype=np.int64)
    sized: dict[int, list[int]] = {}
    pairs = [(x, y) if len(x) <= len(y) else (y, x) for x, y in zip(a, b)]
    for i, (x, _) in enumerate(pairs):
        if x:
            sized.setdefault(-(-len(x) // _WORD), []).append(i)
    for words, at in sized.items():
        at.sort(key=lambda i: len(pairs[i][1]))
        most = max(1, cells // (words * _WORD))
        for k in range(0, len(at), most):
            out[at[k : k + most]] = _lcs_words([pairs[i] for i in at[k : k + most]], words)
    return out


@F.arrow_udf(T.IntegerType())
def _lcs(a: pa.Array, b: pa.Array) -> pa.Array:
    xs, ys = a.to_pylist(), b.to_pylist()
    pairs: dict[tuple[str, str], int] = {}
    where = np.empty(len(xs), dtype=np.int64)
    for i, (x, y) in enumerate(zip(xs, ys)):
        where[i] = -1 if x is None or y is None else pairs.setdefault((x, y), len(pairs))
    lengths = lcs_lengths([p[0] for p in pairs], [p[1] for p in pairs])
    known = where >= 0
    values = np.zeros(len(xs), dtype=np.int32)
    values[known] = lengths[where[known]]
    return pa.array(values, pa.int32(), mask=~known)


def window_ratios(a: list[str], b: list[str]) -> np.ndarray:
    """Best similarity of each pair's shorter text against the longer one's windows of its length, clipped ones included; all pairs in one LCS run."""
    shorter, windows, ends = [], [], np.zeros(len(a) + 1, np.int64)
    for k, (x, y) in enumerate(zip(a, b)):
        if len(x) > len(y):
            x, y = y, x
        found = dict.fromkeys(y[max(0, i) : i + len(x)] for i in range(1 - len(x), len(y))) if x else {}
        found.pop("", None)
        shorter += [x] * len(found)
        windows += found
        ends[k + 1] = ends[k] + len(found)
    total = np.array([len(x) + len(w) for x, w in zip(shorter, windows)], float)
    ratios = (1.0 - (total - 2 * lcs_lengths(shorter, windows)) / np.maximum(total, 1)) * 100.0
    out = np.zeros(len(a))
    some = np.flatnonzero(np.diff(ends))
    if len(some):
        out[some] = np.maximum.reduceat(ratios, ends[some])
    return out


@F.arrow_udf(T.DoubleType())
def _window_ratio(a: pa.Array, b: pa.Array) -> pa.Array:
    xs, ys = a.to_pylist(), b.to_pylist()
    void = np.array([x is None or y is None for x, y in zip(xs, ys)], bool)
    asked = [(x, y) for x, y in zip(xs, ys) if x is not None and y is not None]
    values = np.zeros(len(xs))
    values[~void] = window_ratios([x for x, _ in asked], [y for _, y in asked])
    return pa.array(values, pa.float64(), mask=void)


_ONLY_YEARS = r"^(?:(?:19\d{2}|20\d{2}|2100)(?: |$))+$"


def with_scores(df: DataFrame, pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """Add one score column per pair of already normalised title columns; NULL when either title is NULL.

    Words and sorted words are computed once per title, and all pairs share one Arrow pass.
    """
    titles = list(dict.fromkeys(c for pair in pairs.values() for c in pair))
    at = {c: i for i, c in enumerate(titles)}
    editions = strings(MATCH_EDITION_TOKENS)
    words = {f"__fw{i}": tokens(F.col(c)) for c, i in at.items()}
    out = df.withColumns(words)
    out = out.withColumns({f"__fs{i}": F.array_join(F.sort_array(F.col(f"__fw{i}")), " ") for i in at.values()})

    extras: dict[str, Column] = {}
    for n, (a, b) in enumerate(pairs.values()):
        extras[f"__fa{n}"] = F.array_except(f"__fw{at[a]}", f"__fw{at[b]}")
        extras[f"__fb{n}"] = F.array_except(f"__fw{at[b]}", f"__fw{at[a]}")
    out = out.withColumns(extras)

    def harmless(extra: Column) -> Column:
        years = F.array_join(extra, " ").rlike(_ONLY_YEARS)
        return (F.size(extra) > 0) & (years | (F.size(F.array_except(extra, editions)) == 0))

    asked: dict[str, Column] = {}
    for n, (a, b) in enumerate(pairs.values()):
        na, nb, sa, sb = F.col(a), F.col(b), F.col(f"__fs{at[a]}"), F.col(f"__fs{at[b]}")
        more_a, more_b = F.col(f"__fa{n}"), F.col(f"__fb{n}")
        partial_ok = ((F.size(more_b) == 0) & harmless(more_a)) | ((F.size(more_a) == 0) & harmless(more_b))
        differ = (sa != sb) & (sa != "") & (sb != "")
        some = (na != "") & (nb != "")
        inside = some & (F.contains(na, nb) | F.contains(nb, na))
        need_window = partial_ok & some & ~inside
        asked[f"__fp{n}"] = partial_ok
        asked[f"__fi{n}"] = inside
        asked[f"__fl{n}"] = _lcs(F.when(differ, sa), F.when(differ, sb))
        asked[f"__fr{n}"] = _window_ratio(F.when(need_window, na), F.when(need_window, nb))
    out = out.withColumns(asked)

    scores: dict[str, Column] = {}
    for n, (name, (a, b)) in enumerate(pairs.items()):
        sa, sb = F.col(f"__fs{at[a]}"), F.col(f"__fs{at[b]}")
        total = (F.length(sa) + F.length(sb)).cast("double")
        ratio = (F.lit(1.0) - (total - F.col(f"__fl{n}") * 2) / total) * 100.0
        token_sort = F.when(sa == sb, F.lit(100.0)).otherwise(F.coalesce(ratio, F.lit(0.0)))
        partial = F.when(F.col(f"__fi{n}"), F.lit(100.0)).otherwise(F.coalesce(F.col(f"__fr{n}"), F.lit(0.0)))
        best = F.when(F.col(f"__fp{n}"), F.greatest(token_sort, partial)).otherwise(token_sort)
        scores[name] = F.when(F.col(a).isNotNull() & F.col(b).isNotNull(), F.floor(best).cast("int"))
    return out.withColumns(scores).drop(*words, *[f"__fs{i}" for i in at.values()], *extras, *asked)


def with_fuzzy_scores(df: DataFrame, pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """Add one score column per pair of raw title columns; each title is normalised once."""
    titles = list(dict.fromkeys(c for pair in pairs.values() for c in pair))
    norm = {c: f"__norm_{i}" for i, c in enumerate(titles)}
    out = df.withColumns({n: normalize_title(F.col(c)) for c, n in norm.items()})
    return with_scores(out, {name: (norm[a], norm[b]) for name, (a, b) in pairs.items()}).drop(*norm.values())
