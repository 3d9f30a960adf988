"""Ranking of candidates for a query title.

A search is a table of candidate rows keyed by the query row, as a provider's search returns them. The chain of filters
"keep the candidates with property p, unless that keeps none" is a lexicographic preference: survivors are the rows whose
vector of properties is the group's greatest. So a whole chain plus the final ranking is one ``max(struct(..))``
aggregate, combined map-side before the shuffle; no group is ever gathered.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from catalith.functions.fuzzy import with_scores
from catalith.functions.text import (
    count_year_words,
    has_other_number,
    has_series_number,
    match_dlc_like,
    match_series_numbers,
    normalize_title,
    tokens,
)
from catalith.operators.keys import first_n
from catalith.session import materialize

NO_ID = 10**18
NO_DELTA = 10**9


def year_adjustment(delta: Column) -> Column:
    """Score change for the distance between the hinted year and the candidate's (fixed values)."""
    return (
        F.when(delta == 0, 10)
        .when(delta <= 1, 6)
        .when(delta <= 2, 3)
        .when(delta >= 15, -14)
        .when(delta >= 10, -10)
        .when(delta >= 5, -6)
        .otherwise(0)
    )


def score_bounds(q: Column, c: Column, qt: Column, ct: Column) -> tuple[Column, Column]:
    """(least, greatest) raw score that two normalised titles with these words can have, without their longest common subsequence.

    Words in common stand in both sorted titles in one order, so their letters and the spaces between them are a common subsequence. No subsequence is longer
    than what is left of a title without the characters that the other lacks. Where one title's words are all the other's, the partial match may give 100.
    """
    total = (F.length(q) + F.length(c)).cast("double")

    def ratio(lcs: Column) -> Column:
        return F.floor((F.lit(1.0) - (total - lcs * 2) / total) * 100.0).cast("int")

    def within(a: Column, b: Column) -> Column:
        return F.length(a) - F.length(F.call_function("translate", a, b, F.lit("")))

    common = F.array_intersect(qt, ct)
    shared = F.aggregate(common, F.lit(-1), lambda n, w: n + 1 + F.length(w))
    some = (q != "") & (c != "")
    least = F.when(q == c, 100).when(some & (F.size(common) > 0), ratio(shared)).otherwise(0)
    inside = (F.size(common) == F.size(qt)) | (F.size(common) == F.size(ct))
    most = F.when((q == c) | (some & inside), 100).when(some, ratio(F.least(within(q, c), within(c, q)))).otherwise(0)
    return least, most


def once_per_pair(df: DataFrame, columns: list[str], add: Callable[[DataFrame], DataFrame], source: DataFrame | None = None) -> DataFrame:
    """``df`` with what ``add`` derives from ``columns`` alone, derived once for each distinct combination of them.

    Titles repeat in candidates: many rows ask for a name, and a record answers many. ``df`` is written once, unless its combinations can be read from ``source``,
    a stored table. The combinations, reduced before they are shuffled, are judged and stored, and what was found is merged back: few of them are broadcast, so
    that candidates stay where they lie; else both sides of the join are plain shuffles, and a combination that many rows hold is split by adaptive skew handling.
    A hash goes before the texts, so that sorting compares numbers.
    """
    stored = materialize(df, "candidates") if source is None else df
    found = add((stored if source is None else source).select(*columns).distinct())
    side = materialize(found, "pairs").select(
        F.xxhash64(*columns).alias("__pair"), *[F.col(c).alias(f"__same_{c}") for c in columns], *[c for c in found.columns if c not in columns]
    )
    same = F.xxhash64(*columns) == F.col("__pair")
    for c in columns:  # not as equalities, which would become keys of the join, texts and all
        a, b = F.col(c), F.col(f"__same_{c}")
        same = same & (a.between(b, b) | (a.isNull() & b.isNull()))
    return stored.join(side, same).drop("__pair", *[f"__same_{c}" for c in columns])


def title_facts(df: DataFrame, query: str, name: str, prefix: str = "m_") -> DataFrame:
    """Ranking facts that hang on the two titles alone: series points, add-on flag, differences, points for a leading title; and the normalised titles and words."""
    q, c = f"{prefix}q", f"{prefix}c"
    out = df.withColumns({q: normalize_title(F.col(query)), c: normalize_title(F.coalesce(F.col(name), F.lit("")))})
    out = out.withColumns(
        {f"{prefix}qt": F.array_distinct(tokens(F.col(q))), f"{prefix}ct": F.array_distinct(tokens(F.col(c)))}
    )
    qt, ct = F.col(f"{prefix}qt"), F.col(f"{prefix}ct")
    q_has, c_has = has_series_number(F.col(q)), has_series_number(F.col(c))
    apart = q_has & c_has & ~F.arrays_overlap(match_series_numbers(F.col(q)), match_series_numbers(F.col(c)))
    differing = F.array_union(F.array_except(qt, ct), F.array_except(ct, qt))
    return out.withColumns(
        {
            f"{prefix}series": F.when(~q_has & c_has, 15).when(apart, 20).otherwise(0),
            f"{prefix}dlc": match_dlc_like(ct),
            f"{prefix}year_diff": count_year_words(differing),
            f"{prefix}differ": F.size(differing),
            f"{prefix}leads": F.when(has_other_number(F.col(q)) & F.startswith(F.col(c), F.col(q)), 25).otherwise(0),
        }
    )


def score_candidates(
    df: DataFrame,
    query: str,
    name: str,
    year_hint: str | None = None,
    candidate_year: str | None = None,
    prefix: str = "m_",
    keys: list[str] | None = None,
    code: Column | None = None,
    judge: Callable[[DataFrame], DataFrame] | None = None,
    source: DataFrame | None = None,
) -> DataFrame:
    """Add the ranking facts of each (query, candidate) row: raw and adjusted score, exactness, add-on flag, differences.

    ``year_hint``/``candidate_year`` are optional INT columns; a hint without a candidate year costs 8 points. Pairs of titles are scored once each, together
    with the columns that ``judge`` derives from them (see :func:`once_per_pair`, also for ``source``). With ``keys``, the groups of which only the best is wanted (by ``code`` and
    then by adjusted score), rows are scored instead, and a candidate whose greatest possible score is below the least possible of another one of its group is
    not scored: its scores are NULL. The rows of a group then meet in one task, in a window.
    """
    q, c = f"{prefix}q", f"{prefix}c"
    inner = [q, c, f"{prefix}qt", f"{prefix}ct"]
    titles = list(dict.fromkeys((query, name)))
    if keys:
        out = title_facts(judge(df) if judge else df, query, name, prefix)
    else:

        def scored_pairs(pairs: DataFrame) -> DataFrame:
            facts = title_facts(judge(pairs) if judge else pairs, query, name, prefix)
            return with_scores(facts, {f"{prefix}raw": (q, c)}).drop(*inner)

        out = once_per_pair(df, titles, scored_pairs, source)
    if year_hint and candidate_year:
        delta = F.abs(F.col(candidate_year) - F.col(year_hint))
        year_points = (
            F.when(F.col(year_hint).isNull(), 0).when(F.col(candidate_year).isNull(), -8).otherwise(year_adjustment(delta))
        )
    else:
        delta, year_points = F.lit(None).cast("int"), F.lit(0)
    out = out.withColumns({f"{prefix}bonus": F.col(f"{prefix}leads") + year_points, f"{prefix}delta": delta.cast("int")})
    series, dlc, bonus = (F.col(f"{prefix}{k}") for k in ("series", "dlc", "bonus"))
    same_words = (F.col(f"{prefix}differ") == 0) & (series == 0) & ~dlc

    def adjusted(raw: Column) -> Column:
        blended = F.greatest(raw - series - F.when(dlc, 20).otherwise(0), F.lit(0)) + bonus
        return F.when((raw >= 100) & same_words, 100).otherwise(F.greatest(F.least(blended, F.lit(100)), F.lit(0))).cast("int")

    if keys:
        least, most = score_bounds(F.col(q), F.col(c), F.col(f"{prefix}qt"), F.col(f"{prefix}ct"))
        first = (code if code is not None else F.lit(0)).alias("code")
        out = out.withColumns({f"{prefix}low": F.struct(first, adjusted(least).alias("s")), f"{prefix}high": F.struct(first, adjusted(most).alias("s"))})
        out = out.withColumn(f"{prefix}top", F.max(f"{prefix}low").over(Window.partitionBy(*keys)))
        scored = f"{prefix}scored"
        out = out.withColumn(scored, F.when(F.col(f"{prefix}high") >= F.col(f"{prefix}top"), F.col(c)))
        out = with_scores(out.drop(f"{prefix}low", f"{prefix}high", f"{prefix}top"), {f"{prefix}raw": (q, scored)})
    raw = F.col(f"{prefix}raw")
    return out.withColumns(
        {
            f"{prefix}adjusted": F.when(raw.isNotNull(), adjusted(raw)),
            f"{prefix}exact": (raw >= 100) & same_words,
            f"{prefix}other_diff": F.col(f"{prefix}differ") - F.col(f"{prefix}year_diff"),
        }
    )


def id_number(id_: Column) -> Column:
    return F.coalesce(id_.cast("string").try_cast("bigint"), F.lit(NO_ID).cast("bigint"))


def rank_key(
    name: str, id_: str, pos: Column | None = None, prefix: str = "m_", legacy_tiebreak: bool = False
) -> list[Column]:
    """Ranking columns, greatest first: adjusted, raw, exact, year distance, add-on, differences, title length, id.

    ``legacy_tiebreak`` lets the numeric id decide right after exactness.
    """
    m = {k: F.col(f"{prefix}{k}") for k in ("adjusted", "raw", "exact", "dlc", "other_diff", "year_diff", "delta")}
    by_id = (-id_number(F.col(id_))).alias("k_id")
    close = (-F.coalesce(m["delta"], F.lit(NO_DELTA))).alias("k_close")
    rest = [
        close,
        (~m["dlc"]).alias("k_base"),
        (-m["other_diff"]).alias("k_words"),
        (-m["year_diff"]).alias("k_years"),
        (-F.length(F.coalesce(F.col(name), F.lit("")))).alias("k_length"),
    ]
    order = [by_id, *rest] if legacy_tiebreak else [*rest, by_id]
    tail = [(-(pos if pos is not None else F.lit(0))).alias("k_pos")]
    return [m["adjusted"].alias("k_adjusted"), m["raw"].alias("k_raw"), m["exact"].alias("k_exact"), *order, *tail]


def preference(*predicates: Column) -> Column:
    """Predicates of a filter chain as one number, the first predicate the highest bit."""
    code = F.lit(0)
    for p in predicates:
        code = code * 2 + F.when(F.coalesce(p, F.lit(False)), 1).otherwise(0)
    return code


def best_per_group(
    df: DataFrame, keys: list[str], order: list[Column], payload: list[str], where: Column | None = None
) -> DataFrame:
    """Greatest row per group by ``order``: one aggregate with map-side combine."""
    row = F.struct(F.struct(*order).alias("k"), F.struct(*payload).alias("p"))
    picked = F.max(row if where is None else F.when(where, row))
    return df.groupBy(*keys).agg(picked.alias("__best")).select(*keys, "__best.p.*")


def narrow(df: DataFrame, keys: list[str], predicates: list[Column]) -> DataFrame:
    """Apply a chain of narrow-only-if-it-helps filters and keep all survivors.

    The greatest preference per group comes from a pre-aggregated maximum that is joined back.
    """
    coded = df.withColumn("__code", preference(*predicates))
    top = coded.groupBy(*keys).agg(F.max("__code").alias("__top"))
    kept = coded.join(top, keys).where(F.col("__code") == F.col("__top"))
    return kept.select(*df.columns)


def pick_best(
    df: DataFrame,
    keys: list[str],
    query: str,
    name: str,
    id_: str,
    payload: list[str],
    year_hint: str | None = None,
    candidate_year: str | None = None,
    predicates: list[Column] | None = None,
    legacy_tiebreak: bool = False,
    pos: str | None = None,
    prune: bool = False,
    judge: Callable[[DataFrame], DataFrame] | None = None,
    source: DataFrame | None = None,
) -> DataFrame:
    """Best candidate per group with its adjusted (``score``) and raw (``raw_score``) scores.

    ``judge`` adds columns that hang on the two titles alone, for ``predicates``; for ``source`` see :func:`once_per_pair`. ``prune`` scores only the candidates that bounds leave in question, at the price of a window over each group; for groups that are pages of hits.
    """
    code = preference(*(predicates or []))
    scored = score_candidates(df, query, name, year_hint, candidate_year, keys=keys if prune else None, code=code, judge=judge, source=source)
    order = [
        code.alias("k_code"),
        *rank_key(name, id_, F.col(pos) if pos else None, legacy_tiebreak=legacy_tiebreak),
    ]
    scored = scored.withColumns({"score": F.col("m_adjusted"), "raw_score": F.col("m_raw")})
    return best_per_group(scored, keys, order, [*payload, "score", "raw_score"])


def ranked(
    df: DataFrame,
    keys: list[str],
    query: str,
    name: str,
    id_: str,
    year_hint: str | None = None,
    candidate_year: str | None = None,
    top: int = 6,
    legacy_tiebreak: bool = False,
) -> DataFrame:
    """The first ``top`` candidates per group with ``rank``; groups are cut map-side before the shuffle."""
    scored = score_candidates(df, query, name, year_hint, candidate_year)
    order = [c.desc() for c in rank_key(name, id_, legacy_tiebreak=legacy_tiebreak)]
    keep = [*df.columns, F.col("m_adjusted").alias("score"), F.col("m_raw").alias("raw_score"), "rank"]
    return first_n(scored, keys, order, top).select(*keep)


def with_alternatives(top: DataFrame, keys: list[str], name: str, id_: str) -> DataFrame:
    """Best candidate per group plus the next five names with a positive raw score, from :func:`ranked` rows."""
    best = F.col("rank") == 1
    others = F.sort_array(F.collect_list(F.when(~best & (F.col("raw_score") > 0), F.struct("rank", name, "raw_score"))))
    return top.groupBy(*keys).agg(
        F.max(F.when(best, F.col(id_))).alias("best_id"),
        F.max(F.when(best, F.col(name))).alias("best_name"),
        F.max(F.when(best, F.col("score"))).alias("best_score"),
        others.alias("__others"),
    ).select(
        *keys,
        "best_id",
        "best_name",
        "best_score",
        F.transform("__others", lambda o: F.struct(o[name].alias("name"), o["raw_score"].alias("score"))).alias("alternatives"),
    )
