"""Agreement between the few sources of a row: votes, outliers and overlap components.

A row has at most a handful of sources, so every vote is a set of column expressions over short arrays: no explode, no
shuffle. Components are found on bit masks, one bit per source in name order.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalith.functions.fuzzy import with_scores
from catalith.functions.lists import bind, clean_list, compact, is_blank, strings, tag_if, text
from catalith.functions.company import without_low_signal
from catalith.functions.text import normalize_title

YEARLESS = ("steam",)


def _bit(mask: Column, i: int) -> Column:
    return F.shiftright(mask, i).bitwiseAND(F.lit(1)) == 1


def _joined_names(names: list[str], mask: Column) -> Column:
    return compact(*[F.when(_bit(mask, i), F.lit(n)) for i, n in enumerate(names)])


def _largest_component(present: list[Column], edge: dict[tuple[int, int], Column]) -> Column:
    """Bit mask of the largest connected component; among equals the one holding the first source.

    Presence and edges are bound once as an array, so that their expressions are not copied into every mask.
    """
    n, at = len(present), {pair: len(present) + k for k, pair in enumerate(edge)}
    # Each squaring doubles the length of the paths covered; the longest has one edge less than there are sources.
    rounds = max(1, (n - 2).bit_length())

    def largest(flags: Column) -> Column:
        masks = []
        for i in range(n):
            mask = F.when(F.get(flags, F.lit(i)), F.lit(1 << i)).otherwise(F.lit(0))
            for j in range(n):
                if i != j:
                    mask = mask.bitwiseOR(F.when(F.get(flags, F.lit(at[min(i, j), max(i, j)])), F.lit(1 << j)).otherwise(F.lit(0)))
            masks.append(mask)

        def widen(acc: Column, _: Column) -> Column:
            def reach(m: Column) -> Column:
                out = m
                for i in range(n):
                    out = out.bitwiseOR(F.when(_bit(m, i), F.get(acc, F.lit(i))).otherwise(F.lit(0)))
                return out

            return F.transform(acc, reach)

        closed = F.aggregate(F.array(*[F.lit(k) for k in range(rounds)]), F.array(*masks), widen)
        ranked = F.transform(closed, lambda m, i: F.struct(F.bit_count(m).alias("size"), (-i).alias("first"), m.alias("mask")))
        return F.array_max(ranked)["mask"]

    return bind(F.array(*present, *edge.values()), largest)


def provider_consensus(
    df: DataFrame,
    titles: dict[str, str],
    years: dict[str, str] | None = None,
    threshold: int = 90,
    year_tolerance: int = 1,
    yearless: tuple[str, ...] = YEARLESS,
    min_providers: int = 3,
    out: str = "consensus",
    norms: dict[str, str] | None = None,
) -> DataFrame:
    """Add a struct ``present, majority, outliers, has_majority``: do most sources name the same thing?

    Two sources agree when their titles score at least ``threshold`` and, unless one is ``yearless`` or has no year,
    their years differ by no more than ``year_tolerance``. NULL below ``min_providers``. ``norms`` names columns that hold the normalised titles already.
    """
    names = sorted(titles)
    years = years or {}
    norm = {p: f"__t_{p}" for p in names}
    normal = {p: F.col(norms[p]) if norms else normalize_title(F.col(titles[p])) for p in names}
    work = df.withColumns({norm[p]: F.when(~is_blank(F.col(titles[p])), normal[p]) for p in names})
    present = [F.col(norm[p]).isNotNull() for p in names]
    scores = {f"__s_{i}_{j}": (norm[a], norm[b]) for (i, a), (j, b) in combinations(enumerate(names), 2)}
    work = with_scores(work, scores)
    edge = {}
    for (i, a), (j, b) in combinations(enumerate(names), 2):
        close = F.lit(True)
        if a in years and b in years and a not in yearless and b not in yearless:
            close = F.coalesce(F.abs(F.col(years[a]) - F.col(years[b])) <= year_tolerance, F.lit(True))
        edge[i, j] = present[i] & present[j] & (F.coalesce(F.col(f"__s_{i}_{j}"), F.lit(0)) >= threshold) & close
    have = compact(*[F.when(present[i], F.lit(p)) for i, p in enumerate(names)])

    def verdict(sets: Column) -> Column:
        here, best = sets["here"], sets["best"]
        n = F.size(here)
        # One source alone forms no group, so it never has a majority.
        has = (n >= 2) & (F.size(best) * 2 > n)
        return F.when(
            n >= min_providers,
            F.struct(
                here.alias("present"),
                F.when(has, best).otherwise(strings(())).alias("majority"),
                F.when(has, F.array_except(here, best)).otherwise(strings(())).alias("outliers"),
                has.alias("has_majority"),
            ),
        )

    members = bind(_largest_component(present, edge), lambda mask: _joined_names(names, mask))
    value = bind(F.struct(have.alias("here"), members.alias("best")), verdict)
    return work.withColumn(out, value).drop(*norm.values(), *scores)


def consensus_tags(c: Column) -> Column:
    """Tags of a consensus struct; an absent consensus has none."""
    agreed = F.array(F.concat(F.lit("provider_consensus:"), F.array_join(c["majority"], "+")))
    outliers = F.transform(c["outliers"], lambda p: F.concat(F.lit("provider_outlier:"), p))
    return (
        F.when(c.isNull(), strings(()))
        .when(c["has_majority"], F.concat(agreed, outliers))
        .otherwise(F.array(F.lit("provider_no_consensus")))
    )


def majority_value(values: Column, min_voters: int = 2) -> Column:
    """Value held by more than half of the non-null voters; NULL without one or with too few voters."""

    def decide(votes: Column) -> Column:
        n = F.size(votes)
        winners = F.filter(votes, lambda v: F.size(F.filter(votes, lambda w: w == v)) * 2 > n)
        return F.when(n >= min_voters, F.get(winners, F.lit(0)))

    return bind(F.array_compact(values), decide)


def year_votes(years: dict[str, str], ignore: tuple[str, ...] = YEARLESS) -> Column:
    voters = [F.col(c) for p, c in years.items() if p not in ignore]
    return F.array_compact(F.array(*voters)) if voters else F.array().cast("array<int>")


def year_outlier_tags(years: dict[str, str], max_diff: int = 1, ignore: tuple[str, ...] = YEARLESS) -> Column:
    """``year_outlier:<p>`` against the strict-majority year, or ``year_no_consensus``; ignored voters can be outliers."""
    votes = year_votes(years, ignore)

    def tags(majority: Column) -> Column:
        outliers = compact(*[tag_if(F.abs(F.col(c) - majority) > max_diff, f"year_outlier:{p}") for p, c in years.items()])
        return F.when(majority.isNull(), F.array(F.lit("year_no_consensus"))).otherwise(outliers)

    return F.when(F.size(votes) < 2, strings(())).otherwise(bind(majority_value(votes), tags))


def _filled_sets(sets: dict[str, str]) -> Column:
    return F.filter(F.array(*[F.coalesce(F.col(c), strings(())) for c in sets.values()]), lambda s: F.size(s) > 0)


def majority_items(filled: Column) -> Column:
    """Items held by more than half of a list of non-empty sets."""
    n = F.size(filled)
    items = F.array_distinct(F.flatten(filled))
    return F.filter(items, lambda b: F.size(F.filter(filled, lambda s: F.array_contains(s, b))) * 2 > n)


def set_outlier_tags(sets: dict[str, str], kind: str) -> Column:
    """``<kind>_outlier:<p>`` for voters sharing nothing with the majority items, or ``<kind>_no_consensus``."""

    def tags(held: Column) -> Column:
        outliers = compact(
            *[
                tag_if((F.size(F.col(c)) > 0) & ~F.arrays_overlap(F.col(c), held), f"{kind}_outlier:{p}")
                for p, c in sets.items()
            ]
        )
        return F.when(F.size(held) == 0, F.array(F.lit(f"{kind}_no_consensus"))).otherwise(outliers)

    return bind(
        _filled_sets(sets), lambda f: F.when(F.size(f) < 2, strings(())).otherwise(bind(majority_items(f), tags))
    )


def intersection(sets: dict[str, str], min_voters: int = 2) -> Column:
    """Items common to all non-empty sets, sorted; empty with too few voters."""

    def common(f: Column) -> Column:
        shared = F.aggregate(f, F.get(f, F.lit(0)), lambda acc, s: F.array_intersect(acc, s))
        return F.when(F.size(f) >= min_voters, F.sort_array(shared)).otherwise(strings(()))

    return bind(_filled_sets(sets), common)


def _company_component(sets: dict[str, Column]) -> tuple[list[str], Column, Column]:
    """(provider names, mask of the largest overlap component, providers with companies)."""
    names = sorted(sets)
    present = [F.size(sets[p]) > 0 for p in names]
    edge = {
        (i, j): present[i] & present[j] & F.arrays_overlap(sets[names[i]], sets[names[j]])
        for i, j in combinations(range(len(names)), 2)
    }
    have = compact(*[F.when(present[i], F.lit(p)) for i, p in enumerate(names)])
    return names, _largest_component(present, edge), have


def company_majority(sets: dict[str, str]) -> Column:
    """Struct ``providers, keys`` of the strict-majority overlap component with a non-empty common part."""
    cols = {p: F.coalesce(F.col(c), strings(())) for p, c in sets.items()}
    names, mask, have = _company_component(cols)
    none = F.struct(strings(()).alias("providers"), strings(()).alias("keys"))

    def decide(best: Column) -> Column:
        members = F.array_compact(F.array(*[F.when(_bit(best, i), cols[p]) for i, p in enumerate(names)]))
        common = bind(
            members, lambda ms: F.sort_array(F.aggregate(ms, F.get(ms, F.lit(0)), lambda acc, s: F.array_intersect(acc, s)))
        )
        agreed = (F.size(have) >= 2) & (F.bit_count(best) * 2 > F.size(have))
        found = bind(
            common,
            lambda keys: F.when(
                F.size(keys) > 0, F.struct(_joined_names(names, best).alias("providers"), keys.alias("keys"))
            ).otherwise(none),
        )
        return F.when(agreed, found).otherwise(none)

    return bind(mask, decide)


def company_tags(sets: dict[str, str], kind: str, min_providers: int = 2) -> Column:
    """``<kind>_disagree`` and ``<kind>_outlier:<p>`` when the overlap graph falls apart; low-signal names ignored.

    With three or more voters a strict-majority component is needed.
    """
    cols = {p: without_low_signal(F.coalesce(F.col(c), strings(()))) for p, c in sets.items()}
    names, mask, have = _company_component(cols)

    def decide(best: Column) -> Column:
        n, size = F.size(have), F.bit_count(best)
        outliers = F.transform(
            F.array_except(have, _joined_names(names, best)), lambda p: F.concat(F.lit(f"{kind}_outlier:"), p)
        )
        split = F.array(F.lit(f"{kind}_disagree"))
        tags = F.when(size * 2 > n, F.concat(split, outliers)).otherwise(split)
        return F.when((n >= min_providers) & (size < n) & ((size * 2 > n) | (n < 3)), tags).otherwise(strings(()))

    return bind(mask, decide)


def _after(tags: Column, prefix: str) -> Column:
    kept = F.filter(tags, lambda t: t.startswith(prefix))
    return F.transform(kept, lambda t: F.substr(t, F.lit(len(prefix) + 1)))


def actionable_tags(
    consensus: Column, years: dict[str, str], year_tags: Column, platform_tags: Column, spread: int = 5
) -> Column:
    """``likely_wrong:<p>`` for title outliers that are also year or platform outliers, ``ambiguous_title_year``."""
    suspects = F.array_union(_after(year_tags, "year_outlier:"), _after(platform_tags, "platform_outlier:"))
    wrong = F.sort_array(F.array_intersect(consensus["outliers"], suspects))
    present_years = F.array_compact(
        F.array(*[F.when(F.array_contains(consensus["present"], p), F.col(c)) for p, c in years.items()])
    )
    apart = (
        (F.size(F.array_distinct(present_years)) >= 2)
        & (F.array_max(present_years) - F.array_min(present_years) >= spread)
        & majority_value(present_years, 1).isNull()
    )
    ambiguous = (F.size(consensus["outliers"]) == 0) & (F.size(consensus["present"]) >= 2) & apart
    tags = F.concat(
        F.transform(wrong, lambda p: F.concat(F.lit("likely_wrong:"), p)),
        F.when(ambiguous, F.array(F.lit("ambiguous_title_year"))).otherwise(strings(())),
    )
    return F.when(F.coalesce(consensus["has_majority"], F.lit(False)), tags).otherwise(strings(()))


def canonical_title(titles: dict[str, str], norms: dict[str, str] | None = None) -> Column:
    """Struct ``title, source, count, sources``: largest group of equal normalised titles, in source preference order.

    ``titles`` maps source to column, most preferred first; ``norms`` names columns that hold the normalised titles already.
    """
    entries = F.array_compact(
        F.array(
            *[
                F.when(
                    ~is_blank(F.col(c)),
                    F.struct(
                        (F.col(norms[src]) if norms else normalize_title(F.col(c))).alias("norm"),
                        F.lit(-i).alias("rank"),
                        F.lit(src).alias("source"),
                        text(F.col(c)).alias("title"),
                    ),
                )
                for i, (src, c) in enumerate(titles.items())
            ]
        )
    )

    def choose(es: Column) -> Column:
        def sized(e: Column) -> Column:
            same = F.filter(es, lambda o: o["norm"] == e["norm"])
            return F.struct(
                F.size(same).alias("count"),
                e["rank"].alias("rank"),
                e["source"].alias("source"),
                e["title"].alias("title"),
                F.sort_array(F.transform(same, lambda o: o["source"])).alias("members"),
            )

        return F.array_max(F.transform(es, sized))

    def shown(best: Column) -> Column:
        return F.struct(
            F.coalesce(best["title"], F.lit("")).alias("title"),
            F.coalesce(best["source"], F.lit("")).alias("source"),
            F.coalesce(best["count"], F.lit(0)).alias("count"),
            F.when(best["count"] >= 2, F.array_join(best["members"], "+")).otherwise("").alias("sources"),
        )

    return bind(bind(entries, choose), shown)


def main_genre(genres: dict[str, str]) -> Column:
    """Struct ``label, sources``: genre shared by most providers (two or more, alphabetical tie), else the first genre.

    ``genres`` maps provider to list column in fallback priority order; labels come from their first mention in it.
    """
    def mentioned(provider: str, c: str) -> Column:
        def entry(g: Column) -> Column:
            return F.struct(normalize_title(g).alias("norm"), g.alias("label"), F.lit(provider).alias("provider"))

        return F.filter(F.transform(clean_list(F.col(c)), entry), lambda m: m["norm"] != "")

    mentions = F.flatten(F.array(*[mentioned(p, c) for p, c in genres.items()]))

    def choose(ms: Column) -> Column:
        def providers(norm: Column) -> Column:
            return F.sort_array(
                F.array_distinct(F.transform(F.filter(ms, lambda m: m["norm"] == norm), lambda m: m["provider"]))
            )

        counted = F.transform(
            F.array_distinct(F.transform(ms, lambda m: m["norm"])),
            lambda n: F.struct((-F.size(providers(n))).alias("fewer"), n.alias("norm")),
        )
        first = F.get(ms, F.lit(0))["norm"]
        best = bind(F.array_min(counted), lambda top: F.when(top["fewer"] <= -2, top["norm"]).otherwise(first))

        def shown(norm: Column) -> Column:
            label = F.get(F.filter(ms, lambda m: m["norm"] == norm), F.lit(0))["label"]
            return F.struct(
                F.coalesce(label, F.lit("")).alias("label"),
                F.coalesce(F.array_join(providers(norm), "+"), F.lit("")).alias("sources"),
            )

        return bind(best, shown)

    return bind(mentions, choose)
