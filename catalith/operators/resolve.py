"""Pin repair: clear pins that most sources contradict, find a better query, match again, then repin or unpin."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalith.constants import NOT_FOUND
from catalith.functions.fuzzy import with_fuzzy_scores
from catalith.functions.lists import clean_list, is_blank, text
from catalith.functions.parse import is_yes
from catalith.functions.text import row_year_hint, valid_year
from catalith.operators.consensus import majority_value, provider_consensus
from catalith.operators.diagnostics import add_tag, split_tags

PIN_OF = {"steam": "Steam_AppID", "rawg": "RAWG_ID", "igdb": "IGDB_ID", "hltb": "HLTB_ID"}
LABEL_OF = {"steam": "Steam", "rawg": "RAWG", "igdb": "IGDB", "hltb": "HLTB"}
DIAGNOSTICS_OF = {
    "steam": ("Steam_MatchedName", "Steam_MatchScore", "Steam_MatchedYear", "Steam_RejectedReason"),
    "rawg": ("RAWG_MatchedName", "RAWG_MatchScore", "RAWG_MatchedYear"),
    "igdb": ("IGDB_MatchedName", "IGDB_MatchScore", "IGDB_MatchedYear"),
    "hltb": ("HLTB_MatchedName", "HLTB_MatchScore", "HLTB_MatchedYear", "HLTB_MatchedPlatforms"),
}
RESOLVED = ("steam", "rawg", "igdb")


def contradicted(tags: Column, provider: str) -> Column:
    """Whether tags say: most sources agree, this one is the outlier and likely wrong."""
    agreed = F.exists(tags, lambda t: t.startswith("provider_consensus:"))
    return (
        agreed
        & F.array_contains(tags, f"provider_outlier:{provider}")
        & F.array_contains(tags, f"likely_wrong:{provider}")
    )


def cleared(df: DataFrame, provider: str, cond: Column) -> dict[str, Column]:
    """Pin and diagnostics of one provider blanked where ``cond`` holds."""
    return {
        c: F.when(cond, F.lit(None).cast(df.schema[c].dataType)).otherwise(F.col(c))
        for c in (PIN_OF[provider], *DIAGNOSTICS_OF[provider])
        if c in df.columns
    }


def auto_unpin(df: DataFrame) -> DataFrame:
    """Clear pins that the row's own tags contradict; tag them, set confidence LOW and add ``__unpinned``."""
    work = df.withColumn("__tags", split_tags(F.col("ReviewTags")))
    wrong = {}
    for p, pin in PIN_OF.items():
        if pin in df.columns:
            pinned = ~is_blank(F.col(pin)) & (text(F.col(pin)) != NOT_FOUND) & ~is_blank(F.col("RowId"))
            wrong[p] = pinned & contradicted(F.col("__tags"), p)
    work = work.withColumns({f"__w_{p}": c for p, c in wrong.items()})
    changes: dict[str, Column] = {}
    tags, any_wrong = F.col("__tags"), F.lit(False)
    for p in wrong:
        hit = F.col(f"__w_{p}")
        changes |= cleared(df, p, hit)
        tags = F.when(hit, add_tag(tags, f"autounpinned:{p}")).otherwise(tags)
        any_wrong = any_wrong | hit
    changes["ReviewTags"] = F.array_join(tags, ", ")
    changes["MatchConfidence"] = F.when(any_wrong, "LOW").otherwise(F.col("MatchConfidence"))
    changes["__unpinned"] = F.filter(F.array(*[F.when(F.col(f"__w_{p}"), F.lit(p)) for p in wrong]), lambda x: x.isNotNull())
    return work.withColumns(changes).drop("__tags", *[f"__w_{p}" for p in wrong])


def with_majority(df: DataFrame) -> DataFrame:
    """Add ``majority_title`` (the majority's title nearest to the user's name) and ``majority_year``."""
    names = {p: f"{LABEL_OF[p]}_MatchedName" for p in LABEL_OF} | {"wikidata": "Wikidata_MatchedLabel"}
    year_cols = {p: f"{LABEL_OF[p]}_MatchedYear" for p in LABEL_OF} | {"wikidata": "Wikidata_MatchedYear"}
    base = {f"__t_{p}": text(F.col(c)) if c in df.columns else F.lit("") for p, c in names.items()}
    base |= {
        f"__y_{p}": valid_year(F.col(c).cast("string")) if c in df.columns else F.lit(None).cast("int")
        for p, c in year_cols.items()
    }
    work = df.withColumns(base)
    years = {p: f"__y_{p}" for p in names}
    titles = {p: f"__t_{p}" for p in names}
    # provider_consensus keeps its own scratch names, so titles go in under distinct ones.
    work = work.withColumnsRenamed({t: f"__title_{p}" for p, t in titles.items()})
    titles = {p: f"__title_{p}" for p in names}
    work = provider_consensus(work, titles, years, min_providers=2, out="__cons")
    scores = {f"__s_{p}": ("Name", titles[p]) for p in names}
    work = with_fuzzy_scores(work, scores)

    def member(p: str) -> Column:
        return F.array_contains(F.col("__cons.majority"), p) & (F.col(titles[p]) != "")

    ranked = F.array_compact(
        F.array(
            *[
                F.when(
                    member(p),
                    F.struct(F.col(f"__s_{p}").alias("s"), F.lit(-i).alias("o"), F.col(titles[p]).alias("title")),
                )
                for i, p in enumerate(sorted(names))
            ]
        )
    )
    votes = F.array(*[F.when(member(p), F.col(years[p])) for p in names if p != "steam"])
    found = F.coalesce(F.col("__cons.has_majority"), F.lit(False))
    work = work.withColumns(
        {
            "majority_title": F.when(found, F.array_max(ranked)["title"]),
            "majority_year": F.when(found, majority_value(votes)),
        }
    )
    return work.drop("__cons", *titles.values(), *years.values(), *scores)


def retry_query(rows: DataFrame, titles: list[Column], target: Column, key: str = "RowId", out: str = "retry_query") -> DataFrame:
    """Best search text per row among candidate titles: nearest to the target, shorter on ties.

    ``titles`` are list columns in order of trust. The few titles of a row are scored as exploded rows and reduced by a
    pre-aggregated maximum. Result: ``key, out``; rows without any title are absent.
    """
    listed = F.concat(*[clean_list(c) for c in titles])
    opened = rows.select(key, target.alias("__target"), F.posexplode(listed).alias("pos", "title"))
    scored = with_fuzzy_scores(opened, {"s": ("__target", "title")})
    order = F.struct("s", (-F.length("title")).alias("l"), (-F.col("pos")).alias("p"), "title")
    return scored.groupBy(key).agg(F.max(order)["title"].alias(out))


def retry_targets(df: DataFrame, providers: tuple[str, ...] = RESOLVED, retry_missing: bool = False) -> DataFrame:
    """Pins to try again, one row per (row, provider) with the reason; expects ``majority_title`` of the row."""
    tags = split_tags(F.col("ReviewTags"))
    active = df.where(~is_yes(F.col("Disabled"))) if "Disabled" in df.columns else df
    active = active.where(F.col("majority_title").isNotNull()).withColumn("__tags", tags)
    reasons = []
    for p in providers:
        pin = text(F.col(PIN_OF[p]))
        reason = (
            F.when((pin != "") & contradicted(F.col("__tags"), p), "fix_wrong_pin")
            .when(F.array_contains(F.col("__tags"), f"autounpinned:{p}") & (pin == ""), "fill_after_unpin")
            .when(F.lit(retry_missing) & (pin == ""), "fill_missing")
        )
        reasons.append(F.struct(F.lit(p).alias("provider"), reason.alias("reason")))
    return active.select("RowId", "Name", "majority_title", "majority_year", F.inline(F.array(*reasons))).where("reason is not null")


def plan_actions(targets: DataFrame, found: DataFrame) -> DataFrame:
    """Decide each target: ``repin`` when the new match is near the majority in title or year, else ``unpin`` or ``keep``.

    ``found``: ``RowId, provider, new_id, new_name, new_year`` for targets whose retry matched something. An unknown
    year counts as near.
    """
    joined = targets.join(found, ["RowId", "provider"], "left").withColumn(
        "__goal", F.coalesce(F.nullif(F.col("majority_title"), F.lit("")), F.col("Name"))
    )
    named = ~is_blank(F.col("new_name"))
    joined = with_fuzzy_scores(joined, {"__near": ("__goal", "new_name"), "__own": ("Name", "new_name")})
    score = F.when(named, F.col("__near")).otherwise(0)
    year = valid_year(F.col("new_year").cast("string"))
    near = F.coalesce(F.abs(year - F.col("majority_year")) <= 1, F.lit(True))
    repin = F.col("new_id").isNotNull() & ((score >= 90) | near)
    own_score = F.when(named, F.col("__own"))
    return joined.select(
        "RowId",
        "provider",
        "reason",
        F.when(repin, "repin").when(F.col("reason") == "fix_wrong_pin", "unpin").otherwise("keep").alias("action"),
        F.when(repin, F.col("new_id")).alias("new_id"),
        F.when(repin, F.col("new_name")).alias("new_name"),
        F.when(repin, F.col("new_year").cast("string")).alias("new_year"),
        F.when(repin, own_score).alias("new_score"),
    )


def apply_actions(df: DataFrame, actions: DataFrame, hints: DataFrame | None = None) -> DataFrame:
    """Write repins, unpins and entity hints into the catalog: actions are pivoted to one row per catalog row first."""
    detail = F.struct("action", "new_id", "new_name", "new_year", "new_score")
    wide = actions.groupBy(F.col("RowId").alias("__rk")).agg(
        *[F.max(F.when(F.col("provider") == p, detail)).alias(f"__a_{p}") for p in RESOLVED]
    )
    work = df.join(wide, F.col("RowId") == F.col("__rk"), "left").drop("__rk")
    tags = split_tags(F.col("ReviewTags"))
    changes: dict[str, Column] = {}
    if hints is not None:
        work = work.join(hints.select(F.col("RowId").alias("__hk"), F.col("qid").alias("__qid")), F.col("RowId") == F.col("__hk"), "left")
        hinted = F.col("__qid").isNotNull() & is_blank(F.col("Wikidata_QID"))
        changes["Wikidata_QID"] = F.when(hinted, F.col("__qid")).otherwise(F.col("Wikidata_QID"))
        tags = F.when(hinted, add_tag(tags, "wikidata_hint")).otherwise(tags)
    for p in RESOLVED:
        a = F.col(f"__a_{p}")
        label = LABEL_OF[p]
        repin, unpin = F.coalesce(a["action"] == "repin", F.lit(False)), F.coalesce(a["action"] == "unpin", F.lit(False))
        new = {
            PIN_OF[p]: a["new_id"],
            f"{label}_MatchedName": a["new_name"],
            f"{label}_MatchScore": a["new_score"],
            f"{label}_MatchedYear": a["new_year"],
        }
        for c, wiped in cleared(df, p, unpin | repin).items():
            value = new.get(c)
            kept = wiped if value is None else F.when(repin, value.try_cast(df.schema[c].dataType.simpleString())).otherwise(wiped)
            changes[c] = kept
        tags = F.when(repin, add_tag(tags, f"repinned_by_resolve:{p}")).when(unpin, add_tag(tags, f"autounpinned:{p}")).otherwise(tags)
    changes["ReviewTags"] = F.array_join(tags, ", ")
    return work.withColumns(changes).select(*df.columns)


def resolve_stats(actions: DataFrame, hints: DataFrame | None = None) -> DataFrame:
    """One row of counts: attempted, repinned, unpinned, kept, hints added."""
    counts = actions.agg(
        F.count(F.lit(1)).alias("attempted"),
        F.count_if(F.col("action") == "repin").alias("repinned"),
        F.count_if(F.col("action") == "unpin").alias("unpinned"),
        F.count_if(F.col("action") == "keep").alias("kept"),
    )
    added = hints.agg(F.count(F.lit(1)).alias("wikidata_hint_added")) if hints is not None else None
    zero = F.lit(0).cast("bigint").alias("wikidata_hint_added")
    if added is None:
        return counts.select("*", zero)
    both = counts.select("*", zero).unionByName(added, allowMissingColumns=True)
    return both.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in both.columns])


def search_year(columns: list[str]) -> Column:
    """Year to search with: the majority's, else the row's own hint."""
    return F.coalesce(F.col("majority_year"), row_year_hint(columns))
