"""Production tiers: lookup with priority, tally of untiered companies, deduplication of the tier map."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalith.constants import TIER_RANK
from catalith.functions.company import fold_key, is_porting_label, normalize_company, wanted_normalized
from catalith.functions.lists import clean_list, text
from catalith.operators.keys import first_n
from catalith.operators.signals import COMPANY_PROVIDERS, Inputs
from catalith.session import materialize
from catalith.sources.registry import Registry
from catalith.sources.tables import tier_dimension


def company_mentions(df: DataFrame, registry: Registry, key: str = "RowId", extra: list[str] | None = None) -> DataFrame:
    """Every company named by a row, publishers before developers and providers in priority order."""
    m = Inputs(df, registry)

    def mentions(kind: str, provider: str, base: int) -> Column:
        def entry(n: Column, i: Column) -> Column:
            return F.struct((i + base).alias("rank"), F.lit(kind).alias("kind"), n.alias("company"))

        return F.transform(clean_list(m(f"{provider}.{kind}s")), entry)

    lists = [
        mentions(kind, p, 100_000 * (len(COMPANY_PROVIDERS) * k + j))
        for k, kind in enumerate(("publisher", "developer"))
        for j, p in enumerate(COMPANY_PROVIDERS)
    ]
    return df.select(key, *(extra or []), F.inline(F.concat(*lists)))


def production_tier(df: DataFrame, tiers: DataFrame, registry: Registry, key: str = "RowId") -> DataFrame:
    """Tier and reason per row that names a company: first non-Unknown tier, else the first Unknown, else ``Unknown``.

    The tier map is left to Spark to broadcast while it is below the broadcast threshold; beyond it the join shuffles.
    """
    named = company_mentions(df, registry, key).withColumn("__n", normalize_company(F.col("company")))
    named = named.withColumn("company_key", fold_key(F.col("__n")))
    looked_up = named.join(tier_dimension(tiers), ["kind", "company_key"], "left")
    tier = F.when(~is_porting_label(F.col("__n")), F.nullif(F.col("tier"), F.lit("")))
    reason = F.concat(F.col("kind"), F.lit(":"), F.coalesce(F.nullif(F.col("tier_label"), F.lit("")), F.col("company")))
    hit = F.struct(F.col("rank"), tier.alias("tier"), reason.alias("reason"))
    found = looked_up.groupBy(key).agg(
        F.min(F.when(tier != "Unknown", hit)).alias("known"), F.min(F.when(tier == "Unknown", hit)).alias("unknown")
    )
    best = F.coalesce("known", "unknown")
    return found.select(
        key, F.coalesce(best["tier"], F.lit("Unknown")).alias("tier"), F.coalesce(best["reason"], F.lit("")).alias("tier_reason")
    )


def with_production_tier(df: DataFrame, tiers: DataFrame, registry: Registry, key: str = "RowId") -> DataFrame:
    found = production_tier(df, tiers, registry, key).withColumnRenamed(key, "__tk")
    names = {"tier": "derived.production.tier", "tier_reason": "derived.production.tier_reason"}
    out = df.join(found, F.col(key) == F.col("__tk"), "left").drop("__tk")
    for c, metric in names.items():
        column = registry.column(metric)
        out = out.withColumn(column, F.nullif(F.col(c), F.lit(""))) if column else out
    return out.drop(*[c for c in names if c not in df.columns])


def collect_tiers(
    mentions: DataFrame,
    tiers: DataFrame | None = None,
    only_missing: bool = False,
    min_count: int = 1,
    max_examples: int = 6,
    include_porting_labels: bool = True,
) -> DataFrame:
    """Tally company mentions: count, first-seen label, first distinct example titles, the tier already given.

    ``mentions``: ``kind, company, title, ord`` with a total order ``ord``. Everything is pre-aggregated or cut
    map-side, so one company in a third of the rows costs no single task. Sorted by count, then first mention.
    """
    # Mentions shrink to distinct raw labels before any name is normalised. Written once: labels and example titles both come out of them.
    raw = mentions.groupBy("kind", text(F.col("company")).alias("company"), text(F.col("title")).alias("title")).agg(
        F.count(F.lit(1)).alias("n"), F.min("ord").alias("ord")
    )
    raw = materialize(raw, "mentions")
    labels = raw.groupBy("kind", "company").agg(F.sum("n").alias("n"), F.min("ord").alias("ord"))
    labels = labels.withColumn("__n", normalize_company(F.col("company"))).withColumn("company_key", fold_key(F.col("__n")))
    wanted = labels.where(
        wanted_normalized(F.col("company"), F.col("__n"), F.col("company_key"), include_porting_labels) & (F.col("company_key") != "")
    )
    # Written once: the tally and the examples both ask for the names, whose accents are folded in Arrow.
    wanted = materialize(wanted, "labels")
    tally = wanted.groupBy("kind", "company_key").agg(
        F.sum("n").alias("n"), F.min("ord").alias("first_ord"), F.min_by("__n", "ord").alias("label")
    )
    named = raw.where("title <> ''").join(wanted.select("kind", "company", "company_key"), ["kind", "company"])
    titles = named.groupBy("kind", "company_key", "title").agg(F.min("ord").alias("ord"))
    few = first_n(titles, ["kind", "company_key"], [F.col("ord").asc()], max_examples)
    examples = few.groupBy("kind", "company_key").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("rank", "title"))), lambda s: s["title"]).alias("examples")
    )
    out = tally.where(F.col("n") >= min_count).join(examples, ["kind", "company_key"], "left")
    if tiers is None:
        out = out.withColumn("tier", F.lit(""))
    else:
        given = tier_dimension(tiers).select("kind", "company_key", "tier")
        out = out.join(given, ["kind", "company_key"], "left").withColumn("tier", F.coalesce("tier", F.lit("")))
    out = out.where(F.col("tier") == "") if only_missing else out.where(F.col("tier") != "") if tiers is not None else out
    return out.select("kind", "label", "tier", F.col("n").alias("mentions"), "examples", "first_ord").orderBy(
        F.desc("mentions"), "kind", "first_ord"
    )


def label_penalty(s: Column) -> Column:
    """Readability order of normalised label variants, least first (fixed weights)."""
    letters = s.rlike(r"\p{L}")
    points = (
        F.when(s == "", 100).otherwise(0)
        + F.when(letters & (F.upper(s) == s), 20).otherwise(0)
        + F.when(letters & (F.lower(s) == s), 5).otherwise(0)
        + F.when(F.contains(s, F.lit("-")), 2).otherwise(0)
        + F.when(s.rlike(r"[\x{10000}-\x{10FFFF}]"), 15).otherwise(0)
        + F.when(F.contains(s, F.lit("🚀")), 10).otherwise(0)
        + F.when(F.contains(s, F.lit("™")), 5).otherwise(0)
        + F.when(F.contains(s, F.lit("®")), 5).otherwise(0)
        + F.length(F.regexp_replace(s, r'[^!?;:"]', "")) * 2
    )
    spaces = F.length(F.regexp_replace(s, "[^ ]", ""))
    ands = F.length(F.regexp_replace(s, "[^&]", ""))
    return F.struct(points.alias("p"), (-F.length(s)).alias("l"), spaces.alias("s"), ands.alias("a"), F.lower(s).alias("t"))


def dedupe_tiers(tiers: DataFrame) -> DataFrame:
    """One row per company key: most readable label, best tier, and whether labels merged or tiers conflicted."""
    rank = F.create_map(*[x for t, r in TIER_RANK.items() for x in (F.lit(t), F.lit(r))])
    keyed = tiers.where(text(F.col("tier")).isin(*TIER_RANK)).select(
        "kind", "label", text(F.col("tier")).alias("tier"), normalize_company(F.col("label")).alias("__n")
    ).withColumn("company_key", fold_key(F.col("__n"))).where("company_key <> ''")
    return keyed.groupBy("kind", "company_key").agg(
        F.min_by("label", F.struct(label_penalty(F.col("__n")).alias("p"), F.col("label").alias("raw"))).alias("label"),
        F.max_by("tier", F.try_element_at(rank, F.col("tier"))).alias("tier"),
        (F.min("label") != F.max("label")).alias("merged"),
        (F.min("tier") != F.max("tier")).alias("conflict"),
    )
