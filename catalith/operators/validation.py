"""Cross-provider validation report: one row of findings per catalog row, all in column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalith.constants import REPORT, ReportConfig
from catalith.functions.company import company_key_set
from catalith.functions.fuzzy import with_scores
from catalith.functions.lists import clean_list, contains_any, is_blank, strings, tag_if, text
from catalith.functions.text import (
    edition_or_port,
    edition_words,
    genre_set,
    has_cyrillic,
    normalize_title,
    platform_report_set,
    report_dlc_like,
    report_series_numbers,
    valid_year,
)
from catalith.operators.consensus import (
    actionable_tags,
    canonical_title,
    company_tags,
    consensus_tags,
    intersection,
    provider_consensus,
    set_outlier_tags,
    year_outlier_tags,
)

PROVIDERS = ("RAWG", "IGDB", "Steam", "HLTB")
YEAR_SOURCE = {"RAWG": "RAWG_Year", "IGDB": "IGDB_Year", "Steam": "Steam_ReleaseYear", "HLTB": "HLTB_ReleaseYear"}
PRESENCE = {
    "RAWG": "RAWG_ID", "IGDB": "IGDB_ID", "Steam": "Steam_AppID", "HLTB": "HLTB_Main", "SteamSpy": "SteamSpy_Owners",
}
CANONICAL_ORDER = ("Steam", "RAWG", "IGDB", "HLTB")


def _lowest_below(scores: dict[str, Column], limit: int) -> Column:
    """Provider with the lowest score when that is below the limit, else blank; ties go to the first provider."""
    entries = F.array_compact(
        F.array(
            *[
                F.when(s.isNotNull(), F.struct(s.alias("s"), F.lit(i).alias("i"), F.lit(p).alias("p")))
                for i, (p, s) in enumerate(scores.items())
            ]
        )
    )
    worst = F.array_min(entries)
    return F.coalesce(F.when(worst["s"] < limit, worst["p"]), F.lit(""))


def _summary(values: dict[str, Column], shown: dict[str, Column]) -> Column:
    """``A:x,y; B:z`` of the entries to show."""
    parts = [F.when(shown[k], F.concat(F.lit(f"{k}:"), v)) for k, v in values.items()]
    return F.array_join(F.array_compact(F.array(*parts)), "; ")


def _yes(cond: Column) -> Column:
    return F.coalesce(cond, F.lit(False))


def validation_report(df: DataFrame, enabled: set[str] | None = None, cfg: ReportConfig = REPORT) -> DataFrame:
    """Findings per row: tags, missing providers, years, editions, series, platforms, genres, ids, culprit, title.

    ``RowId`` is kept next to the report columns when the input has it. What several findings ask for is a column of its own, so that it is computed once per row.
    """
    before = list(df.columns)
    array_none = strings(())

    def col(c: str) -> Column:
        return text(F.col(c)) if c in before else F.lit("")

    def items(c: str) -> Column:
        if c in before and df.schema[c].dataType.typeName() == "array":
            return clean_list(F.col(c))
        return array_none

    base: dict[str, Column] = {"__name": col("Name")}
    for p in PROVIDERS:
        base[f"__n_{p}"] = col(f"{p}_Name")
        base[f"__y_{p}"] = valid_year(col(YEAR_SOURCE[p]))
        base[f"__p_{p}"] = platform_report_set(items(f"{p}_Platforms"))
    base |= {
        "__g_rawg": genre_set(items("RAWG_Genres")),
        "__g_igdb": genre_set(items("IGDB_Genres")),
        "__g_steam": genre_set(items("Steam_Tags")),
    }
    for kind in ("Developers", "Publishers"):
        for p in ("Steam", "RAWG", "IGDB", "Wikidata"):
            base[f"__{kind[:3].lower()}_{p.lower()}"] = company_key_set(items(f"{p}_{kind}"))
    work = df.withColumns(base)
    work = work.withColumns(
        {
            "__nn": normalize_title(F.col("__name")),
            **{f"__nn_{p}": normalize_title(F.col(f"__n_{p}")) for p in PROVIDERS},
        }
    )
    shown = {f"__sn_{p}": F.when(F.col(f"__n_{p}") != "", F.col(f"__nn_{p}")) for p in PROVIDERS}
    work = with_scores(work.withColumns(shown), {f"__sc_{p}": ("__nn", f"__sn_{p}") for p in PROVIDERS})
    low = {p.lower(): p for p in PROVIDERS}
    years = {lo: f"__y_{p}" for lo, p in low.items()}
    work = provider_consensus(work, {lo: f"__n_{p}" for lo, p in low.items()}, years, out="__cons", norms={lo: f"__nn_{p}" for lo, p in low.items()})

    title = {p: F.col(f"__n_{p}") for p in PROVIDERS}
    year = {p: F.col(f"__y_{p}") for p in PROVIDERS}
    score = {p: F.col(f"__sc_{p}") for p in PROVIDERS}
    plat = {p: F.col(f"__p_{p}") for p in PROVIDERS}
    titled = {p: title[p] != "" for p in PROVIDERS}
    platform_sets = {p.lower(): f"__p_{p}" for p in ("RAWG", "IGDB", "Steam")}
    genre_sets = {p: f"__g_{p}" for p in ("rawg", "igdb", "steam")}
    years_at = year_outlier_tags(years, cfg.year_max_diff)
    platforms_at = set_outlier_tags({lo: f"__p_{p}" for lo, p in low.items()}, "platform")
    work = work.withColumns(
        {
            **{f"__ed_{p}": edition_words(F.col(f"__nn_{p}")) for p in PROVIDERS},
            **{f"__sr_{p}": report_series_numbers(F.col(f"__nn_{p}")) for p in PROVIDERS},
            "__dlc": report_dlc_like(title["Steam"], items("Steam_Categories"), F.col("__nn_Steam")),
            "__cp": intersection(platform_sets),
            "__canon": canonical_title({p: f"__n_{p}" for p in CANONICAL_ORDER}, {p: f"__nn_{p}" for p in CANONICAL_ORDER}),
            "__yt": years_at,
            "__pt": platforms_at,
        }
    )
    work = work.withColumn("__cnn", normalize_title(F.col("__canon")["title"]))

    # Editions, series numbers, script.
    editions = {p: F.col(f"__ed_{p}") for p in PROVIDERS}
    edition_sets = F.array(*[F.when(titled[p], F.array_join(editions[p], ",")) for p in PROVIDERS])
    edition_apart = F.size(F.array_distinct(F.array_compact(edition_sets))) >= 2
    series = {p: F.col(f"__sr_{p}") for p in PROVIDERS}
    series_text = {p: F.array_join(series[p].cast("array<string>"), ",") for p in PROVIDERS}
    some_series = {p: F.size(series[p]) > 0 for p in PROVIDERS}
    series_sets = F.array(*[F.when(some_series[p], series_text[p]) for p in PROVIDERS])
    several_series = F.size(F.array_distinct(F.array_compact(series_sets))) >= 2
    non_english = F.lit(False)
    for p in PROVIDERS:
        non_english = non_english | has_cyrillic(title[p])

    # Years.
    limit = cfg.year_max_diff
    primary_apart = _yes(F.abs(year["RAWG"] - year["IGDB"]) > limit)
    primary = F.coalesce(year["IGDB"], year["RAWG"])
    store_year_apart = _yes(F.abs(year["Steam"] - primary) > limit) & ~edition_or_port(title["Steam"], F.col("__nn_Steam"))
    year_diff = year["Steam"] - primary

    # Platforms and genres.
    shown_platforms = {p: F.size(plat[p]) > 0 for p in ("RAWG", "IGDB", "Steam")}
    common_platforms = F.col("__cp")
    voters = sum((F.when(c, 1).otherwise(0) for c in shown_platforms.values()), F.lit(0))
    no_platform = (voters >= 2) & (F.size(common_platforms) == 0)

    # Ids, titles, culprit.
    app, igdb_app = col("Steam_AppID"), col("IGDB_SteamAppID")
    ids_apart = (app != "") & (igdb_app != "") & (app != igdb_app)
    low_score = F.lit(False)
    for p in PROVIDERS:
        low_score = low_score | _yes(score[p] < cfg.title_score_warn)
    store_dlc, canon = F.col("__dlc"), F.col("__canon")
    worst_of = _lowest_below(score, cfg.title_score_warn)
    other_name = (canon["title"] != "") & (F.col("__name") != "") & (F.col("__nn") != F.col("__cnn"))
    work = work.withColumns(
        {"__sa": several_series, "__pa": no_platform, "__ta": low_score, "__worst": worst_of, "__ia": ids_apart, "__ya": primary_apart, "__rn": other_name}
    )
    series_apart, platforms_apart, title_apart, worst, ids_apart, primary_apart, renamed = (
        F.col(c) for c in ("__sa", "__pa", "__ta", "__worst", "__ia", "__ya", "__rn")
    )
    by_id = F.when(worst != "", worst).when(_yes(score["Steam"] >= cfg.title_score_warn), "IGDB").otherwise("Steam")
    browser = F.exists(items("IGDB_Platforms"), lambda x: contains_any(F.lower(x), ("web browser",)))
    by_platform = F.when(browser, "IGDB").otherwise(worst)
    by_year = (
        F.when(_yes(F.abs(year["Steam"] - year["RAWG"]) <= limit), "IGDB")
        .when(_yes(F.abs(year["Steam"] - year["IGDB"]) <= limit), "RAWG")
        .otherwise("RAWG/IGDB")
    )
    culprit = (
        F.when(ids_apart, by_id).when(platforms_apart, by_platform).when(primary_apart, by_year).when(title_apart, worst).otherwise("")
    )
    culprit = F.when(store_dlc, "Steam").when((culprit == "") & series_apart, "RAWG/IGDB/Steam/HLTB").otherwise(culprit)

    # Canonical title, rename and review.
    agreed = canon["count"] >= 2
    strong = (app != "") & (igdb_app != "") & (app == igdb_app)
    rename = renamed & (title_apart | primary_apart | platforms_apart | ids_apart) & (agreed | strong)
    looser = (
        F.when(agreed, F.concat(F.lit("provider consensus ("), canon["sources"], F.lit(")")))
        .when((canon["source"] == "Steam") & (app != ""), "steam appid present")
        .when(ids_apart, "steam appid mismatch")
        .when(title_apart, "title mismatch")
    )
    work = work.withColumn("__why", F.coalesce(F.when(renamed, looser), F.when(store_dlc, "steam looks like dlc/demo"), F.lit("")))
    reason = F.col("__why")
    review = reason != ""

    # Missing providers.
    any_platform = F.concat(*[plat[p] for p in PROVIDERS])
    on_pc = F.array_contains(any_platform, "pc")
    wanted = {p.strip().lower() for p in (enabled or set()) if p.strip()}
    lacking: dict[str, Column] = {}
    for p, c in PRESENCE.items():
        if c not in before or (wanted and p.lower() not in wanted):
            continue
        gone = is_blank(F.col(c).cast("string"))
        lacking[p] = gone & (app != "") if p == "SteamSpy" else gone
    missing_tags = [
        F.when(cond, F.when(F.lit(p == "Steam") & ~on_pc, F.lit(f"missing_ok:{p}")).otherwise(F.lit(f"missing:{p}")))
        for p, cond in lacking.items()
    ]
    store_type = F.lower(col("Steam_StoreType"))

    simple = {
        "title_mismatch": title_apart,
        "year_disagree_rawg_igdb": primary_apart,
        "steam_year_disagree": store_year_apart,
        "platform_disagree": platforms_apart,
        "steam_appid_mismatch": ids_apart,
        "edition_disagree": edition_apart,
        "steam_dlc_like": store_dlc,
        "series_disagree": series_apart,
        "title_non_english": non_english,
        "suggest_rename": rename,
        "needs_review": review,
    }
    flags = [tag_if((store_type != "") & (store_type != "game"), F.concat(F.lit("store_type_not_game:"), store_type))]
    flags += [tag_if(cond, tag) for tag, cond in simple.items()]
    companies = ("steam", "rawg", "igdb", "wikidata")
    tags = F.concat(
        F.array_compact(F.array(*missing_tags, *flags)),
        company_tags({p: f"__dev_{p}" for p in companies}, "developer"),
        company_tags({p: f"__pub_{p}" for p in companies}, "publisher"),
        consensus_tags(F.col("__cons")),
        F.col("__pt"),
        F.col("__yt"),
        set_outlier_tags(genre_sets, "genre"),
        actionable_tags(F.col("__cons"), years, F.col("__yt"), F.col("__pt")),
    )
    missing_names = F.array_compact(F.array(*[F.when(cond, F.lit(p)) for p, cond in lacking.items()])) if lacking else array_none
    report = {
        "Name": F.col("__name"),
        "ValidationTags": F.array_join(tags, ", "),
        "MissingProviders": F.array_join(missing_names, ", "),
        **{f"{p}_Name": title[p] for p in PROVIDERS},
        "Years": _summary({p: year[p].cast("string") for p in PROVIDERS}, {p: year[p].isNotNull() for p in PROVIDERS}),
        "SteamYearDiffVsPrimary": F.coalesce(year_diff.cast("string"), F.lit("")),
        "EditionTokens": _summary(
            {p: F.array_join(editions[p], ",") for p in PROVIDERS}, {p: F.size(editions[p]) > 0 for p in PROVIDERS}
        ),
        "SeriesNumbers": _summary(series_text, some_series),
        "Platforms": _summary({p: F.array_join(plat[p], ",") for p in shown_platforms}, shown_platforms),
        "PlatformIntersection": F.array_join(common_platforms, ", "),
        "Genres": _summary(
            {p: F.array_join(F.col(c), ",") for p, c in genre_sets.items()}, {p: F.size(c) > 0 for p, c in genre_sets.items()}
        ),
        "GenreIntersection": F.array_join(intersection(genre_sets), ", "),
        "SteamAppID": app,
        "IGDB_SteamAppID": igdb_app,
        "SuggestedCulprit": culprit,
        "SuggestedCanonicalTitle": canon["title"],
        "SuggestedCanonicalSource": canon["source"],
        "ReviewTitle": F.when(review, "YES").otherwise(""),
        "ReviewTitleReason": reason,
    }
    keep = ["RowId"] if "RowId" in before else []
    return work.select(*keep, *[v.alias(k) for k, v in report.items()])
