"""Per-provider selection rules over candidate tables.

Inputs: ``queries(row_id, name, year_hint)`` and ``hits(query, pos, id, ..)``, the stored search results keyed by query
text; or ``hits(row_id, pos, id, ..)``, results keyed by the row that asked. Each selector ends in one aggregate per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from catalith.constants import MATCHING, MatchConfig
from catalith.functions.fuzzy import with_fuzzy_scores
from catalith.functions.lists import text
from catalith.functions.parse import leading_year, year_from_epoch
from catalith.functions.text import (
    adds_tokens,
    base_of_subtitle,
    describes_game,
    describes_other_media,
    describes_unwanted,
    has_other_number,
    has_series_number,
    match_series_numbers,
    non_year_numbers,
    normalize_title,
    plain_words,
    provider_dlc_like,
    query_variants,
    store_has_series_number,
    strip_edition_phrases,
    strip_edition_tokens,
    strip_trailing_year,
    tokens,
    valid_instance,
    year_in_text,
)
from catalith.operators.keys import first_n
from catalith.operators.matching import best_per_group, once_per_pair, pick_best, preference, rank_key, score_candidates
from catalith.session import materialize


def _is_dlc(title: Column) -> Column:
    return provider_dlc_like(tokens(normalize_title(title)))


def _near(year: Column, hint: Column, tolerance: int) -> Column:
    return hint.isNotNull() & year.isNotNull() & (F.abs(year - hint) <= tolerance)


def search_hits(queries: DataFrame, hits: DataFrame, term: str = "term", by_row: bool = False) -> DataFrame:
    """Candidates of each query row: an equi-join on the row that asked where hits name it, which spreads like the rows; else on the search text.

    With ``by_row`` they are shuffled by the row that asked, to be laid out by it (see :func:`materialize`).
    """
    if "query" not in hits.columns:
        return queries.join(hits.hint("merge") if by_row else hits, "row_id")
    found = queries.join(hits.withColumnRenamed("query", "__query"), F.col(term) == F.col("__query")).drop("__query")
    return found.repartition("row_id") if by_row else found


def with_name_predicates(df: DataFrame, name: str = "cand_name", term: str = "term") -> DataFrame:
    """Add the title predicates of a filter chain: exact, unnumbered, not an add-on, asked for as an add-on, same numbers."""
    norm = df.withColumns({"__q": normalize_title(F.col(term)), "__c": normalize_title(F.col(name))})
    q, c = F.col("__q"), F.col("__c")
    q_nums, q_text = non_year_numbers(q), plain_words(q)
    has_nums = F.size(F.array_except(q_nums, non_year_numbers(c))) == 0
    shares_word = (F.size(q_text) == 0) | F.arrays_overlap(q_text, plain_words(c))
    return norm.withColumns(
        {
            "p_exact": c == q,
            "p_unnumbered": (q == "") | has_series_number(q) | ~has_series_number(c),
            "p_base": provider_dlc_like(tokens(q)) | ~provider_dlc_like(tokens(c)),
            "p_addon": provider_dlc_like(tokens(q)),
            "p_numbers": ~has_other_number(q) | (F.size(q_nums) == 0) | (has_nums & shares_word),
        }
    ).drop("__q", "__c")


def rawg_terms(queries: DataFrame) -> DataFrame:
    """Texts that RAWG is searched with: the title, and the text before its colon."""
    stripped = strip_trailing_year(F.col("name"))
    terms = queries.withColumn("__terms", F.array_compact(F.array(stripped, base_of_subtitle(stripped))))
    return terms.select("*", F.posexplode("__terms").alias("term_no", "term")).drop("__terms")


def select_rawg(queries: DataFrame, hits: DataFrame, cfg: MatchConfig = MATCHING, legacy_tiebreak: bool = False) -> DataFrame:
    """RAWG rule: exact, unnumbered, non-add-on, near year, same numbers; then ranking.

    ``hits``: ``query, pos, id, cand_name, released``. The text before a colon is tried too when the full title scores
    below the minimum. Result: ``row_id, id, cand_name, score`` for accepted rows.
    """
    cand = search_hits(rawg_terms(queries), hits).withColumn("cand_year", leading_year(F.col("released"))).drop("name", "released")
    near = _near(F.col("cand_year"), F.col("year_hint"), cfg.year_tolerance)
    best = pick_best(
        cand,
        ["row_id", "term_no", "term"],
        "term",
        "cand_name",
        "id",
        ["id", "cand_name"],
        "year_hint",
        "cand_year",
        [F.col("p_exact"), F.col("p_unnumbered"), F.col("p_base"), near, F.col("p_numbers")],
        legacy_tiebreak,
        "pos",
        judge=with_name_predicates,
    )
    starts = F.startswith(normalize_title(F.col("cand_name")), normalize_title(F.col("term")))
    lifted = (F.col("score") < cfg.min_score) & starts & (F.size(non_year_numbers(normalize_title(F.col("term")))) > 0)
    best = best.withColumn("score", F.when(lifted, cfg.min_score).otherwise(F.col("score")))
    accepted_first = (F.col("term_no") == 0) & (F.col("score") >= cfg.min_score)
    order = [accepted_first.alias("a"), F.col("score").alias("b"), (-F.col("term_no")).alias("c")]
    return best_per_group(best, ["row_id"], order, ["id", "cand_name", "score"]).where(F.col("score") >= cfg.min_score)


def igdb_terms(queries: DataFrame) -> DataFrame:
    """The text that IGDB is searched with: the title without its year."""
    return queries.withColumn("term", strip_trailing_year(F.col("name")))


def year_window(year_hint: Column, released_seconds: Column) -> Column:
    """Release between 1 January of the year before the hint and 31 December of the year after."""
    year = year_from_epoch(released_seconds)
    return year_hint.isNotNull() & year.between(year_hint - 1, year_hint + 1)


def select_igdb(queries: DataFrame, hits: DataFrame, cfg: MatchConfig = MATCHING, legacy_tiebreak: bool = False) -> DataFrame:
    """IGDB rule: release window first, then exact, main category, unnumbered, non-add-on, near year; then ranking.

    ``hits``: ``query, pos, id, cand_name, first_release_date (seconds), category``.
    """
    cand = search_hits(igdb_terms(queries), hits).withColumn("cand_year", year_from_epoch(F.col("first_release_date")))
    main = F.col("p_addon") | F.coalesce(F.col("category").cast("string") == "0", F.lit(True))
    best = pick_best(
        cand,
        ["row_id"],
        "term",
        "cand_name",
        "id",
        ["id", "cand_name"],
        "year_hint",
        "cand_year",
        [
            year_window(F.col("year_hint"), F.col("first_release_date")),
            F.col("p_exact"),
            main,
            F.col("p_unnumbered"),
            F.col("p_base"),
            _near(F.col("cand_year"), F.col("year_hint"), cfg.year_tolerance),
        ],
        legacy_tiebreak,
        "pos",
        judge=with_name_predicates,
    )
    return best.where(F.col("score") >= cfg.min_score).select("row_id", "id", "cand_name", "score")


def _store_texts(name: Column, year_hint: Column) -> Column:
    stripped = strip_trailing_year(name)
    dated = F.when(year_hint.isNotNull(), F.concat(stripped, F.lit(" "), year_hint.cast("string")))
    return F.array_distinct(F.array_compact(F.array(stripped, strip_edition_phrases(stripped), text(name), dated)))


def store_terms(queries: DataFrame) -> DataFrame:
    """Texts that the store is searched with: the title without year, without edition words, as it is, and with the hinted year."""
    texts = _store_texts(F.col("name"), F.col("year_hint"))
    return queries.withColumn("query_text", strip_trailing_year(F.col("name"))).select("*", F.posexplode(texts).alias("term_no", "term"))


def _store_judged(pairs: DataFrame) -> DataFrame:
    """What the store rule asks of a title and a candidate's: the preference code, the year, add-on words and whether series numbers differ."""
    pairs = pairs.withColumns(
        {
            "__q": normalize_title(F.col("query_text")),
            "__c": normalize_title(F.col("cand_name")),
            "__base": normalize_title(strip_edition_phrases(F.col("query_text"))),
            "__bare": strip_edition_tokens(F.col("query_text")),
        }
    )
    q, c, bare = F.col("__q"), F.col("__c"), F.col("__bare")
    same_base = (
        (bare != "")
        & ~store_has_series_number(bare)
        & (F.coalesce(F.col("cand_name"), F.lit("")) != "")
        & (strip_edition_tokens(F.col("cand_name")) == bare)
        & ~store_has_series_number(c)
    )
    pairs = pairs.withColumns({"query_dlc": provider_dlc_like(tokens(q)), "cand_dlc": provider_dlc_like(tokens(c)), "cand_year": year_in_text(F.col("cand_name"))})
    return pairs.withColumns(
        {
            "code": preference(c == q, c == F.col("__base"), same_base, F.col("query_dlc") | ~F.col("cand_dlc")),
            "other_number": match_series_numbers(q) != match_series_numbers(c),
        }
    ).drop("__q", "__c", "__base", "__bare")


def _detail_facts(details: DataFrame) -> DataFrame:
    """What the store rule asks of an app's details, found once per app."""
    return details.select(
        F.col("id").alias("__id"), "d_name", F.lower(text(F.col("d_type"))).alias("d_kind"), _is_dlc(F.col("d_name")).alias("d_dlc"), year_in_text(F.col("d_date")).alias("d_year")
    )


def _same_id(left: DataFrame, facts: DataFrame) -> Column:
    """Ids of one type meet as they are, so that rows that lie by their id stay there; else as text."""
    a, b = F.col("id"), F.col("__id")
    alike = left.schema["id"].dataType == facts.schema["__id"].dataType and left.schema["id"].dataType.typeName() in ("integer", "long", "string")
    return a == b if alike else a.cast("string") == b.cast("string")


def select_store(
    queries: DataFrame,
    hits: DataFrame,
    details: DataFrame,
    packages: DataFrame | None = None,
    cfg: MatchConfig = MATCHING,
    legacy_tiebreak: bool = False,
) -> DataFrame:
    """Store rule with a second look at details.

    ``hits``: ``query, pos, id, cand_name, cand_type``; ``details``: ``id, d_name, d_type, d_date``, one row per id;
    ``packages``: ``package_id, pos, app_id``. The first search term with apps counts. The pick is re-ranked among at
    most ten candidates by their details when it looks suspicious, and refused when it is no game in the end. Result:
    ``row_id, id, cand_name, score, release_year, rejected_reason``; refused rows keep the reason and no id.
    """
    facts = _detail_facts(details)
    kind = F.lower(text(F.col("cand_type")))
    told = hits.withColumns({"app": kind.isin("", "app", "game") & (text(F.col("id")) != ""), "sub": kind == "sub"}).where("app or sub").drop("cand_type")
    # Hits meet their details before they meet the searches, so the rows, once laid out by search, are not shuffled again. Hits of a hot app stream past it.
    told = told.join(facts.hint("shuffle_hash"), _same_id(told, facts), "left").withColumn("listed", F.col("__id").isNotNull()).drop("__id")
    if "query" in hits.columns:
        asked = store_terms(queries).select("row_id", "name", "year_hint", "query_text", "term_no", "term")
    else:  # every term finds the hits of its row, so the first one has them all
        asked = queries.select("row_id", "name", "year_hint", strip_trailing_year(F.col("name")).alias("query_text"), F.lit(0).alias("term_no"))
    found = materialize(search_hits(asked, told, by_row=True), "store-found", "row_id")
    cand = found.where("app")
    if "query" in hits.columns:
        first_term = cand.groupBy("row_id").agg(F.min("term_no").alias("__first"))
        cand = cand.join(first_term, "row_id").where(F.col("term_no") == F.col("__first")).drop("__first")

    scored = score_candidates(cand, "query_text", "cand_name", "year_hint", "cand_year", judge=_store_judged, source=found.where("app"))
    scored = scored.withColumn("score", F.col("m_adjusted"))
    order = [F.col("code").alias("k_code"), *rank_key("cand_name", "id", F.col("pos"), legacy_tiebreak=legacy_tiebreak)]
    keys = ["row_id", "query_text", "year_hint"]
    facts_of_pick = ["query_dlc", "cand_dlc", "other_number", "listed", "d_kind", "d_dlc", "d_year"]
    best = best_per_group(scored, keys, order, ["id", "cand_name", "code", "score", *facts_of_pick])
    valid_game = F.when(~F.col("query_dlc"), F.col("listed") & (F.col("d_kind") == "game") & ~F.col("d_dlc"))
    must = ~F.coalesce(valid_game, F.lit(True))
    suspicious = (
        F.col("year_hint").isNotNull()
        | (F.col("score") < cfg.suspicious_score)
        | (F.col("cand_dlc") & ~F.col("query_dlc"))
        | must
        | F.col("other_number")
    )
    # Written once: the second look, the choice and the packages start from the first picks.
    first = materialize(best.withColumns({"must": must, "suspicious": suspicious}), "store-first", "row_id")

    tops = first.where("suspicious").select("row_id", F.col("code").alias("top_code")).hint("shuffle_hash")
    looked = scored.select("row_id", "query_text", "year_hint", "id", "pos", "code", "query_dlc", "listed", "d_name", "d_kind", "d_dlc", "d_year")
    # A range, since equal codes would become a key of the join, by which the rows do not lie.
    survivors = looked.join(tops, "row_id").where(F.col("code").between(F.col("top_code"), F.col("top_code")))
    sample = first_n(survivors, ["row_id"], [F.col("pos").asc()], cfg.refine_candidates)
    sampled = sample.where(F.col("listed") & (F.col("d_kind") == "game") & (F.col("query_dlc") | ~F.col("d_dlc")))
    second = pick_best(
        sampled, ["row_id"], "query_text", "d_name", "id", ["id", "d_name", "d_dlc", "d_year"], "year_hint", "d_year",
        legacy_tiebreak=legacy_tiebreak, pos="pos", source=found.where("app and listed and d_kind = 'game'"),
    ).select("row_id", F.struct("id", F.col("d_name").alias("cand_name"), "score", "d_dlc", "d_year").alias("other"))

    score2 = F.col("other.score")
    swap = F.coalesce((score2 >= cfg.min_score) & (F.col("must") | (score2 >= F.greatest("score", F.lit(cfg.min_score)))), F.lit(False))

    def pick(name: str, other: Column) -> Column:
        return F.when(F.col("swap"), other).otherwise(F.col(name)).alias(name)

    chosen = first.join(second, "row_id", "left").withColumn("swap", swap).select(
        "row_id",
        "query_dlc",
        *[pick(c, F.col(f"other.{c}")) for c in ("id", "cand_name", "score", "d_dlc", "d_year")],
        pick("cand_dlc", F.col("other.d_dlc")),
        pick("listed", F.lit(True)),
        pick("d_kind", F.lit("game")),
    )
    reason = F.when(
        ~F.col("query_dlc"),
        F.when(~F.col("listed"), "details_missing")
        .when((F.col("d_kind") != "") & (F.col("d_kind") != "game"), F.concat(F.lit("type_"), F.col("d_kind")))
        .when(F.col("d_dlc") | F.col("cand_dlc"), "dlc_like"),
    )
    reason = F.coalesce(reason, F.when(F.col("score") < cfg.min_score, "low_score"))
    chosen = chosen.withColumn("reason", reason)
    result = chosen.select(
        "row_id",
        *[F.when(F.col("reason").isNull(), F.col(c)).alias(out) for c, out in (("id", "id"), ("cand_name", "cand_name"), ("score", "score"), ("d_year", "release_year"))],
        F.coalesce("reason", F.lit("")).alias("rejected_reason"),
    )
    if packages is None:
        return result
    subs = found.where("sub").select("row_id", "name", "query_text", "year_hint", "term_no", "pos", "id").join(first.select("row_id"), "row_id", "left_anti")
    if "query" not in hits.columns:
        subs = subs.drop("term_no").select("*", F.posexplode(_store_texts(F.col("name"), F.col("year_hint"))).alias("term_no", "__term")).drop("__term")
    return result.unionByName(expand_packages(subs, packages, facts, cfg).withColumn("rejected_reason", F.lit("")))


def expand_packages(subs: DataFrame, packages: DataFrame, facts: DataFrame, cfg: MatchConfig = MATCHING) -> DataFrame:
    """Package hits to member apps: ten packages, ten apps, games only, best by title and release year."""
    few = first_n(subs, ["row_id"], [F.col("term_no").asc(), F.col("pos").asc()], cfg.package_limit, "package_no")
    members = few.select("row_id", "query_text", "year_hint", "package_no", F.col("id").cast("string").alias("package_id")).join(
        packages.select(F.col("package_id").cast("string").alias("package_id"), F.col("pos").alias("app_pos"), "app_id"), "package_id"
    )
    once = members.groupBy("row_id", "query_text", "year_hint", F.col("app_id").cast("string").alias("id")).agg(
        F.min(F.struct("package_no", "app_pos")).alias("first_seen")
    )
    tried = first_n(once, ["row_id"], [F.col("first_seen").asc()], cfg.refine_candidates, "app_no")
    games = tried.join(facts, F.col("id") == F.col("__id").cast("string")).where(F.col("d_kind") == "game")
    best = pick_best(
        games, ["row_id"], "query_text", "d_name", "id", ["id", "d_name", "d_year"], "year_hint", "d_year", pos="app_no"
    )
    return best.where(F.col("score") >= cfg.min_score).select(
        "row_id", "id", F.col("d_name").alias("cand_name"), "score", F.col("d_year").alias("release_year")
    )


def playtime_terms(queries: DataFrame) -> DataFrame:
    """Texts that the playtime site is searched with, in trial order; lower and upper case are marked as ``cased``."""
    src = queries if "query" in queries.columns else queries.withColumn("query", F.col("name"))
    base = F.coalesce(F.nullif(text(F.col("query")), F.lit("")), text(F.col("name")))
    plain = query_variants(base)
    cased = F.array_except(F.array(F.lower(base), F.upper(base)), plain)
    variants = F.concat(
        F.transform(plain, lambda v, i: F.struct(v.alias("term"), i.alias("no"), F.lit(False).alias("cased"))),
        F.transform(cased, lambda v, i: F.struct(v.alias("term"), (i + 1000).alias("no"), F.lit(True).alias("cased"))),
    )
    return src.select("row_id", F.col("name").alias("__name"), F.inline(variants))


def select_playtime(queries: DataFrame, hits: DataFrame, cfg: MatchConfig = MATCHING) -> DataFrame:
    """Playtime-site rule: query variants in order, raw score against the title, stop at the first variant reaching 95.

    ``queries`` may carry ``query`` (the search text to vary) next to ``name``; ``hits``: ``query, pos, id, cand_name``.
    Lower- and upper-case variants count only when no other variant found anything.
    """
    found = search_hits(playtime_terms(queries), hits)
    cand = once_per_pair(found, ["__name", "cand_name"], lambda pairs: with_fuzzy_scores(pairs, {"score": ("__name", "cand_name")}))
    hit = (F.col("score") >= cfg.early_stop_score) & ~F.col("cased")
    order = [
        (~F.col("cased")).alias("plain"),
        hit.alias("hit"),
        F.when(hit, -F.col("no")).otherwise(0).alias("first_hit"),
        F.col("score").alias("s"),
        (-F.col("no")).alias("variant"),
        (-F.col("pos")).alias("p"),
    ]
    return best_per_group(cand, ["row_id"], order, ["id", "cand_name", "score", "term"]).where(
        F.col("score") >= cfg.min_score
    )


def _entity_tries(term: Column) -> Column:
    """A title's searches: itself, then with a "video game" suffix."""
    suffixes = F.array(
        F.struct(F.lit(1).alias("no"), F.concat(term, F.lit(" video game")).alias("t")),
        F.struct(F.lit(2).alias("no"), F.concat(term, F.lit(" (video game)")).alias("t")),
    )
    own = F.array(F.struct(F.lit(0).alias("no"), term.alias("t")))
    return F.when(F.contains(F.lower(term), F.lit("video game")), own).otherwise(F.concat(own, suffixes))


def entity_terms(queries: DataFrame) -> DataFrame:
    """Texts that the knowledge base is searched with: the title, then with a "video game" suffix."""
    return queries.select("row_id", "year_hint", F.inline(_entity_tries(text(F.col("name")))).alias("term_no", "term"))


def select_entity(
    queries: DataFrame, hits: DataFrame, instances: DataFrame, cfg: MatchConfig = MATCHING, legacy_tiebreak: bool = False
) -> DataFrame:
    """Knowledge-base rule: game descriptions first, no extra words when unsure, other media only with game evidence.

    ``hits``: ``query, pos, id, label, description``; ``instances``: ``id, instance_of (list), description``. Titles
    without an accepted match are tried again with a "video game" suffix.
    """
    inst = text(F.array_join("instance_of", ", "))
    demo = F.contains(F.lower(inst), F.lit("game demo")) | F.contains(F.lower(inst), F.lit("content descriptor"))
    known = instances.select(
        F.col("id").alias("__iid"), valid_instance(inst).alias("real"), demo.alias("demo"), (valid_instance(inst) | describes_game(F.col("description"))).alias("proof")
    )
    # Hits meet their records before they meet the searches, so the rows, once laid out by search, are not shuffled again. Hits of a hot record stream past it.
    told = hits.join(known.hint("shuffle_hash"), F.col("id") == F.col("__iid"), "left").withColumn("known", F.col("__iid").isNotNull()).drop("__iid")
    terms = entity_terms(queries)
    found = materialize(search_hits(terms.where("term_no = 0"), told, by_row=True), "entity-found", "row_id")
    own = materialize(_entity_pick(found, cfg, legacy_tiebreak, found), "entity-own", "row_id")
    unsettled = own.where(F.col("outcome") == "retry").select("row_id").hint("shuffle_hash")
    if "query" in hits.columns:
        again = search_hits(terms.where("term_no > 0").join(unsettled, "row_id", "left_semi"), told, by_row=True)
        again = materialize(again, "entity-again", "row_id")
    else:
        tries = F.inline(_entity_tries(F.col("term"))).alias("term_no", "term")
        again = found.join(unsettled, "row_id", "left_semi").select(*[c for c in found.columns if c not in ("term_no", "term")], tries).where("term_no > 0")
    again = _entity_pick(again, cfg, legacy_tiebreak, again if "query" in hits.columns else found)
    retried = best_per_group(again.where(F.col("outcome") == "accepted"), ["row_id"], [-F.col("term_no")], ["id", "label", "score"])
    return own.where(F.col("outcome") == "accepted").select("row_id", "id", "label", "score").unionByName(retried)


def _about(descriptions: DataFrame) -> DataFrame:
    about = F.col("description")
    return descriptions.withColumns(
        {"game": describes_game(about), "unwanted": describes_unwanted(about), "media": describes_other_media(about), "desc_year": year_in_text(about)}
    )


def _entity_pick(found: DataFrame, cfg: MatchConfig, legacy: bool, described: DataFrame) -> DataFrame:
    """(row_id, term_no, outcome, id, label, score) of each search, from rows that lie by search; ``described``: stored rows with their descriptions."""
    cand = once_per_pair(found, ["description"], _about, described).drop("description")
    cand = cand.withColumn("proof", F.col("game") | F.coalesce("proof", F.lit(False)))
    scored = score_candidates(
        cand, "term", "label", "year_hint", "desc_year", judge=lambda pairs: pairs.withColumn("adds", adds_tokens(F.col("term"), F.col("label"))), source=found
    ).withColumn("score", F.col("m_adjusted"))
    keys = ["row_id", "term_no"]
    order = F.struct(*rank_key("label", "id", F.col("pos"), legacy_tiebreak=legacy))
    row = F.struct(order.alias("k"), F.struct("id", "label", "score", "adds", "media", "known", "demo", "proof").alias("p"))
    # A valid instance counts when it is among the ten labels nearest to the title.
    near = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("m_raw").desc(), F.col("pos").asc())) <= 10
    scored = scored.select(*keys, "id", "real", "game", "unwanted", row.alias("row"), (near & F.col("real")).alias("near"))
    scored = scored.withColumn("valid", F.max("near").over(Window.partitionBy(*keys, "id")) & F.col("real"))
    t = scored.groupBy(*keys).agg(
        F.max(F.when(F.col("game") & ~F.col("unwanted"), F.col("row"))).alias("preferred"),
        F.max(F.when(F.col("game"), F.col("row"))).alias("gameish"),
        F.max("row").alias("anyone"),
        F.max(F.when(~F.col("row.p.adds"), F.col("row"))).alias("safer"),
        F.max(F.when(F.col("valid"), F.col("row"))).alias("valid"),
    )

    def good(c: str) -> Column:
        return F.coalesce(F.col(f"{c}.p.score") >= cfg.min_score, F.lit(False))

    fallback = F.coalesce(F.col("gameish"), F.col("anyone"))
    t = t.withColumn("first", F.when(good("preferred"), F.col("preferred")).otherwise(fallback))
    unsure = (F.col("first.p.score") < cfg.suspicious_score) & F.col("first.p.adds")
    t = t.withColumn("second", F.when(unsure & good("safer"), F.col("safer")).otherwise(F.col("first")))
    t = t.withColumn(
        "third",
        F.when(~F.col("second.p.media"), F.col("second"))
        .when(good("valid"), F.col("valid"))
        .when(good("gameish"), F.col("gameish")),
    )
    refused = F.coalesce(F.col("third.p.demo"), F.lit(False))
    other = F.when(good("valid") & (F.col("valid.p.id") != F.col("third.p.id")), F.col("valid"))
    t = t.withColumns({"final": F.when(refused, other).otherwise(F.col("third")), "refused": refused, "evidence": F.col("third.p.proof")})
    outcome = (
        F.when(~good("second"), "retry")
        .when(~F.coalesce(F.col("third.p.known"), F.lit(False)), "reject")
        .when(F.col("refused"), F.when(F.col("final").isNull(), "retry").otherwise("accepted"))
        .when(F.col("evidence"), "accepted")
        .otherwise("reject")
    )
    return t.select(*keys, outcome.alias("outcome"), "final.p.id", "final.p.label", "final.p.score")
