"""Title text: normalisation, year hints, series numbers, edition and add-on tests, query variants."""

from __future__ import annotations

import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalith.constants import (
    EDITION_PHRASES,
    GAME_WORDS,
    MATCH_DLC_TOKENS,
    NON_GAME_WORDS,
    PROVIDER_DLC_TOKENS,
    REJECTED_INSTANCE_WORDS,
    REPORT_EDITION_TOKENS,
    ROMAN_NUMERALS,
    STORE_EDITION_TOKENS,
    TRAILING_PAREN_YEAR,
    UNWANTED_GAME_WORDS,
    VALID_INSTANCE_WORDS,
    YEAR_COLUMNS,
    YEAR_HINT,
    YEAR_IN_TEXT,
)
from catalith.functions.lists import clean_list, contains_any, is_blank, overlaps, strings, strip, text

# Characters that become a space, and characters that vanish, when a title is normalised.
SPACED_CHARS = "()[]{}:-–—_/\\|.,!?+*&%$#@~"
DROPPED_CHARS = "™®©’'`"


def normalize_title(c: Column) -> Column:
    """Lower-case title without punctuation, roman numerals i..x as digits, single spaces.

    One ``translate`` pass does all single-character work, so the whole function stays in generated code.
    """
    s = F.translate(F.lower(F.coalesce(c, F.lit(""))), SPACED_CHARS + DROPPED_CHARS, " " * len(SPACED_CHARS))
    padded = F.concat(F.lit(" "), s, F.lit(" "))
    arabic = padded
    for number, roman in enumerate(ROMAN_NUMERALS, start=1):
        arabic = F.replace(arabic, F.lit(f" {roman} "), F.lit(f" {number} "))
    converted = F.when(padded.rlike(" [ivx]+ "), arabic).otherwise(padded)
    return F.trim(F.regexp_replace(converted, r"(?U)\s+", " "))


def tokens(normalized: Column) -> Column:
    """Words of an already normalised title (empty title: no words)."""
    return F.when(normalized == "", strings(())).otherwise(F.split(normalized, " "))


def title_tokens(c: Column) -> Column:
    return F.array_distinct(tokens(normalize_title(c)))


def year_hint(c: Column) -> Column:
    """First delimited 19xx/20xx in a text, as INT."""
    return F.try_to_number(F.nullif(F.regexp_extract(text(c), YEAR_HINT, 1), F.lit("")), F.lit("9999")).cast("int")


def year_in_text(c: Column) -> Column:
    return F.regexp_extract(F.coalesce(c, F.lit("")), YEAR_IN_TEXT, 1).try_cast("int")


def valid_year(c: Column) -> Column:
    """A four-digit year between 1900 and 2100, else NULL."""
    s = text(c)
    return F.when(s.rlike(r"^(19\d{2}|20\d{2}|2100)$"), s.try_cast("int"))


def row_year_hint(columns: list[str], name: str = "Name") -> Column:
    """Year hint of a catalog row: the first valid year column, else the year in the name."""
    known = [valid_year(F.col(c)) for c in YEAR_COLUMNS if c in columns]
    return F.coalesce(*known, year_hint(F.col(name)))


# Number words of a normalised title are found by one regular expression each, which stays in generated code.
_YEAR_WORD = r"(?:^| )(19\d{2}|20\d{2}|2100)(?= |$)"
_SERIES = r"[1-9]|[1-4]\d|50"
_NOT_THOUSANDS = r"(?! 000(?: |$))"


def count_year_words(words: Column) -> Column:
    """Number of year words in a list of words."""
    return F.regexp_count(F.array_join(words, " "), F.lit(_YEAR_WORD))


def only_year_words(words: Column) -> Column:
    return F.array_join(words, " ").rlike(r"^(?:(?:19\d{2}|20\d{2}|2100)(?: |$))+$")


def _numbers(normalized: Column, pattern: str) -> Column:
    return F.regexp_extract_all(normalized, F.lit(pattern), F.lit(1))


def match_series_numbers(normalized: Column) -> Column:
    """Sorted series numbers (text) for ranking and most providers: 1..50 without leading zeros."""
    return F.sort_array(F.array_distinct(_numbers(normalized, rf"(?:^| )({_SERIES})(?= |$)")))


def has_series_number(normalized: Column) -> Column:
    return normalized.rlike(rf"(?:^| )({_SERIES})(?= |$)")


def has_other_number(normalized: Column) -> Column:
    """Whether a title has a number word that is not a year."""
    return normalized.rlike(r"(?:^| )(?!(?:19\d{2}|20\d{2}|2100)(?: |$))\d+(?= |$)")


def _as_ints(numbers: Column) -> Column:
    return F.sort_array(F.array_distinct(numbers.cast("array<int>")))


def report_series_numbers(normalized: Column) -> Column:
    """Series numbers for the validation report: leading zeros allowed, ``40 000`` ignored; sorted INTs."""
    return _as_ints(_numbers(normalized, rf"(?:^| )(0*(?:{_SERIES}))(?= |$){_NOT_THOUSANDS}"))


def import_series_numbers(normalized: Column) -> Column:
    """Series numbers for import tags: no leading zeros and ``40 000`` ignored; sorted INTs."""
    return _as_ints(_numbers(normalized, rf"(?:^| )({_SERIES})(?= |$){_NOT_THOUSANDS}"))


def store_has_series_number(normalized: Column) -> Column:
    """Store variant: any number of one or two digits other than 0 and 1."""
    return normalized.rlike(r"(?:^| )(?![01](?: |$))\d{1,2}(?= |$)")


def non_year_numbers(normalized: Column) -> Column:
    """Number words except four-digit 19xx/20xx ones."""
    return F.array_distinct(_numbers(normalized, r"(?:^| )(?!(?:19|20)\d{2}(?: |$))(\d+)(?= |$)"))


def plain_words(normalized: Column) -> Column:
    """Distinct words that are not numbers."""
    return F.array_distinct(_numbers(normalized, r"(?:^| )(?!\d+(?: |$))([^ ]+)"))


def match_dlc_like(words: Column) -> Column:
    return overlaps(words, strings(MATCH_DLC_TOKENS))


def provider_dlc_like(words: Column) -> Column:
    return overlaps(words, strings(PROVIDER_DLC_TOKENS))


def report_dlc_like(title: Column, categories: Column, normalized: Column | None = None) -> Column:
    """Add-on test of the validation report: title words, or a ``downloadable content`` category. ``normalized`` is the title's normal form, if at hand."""
    cats = normalize_title(F.array_join(clean_list(categories), ", "))
    words = title_tokens(title) if normalized is None else F.array_distinct(tokens(normalized))
    return provider_dlc_like(words) | F.contains(cats, F.lit("downloadable content"))


def edition_tokens(title: Column) -> Column:
    """Sorted edition words of a title, with the two multi-word editions folded to one word."""
    return edition_words(normalize_title(title))


def edition_words(n: Column) -> Column:
    """:func:`edition_tokens` of an already normalised title, which is named several times."""
    found = F.array_intersect(tokens(n), strings(REPORT_EDITION_TOKENS))
    goty = F.when(F.contains(n, F.lit("game of the year")), F.array(F.lit("goty")))
    cut = F.when(contains_any(n, ("director s cut", "directors cut")), F.array(F.lit("directors")))
    none = strings(())
    return F.sort_array(F.array_union(F.array_union(found, F.coalesce(goty, none)), F.coalesce(cut, none)))


def edition_or_port(title: Column, normalized: Column | None = None) -> Column:
    words = title_tokens(title) if normalized is None else tokens(normalized)
    return overlaps(words, strings(REPORT_EDITION_TOKENS))


def strip_edition_tokens(title: Column) -> Column:
    """Normalised title without edition words (duplicates of other words kept)."""
    editions = "|".join(STORE_EDITION_TOKENS)
    kept = F.regexp_replace(normalize_title(title), rf"(?:(?<=^)|(?<= ))(?:{editions})(?= |$)", "")
    return F.trim(F.regexp_replace(kept, " +", " "))


def strip_trailing_year(title: Column) -> Column:
    """Drop a trailing ``(YYYY)``; a title that is nothing else stays."""
    s = text(title)
    return F.coalesce(F.nullif(strip(F.regexp_replace(s, TRAILING_PAREN_YEAR, "")), F.lit("")), s)


def strip_edition_phrases(title: Column) -> Column:
    s = text(title)
    out = s
    for phrase in EDITION_PHRASES:
        out = strip(F.regexp_replace(out, "(?i)" + phrase, ""))
    out = strip(F.regexp_replace(out, r"\s{2,}", " "))
    return F.coalesce(F.nullif(out, F.lit("")), s)


def query_variants(title: Column) -> Column:
    """Search variants of a title in trial order, distinct and non-blank."""
    base = text(title)
    has_year = year_hint(base).isNotNull()
    roman = base
    for number, numeral in enumerate(ROMAN_NUMERALS, start=1):
        roman = F.regexp_replace(roman, rf"\b{numeral.upper()}\b", str(number))
    before = [
        F.when(F.contains(base, F.lit(sep)), strip(F.substring_index(base, sep, 1))) for sep in (":", " - ", " – ", " — ")
    ]
    variants = F.array(
        base,
        F.when(has_year, strip(F.regexp_replace(base, TRAILING_PAREN_YEAR, ""))),
        F.when(has_year, strip(F.regexp_replace(base, r"\s+(19\d{2}|20\d{2})\s*$", ""))),
        F.translate(base, "–—−", "---"),
        strip(F.regexp_replace(base, r"[!?\.]+$", "")),
        strip(F.regexp_replace(base, r"(?i)\bFull\s+HD\b", "HD")),
        *before,
        roman,
    )
    return F.array_distinct(F.filter(variants, lambda v: v.isNotNull() & (v != "")))


def base_of_subtitle(title: Column) -> Column:
    """Text before the first colon, or NULL when there is none or nothing is left."""
    s = text(title)
    base = strip(F.substring_index(s, ":", 1))
    return F.when(F.contains(s, F.lit(":")) & (base != "") & (base != s), base)


@F.arrow_udf(T.StringType())
def nfkc(values: pa.Array) -> pa.Array:
    """Compatibility-composed text; plain ASCII is handed back as it is."""

    def compose(v):
        return v if v is None or v.isascii() else unicodedata.normalize("NFKC", v)

    return pa.array([compose(v) for v in values.to_pylist()], pa.string())


@F.arrow_udf(T.StringType())
def fold_accents(values: pa.Array) -> pa.Array:
    """Text without combining marks; plain ASCII is handed back as it is."""

    def fold(v):
        if v is None or v.isascii():
            return v
        return "".join(ch for ch in unicodedata.normalize("NFKD", v) if not unicodedata.combining(ch))

    return pa.array([fold(v) for v in values.to_pylist()], pa.string())


def search_text(title: Column) -> Column:
    """Text safe to put in a quoted search expression: NFKC, control characters as spaces, quotes escaped."""
    s = F.regexp_replace(nfkc(strip_trailing_year(title)), r"\p{C}", " ")
    s = F.replace(F.replace(s, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    return strip(s)


def word_tokens(c: Column) -> Column:
    """Lower-case ``[a-z0-9]+`` words of a label."""
    return F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(r"([a-z0-9]+)"), F.lit(1)))


def adds_tokens(query: Column, label: Column) -> Column:
    """Whether a label has words the query lacks (never true when either has none)."""
    q, lab = word_tokens(query), word_tokens(label)
    return (F.size(q) > 0) & (F.size(lab) > 0) & (F.size(F.array_except(lab, q)) > 0)


def describes_game(c: Column) -> Column:
    return contains_any(F.lower(text(c)), GAME_WORDS)


def describes_unwanted(c: Column) -> Column:
    return contains_any(F.lower(text(c)), UNWANTED_GAME_WORDS)


def describes_other_media(c: Column) -> Column:
    return contains_any(F.lower(text(c)), NON_GAME_WORDS)


def valid_instance(c: Column) -> Column:
    s = F.lower(text(c))
    return contains_any(s, VALID_INSTANCE_WORDS) & ~contains_any(s, REJECTED_INSTANCE_WORDS)


def has_cyrillic(c: Column) -> Column:
    return F.coalesce(c, F.lit("")).rlike(r"[Ѐ-ԯ]")


def drop_cyrillic(c: Column) -> Column:
    """List without items in the Russian alphabet."""
    return F.filter(clean_list(c), lambda t: ~t.rlike("[А-Яа-яЁё]"))


def normalize_tag(c: Column) -> Column:
    """Tag text for keyword search: ``&`` as ``and``, only ``a-z0-9:+/-`` and single spaces kept."""
    s = F.replace(F.lower(text(c)), F.lit("&"), F.lit(" and "))
    return strip(F.regexp_replace(F.regexp_replace(s, r"[^a-z0-9\s:+/-]", " "), r"\s+", " "))


def tag_text(*lists: Column) -> Column:
    """All tags of several lists, normalised, in one searchable text."""
    parts = [F.array_join(F.transform(clean_list(c), normalize_tag), " ") for c in lists]
    return F.array_join(F.filter(F.array(*parts), lambda p: p != ""), " ")


def truncate(c: Column, keep: int, limit: int, mark: str, trim: bool = True) -> Column:
    """Text cut to ``keep`` characters plus ``mark`` once longer than ``limit``."""
    s = text(c)
    head = F.substring(s, 1, keep)
    head = F.rtrim(head) if trim else head
    return F.when(F.length(s) > limit, F.concat(head, F.lit(mark))).otherwise(s)


def store_url(app_id: Column) -> Column:
    s = text(app_id)
    return F.when(s.rlike(r"^\d+$"), F.concat(F.lit("https://store.steampowered.com/app/"), s, F.lit("/"))).otherwise("")


def playtime_url(game_id: Column) -> Column:
    s = text(game_id)
    return F.when(s.rlike(r"^\d+$"), F.concat(F.lit("https://howlongtobeat.com/game/"), s)).otherwise("")


def wiki_url(title: Column) -> Column:
    s = F.coalesce(title, F.lit(""))
    return F.when(
        s != "", F.concat(F.lit("https://en.wikipedia.org/wiki/"), F.replace(s, F.lit(" "), F.lit("_")))
    ).otherwise("")


def id_from_url(url: Column) -> Column:
    """Digits after ``/app/`` in a store link, or NULL."""
    return F.nullif(F.regexp_extract(F.coalesce(url, F.lit("")), r"/app/(\d+)\b", 1), F.lit(""))


def first_store_id(urls: Column) -> Column:
    """First store id found over a list of links, or the empty string."""
    ids = F.filter(F.transform(clean_list(urls), id_from_url), lambda x: x.isNotNull())
    return F.coalesce(F.get(ids, F.lit(0)), F.lit(""))


def query_year_or_blank(c: Column) -> Column:
    return F.coalesce(year_hint(c).cast("string"), F.lit(""))


def platform_report_bucket(c: Column) -> Column:
    """Platform family for the validation report; unknown names stay as they are."""
    t = F.lower(text(c))
    return (
        F.when(contains_any(t, ("pc", "windows")), "pc")
        .when(F.contains(t, F.lit("playstation")) | t.startswith("ps"), "playstation")
        .when(F.contains(t, F.lit("xbox")), "xbox")
        .when(contains_any(t, ("nintendo", "switch", "wii")), "nintendo")
        .when(F.contains(t, F.lit("mac")), "mac")
        .when(F.contains(t, F.lit("linux")), "linux")
        .otherwise(t)
    )


def platform_import_bucket(c: Column) -> Column:
    """Platform family for import tags; unknown names give NULL."""
    return _import_bucket(normalize_title(c))


def _import_bucket(n: Column) -> Column:
    return (
        F.when(contains_any(n, ("pc", "windows", "mac", "osx", "linux")), "pc")
        .when(F.contains(n, F.lit("playstation")) | n.startswith("ps"), "playstation")
        .when(F.contains(n, F.lit("xbox")), "xbox")
        .when(contains_any(n, ("nintendo", "switch", "wii")), "nintendo")
        .when(contains_any(n, ("ios", "android", "mobile")), "mobile")
    )


def platform_report_set(c: Column) -> Column:
    return F.sort_array(F.array_distinct(F.filter(F.transform(clean_list(c), platform_report_bucket), lambda p: p != "")))


def platform_import_set(c: Column) -> Column:
    return F.sort_array(F.array_distinct(F.array_compact(F.transform(F.transform(clean_list(c), normalize_title), _import_bucket))))


def pc_like(platform: Column) -> Column:
    """Whether a user platform text allows a PC store match; blank means yes."""
    p = F.lower(text(platform))
    return is_blank(platform) | contains_any(p, ("pc", "windows", "steam", "linux", "mac", "osx"))


def genre_set(c: Column) -> Column:
    return F.sort_array(F.array_distinct(F.filter(F.transform(clean_list(c), normalize_title), lambda g: g != "")))
