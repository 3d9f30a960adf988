"""Word lists, patterns, bounds and names that results depend on."""

from __future__ import annotations

from dataclasses import dataclass

# --- identity columns and sentinels (fixed values) -------------------------------------------------------------
NOT_FOUND = "__NOT_FOUND__"
PIN_COLUMNS = ("RAWG_ID", "IGDB_ID", "Steam_AppID", "HLTB_ID", "HLTB_Query", "Wikidata_QID")
PROVIDER_PREFIX = {
    "rawg": "RAWG_",
    "igdb": "IGDB_",
    "steam": "Steam_",
    "steamspy": "SteamSpy_",
    "hltb": "HLTB_",
    "wikidata": "Wikidata_",
}
YES_VALUES = ("YES", "Y", "TRUE", "1")
YEAR_COLUMNS = ("YearHint", "Year", "ReleaseYear", "Release_Year")
DEPRECATED_COLUMNS = (
    "IGDB_Companies",
    "Steam_ReviewPercent",
    "SteamSpy_Players",
    "SteamSpy_Players2Weeks",
    "Now_SteamSpyPlayers2Weeks",
)
SOURCE_ALIASES = {"core": ["igdb", "rawg", "steam"]}
IMPORT_SOURCES = ("hltb", "igdb", "rawg", "steam", "wikidata")
ENRICH_SOURCES = ("hltb", "igdb", "rawg", "steam", "steamspy", "wikidata")

# --- title vocabulary (fixed values) ---------------------------------------------------------------------------
ROMAN_NUMERALS = ("i", "ii", "iii", "iv", "v", "vi", "vii", "viii", "ix", "x")
MATCH_EDITION_TOKENS = (
    "remake", "hd", "classic", "definitive", "remastered", "ultimate", "goty", "anniversary", "complete",
    "collection", "edition", "enhanced", "redux", "vr", "directors", "director", "cut", "story", "game", "of",
    "the", "year",
)
STORE_EDITION_TOKENS = MATCH_EDITION_TOKENS + ("deluxe",)
REPORT_EDITION_TOKENS = (
    "remake", "hd", "classic", "definitive", "remastered", "ultimate", "goty", "anniversary", "complete",
    "collection", "edition", "enhanced", "redux", "vr", "directors", "director", "deluxe", "gold", "platinum",
)
MATCH_DLC_TOKENS = ("soundtrack", "demo", "beta", "expansion", "pack", "season", "pass")
PROVIDER_DLC_TOKENS = ("soundtrack", "demo", "beta", "dlc", "expansion", "pack", "season", "pass")
EDITION_PHRASES = (
    r"\bgame\s+of\s+the\s+year\s+edition\b",
    r"\bgoty\s+edition\b",
    r"\bcomplete\s+edition\b",
    r"\bultimate\s+edition\b",
    r"\bdefinitive\s+edition\b",
    r"\bdeluxe\s+edition\b",
    r"\bcollector'?s\s+edition\b",
    r"\bgold\s+edition\b",
)
YEAR_IN_TEXT = r"\b(19\d{2}|20\d{2})\b"
YEAR_HINT = r"(?:^|[\s(])(19\d{2}|20\d{2})(?:$|[\s)])"
TRAILING_PAREN_YEAR = r"\s*\(\s*(19\d{2}|20\d{2})\s*\)\s*$"

# --- knowledge-base description words (fixed values) -----------------------------------------------------------
GAME_WORDS = ("video game", "computer game")
UNWANTED_GAME_WORDS = ("demo", "esrb", "content descriptor")
NON_GAME_WORDS = (
    "film", "movie", "television", "tv series", "anime", "manga", "comic", "soundtrack", "album", "song", "novel",
    "book",
)
VALID_INSTANCE_WORDS = ("video game", "computer game", "expansion pack", "downloadable content", "dlc")
REJECTED_INSTANCE_WORDS = ("game demo", "content descriptor", "esrb content descriptor")
LINK_PROPERTIES = {
    "developers": "P178",
    "publishers": "P123",
    "platforms": "P400",
    "series": "P179",
    "genres": "P136",
    "instance_of": "P31",
}
RELEASE_PROPERTY = "P577"
STORE_ID_PROPERTY = "P1733"
GAME_DB_ID_PROPERTY = "P5794"

# --- company vocabulary (fixed values) -------------------------------------------------------------------------
LEGAL_SUFFIXES = (
    r"inc\.?", "incorporated", "llc", r"l\.l\.c\.", r"ltd\.?", "limited", r"corp\.?", "corporation",
    r"co\.?", "company", "gmbh", r"s\.a\.", r"s\.a", r"s\.r\.l\.", r"s\.r\.l", r"s\.p\.a\.", r"s\.p\.a",
    "a/s", r"a\.s\.", "ag", "bv", "oy", "oyj", "kg", r"k\.g\.", r"pte\.?\s+ltd\.?",
    r"lda\.?", r"pty\.?(?:\s+ltd\.?)?",
    r"co\.,?\s*ltd\.?", r"co\.,?\s*limited", r"co\.,?\s*ltd",
)
GENERIC_COMPANY_TOKENS = (
    "games", "game", "software", "studio", "studios", "interactive", "entertainment", "publishing", "publisher",
    "digital", "media", "production", "productions",
)
LOW_SIGNAL_COMPANIES = ("feral interactive", "aspyr", "aspyr media")
PORTING_PREFIXES = ("feral interactive", "aspyr")
IGNORED_COMPANY_KEYS = (
    "amiga", "north america", "playstation mobile", "playstation pc", "small", "lda", "eq", "shanghai", "toronto",
    "kiev", "windows", "mac", "linux", "dreamcast", "gizmondo", "n gage", "game boy advance", "__not_found__",
    "not found",
)
SUFFIXED_LOCATIONS = ("shanghai", "toronto", "kiev", "kyiv", "quebec", "québec", "montreal", "montréal")
TIER_RANK = {"Indie": 1, "AA": 2, "AAA": 3}

# --- keyword needles (fixed values) ----------------------------------------------------------------------------
REPLAY_NEEDLES = {
    "multiplayer": (
        "multiplayer", "multi player", "online pvp", "online multiplayer", "pvp", "mmorpg",
        "massively multiplayer", "battle royale",
    ),
    "coop": ("co op", "coop", "co-operative", "cooperative", "online co op", "local co op"),
    "pvp": ("pvp", "competitive", "ranked", "versus"),
    "roguelike": ("roguelike", "roguelite"),
    "procedural": ("procedural", "procedurally generated", "procedural generation"),
    "systemic": (
        "sandbox", "open world", "strategy", "4x", "simulation", "city builder", "management", "survival",
        "crafting", "building",
    ),
}
REPLAY_POINTS = {
    "base": 20, "multiplayer": 50, "coop": 20, "pvp": 10, "roguelike": 25, "procedural": 15, "systemic": 20,
    "optional_content": 10,
}
MODDING_NEEDLES = {
    "steam_workshop": (90, ("steam workshop",)),
    "level_editor": (75, ("level editor", "includes level editor")),
    "mod_tools": (70, ("moddable", "mod tools", "mod support")),
}
STORE_TYPE_CONTENT = {
    "game": "base_game", "dlc": "dlc", "demo": "demo", "soundtrack": "soundtrack", "bundle": "collection",
}

# --- review weights and tags (fixed values) --------------------------------------------------------------------
CONFIDENCE_POINTS = {"LOW": 50, "MEDIUM": 20}
TAG_PREFIX_POINTS = (("likely_wrong:", 40), ("provider_outlier:", 12), ("year_outlier:", 6), ("platform_outlier:", 6))
TAG_POINTS = {
    "year_disagree": 10, "platform_disagree": 10, "steam_appid_disagree:igdb": 10, "steam_appid_disagree:rawg": 10,
    "steam_rejected": 10, "steam_dlc_like": 10,
    "genre_disagree": 4, "edition_disagree": 4, "ambiguous_title_year": 4,
}
STABLE_TAG_PREFIXES = ("autounpinned:", "repinned_by_resolve:", "wikidata_hint")
REVIEW_PREFIXES = ("likely_wrong:", "provider_outlier:", "year_outlier:", "platform_outlier:")


@dataclass(frozen=True)
class MatchConfig:
    min_score: int = 65
    suspicious_score: int = 90
    year_tolerance: int = 2
    early_stop_score: int = 95
    refine_candidates: int = 10
    package_limit: int = 10


@dataclass(frozen=True)
class ListLimits:
    """How many items the lists of a payload's metrics hold at most."""

    websites: int = 5
    tags: int = 15
    top_tags: int = 50
    aliases: int = 20


@dataclass(frozen=True)
class ReportConfig:
    title_score_warn: int = 90
    year_max_diff: int = 1


@dataclass(frozen=True)
class ReviewConfig:
    max_rows: int = 200


@dataclass(frozen=True)
class Scale:
    """Bounds of a log10 scale and its weight in a blend."""

    low: float
    high: float
    weight: float


@dataclass(frozen=True)
class SignalConfig:
    """Bounds and weights of the composite scores (fixed values)."""

    owners: Scale = Scale(3.0, 8.0, 3.0)
    reviews: Scale = Scale(2.0, 7.0, 2.0)
    votes: Scale = Scale(2.0, 6.0, 1.0)
    added: Scale = Scale(2.0, 7.0, 1.0)
    critic_votes: Scale = Scale(1.0, 5.0, 0.5)
    pageviews: Scale = Scale(2.0, 8.0, 0.8)
    players_2w: Scale = Scale(1.0, 7.0, 2.0)
    ccu: Scale = Scale(0.0, 6.0, 1.0)
    now_pageviews: Scale = Scale(1.0, 7.0, 1.0)


MATCHING = MatchConfig()
LIMITS = ListLimits()
REPORT = ReportConfig()
REVIEW = ReviewConfig()
SIGNALS = SignalConfig()
EARLIEST_PAGEVIEWS = "2015-07-01"
