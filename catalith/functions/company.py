"""Company names: display form, comparison keys and list splitting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from catalith.constants import (
    GENERIC_COMPANY_TOKENS,
    IGNORED_COMPANY_KEYS,
    LEGAL_SUFFIXES,
    LOW_SIGNAL_COMPANIES,
    PORTING_PREFIXES,
    SUFFIXED_LOCATIONS,
)
from catalith.functions.lists import clean_list, strings, strip, text
from catalith.functions.text import fold_accents

#: Any number of legal suffixes at the end, each after white space or a comma.
_LEGAL_TAIL = r"(?i)(?:(?:,?\s+|\s*,\s*)(?:" + "|".join(LEGAL_SUFFIXES) + r")[\s,]*)+$"
_SEP = "\x1f"
_MARKS = "™®℠"


def normalize_company(c: Column) -> Column:
    """Company name without a trailing parenthetical and legal suffixes, however many are stacked; blank unless a letter is left."""
    s = F.regexp_replace(text(c), r"^(?i:nan|none|null)$", "")
    s = F.regexp_replace(s, r"\s*\([^)]*\)\s*$", "")
    s = F.rtrim(F.regexp_replace(F.rtrim(s), _LEGAL_TAIL, ""), F.lit(" ,"))
    s = strip(F.regexp_replace(s, r"\s{2,}", " "))
    return F.regexp_replace(s, "^[^A-Za-z]*$", "")


def key_of_normalized(s: Column) -> Column:
    """Comparison key of an already normalised name whose accents are folded."""
    return F.lower(F.trim(F.regexp_replace(s, "(?i)[^a-z0-9]+", " ")))


def fold_key(name: Column) -> Column:
    """Comparison key of a normalised name."""
    return key_of_normalized(fold_accents(F.translate(name, _MARKS, "")))


def company_key(c: Column) -> Column:
    """Comparison key: normalised name without marks, accents and punctuation, lower-case.

    Accent folding runs in Python for non-ASCII names only, so this form cannot stand inside an array lambda; lists
    go through :func:`company_key_set`.
    """
    return fold_key(normalize_company(c))


def _key_variants(key: Column) -> Column:
    words = F.filter(F.split(key, " "), lambda w: w != "")
    n = F.size(words)
    generic = strings(GENERIC_COMPANY_TOKENS)

    def droppable(i: Column) -> Column:
        return F.forall(F.slice(words, i + 1, n), lambda w: F.array_contains(generic, w))

    lengths = F.filter(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), droppable)
    return F.when(n == 0, strings(())).otherwise(
        F.transform(F.reverse(lengths), lambda i: F.array_join(F.slice(words, 1, i), " "))
    )


def company_keys(c: Column) -> Column:
    """Key of a company plus the keys left when generic trailing words are dropped one by one; sorted."""
    return company_key_set(F.array(c))


def company_key_set(names: Column) -> Column:
    """Sorted union of the keys of a list of companies; the whole list is folded in one go."""
    plain = F.filter(F.transform(clean_list(names), normalize_company), lambda n: n != "")
    folded = F.split(fold_accents(F.translate(F.array_join(plain, _SEP), _MARKS, "")), _SEP)
    keys = F.flatten(F.transform(folded, lambda n: _key_variants(key_of_normalized(n))))
    return F.array_sort(F.array_distinct(keys))


def company_name_set(names: Column) -> Column:
    """Distinct normalised lower-case names of a list, in order."""
    keys = F.transform(clean_list(names), lambda x: F.lower(normalize_company(x)))
    return F.array_distinct(F.filter(keys, lambda k: k != ""))


def without_low_signal(keys: Column) -> Column:
    return F.array_except(keys, strings(LOW_SIGNAL_COMPANIES))


def is_porting_label(name: Column) -> Column:
    low = F.lower(name)
    cond = F.lit(False)
    for prefix in PORTING_PREFIXES:
        cond = cond | low.startswith(prefix)
    return cond


def wanted_company(label: Column, include_porting_labels: bool = True) -> Column:
    """Whether a label is a company worth tallying rather than markup, a place or a platform."""
    return wanted_normalized(label, normalize_company(label), company_key(label), include_porting_labels)


def wanted_normalized(label: Column, name: Column, key: Column, include_porting_labels: bool = True) -> Column:
    """:func:`wanted_company` with the normalised name and key at hand."""
    n = F.lower(name)
    ok = ~F.contains(label, F.lit("'''")) & ~key.isin(*IGNORED_COMPANY_KEYS) & (n != "") & ~n.startswith("and ")
    return ok if include_porting_labels else ok & ~n.isin(*LOW_SIGNAL_COMPANIES)


def split_company_text(c: Column) -> Column:
    """Split "A, B, and C" only when it clearly is a list: two commas or more and no parentheses."""
    s = text(c)
    parts = F.filter(F.transform(F.split(s, ","), strip), lambda p: p != "")
    parts = F.transform(parts, lambda p: strip(F.regexp_replace(p, r"(?i)^and\s+", "")))
    located = F.transform(
        parts,
        lambda p: F.when(F.lower(p).isin(*SUFFIXED_LOCATIONS), F.concat(F.lit("Ubisoft "), p)).otherwise(p),
    )
    parts = F.when(F.lower(F.get(parts, F.lit(0))).startswith("ubisoft "), located).otherwise(parts)
    parts = F.filter(parts, lambda p: p != "")
    whole = F.contains(s, F.lit("(")) | F.contains(s, F.lit(")")) | ~s.rlike(",[^,]*,")
    return F.when(s == "", strings(())).when(whole, F.array(s)).otherwise(parts)


def split_company_list(c: Column) -> Column:
    return F.array_distinct(F.flatten(F.transform(clean_list(c), split_company_text)))
