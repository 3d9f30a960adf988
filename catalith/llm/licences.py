"""Licence scans: sentences become identifiers, and ordered rules recognise sequences of identifiers. DataFrame functions only."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Known sentences, normalised, by identifier.
SENTENCES = {
    "apache-grant": (
        "licensed under the apache license version 2.0", "licensed under the apache license version 2.0 the license",
        "this file is licensed under the apache license version 2.0",
    ),
    "apache-comply": ("you may not use this file except in compliance with the license",),
    "apache-copy": ("you may obtain a copy of the license at http www.apache.org licenses license 2.0",),
    "apache-basis": (
        "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without"
        " warranties or conditions of any kind either express or implied",
    ),
    "mit-name": ("released under the mit license", "licensed under the mit license", "this project is licensed under the mit license"),
    "mit-grant": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal"
        " in the software without restriction",
    ),
    "mit-notice": ("the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",),
    "gpl3-name": (
        "this work is licensed under the gnu general public license version 3", "licensed under the gnu general public license version 3",
        "this program is licensed under the gnu general public license version 3",
    ),
    "gpl2-name": ("this work is licensed under the gnu general public license version 2", "licensed under the gnu general public license version 2"),
    "gpl-hope": (
        "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness"
        " for a particular purpose",
    ),
    "gpl-received": ("you should have received a copy of the gnu general public license along with this program",),
    "cc-by-nc-4": ("licensed under cc by nc 4.0", "this work is licensed under cc by nc 4.0"),
    "cc-by-4": ("licensed under cc by 4.0", "this work is licensed under cc by 4.0"),
    "bsd-grant": (
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    ),
    "as-is": ("the software is provided as is without warranty of any kind express or implied",),
    "reserved": ("all rights reserved",),
}
#: Rules in order, each a licence and the identifiers that must follow one another. What a rule takes is gone for the rules after it.
RULES = (
    ("Apache-2.0", ("apache-grant", "apache-comply", "apache-copy", "apache-basis")),
    ("Apache-2.0", ("apache-grant", "apache-comply")),
    ("MIT", ("mit-grant", "mit-notice", "as-is")),
    ("MIT", ("mit-name", "mit-grant")),
    ("GPL-3.0", ("gpl3-name", "gpl-hope", "gpl-received")),
    ("GPL-2.0", ("gpl2-name", "gpl-hope", "gpl-received")),
    ("Apache-2.0", ("apache-grant",)),
    ("MIT", ("mit-name",)),
    ("GPL-3.0", ("gpl3-name",)),
    ("GPL-2.0", ("gpl2-name",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-4",)),
    ("CC-BY-4.0", ("cc-by-4",)),
    ("BSD", ("bsd-grant", "as-is")),
    ("All-Rights-Reserved", ("reserved",)),
)
_GPL = "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"
_FSF = _GPL + " as published by the free software foundation"
_RECEIVED = "you should have received a copy of the gnu general public license along with this program"
_MIT = (
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the"
    " software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the"
    " software and to permit persons to whom the software is furnished to do so subject to the following conditions"
)
_BSD = "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"
_COMPLY = "you may not use this file except in compliance with the license"
#: The complete sentences of canonical licence texts, normalised, by identifiers. A blank line inside a sentence is two line feeds.
WHOLE_SENTENCES = {
    ("apache-grant", "apache-comply"): (
        f"licensed under the apache license version 2.0 the license {_COMPLY}",
        f"the asf licenses this file to you under the apache license version 2.0 the license {_COMPLY}",
    ),
    ("apache-copy",): tuple(
        f"you may obtain a copy of the license at{gap}{http} www.apache.org licenses license 2.0" for gap in (" ", "\n\n") for http in ("http", "https")
    ),
    ("mit-grant",): (_MIT,),
    ("mit-grant", "mit-notice"): (f"{_MIT} {SENTENCES['mit-notice'][0]}",),
    ("gpl3-name",): (
        f"{_FSF} either version 3 of the license or at your option any later version", f"{_FSF} version 3 of the license", f"{_FSF} version 3",
        f"{_GPL} version 3 as published by the free software foundation",
    ),
    ("gpl2-name",): (
        f"{_FSF} either version 2 of the license or at your option any later version", f"{_FSF} version 2 of the license", f"{_FSF} version 2",
        f"{_GPL} version 2 as published by the free software foundation",
    ),
    ("gpl-received",): (
        *(f"{_RECEIVED} if not see {http} www.gnu.org licenses" for http in ("http", "https")),
        f"{_RECEIVED} if not write to the free software foundation inc. 51 franklin street fifth floor boston ma 02110 1301 usa",
        f"{_RECEIVED} if not write to the free software foundation inc. 59 temple place suite 330 boston ma 02111 1307 usa",
        f"{_RECEIVED} if not write to the free software foundation inc. 675 mass ave cambridge ma 02139 usa",
    ),
    ("bsd-grant",): (f"{_BSD} 1",),
    ("as-is",): (
        "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for"
        " a particular purpose and noninfringement",
        *(
            f"this software is provided by {who} as is and any express or implied warranties including but not limited to the implied warranties of"
            " merchantability and fitness for a particular purpose are disclaimed"
            for who in (
                "the copyright holders and contributors", "the copyright holder and contributors", "the regents and contributors", "the author and contributors",
            )
        ),
    ),
}
END = "\x01"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class LicenceTables:
    """Known sentences and rules. All are tables of fixed size that go into the plan as constants; texts are never shuffled."""

    sentences: tuple[tuple[str, tuple[str, ...]], ...] = tuple(SENTENCES.items())
    rules: tuple[tuple[str, tuple[str, ...]], ...] = RULES
    whole: tuple[tuple[tuple[str, ...], tuple[str, ...]], ...] = tuple(WHOLE_SENTENCES.items())


def normal_text(text: Column) -> Column:
    """A text with A-Z lower-cased and ``END`` for a full stop, question or exclamation mark before white space; line feeds stay.

    Of all other characters letters a-z, digits and stops inside a word or number stay, the rest become single spaces, none beside an end or a line feed.
    """
    ended = F.regexp_replace(F.translate(text, UPPER + END, LOWER + " "), r"[.!?]+(?:\s+|$)", END)
    plain = F.regexp_replace(ended, "[^a-z0-9.\n" + END + "]+", " ")
    return F.trim(F.regexp_replace(plain, f" *([\n{END}]) *", "$1"))


def identifier_sequence(text: Column, tables: LicenceTables) -> Column:
    """Identifiers of a text's known sentences as one string, each in angle brackets; sentences that are not known are passed over.

    A known sentence is found where it fills whole lines or ends at an end: a line feed may close it or stand for one of its spaces. Of two known
    sentences that start at one place the longer is taken.
    """
    known = {s: f"<{name}>" for name, group in tables.sentences for s in group}
    known |= {s: "".join(f"<{x}>" for x in names) for names, group in tables.whole for s in group}
    table = F.create_map(*[F.lit(x) for s, names in sorted({s.replace("\n\n", " "): names for s, names in known.items()}.items()) for x in (s, names)])
    any_of = "|".join(r"\n+".join(r"[ \n]".join(map(re.escape, part.split(" "))) for part in s.split("\n\n")) for s in sorted(known, key=lambda s: (-len(s), s)))
    pattern = rf"(?<![^\n{END}])(?:{any_of})(?![^\n{END}])"
    found = F.regexp_extract_all(normal_text(text), F.lit(pattern), F.lit(0))
    return F.array_join(F.transform(found, lambda s: F.try_element_at(table, F.regexp_replace(s, r"\n+", " "))), "")


def licence_scan(docs: DataFrame, tables: LicenceTables = LicenceTables(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, identifiers (the sequence), licences (names found, in order of name, joined by ``|``), n_licences, unmatched (what no rule took).

    A text without a known sentence, an empty and a NULL text have empty strings and 0. Rows may repeat and keys may be NULL; other columns are not read.
    """
    rows = docs.select(key, F.coalesce(identifier_sequence(F.col(text), tables), F.lit("")).alias("identifiers"))
    left, names = F.col("identifiers"), []
    out = rows
    for k, (name, sequence) in enumerate(tables.rules):
        wanted = F.lit("".join(f"<{x}>" for x in sequence))
        names.append(F.when(F.contains(left, wanted), F.lit(name)))
        out = out.withColumn(f"_hit{k}", names[-1]).withColumn(f"_left{k}", F.replace(left, wanted, F.lit("|")))
        left = F.col(f"_left{k}")
    found = F.sort_array(F.array_distinct(F.array_compact(F.array(*[F.col(f"_hit{k}") for k in range(len(tables.rules))]))))
    return out.select(
        key, "identifiers", F.array_join(found, "|").alias("licences"), F.size(found).cast("long").alias("n_licences"),
        F.regexp_replace(left, r"\|+", "").alias("unmatched"),
    )


def licence_sql(tables: LicenceTables = LicenceTables()) -> str:
    """The same scan as one SQL statement over ``documents``."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    known = ", ".join(f"{quote(s)}: '<{name}>'" for name, group in tables.sentences for s in group)
    steps, last = [], "identifiers"
    for k, (name, sequence) in enumerate(tables.rules):
        wanted = quote("".join(f"<{x}>" for x in sequence))
        steps.append(f"r{k} AS (SELECT *, CASE WHEN contains({last}, {wanted}) THEN '{name}' END AS h{k}, replace({last}, {wanted}, '|') AS l{k} FROM {f'r{k - 1}' if k else 's'})")
        last = f"l{k}"
    hits = ", ".join(f"h{k}" for k in range(len(tables.rules)))
    return f"""
WITH n AS (
  SELECT doc_id, list_transform(string_split(regexp_replace(regexp_replace(translate(coalesce(text, ''), '{UPPER}' || chr(1), '{LOWER} '),
         '[.!?]+(?:[ \\t\\n\\x0B\\f\\r]+|$)|\\n+', chr(1), 'g'), '[^a-z0-9.\\x01]+', ' ', 'g'), chr(1)), lambda x: trim(x)) AS parts FROM documents
), s AS (
  SELECT doc_id, coalesce(array_to_string(list_filter(list_transform(parts, lambda x: MAP {{{known}}}[x]), lambda x: x IS NOT NULL), ''), '') AS identifiers FROM n
), {', '.join(steps)}, f AS (
  SELECT doc_id, identifiers, {last} AS l, list_sort(list_distinct(list_filter([{hits}], lambda x: x IS NOT NULL))) AS found FROM r{len(tables.rules) - 1}
)
SELECT doc_id, identifiers, coalesce(array_to_string(found, '|'), '') AS licences, len(found)::BIGINT AS n_licences, replace(l, '|', '') AS unmatched FROM f
"""
