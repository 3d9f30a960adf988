"""Search of titles by words: an inverted index, entered by a query's rarest words only.

A title is found when it holds words of a query that make up ``share`` percent of the query's letters. Of a query's words in order of rarity only the first
few need a look-up: those up to the point where the words left could not make up that share by themselves. Frequent words ("the", a series' name) thus
rarely open their long posting lists. A title that several look-ups find is kept by the rarest word in common, so no ``distinct`` follows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from catalith.functions.text import normalize_title, tokens
from catalith.session import materialize

SHARE = 60


@dataclass(frozen=True)
class TitleIndex:
    """``vocabulary`` (word, freq) and ``postings`` (word, title, words); both are stored tables."""

    vocabulary: DataFrame
    postings: DataFrame


def _letters(words: Column) -> Column:
    return F.aggregate(words, F.lit(0), lambda n, w: n + F.length(w))


def title_index(titles: DataFrame, column: str = "title") -> TitleIndex:
    """Index of the distinct texts of a column; titles without words are in no posting list."""
    once = titles.select(F.col(column).alias("title")).where("title is not null").distinct()
    words = once.withColumn("words", F.array_distinct(tokens(normalize_title(F.col("title")))))
    postings = materialize(words.select(F.explode("words").alias("word"), "title", "words"), "postings")
    return TitleIndex(materialize(postings.groupBy("word").agg(F.count("*").alias("freq")), "vocabulary"), postings)


def looked_up(queries: DataFrame, vocabulary: DataFrame, share: int = SHARE) -> DataFrame:
    """(term, words, need, word): each distinct query's words from the rarest to the most frequent, and one row per word to look up."""
    words = queries.select("term").where("term is not null").distinct().withColumn("word", F.explode(F.array_distinct(tokens(normalize_title(F.col("term"))))))
    known = words.join(vocabulary, "word", "left").groupBy("term").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("freq", F.lit(0)).alias("freq"), "word"))).alias("o"))
    ordered = known.select("term", F.transform("o", lambda w: w["word"]).alias("words")).withColumn("need", _letters(F.col("words")) * share)
    opened = ordered.select("*", F.posexplode("words").alias("at", "word"))
    rest = _letters(F.slice("words", F.col("at") + 1, F.size("words")))
    return opened.where(rest * 100 >= F.col("need")).drop("at")


def search_titles(queries: DataFrame, index: TitleIndex, share: int = SHARE) -> DataFrame:
    """(term, title, shared): titles that hold words of ``share`` percent of a term's letters, and how many letters of it they share."""
    asked = looked_up(queries, index.vocabulary, share).withColumnRenamed("words", "asked")
    common = F.array_intersect("asked", "words")
    met = asked.join(index.postings, "word").withColumn("common", common).withColumn("shared", _letters(F.col("common")))
    return met.where((F.col("shared") * 100 >= F.col("need")) & (F.get("common", F.lit(0)) == F.col("word"))).select("term", "title", "shared")


def stored_hits(queries: DataFrame, index: TitleIndex, records: DataFrame, share: int = SHARE) -> DataFrame:
    """(query, pos, ..): the ``records`` (title, id, ..) found for each term, most shared letters first, then the shorter title, the title and the id."""
    found = search_titles(queries, index, share).withColumnRenamed("title", "__title")
    hits = found.join(records, F.col("__title") == F.col("title")).drop("__title")
    nearest = Window.partitionBy("term").orderBy(F.desc("shared"), F.length("title"), "title", "id")
    return hits.withColumn("pos", F.row_number().over(nearest)).drop("shared").withColumnRenamed("term", "query")


def indexed_search(
    records: DataFrame, terms: Callable[[DataFrame], DataFrame], select: Callable[[DataFrame, DataFrame], DataFrame], share: int = SHARE
) -> Callable[[DataFrame], DataFrame]:
    """A search over stored ``records`` (title, id, ..) as ``queries(row_id, name, year_hint) -> (row_id, id, ..)``.

    Rows that ask for the same name and year are answered once, so a name that a third of the rows holds costs one search; answers are joined back by the
    question. ``terms`` gives the texts a provider is searched with, ``select`` its rule over the hits.
    """
    index = title_index(records)

    def search(queries: DataFrame) -> DataFrame:
        question = F.to_json(F.struct("name", "year_hint"))
        once = materialize(queries.select(question.alias("row_id"), "name", "year_hint").distinct(), "questions")
        hits = materialize(stored_hits(terms(once).select("term"), index, records, share), "hits")
        answers = materialize(select(once, hits), "answers").withColumnRenamed("row_id", "__question")
        return queries.select("row_id", question.alias("__asked")).join(answers, F.col("__asked") == F.col("__question")).drop("__asked", "__question")

    return search
