"""Dictionary segmentation: the cheapest path through the word lattice of a text.

The dictionary is a table ``(word, cost)`` of any size. The index of rare grams (see
:mod:`kotomori.operators.lexicon`) finds the words that a text contains by an equi join, so
no task holds the dictionary but for a bounded number of its shortest words; a text then meets
only its own words, which are no more than its substrings. Costs are whole numbers. What no word covers is cut into unknown words,
each within one run of a script, at a cost to begin and one for each character.

Of all ways to cut a text the one of least cost is taken, then of fewest tokens, then the
one whose first token, second token and so on is the longest. White space between tokens
costs nothing and is left out; a word of the dictionary may hold some.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kotomori.config import CLEAN, CleanSettings
from kotomori.functions.text import clean_string, drop_stopwords, segment_tokens
from kotomori.operators.lexicon import phrase_index, text_grams
from kotomori.session import pin


@dataclass(frozen=True)
class LatticeCosts:
    #: A word of the dictionary without a cost.
    word: int = 10
    #: To begin an unknown word, and for each of its characters.
    unknown: int = 20
    unknown_char: int = 10


LATTICE = LatticeCosts()


def known_words(dictionary: DataFrame, costs: LatticeCosts = LATTICE) -> DataFrame:
    """``(phrase, cost)``: each word once, with the least of its costs; null and empty words go."""
    cost = F.col("cost").cast("long") if "cost" in dictionary.columns else F.lit(None).cast("long")
    named = dictionary.select(F.col("word").alias("phrase"), F.coalesce(cost, F.lit(costs.word)).alias("cost"))
    return named.where("phrase <> ''").groupBy("phrase").agg(F.min("cost").alias("cost"))


#: Grams of the index of words. Words up to this length are filed under themselves, so most
#: candidates are words that the text holds.
GRAM = 6
#: The shortest words go to every task, at most so many and shorter than a gram: they are in
#: most texts, so that sending each text its own would multiply it.
SHORT = 1 << 17


def dictionary_index(dictionary: DataFrame, costs: LatticeCosts = LATTICE, size: int = GRAM) -> DataFrame:
    """The index of a dictionary's words and their costs, as a table that many segmentations share."""
    words = known_words(dictionary, costs)
    return pin(phrase_index(words.select("phrase"), size=size).join(words, "phrase"), "dictionary-index")


def word_lengths(words: Iterable[str]) -> dict[str, set[int]]:
    """Lengths of the words that begin with a character."""
    lengths: dict[str, set[int]] = {}
    for word in words:
        lengths.setdefault(word[0], set()).add(len(word))
    return lengths


def cheapest(runs: list[str], text: str, words: dict[str, int], costs: LatticeCosts, shared: dict[str, int], short: dict[str, set[int]]) -> list[str]:
    """The tokens of one text; ``runs`` are its script runs in order, ``shared`` the words that
    all texts look up, of the lengths ``short``."""
    n = len(text)
    ends, at = [0] * n, 0  # where the run of a character ends; 0 for white space
    for run in runs:
        at = text.index(run, at)
        ends[at : at + len(run)] = [at + len(run)] * len(run)
        at += len(run)
    lengths = word_lengths(words)
    # from each place: (cost, tokens, minus the length of the first token), from the end on
    best = [(0, 0, 0)] * (n + 1)
    unknown = (0, 0, 0)
    for i in range(n - 1, -1, -1):
        after = best[i + 1]
        options = []
        if ends[i]:
            one = (after[0] + costs.unknown_char, after[1] + 1, -1)
            if ends[i] > i + 1:
                one = min(one, (unknown[0] + costs.unknown_char, unknown[1], unknown[2] - 1))
            unknown = one
            options.append((one[0] + costs.unknown, one[1], one[2]))
        else:
            options.append((after[0], after[1], 0))
        for known, sizes in ((shared, short), (words, lengths)):
            for length in sizes.get(text[i], ()):
                cost = known.get(text[i : i + length])
                if cost is not None and i + length <= n:
                    rest = best[i + length]
                    options.append((rest[0] + cost, rest[1] + 1, -length))
        best[i] = min(options)
    tokens, i = [], 0
    while i < n:
        length = -best[i][2]
        if length:
            tokens.append(text[i : i + length])
        i += length or 1
    return tokens


def lattice_tokens(text: Column, words: Column, costs: LatticeCosts = LATTICE, shared: dict[str, int] | None = None) -> Column:
    """The tokens of ``text`` given ``words``, ``array<struct<phrase, cost>>`` of words in it, and
    the words ``shared`` by all texts."""
    sent = SparkSession.active().sparkContext.broadcast((shared or {}, word_lengths(shared or {})))

    @F.pandas_udf("array<string>")
    def cut(text: pd.Series, runs: pd.Series, phrases: pd.Series, prices: pd.Series) -> pd.Series:
        rows = zip(text, runs, phrases, prices)
        return pd.Series([cheapest(list(r), t, dict(zip(p, map(int, c))), costs, *sent.value) for t, r, p, c in rows])

    given = F.coalesce(text, F.lit(""))
    none = F.array().cast("array<struct<phrase:string,cost:bigint>>")
    found = F.coalesce(words, none)
    return F.when(text.isNotNull(), cut(given, segment_tokens(given), found["phrase"], found["cost"]))


def with_segments(
    df: DataFrame, dictionary: DataFrame, text: str = "text", out: str = "tokens", index: DataFrame | None = None, costs: LatticeCosts = LATTICE
) -> DataFrame:
    """Add ``out``, the tokens of ``text`` by the dictionary; null for null, empty for a text
    without visible characters. All rows stay, and all columns but an earlier ``out``.

    ``index`` is that of the dictionary, if it is at hand, with the costs it was made with. Rows need no key: words are found
    by a hash of the text, and rows with equal texts share them. A word that another text of
    the same hash contains does no harm, as the lattice takes what stands in the text.
    """
    index = dictionary_index(dictionary, costs) if index is None else index
    short = index.where(F.char_length("phrase") < GRAM).orderBy(F.char_length("phrase"), "phrase").limit(SHORT)
    shared = {r.phrase: r.cost for r in short.select("phrase", "cost").collect()}  # at most SHORT words
    rest = index
    if shared:  # the others, by the last word that tasks get
        last = max(shared, key=lambda p: (len(p), p.encode()))
        rest = index.where((F.char_length("phrase") > len(last)) | ((F.char_length("phrase") == len(last)) & (F.col("phrase") > last)))
    found = text_grams(df, text, rest).join(rest.select("gram", "phrase", "cost"), "gram")
    per_text = found.groupBy("digest").agg(F.collect_set(F.struct("phrase", "cost")).alias("_words"))
    per_text = per_text.withColumnRenamed("digest", "_found")
    joined = df.withColumn("_digest", F.xxhash64(F.col(text))).join(per_text, F.col("_digest") == F.col("_found"), "left")
    return joined.withColumn(out, lattice_tokens(F.col(text), F.col("_words"), costs, shared)).drop("_digest", "_found", "_words")


def with_segmented_text(
    df: DataFrame,
    dictionary: DataFrame,
    text: str = "text",
    settings: CleanSettings = CLEAN,
    index: DataFrame | None = None,
    costs: LatticeCosts = LATTICE,
) -> DataFrame:
    """Add ``processed_text``: cleaned, cut by the dictionary, without stop words."""
    cleaned = df.withColumn("_clean", clean_string(F.col(text)))
    tokens = with_segments(cleaned, dictionary, "_clean", "_tokens", index, costs)
    kept = drop_stopwords(F.col("_tokens"), settings.stopwords) if settings.remove_stops else F.col("_tokens")
    return tokens.withColumn("processed_text", F.array_join(kept, " ")).drop("_clean", "_tokens")
