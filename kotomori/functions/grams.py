"""Token and n-gram arrays, and in-row counting.

Everything here works inside one row or one batch of rows. Counting a document's terms
before they are exploded means the first shuffle of a corpus statistic is keyed by term and
carries partial sums, never (document, term) pairs.

Case, accents and word characters are Spark's in both forms; the batch form takes texts in
which Spark has left one space between words, squashes the white space between characters
itself, cuts terms as numbers and counts them by sorting.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kotomori.functions.text import NON_WORD_RUN, SPACE_CHARS, WORD_CHAR, is_ascii, nfkd, squash_ws

# A position between two halves of a surrogate pair is not a character start.
_CHAR_START = r"(?![\x{DC00}-\x{DFFF}])"


@cache
def combining_class() -> str:
    """Regex class of all characters with a canonical combining class."""
    marks = [i for i in range(sys.maxunicode + 1) if unicodedata.combining(chr(i))]
    ranges: list[list[int]] = []
    for i in marks:
        if ranges and ranges[-1][1] == i - 1:
            ranges[-1][1] = i
        else:
            ranges.append([i, i])
    listed = "".join(rf"\x{{{a:x}}}-\x{{{b:x}}}" for a, b in ranges)
    # most characters fail the first half and never see the long list
    return rf"[\x{{{marks[0]:x}}}-\x{{10ffff}}&&[{listed}]]"


def strip_accents(c: Column) -> Column:
    """Lower case, decompose, drop combining marks."""
    low = F.lower(c)
    return F.when(is_ascii(low), low).otherwise(F.regexp_replace(nfkd(low), combining_class(), ""))


def word_tokens(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(f"{WORD_CHAR}+"), F.lit(0))


def word_ngrams(tokens: Column, low: int = 1, high: int = 2) -> Column:
    """All word n-grams of a token array, joined by one space."""

    def of_length(n: int) -> Column:
        if n == 1:
            return tokens
        # sequence() would count down for a short array, so that case comes first
        starts = F.sequence(F.lit(1), F.size(tokens) - (n - 1))
        joined = F.transform(starts, lambda i: F.array_join(F.slice(tokens, i, n), " "))
        return F.when(F.size(tokens) >= n, joined).otherwise(F.array().cast("array<string>"))

    return F.concat(*[of_length(n) for n in range(low, high + 1)])


def char_ngrams(c: Column, low: int = 2, high: int = 4) -> Column:
    """Character n-grams inside words padded by one space on each side.

    Neighbouring words share their padding space: a gram may start or end with it
    but never contain it, so a look-ahead at every position finds each gram of
    each padded word once, in one pass over the text.
    """
    if not 2 <= low <= 3 or high < low:
        raise ValueError("character n-grams need 2 <= low <= 3 and high >= low")
    padded = F.concat(F.lit(" "), squash_ws(F.lower(c)), F.lit(" "))

    def of_length(n: int) -> Column:
        inner = f"[^ ]{{{n - 2}}}" if n > 2 else ""
        # a two-character gram of an empty text would be the padding alone
        guard = "(?!  )" if n == 2 else ""
        pattern = f"(?s){_CHAR_START}{guard}(?=(.{inner}.))"
        return F.regexp_extract_all(padded, F.lit(pattern), F.lit(1))

    return F.concat(*[of_length(n) for n in range(low, high + 1)])


def with_term_counts(df: DataFrame, terms: str, out: str = "counts") -> DataFrame:
    """Add ``out``, an ``array<struct<term, tf>>`` counting the array ``terms``.

    Sort, find where runs start, measure the runs: n log n inside the row. The
    steps are separate projections, for an expression named twice in one
    higher-order function would be evaluated once per element.
    """
    runs = F.col("_sorted"), F.col("_starts")
    return (
        df.withColumn("_sorted", F.sort_array(terms))
        .withColumn(
            "_starts",
            F.filter(
                F.sequence(F.lit(0), F.size("_sorted") - 1),
                lambda i: (i == 0) | (F.get(runs[0], i) != F.get(runs[0], i - 1)),
            ),
        )
        .withColumn(
            out,
            F.when(
                F.size("_sorted") > 0,
                F.transform(
                    "_starts",
                    lambda at, k: F.struct(
                        F.get(runs[0], at).alias("term"),
                        (F.coalesce(F.get(runs[1], k + 1), F.size(runs[0])) - at)
                        .cast("long")
                        .alias("tf"),
                    ),
                ),
            ),
        )
        .drop("_sorted", "_starts")
    )


def inline_counts(df: DataFrame, *keep: str, counts: str = "counts") -> DataFrame:
    """One row per counted term.

    The outer form with a filter behind it: for the plain form Spark would infer a
    filter on the array and push a copy of the whole counting expression below it.
    """
    return df.select(*keep, F.inline_outer(counts)).where(F.col("term").isNotNull())


# ---- whole batches ------------------------------------------------------------

#: Characters counted at a time.
BATCH_CHARS = 1 << 21


def spaced(c: Column, block: str) -> Column:
    """The text that :func:`batch_counts` takes: the words of :func:`word_tokens` with spaces
    between them, or what :func:`char_ngrams` pads, before its white space is squashed."""
    if block == "word":
        return F.regexp_replace(strip_accents(c), NON_WORD_RUN, " ")
    return F.lower(c)


#: By code point, up to the last white space.
_IS_SPACE = np.zeros(max(map(ord, SPACE_CHARS)) + 2, bool)
_IS_SPACE[list(map(ord, SPACE_CHARS))] = True


def _numbered(keys: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The keys, all below ``end``, as numbers without gaps, and a place of each number; by a
    table if that is not much longer than the keys, else by sorting."""
    if end > 16 * len(keys):
        _, place, number = np.unique(keys, return_index=True, return_inverse=True)
        return number, place
    place = np.full(end, -1, np.int64)
    place[keys] = np.arange(len(keys))
    used = np.flatnonzero(place >= 0)
    place_of, place[used] = place[used], np.arange(len(used))
    return place[keys], place_of


def _tokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Row and word number of each word, in order, and the distinct words."""
    words = pc.split_pattern(pa.array(texts, pa.string()), " ")
    row = np.repeat(np.arange(len(texts)), words.value_lengths().to_numpy())
    words = words.flatten()
    full = pc.not_equal(words, "")
    coded = words.filter(full).dictionary_encode()
    return row[full.to_numpy(zero_copy_only=False)], coded.indices.to_numpy().astype(np.int64), coded.dictionary


def _word_terms(texts: list[str], low: int, high: int) -> Iterator[tuple[np.ndarray, np.ndarray, pa.Array]]:
    """By length: row and number of each n-gram of words, and the distinct n-grams."""
    row, word, words = _tokens(texts)
    number, terms = word, words
    for n in range(1, high + 1):
        if n > 1:  # each gram of a word less, with the word behind it
            before, last = number[: max(len(word) - n + 1, 0)], word[n - 1 :]
            number, first = _numbered(before * len(words) + last, len(terms) * len(words))
            terms = pc.binary_join_element_wise(terms.take(pa.array(before[first])), words.take(pa.array(last[first])), " ")
        inside = row[: len(number)] == row[n - 1 :]
        if n >= low:
            yield row[: len(number)][inside], number[inside], terms


def _char_terms(texts: list[str], low: int, high: int) -> Iterator[tuple[np.ndarray, np.ndarray, pa.Array]]:
    """As :func:`_word_terms`, of the characters of padded words. Neighbours share their padding,
    rows as well as words: no gram has it inside, and one that begins with it is of the next row."""
    text = f" {' '.join(texts)} "
    units = np.frombuffer(text.encode("utf-32-le"), "<u4")
    space = _IS_SPACE[np.minimum(units, len(_IS_SPACE) - 1)]
    row = np.repeat(np.arange(len(texts)), [len(t) + 1 for t in texts])
    if (units[space] != 32).any() or (space[1:] & space[:-1]).any():  # one space for a run, the last, which is of the row that follows
        kept = ~space | ~np.append(space[1:], False)
        units, space, row = np.where(space, np.uint32(32), units)[kept], space[kept], row[kept[:-1]]
        text = units.tobytes().decode("utf-32-le")
    letter, letters = _numbered(units, sys.maxunicode + 1)
    number, numbers, inside = letter, len(letters), ~space
    for n in range(2, high + 1):
        m = max(len(units) - n + 1, 0)
        number, first = _numbered(number[:m] * len(letters) + letter[n - 1 :], numbers * len(letters))
        numbers = len(first)
        inside = inside[:m] & ~space[n - 2 : n - 2 + m] if n > 2 else ~(space[:m] & space[1:])
        if n >= low:
            kept = np.flatnonzero(inside)
            term, place = _numbered(number[kept], numbers)
            yield row[kept], term, pa.array([text[i : i + n] for i in kept[place].tolist()], pa.string())


def _terms(texts: list[str], block: str, low: int, high: int) -> Iterator[tuple[np.ndarray, np.ndarray, pa.Array]]:
    return (_word_terms if block == "word" else _char_terms)(texts, low, high)


def _counted(texts: list[str], block: str, low: int, high: int) -> tuple[np.ndarray, pa.DictionaryArray, np.ndarray]:
    rows, terms, counts, distinct, n_terms = [], [], [], [], 0
    for row, term, found in _terms(texts, block, low, high):
        key, n = row * len(found) + term, len(texts) * len(found)
        if n <= 8 * len(key):  # no sort where the table of all pairs is not much longer
            count = np.bincount(key, minlength=n)
            key = np.flatnonzero(count)
            count = count[key]
        else:
            key, count = np.unique(key, return_counts=True)
        rows.append(key // max(len(found), 1))
        terms.append(key % max(len(found), 1) + n_terms)
        counts.append(count)
        distinct.append(found)
        n_terms += len(found)
    term = pa.DictionaryArray.from_arrays(pa.array(np.concatenate(terms)), pa.concat_arrays(distinct))
    return np.concatenate(rows), term, np.concatenate(counts)


def _batches(texts: list[str | None], block: str, low: int) -> Iterator[tuple[int, int, list[str]]]:
    if block == "char" and not 2 <= low <= 3:
        raise ValueError("character n-grams need 2 <= low <= 3 and high >= low")
    start = size = 0
    for end, text in enumerate(texts, 1):
        size += len(text or "")
        if size >= BATCH_CHARS or end == len(texts):
            yield start, end, [t or "" for t in texts[start:end]]
            start, size = end, 0


def batch_sums(texts: list[str | None], block: str, low: int, high: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """``(term, df, tf)``: terms, in how many of some rows each is, and how often."""
    for _, _, some in _batches(texts, block, low if high >= low else 0):
        for row, term, found in _terms(some, block, low, high):
            n, key = len(some) * len(found), row * len(found) + term
            if n <= 32 * len(key):  # no sort where the table of all pairs is not much longer
                seen = np.zeros(n, np.uint8)
                seen[key] = 1
                df = seen.reshape(len(some), len(found)).sum(axis=0, dtype=np.int64)
            else:
                key = np.sort(key)
                df = np.bincount(key[np.append(True, key[1:] != key[:-1])] % len(found), minlength=len(found)) if len(key) else key
            used = np.flatnonzero(df)  # a gram of words may end in another row
            yield found.take(pa.array(used)), df[used], np.bincount(term, minlength=len(found))[used]


def batch_counts(texts: list[str | None], block: str, low: int, high: int) -> Iterator[tuple[int, int, np.ndarray, pa.DictionaryArray, np.ndarray]]:
    """``(start, end, row, term, tf)``: the distinct terms of rows ``start`` to ``end``, with the
    place of their row behind ``start`` and their count there, in no order. ``term`` is coded by
    the distinct terms of the batch. A row counts as empty if it is null."""
    for start, end, some in _batches(texts, block, low if high >= low else 0):
        yield start, end, *_counted(some, block, low, high)
