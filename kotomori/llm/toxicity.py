"""Toxicity of restored text.

Writers hide words behind look-alike digits, spaced letters and repeated letters. A
suspicious token is read as a noisy channel: each written character may stand for several
letters or for nothing, and Viterbi search finds the reading with the best product of
channel and character language model. The model is a trigram model over all texts.

The restored words and their first letters are the features of a logistic regression on
labelled documents; which of them count is learnt from the same documents.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from kotomori.llm.common import is_held_out, labelled_sample, register, slices, table, texts
from kotomori.session import pin

# What a written character may stand for.
STANDS_FOR = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i",
}
SEPARATORS = " .-_*~'·•"
EDGES = "\"'`.,;:!?()[]{}<>*%&#$~|/\\-_=+«»„“”‘’…"
PLAIN_EDGES = "".join(c for c in EDGES if c not in STANDS_FOR)

#: How often a mark at the edge of a word, or a digit of a number, is no letter.
NO_LETTER = {"$": 0.02, "@": 0.02, "€": 0.02, "£": 0.02, "|": 0.1, "+": 0.1} | dict.fromkeys("0123456789", 0.5)

#: Three or more single characters with separators between them. No character is both, so
#: there is one way to read a run.
SPACED = re.compile(r"(?<![^\W_])(?<![@$])(?:(?:[^\W_]|[@$!|])([ .*_~·•-])(?:\1)?){2,}(?:[^\W_]|[@$!|])(?![^\W_]|[@$])")
REPEATED = re.compile(r"([^\W\d_])\1\1")
LETTERS = re.compile(r"[^\W\d_]+")

CLASSES = 128


@dataclass(frozen=True)
class ToxicitySettings:
    #: Labelled documents used to fit, at most: those with the smallest hashes.
    sample: int = 20_000
    #: Log-likelihood ratio from which a feature counts.
    strength: float = 3.84
    #: Lengths of word beginnings that are features beside whole words.
    prefixes: tuple[int, ...] = (3, 4, 5, 6, 7)
    #: Toxic documents that a feature must occur in.
    least: int = 3
    penalty: float = 0.3
    steps: int = 30
    seed: int = 7
    remembered: int = 200_000


# ---- the language model ------------------------------------------------------


def class_table() -> np.ndarray:
    """Character class of each code point below 0x2000: 0 for what is no letter."""
    classes = np.zeros(0x2000, dtype=np.int64)
    for c in range(0x2000):
        low = chr(c).lower()
        if len(low) == 1 and low.isalpha():
            classes[c] = ord(low) - 96 if "a" <= low <= "z" else 27 + ord(low) % (CLASSES - 27)
    return classes


CLASS = class_table()


def class_of(letter: str) -> int:
    return int(CLASS[ord(letter)]) if ord(letter) < len(CLASS) else 27 + ord(letter) % (CLASSES - 27)


def trigram_counts(docs: DataFrame) -> np.ndarray:
    """How often each three classes follow each other in all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES**3, dtype=np.int64)
        for _, part in slices(batches):
            codes = np.frombuffer(" ".join(["", *part, ""]).encode("utf-32-le"), dtype=np.uint32)
            c = np.where(codes < len(CLASS), CLASS[np.minimum(codes, len(CLASS) - 1)], 27 + codes % (CLASSES - 27))
            if len(c) > 2:
                total += np.bincount((c[:-2] * CLASSES + c[1:-1]) * CLASSES + c[2:], minlength=len(total))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], ["gram", "n"])

    counts = np.zeros(CLASSES**3)
    for r in docs.select("text").mapInArrow(run, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect():
        counts[r.gram] = r.n  # at most CLASSES^3 rows
    return counts.reshape(CLASSES, CLASSES, CLASSES)


def log_model(counts: np.ndarray) -> np.ndarray:
    """log p(c | a, b), each order smoothed by the one below."""
    one = (counts.sum(axis=(0, 1)) + 1) / (counts.sum() + CLASSES)
    pairs = counts.sum(axis=0)
    two = (pairs + 8 * one) / (pairs.sum(axis=1, keepdims=True) + 8)
    three = (counts + 8 * two[None]) / (counts.sum(axis=2, keepdims=True) + 8)
    return np.log(three).astype(np.float32)


# ---- the channel -------------------------------------------------------------


def readings(written: str, i: int) -> list[tuple[str, float]]:
    """What the character at ``i`` may stand for, with log probabilities; "" is nothing
    and " " the end of a word."""
    c = written[i]
    if c.isalpha():
        options = [(c, log(0.95))]
        if i and written[i - 1] == c and (written[i - 2 : i - 1] == c or written[i + 1 : i + 2] == c):
            options = [(c, log(0.3)), ("", log(0.65))]
        return options
    stands = STANDS_FOR.get(c, "")
    options = [(x, log(0.7 / len(stands))) for x in stands]
    if i and written[i - 1] == c:
        options.append(("", log(0.2)))
    if c in SEPARATORS:
        options.append(("", log(0.6)))
    options.append((" ", log(0.002 if stands else 0.3)))
    return options


def restore(written: str, model: np.ndarray) -> str:
    """The best reading of ``written`` (lower case); spaces stand between words."""
    return best_reading(written, model)[0]


def best_reading(written: str, model: np.ndarray) -> tuple[str, float]:
    """The best reading and its log probability, in time linear in the length.

    Of the paths that end in the same two classes only the best can go on, so the search
    is exact; paths are chains of letters with their beginnings in common.
    """
    paths: dict = {(0, 0): (0.0, None)}
    for i in range(len(written)):
        longer: dict = {}
        options = [(x, class_of(x) if x.strip() else 0, p) for x, p in readings(written, i)]
        for (a, b), (score, out) in paths.items():
            for x, c, p in options:
                if not x:
                    state, total, text = (a, b), score + p, out
                else:
                    state, total, text = (b, c), score + p + float(model[a, b, c]), (out, x)
                if state not in longer or longer[state][0] < total:
                    longer[state] = (total, text)
        paths = longer
    closed = lambda kv: kv[1][0] + float(model[kv[0][0], kv[0][1], 0])
    best = max(paths.items(), key=closed)
    letters, chain = [], best[1][1]
    while chain:
        chain, x = chain
        letters.append(x)
    return "".join(reversed(letters)), closed(best)


class Restored(dict):
    """Written token -> restored words; starts afresh when full."""

    def __init__(self, model: np.ndarray, settings: ToxicitySettings):
        super().__init__()
        self.model, self.settings = model, settings

    def __missing__(self, token: str) -> str:
        wide = token.lower().strip(PLAIN_EDGES)
        core = wide.strip(EDGES)
        words, score = self.reading(core)
        if wide != core and not wide.isdigit():
            marks = wide.replace(core, "", 1) if core else wide
            more, other = best_reading(wide, self.model)
            if other > (self.score(words) if score is None else score) + sum(log(NO_LETTER.get(c, 0.3)) for c in marks):
                words = more
        if len(self) >= self.settings.remembered:
            self.clear()
        self[token] = words
        return words

    def reading(self, core: str) -> tuple[str, float | None]:
        """The words of a token without its edge marks, and their log probability; None for
        words as they are written, which only a token with edge marks asks for."""
        if core.isalpha() and not REPEATED.search(core):
            return core, None
        if not core:
            return "", 0.0
        if not any(c.isalpha() for c in core):
            number = sum(log(NO_LETTER.get(c, 0.3)) for c in core)
            if any(c in STANDS_FOR and not c.isdigit() for c in core):
                words, score = best_reading(core, self.model)
                if score > number:
                    return words, score
            return "", number
        if REPEATED.search(core) or any(c in STANDS_FOR or c in SEPARATORS for c in core):
            return best_reading(core, self.model)
        return " ".join(LETTERS.findall(core)), None

    def score(self, letters: str) -> float:
        """The log probability of words as they are written."""
        codes = [0, 0, *(class_of(c) if c.isalpha() else 0 for c in letters), 0]
        return sum(float(self.model[x]) for x in zip(codes, codes[1:], codes[2:])) + len(letters) * log(0.95)

    def tokens(self, text: str) -> list[str]:
        """The tokens of a text; letters with separators between them become one."""
        return SPACED.sub(self.joined, text).split()

    def joined(self, match: re.Match) -> str:
        run = match.group()
        if not any(c.isalpha() for c in run):
            return run
        return restore(run.lower(), self.model)

    def text(self, text: str) -> str:
        return " ".join(map(self.__getitem__, self.tokens(text)))


# ---- the classifier ----------------------------------------------------------


def word_features(word: str, settings: ToxicitySettings) -> list[int]:
    """Hashes of a word and of its beginnings."""
    raw = word.encode()
    if len(raw) == len(word):
        return [zlib.crc32(b"=" + raw)] + [zlib.crc32(raw[:n]) for n in settings.prefixes if len(raw) > n]
    return [zlib.crc32(b"=" + raw)] + [zlib.crc32(word[:n].encode()) for n in settings.prefixes if len(word) > n]


class TokenFeatures(dict):
    """Token -> its features, as hashes or, of those that are kept, as columns."""

    def __init__(self, restored: Restored, settings: ToxicitySettings, columns: dict[int, int] | None = None):
        super().__init__()
        self.restored, self.settings, self.columns = restored, settings, columns

    def __missing__(self, token: str) -> tuple[int, ...]:
        word = token.lower().strip(PLAIN_EDGES)
        if word.isalpha() and not REPEATED.search(word):  # read as written
            hashes = word_features(word, self.settings)
        else:
            hashes = [f for word in self.restored[token].split() for f in word_features(word, self.settings)]
        found = tuple(hashes if self.columns is None else (self.columns[h] for h in hashes if h in self.columns))
        if len(self) >= self.settings.remembered:
            self.clear()
        self[token] = found
        return found

    def of(self, text: str) -> list[int]:
        out: set[int] = set()
        for found in map(self.__getitem__, set(self.restored.tokens(text))):
            out.update(found)
        return sorted(out)


@dataclass(frozen=True)
class ToxicityModel:
    language: np.ndarray
    columns: dict[int, int]
    weights: np.ndarray  # the last one is the intercept

    def score(self, columns: list[int]) -> float:
        z = float(self.weights[columns].sum() + self.weights[-1])
        return 1.0 / (1.0 + np.exp(-min(30.0, max(-30.0, z))))


def logistic(found: list[list[int]], n_columns: int, y: np.ndarray, settings: ToxicitySettings) -> np.ndarray:
    """Penalised logistic regression on the columns that each row has; the intercept is free.

    Newton steps whose systems are solved by conjugate gradients, so that time and memory
    go with the columns found and not with rows times columns.
    """
    found = [[*columns, n_columns] for columns in found]
    row = np.repeat(np.arange(len(found)), [len(c) for c in found])
    col = np.array([c for columns in found for c in columns], dtype=np.int64)
    n = n_columns + 1
    w, ridge = np.zeros(n), np.full(n, settings.penalty)
    ridge[-1] = 1e-6
    times = lambda v: np.bincount(row, v[col], len(found))
    back = lambda v: np.bincount(col, v[row], n)
    for _ in range(settings.steps):
        p = 1 / (1 + np.exp(-np.clip(times(w), -30, 30)))
        spread = p * (1 - p)
        scale = back(spread) + ridge  # the diagonal, as columns are 0 or 1
        rest = back(y - p) - ridge * w
        goal = 1e-8 * np.sqrt(rest @ rest) + 1e-12
        step, z = np.zeros(n), rest / scale
        way, now = z, rest @ z
        for _ in range(10 * settings.steps):
            if np.sqrt(rest @ rest) <= goal:
                break
            bent = back(spread * times(way)) + ridge * way
            length = now / (way @ bent)
            step, rest = step + length * way, rest - length * bent
            z = rest / scale
            before, now = now, rest @ z
            way = z + now / before * way
        w = w + step * min(1.0, 5.0 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-4:
            break
    return w


def association(n1: np.ndarray, n0: np.ndarray, all1: int, all0: int) -> np.ndarray:
    """Signed log-likelihood ratio of features occurring in ``n1`` and ``n0`` documents."""

    def part(n, of, n_all, of_all):
        p, q = (n + 1e-9) / of, (n_all + 1e-9) / of_all
        return n * np.log(p / q) + (of - n) * np.log(np.maximum(1 - p, 1e-9) / np.maximum(1 - q, 1e-9))

    both, every = n1 + n0, all1 + all0
    return (part(n1, all1, both, every) + part(n0, all0, both, every)) * np.sign(n1 / all1 - n0 / all0)


def fit_toxicity(docs: DataFrame, labels: DataFrame, settings: ToxicitySettings, key: str = "doc_id", text: str = "text", label: str = "toxic") -> ToxicityModel:
    """The language model from all ``docs``, the classifier from a sample of labelled ones.

    Labels that are null or not 0 or 1 are left out, and so are those of held-out
    documents. Without documents of both labels no feature counts and the score is the
    smoothed share of label 1. An empty table gives the same.
    """
    rows = texts(docs, key, text)
    language = log_model(trigram_counts(rows))
    held = docs.sparkSession.sparkContext.broadcast(language)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = TokenFeatures(Restored(held.value, settings), settings).of
        for batch, part in slices(batches):
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array([of(t) for t in part], pa.list_(pa.int64()))], ["label", "x"])

    chosen = labelled_sample(rows, labels, key, label, settings.sample, settings.seed).select("label", "text")
    sample = pin(chosen.mapInArrow(features, "label int, x array<long>"), "toxicity-sample")  # at most ``sample`` rows
    all1, all0 = sample.agg(F.count_if(F.col("label") == 1), F.count_if(F.col("label") == 0)).first()
    if not all1 or not all0:
        share = (all1 + 0.5) / (all1 + all0 + 1)
        return ToxicityModel(language, {}, np.array([log(share / (1 - share))]))
    held_by = sample.select("label", F.explode("x").alias("feature")).groupBy("feature")
    sums = held_by.agg(F.count_if(F.col("label") == 0).alias("n0"), F.count_if(F.col("label") == 1).alias("n1"))
    got = sums.where(F.col("n1") >= settings.least).collect()  # features of a bounded sample
    feature, n0, n1 = (np.array([r[i] for r in got], dtype=np.int64) for i in range(3))
    strength = association(n1, n0, all1, all0) if len(got) else np.empty(0)
    columns = {f: k for k, f in enumerate(sorted(feature[strength >= settings.strength].tolist()))}
    found = sorted((r.label, [columns[f] for f in r.x if f in columns]) for r in sample.toLocalIterator())
    return ToxicityModel(language, columns, logistic([x for _, x in found], len(columns), np.array([y for y, _ in found], dtype=float), settings))


def score_toxicity(docs: DataFrame, model: ToxicityModel, settings: ToxicitySettings, text: str = "text", restored: str | None = None) -> DataFrame:
    """``docs`` with a last column ``score``, the probability of label 1, and before it the
    restored text if ``restored`` names a column for it. A null or empty text scores
    like one without words. All rows stay, and all columns but those of these names."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    extra = [StructField(restored, StringType())] if restored else []
    extra.append(StructField("score", DoubleType()))
    fields = [f for f in docs.schema.fields if f.name not in {e.name for e in extra}]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        words = Restored(model.language, settings)
        features = TokenFeatures(words, settings, model.columns)
        for batch, part in slices(batches, text):
            part = [t or "" for t in part]
            more = [pa.array([words.text(t) for t in part], pa.string())] if restored else []
            scores = pa.array([model.score(features.of(t)) for t in part], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, *more, scores], [*batch.schema.names, *(e.name for e in extra)])

    kept = docs.select(*[f"`{f.name}`" for f in fields])
    return kept.mapInArrow(run, StructType([*kept.schema.fields, *extra]))


@register("op7_toxicity")
def op7_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    settings, docs = ToxicitySettings(), table(spark, sf, "documents").select("doc_id", "text")
    scored = score_toxicity(docs, fit_toxicity(docs, table(spark, sf, "labels"), settings), settings)
    return scored.select("doc_id", is_held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
