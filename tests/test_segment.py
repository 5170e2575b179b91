"""Cheapest paths against every way to cut a short text."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from kotomori.functions.text import segment_tokens
from kotomori.operators import segment
from kotomori.operators.cleaning import clean_corpus, prepare
from kotomori.operators.segment import LATTICE, dictionary_index, with_segments
from kotomori.plans.catalogue import QUERIES
from kotomori.sources.corpus import scan_dictionary

WORDS = [("東京", 5), ("京都", 5), ("東京都", 12), ("都", 9), ("に", 3), ("住む", 6), ("住", 9), ("ab", 4), ("abc", 4), ("a b", 7), ("ab", 30), ("", 1), (None, 2), ("死ね", None)]
TEXTS = ["東京都に住む", "京都", "abc abx ab", "a b", "xyz東京zz", "", None, "  　", "死ね死ね!", "😀東京😀", "ab", "ab", "カタカナ漢字かな", "都都都"]


def every_cut(runs, text, words):
    """The best of all cuts; a piece is a word, an unknown word in one run, or white space."""
    run_of, at = {}, 0
    for number, run in enumerate(runs):
        at = text.index(run, at)
        run_of.update({at + i: number for i in range(len(run))})
        at += len(run)
    found = []
    for cuts in itertools.product([False, True], repeat=max(len(text) - 1, 0)):
        places = [0, *[i + 1 for i, c in enumerate(cuts) if c], len(text)]
        cost, tokens = 0, []
        for i, j in zip(places, places[1:]):
            piece, kinds = text[i:j], {run_of.get(p) for p in range(i, j)}
            prices = [words[piece]] if piece in words else []
            if kinds == {None} and j == i + 1:
                if 0 <= min([0, *prices]):  # a blank costs nothing
                    continue
            if len(kinds) == 1 and None not in kinds:
                prices.append(LATTICE.unknown + LATTICE.unknown_char * len(piece))
            if not prices:
                break
            cost, tokens = cost + min(prices), [*tokens, piece]
        else:
            found.append((cost, len(tokens), [-len(t) for t in tokens], tokens))
    return min(found)[3] if text else []


def runs_of(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    return {r.text: r.runs for r in df.select("text", segment_tokens(F.col("text")).alias("runs")).collect()}


def prices(pairs):
    words = {}
    for word, cost in pairs:
        if word:
            words[word] = min(words.get(word, 10**9), LATTICE.word if cost is None else cost)
    return words


def test_segments_equal_every_cut(spark):
    df = spark.createDataFrame([(i, t, "kept") for i, t in enumerate(TEXTS)], "id long, text string, phrase string")
    rows = with_segments(df, spark.createDataFrame(WORDS, "word string, cost long")).collect()
    runs = runs_of(spark, [t for t in TEXTS if t])
    assert len(rows) == len(TEXTS) and set(rows[0].asDict()) == {"id", "text", "phrase", "tokens"}
    for r in rows:
        assert r.text == TEXTS[r.id]
        assert r.tokens == (None if r.text is None else every_cut(runs.get(r.text, []), r.text, prices(WORDS)))


def test_random_dictionaries(spark):
    rng = random.Random(3)
    text = lambda low, high: "".join(rng.choice("abカ漢 ") for _ in range(rng.randint(low, high)))
    texts = sorted({text(1, 9) for _ in range(120)})
    words = [(text(1, 4).replace(" ", "b"), rng.randint(1, 60)) for _ in range(40)]
    runs = runs_of(spark, texts)
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    for r in with_segments(df, spark.createDataFrame(words, "word string, cost int")).collect():
        assert r.tokens == every_cut(runs[r.text], r.text, prices(words)), r.text


@pytest.mark.parametrize("short", [0, 3, 10])
def test_short_words_by_task_and_others_by_join(spark, monkeypatch, short):
    """Wherever the bound of the words that tasks get falls, the cuts are the same."""
    monkeypatch.setattr(segment, "SHORT", short)
    df = spark.createDataFrame([(t,) for t in TEXTS if t], "text string")
    runs = runs_of(spark, [t for t in TEXTS if t])
    words = [*WORDS, ("abc abx ab", 1), ("カタカナ漢字かな", 3), ("都都都", 1)]
    rows = with_segments(df, spark.createDataFrame(words, "word string, cost long")).collect()
    assert all(r.tokens == every_cut(runs.get(r.text, []), r.text, prices(words)) for r in rows)


def test_short_words_do_not_travel(spark):
    """A text joins the long words it holds, not every short one."""
    df = spark.createDataFrame([("abcdefghij" * 20,)], "text string")
    words = spark.createDataFrame([("abcdefghij"[i:j], 5) for i in range(10) for j in range(i + 1, 11)], "word string, cost long")
    plan = with_segments(df, words)._jdf.queryExecution().optimizedPlan().toString()
    assert "char_length(phrase" in plan and "> 5" in plan


def test_nothing_known(spark):
    df = spark.createDataFrame([("東京abc、x",)], "text string")
    none = spark.createDataFrame([], "word string, cost long")
    assert with_segments(df, none).first().tokens == ["東京", "abc", "、", "x"]
    assert with_segments(df.limit(0), spark.createDataFrame(WORDS, "word string, cost long")).count() == 0
    assert with_segments(df, spark.createDataFrame([("東京a",)], "word string")).first().tokens == ["東京a", "bc", "、", "x"]


def test_a_long_text_in_linear_time(spark):
    text = "東京都に住む" * 20000
    df = spark.createDataFrame([(text,)], "text string")
    tokens = with_segments(df, spark.createDataFrame(WORDS, "word string, cost long")).first().tokens
    assert "".join(tokens) == text and tokens[:4] == ["東京都", "に", "住む", "東京都"]


def test_no_task_holds_the_dictionary(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet").select("text")
    words = df.select(F.col("text").alias("word"))
    plan = with_segments(df, words, index=dictionary_index(words))._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and plan.count("ArrowEvalPython") == 1


@pytest.mark.parametrize("order", ["clean_first", "raw_first"])
def test_cleaning_by_a_dictionary(spark, tmp_path, order):
    from kotomori.config import CleanSettings

    words = spark.createDataFrame([("東京都", "1"), ("住む", "x"), ("人", None)], "word string, cost string")
    words.write.option("header", True).csv(str(tmp_path / "words"))
    dictionary = scan_dictionary(spark, str(tmp_path / "words"))
    assert {(r.word, r.cost) for r in dictionary.collect()} == {("東京都", 1), ("住む", None), ("人", None)}
    df = spark.createDataFrame([(1, "東京都住む人 <b>https://x.jp/"), (2, " "), (3, None)], "id long, text string")
    assert [(r.id, r.processed_text) for r in clean_corpus(df, dictionary=dictionary).collect()] == [(1, "東京都 住む 人")]
    rows = prepare(df, settings=CleanSettings(order=order), dictionary=dictionary).select("id", "processed_text", "risk").collect()
    assert [(r.id, r.processed_text) for r in rows] == [(1, "東京都 住む 人")]


def test_spaces_found_again(spark, sf):
    """Of the corpus without spaces most words come back, and no character is lost."""
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    rows = QUERIES["segment_dictionary"](spark, sf).collect()
    assert len(rows) == len(docs)
    right = total = 0
    runs = runs_of(spark, [t for t in docs.values() if t])
    for r in rows:
        want = runs.get(docs[r.doc_id], [])
        got = r.tokens.split(" ") if r.tokens else []
        assert "".join(got) == "".join(want) and r.n_tokens == len(got)
        right, total = right + len(set(got) & set(want)), total + len(set(want))
    assert right > 0.8 * total
