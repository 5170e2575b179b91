import re
import sys
import unicodedata

import pytest
from pyspark.sql import functions as F

from kotomori.config import LOOKALIKE_FROM, LOOKALIKE_TO, STOPWORDS, CleanSettings
from kotomori.functions import text as X
from kotomori.operators.cleaning import clean_corpus, drop_report, lemmatise
from tests.strings import column_of, random_strings

STRINGS = random_strings(1500)


@pytest.mark.parametrize(
    ("function", "text", "expected"),
    [
        (X.nfkc, "ｘ１２　ｙ", "x12 y"),
        (X.nfkc, "ﾊﾞｶ", "バカ"),
        (X.nfkc, None, None),
        (X.strip_urls, "see https://h.example/p now", "see  now"),
        (X.strip_urls, "www.h.example/p?q now", " now"),
        (lambda c: X.strip_html(X.strip_urls(c)), "<a href=https://h.example/>go</a> end", "<a href= end"),
        (X.squash_ws, "a\x1cb\x85c", "a b c"),
        (X.guard_text, None, ""),
        (X.guard_text, " 　\x1c", ""),
        (X.char_tokens, "a😀死 b", ["a", "😀", "死", "b"]),
        (X.segment_tokens, "abc死ねクズdef_1 こん é", ["abc", "死", "ね", "クズ", "def_1", "こん", "é"]),
        (X.segment_tokens, "Жук αβ 한국어!", ["Жук", "αβ", "한국어", "!"]),
        (lambda c: X.drop_stopwords(X.char_tokens(c)), "猫が好き", ["猫", "好", "き"]),
        (X.clean_text, "<b>Ａ</b>　https://h.example/x b", "A b"),
        (X.preview, "x" * 70, "x" * 60 + "..."),
        (X.preview, "ab", "ab..."),
    ],
)
def test_golden(one, function, text, expected):
    assert one(function, text) == expected


def test_nfkc_is_the_standard_form(spark):
    want = [unicodedata.normalize("NFKC", s) for s in STRINGS]
    assert column_of(spark, X.nfkc, STRINGS) == want


def test_whitespace_is_unicode_whitespace(spark):
    assert column_of(spark, X.squash_ws, STRINGS) == [re.sub(r"\s+", " ", s).strip() for s in STRINGS]
    assert column_of(spark, X.char_tokens, STRINGS) == [[c for c in s if c.strip()] for s in STRINGS]


def test_every_space_and_word_character(spark):
    """The spelled-out classes agree with the Unicode definitions, character by
    character; younger characters depend on the Java release."""
    known = unicodedata.ucd_3_2_0.category
    chars = [chr(i) for i in range(sys.maxunicode + 1) if known(chr(i)) not in ("Cn", "Cs")]
    df = spark.createDataFrame([(c,) for c in chars], "t string")
    got = df.where(F.col("t").rlike(X.NON_SPACE)).count()
    assert got == sum(not c.isspace() for c in chars)
    words = {r.t for r in df.where(F.col("t").rlike(X.WORD_CHAR)).collect()}
    assert words == {c for c in chars if re.match(r"\w", c)}


def test_cleaning_equals_the_steps_one_by_one(spark):
    """Stop words and spaces go at once, the text is read once by each step, and no character
    is a match of its own."""
    texts = [s + t for s in STRINGS[:300] for t in ("", " は\u3000死ねを <b>x</b> www.a.b/c d", "\x85から😀のhttp://")]
    plain = [c for c in STOPWORDS if len(c) == 1]

    def steps(s):
        s = unicodedata.normalize("NFKC", s) if s.strip() else ""
        s = re.sub(r"<[^>]+>", "", re.sub(r"https?://\S+|www\.\S+", "", s))
        return " ".join(c for c in s if c.strip() and c not in plain)

    assert column_of(spark, X.clean_text, texts) == [steps(s) for s in texts]
    df = spark.createDataFrame([("x",)], "t string").select(X.clean_text(F.col("t")).alias("c"))
    text = df._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("reflect(") == 1 and "regexp_extract_all" not in text


def test_kinds_of_a_segment_share_no_character():
    kinds = [re.compile(re.sub(r"\\x\{(\w+)\}", lambda m: rf"\U{int(m[1], 16):08x}", k)) for k in X.SCRIPT_RUN.split("|")]
    assert len(kinds) == 7 and set(X.SCRIPT_RUN_LATIN_FIRST.split("|")) == set(X.SCRIPT_RUN.split("|"))
    for c in map(chr, range(0x10000)):
        assert sum(k.match(c) is not None for k in kinds[:-1]) <= 1 and (kinds[-1].match(c) or not any(k.match(c) for k in kinds[:-1]))


def test_fixed_values():
    assert len(LOOKALIKE_FROM) == len(LOOKALIKE_TO) == len(set(LOOKALIKE_FROM)) == 28
    assert len(STOPWORDS) == len(set(STOPWORDS)) == 44


def test_blank_rows_are_dropped_and_counted(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, " 　"), (4, "<b>"), (5, "猫"), (6, "は")], "id int, text string")
    assert [r.id for r in clean_corpus(df).collect()] == [5]
    assert drop_report(df).first().asDict() == {"n_total": 6, "n_dropped": 5, "n_kept": 1}
    kept = clean_corpus(df, settings=CleanSettings(remove_stops=False))
    assert sorted(r.id for r in kept.collect()) == [5, 6]


def test_lemmatise_keeps_order_and_unknown_tokens(spark):
    df = spark.createDataFrame([(1, ["cats", "see", "cats", "dogs"]), (2, []), (3, None)], "id int, tokens array<string>")
    lemmas = spark.createDataFrame([("cats", "cat"), ("dogs", "dog")], "surface string, lemma string")
    rows = {r.id: r.tokens for r in lemmatise(df, lemmas, "id").collect()}
    assert rows == {1: ["cat", "see", "cat", "dog"], 2: [], 3: []}
