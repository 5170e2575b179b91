import itertools
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from kotomori.functions import evasion as E
from kotomori.operators.cleaning import high_risk_rate, prepare
from kotomori.config import CleanSettings
from tests.strings import column_of, random_strings

STRINGS = random_strings(1500, seed=11)


def analyse(spark, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    return E.with_evasion(df, "t").orderBy("id")


@pytest.mark.parametrize(
    ("function", "text", "expected"),
    [
        (E.fold_homoglyphs, "h0me!", "homei"),
        (E.strip_inserted_symbols, "死.ね a.b a..b a_.b a._b x_y", "死ね ab a..b a_b a_b xy"),
        (E.collapse_elongation, "dieeeee 😀😀😀😀 ab", "diee 😀😀 ab"),
        (E.collapse_elongation, "\n\n\n\x85\x85\x85", "\n\n\n\x85\x85"),
        (E.lexicon_hits, "死ね バカ 死亡", ["死[ね亡]", "馬鹿|バカ|ばか"]),
        (E.lexicon_hits, "hello", []),
    ],
)
def test_golden(one, function, text, expected):
    assert one(function, text) == expected


def test_symbols_are_removed_in_one_pass_over_the_original(spark):
    symbols, word = set(".·•*_-|/\\"), re.compile(r"\w")

    def brute(s):
        drop = [
            i
            for i in range(1, len(s) - 1)
            if s[i] in symbols and word.match(s[i - 1]) and word.match(s[i + 1])
        ]
        return "".join(c for i, c in enumerate(s) if i not in drop)

    assert column_of(spark, E.strip_inserted_symbols, STRINGS) == [brute(s) for s in STRINGS]


def test_runs_are_cut_to_two(spark):
    strings = [s + c * n + s for s, c, n in zip(STRINGS, itertools.cycle("a死😀."), itertools.cycle(range(6)))]

    def brute(s):
        parts = ["".join(g) for _, g in itertools.groupby(s)]
        return "".join(p if p[0] == "\n" else p[:2] for p in parts)

    assert column_of(spark, E.collapse_elongation, strings) == [brute(s) for s in strings]


def test_scripts_are_seen_after_folding(spark):
    info = analyse(spark, "犬!", "Жук", "犬", "2").select("script_info.*").collect()
    assert (info[0].japanese, info[0].latin, info[0].code_switching) == (True, True, True)
    assert (info[1].cyrillic, info[1].latin) == (True, False)
    assert not info[2].code_switching and info[3].numerals


def test_risk(spark):
    rows = analyse(
        spark,
        "plain",
        "h0w sooo",  # look-alike and elongation: exactly the limit
        "ａｂ а.б 死ね バカ ooooo",  # everything, two lexicon hits
        "死ね バカ くず",  # hits beyond the second do not count
    ).collect()
    assert rows[0].risk == 0.0
    assert rows[1].risk == pytest.approx(0.4) and not rows[1].risk > 0.4
    assert rows[2].risk == 1.0
    assert rows[3].risk == pytest.approx(0.6) and len(rows[3].abuse_patterns_found) == 3


def test_risk_stays_in_range_and_lengths_hold(spark):
    df = analyse(spark, *STRINGS).collect()
    assert all(0.0 <= r.risk <= 1.0 for r in df)
    assert all(r.original_length == len(r.t) for r in df)
    assert all(r.had_fullwidth == (unicodedata.normalize("NFKC", r.t) != r.t) for r in df)
    folded = column_of(spark, E.fold_homoglyphs, STRINGS)
    assert all(len(a) == len(b) for a, b in zip(folded, STRINGS))


def test_flags(spark):
    df = analyse(spark, "ａ 犬", "犬").select(E.flags_map().alias("m"), E.row_flags().alias("f")).collect()
    assert df[0].m == {"had_fullwidth": True} and df[0].f == ["adversarial_text_detected", "code_switching"]
    assert df[1].m == {} and df[1].f == []


def test_order_of_cleaning_and_analysis(spark):
    df = spark.createDataFrame([(1, "ａ.ｂ 死ね")], "id int, text string")
    first = prepare(df).first()
    assert not first.had_fullwidth and not first.had_symbol_insertion and first.abuse_patterns_found == []
    raw = prepare(df, settings=CleanSettings(order="raw_first")).first()
    assert raw.had_fullwidth and raw.had_symbol_insertion and raw.abuse_patterns_found == ["死[ね亡]"]
    assert raw.processed_text == "a b 死"
    with pytest.raises(ValueError):
        prepare(df, settings=CleanSettings(order="other"))


def test_high_risk_rate_is_strict_and_safe_when_empty(spark):
    rows = spark.createDataFrame([(0.4,), (0.41,), (0.0,)], "risk double")
    assert high_risk_rate(rows).first().asDict() == {"n": 3, "n_high": 1, "high_pct": 33.33}
    assert high_risk_rate(rows.where("false")).first().high_pct is None
