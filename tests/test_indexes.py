"""Indexes of phrases and of rules against the comparison of everything with everything."""

import random

import pytest
from pyspark.sql import functions as F

from kotomori.config import DEFAULT_TIER, LABELS
from kotomori.operators.lexicon import candidates, phrase_index, text_grams, with_indexed_taxonomy, with_phrases
from kotomori.operators.rules import DEPTH, intervals_between, intervals_of, pinned_cells, with_indexed_policy_tier
from kotomori.operators.triage import uncertain_by_class, with_policy_tier, with_taxonomy

TEXTS = ["死ねクズ", "abcabcabd", "", None, "a", "ab", "😀死ね😀", "xyz abd 死", "aaaaaaaa", "aaaaaaaa", "the end."]
PHRASES = ["死ね", "死", "abd", "abca", "a", "aa", "aaa", "😀死", "z a", "end.", "ende", "", None, "nowhere", "クズ", "the end. "]


@pytest.mark.parametrize("rated", [True, False])
def test_phrases_equal_contains_over_all_pairs(spark, rated):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)], "id long, text string, digest string").select("id", "text")
    index = phrase_index(spark.createDataFrame([(p,) for p in PHRASES], "phrase string"), docs if rated else None)
    assert index.count() == len({p for p in PHRASES if p})
    got = {r.id: r.phrases_found for r in with_phrases(docs, "text", index).collect()}
    assert got == {i: sorted((p for p in set(PHRASES) if p and t and p in t), key=lambda p: p.encode()) for i, t in enumerate(TEXTS)}


def test_random_phrases(spark):
    rng = random.Random(4)
    texts = ["".join(rng.choice("abc ") for _ in range(rng.randint(0, 40))) for _ in range(150)]
    phrases = {"".join(rng.choice("abc ") for _ in range(rng.randint(1, 7))) for _ in range(300)}
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string")
    index = phrase_index(spark.createDataFrame([(p,) for p in phrases], "phrase string"), docs)
    got = {r.id: r.phrases_found for r in with_phrases(docs, "text", index).collect()}
    assert got == {i: sorted(p for p in phrases if p in t) for i, t in enumerate(texts)}


def test_nothing_to_find(spark):
    docs = spark.createDataFrame([(1, "abc")], "id long, text string")
    none = phrase_index(spark.createDataFrame([], "phrase string"), docs)
    assert with_phrases(docs, "text", none).first().phrases_found == []
    index = phrase_index(spark.createDataFrame([("abc",)], "phrase string"))
    assert with_phrases(docs.limit(0), "text", index).count() == 0


def test_rare_grams_keep_candidates_few(spark, sf):
    """Phrases that share all but one gram with every text are candidates of one text each."""
    docs = spark.createDataFrame([(i, f"the common passage, number {chr(0x4E00 + i)}") for i in range(300)], "id long, text string")
    phrases = docs.select(F.substring("text", 5, 99).alias("phrase"))
    found = candidates(docs, "text", phrase_index(phrases, docs))
    assert found.count() == 300


def test_phrases_of_common_grams_have_few_candidates(spark):
    """Of phrases whose short grams are in every text, candidates are those that a text holds."""
    rng = random.Random(8)
    words = ["".join(rng.choice("abcde") for _ in range(4)) for _ in range(60)]
    docs = spark.createDataFrame([(i, " ".join(rng.choice(words) for _ in range(300))) for i in range(40)], "id long, text string")
    phrases = spark.createDataFrame([(" ".join(rng.sample(words, 3)),) for _ in range(300)], "phrase string")
    index = phrase_index(phrases, docs)
    assert candidates(docs, "text", index).count() < 0.2 * 40 * index.count()


def test_grams_of_no_phrase_go_where_they_are_cut(spark):
    docs = spark.createDataFrame([("abcdefgh" * 50 + "needle",), ("hay" * 99,), (None,), ("😀needle",)], "text string")
    filed = phrase_index(spark.createDataFrame([("needle",), ("not there",)], "phrase string"))
    found = text_grams(docs, "text", filed)
    assert "Generate" not in found._jdf.queryExecution().executedPlan().toString()
    assert found.count() == 2 and {r.phrase for r in candidates(docs, "text", filed).collect()} == {"needle"}


def test_no_text_travels_with_its_grams(spark):
    docs = spark.createDataFrame([(1, "abc")], "id long, text string")
    plan = candidates(docs, "text", phrase_index(spark.createDataFrame([("abc",)], "phrase string")))._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_taxonomy_of_any_size_equals_the_folded_one(spark):
    rng = random.Random(9)
    text = lambda n: "".join(rng.choice("abcd") for _ in range(n))
    rows = [(i, rng.choice([*LABELS, None]), text(rng.randint(0, 30)) if i % 9 else None) for i in range(200)]
    terms = [(rng.choice([*LABELS, None]), rng.randint(0, 5), f"s{i}", i % 2 == 0, text(rng.randint(1, 5))) for i in range(80)] + [("negative_sentiment", 1, "none", False, None)]
    scored = spark.createDataFrame(rows, "id long, predicted_class string, text string")
    taxonomy = spark.createDataFrame(terms, "class string, position int, subcategory string, escalate boolean, phrase string")
    index = phrase_index(taxonomy, scored)
    got = with_indexed_taxonomy(scored, taxonomy, "text", index)
    want = with_taxonomy(scored, taxonomy.where("phrase IS NOT NULL"), "text")
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect()))


def test_intervals_cover_their_cells_once(spark):
    n = 1 << DEPTH
    bounds = [(a / n, b / n) for a in range(0, n, 5) for b in range(0, n, 3)] + [(None, 0.3), (0.3, None), (None, None), (-1.0, 2.0)]
    rows = spark.createDataFrame(bounds, "low double, high double").select("low", "high", intervals_between(F.col("low"), F.col("high")).alias("i")).collect()
    points = {r.x: set(r.i) for r in spark.createDataFrame([(c / n,) for c in range(n)], "x double").select("x", intervals_of(F.col("x")).alias("i")).collect()}
    for r in rows:
        for x, own in points.items():
            inside = (r.low is None or x >= int(max(r.low, 0) * n) / n) and (r.high is None or x <= r.high)
            assert len(own & set(r.i)) == inside, (r, x)
        assert len(set(r.i)) == len(r.i) <= 2 * DEPTH


def test_indexed_policy_equals_the_folded_one(spark):
    rng = random.Random(2)
    number = lambda p: None if rng.random() < p else round(rng.random(), 2)
    rules = [(rng.randint(1, 9), i, rng.choice(["CRITICAL", "HIGH", "MEDIUM", "LOW"]), rng.choice([*LABELS, None]), number(0.3), number(0.4), number(0.4)) for i in range(400)]
    rows = [(i, rng.choice([*LABELS, "other", None]), number(0.05), number(0.05)) for i in range(600)] + [(900, LABELS[0], 0.0, 1.0), (901, LABELS[0], 1.0, 0.0), (902, LABELS[1], 1.5, -0.5)]
    policy = spark.createDataFrame(rules, "priority int, rule_no int, tier string, predicted_class string, risk_min double, conf_min double, conf_max double")
    scored = spark.createDataFrame(rows, "id long, predicted_class string, risk double, confidence double")
    for some in (policy, policy.limit(0)):
        got, want = with_indexed_policy_tier(scored, some), with_policy_tier(scored, some)
        assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect()))
    assert {r.policy_tier for r in with_indexed_policy_tier(scored, policy.limit(0)).collect()} == {*DEFAULT_TIER, None}


def test_covering_rules_leave_one_a_cell(spark):
    """Ten thousand rules around the same points are few rows of the index."""
    rows = [(i % 7, i, "HIGH", LABELS[0], 0.0 + i / 1e6, None if i % 2 else 0.2 + i / 1e7, 0.9) for i in range(10_000)]
    policy = spark.createDataFrame(rows, "priority int, rule_no int, tier string, predicted_class string, risk_min double, conf_min double, conf_max double")
    firsts = policy.withColumn("_rule", F.struct("priority", "rule_no", "tier"))
    cells = pinned_cells(firsts)
    assert cells.where("risk_min IS NULL AND conf_min IS NULL AND conf_max IS NULL").groupBy("_risk_cell", "_conf_cell").count().where("count > 1").isEmpty()
    scored = spark.createDataFrame([(0, LABELS[0], 0.5, 0.5), (1, LABELS[0], 0.0045, 0.2004), (2, LABELS[0], 0.5, 0.9), (3, LABELS[0], 0.5, 0.91)], "id long, predicted_class string, risk double, confidence double")
    got, want = with_indexed_policy_tier(scored, policy), with_policy_tier(scored, policy)
    assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect()))


def test_uncertain_rows_are_limited_before_the_shuffle(spark):
    rng = random.Random(3)
    rows = [(i, LABELS[i % 7 % 3], sorted((rng.random() for _ in range(3)), reverse=True)) for i in range(2000)]
    scored = spark.createDataFrame(rows, "id long, predicted_class string, probabilities array<double>").repartition(6)
    found = uncertain_by_class(scored, "id", top=20)
    want = [(c, k + 1, i) for c in LABELS for k, (_, i) in enumerate(sorted((p[0] - p[1], i) for i, x, p in rows if x == c)[:20])]
    assert sorted((r.predicted_class, r["rank"], r.id) for r in found.collect()) == sorted(want)
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan  # before the shuffle, and after it
