"""Rows, columns and settings that must not get lost on the way."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from kotomori.config import FEATURES, LABELS
from kotomori.functions.evasion import with_evasion
from kotomori.operators import metrics as M
from kotomori.operators.cleaning import lemmatise
from kotomori.operators.features import TfidfModel
from kotomori.operators.triage import with_policy_tier, with_taxonomy
from kotomori.plans.catalogue import QUERIES
from kotomori.plans.catalogue.base import table
from kotomori.plans.training import prepared_split
from kotomori.sources import corpus


def written(spark, tmp_path, *lines):
    path = str(tmp_path / "csv")
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    return corpus.split_corrupt(corpus.scan_corpus(spark, path))


@pytest.mark.parametrize(
    "header, line",
    [("id,label,text", "7,x,hello"), ("text,label,id", "hello,x,7"), ("id,text,label,extra", "7,hello,x,more"), ("label,extra,id,text", "x,,7,hello")],
)
def test_columns_come_by_name(spark, tmp_path, header, line):
    good, bad = written(spark, tmp_path, header, line)
    row = good.first()
    assert (row.id, row.text, row.label) == (7, "hello", "x") and bad.isEmpty()
    assert set(good.columns) == set(header.split(","))


def test_a_missing_label_is_missing(spark, tmp_path):
    good, bad = written(spark, tmp_path, "id,text", "7,hello", "8,there")
    assert good.columns == ["id", "text"] and good.count() == 2 and bad.isEmpty()
    with pytest.raises(ValueError, match="label"):
        corpus.require_columns(good, "text", "label")


def test_unknown_labels_are_not_lost(spark):
    df = spark.createDataFrame([(i, f"text {i}", LABELS[i % 3] if i < 12 else ("typo", None)[i % 2]) for i in range(15)], "id long, text string, label string")
    from kotomori.operators.labels import unknown_labels

    assert prepared_split(df, "id", "text", "label").count() + unknown_labels(df).count() == 15


def test_classes_outside_the_domain_are_an_error(spark):
    df = spark.createDataFrame([(0, 0), (1, 7), (None, 1), (2, None), (1, 1)], "y_true int, y_pred int")
    with pytest.raises(Exception, match="3 rows with a class"):
        M.confusion_counts(df).collect()
    assert M.outside(df).count() == 3
    assert M.error_rate(M.confusion_counts(df.exceptAll(M.outside(df)))).first().n_total == 2


def test_rules_without_a_class_hold_for_all(spark):
    rows = spark.createDataFrame([(c, 0.9, 0.5) for c in (*LABELS, "other")], "predicted_class string, risk double, confidence double")
    rules = spark.createDataFrame([(1, 1, "CRITICAL", None, 0.5, None, None), (2, 2, "LOW", "other", None, None, None)], "priority int, rule_no int, tier string, predicted_class string, risk_min double, conf_min double, conf_max double")
    got = {r.predicted_class: r.policy_tier for r in with_policy_tier(rows, rules).collect()}
    assert got == {**dict.fromkeys(LABELS, "CRITICAL"), "other": "LOW"}
    phrases = spark.createDataFrame([(None, 1, "s", True, "bad")], "class string, position int, subcategory string, escalate boolean, phrase string")
    texts = spark.createDataFrame([(c, "so bad") for c in LABELS], "predicted_class string, t string")
    assert {r.subcategory for r in with_taxonomy(texts, phrases, "t").collect()} == {"s"}


def test_vocabulary_keeps_its_settings(spark, sf, tmp_path):
    settings = replace(FEATURES, word_ngrams=(1, 3), char_ngrams=(2, 5), max_word_terms=500, max_char_terms=400)
    docs = table(spark, sf, "documents").limit(40)
    model = TfidfModel.fit(docs, "text", settings)
    model.save(str(tmp_path / "m"))
    again = TfidfModel.load(spark, str(tmp_path / "m"))
    cells = lambda m: {r.doc_id: r.features for r in m.transform(docs, "text").select("doc_id", "features").collect()}
    assert again.settings == settings and cells(again) == cells(model)
    with pytest.raises(ValueError, match="fitted with"):
        TfidfModel.load(spark, str(tmp_path / "m"), FEATURES)


def test_lemmas_are_settled_and_rows_kept(spark):
    df = spark.createDataFrame([(1, ["b", "a", "b"]), (1, ["a"]), (None, ["a", "c"]), (2, None), (3, [])], "id long, tokens array<string>")
    lemmas = spark.createDataFrame([("a", "y"), ("a", "x"), ("b", None), ("c", "z")], "surface string, lemma string")
    got = sorted((str(r.id), r.tokens) for r in lemmatise(df, lemmas, "id").collect())
    assert got == [("1", ["b", "x", "b"]), ("1", ["x"]), ("2", []), ("3", []), ("None", ["x", "z"])]


def test_a_filter_does_not_repeat_the_chain(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    for df in (with_evasion(docs, "text"), with_evasion(docs, "text").where(F.col("risk") > 0.4), with_evasion(docs, "text").where("had_homoglyphs AND risk > 0.1")):
        assert df._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace(") <= 2


@pytest.mark.parametrize("name", ["review_queue", "error_rows"])
def test_triage_does_not_repeat_the_chain(spark, sf, name):
    """Two steps of the chain and two of the evasion that the query puts into the texts."""
    text = QUERIES[name](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("regexp_replace(") <= 4


@pytest.mark.parametrize("name", ["confidence", "tier_simple", "tier_policy", "auto_approve", "assign_taxonomy", "default_severity"])
def test_triage_sees_all_documents(spark, sf, name):
    assert QUERIES[name](spark, sf).count() == table(spark, sf, "documents").count()
