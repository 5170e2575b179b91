"""What the plans must and must not contain."""

import re

import pytest

from kotomori.config import CleanSettings
from kotomori.functions.evasion import with_evasion
from kotomori.operators import features as FE
from kotomori.operators.cleaning import clean_corpus, prepare
from kotomori.operators.splits import stratified_split
from kotomori.operators.triage import with_policy_tier
from kotomori.plans.catalogue import ORACLES, QUERIES
from kotomori.plans.catalogue.base import judged, labels, scored, table
from kotomori.session import SPREAD, spread
from kotomori.sources.policy import builtin_tier_policy

EAGER = {n for n in ORACLES if n.startswith(("sink_", "scan_", "save_", "stream_")) or n in ("fit_features", "transform_features")}
EAGER |= {"grid_search_checked", "cross_validate_checked", "random_forest_checked"}  # fit models of their own


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(ORACLES) - EAGER))
def test_no_product_joins(spark, sf, name):
    text = plan(QUERIES[name](spark, sf))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_evasion_reads_two_columns_and_stays_in_the_jvm(spark, sf):
    text = plan(with_evasion(table(spark, sf, "documents").select("doc_id", "text"), "text"))
    assert "Python" not in text and "Exchange" not in text
    assert re.search(r"ReadSchema: struct<doc_id:bigint,text:string>", text)


def test_every_step_is_evaluated_once(spark, sf):
    df = with_evasion(table(spark, sf, "documents").select("doc_id", "text"), "text").select("doc_id", "risk")
    text = df._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("translate(") == 1
    assert text.count("reflect(") == 1


def test_counting_is_not_copied_into_a_filter(spark, sf):
    df = FE.document_terms(table(spark, sf, "documents"), "doc_id", "text", "char")
    text = df._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("sort_array(") == 1 and text.count("filter(sequence") == 1


def test_corpus_statistics_shuffle_by_term_only(spark, sf):
    text = plan(FE.doc_freq(table(spark, sf, "documents"), "text", "word"))
    assert set(re.findall(r"hashpartitioning\((\w+)#", text)) == {"term"}
    assert "partial_count" in text


def test_scoring_does_not_shuffle(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    vectors = FE.TfidfModel.fit(docs, "text").transform(docs, "text")
    assert "Exchange" not in plan(vectors)


def test_policy_join_keeps_the_large_side_in_place(spark, sf):
    df = with_policy_tier(scored(spark, sf).drop("lang"), builtin_tier_policy(spark))
    text = plan(df)
    assert "hashpartitioning(predicted_class" not in text.split("BroadcastExchange")[0]


def test_split_keeps_the_large_side_in_place(spark, sf):
    text = plan(stratified_split(labels(spark, sf), "label_id", "doc_id"))
    first = text.split("BroadcastExchange")[0]
    assert "BroadcastHashJoin" in first and "hashpartitioning" not in first


@pytest.mark.parametrize(
    "flow",
    [
        lambda d, w: with_evasion(d, "text", where=w),
        lambda d, w: clean_corpus(d, where=w),
        lambda d, w: prepare(d, where=w),
        lambda d, w: prepare(d, settings=CleanSettings(order="raw_first"), where=w),
    ],
)
def test_filters_reach_the_scan(spark, sf, flow):
    """A condition on the input is part of the scan, and of several columns only those in
    use are read."""
    rows = flow(table(spark, sf, "documents"), "lang = 'en'").drop("text")
    text = plan(rows.select("doc_id", *[c for c in ("risk", "processed_text") if c in rows.columns]))
    assert "EqualTo(lang,en)" in text and "reflect" in text
    assert set(re.findall(r"ReadSchema: struct<(.*)>", text)) == {"doc_id:bigint,text:string,lang:string"}


def test_nothing_is_dealt_out_unless_asked(spark, sf):
    kept = spark.conf.get(SPREAD)
    docs = table(spark, sf, "documents")
    try:
        assert "RoundRobinPartitioning(8)" in plan(spread(docs))
        spark.conf.set(SPREAD, "3")
        assert spread(docs).rdd.getNumPartitions() == 3
        spark.conf.unset(SPREAD)
        assert "Exchange" not in plan(spread(docs))
    finally:
        spark.conf.set(SPREAD, kept)


def test_lemmas_cut_texts_once(spark, sf):
    """Words, lemmas and rows come from the tokens that were written."""
    text = QUERIES["lemmatise"](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" not in text


def test_metrics_analyse_labelled_documents_only(spark, sf):
    text = judged(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert text.index("reflect(") < text.index("Join Inner")  # the join is below the chain
