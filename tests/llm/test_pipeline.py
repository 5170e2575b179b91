"""Each stage against what its operator decides, on its own input."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from kotomori.llm.simhash import SimHashSettings, near_duplicates
from kotomori.session import pin
from tests.llm.rows import awkward, empty


@pytest.fixture(scope="module")
def steps(spark, sf):
    docs, out = spark.read.parquet(f"{sf}/documents.parquet"), []
    for name, stage in pipeline.STAGES:
        before, docs = docs, pin(stage(spark, docs, sf), name)
        out.append((name, before, docs))
    return out


def test_order_and_columns(steps):
    assert [s[0] for s in steps] == ["quality", "near_duplicates", "secrets", "mixing", "packing"]
    assert all(tuple(after.columns) == pipeline.COLUMNS for _, _, after in steps[:-1])


def test_quality_keeps_clean_documents(spark, sf, steps):
    _, before, after = steps[0]
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    kept = after.select("doc_id").withColumn("kept", F.lit(1))
    share = {r.quality: r.share for r in labels.join(kept, "doc_id", "left").groupBy("quality").agg((F.count("kept") / F.count("*")).alias("share")).collect()}
    assert share[1] > 0.97 and share[0] < 0.5
    assert after.exceptAll(before).count() == 0


def test_one_of_each_group_stays(steps):
    _, before, after = steps[1]
    groups = near_duplicates(before, SimHashSettings()).select("doc_id", "component_id")
    kept = after.join(groups, "doc_id")
    assert after.exceptAll(before).count() == 0
    assert kept.count() == groups.select("component_id").distinct().count() == kept.select("component_id").distinct().count()


def test_secrets_go_and_documents_stay(steps):
    _, before, after = steps[2]
    assert Counter(r.doc_id for r in before.collect()) == Counter(r.doc_id for r in after.collect())
    texts = {r.doc_id: r for r in after.collect()}
    secret = re.compile(r"AKIA[A-Z0-9]{12,}|[0-9a-f]{32,}")
    assert not any(secret.search(r.text or "") for r in texts.values())
    for r in before.collect():
        if not secret.search(r.text) and not re.search("(?i)password|passwd|secret|token|api_?key|user|login|://", r.text):
            assert texts[r.doc_id].text == r.text
    assert all(r.n_chars == len(r.text) for r in texts.values())


def test_mix_repeats_at_most_twice(steps):
    _, before, after = steps[3]
    given, taken = Counter(before.collect()), Counter(after.collect())
    assert all(n <= 2 * given[r] for r, n in taken.items())
    words = lambda c: sum(n * len(r.text.split()) for r, n in c.items())
    assert words(taken) == pytest.approx(1.5 * words(given), rel=0.05)


def test_all_tokens_are_packed(steps):
    _, before, after = steps[4]
    assert after.select("doc_id").distinct().count() == before.select("doc_id").distinct().count()


@pytest.mark.parametrize("make", [awkward, empty])
def test_stages_take_awkward_rows(spark, sf, make):
    for _, stage in pipeline.STAGES:
        stage(spark, make(spark), sf).count()


def test_run(spark, sf, steps):
    assert pipeline.run(spark, sf).count() == steps[-1][2].count()
