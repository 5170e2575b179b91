from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from kotomori.config import FOREST, FeatureSettings
from kotomori.operators import classify as C
from kotomori.operators.features import TfidfModel
from kotomori.plans.catalogue import models
from kotomori.plans.catalogue.base import documents, labelled
from kotomori.plans.scoring import documented_records, prediction_records, score_corpus, score_rows
from kotomori.plans.training import train
from kotomori.operators.triage import with_taxonomy
from kotomori.sources import corpus, sinks
from kotomori.sources.policy import builtin_taxonomy
from kotomori.streaming.scoring import read_stream, score_stream

SMALL = replace(FOREST, trees=10, max_depth=6, select_top=200, partitions=2)
TEXT = FeatureSettings(max_word_terms=2000, max_char_terms=1000)


@pytest.fixture(scope="module")
def run(spark, sf, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("run") / "out")
    return out, train(labelled(spark, sf), folds=2, output=out, settings=TEXT, forest=SMALL)


def test_training_run(spark, sf, run):
    out, r = run
    n = labelled(spark, sf).count()
    summary = r.summary.first()
    assert summary.train_samples + summary.test_samples == n
    for name in ("f1_macro", "f1_weighted", "severity_weighted_accuracy"):
        assert 0 <= summary[name] <= 1
    assert spark.read.json(f"{out}/summary").first().f1_macro == summary.f1_macro
    assert [x.fold for x in r.cross_validation.orderBy("fold").collect()] == [0, 1]
    means = C.cross_validation_summary(r.cross_validation).first()
    assert 0 <= means.accuracy_mean <= 1 and means.accuracy_std >= 0
    predictions = r.predictions.collect()
    assert all(sum(p.probabilities) == pytest.approx(1) and p.y_pred in (0, 1, 2) for p in predictions)
    wrong = sum(p.y_true != p.y_pred for p in predictions)
    good, bad = corpus.split_corrupt(corpus.scan_corpus(spark, f"{out}/error_analysis", r.errors.schema))
    assert good.count() == wrong == r.errors.count() and bad.isEmpty()


def test_loaded_models_score_alike(spark, sf, run):
    out, r = run
    features = TfidfModel.load(spark, f"{out}/vocabulary", TEXT)
    model = C.load_model(f"{out}/classifier")
    docs = documents(spark, sf, "doc_id", "text")
    a = score_corpus(docs, "doc_id", r.model, r.features)
    b = score_corpus(docs, "doc_id", model, features)
    key = lambda rows: sorted((x.doc_id, x.predicted_class, x.confidence, x.severity_tier) for x in rows)
    assert key(a.collect()) == key(b.collect())
    assert a.count() == docs.where("trim(text) <> ''").count()


def test_a_run_has_the_vectors_it_scored(spark, sf, run, monkeypatch):
    """So that a query on a trained run does not prepare, split and weigh the rows again."""
    _, r = run
    held_out = models._held_out(r)
    p = lambda df: sorted((x.id, *x.probabilities) for x in df.select("id", "probabilities").collect())
    assert held_out.columns == ["id", "label_id", "features"] and p(C.predict(r.model, held_out)) == p(r.predictions)
    monkeypatch.setattr(models, "trained", lambda spark, sf: r)
    monkeypatch.setattr(models, "_training_vectors", None)
    assert models.save_model(spark, sf).count() == r.predictions.count()
    assert tuple(models.save_model_checked(spark, sf).first()) == (r.predictions.count(), 0)


def test_records(spark, sf, run, tmp_path):
    _, r = run
    scored = score_rows(documents(spark, sf, "doc_id", "text"), r.model, r.features)
    records = prediction_records(scored, "doc_id")
    assert dict(records.dtypes) == {
        "doc_id": "bigint",
        "text_preview": "string",
        "predicted_class": "string",
        "confidence": "double",
        "severity_tier": "string",
        "escalate_to_human": "boolean",
        "adversarial_risk_score": "double",
        "adversarial_flags": "map<string,boolean>",
    }
    path = str(tmp_path / "json")
    sinks.sink_predictions_json(records, path, by_tier=True)
    back = spark.read.schema(records.schema).json(path)
    assert back.count() == records.count()
    assert back.where("escalate_to_human <> (severity_tier in ('HIGH', 'CRITICAL'))").isEmpty()
    rich = documented_records(with_taxonomy(scored, builtin_taxonomy(spark), "text")).first()
    assert rich.taxonomy.category == rich.predicted_class and isinstance(rich.taxonomy.flags, list)


def test_stream_equals_batch(spark, sf, run, tmp_path):
    _, r = run
    schema = spark.read.parquet(f"{sf}/documents.parquet").schema
    rows = read_stream(spark, sf, schema, file_filter="documents.parquet")
    path = str(tmp_path / "out")
    score_stream(rows, "doc_id", r.model, r.features, path, str(tmp_path / "state"), available_now=True).awaitTermination()
    batch = score_corpus(documents(spark, sf, "doc_id", "text"), "doc_id", r.model, r.features)
    columns = ["doc_id", "predicted_class", "confidence", "severity_tier"]
    a, b = spark.read.parquet(path).select(*columns), batch.select(*columns)
    assert a.count() == b.count() and a.exceptAll(b).isEmpty()


@pytest.fixture(scope="module")
def blobs(spark):
    """Three separable classes, one of them holding most rows."""
    from pyspark.ml.functions import array_to_vector

    y = F.when(F.col("id") % 10 == 0, 0).when(F.col("id") % 10 == 1, 2).otherwise(1)
    point = F.array(*[(F.col("label_id") == i).cast("double") + F.rand(i) * 0.2 for i in range(3)])
    df = spark.range(300).withColumn("label_id", y).withColumn("features", array_to_vector(point))
    return df.cache()


def test_classifiers_learn(spark, blobs):
    train_rows = C.training_frame(blobs, "id", 2)
    for estimator in (C.random_forest(replace(SMALL, select_top=None)), C.random_forest(replace(SMALL, select_top=2)), C.logistic_baseline(300)):
        scored = C.predict(estimator.fit(train_rows), blobs)
        assert C.fold_metrics(scored).first().f1_macro > 0.9


def test_forest_is_repeatable(blobs):
    fits = [C.random_forest(SMALL).fit(C.training_frame(df, "id", 2)) for df in (blobs, blobs.repartition(5))]
    a, b = ({r.id: r.probabilities for r in C.predict(m, blobs).collect()} for m in fits)
    assert all(a[i] == pytest.approx(b[i]) for i in a)


def test_grid_search(blobs):
    search = C.grid_search(blobs, "id", replace(SMALL, select_top=None), {"trees": (2, 5), "max_depth": (1, 4)})
    rows = C.grid_results(search, blobs).collect()
    assert len(rows) == 4 and sum(r.best for r in rows) == 1
    best = next(r for r in rows if r.best)
    assert best.f1_macro == max(r.f1_macro for r in rows)
    assert search.bestModel.stages[-1].getNumTrees == best.trees


def test_cross_validation_equals_fold_by_fold(spark, blobs):
    got = C.cross_validate(blobs, "id", lambda _: C.random_forest(replace(SMALL, select_top=None)), 3, partitions=2).collect()
    assert sorted(r.fold for r in got) == [0, 1, 2] and all(r.accuracy > 0.9 for r in got)


def test_refit_per_fold(spark, sf):
    rows = labelled(spark, sf).withColumnRenamed("text", "processed_text")
    rows = rows.withColumn("label_id", F.expr("case label when 'abusive_content' then 0 when 'quality_risk' then 2 else 1 end"))
    got = C.cross_validate_refit(rows, "id", TEXT, replace(SMALL, trees=3), 2).collect()
    assert len(got) == 2 and all(0 <= r.f1_macro <= 1 for r in got)


def test_gradients_equal_the_sums_of_all_cells(spark):
    """At the coefficients and at zero, by numpy over dense rows; the cells of a row never become
    rows of a shuffle, only the sums of a task do."""
    import numpy as np
    from pyspark.ml.linalg import Vectors

    rng = np.random.default_rng(3)
    x = np.where(rng.random((90, 12)) < 0.3, rng.random((90, 12)), 0.0)
    y = np.arange(90) % 3 * (np.arange(90) % 5 > 0)
    x[:, 0] += y
    rows = spark.createDataFrame([(i, int(y[i]), Vectors.sparse(12, np.flatnonzero(x[i]).tolist(), x[i][x[i] != 0].tolist())) for i in range(90)], ["id", "label_id", "features"])
    model = C.fit(C.logistic_baseline(90), C.training_frame(rows, "id", 4))
    lr = model.stages[-1]
    weight = (90 / (3 * np.bincount(y)))[y][:, None]
    z = x @ lr.coefficientMatrix.toArray().T + lr.interceptVector.toArray()
    p = np.exp(z) / np.exp(z).sum(axis=1, keepdims=True)
    at_end = x.T @ (weight * (p - np.eye(3)[y])) / 90 + lr.getRegParam() * lr.coefficientMatrix.toArray().T
    at_zero = x.T @ (weight * (1 / 3 - np.eye(3)[y])) / 90
    got = models.gradients(model, rows, 90)
    assert got == pytest.approx((np.abs(at_end).max(), np.abs(at_zero).max()), rel=1e-6)


def test_missing_columns_fail_early(spark):
    with pytest.raises(ValueError, match="label"):
        train(spark.range(1).withColumn("text", F.lit("x")))


def test_csv_round_trip_and_corrupt_rows(spark, tmp_path):
    odd = [(1, 'a "quoted", text\nwith lines', "x"), (2, "  spaces  ", "y"), (3, "猫", None)]
    df = spark.createDataFrame(odd, corpus.CORPUS)
    path = str(tmp_path / "c")
    sinks.sink_predictions_csv(df.coalesce(1), path)
    good, bad = corpus.split_corrupt(corpus.scan_corpus(spark, path))
    assert sorted(map(tuple, good.collect())) == odd and bad.isEmpty()
    broken = str(tmp_path / "b")
    spark.createDataFrame([("id,text,label",), ("7,fine,x",), ("nine,bad,x",)], "value string").coalesce(1).write.text(broken)
    good, bad = corpus.split_corrupt(corpus.scan_corpus(spark, broken))
    assert [r.id for r in good.collect()] == [7] and bad.count() == 1
    assert good.count() == good.select("text").count() == 1


def test_a_forest_below_its_limit_does_not_depend_on_it(spark):
    """What the grid search relies on: a limit that no tree reaches changes nothing."""
    import random
    from dataclasses import replace

    from pyspark.ml.linalg import Vectors

    rng = random.Random(1)
    rows = [(i, i % 3, Vectors.dense([rng.random() + (i % 3) * 0.3 for _ in range(6)])) for i in range(150)]
    train = C.training_frame(spark.createDataFrame(rows, ["id", "label_id", "features"]), "id", 3)
    deep = replace(C.FOREST, trees=12, max_depth=30, min_instances=1, partitions=3)
    model = C.random_forest(deep).fit(train)
    depth = max(t.depth for t in model.stages[-1].trees)
    assert not C.depth_binds(model, depth + 1) and C.depth_binds(model, depth) and depth < 29
    shallower = C.random_forest(replace(deep, max_depth=depth + 1)).fit(train)
    assert model.stages[-1].toDebugString.split("\n")[1:] == shallower.stages[-1].toDebugString.split("\n")[1:]
    limited = C.random_forest(replace(deep, max_depth=depth - 2)).fit(train)
    assert limited.stages[-1].totalNumNodes < model.stages[-1].totalNumNodes
