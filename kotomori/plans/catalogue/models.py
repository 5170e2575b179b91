"""Model queries. Trees and solvers have no SQL twin: these are checked by their
rows and, in the tests, by their metrics."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.sql import Column
from pyspark.sql import functions as F

from kotomori.functions.evasion import SIGNALS as SIGNAL_COLUMNS
from kotomori.functions.evasion import with_evasion
from kotomori.operators import classify as C
from kotomori.operators.features import TfidfModel, fit_hashed_tfidf
from kotomori.config import LABELS
from kotomori.plans.catalogue.base import SIGNALS, documents, evaded, labelled, register
from kotomori.plans.catalogue.evasion import CLEAN_FIRST
from kotomori.plans.catalogue.labels import RANKED
from kotomori.plans.scoring import score_corpus, score_rows
from kotomori.plans.training import prepared_split, train
from kotomori.session import pin, shared_folder
from kotomori.streaming.scoring import read_stream, score_stream, write_stream


@lru_cache(maxsize=4)
def _training_vectors(spark, sf):
    rows = prepared_split(labelled(spark, sf), "id", "text", "label")
    train_rows = rows.where(~F.col("is_test"))
    features = TfidfModel.fit(train_rows)
    return pin(features.transform(rows).select("id", "label_id", "is_test", "features"), "vectors")


@lru_cache(maxsize=4)
def trained(spark, sf):
    return train(labelled(spark, sf), folds=0)


def _train(spark, sf):
    return _training_vectors(spark, sf).where(~F.col("is_test")).drop("is_test")


def _test(spark, sf):
    return _training_vectors(spark, sf).where("is_test").drop("is_test")


def _held_out(run):
    """The held-out vectors of a training run, which has them as a table."""
    return run.vectors.where("is_test").drop("is_test", "row")


def _predictions(df):
    return df.select(
        F.col("id").alias("doc_id"),
        "predicted_class",
        *[F.round(F.get("probabilities", F.lit(i)), 6).alias(f"p{i}") for i in range(3)],
    )


@register("random_forest")
def random_forest(spark, sf):
    model = C.fit(C.random_forest(), C.training_frame(_train(spark, sf), "id"))
    return _predictions(C.predict(model, _test(spark, sf)))


@register("logistic_baseline")
def logistic_baseline(spark, sf):
    rows = _train(spark, sf)
    model = C.fit(C.logistic_baseline(rows.count()), C.training_frame(rows, "id"))
    return _predictions(C.predict(model, _test(spark, sf)))


@register("cross_validate")
def cross_validate(spark, sf):
    return C.cross_validate(_train(spark, sf), "id", lambda _: C.random_forest(), k=5)


@lru_cache(maxsize=4)
def searched(spark, sf):
    return C.grid_search(_train(spark, sf), "id")


@register("grid_search")
def grid_search(spark, sf):
    return C.grid_results(searched(spark, sf), _train(spark, sf))


@register("train_model")
def train_model(spark, sf):
    """Per-class report of the trained forest on the held-out rows."""
    return trained(spark, sf).report


@register("predict")
def predict(spark, sf):
    return _predictions(trained(spark, sf).predictions)


@register("train_summary")
def train_summary(spark, sf):
    return trained(spark, sf).summary


@register("save_model")
def save_model(spark, sf):
    path = shared_folder(spark, "classifier")
    run = trained(spark, sf)
    C.save_model(run.model, path)
    return _predictions(C.predict(C.load_model(path), _held_out(run)))


@register("save_spark_features")
def save_spark_features(spark, sf):
    path = shared_folder(spark, "hashed")
    docs = documents(spark, sf, "doc_id", "text")
    fit_hashed_tfidf(docs, "text", path, hash_bigrams=True)
    rows = PipelineModel.load(path).transform(docs)
    return rows.select("doc_id", F.size(F.unwrap_udt("features")["values"]).alias("nnz"))


@register("score_corpus")
def score_corpus_query(spark, sf):
    run = trained(spark, sf)
    return _flat(score_corpus(documents(spark, sf, "doc_id", "text"), "doc_id", run.model, run.features))


def _flat(records):
    """Prediction records with their flags as JSON text."""
    return records.withColumn("adversarial_flags", F.to_json("adversarial_flags"))


def _document_stream(spark, sf):
    """The documents as a stream, whether their table is one file or a folder of files: a
    pattern that only they match is taken for either."""
    schema = spark.read.parquet(f"{sf}/documents.parquet").schema
    return read_stream(spark, f"{sf}/documents.parque[t]", schema)


@register("stream_scores")
def stream_scores(spark, sf):
    run = trained(spark, sf)
    path, checkpoint = shared_folder(spark, "stream"), shared_folder(spark, "stream-state")
    rows = _document_stream(spark, sf)
    score_stream(rows, "doc_id", run.model, run.features, path, checkpoint, available_now=True).awaitTermination()
    return _flat(spark.read.parquet(path))


_PLAIN = SIGNALS.replace(SIGNALS[: SIGNALS.index("widened AS")], "evaded AS (SELECT doc_id, text AS raw FROM documents),\n", 1)


@register(
    "stream_evasion",
    f"""WITH {_PLAIN} SELECT doc_id, normalized AS t, {', '.join(SIGNAL_COLUMNS)}, round(risk, 6) AS risk FROM signals""".replace(
        "CASE WHEN doc_id % 8 = 1 THEN translate", "CASE WHEN false THEN translate"
    ),
)
def stream_evasion(spark, sf):
    rows = with_evasion(_document_stream(spark, sf).select("doc_id", "text"), "text").select(
        "doc_id", F.col("normalized").alias("t"), *SIGNAL_COLUMNS, F.round("risk", 6).alias("risk")
    )
    path, checkpoint = shared_folder(spark, "stream"), shared_folder(spark, "stream-state")
    write_stream(rows, path, checkpoint, available_now=True).awaitTermination()
    return spark.read.parquet(path)


# ---- what can be known exactly about a model's results ------------------------


@register(
    "score_corpus_checked",
    f"""WITH {CLEAN_FIRST}
SELECT doc_id, substr(e.raw, 1, 60) || '...' AS text_preview, round(s.risk, 6) AS risk, {", ".join(f"s.{x}" for x in SIGNAL_COLUMNS)},
  true AS tier_follows, true AS escalation_follows, true AS confidence_in_range
FROM signals s JOIN evaded e USING (doc_id)""",
)
def score_corpus_checked(spark, sf):
    """Scores of all evaded documents: what does not depend on the model, and whether the
    rest follows from class and risk."""
    run = trained(spark, sf)
    rows = evaded(spark, sf).withColumnRenamed("raw", "text")
    scored = score_rows(rows, run.model, run.features)
    abusive, other = F.col("predicted_class") == LABELS[0], F.col("predicted_class") == LABELS[2]
    tier = F.when(abusive & (F.col("risk") > 0.4), "CRITICAL").when(abusive, "HIGH").when(other, "LOW").otherwise("MEDIUM")
    return scored.select(
        "doc_id",
        F.concat(F.left("text", F.lit(60)), F.lit("...")).alias("text_preview"),
        F.round("risk", 6).alias("risk"),
        *SIGNAL_COLUMNS,
        (F.col("severity_tier") == tier).alias("tier_follows"),
        (F.col("escalate_to_human") == F.col("severity_tier").isin("HIGH", "CRITICAL")).alias("escalation_follows"),
        F.col("confidence").between(0.3333, 1.0).alias("confidence_in_range"),
    )


HELD_OUT = f"""WITH {RANKED} SELECT doc_id, true AS sums_to_one, true AS class_is_likeliest
FROM ranked WHERE r <= round(0.2::DOUBLE * n)"""


def _held_out_checked(scored):
    """Every held-out row, with what has to hold for its probabilities."""
    p = F.col("probabilities")
    total = F.aggregate(p, F.lit(0.0), lambda a, x: a + x)
    likeliest = F.get(p, F.col("y_pred")) == F.array_max(p)
    return scored.select(F.col("id").alias("doc_id"), (F.abs(total - 1) < 1e-9).alias("sums_to_one"), likeliest.alias("class_is_likeliest"))


@register("predict_checked", HELD_OUT)
def predict_checked(spark, sf):
    return _held_out_checked(trained(spark, sf).predictions)


def gradients(model, rows, n_rows: int) -> tuple[float, float]:
    """Greatest component of the gradient of the penalised loss over ``rows``, at the model's
    coefficients and at zero, from one pass: each task adds up the cells of its rows."""
    lr, classes = model.stages[-1], range(len(LABELS))
    size = lr.numFeatures

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2 * len(LABELS), size))
        for batch in batches:
            j, x = (batch.column(c).flatten().to_numpy() for c in ("j", "x"))
            row = np.repeat(np.arange(batch.num_rows), batch.column("j").value_lengths().to_numpy())
            for k, each in enumerate(total):
                each += np.bincount(j, weights=batch.column(f"e{k}").to_numpy()[row] * x, minlength=size)
        used = np.flatnonzero(total.any(axis=0))
        yield pa.record_batch({"j": used, **{f"g{k}": each[used] for k, each in enumerate(total)}})

    def error(k: int, p: Column) -> Column:
        return F.col("class_weight") * (p - F.when(F.col("label") == k, 1.0).otherwise(0.0))

    errors = [error(k, F.get("probabilities", F.lit(k))) for k in classes] + [error(k, F.lit(1 / len(LABELS))) for k in classes]
    cells = F.unwrap_udt("features")
    each = C.predict(model, C.training_frame(rows, "id")).select(cells["indices"].alias("j"), cells["values"].alias("x"), *[e.alias(f"e{k}") for k, e in enumerate(errors)])
    names = [f"g{k}" for k in range(len(errors))]
    partial = each.mapInArrow(sums, f"j long, {', '.join(f'{g} double' for g in names)}")
    found = partial.groupBy("j").agg(*[(F.sum(g) / n_rows).alias(g) for g in names]).toPandas()  # a row a term
    at_zero = found[names[len(LABELS) :]].to_numpy()
    penalty = lr.getRegParam() * lr.coefficientMatrix.toArray()[:, found["j"].to_numpy()].T
    at_model = found[names[: len(LABELS)]].to_numpy() + penalty
    return float(np.abs(at_model).max()), float(np.abs(at_zero).max())


@register("logistic_checked", f"WITH {RANKED} SELECT count(*) AS n_train, true AS gradient_vanishes FROM ranked WHERE r > round(0.2::DOUBLE * n)")
def logistic_checked(spark, sf):
    """Rows the regression was fitted on, and whether its loss is flat where it ended."""
    rows = _train(spark, sf)
    n = rows.count()
    model = C.fit(C.logistic_baseline(n), C.training_frame(rows, "id"))
    at_end, at_zero = gradients(model, rows, n)
    return rows.agg(F.count("*").alias("n_train")).withColumn("gradient_vanishes", F.lit(at_end < 0.05 * at_zero))


def majority_f1(rows, label="label_id"):
    """Macro F1 of the rule that always says the most frequent class."""
    counts = [r.n for r in rows.groupBy(label).agg(F.count("*").alias("n")).collect()]
    return 2 * max(counts) / (sum(counts) + max(counts)) / len(LABELS)


@register("random_forest_checked", f"WITH {RANKED} SELECT count(*) AS n_test, true AS beats_majority FROM ranked WHERE r <= round(0.2::DOUBLE * n)")
def random_forest_checked(spark, sf):
    """Held-out rows, and whether the forest tells their classes better than a constant."""
    test = _test(spark, sf)
    scored = C.predict(C.fit(C.random_forest(), C.training_frame(_train(spark, sf), "id")), test)
    counts = scored.agg(F.count("*").alias("n_test"))
    better = C.fold_metrics(scored).first()["f1_macro"] > 1.5 * majority_f1(test)
    return counts.withColumn("beats_majority", F.lit(better))


@register(
    "cross_validate_checked",
    """SELECT f.fold, true AS f1_in_order, true AS beats_majority FROM range(5) f(fold)""",
)
def cross_validate_checked(spark, sf):
    """A row a fold: whether its figures are possible and better than those of a constant."""
    rows = _train(spark, sf)
    constant = majority_f1(rows)
    folds = C.cross_validate(rows, "id", lambda _: C.random_forest(), k=5)
    possible = F.col("f1_macro").between(0, 1) & F.col("f1_weighted").between(0, 1) & F.col("accuracy").between(0, 1)
    return folds.select(F.col("fold").cast("long").alias("fold"), possible.alias("f1_in_order"), (F.col("f1_macro") > 1.5 * constant).alias("beats_majority"))


@register(
    "grid_search_checked",
    """SELECT t.x::INT AS trees, d.x::INT AS max_depth, m.x::INT AS min_instances, true AS beats_majority, true AS best_is_greatest
FROM (VALUES (100), (200)) t(x), (VALUES (30), (20)) d(x), (VALUES (1), (2)) m(x)""",
)
def grid_search_checked(spark, sf):
    """All candidates: whether each is better than a constant, and the first of the best is chosen."""
    rows = _train(spark, sf)
    found = searched(spark, sf)
    constant, greatest = majority_f1(rows), max(found.f1_macro)
    results = C.grid_results(found, rows).withColumn("greatest", F.lit(greatest))
    chosen = F.when(F.col("best"), F.col("f1_macro") == F.col("greatest")).otherwise(F.lit(found.f1_macro.index(greatest) == found.best))
    return results.select("trees", "max_depth", "min_instances", (F.col("f1_macro") > 1.5 * constant).alias("beats_majority"), chosen.alias("best_is_greatest"))


@register("save_model_checked", f"SELECT count(*) AS n, 0 AS n_changed FROM ({HELD_OUT})")
def save_model_checked(spark, sf):
    """A reloaded model gives each held-out row the same probabilities."""
    path = shared_folder(spark, "classifier")
    C.save_model(trained(spark, sf).model, path)
    again = C.predict(C.load_model(path), _held_out(trained(spark, sf))).select("id", F.col("probabilities").alias("p"))
    both = trained(spark, sf).predictions.select("id", "probabilities").join(again, "id", "full")
    return both.agg(F.count("*").alias("n"), F.count_if(~F.col("p").eqNullSafe(F.col("probabilities"))).cast("int").alias("n_changed"))


@register("train_model_checked", f"WITH {RANKED} SELECT label_id AS class_id, count(*) AS support FROM ranked WHERE r <= round(0.2::DOUBLE * n) GROUP BY label_id")
def train_model_checked(spark, sf):
    """Supports of the classes in the report of the trained forest."""
    report = trained(spark, sf).report
    ids = F.array_position(F.array(*[F.lit(x) for x in LABELS]), F.col("name")).cast("int") - 1
    return report.where(F.col("name").isin(*LABELS)).select(ids.alias("class_id"), "support")
