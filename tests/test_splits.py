import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from kotomori.operators.labels import class_weights, decode, encode_labels, unknown_labels
from kotomori.operators.splits import kfold, stratified_split

SIZES = {"huge": 3001, "small": 41, "tiny": 3, "one": 1}


@pytest.fixture(scope="module")
def rows(spark):
    data = [(f"{name}-{i}", name) for name, n in SIZES.items() for i in range(n)]
    return spark.createDataFrame(data, "id string, label string").repartition(7)


def ranked(rows):
    """The plain definition: position by hash inside each class."""
    by_class = {}
    for r in rows.collect():
        by_class.setdefault(r.label, []).append((hashlib.md5(f"42|{r.id}".encode()).hexdigest(), r.id))
    return {k: {key: i + 1 for i, (_, key) in enumerate(sorted(v))} for k, v in by_class.items()}


@pytest.mark.parametrize("eager", [False, True])
def test_split_is_exact_for_every_class(rows, eager):
    ranks = ranked(rows)
    got = stratified_split(rows, "label", "id", eager=eager).collect()
    assert len(got) == sum(SIZES.values())
    assert all(r.is_test == (ranks[r.label][r.id] <= round(0.2 * SIZES[r.label])) for r in got)


@pytest.mark.parametrize("k", [3, 5])
def test_folds_are_even_and_ordered(rows, k):
    ranks = ranked(rows)
    got = kfold(rows, "label", "id", k).collect()
    for r in got:
        n = SIZES[r.label]
        assert r.fold == sum(ranks[r.label][r.id] > n * i // k for i in range(1, k))
    for label in SIZES:
        sizes = Counter(r.fold for r in got if r.label == label)
        assert max(sizes.values()) - min(sizes.get(f, 0) for f in range(k)) <= 1


def test_split_does_not_depend_on_partitioning(rows):
    a = stratified_split(rows, "label", "id").where("is_test").select("id")
    b = stratified_split(rows.coalesce(1), "label", "id").where("is_test").select("id")
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_labels(spark):
    df = spark.createDataFrame([("quality_risk",), ("abusive_content",), ("other",), (None,)], "label string")
    known = encode_labels(df).withColumn("back", decode(F.col("label_id")))
    assert {(r.label, r.label_id) for r in known.collect()} == {("quality_risk", 2), ("abusive_content", 0)}
    assert all(r.label == r.back for r in known.collect())
    assert {r.label for r in unknown_labels(df).collect()} == {"other", None}


def test_class_weights_balance(spark):
    df = spark.createDataFrame([(0,)] * 6 + [(1,)] * 3 + [(2,)], "label_id int")
    weights = {r.label_id: r.weight for r in class_weights(df).collect()}
    assert weights == pytest.approx({0: 10 / 18, 1: 10 / 9, 2: 10 / 3})
