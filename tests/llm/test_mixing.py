"""Targets against rounds of resharing; draws against their definition."""

import re
from collections import Counter, defaultdict

import pytest

from kotomori.llm.mixing import MixSettings, mix, op6_mixing, source_targets
from tests.llm.rows import awkward, empty


def plain_targets(sizes, share=1.5, most=2, weights=(3, 1, 2)):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode("utf-32-be")))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    targets, open_ = {}, set(order)
    while open_:
        left, whole = share * sum(sizes.values()) - sum(targets.values()), sum(w[s] for s in open_)
        over = [s for s in open_ if left * w[s] / whole > most * sizes[s]]
        if not over:
            targets.update({s: left * w[s] / whole for s in open_})
            break
        targets.update({s: float(most * sizes[s]) for s in over})
        open_ -= set(over)
    return targets


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 10, "b": 10, "c": 10},
        {"a": 1, "b": 1000, "c": 3, "d": 50, None: 7},
        {"z": 5, "\U0001d4b3": 8, "￮": 9, "": 2, "b": 0},
        {"a": 0, None: 0},
        {"only": 12},
    ],
)
def test_targets_equal_rounds_of_resharing(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in source_targets(df, MixSettings()).collect()}
    assert got == pytest.approx(plain_targets(sizes))


def check(rows, docs, tolerance):
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes, taken, targets = defaultdict(int), defaultdict(int), {}
    source = {r.doc_id: r.source for r in docs}
    for d in docs:
        sizes[d.source] += count(d.text)
    want = plain_targets(sizes)
    for r in rows:
        assert 0 <= r.taken <= 2 * r.size and r.source_size == sizes[source[r.doc_id]]
        taken[source[r.doc_id]] += r.taken
        targets[source[r.doc_id]] = r.target
    assert Counter((r.doc_id, r.size) for r in rows) == Counter((d.doc_id, count(d.text)) for d in docs)
    assert targets == pytest.approx(want)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= tolerance(s, [count(d.text) for d in docs if d.source == s])


def test_awkward_rows(spark):
    df = awkward(spark)
    rows = mix(df, MixSettings()).collect()
    check(rows, df.collect(), lambda s, n: max(n))
    assert {r.taken for r in rows if r.doc_id in (2, 3, 4)} == {0}
    assert mix(empty(spark), MixSettings()).count() == 0


def test_weights_change_who_is_drawn_and_not_how_much(spark):
    from pyspark.sql import functions as F

    df = spark.range(400).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), 10).alias("text"), F.lit("s").alias("source"))
    heavy = F.when(F.col("doc_id") < 200, 16.0).otherwise(None)
    rows = mix(df, MixSettings(share=0.5), weight=heavy).collect()
    assert sum(r.taken for r in rows) == 2000
    assert sum(r.taken for r in rows if r.doc_id < 200) > 1500


def test_op6_and_rerun(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    rows = op6_mixing(spark, sf).collect()
    check(rows, docs, lambda s, n: 0.08 * sum(n))
    assert Counter(op6_mixing(spark, sf).collect()) == Counter(rows)


def test_no_row_has_more_copies_than_allowed(spark):
    """Empty rows of a source that gets all its whole copies have no other copy."""
    rows = [(i, "" if i < 5 else "a b c", "capped") for i in range(8)] + [(10 + i, "x " * 400, "large") for i in range(9)] + [(30, None, "large")]
    got = mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), MixSettings()).collect()
    assert all(r.copies <= MixSettings().most for r in got)
    assert all(r.copies == (2 if r.source == "capped" else 1) for r in got if r.size == 0)
