"""Top lists against a full sort in Python."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from kotomori.llm.topk import SearchSettings, best_of_block, op9_exact_top_k, top_k

SMALL = SearchSettings(k=5, tile=64, shard=128, rows=4, block=7, fan=2)


def plain(rows, k, step):
    whole = [(i, v_id, [math.floor(64 * float(np.float32(x))) for x in v]) for i, (v_id, v) in enumerate(rows) if v_id is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, q, v in whole:
        if q % step == 0:
            scored = sorted(((-sum(a * b for a, b in zip(v, w)), c) for j, c, w in whole if j != i))
            out += [(q, n + 1, c, -s) for n, (s, c) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize("case", ["random", "ties", "awkward", "few"])
def test_lists_equal_a_full_sort(spark, case):
    rng = np.random.default_rng(5)
    if case == "random":
        rows = [(i, rng.normal(size=8).astype("f4").tolist()) for i in range(300)]
    elif case == "ties":
        rows = [(int(i), [1.0, 0.5] if i % 3 else [0.5, 1.0]) for i in rng.permutation(200)]
    elif case == "few":
        rows = [(0, [1.0]), (2, [0.5, 3.0]), (3, [])]
    else:
        rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (4, None), (6, [1.0, None]), (8, [float("nan"), 1.0]), (None, [1.0, 1.0]), (10, [float("inf"), 0.0]), (12, [0.25]), (13, [-1.0, 2.0, 9.0])]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, row int, tile string")
    got = top_k(df, F.col("vec_id") % 2 == 0, SMALL).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == plain(rows, 5, 2)


def test_nothing(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert top_k(df, F.col("vec_id") % 2 == 0, SMALL).count() == 0


def test_large_components_are_exact(spark):
    rows = [(i, [float(np.float32(1e12 + 1e6 * i)), 1.0]) for i in range(6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = top_k(df, F.col("vec_id") == 0, SMALL).collect()
    exact = {i: sum(math.floor(64 * a) * math.floor(64 * b) for a, b in zip(rows[0][1], rows[i][1])) for i in range(1, 6)}
    assert {r.vec_id: r.score for r in got} == {i: min(s, (1 << 63) - 1) for i, s in exact.items()}


def test_first_of_equal_scores_win():
    scores = np.array([[1.0, 3.0, 3.0, 3.0, 2.0]])
    assert best_of_block(scores, np.zeros((1, 5), bool), 2).tolist() == [[False, True, True, False, False]]
    assert best_of_block(scores, np.array([[False, True, False, False, False]]), 2).tolist() == [[False, False, True, True, False]]


def test_op9_lists_are_full(spark, sf):
    rows = op9_exact_top_k(spark, sf).collect()
    assert len(rows) == 20 * len({r.query_id for r in rows})
