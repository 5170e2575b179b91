import hashlib
from collections import defaultdict
from math import floor, inf, nan

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from kotomori.llm import codes
from kotomori.llm.codes import CodeSettings, Chunk, books_digest, hilbert_ranks, packed, short_lists, vector_codes
from tests.oracle import compare, connect

SMALL = CodeSettings(parts=4, entries=8, chunk=50, block=7)


def brute(rows, s):
    """The contract with loops over Python's integers."""
    kept = [(k, lab, [floor(s.scale * x) for x in v]) for k, v, lab in rows if v is not None and all(x is not None and abs(x) < inf for x in v)]
    if not kept:
        return [], []
    width = len(kept[0][2]) // s.parts
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[2]))[: s.entries]
    cut = lambda v, p: v[p * width : (p + 1) * width]
    books = [[cut(v, p) for _, _, v in first] for p in range(s.parts)]
    near = lambda v, book: min((sum((a - b) ** 2 for a, b in zip(v, e)), i) for i, e in enumerate(book))
    for _ in range(s.rounds):
        for p, book in enumerate(books):
            mine = defaultdict(list)
            for _, _, v in kept:
                mine[near(cut(v, p), book)[1]].append(cut(v, p))
            books[p] = [[sum(c) // len(mine[i]) for c in zip(*mine[i])] if mine[i] else e for i, e in enumerate(book)]
    out, by_label = [], defaultdict(int)
    for k, lab, v in kept:
        found = [near(cut(v, p), books[p]) for p in range(s.parts)]
        out.append((k, lab, "".join(f"{i:02x}" for _, i in found), sum(d for d, _ in found)))
        by_label[lab] += out[-1][3]
    return [(k, c, e, by_label[lab]) for k, lab, c, e in out], books


def frame(spark, rows):
    return spark.createDataFrame([(k, v, lab, "x", 1) for k, v, lab in rows], "vec_id long, embedding array<double>, label int, code string, salt int")


def order(rows):
    return sorted(rows, key=repr)


def some_rows(n, seed, spread):
    rng = np.random.default_rng(seed)
    return [(int(k), [float(x) for x in rng.normal(0, spread, 8).round(2)], int(k % 3) if k % 5 else None) for k in rng.permutation(n)]


@pytest.mark.parametrize("n,spread", [(5, 1.0), (200, 0.02), (333, 1.0)])
def test_equals_brute_force(spark, n, spread):
    rows = some_rows(n, n, spread)
    got, books = vector_codes(frame(spark, rows).repartition(3), SMALL)
    want, want_books = brute(rows, SMALL)
    assert order(map(tuple, got.collect())) == order(want)
    assert books.tolist() == want_books
    joined = ",".join(str(x) for b in want_books for e in b for x in e)
    assert books_digest(books) == hashlib.sha256(joined.encode()).hexdigest()


def test_awkward_rows(spark):
    zero, huge = [0.0] * 8, [1e6] * 7 + [-1e6]
    rows = [(1, None, 1), (2, [0.1] * 7 + [None], 1), (3, [nan] * 8, 1), (4, [inf] * 8, 2), (5, zero, None), (5, zero, None), (None, huge, 1), (None, [0.5] * 8, None), (6, [-0.001] * 8, 4)]
    rows += some_rows(40, 1, 1.0)
    got, books = vector_codes(frame(spark, rows), SMALL)
    want, want_books = brute(rows, SMALL)
    assert order(map(tuple, got.collect())) == order(want) and books.tolist() == want_books


def test_empty_and_all_unsound(spark):
    for rows in ([], [(1, None, 1)]):
        got, books = vector_codes(frame(spark, rows), SMALL)
        assert got.collect() == [] and got.columns == ["vec_id", "code", "error", "label_error"]
        assert books_digest(books) == hashlib.sha256(b"").hexdigest()


def test_lengths_that_do_not_fit_are_an_error(spark):
    with pytest.raises(ValueError, match="equal parts"):
        vector_codes(frame(spark, [(1, [0.0] * 6, 1)]), SMALL)
    with pytest.raises(Exception, match="vectors of 8 and of 4 components"):
        vector_codes(frame(spark, [(1, [0.0] * 8, 1), (2, [0.0] * 4, 1)]), SMALL)


@given(st.lists(st.lists(st.integers(-300, 300), min_size=3, max_size=3), min_size=1, max_size=60), st.lists(st.lists(st.integers(-300, 300), min_size=3, max_size=3), min_size=1, max_size=9))
@settings(max_examples=60, deadline=None)
def test_no_nearest_entry_is_left_off_a_short_list(points, entries):
    s = CodeSettings(parts=1, block=5)
    chunk, entries = Chunk(packed(np.array(points), s), s), np.array(entries)
    for at, few in chunk.short_listed(0, entries):
        for x in chunk.points[0][at].tolist():
            d = ((entries - x) ** 2).sum(axis=1)
            assert set(np.flatnonzero(d == d.min())) <= set(few)


def test_boxes_shorten_the_lists():
    rng = np.random.default_rng(0)
    points, entries = rng.integers(-200, 200, (20_000, 4)), rng.integers(-200, 200, (64, 4))
    s = CodeSettings(parts=1, block=16)
    chunk = Chunk(packed(points, s), s)
    lists = short_lists(chunk.low[0], chunk.high[0], entries).sum(axis=1)
    unsorted = short_lists(*(f.reduceat(points, np.arange(0, 20_000, 16)) for f in (np.minimum, np.maximum)), entries).sum(axis=1)
    assert lists.mean() < 0.35 * unsorted.mean()


def test_neighbours_on_the_curve_are_neighbours_in_space():
    """On a full grid the Hilbert curve goes from cell to adjacent cell."""
    for width, side in ((2, 16), (3, 8)):
        grid = np.stack(np.meshgrid(*[np.arange(side)] * width), -1).reshape(-1, width)
        scaled = grid * (256 // side)  # 8 bits a component; cells begin at multiples
        walk = grid[np.argsort(hilbert_ranks(np.vstack([scaled, np.full((1, width), 255)]))[:-1], kind="stable")]
        assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_equals_sql(spark, sf):
    assert compare(spark, connect(sf), sf, "op11", codes.op11_vector_codes, codes._sql()) == ""
