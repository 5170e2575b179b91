"""SimHash components against all pairs."""

import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from kotomori.llm.simhash import SimHashSettings, components, fingerprint, gray_rank, links, near_duplicates, op5_simhash
from tests.llm.rows import awkward, empty


def plain_fingerprint(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(prints, radius=2):
    """Smallest position reachable from each position."""
    root = list(range(len(prints)))

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    x = np.array(prints, dtype=np.uint64)
    for i in range(len(x)):
        for j in np.flatnonzero(np.bitwise_count(x[i] ^ x[i + 1 :]) <= radius):
            a, b = find(i), find(i + 1 + int(j))
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(x))]


def test_fingerprints_equal_the_definition(spark):
    for text in [r.text or "" for r in awkward(spark).collect()] + ["A b", "ÀÉ Ünï c d", "a\x0bb\x0cc\x1cd\x85e"]:
        assert fingerprint(text, SimHashSettings()) == plain_fingerprint(text)


@pytest.mark.parametrize("kind", ["random", "dense", "chain"])
def test_links_connect_what_all_pairs_connect(spark, kind):
    rng = np.random.default_rng(3)
    if kind == "random":
        base = rng.integers(0, 1 << 63, 250, dtype=np.uint64)
        prints = [int(b) ^ sum(1 << int(k) for k in rng.choice(64, n, replace=False)) for b in base for n in (0, 1, 2, 3)]
    elif kind == "dense":
        prints = [12345 ^ sum(1 << int(k) for k in rng.choice(64, n, replace=False)) for n in (0, 1, 1, 2, 2, 2, 3) for _ in range(120)]
    else:
        prints = [(1 << k) - 1 for k in range(0, 64, 2)] + [(1 << 63) | 5]
    prints = sorted(set(prints))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    settings = SimHashSettings(leaf=8, fan=4)
    got = {r.node: r.root for r in components(links(spark.createDataFrame([(s,) for s in signed], "bits long"), settings)).collect()}
    want = plain_components(prints)
    groups: dict = {}
    for s, w in zip(signed, want):
        groups.setdefault(w, set()).add(got.get(s, s))
    assert all(len(g) == 1 for g in groups.values()) and len(set.union(*groups.values())) == len(groups)


def test_gray_neighbours_differ_in_one_bit(spark):
    df = spark.range(256).select("id", gray_rank(F.col("id")).alias("rank"))
    order = [r.id for r in sorted(df.collect(), key=lambda r: r.rank)]
    assert all(bin(a ^ b).count("1") == 1 for a, b in zip(order, order[1:]))


def test_awkward_rows(spark):
    rows = near_duplicates(awkward(spark), SimHashSettings()).collect()
    assert len(rows) == 12
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert {by[i][0].component_id for i in (2, 3, 4)} == {2} and by[2][0].fingerprint == "0" * 16
    assert len(by[6]) == 2 and {r.component_id for r in by[None]} == {None}
    assert near_duplicates(empty(spark), SimHashSettings()).count() == 0


def test_op5(spark, sf):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    prints = [plain_fingerprint(t or "") for _, t in docs]
    want = {docs[i][0]: (f"{p:016x}", docs[c][0]) for i, (p, c) in enumerate(zip(prints, plain_components(prints)))}
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in op5_simhash(spark, sf).collect()} == want
