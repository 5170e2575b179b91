"""Syncmers against a plain implementation of the same rule; likeness of edited texts."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from kotomori.llm.fingerprints import SyncmerSettings, compare_edited, likeness, op3_fingerprints, with_anchors, with_fingerprint
from tests.llm.rows import awkward, empty

SETTINGS = SyncmerSettings()


def hashes(spark, values):
    """Spark's hash of rows of strings or longs."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v array<long>" if isinstance(values[0], tuple) else "i int, v string")
    column = F.xxhash64(*[F.get("v", F.lit(j)) for j in range(len(values[0]))]) if isinstance(values[0], tuple) else F.xxhash64("v")
    return {(tuple(r.v) if not isinstance(r.v, str) else r.v): r.h for r in df.select("v", column.alias("h")).collect()}


def pieces_of(text):
    """A plain scan: a piece ends at a closing character, before white space or at the end."""
    pieces, held = [], ""
    for c in text:
        if c in " \t\n\v\f\r":
            pieces, held = pieces + [held] * bool(held), ""
            continue
        held += c
        if ord(c) > 127 or ord(c) % SETTINGS.stride == 0:
            pieces, held = pieces + [held], ""
    return pieces + [held] * bool(held)


@pytest.mark.parametrize("text", ["the quick brown fox jumps over the lazy dog and then\trests_under an old tree for hours", "暴言を吐くコメントwith mixed 文字列、ノイズ!! and a ünïcode tail 2026"])
def test_anchors_follow_the_rule(spark, text):
    pieces = pieces_of(text)
    of = hashes(spark, pieces)
    h = [of[p] for p in pieces]
    pairs = [tuple(h[i : i + 2]) for i in range(len(h) - 1)]
    inner = hashes(spark, pairs)
    m = [inner[p] for p in pairs]
    width = SETTINGS.k - SETTINGS.s + 1
    want = [i for i in range(len(h) - SETTINGS.k + 1) if min(m[i : i + width]) in (m[i], m[i + width - 1])]
    df = with_anchors(spark.createDataFrame([(text,)], "text string"), SETTINGS)
    assert [a.at for a in df.first().anchors] == want


def test_anchors_do_not_depend_on_context(spark):
    passage = "a passage of some length that stands in two places, with other words around it"
    texts = [("before it came this: " + passage + " and more.",), (passage,), ("Quite another start here " + passage,)]
    rows = with_anchors(spark.createDataFrame(texts, "text string"), SETTINGS).collect()
    sets = [{a.hash for a in r.anchors} for r in rows]
    assert sets[1] <= sets[0] and sets[1] <= sets[2]
    places = [{a.hash: a.at for a in r.anchors} for r in rows]
    for other in (places[0], places[2]):
        assert len({other[h] - at for h, at in places[1].items()}) == 1


def unspaced(alphabet, n, seed):
    rng = random.Random(seed)
    return "".join(rng.choice(alphabet) for _ in range(n))


@pytest.mark.parametrize("alphabet", ["".join(map(chr, range(0x3042, 0x3082))), "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"])
def test_text_without_spaces_may_start_anywhere(spark, alphabet):
    text = unspaced(alphabet, 800, 1)
    rows = [(text, unspaced(alphabet, n, 2) + text) for n in range(1, 6)] + [(text, text[:400] + "x" + text[400:]), (text, unspaced(alphabet, 800, 3))]
    found = compared(spark, rows)
    assert all(r.near > 0.9 for r in found[:6]) and found[6].near < 0.05


def compared(spark, rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, text string, other string")
    df = with_fingerprint(with_fingerprint(df, SETTINGS), SETTINGS, "other", "other_fingerprint", "others")
    return df.select("i", "fingerprint", "other_fingerprint", "links", "others", likeness("links", "others").alias("near")).orderBy("i").collect()


def test_every_anchor_counts(spark):
    """One word changed in a long text changes its fingerprint, and a passage of a hundred
    words that two long texts share is likeness."""
    rng = random.Random(5)
    word = lambda: unspaced("abcdefghijklmnopqrstuvwxyz", rng.randint(2, 9), rng.random())
    base = [word() for _ in range(6000)]
    once = [*base[:3000], "changed", *base[3001:]]
    other = [word() for _ in range(6000)]
    shared = [*other[:2000], *base[2000:2100], *other[2000:]]
    edit, passage, nothing = compared(spark, [(" ".join(base), " ".join(t)) for t in (once, shared, other)])
    assert edit.fingerprint != edit.other_fingerprint and 0.99 < edit.near < 1
    assert 0.5 * 100 / 6000 < passage.near < 2 * 100 / 6000 and nothing.near < 0.2 * passage.near


def test_likeness_counts_links_in_place(spark):
    """Links are an anchor, its follower and the pieces between them, counted by hand."""
    base = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    texts = [base, base[:40], "unlike anything else that was said", base + " " + base, "", "word"]
    rows = [(a, b) for a in texts for b in texts]
    links = {}
    for r in with_anchors(spark.createDataFrame([(t,) for t in texts], "text string"), SETTINGS).collect():
        found = [(a.hash, a.at) for a in r.anchors]
        links[r.text] = {(h, j - i, g) for (h, i), (g, j) in zip(found, found[1:])} if len(found) != 1 else {found[0][0]}
    for (a, b), r in zip(rows, compared(spark, rows)):
        n = len(links[a]) + len(links[b])
        assert len(r.links) == len(links[a])
        assert r.near == (2 * len(links[a] & links[b]) / n if n else 1.0)


def test_one_shuffle_of_texts(spark, sf):
    """Links are made behind the shuffle by ranges, which the window uses as it is."""
    plan = op3_fingerprints(spark, sf)._jdf.queryExecution().executedPlan().toString()
    above, below = plan.split("REPARTITION_BY_COL")
    assert "Window [lead(text" in above and "Exchange" not in above[: above.rindex("Exchange")] and above.count("Sort [") == 1


def test_awkward_rows(spark):
    df = awkward(spark)
    rows = compare_edited(df, SETTINGS).collect()
    docs = [r for r in df.collect()]
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(r.doc_id) for r in docs)
    by_text = {}
    for r in rows:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    ids = {r.doc_id: r for r in rows if r.doc_id is not None}
    for d in docs:
        if d.doc_id is not None:
            by_text.setdefault(d.text or "", set()).add(ids[d.doc_id].fingerprint)
    assert all(len(v) == 1 for v in by_text.values())
    assert ids[2].fingerprint == "" == ids[3].fingerprint and ids[2].near_next == 1.0
    assert compare_edited(empty(spark), SETTINGS).count() == 0


def test_one_row_is_its_own_next(spark):
    row = compare_edited(spark.createDataFrame([(1, "abcd efgh")], "doc_id long, text string"), SETTINGS).first()
    assert row.edited_sha256 == hashlib.sha256(b"abcd abcd").hexdigest() and row.near_next == 1.0


def test_op3(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    ids = sorted(docs)
    rows = {r.doc_id: r for r in op3_fingerprints(spark, sf).collect()}
    assert sorted(rows) == ids
    for i, n in zip(ids, ids[1:] + ids[:1]):
        half = len(docs[i]) // 2
        edited = docs[i][: len(docs[i]) - half] + docs[n][:half]
        assert rows[i].n_chars == len(docs[i]) and rows[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
    long = [r for r in rows.values() if r.n_chars > 300]
    assert sum(0.25 < r.near_edited < 0.85 for r in long) > 0.9 * len(long)
    assert sum(r.near_next < 0.2 for r in long) > 0.9 * len(long)
