import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from kotomori.llm.bestfit import BestFitSettings, best_fit, best_fit_pack, complete, dominated, fewest, fillings, sequences
from kotomori.llm.common import load_tokenizer, tokenizer_path
from tests.llm.rows import awkward, empty

PATH = tokenizer_path("byte_bpe_50k.json")


def fewest_of(items, length):
    """All ways to deal the items, cut off where a known one is as good."""
    items, best = sorted(items, reverse=True), len(items)

    def go(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(items):
            best = len(rooms)
            return
        for room in set(rooms):
            if room >= items[i]:
                rest = list(rooms)
                rest.remove(room)
                go(i + 1, [*rest, room - items[i]])
        go(i + 1, [*rooms, length - items[i]])

    go(0, [])
    return best


def held(packing):
    out = Counter()
    for filling, n in packing:
        for size, each in filling:
            out[size] += n * each
    return +out


@pytest.mark.parametrize("longest", [12, 20, 30])
def test_as_few_as_any(longest):
    rng = random.Random(longest)
    settings = BestFitSettings("", length=30)
    for _ in range(120):
        items = [rng.randint(1, longest) for _ in range(rng.randint(0, 11))]
        packing = complete(Counter(items), settings)
        assert held(packing) == Counter(items)
        assert all(sum(s * e for s, e in f) <= 30 for f, _ in packing)
        assert fewest(Counter(items), 30) <= sequences(packing) == fewest_of(items, 30)


def test_bin_completion_beats_best_fit():
    counts = Counter({14: 40, 11: 40, 10: 40, 9: 40, 6: 80, 5: 80})
    settings = BestFitSettings("", length=30)
    assert sequences(complete(counts, settings)) <= sequences(best_fit(counts, 30))
    awkward_ = Counter({9: 2, 8: 2, 7: 2, 6: 2, 5: 2, 4: 2, 3: 2})
    assert sequences(complete(awkward_, BestFitSettings("", length=21))) == 4


def test_best_fit_is_that_of_single_pieces():
    rng = random.Random(3)
    for _ in range(200):
        items = sorted((rng.randint(1, 30) for _ in range(rng.randint(0, 60))), reverse=True)
        rooms = []
        for x in items:
            fits = [r for r in rooms if r >= x]
            if fits:
                rooms.remove(min(fits))
            rooms.append((min(fits) if fits else 30) - x)
        packing = best_fit(Counter(items), 30)
        assert held(packing) == Counter(items)
        assert Counter(30 - sum(s * e for s, e in f) for f, n in packing for _ in range(n)) == Counter(rooms)


def test_fillings_are_undominated():
    counts = {3: 2, 4: 1, 5: 2, 9: 1}
    found = fillings(10, counts, [3, 4, 5, 9], BestFitSettings("", width=9))
    assert found[0] == [5, 5]
    assert dominated([4, 3], 10, counts, [3, 4, 5, 9]) and not dominated([5, 5], 10, counts, [3, 4, 5, 9])
    assert fillings(9, counts, [3, 4, 5, 9], BestFitSettings("")) == [[9]]


def test_steps_do_not_grow_with_the_pieces():
    rng = random.Random(5)
    few = Counter(rng.randint(1, 1024) for _ in range(20_000))
    many = Counter({s: n * 10**6 for s, n in few.items()})
    packing = complete(many, BestFitSettings("", steps=2000))
    assert held(packing) == many and len(packing) < 5000
    assert sequences(packing) <= 1.01 * fewest(many, 1024)


def check(spark, docs, settings=BestFitSettings(PATH)):
    tokenizer = load_tokenizer(PATH)
    rows = best_fit_pack(docs, settings).collect()
    wanted = Counter()
    for d in docs.collect():
        ids = [*tokenizer.encode(d.text or "", add_special_tokens=False).ids, 2]
        first = len(ids) if len(ids) <= 1024 else len(ids) % 1024 or 1024
        at = [0, *range(first, len(ids), 1024), len(ids)] if len(ids) > first else [0, len(ids)]
        for i, (a, b) in enumerate(zip(at, at[1:])):
            wanted[d.doc_id, i, a, b - a, zlib.crc32(np.array(ids[a:b], dtype="<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == wanted
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for pieces in by.values():
        pieces.sort()
        assert all(a + n == b for (a, n), (b, _) in zip(pieces, [*pieces[1:], (sum(n for _, n in pieces), 0)]))
        assert pieces[0][0] == 0 and sum(n for _, n in pieces) <= 1024
    return rows, by


def test_pieces_and_places(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").repartition(5)
    rows, by = check(spark, docs)
    lengths = Counter(r.length for r in rows)
    assert len(by) <= fewest(lengths, 1024) * 1.01 + 1


def test_awkward_rows(spark):
    check(spark, awkward(spark).union(awkward(spark)))
    assert best_fit_pack(empty(spark), BestFitSettings(PATH)).count() == 0


def test_one_length_holds_a_third_of_the_rows(spark):
    texts = ["the same text"] * 300 + ["word " * (i % 700) for i in range(600)]
    check(spark, spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(7))
