"""Token counts and packing against the tokenizers themselves."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from kotomori.llm.common import tokenizer_path
from kotomori.llm.packing import Packer, PackSettings, best_windows, cut_points, op4_packing, pack, split_tail
from kotomori.llm.pieces import DISPUTED, WordIds, byte_pieces
from kotomori.llm.token_counts import CountSettings, count_tokens, op2_token_counts
from tests.llm.rows import awkward, empty

BYTE, WORD = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def byte():
    return Tokenizer.from_file(BYTE)


@pytest.fixture(scope="module")
def word():
    return Tokenizer.from_file(WORD)


@pytest.mark.parametrize("shared", [1 << 18, 4])
def test_counts_equal_the_tokenizer(spark, byte, shared):
    df = awkward(spark)
    got = Counter(map(tuple, count_tokens(df, CountSettings(BYTE, shared=shared, summed=3)).collect()))
    want = Counter((r.doc_id, len((r.text or "").encode()), len(byte.encode(r.text or "", add_special_tokens=False).ids)) for r in df.collect())
    assert got == want


def test_counts_of_nothing(spark):
    assert count_tokens(empty(spark), CountSettings(BYTE)).count() == 0


def test_op2(spark, sf, byte):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op2_token_counts(spark, sf).collect()
    assert len(rows) == len(docs)
    for r in rows:
        n = len(byte.encode(docs[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(docs[r.doc_id].encode()), n, n > 1024)


def test_pieces_equal_the_pattern_of_the_tokenizer(byte):
    """Every character that is not left to the tokenizer, in several surroundings."""
    split, pre = byte_pieces(BYTE), byte.pre_tokenizer
    for start in range(0, 0x10000, 64):
        chars = [chr(c) for c in range(start, start + 64) if not 0xD800 <= c < 0xE000]
        text = "".join(f"a{c} {c}1{c}{c} !{c}" for c in chars)
        assert split(text)[0] == [text[a:b] for _, (a, b) in pre.pre_tokenize_str(text)], hex(start)
    assert DISPUTED.search("\U0001f600")


def test_word_ids_equal_the_tokenizer(spark, word):
    texts = [r.text or "" for r in awkward(spark).collect()] + ["ΣΑΣ İ ĲSSEL it's we'll ½ 12 !'s", "a\x85b\xa0c d", "don''t <|x|> <|startoftext|>"]
    for limit in (300_000, 3):
        got = WordIds(WORD, limit=limit).of(texts)
        assert got == [np.array(word.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes() for t in texts]


def check_pieces(rows, texts, word, key="doc_id"):
    """Pieces tile the documents and the sequences; returns padding over tokens."""
    ids = {k: np.array(word.encode(t or "", add_special_tokens=False).ids + [1], dtype="<u4") for k, t in texts}
    want, by = Counter(k for k, _ in texts), defaultdict(list)
    sequences = defaultdict(list)
    for r in rows:
        by[r[key]].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    assert set(by) == set(want)
    for k, pieces in by.items():
        covered = np.zeros(len(ids[k]), dtype=int)
        for p in pieces:
            assert p.doc_tokens == len(ids[k]) and p.length > 0
            assert zlib.crc32(ids[k][p.start : p.start + p.length].tobytes()) == p.ids_crc32
            covered[p.start : p.start + p.length] += 1
        assert (covered == want[k]).all()
    padding = total = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
        total += at
        padding += 0 if at & (at - 1) == 0 else 2048 - at
    return padding / max(1, total)


def test_pack_awkward_rows(spark, word):
    df = awkward(spark)
    rows = pack(df.coalesce(1), PackSettings(WORD)).collect()
    check_pieces(rows, [(r.doc_id, r.text) for r in df.collect()], word)
    assert pack(empty(spark), PackSettings(WORD)).count() == 0


def test_op4_pads_little(spark, sf, word):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert check_pieces(op4_packing(spark, sf).collect(), docs, word) < 0.01


def cheapest(places, penalty, settings):
    """All windows between all cuts, and full windows that are followed by another."""
    def pad(n):
        return 0 if n >= settings.least_exact and n & (n - 1) == 0 else settings.length - n

    best = [0.0] + [float("inf")] * (len(places) - 1)
    for j in range(1, len(places)):
        for i in range(j):
            span = int(places[j] - places[i])
            if span <= settings.length:
                best[j] = min(best[j], best[i] + pad(span) + penalty[j])
            elif span <= 2 * settings.length:
                best[j] = min(best[j], best[i] + settings.hard_cut + pad(span - settings.length) + penalty[j])
    return best[-1]


@pytest.mark.parametrize("seed", range(12))
def test_windows_are_the_cheapest(seed):
    settings = PackSettings(WORD, length=64, least_exact=8)
    rng = np.random.default_rng(seed)
    ends = np.cumsum(rng.integers(1, 150, 12))
    ids = rng.integers(0, 20, ends[-1])
    is_ender = np.arange(20) < 2
    places, penalty = cut_points(ids, ends, is_ender, settings)
    cuts = best_windows(places, penalty, settings)
    assert cuts[0] == 0 and cuts[-1] == ends[-1] and max(np.diff(cuts)) <= 64 and min(np.diff(cuts)) > 0
    known = dict(zip(places.tolist(), penalty.tolist()))
    cost = sum((0 if n >= 8 and n & (n - 1) == 0 else 64 - n) for n in np.diff(cuts).tolist()) + sum(known.get(c, settings.hard_cut) for c in cuts[1:])
    assert cost == pytest.approx(cheapest(places, penalty, settings))


def test_blocks_leave_no_seams():
    settings = PackSettings(WORD, length=64, least_exact=8, block=500)
    rng = np.random.default_rng(1)
    packer, out, docs = Packer(settings, np.arange(20) < 2), [], [rng.integers(0, 20, rng.integers(1, 400)).astype("<u4") for _ in range(60)]
    for k, d in enumerate(docs):
        out.extend(packer.add(k, d))
    out.extend(packer.finish())
    at = Counter()
    for k, start, length, crc, total, *_ in out:
        assert start == at[k] and total == len(docs[k]) and zlib.crc32(docs[k][start : start + length].tobytes()) == crc
        at[k] += length
    assert at == Counter({k: len(d) for k, d in enumerate(docs)})


def test_tail_becomes_powers_of_two():
    assert split_tail([0, 2048, 2048 + 1536], PackSettings(WORD)) == [0, 2048, 2048 + 1024, 2048 + 1536]
    assert split_tail([0, 2047], PackSettings(WORD)) == [0, 2047]
