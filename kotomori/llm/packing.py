"""Order-preserving packing of token streams.

Documents keep their order. Windows of at most ``length`` tokens are cut from the
stream so that padding plus cut penalties are least. Cuts are wanted at the ends of
documents, allowed at the ends of sentences for a small penalty, and inside sentences
for a larger one, where they fill a window exactly. With ``p`` the position of a cut,

    best[j] = penalty[j] + min over i of best[i] + length - (p[j] - p[i])

so the minimum is that of ``best[i] + p[i]`` over a sliding window of positions, and a
monotone queue gives it in constant time. Windows with a power of two of tokens need
no padding and are looked up exactly.

Each task packs the rows it scans, in their order, a block at a time: neither texts
nor ids are shuffled, and a task holds one block of ids. The last windows of a block
are given up and packed again with the next block, so blocks leave no seams.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from kotomori.llm.common import load_tokenizer, register, slices, table, texts, tokenizer_path
from kotomori.llm.pieces import WordIds


@dataclass(frozen=True)
class PackSettings:
    tokenizer: str
    length: int = 2048
    #: The id that ends each document.
    end_id: int = 1
    #: Penalties, in tokens of padding.
    sentence_cut: int = 2
    hard_cut: int = 12
    #: Tokens that end a sentence.
    enders: tuple[str, ...] = (".</w>", "!</w>", "?</w>", "!!</w>", "...</w>", "。</w>", "！</w>", "？</w>")
    #: Windows below this many tokens are not worth a sequence, except at the end of the rows of a task.
    least_exact: int = 256
    #: Tokens packed at a time.
    block: int = 1 << 20
    #: Windows given up at the end of a block.
    margin: int = 4


def cut_points(ids: np.ndarray, ends: np.ndarray, is_ender: np.ndarray, settings: PackSettings) -> tuple[np.ndarray, np.ndarray]:
    """Positions where the stream may be cut, from 0 to its length, and their penalties.

    ``ends``: the positions after each document. Stretches without a sentence end get
    a hard cut every ``length`` tokens, so that a packing always exists.
    """
    sentence = np.flatnonzero(is_ender[ids]) + 1
    places = np.union1d(np.concatenate(([0], ends)), sentence)
    gaps = np.flatnonzero(np.diff(places) > settings.length)
    if len(gaps):
        more = [np.arange(places[g] + settings.length, places[g + 1], settings.length) for g in gaps]
        forced = np.concatenate(more)
        places = np.union1d(places, forced)
    else:
        forced = np.empty(0, dtype=np.int64)
    penalty = np.full(len(places), float(settings.sentence_cut))
    penalty[np.searchsorted(places, forced)] = settings.hard_cut
    penalty[np.searchsorted(places, ends)] = 0.0
    penalty[0] = 0.0
    return places, penalty


def best_windows(places: np.ndarray, penalty: np.ndarray, settings: PackSettings) -> list[int]:
    """The cuts, ascending and with both ends, of the cheapest packing."""
    size, hard = settings.length, float(settings.hard_cut)
    n = len(places)
    exact: dict[int, list[tuple[int, float]]] = {}  # cut -> earlier cuts from which a window needs no padding
    power = settings.least_exact
    while power <= size:
        for span, extra in ((power, 0.0), (power + size, hard)):
            at = np.searchsorted(places, places - span)
            for j in np.flatnonzero((places >= span) & (places[np.minimum(at, n - 1)] == places - span)).tolist():
                exact.setdefault(j, []).append((int(at[j]), extra))
        power *= 2
    p, pen = places.tolist(), penalty.tolist()
    best, back = [0.0] * n, [0] * n
    near: deque[int] = deque()  # cuts less than a window back, the cheapest first
    far: deque[int] = deque()  # cuts from which a full window comes first, then this one
    keys = [0.0] * n
    passed = 0
    for j in range(1, n):
        here = p[j]
        key = keys[j - 1] = best[j - 1] + p[j - 1]
        while near and keys[near[-1]] >= key:
            near.pop()
        near.append(j - 1)
        low = here - size
        while p[passed] < low:  # leaves the near window, enters the far one
            key = keys[passed]
            while far and keys[far[-1]] >= key:
                far.pop()
            far.append(passed)
            passed += 1
        while p[near[0]] < low:
            near.popleft()
        low -= size
        while far and p[far[0]] < low:
            far.popleft()
        i = near[0]
        cost = keys[i] + size - here
        if far:
            k = far[0]
            other = keys[k] + 2 * size - here + hard
            if other < cost:
                i, cost = k, other
        if j in exact:
            for k, extra in exact[j]:
                if best[k] + extra < cost:
                    i, cost = k, best[k] + extra
        best[j], back[j] = cost + pen[j], i
    cuts, j = [p[-1]], n - 1
    while j:
        i = back[j]
        if p[j] - p[i] > size:
            cuts.append(p[i] + size)
        cuts.append(p[i])
        j = i
    return cuts[::-1]


def split_tail(cuts: list[int], settings: PackSettings) -> list[int]:
    """Cut the last window at powers of two if that is cheaper than its padding."""
    if len(cuts) < 2:
        return cuts
    rest = cuts[-1] - cuts[-2]
    parts = [1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1]
    if len(parts) > 1 and (len(parts) - 1) * settings.hard_cut < settings.length - rest:
        at = cuts[-2]
        for part in parts[:-1]:
            at += part
            cuts.insert(-1, at)
    return cuts


class Packer:
    """Packs a stream of documents; ``add`` and ``finish`` yield finished pieces."""

    def __init__(self, settings: PackSettings, is_ender: np.ndarray):
        self.settings, self.is_ender = settings, is_ender
        self.docs: list[tuple[object, int, np.ndarray, int]] = []  # key, ids packed before, ids left, all ids
        self.held = self.sequence = 0

    def add(self, key, ids: np.ndarray) -> Iterator[tuple]:
        self.docs.append((key, 0, ids, len(ids)))
        self.held += len(ids)
        if self.held >= self.settings.block:
            yield from self.pack(last=False)

    def finish(self) -> Iterator[tuple]:
        if self.docs:
            yield from self.pack(last=True)

    def pack(self, last: bool) -> Iterator[tuple]:
        ids = np.concatenate([d[2] for d in self.docs])
        ends = np.cumsum([len(d[2]) for d in self.docs])
        cuts = best_windows(*cut_points(ids, ends, self.is_ender, self.settings), self.settings)
        cuts = split_tail(cuts, self.settings) if last else cuts[: max(2, len(cuts) - self.settings.margin)]
        done, d, start = cuts[-1], 0, 0  # d: the document at hand, start: its place in the block
        for a, b in zip(cuts, cuts[1:]):
            at = a
            while at < b:
                key, before, own, total = self.docs[d]
                upto = min(b, start + len(own))
                piece = own[at - start : upto - start]
                yield key, before + at - start, upto - at, zlib.crc32(piece), total, self.sequence, at - a
                at = upto
                if at == start + len(own):
                    start, d = at, d + 1
            self.sequence += 1
        rest = self.docs[d:]
        if rest and done > start:
            key, before, own, total = rest[0]
            rest[0] = (key, before + done - start, own[done - start :].copy(), total)
        self.docs, self.held = rest, len(ids) - done


def pack(docs: DataFrame, settings: PackSettings, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces ``(key, start, length, ids_crc32, doc_tokens, sequence_id, offset)``.

    Each id of each row, its end id included, lies in exactly one piece. A null or
    empty text is its end id alone. Repeated rows and null keys are packed as they are;
    a document longer than a window spreads over several. Rows of a task are packed in
    the order of the scan, and ``sequence_id`` holds the task's number above bit 40.
    """
    rows = texts(docs, key, text)
    kind = dict(rows.dtypes)["key"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, base = WordIds(settings.tokenizer), TaskContext.get().partitionId() << 40
        tokenizer, end = load_tokenizer(settings.tokenizer), settings.end_id.to_bytes(4, "little")
        is_ender = np.zeros(tokenizer.get_vocab_size() + 1, dtype=bool)
        is_ender[[i for i in map(tokenizer.token_to_id, settings.enders) if i is not None]] = True
        packer, out, of = Packer(settings, is_ender), [], None

        def batch() -> pa.RecordBatch:
            columns = list(zip(*out))
            out.clear()
            arrays = [pa.array(columns[0], of), *(pa.array(c, pa.int64()) for c in columns[1:5]), pa.array([base + s for s in columns[5]], pa.int64()), pa.array(columns[6], pa.int64())]
            return pa.RecordBatch.from_arrays(arrays, ["key", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

        for rows_, part in slices(batches):
            keys = rows_.column("key")
            of = keys.type
            for k, ids in zip(keys.to_pylist(), words.of(part)):
                out.extend(packer.add(k, np.frombuffer(ids + end, dtype="<u4")))
            if len(out) > 5000:
                yield batch()
        out.extend(packer.finish())
        if out:
            yield batch()

    schema = f"key {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return rows.mapInArrow(run, schema).withColumnRenamed("key", key)


@register("op4_packing")
def op4_packing(spark: SparkSession, sf: str) -> DataFrame:
    return pack(table(spark, sf, "documents"), PackSettings(tokenizer_path("word_bpe_49k.json")))
