"""Best-fit packing: whole documents into few sequences, by bin completion.

Only the lengths of pieces matter for a packing, and there are at most ``length`` of
them. The pieces are counted by length; the search works on these counts and so costs the
same for any number of documents. It fills one kind of sequence after the other: around
the longest piece left it lists the undominated fillings of the room beside it, takes one
for as many sequences as the counts allow, and goes on with the rest. Where the sequences
used and the least that the rest can need reach the best packing known, it turns back.
Packings of the rest by best fit (longest first, each into the fullest sequence that has
room) are the incumbents; a packing of as few sequences as any can have ends the
search, and so does a number of steps, with the best one found.

Pieces are then ranked within their length: a running number in the task that tokenized
them plus those of the tasks before, so no length is ranked in one place. A short table of
runs of ranks says which sequence and offset each piece has.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kotomori.llm.common import register, slices, table, texts, tokenizer_path
from kotomori.llm.pieces import ByteIds
from kotomori.session import pin


@dataclass(frozen=True)
class BestFitSettings:
    tokenizer: str
    length: int = 1024
    #: The id that ends each document.
    end_id: int = 2
    #: Fillings that are branched on at a step, and partial fillings looked at to find them.
    width: int = 4
    looks: int = 400
    #: Steps of the search, and how often the rest is packed by best fit.
    steps: int = 2_000
    best_fit_every: int = 50


#: Lengths of one kind of sequence, each with how often it occurs there; longest first.
Filling = tuple[tuple[int, int], ...]
#: Kinds of sequences and the number of each.
Packing = list[tuple[Filling, int]]


def sequences(packing: Packing) -> int:
    return sum(n for _, n in packing)


# ---- best fit -----------------------------------------------------------------


def best_fit(counts: dict[int, int], length: int) -> Packing:
    """Longest pieces first, each into the fullest sequence that has room for it; equal
    pieces are dealt together."""
    groups: dict[int, list[tuple[Filling, int]]] = {}  # room left -> kinds of sequences
    rooms: list[int] = []

    def put(room: int, filling: Filling, n: int) -> None:
        if room not in groups:
            groups[room] = []
            rooms.insert(bisect_left(rooms, room), room)
        groups[room].append((filling, n))

    for size in sorted(counts, reverse=True):
        left = counts[size]
        while left:
            at = bisect_left(rooms, size)
            if at < len(rooms):
                room = rooms[at]
                filling, n = groups[room].pop()
                if not groups[room]:
                    del groups[room], rooms[at]
            else:
                room, filling, n = length, (), -(-left // (length // size))
            each = min(room // size, left)  # a sequence is the fullest one until it has no room
            some = min(n, left // each)
            put(room - each * size, (*filling, (size, each)), some)
            left -= some * each
            if n > some and room < length:
                put(room, filling, n - some)
    return [(filling, n) for found in groups.values() for filling, n in found]


# ---- fillings -------------------------------------------------------------------


def dominated(filling: list[int], room: int, counts: dict[int, int], sizes: list[int]) -> bool:
    """Could one longer piece that is left out take the place of some of the filling?"""
    used, total = Counter(filling), sum(filling)
    sums: dict[int, int] = {0: 0}  # sums of parts of the filling -> fewest pieces of such a part, at most two
    for x in filling:
        for s, n in list(sums.items()):
            if s + x not in sums or sums[s + x] < 2:
                sums[s + x] = max(sums.get(s + x, 0), min(2, n + 1))
    for s, n in sums.items():
        if not s:
            continue
        most = room - total + s
        for at in range(bisect_left(sizes, s), bisect_right(sizes, most)):
            x = sizes[at]
            if counts[x] > used.get(x, 0) and (x > s or n > 1):
                return True
    return False


def fillings(room: int, counts: dict[int, int], sizes: list[int], settings: BestFitSettings) -> list[list[int]]:
    """Undominated fillings of ``room``, the fullest first and of these the ones of few
    long pieces; ``sizes`` are the lengths left, ascending."""
    if counts.get(room, 0) > 0:
        return [[room]]  # dominates all others
    found: list[tuple[int, list[int]]] = []
    looks, exact = settings.looks, 0
    stack: list[tuple[int, int, list[int]]] = [(room, bisect_right(sizes, room), [])]  # room left, lengths that may come next, chosen
    while stack and looks and exact < settings.width:
        left, upto, chosen = stack.pop()
        looks -= 1
        upto = min(upto, bisect_right(sizes, left))
        last = sizes[upto - 1] if upto else 0
        if chosen and counts.get(left, 0) > chosen.count(left) and left <= chosen[-1]:
            found.append((0, [*chosen, left]))
            exact += 1
            continue
        while upto and counts[sizes[upto - 1]] <= chosen.count(sizes[upto - 1]):
            upto -= 1
        if not upto:
            if not any(counts[x] > chosen.count(x) for x in sizes[: bisect_right(sizes, left)]):
                found.append((left, chosen))
            continue
        last = sizes[upto - 1]
        if upto > 1:
            stack.append((left, upto - 1, chosen))  # without any more of this length
        stack.append((left - last, upto, [*chosen, last]))
    found.sort(key=lambda f: (f[0], len(f[1])))
    kept: list[list[int]] = []
    for _, filling in found:
        if len(kept) == settings.width:
            break
        if not dominated(filling, room, counts, sizes):
            kept.append(filling)
    return kept or [f for _, f in found[:1]] or [[]]


def fewest(counts: dict[int, int], length: int) -> int:
    """No packing has fewer sequences: pieces over ``length - k`` leave no room for those of
    ``k`` and more, those over half of it do not share a sequence, and what the others have
    beyond the room beside the latter needs sequences of its own; for the best ``k``."""
    n = np.zeros(length + 2, dtype=np.float64)
    n[list(counts)] = list(counts.values())
    many, much = np.cumsum(n), np.cumsum(n * np.arange(length + 2))
    half = length // 2
    least = -(-int(much[-1]) // length)
    for k in range(1, half + 1):
        alone = many[-1] - many[length - k]
        pairs, pairs_sum = many[length - k] - many[half], much[length - k] - much[half]
        beyond = much[half] - much[k - 1] - (pairs * length - pairs_sum)
        least = max(least, int(alone + pairs) + max(0, -(-int(beyond) // length)))
    return least


# ---- branch and bound -------------------------------------------------------------


def complete(counts: dict[int, int], settings: BestFitSettings) -> Packing:
    """Few sequences for ``counts`` pieces of each length (1 to ``length``)."""
    length = settings.length
    counts = {size: n for size, n in counts.items() if n}
    total = sum(size * n for size, n in counts.items())
    least, best = fewest(counts, length), best_fit(counts, length)
    if sequences(best) == least:
        return best
    sizes = sorted(counts)
    done: Packing = []
    used, rest, steps = 0, total, 0
    # of each step: the choices left, and what the last one took
    trail: list[tuple[list[list[int]], Filling, int]] = []

    def take(filling: Filling, n: int) -> None:
        for size, each in filling:
            counts[size] -= n * each
            if not counts[size]:
                sizes.pop(bisect_left(sizes, size))

    def give(filling: Filling, n: int) -> None:
        for size, each in filling:
            if not counts[size]:
                sizes.insert(bisect_left(sizes, size), size)
            counts[size] += n * each

    choices: list[list[int]] | None = None  # None: a new step; else the choices left of this one
    while steps < settings.steps:
        if choices is None:
            if not sizes:
                if used < sequences(best):
                    best = list(done)
                choices = []
            elif used + -(-rest // length) >= sequences(best):
                choices = []  # waste so far is too much for a better packing
            else:
                steps += 1
                if steps % settings.best_fit_every == 0:
                    other = best_fit({s: counts[s] for s in sizes}, length)
                    if used + sequences(other) < sequences(best):
                        best = [*done, *other]
                longest = sizes[-1]
                counts[longest] -= 1  # it has its place
                choices = [[longest, *f] for f in fillings(length - longest, counts, sizes, settings)][::-1]
                counts[longest] += 1
            if sequences(best) == least:
                return best
        if choices:
            chosen = Counter(choices.pop())
            filling = tuple(sorted(chosen.items(), reverse=True))
            n = min(counts[size] // each for size, each in filling)
            take(filling, n)
            trail.append((choices, filling, n))
            done.append((filling, n))
            used, rest, choices = used + n, rest - n * sum(s * e for s, e in filling), None
        elif trail:
            choices, filling, n = trail.pop()
            done.pop()
            give(filling, n)
            used, rest = used - n, rest + n * sum(s * e for s, e in filling)
        else:
            break
    return best


# ---- the operator -----------------------------------------------------------------


def cut_pieces(docs: DataFrame, settings: BestFitSettings, key: str, text: str) -> DataFrame:
    """``(key, piece, start, length, ids_crc32, part, place)``: the pieces of all rows;
    ``place`` counts the pieces of a length in a task, and ``part`` is the task."""
    rows = texts(docs, key, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, end, size = ByteIds(settings.tokenizer), settings.end_id.to_bytes(4, "little"), settings.length
        part, places = TaskContext.get().partitionId(), Counter()
        for batch, chunk in slices(batches):
            keys, out = batch.column("key"), []
            for k, ids in zip(keys.to_pylist(), ids_of.of(chunk)):
                ids += end
                n = len(ids) // 4
                first = n if n <= size else n % size or size
                for i, stop in enumerate(range(first, n + 1, size)):
                    start = max(0, stop - size) if i else 0
                    length = stop - start
                    out.append((k, i, start, length, zlib.crc32(ids[4 * start : 4 * stop]), part, places[length]))
                    places[length] += 1
            if out:
                columns = list(zip(*out))
                kinds = (keys.type, pa.int32(), *[pa.int64()] * 3, pa.int32(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["key", "piece", "start", "length", "ids_crc32", "part", "place"])

    return rows.mapInArrow(run, f"key {dict(rows.dtypes)['key']}, piece int, start long, length long, ids_crc32 long, part int, place long")


def runs(packing: Packing) -> dict[str, np.ndarray]:
    """Runs of ranks of one length in one kind of sequence, by length and first rank."""
    dealt: Counter = Counter()
    rows, sequence = [], 0
    for filling, n in packing:
        offset = 0
        for size, each in filling:
            rows.append((size, dealt[size], sequence, each, offset))
            dealt[size] += n * each
            offset += size * each
        sequence += n
    rows.sort()
    columns = np.array(rows, dtype=np.int64).reshape(-1, 5).T
    return dict(zip(("length", "rank", "sequence", "each", "offset"), columns))


def best_fit_pack(docs: DataFrame, settings: BestFitSettings, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces ``(key, piece, start, length, ids_crc32, sequence_id, offset)``.

    Each document is its ids and the end id; a null or empty text is the end id alone. A
    document of up to ``length`` ids is one piece; a longer one is cut into pieces of
    ``length``, the first of which may be shorter. Every id lies in one piece and every
    piece in one sequence, without gaps. Repeated rows and null keys are packed as they
    are; an empty table gives no rows. Other columns are not read.
    """
    pieces = pin(cut_pieces(docs, settings, key, text), "pieces")
    held = pin(pieces.groupBy("part", "length").agg(F.count("*").alias("n")), "piece-counts")
    totals = held.groupBy("length").agg(F.sum("n").alias("n")).collect()  # a row for each length
    table_ = docs.sparkSession.sparkContext.broadcast(runs(complete({r.length: r.n for r in totals}, settings)))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    firsts = held.select("part", "length", F.coalesce(before, F.lit(0)).alias("before"))
    ranked = pieces.join(firsts, ["part", "length"]).select("key", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("place")).alias("rank"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = table_.value
        lengths = np.unique(t["length"])
        bounds = np.searchsorted(t["length"], np.append(lengths, np.iinfo(np.int64).max))
        for batch in batches:
            size, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            at = np.empty(len(size), dtype=np.int64)
            for length in np.unique(size):
                a, b = bounds[np.searchsorted(lengths, length) :][:2]
                mine = size == length
                at[mine] = a + np.searchsorted(t["rank"][a:b], rank[mine], "right") - 1
            inside = rank - t["rank"][at]
            sequence = t["sequence"][at] + inside // t["each"][at]
            offset = t["offset"][at] + inside % t["each"][at] * size
            kept = [batch.column(c) for c in ("key", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], ["key", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    schema = f"key {dict(pieces.dtypes)['key']}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return ranked.mapInArrow(run, schema).withColumnRenamed("key", key)


@register("op13_best_fit")
def op13_best_fit(spark: SparkSession, sf: str) -> DataFrame:
    return best_fit_pack(table(spark, sf, "documents"), BestFitSettings(tokenizer_path("byte_bpe_50k.json")))
