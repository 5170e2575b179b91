"""Fill-in-the-middle texts by secondary sort.

Each text is cut into units (lines), and two cuts drawn from a hash of its key make a
prefix, a middle and a suffix. The task that scans a text emits it as pieces of whole
units, keyed by document and place in the output, markers included. Pieces are dealt by
document and sorted by place inside each partition, so a document's output passes as a
stream through a task: whatever reads it (a digest, a writer) holds one piece at a time,
and a long text needs no more memory than a short one.

The original text comes back the same way: the pieces of an output, read in order, tell
by its markers which section they belong to; sorted again by section and place, they are
the text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kotomori.llm.common import register, slices, table, texts

UNIT = re.compile(r"[^\n]*\n|[^\n]+")


@dataclass(frozen=True)
class MiddleSettings:
    seed: int = 7
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"
    #: Percent of texts that are rearranged, and of these that begin with the suffix.
    rate: int = 100
    suffix_first: int = 50
    #: Characters in a piece, about.
    piece: int = 1 << 15

    @property
    def markers(self) -> tuple[str, str, str]:
        return self.prefix, self.middle, self.suffix

    def order(self, form: str) -> tuple[str, ...]:
        """The markers in the order of the output."""
        return {"plain": (), "psm": (self.prefix, self.suffix, self.middle), "spm": (self.suffix, self.prefix, self.middle)}[form]


def draws(key, seed: int) -> list[int]:
    """Four numbers from the hash of a key; a missing key is drawn like an empty one."""
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]


def plan(key, text: str, settings: MiddleSettings) -> tuple[str, int, int, int]:
    """``(form, units, end of the prefix, end of the middle)``, the ends as places in the text."""
    ends = [m.end() for m in UNIT.finditer(text)]
    h1, h2, h3, h4 = draws(key, settings.seed)
    n = len(ends)
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    place = lambda units: ends[units - 1] if units else 0
    if not text or any(m in text for m in settings.markers) or h3 % 100 >= settings.rate:
        return "plain", n, 0, 0
    return ("spm" if h4 % 100 < settings.suffix_first else "psm"), n, place(low), place(high)


def cut(text: str, start: int, end: int, size: int) -> Iterator[str]:
    """``text[start:end]`` in pieces that end after a line where one ends in time."""
    while start < end:
        stop = min(end, start + size)
        if stop < end:
            line = text.rfind("\n", start, stop)
            stop = line + 1 if line >= start else stop
        yield text[start:stop]
        start = stop


def output_pieces(key, text: str, settings: MiddleSettings) -> tuple[tuple, list[str]]:
    """What is said of a document ``(n, form, prefix_chars, middle_chars)`` and its output
    in pieces; each marker is a piece of its own."""
    form, n, low, high = plan(key, text, settings)
    if form == "plain":
        return (n, form, None, None), list(cut(text, 0, len(text), settings.piece))
    sections = {settings.prefix: (0, low), settings.middle: (low, high), settings.suffix: (high, len(text))}
    out = []
    for marker in settings.order(form):
        out.append(marker)
        out.extend(cut(text, *sections[marker], settings.piece))
    return (n, form, low, high - low), out


SAID = "n long, form string, prefix_chars long, middle_chars long"
#: After the last piece of a document.
CLOSING = (1 << 31) - 1


def pieces(docs: DataFrame, settings: MiddleSettings, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, row, place, piece, n, form, prefix_chars, middle_chars)``: outputs in pieces.

    ``row`` tells documents apart whatever their keys, so repeated rows and null keys keep
    an output each. The last row of a document has no piece but what is said of it; form
    is on all of them. A null or empty text has no other row. Other columns are not read.
    """
    rows = texts(docs, key, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        for batch, part in slices(batches):
            out: list[tuple] = []
            keys = batch.column("key")
            for k, t in zip(keys.to_pylist(), part):
                said, found = output_pieces(k, t, settings)
                out.extend((k, number, i, p, None, said[1], None, None) for i, p in enumerate(found))
                out.append((k, number, CLOSING, None, *said))
                number += 1
            kinds = (keys.type, pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)] if out else [pa.array([], t) for t in kinds], ["key", "row", "place", "piece", "n", "form", "prefix_chars", "middle_chars"])

    return rows.mapInArrow(run, f"key {dict(rows.dtypes)['key']}, row long, place int, piece string, {SAID}")


def in_order(found: DataFrame) -> DataFrame:
    """Pieces dealt by document, each document's in the order of its output."""
    return found.repartition("row").sortWithinPartitions("row", "place")


def digested(ordered: DataFrame, settings: MiddleSettings, name: str, restoring: bool) -> DataFrame:
    """Closing rows get a column ``name``, the SHA-256 of their document's pieces.

    ``ordered`` streams through: a task holds one batch and one digest. With ``restoring``
    the pieces go on with the place they have in the restored text, known from the markers
    alone; markers stay behind. Without it closing rows alone are left.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        section = {settings.prefix: 0, settings.middle: 1, settings.suffix: 2}
        digest, seen, now, here = hashlib.sha256(), 0, 0, None
        for batch in batches:
            keep, places, digests = [], [], []
            rows = zip(*(batch.column(c).to_pylist() for c in ("row", "piece", "form")))
            for i, (row, piece, form) in enumerate(rows):
                if row != here:
                    digest, seen, now, here = hashlib.sha256(), 0, 0, row
                if piece is None:
                    keep.append(i)
                    places.append((3 << 32) | CLOSING)
                    digests.append(digest.hexdigest())
                    continue
                digest.update(piece.encode())
                if not restoring:
                    continue
                if form != "plain" and piece in section:
                    now = section[piece]
                    continue
                keep.append(i)
                places.append((now << 32) | seen)
                digests.append(None)
                seen += 1
            kept = batch.take(pa.array(keep, pa.int64()))
            columns = [pa.array(places, pa.int64()) if c == "place" else kept.column(c) for c in kept.schema.names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(digests, pa.string())], [*kept.schema.names, name])

    columns = ", ".join(f"`{c}` {'long' if c == 'place' else t}" for c, t in ordered.dtypes)
    return ordered.mapInArrow(run, f"{columns}, `{name}` string")


def fill_in_middle(docs: DataFrame, settings: MiddleSettings, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256)``, a row
    for each row of ``docs``.

    ``n`` counts lines. An empty or null text, and one that holds a marker, keeps its form
    (``plain``). Pieces are shuffled once; for the restored text they are sorted again
    where they are.
    """
    first = digested(in_order(pieces(docs, settings, key, text)), settings, "output_sha256", restoring=True)
    again = digested(first.sortWithinPartitions("row", "place"), settings, "restored_sha256", restoring=False)
    return again.select(F.col("key").alias(key), "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")


def output_texts(docs: DataFrame, settings: MiddleSettings, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, form, text)``: the outputs as strings, for documents that fit in one."""
    ordered = in_order(pieces(docs, settings, key, text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[str] = []
        for batch in batches:
            keep, out = [], []
            for i, piece in enumerate(batch.column("piece").to_pylist()):
                if piece is not None:
                    held.append(piece)
                    continue
                keep.append(i)
                out.append("".join(held))
                held = []
            kept = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([kept.column("key"), kept.column("form"), pa.array(out, pa.string())], ["key", "form", "text"])

    return ordered.mapInArrow(run, f"key {dict(ordered.dtypes)['key']}, form string, text string").withColumnRenamed("key", key)


OP12_SQL = r"""
WITH cut AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents),
drawn AS (
  SELECT *, len(u) AS n, ('0x' || h[1:8])::BIGINT % (len(u) + 1) AS a, ('0x' || h[9:16])::BIGINT % (len(u) + 1) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR ('0x' || h[17:24])::BIGINT % 100 >= 100 THEN 'plain'
      WHEN ('0x' || h[25:32])::BIGINT % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM cut),
parts AS (
  SELECT *, array_to_string(u[1 : least(a, b)], '') AS p, array_to_string(u[least(a, b) + 1 : greatest(a, b)], '') AS m,
    array_to_string(u[greatest(a, b) + 1 : n], '') AS s
  FROM drawn),
made AS (
  SELECT *, CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END AS o
  FROM parts),
read AS (
  SELECT *, CASE WHEN form = 'plain' THEN [o] ELSE string_split(replace(replace(o, '<P>', '<M>'), '<S>', '<M>'), '<M>') END AS x
  FROM made)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(o) AS output_sha256, sha256(CASE form WHEN 'plain' THEN x[1] WHEN 'psm' THEN x[2] || x[4] || x[3] ELSE x[3] || x[4] || x[2] END) AS restored_sha256
FROM read
"""


@register("op12_fill_in_middle", OP12_SQL)
def op12_fill_in_middle(spark: SparkSession, sf: str) -> DataFrame:
    return fill_in_middle(table(spark, sf, "documents"), MiddleSettings())
