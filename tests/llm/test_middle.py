import hashlib
import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kotomori.llm import middle
from kotomori.llm.middle import MiddleSettings, fill_in_middle, in_order, output_pieces, output_texts, pieces
from tests.llm.rows import LONG, awkward, empty
from tests.oracle import compare, connect

sha = lambda s: hashlib.sha256(s.encode()).hexdigest()


def brute(key, text):
    """The contract on one string."""
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = hashlib.sha256(f"7:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= 100:
        return key, n, "plain", None, None, sha(text), sha(text)
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    form = "spm" if h4 % 100 < 50 else "psm"
    out = f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"
    return key, n, form, len(p), len(m), sha(out), sha(text)


def restored(out, form):
    if form == "plain":
        return out
    x = re.split("<[PSM]>", out)
    return x[2] + x[3] + x[1] if form == "spm" else x[1] + x[3] + x[2]


@pytest.mark.parametrize("size", [5, 1 << 15])
def test_equals_brute_force(spark, size):
    docs = [(i, "".join(f"line {j}\n" * (j % 3) + "é\n" for j in range(i)) + "x" * (i % 4)) for i in range(60)]
    docs += [(100, "<P> is a marker"), (101, "<<P\n>S>"), (102, "<"), (103, "\n\n\n"), (104, "\r\n a\r b"), (105, LONG), (106, "多\n言\n語\n" * 500)]
    got = fill_in_middle(spark.createDataFrame(docs, "doc_id long, text string").repartition(4), MiddleSettings(piece=size))
    assert Counter(map(tuple, got.collect())) == Counter(brute(*d) for d in docs)


def test_awkward_rows(spark):
    rows = awkward(spark).select("*", F.lit("m").alias("form"), F.lit(1).alias("place"), F.lit("p").alias("piece"), F.lit(2).alias("n"))
    got = fill_in_middle(rows, MiddleSettings())
    assert Counter(map(tuple, got.collect())) == Counter(brute(r.doc_id, r.text) for r in rows.collect())
    assert fill_in_middle(empty(spark), MiddleSettings()).count() == 0


def test_outputs_can_be_read_back(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    found = output_texts(docs, MiddleSettings(piece=100)).collect()
    assert len(found) == len(texts) and {r.form for r in found} == {"psm", "spm"}
    assert all(restored(r.text, r.form) == texts[r.doc_id] for r in found)


def test_rates(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    forms = Counter(r.form for r in fill_in_middle(docs, MiddleSettings(rate=50, suffix_first=0)).collect())
    assert set(forms) == {"plain", "psm"} and 0.3 < forms["plain"] / sum(forms.values()) < 0.7


@given(st.text("ab\n<PSM>é", max_size=80), st.integers(1, 20))
@settings(max_examples=200, deadline=None)
def test_pieces_join_to_the_output(text, size):
    (n, form, low, mid), found = output_pieces(3, text, MiddleSettings(piece=size))
    want = brute(3, text)
    assert (3, n, form, low, mid, sha("".join(found)), sha(restored("".join(found), form))) == want
    assert all(len(p) <= max(size, 3) for p in found)


def test_one_shuffle_and_a_sort(spark, sf):
    plan = fill_in_middle(spark.read.parquet(f"{sf}/documents.parquet"), MiddleSettings())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Sort [") == 2


def test_pieces_come_in_order(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = in_order(pieces(docs, MiddleSettings(piece=50))).collect()
    seen = set()
    for before, r in zip([None, *rows], rows):
        if before is None or before.row != r.row:
            assert r.row not in seen
            seen.add(r.row)
        else:
            assert before.place < r.place


def test_equals_sql(spark, sf):
    assert compare(spark, connect(sf), sf, "op12", middle.op12_fill_in_middle, middle.OP12_SQL) == ""
