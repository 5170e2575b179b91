import math
import re
import unicodedata
from collections import Counter

import pytest
from pyspark.sql import functions as F

from kotomori.config import FeatureSettings
from kotomori.functions import grams as G
from kotomori.functions.grams import char_ngrams, strip_accents, with_term_counts, inline_counts, word_tokens
from kotomori.operators import features as FE
from tests.strings import column_of, random_strings

STRINGS = random_strings(1500, seed=5)
DOCS = [
    "The cat sat on the mat. École école",
    "the dog sat; the cat ran ran ran",
    "x",
    "",
    "   ",
    "ばかあ 死ね the x y",
    "😀😀 the 😀 x",
    "unique words here the",
]


def brute_chars(text, low=2, high=4):
    grams = []
    for w in text.lower().split():
        w = f" {w} "
        for n in range(low, high + 1):
            if n >= len(w):
                grams.append(w)
                break
            grams += [w[i : i + n] for i in range(len(w) - n + 1)]
    return grams


def fold(text):
    return "".join(c for c in unicodedata.normalize("NFKD", text.lower()) if not unicodedata.combining(c))


def brute_words(text):
    t = re.findall(r"\w+", fold(text))
    return t + [f"{a} {b}" for a, b in zip(t, t[1:])]


def brute_tfidf(docs, terms_of, cap, min_df=2, max_df=0.95):
    counts = [Counter(terms_of(d)) for d in docs]
    df, tf = Counter(), Counter()
    for c in counts:
        df.update(c.keys())
        tf.update(c)
    kept = [t for t in df if min_df <= df[t] <= max_df * len(docs)]
    kept = sorted(sorted(kept, key=lambda t: (-tf[t], t))[:cap])
    idf = {t: math.log((1 + len(docs)) / (1 + df[t])) + 1 for t in kept}
    rows = []
    for c in counts:
        w = {t: (1 + math.log(n)) * idf[t] for t, n in c.items() if t in idf}
        norm = math.sqrt(sum(v * v for v in w.values()))
        rows.append({t: v / norm for t, v in w.items()})
    return kept, idf, rows


def frame(spark, docs=DOCS):
    return spark.createDataFrame(list(enumerate(docs)), "id int, text string")


def test_char_ngrams_equal_enumeration(spark):
    got = column_of(spark, char_ngrams, STRINGS)
    assert [Counter(g) for g in got] == [Counter(brute_chars(s)) for s in STRINGS]
    assert [Counter(g) for g in column_of(spark, lambda c: char_ngrams(c, 3, 5), STRINGS[:300])] == [
        Counter(brute_chars(s, 3, 5)) for s in STRINGS[:300]
    ]
    with pytest.raises(ValueError):
        char_ngrams(F.col("t"), 1, 3)


def test_accents_and_word_tokens(spark):
    assert column_of(spark, strip_accents, STRINGS) == [fold(s) for s in STRINGS]
    assert column_of(spark, word_tokens, STRINGS) == [re.findall(r"\w+", s) for s in STRINGS]


def test_in_row_counts(spark):
    arrays = [list(s) for s in STRINGS[:400]]
    df = spark.createDataFrame(list(enumerate(arrays)), "id int, terms array<string>")
    got = {}
    for r in inline_counts(with_term_counts(df, "terms"), "id").collect():
        got.setdefault(r.id, {})[r.term] = r.tf
    assert got == {i: dict(Counter(a)) for i, a in enumerate(arrays) if a}


@pytest.mark.parametrize(("block", "terms_of"), [("word", brute_words), ("char", brute_chars)])
@pytest.mark.parametrize("cap", [1000, 5])
def test_tfidf_equals_brute_force(spark, block, terms_of, cap):
    settings = FeatureSettings(max_word_terms=cap, max_char_terms=cap)
    kept, idf, rows = brute_tfidf(DOCS, terms_of, cap)
    df = frame(spark)
    vocab = FE.vocabulary(df, "text", block, settings)
    local = sorted(vocab.collect(), key=lambda r: r.term_id)
    assert [r.term for r in local] == kept
    assert [r.idf for r in local] == pytest.approx([idf[t] for t in kept])
    got = [{} for _ in DOCS]
    for r in FE.tfidf_long(df, "id", "text", vocab, block, settings).collect():
        got[r.id][r.term] = r.weight
    assert [g.keys() for g in got] == [r.keys() for r in rows]
    assert all(g[t] == pytest.approx(r[t]) for g, r in zip(got, rows) for t in r)


def test_vectors_equal_the_long_form_and_survive_a_round_trip(spark, tmp_path):
    df = frame(spark)
    model = FE.TfidfModel.fit(df, "text")
    words, _, word_rows = brute_tfidf(DOCS, brute_words, 50_000)
    chars, _, char_rows = brute_tfidf(DOCS, brute_chars, 25_000)
    assert model.size == len(words) + len(chars)
    model.save(str(tmp_path / "vocabulary"))
    loaded = FE.TfidfModel.load(spark, str(tmp_path / "vocabulary"))
    for m in (model, loaded):
        for r in m.transform(df, "text").collect():
            want = {words.index(t): w for t, w in word_rows[r.id].items()}
            want |= {len(words) + chars.index(t): w for t, w in char_rows[r.id].items()}
            assert r.features.size == m.size
            assert r.features.indices.tolist() == sorted(want)
            assert r.features.values.tolist() == pytest.approx([want[i] for i in sorted(want)])


def test_the_long_form_keeps_documents_whole_until_their_length_is_known(spark):
    """Rows that share a key share their length, a key may be null, and documents, not cells, are
    sorted by key."""
    docs = [("a", "the cat"), ("a", "the the dog"), (None, "cat x"), ("b", None), ("c", "zzzz")]
    df = spark.createDataFrame(docs, "id string, text string")
    vocab = FE.vocabulary(frame(spark), "text", "word")
    terms = {r.term: (r.term_id, r.idf) for r in vocab.collect()}
    long = FE.tfidf_long(df, "id", "text", vocab, "word")
    got = sorted(((r.id or "", r.term, r.tf, r.term_id, r.weight) for r in long.collect()), key=str)
    cells = [(i or "", t, n, *terms[t]) for i, text in docs for t, n in Counter(brute_words(text or "")).items() if t in terms]
    raw = [(*c, (1 + math.log(c[2])) * c[4]) for c in cells]
    norm = {i: math.sqrt(sum(r[5] ** 2 for r in raw if r[0] == i)) for i, *_ in raw}
    want = sorted(((i, t, n, at, w / norm[i]) for i, t, n, at, _, w in raw), key=str)
    assert [g[:4] for g in got] == [w[:4] for w in want] and len({g[0] for g in got}) == 2
    assert [g[4] for g in got] == pytest.approx([w[4] for w in want])
    text = long._jdf.queryExecution().optimizedPlan().toString()
    assert text.index("Generate inline") < text.index("Window")  # the window is below


def test_unknown_terms_are_dropped(spark):
    model = FE.TfidfModel.fit(frame(spark), "text")
    row = model.transform(frame(spark, ["zzzz qqqq", None]), "text").orderBy("id").collect()
    assert row[0].features.numNonzeros() == 0 or all(v > 0 for v in row[0].features.values)
    assert row[1].features.numNonzeros() == 0


def test_vocab_topk_with_ties_and_hot_terms(spark):
    stats = [(f"t{i:04d}", 2, 3) for i in range(500)] + [("hot", 9, 10**12), ("warm", 9, 5)]
    df = spark.createDataFrame(stats, "term string, df long, corpus_tf long")
    got = [r.term for r in FE.vocab_topk(df, 10).collect()]
    assert got == ["hot", "warm"] + [f"t{i:04d}" for i in range(8)]
    assert FE.vocab_topk(df, 10_000).count() == 502


def test_matrix_shape(spark):
    cells = spark.createDataFrame([(1, "word", 0), (1, "word", 1), (2, "word", 1)], "id int, block string, term_id int")
    assert FE.matrix_shape(cells, "id").first().asDict() == {"n_rows": 2, "n_cols": 2, "nnz": 3}


def test_matrix_shape_makes_the_cells_once(spark):
    df = frame(spark)
    shape = FE.matrix_shape(FE.tfidf_long(df, "id", "text", FE.vocabulary(df, "text", "word"), "word"), "id")
    assert shape._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    odd = spark.createDataFrame([(None, "word", 0), (None, "char", 0), (2, "word", None)], "id int, block string, term_id int")
    assert FE.matrix_shape(odd, "id").first().asDict() == {"n_rows": 2, "n_cols": 3, "nnz": 3}
    assert FE.matrix_shape(odd.where("false"), "id").first().asDict() == {"n_rows": 0, "n_cols": 0, "nnz": None}


def test_hashed_tfidf(spark, tmp_path):
    df = frame(spark).withColumnRenamed("text", "processed_text")
    path = str(tmp_path / "hashed")
    plain = FE.fit_hashed_tfidf(df, path=path)
    FE.fit_hashed_tfidf(df, path=path)  # an existing model is replaced
    both = FE.fit_hashed_tfidf(df, hash_bigrams=True)
    a, b = (m.transform(df).orderBy("id").first() for m in (plain, both))
    assert a.features.size == 100_000
    assert a.raw_features.numNonzeros() == len(set(DOCS[0].lower().split()))
    assert b.raw_features.numNonzeros() > a.raw_features.numNonzeros()


@pytest.mark.parametrize(("block", "limits", "brute"), [("word", (1, 2), brute_words), ("char", (2, 4), brute_chars), ("char", (3, 5), lambda t: brute_chars(t, 3, 5))])
def test_batches_count_as_rows_do(spark, monkeypatch, block, limits, brute):
    """Across the cuts of a batch, with characters of two units, null characters and empty texts."""
    monkeypatch.setattr(G, "BATCH_CHARS", 300)
    texts = [*STRINGS[:200], "a\0b \0\0", "", "x" * 900, "𠮷𠮷 a𠮷", "é"]
    made = column_of(spark, lambda c: G.spaced(c, block), texts)
    got = [Counter() for _ in texts]
    for start, end, row, term, tf in G.batch_counts([*made, None], block, *limits):
        assert len(set(zip(row.tolist(), term.to_pylist()))) == len(row)
        for i, t, n in zip(row.tolist(), term.to_pylist(), tf.tolist()):
            assert start + i < end
            got[start + i][t] += n
    assert got == [Counter(brute(t)) for t in texts]


def test_corpus_statistics_are_made_once_and_in_batches(spark):
    """Neither a row a term of a document, nor a second pass for the histogram of the cap."""
    stats = FE.doc_freq(frame(spark), "text", "char")
    assert "Generate" not in stats._jdf.queryExecution().executedPlan().toString()
    top = FE.vocab_topk(stats, 5)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in top and "Scan parquet" in top


@pytest.mark.parametrize(("block", "limits", "brute"), [("word", (1, 2), brute_words), ("char", (2, 4), brute_chars), ("char", (3, 5), lambda t: brute_chars(t, 3, 5))])
def test_sums_of_a_batch_are_those_of_its_rows(spark, monkeypatch, block, limits, brute):
    """Rows that end in the beginning of another's term, empty rows, characters of two units."""
    monkeypatch.setattr(G, "BATCH_CHARS", 300)
    texts = [*STRINGS[:200], "a b", "c", "", "", "b a", "a\0b \0\0", "x" * 900, "𠮷𠮷 a𠮷", "é"]
    made = column_of(spark, lambda c: G.spaced(c, block), texts)
    df, uses = Counter(), Counter()
    for term, rows, tf in G.batch_sums([*made, None], block, *limits):
        assert len(set(term.to_pylist())) == len(term)
        for t, d, n in zip(term.to_pylist(), rows.tolist(), tf.tolist()):
            df[t] += d
            uses[t] += n
    each = [Counter(brute(t)) for t in texts]
    assert df == sum((Counter(c.keys()) for c in each), Counter()) and uses == sum(each, Counter())


@pytest.mark.parametrize(("block", "brute"), [("word", brute_words), ("char", brute_chars)])
def test_terms_of_a_corpus_are_summed_in_batches(spark, block, brute):
    """All terms, without limits, and without a row a term of a document."""
    found = FE.corpus_terms(frame(spark), "text", block)
    assert "Generate" not in found._jdf.queryExecution().executedPlan().toString()
    each = [Counter(brute(t)) for t in DOCS]
    want = {t: (sum(t in c for c in each), sum(c[t] for c in each)) for c in each for t in c}
    assert {r.term: (r.df, r.corpus_tf) for r in found.collect()} == want


@pytest.mark.parametrize("settings", [(2, 4), (3, 5)])
def test_batches_squash_white_space_between_characters(spark, settings):
    """Runs of all kinds of white space, at both ends of rows and across empty ones, count as one space."""
    texts = [" \t a\u3000\u3000b ", "", "  ", "\u2003", "c\x1c\x85d\n", "e  ", " f", "gh", "i\u200bj k\u00a0"]
    made = column_of(spark, lambda c: G.spaced(c, "char"), texts)
    assert made == texts  # no regex of Spark's over every character
    got = [Counter() for _ in texts]
    for start, _, row, term, tf in G.batch_counts(made, "char", *settings):
        for i, t, n in zip(row.tolist(), term.to_pylist(), tf.tolist()):
            got[start + i][t] += n
    assert got == [Counter(brute_chars(t, *settings)) for t in texts] and got[1] == got[2] == got[3] == Counter()
