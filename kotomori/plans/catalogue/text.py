"""Cleaning queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from kotomori.config import STOPWORDS, CleanSettings
from kotomori.functions import text as X
from kotomori.operators.cleaning import clean_corpus, clean_corpus_counted, drop_report, lemmatise
from kotomori.operators.segment import with_segments
from kotomori.plans.catalogue.base import (
    EVADED,
    ORACLES,
    SQL_NON_SPACE,
    SQL_SPACES,
    WIDENED,
    documents,
    evaded,
    listed,
    register,
    table,
)
from kotomori.session import pin, shared_folder

RUNS = X.SCRIPT_RUN
SQL_URL = X.URL


def pages(spark, sf):
    return table(spark, sf, "pages").select("page_id", "html")


@register("nfkc", f"WITH {EVADED}, {WIDENED} SELECT doc_id, wide AS text FROM widened")
def nfkc(spark, sf):
    return evaded(spark, sf).select("doc_id", X.nfkc(F.col("raw")).alias("text"))


@register("strip_urls", f"SELECT page_id, regexp_replace(html, '{SQL_URL}', '', 'g') AS html FROM pages")
def strip_urls(spark, sf):
    return pages(spark, sf).select("page_id", X.strip_urls(F.col("html")).alias("html"))


@register("strip_html", "SELECT page_id, regexp_replace(html, '<[^>]+>', '', 'g') AS html FROM pages")
def strip_html(spark, sf):
    return pages(spark, sf).select("page_id", X.strip_html(F.col("html")).alias("html"))


@register("squash_ws", f"SELECT page_id, trim(regexp_replace(html, '{SQL_SPACES}+', ' ', 'g')) AS html FROM pages")
def squash_ws(spark, sf):
    return pages(spark, sf).select("page_id", X.squash_ws(F.col("html")).alias("html"))


# every turn once as it is and, for user turns, once blank
@register(
    "guard_text",
    f"""SELECT conv_id, turn, role, CASE WHEN regexp_matches(t, '{SQL_NON_SPACE}') THEN t ELSE '' END AS text
FROM (SELECT conv_id, turn, role, text AS t FROM conversations UNION ALL
      SELECT conv_id, turn, role, CASE WHEN turn % 3 = 0 THEN chr(12288) END AS t FROM conversations WHERE role = 'user')""",
)
def guard_text(spark, sf):
    turns = table(spark, sf, "conversations")
    blank = turns.where("role = 'user'").withColumn("text", F.when(F.col("turn") % 3 == 0, F.lit("　")))
    return turns.unionByName(blank).select("conv_id", "turn", "role", X.guard_text(F.col("text")).alias("text"))


@register(
    "char_tokens",
    f"""SELECT doc_id, len(t) AS n_tokens, len(list_distinct(t)) AS n_distinct, array_to_string(t, '|') AS tokens
FROM (SELECT doc_id, regexp_extract_all(text, '{SQL_NON_SPACE}') AS t FROM documents)""",
)
def char_tokens(spark, sf):
    return _tokens(documents(spark, sf, "doc_id", "text").withColumn("t", X.char_tokens(F.col("text"))))


def _tokens(df):
    return df.select(
        "doc_id",
        F.size("t").alias("n_tokens"),
        F.size(F.array_distinct("t")).alias("n_distinct"),
        F.array_join("t", "|").alias("tokens"),
    )


@register(
    "segment_tokens",
    f"""WITH {EVADED} SELECT doc_id, len(t) AS n_tokens, len(list_distinct(t)) AS n_distinct, array_to_string(t, '|') AS tokens
FROM (SELECT doc_id, regexp_extract_all(raw, '{RUNS}') AS t FROM evaded)""",
)
def segment_tokens(spark, sf):
    return _tokens(evaded(spark, sf).withColumn("t", X.segment_tokens(F.col("raw"))))


SQL_STOPS = listed(STOPWORDS)


@register(
    "drop_stopwords",
    f"""WITH {EVADED} SELECT doc_id, array_to_string(list_filter(regexp_extract_all(raw, '{RUNS}'),
  lambda t: t NOT IN ({SQL_STOPS})), ' ') AS kept FROM evaded""",
)
def drop_stopwords(spark, sf):
    tokens = X.segment_tokens(F.col("raw"))
    return evaded(spark, sf).select("doc_id", F.array_join(X.drop_stopwords(tokens), " ").alias("kept"))


def sql_clean(tokens: str) -> str:
    return f"""{EVADED}, {WIDENED},
stripped AS (SELECT doc_id, lang, n_chars, trim(regexp_replace(regexp_replace(regexp_replace(wide, '{SQL_URL}', '', 'g'),
  '<[^>]+>', '', 'g'), '{SQL_SPACES}+', ' ', 'g')) AS s FROM widened),
cleaned AS (SELECT doc_id, lang, n_chars, array_to_string(list_filter(regexp_extract_all(s, '{tokens}'),
  lambda t: t NOT IN ({SQL_STOPS})), ' ') AS processed_text FROM stripped)"""


SQL_CLEAN_CHAR = sql_clean(SQL_NON_SPACE)


@register("clean_text", f"WITH {SQL_CLEAN_CHAR} SELECT doc_id, processed_text FROM cleaned")
def clean_text(spark, sf):
    return evaded(spark, sf).select("doc_id", X.clean_text(F.col("raw")).alias("processed_text"))


@register(
    "clean_corpus",
    f"WITH {sql_clean(RUNS)} SELECT doc_id, lang, processed_text FROM cleaned WHERE processed_text <> ''",
)
def clean_corpus_query(spark, sf):
    settings = CleanSettings(tokenizer="script")
    return clean_corpus(evaded(spark, sf), "raw", settings).select("doc_id", "lang", "processed_text")


# conversation turns plus one blank copy of each user turn
@register(
    "drop_report",
    """SELECT count(*) + count(*) FILTER (role = 'user') AS n_total, count(*) FILTER (role = 'user') AS n_dropped, count(*) AS n_kept
FROM conversations""",
)
def drop_report_query(spark, sf):
    turns = table(spark, sf, "conversations")
    blank = turns.where("role = 'user'").select(F.lit(" 　 ").alias("text"))
    return drop_report(turns.select("text").unionByName(blank))


# the same turns, counted while the clean ones are written
@register("drop_report_written", ORACLES["drop_report"])
def drop_report_written(spark, sf):
    turns = table(spark, sf, "conversations")
    blank = turns.where("role = 'user'").select(F.lit(" 　 ").alias("text"))
    kept, seen = clean_corpus_counted(turns.select("text").unionByName(blank))
    kept.write.parquet(shared_folder(spark, "cleaned"))
    return spark.range(1).select(*[F.lit(n).cast("long").alias(name) for name, n in seen.get.items()])


# lemma table: every word that occurs with and without a final "s"
@register(
    "lemmatise",
    f"""WITH t AS (SELECT doc_id, unnest(range(1, len(ts) + 1)) AS i, unnest(ts) AS tok
  FROM (SELECT doc_id, regexp_extract_all(text, '{RUNS}') AS ts FROM documents)),
words AS (SELECT DISTINCT tok FROM t),
lemmas AS (SELECT a.tok AS surface, b.tok AS lemma FROM words a JOIN words b ON a.tok = b.tok || 's')
SELECT doc_id, string_agg(coalesce(lemma, tok), ' ' ORDER BY i) AS lemmas
FROM t LEFT JOIN lemmas ON tok = surface GROUP BY doc_id""",
)
def lemmatise_query(spark, sf):
    # texts are cut once, for the words, their lemmas and the rows
    docs = pin(documents(spark, sf, "doc_id", "text").select("doc_id", X.segment_tokens(F.col("text")).alias("tokens")), "tokens")
    words = pin(docs.select(F.explode("tokens").alias("lemma")).distinct(), "words")
    lemmas = words.select(F.concat("lemma", F.lit("s")).alias("surface"), "lemma").join(
        words.select(F.col("lemma").alias("surface")), "surface", "left_semi"
    )
    return lemmatise(docs, lemmas, "doc_id").select("doc_id", F.array_join("tokens", " ").alias("lemmas"))


@register("segment_dictionary")
def segment_dictionary(spark, sf):
    """Texts whose spaces are gone, cut by a dictionary of all words of the corpus; frequent
    words are cheap."""
    docs = documents(spark, sf, "doc_id", "text")
    words = docs.select(F.explode(X.segment_tokens(F.col("text"))).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    priced = words.select("word", F.greatest(F.lit(1), 40 - 2 * F.floor(F.log2("n"))).alias("cost"))
    joined = docs.select("doc_id", F.regexp_replace("text", X.SPACE_RUN, "").alias("text"))
    cut = with_segments(joined, pin(priced, "dictionary"), "text")
    return cut.select("doc_id", F.size("tokens").alias("n_tokens"), F.array_join("tokens", " ").alias("tokens"))


@register("preview", "SELECT doc_id, substr(text, 1, 60) || '...' AS text_preview FROM documents")
def preview(spark, sf):
    return documents(spark, sf, "doc_id", "text").select("doc_id", X.preview(F.col("text")).alias("text_preview"))
