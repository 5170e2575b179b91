"""Evasion queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from kotomori.config import LOOKALIKE_FROM, LOOKALIKE_TO, CleanSettings
from kotomori.functions import evasion as E
from kotomori.functions.text import nfkc
from kotomori.operators.cleaning import high_risk_rate, prepare
from kotomori.plans.catalogue.base import (
    EVADED,
    SIGNALS,
    WIDENED,
    analysed,
    evaded,
    quoted,
    register,
    sql_collapse,
    sql_join_symbols,
    sql_signals,
)
from kotomori.plans.catalogue.text import SQL_CLEAN_CHAR


@register("had_fullwidth", f"WITH {EVADED}, {WIDENED} SELECT doc_id, wide <> raw AS had_fullwidth FROM widened")
def had_fullwidth(spark, sf):
    return evaded(spark, sf).select("doc_id", (nfkc(F.col("raw")) != F.col("raw")).alias("had_fullwidth"))


@register(
    "fold_homoglyphs",
    f"WITH {EVADED} SELECT doc_id, translate(raw, {quoted(LOOKALIKE_FROM)}, {quoted(LOOKALIKE_TO)}) AS folded FROM evaded",
)
def fold_homoglyphs(spark, sf):
    return evaded(spark, sf).select("doc_id", E.fold_homoglyphs(F.col("raw")).alias("folded"))


@register(
    "strip_inserted_symbols",
    f"WITH {EVADED}, {sql_join_symbols('evaded', 'raw', 'symbols')} SELECT doc_id, joined FROM symbols",
)
def strip_inserted_symbols(spark, sf):
    return evaded(spark, sf).select("doc_id", E.strip_inserted_symbols(F.col("raw")).alias("joined"))


@register(
    "collapse_elongation",
    f"WITH {EVADED}, {sql_collapse('evaded', 'raw', 'collapsed')} SELECT doc_id, normalized FROM collapsed",
)
def collapse_elongation(spark, sf):
    return evaded(spark, sf).select("doc_id", E.collapse_elongation(F.col("raw")).alias("normalized"))


@register(
    "script_flags",
    f"""WITH {SIGNALS} SELECT doc_id, japanese, latin, numerals, cyrillic, japanese AND latin AS code_switching
FROM signals""",
)
def script_flags(spark, sf):
    return analysed(spark, sf).select("doc_id", "script_info.*")


@register(
    "lexicon_hits",
    f"WITH {SIGNALS} SELECT doc_id, len(hits) AS n_hits, array_to_string(hits, '; ') AS hits FROM signals",
)
def lexicon_hits(spark, sf):
    hits = F.col("abuse_patterns_found")
    return analysed(spark, sf).select("doc_id", F.size(hits).alias("n_hits"), F.array_join(hits, "; ").alias("hits"))


HAD = ", ".join(E.SIGNALS)


@register("normalise_evasion", f"WITH {SIGNALS} SELECT doc_id, normalized, original_length, {HAD} FROM signals")
def normalise_evasion(spark, sf):
    return analysed(spark, sf).select("doc_id", "normalized", "original_length", *E.SIGNALS)


@register("original_length", f"WITH {EVADED} SELECT doc_id, length(raw) AS original_length FROM evaded")
def original_length(spark, sf):
    return evaded(spark, sf).select("doc_id", F.char_length("raw").alias("original_length"))


@register("risk_score", f"WITH {SIGNALS} SELECT doc_id, round(risk, 6) AS risk FROM signals")
def risk_score(spark, sf):
    return analysed(spark, sf).select("doc_id", F.round("risk", 6).alias("risk"))


@register(
    "high_risk_rate",
    f"""WITH {SIGNALS} SELECT lang, count(*) AS n, count(*) FILTER (risk > 0.4::DOUBLE) AS n_high,
  round(100.0::DOUBLE * count(*) FILTER (risk > 0.4::DOUBLE) / count(*), 2) AS high_pct
FROM signals GROUP BY lang""",
)
def high_risk(spark, sf):
    return high_risk_rate(analysed(spark, sf), "lang")


@register(
    "flags_map",
    f"""WITH {SIGNALS} SELECT doc_id, array_to_string(list_filter([{', '.join(f"CASE WHEN {s} THEN '{s}' END" for s in E.SIGNALS)}],
  lambda x: x IS NOT NULL), ',') AS flags FROM signals""",
)
def flags_map(spark, sf):
    return analysed(spark, sf).select("doc_id", F.array_join(F.map_keys(E.flags_map()), ",").alias("flags"))


@register(
    "row_flags_doc",
    f"""WITH {SIGNALS} SELECT doc_id, array_to_string(list_filter([
  CASE WHEN {' OR '.join(E.SIGNALS)} THEN 'adversarial_text_detected' END,
  CASE WHEN japanese AND latin THEN 'code_switching' END], lambda x: x IS NOT NULL), ',') AS flags FROM signals""",
)
def row_flags_doc(spark, sf):
    return analysed(spark, sf).select("doc_id", F.array_join(E.row_flags(), ",").alias("flags"))


# cleaned text is in compatibility form already, so `wide` is the text itself
CLEAN_FIRST = f"""{SQL_CLEAN_CHAR},
kept AS (SELECT doc_id, lang, n_chars, processed_text AS raw, processed_text AS wide FROM cleaned WHERE processed_text <> ''),
{sql_signals('kept', 'raw')}"""


@register(
    "prepare_clean_first",
    f"WITH {CLEAN_FIRST} SELECT doc_id, normalized AS processed_text, {HAD}, round(risk, 6) AS risk FROM signals",
)
def prepare_clean_first(spark, sf):
    return prepare(evaded(spark, sf), "raw").select("doc_id", "processed_text", *E.SIGNALS, F.round("risk", 6).alias("risk"))


RAW_FIRST_TAIL = SQL_CLEAN_CHAR[SQL_CLEAN_CHAR.index("stripped AS") :].replace("wide,", "normalized,").replace(
    "FROM widened", "FROM signals"
).replace("n_chars, trim", f"n_chars, {HAD}, risk, trim").replace("n_chars, array", f"n_chars, {HAD}, risk, array")


@register(
    "prepare_raw_first",
    f"""WITH {SIGNALS}, {RAW_FIRST_TAIL}
SELECT doc_id, processed_text, {HAD}, round(risk, 6) AS risk FROM cleaned WHERE processed_text <> ''""",
)
def prepare_raw_first(spark, sf):
    rows = prepare(evaded(spark, sf), "raw", CleanSettings(order="raw_first"))
    return rows.select("doc_id", "processed_text", *E.SIGNALS, F.round("risk", 6).alias("risk"))
