"""Shared inputs of the catalogue, once for Spark and once as SQL.

The given documents hold no evasion, so ``evaded`` puts one into every text: which
one depends on the document id, and all documents take part.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kotomori.config import LABELS, LEXICON, LOOKALIKE_FROM, LOOKALIKE_TO, RISK
from kotomori.functions.evasion import with_evasion
from kotomori.functions.text import SPACES
from kotomori.session import spread

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def add(query: Query) -> Query:
        QUERIES[name] = query
        if sql is not None:
            ORACLES[name] = sql
        return query

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def documents(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    df = table(spark, sf, "documents")
    return spread(df.select(*columns) if columns else df)


# ---- evaded documents ------------------------------------------------------

ASCII = "".join(map(chr, range(0x21, 0x7F)))
WIDE = "".join(chr(ord(c) + 0xFEE0) for c in ASCII)
LATIN, CYRILLIC = "aeopcxb", "аеорсхб"  # the last one has no Latin look-alike
PREFIX, SUFFIX = "https://h.example/p?q=1 <b>", "</b>"
PHRASES = ("死ね", "殺すぞ バカ", "クズ うざい", "最悪", "デマ", "覚えておけ", "同じ内容の繰り返し", "二度と使わない")


def evade(text: Column, key: Column) -> Column:
    kind = F.pmod(key, F.lit(8))
    phrase = F.get(F.array(*[F.lit(p) for p in PHRASES]), F.pmod(F.floor(key / 8), F.lit(len(PHRASES))).cast("int"))
    return (
        F.when(kind == 1, F.translate(text, ASCII, WIDE))
        .when(kind == 2, F.translate(text, LATIN, CYRILLIC))
        .when(kind == 3, F.regexp_replace(text, "([A-Za-z])", "$1."))
        .when(kind == 4, F.regexp_replace(text, "([aeiou])", "$1$1$1$1"))
        .when(kind == 5, F.concat(F.lit(PREFIX), text, F.lit(SUFFIX)))
        .when(kind == 6, F.concat(text, F.lit(" "), phrase))
        .otherwise(text)
    )


def evaded(spark: SparkSession, sf: str, docs: DataFrame | None = None) -> DataFrame:
    """``(doc_id, lang, n_chars, raw)`` and, of given ``docs``, their other columns."""
    docs = documents(spark, sf, "doc_id", "lang", "n_chars", "text") if docs is None else docs
    others = [c for c in docs.columns if c not in ("doc_id", "lang", "n_chars", "text", "source")]
    return docs.select("doc_id", "lang", "n_chars", evade(F.col("text"), F.col("doc_id")).alias("raw"), *others)


def analysed(spark: SparkSession, sf: str) -> DataFrame:
    return with_evasion(evaded(spark, sf), "raw")


def quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def listed(items) -> str:
    return ", ".join(quoted(s) for s in items)


SQL_SPACES = f"[{SPACES}]"
SQL_NON_SPACE = f"[^{SPACES}]"
SQL_WORD = r"[\pL\pN_]"

EVADED = f"""evaded AS (
  SELECT doc_id, lang, n_chars, CASE doc_id % 8
    WHEN 1 THEN translate(text, {quoted(ASCII)}, {quoted(WIDE)})
    WHEN 2 THEN translate(text, {quoted(LATIN)}, {quoted(CYRILLIC)})
    WHEN 3 THEN regexp_replace(text, '([A-Za-z])', '\\1.', 'g')
    WHEN 4 THEN regexp_replace(text, '([aeiou])', '\\1\\1\\1\\1', 'g')
    WHEN 5 THEN {quoted(PREFIX)} || text || {quoted(SUFFIX)}
    WHEN 6 THEN text || ' ' || ([{listed(PHRASES)}])[(doc_id // 8) % {len(PHRASES)} + 1]
    ELSE text END AS raw
  FROM documents)"""

# The only wide text is the one made above, so its inverse stands in for NFKC.
WIDENED = f"""widened AS (
  SELECT *, CASE WHEN doc_id % 8 = 1 THEN translate(raw, {quoted(WIDE)}, {quoted(ASCII)}) ELSE raw END AS wide
  FROM evaded)"""


def sql_join_symbols(source: str, column: str, out: str) -> str:
    """CTE ``out`` adding ``joined``: in-word symbols of ``column`` removed."""
    return f"""{out}_chars AS (
  SELECT *, list_transform(ch, lambda c: regexp_matches(c, '{SQL_WORD}')) AS w
  FROM (SELECT *, string_split({column}, '') AS ch FROM {source})),
{out} AS (
  SELECT * EXCLUDE (ch, w), array_to_string(list_filter(ch, lambda c, i:
    NOT (c IN ('.', '·', '•', '*', '_', '-', '|', '/', '\\') AND i > 1 AND w[i - 1] AND coalesce(w[i + 1], false))), '') AS joined
  FROM {out}_chars)"""


def sql_collapse(source: str, column: str, out: str) -> str:
    """CTE ``out`` adding ``normalized``: at most two equal characters in a row."""
    return f"""{out} AS (
  SELECT * EXCLUDE (ch), array_to_string(list_filter(ch, lambda c, i:
    NOT (i > 2 AND c <> chr(10) AND c = ch[i - 1] AND c = ch[i - 2])), '') AS normalized
  FROM (SELECT *, string_split({column}, '') AS ch FROM {source}))"""


def sql_hits(column: str) -> str:
    cases = ", ".join(f"CASE WHEN regexp_matches({column}, {quoted(p)}) THEN {quoted(p)} END" for p in LEXICON)
    return f"list_filter([{cases}], lambda x: x IS NOT NULL)"


def sql_signals(source: str, text: str) -> str:
    """CTEs ending in ``signals``: all evasion columns of ``source``, whose ``wide``
    is the compatibility form of its column ``text``."""

    def part(condition: str, weight: float) -> str:
        return f"CASE WHEN {condition} THEN {weight}::DOUBLE ELSE 0::DOUBLE END"

    total = " + ".join(
        [
            part("had_fullwidth", RISK.fullwidth),
            part("had_homoglyphs", RISK.homoglyphs),
            part("had_symbol_insertion", RISK.symbol_insertion),
            part("had_elongation", RISK.elongation),
            part("cyrillic", RISK.cyrillic),
            f"least(len(hits), {RISK.lexicon_hits_counted})::DOUBLE * {RISK.lexicon_hit}::DOUBLE",
        ]
    )
    return f"""folded AS (
  SELECT *, translate(wide, {quoted(LOOKALIKE_FROM)}, {quoted(LOOKALIKE_TO)}) AS folded FROM {source}),
{sql_join_symbols("folded", "folded", "symbols")},
{sql_collapse("symbols", "joined", "collapsed")},
flags AS (
  SELECT *, length({text}) AS original_length, wide <> {text} AS had_fullwidth,
    folded <> wide AS had_homoglyphs, joined <> folded AS had_symbol_insertion, normalized <> joined AS had_elongation,
    regexp_matches(normalized, '[\\x{{3040}}-\\x{{30ff}}\\x{{4e00}}-\\x{{9fff}}]') AS japanese,
    regexp_matches(normalized, '[a-zA-Z]') AS latin, regexp_matches(normalized, '[0-9]') AS numerals,
    regexp_matches(normalized, '[\\x{{400}}-\\x{{4ff}}]') AS cyrillic, {sql_hits("normalized")} AS hits
  FROM collapsed),
signals AS (SELECT *, least({total}, {RISK.cap}::DOUBLE) AS risk FROM flags)"""


SIGNALS = f"{EVADED},\n{WIDENED},\n{sql_signals('widened', 'raw')}"

# ---- labelled and scored documents ----------------------------------------

CLASS_RULE = "CASE WHEN toxic = 1 THEN 0 WHEN quality = 0 THEN 2 ELSE 1 END"


def labels(spark: SparkSession, sf: str) -> DataFrame:
    """``(doc_id, label_id)`` by a fixed rule over the two given labels."""
    return table(spark, sf, "labels").select("doc_id", F.expr(CLASS_RULE).alias("label_id"))


def labelled(spark: SparkSession, sf: str) -> DataFrame:
    """``(id, text, label)`` of the labelled documents."""
    names = F.array(*[F.lit(x) for x in LABELS])
    return (
        spread(table(spark, sf, "documents").select("doc_id", "text").join(labels(spark, sf), "doc_id"))
        .select(F.col("doc_id").alias("id"), "text", F.get(names, F.col("label_id")).alias("label"))
    )


def hash_share(key: str, start: int) -> Column:
    """A reproducible number in [0, 1] with three digits."""
    digits = F.substring(F.md5(F.col(key).cast("string").cast("binary")), start, 4)
    return F.conv(digits, 16, 10).cast("int") % 1001 / F.lit(1000.0)


def scored(spark: SparkSession, sf: str, docs: DataFrame | None = None) -> DataFrame:
    """All evaded documents with a rule for the prediction, so that everything after a
    model can be checked exactly."""
    with_risk = with_evasion(evaded(spark, sf, docs), "raw")
    y_pred = F.when(F.col("risk") > 0.4, 0).when(F.col("n_chars") < 500, 2).otherwise(1)
    return (
        with_risk.withColumn("y_pred", y_pred)
        .withColumn("predicted_class", F.get(F.array(*[F.lit(x) for x in LABELS]), F.col("y_pred")))
        .withColumn("confidence", hash_share("doc_id", 1))
    )


def judged(spark: SparkSession, sf: str) -> DataFrame:
    """The scored documents that have a true class, for the metrics; the others never
    reach the text chain."""
    true = labels(spark, sf).withColumnRenamed("label_id", "y_true")
    return scored(spark, sf, spread(table(spark, sf, "documents").join(true, "doc_id")))


def sql_share(start: int, key: str = "doc_id") -> str:
    return f"(('0x' || substr(md5({key}::VARCHAR), {start}, 4))::INT % 1001) / 1000::DOUBLE"


def sql_name(column: str) -> str:
    return f"([{listed(LABELS)}])[{column} + 1]"


TRUTH = f"truth AS (SELECT doc_id, {CLASS_RULE} AS label_id FROM labels)"

SCORED = f"""{SIGNALS},
ruled AS (
  SELECT s.*, CASE WHEN risk > 0.4::DOUBLE THEN 0 WHEN n_chars < 500 THEN 2 ELSE 1 END AS y_pred FROM signals s),
scored AS (SELECT *, {sql_name('y_pred')} AS predicted_class, {sql_share(1)} AS confidence FROM ruled)"""

JUDGED = f"""{SCORED},
{TRUTH},
judged AS (SELECT s.*, t.label_id AS y_true FROM scored s JOIN truth t USING (doc_id))"""
