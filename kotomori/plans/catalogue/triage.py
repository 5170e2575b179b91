"""Triage queries on rule-made predictions, so that they can be exact."""

from __future__ import annotations

from pyspark.sql import functions as F

from kotomori.config import DEFAULT_TIER, LABELS, TAXONOMY, TIER_ACTIONS, TIER_RULES
from kotomori.operators import triage as G
from kotomori.operators.lexicon import phrase_index, with_indexed_taxonomy, with_phrases
from kotomori.operators.rules import with_indexed_policy_tier
from kotomori.plans.catalogue.base import SCORED, documents, hash_share, quoted, register, scored, sql_share, table
from kotomori.session import pin
from kotomori.sources.policy import builtin_taxonomy, builtin_tier_policy

SQL_DEFAULT = (
    "CASE predicted_class "
    + " ".join(f"WHEN {quoted(c)} THEN {quoted(t)}" for c, t in zip(LABELS, DEFAULT_TIER))
    + " END"
)
SQL_SIMPLE = f"CASE WHEN predicted_class = '{LABELS[0]}' AND risk > 0.4::DOUBLE THEN 'CRITICAL' ELSE {SQL_DEFAULT} END"
TIERED = f"""{SCORED},
tiered AS (SELECT *, {SQL_SIMPLE} AS severity_tier FROM scored),
records AS (SELECT *, severity_tier IN ('HIGH', 'CRITICAL') AS escalate_to_human FROM tiered)"""


def records(spark, sf):
    tier = G.tier_simple(F.col("predicted_class"), F.col("risk"))
    return (
        scored(spark, sf)
        .withColumn("severity_tier", tier)
        .withColumn("escalate_to_human", G.escalate_simple(F.col("severity_tier")))
    )


# three hash-made class probabilities; the predicted class takes one of them
SQL_PROBS = f"[{sql_share(1)}, {sql_share(5)}, {sql_share(9)}]"


def with_probabilities(df):
    return df.withColumn("probabilities", F.array(*[hash_share("doc_id", i) for i in (1, 5, 9)]))


@register("confidence", f"WITH {SCORED} SELECT doc_id, round(({SQL_PROBS})[y_pred + 1], 4) AS confidence FROM scored")
def confidence(spark, sf):
    rows = with_probabilities(scored(spark, sf))
    return rows.select("doc_id", G.confidence(F.col("probabilities"), F.col("y_pred")).alias("confidence"))


@register("tier_simple", f"WITH {TIERED} SELECT doc_id, predicted_class, round(risk, 3) AS risk, severity_tier FROM records")
def tier_simple(spark, sf):
    return records(spark, sf).select("doc_id", "predicted_class", F.round("risk", 3).alias("risk"), "severity_tier")


@register("escalate_simple", f"WITH {TIERED} SELECT doc_id, severity_tier, escalate_to_human FROM records")
def escalate_simple(spark, sf):
    return records(spark, sf).select("doc_id", "severity_tier", "escalate_to_human")


@register(
    "escalation_rate",
    f"""WITH {TIERED} SELECT count(*) AS n, count(*) FILTER (escalate_to_human) AS n_escalated,
  round(100.0::DOUBLE * count(*) FILTER (escalate_to_human) / count(*), 1) AS escalated_pct FROM records""",
)
def escalation_rate(spark, sf):
    return G.escalation_rate(records(spark, sf))


def _sql_rule(tier, label, risk_min, conf_min, conf_max) -> str:
    tests = [f"predicted_class = {quoted(label)}"]
    tests += [f"risk >= {risk_min}::DOUBLE"] if risk_min is not None else []
    tests += [f"confidence >= {conf_min}::DOUBLE"] if conf_min is not None else []
    tests += [f"confidence <= {conf_max}::DOUBLE"] if conf_max is not None else []
    return f"WHEN {' AND '.join(tests)} THEN {quoted(tier)}"


SQL_POLICY = f"CASE {' '.join(_sql_rule(*r) for r in TIER_RULES)} ELSE {SQL_DEFAULT} END"
SQL_TIER_POLICY = f"WITH {SCORED} SELECT doc_id, predicted_class, confidence, {SQL_POLICY} AS policy_tier FROM scored"


@register("tier_policy", SQL_TIER_POLICY)
def tier_policy(spark, sf):
    rows = G.with_policy_tier(scored(spark, sf), builtin_tier_policy(spark))
    return rows.select("doc_id", "predicted_class", "confidence", "policy_tier")


AUTO = f"""{TIERED},
fired AS (SELECT *, list_filter([
    CASE WHEN had_homoglyphs AND predicted_class = '{LABELS[0]}' THEN 'homoglyph_abuse' END,
    CASE WHEN risk > 0.6::DOUBLE THEN 'high_risk' END,
    CASE WHEN len(hits) > 0 AND confidence > 0.8::DOUBLE THEN 'lexicon_hit' END], lambda x: x IS NOT NULL) AS fired
  FROM records),
auto AS (SELECT *, len(fired) = 0 AND predicted_class = '{LABELS[2]}' AND confidence > 0.9::DOUBLE
    AND risk < 0.1::DOUBLE AS auto_approved,
    CASE WHEN len(fired) > 0 THEN 'CRITICAL' ELSE severity_tier END AS final_tier FROM fired)"""


@register("auto_escalate", f"WITH {AUTO} SELECT doc_id, array_to_string(fired, ',') AS rules_fired, final_tier FROM auto")
def auto_escalate(spark, sf):
    rows = G.with_auto_rules(records(spark, sf))
    return rows.select("doc_id", F.array_join("rules_fired", ",").alias("rules_fired"), "final_tier")


@register("auto_approve", f"WITH {AUTO} SELECT doc_id, predicted_class, auto_approved FROM auto")
def auto_approve(spark, sf):
    return G.with_auto_rules(records(spark, sf)).select("doc_id", "predicted_class", "auto_approved")


SQL_RANK = f"list_position([{', '.join(quoted(t) for t in G.QUEUE_ORDER)}], severity_tier)::BIGINT"
QUEUE = f"""{TIERED}
SELECT doc_id, severity_tier, {SQL_RANK} AS queue_rank, round(risk, 3) AS risk FROM records
WHERE escalate_to_human ORDER BY {SQL_RANK}, records.risk DESC, doc_id"""


def queue_columns(df):
    return df.select("doc_id", "severity_tier", "queue_rank", F.round("risk", 3).alias("risk"))


@register("review_queue", f"WITH {QUEUE}")
def review_queue(spark, sf):
    urgent = records(spark, sf).select("doc_id", "severity_tier", "risk", "escalate_to_human")
    return queue_columns(G.review_queue(urgent, "doc_id"))


@register("review_queue_top", f"WITH {QUEUE} LIMIT 50")
def review_queue_top(spark, sf):
    return queue_columns(G.review_queue(records(spark, sf), "doc_id", top=50))


def _sql_by_tier(index: int) -> str:
    def value(row):
        return quoted(row[index]) if isinstance(row[index], str) else str(row[index])

    return "CASE severity_tier " + " ".join(f"WHEN {quoted(r[0])} THEN {value(r)}" for r in TIER_ACTIONS) + " END"


@register(
    "sla_due",
    f"""WITH {TIERED}, s AS (SELECT doc_id, severity_tier, {_sql_by_tier(1)} AS action, {_sql_by_tier(2)} AS sla_minutes FROM records)
SELECT *, TIMESTAMP '2024-01-01 00:00:00' + to_minutes(doc_id + sla_minutes) AS due_at FROM s""",
)
def sla_due(spark, sf):
    sent = F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, cast(doc_id as int), 0)")
    rows = G.with_sla(records(spark, sf).withColumn("sent_at", sent), submitted_at="sent_at")
    return rows.select("doc_id", "severity_tier", "action", "sla_minutes", "due_at")


def _sql_taxonomy() -> str:
    rows, seen = [], {}
    for label, subcategory, _, escalate, phrases in TAXONOMY:
        seen[label] = seen.get(label, -1) + 1
        rows += [f"({quoted(label)}, {seen[label]}, {quoted(subcategory)}, {escalate}, {quoted(p)})" for p in phrases]
    return f"taxonomy(class, position, subcategory, escalate, phrase) AS (VALUES {', '.join(rows)})"


SQL_TAXONOMY = f"""WITH {SCORED}, {_sql_taxonomy()},
hits_by_row AS (SELECT doc_id, t.*, row_number() OVER (PARTITION BY doc_id ORDER BY length(phrase) DESC, position, phrase DESC) AS r
  FROM scored JOIN taxonomy t ON class = predicted_class AND contains(normalized, phrase))
SELECT s.doc_id, predicted_class AS category, subcategory, escalate AS subcategory_escalate
FROM scored s LEFT JOIN hits_by_row h ON s.doc_id = h.doc_id AND r = 1"""


@register("assign_taxonomy", SQL_TAXONOMY)
def assign_taxonomy(spark, sf):
    rows = G.with_taxonomy(scored(spark, sf), builtin_taxonomy(spark), "normalized")
    return rows.select("doc_id", "category", "subcategory", "subcategory_escalate")


@register("default_severity", f"WITH {SCORED} SELECT doc_id, {SQL_DEFAULT} AS severity FROM scored")
def default_severity(spark, sf):
    return scored(spark, sf).select("doc_id", G.default_severity(F.col("predicted_class")).alias("severity"))


@register(
    "uncertain_rows",
    f"""WITH p AS (SELECT doc_id, list_reverse_sort([{sql_share(1, 'text')}, {sql_share(5, 'text')}, {sql_share(9, 'text')}]) AS p FROM documents)
SELECT doc_id, round(p[1] - p[2], 6) AS margin FROM p ORDER BY p[1] - p[2], doc_id LIMIT 100""",
)
def uncertain_rows(spark, sf):
    by_text = F.array(*[hash_share("text", i) for i in (1, 5, 9)])
    rows = G.uncertain_rows(documents(spark, sf, "doc_id", "text").withColumn("probabilities", by_text), "doc_id", top=100)
    return rows.select("doc_id", F.round("margin", 6).alias("margin"))


@register(
    "uncertain_by_class",
    f"""WITH {SCORED}, p AS (SELECT doc_id, predicted_class, list_reverse_sort({SQL_PROBS}) AS p FROM scored),
ranked AS (SELECT doc_id, predicted_class, p[1] - p[2] AS margin, row_number() OVER (PARTITION BY predicted_class ORDER BY p[1] - p[2], doc_id)::INT AS rank FROM p)
SELECT doc_id, predicted_class, round(margin, 6) AS margin, rank FROM ranked WHERE rank <= 25""",
)
def uncertain_by_class(spark, sf):
    rows = with_probabilities(scored(spark, sf)).select("doc_id", "predicted_class", "probabilities")
    return G.uncertain_by_class(rows, "doc_id", top=25).select("doc_id", "predicted_class", F.round("margin", 6).alias("margin"), "rank")


# a rule for each line item and class: bounds from its numbers, some of them missing
RULE_ROWS = """SELECT l_orderkey % 97 AS priority, l_orderkey * 10 + l_linenumber AS rule_no,
  CASE l_partkey % 4 WHEN 0 THEN 'CRITICAL' WHEN 1 THEN 'HIGH' WHEN 2 THEN 'MEDIUM' ELSE 'LOW' END AS tier,
  CASE l_suppkey % 4 WHEN 0 THEN 'abusive_content' WHEN 1 THEN 'negative_sentiment' WHEN 2 THEN 'quality_risk' END AS predicted_class,
  CASE WHEN l_partkey % 5 > 0 THEN CAST(l_partkey % 20 AS DOUBLE) / 20 + 0.05 END AS risk_min,
  CASE WHEN l_suppkey % 7 > 0 THEN CAST(l_orderkey % 1000 AS DOUBLE) / 1000 END AS conf_min,
  CASE WHEN l_orderkey % 3 > 0 THEN CAST(l_orderkey % 1000 AS DOUBLE) / 1000 + 0.001 * l_linenumber END AS conf_max
FROM lineitem WHERE l_partkey % 5 > 0 OR l_orderkey % 3 > 0"""


def many_rules(spark, sf):
    table(spark, sf, "lineitem").createOrReplaceTempView("policy_lines")
    return spark.sql(RULE_ROWS.replace("FROM lineitem", "FROM policy_lines"))


@register(
    "tier_policy_indexed",
    f"""WITH {SCORED}, rules AS ({RULE_ROWS}),
points AS (SELECT DISTINCT predicted_class, risk, confidence FROM scored),
met AS (
  SELECT p.predicted_class, p.risk, p.confidence, arg_min(r.tier, (r.priority, r.rule_no, r.tier)) AS tier
  FROM points p JOIN rules r ON coalesce(r.predicted_class, p.predicted_class) = p.predicted_class
    AND (risk_min IS NULL OR p.risk >= risk_min) AND (conf_min IS NULL OR p.confidence >= conf_min) AND (conf_max IS NULL OR p.confidence <= conf_max)
  GROUP BY ALL)
SELECT doc_id, predicted_class, confidence, coalesce(m.tier, {SQL_DEFAULT}) AS policy_tier
FROM scored LEFT JOIN met m USING (predicted_class, risk, confidence)""",
)
def tier_policy_indexed(spark, sf):
    """The tier policy with a rule for each line item, by dyadic cells."""
    rows = scored(spark, sf).select("doc_id", "predicted_class", "risk", "confidence")
    return with_indexed_policy_tier(rows, many_rules(spark, sf)).select("doc_id", "predicted_class", "confidence", "policy_tier")


# every run of 12 characters that begins a word of a benchmark text, as a phrase
PHRASE_ROWS = r"""SELECT DISTINCT item_id, substr(text, i, 12) AS phrase
FROM (SELECT item_id, text, unnest(range(1, length(text) - 10)) AS i FROM benchmark) WHERE substr(text, i - 1, 1) = ' ' AND i > 1"""


def many_phrases(spark, sf):
    texts = table(spark, sf, "benchmark").select("item_id", "text").where(F.char_length("text") > 11)
    at = texts.withColumn("i", F.explode(F.sequence(F.lit(2), F.char_length("text") - 11)))
    at = at.where(F.substring("text", F.col("i") - 1, F.lit(1)) == " ")
    return at.select("item_id", F.substring("text", F.col("i"), F.lit(12)).alias("phrase")).distinct()


@register(
    "lexicon_large",
    f"""WITH phrases AS (SELECT DISTINCT phrase FROM ({PHRASE_ROWS}))
SELECT doc_id, coalesce(string_agg(phrase, '|' ORDER BY phrase COLLATE "C"), '') AS phrases_found
FROM documents LEFT JOIN phrases ON contains(text, phrase) GROUP BY doc_id, text""".replace(' COLLATE "C"', ""),
)
def lexicon_large(spark, sf):
    """Passages of the benchmark that occur in documents, from an index of all of them."""
    docs = documents(spark, sf, "doc_id", "text")
    index = phrase_index(many_phrases(spark, sf), docs)
    return with_phrases(docs, "text", index).select("doc_id", F.array_join("phrases_found", "|").alias("phrases_found"))


TERM_CLASS = "CASE item_id % 4 WHEN 0 THEN 'abusive_content' WHEN 1 THEN 'negative_sentiment' WHEN 2 THEN 'quality_risk' END"


@register(
    "taxonomy_large",
    f"""WITH {SCORED}, terms AS (SELECT {TERM_CLASS} AS class, item_id AS position, 's' || item_id AS subcategory, phrase FROM ({PHRASE_ROWS})),
met AS (
  SELECT doc_id, subcategory, row_number() OVER (PARTITION BY doc_id ORDER BY length(phrase) DESC, position, phrase DESC, subcategory DESC) AS r
  FROM scored JOIN terms ON (class IS NULL OR class = predicted_class) AND contains(normalized, phrase))
SELECT s.doc_id, predicted_class AS category, subcategory FROM scored s LEFT JOIN met m ON s.doc_id = m.doc_id AND r = 1""",
)
def taxonomy_large(spark, sf):
    """Subcategories by phrases of the benchmark, from the index."""
    phrases = many_phrases(spark, sf)
    terms = phrases.select(
        F.expr(TERM_CLASS).alias("class"), F.col("item_id").alias("position"),
        F.concat(F.lit("s"), "item_id").alias("subcategory"), F.lit(False).alias("escalate"), "phrase",
    )
    rows = pin(scored(spark, sf).select("doc_id", "predicted_class", "normalized"), "normalized")
    found = with_indexed_taxonomy(rows, terms, "normalized", phrase_index(terms, rows, "normalized"))
    return found.select("doc_id", "category", "subcategory")
