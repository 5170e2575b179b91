"""Reader and writer queries: tables written by Spark and read back."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from kotomori.config import AUTO_CONDITIONS, RISK, TAXONOMY
from kotomori.functions.evasion import SIGNALS as SIGNAL_COLUMNS
from kotomori.operators import metrics as M
from kotomori.operators import triage as G
from kotomori.operators.features import TfidfModel
from kotomori.operators.splits import stratified_split
from kotomori.plans.catalogue.base import JUDGED, ORACLES, SCORED, documents, judged, labelled, quoted, register, scored, sql_name
from kotomori.plans.catalogue.features import SQL_UNION
from kotomori.plans.catalogue.triage import AUTO, SQL_TAXONOMY, SQL_TIER_POLICY, TIERED, records
from kotomori.plans.scoring import documented_records, prediction_records
from kotomori.session import shared_folder
from kotomori.sources import corpus, policy, sinks

RULE_TEXTS = dict(AUTO_CONDITIONS)["auto_escalate_to_critical"]
CORPUS_SQL = f"""SELECT doc_id AS id, text, {sql_name('(CASE WHEN toxic = 1 THEN 0 WHEN quality = 0 THEN 2 ELSE 1 END)')} AS label
FROM documents JOIN labels USING (doc_id)"""


@register("scan_corpus", CORPUS_SQL)
def scan_corpus(spark, sf):
    path = shared_folder(spark, "corpus")
    rows = labelled(spark, sf).select("label", F.lit("x").alias("note"), "text", "id")
    sinks.sink_predictions_csv(rows, path)  # neither the order nor the columns of the schema
    good, _ = corpus.split_corrupt(corpus.scan_corpus(spark, path))
    return good.select("id", "text", "label")


@register("require_columns", CORPUS_SQL)
def require_columns(spark, sf):
    return corpus.require_columns(labelled(spark, sf), "text", "label")


@register("scan_parquet", "SELECT doc_id, text, lang FROM documents")
def scan_parquet(spark, sf):
    return corpus.scan_parquet(spark, f"{sf}/documents.parquet").select("doc_id", "text", "lang")


SQL_FLAGS = ", ".join(f"CASE WHEN {s} THEN '\"{s}\":true' END" for s in SIGNAL_COLUMNS)
RECORDS = f"""WITH {TIERED} SELECT doc_id, substr(raw, 1, 60) || '...' AS text_preview, predicted_class, confidence,
  severity_tier, escalate_to_human, round(risk, 3) AS adversarial_risk_score,
  '{{' || array_to_string(list_filter([{SQL_FLAGS}], lambda x: x IS NOT NULL), ',') || '}}' AS adversarial_flags FROM records"""


def prediction_rows(spark, sf):
    return prediction_records(records(spark, sf), "doc_id", "raw")


@register("sink_predictions_json", RECORDS)
def sink_predictions_json(spark, sf):
    rows, path = prediction_rows(spark, sf), shared_folder(spark, "predictions")
    sinks.sink_predictions_json(rows, path, by_tier=True)
    back = spark.read.schema(rows.schema).json(path).select(*rows.columns)
    return back.withColumn("adversarial_flags", F.to_json("adversarial_flags"))


@register("sink_predictions_csv", RECORDS)
def sink_predictions_csv(spark, sf):
    rows, path = prediction_rows(spark, sf), shared_folder(spark, "predictions")
    sinks.sink_predictions_csv(rows, path)
    schema = rows.withColumn("adversarial_flags", F.to_json("adversarial_flags")).schema
    good, _ = corpus.split_corrupt(corpus.scan_corpus(spark, path, schema))
    return good


@register(
    "sink_errors_csv",
    f"""WITH {JUDGED} SELECT doc_id, raw AS text, {sql_name('y_true')} AS true_label, {sql_name('y_pred')} AS predicted_label
FROM judged WHERE y_true <> y_pred""",
)
def sink_errors_csv(spark, sf):
    rows = M.error_rows(judged(spark, sf), "doc_id", "raw").withColumnRenamed("raw", "text")
    path = shared_folder(spark, "errors")
    sinks.sink_errors_csv(rows, path)
    good, _ = corpus.split_corrupt(corpus.scan_corpus(spark, path, rows.schema))
    return good


@register("sink_summary", ORACLES["run_summary"])
def sink_summary(spark, sf):
    rows = judged(spark, sf)
    split = stratified_split(rows.select("doc_id", F.col("y_true").alias("label_id")), "label_id", "doc_id")
    summary, path = M.run_summary(rows, split, M.confusion_counts(rows), RISK.high), shared_folder(spark, "summary")
    sinks.sink_summary(summary, path)
    return spark.read.schema(summary.schema).json(path)


@register("save_features", SQL_UNION)
def save_features(spark, sf):
    path = shared_folder(spark, "vocabulary")
    TfidfModel.fit(documents(spark, sf, "doc_id", "text"), "text").save(path)
    return TfidfModel.load(spark, path).table.withColumn("idf", F.round("idf", 6))


def _written(spark, name: str, document: str) -> str:
    path = shared_folder(spark, name)
    spark.range(1).select(F.lit(document).alias("value")).coalesce(1).write.text(path)
    return path


@register("scan_taxonomy", SQL_TAXONOMY)
def scan_taxonomy(spark, sf):
    taxonomy = policy.scan_taxonomy(spark, _written(spark, "taxonomy", policy.policy_documents()[0]))
    rows = G.with_taxonomy(scored(spark, sf), taxonomy, "normalized")
    return rows.select("doc_id", "category", "subcategory", "subcategory_escalate")


@register("scan_tier_policy", SQL_TIER_POLICY)
def scan_tier_policy(spark, sf):
    rules = policy.scan_tier_policy(spark, _written(spark, "tiers", policy.policy_documents()[1]))
    rows = G.with_policy_tier(scored(spark, sf), rules)
    return rows.select("doc_id", "predicted_class", "confidence", "policy_tier")


@register(
    "scan_auto_rules",
    f"""WITH {AUTO} SELECT doc_id, len(fired) AS n_fired, array_to_string(list_transform(fired, lambda f: CASE f
  WHEN 'homoglyph_abuse' THEN '{RULE_TEXTS[0]}' WHEN 'high_risk' THEN '{RULE_TEXTS[1]}' ELSE '{RULE_TEXTS[2]}' END), ',') AS rules_fired,
  auto_approved, final_tier FROM auto""",
)
def scan_auto_rules(spark, sf):
    rules = policy.scan_auto_rules(spark, _written(spark, "tiers", policy.policy_documents()[1]))
    rows = G.with_policy_rules(records(spark, sf), rules)
    return rows.select("doc_id", F.size("rules_fired").alias("n_fired"), F.array_join("rules_fired", ",").alias("rules_fired"), "auto_approved", "final_tier")


@register(
    "sink_predictions_counted",
    f"""WITH {TIERED} SELECT count(*) AS n, count(*) FILTER (escalate_to_human) AS n_escalated,
  count(*) FILTER (round(risk, 3) > {RISK.high}::DOUBLE) AS n_high FROM records""",
)
def sink_predictions_counted(spark, sf):
    """Counts of the records from the pass that writes them."""
    path = shared_folder(spark, "predictions")
    seen = sinks.write_counted(prediction_rows(spark, sf), lambda df: sinks.sink_predictions_json(df, path, by_tier=True), **sinks.record_counts(RISK.high))
    return spark.range(1).select(*[F.lit(n).cast("long").alias(name) for name, n in seen.items()])


# ---- a policy that differs from the built-in one in all it says --------------

OWN_TIERS = (("LOW", "drop", 11), ("CRITICAL", "call", 7), ("MEDIUM", "wait", 500), ("HIGH", "look", 90))
OWN_DEFAULTS = {"abusive_content": "LOW", "negative_sentiment": "CRITICAL"}


def _own_policy(spark):
    document = json.loads(policy.policy_documents()[1])
    for tier, action, minutes in OWN_TIERS:
        document["severity_tiers"][tier] |= {"action": action, "sla_minutes": minutes}
    document["review_queue_priority"] = [tier for tier, _, _ in OWN_TIERS]
    return policy.scan_tier_policy(spark, _written(spark, "tiers", json.dumps(document)))


def _own_taxonomy(spark):
    document = json.loads(policy.policy_documents()[0])
    for label, tier in OWN_DEFAULTS.items():
        document["categories"][label]["severity_default"] = tier
    return policy.scan_taxonomy(spark, _written(spark, "taxonomy", json.dumps(document)))


OWN_VALUES = ", ".join(f"({i + 1}, '{t}', '{a}', {m})" for i, (t, a, m) in enumerate(OWN_TIERS))
OWN = f"""WITH {TIERED}, own(queue_rank, tier, action, sla_minutes) AS (VALUES {OWN_VALUES}),
terms AS (SELECT * FROM records LEFT JOIN own ON severity_tier = tier)"""


@register(
    "review_queue_policy",
    f"""{OWN} SELECT doc_id, severity_tier, queue_rank, round(risk, 3) AS risk FROM terms WHERE escalate_to_human""",
)
def review_queue_policy(spark, sf):
    rows = G.review_queue(records(spark, sf), "doc_id", policy=_own_policy(spark))
    return rows.select("doc_id", "severity_tier", "queue_rank", F.round("risk", 3).alias("risk"))


@register("sla_due_policy", f"{OWN} SELECT doc_id, severity_tier, action, sla_minutes FROM terms")
def sla_due_policy(spark, sf):
    return G.with_sla(records(spark, sf), policy=_own_policy(spark)).select("doc_id", "severity_tier", "action", "sla_minutes")


@register(
    "default_severity_policy",
    f"""WITH {SCORED} SELECT doc_id, CASE predicted_class WHEN 'abusive_content' THEN 'LOW'
  WHEN 'negative_sentiment' THEN 'CRITICAL' ELSE 'LOW' END AS severity FROM scored""",
)
def default_severity_policy(spark, sf):
    return G.with_default_severity(scored(spark, sf), _own_taxonomy(spark)).select("doc_id", "severity")


def _named_taxonomy() -> str:
    names = ", ".join(f"({quoted(s)}, {quoted(n)})" for s, n in dict((t[1], t[2]) for t in TAXONOMY).items())
    return f"named(id, name) AS (VALUES {names})"


@register(
    "documented_records",
    f"""WITH {TIERED}, {_named_taxonomy()}, found AS ({SQL_TAXONOMY.replace("WITH " + SCORED + ",", "WITH")})
SELECT r.doc_id, coalesce(name, category) AS category, subcategory, severity_tier, escalate_to_human,
  array_to_string(list_filter([
    CASE WHEN had_fullwidth OR had_homoglyphs OR had_symbol_insertion OR had_elongation THEN 'adversarial_text_detected' END,
    CASE WHEN japanese AND latin THEN 'code_switching' END], lambda x: x IS NOT NULL), ',') AS flags
FROM records r JOIN found f ON f.doc_id = r.doc_id LEFT JOIN named ON id = subcategory""",
)
def documented_records_query(spark, sf):
    """The documented nested record, laid flat."""
    rows = G.with_taxonomy(records(spark, sf), policy.builtin_taxonomy(spark), "normalized")
    flat = documented_records(rows.withColumn("raw", F.col("doc_id")), "raw")
    return flat.select(
        F.col("raw").alias("doc_id"), "taxonomy.category", "taxonomy.subcategory", "severity_tier", "escalate_to_human", F.array_join("taxonomy.flags", ",").alias("flags")
    )
