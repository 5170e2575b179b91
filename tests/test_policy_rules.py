"""Automatic rules from a policy file, and counts from the pass that writes."""

import json

from pyspark.sql import functions as F

from kotomori.operators.cleaning import clean_corpus_counted, drop_report
from kotomori.operators.triage import with_auto_rules, with_policy_rules
from kotomori.sources.policy import policy_documents, scan_auto_rules
from kotomori.sources.sinks import record_counts, sink_predictions_json, write_counted

SCHEMA = "had_homoglyphs boolean, predicted_class string, risk double, confidence double, abuse_patterns_found array<string>, severity_tier string"
ROWS = [
    (h, c, r, p, found, "LOW")
    for h in (True, False, None)
    for c in ("abusive_content", "quality_risk", None)
    for r in (0.05, 0.6, 0.61, None)
    for p in (0.8, 0.95, None)
    for found in ([], ["x"])
]
OUT = ("rules_fired", "auto_approved", "final_tier")


def written(tmp_path, document):
    path = tmp_path / "policy.json"
    path.write_text(json.dumps(document))
    return str(path)


def test_the_built_in_rules_read_from_a_file(spark, tmp_path):
    rules = scan_auto_rules(spark, written(tmp_path, json.loads(policy_documents()[1])))
    rows = spark.createDataFrame(ROWS, SCHEMA)
    names = dict(zip([r.condition for r in rules.where("action like '%escalate%'").orderBy("rule_no").collect()], ("homoglyph_abuse", "high_risk", "lexicon_hit")))
    got = [([names[f] for f in r.rules_fired], bool(r.auto_approved), r.final_tier) for r in with_policy_rules(rows, rules).collect()]
    want = [(r.rules_fired, bool(r.auto_approved), r.final_tier) for r in with_auto_rules(rows).collect()]
    assert got == want and len({len(f) for f, _, _ in got}) == 4


def test_other_rules(spark, tmp_path):
    rows = spark.createDataFrame(ROWS, SCHEMA)
    own = {"auto_escalate_to_critical": ["confidence >= 0.95 AND predicted_class == quality_risk"], "auto_approve": ["risk < 0.1", "had_homoglyphs"]}
    rules = scan_auto_rules(spark, written(tmp_path, {"escalation_rules": own}))
    for r in with_policy_rules(rows, rules).collect():
        fires = r.predicted_class == "quality_risk" and r.confidence == 0.95
        approved = bool((r.risk is not None and r.risk < 0.1) or r.had_homoglyphs)
        assert tuple(r[c] for c in OUT) == (own["auto_escalate_to_critical"] * fires, approved and not fires, "CRITICAL" if fires else "LOW")
    nothing = scan_auto_rules(spark, written(tmp_path, {"severity_tiers": {}}))
    assert with_policy_rules(rows, nothing).where("size(rules_fired) > 0 OR auto_approved OR final_tier <> 'LOW'").count() == 0


def test_counts_of_a_write(spark, tmp_path):
    records = spark.range(1000).select(
        "id",
        (F.col("id") % 7 == 0).alias("escalate_to_human"),
        (F.col("id") / 1000).alias("adversarial_risk_score"),
        F.when(F.col("id") % 2 == 0, "LOW").otherwise("HIGH").alias("severity_tier"),
    )
    path = str(tmp_path / "records")
    seen = write_counted(records, lambda df: sink_predictions_json(df, path, by_tier=True), **record_counts(0.6))
    assert seen == records.agg(*[c.alias(n) for n, c in record_counts(0.6).items()]).first().asDict()
    assert spark.read.json(path).count() == seen["n"] == 1000
    none = write_counted(records.where("id < 0"), lambda df: df.write.parquet(str(tmp_path / "none")), **record_counts(0.6))
    assert none == {"n": 0, "n_escalated": 0, "n_high": 0}


def test_drops_counted_in_one_scan(spark, sf, tmp_path):
    turns = spark.read.parquet(f"{sf}/conversations.parquet").select(F.when(F.col("turn") % 3 > 0, F.col("text")).alias("text"))
    kept, seen = clean_corpus_counted(turns)
    assert kept._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    kept.write.parquet(str(tmp_path / "kept"))
    assert seen.get == drop_report(turns).first().asDict()
    assert spark.read.parquet(str(tmp_path / "kept")).count() == seen.get["n_kept"] < seen.get["n_total"]
