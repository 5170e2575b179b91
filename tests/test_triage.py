import itertools
import json

import pytest
from pyspark.sql import functions as F

from kotomori.config import DEFAULT_TIER, LABELS, TIER_RULES
from kotomori.operators import triage as G
from kotomori.sources import policy

GRID = [
    (i, c, r / 10, p / 20)
    for i, (c, r, p) in enumerate(itertools.product(LABELS, range(11), range(21)))
]


def brute_tier(label, risk, conf):
    for tier, c, risk_min, conf_min, conf_max in TIER_RULES:
        if (
            c == label
            and (risk_min is None or risk >= risk_min)
            and (conf_min is None or conf >= conf_min)
            and (conf_max is None or conf <= conf_max)
        ):
            return tier
    return DEFAULT_TIER[LABELS.index(label)]


@pytest.fixture(scope="module")
def grid(spark):
    return spark.createDataFrame(GRID, "id int, predicted_class string, risk double, confidence double")


def write(spark, path, text):
    spark.range(1).select(F.lit(text).alias("value")).coalesce(1).write.text(path)
    return path


def test_simple_tier_is_strict(spark, grid):
    rows = grid.select("*", G.tier_simple(F.col("predicted_class"), F.col("risk")).alias("t")).collect()
    for r in rows:
        critical = r.predicted_class == LABELS[0] and r.risk > 0.4
        assert r.t == ("CRITICAL" if critical else DEFAULT_TIER[LABELS.index(r.predicted_class)])


def test_policy_gives_each_row_one_tier(spark, grid, tmp_path):
    path = write(spark, str(tmp_path / "tiers"), policy.policy_documents()[1])
    for rules in (policy.builtin_tier_policy(spark), policy.scan_tier_policy(spark, path)):
        rows = G.with_policy_tier(grid, rules).collect()
        assert len(rows) == len(GRID)
        assert all(r.policy_tier == brute_tier(r.predicted_class, r.risk, r.confidence) for r in rows)


def test_policy_conditions_as_object_or_list(spark, tmp_path):
    document = {
        "severity_tiers": {
            "A": {"conditions": {"predicted_class": "x", "confidence_min": 0.5}, "action": "look", "sla_minutes": 5},
            "B": {"conditions": [{"predicted_class": "x"}, {"predicted_class": "y"}], "action": "wait", "sla_minutes": 9},
        },
        "review_queue_priority": ["B", "A"],
    }
    path = write(spark, str(tmp_path / "t"), json.dumps(document, indent=2))
    rows = {(r.tier, r.rule_no): r for r in policy.scan_tier_policy(spark, path).collect()}
    assert rows["A", 0].priority == 2 and rows["A", 0].conf_min == 0.5 and rows["A", 0].risk_min is None
    assert rows["B", 1].predicted_class == "y" and rows["B", 1].sla_minutes == 9


def test_taxonomy_document_round_trip(spark, tmp_path):
    path = write(spark, str(tmp_path / "x"), policy.policy_documents()[0])
    columns = ["class", "position", "subcategory", "name", "escalate", "phrase"]
    read = {tuple(r) for r in policy.scan_taxonomy(spark, path).select(*columns).collect()}
    assert read == {tuple(r) for r in policy.builtin_taxonomy(spark).select(*columns).collect()}


def test_taxonomy_takes_the_longest_phrase_of_the_class(spark):
    rows = spark.createDataFrame(
        [(1, LABELS[1], "最悪のサービス"), (2, LABELS[1], "最悪"), (3, LABELS[0], "最悪"), (4, LABELS[0], "バカ 覚えておけ")],
        "id int, predicted_class string, t string",
    )
    got = {r.id: r for r in G.with_taxonomy(rows, policy.builtin_taxonomy(spark), "t").collect()}
    assert got[1].subcategory == "product_complaint" and got[2].subcategory == "frustration"
    assert got[3].subcategory is None and got[3].category == LABELS[0]
    assert got[4].subcategory == "threats" and got[4].subcategory_escalate


def test_auto_rules(spark):
    rows = spark.createDataFrame(
        [
            (1, True, LABELS[0], 0.3, ["x"], 0.9, "HIGH"),
            (2, True, LABELS[2], 0.05, [], 0.95, "LOW"),
            (3, False, LABELS[2], 0.0, ["x"], 0.95, "LOW"),
            (4, False, LABELS[1], 0.6, [], 0.95, "MEDIUM"),
        ],
        "id int, had_homoglyphs boolean, predicted_class string, risk double, abuse_patterns_found array<string>, confidence double, severity_tier string",
    )
    got = {r.id: r for r in G.with_auto_rules(rows).collect()}
    assert got[1].rules_fired == ["homoglyph_abuse", "lexicon_hit"] and got[1].final_tier == "CRITICAL"
    assert got[2].auto_approved and got[2].final_tier == "LOW"
    assert not got[3].auto_approved and got[3].final_tier == "CRITICAL"
    assert got[4].rules_fired == [] and got[4].final_tier == "MEDIUM"


def test_queue_and_rates(spark):
    rows = spark.createDataFrame(
        [(1, "HIGH", 0.1, True), (2, "CRITICAL", 0.5, True), (3, "LOW", 0.9, False), (4, "CRITICAL", 0.9, True)],
        "id int, severity_tier string, risk double, escalate_to_human boolean",
    )
    assert [r.id for r in G.review_queue(rows, "id").collect()] == [4, 2, 1]
    assert [r.id for r in G.review_queue(rows, "id", top=2).collect()] == [4, 2]
    assert G.escalation_rate(rows).first().escalated_pct == 75.0
    assert G.escalation_rate(rows.where("false")).first().escalated_pct is None
    due = G.with_sla(rows.withColumn("at", F.expr("timestamp_ntz'2024-01-01 00:00:00'")), submitted_at="at")
    assert {r.severity_tier: str(r.due_at) for r in due.collect()}["HIGH"] == "2024-01-01 01:00:00"


def test_uncertain_rows(spark):
    rows = spark.createDataFrame([(1, [0.5, 0.3, 0.2]), (2, [0.4, 0.39, 0.21]), (3, [0.1, 0.1, 0.8])], "id int, probabilities array<double>")
    assert [r.id for r in G.uncertain_rows(rows, "id", top=2).collect()] == [2, 1]
