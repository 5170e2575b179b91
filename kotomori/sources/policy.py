"""Policy tables: read from JSON documents, or the built-in ones."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kotomori.config import AUTO_CONDITIONS, LABELS, TAXONOMY, TIER_ACTIONS, TIER_RULES
from kotomori.operators.triage import QUEUE_ORDER, default_severity

_CATEGORY = (
    "struct<label_id:int,description:string,severity_default:string,subcategories:array<struct<"
    "id:string,name:string,description:string,examples_ja:array<string>,escalate:boolean>>>"
)
_CONDITION = (
    "struct<predicted_class:string,adversarial_risk_score_min:double,"
    "confidence_min:double,confidence_max:double>"
)
_TIER = "struct<description:string,conditions:string,action:string,sla_minutes:int>"


def _document(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).json(path)


def scan_taxonomy(spark: SparkSession, path: str) -> DataFrame:
    """``(class, label_id, severity_default, position, subcategory, name, escalate, phrase)``."""
    categories = _document(spark, path, f"categories map<string,{_CATEGORY}>").select(
        F.explode("categories").alias("class", "c")
    )
    subcategories = categories.select(
        "class", "c.label_id", "c.severity_default", F.posexplode("c.subcategories").alias("position", "s")
    )
    return subcategories.select(
        "class",
        "label_id",
        "severity_default",
        "position",
        F.col("s.id").alias("subcategory"),
        "s.name",
        "s.escalate",
        F.explode_outer("s.examples_ja").alias("phrase"),
    )


def scan_tier_policy(spark: SparkSession, path: str) -> DataFrame:
    """``(priority, rule_no, tier, predicted_class, risk_min, conf_min, conf_max,
    action, sla_minutes)``.

    ``conditions`` may be one object or a list, so it is read as text, wrapped
    where needed and parsed as a list.
    """
    schema = f"severity_tiers map<string,{_TIER}>, review_queue_priority array<string>"
    tiers = _document(spark, path, schema).select(
        "review_queue_priority", F.explode("severity_tiers").alias("tier", "t")
    )
    listed = F.when(F.col("t.conditions").startswith("["), F.col("t.conditions")).otherwise(
        F.concat(F.lit("["), F.col("t.conditions"), F.lit("]"))
    )
    rules = tiers.select(
        F.array_position("review_queue_priority", F.col("tier")).cast("int").alias("priority"),
        "tier",
        F.col("t.action").alias("action"),
        F.col("t.sla_minutes").alias("sla_minutes"),
        F.posexplode(F.from_json(listed, f"array<{_CONDITION}>")).alias("rule_no", "r"),
    )
    return rules.select(
        "priority",
        "rule_no",
        "tier",
        "r.predicted_class",
        F.col("r.adversarial_risk_score_min").alias("risk_min"),
        F.col("r.confidence_min").alias("conf_min"),
        F.col("r.confidence_max").alias("conf_max"),
        "action",
        "sla_minutes",
    )


def scan_auto_rules(spark: SparkSession, path: str) -> DataFrame:
    """``(action, rule_no, condition)`` of the policy's automatic rules, a row for each; a policy
    without such rules gives no rows."""
    schema = "escalation_rules map<string,array<string>>"
    actions = _document(spark, path, schema).select(F.explode("escalation_rules").alias("action", "conditions"))
    return actions.select("action", F.posexplode("conditions").alias("rule_no", "condition")).where("condition IS NOT NULL")


def _literal_rows(spark: SparkSession, rows: list[dict[str, Column]]) -> DataFrame:
    cells = [F.struct(*[c.alias(n) for n, c in row.items()]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*cells)))


def builtin_tier_policy(spark: SparkSession) -> DataFrame:
    rows, seen = [], {}
    for tier, label, risk_min, conf_min, conf_max in TIER_RULES:
        seen[tier] = seen.get(tier, -1) + 1
        rows.append(
            {
                "priority": F.lit(QUEUE_ORDER.index(tier) + 1),
                "rule_no": F.lit(seen[tier]),
                "tier": F.lit(tier),
                "predicted_class": F.lit(label),
                "risk_min": F.lit(risk_min).cast("double"),
                "conf_min": F.lit(conf_min).cast("double"),
                "conf_max": F.lit(conf_max).cast("double"),
            }
        )
    return _literal_rows(spark, rows)


def builtin_taxonomy(spark: SparkSession) -> DataFrame:
    rows, seen = [], {}
    for label, subcategory, name, escalate, phrases in TAXONOMY:
        seen[label] = seen.get(label, -1) + 1
        rows.extend(
            {
                "class": F.lit(label),
                "position": F.lit(seen[label]),
                "subcategory": F.lit(subcategory),
                "name": F.lit(name),
                "escalate": F.lit(escalate),
                "phrase": F.lit(phrase),
            }
            for phrase in phrases
        )
    return _literal_rows(spark, rows).withColumn("severity_default", default_severity(F.col("class")))


def policy_documents() -> tuple[str, str]:
    """The built-in taxonomy and tier policy as JSON text, as the readers expect it."""
    categories: dict = {}
    for label, subcategory, name, escalate, phrases in TAXONOMY:
        entry = categories.setdefault(label, {"label_id": LABELS.index(label), "subcategories": []})
        entry["subcategories"].append(
            {"id": subcategory, "name": name, "examples_ja": list(phrases), "escalate": escalate}
        )
    tiers: dict = {}
    names = ("predicted_class", "adversarial_risk_score_min", "confidence_min", "confidence_max")
    for tier, *condition in TIER_RULES:
        found = {n: v for n, v in zip(names, condition) if v is not None}
        tiers.setdefault(tier, []).append(found)
    documents = {
        "severity_tiers": {
            tier: {
                "conditions": tiers[tier][0] if len(tiers[tier]) == 1 else tiers[tier],
                "action": action,
                "sla_minutes": minutes,
            }
            for tier, action, minutes in TIER_ACTIONS
        },
        "escalation_rules": {action: list(conditions) for action, conditions in AUTO_CONDITIONS},
        "review_queue_priority": list(QUEUE_ORDER),
    }
    return (
        json.dumps({"categories": categories}, ensure_ascii=False, indent=1),
        json.dumps(documents, ensure_ascii=False, indent=1),
    )
