"""From a scored row to a severity tier, a harm category and a review queue.

Policies are tables. For a row only the rules of its class matter, so a policy is
folded to one row per class holding an ordered array of rules; the equi join that
brings it in never multiplies rows, and picking a rule needs no shuffle.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kotomori.config import DEFAULT_TIER, ESCALATION, LABELS, RISK, TIER_ACTIONS, EscalationRules
from kotomori.session import pin

QUEUE_ORDER = tuple(tier for tier, _, _ in TIER_ACTIONS)


def confidence(probability: Column, prediction: Column) -> Column:
    """Probability of the predicted class (``probability`` is an array)."""
    return F.round(F.get(probability, prediction.cast("int")), 4)


def default_severity(predicted_class: Column) -> Column:
    pairs = [x for c, t in zip(LABELS, DEFAULT_TIER) for x in (F.lit(c), F.lit(t))]
    return F.try_element_at(F.create_map(*pairs), predicted_class)


def tier_simple(predicted_class: Column, risk: Column, high: float = RISK.high) -> Column:
    abusive = predicted_class == LABELS[0]
    return F.when(abusive & (risk > high), F.lit("CRITICAL")).otherwise(default_severity(predicted_class))


def escalate_simple(tier: Column) -> Column:
    return tier.isin("HIGH", "CRITICAL")


def escalation_rate(records: DataFrame) -> DataFrame:
    escalated = F.count_if("escalate_to_human")
    return records.agg(
        F.count(F.lit(1)).alias("n"),
        escalated.alias("n_escalated"),
        F.round(F.try_divide(escalated * F.lit(100.0), F.count(F.lit(1))), 1).alias("escalated_pct"),
    )


def for_each_class(rules: DataFrame, column: str) -> DataFrame:
    """Rules without a class, once for each class; all others as they are."""
    every = F.array(*[F.lit(x) for x in LABELS])
    return rules.withColumn(column, F.explode(F.when(F.col(column).isNull(), every).otherwise(F.array(column))))


def with_policy_tier(scored: DataFrame, rules: DataFrame, out: str = "policy_tier") -> DataFrame:
    """Add the tier of the first rule that holds, else the default of the class.

    ``rules``: ``(priority, rule_no, tier, predicted_class, risk_min, conf_min,
    conf_max)``; a rule without a class holds for every class. Reads ``predicted_class``, ``risk`` and ``confidence``.
    """
    order = F.sort_array(
        F.collect_list(F.struct("priority", "rule_no", "tier", "risk_min", "conf_min", "conf_max"))
    )
    per_class = for_each_class(rules, "predicted_class").groupBy("predicted_class").agg(order.alias("_rules"))

    def holds(rule: Column) -> Column:
        return (
            (rule["risk_min"].isNull() | (F.col("risk") >= rule["risk_min"]))
            & (rule["conf_min"].isNull() | (F.col("confidence") >= rule["conf_min"]))
            & (rule["conf_max"].isNull() | (F.col("confidence") <= rule["conf_max"]))
        )

    # a row per class the policy names; Spark broadcasts it if it is small
    joined = scored.join(per_class, "predicted_class", "left")
    first = F.get(F.filter("_rules", holds), F.lit(0))["tier"]
    return joined.withColumn(
        out, F.coalesce(first, default_severity(F.col("predicted_class")))
    ).drop("_rules")


def auto_escalate(rules: EscalationRules = ESCALATION) -> Column:
    """Names of the escalation rules that fire, in rule order; empty for none."""
    return F.array_compact(
        F.array(
            F.when(F.col("had_homoglyphs") & (F.col("predicted_class") == LABELS[0]), F.lit("homoglyph_abuse")),
            F.when(F.col("risk") > rules.risk_above, F.lit("high_risk")),
            F.when(
                (F.size("abuse_patterns_found") > 0)
                & (F.col("confidence") > rules.lexicon_confidence_above),
                F.lit("lexicon_hit"),
            ),
        )
    )


def auto_approve(rules: EscalationRules = ESCALATION) -> Column:
    return (
        (F.col("predicted_class") == LABELS[2])
        & (F.col("confidence") > rules.approve_confidence_above)
        & (F.col("risk") < rules.approve_risk_below)
    )


def with_auto_rules(scored: DataFrame, tier: str = "severity_tier", rules: EscalationRules = ESCALATION) -> DataFrame:
    """Add ``rules_fired``, ``auto_approved`` and ``final_tier``; escalation wins."""
    fired = scored.withColumn("rules_fired", auto_escalate(rules))
    escalated = F.size("rules_fired") > 0
    return fired.withColumn("auto_approved", auto_approve(rules) & ~escalated).withColumn(
        "final_tier", F.when(escalated, F.lit("CRITICAL")).otherwise(F.col(tier))
    )


def condition_of(text: str) -> Column:
    """A policy's condition as a column: SQL, in which class names need no quotes and the
    risk and the phrases found go by the names that policies give them."""
    named = re.sub(r"==\s*(\w+)", lambda m: f"= '{m[1]}'", text)
    named = re.sub(r"\badversarial_risk_score\b", "risk", named)
    return F.expr(re.sub(r"\babuse_patterns_found\b", "(size(abuse_patterns_found) > 0)", named))


def with_policy_rules(scored: DataFrame, rules: DataFrame, tier: str = "severity_tier") -> DataFrame:
    """As :func:`with_auto_rules`, by the rules of a scanned policy
    (:func:`~kotomori.sources.policy.scan_auto_rules`), which go by their conditions.

    A condition that is NULL for a row does not hold; of no rules none fires.
    """
    listed = rules.orderBy("action", "rule_no").collect()  # the rules of one policy document
    named = {action: [r.condition for r in listed if r.action == action] for action in ("auto_escalate_to_critical", "auto_approve")}
    fires = [F.when(condition_of(c), F.lit(c)) for c in named["auto_escalate_to_critical"]]
    none = F.array().cast("array<string>")
    fired = scored.withColumn("rules_fired", F.array_compact(F.array(*fires)) if fires else none)
    escalated = F.size("rules_fired") > 0
    approves = [F.coalesce(condition_of(c), F.lit(False)) for c in named["auto_approve"]]
    approved = reduce(Column.__or__, approves, F.lit(False))
    return fired.withColumn("auto_approved", approved & ~escalated).withColumn("final_tier", F.when(escalated, F.lit("CRITICAL")).otherwise(F.col(tier)))


def tier_priority(tier: Column) -> Column:
    return F.array_position(F.array(*[F.lit(t) for t in QUEUE_ORDER]), tier)


def tier_table(policy: DataFrame) -> DataFrame:
    """``(_tier, queue_rank, action, sla_minutes)``, a row for each tier of a scanned policy."""
    return policy.groupBy(F.col("tier").alias("_tier")).agg(
        F.min("priority").alias("queue_rank"), F.min("action").alias("action"), F.min("sla_minutes").alias("sla_minutes")
    )


def review_queue(
    records: DataFrame,
    key: str,
    tier: str = "severity_tier",
    risk: str = "risk",
    top: int | None = None,
    policy: DataFrame | None = None,
) -> DataFrame:
    """Escalated rows, most urgent first, in the order of the policy or the built-in one.

    The filter precedes the sort, the sort is a range shuffle, and ``top`` turns it into a
    bounded per-task heap. A tier that the policy does not name comes last. A whole queue
    is written before it is sorted: the sort samples its input first, and the texts would
    be analysed once for the sample and once for the sort.
    """
    urgent = records.where("escalate_to_human")
    if top is None:
        urgent = pin(urgent, "urgent")
    if policy is None:
        ranked = urgent.withColumn("queue_rank", tier_priority(F.col(tier)))
    else:
        ranks = tier_table(policy).select("_tier", "queue_rank")
        ranked = urgent.join(ranks, F.col(tier) == F.col("_tier"), "left").drop("_tier")
    queue = ranked.orderBy(F.asc_nulls_last("queue_rank"), F.desc(risk), key)
    return queue if top is None else queue.limit(top)


def with_sla(
    records: DataFrame, tier: str = "severity_tier", submitted_at: str | None = None, policy: DataFrame | None = None
) -> DataFrame:
    """Add ``action`` and ``sla_minutes``, of the policy or the built-in ones, and, given a
    time of arrival, ``due_at``."""
    if policy is not None:
        terms = tier_table(policy).drop("queue_rank")
        return _with_due(records.join(terms, F.col(tier) == F.col("_tier"), "left").drop("_tier"), submitted_at)
    actions = [x for t, a, _ in TIER_ACTIONS for x in (F.lit(t), F.lit(a))]
    minutes = [x for t, _, m in TIER_ACTIONS for x in (F.lit(t), F.lit(m))]
    out = records.withColumns(
        {
            "action": F.try_element_at(F.create_map(*actions), F.col(tier)),
            "sla_minutes": F.try_element_at(F.create_map(*minutes), F.col(tier)),
        }
    )
    return _with_due(out, submitted_at)


def _with_due(out: DataFrame, submitted_at: str | None) -> DataFrame:
    if submitted_at is None:
        return out
    wait = F.make_dt_interval(F.lit(0), F.lit(0), F.col("sla_minutes"), F.lit(0))
    return out.withColumn("due_at", F.col(submitted_at) + wait)


def with_default_severity(scored: DataFrame, taxonomy: DataFrame, out: str = "severity") -> DataFrame:
    """Add the default tier that the taxonomy gives to the class; the built-in one else."""
    given = taxonomy.groupBy(F.col("class").alias("_class")).agg(F.min("severity_default").alias("_default"))
    joined = scored.join(given, F.col("predicted_class") == F.col("_class"), "left")
    return joined.withColumn(out, F.coalesce("_default", default_severity(F.col("predicted_class")))).drop("_class", "_default")


def with_taxonomy(scored: DataFrame, taxonomy: DataFrame, text: str) -> DataFrame:
    """Add ``category``, ``subcategory``, ``subcategory_name``, ``subcategory_escalate``.

    ``taxonomy``: ``(class, position, subcategory, name, escalate, phrase)``, ``name`` if
    there is one; a phrase without a class holds for every class. The longest
    example phrase contained in the text decides, then the taxonomy's order.
    """
    name = F.col("name") if "name" in taxonomy.columns else F.lit(None).cast("string")
    entry = F.struct(
        F.char_length("phrase").alias("len"), (-F.col("position")).alias("rank"), "phrase", "subcategory", "escalate", name.alias("name")
    )
    per_class = (
        for_each_class(taxonomy, "class")
        .groupBy(F.col("class").alias("predicted_class"))
        .agg(F.collect_list(entry).alias("_phrases"))
    )
    # a row per class the taxonomy names; Spark broadcasts it if it is small
    joined = scored.join(per_class, "predicted_class", "left")
    best = F.array_max(F.filter("_phrases", lambda p: F.contains(F.col(text), p["phrase"])))
    return (
        joined.withColumn("_best", best)
        .withColumns(
            {
                "category": F.col("predicted_class"),
                "subcategory": F.col("_best.subcategory"),
                "subcategory_name": F.col("_best.name"),
                "subcategory_escalate": F.col("_best.escalate"),
            }
        )
        .drop("_best", "_phrases")
    )


def uncertain_rows(scored: DataFrame, key: str, probability: str = "probabilities", top: int = 100) -> DataFrame:
    """The rows with the smallest margin between their two likeliest classes."""
    ranked = F.sort_array(F.col(probability), asc=False)
    margin = F.get(ranked, F.lit(0)) - F.get(ranked, F.lit(1))
    return scored.withColumn("margin", margin).orderBy("margin", key).limit(top)


def uncertain_by_class(scored: DataFrame, key: str, probability: str = "probabilities", top: int = 100) -> DataFrame:
    """The ``top`` rows of each predicted class with the smallest margin, and their ``rank``.

    The rank is limited in the order of a window, which Spark applies in every task before
    the shuffle: a task keeps and sends at most ``top`` rows a class, however many rows the
    class has.
    """
    ranked = F.sort_array(F.col(probability), asc=False)
    rows = scored.withColumn("margin", F.get(ranked, F.lit(0)) - F.get(ranked, F.lit(1)))
    order = Window.partitionBy("predicted_class").orderBy("margin", key)
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
