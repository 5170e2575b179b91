"""Tier policies of very many rules.

A rule covers a rectangle of risk and confidence. Each side is cut into the fewest dyadic
intervals, and a point lies in one interval of each level, so rules and points meet by an
equi join on (class, interval of risk, interval of confidence): a rule makes at most a few
hundred rows and a point as many as there are pairs of levels, whatever the number of rules.
Where an interval lies between the bounds as a whole, only the first rule of all is kept; in
the cells of the bounds the bounds themselves are compared in the joined rows.

Points are the distinct (class, risk, confidence) of the rows: a hot class, or a risk that
most rows have, is looked up once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kotomori.operators.triage import default_severity, for_each_class
from kotomori.session import pin

#: Levels below the whole interval: 2^DEPTH cells a side.
DEPTH = 6
#: Levels of the index of a policy: its narrow rules lie in few cells.
FINE = 10


def cell(x: Column, depth: int = DEPTH) -> Column:
    """The cell of a number on a side of 2^depth cells from 0 to 1; the first and the last
    one take what lies beyond."""
    within = F.least(F.greatest(F.floor(x * (1 << depth)), F.lit(0)), F.lit((1 << depth) - 1)).cast("int")
    return F.when(x.isNotNull(), within)


def intervals_of(x: Column, depth: int = DEPTH) -> Column:
    """The dyadic intervals that hold a point, numbered like the nodes of a heap: 1 is the
    whole side, 2n and 2n + 1 are the halves of n."""
    leaf = cell(x, depth) + (1 << depth)
    return F.array(*[F.shiftright(leaf, k).cast("int") for k in range(depth + 1)])


def intervals_between(low: Column, high: Column, depth: int = DEPTH) -> Column:
    """The fewest dyadic intervals that cover the cells from ``low`` to ``high``; none if they
    are the wrong way round. A missing bound is the end of the side."""
    a = F.coalesce(cell(low, depth), F.lit(0)) + (1 << depth)
    b = F.coalesce(cell(high, depth), F.lit((1 << depth) - 1)) + (1 << depth) + 1
    taken = []
    for _ in range(depth + 1):
        open_ = a < b
        taken.append(F.when(open_ & (a % 2 == 1), a))
        taken.append(F.when(open_ & (b % 2 == 1) & ((b - 1) >= (a + a % 2)), b - 1))
        a, b = F.floor((a + 1) / 2).cast("int"), F.floor(b / 2).cast("int")
    return F.array_compact(F.array(*[t.cast("int") for t in taken]))


def within(low: Column, high: Column, node: Column, depth: int = DEPTH) -> Column:
    """Does an interval lie between the bounds with all its points? Only the cells of the bounds
    themselves, and the ends of the side, which take what lies beyond, may hold others."""
    # a node at level d covers the cells from (node << (depth - d)) on, 2^(depth - d) of them
    level = F.floor(F.log2(node.cast("double"))).cast("int")
    span = F.pow(F.lit(2.0), F.lit(depth) - level)
    start = node * span - (1 << depth)
    above = low.isNull() | (start > cell(low, depth))
    below = high.isNull() | (start + span - 1 < cell(high, depth))
    return F.coalesce(above & below, F.lit(False))


def pinned_cells(rules: DataFrame, depth: int = FINE) -> DataFrame:
    """``(_class, _risk_cell, _conf_cell, _rule, bounds)``: rules under their cells, as a table.

    A bound that holds for a whole cell is dropped there, and of rules that then ask for the
    same in a cell the first is kept. So a cell keeps no more rules than different bounds lie
    in it, however many rules cover it.
    """
    none = F.lit(None).cast("double")
    filed = for_each_class(rules, "predicted_class").select(
        F.col("predicted_class").alias("_class"), "_rule", "risk_min", "conf_min", "conf_max",
        F.explode(intervals_between(F.col("risk_min"), none, depth)).alias("_risk_cell"),
    ).withColumn("_conf_cell", F.explode(intervals_between(F.col("conf_min"), F.col("conf_max"), depth)))
    risk_in = within(F.col("risk_min"), none, F.col("_risk_cell"), depth)
    low_in, high_in = within(F.col("conf_min"), none, F.col("_conf_cell"), depth), within(none, F.col("conf_max"), F.col("_conf_cell"), depth)
    asked = filed.select(
        "_class", "_risk_cell", "_conf_cell", "_rule",
        F.when(~risk_in, F.col("risk_min")).alias("risk_min"),
        F.when(~low_in, F.col("conf_min")).alias("conf_min"),
        F.when(~high_in, F.col("conf_max")).alias("conf_max"),
    )
    kept = asked.groupBy("_class", "_risk_cell", "_conf_cell", "risk_min", "conf_min", "conf_max").agg(F.min("_rule").alias("_rule"))
    return pin(kept, "policy-cells")


def with_indexed_policy_tier(scored: DataFrame, rules: DataFrame, out: str = "policy_tier") -> DataFrame:
    """As :func:`~kotomori.operators.triage.with_policy_tier`, for any number of rules: the tier
    of the first rule that holds by ``(priority, rule_no, tier)``, else the default of the class.

    A bound that is missing holds always; a missing risk or confidence fails every bound on it.
    """
    bounds = "predicted_class", "risk_min", "conf_min", "conf_max"
    # of rules with the same bounds only the first can decide
    firsts = rules.groupBy(*bounds).agg(F.min(F.struct("priority", "rule_no", "tier")).alias("_rule"))
    inner = pinned_cells(firsts, FINE)
    points = scored.select("predicted_class", "risk", "confidence").distinct()
    # a missing number lies in the whole side alone, where rules without bounds on it are filed
    at = lambda c: F.when(F.col(c).isNull(), F.array(F.lit(1))).otherwise(intervals_of(F.col(c), FINE))
    placed = points.withColumn("_risk_cell", F.explode(at("risk"))).withColumn("_conf_cell", F.explode(at("confidence")))
    holds = (
        (F.col("risk_min").isNull() | (F.col("risk") >= F.col("risk_min")))
        & (F.col("conf_min").isNull() | (F.col("confidence") >= F.col("conf_min")))
        & (F.col("conf_max").isNull() | (F.col("confidence") <= F.col("conf_max")))
    )
    met = placed.join(inner, (F.col("predicted_class") == F.col("_class")) & (placed["_risk_cell"] == inner["_risk_cell"]) & (placed["_conf_cell"] == inner["_conf_cell"]))
    first = met.where(holds).groupBy("predicted_class", "risk", "confidence").agg(F.min("_rule").alias("_first"))
    first = first.select(F.col("predicted_class").alias("_class"), F.col("risk").alias("_r"), F.col("confidence").alias("_c"), "_first")
    same = F.col("predicted_class").eqNullSafe(F.col("_class")) & F.col("risk").eqNullSafe(F.col("_r")) & F.col("confidence").eqNullSafe(F.col("_c"))
    joined = scored.join(first, same, "left")
    return joined.withColumn(out, F.coalesce("_first.tier", default_severity(F.col("predicted_class")))).drop("_class", "_r", "_c", "_first")
