"""Evaluation queries on rule-made predictions, so that they can be exact."""

from __future__ import annotations

from pyspark.sql import functions as F

from kotomori.config import LABELS, RISK, SEVERITY_WEIGHTS
from kotomori.operators import metrics as M
from kotomori.operators.splits import stratified_split
from kotomori.plans.catalogue.base import JUDGED, judged, register, sql_name
from kotomori.plans.catalogue.labels import RANKED

IDS = "(SELECT unnest([0, 1, 2]) AS id)"
CONFUSION = f"""{JUDGED},
confusion AS (SELECT a.id AS y_true, b.id AS y_pred, count(s.doc_id) AS n
  FROM {IDS} a CROSS JOIN {IDS} b LEFT JOIN judged s ON s.y_true = a.id AND s.y_pred = b.id GROUP BY a.id, b.id)"""
BY_CLASS = f"""{CONFUSION},
per_class AS (SELECT id, hit, support, guess,
    CASE WHEN guess = 0 THEN 0 ELSE hit / guess::DOUBLE END AS precision,
    CASE WHEN support = 0 THEN 0 ELSE hit / support::DOUBLE END AS recall,
    CASE WHEN guess + support = 0 THEN 0 ELSE 2 * hit / (guess + support)::DOUBLE END AS f1
  FROM (SELECT id, (SELECT sum(n) FROM confusion WHERE y_true = id AND y_pred = id)::BIGINT AS hit,
    (SELECT sum(n) FROM confusion WHERE y_true = id)::BIGINT AS support,
    (SELECT sum(n) FROM confusion WHERE y_pred = id)::BIGINT AS guess FROM {IDS}))"""


def confusion(spark, sf):
    return M.confusion_counts(judged(spark, sf))


def rounded(df, *names):
    return df.withColumns({n: F.round(n, 6) for n in names})


@register("confusion_counts", f"WITH {CONFUSION} SELECT * FROM confusion")
def confusion_counts(spark, sf):
    return confusion(spark, sf)


@register(
    "confusion_normalised",
    f"""WITH {CONFUSION} SELECT y_true, y_pred, n,
  round(CASE WHEN sum(n) OVER w = 0 THEN NULL ELSE n / (sum(n) OVER w)::DOUBLE END, 6) AS share
FROM confusion WINDOW w AS (PARTITION BY y_true)""",
)
def confusion_normalised(spark, sf):
    return rounded(M.confusion_normalised(confusion(spark, sf)), "share")


MEASURES = ("precision", "recall", "f1")
SQL_ROUNDED = ", ".join(f"round({m}, 6) AS {m}" for m in MEASURES)
SQL_AVG = ", ".join(f"avg({m}) AS {m}" for m in MEASURES)
SQL_WEIGHTED = ", ".join(f"sum({m} * support) / sum(support) AS {m}" for m in MEASURES)
SQL_ACCURACY = ", ".join(f"sum(hit) / sum(support)::DOUBLE AS {m}" for m in MEASURES)


@register(
    "class_report",
    f"""WITH {BY_CLASS} SELECT name, {SQL_ROUNDED}, support::BIGINT AS support FROM (
  SELECT {sql_name('id')} AS name, precision, recall, f1, support FROM per_class
  UNION ALL SELECT 'accuracy', {SQL_ACCURACY}, sum(support) FROM per_class
  UNION ALL SELECT 'macro avg', {SQL_AVG}, sum(support) FROM per_class
  UNION ALL SELECT 'weighted avg', {SQL_WEIGHTED}, sum(support) FROM per_class)""",
)
def class_report(spark, sf):
    return rounded(M.class_report(confusion(spark, sf)), *MEASURES)


SQL_F1 = f"""avg(f1) AS f1_macro, sum(f1 * support) / sum(support) AS f1_weighted,
  sum(hit) / sum(support)::DOUBLE AS accuracy"""
SCALARS = ("f1_macro", "f1_weighted", "accuracy")


@register(
    "f1_scores",
    f"WITH {BY_CLASS}, s AS (SELECT {SQL_F1} FROM per_class) SELECT {', '.join(f'round({x}, 6) AS {x}' for x in SCALARS)} FROM s",
)
def f1_scores(spark, sf):
    return rounded(M.f1_scores(confusion(spark, sf)), *SCALARS)


SQL_WEIGHT = "([" + ", ".join(f"{w}::DOUBLE" for w in SEVERITY_WEIGHTS) + "])[y_true + 1]"
SQL_SEVERITY = f"""(SELECT sum(CASE WHEN y_true = y_pred THEN {SQL_WEIGHT} * n ELSE 0 END) / sum({SQL_WEIGHT} * n)
  FROM confusion)"""


@register(
    "severity_weighted_accuracy",
    f"WITH {CONFUSION} SELECT round({SQL_SEVERITY}, 6) AS severity_weighted_accuracy",
)
def severity_weighted_accuracy(spark, sf):
    return rounded(M.severity_weighted_accuracy(confusion(spark, sf)), "severity_weighted_accuracy")


@register(
    "full_evaluation",
    f"""WITH {BY_CLASS}, s AS (SELECT {SQL_F1}, {SQL_SEVERITY} AS severity_weighted_accuracy FROM per_class)
SELECT {', '.join(f'round({x}, 6) AS {x}' for x in (*SCALARS, 'severity_weighted_accuracy'))} FROM s""",
)
def full_evaluation(spark, sf):
    return rounded(M.evaluation_summary(confusion(spark, sf)), *SCALARS, "severity_weighted_accuracy")


ERRORS = f"""{JUDGED},
errors AS (SELECT doc_id, raw, {sql_name('y_true')} AS true_label, {sql_name('y_pred')} AS predicted_label
  FROM judged WHERE y_true <> y_pred)"""


def errors(spark, sf):
    return M.error_rows(judged(spark, sf), "doc_id", "raw")


@register("error_rows", f"WITH {ERRORS} SELECT * FROM errors")
def error_rows(spark, sf):
    return errors(spark, sf)


@register(
    "error_rate",
    f"""WITH {JUDGED} SELECT count(*) FILTER (y_true <> y_pred) AS n_errors, count(*) AS n_total,
  round(100.0::DOUBLE * count(*) FILTER (y_true <> y_pred) / count(*), 1) AS error_pct FROM judged""",
)
def error_rate(spark, sf):
    return M.error_rate(confusion(spark, sf))


@register(
    "error_sample",
    f"""WITH {ERRORS} SELECT doc_id, substr(raw, 1, 80) || '...' AS text_preview, true_label, predicted_label
FROM errors ORDER BY md5('42|' || doc_id), doc_id LIMIT 10""",
)
def error_sample(spark, sf):
    return M.error_sample(errors(spark, sf), "doc_id", 10, text="raw")


@register(
    "run_summary",
    f"""WITH {BY_CLASS}, {RANKED[RANKED.index('ranked AS'):]},
sizes AS (SELECT count(*) FILTER (r > round(0.2::DOUBLE * n)) AS train_samples,
  count(*) FILTER (r <= round(0.2::DOUBLE * n)) AS test_samples FROM ranked),
s AS (SELECT {SQL_F1}, {SQL_SEVERITY} AS sev FROM per_class)
SELECT train_samples, test_samples, round(f1_macro, 4) AS f1_macro, round(f1_weighted, 4) AS f1_weighted,
  round(sev, 4) AS severity_weighted_accuracy,
  (SELECT round(100.0::DOUBLE * count(*) FILTER (risk > 0.4::DOUBLE) / count(*), 2) FROM judged) AS high_adversarial_risk_pct
FROM s CROSS JOIN sizes""",
)
def run_summary(spark, sf):
    rows = judged(spark, sf)
    split = stratified_split(rows.select("doc_id", F.col("y_true").alias("label_id")), "label_id", "doc_id")
    return M.run_summary(rows, split, M.confusion_counts(rows), RISK.high)


assert len(LABELS) == 3  # the class ids written out in the SQL above
