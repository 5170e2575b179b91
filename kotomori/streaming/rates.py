"""Rates by event time, and submissions that come again.

Both keep state for as long as the watermark allows and no longer: a window's counts until
the watermark passes its end, a key until the watermark passes the horizon behind it. The
same functions run on a finished table, where a watermark has no effect.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from kotomori.config import RISK, RiskWeights


def instant(df: DataFrame, time: str) -> Column:
    """Column ``time`` as a point in time, which watermarks need; one without a time zone is
    read as UTC, whatever the session's zone."""
    if dict(df.dtypes)[time] != "timestamp_ntz":
        return F.col(time).cast("timestamp")
    return F.expr(f"timestamp_micros(timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01', `{time}`))")


def back(column: str, kind: str) -> Column:
    """The inverse of :func:`instant` for a column of type ``kind``."""
    plain = F.expr(f"timestampadd(MICROSECOND, unix_micros({column}), timestamp_ntz'1970-01-01')")
    return plain if kind == "timestamp_ntz" else F.col(column)


def windowed_rates(
    records: DataFrame,
    time: str,
    window: str = "1 hour",
    slide: str | None = None,
    by: tuple[str, ...] = (),
    watermark: str = "10 minutes",
    weights: RiskWeights = RISK,
    risk: str = "risk",
    escalated: str = "escalate_to_human",
) -> DataFrame:
    """``(window_start, window_end, *by, n, n_high, high_pct, n_escalated, escalated_pct)``.

    A stream emits a window once, when the watermark has passed its end, and drops rows that
    come for a window already closed. Counts are combined before the shuffle, so a window or
    a language that holds most of the rows costs one row a task. Rows without a time belong
    to no window.
    """
    n, high, up = F.count(F.lit(1)), F.count_if(F.col(risk) > weights.high), F.count_if(F.col(escalated))
    kind = dict(records.dtypes)[time]
    timed = records.where(F.col(time).isNotNull()).withColumn("_at", instant(records, time)).withWatermark("_at", watermark)
    frame = F.window("_at", window, slide) if slide else F.window("_at", window)
    counted = timed.groupBy(frame.alias("window"), *by).agg(n.alias("n"), high.alias("n_high"), up.alias("n_escalated"))
    share = lambda c: F.round(F.col(c) * F.lit(100.0) / F.col("n"), 2)
    return counted.select(
        back("window.start", kind).alias("window_start"),
        back("window.end", kind).alias("window_end"),
        *by,
        "n",
        "n_high",
        share("n_high").alias("high_pct"),
        "n_escalated",
        share("n_escalated").alias("escalated_pct"),
    )


def late_groups(query: StreamingQuery) -> int:
    """Combined rows that came after their window was closed, as far as the query remembers
    its progress: late rows of one batch, task and group count once."""
    return sum(s.numRowsDroppedByWatermark for p in query.recentProgress for s in p.stateOperators)


def first_submissions(rows: DataFrame, key: str, time: str, horizon: str) -> DataFrame:
    """The first row to arrive for each ``key``; others within ``horizon`` of event time go.

    For a stream, ahead of scoring, so that what is sent again is not scored again. State
    is a key and a time for as long as ``horizon`` behind the watermark.
    """
    timed = rows.withColumn("_at", instant(rows, time)).withWatermark("_at", horizon)
    return timed.dropDuplicatesWithinWatermark([key]).drop("_at")
