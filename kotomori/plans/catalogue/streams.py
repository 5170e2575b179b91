"""Stateful streams over the given events: each event is a submission of a document.

Events arrive in four files, in order of their number but for every fiftieth, which comes
with the last file, too late for windows closed by then.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from kotomori.operators.triage import with_sla
from kotomori.plans.catalogue.base import register, table
from kotomori.plans.catalogue.triage import TIERED, _sql_by_tier, records
from kotomori.session import pin, shared_folder
from kotomori.streaming.rates import first_submissions, windowed_rates
from kotomori.streaming.scoring import read_stream, write_stream
from kotomori.streaming.targets import breaches, target_events, use_timers

FILES, LATE = 4, 50
SLICED = f"""sliced AS (
  SELECT *, CASE WHEN event_id % {LATE} = 0 THEN {FILES - 1} ELSE event_id * {FILES} // (max(event_id) OVER () + 1) END AS slice,
    event_id % (SELECT count(*) FROM documents) AS doc_id
  FROM events)"""


def sliced(spark, sf):
    events = table(spark, sf, "events")
    n, docs = events.agg(F.max("event_id") + 1).first()[0] or 1, table(spark, sf, "documents").count() or 1
    late = F.when(F.col("event_id") % LATE == 0, FILES - 1)
    return events.select(
        "event_id", "ts", (F.col("event_id") % docs).alias("doc_id"), late.otherwise(F.floor(F.col("event_id") * FILES / n)).alias("slice")
    )


def arriving(spark, df, name):
    """``df`` as a stream of one file a slice, in their order."""
    folder, df = shared_folder(spark, name), pin(df, f"{name}-rows")
    for i in range(FILES):
        df.where(F.col("slice") == i).drop("slice").coalesce(1).write.mode("append").parquet(folder)
    return read_stream(spark, folder, df.drop("slice").schema, files_per_trigger=1)


def written(spark, stream, name):
    """What the stream has written when all its input is read."""
    path, checkpoint = shared_folder(spark, name), shared_folder(spark, f"{name}-state")
    write_stream(stream, path, checkpoint, available_now=True).awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def judged_documents(spark, sf):
    rows = records(spark, sf).select("doc_id", "lang", "risk", "escalate_to_human", "severity_tier")
    return pin(with_sla(rows), "judged-documents")


def _sql_rates(closed: str) -> str:
    # A batch closes windows by the times of the batches before it, and the next one drops
    # what comes for those: the mark of a file is that of the last but one before it.
    share = lambda c: f"round(100.0::DOUBLE * count(*) FILTER ({c}) / count(*), 2)"
    return f"""WITH {TIERED}, {SLICED},
marks AS (SELECT slice, max(max(ts)) OVER (ORDER BY slice ROWS BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING) - INTERVAL 2 HOUR AS mark FROM sliced GROUP BY slice),
framed AS (
  SELECT time_bucket(INTERVAL 6 HOUR, e.ts) AS window_start, time_bucket(INTERVAL 6 HOUR, e.ts) + INTERVAL 6 HOUR AS window_end,
    r.lang, r.risk, r.escalate_to_human, m.mark
  FROM sliced e JOIN records r USING (doc_id) JOIN marks m USING (slice))
SELECT window_start, window_end, lang, count(*) AS n, count(*) FILTER (risk > 0.4::DOUBLE) AS n_high, {share("risk > 0.4::DOUBLE")} AS high_pct,
  count(*) FILTER (escalate_to_human) AS n_escalated, {share("escalate_to_human")} AS escalated_pct
FROM framed {closed} GROUP BY ALL"""


@register("windowed_rates", _sql_rates(""))
def windowed_rates_query(spark, sf):
    """High-risk and escalation rate by language in windows of six hours, of all events."""
    rows = sliced(spark, sf).join(judged_documents(spark, sf), "doc_id")
    return windowed_rates(rows, "ts", "6 hours", by=("lang",), watermark="2 hours")


@register(
    "stream_rates",
    _sql_rates("WHERE (mark IS NULL OR window_end > mark) AND window_end <= (SELECT max(ts) - INTERVAL 2 HOUR FROM sliced)"),
)
def stream_rates(spark, sf):
    """The same from the stream: closed windows, without the rows that came too late."""
    rows = arriving(spark, sliced(spark, sf), "events").join(judged_documents(spark, sf), "doc_id")
    return written(spark, windowed_rates(rows, "ts", "6 hours", by=("lang",), watermark="2 hours"), "rates")


#: Every second event resolves the submission of the event this many before it.
BEHIND = 41


def targets(spark, sf, events):
    """Submissions (even events) with their due times, and resolutions (odd events)."""
    due = F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.col("sla_minutes"), F.lit(0))
    sent = events.where("event_id % 2 = 0").join(judged_documents(spark, sf), "doc_id").withColumn("due_at", due)
    solved = events.where("event_id % 2 = 1").withColumn("event_id", F.col("event_id") - BEHIND)
    return target_events(sent, solved, "event_id", "ts", "due_at", "ts")


@register(
    "stream_breaches",
    f"""WITH {TIERED},
sent AS (
  SELECT event_id, ts + to_minutes({_sql_by_tier(2)}) AS due_at FROM events e JOIN records r ON r.doc_id = e.event_id % (SELECT count(*) FROM documents)
  WHERE event_id % 2 = 0),
solved AS (SELECT event_id - {BEHIND} AS event_id, ts FROM events WHERE event_id % 2 = 1)
SELECT event_id, epoch_us(due_at) // 1000 AS due_ms FROM sent LEFT JOIN solved USING (event_id)
WHERE (ts IS NULL OR epoch_us(ts) // 1000 > epoch_us(due_at) // 1000) AND epoch_us(due_at) // 1000 <= epoch_us((SELECT max(ts) - INTERVAL 10 MINUTE FROM events)) // 1000""",
)
def stream_breaches(spark, sf):
    """Submissions whose target passed unresolved, from a stream in four files."""
    n = table(spark, sf, "events").agg(F.max("event_id") + 1).first()[0] or 1
    events = sliced(spark, sf).withColumn("slice", F.floor(F.col("event_id") * FILES / n))  # in order, nothing late
    use_timers(spark)
    stream = targets(spark, sf, arriving(spark, events, "events"))
    return written(spark, breaches(stream, "10 minutes"), "breaches").withColumnRenamed("key", "event_id")


@register("stream_resubmissions", f"WITH {TIERED}, {SLICED} SELECT DISTINCT doc_id, severity_tier FROM sliced JOIN records USING (doc_id)")
def stream_resubmissions(spark, sf):
    """One record for each document, however often it is submitted within the horizon."""
    once = first_submissions(arriving(spark, sliced(spark, sf), "events"), "doc_id", "ts", "60 days")
    return written(spark, once.join(judged_documents(spark, sf), "doc_id").select("doc_id", "severity_tier"), "first")
