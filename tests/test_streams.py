"""Stateful streams: late rows, restarts, timers."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from kotomori.plans.catalogue import QUERIES
from kotomori.streaming.rates import first_submissions, late_groups, windowed_rates
from kotomori.streaming.scoring import read_stream, write_stream
from kotomori.streaming.targets import breaches, breaches_so_far, target_events, use_timers


def minute(m):
    return dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m)


RECORDS = "id long, ts timestamp_ntz, risk double, escalate_to_human boolean"


def add(spark, folder, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)


def run(spark, stream, base):
    query = write_stream(stream, f"{base}/out", f"{base}/state", available_now=True)
    query.awaitTermination()
    return query, spark.read.schema(stream.schema).parquet(f"{base}/out")


def record(i, m):
    return (i, minute(m), 0.5 if i % 3 == 0 else 0.1, i % 2 == 0)


def rates(spark, folder):
    rows = read_stream(spark, folder, spark.createDataFrame([], RECORDS).schema, files_per_trigger=1)
    return windowed_rates(rows, "ts", "10 minutes", watermark="5 minutes")


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    folder, base = str(tmp_path / "in"), str(tmp_path)
    first, second = [record(i, i) for i in range(40)], [record(i, i) for i in range(40, 60)]
    late = [record(100, 3), record(101, 12)]  # of two windows closed by the time of the first file
    for part in (first, second, [*late, record(60, 70)]):
        add(spark, folder, part, RECORDS)
    query, out = run(spark, rates(spark, folder), base)
    want = windowed_rates(spark.createDataFrame(first + second, RECORDS), "ts", "10 minutes")
    assert sorted(out.collect()) == sorted(want.collect())  # the window from 70 is open
    assert late_groups(query) == 2


def test_a_restart_changes_nothing(spark, tmp_path):
    parts = [[record(i, i) for i in range(k, k + 25)] for k in range(0, 100, 25)]
    whole, halves = str(tmp_path / "whole"), str(tmp_path / "halves")
    for part in parts:
        add(spark, f"{whole}/in", part, RECORDS)
    _, at_once = run(spark, rates(spark, f"{whole}/in"), whole)
    for part in parts[:2]:
        add(spark, f"{halves}/in", part, RECORDS)
    run(spark, rates(spark, f"{halves}/in"), halves)
    for part in parts[2:]:
        add(spark, f"{halves}/in", part, RECORDS)
    run(spark, rates(spark, f"{halves}/in"), halves)
    _, again = run(spark, rates(spark, f"{halves}/in"), halves)
    assert at_once.count() > 0 and sorted(at_once.collect()) == sorted(again.collect())


def test_rates_of_a_table(spark):
    rows = [record(i, i) for i in range(7)] + [(8, None, 0.9, True), (9, minute(3), None, None)]
    got = windowed_rates(spark.createDataFrame(rows, RECORDS), "ts", "5 minutes").orderBy("window_start").collect()
    assert [tuple(r)[:2] for r in got] == [(minute(0), minute(5)), (minute(5), minute(10))]
    assert [tuple(r)[2:] for r in got] == [(6, 2, 33.33, 3, 50.0), (2, 1, 50.0, 1, 50.0)]
    slid = windowed_rates(spark.createDataFrame(rows, RECORDS), "ts", "5 minutes", slide="1 minute")
    assert slid.agg(F.sum("n")).first()[0] == 5 * 8


def test_windows_do_not_depend_on_the_session_zone(spark):
    rows, kept = spark.createDataFrame([record(i, 100 * i) for i in range(30)], RECORDS), spark.conf.get("spark.sql.session.timeZone")
    want = windowed_rates(rows, "ts", "6 hours").collect()
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        assert sorted(windowed_rates(rows, "ts", "6 hours").collect()) == sorted(want)
    finally:
        spark.conf.set("spark.sql.session.timeZone", kept)


def test_one_row_for_each_key_within_the_horizon(spark, tmp_path):
    folder, base = str(tmp_path / "in"), str(tmp_path)
    add(spark, folder, [record(1, 0), record(2, 1), record(1, 2)], RECORDS)
    add(spark, folder, [record(2, 5), record(3, 6)], RECORDS)
    add(spark, folder, [record(9, 300)], RECORDS)
    add(spark, folder, [record(8, 310)], RECORDS)  # keys go at the end of a batch
    add(spark, folder, [record(1, 311)], RECORDS)  # long after: a new submission
    rows = read_stream(spark, folder, spark.createDataFrame([], RECORDS).schema, files_per_trigger=1)
    _, out = run(spark, first_submissions(rows, "id", "ts", "30 minutes"), base)
    assert sorted(r.id for r in out.collect()) == [1, 1, 2, 3, 8, 9]


SUBMITTED, RESOLVED = "id long, submitted_at timestamp_ntz, due_at timestamp_ntz", "id long, resolved_at timestamp_ntz"


@pytest.mark.parametrize("seed", [1, 2])
def test_breaches_equal_the_join_of_finished_tables(spark, tmp_path, seed):
    rng, folder = random.Random(seed), str(tmp_path / "in")
    sent = [(i, minute(i), minute(i + rng.choice([5, 20, 60]))) for i in range(120)] + [(None, minute(3), minute(4)), (200, minute(1), None)]
    solved = [(i, minute(i + rng.choice([0, 3, 19, 20, 21, 70]))) for i in range(120) if rng.random() < 0.7] + [(500, minute(4))]
    both = target_events(spark.createDataFrame(sent, SUBMITTED), spark.createDataFrame(solved, RESOLVED), "id")
    start = int(minute(0).replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
    for a, b in ((-1, 40), (40, 80), (80, 10**6)):
        part = both.where((F.col("at_ms") >= start + a * 60_000) & (F.col("at_ms") < start + b * 60_000))
        part.coalesce(1).write.mode("append").parquet(folder)
    kept = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    try:
        use_timers(spark)
        _, out = run(spark, breaches(read_stream(spark, folder, both.schema, files_per_trigger=1), "1 minute"), str(tmp_path))
        _, out = run(spark, breaches(read_stream(spark, folder, both.schema, files_per_trigger=1), "1 minute"), str(tmp_path))  # restarted
        got = sorted(map(tuple, out.collect()))
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", kept)
    upto = both.agg((F.max("at") - F.expr("interval 1 minute")).alias("t")).select(F.col("t")).first()[0]
    want = sorted(map(tuple, breaches_so_far(both, F.lit(upto)).collect()))
    resolved = {}
    for i, at in solved:
        resolved[i] = min(at, resolved.get(i, at))
    last = max(at for _, at in solved + [(i, at) for i, at, _ in sent if i is not None]) - dt.timedelta(minutes=1)
    plain = sorted(i for i, _, due in sent if i is not None and due is not None and due <= last and resolved.get(i, due + dt.timedelta(1)) > due)
    assert got == want and [i for i, _ in got] == plain and plain


def test_states_travel_in_batches_and_due_times_are_met_exactly(spark, tmp_path):
    """Calls are by bucket and not by key; a target passes when the watermark reaches it,
    not before, whether the key is new in that batch or not."""
    folder, base = str(tmp_path / "in"), str(tmp_path)
    schema = "key long, kind string, at timestamp, at_ms long, due_ms long"

    def event(key, kind, at, due=0):
        return (key, kind, minute(at), ms(at), due and ms(due))

    def ms(m):
        return int(minute(m).replace(tzinfo=dt.timezone.utc).timestamp() * 1000)

    first = [event(1, "submitted", 10, 30), event(2, "submitted", 10, 31), event(3, "submitted", 10, 30), event(4, "resolved", 11), event(6, "resolved", 28)]
    second = [event(3, "resolved", 30), event(4, "submitted", 12, 20), event(7, "submitted", 31, 900), event(8, "submitted", 14, 15)]
    third = [event(5, "submitted", 30, 30), event(6, "submitted", 30, 27), event(9, "submitted", 31, 900)]
    for rows in (first, second, third):
        add(spark, folder, rows, schema)
    kept = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    try:
        use_timers(spark)
        stream = breaches(read_stream(spark, folder, spark.createDataFrame([], schema).schema, files_per_trigger=1), "1 minute")
        grouped = re.search(r"FlatMapGroupsInPandasWithState .*?, \[(\w+)#", stream._jdf.queryExecution().analyzed().toString())
        assert grouped and grouped[1] == "bucket"
        _, out = run(spark, stream, base)  # the watermark ends at 30
        assert sorted((r.key, r.due_ms) for r in out.collect()) == [(1, ms(30)), (5, ms(30)), (6, ms(27)), (8, ms(15))]
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", kept)


@pytest.mark.parametrize("files", [1, 3])
def test_a_table_of_one_file_or_of_many_as_a_stream(spark, sf, tmp_path, files):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    if files == 1:
        (tmp_path / "documents.parquet").write_bytes(open(f"{sf}/documents.parquet", "rb").read())
    else:
        docs.repartition(files).write.parquet(str(tmp_path / "documents.parquet"))
    (tmp_path / "labels.parquet").write_bytes(open(f"{sf}/labels.parquet", "rb").read())
    rows = QUERIES["stream_evasion"](spark, str(tmp_path))
    assert sorted(r.doc_id for r in rows.collect()) == sorted(r.doc_id for r in docs.collect())
