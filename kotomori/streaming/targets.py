"""Service targets while they run: a record for each submission whose target passes.

Submissions and resolutions arrive in one stream, keyed by submission. An open submission
is held with its due time; a resolution in time settles it. When the watermark reaches the
due time of one that is not settled, the breach is emitted and the submission goes, so state
holds open submissions only and a replay from the checkpoint emits nothing twice.

A call for a group costs far more than a row does, so a group is a bucket of keys by hash
and not a key: a batch of rows makes as many calls as there are buckets, however many keys
it has. What holds for a key depends on its own rows only.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import batched

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from kotomori.streaming.rates import instant

OPEN, RESOLVED = "submitted", "resolved"
NEVER = (1 << 63) - 1


def use_timers(spark: SparkSession) -> None:
    """The state store that keeps its keys on disk, for many open submissions."""
    spark.conf.set(
        "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    )


def settle(bucket: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """A bucket's rows of a batch, or its timeout. State: of open submissions their due times;
    of resolutions that came first their own times."""
    due, early = ({}, {}) if not state.exists else (dict(zip(keys, times)) for keys, times in batched(state.get, 2))
    for part in parts:
        part = part.sort_values("at", kind="stable")
        for key, kind, at, until in zip(*(part[c].tolist() for c in ("key", "kind", "at_ms", "due_ms"))):
            if kind == RESOLVED:
                if key not in due:
                    early[key] = min(at, early.get(key, at))
                elif at <= due[key]:
                    del due[key]
            elif key not in due:
                if key in early and early[key] <= until:
                    del early[key]
                else:
                    due[key] = until
    watermark = state.getCurrentWatermarkMs()
    passed = {key: at for key, at in due.items() if at <= watermark}
    due = {key: at for key, at in due.items() if at > watermark}
    early = {key: at for key, at in early.items() if at > watermark}  # of others the submission would be late
    if passed:
        yield pd.DataFrame({"key": list(passed), "due_ms": list(passed.values())})
    if due or early:
        state.update((list(due), list(due.values()), list(early), list(early.values())))
        # a timeout comes once the watermark is past it
        state.setTimeoutTimestamp(min(*due.values(), *early.values(), NEVER) - 1)
    elif state.exists:
        state.remove()


def target_events(submissions: DataFrame, resolutions: DataFrame, key: str, submitted_at: str = "submitted_at", due_at: str = "due_at", resolved_at: str = "resolved_at") -> DataFrame:
    """One stream of both kinds: ``(key, kind, at, at_ms, due_ms)``. Rows without a key, a
    time or a due time take no part; times are compared in milliseconds."""
    opened = submissions.select(F.col(key).alias("key"), F.lit(OPEN).alias("kind"), instant(submissions, submitted_at).alias("at"), F.unix_millis(instant(submissions, due_at)).alias("due_ms"))
    closed = resolutions.select(F.col(key).alias("key"), F.lit(RESOLVED).alias("kind"), instant(resolutions, resolved_at).alias("at"), F.lit(0).cast("long").alias("due_ms"))
    both = opened.unionByName(closed).where("key IS NOT NULL AND at IS NOT NULL AND due_ms IS NOT NULL")
    return both.withColumn("at_ms", F.unix_millis("at"))


def breaches(events: DataFrame, watermark: str = "10 minutes", buckets: int = 1024) -> DataFrame:
    """``(key, due_ms)`` of each submission not resolved by its due time, once the watermark
    has reached that time. The first due time of a key counts, as does its first resolution.

    The state of a bucket is written as a whole, so ``buckets`` should grow with the
    submissions that are open at a time; it has to stay as it is for a checkpoint.
    Call :func:`use_timers` on the session first.
    """
    kind = dict(events.dtypes)["key"]
    dealt = events.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)))
    keyed = dealt.withWatermark("at", watermark).groupBy("bucket")
    state = f"due_keys array<{kind}>, due array<long>, early_keys array<{kind}>, early array<long>"
    return keyed.applyInPandasWithState(settle, f"key {kind}, due_ms long", state, "append", GroupStateTimeout.EventTimeTimeout)


def breaches_so_far(events: DataFrame, upto) -> DataFrame:
    """What :func:`breaches` has emitted when the watermark stands at ``upto`` (a column or
    timestamp), from finished tables."""
    at = F.col("at_ms")
    per_key = events.groupBy("key").agg(
        F.min_by("due_ms", F.when(F.col("kind") == OPEN, at)).alias("due_ms"),
        F.min(F.when(F.col("kind") == RESOLVED, at)).alias("resolved_ms"),
    )
    passed = F.col("due_ms") <= F.unix_millis(upto)
    return per_key.where(passed & (F.col("resolved_ms").isNull() | (F.col("resolved_ms") > F.col("due_ms")))).select("key", "due_ms")
