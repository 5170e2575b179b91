"""Result writers. Each task writes its own file; nothing passes the driver."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def write_counted(df: DataFrame, write: Callable[[DataFrame], None], **counts: Column) -> dict:
    """``write(df)``, and the aggregates ``counts`` over its rows from the same pass.

    ``write`` must run one job over the whole frame, as the sinks of this module do. What it
    does behind the frame (folders by tier, file formats) plays no part in the counts.
    """
    seen = Observation()
    write(df.observe(seen, *[c.alias(name) for name, c in counts.items()]))
    return seen.get


def record_counts(risk: float) -> dict[str, Column]:
    """Counts of prediction records: all, escalated, and of a risk above ``risk``."""
    return {
        "n": F.count(F.lit(1)),
        "n_escalated": F.count_if("escalate_to_human"),
        "n_high": F.count_if(F.col("adversarial_risk_score") > risk),
    }


def sink_predictions_json(records: DataFrame, path: str, by_tier: bool = False, mode: str = "error") -> None:
    """JSON lines, UTF-8, one folder per severity tier on request."""
    writer = records.write.mode(mode).option("ignoreNullFields", False)
    (writer.partitionBy("severity_tier") if by_tier else writer).json(path)


def _csv(df: DataFrame, path: str, mode: str) -> None:
    (
        df.write.mode(mode)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def sink_predictions_csv(records: DataFrame, path: str, mode: str = "error") -> None:
    """CSV; maps, arrays and structs become JSON text."""
    nested = {
        f.name: F.to_json(f.name)
        for f in records.schema.fields
        if f.dataType.typeName() in ("map", "array", "struct")
    }
    _csv(records.withColumns(nested) if nested else records, path, mode)


def sink_errors_csv(errors: DataFrame, path: str, mode: str = "error") -> None:
    _csv(errors, path, mode)


def sink_summary(summary: DataFrame, path: str, mode: str = "error") -> None:
    """A one-row frame as JSON."""
    summary.coalesce(1).write.mode(mode).option("ignoreNullFields", False).json(path)
