"""Latest-rows reports and consumer filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import scores

BOUNDARY_FLAGS = (
    "missing_locf_start",
    "missing_linear_start",
    "missing_locf_end",
    "missing_linear_end",
)


def latest_messages(messages: DataFrame, n: int = 20) -> DataFrame:
    columns = (
        "received_at topic device_id metric_name numeric_value trace_id sequence published_at"
        " committed_at"
    ).split()
    return messages.select(*columns).orderBy(F.desc("received_at"), F.desc("committed_at")).limit(n)


def _rounded(df: DataFrame, places: int) -> DataFrame:
    return df.select(
        *[
            F.round(f.name, places).alias(f.name) if f.dataType.simpleString() == "double" else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def latest_aggregates(aggregates: DataFrame, n: int = 20) -> DataFrame:
    newest = aggregates.drop("first_received_at", "last_received_at").orderBy(
        F.desc("bucket_start"), "device_id", "metric_name", "topic"
    )
    return _rounded(newest.limit(n), 6)


def latest_reconciliation(rows: DataFrame, n: int = 20) -> DataFrame:
    return _rounded(rows.orderBy(F.desc("bucket_start"), "device_id").limit(n), 6)


def latest_topics(inventory: DataFrame, n: int = 50) -> DataFrame:
    return (
        inventory.drop("last_payload", "last_metadata")
        .orderBy(F.desc("last_seen_at"), "topic")
        .limit(n)
    )


def trace_latency(messages: DataFrame, n: int = 50) -> DataFrame:
    """Publish-to-receive and receive-to-commit milliseconds of traced messages.

    Messages without a publish time come first, as the newest.
    """
    def milliseconds(later: str, earlier: str) -> str:
        return f"round((unix_micros({later}) - unix_micros({earlier})) / 1000D, 3)"

    return (
        messages.where("trace_id IS NOT NULL")
        .selectExpr(
            "trace_id",
            "sequence",
            "topic",
            "published_at",
            "received_at",
            "committed_at",
            f"{milliseconds('received_at', 'published_at')} AS publish_to_receive_ms",
            f"{milliseconds('committed_at', 'received_at')} AS receive_to_commit_ms",
        )
        .orderBy(F.desc_nulls_first("published_at"), "trace_id")
        .limit(n)
    )


def top_unmapped(unmapped: DataFrame, batch_id: int, n: int = 50) -> DataFrame:
    return (
        unmapped.where(F.col("batch_id") == batch_id)
        .drop("batch_id")
        .orderBy(F.desc("row_count"), "source_topic", "source_table")
        .limit(n)
    )


def recommended(aggregates: DataFrame, min_score: float = 5.0, min_count: int = 5) -> DataFrame:
    """Rows a consumer may rely on: rated, scored, counted, with both boundaries."""
    missing = F.arrays_overlap("quality_flags", F.array(*[F.lit(f) for f in BOUNDARY_FLAGS]))
    return aggregates.where(
        (F.col("quality_status") == "rated")
        & (F.col("quality_score") >= min_score)
        & (F.col("numeric_count") >= min_count)
        & ~missing
    )


def quality_bands(aggregates: DataFrame) -> DataFrame:
    """Number of rated rows per metric and guidance band."""
    return (
        aggregates.where("quality_status = 'rated'")
        .groupBy("metric_name", F.expr(scores.quality_band()).alias("band"))
        .agg(F.count(F.lit(1)).alias("row_count"))
    )
