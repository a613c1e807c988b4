"""Data-quality contracts: each check counts the rows that break it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas


def _row_checks(df: DataFrame, table: str, checks: dict[str, Column]) -> DataFrame:
    """All row-level checks of a table in one pass; NULL counts as satisfied."""
    counted = df.agg(
        *[F.count(F.when(~ok, 1)).alias(name) for name, ok in checks.items()]
    )
    pairs = F.explode(
        F.array(*[F.struct(F.lit(n).alias("check"), F.col(n).alias("violations")) for n in checks])
    )
    return counted.select(pairs.alias("c")).select(F.lit(table).alias("table_name"), "c.*")


def _unique(df: DataFrame, table: str, name: str, keys: list[str]) -> DataFrame:
    repeated = df.groupBy(*keys).count().where("count > 1")
    return repeated.agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit(table).alias("table_name"), F.lit(name).alias("check"), "violations"
    )


def _present(schema, only: list[str] | None = None) -> Column:
    required = [f.name for f in schema.fields if not f.nullable]
    names = [c for c in required if only is None or c in only]
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in names])


def _bucket_checks(width: str) -> dict[str, Column]:
    seconds = schemas.WIDTHS[width]
    return {
        "status_domain": F.col("status").isin(*schemas.BUCKET_STATUSES),
        "bucket_width": F.unix_micros("bucket_end") - F.unix_micros("bucket_start")
        == seconds * 1_000_000,
    }


def aggregate_checks(df: DataFrame, width: str, table: str = "message_aggregates") -> DataFrame:
    checks = {**_bucket_checks(width), "not_null": _present(schemas.AGGREGATE)}
    return (
        _row_checks(df, table, checks)
        .unionByName(_unique(df, table, "unique_topic_key", ["bucket_start", "topic"]))
        .unionByName(
            _unique(df, table, "unique_series_key", ["bucket_start", "device_id", "metric_name"])
        )
    )


def reconciliation_checks(df: DataFrame, width: str, table: str = "power_energy_reconciliation") -> DataFrame:
    checks = {**_bucket_checks(width), "not_null": _present(schemas.RECONCILIATION)}
    return _row_checks(df, table, checks).unionByName(
        _unique(df, table, "unique_key", ["bucket_start", "device_id"])
    )


def message_checks(df: DataFrame, table: str = "messages") -> DataFrame:
    return _row_checks(df, table, {"not_null": _present(schemas.MESSAGE, df.columns)})


def relay_checks(df: DataFrame, table: str = "relay_state_events") -> DataFrame:
    return _row_checks(
        df,
        table,
        {
            "state_domain": F.col("state").isin(*schemas.RELAY_STATES),
            "relay_index_domain": F.col("relay_index") >= 0,
            "not_null": _present(schemas.RELAY_EVENT, df.columns),
        },
    )


def rule_checks(df: DataFrame, table: str = "topic_mapping") -> DataFrame:
    return _row_checks(
        df,
        table,
        {
            "rule_type_domain": F.col("rule_type").isin(*schemas.RULE_TYPES),
            "target_kind_domain": F.col("target_kind").isin(*schemas.TARGET_KINDS),
            "target_required": (F.col("target_kind") == "skip") | F.col("target_topic").isNotNull(),
        },
    )


def staged_checks(df: DataFrame, table: str = "staged_messages") -> DataFrame:
    return _row_checks(
        df,
        table,
        {
            "status_domain": F.col("validation_status").isin(*schemas.STAGED_STATUSES),
            "kind_domain": F.col("mapped_kind").isNull()
            | F.col("mapped_kind").isin(*schemas.TARGET_KINDS),
        },
    )


def batch_checks(df: DataFrame, table: str = "import_batches") -> DataFrame:
    return _row_checks(
        df, table, {"status_domain": F.col("status").isin(*schemas.BATCH_STATUSES)}
    )


def reject_checks(df: DataFrame, table: str = "rejected_messages") -> DataFrame:
    one = F.col("staged_message_id").isNotNull() != F.col("staged_topic_id").isNotNull()
    return _row_checks(df, table, {"one_source": one})


def retention_checks(df: DataFrame, time_column: str, oldest: Column, table: str) -> DataFrame:
    """Raw rows older than the retention boundary."""
    return _row_checks(df, table, {"retention": F.col(time_column) >= oldest})
