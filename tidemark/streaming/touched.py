"""Which buckets a set of messages touches, and which others depend on them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.clock import SECOND_US

SERIES = ("device_id", "metric_name")


def touched_series_buckets(messages: DataFrame, width: str) -> DataFrame:
    """Distinct (series, bucket) of the messages that refresh sensor aggregates:
    all that name a series, but for those of topic kind ``status``."""
    width_us = schemas.WIDTHS[width] * SECOND_US
    at = "unix_micros(received_at)"
    return (
        messages.where("device_id IS NOT NULL AND metric_name IS NOT NULL AND topic_kind <> 'status'")
        .selectExpr(*SERIES, f"{at} - pmod({at}, {width_us}L) AS bucket_us")
        .distinct()
    )


def with_dependents(touched: DataFrame, known: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """The touched buckets and the known ones whose values depend on them.

    ``known`` holds every bucket row of the touched groups (keys, ``bucket_us``,
    ``sampled``: it has a sample now or had one before). A row looks at the nearest
    sampled bucket on each side, so it depends on a touched bucket exactly when no
    sampled bucket lies strictly between them.
    """
    rows = (
        known.selectExpr(*keys, "bucket_us", "sampled", "false AS touched")
        .unionByName(touched.selectExpr(*keys, "bucket_us", "false AS sampled", "true AS touched"))
        .groupBy(*keys, "bucket_us")
        .agg(F.bool_or("sampled").alias("sampled"), F.bool_or("touched").alias("touched"))
    )
    group = ", ".join(keys)
    running = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    back = f"(PARTITION BY {group} ORDER BY bucket_us {running})"
    ahead = f"(PARTITION BY {group} ORDER BY bucket_us DESC {running})"
    looked = rows.selectExpr(
        *keys,
        "bucket_us",
        "touched",
        f"max(IF(touched, bucket_us, NULL)) OVER {back} AS touched_before",
        f"max(IF(sampled, bucket_us, NULL)) OVER {back} AS sampled_before",
        f"min(IF(touched, bucket_us, NULL)) OVER {ahead} AS touched_after",
        f"min(IF(sampled, bucket_us, NULL)) OVER {ahead} AS sampled_after",
    )
    depends = """touched
        OR touched_before >= coalesce(sampled_before, touched_before)
        OR touched_after <= coalesce(sampled_after, touched_after)"""
    return looked.where(depends).select(*keys, "bucket_us")
