"""What tells a migrated row that is loaded already: its instant, topic, payload and source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

from tidemark.functions import parse

# Stored beside the raw rows, so that a later load reads these and no JSON.
KEYS = StructType(
    [
        StructField("twin_a", LongType()),
        StructField("twin_b", LongType()),
        StructField("twin_wall", StringType()),
        StructField("twin_walled", BooleanType()),
    ]
)


def identity(at: Column, topic: Column, payload: Column, table: Column, source: Column) -> dict[str, Column]:
    """128 bits of a row's identity; NULL where a part is, as such a row has no twin."""
    parts = (at.cast("timestamp"), topic, payload, table, source)
    whole = parts[0].isNotNull()
    for part in parts[1:]:
        whole = whole & part.isNotNull()
    return {
        name: F.when(whole, F.xxhash64(F.lit(seed), *parts))
        for name, seed in (("twin_a", "a"), ("twin_b", "b"))
    }


def with_keys(rows: DataFrame, time_column: str) -> DataFrame:
    """Raw rows with the columns of ``KEYS``: their identity, and the wall-clock time their
    metadata records, if any. Only metadata that can name a source is parsed."""
    # A key may be spelled with escapes.
    named = F.col("metadata").contains("source_table") | F.col("metadata").contains("\\u")
    text = F.when(named, parse.object_text(F.col("metadata")))
    meta = F.col("_twin_meta")

    def field(name: str) -> Column:
        return parse.object_field(meta, name)

    wall = F.try_variant_get(meta, "$[0].source_created_at", "variant")
    return (
        rows.withColumn("_twin_text", text)
        .withColumn("_twin_marked", parse.json_marked(F.col("_twin_text")))
        .withColumn("_twin_meta", parse.json_value(F.col("_twin_marked"), F.col("_twin_text")))
        .withColumns({"_twin_table": field("source_table"), "_twin_source": field("source_topic")})
        .withColumns(
            {
                **identity(F.col(time_column), F.col("topic"), F.col("payload"), F.col("_twin_table"), F.col("_twin_source")),
                "twin_wall": field("source_created_at"),
                "twin_walled": F.coalesce(wall.isNotNull(), F.lit(False)),
            }
        )
        .drop("_twin_text", "_twin_marked", "_twin_meta", "_twin_table", "_twin_source")
    )


def stored_keys(rows: DataFrame, time_column: str) -> DataFrame:
    """The ``KEYS`` of raw rows that have an identity.

    Where the rows carry the keys, these are read and nothing else; only files from before they
    were stored are parsed, and a filter on missing keys passes the others over.
    """
    names = KEYS.fieldNames()
    if not set(names) <= set(rows.columns):
        return with_keys(rows, time_column).select(*names).where("twin_a IS NOT NULL")
    kept = rows.select(*names).where("twin_a IS NOT NULL")
    older = with_keys(rows.where("twin_walled IS NULL").drop(*names), time_column)
    return kept.unionByName(older.select(*names).where("twin_a IS NOT NULL"))
