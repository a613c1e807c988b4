"""Column and storage helpers the corpus operators share."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.checkpoints import ensure_checkpoint_dir

# White space is exactly space, tab, line feed, vertical tab, form feed, carriage return.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def words_of(text: Column) -> Column:
    """The words of a text in order; none for null, empty and blank texts."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def n_words_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def working_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder."""
    ensure_checkpoint_dir(spark)
    top = spark.sparkContext.getCheckpointDir()
    return f"{top}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, *partitions: str) -> DataFrame:
    """The rows as a parquet table in the shared folder: computed once, read by any executor."""
    path = working_folder(df.sparkSession, name)
    df.write.partitionBy(*partitions).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unique_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def running(values: Column, kind: str, plus: Callable[[Column, Column], Column], chunk: int = 64) -> Column:
    """Inclusive running totals of an array that is not empty, under an associative ``plus`` with 0.

    Appending to an array copies it, so totals are taken in chunks first.
    """

    def totals(x: Column, first: Column) -> Column:
        start = F.struct(first.alias("s"), F.array().cast(f"array<{kind}>").alias("out"))

        def step(acc: Column, v: Column) -> Column:
            return bind(plus(acc["s"], v), lambda s: F.struct(s.alias("s"), F.concat(acc["out"], F.array(s)).alias("out")))

        return F.aggregate(x, start, step, lambda acc: acc["out"])

    zero = F.lit(0).cast(kind)
    chunks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(values) - 1) / chunk).cast("int")),
        lambda c: F.slice(values, c * chunk + 1, chunk),
    )
    return bind(
        chunks,
        lambda parts: bind(
            F.concat(F.array(zero), totals(F.transform(parts, lambda x: F.aggregate(x, zero, plus)), zero)),
            lambda starts: F.flatten(F.transform(parts, lambda x, i: totals(x, F.get(starts, i)))),
        ),
    )


# A bitmap of 2^25 bits: 4 MB to broadcast, whatever the corpus.
FILTER_BITS = 25


def maybe_among(rows: DataFrame, keys: DataFrame, key: str = "key") -> DataFrame:
    """The ``rows`` whose long ``key`` may be among ``keys``; the others certainly are not.

    The keys are hashed to a bitmap of fixed size, which is broadcast. A bit that belongs to
    another key only lets a row through in vain.
    """
    slot, page, at, bits = (unique_name(rows, c) for c in ("_slot", "_page", "_at", "_bits"))
    spot = F.pmod(F.col(key), F.lit(1 << FILTER_BITS))
    marks = (
        keys.select(spot.alias(slot))
        .groupBy(F.expr(f"bitmap_bucket_number({slot})").alias(page))
        .agg(F.expr(f"bitmap_construct_agg(bitmap_bit_position({slot}))").alias(bits))
    )
    byte = F.conv(F.hex(F.expr(f"substring({bits}, CAST({at} DIV 8 AS INT) + 1, 1)")), 16, 10).cast("int")
    bit = byte.bitwiseAND(F.expr(f"shiftleft(1, CAST({at} % 8 AS INT))"))
    return (
        rows.withColumn(slot, spot)
        # Never null, so that no null check is pushed down to where it would evaluate the key again.
        .withColumn(page, F.coalesce(F.expr(f"bitmap_bucket_number({slot})"), F.lit(-1)))
        .withColumn(at, F.coalesce(F.expr(f"bitmap_bit_position({slot})"), F.lit(-1)))
        .join(F.broadcast(marks), page)
        .where(bit != 0)
        .select(*rows.columns)
    )
