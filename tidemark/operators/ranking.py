"""Consecutive numbers in a global order, without one task for all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.sources.checkpoints import cut_lineage


def ranked(rows: DataFrame, name: str, first: int, *order: str) -> DataFrame:
    """``rows`` with ``name``, counting from ``first`` in the order of the columns ``order``.

    Rows are dealt by range and numbered within their range; a range's numbers start where the
    ranges before it end. Runs a job.
    """
    line = F.monotonically_increasing_id()
    dealt = cut_lineage(
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumns({"_range": F.shiftright(line, 33), "_line": line.bitwiseAND(F.lit((1 << 33) - 1))})
    )
    # One row per range.
    sizes = sorted((r["_range"], r["n"]) for r in dealt.groupBy("_range").agg(F.count(F.lit(1)).alias("n")).collect())
    starts, at = [], first
    for number, n in sizes:
        starts.append((number, at))
        at += n
    known = rows.sparkSession.createDataFrame(starts, "_range long, _start long")
    return (
        dealt.join(F.broadcast(known), "_range")
        .withColumn(name, F.col("_start") + F.col("_line"))
        .drop("_range", "_line", "_start")
    )
