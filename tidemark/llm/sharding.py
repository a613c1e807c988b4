"""Shards of near-equal bytes by histogram sort."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import text_or_empty, written

LOW, HIGH = -(1 << 63), (1 << 63) - 1


@dataclass
class Search:
    """The keys ``low`` to ``high`` between which one boundary is sought.

    ``before`` bytes lie below ``low``; ``rows`` rows lie within the bounds.
    """

    target: int
    before: int
    rows: int
    low: int = LOW
    high: int = HIGH
    boundary: int | None = None

    def probes(self, count: int, few: int) -> list[int]:
        """Evenly spaced candidate boundaries; none once found or few rows are left."""
        if self.boundary is not None or self.rows <= few or self.low >= self.high:
            return []
        width = self.high - self.low
        return sorted({self.low + max(1, width * i // (count + 1)) for i in range(1, count + 1)} | {self.high})

    def narrow(self, probes: list[int], bytes_below: dict[int, int], rows_below: dict[int, int], allowed: int) -> None:
        best = min(probes, key=lambda p: abs(bytes_below[p] - self.target))
        if abs(bytes_below[best] - self.target) <= allowed:
            self.boundary = best
            return
        edges = [self.low, *probes, self.high + 1]
        below = [self.before, *(bytes_below[p] for p in probes)]
        at = max(i for i, n in enumerate(below) if n <= self.target)
        first = rows_below[self.low] if self.low in rows_below else None
        counts = [first, *(rows_below[p] for p in probes), None]
        low, high = edges[at], edges[at + 1] - 1
        self.rows = counts[at + 1] - counts[at] if None not in (counts[at], counts[at + 1]) else self.rows
        self.before, self.low, self.high = below[at], low, high


def count_below(entries: DataFrame, key: str, probes: list[int]) -> tuple[dict[int, int], dict[int, int]]:
    """Exact bytes and rows of the keys below each probe; a row per probe reaches the driver."""
    marks = np.array(probes, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, len(marks) + 1), np.int64)
        for batch in batches:
            place = np.searchsorted(marks, batch.column(0).to_numpy(), side="right")
            np.add.at(sums[0], place, batch.column(1).to_numpy())
            sums[1] += np.bincount(place, minlength=len(marks) + 1)
        yield pa.record_batch([pa.array(np.arange(len(marks) + 1)), *map(pa.array, sums)], names=["place", "bytes", "n"])

    counted = entries.select(key, "size").mapInArrow(run, "place long, bytes long, n long")
    by_place = {r.place: r for r in counted.groupBy("place").agg(F.sum("bytes").alias("b"), F.sum("n").alias("n")).collect()}
    bytes_below, rows_below, b, n = {}, {}, 0, 0
    for i, probe in enumerate(probes):
        if i in by_place:
            b, n = b + by_place[i].b, n + by_place[i].n
        bytes_below[probe], rows_below[probe] = b, n
    return bytes_below, rows_below


def refine(entries: DataFrame, key: str, searches: list[Search], allowed: int, probes: int, few: int) -> None:
    """Probe round by round until each boundary is found, or few rows or one key are left."""
    while True:
        asked = [s.probes(probes, few) for s in searches]
        every = sorted({p for s, ps in zip(searches, asked, strict=True) if ps for p in [*ps, s.low]})
        if not every:
            return
        bytes_below, rows_below = count_below(entries, key, every)
        for s, ps in zip(searches, asked, strict=True):
            if ps:
                s.narrow(ps, bytes_below, rows_below, allowed)


def splitters(entries: DataFrame, shards: int, tolerance: float, probes: int, few: int) -> list[tuple[int, int]]:
    """``shards - 1`` boundaries as (``key``, ``tie``): rows below go left.

    Boundaries fall between keys where the tolerance allows. Otherwise the nearest row is sought,
    within a single key by the order of ``tie``.
    """
    rows, total = entries.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    allowed = int(tolerance * total / shards)
    wanted = [Search(total * (i + 1) // shards, 0, rows) for i in range(shards - 1)]
    refine(entries, "key", wanted, allowed, probes, few)
    found = []
    for s in wanted:
        if s.boundary is not None:
            found.append((s.boundary, LOW))
            continue
        inside = entries.where(F.col("key").between(s.low, s.high))
        ties = Search(s.target - s.before, 0, s.rows)
        if s.rows > few:
            refine(inside, "tie", [ties], allowed, probes, few)
        if ties.boundary is not None:
            found.append((s.low, ties.boundary))
            continue
        # Few rows are left, unless a great many share both keys; those stay together.
        near = inside.where(F.col("tie").between(ties.low, ties.high))
        grouped = near.groupBy("key", "tie").agg(F.sum("size").alias("size")).orderBy("key", "tie")
        best, below = (abs(s.target - s.before - ties.before), (s.low, ties.low)), s.before + ties.before
        for r in grouped.limit(few + 1).collect():
            below += r.size
            after = (r.key, r.tie + 1) if r.tie < HIGH else (r.key + 1, LOW)
            best = min(best, (abs(s.target - below), after))
        found.append(best[1])
    return sorted(found)


def shard_of(bounds: list[tuple[int, int]]) -> Column:
    """The number of boundaries at or below a row."""
    at_or_above = (
        ((F.col("key") > F.lit(k)) | ((F.col("key") == F.lit(k)) & (F.col("tie") >= F.lit(t)))).cast("int")
        for k, t in bounds
    )
    return sum(at_or_above, F.lit(0))


def sharded(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shards: int = 8,
    tolerance: float = 0.001,
    part_rows: int = 200_000,
    probes: int = 255,
    few: int = 1000,
) -> DataFrame:
    """One row per document: ``id``, ``size``, ``text_crc32``, ``shard``, ``slot``.

    Rows are ordered by a hash of the text, so equal texts lie together; a boundary passes through
    them only if the shards would otherwise differ by more than ``tolerance`` of a shard. Sizes are
    UTF-8 bytes plus one; a null text has no bytes and the checksum of none. Boundaries come from
    exact counts of bytes below probes, narrowed until they meet the tolerance. Slots count from 0
    without gaps within a shard; they are given out by parts of about ``part_rows`` rows, so no
    task holds a shard. Rows that repeat both id and text, or lack an id, share all keys and
    stay together. Other columns are not read; no rows give no rows.
    """
    text = text_or_empty(text_col)
    entries = written(
        docs.select(
            F.col(id_col).alias("id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.xxhash64(text).alias("key"),
            F.xxhash64(F.lit(1), F.col(id_col)).alias("tie"),
        ),
        "shard-entries",
    )
    rows = entries.count()
    placed = entries.withColumn("shard", shard_of(splitters(entries, shards, tolerance, probes, few)))
    parts = max(1, -(-rows // (shards * part_rows)))
    placed = placed.withColumn("part", F.pmod(F.xxhash64("tie"), F.lit(parts)).cast("int"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("shard", "part").agg(F.count("*").alias("n"))
    starts = starts.select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("shard", "part").orderBy("key", "tie", "id")
    ranked = placed.withColumn("rank", F.row_number().over(within))
    return ranked.join(starts, ["shard", "part"]).select(
        "id", "size", "text_crc32", "shard", (F.col("before") + F.col("rank") - 1).cast("long").alias("slot")
    )


def write_shards(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Write whole documents under ``shard=N`` folders; an id identifies a document."""
    places = sharded(docs, id_col, text_col, **options).select(F.col("id").alias("_shard_id"), "shard", "slot").dropDuplicates(["_shard_id"])
    named = docs.select(*(F.col(c) for c in docs.columns if c.lower() not in ("shard", "slot")))
    joined = named.join(places, F.col(id_col).eqNullSafe(F.col("_shard_id"))).drop("_shard_id")
    joined.write.partitionBy("shard").parquet(path)
    return docs.sparkSession.read.parquet(path)
