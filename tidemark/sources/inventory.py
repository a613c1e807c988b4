"""The topic inventory on disk: arrivals by batch, and snapshots that settled batches are folded into.

A snapshot has one row per topic for the batches of each stream up to a mark, and those
marks. The newest batch of a stream is never in it, as the stream may repeat that one
after a failure. Marks are one file, written last: a snapshot without them does not count.
"""

from __future__ import annotations

import re
import uuid
from collections import defaultdict
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.sources.checkpoints import cut_lineage

_EPOCH = re.compile(r"(.+)-(\d{12})")
_LAST = ("last_seen_at", "last_payload", "last_metadata", "refreshed_at")
_TRACE = ("last_event_id", "last_trace_id", "last_publisher_id", "last_sequence")


def _stream_and_epoch(tag: str) -> tuple[str, str] | None:
    """Of a stream's batch; other batches, as those of migrations, have neither and are not folded."""
    found = _EPOCH.fullmatch(tag)
    return (found[1], found[2]) if found else None


def _versions(store) -> list[str]:
    folders = store.partition_folders("topic_marks", "version", lambda version: True)
    return sorted(folder.rsplit("version=", 1)[1] for folder in folders)


def _marks(store, version: str | None) -> dict[str, str]:
    """The last folded epoch by stream: a row for each stream there ever was."""
    if version is None:
        return {}
    rows = store.read("topic_marks").where(F.col("version") == version)
    return {r.stream: r.epoch for r in rows.collect()}


def _newest(store) -> tuple[str | None, dict[str, str]]:
    version = max(_versions(store), default=None)
    return version, _marks(store, version)


def _in(marks: dict[str, str], tag: str) -> bool:
    found = _stream_and_epoch(tag)
    return found is not None and found[1] <= marks.get(found[0], "")


def _folders(store, wanted) -> list[str]:
    return store.partition_folders("topic_arrivals", "ingest_batch", lambda tag: wanted(unquote(tag)))


def _tag(folder: str) -> str:
    return unquote(folder.rsplit("ingest_batch=", 1)[1])


def _arrivals(store, folders: list[str]) -> DataFrame:
    """Arrivals of some batches, in the columns of a snapshot."""
    if folders:
        rows = store.read_folders("topic_arrivals", folders)
    else:
        rows = store.spark.createDataFrame([], store.tables["topic_arrivals"].full_schema())
    batch = F.col("ingest_batch")
    return rows.withColumns({"first_refreshed_at": F.col("refreshed_at"), "first_batch": batch, "last_batch": batch})


def _snapshot(store, version: str | None) -> DataFrame:
    rows = store.read("topic_folds")
    return rows.where(F.lit(False) if version is None else F.col("version") == version)


def _folded(rows: DataFrame) -> DataFrame:
    """One row per topic. Rows of migrations leave the trace fields alone."""
    first, last = F.struct("first_refreshed_at", "first_batch"), F.struct("refreshed_at", "last_batch")
    live = F.when(F.col("migrated").isNull(), last)

    def picked(found: Column, names: tuple[str, ...]) -> list[Column]:
        return [found[n].alias(n) for n in names]

    return rows.groupBy("topic").agg(
        *picked(F.min_by(F.struct("first_seen_at", "first_refreshed_at", "first_batch"), first),
                ("first_seen_at", "first_refreshed_at", "first_batch")),
        F.sum("message_count").alias("message_count"),
        *picked(F.max_by(F.struct(*_LAST, "last_batch"), last), (*_LAST, "last_batch")),
        *picked(F.max_by(F.struct(*_TRACE), live), _TRACE),
    )


def topic_overview(store) -> DataFrame:
    """One row per topic: the newest snapshot and the arrivals after its marks; no others are read.

    Counts come from the batches' own rows, so a replayed batch is counted once.
    """
    version, marks = _newest(store)
    left = _arrivals(store, _folders(store, lambda tag: not _in(marks, tag)))
    everything = _snapshot(store, version).drop("version").unionByName(left.drop("ingest_batch"))
    return _folded(everything).select(*schemas.TOPIC_OVERVIEW.fieldNames())


def check_not_folded(store, batch: str) -> None:
    """Refuse a batch that a snapshot holds already: its rows would not be read again."""
    if _in(_newest(store)[1], batch):
        raise ValueError(f"batch {batch} is folded into the topic inventory already")


def _write(store, rows: DataFrame, marks: dict[str, str], before: str | None) -> None:
    # Snapshots made at once get names of their own; the greater one holds, and the other's batches are folded again.
    number = int(before.split("-")[0]) + 1 if before else 0
    version = F.lit(f"{number:012d}-{uuid.uuid4().hex}")
    store.add_partitions(rows.withColumn("version", version), "topic_folds")
    listed = store.spark.createDataFrame(sorted(marks.items()), "stream string, epoch string").coalesce(1)
    store.add_partitions(listed.withColumn("version", version), "topic_marks")


def fold_arrivals(store) -> int:
    """Fold all batches but each stream's newest into a new snapshot; returns how many.

    The snapshot before it and the arrivals that one lacks are kept until the next fold, for
    readers that began with them. A failure at any point leaves the old snapshot or the new one.
    """
    before, marks = _newest(store)
    streams = defaultdict(list)
    for folder in _folders(store, lambda tag: _stream_and_epoch(tag) and not _in(marks, tag)):
        stream, epoch = _stream_and_epoch(_tag(folder))
        streams[stream].append((epoch, folder))
    settled = {s: sorted(found)[:-1] for s, found in streams.items() if len(found) > 1}
    if not settled:
        return 0
    folders = [folder for found in settled.values() for _, folder in found]
    everything = _snapshot(store, before).drop("version").unionByName(_arrivals(store, folders).drop("ingest_batch"))
    rows = _folded(everything).withColumn("migrated", F.lit(None).cast("string"))
    _write(store, rows, {**marks, **{s: found[-1][0] for s, found in settled.items()}}, before)
    store.remove_folders(_folders(store, lambda tag: _in(marks, tag)))
    if before:
        for name in ("topic_marks", "topic_folds"):
            store.drop_partitions(name, "version", lambda version: version >= before)
    return len(folders)


def keep_topics(store, kept: DataFrame) -> None:
    """Drop the arrivals of migrations, and all arrivals of topics that are not ``kept``."""
    kept = cut_lineage(kept)
    version, marks = _newest(store)
    left = _arrivals(store, _folders(store, lambda tag: not _in(marks, tag)))
    survivors = cut_lineage(left.where(F.col("migrated").isNull()).join(kept, "topic", "left_semi"))
    if version:
        _write(store, _snapshot(store, version).join(kept, "topic", "left_semi"), marks, version)
    store.replace_partitions(survivors, "topic_arrivals")
    # One tag for each batch since the last fold.
    tags = {r.ingest_batch for r in survivors.select("ingest_batch").distinct().collect()}
    store.drop_partitions("topic_arrivals", "ingest_batch", lambda tag: unquote(tag) in tags)
