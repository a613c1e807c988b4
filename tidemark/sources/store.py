"""Parquet tables under one root folder.

Raw tables are append-only and partitioned by day and by the ingest batch that
wrote them, so a replayed batch replaces its own files. Derived tables are
partitioned by width and bucket day and written by upsert.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType, TimestampType

from tidemark import schemas
from tidemark.functions import clock, twins
from tidemark.session import prepare
from tidemark.sources import inventory
from tidemark.sources.retention import RETENTION_MONTHS, oldest_day


@dataclass(frozen=True)
class Table:
    """Layout of a stored table: columns, partition columns with how they are
    derived, the upsert key, and for raw rows the time of their twin keys."""

    schema: StructType
    partitions: dict[str, Column | None] = field(default_factory=dict)
    keys: tuple[str, ...] = ()
    twin_time: str | None = None

    def full_schema(self) -> StructType:
        have = set(self.schema.fieldNames())
        kinds = {p: StringType() for p in ("width", "ingest_batch", "due", "version")}
        added = [
            StructField(p, kinds.get(p, DateType())) for p in self.partitions if p not in have
        ]
        beside = twins.KEYS.fields if self.twin_time else []
        return StructType([*self.schema.fields, *beside, *added])



def tables() -> dict[str, Table]:
    """Layouts by table name. Column expressions need a running session."""
    edge_day = F.to_date(clock.instant("bucket_us"))
    edge_keys = ("device_id", "metric_name", "bucket_us")
    arrivals = StructType(
        [*schemas.TOPIC_OVERVIEW.fields, StructField("migrated", StringType())]
    )
    return {
        "messages": Table(
            schemas.MESSAGE,
            {"received_date": F.to_date("received_at"), "ingest_batch": None},
            twin_time="received_at",
        ),
        "relay_state_events": Table(
            schemas.RELAY_EVENT,
            {"event_date": F.to_date("event_at"), "ingest_batch": None},
            twin_time="event_at",
        ),
        "quarantined_messages": Table(
            StructType(
                [f for f in schemas.RAW_MESSAGE.fields if f.name != "committed_at"]
                + [StructField("reject_reason", StringType())]
            ),
            {"ingest_batch": None},
        ),
        "topic_arrivals": Table(arrivals, {"ingest_batch": None}),
        # Snapshots of the inventory, with the times and batches that order arrivals, and their marks.
        "topic_folds": Table(
            StructType(
                [
                    *arrivals.fields,
                    StructField("first_refreshed_at", TimestampType()),
                    StructField("first_batch", StringType()),
                    StructField("last_batch", StringType()),
                ]
            ),
            {"version": None},
        ),
        "topic_marks": Table(
            StructType([StructField("stream", StringType()), StructField("epoch", StringType())]), {"version": None}
        ),
        "message_aggregates": Table(
            schemas.AGGREGATE,
            {"width": None, "bucket_date": F.to_date("bucket_start")},
            ("width", "bucket_start", "device_id", "metric_name"),
        ),
        "power_energy_reconciliation": Table(
            schemas.RECONCILIATION,
            {"width": None, "bucket_date": F.to_date("bucket_start")},
            ("width", "bucket_start", "device_id"),
        ),
        "sample_edges": Table(schemas.EDGES, {"bucket_date": edge_day}, edge_keys),
        "relay_edges": Table(schemas.EDGES, {"bucket_date": edge_day}, edge_keys),
        # What the passing of time makes due, by minute; without a metric, a device's reconciliation.
        "due_buckets": Table(schemas.DUE_BUCKET, {"due": None, "ingest_batch": None}),
        # Days with rows and with samples as bitmaps, so that a neighbour is found without history.
        "series_days": Table(schemas.SERIES_DAYS, {"month": None}, ("device_id", "metric_name", "month")),
        "relay_days": Table(schemas.SERIES_DAYS, {"month": None}, ("device_id", "metric_name", "month")),
        "import_batches": Table(schemas.IMPORT_BATCH, {"batch_id": None}, ("batch_id",)),
        "topic_mapping": Table(schemas.TOPIC_RULE, {}, ("mapping_id",)),
        "staged_messages": Table(schemas.STAGED_MESSAGE, {"batch_id": None}),
        "staged_topics": Table(schemas.STAGED_TOPIC, {"batch_id": None}),
        "rejected_messages": Table(schemas.REJECTED_MESSAGE, {"batch_id": None}),
    }


class Store:
    """Named tables below ``root``, a folder all executors share."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = prepare(spark)
        self.root = root.rstrip("/")
        self.tables = tables()

    # --- files -----------------------------------------------------------------

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), target

    def exists(self, name: str) -> bool:
        fs, target = self._fs(self.path(name))
        return fs.exists(target)

    def _remove(self, path: str) -> None:
        fs, target = self._fs(path)
        fs.delete(target, True)

    # --- reading and writing -----------------------------------------------------

    def read(self, name: str, twin_keys: bool = False) -> DataFrame:
        """A table; of raw rows also the columns that tell loaded twins, if asked for."""
        schema = self.tables[name].full_schema()
        if not self.exists(name):
            rows = self.spark.createDataFrame([], schema)
        else:
            rows = self.spark.read.schema(schema).parquet(self.path(name))
        return rows if twin_keys else rows.drop(*twins.KEYS.fieldNames())

    def _shaped(self, df: DataFrame, name: str) -> DataFrame:
        table = self.tables[name]
        added = {p: c for p, c in table.partitions.items() if c is not None}
        if table.twin_time:
            df = twins.with_keys(df, table.twin_time)
        return schemas.conform(df.withColumns(added) if added else df, table.full_schema())

    def _overwrite_partitions(self, df: DataFrame, path: str, partitions: Sequence[str]) -> None:
        writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        (writer.partitionBy(*partitions) if partitions else writer).parquet(path)

    def append(self, df: DataFrame, name: str, ingest_batch: str) -> None:
        """Append a batch's rows; repeating the batch replaces them."""
        rows = self._shaped(df.withColumn("ingest_batch", F.lit(ingest_batch)), name)
        rows = rows.hint("rebalance", *self.tables[name].partitions)
        self._overwrite_partitions(rows, self.path(name), list(self.tables[name].partitions))

    def add_partitions(self, df: DataFrame, name: str) -> None:
        """Write rows whose partitions are not there yet."""
        self._overwrite_partitions(self._shaped(df, name), self.path(name), list(self.tables[name].partitions))

    def replace_partitions(self, df: DataFrame, name: str) -> None:
        """Replace the partitions present in ``df``. The rows are written aside
        first, so they may come from the table itself."""
        table = self.tables[name]
        aside = f"{self.root}/_aside/{name}-{uuid.uuid4().hex}"
        self._shaped(df, name).write.parquet(aside)
        self._place(self.spark.read.schema(table.full_schema()).parquet(aside), name)
        self._remove(aside)

    def put_partitions(self, df: DataFrame, name: str) -> None:
        """Replace the partitions present in ``df``, whose rows come from elsewhere, in one write."""
        self._place(self._shaped(df, name), name)

    @contextmanager
    def aside(self, df: DataFrame) -> Iterator[DataFrame]:
        """The rows as a table of their own while the block runs: computed once, read by column."""
        path = f"{self.root}/_aside/rows-{uuid.uuid4().hex}"
        df.write.parquet(path)
        try:
            yield self.spark.read.schema(df.schema).parquet(path)
        finally:
            self._remove(path)

    def _place(self, rows: DataFrame, name: str) -> None:
        """Replace the partitions present in shaped rows that do not lie in the table."""
        table = self.tables[name]
        if table.partitions:
            # Few files per small partition; AQE splits the large ones over tasks.
            rows = rows.hint("rebalance", *table.partitions)
        self._overwrite_partitions(rows, self.path(name), list(table.partitions))

    def upsert(self, df: DataFrame, name: str) -> None:
        """Insert rows, replacing those with the same key. Only the partitions of
        the new rows are read and rewritten."""
        table = self.tables[name]
        aside = f"{self.root}/_aside/{name}-{uuid.uuid4().hex}"
        # Each row is written aside once: the new ones, then the old ones that stay.
        self._shaped(df, name).write.parquet(f"{aside}/new")
        found = self.spark.read.schema(table.full_schema())
        new, parts = found.parquet(f"{aside}/new"), [f"{aside}/new"]
        old = self.read(name, twin_keys=True)
        if table.partitions:
            # One row per width and day: a calendar-bounded list.
            touched = new.select(*table.partitions).distinct()
            places = [row.asDict() for row in touched.collect()]
            if not places:
                self._remove(aside)
                return
            for p in table.partitions:
                values = list({place[p] for place in places})
                old = old.where(F.col(p).isin(values))
            old = old.join(F.broadcast(touched), list(table.partitions), "left_semi")
        if self.exists(name):
            kept = old.join(new.select(*table.keys), list(table.keys), "left_anti")
            kept.select(*new.columns).write.parquet(f"{aside}/kept")
            parts.append(f"{aside}/kept")
        self._place(found.parquet(*parts), name)
        self._remove(aside)

    # --- folders of partitions -----------------------------------------------------

    def partition_folders(self, name: str, column: str, wanted) -> list[str]:
        """The folders below the partitions whose value of ``column`` is wanted, as
        deep as there are partitions: what is added later is not among them."""
        fs, top = self._fs(self.path(name))
        if not fs.exists(top):
            return []
        found = []

        def walk(folder, inside: bool) -> None:
            below = [s for s in fs.listStatus(folder) if s.isDirectory() and "=" in s.getPath().getName()]
            if inside and not below:
                found.append(folder.toString())
            for status in below:
                key, value = status.getPath().getName().split("=", 1)
                if inside or key != column or wanted(value):
                    walk(status.getPath(), inside or key == column)

        walk(top, False)
        return sorted(found)

    def read_folders(self, name: str, folders: Sequence[str]) -> DataFrame:
        schema = self.tables[name].full_schema()
        return self.spark.read.schema(schema).option("basePath", self.path(name)).parquet(*folders)

    def remove_folders(self, folders: Sequence[str]) -> None:
        for folder in folders:
            self._remove(folder)

    # --- maintenance -------------------------------------------------------------

    def drop_partitions(self, name: str, column: str, keep) -> list[str]:
        """Delete the partition folders whose value of ``column`` is not kept."""
        fs, top = self._fs(self.path(name))
        if not fs.exists(top):
            return []
        dropped = []

        def walk(folder) -> None:
            for status in fs.listStatus(folder):
                label = status.getPath().getName()
                if not status.isDirectory() or "=" not in label:
                    continue
                key, value = label.split("=", 1)
                if key != column:
                    walk(status.getPath())
                elif not keep(value):
                    dropped.append(status.getPath().toString())

        walk(top)
        for path in dropped:
            self._remove(path)
        return dropped

    def prune_raw(self, reference_time: datetime | str, months: int = RETENTION_MONTHS) -> None:
        """Drop raw day partitions past retention, and the neighbour samples of
        those days. Aggregates and reconciliation stay."""
        first = oldest_day(reference_time, months)
        self.drop_partitions("messages", "received_date", lambda day: day >= first)
        self.drop_partitions("relay_state_events", "event_date", lambda day: day >= first)
        for edges in ("sample_edges", "relay_edges"):
            self.drop_partitions(edges, "bucket_date", lambda day: day >= first)

    def missing_tables(self, names: Sequence[str]) -> list[str]:
        return [n for n in names if not self.exists(n)]

    # --- topic inventory -----------------------------------------------------------

    def topic_overview(self) -> DataFrame:
        """One row per topic, folded from the last snapshot and the arrivals after it."""
        return inventory.topic_overview(self)
