"""Running a historical migration against a store.

Each step writes its result, so a failed run restarts at the last completed
status of its batch. A load notes the tag of its raw rows in the batch before it
writes any; if it is interrupted, the next load of the batch takes up that tag.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import clock
from tidemark.operators import migration, reports, rules
from tidemark.plans.refresh import edge_cells, rebuild_edges, refresh_range, update_edges
from tidemark.sources import inventory
from tidemark.sources.checkpoints import cut_lineage
from tidemark.sources.store import Store

# Fixed value: what a full reset must be confirmed with.
RESET_TOKEN = "RESET_LOCAL_MIGRATION"

# Where a batch's metadata names the tag of a load that has begun but not ended.
_OPEN_LOAD = "open_load"

# Name of a legacy table -> the table, or None where it does not exist.
Legacy = Callable[[str], "DataFrame | None"]


class RangeRun(list):
    """The batch ids of a range run. ``stopped_at`` is the wall-clock time reached if a limit
    ended it early, else None."""

    stopped_at: str | None = None


class Migration:
    def __init__(self, store: Store, legacy: Legacy | None = None):
        self.store = store
        self.legacy = legacy or self._catalog_table

    def _catalog_table(self, name: str) -> DataFrame | None:
        spark = self.store.spark
        return spark.table(name) if spark.catalog.tableExists(name) else None

    # --- batches -----------------------------------------------------------------

    def _batch(self, batch_id: int) -> DataFrame:
        return self.store.read("import_batches").where(F.col("batch_id") == batch_id)

    def _staged(self, batch_id: int) -> tuple[DataFrame, DataFrame]:
        of_batch = F.col("batch_id") == batch_id
        return (
            self.store.read("staged_messages").where(of_batch),
            self.store.read("staged_topics").where(of_batch),
        )

    def _zone(self, batch_id: int) -> str:
        row = self._batch(batch_id).select("source_timezone").first()
        if row is None:
            raise ValueError(f"no import batch {batch_id}")
        return row.source_timezone

    def available(self) -> list[str]:
        """Legacy tables that exist; migration needs at least one."""
        names = [*schemas.LEGACY_TABLES, schemas.LEGACY_TOPICS]
        found = [n for n in names if self.legacy(n) is not None]
        if not found:
            raise ValueError("no legacy tables found")
        return found

    def create_batch(
        self, dump_name: str, now: datetime | str, source_timezone: str | None = None, metadata: dict | None = None
    ) -> int:
        """A new batch; without a zone the session's applies, then UTC."""
        spark = self.store.spark
        zone = source_timezone or spark.conf.get("spark.sql.session.timeZone") or "UTC"
        last = self.store.read("import_batches").agg(F.max("batch_id")).first()[0] or 0
        at = clock.from_us(clock.to_us(now))
        row = (
            last + 1, dump_name, zone, None, None, "created", 0, 0, 0, 0,
            json.dumps(metadata or {}), at, at,
        )
        self.store.upsert(spark.createDataFrame([row], schemas.IMPORT_BATCH), "import_batches")
        return last + 1

    def _advance(self, batch_id: int, status: str, now: datetime | str, **counters) -> None:
        columns = {"status": F.lit(status), "updated_at": clock.instant_lit(clock.to_us(now)), **counters}
        self.store.upsert(self._batch(batch_id).withColumns(columns), "import_batches")

    def _recount(self, batch_id: int, status: str, now: datetime | str, *names: str) -> None:
        counted = migration.batch_counters(*self._staged(batch_id), self._zone(batch_id)).first()
        # Without rows counters are zero and bounds unknown.
        empty = {n: None if n.endswith("_at") else 0 for n in names}
        known = counted.asDict() if counted else empty
        types = {f.name: f.dataType for f in schemas.IMPORT_BATCH.fields}
        self._advance(
            batch_id, status, now, **{n: F.lit(known[n]).cast(types[n]) for n in names}
        )

    # --- steps -------------------------------------------------------------------

    def stage(
        self,
        batch_id: int,
        now: datetime | str,
        from_time: str | None = None,
        to_time: str | None = None,
        include_topics: bool = True,
    ) -> DataFrame:
        """Stage the legacy tables that exist, in place of what the batch had staged of them;
        rows per source table."""
        parts = []
        for name in schemas.LEGACY_TABLES:
            source = self.legacy(name)
            if source is not None:
                parts.append(migration.stage_table(source, batch_id, name, from_time, to_time))
        self.store.drop_partitions("staged_messages", "batch_id", lambda b: b != str(batch_id))
        if parts:
            self.store.put_partitions(reduce(DataFrame.unionByName, parts), "staged_messages")
        snapshot = self.legacy(schemas.LEGACY_TOPICS) if include_topics else None
        if include_topics:
            self.store.drop_partitions("staged_topics", "batch_id", lambda b: b != str(batch_id))
        if snapshot is not None:
            position = "position" if "position" in snapshot.columns else None
            self.store.put_partitions(migration.stage_topics(snapshot, batch_id, position), "staged_topics")
        self._recount(batch_id, "staged", now, "staged_row_count", "source_min_at", "source_max_at")
        messages, topics = self._staged(batch_id)
        per_table = messages.groupBy("source_table").agg(F.count(F.lit(1)).alias("row_count"))
        return per_table.unionByName(
            topics.groupBy(F.lit(schemas.LEGACY_TOPICS).alias("source_table")).agg(
                F.count(F.lit(1)).alias("row_count")
            )
        )

    def apply(self, batch_id: int, now: datetime | str) -> DataFrame:
        """Map the batch by the stored rules, replacing its rejects; row counts
        per status. Can be repeated after the rules changed."""
        known = self.store.read("topic_mapping")
        messages, topics = self._staged(batch_id)
        self.store.replace_partitions(
            migration.apply_rules(messages, known, self._zone(batch_id)), "staged_messages"
        )
        self.store.replace_partitions(migration.apply_rules(topics, known), "staged_topics")
        messages, topics = self._staged(batch_id)
        self.store.drop_partitions("rejected_messages", "batch_id", lambda b: b != str(batch_id))
        self.store.put_partitions(migration.rejects(messages, topics), "rejected_messages")
        self._recount(batch_id, "mapped", now, "mapped_row_count", "skipped_row_count")
        return migration.status_report(messages, topics)

    def _tag(self, batch_id: int, now: datetime | str) -> str:
        """Raw rows of one load; loading again later adds a tag of its own."""
        return f"migration-{batch_id}-{clock.to_us(now)}"

    def _notes(self, batch_id: int) -> dict:
        row = self._batch(batch_id).select("metadata").first()
        return json.loads(row.metadata or "{}")

    def _note(self, batch_id: int, notes: dict, now: datetime | str) -> None:
        status = self._batch(batch_id).select("status").first().status
        self._advance(batch_id, status, now, metadata=F.lit(json.dumps(notes)))

    def _loaded_near(self, name: str, time: str, staged: DataFrame, tag: str) -> DataFrame:
        """Stored raw rows of other loads on the days of the staged rows."""
        at = F.to_date("production_received_at")
        span = staged.agg(F.min(at).alias("lo"), F.max(at).alias("hi")).first()
        rows = self.store.read(name, twin_keys=True).where(F.col("ingest_batch") != tag)
        if span.lo is None:
            return rows.where(F.lit(False))
        return rows.where(F.col(time).between(F.lit(span.lo), F.lit(span.hi)))

    def load_messages(self, batch_id: int, now: datetime | str) -> tuple[int, int]:
        """Append mapped messages and relay events that are not loaded yet;
        returns how many of each.

        A load that was interrupted is done again under its own tag and time: its raw rows
        are replaced, and edges, marks and counters made anew from them.
        """
        notes = self._notes(batch_id)
        again = notes.get(_OPEN_LOAD)
        if again:
            tag, at = again["tag"], again["at"]
        else:
            tag, at = self._tag(batch_id, now), str(clock.from_us(clock.to_us(now)))
            self._note(batch_id, {**notes, _OPEN_LOAD: {"tag": tag, "at": at}}, now)
        staged, _ = self._staged(batch_id)
        # Marks of the interrupted load may be there already; what other loads hold does not count.
        ready = migration.reopened(staged) if again else staged
        if again:
            for name in ("messages", "relay_state_events"):
                self.store.drop_partitions(name, "ingest_batch", lambda t: t != tag)
        existing = self._loaded_near("messages", "received_date", ready, tag)
        known = self._loaded_near("relay_state_events", "event_date", ready, tag)
        fresh = migration.message_candidates(ready, existing)
        owed = migration.relay_candidates(ready, known)
        with self.store.aside(fresh) as new, self.store.aside(owed) as events:
            messages = migration.to_messages(new, at)
            relay = migration.to_relay_events(events, at)
            self.store.append(messages, "messages", tag)
            self.store.append(relay, "relay_state_events", tag)
            if again:
                rebuild_edges(self.store, *edge_cells(messages, relay))
            else:
                update_edges(self.store, messages, relay)
            done = migration.mark_inserted(staged, new, "staged_message_id", at)
            self.store.replace_partitions(
                migration.mark_relay_inserted(done, events), "staged_messages"
            )
            self._recount(batch_id, "loaded", now, "inserted_row_count")
            self._note(batch_id, {k: v for k, v in self._notes(batch_id).items() if k != _OPEN_LOAD}, now)
            return new.count(), relay.count()

    def load_topics(self, batch_id: int, now: datetime | str) -> int:
        """Record the mapped topic snapshot in the inventory."""
        _, staged = self._staged(batch_id)
        new = cut_lineage(migration.topic_candidates(staged))
        latest = migration.latest_topics(new, now).withColumn("migrated", F.lit(str(batch_id)))
        self.store.append(latest, "topic_arrivals", self._tag(batch_id, now))
        self.store.replace_partitions(
            migration.mark_inserted(staged, new, "staged_topic_id", now), "staged_topics"
        )
        return latest.count()

    def refresh(self, batch_id: int, now: datetime | str) -> None:
        """Recompute the eight derived tables over the batch's inserted range."""
        staged, _ = self._staged(batch_id)
        span = (
            staged.where("inserted")
            .agg(
                F.min(clock.micros("production_received_at")).alias("lo"),
                F.max(clock.micros("production_received_at")).alias("hi"),
            )
            .first()
        )
        if span.lo is None:
            return
        refresh_range(self.store, now, clock.from_us(span.lo), clock.from_us(span.hi))
        self._advance(batch_id, "refreshed", now)

    # --- runs --------------------------------------------------------------------

    def summary(self, batch_id: int) -> DataFrame:
        return migration.batch_summary(self._batch(batch_id), *self._staged(batch_id))

    def top_unmapped(self, batch_id: int, n: int = 50) -> DataFrame:
        return reports.top_unmapped(
            migration.top_unmapped_topics(*self._staged(batch_id)), batch_id, n
        )

    def remap(self, batch_id: int, now: datetime | str, new_rules: DataFrame | None = None, n: int = 50) -> dict[str, DataFrame]:
        """Map a batch again, after importing ``new_rules`` if given, and report on it:
        ``status``, ``summary`` and ``unmapped`` (the ``n`` most frequent topics)."""
        if new_rules is not None:
            self.import_rules(new_rules)
        status = self.apply(batch_id, now)
        return {"status": status, "summary": self.summary(batch_id), "unmapped": self.top_unmapped(batch_id, n)}

    def import_rules(self, new_rules: DataFrame) -> None:
        """Add the rules the store lacks, numbered in their order."""
        self.store.upsert(rules.import_rules(self.store.read("topic_mapping"), new_rules), "topic_mapping")

    def dry_run(
        self,
        dump_name: str,
        now: datetime | str,
        source_timezone: str | None = None,
        from_time: str | None = None,
        to_time: str | None = None,
        include_topics: bool = True,
        metadata: dict | None = None,
    ) -> int:
        """Create, stage and map a batch; its reports show what would load."""
        self.available()
        batch_id = self.create_batch(dump_name, now, source_timezone, metadata)
        self.stage(batch_id, now, from_time, to_time, include_topics)
        self.apply(batch_id, now)
        return batch_id

    def load(self, batch_id: int, now: datetime | str) -> tuple[int, int, int]:
        messages, events = self.load_messages(batch_id, now)
        topics = self.load_topics(batch_id, now)
        self.refresh(batch_id, now)
        return messages, events, topics

    def run_range(
        self,
        dump_name: str,
        start: date | str,
        end: date | str,
        now: datetime | str,
        source_timezone: str | None = None,
        batch_days: int = 1,
        max_batches: int | None = None,
        load_batches: bool = False,
        include_topics: str = "first",
    ) -> RangeRun:
        """One batch per slice of ``[start, end)``; the topic snapshot goes with
        the first, all or none of them. ``max_batches`` ends the run early; the
        result then tells where."""
        if include_topics not in ("first", "all", "none"):
            raise ValueError("topics go with the 'first' batch, with 'all' or with 'none'")
        batches = RangeRun()
        for lo, hi in slices(start, end, batch_days):
            if max_batches is not None and len(batches) >= max_batches:
                batches.stopped_at = lo
                break
            with_topics = include_topics == "all" or (include_topics == "first" and not batches)
            notes = {"from_time": lo, "to_time": hi, "range_runner": True}
            batch_id = self.dry_run(dump_name, now, source_timezone, lo, hi, with_topics, notes)
            if load_batches:
                self.load(batch_id, now)
            batches.append(batch_id)
        return batches

    def _drop_raw(self, prefix: str) -> None:
        """Drop raw rows by ingest tag, and the neighbour samples they lent."""
        tagged = F.col("ingest_batch").startswith(prefix)
        cells = edge_cells(
            self.store.read("messages").where(tagged),
            self.store.read("relay_state_events").where(tagged),
        )
        for name in ("messages", "relay_state_events"):
            self.store.drop_partitions(name, "ingest_batch", lambda tag: not tag.startswith(prefix))
        rebuild_edges(self.store, *cells)

    def reset_batch(self, batch_id: int, now: datetime | str) -> None:
        """Take a loaded batch's raw rows out again; its staged rows are mapped
        as before. Derived tables and the inventory stay as they are."""
        self._drop_raw(f"migration-{batch_id}-")
        messages, topics = self._staged(batch_id)
        self.store.replace_partitions(migration.reset_staged(messages), "staged_messages")
        self.store.replace_partitions(migration.reset_staged(topics), "staged_topics")
        self._advance(batch_id, "mapped", now, inserted_row_count=F.lit(0).cast("bigint"))

    def reset_all(self, confirm: str) -> None:
        """Remove everything any migration wrote but for derived tables and rules."""
        if confirm != RESET_TOKEN:
            raise ValueError("reset not confirmed")
        self._drop_raw("migration-")
        # A topic last seen by a migration goes with all of its arrivals.
        overview = self.store.topic_overview()
        kept = migration.without_batch(overview, None, "last_metadata").select("topic")
        inventory.keep_topics(self.store, kept)
        for name in ("import_batches", "staged_messages", "staged_topics", "rejected_messages"):
            self.store.drop_partitions(name, "batch_id", lambda batch: False)


def slices(start: date | str, end: date | str, days: int) -> Iterator[tuple[str, str]]:
    """Consecutive wall-clock slices of ``days`` days, the last one clipped."""
    lo, stop = (datetime.fromisoformat(str(d)) for d in (start, end))
    while lo < stop:
        hi = min(lo + timedelta(days=days), stop)
        yield str(lo), str(hi)
        lo = hi
