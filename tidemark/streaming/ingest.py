"""Structured Streaming ingest: messages and the topic inventory."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions import clock
from tidemark.operators import normalize
from tidemark.plans.refresh import note_due, refresh_touched, update_edges
from tidemark.sources import inventory
from tidemark.sources.checkpoints import cut_lineage
from tidemark.sources.store import Store


def _now() -> datetime:
    return datetime.now(timezone.utc)


def ingest_batch(
    store: Store, raw: DataFrame, batch: str, reference_time: datetime | str
) -> None:
    """Normalise, append and refresh one batch of raw messages.

    The batch's name tags its raw rows: repeating it after a failure replaces
    them, and every later step recomputes from the raw tables.
    """
    reference = clock.instant_lit(clock.to_us(reference_time))
    stamped = raw if "committed_at" in raw.columns else raw.withColumn("committed_at", reference)
    judged = cut_lineage(normalize.judged_messages(stamped, ("topic_kind", "value_text")))
    typed = normalize.accepted(judged)
    relay = cut_lineage(normalize.relay_events(typed))
    store.append(typed.drop("topic_kind", "value_text"), "messages", batch)
    store.append(relay, "relay_state_events", batch)
    store.append(normalize.quarantined(judged), "quarantined_messages", batch)
    note_due(store, typed, relay, batch, reference_time)
    update_edges(store, typed, relay)
    refresh_touched(store, typed, relay, reference_time)


def start_ingest(
    store: Store,
    raw_stream: DataFrame,
    checkpoint: str,
    name: str = "stream",
    clock_now: Callable[[], datetime] = _now,
    **trigger,
) -> StreamingQuery:
    """Ingest a stream of raw messages (``schemas.RAW_MESSAGE`` columns)."""

    def each(raw: DataFrame, epoch: int) -> None:
        ingest_batch(store, raw, f"{name}-{epoch:012d}", clock_now())

    writer = raw_stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()


def inventory_batch(
    store: Store, raw: DataFrame, batch: str, reference_time: datetime | str
) -> None:
    """Record one batch's arrivals per topic; the overview is folded from them.

    Messages that cannot be counted go to quarantine.
    """
    inventory.check_not_folded(store, batch)
    reference = clock.instant_lit(clock.to_us(reference_time))
    stamped = raw if "committed_at" in raw.columns else raw.withColumn("committed_at", reference)
    store.append(
        normalize.topic_inventory(stamped, reference).withColumn("migrated", F.lit(None).cast("string")),
        "topic_arrivals",
        batch,
    )
    store.append(normalize.quarantined_topics(stamped), "quarantined_messages", batch)


def start_inventory(
    store: Store,
    raw_stream: DataFrame,
    checkpoint: str,
    name: str = "topics",
    clock_now: Callable[[], datetime] = _now,
    fold_every: int = 64,
    **trigger,
) -> StreamingQuery:
    """Count the topics of a stream; every ``fold_every`` batches the settled ones are folded.

    A checkpoint begun anew needs a ``name`` of its own.
    """

    def each(raw: DataFrame, epoch: int) -> None:
        inventory_batch(store, raw, f"{name}-{epoch:012d}", clock_now())
        if (epoch + 1) % fold_every == 0:
            inventory.fold_arrivals(store)

    writer = raw_stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()
