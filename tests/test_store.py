"""Tables on disk: ingest with late data, replay, upsert, retention."""

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from checks import fixture as fx
from checks.compare import rows_of
from tests.helpers import messages, message
from tidemark import schemas
from tidemark.operators.aggregates import message_aggregates
from tidemark.operators.reconcile import power_energy_reconciliation
from tidemark.plans.refresh import close_buckets, refresh_range
from tidemark.sources import inventory
from tidemark.sources.retention import oldest_day
from tidemark.sources.store import Store
from tidemark.streaming.ingest import ingest_batch, inventory_batch, start_ingest, start_inventory

END = "2024-01-31 00:00:00"


def contents(df):
    return rows_of(df.columns, [tuple(r) for r in fx.for_compare(df).collect()])[0]


def assert_fixed_point(store):
    """Stored rows equal the batch functions over the raw tables."""
    raw, relay = store.read("messages"), store.read("relay_state_events")
    for width in schemas.WIDTHS:
        this = F.col("width") == width
        extra = ("width", "bucket_date", "refreshed_at")
        stored = store.read("message_aggregates").where(this).drop(*extra)
        batch = message_aggregates(raw, width, END).drop("refreshed_at")
        assert contents(stored) == contents(batch), width
        stored = store.read("power_energy_reconciliation").where(this).drop(*extra)
        batch = power_energy_reconciliation(raw, relay, width, END).drop("refreshed_at")
        assert contents(stored) == contents(batch), width


@pytest.fixture(scope="module")
def raw(spark, sf, tmp_path_factory):
    """The traffic in two files: on time, and with a seventh arriving late."""
    folder = tmp_path_factory.mktemp("raw")
    rows = fx.raw_messages(spark, sf)
    late = F.pmod(F.hash("topic", "payload", "received_at"), F.lit(7)) == 0
    first = (F.col("received_at") < F.lit("2024-01-16").cast("timestamp")) & ~late
    rows.where(first).coalesce(1).write.parquet(str(folder / "a"))
    rows.where(~first).coalesce(1).write.parquet(str(folder / "b"))
    return folder


def test_stream_with_late_data_equals_batch(spark, raw, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    stops = iter(["2024-01-16 00:00:00", END, END])
    for part in "ab":
        for start in (start_ingest, start_inventory):
            if start is start_ingest:
                moment = next(stops)
            stream = spark.readStream.schema(schemas.RAW_MESSAGE).parquet(str(raw / part))
            query = start(
                store,
                stream,
                str(tmp_path / f"{start.__name__}-{part}"),
                name=part,
                clock_now=lambda m=moment: datetime.fromisoformat(m).replace(tzinfo=timezone.utc),
                availableNow=True,
            )
            query.awaitTermination()
            assert query.exception() is None
    everything = spark.read.schema(schemas.RAW_MESSAGE).parquet(str(raw / "a"), str(raw / "b"))
    # A batch repeated after a failure replaces its own rows.
    again = spark.read.schema(schemas.RAW_MESSAGE).parquet(str(raw / "b"))
    ingest_batch(store, again, "b-000000000000", END)
    close_buckets(store, END)
    quarantined = store.read("quarantined_messages").count()
    assert quarantined > 0
    assert store.read("messages").count() + quarantined == everything.count()
    assert_fixed_point(store)
    overview = store.topic_overview()
    assert overview.agg(F.sum("message_count")).first()[0] == everything.count() - quarantined

    refresh_range(store, END)
    assert_fixed_point(store)
    rows = store.read("message_aggregates").count()
    refresh_range(store, END, "2024-01-10", "2024-01-12", ["60m"])
    assert store.read("message_aggregates").count() == rows


def test_upsert_replaces_by_key(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    def row(i, name):
        at = datetime(2024, 1, 1, tzinfo=timezone.utc)
        return (i, name, "UTC", None, None, "created", 0, 0, 0, 0, "{}", at, at)

    def frame(*rows):
        return spark.createDataFrame([row(*r) for r in rows], schemas.IMPORT_BATCH)

    store.upsert(frame((1, "a"), (2, "b")), "import_batches")
    store.upsert(frame((2, "c"), (3, "d")), "import_batches")
    got = {(r.batch_id, r.dump_name) for r in store.read("import_batches").collect()}
    assert got == {(1, "a"), (2, "c"), (3, "d")}


def test_retention_drops_whole_days(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    rows = [message("d", "m", s, 1) for s in (0, 86400, 2 * 86400)]
    store.append(messages(spark, rows), "messages", "one")
    store.prune_raw("2025-03-02 15:00:00")
    days = {str(r.received_date) for r in store.read("messages").collect()}
    assert days == {"2024-03-02", "2024-03-03"}
    assert oldest_day("2025-02-28 00:00:00", 12) == "2024-02-28"
    assert oldest_day("2024-02-29 00:00:00", 12) == "2023-02-28"
    assert store.missing_tables(["messages", "sample_edges"]) == ["sample_edges"]


def arrivals(spark, *rows):
    return spark.createDataFrame(rows, "topic string, payload string, at string, metadata string").select(
        "topic", "payload", F.col("at").cast("timestamp").alias("received_at"), "metadata"
    )


def test_inventory_folds_settled_batches(spark, tmp_path):
    store = Store(spark, str(tmp_path))

    def arrive(stream, epoch, *topics):
        moment = f"2024-01-0{epoch + 1} 00:00:00"
        rows = [(t, f"{stream}{epoch}", moment, f'{{"event_id": "{stream}{epoch}"}}') for t in topics]
        inventory_batch(store, arrivals(spark, *rows), f"{stream}-{epoch:012d}", moment)

    def unread():
        """Batches that the overview does not read as arrivals."""
        files = store.topic_overview().inputFiles()
        return {e for e in range(5) if not any(f"ingest_batch=a-{e:012d}" in f for f in files)}

    for epoch in range(3):
        arrive("a", epoch, "t/1", "t/1", f"t/{epoch + 2}")
    arrive("b", 0, "t/1")
    loaded = store.topic_overview().where("topic = 't/1'").withColumn("last_payload", F.lit("old"))
    later = loaded.withColumns({"refreshed_at": F.lit("2024-01-09").cast("timestamp"), "message_count": F.lit(10).cast("long")})
    store.append(later.withColumn("migrated", F.lit("1")), "topic_arrivals", "migration-1-1704700000000000")

    before = contents(store.topic_overview())
    assert unread() == {3, 4}
    assert inventory.fold_arrivals(store) == 2
    assert contents(store.topic_overview()) == before
    assert unread() == {0, 1, 3, 4}
    assert inventory.fold_arrivals(store) == 0
    # The newest batch of a stream may come again; one in a snapshot may not.
    arrive("a", 2, "t/1", "t/1", "t/4")
    assert contents(store.topic_overview()) == before
    with pytest.raises(ValueError):
        arrive("a", 1, "t/1")

    arrive("a", 3, "t/1")
    arrive("a", 4, "t/9")
    row = store.topic_overview().where("topic = 't/1'").first()
    assert (row.message_count, row.last_payload, row.last_event_id) == (18, "old", "a3")
    before = contents(store.topic_overview())
    assert inventory.fold_arrivals(store) == 2
    assert contents(store.topic_overview()) == before
    arrive("a", 5, "t/1")
    assert inventory.fold_arrivals(store) == 1
    # Folders are bounded: of snapshots two are left, of arrivals those after the marks of the one before.
    assert len(store.partition_folders("topic_folds", "version", lambda v: True)) == 2
    left = store.partition_folders("topic_arrivals", "ingest_batch", lambda tag: tag.startswith("a-"))
    assert [f[-1] for f in left] == ["4", "5"]


def test_unfinished_snapshot_does_not_count(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path))
    for epoch in range(2):
        row = ("t", "x", "2024-01-01", "{}")
        inventory_batch(store, arrivals(spark, row), f"a-{epoch:012d}", f"2024-01-0{epoch + 1}")
    add = store.add_partitions

    def stop(df, name):
        if name == "topic_marks":
            raise RuntimeError("lost")
        add(df, name)

    monkeypatch.setattr(store, "add_partitions", stop)
    with pytest.raises(RuntimeError):
        inventory.fold_arrivals(store)
    assert store.topic_overview().first().message_count == 2
    monkeypatch.undo()
    assert inventory.fold_arrivals(store) == 1
    assert store.topic_overview().first().message_count == 2


def test_reset_of_a_folded_inventory(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    for epoch in range(3):
        rows = [(t, "x", "2024-01-01", "{}") for t in ("keep", "drop")]
        inventory_batch(store, arrivals(spark, *rows), f"a-{epoch:012d}", f"2024-01-0{epoch + 1}")
    assert inventory.fold_arrivals(store) == 2
    inventory.keep_topics(store, spark.createDataFrame([("keep",)], "topic string"))
    assert [(r.topic, r.message_count) for r in store.topic_overview().collect()] == [("keep", 3)]
    inventory.keep_topics(store, spark.createDataFrame([], "topic string"))
    assert store.topic_overview().count() == 0
