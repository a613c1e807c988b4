"""What a refresh reads: raw rows once for all widths, and no partition it does not need."""

import re
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.plans import refresh
from tidemark.sources.store import Store
from tidemark.streaming.ingest import ingest_batch

START = datetime(2024, 3, 1, tzinfo=timezone.utc)
RAW_TABLES = ("messages", "relay_state_events")
DATED = (*RAW_TABLES, "sample_edges", "relay_edges", "message_aggregates", "power_energy_reconciliation")


def raw(spark, rows):
    """(topic, payload, hours after START) as raw messages; relay topics are of kind status."""
    return spark.createDataFrame(
        [
            (t, p, START + timedelta(hours=h), '{"topic_kind":"status"}' if t.startswith("shellies") else "{}", START + timedelta(hours=h, seconds=1))
            for t, p, h in rows
        ],
        schemas.RAW_MESSAGE,
    )


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    store = Store(spark, str(tmp_path_factory.mktemp("refresh")))
    days = (0, 1, 4, 9, 10, 20)
    rows = [("sensors/a/power", str(d + h), 24 * d + h) for d in days for h in (1, 13)]
    rows += [("sensors/a/energy", str(10 * d), 24 * d + 2) for d in days]
    rows += [("sensors/b/text", "n/a", 24 * d + 3) for d in days] + [("shellies/a/relay/0", "on", 24 * 4 + 5)]
    ingest_batch(store, raw(spark, rows), "one", "2024-03-25 00:00:00")
    return store


@pytest.fixture
def plans(monkeypatch):
    """Plans of everything that is written or cut off during a test."""
    seen = []

    def spy(owner, name, position):
        real = getattr(owner, name)

        def run(*args, **kwargs):
            seen.append(args[position]._jdf.queryExecution().executedPlan().toString())
            return real(*args, **kwargs)

        monkeypatch.setattr(owner, name, run)

    spy(refresh, "cut_lineage", 0)
    spy(refresh.agg, "cut_lineage", 0)
    spy(refresh.rec, "cut_lineage", 0)
    spy(Store, "upsert", 1)
    return seen


def scans(plans, store, tables):
    return [
        line
        for plan in plans
        for line in plan.splitlines()
        if "FileScan parquet" in line and any(f"{store.root}/{t}" in line or f"/{t}," in line or f"/{t}]" in line for t in tables)
    ]


def test_a_range_reads_each_raw_table_once_a_family(spark, store, plans):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    refresh.refresh_range(store, "2024-03-25 00:00:00", "2024-03-02", "2024-03-06")
    assert len(scans(plans, store, ["messages"])) == 2
    assert len(scans(plans, store, ["relay_state_events"])) == 1


def test_late_data_reads_only_days_it_needs(spark, store, plans):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    late = raw(spark, [("sensors/a/power", "77", 24 * 4 + 6)])
    before = store.read("message_aggregates").where("metric_name = 'power' AND width = '24h'")
    old = {str(r.bucket_start.date()): r.refreshed_at for r in before.collect()}
    ingest_batch(store, late, "two", "2024-03-26 00:00:00")
    found = scans(plans, store, DATED)
    assert len(found) > 6
    for line in found:
        filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", line)
        assert filters and "_date" in filters.group(1), line
        # Neighbours lie on the second and the tenth of March, theirs on the first and the eleventh.
        assert "2024-03-21" not in filters.group(1), line
    after = store.read("message_aggregates").where("metric_name = 'power' AND width = '24h'")
    new = {str(r.bucket_start.date()): r.refreshed_at for r in after.collect()}
    assert {d for d in new if new[d] != old[d]} == {"2024-03-02", "2024-03-05", "2024-03-10"}


def test_index_of_days(store):
    rows = {(r.metric_name, r.present, r.sampled) for r in store.read("series_days").collect()}
    days = sum(1 << d for d in (0, 1, 4, 9, 10, 20))
    assert rows == {("power", days, days), ("energy", days, days), ("text", days, 0), ("relay_state", 1 << 4, 0)}
    assert [(r.present, r.sampled) for r in store.read("relay_days").collect()] == [(1 << 4, 1 << 4)]


def test_ledger_is_drained_by_minute(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    rows = [("sensors/a/power", "1", 10.01), ("sensors/a/power", "2", 10.4), ("shellies/a/relay/0", "on", 10.42)]
    ingest_batch(store, raw(spark, rows), "one", "2024-03-01 10:26:00")
    due = lambda: {r.due for r in store.read("due_buckets").select("due").distinct().collect()}
    assert due() == {"202403011026", "202403011027", "202403011030", "202403011100", "202403020000"}
    status = lambda metric: {
        (r.width, r.status) for r in store.read("message_aggregates").where(F.col("metric_name") == metric).collect()
    }
    assert status("relay_state") == set()
    refresh.close_buckets(store, "2024-03-01 10:30:00")
    assert due() == {"202403011100", "202403020000"}
    assert status("relay_state") == {("3m", "aggregated"), ("15m", "aggregated"), ("60m", "tba"), ("24h", "tba")}
    refresh.close_buckets(store, "2024-03-01 10:59:00")
    assert due() == {"202403011100", "202403020000"}
    refresh.close_buckets(store, "2024-03-02 00:00:00")
    assert due() == set()
    assert {s for m in ("power", "relay_state") for _, s in status(m)} == {"aggregated"}
    devices = store.read("power_energy_reconciliation")
    assert devices.where("status = 'tba'").count() == 0 < devices.count()


def test_a_batch_is_parsed_once(spark, tmp_path, monkeypatch):
    appended, real = [], Store.append

    def run(self, df, *args):
        appended.append(df._jdf.queryExecution().optimizedPlan().toString())
        return real(self, df, *args)

    monkeypatch.setattr(Store, "append", run)
    ingest_batch(Store(spark, str(tmp_path / "s")), raw(spark, [("sensors/a/power", "1", 1)]), "one", "2024-03-02 00:00:00")
    assert len(appended) > 2 and not any("parseJson" in plan for plan in appended)
