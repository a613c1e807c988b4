import pytest
from pyspark.sql import functions as F

from checks import fixture as fx
from checks.queries import _rules
from tests.helpers import message, messages
from tests.test_store import contents
from tidemark import schemas
from tidemark.operators.aggregates import message_aggregates
from tidemark.plans.migrate import RESET_TOKEN, Migration, slices
from tidemark.sources.store import Store

NOW = "2024-02-01 00:00:00"


def test_slices_clip_the_last():
    assert list(slices("2024-01-01", "2024-01-06", 2)) == [
        ("2024-01-01 00:00:00", "2024-01-03 00:00:00"),
        ("2024-01-03 00:00:00", "2024-01-05 00:00:00"),
        ("2024-01-05 00:00:00", "2024-01-06 00:00:00"),
    ]


def test_needs_a_legacy_table(spark, tmp_path):
    with pytest.raises(ValueError, match="no legacy tables"):
        Migration(Store(spark, str(tmp_path)), lambda name: None).dry_run("x", NOW)


def test_run_load_and_reset(spark, sf, tmp_path):
    store = Store(spark, str(tmp_path))
    legacy = {table: fx.legacy_table(spark, sf, kind) for kind, (table, _) in fx.LEGACY.items()}
    legacy[schemas.LEGACY_TOPICS] = fx.legacy_topics(spark, sf)
    runner = Migration(store, legacy.get)
    live = messages(spark, [message("live", "power", 0, 1)])
    store.append(live, "messages", "live")

    # Without rules everything is unmapped; mapping again replaces the rejects.
    first, second = runner.run_range("dump", "2024-01-01", "2024-01-31", NOW, fx.ZONE, batch_days=20)
    assert runner.summary(first).first().mapped_row_count == 0
    assert runner.top_unmapped(first).count() > 0
    store.upsert(_rules(spark, sf), "topic_mapping")
    report = {r.status: r.row_count for r in runner.apply(first, NOW).collect()}
    assert report["mapped"] > 0 and report["topic_mapped"] > 0
    rejected = store.read("rejected_messages").where(F.col("batch_id") == first).count()
    assert rejected == sum(n for s, n in report.items() if "mapped" not in s or "unmapped" in s)

    loaded, events, topics = runner.load(first, NOW)
    assert (loaded, topics) == (report["mapped"], report["topic_mapped"]) and events > 0
    assert runner.load_messages(first, "2024-02-01 01:00:00") == (0, 0)
    assert runner.summary(first).first().status == "loaded"
    # Only the second batch's slice carries no topics.
    assert runner.summary(second).first().topic_status_counts == "{}"

    raw = store.read("messages")
    stored = store.read("message_aggregates").where("width = '60m'")
    batch = message_aggregates(raw.where("ingest_batch <> 'live'"), "60m", NOW)
    drop = ("width", "bucket_date", "refreshed_at")
    assert contents(stored.drop(*drop)) == contents(batch.drop("refreshed_at"))

    runner.reset_batch(first, NOW)
    assert store.read("messages").count() == 1 and store.read("sample_edges").count() == 0
    row = runner.summary(first).first()
    assert (row.status, row.inserted_row_count) == ("mapped", 0)
    assert runner.load_messages(first, "2024-02-02 00:00:00") == (loaded, events)

    with pytest.raises(ValueError):
        runner.reset_all("yes")
    runner.reset_all(RESET_TOKEN)
    assert [r.device_id for r in store.read("messages").collect()] == ["live"]
    for name in ("import_batches", "staged_messages", "staged_topics", "rejected_messages"):
        assert store.read(name).count() == 0
    assert store.topic_overview().count() == 0


def _rule(spark, target=r"sensors/\1"):
    columns = "priority int, source_table string, rule_type string, source_pattern string, target_topic string, target_kind string, notes string"
    kinds = [("public.mqtt_power", "measurement"), ("public.mqtt_status", "status")]
    return spark.createDataFrame([(1, t, "regex", "^old/(.*)$", target, k, None) for t, k in kinds], columns)


def _power(spark, days):
    rows = [(f"2024-01-{d:02d} 10:00:0{i}", "old/dev/power", "W", str(i)) for d in days for i in range(4)]
    rows = spark.createDataFrame(rows, "created_at string, topic string, unit string, payload string")
    return rows.withColumn("created_at", F.col("created_at").cast("timestamp_ntz"))


def _load(runner, batch):
    """Load and refresh; what the tables then hold."""
    assert runner.load_messages(batch, NOW)[0] == 4
    runner.refresh(batch, NOW)
    summary = runner.summary(batch).first()
    assert (summary.status, summary.inserted_row_count) == ("refreshed", 4)
    assert "open_load" not in runner._notes(batch)
    tables = ("messages", "sample_edges", "message_aggregates", "staged_messages")
    return [contents(runner.store.read(t).drop("updated_at")) for t in tables]


@pytest.fixture(scope="module")
def undisturbed(spark, tmp_path_factory):
    runner = Migration(Store(spark, str(tmp_path_factory.mktemp("whole"))), {"public.mqtt_power": _power(spark, (3,))}.get)
    runner.import_rules(_rule(spark))
    return _load(runner, runner.dry_run("x", NOW))


@pytest.mark.parametrize("crash", ["update_edges", "_recount"])
def test_interrupted_load_is_taken_up_again(spark, tmp_path, monkeypatch, undisturbed, crash):
    from tidemark.plans import migrate

    runner = Migration(Store(spark, str(tmp_path)), {"public.mqtt_power": _power(spark, (3,))}.get)
    runner.import_rules(_rule(spark))
    batch = runner.dry_run("x", NOW)

    def stop(*_, **__):
        raise RuntimeError("stopped")

    with monkeypatch.context() as patch, pytest.raises(RuntimeError):
        patch.setattr(migrate if crash == "update_edges" else runner, crash, stop)
        runner.load_messages(batch, NOW)
    assert runner.store.read("messages").count() == 4
    assert _load(runner, batch) == undisturbed
    assert runner.load_messages(batch, NOW) == (0, 0)


def test_staging_an_empty_slice_replaces_the_old_one(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    runner = Migration(store, {"public.mqtt_power": _power(spark, (3, 4))}.get)
    batch = runner.dry_run("x", NOW)
    assert store.read("staged_messages").count() == 8
    runner.stage(batch, NOW, "2023-01-01", "2023-01-02")
    assert store.read("staged_messages").count() == 0
    row = store.read("import_batches").first()
    assert (row.staged_row_count, row.source_min_at, row.source_max_at) == (0, None, None)


def test_range_runs_to_its_end_or_tells_where_it_stopped(spark, tmp_path):
    runner = Migration(Store(spark, str(tmp_path)), lambda name: None)
    seen = []
    runner.dry_run = lambda name, now, zone, lo, hi, topics, notes: seen.append((lo, topics)) or len(seen)
    done = runner.run_range("x", "2024-01-01", "2024-05-30", NOW)
    assert (len(done), done.stopped_at) == (150, None)
    assert [t for _, t in seen].count(True) == 1
    short = runner.run_range("x", "2024-01-01", "2024-05-30", NOW, max_batches=7)
    assert (len(short), short.stopped_at) == (7, "2024-01-08 00:00:00")


def test_remap_reports(spark, tmp_path):
    runner = Migration(Store(spark, str(tmp_path)), {"public.mqtt_power": _power(spark, (3,))}.get)
    batch = runner.dry_run("x", NOW)
    assert runner.top_unmapped(batch).count() == 1
    report = runner.remap(batch, NOW, _rule(spark))
    assert [(r.status, r.row_count) for r in report["status"].collect()] == [("mapped", 4)]
    assert report["unmapped"].count() == 0 and report["summary"].first().mapped_row_count == 4


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_loads_compare_stored_keys_and_parse_only_older_files(spark, tmp_path):
    from tidemark.functions import twins

    store = Store(spark, str(tmp_path / "store"))
    runner = Migration(store, {"public.mqtt_power": _power(spark, (3, 4))}.get)
    runner.import_rules(_rule(spark))
    batch = runner.dry_run("x", NOW)
    assert runner.load_messages(batch, NOW)[0] == 8
    again = runner.dry_run("y", NOW)
    assert runner.load_messages(again, "2024-02-01 01:00:00") == (0, 0)
    assert not set(twins.KEYS.fieldNames()) & set(store.read("messages").columns)

    stored = store.read("messages", twin_keys=True)
    assert stored.where("twin_a IS NOT NULL AND twin_walled").count() == 8
    keyed, older = twins.stored_keys(stored, "received_at"), stored.where("twin_walled IS NULL")
    scans = [line for line in _plan(keyed).split("\n") if "FileScan" in line]
    assert len(scans) == 2 and [("metadata" in line.split("ReadSchema")[1]) for line in scans] == [False, True]
    assert "IsNull(twin_walled)" in scans[1] and older.count() == 0


def test_rows_without_keys_are_twins_by_what_they_hold(spark, tmp_path):
    from tidemark.functions import twins

    meta = '{"source_table":"t","source_topic":"s"%s}'
    rows = [
        (1, "a", meta % ""),
        (2, "b", meta % ',"source_created_at":"w"'),
        (3, "c", "{}"),
        (4, "d", '{"source\\u005ftable":"t","source_topic":"s"}'),
        (5, "e", '{"source_table":"t","source_topic":null}'),
        (6, "f", '{"source_table":"t"} x'),
    ]
    df = spark.createDataFrame(rows, "n int, payload string, metadata string").select(
        F.timestamp_seconds("n").alias("received_at"), F.lit("topic").alias("topic"), "payload", "metadata"
    )
    keys = sorted(map(tuple, twins.stored_keys(df, "received_at").collect()))
    assert sorted((w or "", walled) for _, _, w, walled in keys) == [("", False), ("", False), ("w", True)]
    # Two kinds of file in one table: rows with keys beside rows without.
    with_keys = twins.with_keys(df.where("payload < 'c'"), "received_at")
    with_keys.write.parquet(str(tmp_path / "k"))
    df.where("payload >= 'c'").write.mode("append").parquet(str(tmp_path / "k"))
    mixed = spark.read.schema(with_keys.schema).parquet(str(tmp_path / "k"))
    assert sorted(map(tuple, twins.stored_keys(mixed, "received_at").collect())) == keys


def test_rows_from_elsewhere_are_written_once(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path))
    runner = Migration(store, {"public.mqtt_power": _power(spark, (3, 4))}.get)
    runner.import_rules(_rule(spark))
    twice = []
    replace = Store.replace_partitions
    monkeypatch.setattr(Store, "replace_partitions", lambda self, df, name: (twice.append(name), replace(self, df, name)))
    batch = runner.create_batch("dump", NOW)
    runner.stage(batch, NOW)
    assert not twice and store.read("staged_messages").count() == _power(spark, (3, 4)).count()
    runner.apply(batch, NOW)
    # Mapped rows come from the table itself.
    assert "rejected_messages" not in twice and "staged_messages" in twice


def test_what_a_load_writes_aside_goes_with_it(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    with store.aside(_power(spark, (3,))) as rows:
        assert contents(rows) == contents(_power(spark, (3,))) and list((tmp_path / "_aside").iterdir())
    with pytest.raises(RuntimeError), store.aside(_power(spark, (3,))):
        raise RuntimeError
    assert not list((tmp_path / "_aside").iterdir())
