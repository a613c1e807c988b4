"""The registered queries, by name."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import cache, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixture as fx
from tidemark import schemas
from tidemark.functions import clock
from tidemark.operators import contracts, migration, normalize, reports, rules
from tidemark.operators.aggregates import message_aggregates
from tidemark.operators.reconcile import power_energy_reconciliation
from tidemark.plans import refresh
from tidemark.plans.migrate import Migration
from tidemark.sources.checkpoints import cut_lineage, ensure_checkpoint_dir
from tidemark.sources.retention import within_retention
from tidemark.sources.store import Store
from tidemark.streaming.ingest import ingest_batch

REF = fx.REFERENCE_TIME
RANGE = ("2024-01-10 05:30:00", "2024-01-20 17:45:00")
NOW = "2024-02-01 00:00:00"
# When the first of two ingested batches ends, inside a bucket of every width.
HALFWAY = "2024-01-16 10:31:00"

SERIES = ["bucket_start", "device_id", "metric_name"]
BASE = SERIES + """bucket_end topic sample_count numeric_count numeric_avg numeric_min numeric_max
    numeric_median numeric_p25 numeric_p75 numeric_variance_samp numeric_stddev_samp numeric_stderr
    numeric_ci95_lower numeric_ci95_upper first_received_at last_received_at status""".split()
BOUNDARY = SERIES + """locf_value_at_bucket_start locf_value_at_bucket_end
    linear_value_at_bucket_start linear_value_at_bucket_end""".split()
WEIGHTED = SERIES + ["locf_time_weighted_avg", "linear_time_weighted_avg"]
GAPS = SERIES + """interval_gap_count interval_gap_avg_seconds interval_gap_stddev_seconds
    interval_gap_cv""".split()
RELAY = """bucket_start device_id relay_on_seconds relay_off_seconds relay_on_pct relay_off_pct
    relay_event_count relay_state_known""".split()

Query = Callable[[SparkSession, str], DataFrame]


def _aggregates(width: str, columns: list[str] | None = None, bounds=(None, None)) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = message_aggregates(fx.messages(spark, sf_dir), width, REF, *bounds)
        return fx.for_compare(out.select(*columns) if columns else out)

    return run


def _reconciliation(width: str, columns: list[str] | None = None, bounds=(None, None)) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = power_energy_reconciliation(
            fx.messages(spark, sf_dir), fx.relay(spark, sf_dir), width, REF, *bounds
        )
        return fx.for_compare(out.select(*columns) if columns else out)

    return run


def normalize_messages(spark, sf_dir):
    return fx.for_compare(normalize.normalize_messages(fx.raw_messages(spark, sf_dir), ("topic_kind",)))


def quarantined_messages(spark, sf_dir):
    return fx.for_compare(normalize.quarantined_messages(fx.raw_messages(spark, sf_dir)))


def quarantined_topics(spark, sf_dir):
    return fx.for_compare(normalize.quarantined_topics(fx.raw_messages(spark, sf_dir)))


def relay_events(spark, sf_dir):
    typed = normalize.normalize_messages(fx.raw_messages(spark, sf_dir), ("value_text",))
    return fx.for_compare(normalize.relay_events(typed))


def _inventory(spark, sf_dir):
    return normalize.topic_inventory(
        fx.raw_messages(spark, sf_dir), clock.instant_lit(clock.to_us(NOW))
    )


def topic_inventory(spark, sf_dir):
    return fx.for_compare(_inventory(spark, sf_dir))


def topic_inventory_merge(spark, sf_dir):
    """Two arrivals in sequence must equal one."""
    raw = fx.raw_messages(spark, sf_dir)
    now = clock.instant_lit(clock.to_us(NOW))
    half = F.col("committed_at") < F.lit("2024-01-15 00:00:00").cast("timestamp")
    first = normalize.topic_inventory(raw.where(half), now)
    second = normalize.topic_inventory(raw.where(~half), now)
    return fx.for_compare(normalize.merge_topic_inventory(first, second))


def retained_messages(spark, sf_dir):
    """Raw rows kept a year after mid-January, by series."""
    kept = within_retention(fx.messages(spark, sf_dir), "received_at", "2025-01-15 10:00:00")
    return fx.for_compare(
        kept.groupBy("device_id", "metric_name").agg(
            F.count(F.lit(1)).alias("row_count"), F.min("received_at").alias("oldest")
        )
    )


def latest_messages(spark, sf_dir):
    typed = normalize.normalize_messages(fx.raw_messages(spark, sf_dir))
    return fx.for_compare(reports.latest_messages(typed))


def trace_latency(spark, sf_dir):
    typed = normalize.normalize_messages(fx.raw_messages(spark, sf_dir))
    return fx.for_compare(reports.trace_latency(typed))


def latest_topics(spark, sf_dir):
    return fx.for_compare(reports.latest_topics(_inventory(spark, sf_dir)))


def _latest_aggregates(width: str) -> Query:
    def run(spark, sf_dir):
        out = message_aggregates(fx.messages(spark, sf_dir), width, REF)
        return fx.for_compare(reports.latest_aggregates(out))

    return run


def latest_reconciliation_3m(spark, sf_dir):
    out = power_energy_reconciliation(fx.messages(spark, sf_dir), fx.relay(spark, sf_dir), "3m", REF)
    return fx.for_compare(reports.latest_reconciliation(out))


def recommended_24h(spark, sf_dir):
    out = message_aggregates(fx.messages(spark, sf_dir), "24h", REF)
    return fx.for_compare(
        reports.recommended(out).select(*SERIES, "numeric_count", "quality_score", "quality_flags")
    )


def quality_bands_60m(spark, sf_dir):
    return reports.quality_bands(message_aggregates(fx.messages(spark, sf_dir), "60m", REF))


def contract_violations(spark, sf_dir):
    messages, relay = fx.messages(spark, sf_dir), fx.relay(spark, sf_dir)
    staged, topics = _mapped(spark, sf_dir)
    checks = [
        contracts.aggregate_checks(message_aggregates(messages, "60m", REF), "60m"),
        contracts.reconciliation_checks(
            power_energy_reconciliation(messages, relay, "60m", REF), "60m"
        ),
        contracts.message_checks(messages),
        contracts.relay_checks(relay),
        contracts.rule_checks(_rules(spark, sf_dir)),
        contracts.staged_checks(staged),
        contracts.reject_checks(migration.rejects(staged, topics)),
        contracts.retention_checks(
            messages,
            "received_at",
            F.lit("2024-01-15 00:00:00").cast("timestamp"),
            "messages_at_mid_january",
        ),
    ]
    return reduce(DataFrame.unionByName, checks)


# --- migration ---------------------------------------------------------------


def _rule_rows(spark, sf_dir) -> DataFrame:
    generated = rules.device_rules(fx.device_table(spark, sf_dir))
    aliases = fx.device_table(spark, sf_dir).select(
        F.concat(F.lit("alias-"), F.col("`<new-mqtt-device-name>`")).alias("old"),
        F.col("`<new-mqtt-device-name>`").alias("new"),
        F.lit("Explicit historical alias").alias("notes"),
        "row_number",
    ).where("row_number < 1000000")
    return rules.alias_rules(generated, aliases).unionByName(rules.skip_rules(spark))


def _rules(spark, sf_dir) -> DataFrame:
    """The rule table; like the staged rows below it is stored between steps."""
    none = spark.createDataFrame([], schemas.TOPIC_RULE)
    return cut_lineage(rules.import_rules(none, _rule_rows(spark, sf_dir)))


def _staged(spark, sf_dir, bounds=(None, None)) -> DataFrame:
    tables = [
        migration.stage_table(fx.legacy_table(spark, sf_dir, kind), fx.BATCH_ID, table, *bounds)
        for kind, (table, _) in fx.LEGACY.items()
    ]
    return reduce(DataFrame.unionByName, tables)


def _mapped(spark, sf_dir):
    staged = cut_lineage(_staged(spark, sf_dir))
    topics = migration.stage_topics(fx.legacy_topics(spark, sf_dir), fx.BATCH_ID, "position")
    found = _rules(spark, sf_dir)
    return migration.apply_rules(staged, found, fx.ZONE), migration.apply_rules(topics, found)


def rules_from_devices(spark, sf_dir):
    return _rule_rows(spark, sf_dir).drop("position")


def imported_rules(spark, sf_dir):
    """Importing the same rules twice adds only those without a target again."""
    once = _rules(spark, sf_dir)
    return rules.import_rules(once, _rule_rows(spark, sf_dir))


def stage_range(spark, sf_dir):
    staged = _staged(spark, sf_dir, RANGE)
    return fx.for_compare(
        staged.groupBy("batch_id", "source_table").agg(
            F.count(F.lit(1)).alias("row_count"),
            F.min("source_created_at").alias("first_at"),
            F.max("source_created_at").alias("last_at"),
        )
    )


def apply_rules(spark, sf_dir):
    staged, _ = _mapped(spark, sf_dir)
    return fx.for_compare(
        staged.select(
            "source_table",
            "source_created_at",
            "source_topic",
            "source_payload",
            "mapped_topic",
            "mapped_kind",
            "validation_status",
            "validation_error",
            "production_received_at",
        )
    )


def apply_rules_topics(spark, sf_dir):
    _, topics = _mapped(spark, sf_dir)
    return topics.select(
        "staged_topic_id", "source_topic", "source_payload", "mapped_topic", "mapped_kind",
        "validation_status", "validation_error",
    )


def status_report(spark, sf_dir):
    return migration.status_report(*_mapped(spark, sf_dir))


def rejected_rows(spark, sf_dir):
    return migration.rejects(*_mapped(spark, sf_dir)).groupBy(
        "batch_id", "source_table", "source_topic", "reason"
    ).agg(F.count(F.lit(1)).alias("row_count"), F.count("staged_message_id").alias("messages"))


def _loaded_before(staged: DataFrame) -> DataFrame:
    """What an earlier batch loaded: the first half of January. Early rows of it
    do not record their source time."""
    at = F.col("source_created_at")
    early = F.col("received_at") < F.lit("2024-01-08 00:00:00").cast("timestamp")
    half = staged.where(at < F.lit("2024-01-15 00:00:00").cast("timestamp_ntz"))
    plain = F.regexp_replace("metadata", r'"source_created_at":"[^"]*",', "")

    def forget(df: DataFrame, time_column: str) -> DataFrame:
        renamed = df.withColumn("received_at", F.col(time_column))
        return renamed.withColumn("metadata", F.when(early, plain).otherwise(F.col("metadata")))

    return half, forget


def load_messages(spark, sf_dir):
    staged, _ = _mapped(spark, sf_dir)
    half, forget = _loaded_before(staged)
    none = staged.sparkSession.createDataFrame([], schemas.MESSAGE)
    existing = forget(
        migration.to_messages(migration.message_candidates(half, none), NOW), "received_at"
    )
    new = migration.to_messages(migration.message_candidates(staged, existing), NOW)
    return fx.for_compare(
        new.select(
            "received_at", "topic", "device_id", "metric_name", "payload", "numeric_value", "metadata"
        )
    )


def load_relay_events(spark, sf_dir):
    staged, _ = _mapped(spark, sf_dir)
    half, forget = _loaded_before(staged)
    none = staged.sparkSession.createDataFrame([], schemas.RELAY_EVENT)
    existing = forget(
        migration.to_relay_events(migration.relay_candidates(half, none), NOW), "event_at"
    )
    new = migration.to_relay_events(migration.relay_candidates(staged, existing), NOW)
    return fx.for_compare(
        new.select("event_at", "topic", "device_id", "relay_index", "state", "is_on", "payload")
    )


def load_topics(spark, sf_dir):
    """The snapshot loaded over the inventory of the live traffic."""
    _, topics = _mapped(spark, sf_dir)
    loaded = migration.latest_topics(migration.topic_candidates(topics), NOW)
    return fx.for_compare(migration.merge_loaded_topics(_inventory(spark, sf_dir), loaded))


def _batches(spark, sf_dir, staged, topics) -> DataFrame:
    counted = migration.batch_counters(staged, topics, fx.ZONE)
    at = clock.instant_lit(clock.to_us(NOW))
    return schemas.conform(
        counted.withColumns(
            {
                "dump_name": F.lit("history"),
                "source_timezone": F.lit(fx.ZONE),
                "status": F.lit("mapped"),
                "metadata": F.lit("{}"),
                "created_at": at,
                "updated_at": at,
            }
        ),
        schemas.IMPORT_BATCH,
    )


def batch_summary(spark, sf_dir):
    staged, topics = _mapped(spark, sf_dir)
    return fx.for_compare(
        migration.batch_summary(_batches(spark, sf_dir, staged, topics), staged, topics)
    )


def top_unmapped(spark, sf_dir):
    unmapped = migration.top_unmapped_topics(*_mapped(spark, sf_dir))
    return fx.for_compare(reports.top_unmapped(unmapped, fx.BATCH_ID))


def loaded_by_series(spark, sf_dir):
    staged, _ = _mapped(spark, sf_dir)
    none = spark.createDataFrame([], schemas.MESSAGE)
    loaded = migration.to_messages(migration.message_candidates(staged, none), NOW)
    return migration.loaded_by_series(loaded, fx.BATCH_ID)


def loaded_relay_states(spark, sf_dir):
    staged, _ = _mapped(spark, sf_dir)
    none = spark.createDataFrame([], schemas.RELAY_EVENT)
    loaded = migration.to_relay_events(migration.relay_candidates(staged, none), NOW)
    return migration.loaded_relay_states(loaded, fx.BATCH_ID)


def reset_batch(spark, sf_dir):
    """Live traffic and a loaded batch; resetting the batch leaves the traffic."""
    staged, _ = _mapped(spark, sf_dir)
    none = spark.createDataFrame([], schemas.MESSAGE)
    loaded = migration.to_messages(migration.message_candidates(staged, none), NOW)
    live = normalize.normalize_messages(fx.raw_messages(spark, sf_dir))
    kept = migration.without_batch(live.unionByName(loaded), fx.BATCH_ID)
    return kept.groupBy("device_id", "metric_name").agg(F.count(F.lit(1)).alias("row_count"))


def touched_buckets(spark, sf_dir):
    """Buckets a message touches at the four widths (status messages: none of
    the sensor aggregates)."""
    from tidemark.streaming.touched import touched_series_buckets

    typed = normalize.normalize_messages(fx.raw_messages(spark, sf_dir), ("topic_kind",))
    all_widths = [
        touched_series_buckets(typed, width).withColumn("width", F.lit(width))
        for width in schemas.WIDTHS
    ]
    return fx.for_compare(
        reduce(DataFrame.unionByName, all_widths).select(
            "width", "device_id", "metric_name", clock.instant("bucket_us").alias("bucket_start")
        )
    )


# --- on a store ----------------------------------------------------------------


def _store(spark) -> Store:
    """An empty store below the shared checkpoint folder."""
    ensure_checkpoint_dir(spark)
    return Store(spark, f"{spark.sparkContext.getCheckpointDir()}/store-{uuid.uuid4().hex}")


def _halves(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """The traffic in two batches: what arrives by HALFWAY, and the rest with a
    seventh of the first half, which is late."""
    raw = fx.raw_messages(spark, sf_dir)
    late = F.pmod(F.unix_micros("committed_at"), F.lit(7)) == 0
    first = (F.col("received_at") < F.lit(HALFWAY).cast("timestamp")) & ~late
    return raw.where(first), raw.where(~first)


@cache
def _ingested(spark, sf_dir) -> Store:
    """A store after both batches and the minute job; made once a session."""
    store = _store(spark)
    for raw, at in zip(_halves(spark, sf_dir), (HALFWAY, NOW), strict=True):
        ingest_batch(store, raw, f"batch-{at[:10]}", at)
    refresh.close_buckets(store, NOW)
    return store


def fixed_point_after_ingest(spark, sf_dir):
    """Stored aggregates of all widths, status series included, without any full refresh."""
    rows = _ingested(spark, sf_dir).read("message_aggregates")
    return fx.for_compare(rows.drop("bucket_date", "refreshed_at"))


def reconciled_after_ingest(spark, sf_dir):
    rows = _ingested(spark, sf_dir).read("power_energy_reconciliation")
    return fx.for_compare(rows.drop("bucket_date", "refreshed_at"))


def refreshed_range(spark, sf_dir):
    """Both derived tables of a range recomputed in a store that has raw rows and edges only."""
    store = _store(spark)
    typed = cut_lineage(normalize.normalize_messages(fx.raw_messages(spark, sf_dir), ("topic_kind", "value_text")))
    relay = cut_lineage(normalize.relay_events(typed))
    store.append(typed.drop("topic_kind", "value_text"), "messages", "all")
    store.append(relay, "relay_state_events", "all")
    refresh.update_edges(store, typed, relay)
    refresh.refresh_range(store, REF, *RANGE)
    counted = store.read("message_aggregates").groupBy("width", "metric_name").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("sample_count").alias("samples"),
        F.sum("interval_gap_count").alias("gaps"), F.min("bucket_start").alias("first"), F.max("bucket_start").alias("last"),
    )
    devices = store.read("power_energy_reconciliation").groupBy("width").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("energy_numeric_count").alias("samples"),
        F.sum("relay_event_count").alias("gaps"), F.min("bucket_start").alias("first"), F.max("bucket_start").alias("last"),
    )
    return fx.for_compare(counted.unionByName(devices.withColumn("metric_name", F.lit("(device)"))))


def due_buckets(spark, sf_dir):
    """The ledger after the first batch: what falls due, and when."""
    store = _store(spark)
    first, _ = _halves(spark, sf_dir)
    typed = cut_lineage(normalize.normalize_messages(first, ("topic_kind", "value_text")))
    refresh.note_due(store, typed, normalize.relay_events(typed), "first", HALFWAY)
    due = store.read("due_buckets")
    return due.groupBy("due", "width", "metric_name", "touched").agg(
        F.count(F.lit(1)).alias("buckets"), F.countDistinct("device_id").alias("devices")
    )


# A range run: slices of twelve days, the last one clipped.
SLICES = ("2024-01-05", "2024-01-22", 12)


@cache
def _range_run(spark, sf_dir) -> Migration:
    """The legacy tables staged and mapped slice by slice; the last slice loaded."""
    legacy = {table: fx.legacy_table(spark, sf_dir, kind) for kind, (table, _) in fx.LEGACY.items()}
    legacy[schemas.LEGACY_TOPICS] = fx.legacy_topics(spark, sf_dir)
    runner = Migration(_store(spark), legacy.get)
    runner.import_rules(_rule_rows(spark, sf_dir))
    start, end, days = SLICES
    batches = runner.run_range("history", start, end, NOW, fx.ZONE, batch_days=days)
    runner.load_messages(batches[-1], NOW)
    return runner


def range_run_staged(spark, sf_dir):
    """Staged rows of each slice by table and status; the topics go with the first."""
    store = _range_run(spark, sf_dir).store
    rows = store.read("staged_messages").select("batch_id", "source_table", "validation_status")
    topics = store.read("staged_topics").select("batch_id", F.lit("(topics)").alias("source_table"), "validation_status")
    # Loaded rows were mapped ones.
    status = F.when(F.col("validation_status") == "inserted", "mapped").otherwise(F.col("validation_status"))
    return (
        rows.unionByName(topics)
        .groupBy("batch_id", "source_table", status.alias("status"))
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


def range_run_loaded(spark, sf_dir):
    """What loading the last slice left in the raw tables."""
    store = _range_run(spark, sf_dir).store
    messages = store.read("messages").select("device_id", "metric_name", F.lit(None).cast("string").alias("state"), F.col("received_at").alias("at"))
    events = store.read("relay_state_events").select("device_id", F.lit("(relay)").alias("metric_name"), "state", F.col("event_at").alias("at"))
    return fx.for_compare(
        messages.unionByName(events).groupBy("device_id", "metric_name", "state").agg(
            F.count(F.lit(1)).alias("row_count"), F.min("at").alias("first_at"), F.max("at").alias("last_at")
        )
    )


def range_run_batches(spark, sf_dir):
    """The control rows of the slices: status, counters and bounds."""
    rows = _range_run(spark, sf_dir).store.read("import_batches")
    return rows.select("batch_id", "dump_name", "status", "staged_row_count", "mapped_row_count", "inserted_row_count")


QUERIES: dict[str, Query] = {
    "normalize_messages": normalize_messages,
    "quarantined_messages": quarantined_messages,
    "quarantined_topics": quarantined_topics,
    "relay_events": relay_events,
    "topic_inventory": topic_inventory,
    "topic_inventory_merge": topic_inventory_merge,
    "agg_base_24h": _aggregates("24h", BASE),
    "agg_base_60m": _aggregates("60m", BASE),
    "boundary_values_60m": _aggregates("60m", BOUNDARY),
    "time_weighted_24h": _aggregates("24h", WEIGHTED),
    "gap_metrics_24h": _aggregates("24h", GAPS),
    **{f"message_aggregates_{w}": _aggregates(w) for w in schemas.WIDTHS},
    "message_aggregates_range_15m": _aggregates("15m", None, RANGE),
    "relay_coverage_60m": _reconciliation("60m", RELAY),
    **{f"power_energy_{w}": _reconciliation(w) for w in schemas.WIDTHS},
    "power_energy_range_60m": _reconciliation("60m", None, RANGE),
    "retained_messages": retained_messages,
    "latest_messages": latest_messages,
    **{f"latest_aggregates_{w}": _latest_aggregates(w) for w in schemas.WIDTHS},
    "latest_reconciliation_3m": latest_reconciliation_3m,
    "latest_topics": latest_topics,
    "trace_latency": trace_latency,
    "recommended_24h": recommended_24h,
    "quality_bands_60m": quality_bands_60m,
    "contract_violations": contract_violations,
    "touched_buckets": touched_buckets,
    "fixed_point_after_ingest": fixed_point_after_ingest,
    "reconciled_after_ingest": reconciled_after_ingest,
    "refreshed_range": refreshed_range,
    "due_buckets": due_buckets,
    "range_run_staged": range_run_staged,
    "range_run_loaded": range_run_loaded,
    "range_run_batches": range_run_batches,
    "rules_from_devices": rules_from_devices,
    "imported_rules": imported_rules,
    "stage_range": stage_range,
    "apply_rules": apply_rules,
    "apply_rules_topics": apply_rules_topics,
    "status_report": status_report,
    "rejected_rows": rejected_rows,
    "load_messages": load_messages,
    "load_relay_events": load_relay_events,
    "load_topics": load_topics,
    "batch_summary": batch_summary,
    "top_unmapped": top_unmapped,
    "loaded_by_series": loaded_by_series,
    "loaded_relay_states": loaded_relay_states,
    "reset_batch": reset_batch,
}
