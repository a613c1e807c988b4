"""Stages of a historical migration batch, as DataFrame transformations.

Every stage takes the batch's rows and returns them with the next status; rows
that did not move keep theirs, so each stage can be repeated.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import clock, parse, topics, twins
from tidemark.operators.rules import first_matching_rules

# Why a staged row is turned down.
UNMATCHED = "no topic mapping matched"
SKIPPED = "topic mapping target kind is skip"


def _now(now: datetime | str | None) -> Column:
    return F.current_timestamp() if now is None else clock.instant_lit(clock.to_us(now))


def stage_table(
    source: DataFrame,
    batch_id: int,
    source_table: str,
    from_time: datetime | str | None = None,
    to_time: datetime | str | None = None,
) -> DataFrame:
    """Rows of one legacy table in the half-open wall-clock range, staged.

    Row ids are content hashes: re-running gives the same ids, and identical
    rows share one.
    """
    at = F.col("created_at")
    rows = source
    if from_time is not None:
        rows = rows.where(at >= F.lit(str(from_time)).cast("timestamp_ntz"))
    if to_time is not None:
        rows = rows.where(at < F.lit(str(to_time)).cast("timestamp_ntz"))
    staged = rows.select(
        F.lit(batch_id).cast("bigint").alias("batch_id"),
        F.lit(source_table).alias("source_table"),
        at.cast("timestamp_ntz").alias("source_created_at"),
        F.col("topic").alias("source_topic"),
        F.col("unit").alias("source_unit"),
        F.col("payload").cast("string").alias("source_payload"),
        F.lit("staged").alias("validation_status"),
        F.lit(False).alias("inserted"),
        F.lit(False).alias("relay_inserted"),
        F.lit("{}").alias("metadata"),
    )
    content = ("batch_id", "source_table", "source_created_at", "source_topic", "source_unit", "source_payload")
    identified = staged.withColumn("staged_message_id", F.xxhash64(*content))
    return schemas.conform(identified, schemas.STAGED_MESSAGE)


def stage_topics(snapshot: DataFrame, batch_id: int, id_column: str | None = None) -> DataFrame:
    """The untimed topic snapshot, staged. ``id_column`` gives snapshot order."""
    row_id = (
        F.xxhash64(F.lit(batch_id), "topic", "payload")
        if id_column is None
        else F.col(id_column).cast("bigint")
    )
    staged = snapshot.select(
        row_id.alias("staged_topic_id"),
        F.lit(batch_id).cast("bigint").alias("batch_id"),
        F.col("topic").alias("source_topic"),
        F.col("payload").cast("string").alias("source_payload"),
        F.lit("staged").alias("validation_status"),
        F.lit(False).alias("inserted"),
        F.lit("{}").alias("metadata"),
    )
    return schemas.conform(staged, schemas.STAGED_TOPIC)


def apply_rules(
    staged: DataFrame, rules: DataFrame, source_timezone: str | None = None, strict_prefix: bool = False
) -> DataFrame:
    """Map staged messages or topics by the first matching rule.

    Inserted rows keep their mapping. Messages also get the instant of their
    wall-clock time in ``source_timezone``.
    """
    timed = "source_created_at" in staged.columns
    keyed = staged if timed else staged.withColumn("source_table", F.lit(schemas.LEGACY_TOPICS))
    new = ("mapping_id", "mapped_topic", "mapped_kind")
    found = first_matching_rules(keyed.where(~F.col("inserted")), rules, strict_prefix)
    found = found.select("source_table", "source_topic", *[F.col(c).alias(f"_{c}") for c in new])
    joined = keyed.join(found, ["source_table", "source_topic"], "left")

    open_row, matched = ~F.col("inserted"), F.col("_mapping_id").isNotNull()
    skipped = F.col("_mapped_kind") == "skip"

    def moved(name: str, value: Column) -> Column:
        return F.when(open_row, value).otherwise(F.col(name))

    columns = {c: moved(c, F.col(f"_{c}")) for c in new}
    columns["validation_status"] = moved(
        "validation_status",
        F.when(~matched, "unmapped").when(skipped, "skipped").otherwise("mapped"),
    )
    columns["validation_error"] = moved(
        "validation_error", F.when(~matched, UNMATCHED).when(skipped, SKIPPED)
    )
    if timed:
        instant = clock.wall_clock_to_instant(
            F.col("source_created_at"), F.lit(source_timezone or "UTC")
        )
        columns["production_received_at"] = moved(
            "production_received_at", F.when(matched & ~skipped, instant)
        )
    return joined.withColumns(columns).select(*staged.columns)


def rejects(staged_messages: DataFrame, staged_topics: DataFrame | None = None) -> DataFrame:
    """Quarantined rows: one per unmapped or skipped staged row."""
    turned_down = F.col("validation_status").isin("unmapped", "skipped")

    def rejected(df: DataFrame) -> DataFrame:
        named = df.where(turned_down).withColumn("reason", F.col("validation_error"))
        if "source_table" not in df.columns:
            named = named.withColumn("source_table", F.lit(schemas.LEGACY_TOPICS))
        return schemas.conform(named, schemas.REJECTED_MESSAGE)

    out = rejected(staged_messages)
    return out if staged_topics is None else out.unionByName(rejected(staged_topics))


def status_report(staged_messages: DataFrame, staged_topics: DataFrame) -> DataFrame:
    """Row counts per status; topic statuses carry the prefix ``topic_``."""
    counted = staged_messages.groupBy(F.col("validation_status").alias("status")).agg(
        F.count(F.lit(1)).alias("row_count")
    )
    of_topics = staged_topics.groupBy(
        F.concat(F.lit("topic_"), F.col("validation_status")).alias("status")
    ).agg(F.count(F.lit(1)).alias("row_count"))
    return counted.unionByName(of_topics).orderBy("status")


def _wall_text() -> Column:
    return F.date_format("source_created_at", "yyyy-MM-dd HH:mm:ss.SSSSSS")


def provenance(imported_at: Column, timed: bool = True) -> Column:
    """Metadata of a loaded row as JSON text; the row's own metadata wins."""
    own = F.from_json("metadata", "map<string,string>")
    fields: list[tuple[str, Column]] = [
        ("migration_batch_id", F.col("batch_id").cast("string")),
        ("source_table", F.col("source_table")),
        ("source_topic", F.col("source_topic")),
    ]
    if timed:
        fields += [("source_unit", F.col("source_unit")), ("source_created_at", _wall_text())]
    fields += [
        ("target_kind", F.col("mapped_kind")),
        ("imported_at", F.date_format(imported_at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")),
    ]
    built = F.create_map(*[x for name, c in fields for x in (F.lit(name), c)])
    kept = F.map_filter(built, lambda k, _: ~F.map_contains_key(own, k))
    return F.to_json(
        F.map_concat(kept, own), {"ignoreNullFields": "false"}
    )


def _already_loaded(candidates: DataFrame, existing: DataFrame, time_column: str) -> DataFrame:
    """Candidates without a loaded twin.

    A twin has the same instant, topic, payload and source; where it records a
    source wall-clock time, that must agree too. Only what was loaded before is
    compared: copies inside the batch all stay.
    """
    payload = F.coalesce(F.col("source_payload"), F.lit(""))
    keys = twins.identity(
        F.col("production_received_at"), F.col("mapped_topic"), payload, F.col("source_table"), F.col("source_topic")
    )
    c = candidates.withColumns({**keys, "_wall": _wall_text()}).alias("c")
    e = twins.stored_keys(existing, time_column).alias("e")
    twin = (F.col("c.twin_a") == F.col("e.twin_a")) & (F.col("c.twin_b") == F.col("e.twin_b"))
    agrees = (F.col("c._wall") == F.col("e.twin_wall")) | ~F.col("e.twin_walled")
    return c.join(e, twin & agrees, "left_anti").drop(*keys, "_wall")


def message_candidates(staged: DataFrame, existing_messages: DataFrame) -> DataFrame:
    """Mapped measurement and status rows that are not loaded yet."""
    ready = staged.where(
        (F.col("validation_status") == "mapped")
        & F.col("mapped_kind").isin("measurement", "status")
        & F.col("mapped_topic").isNotNull()
        & F.col("production_received_at").isNotNull()
        & ~F.col("inserted")
    )
    return _already_loaded(ready, existing_messages, "received_at")


def relay_candidates(staged: DataFrame, existing_events: DataFrame) -> DataFrame:
    """Status rows of a relay topic with an on/off payload, not loaded yet.

    The validation status does not matter: a message loaded before may still owe
    its relay event.
    """
    state = F.lower(F.btrim(F.coalesce(F.col("source_payload"), F.lit(""))))
    ready = staged.where(
        (F.col("mapped_kind") == "status")
        & (topics.metric_name(F.col("mapped_topic")) == "relay_state")
        & state.isin(*schemas.RELAY_STATES)
        & F.col("production_received_at").isNotNull()
        & ~F.col("relay_inserted")
    )
    return _already_loaded(ready, existing_events, "event_at")


def to_messages(candidates: DataFrame, now: datetime | str | None = None) -> DataFrame:
    topic = F.col("mapped_topic")
    rows = candidates.select(
        F.col("production_received_at").alias("received_at"),
        topic.alias("topic"),
        topics.device_id(topic).alias("device_id"),
        topics.metric_name(topic).alias("metric_name"),
        F.coalesce(F.col("source_payload"), F.lit("")).alias("payload"),
        parse.strict_double(F.col("source_payload")).alias("numeric_value"),
        provenance(_now(now)).alias("metadata"),
        _now(now).alias("committed_at"),
    )
    return schemas.conform(rows, schemas.MESSAGE)


def to_relay_events(candidates: DataFrame, now: datetime | str | None = None) -> DataFrame:
    topic = F.col("mapped_topic")
    state = F.lower(F.btrim(F.coalesce(F.col("source_payload"), F.lit(""))))
    rows = candidates.select(
        F.col("production_received_at").alias("event_at"),
        topic.alias("topic"),
        topics.device_id(topic).alias("device_id"),
        F.lit(0).alias("relay_index"),
        state.alias("state"),
        (state == "on").alias("is_on"),
        F.coalesce(F.col("source_payload"), F.lit("")).alias("payload"),
        provenance(_now(now)).alias("metadata"),
        _now(now).alias("committed_at"),
    ).where(F.col("device_id").isNotNull())
    return schemas.conform(rows, schemas.RELAY_EVENT)


def topic_candidates(staged_topics: DataFrame) -> DataFrame:
    return staged_topics.where(
        (F.col("validation_status") == "mapped")
        & (F.col("mapped_kind") == "topic_inventory")
        & F.col("mapped_topic").isNotNull()
        & ~F.col("inserted")
    )


def latest_topics(candidates: DataFrame, now: datetime | str | None = None) -> DataFrame:
    """One inventory row per mapped topic, from its highest staged id."""
    timed = candidates.withColumn("source_table", F.lit(schemas.LEGACY_TOPICS))
    last = F.max(
        F.struct(
            "staged_topic_id",
            "source_topic",
            F.col("source_payload").alias("payload"),
            provenance(_now(now), timed=False).alias("metadata"),
        )
    )
    rows = (
        timed.groupBy(F.col("mapped_topic").alias("topic"))
        .agg(last.alias("l"))
        .select(
            "topic",
            _now(now).alias("first_seen_at"),
            _now(now).alias("last_seen_at"),
            F.lit(1).alias("message_count"),
            F.col("l.payload").alias("last_payload"),
            F.col("l.metadata").alias("last_metadata"),
            _now(now).alias("refreshed_at"),
        )
    )
    return schemas.conform(rows, schemas.TOPIC_OVERVIEW)


def merge_loaded_topics(existing: DataFrame, loaded: DataFrame) -> DataFrame:
    """Upsert of migrated topics: counts add up, trace fields stay as they were."""
    e, a = existing.alias("e"), loaded.alias("a")
    joined = e.join(a, F.col("e.topic") == F.col("a.topic"), "full")
    arrived = F.col("a.topic").isNotNull()
    replaced = ("last_seen_at", "last_payload", "last_metadata", "refreshed_at")
    zero = F.lit(0).cast("bigint")

    def merged(name: str) -> Column:
        if name == "message_count":
            return F.coalesce("e.message_count", zero) + F.coalesce("a.message_count", zero)
        if name in replaced:
            return F.when(arrived, F.col(f"a.{name}")).otherwise(F.col(f"e.{name}"))
        if name in ("topic", "first_seen_at"):
            return F.coalesce(f"e.{name}", f"a.{name}")
        return F.col(f"e.{name}")

    return joined.select(*[merged(c).alias(c) for c in schemas.TOPIC_OVERVIEW.fieldNames()])


def batch_counters(staged_messages: DataFrame, staged_topics: DataFrame, zone: Column | str) -> DataFrame:
    """Per batch: row counters and the range of source instants."""
    status = F.col("validation_status")
    zone = F.lit(zone) if isinstance(zone, str) else zone

    def counts(df: DataFrame, at: Column, timed: bool) -> DataFrame:
        inserted = F.col("inserted") if timed else F.lit(False)
        return df.select(
            "batch_id",
            at.alias("at"),
            (status == "mapped").cast("int").alias("mapped"),
            status.isin("unmapped", "skipped").cast("int").alias("skipped"),
            inserted.cast("int").alias("inserted"),
        )

    none = F.lit(None).cast("timestamp")
    rows = counts(
        staged_messages, clock.wall_clock_to_instant(F.col("source_created_at"), zone), True
    ).unionByName(counts(staged_topics, none, False))
    return rows.groupBy("batch_id").agg(
        F.min("at").alias("source_min_at"),
        F.max("at").alias("source_max_at"),
        F.count(F.lit(1)).alias("staged_row_count"),
        F.sum("mapped").alias("mapped_row_count"),
        F.sum("skipped").alias("skipped_row_count"),
        F.sum("inserted").alias("inserted_row_count"),
    )


def _status_json(staged: DataFrame, name: str) -> DataFrame:
    per_status = staged.groupBy("batch_id", "validation_status").agg(
        F.count(F.lit(1)).alias("row_count")
    )
    pairs = F.array_sort(F.collect_list(F.struct("validation_status", "row_count")))
    return per_status.groupBy("batch_id").agg(
        F.to_json(F.map_from_entries(pairs)).alias(name)
    )


def batch_summary(batches: DataFrame, staged_messages: DataFrame, staged_topics: DataFrame) -> DataFrame:
    """The batch rows with JSON status counts of their messages and topics."""
    columns = [c for c in schemas.IMPORT_BATCH.fieldNames() if c not in ("metadata", "created_at", "updated_at")]
    none = F.lit("{}")
    return (
        batches.join(_status_json(staged_messages, "m"), "batch_id", "left")
        .join(_status_json(staged_topics, "t"), "batch_id", "left")
        .select(
            *columns,
            F.coalesce("m", none).alias("message_status_counts"),
            F.coalesce("t", none).alias("topic_status_counts"),
            "created_at",
            "updated_at",
        )
    )


def top_unmapped_topics(staged_messages: DataFrame, staged_topics: DataFrame) -> DataFrame:
    """Unmapped topics per batch and table with row counts and first/last times."""
    unmapped = F.col("validation_status") == "unmapped"
    none = F.lit(None).cast("timestamp_ntz")
    of_messages = (
        staged_messages.where(unmapped)
        .groupBy("batch_id", "source_table", "source_topic")
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.min("source_created_at").alias("first_seen_at"),
            F.max("source_created_at").alias("last_seen_at"),
        )
    )
    of_topics = (
        staged_topics.where(unmapped)
        .groupBy("batch_id", F.lit(schemas.LEGACY_TOPICS).alias("source_table"), "source_topic")
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.first(none).alias("first_seen_at"),
            F.first(none).alias("last_seen_at"),
        )
    )
    return of_messages.unionByName(of_topics)


def loaded_by_series(messages: DataFrame, batch_id: int) -> DataFrame:
    """Loaded rows of a batch per topic and series, largest first."""
    return (
        messages.where(_batch_of("metadata") == str(batch_id))
        .groupBy("topic", "device_id", "metric_name")
        .agg(F.count(F.lit(1)).alias("row_count"))
        .orderBy(F.desc("row_count"), "topic")
    )


def loaded_relay_states(events: DataFrame, batch_id: int) -> DataFrame:
    return (
        events.where(_batch_of("metadata") == str(batch_id))
        .groupBy("device_id", "state")
        .agg(F.count(F.lit(1)).alias("row_count"))
        .orderBy("device_id", "state")
    )


def _batch_of(column: str) -> Column:
    return F.try_variant_get(F.try_parse_json(F.col(column)), "$.migration_batch_id", "string")


def without_batch(rows: DataFrame, batch_id: int | None = None, column: str = "metadata") -> DataFrame:
    """Rows that do not come from the batch (or, without an id, from any batch)."""
    batch = _batch_of(column)
    if batch_id is None:
        return rows.where(batch.isNull())
    return rows.where(batch.isNull() | (batch != str(batch_id)))


def reset_staged(staged: DataFrame) -> DataFrame:
    """Inserted rows back to mapped."""
    was = F.col("validation_status") == "inserted"
    columns = {
        "inserted": F.when(was, False).otherwise(F.col("inserted")),
        "inserted_at": F.when(~was, F.col("inserted_at")),
        "validation_status": F.when(was, "mapped").otherwise(F.col("validation_status")),
    }
    if "relay_inserted" in staged.columns:
        columns["relay_inserted"] = F.when(was, False).otherwise(F.col("relay_inserted"))
    return staged.withColumns(columns)


def reopened(staged: DataFrame) -> DataFrame:
    """All rows as they were before any load: what is loaded is then told by the raw tables alone."""
    columns = {
        "inserted": F.lit(False),
        "relay_inserted": F.lit(False),
        "validation_status": F.when(F.col("validation_status") == "inserted", "mapped").otherwise(
            F.col("validation_status")
        ),
    }
    return staged.withColumns(columns)


def mark_inserted(
    staged: DataFrame, ids: DataFrame, id_column: str, now: datetime | str | None = None
) -> DataFrame:
    """Loaded rows to status inserted."""
    done = ids.select(id_column).distinct().withColumn("_done", F.lit(True))
    hit = F.coalesce(F.col("_done"), F.lit(False))
    return (
        staged.join(done, id_column, "left")
        .withColumns(
            {
                "inserted": F.col("inserted") | hit,
                "validation_status": F.when(hit, "inserted").otherwise(F.col("validation_status")),
                "inserted_at": F.when(hit, _now(now)).otherwise(F.col("inserted_at")),
            }
        )
        .select(*staged.columns)
    )


def mark_relay_inserted(staged: DataFrame, ids: DataFrame) -> DataFrame:
    done = ids.select("staged_message_id").distinct().withColumn("_done", F.lit(True))
    return (
        staged.join(done, "staged_message_id", "left")
        .withColumn("relay_inserted", F.col("relay_inserted") | F.coalesce(F.col("_done"), F.lit(False)))
        .select(*staged.columns)
    )
