"""Raw device messages to typed rows, relay events and a topic inventory."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import parse, topics
from tidemark.session import prepare


def _decoded(raw: DataFrame) -> DataFrame:
    """Raw columns plus every parsed field; nothing is dropped."""
    prepare(raw.sparkSession)
    text = raw.withColumns(
        {
            "metadata": F.coalesce(F.col("metadata"), F.lit("{}")),
            "committed_at": F.coalesce(F.col("committed_at"), F.col("received_at"))
            if "committed_at" in raw.columns
            else F.col("received_at"),
        }
    )
    marked = text.withColumns(
        {
            "_body": parse.json_marked(parse.object_text(F.col("payload"))),
            "_meta": parse.json_marked(F.col("metadata")),
        }
    )
    parsed = marked.withColumns(
        {
            "_body": parse.json_value(F.col("_body"), F.col("payload")),
            "_meta": parse.json_value(F.col("_meta"), F.col("metadata")),
        }
    )
    # Out of the texts and not inside the ``inline``, whose expressions are not shared.
    fields = _text_fields(parsed).withColumns(
        {
            "_body_sequence": parse.whole_number(F.col("_body_sequence")),
            "_body_published": parse.moment(F.col("_body_published")),
        }
    )
    bad_sequence = (
        F.col("_body_sequence").isNull()
        & F.col("_meta_sequence").isNotNull()
        & parse.whole_number(F.col("_meta_sequence")).isNull()
    )
    bad_published = (
        F.col("_body_published").isNull()
        & F.col("_meta_published").isNotNull()
        & parse.moment(F.col("_meta_published")).isNull()
    )
    return fields.withColumns(
        {
            "device_id": topics.device_id(F.col("topic")),
            "metric_name": topics.metric_name(F.col("topic")),
            "numeric_value": parse.lenient_double(F.col("value_text")),
            "sequence": F.coalesce(
                F.col("_body_sequence"), parse.whole_number(F.col("_meta_sequence"))
            ),
            "published_at": F.coalesce(
                F.col("_body_published"), parse.moment(F.col("_meta_published"))
            ),
            "reject_reason": F.when(F.col("_meta_broken"), F.lit("malformed metadata"))
            .when(bad_sequence, F.lit("malformed metadata sequence"))
            .when(bad_published, F.lit("malformed metadata published_at")),
        }
    )


def _text_fields(parsed: DataFrame) -> DataFrame:
    """Fields of the two parsed documents as plain columns.

    They come out of a one-row ``inline``: filters on them stay above it, so the
    documents are not parsed a second time inside a pushed-down predicate.
    """
    body, meta = F.col("_body"), F.col("_meta")

    def in_body(name: str) -> Column:
        return parse.object_field(body, name, F.col("payload"))

    def in_meta(name: str) -> Column:
        return parse.object_field(meta, name, F.col("metadata"))

    overflowed = F.coalesce(parse.overflowed_number(body, "value", F.col("payload")), F.lit(False))
    fields = F.struct(
        meta.isNull().alias("_meta_broken"),
        F.when(body.isNull(), F.col("payload"))
        .otherwise(F.when(~overflowed, in_body("value")))
        .alias("value_text"),
        *[
            F.coalesce(in_body(name), in_meta(name)).alias(name)
            for name in ("event_id", "trace_id", "publisher_id")
        ],
        in_body("sequence").alias("_body_sequence"),
        in_body("published_at").alias("_body_published"),
        F.nullif(in_meta("sequence"), F.lit("")).alias("_meta_sequence"),
        F.nullif(in_meta("published_at"), F.lit("")).alias("_meta_published"),
        F.lower(F.btrim(F.coalesce(in_meta("topic_kind"), F.lit("")))).alias("topic_kind"),
    )
    carried = [c for c in parsed.columns if c not in ("_body", "_meta")]
    return parsed.select(*carried, F.inline(F.array(fields)))


def judged_messages(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Every message as ``schemas.MESSAGE`` with ``keep`` and ``reject_reason``, NULL where it can be typed."""
    return _decoded(raw).select(*schemas.MESSAGE.fieldNames(), *keep, "reject_reason")


def accepted(judged: DataFrame) -> DataFrame:
    return judged.where(F.col("reject_reason").isNull()).drop("reject_reason")


def quarantined(judged: DataFrame) -> DataFrame:
    rejected = judged.where(F.col("reject_reason").isNotNull())
    return rejected.select("topic", "payload", "received_at", "metadata", "reject_reason")


def normalize_messages(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Typed messages (``schemas.MESSAGE``); ``keep`` adds working columns such
    as ``topic_kind`` or ``value_text``."""
    return accepted(judged_messages(raw, keep))


def quarantined_messages(raw: DataFrame) -> DataFrame:
    """Messages whose metadata cannot be typed, with the reason."""
    return quarantined(judged_messages(raw))


def relay_events(messages: DataFrame) -> DataFrame:
    """On/off events of relay 0 from normalised messages with ``value_text``."""
    state = F.lower(F.btrim(F.coalesce(F.col("value_text"), F.lit(""))))
    return (
        messages.where(F.col("metric_name") == "relay_state")
        .withColumn("state", state)
        .where(F.col("state").isin(*schemas.RELAY_STATES))
        .select(
            F.col("received_at").alias("event_at"),
            "topic",
            "device_id",
            F.lit(0).alias("relay_index"),
            "state",
            (F.col("state") == "on").alias("is_on"),
            "payload",
            "metadata",
            "committed_at",
        )
    )


def topic_inventory(
    raw: DataFrame, refreshed_at: Column | None = None, arrival: tuple[str, ...] = ("committed_at",)
) -> DataFrame:
    """One row per topic: first message's time, last message's content, count.

    First and last follow arrival order, so ``last_seen_at`` can move backwards
    when a message arrives late. Trace fields come from metadata only.
    """
    typed = _inventory_fields(raw).where(F.col("_malformed").isNull())
    order = F.struct(*[F.col(c) for c in arrival], F.col("received_at"), F.col("payload"))
    last = F.max(
        F.struct(
            order.alias("o"),
            F.col("received_at").alias("at"),
            F.col("payload"),
            F.col("metadata"),
            F.col("_event_id"),
            F.col("_trace_id"),
            F.col("_publisher_id"),
            F.col("_sequence"),
        )
    )
    first = F.min(F.struct(order.alias("o"), F.col("received_at").alias("at")))
    grouped = typed.groupBy("topic").agg(
        first.alias("f"), last.alias("l"), F.count(F.lit(1)).alias("message_count")
    )
    return grouped.select(
        "topic",
        F.col("f.at").alias("first_seen_at"),
        F.col("l.at").alias("last_seen_at"),
        "message_count",
        F.col("l.payload").alias("last_payload"),
        F.col("l.metadata").alias("last_metadata"),
        F.col("l._event_id").alias("last_event_id"),
        F.col("l._trace_id").alias("last_trace_id"),
        F.col("l._publisher_id").alias("last_publisher_id"),
        F.col("l._sequence").alias("last_sequence"),
        (F.current_timestamp() if refreshed_at is None else refreshed_at).alias("refreshed_at"),
    )


def quarantined_topics(raw: DataFrame) -> DataFrame:
    """Messages the inventory cannot count because of their metadata, with the reason."""
    return (
        _inventory_fields(raw)
        .where(F.col("_malformed").isNotNull())
        .withColumn("reject_reason", F.col("_malformed"))
        .select("topic", "payload", "received_at", "metadata", "reject_reason")
    )


def _inventory_fields(raw: DataFrame) -> DataFrame:
    prepare(raw.sparkSession)
    text = raw.withColumn("metadata", F.coalesce(F.col("metadata"), F.lit("{}")))
    parsed = text.withColumn("_meta", parse.json_marked(F.col("metadata"))).withColumn(
        "_meta", parse.json_value(F.col("_meta"), F.col("metadata"))
    )
    meta = F.col("_meta")

    def field(name: str) -> Column:
        return parse.object_field(meta, name, F.col("metadata"))

    # Out of an ``inline`` as in _text_fields: a filter above does not parse again.
    fields = F.struct(
        meta.isNull().alias("_meta_broken"),
        *[field(name).alias(f"_{name}") for name in ("event_id", "trace_id", "publisher_id")],
        F.nullif(field("sequence"), F.lit("")).alias("_sequence_text"),
    )
    carried = [F.col(f"`{c}`") for c in parsed.columns if c != "_meta"]
    plain = parsed.select(*carried, F.inline(F.array(fields)))
    sequence_text = F.col("_sequence_text")
    return plain.withColumns(
        {
            "_sequence": parse.whole_number(sequence_text),
            "_malformed": F.when(F.col("_meta_broken"), "malformed metadata").when(
                sequence_text.isNotNull() & parse.whole_number(sequence_text).isNull(), "malformed metadata sequence"
            ),
        }
    ).drop("_meta_broken", "_sequence_text")


def merge_topic_inventory(existing: DataFrame, arrived: DataFrame) -> DataFrame:
    """Upsert: arrived rows replace the last_* fields and add to the count."""
    e, a = existing.alias("e"), arrived.alias("a")
    joined = e.join(a, F.col("e.topic") == F.col("a.topic"), "full")

    def newest(name: str) -> Column:
        return (
            F.when(F.col("a.topic").isNotNull(), F.col(f"a.{name}"))
            .otherwise(F.col(f"e.{name}"))
            .alias(name)
        )

    def either(name: str) -> Column:
        return F.coalesce(F.col(f"e.{name}"), F.col(f"a.{name}")).alias(name)

    zero = F.lit(0).cast("bigint")
    kept = {"topic", "first_seen_at"}
    return joined.select(
        *[
            either(c)
            if c in kept
            else (
                F.coalesce(F.col("e.message_count"), zero)
                + F.coalesce(F.col("a.message_count"), zero)
            ).alias(c)
            if c == "message_count"
            else newest(c)
            for c in schemas.TOPIC_OVERVIEW.fieldNames()
        ]
    )
