"""The driver's ``events`` table read as device traffic.

One event is one raw message. ``user_id`` blocks of 30 make the devices, so both
rows and devices grow with the scale factor.

=========  =============================  ==========================  ===========
type       topic                          value                       time floor
=========  =============================  ==========================  ===========
click      power, sensor or relay form    value                       none
purchase   energy, sensor or relay form   10 * event_id (a counter)   60 s
signup     temperature                    value                       90 s
error      temperature                    text ``n/a``                90 s
view       relay 0 state (or relay 1)     on / off                    30 s
=========  =============================  ==========================  ===========

Messages are in turn plain text, JSON with a number, JSON with a string, or
plain text with trace fields in the metadata. Some of the last kind carry a
malformed sequence there and are quarantined. The same events also make up legacy
tables for migration: see :func:`legacy_table`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import prepare

REFERENCE_TIME = "2024-01-30 12:00:00"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _device() -> Column:
    return F.concat(F.lit("dev"), F.floor(F.col("user_id") / 30))


def _topic() -> Column:
    kind, event = F.col("event_type"), F.col("event_id")
    metric = F.when(kind == "click", F.lit("power")).otherwise(F.lit("energy"))
    on_relay = (kind == "view") | (kind.isin("click", "purchase") & (event % 3 == 0))
    ending = F.when(kind != "view", F.concat(F.lit("/relay/0/"), metric)).otherwise(
        F.when(event % 10 == 9, F.lit("/relay/1")).otherwise(F.lit("/relay/0"))
    )
    plain = F.when(kind.isin("click", "purchase"), metric).otherwise(F.lit("temperature"))
    return F.when(on_relay, F.concat(F.lit("shellies/"), _device(), ending)).otherwise(
        F.concat(F.lit("sensors/"), _device(), F.lit("/"), plain)
    )


def _received_at() -> Column:
    kind = F.col("event_type")
    at_us = F.unix_micros(F.col("ts").cast("timestamp"))
    floor_us = (
        F.when(kind == "purchase", 60_000_000)
        .when(kind == "view", 30_000_000)
        .when(kind == "click", 1)
        .otherwise(90_000_000)
    )
    return F.timestamp_micros(at_us - F.pmod(at_us, floor_us.cast("bigint")))


def _committed_at() -> Column:
    return F.col("ts").cast("timestamp") + F.expr("INTERVAL 1500 MILLISECONDS")


def _malformed() -> Column:
    return (F.col("event_type") == "error") & (F.col("event_id") % 28 == 3)


def raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages as devices sent them: columns of ``schemas.RAW_MESSAGE``."""
    kind, event = F.col("event_type"), F.col("event_id")
    text = (
        F.when(kind == "purchase", (event * 10).cast("string"))
        .when(kind == "view", F.when(event % 2 == 0, F.lit(" ON ")).otherwise(F.lit("off")))
        .when(kind == "error", F.lit("n/a"))
        .otherwise(F.col("value").cast("decimal(18,2)").cast("string"))
    )
    published = F.col("ts").cast("timestamp") - F.expr("INTERVAL 250 MILLISECONDS")
    trace = F.format_string(
        '"event_id":"e%d","trace_id":"t%d","publisher_id":"p1","sequence":"%s","published_at":"%s"',
        event,
        event,
        F.when(_malformed(), F.lit("x")).otherwise(event.cast("string")),
        F.date_format(published, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"),
    )
    style, numeric = event % 4, kind.isin("click", "purchase", "signup")
    topic_kind = F.when(kind == "view", F.lit('"topic_kind":"status"'))
    return (
        events(spark, sf_dir)
        .withColumns({"_text": text, "_trace": trace})
        .select(
            _topic().alias("topic"),
            F.when((style == 1) & numeric, F.format_string('{"value":%s,%s}', "_text", "_trace"))
            .when(style == 2, F.format_string('{"value":"%s"}', "_text"))
            .otherwise(F.col("_text"))
            .alias("payload"),
            _received_at().alias("received_at"),
            F.concat(
                F.lit("{"),
                F.concat_ws(",", topic_kind, F.when(style == 3, F.col("_trace"))),
                F.lit("}"),
            ).alias("metadata"),
            _committed_at().alias("committed_at"),
        )
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same traffic as stored after normalisation (analytic columns)."""
    kind, event = F.col("event_type"), F.col("event_id")
    named = (kind != "view") | (event % 10 != 9)
    metric = (
        F.when(kind == "click", F.lit("power"))
        .when(kind == "purchase", F.lit("energy"))
        .when(kind == "view", F.lit("relay_state"))
        .otherwise(F.lit("temperature"))
    )
    return events(spark, sf_dir).where(~_malformed()).select(
        _received_at().alias("received_at"),
        _topic().alias("topic"),
        F.when(named, _device()).alias("device_id"),
        F.when(named, metric).alias("metric_name"),
        F.when(kind == "purchase", (event * 10).cast("double"))
        .when(kind.isin("click", "signup"), F.col("value"))
        .alias("numeric_value"),
        _committed_at().alias("committed_at"),
    )


def relay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored relay events of that traffic (analytic columns)."""
    return (
        events(spark, sf_dir)
        .where((F.col("event_type") == "view") & (F.col("event_id") % 10 != 9))
        .select(
            _received_at().alias("event_at"),
            _device().alias("device_id"),
            F.lit(0).alias("relay_index"),
            F.when(F.col("event_id") % 2 == 0, F.lit("on")).otherwise(F.lit("off")).alias("state"),
            (F.col("event_id") % 2 == 0).alias("is_on"),
            _committed_at().alias("committed_at"),
        )
    )


# --- migration ---------------------------------------------------------------

BATCH_ID = 7
ZONE = "Europe/Berlin"
SKIPPED_TOPIC = "shellies/BV.LR.SY/ProjectorScreen/online"

# event type -> (legacy table, unit)
LEGACY = {
    "click": ("public.mqtt_power", "W"),
    "purchase": ("public.mqtt_energy", "Wmin"),
    "view": ("public.mqtt_status", None),
    "signup": ("public.mqtt_infos", "C"),
    "error": ("public.mqtt_online", None),
}


def _legacy_topic() -> Column:
    kind, dev = F.col("event_type"), _device()
    old = F.concat(F.lit("shellies/old-"), dev, F.lit("/relay/0"))
    return (
        F.when(kind == "click", F.concat(old, F.lit("/power")))
        .when(kind == "purchase", F.concat(old, F.lit("/energy")))
        .when(kind == "view", old)
        .when(kind == "signup", F.concat(F.lit("shellies/shellies/vold-"), dev, F.lit("/temperature")))
        .when(F.col("event_id") % 5 == 0, F.lit(SKIPPED_TOPIC))
        .otherwise(F.concat(F.lit("other/"), dev, F.lit("/online")))
    )


def _legacy_payload() -> Column:
    kind, event = F.col("event_type"), F.col("event_id")
    return (
        F.when(kind == "purchase", (event * 10).cast("string"))
        .when(kind == "view", F.when(event % 2 == 0, F.lit("On ")).otherwise(F.lit("off")))
        .when(kind == "error", F.when(event % 3 == 0, F.lit("true")))
        .otherwise(F.col("value").cast("decimal(18,2)").cast("string"))
    )


def legacy_table(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """One legacy table: (created_at wall clock, topic, unit, payload)."""
    return (
        events(spark, sf_dir)
        .where(F.col("event_type") == kind)
        .select(
            F.col("ts").alias("created_at"),
            _legacy_topic().alias("topic"),
            F.lit(LEGACY[kind][1]).cast("string").alias("unit"),
            _legacy_payload().alias("payload"),
        )
    )


def legacy_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The retained-topic snapshot: last payload per topic, and broker topics."""
    all_events = events(spark, sf_dir)
    retained = all_events.groupBy(_legacy_topic().alias("topic")).agg(
        F.max_by(_legacy_payload(), "event_id").alias("payload"), F.max("event_id").alias("position")
    )
    broker = all_events.groupBy(
        F.concat(F.lit("$SYS/broker/"), F.col("event_type")).alias("topic")
    ).agg(F.count(F.lit(1)).cast("string").alias("payload"), F.max("event_id").alias("position"))
    return retained.unionByName(broker.withColumn("position", F.col("position") + 10**12))


def device_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The device rename table; every third device is not in use.

    The devices at the front share their old name with a later row, which sorts first by name.
    """
    number = F.floor(F.col("user_id") / 30)
    device = F.concat(F.lit("dev"), F.col("n"))
    numbers = events(spark, sf_dir).select(number.alias("n")).distinct()
    rows = numbers.select(
        device.alias("<new-mqtt-device-name>"),
        F.concat(F.lit("/old-"), device, F.lit("/")).alias("<old-mqtt-device-name>"),
        F.concat(F.lit("shellies/vold-"), device).alias("<very-old-mqtt-device-name>"),
        F.when(F.col("n") % 3 == 2, F.lit("x")).alias("<not-in-use>"),
        (F.col("n") + 2).alias("row_number"),
    )
    later = numbers.where("n % 3 = 0").select(
        F.concat(F.lit("a-"), device).alias("<new-mqtt-device-name>"),
        F.concat(F.lit("old-"), device).alias("<old-mqtt-device-name>"),
        F.lit("").alias("<very-old-mqtt-device-name>"),
        F.lit(None).cast("string").alias("<not-in-use>"),
        (F.col("n") + 1_000_000).alias("row_number"),
    )
    return rows.unionByName(later)


def rounding(column: str) -> tuple[int, str]:
    """Decimals two engines agree on whatever order they add in, and a nudge.

    Sample values have two decimals and times six, so many exact results end in
    a 5 just behind the kept decimals; the nudge moves those off the tie.
    """
    return (3, "0.000137") if column.endswith("_ws") else (5, "0.00000137")


def for_compare(df: DataFrame) -> DataFrame:
    """Doubles rounded, instants without zone, arrays as text."""
    out = []
    for f in df.schema.fields:
        c, kind = F.col(f.name), f.dataType.simpleString()
        if kind == "double":
            # Adding zero turns a rounded -0.0 into 0.0.
            digits, nudge = rounding(f.name)
            c = F.round(c + F.lit(float(nudge)), digits) + F.lit(0.0)
        elif kind == "timestamp":
            c = c.cast("timestamp_ntz")
        elif kind == "array<string>":
            c = F.array_join(c, ",")
        out.append(c.alias(f.name))
    return df.select(*out)
