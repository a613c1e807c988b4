"""Table layouts, bucket widths and status vocabularies."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

# The four bucket widths, in seconds.
WIDTHS = {"3m": 180, "15m": 900, "60m": 3600, "24h": 86400}

# Vocabularies of the status and kind columns.
BUCKET_STATUSES = ("aggregated", "tba")
BATCH_STATUSES = ("created", "staged", "mapped", "loaded", "refreshed", "failed")
STAGED_STATUSES = ("staged", "mapped", "skipped", "unmapped", "inserted", "failed")
RULE_TYPES = ("exact", "prefix", "regex")
TARGET_KINDS = ("measurement", "status", "topic_inventory", "skip")
RELAY_STATES = ("on", "off")

# Legacy tables in staging order, and the untimed topic snapshot.
LEGACY_TABLES = (
    "public.mqtt_power",
    "public.mqtt_energy",
    "public.mqtt_status",
    "public.mqtt_switch",
    "public.mqtt_online",
    "public.mqtt_infos",
    "public.mqtt_announcements",
    "public.mqtt_dump",
)
LEGACY_TOPICS = "public.mqtt_topics"

_TS, _STR, _DBL, _LONG = TimestampType(), StringType(), DoubleType(), LongType()
_DATE, _BOOL, _INT = DateType(), BooleanType(), IntegerType()


def _struct(*fields: tuple) -> StructType:
    return StructType(
        [StructField(f[0], f[1], f[2] if len(f) > 2 else True) for f in fields]
    )


RAW_MESSAGE = _struct(
    ("topic", _STR, False),
    ("payload", _STR, False),
    ("received_at", _TS, False),
    ("metadata", _STR),
    ("committed_at", _TS),
)

MESSAGE = _struct(
    ("received_at", _TS, False),
    ("topic", _STR, False),
    ("device_id", _STR),
    ("metric_name", _STR),
    ("payload", _STR, False),
    ("numeric_value", _DBL),
    ("event_id", _STR),
    ("trace_id", _STR),
    ("publisher_id", _STR),
    ("sequence", _LONG),
    ("published_at", _TS),
    ("metadata", _STR, False),
    ("committed_at", _TS, False),
)

RELAY_EVENT = _struct(
    ("event_at", _TS, False),
    ("topic", _STR, False),
    ("device_id", _STR, False),
    ("relay_index", IntegerType(), False),
    ("state", _STR, False),
    ("is_on", BooleanType(), False),
    ("payload", _STR, False),
    ("metadata", _STR, False),
    ("committed_at", _TS, False),
)

TOPIC_OVERVIEW = _struct(
    ("topic", _STR, False),
    ("first_seen_at", _TS, False),
    ("last_seen_at", _TS, False),
    ("message_count", _LONG, False),
    ("last_payload", _STR),
    ("last_metadata", _STR, False),
    ("last_event_id", _STR),
    ("last_trace_id", _STR),
    ("last_publisher_id", _STR),
    ("last_sequence", _LONG),
    ("refreshed_at", _TS, False),
)

AGGREGATE = _struct(
    ("bucket_start", _TS, False),
    ("bucket_end", _TS, False),
    ("topic", _STR, False),
    ("device_id", _STR),
    ("metric_name", _STR),
    ("sample_count", _LONG, False),
    ("numeric_count", _LONG, False),
    ("numeric_avg", _DBL),
    ("numeric_min", _DBL),
    ("numeric_max", _DBL),
    ("numeric_median", _DBL),
    ("numeric_p25", _DBL),
    ("numeric_p75", _DBL),
    ("numeric_variance_samp", _DBL),
    ("numeric_stddev_samp", _DBL),
    ("numeric_stderr", _DBL),
    ("numeric_ci95_lower", _DBL),
    ("numeric_ci95_upper", _DBL),
    ("first_received_at", _TS),
    ("last_received_at", _TS),
    ("locf_value_at_bucket_start", _DBL),
    ("locf_value_at_bucket_end", _DBL),
    ("locf_time_weighted_avg", _DBL),
    ("linear_value_at_bucket_start", _DBL),
    ("linear_value_at_bucket_end", _DBL),
    ("linear_time_weighted_avg", _DBL),
    ("status", _STR, False),
    ("quality_score", _DBL),
    ("quality_boundary_score", _DBL),
    ("quality_count_score", _DBL),
    ("quality_stats_score", _DBL),
    ("interval_gap_count", _LONG),
    ("interval_gap_avg_seconds", _DBL),
    ("interval_gap_stddev_seconds", _DBL),
    ("interval_gap_cv", _DBL),
    ("quality_interval_score", _DBL),
    ("quality_flags", ArrayType(_STR)),
    ("quality_status", _STR),
    ("refreshed_at", _TS, False),
)

RECONCILIATION = _struct(
    ("bucket_start", _TS, False),
    ("bucket_end", _TS, False),
    ("device_id", _STR, False),
    ("power_topic", _STR),
    ("energy_topic", _STR),
    ("power_numeric_count", _LONG),
    ("energy_numeric_count", _LONG),
    ("power_locf_avg_w", _DBL),
    ("power_linear_avg_w", _DBL),
    ("power_locf_integral_ws", _DBL),
    ("power_linear_integral_ws", _DBL),
    ("energy_locf_value_at_bucket_start", _DBL),
    ("energy_locf_value_at_bucket_end", _DBL),
    ("energy_linear_value_at_bucket_start", _DBL),
    ("energy_linear_value_at_bucket_end", _DBL),
    ("energy_locf_delta_ws", _DBL),
    ("energy_linear_delta_ws", _DBL),
    ("drift_locf_signed_ws", _DBL),
    ("drift_locf_abs_ws", _DBL),
    ("drift_locf_pct", _DBL),
    ("drift_linear_signed_ws", _DBL),
    ("drift_linear_abs_ws", _DBL),
    ("drift_linear_pct", _DBL),
    ("relay_on_seconds", _DBL),
    ("relay_off_seconds", _DBL),
    ("relay_on_pct", _DBL),
    ("relay_off_pct", _DBL),
    ("relay_event_count", _LONG),
    ("relay_state_known", BooleanType()),
    ("status", _STR, False),
    ("refreshed_at", _TS, False),
)

# Compact first/last numeric sample per series and 3-minute bucket: the context
# an incremental refresh reads instead of raw history.
EDGES = _struct(
    ("device_id", _STR, False),
    ("metric_name", _STR, False),
    ("bucket_us", _LONG, False),
    ("first_us", _LONG, False),
    ("first_v", _DBL, False),
    ("last_us", _LONG, False),
    ("last_v", _DBL, False),
)

# The ledger of buckets that fall due with time, and the index of a series' days.
DUE_BUCKET = _struct(
    ("width", _STR, False),
    ("device_id", _STR, False),
    ("metric_name", _STR),
    ("bucket_us", _LONG, False),
    ("touched", _BOOL, False),
)
SERIES_DAYS = _struct(
    ("device_id", _STR, False),
    ("metric_name", _STR, False),
    ("month", _DATE, False),
    ("present", _INT, False),
    ("sampled", _INT, False),
)

IMPORT_BATCH = _struct(
    ("batch_id", _LONG, False),
    ("dump_name", _STR, False),
    ("source_timezone", _STR, False),
    ("source_min_at", _TS),
    ("source_max_at", _TS),
    ("status", _STR, False),
    ("staged_row_count", _LONG, False),
    ("mapped_row_count", _LONG, False),
    ("skipped_row_count", _LONG, False),
    ("inserted_row_count", _LONG, False),
    ("metadata", _STR, False),
    ("created_at", _TS, False),
    ("updated_at", _TS, False),
)

TOPIC_RULE = _struct(
    ("mapping_id", _LONG, False),
    ("priority", IntegerType(), False),
    ("enabled", BooleanType(), False),
    ("source_table", _STR),
    ("rule_type", _STR, False),
    ("source_pattern", _STR, False),
    ("target_topic", _STR),
    ("target_kind", _STR, False),
    ("notes", _STR),
)

# The seven columns of an exported rule file.
RULE_FILE_COLUMNS = (
    "priority",
    "source_table",
    "rule_type",
    "source_pattern",
    "target_topic",
    "target_kind",
    "notes",
)

STAGED_MESSAGE = _struct(
    ("staged_message_id", _LONG, False),
    ("batch_id", _LONG, False),
    ("source_table", _STR, False),
    ("source_created_at", TimestampNTZType(), False),
    ("source_topic", _STR, False),
    ("source_unit", _STR),
    ("source_payload", _STR),
    ("mapping_id", _LONG),
    ("mapped_topic", _STR),
    ("mapped_kind", _STR),
    ("validation_status", _STR, False),
    ("validation_error", _STR),
    ("production_received_at", _TS),
    ("inserted", BooleanType(), False),
    ("relay_inserted", BooleanType(), False),
    ("metadata", _STR, False),
    ("inserted_at", _TS),
)

STAGED_TOPIC = _struct(
    ("staged_topic_id", _LONG, False),
    ("batch_id", _LONG, False),
    ("source_topic", _STR, False),
    ("source_payload", _STR),
    ("mapping_id", _LONG),
    ("mapped_topic", _STR),
    ("mapped_kind", _STR),
    ("validation_status", _STR, False),
    ("validation_error", _STR),
    ("inserted", BooleanType(), False),
    ("metadata", _STR, False),
    ("inserted_at", _TS),
)

REJECTED_MESSAGE = _struct(
    ("batch_id", _LONG, False),
    ("staged_message_id", _LONG),
    ("staged_topic_id", _LONG),
    ("source_table", _STR, False),
    ("source_topic", _STR, False),
    ("source_payload", _STR),
    ("reason", _STR, False),
)


def conform(df, schema: StructType):
    """Project ``df`` on ``schema``: cast present columns, NULL for absent ones."""
    from pyspark.sql import functions as F

    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )
