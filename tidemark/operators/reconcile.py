"""Integrated power against energy counters, with relay on/off coverage."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import clock
from tidemark.operators import timeweight as tw
from tidemark.operators.aggregates import RefreshWindow, common_cut, in_buckets, within
from tidemark.sources.checkpoints import cut_lineage

SIGNALS = ("power", "energy", "relay")
CELL = ("device_id", "bucket_us")
GROUP = ("device_id", "signal")


def _meter_topic(metric: str) -> str:
    return f"""topic IN (concat('sensors/', device_id, '/{metric}'),
        concat('shellies/', device_id, '/relay/0/{metric}'))"""


def meter_rows(messages: DataFrame) -> DataFrame:
    """Power and energy samples. A power message on the device's energy topic (or
    the reverse) opens a bucket but carries no sample."""
    metered = messages.where(f"""device_id IS NOT NULL AND metric_name IN ('power', 'energy')
        AND ({_meter_topic('power')} OR {_meter_topic('energy')})""")
    own_topic = " OR ".join(
        f"(metric_name = '{m}' AND {_meter_topic(m)})" for m in ("power", "energy")
    )
    return metered.selectExpr(
        "device_id",
        "metric_name AS signal",
        "topic",
        f"IF({own_topic}, numeric_value, NULL) AS v",
        "unix_micros(received_at) AS t_us",
        "unix_micros(committed_at) AS tie_us",
    )


def relay_rows(relay: DataFrame) -> DataFrame:
    """Events of relay 0 as the signal 1.0 (on) or 0.0 (off). The tie order is
    reversed: of several events at one instant the one committed last holds."""
    return relay.where("relay_index = 0 AND device_id IS NOT NULL").selectExpr(
        "device_id",
        "'relay' AS signal",
        "CAST(NULL AS STRING) AS topic",
        "CAST(is_on AS DOUBLE) AS v",
        "unix_micros(event_at) AS t_us",
        "-unix_micros(committed_at) AS tie_us",
    )


def signal_rows(messages: DataFrame, relay: DataFrame) -> DataFrame:
    """The samples of all three signals in one narrow shape."""
    return meter_rows(messages).unionByName(relay_rows(relay))


def bucket_rows(rows: DataFrame, width_us: int, cut: int | None = None) -> DataFrame:
    """One mergeable row per (device, bucket) with the three signals' summaries.

    Partitioning by (device, bucket) once serves the sample windows and the
    aggregation alike. Rows from ``cut`` on do not count towards the spine.
    """
    before = "" if cut is None else f" AND t_us < {cut}L"
    counts = {
        "meter_rows": f"count_if(signal <> 'relay'{before})",
        "power_topic": "min(IF(signal = 'power' AND v IS NOT NULL, topic, NULL))",
        "energy_topic": "min(IF(signal = 'energy' AND v IS NOT NULL, topic, NULL))",
        "power_numeric_count": "count_if(signal = 'power' AND v IS NOT NULL)",
        "energy_numeric_count": "count_if(signal = 'energy' AND v IS NOT NULL)",
        "relay_event_count": "count_if(signal = 'relay')",
    }
    placed = in_buckets(rows, width_us).repartition(*CELL)
    stepped = tw.with_steps(placed, (*CELL, "signal"), ["tie_us", "v"])
    return stepped.groupBy(*CELL).agg(
        *[F.expr(sql).alias(name) for name, sql in counts.items()],
        *[c for s in SIGNALS for c in tw.summary_aggregates(f"{s}_", f"signal = '{s}'")],
    )


def fold(buckets: DataFrame, width_us: int) -> DataFrame:
    """The rows of wider buckets from those of narrower ones that nest in them."""
    wide = tw.add_columns(buckets, {"wide_us": f"bucket_us - pmod(bucket_us, {width_us}L)"})
    group = ["device_id", "wide_us"]
    prefixes = [f"{s}_" for s in SIGNALS]
    summed = ("meter_rows", "power_numeric_count", "energy_numeric_count", "relay_event_count")
    return (
        tw.linked_summaries(wide, group, prefixes)
        .groupBy(*group)
        .agg(
            *[F.sum(c).alias(c) for c in summed],
            *[F.min(c).alias(c) for c in ("power_topic", "energy_topic")],
            *[c for p in prefixes for c in tw.folded_aggregates(p)],
        )
        .withColumnRenamed("wide_us", "bucket_us")
    )


def outside_context(rows: DataFrame, window: RefreshWindow) -> DataFrame:
    """Nearest samples outside the range, in the columns of ``schemas.EDGES``."""
    sided = tw.add_columns(rows, {"late": f"t_us >= {window.end}L"})
    return tw.nearest_samples(sided, [*GROUP, "late"]).selectExpr(
        "device_id",
        "signal AS metric_name",
        f"{window.context_bucket} AS bucket_us",
        *tw.EDGE_COLUMNS,
    )


def _lent(context: DataFrame, of_width: list[str]) -> DataFrame:
    """Context samples as bucket rows, one column set per signal."""
    return context.selectExpr(
        *of_width,
        *CELL,
        *[
            f"IF(metric_name = '{s}', {c}, NULL) AS {s}_{c}"
            for s in SIGNALS
            for c in tw.EDGE_COLUMNS
        ],
    )


def relay_on_seconds(width: int | str) -> str:
    """Seconds in state on; before its first event a relay counts as on."""
    before = "coalesce(relay_before_v, 1.0D)"
    return f"""IF(relay_first_us IS NULL, {before} * {tw.seconds_of(width)},
        (relay_first_us - bucket_us) / {clock.SECOND_US}D * {before} + relay_held_area
        + (bucket_us + {tw.us_of(width)} - relay_last_us) / {clock.SECOND_US}D * relay_last_v)"""


def finish(
    buckets: DataFrame, window: RefreshWindow, width: int | str, refreshed_us: int | None = None
) -> DataFrame:
    """All output columns; ``width`` is one for all rows, or the column that has it, which is kept."""
    kept = [] if isinstance(width, int) else [width]
    seconds = tw.seconds_of(width)
    end_us = f"(bucket_us + {tw.us_of(width)})"

    def if_any(signal: str, column: str) -> str:
        return f"IF({signal}_numeric_count > 0, {column}, NULL)"

    edged = tw.with_boundaries(buckets, width, "power_")
    edged = tw.with_boundaries(edged, width, "energy_")
    out = edged.selectExpr(
        *kept,
        "timestamp_micros(bucket_us) AS bucket_start",
        f"timestamp_micros({end_us}) AS bucket_end",
        "device_id",
        "power_topic",
        "energy_topic",
        f"{if_any('power', 'power_numeric_count')} AS power_numeric_count",
        f"{if_any('energy', 'energy_numeric_count')} AS energy_numeric_count",
        *[
            f"{if_any('power', f'power_{m}_avg')} AS power_{m}_avg_w"
            for m in ("locf", "linear")
        ],
        *[
            f"{if_any('energy', f'energy_{m}_{side}')} AS energy_{m}_value_at_bucket_{side}"
            for m in ("locf", "linear")
            for side in ("start", "end")
        ],
        f"{relay_on_seconds(width)} AS relay_on_seconds",
        "relay_event_count",
        "true AS relay_state_known",
        f"{window.status_sql(end_us)} AS status",
        f"timestamp_micros({refreshed_us or window.reference}L) AS refreshed_at",
    )
    deltas, signed, relative = {}, {}, {}
    for m in ("locf", "linear"):
        at = f"energy_{m}_value_at_bucket"
        deltas[f"power_{m}_integral_ws"] = f"power_{m}_avg_w * {seconds}"
        deltas[f"energy_{m}_delta_ws"] = f"{at}_end - {at}_start"
        signed[f"drift_{m}_signed_ws"] = f"power_{m}_integral_ws - energy_{m}_delta_ws"
        relative[f"drift_{m}_abs_ws"] = f"abs(drift_{m}_signed_ws)"
        relative[f"drift_{m}_pct"] = (
            f"drift_{m}_signed_ws / nullif(energy_{m}_delta_ws, 0.0D) * 100.0D"
        )
    deltas["relay_off_seconds"] = f"{seconds} - relay_on_seconds"
    signed["relay_on_pct"] = f"relay_on_seconds / {seconds} * 100.0D"
    signed["relay_off_pct"] = f"relay_off_seconds / {seconds} * 100.0D"
    for columns in (deltas, signed, relative):
        out = tw.add_columns(out, columns)
    return out.select(*kept, *schemas.RECONCILIATION.fieldNames())


def power_energy_reconciliation(
    messages: DataFrame,
    relay: DataFrame,
    width: str,
    reference_time: datetime | str,
    lo: datetime | str | None = None,
    hi: datetime | str | None = None,
    *,
    context: DataFrame | None = None,
    refreshed_at: datetime | str | None = None,
) -> DataFrame:
    """One row per (bucket, device) with a power or energy message in the range."""
    window = RefreshWindow.resolve(width, reference_time, lo, hi)
    rows = signal_rows(
        messages.where(window.inside("received_at")), relay.where(window.inside("event_at"))
    )
    if context is None:
        beyond = signal_rows(
            messages.where(window.outside("received_at")), relay.where(window.outside("event_at"))
        )
        context = outside_context(beyond, window)
    buckets = bucket_rows(rows, window.width_us, window.counted_until)
    return reconcile_buckets(buckets, context, window, window.width_us, refreshed_at)


def reconciliation_by_width(
    rows: DataFrame,
    windows: Mapping[str, RefreshWindow],
    context: DataFrame,
    refreshed_at: datetime | str | None = None,
) -> DataFrame:
    """Reconciliation at several widths (``width_us``) from one pass over ``rows`` (of
    :func:`signal_rows`), which cover the buckets of all ``windows`` whole.
    ``context`` lends edges by ``width_us``."""
    order = sorted(windows.values(), key=lambda w: w.width_us)
    buckets = cut_lineage(bucket_rows(rows, order[0].width_us, common_cut(windows)))
    parts = []
    for i, window in enumerate(order):
        if i:
            buckets = fold(buckets, window.width_us)
            if i + 1 < len(order):
                buckets = cut_lineage(buckets)
        parts.append(within(buckets, window))
    together = reduce(DataFrame.unionByName, parts)
    return reconcile_buckets(together, context, order[0], "width_us", refreshed_at)


def reconcile_buckets(
    buckets: DataFrame,
    context: DataFrame,
    window: RefreshWindow,
    width: int | str,
    refreshed_at: datetime | str | None = None,
) -> DataFrame:
    """Reconciliation of summarised buckets, with neighbours from them and from ``context``."""
    of_width = [] if isinstance(width, int) else [width]
    both = buckets.unionByName(_lent(context, of_width), allowMissingColumns=True)
    linked = tw.with_neighbours(both, [*of_width, "device_id"], [f"{s}_" for s in SIGNALS])
    refreshed = None if refreshed_at is None else clock.to_us(refreshed_at)
    return finish(linked.where(F.col("meter_rows") > 0), window, width, refreshed)
