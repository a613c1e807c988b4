"""Keeping the derived tables of a store in step with its raw tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import clock
from tidemark.operators import aggregates as agg
from tidemark.operators import reconcile as rec
from tidemark.operators import timeweight as tw
from tidemark.sources.checkpoints import cut_lineage
from tidemark.sources.store import Store
from tidemark.streaming.touched import with_dependents

EDGE_WIDTH_US = schemas.WIDTHS["3m"] * clock.SECOND_US
DAY_US = 86_400 * clock.SECOND_US
MINUTE = "yyyyMMddHHmm"


def _day(column: str = "bucket_us") -> Column:
    return F.col(column) - F.pmod(F.col(column), F.lit(DAY_US))


def _dates(rows: DataFrame, column: str = "bucket_us") -> list:
    """Days of the rows, for partition pruning: bounded by the calendar."""
    days = rows.select(F.to_date(clock.instant(column)).alias("d")).distinct()
    return [row.d for row in days.collect()]


def _open_windows(reference_time: datetime | str) -> dict[str, agg.RefreshWindow]:
    """Windows that count every row of the buckets they are given."""
    far = clock.to_us("9000-01-01")
    reference = clock.to_us(reference_time)
    widths = {w: s * clock.SECOND_US for w, s in schemas.WIDTHS.items()}
    # All end at one instant that is a bucket's end at any width.
    return {w: agg.RefreshWindow(us, None, far - far % DAY_US, reference) for w, us in widths.items()}


# --- edges ---------------------------------------------------------------------


def edge_cells(messages: DataFrame, relay: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The 3-minute buckets in which messages or relay events lie, of series also
    those without samples: (series, ``bucket_us``, ``sampled``) and (device, ``bucket_us``)."""
    named = agg.in_buckets(agg.series_rows(messages), EDGE_WIDTH_US)
    switched = agg.in_buckets(rec.relay_rows(relay), EDGE_WIDTH_US)
    return (
        cut_lineage(named.groupBy(*agg.CELL).agg(F.expr("bool_or(v IS NOT NULL)").alias("sampled"))),
        cut_lineage(switched.select(*rec.CELL).distinct()),
    )


def rebuild_edges(store: Store, named: DataFrame, switched: DataFrame) -> None:
    """First and last samples of the given 3-minute buckets, read back from the
    raw tables, and the index of their days; buckets that lost all samples lose
    their row."""
    days = _dates(named)
    raw = store.read("messages").where(F.col("received_date").isin(days))
    sampled = named.where("sampled").drop("sampled")
    rows = agg.in_buckets(agg.series_rows(raw), EDGE_WIDTH_US)
    edges = tw.nearest_samples(rows.join(sampled, list(agg.CELL), "left_semi"), agg.CELL)
    _replace_edges(store, "sample_edges", edges, sampled, agg.CELL, _dates(sampled))
    dated = tw.add_columns(agg.series_rows(raw), {"day_us": f"t_us - pmod(t_us, {DAY_US}L)"})
    touched = named.select(*agg.SERIES, _day().alias("day_us")).distinct()
    held = dated.join(touched, [*agg.SERIES, "day_us"], "left_semi")
    _index_days(store, "series_days", held, touched)

    days = _dates(switched)
    events = store.read("relay_state_events").where(F.col("event_date").isin(days))
    rows = agg.in_buckets(rec.relay_rows(events), EDGE_WIDTH_US)
    edges = tw.nearest_samples(rows.join(switched, list(rec.CELL), "left_semi"), rec.CELL)
    edges = edges.withColumn("metric_name", F.lit("relay"))
    _replace_edges(store, "relay_edges", edges, switched, rec.CELL, days)
    dated = tw.add_columns(
        rec.relay_rows(events), {"metric_name": "'relay'", "day_us": f"t_us - pmod(t_us, {DAY_US}L)"}
    )
    touched = switched.select(
        "device_id", F.lit("relay").alias("metric_name"), _day().alias("day_us")
    ).distinct()
    held = dated.join(touched, [*agg.SERIES, "day_us"], "left_semi")
    _index_days(store, "relay_days", held, touched)


def _replace_edges(store, name, edges, cells, keys, days) -> None:
    old = store.read(name).where(F.col("bucket_date").isin(days))
    kept = old.join(cells, list(keys), "left_anti").drop("bucket_date")
    result = cut_lineage(kept.unionByName(edges))
    store.replace_partitions(result, name)
    emptied = {str(d) for d in days} - {str(d) for d in _dates(result)}
    store.drop_partitions(name, "bucket_date", lambda day: day not in emptied)


def update_edges(store: Store, messages: DataFrame, relay: DataFrame) -> None:
    """Bring the edges and day index of an appended batch's buckets up to date."""
    rebuild_edges(store, *edge_cells(messages, relay))


# --- index of days ---------------------------------------------------------------


def _index_days(store: Store, name: str, held: DataFrame, touched: DataFrame) -> None:
    """Set the bits of the touched (series, ``day_us``) to what their raw rows say.

    A month is one row per series with two bitmaps: days with rows, days with samples.
    """
    now = held.groupBy(*agg.SERIES, "day_us").agg(F.expr("bool_or(v IS NOT NULL)").alias("has"))
    bit = "shiftleft(1, day(timestamp_micros(day_us)) - 1)"
    marks = (
        touched.join(now, [*agg.SERIES, "day_us"], "left")
        .selectExpr(
            *agg.SERIES,
            "to_date(date_trunc('MONTH', timestamp_micros(day_us))) AS month",
            f"{bit} AS changed",
            f"IF(has IS NULL, 0, {bit}) AS present",
            f"IF(has, {bit}, 0) AS sampled",
        )
        .groupBy(*agg.SERIES, "month")
        .agg(*[F.bit_or(c).alias(c) for c in ("changed", "present", "sampled")])
    )
    marks = cut_lineage(marks)
    months = [r.month for r in marks.select("month").distinct().collect()]
    old = store.read(name).where(F.col("month").isin(months))
    old = old.select(*agg.SERIES, "month", F.col("present").alias("p"), F.col("sampled").alias("s"))
    merged = marks.join(old, [*agg.SERIES, "month"], "left").selectExpr(
        *agg.SERIES,
        "month",
        "(coalesce(p, 0) & ~changed) | present AS present",
        "(coalesce(s, 0) & ~changed) | sampled AS sampled",
    )
    store.upsert(merged, name)


def _indexed(store: Store, names: Sequence[str]) -> DataFrame:
    """The index by day: series, ``bucket_us`` (the day's start), ``sampled``."""
    months = reduce(DataFrame.unionByName, [store.read(n) for n in names])
    days = months.select(*agg.SERIES, "month", "sampled", F.explode(F.expr(
        "filter(sequence(0, 30), d -> (shiftright(present, d) & 1) = 1)"
    )).alias("d"))
    start = "unix_micros(CAST(month AS TIMESTAMP))"
    return days.selectExpr(
        *agg.SERIES, f"{start} + d * {DAY_US}L AS bucket_us", "(shiftright(sampled, d) & 1) = 1 AS sampled"
    )


def _reach(touched: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The days (``bucket_us``) that may depend on touched ones or lend them a
    sample: up to the nearest sampled day on either side."""
    ours = known.join(touched.select(*keys).distinct(), list(keys), "left_semi")
    return cut_lineage(with_dependents(touched, ours, tuple(keys)))


def _on_days(rows: DataFrame, days: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows (with ``bucket_date``) on the given days of their keys; the dates prune partitions."""
    dated = days.select(*keys, F.to_date(clock.instant("bucket_us")).alias("bucket_date")).distinct()
    return rows.where(F.col("bucket_date").isin(_dates(days))).join(dated, [*keys, "bucket_date"], "left_semi")


def _width_us() -> Column:
    """The width of the column ``width`` in microseconds."""
    us = {w: F.lit(s * clock.SECOND_US).cast("long") for w, s in schemas.WIDTHS.items()}
    return F.element_at(F.create_map(*[x for w in us for x in (F.lit(w), us[w])]), F.col("width"))


def _at_widths(edges: DataFrame, *columns) -> DataFrame:
    """Edge rows as sampled buckets of all widths."""
    wide = edges.select("*", F.explode(F.array(*[F.lit(w) for w in schemas.WIDTHS])).alias("width"))
    bucket = F.col("bucket_us") - F.pmod(F.col("bucket_us"), _width_us())
    return wide.select("width", *columns, bucket.alias("bucket_us"), F.lit(True).alias("sampled")).distinct()


def _at_each(edges: DataFrame) -> DataFrame:
    """Edges once for each width (``width_us``)."""
    us = [F.lit(s * clock.SECOND_US).cast("long") for s in schemas.WIDTHS.values()]
    return edges.select("*", F.explode(F.array(*us)).alias("width_us"))


def _named_widths(rows: DataFrame) -> DataFrame:
    names = {s * clock.SECOND_US: w for w, s in schemas.WIDTHS.items()}
    name = F.create_map(*[F.lit(x).cast(k) for pair in names.items() for x, k in zip(pair, ("long", "string"), strict=True)])
    return rows.withColumn("width", F.element_at(name, F.col("width_us"))).drop("width_us")


def _signal_edges(store: Store) -> DataFrame:
    meters = store.read("sample_edges").where(F.col("metric_name").isin("power", "energy"))
    return meters.unionByName(store.read("relay_edges"))


def _signal_days(store: Store) -> DataFrame:
    """The index by day of the three signals: device, ``signal``, ``bucket_us``, ``sampled``.

    A day on which the device has power or energy rows has spine rows for all three.
    """
    days = _indexed(store, ["series_days"]).where(F.col("metric_name").isin("power", "energy"))
    relay = _indexed(store, ["relay_days"])
    own = days.unionByName(relay).withColumnRenamed("metric_name", "signal")
    spine = days.select("device_id", "bucket_us").distinct()
    every = spine.select(
        "device_id", F.explode(F.array(*[F.lit(s) for s in rec.SIGNALS])).alias("signal"), "bucket_us", F.lit(False).alias("sampled")
    )
    return own.unionByName(every)


# --- recomputing buckets ------------------------------------------------------------


def _lent(edges: DataFrame, days: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Edges that lend samples to whole recomputed ``days`` (keys, ``bucket_us``):
    those of the nearest sampled day on either side."""
    near = _reach(days, known, keys).join(days, [*keys, "bucket_us"], "left_anti")
    lending = known.where("sampled").select(*keys, "bucket_us")
    return _on_days(edges, cut_lineage(near.join(lending, [*keys, "bucket_us"], "left_semi")), keys)


def refresh_series_buckets(store: Store, buckets: DataFrame, reference_time: datetime | str) -> None:
    """Recompute the aggregates of given (width, series, ``bucket_us``).

    Their days are read once, whole, for all widths, and no other day but the
    nearest sampled one on either side.
    """
    wanted = cut_lineage(buckets.select("width", *agg.CELL).distinct())
    days = cut_lineage(wanted.select(*agg.SERIES, _day().alias("bucket_us")).distinct())
    dates = _dates(days)
    if not dates:
        return
    raw = store.read("messages").where(F.col("received_date").isin(dates))
    rows = agg.series_rows(raw).withColumn("day_us", _day("t_us"))
    rows = rows.join(days.withColumnRenamed("bucket_us", "day_us"), [*agg.SERIES, "day_us"], "left_semi").drop("day_us")
    context = cut_lineage(_lent(store.read("sample_edges"), days, _indexed(store, ["series_days"]), agg.SERIES))
    windows = _open_windows(reference_time)
    out = _named_widths(agg.message_aggregates_by_width(rows, windows, _at_each(context)))
    keys = wanted.select("width", *agg.SERIES, clock.instant("bucket_us").alias("bucket_start"))
    store.upsert(out.join(keys, ["width", *agg.SERIES, "bucket_start"], "left_semi"), "message_aggregates")


def refresh_device_buckets(store: Store, buckets: DataFrame, reference_time: datetime | str) -> None:
    """Recompute the reconciliation of given (width, device, ``bucket_us``), read likewise."""
    wanted = cut_lineage(buckets.select("width", *rec.CELL).distinct())
    days = cut_lineage(wanted.select("device_id", _day().alias("bucket_us")).distinct())
    dates = _dates(days)
    if not dates:
        return
    raw = store.read("messages").where(F.col("received_date").isin(dates))
    switched = store.read("relay_state_events").where(F.col("event_date").isin(dates))
    rows = rec.signal_rows(raw, switched).withColumn("day_us", _day("t_us"))
    rows = rows.join(days.withColumnRenamed("bucket_us", "day_us"), ["device_id", "day_us"], "left_semi").drop("day_us")
    signals = days.select(
        "device_id", F.explode(F.array(*[F.lit(s) for s in rec.SIGNALS])).alias("signal"), "bucket_us"
    )
    edges = _signal_edges(store).withColumn("signal", F.col("metric_name"))
    context = cut_lineage(_lent(edges, signals, _signal_days(store), rec.GROUP))
    windows = _open_windows(reference_time)
    out = _named_widths(rec.reconciliation_by_width(rows, windows, _at_each(context)))
    keys = wanted.select("width", "device_id", clock.instant("bucket_us").alias("bucket_start"))
    store.upsert(out.join(keys, ["width", "device_id", "bucket_start"], "left_semi"), "power_energy_reconciliation")


# --- what a batch touches ------------------------------------------------------------


def touched_series(messages: DataFrame, only: str = "true") -> DataFrame:
    """(width, series, ``bucket_us``) of the messages that name a series and of which ``only`` holds."""
    rows = messages.where(f"device_id IS NOT NULL AND metric_name IS NOT NULL AND {only}")
    cells = rows.select(*agg.SERIES, clock.micros("received_at").alias("bucket_us"))
    return _at_widths(cells, *agg.SERIES).drop("sampled")


def touched_devices(messages: DataFrame, relay: DataFrame) -> DataFrame:
    """(width, device, ``signal``, ``bucket_us``) of the samples of the three signals."""
    rows = rec.signal_rows(messages, relay).withColumnRenamed("t_us", "bucket_us")
    return _at_widths(rows, *rec.GROUP).drop("sampled")


def series_dependents(store: Store, touched: DataFrame) -> DataFrame:
    """The touched (width, series, ``bucket_us``) and those whose values depend on them."""
    touched = cut_lineage(touched.select("width", *agg.CELL).distinct())
    days = touched.select(*agg.SERIES, _day().alias("bucket_us")).distinct()
    near = _reach(days, _indexed(store, ["series_days"]), agg.SERIES)
    spine = _on_days(store.read("message_aggregates"), near, agg.SERIES).select(
        "width", *agg.SERIES, clock.micros("bucket_start").alias("bucket_us"), F.lit(False).alias("sampled")
    )
    sampled = _at_widths(_on_days(store.read("sample_edges"), near, agg.SERIES), *agg.SERIES)
    return with_dependents(touched, spine.unionByName(sampled), ("width", *agg.SERIES))


def device_dependents(store: Store, touched: DataFrame) -> DataFrame:
    """The (width, device, ``bucket_us``) that depend on touched samples.

    Each signal has its own neighbours; a relay event moves the opening state of
    every row up to the device's next bucket with events.
    """
    touched = cut_lineage(touched.select("width", *rec.GROUP, "bucket_us").distinct())
    days = touched.select(*rec.GROUP, _day().alias("bucket_us")).distinct()
    near = _reach(days, _signal_days(store), rec.GROUP)
    every = F.explode(F.array(*[F.lit(s) for s in rec.SIGNALS])).alias("signal")
    rows = store.read("power_energy_reconciliation").select("*", every)
    spine = _on_days(rows, near, rec.GROUP).select(
        "width", *rec.GROUP, clock.micros("bucket_start").alias("bucket_us"), F.lit(False).alias("sampled")
    )
    edges = _signal_edges(store).withColumn("signal", F.col("metric_name"))
    sampled = _at_widths(_on_days(edges, near, rec.GROUP), *rec.GROUP)
    found = with_dependents(touched, spine.unionByName(sampled), ("width", *rec.GROUP))
    return found.select("width", *rec.CELL)


def refresh_touched(store: Store, messages: DataFrame, relay: DataFrame, reference_time: datetime | str) -> None:
    """Recompute what an ingest batch touched and what depends on it.

    Dependents are the rows up to the nearest sampled bucket on either side, so
    late data of any age leaves the tables as a full refresh would. Messages of
    kind ``status`` leave the sensor aggregates to the next minute.
    """
    series = series_dependents(store, touched_series(messages, "topic_kind <> 'status'"))
    refresh_series_buckets(store, series, reference_time)
    devices = device_dependents(store, touched_devices(messages, relay))
    refresh_device_buckets(store, devices, reference_time)


# --- what the clock makes due ---------------------------------------------------------


def _minute(us: Column) -> Column:
    return F.date_format(clock.instant(us), MINUTE)


def note_due(store: Store, messages: DataFrame, relay: DataFrame, batch: str, reference_time: datetime | str) -> None:
    """Enter what the passing of time will have to do for an appended batch in the ledger.

    Buckets still open are due when they end. Series touched by messages of kind
    ``status`` are due at once, with their dependents (``touched``). Repeating the
    batch replaces its entries.
    """
    now = clock.minute_floor_us(clock.to_us(reference_time))
    series = touched_series(messages).withColumn("touched", F.lit(False))
    devices = touched_devices(messages, relay).select("width", *rec.CELL, F.lit(False).alias("touched")).distinct()
    open_ = _ends(series.unionByName(devices, allowMissingColumns=True)).where(F.col("due_us") > now)
    status = touched_series(messages, "topic_kind = 'status'").withColumns(
        {"touched": F.lit(True), "due_us": F.lit(now)}
    )
    entries = open_.unionByName(status).withColumn("due", _minute(F.col("due_us")))
    store.append(entries, "due_buckets", batch)


def _ends(buckets: DataFrame) -> DataFrame:
    return buckets.withColumn("due_us", F.col("bucket_us") + _width_us())


def _note_open(store: Store, reference_time: datetime | str) -> None:
    """Enter the rows that a refresh left open: they start on the last day or later."""
    now = clock.minute_floor_us(clock.to_us(reference_time))
    late = F.col("bucket_date") >= F.to_date(clock.instant_lit(now - DAY_US))
    at = clock.micros("bucket_start").alias("bucket_us")
    unrated = late & (F.col("status") == "tba")
    series = store.read("message_aggregates").where(unrated).select("width", *agg.SERIES, at)
    devices = store.read("power_energy_reconciliation").where(unrated).select("width", "device_id", at)
    entries = _ends(series.unionByName(devices, allowMissingColumns=True)).withColumns(
        {"touched": F.lit(False), "due": _minute(F.col("due_us"))}
    )
    store.append(entries, "due_buckets", f"refresh-{uuid.uuid4().hex}")


def close_buckets(store: Store, reference_time: datetime | str) -> None:
    """The job of each minute: rate the buckets that have ended and bring in the
    series of status messages, as the ledger has them.

    Only the minutes due are read. They leave the ledger when their rows are
    written; after a failure in between the same work is done again.
    """
    now = _minute_text(reference_time)
    folders = store.partition_folders("due_buckets", "due", lambda due: due <= now)
    if not folders:
        return
    due = cut_lineage(store.read_folders("due_buckets", folders))
    series = due.where("metric_name IS NOT NULL")
    touched = cut_lineage(series_dependents(store, series.where("touched")))
    closing = series.where("NOT touched").select("width", *agg.CELL)
    refresh_series_buckets(store, closing.unionByName(touched), reference_time)
    refresh_device_buckets(store, due.where("metric_name IS NULL"), reference_time)
    if touched.limit(1).count():
        # Rows that status messages opened end later.
        _note_open_of(store, touched, reference_time)
    store.remove_folders(folders)


def _minute_text(moment: datetime | str) -> str:
    return clock.from_us(clock.minute_floor_us(clock.to_us(moment))).strftime("%Y%m%d%H%M")


def _note_open_of(store: Store, buckets: DataFrame, reference_time: datetime | str) -> None:
    now = clock.minute_floor_us(clock.to_us(reference_time))
    entries = _ends(buckets.select("width", *agg.CELL)).where(F.col("due_us") > now)
    entries = entries.withColumns({"touched": F.lit(False), "due": _minute(F.col("due_us"))})
    store.append(entries, "due_buckets", f"refresh-{uuid.uuid4().hex}")


# --- ranges ------------------------------------------------------------------------


def refresh_range(
    store: Store,
    reference_time: datetime | str,
    lo: datetime | str | None = None,
    hi: datetime | str | None = None,
    widths: Iterable[str] = tuple(schemas.WIDTHS),
) -> None:
    """Recompute all derived rows of a range; without bounds, of all raw history.

    Each family of tables reads its raw rows once, for all widths.
    """
    windows = {w: agg.RefreshWindow.resolve(w, reference_time, lo, hi) for w in widths}
    end = max(w.end for w in windows.values())
    start = None if lo is None else min(w.lo for w in windows.values())

    def inside(rows: DataFrame, time: str, day: str) -> DataFrame:
        kept = rows.where((F.col(time) < clock.instant_lit(end)) & (F.col(day) <= F.to_date(clock.instant_lit(end))))
        if start is None:
            return kept
        first = clock.instant_lit(start)
        return kept.where((F.col(time) >= first) & (F.col(day) >= F.to_date(first)))

    messages = inside(store.read("messages"), "received_at", "received_date")
    relay = inside(store.read("relay_state_events"), "event_at", "event_date")
    context = agg.context_by_width(store.read("sample_edges"), windows)
    out = agg.message_aggregates_by_width(agg.series_rows(messages), windows, context)
    store.upsert(_named_widths(out), "message_aggregates")
    context = agg.context_by_width(_signal_edges(store), windows)
    out = rec.reconciliation_by_width(rec.signal_rows(messages, relay), windows, context)
    store.upsert(_named_widths(out), "power_energy_reconciliation")
    _note_open(store, reference_time)
