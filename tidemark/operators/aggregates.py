"""Bucketed sensor aggregates with boundary values, gaps and quality."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import clock, scores
from tidemark.operators import percentiles as pct
from tidemark.operators import timeweight as tw
from tidemark.sources.checkpoints import cut_lineage

SERIES = ("device_id", "metric_name")
CELL = (*SERIES, "bucket_us")


@dataclass(frozen=True)
class RefreshWindow:
    """Half-open range of a refresh, resolved to microseconds.

    ``lo`` is the start of the bucket holding ``from``. ``cut`` is one width past
    the bucket holding ``to``; without ``to`` it is the minute after the reference
    time, which may fall inside a bucket: that bucket then counts only rows before
    the cut while its boundaries and time weighting see all of its rows.
    """

    width_us: int
    lo: int | None
    cut: int
    reference: int

    @classmethod
    def resolve(
        cls,
        width: str,
        reference_time: datetime | str,
        lo: datetime | str | None = None,
        hi: datetime | str | None = None,
    ) -> RefreshWindow:
        width_us = schemas.WIDTHS[width] * clock.SECOND_US
        reference = clock.to_us(reference_time)

        def floor(us: int) -> int:
            return us - us % width_us

        if hi is None:
            cut = clock.minute_floor_us(reference) + 60 * clock.SECOND_US
        else:
            cut = floor(clock.to_us(hi)) + width_us
        return cls(width_us, None if lo is None else floor(clock.to_us(lo)), cut, reference)

    @property
    def end(self) -> int:
        """First bucket start not touched by the refresh."""
        return self.cut + (-self.cut) % self.width_us

    @property
    def counted_until(self) -> int | None:
        """Where counts end inside the last bucket; None if they end with it."""
        return None if self.cut == self.end else self.cut

    @property
    def closed_until(self) -> int:
        return clock.minute_floor_us(self.reference)

    def inside(self, column: str) -> Column:
        """Range predicate on the raw time column, for pushdown."""
        at = F.col(column)
        bound = at < clock.instant_lit(self.end)
        return bound if self.lo is None else bound & (at >= clock.instant_lit(self.lo))

    def outside(self, column: str) -> Column:
        at = F.col(column)
        late = at >= clock.instant_lit(self.end)
        return late if self.lo is None else late | (at < clock.instant_lit(self.lo))

    @property
    def context_bucket(self) -> str:
        """A bucket start just outside the range, on the side given by ``late``."""
        return f"IF(late, {self.end}L, {(self.lo or 0) - 1}L)"

    def status_sql(self, bucket_end_us: str) -> str:
        return f"IF({bucket_end_us} <= {self.closed_until}L, 'aggregated', 'tba')"


def series_rows(messages: DataFrame) -> DataFrame:
    """The narrow row the aggregates need, for messages that name a series."""
    return messages.where("device_id IS NOT NULL AND metric_name IS NOT NULL").selectExpr(
        *SERIES,
        "topic",
        "numeric_value AS v",
        "unix_micros(received_at) AS t_us",
        "unix_micros(committed_at) AS tie_us",
    )


def in_buckets(rows: DataFrame, width_us: int, name: str = "bucket_us") -> DataFrame:
    return tw.add_columns(rows, {name: f"t_us - pmod(t_us, {width_us}L)"})


def bucket_rows(rows: DataFrame, widths_us: Sequence[int], cut: int | None = None) -> DataFrame:
    """Mergeable summaries of each (series, bucket of the narrowest width).

    Rows are exchanged once, by series and bucket of the widest width, in which the
    others nest. ``cut`` leaves later rows out of the statistics, not of the time weighting.
    """
    narrow, wide = min(widths_us), max(widths_us)
    counted = "" if cut is None else f"t_us < {cut}L AND "
    placed = in_buckets(in_buckets(rows, wide, "unit_us"), narrow).repartition(*SERIES, "unit_us")
    ranked = tw.add_columns(placed, {"cv": f"IF({counted}true, v, NULL)"})
    for width_us in widths_us:
        ranked = pct.with_ranks(ranked, (*SERIES, "unit_us"), "cv", width_us)
    counts = {
        "sample_count": f"count_if({counted}true)",
        "numeric_count": "count(cv)",
        "topic": f"min(IF({counted}true, topic, NULL))",
        "numeric_sum": "sum(cv)",
        "numeric_m2": "var_pop(cv) * count(cv)",
        "numeric_min": "min(cv)",
        "numeric_max": "max(cv)",
        "first_received_us": f"min(IF({counted}true, t_us, NULL))",
        "last_received_us": f"max(IF({counted}true, t_us, NULL))",
    }
    stepped = tw.with_steps(ranked, (*SERIES, "unit_us", "bucket_us"), ["tie_us", "v"])
    return (
        stepped.groupBy(*SERIES, "unit_us", "bucket_us")
        .agg(
            *[F.expr(sql).alias(name) for name, sql in counts.items()],
            *[c for width_us in widths_us for c in pct.picked("cv", width_us)],
            *tw.summary_aggregates(),
        )
        .drop("unit_us")
    )


def fold(buckets: DataFrame, width_us: int, widths_us: Sequence[int]) -> DataFrame:
    """The summaries of wider buckets from those of narrower ones that nest in them.

    ``widths_us`` are the widths whose percentiles are still to be taken over.
    Moments meet around the mean of the wide bucket.
    """
    wide = tw.add_columns(buckets, {"wide_us": f"bucket_us - pmod(bucket_us, {width_us}L)"})
    group = [*SERIES, "wide_us"]
    over = f"(PARTITION BY {', '.join(group)})"
    linked = tw.add_columns(
        tw.linked_summaries(wide, group),
        {"_mean": f"sum(numeric_sum) OVER {over} / nullif(sum(numeric_count) OVER {over}, 0L)"},
    )
    off = "(numeric_sum / nullif(numeric_count, 0L) - _mean)"
    merged = {
        "sample_count": "sum(sample_count)",
        "numeric_count": "sum(numeric_count)",
        "topic": "min(topic)",
        "numeric_sum": "sum(numeric_sum)",
        "numeric_m2": f"sum(IF(numeric_count > 0, numeric_m2 + numeric_count * {off} * {off}, NULL))",
        "numeric_min": "min(numeric_min)",
        "numeric_max": "max(numeric_max)",
        "first_received_us": "min(first_received_us)",
        "last_received_us": "max(last_received_us)",
    }
    return (
        linked.groupBy(*group)
        .agg(
            *[F.expr(sql).alias(name) for name, sql in merged.items()],
            *[c for w in widths_us for c in pct.folded(w)],
            *tw.folded_aggregates(),
        )
        .withColumnRenamed("wide_us", "bucket_us")
    )


def outside_context(rows: DataFrame, window: RefreshWindow) -> DataFrame:
    """Per series the last sample before the range and the first one after it,
    shaped as bucket rows that only lend their samples to their neighbours."""
    sided = tw.add_columns(rows, {"late": f"t_us >= {window.end}L"})
    return tw.nearest_samples(sided, [*SERIES, "late"]).selectExpr(
        *SERIES, f"{window.context_bucket} AS bucket_us", *tw.EDGE_COLUMNS
    )


def finish(
    buckets: DataFrame, window: RefreshWindow, width: int | str, refreshed_us: int | None = None
) -> DataFrame:
    """All output columns from neighboured bucket rows. ``width`` is one for all of
    them, or the column that has it, which is kept."""
    end_us = f"(bucket_us + {tw.us_of(width)})"
    moments = {
        "numeric_avg": "numeric_sum / nullif(numeric_count, 0L)",
        "numeric_variance_samp": "IF(numeric_count > 1, numeric_m2 / (numeric_count - 1), NULL)",
        **pct.blended("numeric_count"),
    }
    spread = {"numeric_stddev_samp": "sqrt(numeric_variance_samp)"}
    measured = tw.add_columns(tw.add_columns(buckets, moments), spread)
    edged = tw.with_gap_statistics(tw.with_boundaries(measured, width), width)
    named = edged.selectExpr(
        *([] if isinstance(width, int) else [width]),
        "timestamp_micros(bucket_us) AS bucket_start",
        f"timestamp_micros({end_us}) AS bucket_end",
        "topic",
        *SERIES,
        "sample_count",
        "numeric_count",
        "numeric_avg",
        "numeric_min",
        "numeric_max",
        "_percentile1 AS numeric_median",
        "_percentile0 AS numeric_p25",
        "_percentile2 AS numeric_p75",
        "numeric_variance_samp",
        "numeric_stddev_samp",
        "numeric_stddev_samp / sqrt(numeric_count) AS numeric_stderr",
        "timestamp_micros(first_received_us) AS first_received_at",
        "timestamp_micros(last_received_us) AS last_received_at",
        "locf_start AS locf_value_at_bucket_start",
        "locf_end AS locf_value_at_bucket_end",
        "locf_avg AS locf_time_weighted_avg",
        "linear_start AS linear_value_at_bucket_start",
        "linear_end AS linear_value_at_bucket_end",
        "linear_avg AS linear_time_weighted_avg",
        f"{window.status_sql(end_us)} AS status",
        f"IF({end_us} <= {window.closed_until}L, gaps, NULL) AS interval_gap_count",
        "gap_mean",
        "gap_deviation",
    )
    measured = tw.add_columns(
        named,
        {
            "numeric_ci95_lower": f"numeric_avg - {scores.Z95}D * numeric_stderr",
            "numeric_ci95_upper": f"numeric_avg + {scores.Z95}D * numeric_stderr",
            "interval_gap_avg_seconds": "IF(interval_gap_count IS NOT NULL, gap_mean, NULL)",
            "interval_gap_stddev_seconds": "IF(interval_gap_count IS NOT NULL, gap_deviation, NULL)",
            "interval_gap_cv": """IF(interval_gap_count IS NOT NULL AND gap_mean > 0,
                gap_deviation / gap_mean, NULL)""",
            "refreshed_at": f"timestamp_micros({refreshed_us or window.reference}L)",
        },
    )
    kept = [] if isinstance(width, int) else [width]
    return with_quality(measured).select(*kept, *schemas.AGGREGATE.fieldNames())


def with_quality(rows: DataFrame) -> DataFrame:
    """Scores, flags and lifecycle; open buckets stay unrated."""
    parts = {
        "quality_boundary_score": scores.boundary_score(),
        "quality_count_score": scores.count_score(),
        "quality_stats_score": scores.stats_score("_doubt"),
        "quality_interval_score": scores.interval_score(),
        "quality_flags": scores.flags("_doubt"),
    }
    rated = tw.add_columns(
        tw.add_columns(rows, {"_doubt": scores.relative_uncertainty()}),
        {name: f"IF(status = 'aggregated', {sql}, NULL)" for name, sql in parts.items()},
    )
    return tw.add_columns(
        rated,
        {
            "quality_score": """round((quality_boundary_score + quality_count_score
                + quality_stats_score + quality_interval_score) / 4, 2)""",
            "quality_status": "IF(status = 'aggregated', 'rated', 'provisional')",
        },
    )


def message_aggregates(
    messages: DataFrame,
    width: str,
    reference_time: datetime | str,
    lo: datetime | str | None = None,
    hi: datetime | str | None = None,
    *,
    context: DataFrame | None = None,
    refreshed_at: datetime | str | None = None,
) -> DataFrame:
    """Aggregates of every (bucket, series) with a message in the range.

    ``context`` lends samples from outside the range (columns of
    ``schemas.EDGES``); without it they are looked up in ``messages``.
    """
    window = RefreshWindow.resolve(width, reference_time, lo, hi)
    rows = series_rows(messages.where(window.inside("received_at")))
    if context is None:
        beyond = messages.where(window.outside("received_at"))
        context = outside_context(series_rows(beyond), window)
    buckets = bucket_rows(rows, [window.width_us], window.counted_until)
    buckets = buckets.select("*", *pct.named(window.width_us))
    return aggregate_buckets(buckets, context, window, window.width_us, refreshed_at)


def common_cut(windows: Mapping[str, RefreshWindow]) -> int | None:
    """Where the counts of all windows end inside a bucket; those that end with one need no cut."""
    cuts = {w.counted_until for w in windows.values()} - {None}
    if len(cuts) > 1:
        raise ValueError("the windows of one pass end their counts at one instant")
    return max(cuts, default=None)


def within(buckets: DataFrame, window: RefreshWindow) -> DataFrame:
    """The bucket rows that start in the range, with their ``width_us``."""
    ours = buckets.where(F.col("bucket_us") < window.end)
    if window.lo is not None:
        ours = ours.where(F.col("bucket_us") >= window.lo)
    return ours.withColumn("width_us", F.lit(window.width_us).cast("long"))


def context_by_width(edges: DataFrame, windows: Mapping[str, RefreshWindow]) -> DataFrame:
    """The edges outside the range of each window, with ``width_us``."""
    none = F.lit(None).cast("long")
    spans = F.array(*[
        F.struct(
            F.lit(w.width_us).cast("long").alias("width_us"),
            (none if w.lo is None else F.lit(w.lo).cast("long")).alias("lo"),
            F.lit(w.end).cast("long").alias("end"),
        )
        for w in windows.values()
    ])
    wide = edges.select("*", F.inline(spans))
    return wide.where("bucket_us >= end OR bucket_us < lo").drop("lo", "end")


def message_aggregates_by_width(
    rows: DataFrame,
    windows: Mapping[str, RefreshWindow],
    context: DataFrame,
    refreshed_at: datetime | str | None = None,
) -> DataFrame:
    """Aggregates at several widths (``width_us``) from one pass over ``rows`` (of
    :func:`series_rows`), which cover the buckets of all ``windows`` whole.

    The narrowest buckets are computed from the rows and kept; each wider width is
    folded from the one before it. ``context`` lends edges by ``width_us``.
    """
    order = sorted(windows.values(), key=lambda w: w.width_us)
    widths_us = [w.width_us for w in order]
    buckets = cut_lineage(bucket_rows(rows, widths_us, common_cut(windows)))
    parts, gone = [], {c for w in widths_us for c in pct.picks(w)}
    for i, window in enumerate(order):
        if i:
            buckets = fold(buckets, window.width_us, widths_us[i:])
            if i + 1 < len(order):
                # The next width reads it as well and does not fold it anew.
                buckets = cut_lineage(buckets)
        parts.append(within(buckets.select("*", *pct.named(window.width_us)), window).drop(*gone))
    together = reduce(DataFrame.unionByName, parts)
    return aggregate_buckets(together, context, order[0], "width_us", refreshed_at)


def aggregate_buckets(
    buckets: DataFrame,
    context: DataFrame,
    window: RefreshWindow,
    width: int | str,
    refreshed_at: datetime | str | None = None,
) -> DataFrame:
    """Aggregates of summarised buckets, with neighbours from them and from ``context``."""
    of_width = [] if isinstance(width, int) else [width]
    lent = context.select(*of_width, *CELL, *tw.EDGE_COLUMNS)
    both = buckets.unionByName(lent, allowMissingColumns=True)
    linked = tw.with_neighbours(both, [*of_width, *SERIES]).where(F.col("sample_count") > 0)
    refreshed = None if refreshed_at is None else clock.to_us(refreshed_at)
    return finish(linked, window, width, refreshed)
