"""Time-weighted bucket summaries and their neighbours.

A summary describes the distinct sample times of one group (a series, or a
device and a signal) inside one bucket:

====================  =======================================================
``first_us/first_v``  first sample
``last_us/last_v``    last sample
``held_area``         sum of v[i] * (t[i+1] - t[i]), value * seconds
``ramp_area``         sum of (v[i] + v[i+1]) / 2 * (t[i+1] - t[i])
``gap_n``             number of in-bucket gaps
``gap_sq``            sum of squared gaps, exact (square microseconds)
====================  =======================================================

Summaries of adjacent buckets merge by adding the areas, the gap moments and one
crossing gap, so wider buckets are folded from narrower ones without raw rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.clock import SECOND_US

SUMMARY_COLUMNS = (
    "first_us",
    "first_v",
    "last_us",
    "last_v",
    "held_area",
    "ramp_area",
    "gap_n",
    "gap_sq",
)

EDGE_COLUMNS = SUMMARY_COLUMNS[:4]

_SQUARES = "DECIMAL(38,0)"


def _square(gap: str) -> str:
    wide = f"CAST({gap} AS DECIMAL(11,0))"
    return f"CAST({wide} * {wide} AS DECIMAL(22,0))"


def with_steps(rows: DataFrame, cell: Sequence[str], tie: Sequence[str]) -> DataFrame:
    """Mark the kept sample of each instant and link it to the one before.

    ``rows`` carry ``t_us`` and ``v`` (NULL when not numeric). Adds ``kept``,
    ``prev_us`` and ``prev_v`` within each ``cell`` (group and bucket columns).
    Both windows share one exchange and one sort; a following ``groupBy`` on the
    leading cell columns reuses them.
    """
    order = ", ".join(["t_us", "v IS NULL", *tie])
    over = f"PARTITION BY {', '.join(cell)} ORDER BY {order}"
    marked = add_columns(
        rows, {"kept": f"v IS NOT NULL AND NOT (t_us <=> lag(t_us) OVER ({over}))"}
    )
    before = f"({over} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    sample = "IF(kept, named_struct('us', t_us, 'v', v), NULL)"
    linked = add_columns(marked, {"_prev": f"last({sample}) IGNORE NULLS OVER {before}"})
    return add_columns(linked, {"prev_us": "_prev.us", "prev_v": "_prev.v"}).drop("_prev")


def summary_aggregates(prefix: str = "", only: str = "true") -> list[Column]:
    """Aggregates over the rows of :func:`with_steps` giving one summary,
    optionally of the rows where ``only`` holds."""
    kept = f"kept AND {only}"
    kept_us = f"IF({kept}, t_us, NULL)"
    gap = f"IF({kept}, t_us - prev_us, NULL)"
    columns = {
        "first_us": f"min({kept_us})",
        "first_v": f"min_by(v, {kept_us})",
        "last_us": f"max({kept_us})",
        "last_v": f"max_by(v, {kept_us})",
        "held_area": f"coalesce(sum(prev_v * ({gap} / {SECOND_US}D)), 0.0D)",
        "ramp_area": f"coalesce(sum((prev_v + v) / 2.0D * ({gap} / {SECOND_US}D)), 0.0D)",
        "gap_n": f"count({gap})",
        "gap_sq": f"CAST(coalesce(sum({_square(gap)}), 0) AS {_SQUARES})",
    }
    return [F.expr(sql).alias(prefix + name) for name, sql in columns.items()]


def linked_summaries(cells: DataFrame, keys: Sequence[str], prefixes: Sequence[str] = ("",)) -> DataFrame:
    """Add to each summary, per prefix, the gap since the nearest earlier one of the
    same ``keys`` (``_crossing``, microseconds) and the value held through it (``_before_v``)."""
    over = f"(PARTITION BY {', '.join(keys)} ORDER BY bucket_us ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    ends = {}
    for p in prefixes:
        sample = f"IF({p}last_us IS NOT NULL, named_struct('us', {p}last_us, 'v', {p}last_v), NULL)"
        ends[f"_{p}end"] = f"last({sample}) IGNORE NULLS OVER {over}"
    out = add_columns(cells, ends)
    links = {}
    for p in prefixes:
        links |= {f"{p}_crossing": f"{p}first_us - _{p}end.us", f"{p}_before_v": f"_{p}end.v"}
    return add_columns(out, links).drop(*ends)


def folded_aggregates(prefix: str = "") -> list[Column]:
    """Aggregates over the rows of :func:`linked_summaries` giving the merged summary."""
    p = prefix
    seconds = f"({p}_crossing / {SECOND_US}D)"
    columns = {
        "first_us": f"min({p}first_us)",
        "first_v": f"min_by({p}first_v, {p}first_us)",
        "last_us": f"max({p}last_us)",
        "last_v": f"max_by({p}last_v, {p}last_us)",
        "held_area": f"sum({p}held_area + coalesce({p}_before_v * {seconds}, 0.0D))",
        "ramp_area": f"sum({p}ramp_area + coalesce(({p}_before_v + {p}first_v) / 2.0D * {seconds}, 0.0D))",
        "gap_n": f"sum({p}gap_n + CAST({p}_crossing IS NOT NULL AS BIGINT))",
        "gap_sq": f"""CAST(sum(CAST({p}gap_sq + coalesce({_square(f"{p}_crossing")}, 0)
            AS DECIMAL(28,0))) AS {_SQUARES})""",
    }
    return [F.expr(sql).alias(p + name) for name, sql in columns.items()]


def nearest_samples(rows: DataFrame, group: Sequence[str]) -> DataFrame:
    """First and last sample per group, combined before the shuffle. Of several
    samples at the last instant the first in tie order is the kept one; NaN is the largest value."""
    first = "min(IF(v IS NOT NULL, struct(t_us, tie_us, v), NULL))"
    last = "min(IF(v IS NOT NULL, struct(-t_us AS back_us, tie_us, v), NULL))"
    ends = rows.groupBy(*group).agg(F.expr(first).alias("_first"), F.expr(last).alias("_last"))
    return ends.where("_first IS NOT NULL").selectExpr(
        *group,
        "_first.t_us AS first_us",
        "_first.v AS first_v",
        "-_last.back_us AS last_us",
        "_last.v AS last_v",
    )


def with_neighbours(
    buckets: DataFrame, keys: Sequence[str], prefixes: Sequence[str] = ("",)
) -> DataFrame:
    """Add, per prefix, the last sample of the nearest earlier bucket that has one
    (``before_us``, ``before_v``) and the first of the nearest later one
    (``after_us``, ``after_v``). Bucket rows without samples are looked through.

    Works on bucket rows, never raw rows: at most one per bucket width and group.
    """
    # Descending order keeps the running frame linear in the opposite direction.
    running = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    back = f"(PARTITION BY {', '.join(keys)} ORDER BY bucket_us {running})"
    ahead = f"(PARTITION BY {', '.join(keys)} ORDER BY bucket_us DESC {running})"

    def nearest(end: str, over: str) -> str:
        sample = f"IF({end}_us IS NOT NULL, named_struct('us', {end}_us, 'v', {end}_v), NULL)"
        return f"last({sample}) IGNORE NULLS OVER {over}"

    out = add_columns(buckets, {f"_{p}b": nearest(f"{p}last", back) for p in prefixes})
    out = add_columns(out, {f"_{p}a": nearest(f"{p}first", ahead) for p in prefixes})
    ends = {}
    for p in prefixes:
        ends |= {f"{p}before_us": f"_{p}b.us", f"{p}before_v": f"_{p}b.v"}
        ends |= {f"{p}after_us": f"_{p}a.us", f"{p}after_v": f"_{p}a.v"}
    return add_columns(out, ends).drop(*[f"_{p}{side}" for p in prefixes for side in "ab"])


def us_of(width: int | str) -> str:
    """SQL of a width in microseconds: a number, or a column of them."""
    return f"{width}L" if isinstance(width, int) else width


def seconds_of(width: int | str) -> str:
    return f"{width / SECOND_US}D" if isinstance(width, int) else f"({width} / {SECOND_US}D)"


def add_columns(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Append SQL expressions as new columns."""
    return df.selectExpr("*", *[f"{sql} AS {name}" for name, sql in columns.items()])


def _interpolated(at: str, left: str, right: str) -> str:
    between = (
        f"{left}_v + ({right}_v - {left}_v) * (({at} - {left}_us) / ({right}_us - {left}_us))"
    )
    return f"""CASE WHEN {left}_us IS NULL OR {right}_us IS NULL THEN NULL
        WHEN {left}_us = {right}_us THEN {left}_v ELSE {between} END"""


def with_boundaries(buckets: DataFrame, width: int | str, prefix: str = "") -> DataFrame:
    """Boundary values and time-weighted averages of neighboured bucket rows.

    Adds ``locf_start``, ``locf_end``, ``linear_start``, ``linear_end``,
    ``locf_avg`` and ``linear_avg`` (all prefixed). The nearest samples around the
    two boundaries are columns of their own, so each is computed once.
    """
    p = prefix
    start, end = "bucket_us", f"(bucket_us + {us_of(width)})"
    inside = f"{p}first_us IS NOT NULL"
    nearest = {}
    for part in ("us", "v"):
        # Last sample at or before the start; first at or after it; last sample at
        # or before the end. The first at or after the end is "after".
        nearest[f"{p}_sp_{part}"] = (
            f"IF({p}first_us = {start}, {p}first_{part}, {p}before_{part})"
        )
        nearest[f"{p}_sn_{part}"] = f"IF({inside}, {p}first_{part}, {p}after_{part})"
        nearest[f"{p}_ep_{part}"] = f"""CASE WHEN {p}after_us = {end} THEN {p}after_{part}
            WHEN {inside} THEN {p}last_{part} ELSE {p}before_{part} END"""
    values = {
        f"{p}locf_start": f"{p}_sp_v",
        f"{p}locf_end": f"IF({p}after_us IS NOT NULL, {p}_ep_v, NULL)",
        f"{p}linear_start": _interpolated(start, f"{p}_sp", f"{p}_sn"),
        f"{p}linear_end": _interpolated(end, f"{p}_ep", f"{p}after"),
        # The parts of the bucket before its first and after its last sample.
        f"{p}_lead_in": f"({p}first_us - {start}) / {SECOND_US}D",
        f"{p}_lead_out": f"({end} - {p}last_us) / {SECOND_US}D",
        # The bucket has a sample, and both of its boundaries have support.
        f"{p}_held": f"{inside} AND {p}_sp_us IS NOT NULL AND {p}after_us IS NOT NULL",
    }
    seconds = seconds_of(width)
    averages = {
        f"{p}locf_avg": f"""IF({p}_held, ({p}_lead_in * {p}_sp_v + {p}held_area
            + {p}_lead_out * {p}last_v) / {seconds}, NULL)""",
        f"{p}linear_avg": f"""IF({p}_held, (
            {p}_lead_in * ({p}linear_start + {p}first_v) / 2.0D + {p}ramp_area
            + {p}_lead_out * ({p}last_v + {p}linear_end) / 2.0D) / {seconds}, NULL)""",
    }
    return add_columns(add_columns(add_columns(buckets, nearest), values), averages)


def with_gap_statistics(buckets: DataFrame, width: int | str) -> DataFrame:
    """Gaps between the supported boundaries and the distinct sample times inside
    the bucket: adds ``gaps``, ``gap_mean`` and ``gap_deviation`` (seconds) to the
    rows of :func:`with_boundaries`.

    The variance numerator n*sum(g^2) - sum(g)^2 is exact, so an even spacing has
    a deviation of exactly zero.
    """
    edges = {
        # A bucket without samples but with both boundaries is one gap.
        "_opening": f"""CASE
            WHEN first_us > bucket_us AND _sp_us IS NOT NULL THEN first_us - bucket_us
            WHEN first_us IS NULL AND _sp_us IS NOT NULL AND after_us IS NOT NULL
            THEN {us_of(width)} END""",
        "_closing": f"IF(after_us IS NOT NULL, bucket_us + {us_of(width)} - last_us, NULL)",
    }
    moments = {
        "gaps": """coalesce(gap_n, 0L) + CAST(_opening IS NOT NULL AS BIGINT)
            + CAST(_closing IS NOT NULL AS BIGINT)""",
        "_gaps_us": "coalesce(last_us - first_us, 0L) + coalesce(_opening, 0L) + coalesce(_closing, 0L)",
        "_gaps_sq": f"""CAST(coalesce(gap_sq, 0) + coalesce({_square("_opening")}, 0)
            + coalesce({_square("_closing")}, 0) AS DECIMAL(24,0))""",
    }
    statistics = {
        "gap_mean": f"IF(gaps > 0, _gaps_us / gaps / {SECOND_US}D, NULL)",
        "gap_deviation": f"""IF(gaps >= 2, sqrt(CAST(
            CAST(_gaps_sq * CAST(gaps AS DECIMAL(13,0)) AS DECIMAL(38,0))
            - CAST({_square("_gaps_us")} AS DECIMAL(38,0)) AS DOUBLE)
            / (CAST(gaps AS DOUBLE) * (gaps - 1))) / {SECOND_US}D, NULL)""",
    }
    return add_columns(add_columns(add_columns(buckets, edges), moments), statistics)
