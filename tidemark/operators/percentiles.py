"""Exact percentiles by rank, foldable from narrow buckets to wide ones.

The values of a bucket are ranked by one sort, which spills, and the two order
statistics around each fraction are picked out by their rank. Each of them lies in
exactly one narrow bucket, so a wide bucket takes over whatever of them its narrow
ones hold. No buffer grows with a bucket, and no plan depends on its size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FRACTIONS = (0.25, 0.5, 0.75)


def picks(width_us: int) -> list[str]:
    """Names of the picked order statistics of a width."""
    return [f"_q{width_us}_{side}{i}" for i in range(len(FRACTIONS)) for side in ("low", "high")]


def with_ranks(rows: DataFrame, group: Sequence[str], value: str, width_us: int) -> DataFrame:
    """Add the rank from 0 of each row's ``value`` among those of its bucket of the width, and their number."""
    cell = f"PARTITION BY {', '.join(group)}, t_us - pmod(t_us, {width_us}L) ORDER BY {value} NULLS LAST"
    whole = "ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING"
    return rows.selectExpr(
        "*",
        f"IF({value} IS NULL, NULL, row_number() OVER ({cell}) - 1) AS _rank{width_us}",
        f"count({value}) OVER ({cell} {whole}) AS _of{width_us}",
    )


def picked(value: str, width_us: int) -> list[Column]:
    """Aggregates that pick the order statistics of the width around each fraction."""
    wanted = [
        f"max(IF(_rank{width_us} = {side}({f}D * (_of{width_us} - 1)), {value}, NULL))"
        for f in FRACTIONS
        for side in ("floor", "ceil")
    ]
    return [F.expr(sql).alias(name) for sql, name in zip(wanted, picks(width_us), strict=True)]


def folded(width_us: int) -> list[Column]:
    """Aggregates that take the picks of the width over from narrower buckets."""
    return [F.max(name).alias(name) for name in picks(width_us)]


def named(width_us: int) -> list[Column]:
    """The picks of the width under names of their own, ``_q_<side><i>``."""
    return [F.col(name).alias(name.replace(str(width_us), "")) for name in picks(width_us)]


def blended(count: str) -> dict[str, str]:
    """``_percentile<i>``: linear interpolation between the named picks of ``count`` values."""
    out = {}
    for i, f in enumerate(FRACTIONS):
        low, high = f"_q_low{i}", f"_q_high{i}"
        at = f"({f}D * ({count} - 1))"
        out[f"_percentile{i}"] = f"""IF({low} = {high}, {low},
            {low} * (ceil{at} - {at}) + {high} * ({at} - floor{at}))"""
    return out
