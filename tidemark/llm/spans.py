"""Where a pattern matches in a text, with SQL functions only.

Java's ``split`` and ``regexp_extract_all`` run the same leftmost, non-overlapping search, so the
pieces between the matches and the matches themselves give every position. Positions count code
points; ends are exclusive. Patterns are possessive and anchored to the start of a run, which
finds the same matches as their plain forms in time linear in the text.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.llm.common import bind, running


@dataclass(frozen=True)
class Kind:
    """A kind of span: matches of ``pattern`` of which ``test`` is true, in texts that match ``needs``."""

    name: str
    pattern: str
    test: Callable[[Column], Column] | None = None
    needs: str | None = None


SPAN = "array<struct<start:int,stop:int,value:string>>"


def matches(text: Column, pattern: str) -> Column:
    """Array of (start, stop, value) of all matches of the pattern."""

    def placed(found: Column) -> Column:
        steps = F.zip_with(
            F.slice(F.split(text, pattern, -1), 1, F.size(found)), found, lambda gap, m: F.length(gap) + F.length(m)
        )
        return bind(
            steps,
            lambda lengths: F.zip_with(
                found,
                running(lengths, "int", lambda a, b: a + b),
                lambda m, stop: F.struct((stop - F.length(m)).alias("start"), stop.alias("stop"), m.alias("value")),
            ),
        )

    return bind(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda found: F.when(F.size(found) > 0, placed(found)).otherwise(F.array().cast(SPAN)),
    )


def kind_spans(text: Column, kind: Kind) -> Column:
    """The matches of a kind that hold; texts without its rarest character are not searched."""
    found = matches(text, kind.pattern)
    if kind.test:
        found = F.filter(found, lambda x: kind.test(x["value"]))
    if kind.needs:
        found = F.when(text.rlike(kind.needs), found).otherwise(F.array().cast(SPAN))
    return found


def digest(spans: Column) -> Column:
    """``kind:start:end`` of an array of (kind, start, stop), comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def count_of(spans: Column, kind: str) -> Column:
    """``n_<kind>``: how many of the spans are of the kind."""
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
