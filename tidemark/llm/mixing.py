"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import n_words_of, unique_name, written

OFFSET_BITS = 20


def targets(sizes: DataFrame, weights: Sequence[int], budget: float, most: int) -> DataFrame:
    """``source``, ``source_size``, ``target`` for one row per source of ``sizes``.

    Sources in code-point order, null last, weigh ``weights`` in turn and share ``budget`` times
    all sizes. No target exceeds ``most`` times its source; the excess is shared again by weight
    until none does, which gives each source the lesser of that bound and ``level`` times its
    weight. The level is the greatest of those found by capping the sources in the order of
    bound over weight, one more at a time.
    """
    turn = Window.orderBy(F.col("source").asc_nulls_last())
    weighed = sizes.withColumn(
        "weight",
        F.element_at(F.array(*(F.lit(w) for w in weights)), ((F.row_number().over(turn) - 1) % len(weights) + 1).cast("int")),
    ).withColumn("bound", F.col("source_size") * most)
    order = [(F.col("bound") / F.col("weight")).asc(), F.col("source").asc_nulls_last()]
    below = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    above = Window.orderBy(*order).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = (
        F.lit(budget) * F.sum("source_size").over(everything) - F.coalesce(F.sum("bound").over(below), F.lit(0))
    ) / F.sum("weight").over(above)
    return weighed.withColumn("level", level).select(
        "source",
        "source_size",
        F.least(F.col("bound").cast("double"), F.max("level").over(everything) * F.col("weight")).alias("target"),
    )


def offset(source: str, seed: int) -> Column:
    """One offset in [0, 1) per source; of few bits, so that sums with whole numbers are exact."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.concat(F.lit("="), source), F.lit("null"))))
    return F.conv(F.substring(digest, 1, OFFSET_BITS // 4), 16, 10).cast("double") / (1 << OFFSET_BITS)


def mixture(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = (3, 1, 2),
    budget: float = 1.5,
    most: int = 2,
    seed: int = 11,
) -> DataFrame:
    """One row per document: ``id``, ``source``, ``size``, ``source_size``, ``target``, ``copies``, ``taken``.

    Each document of a source is expected ``target / source_size`` times. Within a source, in the
    order of size and id, the prefix sums of expected copies are shifted by the source's offset,
    and a document is taken once for each whole number its step crosses. As neighbours in that
    order have like sizes, the words taken differ from the target by about one document.

    Sizes count words; null and blank texts have size 0 and are taken without effect. A null
    source is a source of its own. Ties in size and id are interchangeable. The same rows give the
    same result. Other columns are not read; no rows give no rows.
    """
    sized = docs.select(
        F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), n_words_of(F.col(text_col)).alias("size")
    )
    # Ranges of (source, size, id) are even however large a source is.
    dealt = sized.repartitionByRange("source", "size", "id").withColumn("part", F.spark_partition_id())
    dealt = written(dealt, "mix-ranges")
    counts = dealt.groupBy("part", "source").agg(F.count("*").alias("n"), F.sum("size").alias("words"))
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = written(counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))), "mix-counts")
    wanted = targets(counts.groupBy("source").agg(F.sum("words").alias("source_size")), weights, budget, most)
    wanted = wanted.withColumnRenamed("source", "of_source")
    starts = counts.join(wanted, F.col("source").eqNullSafe(F.col("of_source"))).select(
        F.col("part").alias("of_part"), "of_source", "before", "source_size", "target"
    )
    within = Window.partitionBy("part", "source").orderBy("size", "id")
    ranked = dealt.withColumn("rank", F.row_number().over(within))
    placed = ranked.join(
        starts, (F.col("part") == F.col("of_part")) & F.col("source").eqNullSafe(F.col("of_source"))
    ).withColumn("place", F.col("before") + F.col("rank"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    start = offset("source", seed)
    copies = F.floor(start + F.col("place") * rate) - F.floor(start + (F.col("place") - 1) * rate)
    return placed.select(
        "id", "source", "size", "source_size", "target", copies.cast("long").alias("copies")
    ).withColumn("taken", F.col("copies") * F.col("size"))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mix itself: each document as often as it is taken, with all its columns.

    An id identifies a document; rows that share id, source and size are told apart by number.
    """
    names = [unique_name(docs, f"_mix_{c}") for c in ("key", "copies", "take_nth", "nth")]
    key, copies, take_nth, nth = names
    numbered = Window.partitionBy(key).orderBy(F.lit(0))
    # Nulls inside a struct compare as equal, so the key serves the window and the join alike, if
    # it has the same type on both sides, nullability included.
    take = (
        mixture(docs, id_col, text_col, source_col, **options)
        .select(
            F.struct("id", "source", F.coalesce("size", F.lit(0)).alias("size")).alias(key), F.col("copies").alias(copies)
        )
        .withColumn(take_nth, F.row_number().over(Window.partitionBy(key).orderBy(copies)))
        .where(F.col(copies) > 0)
    )
    rows = docs.withColumn(
        key,
        F.struct(
            F.col(id_col).alias("id"),
            F.col(source_col).cast("string").alias("source"),
            n_words_of(F.col(text_col)).alias("size"),
        ),
    ).withColumn(nth, F.row_number().over(numbered))
    # Written as a range, the number is no join key, and the rows stay where the window put them.
    joined = rows.join(take, key).where(F.col(nth).between(F.col(take_nth), F.col(take_nth)))
    repeated = joined.withColumn(nth, F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies))))
    return repeated.select(*docs.columns)
