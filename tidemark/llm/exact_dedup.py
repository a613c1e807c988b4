"""Exact duplicates through an extendible-hash index in the shared folder.

Texts are equal when identical after each run of white space has become one space.
The index maps the 64-bit hash of a normalised text to its entry; a directory of hash
prefixes deals the entries to buckets. The directory starts with one bucket and doubles
wherever a bucket holds more entries than allowed. Copies of a text are combined before
any exchange, so a hot text is one entry per map task and never fills a bucket. Entries
of one hash form a chain, in which texts are told apart by their bytes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SPACE, maybe_among, text_or_empty, unique_name, written

def normalised(column: str = "text"):
    return F.regexp_replace(text_or_empty(column), SPACE, " ")


def split_directory(leaves: dict[int, int], bucket_entries: int, max_depth: int) -> list[tuple[int, int]]:
    """(leaf, bucket) for each leaf prefix of ``max_depth`` bits.

    A bucket is the pair of a local depth and a prefix, numbered as ``(1 << depth) | prefix``.
    """
    load = {(0, 0): sum(leaves.values())}
    members = {(0, 0): sorted(leaves)}
    waiting, placed = [(0, 0)], []
    while waiting:
        depth, prefix = waiting.pop()
        own = members.pop((depth, prefix))
        if load[depth, prefix] <= bucket_entries or depth == max_depth:
            placed += [(leaf, (1 << depth) | prefix) for leaf in own]
            continue
        for bit in (0, 1):
            child = (depth + 1, prefix << 1 | bit)
            members[child] = [x for x in own if x >> (max_depth - depth - 1) & 1 == bit]
            load[child] = sum(leaves[x] for x in members[child])
            waiting.append(child)
    return sorted(placed)


def hash_index(entries: DataFrame, bucket_entries: int, max_depth: int) -> DataFrame:
    """Entries of each hash (``key``, ``n``), written by bucket of the extendible directory."""
    spark = entries.sparkSession
    leaf = F.shiftrightunsigned("key", 64 - max_depth)
    keys = entries.groupBy("key").agg(F.count("*").alias("n")).withColumn("leaf", leaf)
    keys = written(keys, "dedup-keys")
    # At most 2^max_depth rows, however large the corpus.
    leaves = {r.leaf: r.n for r in keys.groupBy("leaf").agg(F.count("*").alias("n")).collect()}
    directory = spark.createDataFrame(
        split_directory(leaves, bucket_entries, max_depth), "leaf long, bucket long"
    )
    placed = keys.join(F.broadcast(directory), "leaf").select("key", "n", "bucket")
    return written(placed.repartition("bucket"), "dedup-index", "bucket")


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    bucket_entries: int = 500_000,
    max_depth: int = 16,
) -> DataFrame:
    """One row per document: ``id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Of equal texts the row with the smallest id stays. Null texts count as empty. Null ids are
    larger than any other: such a row stays only if all ids of its group are null. Rows that
    repeat both id and text are one document: each counts in ``group_size``, and all have the
    same ``kept``. Columns other than the two named are not read. No rows give no rows.
    """
    texts = docs.select(F.col(id_col).alias("id"), normalised(text_col).alias("text")).withColumn(
        "key", F.xxhash64("text")
    )
    entries = written(
        texts.select("id", "key", F.unhex(F.sha2("text", 256)).alias("sha")), "dedup-entries"
    )
    chained = hash_index(entries, bucket_entries, max_depth).where("n > 1").select("key")
    # The text itself is the grouping key: bytes are compared, not hashes.
    classes = (
        maybe_among(texts, chained)
        .groupBy("key", "text")
        .agg(F.min("id").alias("keep_id"), F.count("*").alias("group_size"))
        .where("group_size > 1")
        .select("key", F.unhex(F.sha2("text", 256)).alias("sha"), "keep_id", "group_size")
    )
    keep_id = F.when(F.col("group_size").isNull(), F.col("id")).otherwise(F.col("keep_id"))
    return entries.join(classes, ["key", "sha"], "left").select(
        "id",
        keep_id.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("id").eqNullSafe(keep_id).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with all their columns; repeated rows stay once."""
    row = unique_name(docs, "_row")
    stay = exact_dedup(docs, id_col, text_col).where("kept")
    # Nulls inside a struct compare as equal; one key serves the join and what follows it.
    stay = stay.select(F.struct("id", F.unhex("text_sha256").alias("sha")).alias(row))
    sha = F.unhex(F.sha2(normalised(text_col), 256))
    keyed = docs.withColumn(row, F.struct(F.col(id_col).alias("id"), sha.alias("sha")))
    return keyed.join(stay, row, "left_semi").dropDuplicates([row]).select(*docs.columns)
