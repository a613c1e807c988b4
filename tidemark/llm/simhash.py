"""SimHash near-duplicates: fingerprints, links by pigeonhole blocks, components."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import component_minimum
from tidemark.llm.common import unique_name, written

BITS = 64
SEED = 42
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_BYTE_LANES = np.uint64(0x0101010101010101)
_SHIFTS = np.arange(8, dtype=np.uint64)[:, None]


def majority_bits(hashes: np.ndarray) -> int:
    """The bits set in over half of the 64-bit hashes; zero for none."""
    n = len(hashes)
    if not n:
        return 0
    # Row k holds bit k of each byte; sums of up to 255 hashes fit the bytes.
    lanes = (hashes[None, :] >> _SHIFTS) & _BYTE_LANES
    sums = np.add.reduceat(lanes, np.arange(0, n, 255), axis=1)
    counts = sums.astype("<u8").view(np.uint8).reshape(8, -1, 8).sum(axis=1, dtype=np.int64)
    bits = (2 * counts > n).T.reshape(-1)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def shingles(text: str | None, shingle: int) -> Iterable[bytes]:
    """Each run of ``shingle`` words; a shorter text is one, a text without words has none."""
    # bytes.split() splits at exactly the white space that bounds words here.
    words = (text or "").encode().translate(_LOWER).split()
    if len(words) <= shingle:
        return [b" ".join(words)] if words else []
    return map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))


def fingerprint(text: str | None, shingle: int = 3) -> int:
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(s, SEED) for s in shingles(text, shingle)])
    return majority_bits(np.frombuffer(hashes, ">u8").astype("<u8"))


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """``id``, a hash of the text and ``fp`` (a signed long) of each row; only one batch is in memory."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.fromiter((fingerprint(t.as_py(), shingle) for t in batch.column("text")), "<u8", len(batch))
            columns = [batch.column("id"), batch.column("text_key"), pa.array(fp.view("<i8"))]
            yield pa.record_batch(columns, names=["id", "text_key", "fp"])

    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_key"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, text_key long, fp long")


def _block_masks(blocks: int, distance: int) -> list[int]:
    """One mask for each choice of the blocks that stay equal when ``distance`` others differ."""
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    masks = [(1 << high) - (1 << low) for low, high in zip(edges, edges[1:], strict=False)]
    return [reduce(int.__or__, c) for c in combinations(masks, blocks - distance)]


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def _star_links(members: DataFrame, masks: list[int], distance: int) -> DataFrame:
    """Links inside buckets of any size, without pairs: each member to the least it shares a variant with.

    Members of a bucket agree in its masked bits. Flipping up to half of ``distance`` free bits,
    two members reach a common variant exactly when they differ in at most ``distance`` bits.
    """
    flips = F.array(
        *(
            F.array(
                *(
                    F.lit(_signed(reduce(int.__or__, (1 << b for b in c), 0)))
                    for size in range(distance // 2 + 1)
                    for c in combinations([b for b in range(BITS) if not mask >> b & 1], size)
                )
            )
            for mask in masks
        )
    )
    variants = members.select(
        "table", "fp", F.explode(F.element_at(flips, F.col("table") + 1)).alias("flip")
    ).select("table", "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("variant"))
    least = variants.groupBy("table", "variant").agg(F.min("fp").alias("least"), F.count("*").alias("n")).where("n > 1")
    return variants.join(least, ["table", "variant"]).where("fp > least").select(F.col("least").alias("u"), F.col("fp").alias("v"))


def links(
    nodes: DataFrame, distance: int = 2, blocks: int | None = None, bucket_pairs: int = 128
) -> DataFrame:
    """Links (``u`` < ``v``) that connect the distinct fingerprints ``fp`` within ``distance`` bits.

    Close pairs share ``blocks - distance`` blocks, so they meet in a bucket of one of the tables.
    Buckets of up to ``bucket_pairs`` fingerprints are joined with themselves and verified. Larger
    ones are linked through common variants, which needs no pairs and loses no connection.
    """
    if distance % 2:
        raise ValueError("an even distance is needed: variants are half of it away")
    blocks = blocks or 2 * distance
    masks = _block_masks(blocks, distance)
    spots = nodes.select(
        "fp",
        F.explode(
            F.array(
                *(
                    F.struct(F.lit(t).alias("table"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("block"))
                    for t, m in enumerate(masks)
                )
            )
        ).alias("spot"),
    ).select("fp", "spot.table", "spot.block")
    sizes = spots.groupBy("table", "block").agg(F.count("*").alias("n")).where("n > 1")
    shared = written(spots.join(sizes, ["table", "block"]), "simhash-blocks")
    small = shared.where(F.col("n") <= bucket_pairs)
    left = small.select("table", "block", F.col("fp").alias("u"))
    right = small.select("table", "block", F.col("fp").alias("v"))
    close = F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= distance
    pairs = left.join(right, ["table", "block"]).where((F.col("u") < F.col("v")) & close).select("u", "v")
    return pairs.union(_star_links(shared.where(F.col("n") > bucket_pairs), masks, distance)).distinct()


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 3,
    distance: int = 2,
    bucket_pairs: int = 128,
) -> DataFrame:
    """``id``, ``text_key`` (a hash), ``fp`` (signed long) and ``component_id`` of each row.

    ``component_id`` is the least id among the documents reachable over fingerprints that differ
    in at most ``distance`` bits. Texts without words (null, empty, blank) have fingerprint zero
    and link like any other. Null ids never become a ``component_id`` unless a component has no
    other. Repeated rows report the same. Other columns are not read; no rows give no rows.
    """
    rows = written(fingerprints(docs, id_col, text_col, shingle), "simhash-rows")
    nodes = written(rows.groupBy("fp").agg(F.min("id").alias("first_id")), "simhash-nodes")
    return labelled(rows, written(links(nodes, distance, bucket_pairs=bucket_pairs), "simhash-links"), nodes)


def labelled(rows: DataFrame, linked_by: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """The rows (``id``, ``text_key``, ``fp``) with the least id of what the links of ``fp`` connect."""
    if nodes is None:
        nodes = written(rows.groupBy("fp").agg(F.min("id").alias("first_id")), "simhash-nodes")
    found = component_minimum(linked_by)
    linked = found.withColumnRenamed("node", "fp").join(nodes, "fp")
    least = linked.groupBy("component").agg(F.min("first_id").alias("component_id"))
    linked = linked.join(least, "component").select("fp", "component_id", F.lit(True).alias("in_component"))
    labels = nodes.join(linked, "fp", "left").select(
        "fp", F.when(F.col("in_component"), F.col("component_id")).otherwise(F.col("first_id")).alias("component_id")
    )
    # Written, so that the last join has an exchange on either side and a hot fingerprint can be split.
    labels = written(labels, "simhash-labels")
    return rows.join(labels, "fp").select("id", "text_key", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One document of each component, the one with the least id, with all its columns.

    Rows that repeat id and text stay once; rows without an id stay only where a whole component
    has none.
    """
    return keep_least(docs, near_duplicates(docs, id_col, text_col, **options), id_col, text_col)


def keep_least(docs: DataFrame, found: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The documents whose id is the ``component_id`` that ``found`` has for their id and text."""
    row = unique_name(docs, "_row")
    stay = found.where(F.col("id").eqNullSafe(F.col("component_id")))
    # Nulls inside a struct compare as equal. Both keys have the same type, nullability included:
    # otherwise one is cast, and the documents are exchanged once more.
    stay = stay.select(F.struct("id", F.coalesce("text_key", F.lit(0)).alias("text_key")).alias(row))
    keyed = docs.withColumn(row, F.struct(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_key")))
    return keyed.join(stay, row, "left_semi").dropDuplicates([row]).select(*docs.columns)


def hex_fingerprint(fp: str = "fp"):
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
