"""Quality classifier: importance weights of hashed n-grams, sampled by Gumbel top-k."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import unique_name, written

BUCKET_BITS = 14
# Hashed four-byte n-grams, then two buckets for word pairs: the same word twice, or not.
BUCKETS = (1 << BUCKET_BITS) + 2
_SAME, _OTHER = BUCKETS - 2, BUCKETS - 1
_CHUNK = 1 << 20


def ngrams(text: bytes) -> np.ndarray:
    """Bucket of each n-gram of the text, in no particular order."""
    found = []
    for start in range(4):
        n = (len(text) - start) // 4
        if n > 0:
            grams = np.frombuffer(text, "<u4", n, start)
            found.append((grams * np.uint32(0x9E3779B1)) >> np.uint32(32 - BUCKET_BITS))
    words = text.split()
    same = sum(a == b for a, b in zip(words, words[1:], strict=False))
    found.append(np.repeat([_SAME, _OTHER], [same, max(len(words) - 1 - same, 0)]).astype(np.uint32))
    return np.concatenate(found)


def _histogram(texts: Iterable[bytes]) -> np.ndarray:
    total, waiting, size = np.zeros(BUCKETS, np.int64), [], 0
    for text in texts:
        waiting.append(ngrams(text))
        size += len(waiting[-1])
        if size >= _CHUNK:
            total += np.bincount(np.concatenate(waiting), minlength=BUCKETS)
            waiting, size = [], 0
    if waiting:
        total += np.bincount(np.concatenate(waiting), minlength=BUCKETS)
    return total


def _bytes(text_col: str) -> Column:
    return F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")


def label_sample(labels: DataFrame, id_col: str, label_col: str, fit_rows: int) -> DataFrame:
    """At most ``fit_rows`` labelled ids, chosen by hash: ``id``, ``good``, ``held_out``."""
    order = F.xxhash64("id")
    return (
        labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
        .groupBy(F.col(id_col).alias("id"))
        .agg((F.min(label_col) == 1).alias("good"))
        .orderBy(order, "id")
        .limit(fit_rows)
        .select("id", "good", (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(2)) == 1).alias("held_out"))
    )


def log_ratio(texts: DataFrame) -> np.ndarray:
    """Log of target over raw probability by bucket, from all rows (``body``, ``in_target``).

    Zero everywhere if no row is in the target.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            for k in (0, 1):
                rows = batch.filter(pa.compute.equal(batch.column("in_target"), bool(k)))
                counts[k] += _histogram(x.as_py() for x in rows.column("body"))
        where = np.flatnonzero(counts.any(axis=0))
        yield pa.record_batch(
            [pa.array(where.astype(np.int32)), pa.array(counts[:, where].sum(axis=0)), pa.array(counts[1, where])],
            names=["bucket", "raw", "target"],
        )

    counted = texts.mapInArrow(run, "bucket int, raw long, target long")
    # At most one row per bucket reaches the driver.
    sums = counted.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect()
    raw, target = np.ones(BUCKETS), np.ones(BUCKETS)
    for r in sums:
        raw[r.bucket] += r.raw
        target[r.bucket] += r.target
    if not any(r.target for r in sums):
        return np.zeros(BUCKETS)
    return np.log(target / target.sum()) - np.log(raw / raw.sum())


def scored(docs: DataFrame, ratio: np.ndarray, text_col: str, sharpness: float, score: str, grams: str) -> DataFrame:
    """All columns, the log weight per n-gram times ``sharpness``, and the number of n-grams."""
    body = unique_name(docs, "_body")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums, sizes = np.zeros(len(batch)), np.zeros(len(batch), np.int64)
            for i, text in enumerate(batch.column(len(batch.schema) - 1)):
                found = ngrams(text.as_py())
                sums[i], sizes[i] = ratio[found].sum(), len(found)
            columns = [*batch.columns[:-1], pa.array(sharpness * sums / np.maximum(sizes, 1)), pa.array(sizes)]
            yield pa.record_batch(columns, names=[*batch.schema.names[:-1], score, grams])

    out = docs.select("*", F.lit(0.0).alias(score), F.lit(0).cast("long").alias(grams)).schema
    return docs.withColumn(body, _bytes(text_col)).mapInArrow(run, out)


def gumbel(id_col: str, seed: int) -> Column:
    """Standard Gumbel noise that an id always gets again."""
    uniform = (F.pmod(F.xxhash64(id_col, F.lit(seed)), F.lit(1 << 52)).cast("double") + 0.5) / float(1 << 52)
    return -F.log(-F.log(uniform))


def kth_largest(keys: DataFrame, key: str, k: int, bins: int = 512, few: int = 4096) -> float:
    """The k-th largest value, by counting in ever narrower bins; a few values at the end are sorted."""
    low, high, n = keys.agg(F.min(key), F.max(key), F.count(key)).first()
    if not n or k >= n:
        return float("-inf")
    if k <= 0:
        return float("inf")
    above, inside = 0, n
    while inside > few and low < high:
        step = (high - low) / bins
        if low + step <= low:
            break
        place = F.least(F.floor((F.col(key) - low) / step), F.lit(bins - 1))
        found = keys.where(F.col(key).between(low, high)).groupBy(place.alias("bin")).agg(
            F.count("*").alias("n"), F.min(key).alias("low"), F.max(key).alias("high")
        )
        for r in sorted(found.collect(), key=lambda r: -r.bin):
            if above + r.n >= k:
                low, high, inside = r.low, r.high, r.n
                break
            above += r.n
    if low == high:
        return low
    return keys.where(F.col(key).between(low, high)).orderBy(F.desc(key)).limit(k - above).agg(F.min(key)).first()[0]


class Resampler:
    """The fitted model and the threshold that top-k sampling comes to."""

    def __init__(self, docs, labels, id_col, text_col, label_col, fit_rows, miss, sharpness, seed):
        self.id_col, self.text_col, self.sharpness, self.seed = id_col, text_col, sharpness, seed
        chosen = written(label_sample(labels, id_col, label_col, fit_rows), "label-sample")
        good = chosen.where("good").select(F.col("id").alias("good_id"), "held_out")
        fit = good.where("NOT held_out").select("good_id")
        # The sample is bounded by fit_rows, so it can be broadcast.
        texts = docs.select(F.col(id_col).alias("id"), _bytes(text_col).alias("body")).join(
            F.broadcast(fit), F.col("id") == F.col("good_id"), "left"
        )
        self.ratio = log_ratio(texts.select("body", F.col("good_id").isNotNull().alias("in_target")))
        rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        scores = self.with_keys(rows, "id", "text").select("id", "n_ngrams", "log_weight", "sample_key")
        self.scores = written(scores, "importance")
        held = self.scores.join(F.broadcast(good.where("held_out")), F.col("id") == F.col("good_id"))
        level = held.agg(F.percentile("log_weight", F.lit(miss))).first()[0]
        self.k = None if level is None else self.scores.where(F.col("log_weight") >= level).count()
        self.threshold = float("-inf") if level is None else kth_largest(self.scores, "sample_key", self.k)

    def with_keys(self, docs, id_col, text_col, score="log_weight", grams="n_ngrams", key="sample_key"):
        out = scored(docs, self.ratio, text_col, self.sharpness, score, grams)
        return out.withColumn(key, F.col(score) + gumbel(id_col, self.seed))


def importance_resampling(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    fit_rows: int = 20_000,
    miss: float = 0.002,
    sharpness: float = 100.0,
    seed: int = 5,
) -> DataFrame:
    """One row per document: ``id``, ``n_ngrams``, ``log_weight``, ``sample_key``, ``kept``.

    The target model counts n-grams of half of the documents labelled good, among at most
    ``fit_rows`` labelled ids; the raw model counts those of all documents. A document's weight is
    the log ratio of the two per n-gram, times ``sharpness``, so that long texts do not drown the
    noise. The number to keep, k, is how many documents weigh at least as much as all but a share
    ``miss`` of the good documents held out from the fit. Those with the k largest sums of weight
    and Gumbel noise are kept, and whatever ties with the last of them.

    Null and empty texts have no n-grams and weight 0. Null ids and labels are left out of the fit;
    of several labels of an id the lowest counts. Without any good label every document is kept.
    Rows that repeat an id get the same noise. Other columns are not read; no rows give no rows.
    """
    fitted = Resampler(docs, labels, id_col, text_col, label_col, fit_rows, miss, sharpness, seed)
    return fitted.scores.withColumn("kept", F.col("sample_key") >= F.lit(fitted.threshold))


def keep_sampled(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    fit_rows: int = 20_000,
    miss: float = 0.002,
    sharpness: float = 100.0,
    seed: int = 5,
) -> DataFrame:
    """The documents that the sampling keeps, with all their columns; texts are not exchanged."""
    fitted = Resampler(docs, labels, id_col, text_col, label_col, fit_rows, miss, sharpness, seed)
    score, grams, key = (unique_name(docs, c) for c in ("_log_weight", "_n_ngrams", "_sample_key"))
    rows = fitted.with_keys(docs, id_col, text_col, score, grams, key)
    return rows.where(F.col(key) >= F.lit(fitted.threshold)).select(*docs.columns)
