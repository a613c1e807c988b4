"""Language ID by error-correcting output codes over hashed n-gram models.

Each language learned gets a codeword of bits. For each bit a binary classifier weighs hashed byte
n-grams by the log ratio of two models: the languages that have the bit and those that lack it,
every language with the same share of its side. A text's margins are compared with all codewords;
each bit counts by how often its classifier is right on that language, and the codeword of least
loss is the prediction.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written

BUCKET_BITS = 16
BUCKETS = 1 << BUCKET_BITS
UNKNOWN = "und"
LETTER = r"\p{L}"
_GAIN = 4.0  # margins are log ratios per n-gram; the loss is logistic in this multiple of them
_CHUNK = 1 << 20

# Letters to lower case; every other ASCII byte to one space, so that digits and marks tell nothing.
_FOLD = bytes(
    b if b >= 128 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256)
)


def ngrams(text: bytes) -> np.ndarray:
    """Bucket of each four-byte run of the folded text, its words set apart by one space."""
    folded = b" " + b" ".join(text.translate(_FOLD).split()) + b" "
    parts = []
    for start in range(4):
        n = (len(folded) - start) // 4
        if n > 0:
            grams = np.frombuffer(folded, "<u4", n, start)
            parts.append((grams * np.uint32(0x9E3779B1)) >> np.uint32(32 - BUCKET_BITS))
    return np.concatenate(parts) if parts else np.zeros(0, np.uint32)


def codebook(languages: int) -> np.ndarray:
    """Codewords of +1 and -1, a row a language; no column is constant or doubles another.

    Few languages get every split of them into two sides; many get splits by hash, so many that
    any two codewords differ in about half of them.
    """
    if languages < 2:
        return np.ones((languages, 0), np.int8)
    if languages <= 5:
        splits = range(1, 1 << (languages - 1))
        columns = [[1 - 2 * (s >> i & 1) for i in range(languages)] for s in splits]
        return np.array(columns, np.int8).T
    wanted, columns, seen, k = 8 * int(np.ceil(np.log2(languages))), [], set(), 0
    while len(columns) < wanted:
        digest = b"".join(hashlib.sha256(f"{k}:{i}".encode()).digest() for i in range(-(-languages // 256)))
        bits = np.unpackbits(np.frombuffer(digest, np.uint8))[:languages].astype(np.int8)
        bits ^= bits[0]
        k += 1
        if bits.any() and bits.tobytes() not in seen:
            seen.add(bits.tobytes())
            columns.append(1 - 2 * bits)
    return np.array(columns, np.int8).T


@dataclass
class Coded:
    """The fitted classifiers (``weights`` by bit and bucket), codewords and their bits' weights."""

    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    trust: np.ndarray

    def margins(self, text: bytes) -> np.ndarray:
        """Mean weight of the n-grams for each bit; zeros for a text without any."""
        found = ngrams(text)
        bits = self.code.shape[1]
        total = np.zeros(bits)
        for start in range(0, len(found), _CHUNK):
            total += self.weights[found[start : start + _CHUNK]].sum(axis=0, dtype=np.float64)
        return total / max(len(found), 1)

    def losses(self, margins: np.ndarray) -> np.ndarray:
        """Logistic loss of each codeword, bits weighted by trust."""
        return (self.trust * np.logaddexp(0, -_GAIN * self.code * margins)).sum(axis=1)

    def decode(self, text: bytes) -> tuple[str, float, str | None]:
        """Nearest language, its share of the confidence, and the runner-up.

        Equal losses go to the first language in order.
        """
        if len(self.languages) == 1:
            return self.languages[0], 1.0, None
        losses = self.losses(self.margins(text))
        order = np.argsort(losses, kind="stable")
        share = np.exp(losses[order[0]] - losses)
        return self.languages[order[0]], float(min(1.0, 1 / share.sum())), self.languages[order[1]]


def held_out(id_col: str, folds: int = 4, fold: int = 2) -> Column:
    """Whether crc32 of the id as text leaves ``fold`` by ``folds``; the empty text stands for a null id."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds == fold


def _bytes(text_col: str) -> Column:
    return F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")


def _per_row(rows: DataFrame, out: str, body: Callable[[pa.RecordBatch], pa.RecordBatch]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield body(batch)

    return rows.mapInArrow(run, out)


def _counts(rows: DataFrame) -> DataFrame:
    """``lang``, ``bucket``, ``n`` over all rows (``lang``, ``body``): one array a language and task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, body in zip(batch.column("lang").to_pylist(), batch.column("body"), strict=True):
                sums = totals.setdefault(lang, np.zeros(BUCKETS, np.int64))
                found = ngrams(body.as_py())
                if len(found) > BUCKETS // 8:
                    sums += np.bincount(found, minlength=BUCKETS)
                else:
                    np.add.at(sums, found, 1)
            # Few languages are open at a time, however many a table names.
            if len(totals) > 64:
                yield from flushed(totals)
        yield from flushed(totals)

    def flushed(totals: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        while totals:
            lang, sums = totals.popitem()
            where = np.flatnonzero(sums)
            langs = pa.array([lang] * len(where), pa.string())
            yield pa.record_batch(
                [langs, pa.array(where.astype(np.int32)), pa.array(sums[where])], names=["lang", "bucket", "n"]
            )

    counted = rows.mapInArrow(run, "lang string, bucket int, n long")
    return written(counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")), "language-counts")


def _trust(rows: DataFrame, model: Coded) -> np.ndarray:
    """Share of each language's texts on the right side of each bit, scaled to sum to the bits."""
    index = {lang: i for i, lang in enumerate(model.languages)}
    bits = model.code.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        right = np.zeros((len(index), bits + 1), np.int64)
        for batch in batches:
            for lang, body in zip(batch.column("lang").to_pylist(), batch.column("body"), strict=True):
                i = index.get(lang)
                if i is None:  # no text of this language had an n-gram
                    continue
                right[i, :bits] += model.code[i] * model.margins(body.as_py()) > 0
                right[i, bits] += 1
        at = np.flatnonzero(right[:, bits])
        yield pa.record_batch(
            [pa.array(np.repeat(at, bits + 1).astype(np.int32)), pa.array(np.tile(np.arange(bits + 1, dtype=np.int32), len(at))),
             pa.array(right[at].reshape(-1))],
            names=["lang", "bit", "n"],
        )

    right = np.ones((len(index), bits + 1))
    right[:, bits] = 2  # a language without a text in reach counts each bit as a coin toss
    # At most languages times bits rows.
    for r in rows.mapInArrow(run, "lang int, bit int, n long").groupBy("lang", "bit").agg(F.sum("n").alias("n")).collect():
        right[r.lang, r.bit] += r.n
    share = right[:, :bits] / right[:, bits:]
    return bits * share / share.sum(axis=1, keepdims=True)


def fitted(docs: DataFrame, id_col: str, text_col: str, lang_col: str, max_languages: int) -> Coded:
    """The model of the documents that have a language and are not held out, all of them."""
    training = docs.where(F.col(lang_col).isNotNull() & ~held_out(id_col)).select(
        F.col(lang_col).alias("lang"), _bytes(text_col).alias("body")
    )
    counts = _counts(training)
    sizes = counts.groupBy("lang").agg(F.sum("n").alias("size"))
    found = sizes.orderBy("lang").limit(max_languages + 1).collect()
    if len(found) > max_languages:
        raise ValueError(f"more than {max_languages} languages: is {lang_col} a language?")
    languages = [r.lang for r in found]
    code = codebook(len(languages))
    bits = code.shape[1]
    weights = np.zeros((BUCKETS, bits), np.float32)
    if bits:
        # The two models of each bit are summed by Spark: at most one row a bucket comes back.
        place = F.create_map(*(x for i, lang in enumerate(languages) for x in (F.lit(lang), F.lit(i))))
        share = F.col("n") / F.element_at(
            F.create_map(*(x for r in found for x in (F.lit(r.lang), F.lit(float(r.size))))), F.col("lang")
        )
        sides = [
            F.sum(F.when(F.element_at(F.array(*map(F.lit, code[:, j].tolist())), F.col("i") + 1) > 0, F.col("p"))).alias(f"p{j}")
            for j in range(bits)
        ]
        model = counts.select("bucket", F.element_at(place, F.col("lang")).alias("i"), share.alias("p"))
        sums = model.groupBy("bucket").agg(F.sum("p").alias("p"), *sides).collect()
        with_bit, all_ = np.zeros((BUCKETS, bits)), np.zeros((BUCKETS, 1))
        for r in sums:
            all_[r.bucket] = r.p
            with_bit[r.bucket] = [r[f"p{j}"] or 0.0 for j in range(bits)]
        least = 0.5 / max(min(r.size for r in found), BUCKETS)
        n_with = (code > 0).sum(axis=0)
        without = np.maximum(all_ - with_bit, 0) / (len(languages) - n_with)
        weights = np.log((with_bit / n_with + least) / (without + least)).astype(np.float32)
    model = Coded(languages, code, weights, np.ones(code.shape))
    if bits:
        model.trust = _trust(training, model)
    return model


def languages(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    ambiguous_below: float = 0.9,
    max_languages: int = 1000,
) -> DataFrame:
    """One row per document: ``id``, ``held_out``, ``lang_pred``, ``score``, ``runner_up``, ``ambiguous``.

    Learned from text and language of every document that has a language and whose crc32 of the id
    modulo 4 is not 2; a prediction sees the text alone. ``score`` is the confidence of the
    codeword chosen, as a share of that of all; below ``ambiguous_below`` the row is flagged.

    Texts that are null or have no letter are ``und`` with score 0, never ambiguous. Texts too short for an n-gram have
    equal margins of zero: the first language in order, ambiguous. Without any learned language all
    are ``und``. A null id hashes as the empty text. Repeated rows count as often as they occur and report the same.
    More than ``max_languages`` languages are an error. Other columns are not read; no rows give no rows.
    """
    model = fitted(docs, id_col, text_col, lang_col, max_languages)
    letters = F.coalesce(F.col(text_col).rlike(LETTER), F.lit(False))
    rows = docs.select(
        F.col(id_col).alias("id"), held_out(id_col).alias("held_out"), letters.alias("letters"), _bytes(text_col).alias("body")
    )

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [
            model.decode(body.as_py()) if letters and model.languages else (UNKNOWN, 0.0, None)
            for letters, body in zip(batch.column("letters").to_pylist(), batch.column("body"), strict=True)
        ]
        return pa.record_batch(
            [batch.column("id"), batch.column("held_out"), pa.array([x[0] for x in found], pa.string()),
             pa.array([x[1] for x in found], pa.float64()), pa.array([x[2] for x in found], pa.string())],
            names=["id", "held_out", "lang_pred", "score", "runner_up"],
        )

    kind = rows.schema["id"].dataType.simpleString()
    out = _per_row(rows, f"id {kind}, held_out boolean, lang_pred string, score double, runner_up string", run)
    flag = (F.col("lang_pred") != UNKNOWN) & (F.col("score") < ambiguous_below)
    return out.withColumn("ambiguous", flag)
