import random
import struct
import zlib

import corpus_cases as cases
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from checks.compare import compare, duck
from tidemark.llm import importance, mixing, packing, sharding
from tidemark.llm.queries import QUERIES, SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_queries_against_sql(spark, sf, name):
    assert compare(spark, duck(sf), sf, name, QUERIES[name], SQL[name]) is None


def shared_again(sizes, weights=(3, 1, 2), budget=1.5, most=2):
    """Targets by the definition: cap, share the excess again, until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, capped, targets = budget * sum(sizes.values()), set(), {}
    while True:
        open_ = [s for s in names if s not in capped]
        total = sum(weight[s] for s in open_)
        for s in open_:
            targets[s] = (left - sum(most * sizes[c] for c in capped)) * weight[s] / total
        over = [s for s in open_ if targets[s] > most * sizes[s] + 1e-9]
        if not over:
            return targets
        for s in over:
            capped.add(s)
            targets[s] = most * sizes[s]


def test_targets_on_odd_sources(spark):
    sizes = {"b": 10, "a": 1000, None: 400, "": 3, "é": 77, "Z": 0, "c": 5000}
    rows = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, source_size long")
    got = dict(cases.of(mixing.targets(rows, (3, 1, 2), 1.5, 2), "source", "target"))
    want = shared_again(sizes)
    assert all(abs(got[s] - want[s]) < 1e-6 for s in sizes)


def test_mixture_near_targets(spark):
    random.seed(1)
    rows = [(i, "w " * random.randint(0, 200), random.choice(["a", "b", None])) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = mixing.mixture(docs)
    assert found.where("copies > 2 OR copies < 0").count() == 0
    sums = found.groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target"))
    assert all(abs(taken - target) <= 400 for taken, target in cases.of(sums, "taken", "target"))
    assert sorted(cases.of(found, "id", "copies")) == sorted(cases.of(mixing.mixture(docs.repartition(7)), "id", "copies"))


def test_mixing_on_odd_rows(spark):
    docs = cases.odd_docs(spark)
    found = mixing.mixture(docs)
    assert found.count() == docs.count()
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == found.agg(F.sum("copies")).first()[0]
    assert mixing.mixture(cases.no_docs(spark)).count() == mixing.mixed(cases.no_docs(spark)).count() == 0


def tokenizer():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t


ENCODED = tokenizer()


@settings(max_examples=200, deadline=None)
@given(st.text())
def test_ranks_give_the_tokenizers_ids(text):
    ids = packing.encoder(public_tokenizers.path(packing.VOCABULARY)).encode_ordinary(text)
    assert ids == ENCODED.encode(text, add_special_tokens=False).ids


def check_packing(rows, texts, capacity):
    """Pieces are the documents' tokens, and places are gapless and within bounds."""
    pieces, places = {}, {}
    for i, piece, start, length, crc, sequence, offset in rows:
        pieces.setdefault(i, []).append((piece, start, length, crc))
        places.setdefault(sequence, []).append((offset, length))
    total = 0
    for i, text in texts:
        ids = [*ENCODED.encode(text or "", add_special_tokens=False).ids, 2]
        own, at = sorted(pieces[i]), 0
        for k, (piece, start, length, crc) in enumerate(own):
            assert (piece, start) == (k, at) and (k == 0 or length == capacity)
            assert crc == zlib.crc32(struct.pack(f"<{length}I", *ids[at : at + length]))
            at += length
        assert at == len(ids) and (len(own) == 1 or at > capacity)
        total += at
    for spots in places.values():
        at = 0
        for offset, length in sorted(spots):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places), -(-total // capacity)


def test_packing_query(spark, sf):
    texts = cases.of(spark.read.parquet(f"{sf}/documents.parquet"), "doc_id", "text")
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    used, least = check_packing(cases.of(QUERIES["op2_packing"](spark, sf), *columns), texts, 1024)
    assert used <= 1.03 * least


def test_packing_on_odd_rows(spark):
    docs = cases.odd_docs(spark).withColumn("doc_id", F.monotonically_increasing_id())
    columns = ["id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    for block in (4096, 4):
        rows = cases.of(packing.packed(docs, capacity=64, block_pieces=block), *columns)
        check_packing(rows, cases.of(docs, "doc_id", "text"), 64)
    assert packing.packed(cases.no_docs(spark)).count() == 0
    assert packing.packed(cases.odd_docs(spark)).where("id IS NULL").count() > 0


def test_added_tokens_in_texts_have_their_ids(spark):
    """Held to the tokenizer as its file defines it, with no option set."""
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["one <|endoftext|> two", "<|endoftext|><|endoftext|>", "a<|endoftext|", "x\n<|endoftext|>\n\ny é", "no token"]
    assert 50256 in plain.encode(texts[0], add_special_tokens=False).ids
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {i: (n, crc) for i, n, crc in cases.of(packing.packed(docs), "id", "length", "ids_crc32")}
    for i, text in enumerate(texts):
        ids = [*plain.encode(text, add_special_tokens=False).ids, 2]
        assert got[i] == (len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)))


def test_runs_of_a_million_white_space_characters(spark):
    """Too long for the fast encoder: held to the tokenizer as its file defines it."""
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["a" + " " * 1_000_000 + "b", "\n" * 1_000_001, "\t" * 1_000_000 + " word <|endoftext|>"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = packing.packed(docs).groupBy("id").agg(F.sum("length"), F.max("piece"), F.min_by("ids_crc32", "piece"))
    for i, n, last, crc in cases.of(found, *found.columns):
        ids = [*plain.encode(texts[i], add_special_tokens=False).ids, 2]
        first = len(ids) % 1024 or 1024
        assert (n, last) == (len(ids), -(-len(ids) // 1024) - 1)
        assert crc == zlib.crc32(struct.pack(f"<{first}I", *ids[:first]))


def test_local_search_empties_bins():
    random.seed(9)
    for _ in range(20):
        sizes = [random.randint(1, 60) for _ in range(80)]
        # Next fit in the given order leaves much to gain.
        bins, fill = [[]], 0
        for i, s in enumerate(sizes):
            if fill + s > 100:
                bins.append([])
                fill = 0
            bins[-1].append(i)
            fill += s
        before = len(bins)
        after = packing.local_search([list(b) for b in bins], sizes, 100)
        assert sorted(i for b in after for i in b) == list(range(80))
        assert all(sum(sizes[i] for i in b) <= 100 for b in after)
        assert len(after) < before
    # 1-for-1: the exchange of 6 for 5 makes room for all.
    assert len(packing.local_search([[0, 1], [2, 3], [4]], [5, 4, 6, 3, 2], 10)) == 2


def check_shards(rows, shards):
    bytes_, slots = [0] * shards, [[] for _ in range(shards)]
    for size, shard, slot in rows:
        bytes_[shard] += size
        slots[shard].append(slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots)
    return bytes_


@pytest.mark.parametrize("part_rows", [200_000, 7])
def test_shards_of_a_hot_text(spark, part_rows):
    rows = [(i, "same text" if i % 3 else f"text {i} " * (i % 50)) for i in range(900)] + [(None, None), (5, "same text"), (9, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = cases.of(sharding.sharded(docs, part_rows=part_rows, few=10, probes=5), "id", "size", "text_crc32", "shard", "slot")
    want = sorted(((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows), key=str)
    assert sorted((r[:3] for r in found), key=str) == want
    filled = check_shards([(r[1], r[3], r[4]) for r in found], 8)
    assert max(filled) - min(filled) <= 2 * max(r[1] for r in found)


def test_shards_on_odd_rows(spark, tmp_path):
    docs = cases.odd_docs(spark)
    found = cases.of(sharding.sharded(docs), "size", "shard", "slot")
    assert len(found) == docs.count()
    check_shards(found, 8)
    assert sharding.sharded(cases.no_docs(spark)).count() == 0
    out = sharding.write_shards(docs.where("doc_id > 2"), str(tmp_path / "out"))
    assert out.count() == docs.where("doc_id > 2").count() and {"shard", "slot"} <= set(out.columns)


def test_classifier_keeps_good_and_rejects_junk(spark, sf):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    joined = QUERIES["op10_importance_resampling"](spark, "/root/testdata/sf0.01").join(labels, "doc_id")
    share = dict(cases.of(joined.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")), "quality", "kept"))
    assert share[1] >= 0.98 and share[0] <= 0.12


def test_classifier_on_odd_rows(spark):
    docs = cases.odd_docs(spark)
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 1), (8, 1), (None, 1), (9, None), (10, 0)], "doc_id long, quality int")
    found = importance.importance_resampling(docs, labels)
    assert found.count() == docs.count()
    assert found.where("id = 3 AND n_ngrams = 0 AND log_weight = 0").count() == 1
    kept = importance.keep_sampled(docs, labels)
    assert kept.columns == docs.columns
    assert sorted(cases.of(kept, "doc_id"), key=str) == sorted(cases.of(found.where("kept"), "id"), key=str)
    nothing = spark.createDataFrame([], "doc_id long, quality int")
    assert importance.importance_resampling(docs, nothing).where("NOT kept").count() == 0
    assert importance.importance_resampling(cases.no_docs(spark), labels).count() == 0


def test_kth_largest(spark):
    random.seed(8)
    values = [random.gauss(0, 5) for _ in range(3000)] + [1.25] * 500
    keys = spark.createDataFrame([(v,) for v in values], "key double")
    ordered = sorted(values, reverse=True)
    for k in (1, 2, 1400, 1700, 3499):
        assert importance.kth_largest(keys, "key", k, bins=7, few=5) == ordered[k - 1]
    assert importance.kth_largest(keys, "key", 3500) == float("-inf")


def test_ngrams_hold_every_four_bytes():
    text = b"one two two \xc3\xa9"
    found = importance.ngrams(text)
    assert len(found) == len(text) - 3 + 3
    assert (found == importance.BUCKETS - 2).sum() == 1


def test_pipeline_stages_do_what_they_decide(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    classified = stages["quality classifier"](spark, docs, sf)
    want = {i for i, k in cases.of(QUERIES["op10_importance_resampling"](spark, sf), "doc_id", "kept") if k}
    assert {i for (i,) in cases.of(classified, "doc_id")} == want
    exact = stages["exact dedup"](spark, docs, sf)
    want = {i for i, k in cases.of(QUERIES["op5_exact_dedup"](spark, sf), "doc_id", "kept") if k}
    assert sorted(i for (i,) in cases.of(exact, "doc_id")) == sorted(want)
    near = stages["near dedup"](spark, docs, sf)
    want = {c for (c,) in cases.of(QUERIES["op4_simhash"](spark, sf), "component_id")}
    assert sorted(i for (i,) in cases.of(near, "doc_id")) == sorted(want)
    mixed = stages["mixing"](spark, docs, sf)
    copies = {i: n for i, n in cases.of(QUERIES["op7_mixing"](spark, sf), "doc_id", "copies") if n}
    assert dict(cases.of(mixed.groupBy("doc_id").count(), "doc_id", "count")) == copies
    assert all(x.columns == docs.columns for x in (classified, exact, near, mixed))


def test_pipeline_runs_whole(spark, sf):
    out = corpus_pipeline.run(spark, sf)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert out.count() > 0
