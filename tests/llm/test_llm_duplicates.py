import hashlib
import random
import re

import corpus_cases as cases
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import exact_dedup, line_dedup, simhash
from tidemark.llm.components import component_minimum
from tidemark.llm.queries import QUERIES


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def exact_by_brute_force(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(normal(t), []).append(i)
    out = []
    for i, t in rows:
        ids = groups[normal(t)]
        keep = min((x for x in ids if x is not None), default=None)
        out.append((i, keep, len(ids), i == keep, hashlib.sha256(normal(t).encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("limits", [{}, {"bucket_entries": 2, "max_depth": 3}])
def test_exact_dedup_on_odd_rows(spark, limits):
    docs = cases.odd_docs(spark)
    got = cases.of(exact_dedup.exact_dedup(docs, **limits), "id", "keep_id", "group_size", "kept", "text_sha256")
    assert sorted(got, key=str) == exact_by_brute_force(cases.of(docs, "doc_id", "text"))
    assert exact_dedup.exact_dedup(cases.no_docs(spark)).count() == 0
    left = exact_dedup.drop_exact_duplicates(docs)
    assert left.columns == docs.columns
    assert len({normal(t) for (t,) in cases.of(left, "text")}) == left.count() == len({normal(t) for (t,) in cases.of(docs, "text")})


def test_directory_doubles_only_where_a_bucket_is_full():
    leaves = {0b000: 5, 0b001: 5, 0b010: 1, 0b111: 1}
    placed = dict(exact_dedup.split_directory(leaves, 6, 3))
    assert placed[0b000] == 0b1000 and placed[0b001] == 0b1001  # depth 3
    assert placed[0b010] == 0b101  # depth 2
    assert placed[0b111] == 0b11  # depth 1
    assert exact_dedup.split_directory({}, 6, 3) == []


def test_equal_hashes_are_told_apart_by_bytes(spark):
    """Chains hold several texts: grouping is by hash and text."""
    texts = spark.createDataFrame([(1, "a", 9), (2, "b", 9), (3, "a", 9)], "id long, text string, key long")
    classes = texts.groupBy("key", "text").agg(F.min("id").alias("keep"), F.count("*").alias("n"))
    assert sorted(cases.of(classes, "text", "keep", "n")) == [("a", 1, 2), ("b", 2, 1)]


def near_by_brute_force(rows, distance=2):
    prints = [(i, cases.fingerprint(t)) for i, t in rows]
    of = cases.components({f for _, f in prints}, lambda a, b: (a ^ b).bit_count() <= distance)
    least = {}
    for i, f in prints:
        if i is not None:
            least[of[f]] = min(i, least.get(of[f], i))
    return sorted(((i, f"{f:016x}", least.get(of[f])) for i, f in prints), key=str)


@pytest.mark.parametrize("bucket_pairs", [128, 1])
def test_simhash_on_odd_rows(spark, sf, bucket_pairs):
    random.seed(4)
    base = [f"w{random.randrange(500)}" for _ in range(120)]
    copies = []
    for i in range(60):
        edited = list(base)
        for _ in range(i % 4):
            edited[random.randrange(120)] = f"z{i}"
        copies.append((1000 + i, " ".join(edited)))
    docs = cases.odd_docs(spark).select("doc_id", "text").union(spark.createDataFrame(copies, "doc_id long, text string"))
    found = simhash.near_duplicates(docs, bucket_pairs=bucket_pairs)
    got = cases.of(found, "id", simhash.hex_fingerprint(), "component_id")
    assert sorted(got, key=str) == near_by_brute_force(cases.of(docs, "doc_id", "text"))


def test_simhash_rows_and_columns(spark):
    docs = cases.odd_docs(spark)
    assert simhash.near_duplicates(cases.no_docs(spark)).count() == 0
    left = simhash.drop_near_duplicates(docs)
    assert left.columns == docs.columns
    kept = [i for (i,) in cases.of(left, "doc_id")]
    assert len(kept) == len(set(kept)) and 1 in kept and 2 not in kept and 3 in kept and 4 not in kept
    assert [t for i, t in cases.of(left, "doc_id", "text") if i is None] == [t for i, t, *_ in cases.odd_rows() if i is None][1:]


def test_simhash_query(spark, sf):
    texts = cases.of(spark.read.parquet(f"{sf}/documents.parquet"), "doc_id", "text")
    got = cases.of(QUERIES["op4_simhash"](spark, sf), "doc_id", "fingerprint", "component_id")
    assert sorted(got, key=str) == near_by_brute_force(texts)


def test_near_dedup_stage_on_odd_rows(spark, sf):
    stage = dict(corpus_pipeline.STAGES)["near dedup"]
    docs = cases.odd_docs(spark)
    left = stage(spark, docs, sf)
    assert left.columns == docs.columns
    assert sorted(i for (i,) in cases.of(left, "doc_id") if i is not None) == [1, 3, 6, 8, 9, 10, 11, 12, 13]
    assert [t for i, t in cases.of(left, "doc_id", "text") if i is None] == [t for i, t, *_ in cases.odd_rows() if i is None][1:]
    assert stage(spark, cases.no_docs(spark), sf).count() == 0


def test_components_of_paths_stars_and_loops(spark):
    path = [(i, i + 1) for i in range(100, 140)]
    star = [(7, x) for x in range(20, 60)]
    edges = [*path, *star, (3, 3), (5, 6), (6, 5), (None, 4)]
    got = dict(cases.of(component_minimum(spark.createDataFrame(edges, "a long, b long")), "node", "component"))
    want = {x: 100 for x in range(100, 141)} | {x: 7 for x in [7, *range(20, 60)]} | {5: 5, 6: 5}
    assert got == want
    assert component_minimum(spark.createDataFrame([], "a long, b long")).count() == 0


def test_line_dedup_against_brute_force(spark, sf):
    texts = cases.of(spark.read.parquet(f"{sf}/documents.parquet"), "doc_id", "text")
    want = cases.dropped_lines(texts)
    got = {i: (n, set(map(int, d.split(","))) if d else set()) for i, n, d in cases.of(QUERIES["op9_line_dedup"](spark, sf), "doc_id", "n_dropped", "dropped")}
    assert got == {i: (len(want[i]), want[i]) for i, _ in texts}


def test_line_dedup_on_odd_and_dense_rows(spark):
    random.seed(2)
    lines = [" ".join(random.choices(["aa", "bb", "cc"], k=random.randint(3, 8))) for _ in range(300)]
    dense = [(100 + i, "\n".join(lines[i * 3 : i * 3 + 3])) for i in range(100)]
    docs = cases.odd_docs(spark).select("doc_id", "text").union(spark.createDataFrame(dense, "doc_id long, text string"))
    want = cases.dropped_lines(cases.of(docs, "doc_id", "text"))
    got = cases.of(line_dedup.repeated_lines(docs).where("id IS NOT NULL"), "id", "dropped")
    assert all(set(d) == want[i] for i, d in got) and len(got) == docs.where("doc_id IS NOT NULL").count()
    assert line_dedup.repeated_lines(cases.no_docs(spark)).count() == 0


def test_lines_of_few_words_repeat_too(spark):
    japanese = "これは空白のない長い行で、どの文書にも同じ形で現れるものです"
    spread = " ".join(japanese)
    rows = [
        (1, f"Sign up now\n{japanese}\nAll  rights\treserved\n\n \n{spread}"),
        (2, f"Sign up now\nSign up today\n{japanese[:9]}違{japanese[10:]}\nAll rights reserved\n"),
        (3, f"{japanese[1:]}\n\U0001f600{japanese}\n{japanese}。。\nx\n{'word ' * 20000}"),
        (4, f"x\nhttps://example.org/a/long/path?q=1\n{'word ' * 20000}"),
        (5, "https://example.org/a/long/path?q=2\nhttps://example.org/a/longer/path?q=2"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {i: set(d) for i, d in cases.of(line_dedup.repeated_lines(docs), "id", "dropped")}
    assert got == {1: set(), 2: {0, 2, 3}, 3: {0, 1}, 4: {0, 2}, 5: {0}}
    want = cases.dropped_lines(rows)
    assert got == {i: want[i] for i, _ in rows}


def test_lines_are_cut_from_the_text(spark):
    docs = cases.odd_docs(spark)
    left = line_dedup.without_repeated_lines(docs)
    assert left.columns == docs.columns and left.count() == docs.count()
    assert cases.of(left.where("doc_id = 13"), "text") == [("same line of five words",)]
    assert cases.of(left.where("doc_id = 3"), "text") == [(None,)]


def test_lines_a_word_or_character_apart_share_a_half(spark):
    pairs = [
        ("the cat sat on the mat", "the cat sat on the old mat", True),
        ("the cat sat on the mat", "one cat sat on the mat", True),
        ("the cat sat on the red mat", "the cat on the red mat", True),
        ("abcdefghijklmnopqrstuvwxyz", "abcdefghijklmnopqrstuvwxy", False),
        ("äöü漢字abcdefghijklmnopqr", "xäöü漢字abcdefghijklmnopqr", False),
    ]
    rows = spark.createDataFrame(pairs, "a string, b string, w boolean")

    def keys(name):
        size = F.when(F.col("w"), F.size(F.split(name, " "))).otherwise(F.length(name))
        return line_dedup._half_keys(F.col(name), F.col("w"), size)

    shared = rows.select(F.size(F.array_intersect(keys("a"), keys("b"))).alias("n"))
    assert all(r.n >= 1 for r in shared.collect())
    # No function of arrays, which would be interpreted line by line.
    plan = rows.select(keys("a"))._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan and "array_join" not in plan
