import hashlib
import random
import zlib
from collections import defaultdict

import corpus_cases as cases
import pytest
from pyspark.sql import functions as F

from tidemark.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, depth int, k1 string, rep long, sid string"
EXTRA = (9, "x", 3, "y")


def nodes_of(sequences):
    """Every prefix by brute force; ``sequences`` maps an id to its turns."""
    members = defaultdict(list)
    for c, turns in sequences.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        own = (len(members[p]) - 1) * len(cases.words(p[-1][1])) if p else 0
        leaves[p] = sum(leaves[c] for c in children[p]) or 1
        saved[p] = own + sum(saved[c] for c in children[p])
    out = []
    for p, ids in members.items():
        ends = ",".join(str(c) for c in sorted(ids) if len(sequences[c]) == len(p))
        parent = min(members[p[:-1]]) if p else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(ids), len(p), parent, len(ids), len(children[p]), leaves[p], saved[p], digest))
    return sorted(out, key=str)


def ordered(rows):
    found = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            found[c].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [(r, t) for *_, r, t in sorted(v)] for c, v in found.items()}


def with_heads(own):
    """As the contract of the query has it; remainders keep the sign of the id."""
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = own.get(c - (abs(c) % 20) * (1 if c >= 0 else -1), [])
        out[c] = base[:h] + turns[h:]
    return out


def rebuilt(spark, rows):
    table = spark.createDataFrame([(*r, *EXTRA) for r in rows], SCHEMA)
    return prefix_trie.prefix_trie(*prefix_trie.with_shared_heads(prefix_trie.ordered_turns(table)))


def test_spines_forks_and_copies(spark, monkeypatch):
    """Long shared runs that end and fork at every depth, over several rows of signatures."""
    monkeypatch.setattr(prefix_trie, "CHUNK_IDS", 3)
    monkeypatch.setattr(prefix_trie, "SEGMENT", 8)
    random.seed(13)
    spine = [("user", f"turn {d} " + "w " * (d % 5)) for d in range(30)]
    sequences = {}
    for c in range(-40, 120):
        cut = random.choice([0, 1, 2, 7, 8, 9, 16, 29, 30])
        own = [("bot", random.choice("ab")) for _ in range(random.randint(0, 4))]
        sequences[c * 7] = spine[:cut] + own
    sequences |= {5000 + i: spine for i in range(40)}  # copies of a whole conversation
    turns = [(c, d + 1, hash(t), 1, len(cases.words(t[1]))) for c, s in sequences.items() for d, t in enumerate(s)]
    turns = spark.createDataFrame(turns, "conv_id long, depth int, k1 long, k2 long, words long")
    ids = spark.createDataFrame([(c,) for c in [*sequences, 5000]], "conv_id long")
    got = [tuple(r) for r in prefix_trie.prefix_trie(turns, ids).collect()]
    assert sorted(got, key=str) == nodes_of(sequences)


def test_rebuilt_conversations_with_odd_rows(spark):
    random.seed(5)
    rows = [(None, 0, "user", "lost"), (0, None, "system", None), (0, 3, None, "a b"), (0, 1, "user", ""), (-7, 2, "user", "x"), (-7, 2, "user", "x")]
    rows += [(c, t, "user" if t % 2 else "bot", f"{t} {c % 3 if t > 1 else ''}") for c in range(20, 60) for t in range(c % 5 + 1)]
    rows += [(77, 0, "user", "no first of the group here " * 2000)]
    got = rebuilt(spark, rows)
    assert got.dtypes == [*((c, "bigint") for c in got.columns[:-1]), ("ends_sha256", "string")]
    got = sorted((tuple(r) for r in got.collect()), key=str)
    # Here equal turn numbers belong to equal turns, so their order does not matter.
    assert got == nodes_of(with_heads(ordered(rows)))


def test_tables_without_turns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    turns = prefix_trie.ordered_turns(empty)
    assert prefix_trie.prefix_trie(*prefix_trie.with_shared_heads(turns)).count() == 0
    no_turns = spark.createDataFrame([], "conv_id long, depth int, k1 long, k2 long, words long")
    ids = spark.createDataFrame([(3,), (12,)], "conv_id long")
    want = [(3, 0, None, 2, 0, 1, 0, hashlib.sha256(b"3,12").hexdigest())]
    assert [tuple(r) for r in prefix_trie.prefix_trie(no_turns, ids).collect()] == want


@pytest.mark.parametrize("a, b", [(0, 1), (0, 9), (4, 7), (7, 8), (8, 15), (100, 131), (0, 2**40)])
def test_two_fattest_number(spark, a, b):
    f = spark.range(1).select(prefix_trie.fattest(F.lit(a), F.lit(b))).first()[0]
    zeros = lambda x: (x & -x).bit_length()
    assert a < f <= b and (b > 10_000 or all(zeros(x) < zeros(f) for x in range(a + 1, b + 1) if x != f))
