"""A z-fast trie of conversations: which of them begin with the same turns.

A conversation is a string of turns, closed by an end mark so that none is a prefix of another.
The compacted trie keeps branching points only: an edge is the stretch (top, ext] of the path of
one sequence that runs through it. Its handle is the prefix at the two-fattest depth of that
stretch, the one number in it that the most powers of two divide. A hash table from handles to
edges lets a fat binary search find where a sequence leaves the trie in a logarithm of its length.

Prefixes are told apart by 128-bit signatures, the running exclusive-or of a hash of each turn and
its depth, so that runs of a long conversation are signed on their own and then put together. All
steps are joins and aggregates of the sequences that are not in the trie yet; equal conversations
are one sequence from the start.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import n_words_of, text_or_empty, written

SEGMENT = 64  # signatures kept in one row
CHUNK_IDS = 50_000  # ids joined into one string
_NO_ENDS = hashlib.sha256(b"").hexdigest()
_EDGE = ["rep", "ext"]


def fattest(a: Column, b: Column) -> Column:
    """The two-fattest number in (a, b], for 0 <= a < b."""
    zeros = (F.length(F.bin(a.bitwiseXOR(b))) - 1).cast("int")
    return F.call_function("shiftleft", F.call_function("shiftright", b, zeros), zeros)


def _ranged(rows: DataFrame, key: str, *order: Column, name: str) -> DataFrame:
    """Rows by even ranges of key and order, ``part`` the range: a hot key spans many."""
    return written(rows.repartitionByRange(F.col(key), *order).withColumn("part", F.spark_partition_id()), name)


def ordered_turns(
    conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """``conv_id``, ``pos`` from 1, ``k1``, ``k2`` (a 128-bit hash of role and text), ``words``; texts are not exchanged.

    Turns are in order of ``turn``, null first, equal ones by their hash. Null roles and texts are
    empty. Rows without a conversation belong to none and are left out; repeated rows are turns
    of their own.
    """
    role, text = text_or_empty(role_col), text_or_empty(text_col)
    turns = conversations.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv_id"),
        F.col(turn_col).alias("turn"),
        F.xxhash64(F.lit(1), role, text).alias("k1"),
        F.xxhash64(F.lit(2), role, text).alias("k2"),
        n_words_of(text).alias("words"),
    )
    order = [F.col("turn").asc_nulls_first(), F.col("k1"), F.col("k2")]
    dealt = _ranged(turns, "conv_id", *order, name="turn-ranges")
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        dealt.groupBy("part", "conv_id")
        .agg(F.count("*").alias("n"))
        .select("part", "conv_id", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    )
    nth = F.row_number().over(Window.partitionBy("part", "conv_id").orderBy(*order))
    placed = dealt.withColumn("nth", nth).join(starts, ["part", "conv_id"])
    return placed.select("conv_id", (F.col("nth") + F.col("before")).alias("pos"), "k1", "k2", "words")


def _signed(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Prefix rows (``conv_id``, ``depth``, ``e1``, ``e2``, ``words``, ``upto``) and totals by conversation."""
    signs = [F.xxhash64(F.lit(s), "k1", "k2", "depth").alias(e) for s, e in ((3, "t1"), (4, "t2"))]
    rows = turns.select("conv_id", F.col("depth").cast("long").alias("depth"), *signs, "words")
    dealt = _ranged(rows, "conv_id", F.col("depth"), name="prefix-ranges")
    sums = (F.bit_xor("t1").alias("x1"), F.bit_xor("t2").alias("x2"), F.sum("words").alias("w"))
    by_part = written(dealt.groupBy("part", "conv_id").agg(*sums, F.count("*").alias("n")), "prefix-sums")
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    starts = by_part.select(
        "part",
        "conv_id",
        *(F.coalesce(f(c).over(before), zero).alias(f"b{c}") for f, c in ((F.bit_xor, "x1"), (F.bit_xor, "x2"), (F.sum, "w"))),
    )
    upto = Window.partitionBy("part", "conv_id").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    prefixes = dealt.select(
        "part", "conv_id", "depth", "words", *(f(c).over(upto).alias(c[0] + "_" + c[-1]) for f, c in ((F.bit_xor, "t1"), (F.bit_xor, "t2"), (F.sum, "words")))
    ).join(starts, ["part", "conv_id"])
    prefixes = prefixes.select(
        "conv_id",
        "depth",
        F.col("t_1").bitwiseXOR(F.col("bx1")).alias("e1"),
        F.col("t_2").bitwiseXOR(F.col("bx2")).alias("e2"),
        "words",
        (F.col("w_s") + F.col("bw")).alias("upto"),
    )
    totals = by_part.groupBy("conv_id").agg(
        F.sum("n").alias("size"), F.bit_xor("x1").alias("e1"), F.bit_xor("x2").alias("e2")
    )
    return prefixes, totals


class Trie:
    """Edges (``rep``, ``top``, ``ext``; parent ``prep``, ``pext``) over sequences, grown in batches.

    ``rep`` is a sequence through the edge. The edges of one ``rep`` do not overlap, so (rep, ext)
    names an edge and the node at its lower end; (0, 0) is the root.
    """

    def __init__(self, sequences: DataFrame, segments: DataFrame):
        self.segments = segments
        start = sequences.select("sid", "size", *(F.lit(0).cast("long").alias(c) for c in ("rep", "ext")))
        # Nothing to search in an empty trie: every sequence leaves it at the root.
        self.edges, left = self._inserted(None, written(self._with_next(start), "trie-exits"))
        while left.limit(1).count():
            self.edges, left = self._inserted(self.edges, self._exits(left))

    def _signature(self, rows: DataFrame, sid: str, depth: str, *names: str) -> DataFrame:
        """The signature of ``sid`` at ``depth``, as two columns; null beyond its end mark."""
        cell = F.floor((F.col(depth) - 1) / SEGMENT)
        spot = ((F.col(depth) - 1) % SEGMENT + 1).cast("int")
        found = rows.withColumn("_cell", cell).join(
            self.segments.select(F.col("sid").alias("_sid"), F.col("cell").alias("_of"), "s1", "s2"),
            (F.col(sid) == F.col("_sid")) & (F.col("_cell") == F.col("_of")),
            "left",
        )
        got = (F.when(spot <= F.size(s), F.element_at(s, spot)).alias(n) for s, n in zip(("s1", "s2"), names, strict=True))
        return found.select(*rows.columns, *got)

    def _with_next(self, exits: DataFrame) -> DataFrame:
        """Exits (sid, size, rep, ext: a branching point) with the signature one turn further on."""
        return self._signature(exits.withColumn("_d", F.col("ext") + 1), "sid", "_d", "n1", "n2").drop("_d")

    def _tables(self) -> tuple[DataFrame, DataFrame]:
        """Edges by the signature of their handle, and by that of their first turn."""
        handle = fattest(F.col("top"), F.col("ext"))
        spots = [F.struct(F.lit(k).alias("kind"), d.alias("at")) for k, d in ((0, handle), (1, F.col("top") + 1))]
        marks = self.edges.select("rep", "top", "ext", F.explode(F.array(*spots)).alias("m"))
        marks = marks.select("rep", "top", "ext", "m.kind", F.col("m.at").alias("at"))
        marks = self._signature(marks, "rep", "at", "h1", "h2")
        marks = written(self._signature(marks, "rep", "ext", "x1", "x2"), "trie-marks")
        named = [F.col(c).alias(f"m_{c}") for c in ("rep", "top", "ext", "at", "h1", "h2", "x1", "x2")]
        return marks.where("kind = 0").select(*named), marks.where("kind = 1").select(*named)

    def _exits(self, left: DataFrame) -> DataFrame:
        """Where each sequence (sid, size, and a node on its path: rep, ext) leaves the trie."""
        handles, firsts = self._tables()
        longest = left.agg(F.max(F.col("size") + 1 - F.col("ext"))).first()[0]
        at = left.select(
            "sid", "size", "rep", "ext", F.col("ext").alias("low"), (F.col("size") + 1).alias("high"),
            *(F.lit(None).cast("long").alias(c) for c in ("h_rep", "h_top", "h_ext", "hx1", "hx2")),
        )
        for _ in range(int(longest).bit_length()):
            f = F.when(F.col("low") < F.col("high"), fattest(F.col("low"), F.col("high")))
            probe = self._signature(at.withColumn("f", f), "sid", "f", "g1", "g2")
            met = probe.join(
                handles, (F.col("f") == F.col("m_at")) & (F.col("g1") == F.col("m_h1")) & (F.col("g2") == F.col("m_h2")), "left"
            )
            hit = F.col("m_rep").isNotNull()
            took = {"h_rep": "m_rep", "h_top": "m_top", "h_ext": "m_ext", "hx1": "m_x1", "hx2": "m_x2"}
            at = met.select(
                "sid", "size", "rep", "ext",
                F.when(hit, F.col("m_ext")).otherwise(F.col("low")).alias("low"),
                F.when(hit | F.col("f").isNull(), F.col("high")).otherwise(F.col("f") - 1).alias("high"),
                *(F.when(hit, F.col(new)).otherwise(F.col(old)).alias(old) for old, new in took.items()),
            )
        # A handle that matches does not make its whole edge match.
        at = self._signature(written(at, "trie-search"), "sid", "h_ext", "g1", "g2")
        whole = F.coalesce((F.col("g1") == F.col("hx1")) & (F.col("g2") == F.col("hx2")), F.lit(False))
        part = F.col("h_rep").isNotNull() & ~whole
        at = at.select(
            "sid", "size", part.alias("inside"),
            *(F.when(part, F.col(f"h_{c}")).alias(f"e_{c}") for c in ("rep", "top", "ext")),
            F.when(whole, F.col("h_rep")).otherwise(F.col("rep")).alias("rep"),
            F.when(whole, F.col("h_ext")).otherwise(F.col("ext")).alias("ext"),
        )
        at = self._with_next(at).join(
            firsts,
            ~F.col("inside") & (F.col("ext") + 1 == F.col("m_at")) & (F.col("n1") == F.col("m_h1")) & (F.col("n2") == F.col("m_h2")),
            "left",
        )
        edge = [F.coalesce(f"e_{c}", f"m_{c}").alias(f"e_{c}") for c in ("rep", "top", "ext")]
        at = written(at.select("sid", "size", "rep", "ext", *edge), "trie-edges-met")
        at = self._common(at)
        split = F.col("common").isNotNull()
        exits = at.select(
            "sid", "size",
            F.when(split, F.col("e_rep")).otherwise(F.col("rep")).alias("rep"),
            F.when(split, F.col("common")).otherwise(F.col("ext")).alias("ext"),
        )
        return written(self._with_next(exits), "trie-exits")

    def _common(self, at: DataFrame) -> DataFrame:
        """``common``: the depth to which a sequence follows the edge it leaves; null where it meets none."""
        own = self.segments.select(F.col("sid").alias("_sid"), F.col("cell").alias("_cell"), F.col("s1").alias("_a1"), F.col("s2").alias("_a2"))
        other = self.segments.select(F.col("sid").alias("_rep"), F.col("cell").alias("_of"), "s1", "s2")
        inside = F.col("_cell").between(F.floor(F.col("e_top") / SEGMENT), F.floor((F.col("e_ext") - 1) / SEGMENT))
        pairs = at.where("e_rep IS NOT NULL").join(own, (F.col("sid") == F.col("_sid")) & inside)
        pairs = pairs.join(other, (F.col("e_rep") == F.col("_rep")) & (F.col("_cell") == F.col("_of")))
        same = F.zip_with(
            F.arrays_zip("_a1", "_a2"), F.arrays_zip("s1", "s2"),
            lambda a, b: F.coalesce((a["_a1"] == b["s1"]) & (a["_a2"] == b["s2"]), F.lit(False)),
        )
        # Signatures stay apart from the first difference on, so the equal ones are a prefix.
        equal = F.aggregate(same, F.lit(0), lambda n, s: n + s.cast("int"))
        # Cells before that of the edge's top are equal throughout.
        reach = pairs.groupBy("sid").agg(
            (F.min(F.col("_cell")) * SEGMENT + F.sum(equal)).alias("common")
        )
        return at.join(reach, "sid", "left")

    def _inserted(self, edges: DataFrame | None, exits: DataFrame) -> tuple[DataFrame, DataFrame]:
        """One sequence for each exit and next turn becomes a leaf; the others wait for the next batch."""
        group = ["rep", "ext", "n1", "n2"]
        chosen = exits.groupBy(*group).agg(F.min_by("sid", F.xxhash64("sid")).alias("sid"), F.min_by("size", F.xxhash64("sid")).alias("size"))
        chosen = written(chosen, "trie-leaves")
        leaves = chosen.select(
            F.col("sid").alias("rep"), F.col("ext").alias("top"), (F.col("size") + 1).alias("ext"),
            F.col("rep").alias("prep"), F.col("ext").alias("pext"),
        )
        if edges is not None:
            cuts = chosen.where("ext > 0").select(F.col("rep").alias("c_rep"), F.col("ext").alias("cut")).distinct()
            met = edges.join(cuts, (F.col("rep") == F.col("c_rep")) & (F.col("cut") > F.col("top")) & (F.col("cut") < F.col("ext")), "left")
            cut = met.groupBy("rep", "top", "ext", "prep", "pext").agg(F.array_sort(F.collect_set("cut")).alias("cuts"))
            ends = F.concat("cuts", F.array("ext"))
            pieces = cut.select("rep", "top", "prep", "pext", F.posexplode(ends).alias("i", "end"), ends.alias("ends"))
            first = F.col("i") == 0
            above = F.when(~first, F.get("ends", F.col("i") - 1))
            leaves = leaves.union(
                pieces.select(
                    "rep", F.when(first, F.col("top")).otherwise(above), F.col("end"),
                    F.when(first, F.col("prep")).otherwise(F.col("rep")), F.when(first, F.col("pext")).otherwise(above),
                )
            )
        left = exits.join(chosen.select("sid"), "sid", "left_anti").select("sid", "size", "rep", "ext")
        return written(leaves, "trie"), written(left, "trie-left")


def _subtree(nodes: DataFrame, sums: dict) -> DataFrame:
    """The nodes with ``sums`` (column to aggregate function) taken over their subtrees, by pointer doubling.

    After round k a node holds what lies less than 2^k levels below it and points 2^k levels up.
    """
    values = list(sums)
    now = written(nodes.select("rep", "ext", F.col("prep").alias("up_rep"), F.col("pext").alias("up_ext"), *values), "trie-sums")
    while now.where("up_rep IS NOT NULL").limit(1).count():
        risen = now.where("up_rep IS NOT NULL").groupBy("up_rep", "up_ext").agg(*(f(c).alias(f"r_{c}") for c, f in sums.items()))
        risen = risen.withColumnsRenamed({"up_rep": "k_rep", "up_ext": "k_ext"})
        ups = now.select(
            F.col("rep").alias("j_rep"), F.col("ext").alias("j_ext"), F.col("up_rep").alias("u_rep"), F.col("up_ext").alias("u_ext")
        )
        joined = now.join(risen, (F.col("rep") == F.col("k_rep")) & (F.col("ext") == F.col("k_ext")), "left")
        joined = joined.join(ups, (F.col("up_rep") == F.col("j_rep")) & (F.col("up_ext") == F.col("j_ext")), "left")
        plus = {F.sum: lambda a, b: a + F.coalesce(b, F.lit(0)), F.min: lambda a, b: F.least(a, b)}
        now = written(
            joined.select(
                "rep", "ext", F.col("u_rep").alias("up_rep"), F.col("u_ext").alias("up_ext"),
                *(plus[f](F.col(c), F.col(f"r_{c}")).alias(c) for c, f in sums.items()),
            ),
            "trie-sums",
        )
    return now.select("rep", "ext", *values)


def id_digests(ids: DataFrame) -> DataFrame:
    """``sid`` and the SHA-256 of its ids (``conv_id``) in order, comma-joined.

    Ranges of (sid, id) are joined into strings where they lie, so that of a sequence that many
    conversations share one task only hashes the strings, a batch at a time.
    """

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sid, first, held = None, None, []

        def full() -> pa.RecordBatch:
            return pa.record_batch([pa.array([sid]), pa.array([first]), pa.array([",".join(held)])], names=["sid", "first", "ids"])

        for batch in batches:
            for s, i in zip(batch.column("sid").to_pylist(), batch.column("conv_id").to_pylist(), strict=True):
                if held and (s != sid or len(held) == CHUNK_IDS):
                    yield full()
                    held = []
                if not held:
                    sid, first = s, i
                held.append(str(i))
        if held:
            yield full()

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sid, state, out = None, None, []
        for batch in batches:
            for s, ids in zip(batch.column("sid").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if s == sid:
                    state.update(b"," + ids.encode())
                    continue
                if state:
                    out.append((sid, state.hexdigest()))
                sid, state = s, hashlib.sha256(ids.encode())
            if out:
                yield pa.record_batch([pa.array(c) for c in zip(*out, strict=True)], names=["sid", "sha"])
                out = []
        if state:
            yield pa.record_batch([pa.array([sid]), pa.array([state.hexdigest()])], names=["sid", "sha"])

    placed = ids.repartitionByRange("sid", "conv_id").sortWithinPartitions("sid", "conv_id")
    joined = placed.mapInArrow(chunks, "sid long, first long, ids string")
    return joined.repartition("sid").sortWithinPartitions("sid", "first").mapInArrow(hashes, "sid long, sha string")


def prefix_trie(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row per prefix of turns that any conversation begins with, the empty one included.

    ``turns`` has ``conv_id``, ``depth`` (from 1, gapless), ``k1``, ``k2`` (hash of the turn) and
    ``words``; ``conversations`` has every ``conv_id``, those without turns too. Returned are
    ``conv_id`` (the smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens`` and ``ends_sha256``, all but the last of type long.

    Prefixes are the same if their 128-bit signatures are. Repeated ids of ``conversations``
    count once; a depth that occurs twice in a conversation is an error of the caller. No
    conversations give no rows; conversations without turns give the root.
    """
    prefixes, totals = _signed(turns)
    prefixes = written(prefixes, "trie-prefixes")
    zero = F.lit(0).cast("long")
    ids = conversations.select("conv_id").distinct().join(totals, "conv_id", "left")
    ids = written(ids.select("conv_id", *(F.coalesce(c, zero).alias(c) for c in ("size", "e1", "e2"))), "trie-ids")
    sequences = written(
        ids.groupBy("size", "e1", "e2").agg(F.min("conv_id").alias("sid"), F.count("*").alias("members")), "trie-sequences"
    )
    steps = prefixes.join(sequences.select(F.col("sid").alias("conv_id")), "conv_id", "left_semi")
    steps = written(steps.withColumnRenamed("conv_id", "sid"), "trie-steps")
    end = F.col("size") + 1
    marks = sequences.select(
        "sid", end.alias("depth"), *(F.col(e).bitwiseXOR(F.xxhash64(F.lit(s), end)).alias(e) for s, e in ((5, "e1"), (6, "e2")))
    )
    cells = steps.select("sid", "depth", "e1", "e2").union(marks).groupBy("sid", F.floor((F.col("depth") - 1) / SEGMENT).alias("cell"))
    cells = cells.agg(F.array_sort(F.collect_list(F.struct("depth", "e1", "e2"))).alias("s"))
    segments = written(cells.select("sid", "cell", F.col("s.e1").alias("s1"), F.col("s.e2").alias("s2")), "trie-segments")
    trie = Trie(sequences, segments)

    of_leaf = sequences.select(F.col("sid").alias("l_sid"), (F.col("size") + 1).alias("l_ext"), "members")
    edges = trie.edges.join(of_leaf, (F.col("rep") == F.col("l_sid")) & (F.col("ext") == F.col("l_ext")), "left")
    leaf = F.col("members").isNotNull()
    edges = written(
        edges.select(
            "rep", "top", "ext", "prep", "pext", "members",
            # The last real turn: a leaf's edge ends with its end mark.
            (F.col("ext") - leaf.cast("long")).alias("bottom"),
        ),
        "trie-edges",
    )
    # "Expand edges": the turns along each of them.
    along = edges.where("bottom > top").select("rep", "ext", F.explode(F.sequence(F.col("top") + 1, F.col("bottom"))).alias("depth"))
    along = along.join(steps.select(F.col("sid").alias("rep"), "depth", "words", "upto"), ["rep", "depth"])
    along = written(along, "trie-along")
    root = sequences.limit(1).select(zero.alias("rep"), zero.alias("ext"))
    null = F.lit(None).cast("long")
    everywhere = edges.select(
        "rep", "ext", "prep", "pext", F.coalesce("members", zero).alias("n"), F.when(leaf, F.col("rep")).alias("least"),
        (leaf & (F.col("bottom") > F.col("top"))).cast("long").alias("leaves"),
        (F.col("bottom") > F.col("top")).cast("long").alias("child"),
    )
    nodes = everywhere.drop("child").union(root.select("rep", "ext", null, null, zero, null, zero))
    counted = written(_subtree(nodes, {"n": F.sum, "least": F.min, "leaves": F.sum}), "trie-counted")
    lengths = along.groupBy("rep", "ext").agg(F.sum("words").alias("words"), F.max("upto").alias("upto"))
    costs = edges.select("rep", "ext", "prep", "pext").union(root.select("rep", "ext", null, null))
    costs = costs.join(counted, _EDGE).join(lengths, _EDGE, "left")
    own = (F.col("n") - 1) * F.coalesce("words", zero)
    costs = written(costs.select("rep", "ext", "prep", "pext", own.alias("saved"), own.alias("own"), "upto"), "trie-costs")
    saved = _subtree(costs, {"saved": F.sum}).join(costs.select("rep", "ext", "own", "upto"), _EDGE)
    children = everywhere.groupBy(F.col("prep").alias("rep"), F.col("pext").alias("ext")).agg(F.sum("child").alias("n_children"))
    digests = id_digests(ids.join(sequences, ["size", "e1", "e2"]).select("sid", "conv_id"))
    # A sequence that ends where others go on ends at its parent node.
    stops = edges.where("members IS NOT NULL").select(
        F.col("rep").alias("sid"),
        *(F.when(F.col("bottom") > F.col("top"), F.col(o)).otherwise(F.col(p)).alias(o) for o, p in (("rep", "prep"), ("ext", "pext"))),
    )
    ends = stops.join(digests, "sid").select("rep", "ext", "sha")
    facts = written(
        counted.join(saved, _EDGE).join(children, _EDGE, "left").join(ends, _EDGE, "left")
        .select("rep", "ext", "n", "least", "leaves", (F.col("saved") - F.col("own")).alias("below"), "upto",
                F.coalesce("n_children", zero).alias("n_children"), F.coalesce("sha", F.lit(_NO_ENDS)).alias("sha")),
        "trie-facts",
    )
    of_parent = facts.select(F.col("rep").alias("prep"), F.col("ext").alias("pext"), F.col("least").alias("p_least"))
    placed = edges.select("rep", "top", "ext", "bottom", "prep", "pext").join(facts, _EDGE).join(of_parent, ["prep", "pext"])
    last = F.col("depth") == F.col("bottom")
    rows = along.select("rep", "ext", "depth", "words", F.col("upto").alias("at")).join(placed, _EDGE).select(
        F.col("least").alias("conv_id"), "depth",
        F.when(F.col("depth") == F.col("top") + 1, F.col("p_least")).otherwise(F.col("least")).alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.when(last, F.col("n_children")).otherwise(1).alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        ((F.col("n") - 1) * (F.col("upto") - F.col("at") + F.col("words")) + F.col("below")).alias("saved_tokens"),
        F.when(last, F.col("sha")).otherwise(F.lit(_NO_ENDS)).alias("ends_sha256"),
    )
    top = facts.where("ext = 0").select(
        F.col("least").alias("conv_id"), zero.alias("depth"), null.alias("parent_conv_id"), F.col("n").alias("n_convs"),
        "n_children", F.greatest("leaves", F.lit(1)).alias("n_leaves"), F.col("below").alias("saved_tokens"), F.col("sha").alias("ends_sha256"),
    )
    return rows.union(top)


def with_shared_heads(
    turns: DataFrame, group: int = 20, most: int = 4
) -> tuple[DataFrame, DataFrame]:
    """Turns and ids of conversations whose first turns are those of the first of their group.

    Of conversation c the first h turns are those of c - c % ``group``, where h is the crc32 of c as
    text modulo ``most``, then its own after its first h.
    """
    ids = turns.select("conv_id").distinct().select(
        "conv_id",
        (F.col("conv_id") - F.col("conv_id") % group).alias("base"),
        (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).alias("h"),
    )
    ids = written(ids, "head-ids")
    heads = turns.where((F.col("conv_id") % group == 0) & (F.col("pos") < most))
    heads = heads.select(F.col("conv_id").alias("of"), F.col("pos").alias("depth"), "k1", "k2", "words")
    lent = ids.join(heads, (F.col("base") == F.col("of")) & (F.col("depth") <= F.col("h")))
    sizes = heads.groupBy("of").agg(F.count("*").alias("n"))
    begun = ids.join(sizes, F.col("base") == F.col("of"), "left").select(
        "conv_id", "h", F.least("h", F.coalesce("n", F.lit(0))).alias("begun")
    )
    own = turns.join(begun, "conv_id").where("pos > h")
    own = own.select("conv_id", (F.col("begun") + F.col("pos") - F.col("h")).alias("depth"), "k1", "k2", "words")
    return lent.select("conv_id", "depth", "k1", "k2", "words").union(own), ids.select("conv_id")
