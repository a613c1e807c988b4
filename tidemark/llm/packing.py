"""Packing token pieces into sequences: best fit, then a swap-based local search, by blocks."""

from __future__ import annotations

import base64
import json
import os
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from functools import cache, partial
from itertools import combinations

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm.common import written

VOCABULARY = "byte_bpe_50k.tiktoken"  # the ids of byte_bpe_50k.json as ranks


def added_tokens(path: str) -> dict[str, int]:
    """The added tokens of the vocabulary whose ranks are in ``path``, from the json file beside it."""
    whole = os.path.splitext(path)[0] + ".json"
    if not os.path.exists(whole):
        return {}
    with open(whole, encoding="utf-8") as file:
        found = json.load(file)["added_tokens"]
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in found):
        raise ValueError(f"{whole}: added tokens that depend on what is around them")
    return {t["content"]: t["id"] for t in found}


def encoder(path: str) -> tiktoken.Encoding:
    """The byte-level encoder of a rank file with its added tokens, made once per worker process."""
    known = tiktoken.registry.ENCODINGS
    if path not in known:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        known[path] = tiktoken.Encoding(
            os.path.basename(path),
            pat_str=public_tokenizers.PATTERN,
            mergeable_ranks=ranks,
            special_tokens=added_tokens(path),
        )
    return known[path]


def token_ids(path: str, text: str) -> list[int]:
    """The ids of a text. The fast encoder gives up on runs of about a million white-space
    characters; such a text goes to the vocabulary's own tokenizer."""
    try:
        return encoder(path).encode(text, allowed_special="all")
    except ValueError:
        return tokenizer(path).encode(text, add_special_tokens=False).ids


@cache
def tokenizer(path: str) -> Tokenizer:
    return Tokenizer.from_file(f"{os.path.splitext(path)[0]}.json")


def cut(n: int, capacity: int) -> list[int]:
    """Lengths of the pieces of ``n`` tokens: all full but the first, which may be shorter."""
    first = n % capacity or capacity
    return [first] + [capacity] * ((n - first) // capacity)


def pieces(docs: DataFrame, id_col: str, text_col: str, capacity: int, end_id: int, path: str) -> DataFrame:
    """``id``, ``piece``, ``start``, ``length``, ``ids_crc32`` of each piece of each document."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = partial(token_ids, path)
        for batch in batches:
            of, piece, start, length, crc = [], [], [], [], []
            for i, text in enumerate(batch.column("text")):
                ids = np.array([*encode(text.as_py()), end_id], "<u4")
                at = 0
                for k, size in enumerate(cut(len(ids), capacity)):
                    of.append(i)
                    piece.append(k)
                    start.append(at)
                    length.append(size)
                    crc.append(zlib.crc32(ids[at : at + size].tobytes()))
                    at += size
            yield pa.record_batch(
                [
                    batch.column("id").take(pa.array(of, pa.int64())),
                    pa.array(piece, pa.int32()),
                    *(pa.array(x, pa.int64()) for x in (start, length, crc)),
                ],
                names=["id", "piece", "start", "length", "ids_crc32"],
            )

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, piece int, start long, length long, ids_crc32 long")


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Bins of item numbers; each item, larger first, goes to the fullest bin that takes it."""
    bins: list[list[int]] = []
    by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
    free_bits = 0  # bit f is set when a bin has f tokens free
    for item in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        size = sizes[item]
        above = free_bits >> size
        if above:
            free = size + ((above & -above).bit_length() - 1)
            at = by_free[free].pop()
            if not by_free[free]:
                free_bits &= ~(1 << free)
            bins[at].append(item)
        else:
            free, at = capacity, len(bins)
            bins.append([item])
        free -= size
        by_free[free].append(at)
        free_bits |= 1 << free
    return bins


def _better_exchange(own: list[int], other: list[int], free: int, sizes: list[int]):
    """(gain, items out of own, items out of other) that fills ``other`` most, one or two for one."""
    best = (0, (), ())
    mine = [((a,), sizes[a]) for a in own]
    pairs = [(c, sizes[c[0]] + sizes[c[1]]) for c in combinations(own, 2)]
    theirs = [((b,), sizes[b]) for b in other]
    doubles = [(c, sizes[c[0]] + sizes[c[1]]) for c in combinations(other, 2)]
    for out, options in [(x, mine + pairs) for x in theirs] + [(x, mine) for x in doubles]:
        for back, size in options:
            gain = size - out[1]
            if best[0] < gain <= free:
                best = (gain, back, out[0])
                if gain == free:
                    return best
    return best


def _fuller(victim: int, bins: list[list[int]], fills: list[int], capacity: int) -> list[int]:
    """Bins with room that are at least as full as the victim, emptier first."""
    found = [t for t in range(len(bins)) if t != victim and bins[t] and fills[victim] <= fills[t] < capacity]
    return sorted(found, key=fills.__getitem__)


def _move_out(victim: int, bins: list[list[int]], fills: list[int], sizes: list[int], capacity: int) -> bool:
    """Move what fits elsewhere, larger items first, each to the fullest bin that takes it."""
    others = _fuller(victim, bins, fills, capacity)
    fullness, moved = [fills[t] for t in others], False
    for a in sorted(bins[victim], key=lambda i: -sizes[i]):
        k = bisect_right(fullness, capacity - sizes[a]) - 1
        if k >= 0:
            t = others.pop(k)
            fullness.pop(k)
            bins[victim].remove(a)
            bins[t].append(a)
            fills[t] += sizes[a]
            fills[victim] -= sizes[a]
            moved = True
    return moved


def _exchange(victim: int, bins: list[list[int]], fills: list[int], sizes: list[int], capacity: int) -> bool:
    """Make the one exchange that fills another bin most."""
    best = (0, (), (), -1)
    for t in _fuller(victim, bins, fills, capacity):
        if capacity - fills[t] <= best[0]:
            break
        found = _better_exchange(bins[victim], bins[t], capacity - fills[t], sizes)
        if found[0] > best[0]:
            best = (*found, t)
    gain, back, out, t = best
    if gain:
        bins[victim] = [i for i in bins[victim] if i not in back] + list(out)
        bins[t] = [i for i in bins[t] if i not in out] + list(back)
        fills[victim] -= gain
        fills[t] += gain
    return gain > 0


def local_search(bins: list[list[int]], sizes: list[int], capacity: int, patience: int = 64) -> list[list[int]]:
    """Empty the emptiest bins by moves and exchanges, each of which raises the sum of squared fills."""
    # Items over half a bin never share one.
    least = max(-(-sum(sizes) // capacity), sum(2 * s > capacity for s in sizes))
    fills = [sum(sizes[i] for i in b) for b in bins]
    left, better = len(bins), True
    while better and left > least:
        better = False
        victims = sorted((t for t in range(len(bins)) if bins[t]), key=fills.__getitem__)
        for victim in victims[: 2 * (left - least) + 8]:
            for _ in range(patience):
                moved = _move_out(victim, bins, fills, sizes, capacity)
                if not bins[victim]:
                    left -= 1
                gained = bool(bins[victim]) and _exchange(victim, bins, fills, sizes, capacity)
                better |= moved or gained
                if not gained:
                    break
            if left <= least:
                break
    return [b for b in bins if b]


def pack_block(rows: pd.DataFrame, capacity: int, turn: int) -> pd.DataFrame:
    """The rows with ``sequence_id``, ``offset`` and the ``fill`` of their sequence."""
    rows = rows.sort_values(["length", "id", "piece", "ids_crc32"], ascending=False, kind="stable").reset_index(drop=True)
    sizes = rows["length"].tolist()
    bins = local_search(best_fit(sizes, capacity), sizes, capacity)
    sequence, offset, fill = np.empty(len(rows), np.int64), np.empty(len(rows), np.int64), np.empty(len(rows), np.int64)
    top = (int(rows["block"].iloc[0]) << 30) | (turn << 24)
    for k, items in enumerate(bins):
        at = 0
        for i in items:
            sequence[i], offset[i] = top | k, at
            at += sizes[i]
        fill[items] = at
    return rows.assign(sequence_id=sequence, offset=offset, fill=fill).drop(columns="block")


def packed(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = 1024,
    end_id: int = 2,
    tokenizer_path: str | None = None,
    block_pieces: int = 4096,
    settled: float = 0.98,
) -> DataFrame:
    """Each piece with its place: ``id``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``, ``offset``.

    A document is its tokens and ``end_id``; null texts are empty. Added tokens of the vocabulary
    count as such where a text spells them. Only documents longer than
    ``capacity`` are cut. Full pieces are sequences by themselves. The others are dealt by hash to
    blocks of about ``block_pieces``; a block is filled by best fit and improved by local search.
    Sequences at least ``settled`` full are final; pieces of the others meet again in fewer
    blocks, until one block is left or blocks no longer help. Rows are placed one by one, so
    repeated rows and null ids need no special case. No rows give no rows.
    """
    path = tokenizer_path or public_tokenizers.path(VOCABULARY)
    cut_up = written(pieces(docs, id_col, text_col, capacity, end_id, path), "pieces")
    full = cut_up.where(F.col("length") == capacity)
    done = full.withColumn("sequence_id", -1 - F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))
    columns = done.columns
    rest, turn = cut_up.where(F.col("length") < capacity), 0
    left = rest.count()
    while left:
        blocks = -(-left // block_pieces)
        key = F.pmod(F.xxhash64("id", "piece", "ids_crc32", F.lit(turn)), F.lit(blocks))
        dealt = rest.withColumn("block", key)
        place = _placing(capacity, turn)
        kind = dealt.schema["id"].dataType.simpleString()
        out = written(
            dealt.groupBy("block").applyInPandas(
                place,
                f"id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long, fill long",
            ),
            "packed",
        )
        again = out.where(F.col("fill") < settled * capacity)
        before, left = left, again.count() if blocks > 1 else 0
        if left > 0.7 * before:
            left = 0
        done = done.union((out.where(F.col("fill") >= settled * capacity) if left else out).select(*columns))
        rest, turn = again.select(*cut_up.columns), turn + 1
    return done


def _placing(capacity: int, turn: int):
    def place(rows: pd.DataFrame) -> pd.DataFrame:
        return pack_block(rows, capacity, turn)

    return place
