"""SimHash near-duplicate detection by a hierarchical index in Gray order.

1. A text's fingerprint has 64 bits: bit i is set if it is set in more than half of the hashes of its word shingles, repeats included.  Equal
   fingerprints are one class from here on.
2. Upper nodes of the index are masked bit patterns: fingerprints that agree under a mask stand below one node.  Two fingerprints with at most k
   differing bits agree on one of any k + 1 blocks of bits, so each fingerprint stands below one node for each block and meets every partner below one.
   A node of more than LIMIT members is refined: first to its whole block, then by k + 1 blocks of the bits that are left, and so on until
   at most 20 bits are left, which bounds a node at 2**20 members; nothing is dropped or cut.
3. Below a node, fingerprints are sorted by Gray rank (the number whose Gray code they are), so that neighbours share most bits.  Runs of FANOUT members, of
   runs, and so on, form the lower nodes; each stores the bits that all its members share and its parent's do not.  A search goes down from the top and adds up
   the differences on these bits: as soon as they exceed k, the whole group is left.
4. What a node finds is reduced to a spanning forest, so it gives fewer links than it has members.  Components of the links come from alternating
   large-star and small-star.

Defined results: null and empty texts and texts without words have the fingerprint zero and are linked like any other; texts with fewer words than a shingle have one shingle, all their words;
texts of any length are read whole; repeated rows and rows that repeat an id are rows of their own; a null id does not count for the smallest id of its component, which is null if there
is no other; an empty table gives an empty result; other columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from factloom.llm import textbatch as tb
from factloom.llm.common import arrow_map, join_heavy
from factloom.llm.components import components
from factloom.storage import drop_materialized, materialize

SHINGLE, SEED, DIFFER, BITS = 3, 42, 2, 64
#: Members that an upper node has on average, about, and at most before it is refined.
TARGET, LIMIT = 512, 32_768
#: Children of a lower node, and pairs of fingerprint and node that a task looks at together.
FANOUT, FRONTIER = 8, 1 << 18
_ALL = (1 << BITS) - 1


def shingle_hashes(s: tb.Slice, shingle: int = SHINGLE, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of each shingle of a slice (words joined by one space), and its row."""
    w = tb.words(s)
    length = w.end - w.start
    at = np.cumsum(length + 1) - (length + 1)  # of each word in the spaced text
    inside = np.zeros(len(s.data) + 1, np.int8)
    inside[w.start] += 1
    inside[w.end] -= 1
    spaced = np.full(int((length + 1).sum()), 0x20, np.uint8)
    spaced[np.arange(int(length.sum())) + np.repeat(np.arange(len(w)), length)] = s.data[np.cumsum(inside[:-1], dtype=np.int8).astype(bool)]
    m = max(len(w) - shingle + 1, 0)
    first = np.flatnonzero(w.row[:m] == w.row[shingle - 1 :]) if m else np.zeros(0, np.int64)
    few = np.flatnonzero((w.counts() > 0) & (w.counts() < shingle))
    first, last = np.concatenate([first, w.bounds[few]]), np.concatenate([first + shingle - 1, w.bounds[few + 1] - 1])
    order = np.argsort(first)
    first, last = first[order], last[order]
    text, f = spaced.tobytes(), xxhash.xxh64_intdigest
    h = np.fromiter((f(text[a:b], seed) for a, b in zip(at[first].tolist(), (at[last] + length[last]).tolist(), strict=True)), np.uint64, len(first))
    return h, w.row[first] if len(w) else np.zeros(0, np.int64)


def majority(h: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """The fingerprint of each row from its hashes, which stand in row order."""
    out = np.zeros(rows, np.uint64)
    if len(h):
        have, at, n = np.unique(row, return_index=True, return_counts=True)
        bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        count = np.add.reduceat(bits, at, axis=0, dtype=np.int32)
        out[have] = np.packbits(2 * count > n[:, None], axis=1, bitorder="little").view("<u8")[:, 0]
    return out


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED, id_column: str = "doc_id") -> DataFrame:
    """(id, code) of every row; code is the fingerprint as a signed long."""
    schema = StructType([StructField("id", docs.schema[id_column].dataType), StructField("code", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            codes = [majority(*shingle_hashes(s.lower(), shingle, seed), s.rows) for s in tb.slices(rb["text"])]
            yield pa.RecordBatch.from_arrays([rb["id"], pa.array(np.concatenate([np.zeros(0, np.uint64), *codes]).view(np.int64))], names=["id", "code"])

    return arrow_map(docs.select(F.col(id_column).alias("id"), "text"), run, schema)


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """The number whose Gray code each code is."""
    r = codes.copy()
    for k in (1, 2, 4, 8, 16, 32):
        r ^= r >> np.uint64(k)
    return r


def gray_tree(codes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(mask, pattern) of the nodes of each level above ``codes``, which stand in Gray order, from the codes to the top.

    mask has the bits that all members of a node share and those of its parent do not; pattern has their values.
    """
    both, any_of = codes, codes
    shared = [(np.full(len(codes), _ALL, np.uint64), codes)]
    while len(both) > 1:
        at = np.arange(0, len(both), FANOUT)
        both, any_of = np.bitwise_and.reduceat(both, at), np.bitwise_or.reduceat(any_of, at)
        mask = ~(both ^ any_of)
        shared.append((mask, both & mask))
    levels = []
    for k, (mask, pattern) in enumerate(shared):
        own = mask if k + 1 == len(shared) else mask & ~shared[k + 1][0][np.arange(len(mask)) // FANOUT]
        levels.append((own, pattern & own))
    return levels


def close_pairs(codes: np.ndarray, differ: int = DIFFER) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i, j), i < j, of the distinct codes, which stand in Gray order, with at most ``differ`` differing bits, each once."""
    levels, n = gray_tree(codes), len(codes)
    top = len(levels) - 1
    step = max(1, FRONTIER // FANOUT)
    todo = [(top, np.arange(a, min(a + step, n)), np.zeros(min(a + step, n) - a, np.int64), np.zeros(min(a + step, n) - a, np.int64)) for a in range(0, n, step)]
    while todo:
        level, of, node, sum_ = todo.pop()
        mask, pattern = levels[level]
        sum_ = sum_ + np.bitwise_count((codes[of] ^ pattern[node]) & mask[node])
        last = np.minimum((node + 1) * FANOUT**level, n) - 1
        stay = (sum_ <= differ) & (last > of)
        of, node, sum_ = of[stay], node[stay], sum_[stay]
        if not level:
            yield of, node
            continue
        below = len(levels[level - 1][0])
        for a in range(0, len(of), step):
            child = (node[a : a + step, None] * FANOUT + np.arange(FANOUT)).ravel()
            there = child < below
            todo.append((level - 1, np.repeat(of[a : a + step], FANOUT)[there], child[there], np.repeat(sum_[a : a + step], FANOUT)[there]))


def spanning_links(codes: np.ndarray, differ: int = DIFFER) -> tuple[np.ndarray, np.ndarray]:
    """Links that join the same codes as all links of at most ``differ`` bits do: each code with the first one of its component."""
    codes = np.unique(codes)
    codes = codes[np.argsort(gray_rank(codes))]
    label = np.arange(len(codes))
    for a, b in close_pairs(codes, differ):
        while len(a):  # hook the larger root below the smaller, until every pair has one root
            ra, rb = label[a], label[b]
            apart = ra != rb
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            np.minimum.at(label, np.maximum(ra, rb), np.minimum(ra, rb))
            while (label != (up := label[label])).any():
                label = up
    other = np.flatnonzero(label != np.arange(len(codes)))
    return codes[other], codes[label[other]]


def blocks_of(bits: list[int], parts: int) -> list[int]:
    """Masks of ``parts`` blocks, about equal, of these bits."""
    cut = [len(bits) * i // parts for i in range(parts + 1)]
    return [sum(1 << b for b in bits[a:z]) for a, z in zip(cut, cut[1:], strict=False)]


def refinements(differ: int, first_bits: int) -> list[dict[int, list[int]]]:
    """For each level, the masks below each mask of the level before: the first bits of each block, whole blocks, then blocks of what is left, down to 20 bits at most.

    A pair that agrees under a mask and differs in at most ``differ`` bits agrees under one of the masks below it.
    """
    top = list(range(BITS - 1, -1, -1))
    whole = blocks_of(top, differ + 1)
    start = {m: sum(1 << b for b in [b for b in top if m >> b & 1][:first_bits]) for m in whole}
    levels = [{0: list(start.values())}]
    if any(start[m] != m for m in whole):
        levels.append({start[m]: [m] for m in whole})
    masks = whole
    while any(BITS - m.bit_count() > 20 for m in masks):
        levels.append({m: [m | x for x in blocks_of([b for b in top if not m >> b & 1], differ + 1)] for m in masks})
        masks = list({x for below in levels[-1].values() for x in below})
    return levels


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def _below(rows: DataFrame, level: dict[int, list[int]]) -> DataFrame:
    """(mask, pattern, code): each row of (mask, code) below the masks that refine its own."""
    masks = F.array().cast("array<bigint>")
    for m, fine in level.items():
        masks = F.when(F.col("mask") == _signed(m), F.array(*[F.lit(_signed(x)).cast("long") for x in fine])).otherwise(masks)
    return rows.select("code", F.explode(masks).alias("mask")).select("mask", F.col("code").bitwiseAND(F.col("mask")).alias("pattern"), "code")


def index_nodes(codes: DataFrame, differ: int = DIFFER, target: int = TARGET, limit: int = LIMIT) -> DataFrame:
    """(mask, pattern, code): the upper nodes (mask, pattern) that each of the distinct codes stands below."""
    n = codes.count()
    first_bits = max(1, min(BITS // (differ + 1), (max(n, 1) // target).bit_length()))
    levels = refinements(differ, first_bits)
    done, rows = [], _below(codes.select(F.lit(0).cast("long").alias("mask"), "code"), levels[0])
    for level in levels[1:]:
        large = materialize(rows.groupBy("mask", "pattern").agg(F.count("*").alias("c")).where(F.col("c") > limit).select("mask", "pattern"), "large")
        m = large.count()  # a row for every ``limit`` rows at most
        if not m:
            break
        large = F.broadcast(large) if m <= 100_000 else large
        done.append(rows.join(large, ["mask", "pattern"], "left_anti"))
        rows = materialize(_below(rows.join(large, ["mask", "pattern"], "left_semi").select("mask", "code"), level), "refined")
    for d in done:
        rows = rows.unionByName(d)
    return rows


def code_links(nodes: DataFrame, differ: int = DIFFER) -> DataFrame:
    """(u, v): links between codes, fewer than a node has members."""

    def run(t: pa.Table) -> pa.Table:
        u, v = spanning_links(np.asarray(t["code"], np.int64).view(np.uint64), differ)
        return pa.table({"u": pa.array(u.view(np.int64)), "v": pa.array(v.view(np.int64))})

    return nodes.groupBy("mask", "pattern").applyInArrow(run, "u long, v long")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, differ: int = DIFFER, seed: int = SEED, id_column: str = "doc_id") -> DataFrame:
    """id, fingerprint (16 hex digits) and component_id (the smallest id reachable, itself included) of every row."""
    rows = materialize(fingerprints(docs, shingle, seed, id_column), "fingerprints")
    classes = materialize(rows.groupBy("code").agg(F.min("id").alias("first")), "codes")
    found = materialize(components(code_links(index_nodes(classes.select("code"), differ), differ)), "components")
    least = found.join(classes.withColumnRenamed("code", "vertex"), "vertex").groupBy("component").agg(F.min("first").alias("component_id"))
    member = join_heavy(found, materialize(least, "least"), "component").select(F.col("vertex").alias("code"), "component_id", F.lit(True).alias("linked"))
    of = classes.join(member, "code", "left").select("code", F.when(F.col("linked"), F.col("component_id")).otherwise(F.col("first")).alias("component_id"))
    out = join_heavy(rows, materialize(of, "classes"), "code")
    drop_materialized(found)
    return out.select(F.col("id").alias(id_column), F.lpad(F.lower(F.hex("code")), 16, "0").alias("fingerprint"), "component_id")
