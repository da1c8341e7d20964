"""MinHash near-duplicate detection with exact confirmation.

1. Every text becomes its set of distinct five-word shingles (hashed to 64 bits) and ``HASHES`` universal-hash minima.
2. Texts with the same set are one class, represented by their smallest id.
3. The minima are banded; classes that share a band fall into one bucket.  A pair from a bucket is a candidate if its
   sizes allow the similarity and its 256 signature bits agree often enough.
4. Candidates are confirmed on the full sets.  First every class is compared with the most central of its buckets'
   leaders (the members with the most bucket mates).  Components of these links are then computed, and in each bucket all
   members outside its largest component are compared with all members of other components, after a longer signature has ruled out most.  So every candidate pair is either compared or already
   in one component, while a bucket of n mutual copies costs n comparisons.
5. Components come from alternating large-star and small-star.

At a similarity of exactly 0.75 a pair shares no band with a probability of 5e-6, and fails the signature bits with one of about
1e-6; both fall fast above it.

Buckets of any size are spread over tasks: joins by bucket are salted by SALT_ROWS members, and a large bucket's remaining members are packed into blocks of SPLIT, whose
pairs are the tasks. The rows made are thus linear in the members, plus the pairs of blocks; the comparisons of members that no hub links grow with the square.

Defined results: a text without words has an empty set and no links; a text of any length is compared whole; an empty table gives an empty result; a null id has a null component and is kept; rows that
repeat an id are one vertex, linked through each of their texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.llm import textbatch as tb
from factloom.llm.common import arrow_map, batch
from factloom.llm.components import components
from factloom.storage import drop_materialized, materialize, release

SHINGLE, PERCENT = 5, 75
HASHES, BANDS, SEED = 128, 32, 3
_BLOCK = 1 << 19
_SIEVE_BITS = 1 << 26
#: Bits of the second signature, for members of buckets that hold several components.
LONG_BITS = 4096
#: Members of a block, about: a sixteenth of the bucket's, but at most SPLIT and not fewer than LEAST_SPLIT.
SPLIT, LEAST_SPLIT = 4096, 512
#: Rows of one bucket that a task gets in a join by bucket, about.
SALT_ROWS = 1024
#: Pairs of one first member that are confirmed together, about; its set is repeated for each part.
CONFIRM_ROWS = 256
#: Members of a bucket that is compared by a join; larger ones are compared in blocks.
SMALL = 48


def _family(n: int = HASHES, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 1 << 63, n, dtype=np.uint64)


def minima(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least value of each hash a*x+b mod 2**64 over the set."""
    m, width = None, max(1, _BLOCK // len(a))
    for i in range(0, len(x), width):
        z = np.multiply.outer(a, x[i : i + width])
        z += b[:, None]
        z = z.min(axis=1)
        m = z if m is None else np.minimum(m, z)
    return m


def bands(m: np.ndarray) -> np.ndarray:
    """A 64-bit key of each band: equal minima of the band's hashes."""
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for column in m.reshape(BANDS, -1).T:
        key = tb.mix(key + column)
    return key


def signature(m: np.ndarray) -> np.ndarray:
    """Two well-mixed bits of each minimum, as four longs."""
    x = tb.mix(m)
    return np.packbits(np.concatenate([x & np.uint64(1), (x >> np.uint64(1)) & np.uint64(1)]).astype(np.uint8)).view(np.int64)


def sketches(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """id, n (set size), h1 and h2 (128-bit set hash), bands and s (signature) of each row; n is 0 without words."""
    a, b = _family()

    def run(batches):
        for rb in batches:
            n, h1, h2, keys, bits = [], [], [], [], []
            for s in tb.slices(rb["text"]):
                h, row, _ = tb.ngrams(tb.words(s.lower()), SHINGLE, short=True)
                at = np.searchsorted(row, np.arange(s.rows + 1))
                for i in range(s.rows):
                    x = np.unique(h[at[i] : at[i + 1]])
                    n.append(len(x))
                    h1.append(int(x.sum(dtype=np.uint64).view(np.int64)) if len(x) else 0)
                    h2.append(int(tb.mix(x ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).view(np.int64)) if len(x) else 0)
                    m = minima(x, a, b) if len(x) else None
                    keys.append(bands(m).view(np.int64) if len(x) else None)
                    bits.append(signature(m) if len(x) else None)
            yield batch(id=rb["id"], n=pa.array(n, pa.int64()), h1=pa.array(h1, pa.int64()), h2=pa.array(h2, pa.int64()), bands=pa.array(keys, pa.list_(pa.int64())), s=pa.array(bits, pa.list_(pa.int64())))

    return arrow_map(docs.select(F.col(id_column).cast("long").alias("id"), "text"), run, "id long, n long, h1 long, h2 long, bands array<long>, s array<long>")


def _sieve(ids: DataFrame) -> np.ndarray:
    """A bitmap that holds the hash of every id, for dropping most other rows early: some 64 bits an id, 8 MB at most."""
    bits = min(_SIEVE_BITS, max(1 << 10, 1 << (64 * ids.count()).bit_length()))
    slot = F.pmod(F.xxhash64("id"), F.lit(bits))
    rows = ids.select(slot.alias("slot")).select(F.expr("CAST(slot DIV 32 AS INT)").alias("i"), F.expr("shiftleft(1L, CAST(slot % 32 AS INT))").alias("b"))
    out = np.zeros(bits // 32, np.uint32)
    for r in rows.groupBy("i").agg(F.bit_or("b").alias("b")).toLocalIterator():
        out[r["i"]] = r["b"]
    return out


def _sets(docs: DataFrame, ids: DataFrame, long_signature: bool = False) -> DataFrame:
    """(id, h1, set) with the sorted shingle hashes of the texts of ``ids`` (id, h1); with ``long_signature`` also t, LONG_BITS bits."""
    family = _family(LONG_BITS, SEED + 1) if long_signature else None
    sieve = _sieve(ids)
    ship = docs.sparkSession.sparkContext.broadcast(sieve)  # 8 MB at most
    slot = F.pmod(F.xxhash64("id"), F.lit(32 * len(sieve)))

    def run(batches):
        for rb in batches:
            at = rb["slot"].to_numpy()
            rb = rb.filter(pa.array((ship.value[at // 32] >> (at % 32).astype(np.uint32)) & 1 == 1))
            sets, h1, t = [], [], []
            for s in tb.slices(rb["text"]):
                h, row, _ = tb.ngrams(tb.words(s.lower()), SHINGLE, short=True)
                bounds = np.searchsorted(row, np.arange(s.rows + 1))
                for i in range(s.rows):
                    x = np.unique(h[bounds[i] : bounds[i + 1]])
                    sets.append(x.tobytes())
                    h1.append(int(x.sum(dtype=np.uint64).view(np.int64)) if len(x) else 0)
                    if family and len(x):
                        t.append(np.packbits((tb.mix(minima(x, *family)) & np.uint64(1)).astype(np.uint8)).view(np.int64))
                    else:
                        t.append(None)
            yield batch(id=rb["id"], h1=pa.array(h1, pa.int64()), set=pa.array(sets, pa.binary()), t=pa.array(t, pa.list_(pa.int64())))

    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text").where(F.col("id").isNotNull()).withColumn("slot", slot)
    return arrow_map(texts, run, "id long, h1 long, set binary, t array<long>").join(ids, ["id", "h1"], "left_semi")


def bits_differ() -> Column:
    """Differing signature bits of a pair (s of ua and ub)."""
    return sum(F.bit_count(F.get(F.col("sa"), F.lit(i)).bitwiseXOR(F.get(F.col("sb"), F.lit(i)))) for i in range(4))


def _sizes(percent: int) -> Column:
    return 100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")


def _plausible(percent: int) -> Column:
    """Sizes allow the similarity, and the bits do not rule it out by 4.8 standard deviations."""
    j = percent / 100
    differ = 256 * (1 - j) / 2
    most = differ + 4.8 * np.sqrt(2 * 128 * j * (1 - j) / 2)
    return _sizes(percent) & (bits_differ() <= int(most))


def _long_plausible(percent: int) -> Column:
    """The long signatures (ta, tb) do not rule out the similarity by 4.8 standard deviations."""
    p = (1 - percent / 100) / 2
    # as a loop over the arrays: 64 terms would make a large plan
    differ = F.aggregate(F.zip_with("ta", "tb", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    return differ <= int(LONG_BITS * p + 4.8 * np.sqrt(LONG_BITS * p * (1 - p)))


_SIDE = ("rep", "h1", "n", "keys", "t", "comp")
_PAIR = "ua long, ha long, ub long, hb long"


def _within_small(open_: DataFrame, percent: int) -> DataFrame:
    """Plausible pairs of different components in small buckets, at most one of a pair in the largest component; by a join."""
    side = lambda x: [F.col(c).alias(f"{v}{x}") for c, v in zip(_SIDE, "uhnktc", strict=True)]
    a = open_.where(F.col("comp") != F.col("top")).select("bucket", *side("a"))
    b = open_.select("bucket", *side("b"), "top")
    once = (F.col("cb") == F.col("top")) | (F.col("ua") < F.col("ub"))
    # a pair of many buckets comes out once: of the one with the least key (32 bits of each key are compared)
    first_shared = F.array_min(F.zip_with("ka", "kb", lambda x, y: F.when(x == y, x))) == (a["bucket"].bitwiseAND(F.lit(0xFFFFFFFF)) - F.lit(1 << 31)).cast("int")
    return a.join(b, (a["bucket"] == b["bucket"]) & (F.col("ca") != F.col("cb")) & once & _sizes(percent) & _long_plausible(percent) & first_shared).select("ua", "ha", "ub", "hb")


def _within_large(open_: DataFrame, percent: int) -> DataFrame:
    """The same in large buckets. Members are packed into blocks of about SPLIT, a row each; every pair of a bucket's blocks is a task that compares bit matrices.

    So the rows made are the members, once, and the pairs of blocks.
    """
    n = F.ceil(F.col("k") / F.least(F.lit(SPLIT), F.greatest(F.lit(LEAST_SPLIT), F.ceil(F.col("k") / 16)))).cast("int")
    members = open_.select("bucket", n.alias("blocks"), F.pmod(F.xxhash64("rep"), n).cast("int").alias("block"), *_SIDE, "top")
    longs, arrays = ("rep", "h1", "n", "comp"), {"keys": np.int32, "t": np.uint64}
    fields = [("bucket", pa.int64()), ("blocks", pa.int32()), ("block", pa.int32()), ("top", pa.int64()), *[(c, pa.binary()) for c in (*longs, *arrays)]]
    packed_schema = pa.schema(fields)

    def pack(t: pa.Table) -> pa.Table:
        one = {c: [t[c][0].as_py()] for c in ("bucket", "blocks", "block", "top")}
        one |= {c: [t[c].to_numpy().tobytes()] for c in longs}
        one |= {c: [np.concatenate([x.flatten().to_numpy(zero_copy_only=False) for x in t[c].chunks]).tobytes()] for c in arrays}
        return pa.table(one, packed_schema)

    packed = members.groupBy("bucket", "block").applyInArrow(pack, "bucket long, blocks int, block int, top long, rep binary, h1 binary, n binary, comp binary, keys binary, t binary")
    packed = materialize(packed, "blocks")
    data = [*longs, *arrays]
    a = packed.select("bucket", F.col("block").alias("pa"), F.explode(F.sequence("block", F.col("blocks") - 1)).alias("pb"), "top", *data)
    b = packed.select("bucket", F.explode(F.sequence(F.lit(0), F.col("block"))).alias("pa"), F.col("block").alias("pb"), *data)
    p = (1 - percent / 100) / 2
    most = int(LONG_BITS * p + 4.8 * np.sqrt(LONG_BITS * p * (1 - p)))
    schema = pa.schema([(c.split()[0], pa.int64()) for c in _PAIR.split(", ")])

    def unpack(t: pa.Table) -> dict[str, np.ndarray]:
        get = lambda c, kind: np.frombuffer(t[c][0].as_py(), kind)
        out = {c: get(c, np.int64) for c in longs}
        return out | {c: get(c, kind).reshape(len(out["rep"]), -1) for c, kind in arrays.items()}

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        x, y = unpack(left), unpack(right)
        same, top = left["pa"][0].as_py() == left["pb"][0].as_py(), left["top"][0].as_py()
        bucket = (int(left["bucket"][0].as_py()) & 0xFFFFFFFF) - (1 << 31)
        out = [np.zeros((0, 4), np.int64)]
        for i in range(0, len(x["rep"]), 8):
            u = {c: x[c][i : i + 8, None] for c in longs}
            differ = np.bitwise_count(x["t"][i : i + 8, None, :] ^ y["t"][None, :, :]).sum(axis=2, dtype=np.int32)
            good = (differ <= most) & (u["comp"] != y["comp"]) & (100 * np.minimum(u["n"], y["n"]) >= percent * np.maximum(u["n"], y["n"]))
            j, k = np.nonzero(good)
            j = j + i
            if same:  # each pair of a block once
                j, k = j[j < k], k[j < k]
            # a pair of many buckets comes out once: of the one with the least key
            keep = np.where(x["keys"][j] == y["keys"][k], x["keys"][j].astype(np.int64), 1 << 31).min(axis=1, initial=1 << 31) == bucket
            j, k = j[keep], k[keep]
            ends = [np.column_stack([z["rep"][m], z["h1"][m]]) for z, m in ((x, j), (y, k))]
            # a member of the largest component is the second, of two others the larger
            swap = (x["comp"][j] == top) | ((y["comp"][k] != top) & (x["rep"][j] > y["rep"][k]))
            out.append(np.where(swap[:, None], np.hstack(ends[::-1]), np.hstack(ends)))
        return pa.Table.from_arrays([pa.array(c) for c in np.concatenate(out).T.copy()], schema=schema)

    key = ["bucket", "pa", "pb"]
    return a.groupBy(*key).cogroup(b.groupBy(*key)).applyInArrow(run, _PAIR)


def _by_bucket(rows: DataFrame, few: DataFrame, members: str = "members") -> DataFrame:
    """``rows`` (bucket, rep, ...) joined with ``few`` (bucket, members, ...), one row a bucket, which is repeated for each SALT_ROWS of a bucket's members."""
    parts = F.ceil(F.col(members) / SALT_ROWS).cast("int")
    spread = few.withColumn("__salt", F.explode(F.sequence(F.lit(0), parts - 1))).drop(members)
    return rows.withColumn("__salt", F.pmod(F.xxhash64("rep"), parts).cast("int")).join(spread, ["bucket", "__salt"]).drop("__salt")


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (ua, ha, ub, hb) whose full sets are similar enough, as (u, v)."""

    def run(batches):
        for rb in batches:
            keep = []
            for x, y in zip(rb["a"], rb["b"], strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            keep = pa.array(keep, pa.bool_())
            yield batch(u=rb["ua"].filter(keep), v=rb["ub"].filter(keep))

    # the pairs of a first member with many of them are spread, its set going to each part
    many = pairs.groupBy("ua", "ha").agg(F.ceil(F.count("*") / CONFIRM_ROWS).cast("int").alias("parts")).where(F.col("parts") > 1)
    many = materialize(many, "many")
    many = F.broadcast(many) if many.count() <= 100_000 else many
    pairs = pairs.join(many, ["ua", "ha"], "left").withColumn("part", F.pmod(F.xxhash64("ub"), F.coalesce("parts", F.lit(1))).cast("int")).drop("parts")
    # the second of a pair is the rarer one: its set is joined first, and only sets of first members go to the other side
    firsts = pairs.select(F.col("ua").alias("id"), F.col("ha").alias("h1")).distinct()
    seconds = pairs.select(F.col("ub").alias("id"), F.col("hb").alias("h1")).distinct()
    left = sets.join(firsts, ["id", "h1"], "left_semi").select(F.col("id").alias("ua"), F.col("h1").alias("ha"), F.col("set").alias("a")).dropDuplicates(["ua", "ha"])
    right = sets.join(seconds, ["id", "h1"], "left_semi").select(F.col("id").alias("ub"), F.col("h1").alias("hb"), F.col("set").alias("b")).dropDuplicates(["ub", "hb"])
    left = left.join(many, ["ua", "ha"], "left").withColumn("part", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))).drop("parts")
    both = pairs.join(right, ["ub", "hb"]).join(left, ["ua", "ha", "part"]).select("ua", "ub", "a", "b")
    return materialize(arrow_map(both, run, "u long, v long", 500), "links")


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of ``docs``."""
    rows = materialize(sketches(docs), "sketches")
    filled = rows.where((F.col("n") > 0) & F.col("id").isNotNull())
    key = ["n", "h1", "h2"]
    classes = materialize(filled.groupBy(*key).agg(F.min("id").alias("rep")), "classes")
    # the sketch of a class is that of its representative; an id with several texts may stand for several classes
    reps = materialize(classes.join(filled.withColumnRenamed("id", "rep"), ["rep", *key]).select("rep", "h1", "n", "s", "bands"), "reps")
    banded = reps.select("rep", F.explode("bands").alias("bucket"))
    full = banded.groupBy("bucket").agg(F.count("*").alias("members")).where(F.col("members") > 1)
    member = materialize(banded.join(full, "bucket").select("bucket", "rep", "members"), "buckets")
    light = reps.select("rep", "h1", "n", "s")
    end = lambda x: light.select(F.col("rep").alias(f"u{x}"), F.col("h1").alias(f"h{x}"), F.col("n").alias(f"n{x}"), F.col("s").alias(f"s{x}"))
    pair = ["ua", "ha", "ub", "hb"]

    # a bucket's leader is its member with the most bucket mates overall: of a group of copies, the one that is most alike to the others
    degree = member.groupBy("rep").agg(F.sum("members").alias("degree"))
    best = F.max(F.struct("degree", (-F.col("rep")).alias("minus"))).alias("top")
    leader = member.join(degree, "rep").groupBy("bucket").agg(F.max("members").alias("members"), best)
    led = _by_bucket(member, leader).select((-F.col("top.minus")).alias("ua"), F.col("rep").alias("ub"), F.col("top.degree").alias("degree")).where(F.col("ua") != F.col("ub")).distinct()
    may = led.join(end("a"), "ua").join(end("b"), "ub").where(_plausible(percent))
    best = may.groupBy("ub", "hb").agg(F.max(F.struct("degree", (-F.col("ua")).alias("minus"), "ha")).alias("top"))
    first = materialize(best.select((-F.col("top.minus")).alias("ua"), F.col("top.ha").alias("ha"), "ub", "hb"), "pairs")
    ids = first.select(F.col("ua").alias("id"), F.col("ha").alias("h1")).unionByName(first.select(F.col("ub").alias("id"), F.col("hb").alias("h1"))).distinct()
    ids = materialize(ids, "ids")
    sets = materialize(_sets(docs, ids), "sets")
    links = confirm(first, sets, percent)
    drop_materialized(sets)
    release(docs.sparkSession)
    # an id with several texts links their classes
    several = filled.select("id", *key).distinct().join(classes, key).groupBy("id").agg(F.count("*").alias("k"), F.collect_set("rep").alias("reps")).where(F.col("k") > 1)
    links = links.unionByName(several.select(F.col("id").alias("u"), F.explode("reps").alias("v")))
    label = materialize(components(links), "labels")
    release(docs.sparkSession)

    # members of a bucket outside its largest component, against all other components
    placed = member.join(label, F.col("rep") == F.col("vertex"), "left").select("bucket", "rep", "members", F.coalesce("component", "rep").alias("comp"))
    split = placed.groupBy("bucket").agg(F.max("members").alias("members"), F.min("comp").alias("low"), F.max("comp").alias("high")).where(F.col("low") != F.col("high"))
    mixed = materialize(_by_bucket(placed, split.select("bucket", "members")).distinct(), "mixed")
    top = mixed.groupBy("bucket", "comp").agg(F.max("members").alias("members"), F.count("*").alias("k")).groupBy("bucket").agg(F.max("members").alias("members"), F.max(F.struct("k", "comp")).alias("top"), F.sum("k").alias("k"))
    ids = materialize(mixed.join(light, "rep").select(F.col("rep").alias("id"), "h1").distinct(), "ids")
    sets = materialize(_sets(docs, ids, True), "sets")
    keys = F.transform("bands", lambda x: x.bitwiseAND(F.lit(0xFFFFFFFF)) - F.lit(1 << 31)).cast("array<int>")
    known = reps.select("rep", "h1", "n", keys.alias("keys")).join(sets.select(F.col("id").alias("rep"), "h1", "t"), ["rep", "h1"]).dropDuplicates(["rep", "h1"])
    open_ = _by_bucket(mixed, top.select("bucket", "members", F.col("top.comp").alias("top"), "k")).join(known, "rep")
    open_ = materialize(open_.select("bucket", "k", "rep", "h1", "n", "keys", "t", "comp", "top"), "open")
    rest = _within_small(open_.where(F.col("k") <= SMALL), percent).unionByName(_within_large(open_.where(F.col("k") > SMALL), percent)).distinct()
    swapped = first.select(F.col("ub").alias("ua"), F.col("hb").alias("ha"), F.col("ua").alias("ub"), F.col("ha").alias("hb"))
    rest = materialize(rest.join(first.unionByName(swapped), pair, "left_anti"), "pairs")
    more = confirm(rest, sets, percent)
    drop_materialized(sets)
    release(docs.sparkSession)
    if not more.isEmpty():
        old = label.select(F.col("vertex").alias("u"), F.col("component").alias("v"))
        label = materialize(components(old.unionByName(more)), "labels")
    for t in (member, mixed, open_, first, rest, reps):
        drop_materialized(t)

    out = rows.join(classes, key, "left").join(label, F.col("rep") == F.col("vertex"), "left")
    comp = F.when(F.col("n") == 0, F.col("id")).otherwise(F.coalesce("component", "rep"))
    comp = F.when(F.col("id").isNotNull(), comp)
    return out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), comp.alias("component_id"), F.coalesce(F.col("id") == comp, F.lit(True)).alias("kept"))


def deduplicate(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one document of each group of near duplicates, all columns kept."""
    verdict = near_duplicates(docs, percent)
    gone = verdict.where(~F.col("kept")).select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone, docs["doc_id"].cast("long") == F.col("__gone"), "left_anti")
