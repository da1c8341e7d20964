"""Hashed maximum-entropy language model with a class-factored softmax.

p(word | history) = p(class | history) * p(slot | class, history) * p(word | class, slot).  A word's class is that of its ending (hashed); the commonest
words and the end of the text have classes of their own.  In a class, its SLOTS - 1 most frequent words have a slot each, and slot 0 holds all others.  Both
softmaxes are maximum-entropy models over hashed features of
the history: the word before (bigram), the word before that (skip), and for the class also the pair of their classes (trigram); the features of the
slots are crossed with the class.  Among the words of slot 0, of which there may be any number, a word has its smoothed relative frequency from exact counts.

Training is by distributed gradient updates: the training texts are dealt by hash to shards of about SHARD_TOKENS tokens, whatever the number of cores and the size of the
corpus.  Adaptive gradient steps run over each shard, in the order of the texts' hashes, in sparse numpy batches; the
tables' rows are then averaged in a tree, weighted by the tokens that touched them. A task has one shard, or several, one after the other, where there are over PARTITIONS.
Counts come from one distributed aggregation.  Words of at least a count that at most FREQUENT words
reach are looked up in the worker; the other words of a text are joined with the count table, which may be of any size.

Tokens are words of the text with A-Z lower-cased, then one end token.  Defined results: null text is empty (the end token
alone); rows without an id are trained on; repeated rows count each; of words with one count the one with the smaller hash comes first; very long texts are
read whole; an empty table gives an empty result; without training rows all probabilities are those of empty counts.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.llm import textbatch as tb
from factloom.llm.common import arrow_map, batch, fold
from factloom.storage import drop_materialized, materialize

#: Words that workers look up themselves, at most.
FREQUENT = 1 << 18
CLASSES, TOP = 32, 8  # class 0: end of text; 1 to TOP: the commonest words; the rest by ending
SLOTS = 32  # of a class by ending: 0 for all words that have none of their own
BUCKETS = 1 << 13  # of the bigram features of the class, and of its skip features
WORD_BUCKETS = 1 << 15  # of the bigram and class features of the slot, and of its skip and class features
STEP, STEP_TOKENS = 0.25, 1 << 15
SHARD_TOKENS, PARTITIONS = 1 << 22, 1 << 16
_BLOCK_ROWS, _FAN_IN, _NEVER = 2048, 32, -40.0
_END = np.uint64(0x243F6A8885A308D3)
_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True


def tokens(s: tb.Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, ending class and row of each token of a slice, ends included, in order."""
    low = s.lower()
    w = tb.words(low)
    end = w.end.copy()
    for _ in range(3):  # an ending is the last two bytes before at most three signs
        sign = (end - w.start > 1) & _PUNCTUATION[low.data[np.maximum(end - 1, 0)]] if len(w) else np.zeros(0, bool)
        end = end - sign
    last = low.data[end - 1].astype(np.uint64) if len(w) else np.zeros(0, np.uint64)
    other = np.where(end - w.start > 1, low.data[np.maximum(end - 2, 0)], 0).astype(np.uint64) if len(w) else last
    cls = (tb.mix(last * np.uint64(257) + other) % np.uint64(CLASSES - 1 - TOP)).astype(np.int64) + 1 + TOP
    # ends go after the words of their row
    at = w.bounds[1:]
    return np.insert(w.hash, at, _END), np.insert(cls, at, 0), np.insert(w.row, at, np.arange(s.rows))


def _training() -> Column:
    return F.coalesce(fold() != 1, F.lit(True))


def word_counts(docs: DataFrame) -> DataFrame:
    """(w, cls, n): hash, ending class and count of every token of all training texts. A task keeps a bounded number of sums and passes the rest on."""

    def run(batches):
        held: list[np.ndarray] = []
        size = 0

        def out():
            h, c, n = (np.concatenate([x[k] for x in held]) for k in range(3))
            u, first, inverse = np.unique(h, return_index=True, return_inverse=True)
            return u, c[first], np.bincount(inverse, weights=n).astype(np.int64)

        for b in batches:
            for s in tb.slices(b["text"]):
                h, c, _ = tokens(s)
                u, first, n = np.unique(h, return_index=True, return_counts=True)
                held.append((u, c[first], n))
                size += len(u)
            if size > 600_000:
                held = [out()]
                size = len(held[0][0])
                if size > 400_000:
                    u, c, n = held[0]
                    yield batch(w=pa.array(tb.signed(u)), cls=pa.array(c.astype(np.int32)), n=pa.array(n))
                    held, size = [], 0
        if held:
            u, c, n = out()
            yield batch(w=pa.array(tb.signed(u)), cls=pa.array(c.astype(np.int32)), n=pa.array(n))

    return arrow_map(docs.where(_training()).select("text"), run, "w long, cls int, n long").groupBy("w", "cls").agg(F.sum("n").alias("n"))


@dataclass
class Model:
    words: np.ndarray  # frequent words, sorted
    counts: np.ndarray
    classes: np.ndarray
    slots: np.ndarray
    total: int  # N
    distinct: int  # V
    other_total: np.ndarray  # by class, of the words of slot 0
    other_distinct: np.ndarray
    by_class: np.ndarray  # rows of CLASSES weights: pairs of classes before, hashed words before, hashed words before those
    by_slot: np.ndarray  # rows of SLOTS weights: one a class, hashed (word before, class), hashed (word before that, class)

    def __post_init__(self):
        self.sieve = np.zeros(1 << 22, bool)
        self.sieve[self.words >> np.uint64(42)] = True

    def place(self, h: np.ndarray) -> np.ndarray:
        """Index of each frequent word, -1 for others."""
        maybe = np.flatnonzero(self.sieve[h >> np.uint64(42)])
        out = np.full(len(h), -1, np.int64)
        if len(self.words) and len(maybe):
            at = np.minimum(np.searchsorted(self.words, h[maybe]), len(self.words) - 1)
            out[maybe] = np.where(self.words[at] == h[maybe], at, -1)
        return out

    def encode(self, h: np.ndarray, cls: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place, class and slot of each token."""
        at = self.place(h)
        if not len(self.words):
            return at, cls, np.zeros(len(h), np.int64)
        return at, np.where(at >= 0, self.classes[at], cls), np.where(at >= 0, self.slots[at], 0)


def history(h: np.ndarray, cls: np.ndarray, row: np.ndarray) -> tuple[tuple[np.ndarray, ...], tuple[np.ndarray, ...]]:
    """Feature rows of each token in by_class and in by_slot. Before a text stands its end token."""

    def back(v, k, fill):
        out = np.full(len(v), fill, v.dtype)
        out[k:] = np.where(row[k:] == row[:-k], v[:-k], fill) if len(v) > k else fill
        return out

    h1, h2, c1, c2 = back(h, 1, _END), back(h, 2, _END), back(cls, 1, 0), back(cls, 2, 0)
    cut = np.uint64(64 - 13)
    first = CLASSES * CLASSES
    of_class = c2 * CLASSES + c1, first + (h1 >> cut).astype(np.int64), first + BUCKETS + ((h2 * np.uint64(0x9E3779B97F4A7C15)) >> cut).astype(np.int64)
    crossed = cls.astype(np.uint64) * np.uint64(0x632BE59BD9B4E019)
    cut = np.uint64(64 - 15)
    near = ((h1 ^ crossed) * np.uint64(0xD1342543DE82EF95) >> cut).astype(np.int64)
    skip = ((h2 ^ crossed) * np.uint64(0x9E6C63D0676A9A99) >> cut).astype(np.int64)
    return of_class, (cls, CLASSES + near, CLASSES + WORD_BUCKETS + skip)


def _sums(table: np.ndarray, keys: tuple[np.ndarray, ...]) -> np.ndarray:
    """Sums of the rows of weights of each token, less their largest."""
    z = table[keys[0]]
    for k in keys[1:]:
        z += table[k]
    z -= z.max(axis=1, keepdims=True)
    return z


def log_softmax(table: np.ndarray, keys: tuple[np.ndarray, ...]) -> np.ndarray:
    """Natural log-probabilities of a row of choices for each token."""
    z = _sums(table, keys)
    return z - np.log(np.exp(z).sum(axis=1, keepdims=True))


def softmax(table: np.ndarray, keys: tuple[np.ndarray, ...]) -> np.ndarray:
    """Probabilities of a row of choices for each token."""
    z = _sums(table, keys)
    np.exp(z, out=z)
    z /= z.sum(axis=1, keepdims=True)
    return z


def _run_sums(g: np.ndarray, first: np.ndarray, n: np.ndarray, most: int = 6) -> np.ndarray:
    """Sums of the runs of ``n`` rows that begin at ``first``; with many short runs, these go place by place, which is faster than run by run."""
    if 8 * len(first) < len(g):
        return np.add.reduceat(g, first, axis=0)
    out, short = g[first], n <= most
    for k in range(1, most):
        at = np.flatnonzero(short & (n > k))
        out[at] += g[first[at] + k]
    if not short.all():
        size = n[~short]
        out[~short] = np.add.reduceat(g[np.repeat(~short, n)], np.cumsum(size) - size, axis=0)
    return out


def _by_key(key: np.ndarray, g: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, their gradient sums and counts."""
    low = key.min()
    order = np.argsort((key - low).astype(np.uint16), kind="stable")  # 16 bits sort by radix
    k = key[order]
    first = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
    n = np.diff(np.r_[first, len(k)])
    return k[first], _run_sums(g[order], first, n), n


class Descent:
    """Adaptive gradient steps on one table of weights."""

    def __init__(self, table: np.ndarray):
        self.table = table.astype(np.float32)
        self.squares, self.seen = np.ones(len(table), np.float32), np.zeros(len(table), np.float32)

    def step(self, keys: tuple[np.ndarray, ...], target: np.ndarray) -> None:
        z = softmax(self.table, keys)
        z[np.arange(len(z)), target] -= 1
        for k in keys:
            rows, g, n = _by_key(k, z)
            g /= np.sqrt(n)[:, None].astype(np.float32)  # as a step of the batch's mean, grown with the evidence
            self.squares[rows] += np.square(g).mean(axis=1)
            self.table[rows] -= STEP * g / np.sqrt(self.squares[rows])[:, None]
            self.seen[rows] += n


def fit(docs: DataFrame) -> tuple[Model, DataFrame]:
    """The model, and the table of all counts."""
    counts = materialize(word_counts(docs), "counts")
    sizes = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    # the least count that at most FREQUENT words reach, from a histogram of counts in steps of an eighth
    step = F.floor(F.log2(F.col("n").cast("double")) * 8).cast("int")
    left, cut = FREQUENT, None
    for r in counts.groupBy(step.alias("step")).agg(F.count("*").alias("k")).orderBy(F.desc("step")).collect():
        left -= r["k"]
        if left < 0:
            break
        cut = r["step"]
    found = counts.where(F.lit(False) if cut is None else step >= cut).toPandas().sort_values(["n", "w"], ascending=[False, True])
    words, n, cls = (found[c].to_numpy(dtype=np.int64) for c in ("w", "n", "cls"))
    class_total, other_total, other_distinct = (np.zeros(CLASSES) for _ in range(3))
    for r in counts.groupBy("cls").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect():
        class_total[r["cls"]], other_distinct[r["cls"]] = r["n"], r["v"]
    other_total[:] = class_total
    prior = np.zeros((CLASSES, SLOTS))
    slots, used = np.zeros(len(words), np.int64), np.zeros(CLASSES, np.int64)
    own = {i: k for k, i in enumerate([i for i in range(min(len(words), TOP + 1)) if cls[i] != 0][:TOP], 1)}
    for i in range(len(words)):
        was = cls[i]
        if was == 0:  # the end
            continue
        if i in own:  # the commonest words leave their ending's class
            cls[i] = own[i]
            class_total[was] -= n[i]
            class_total[cls[i]] = n[i]
        elif used[was] < SLOTS - 1:
            used[was] += 1
            slots[i] = used[was]
            prior[was, slots[i]] = n[i]
        else:
            if (used[TOP + 1 :] == SLOTS - 1).all():
                break
            continue
        other_total[was] -= n[i]
        other_distinct[was] -= 1
    other_total[: TOP + 1], other_distinct[: TOP + 1] = 0, 0
    prior[:, 0] = other_total
    start = np.log((class_total + 0.5) / (class_total.sum() + 0.5 * CLASSES))
    of_slot = np.log((prior + 0.5) / (prior.sum(axis=1, keepdims=True) + 0.5 * SLOTS))
    of_slot[np.arange(SLOTS) > used[:, None]] = _NEVER  # no word has these
    start[1 : TOP + 1][np.arange(TOP) >= len(own)] = _NEVER
    order = np.argsort(words.view(np.uint64))
    model = Model(
        words.view(np.uint64)[order], n[order], cls[order], slots[order], sizes["n"] or 0, sizes["v"], other_total, other_distinct,
        np.concatenate([np.tile(start, (CLASSES * CLASSES, 1)), np.zeros((2 * BUCKETS, CLASSES))]).astype(np.float32),
        np.concatenate([of_slot, np.zeros((2 * WORD_BUCKETS, SLOTS))]).astype(np.float32),
    )
    if model.total:
        _train(docs, model)
    return model, counts


def descend(model: Model, slices) -> tuple[Descent, Descent]:
    """The steps of one shard over its slices of text."""
    classes, slots = Descent(model.by_class), Descent(model.by_slot)
    for s in slices:
        h, cls, row = tokens(s)
        _, cls, slot = model.encode(h, cls)
        of_class, of_slot = history(h, cls, row)
        for i in range(0, len(h), STEP_TOKENS):
            j = np.arange(i, min(i + STEP_TOKENS, len(h)))
            classes.step(tuple(k[j] for k in of_class), cls[j])
            j = j[cls[j] > TOP]
            if len(j):
                slots.step(tuple(k[j] for k in of_slot), slot[j])
    return classes, slots


_ROWS = "part int, block int, node long, rows binary, seen binary, v binary"


def _average(parts: list[tuple[bytes, bytes, bytes]], width: int) -> tuple[bytes, bytes, bytes]:
    """Rows, weights and weighted means of several sets of table rows."""
    rows = np.concatenate([np.frombuffer(p[0], np.int32) for p in parts])
    seen = np.concatenate([np.frombuffer(p[1], np.float64) for p in parts])
    v = np.concatenate([np.frombuffer(p[2], np.float32).reshape(-1, width) for p in parts])
    order = np.argsort(rows, kind="stable")
    rows, seen, v = rows[order], seen[order], v[order]
    first = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
    total = np.add.reduceat(seen, first)
    mean = np.add.reduceat(v * seen[:, None], first, axis=0) / total[:, None]
    return rows[first].tobytes(), total.tobytes(), mean.astype(np.float32).tobytes()


def _train(docs: DataFrame, model: Model) -> None:
    """A pass of all training tokens: each shard's adaptive gradient steps, averaged by table row in a tree."""
    ship = docs.sparkSession.sparkContext.broadcast(model)  # fixed size
    shards = math.ceil(model.total / SHARD_TOKENS)

    def rows_of(node: int, part: int, d: Descent):
        for block in range(0, len(d.table), _BLOCK_ROWS):
            rows = block + np.flatnonzero(d.seen[block : block + _BLOCK_ROWS])
            if len(rows):
                yield part, block, node, rows.astype(np.int32).tobytes(), d.seen[rows].astype(np.float64).tobytes(), d.table[rows].tobytes()

    def out(found: list) -> pa.RecordBatch:
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
        return batch(**{c.split()[0]: pa.array([r[k] for r in found], kinds[k]) for k, c in enumerate(_ROWS.split(", "))})

    def run(batches):
        def of(node):  # the slices of one shard
            while held[0] is not None and held[0][0] == node:
                yield held[0][1]
                held[0] = next(stream, None)

        def all_slices():
            for b in batches:
                shard = b["shard"].to_numpy()
                edges = np.r_[0, np.flatnonzero(np.diff(shard)) + 1, len(shard)]
                for i, j in zip(edges[:-1], edges[1:], strict=True):
                    if j > i:
                        for s in tb.slices(b["text"].slice(i, j - i)):
                            yield int(shard[i]), s

        stream = all_slices()
        held = [next(stream, None)]
        while held[0] is not None:
            node = held[0][0]
            for part, d in enumerate(descend(ship.value, of(node))):
                found = list(rows_of(node, part, d))
                for i in range(0, len(found), 16):
                    yield out(found[i : i + 16])

    def merge(t: pa.Table) -> pa.Table:
        t = t.sort_by("node")
        part, block = t["part"][0].as_py(), t["block"][0].as_py()
        rows, seen, v = _average(list(zip(*(t[c].to_pylist() for c in ("rows", "seen", "v")), strict=True)), SLOTS if part else CLASSES)
        return pa.Table.from_batches([out([(part, block, t["node"][0].as_py() // _FAN_IN, rows, seen, v)])])

    key = F.xxhash64("doc_id", "text")
    texts = docs.where(_training()).select(F.pmod(key, F.lit(shards)).cast("int").alias("shard"), key.alias("key"), F.col("text"))
    parts = min(shards, PARTITIONS)
    dealt = texts.withColumn("part", F.col("shard") % parts).repartitionById(parts, "part").sortWithinPartitions("shard", "key").select("shard", "text")
    found = materialize(arrow_map(dealt, run, _ROWS), "steps")
    while True:
        merged = found.withColumn("up", F.floor(F.col("node") / _FAN_IN)).groupBy("part", "block", "up").applyInArrow(lambda k, t: merge(t.drop(["up"])), _ROWS)
        shards = math.ceil(shards / _FAN_IN)
        if shards <= 1:
            break
        found = materialize(merged, "steps")
    for r in merged.toLocalIterator():  # fixed size: the tables
        table = model.by_slot if r["part"] else model.by_class
        table[np.frombuffer(r["rows"], np.int32)] = np.frombuffer(r["v"], np.float32).reshape(-1, table.shape[1])


def log_probabilities(m: Model, h: np.ndarray, cls: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place of each token, whether its count matters, and the log10 of its class and slot, less that of its class's other words where the count matters."""
    at, cls, slot = m.encode(h, cls)
    of_class, of_slot = history(h, cls, row)
    chosen = np.empty(len(h))
    for i in range(0, len(h), STEP_TOKENS):
        j = np.arange(i, min(i + STEP_TOKENS, len(h)))
        chosen[j] = log_softmax(m.by_class, tuple(k[j] for k in of_class))[np.arange(len(j)), cls[j]]
        j = j[cls[j] > TOP]
        if len(j):
            chosen[j] += log_softmax(m.by_slot, tuple(k[j] for k in of_slot))[np.arange(len(j)), slot[j]]
    other = (cls > TOP) & (slot == 0)
    return at, other, chosen / np.log(10) - np.where(other, np.log10(m.other_total + 0.5 * (m.other_distinct + 1))[cls], 0.0)


def score(docs: DataFrame, model: Model, counts: DataFrame) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score and score (log10) of every row."""
    ship = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m, rng = ship.value, np.random.default_rng()
        denominator = np.log10(m.total + 0.5 * (m.distinct + 1))
        logs = np.log10(m.counts + 0.5) if len(m.counts) else np.zeros(1)
        for b in batches:
            for s in tb.slices(b["text"]):
                h, cls, row = tokens(s)
                at, other, chosen = log_probabilities(m, h, cls, row)
                often = at >= 0
                known = np.where(often, logs[at], 0.0)
                total = lambda v: np.bincount(row, weights=v, minlength=s.rows)  # noqa: E731, B023
                n = total(np.ones(len(h)))
                # the other words of each row, with their numbers
                rare = np.flatnonzero(~often)
                order = rare[np.lexsort((h[rare], row[rare]))]
                hr, rr = h[order], row[order]
                first = np.flatnonzero(np.r_[True, (hr[1:] != hr[:-1]) | (rr[1:] != rr[:-1])]) if len(order) else order
                times = np.diff(np.r_[first, len(order)]).astype(np.int32)
                bounds = np.searchsorted(rr[first], np.arange(s.rows + 1)).astype(np.int32)
                yield batch(
                    doc_id=b["doc_id"][s.first : s.first + s.rows],
                    uid=pa.array(rng.integers(0, 1 << 62, s.rows)),
                    n_tokens=pa.array(n.astype(np.int64)),
                    n_often=pa.array(total(often).astype(np.int64)),
                    base=pa.array(total(known) - n * denominator),
                    part=pa.array(total(chosen + np.where(other, known, 0.0))),
                    w=pa.ListArray.from_arrays(pa.array(bounds), pa.array(tb.signed(hr[first]))),
                    times=pa.ListArray.from_arrays(pa.array(bounds), pa.array(times)),
                )

    fields = "doc_id long, uid long, n_tokens long, n_often long, base double, part double, w array<long>, times array<int>"
    rows = materialize(arrow_map(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, fields), "scores")
    rare = rows.select("uid", F.explode(F.arrays_zip("w", "times")).alias("x")).select("uid", F.col("x.w").alias("w"), F.col("x.times").alias("times"))
    c = F.coalesce("n", F.lit(0))
    found = rare.join(counts.select("w", "n"), "w", "left").groupBy("uid").agg(F.sum(F.col("times") * F.log10(c + 0.5)).alias("logs"), F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("more"))
    out = rows.select("doc_id", "uid", "n_tokens", "n_often", "base", "part").join(found, "uid", "left")
    logs, more = F.coalesce("logs", F.lit(0.0)), F.coalesce("more", F.lit(0))
    return out.select("doc_id", "n_tokens", (F.col("n_often") + more).alias("n_known"), (F.col("base") + logs).alias("base_score"), (F.col("part") + logs).alias("score"))


def text_scores(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document."""
    model, counts = fit(docs)
    out = score(docs, model, counts)
    return out.select("doc_id", F.coalesce(fold() == 1, F.lit(False)).alias("held_out"), "n_tokens", "n_known", F.lit(model.total).cast("long").alias("train_tokens"), "base_score", "score")
