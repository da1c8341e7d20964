"""Benchmark decontamination by latent semantic retrieval.

Benchmark items and documents are sequences of words (runs of letters and digits, lower-cased).
1. One pass over all documents gives the document frequency of every benchmark word, and the benchmark words of every document window (windows of one length, one
   after the other).
2. TF-IDF passages (the items, and all windows) over the items' vocabulary are factorised by a randomised SVD: tasks sum the products of the words that
   passages share, A'A, as rows (pair, sum), and their shares of A'A Omega, with one power iteration; the leading right singular vectors are the latent space.
3. Every document is cut into overlapping windows, two lengths of an item's length class each with a stride of one length, so an item lies in one window
   whole.  Windows too poor in answer words to pass step 5 are not projected.  The others are projected and compared with
   all items of the class by cosine.
4. Candidates are confirmed by the longest common subsequence of words, as a share of the item's words.
5. The answer check: of the item's answer words (a given ``answer`` column, else its rarest words), at least half must be in the window.

Large benchmarks are cut into blocks of at most BLOCK_WORDS words, whose vectors are what is broadcast; WAVE blocks share a scan of the documents. (An item of more words is
a block of its own.)  The frequencies come from one pass, whatever the number of blocks.

Defined results: null or wordless items and documents match nothing; ids may be of any type, and null; repeated rows count each; items of the same words
all match; a very long text is searched whole; of several windows that match an item the best counts (largest share, then cosine);
without documents or items there are no leaks, and all documents are clean.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType, DoubleType, StructField, StructType

from factloom.llm import textbatch as tb
from factloom.llm.common import annotate, arrow_map, batch
from factloom.storage import materialize

COSINE, LCS, ANSWER_SHARE, ANSWER_WORDS = 0.15, 0.7, 0.5, 8
RANK, OVERSAMPLE, BLOCK_WORDS, WAVE, SEED = 128, 8, 1 << 16, 4, 29
#: Products of words that are made at a time, about, the largest table of sums of all pairs of a vocabulary, and, where pairs are more, how many are sorted at a time.
PAIRS, TABLE, HELD = 1 << 17, 1 << 23, 1 << 20
#: Sums that a task hands on at a time.
SUMS = 1 << 16
#: Words of a passage of the fit, at most; longer items are cut for it.
PASSAGE = 1024
_SHORTEST, _SIEVE = 16, 26
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def terms(s: tb.Slice) -> tb.Words:
    low = s.lower()
    data = low.data  # Latin-1 capitals too: C3 80 to C3 9E, but for the multiplication sign
    capital = np.flatnonzero(data[:-1] == 0xC3) + 1
    capital = capital[(data[capital] >= 0x80) & (data[capital] <= 0x9E) & (data[capital] != 0x97)]
    data[capital] += 0x20
    return tb.words(low, _WORD[data])


def lcs(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence, by bit-parallel rows."""
    at: dict[int, int] = {}
    for i, x in enumerate(a.tolist()):
        at[x] = at.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for x in b.tolist():
        u = v & at.get(x, 0)
        v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


@dataclass
class Block:
    """Items of a block and their vocabulary."""

    ids: list
    words: list[np.ndarray]
    answers: list[np.ndarray]  # hashes first, then indices into the vocabulary; distinct
    vocabulary: np.ndarray
    idf: np.ndarray | None = None
    basis: np.ndarray | None = None  # vocabulary x rank, idf included
    vectors: np.ndarray | None = None
    classes: np.ndarray | None = None  # length class of each item

    def index(self, h: np.ndarray) -> np.ndarray:
        """Vocabulary index of each word, -1 for others."""
        maybe = np.flatnonzero(self.sieve[h >> np.uint64(44)])
        at = np.searchsorted(self.vocabulary, h[maybe])
        at[at == len(self.vocabulary)] = 0
        out = np.full(len(h), -1, np.int64)
        out[maybe] = np.where(self.vocabulary[at] == h[maybe], at, -1)
        return out

    def __post_init__(self):
        self.sieve = np.zeros(1 << 20, bool)
        self.sieve[self.vocabulary >> np.uint64(44)] = True


def _items(benchmark: DataFrame) -> DataFrame:
    """(item_id, words, given): hashed words of each item that has any, and of its given answer."""
    answer = F.col("answer").cast("string") if "answer" in benchmark.columns else F.lit(None).cast("string")

    def hashes(column: pa.Array) -> list[bytes]:
        out = []
        for s in tb.slices(column):
            w = terms(s)
            out += [w.hash[i:j].tobytes() for i, j in zip(w.bounds[:-1], w.bounds[1:], strict=True)]
        return out

    rows = annotate(
        benchmark.select("item_id", "text", answer.alias("answer")),
        lambda b: {"words": pa.array(hashes(b["text"]), pa.binary()), "given": pa.array(hashes(b["answer"]), pa.binary())},
        "words binary, given binary", ["item_id", "answer"],
    )
    return materialize(rows.drop("answer").where(F.length("words") > 0), "items")


def _blocks(items: DataFrame, size: int) -> Iterator[Block]:
    """The items in order, in blocks of at most ``size`` words; the driver holds one block at a time."""
    ids, words, given, total = [], [], [], 0

    def made() -> Block:
        return Block(list(ids), list(words), list(given), np.unique(np.concatenate(words + given)))

    for r in items.orderBy("item_id", "words").toLocalIterator():
        w, a = np.frombuffer(r["words"], np.uint64), np.unique(np.frombuffer(r["given"], np.uint64))
        if ids and total + len(w) + len(a) > size:
            yield made()
            ids, words, given, total = [], [], [], 0
        ids.append(r["item_id"])
        words.append(w)
        given.append(a)
        total += len(w) + len(a)
    if ids:
        yield made()


def _sieve(items: DataFrame) -> np.ndarray:
    """A bitmap of the hashes of all items' words, some 64 bits a word and 8 MB at most: every task sets its own bits, the driver joins them."""
    n = items.agg(F.sum(F.length("words") + F.length("given")) / 8).first()[0]
    size = min(_SIEVE, max(16, math.ceil(math.log2(64 * n))))

    def bits(batches):
        at = np.zeros(1 << size, bool)
        for b in batches:
            for c in ("words", "given"):
                for x in b[c]:
                    at[np.frombuffer(x.as_buffer(), np.uint64) >> np.uint64(64 - size)] = True
        yield batch(bits=pa.array([np.packbits(at).tobytes()], pa.binary()))

    out = np.zeros(1 << (size - 3), np.uint8)
    for r in arrow_map(items.select("words", "given").coalesce(8), bits, "bits binary").toLocalIterator():
        out |= np.frombuffer(r["bits"], np.uint8)
    return out


def _binary(values: np.ndarray, n: np.ndarray) -> pa.Array:
    """Rows of ``n`` values each, as bytes."""
    ends = np.r_[0, np.cumsum(n)] * values.itemsize
    return pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(values.tobytes())])


def _corpus(docs: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """(w, n) document frequencies of the items' words, (words) the known words of every window that has any, and the number of documents; one pass over the documents."""
    n_docs = docs.count()
    length = min(PASSAGE, _length_class(items.agg(F.percentile_approx(F.length("words") / 8, 0.5)).first()[0]))
    ship = docs.sparkSession.sparkContext.broadcast(_sieve(items))  # 8 MB at most

    def run(batches):
        held, size, shift = [], 0, np.uint64(65 - len(ship.value).bit_length() - 3)

        def sums():
            w, n = (np.concatenate([x[k] for x in held]) if held else np.zeros(0, t) for k, t in ((0, np.uint64), (1, np.int64)))
            u, inverse = np.unique(w, return_inverse=True)
            return u, np.bincount(inverse, weights=n, minlength=len(u)).astype(np.int64)

        for b in batches:
            for s in tb.slices(b["text"]):
                w = terms(s)
                if not len(w):
                    continue
                at = (w.hash >> shift).astype(np.int64)
                known = (ship.value[at >> 3] >> (7 - (at & 7))) & 1 == 1
                h, row = w.hash[known], w.row[known]
                order = np.lexsort((h, row))
                h, row = h[order], row[order]
                once = np.r_[True, (h[1:] != h[:-1]) | (row[1:] != row[:-1])] if len(h) else known[:0]
                u, n = np.unique(h[once], return_counts=True)
                held.append((u, n))
                size += len(u)
                # windows of ``length`` words one after the other; the last of a text may be shorter
                place = np.arange(len(w)) - w.bounds[w.row]
                n = np.add.reduceat(known.astype(np.int64), np.flatnonzero(place % length == 0))
                yield batch(w=pa.nulls(np.count_nonzero(n), pa.int64()), n=pa.nulls(np.count_nonzero(n), pa.int64()), words=_binary(w.hash[known], n[n > 0]))
            if size > 500_000:
                held = [sums()]
                size = len(held[0][0])
        u, n = sums()
        yield batch(w=pa.array(tb.signed(u)), n=pa.array(n), words=pa.nulls(len(u), pa.binary()))

    found = materialize(arrow_map(docs.select("text"), run, "w long, n long, words binary"), "corpus")
    df = materialize(found.where(F.col("words").isNull()).groupBy("w").agg(F.sum("n").alias("n")), "df")
    return df, found.where(F.col("words").isNotNull()).select("words"), n_docs


def _length_class(n: int) -> int:
    return max(_SHORTEST, 1 << math.ceil(math.log2(n)))


def _products(row: np.ndarray, index: np.ndarray, idf: np.ndarray, starts: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(starts[i] + j, product) for every two words i <= j of each row's TF-IDF vector of length one, some PAIRS at a time; rows are in order. starts: i * size if None."""
    size = len(idf)
    starts = np.arange(size) * size if starts is None else starts
    key, n = np.unique(row * size + index, return_counts=True)
    row, k = key // size, key % size
    v = n * idf[k]
    v /= np.maximum(np.sqrt(np.bincount(row, weights=v * v)), 1e-12)[row]
    left = np.searchsorted(row, row, side="right") - np.arange(len(row))  # words from here to the end of the row
    ends = np.cumsum(left)
    cuts = np.unique(np.r_[0, np.searchsorted(ends, np.arange(PAIRS, (ends[-1] if len(ends) else 0) + PAIRS, PAIRS)), len(row)])
    for i, j in zip(cuts[:-1], cuts[1:], strict=True):
        m = left[i:j]
        a = np.repeat(np.arange(i, j), m)
        b = a + np.arange(len(a)) - np.repeat(np.cumsum(m) - m, m)
        yield starts[k[a]] + k[b], v[a] * v[b]


class _Sums:
    """Sums of products by pair of words, in bounded memory: one table of all pairs i <= j, or, where these are more than TABLE, the pairs met."""

    def __init__(self, idf: np.ndarray):
        self.idf, i = idf, np.arange(len(idf))
        self.starts = i * len(idf) - i * (i + 1) // 2  # of the pairs of word i, without those before (i, i)
        cells = len(idf) * (len(idf) + 1) // 2
        self.table = np.zeros(cells) if cells <= TABLE else None
        self.held: list[tuple[np.ndarray, np.ndarray]] = []
        self.many = 0

    def add(self, row: np.ndarray, index: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Adds the rows' products; gives the sums that are held no longer, SUMS at a time."""
        if self.table is not None:
            for key, value in _products(row, index, self.idf, self.starts):
                np.add.at(self.table, key, value)
            return
        for key, value in _products(row, index, self.idf):
            self.held.append((key, value))
            self.many += len(key)
            if self.many > HELD:
                self._merge()
                if self.many > HELD // 2:
                    yield from self.rest()

    def _merge(self) -> None:
        key = np.concatenate([x[0] for x in self.held])
        value = np.concatenate([x[1] for x in self.held])
        self.held = []
        order = np.argsort(key, kind="stable")
        key, value = key[order], value[order]
        first = np.flatnonzero(np.diff(key, prepend=-1))
        self.held, self.many = [(key[first], np.add.reduceat(value, first))], len(first)

    def rest(self) -> Iterator[pa.RecordBatch]:
        """(pair, value) of all sums, pair being i * size + j, SUMS at a time; none is held any more."""
        if self.table is not None:
            for at in range(0, len(self.table), SUMS):
                value = self.table[at : at + SUMS]
                t = np.flatnonzero(value)
                if len(t):
                    i = np.searchsorted(self.starts + np.arange(len(self.idf)), t + at, side="right") - 1
                    yield batch(pair=pa.array(i * len(self.idf) + t + at - self.starts[i]), value=pa.array(value[t]))
            self.table[:] = 0
            return
        if self.held:
            self._merge()
            ((key, value),) = self.held
            self.held, self.many = [], 0
            for at in range(0, len(key), SUMS):
                yield batch(pair=pa.array(key[at : at + SUMS]), value=pa.array(value[at : at + SUMS]))


def _fit(block: Block, df: DataFrame, windows: DataFrame, n_docs: int, rank: int) -> None:
    """The latent space of the block: randomised SVD of TF-IDF passages."""
    spark = df.sparkSession
    own_words = spark.createDataFrame(pa.table({"w": pa.array(tb.signed(block.vocabulary))}))  # at most BLOCK_WORDS
    counts = np.zeros(len(block.vocabulary))
    for r in df.join(own_words, "w").collect():
        counts[np.searchsorted(block.vocabulary, np.uint64(r["w"] & ((1 << 64) - 1)))] = r["n"]
    block.idf = np.log((n_docs + 1) / (counts + 1)) + 0.05
    block.classes = np.array([_length_class(len(w)) for w in block.words])
    own = [np.searchsorted(block.vocabulary, w) for w in block.words]
    for i, w in enumerate(own):
        if not len(block.answers[i]):
            k = np.unique(w)
            block.answers[i] = k[np.argsort(-block.idf[k], kind="stable")][:ANSWER_WORDS]
        else:
            block.answers[i] = np.searchsorted(block.vocabulary, block.answers[i])
    idf, ship = block.idf, spark.sparkContext.broadcast(block)

    def products(batches):
        sums = _Sums(idf)
        for b in batches:
            if not b.num_rows:
                continue
            ends = np.frombuffer(b["words"].buffers()[1], np.int32)[b["words"].offset :][: b.num_rows + 1] // 8
            x = ship.value.index(np.frombuffer(b["words"].buffers()[2], np.uint64)[ends[0] : ends[-1]]) if ends[-1] > ends[0] else np.zeros(0, np.int64)
            row = np.repeat(np.arange(b.num_rows), np.diff(ends))
            yield from sums.add(row[x >= 0], x[x >= 0])
        yield from sums.rest()

    items = spark.createDataFrame(pa.table({"words": pa.array([w[i : i + PASSAGE].tobytes() for w in block.words for i in range(0, len(w), PASSAGE)], pa.binary())}))
    shares = arrow_map(windows.unionByName(items), products, "pair long, value double")
    pairs = materialize(shares.groupBy("pair").agg(F.sum("value").alias("value")), "products").coalesce(8)
    size, r = len(idf), min(rank + OVERSAMPLE, len(idf))

    def gram_times(x: np.ndarray) -> np.ndarray:
        """A'A x, summed by partition."""
        sent = spark.sparkContext.broadcast(x)

        def run(batches):
            total = np.zeros((size, x.shape[1]))
            for b in batches:
                i, j = np.divmod(b["pair"].to_numpy(), size)
                v = b["value"].to_numpy()
                for to, of, share in ((i, j, v), (j[i != j], i[i != j], v[i != j])):
                    order = np.argsort(to, kind="stable")
                    first = np.flatnonzero(np.diff(to[order], prepend=-1))
                    if len(first):
                        total[to[order[first]]] += np.add.reduceat(share[order, None] * sent.value[of[order]], first)
            yield batch(y=pa.array([total.tobytes()], pa.binary()))

        total = sum(np.frombuffer(p["y"]).reshape(size, -1) for p in arrow_map(pairs, run, "y binary").toLocalIterator())
        sent.destroy()
        return total

    q = np.random.default_rng(SEED).normal(size=(size, r))
    for _ in range(2):
        q, _ = np.linalg.qr(gram_times(q))
    small = q.T @ gram_times(q)
    value, vector = np.linalg.eigh((small + small.T) / 2)
    space = q @ vector[:, np.argsort(-value)[:rank]]
    block.basis = (idf[:, None] * space).astype(np.float32)
    block.vectors = np.stack([block.basis[w].sum(axis=0) for w in own])
    block.vectors /= np.maximum(np.linalg.norm(block.vectors, axis=1, keepdims=True), 1e-12)


def _search(block: Block, s: tb.Slice, w: tb.Words, cosine: float, least: float, answer_share: float) -> list[tuple[int, int, float, float]]:
    """(row, number of the item, cosine, lcs share) of each confirmed match of a slice; the best window of a row and item."""
    index = block.index(w.hash)
    best: dict[tuple[int, int], tuple[float, float]] = {}
    for size in np.unique(block.classes):
        items = np.flatnonzero(block.classes == size)
        need = min(max(1, math.ceil(answer_share * len(block.answers[i]))) for i in items)
        rare = np.zeros(len(block.vocabulary) + 1, bool)
        rare[np.concatenate([block.answers[i] for i in items])] = True
        hits = np.r_[0, np.cumsum(rare[index])]  # index -1 is the last, False
        # windows of 2 * size words every size words, clipped to their row
        counts = w.counts()
        many = np.maximum(1, np.ceil(counts / size).astype(int) - 1) * (counts > 0)
        row = np.repeat(np.arange(s.rows), many)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
        start = w.bounds[row] + nth * size
        end = np.minimum(start + 2 * size, w.bounds[row + 1])
        good = hits[end] - hits[start] >= need
        for r, i, j in zip(row[good], start[good], end[good], strict=True):
            x = index[i:j]
            known = x[x >= 0]
            v = block.basis[known].sum(axis=0)
            cos = block.vectors[items] @ v / max(float(np.linalg.norm(v)), 1e-12)
            there = None
            for k in np.flatnonzero(cos >= cosine):
                item = items[k]
                if there is None:
                    there = set(known.tolist())
                answer = block.answers[item]
                if sum(a in there for a in answer.tolist()) < max(1, math.ceil(answer_share * len(answer))):
                    continue
                share = lcs(block.words[item], w.hash[i:j]) / len(block.words[item])
                if share >= least:
                    key = (int(r), int(item))
                    best[key] = max(best.get(key, (0.0, 0.0)), (share, float(cos[k])))
    return [(r, i, c, share) for (r, i), (share, c) in sorted(best.items())]


def _scan(docs: DataFrame, wave: list[Block], id_type: DataType, keep: list[str] | None, cosine: float, least: float, answer_share: float, only_clean: bool) -> DataFrame:
    """The matches of each row with the items of a few blocks, or the rows without any."""
    ships = [docs.sparkSession.sparkContext.broadcast(b) for b in wave]  # each of at most BLOCK_WORDS
    kind = pa.list_(pa.struct([("item_id", to_arrow_type(id_type)), ("cosine", pa.float64()), ("lcs", pa.float64())]))

    def run(b):
        found: list[list] = [[] for _ in range(b.num_rows)]
        for s in tb.slices(b["text"]):
            w = terms(s)
            for ship in ships:
                for r, i, c, share in _search(ship.value, s, w, cosine, least, answer_share):
                    found[s.first + r].append({"item_id": ship.value.ids[i], "cosine": c, "lcs": share})
        return {"where": np.array([not f for f in found], bool)} if only_clean else {"leaks": pa.array(found, kind)}

    return annotate(docs, run, "" if only_clean else f"leaks array<struct<item_id:{id_type.simpleString()},cosine:double,lcs:double>>", keep)


def _waves(docs: DataFrame, benchmark: DataFrame, rank: int, block_words: int) -> Iterator[list[Block]]:
    """Fitted blocks, up to WAVE at a time."""
    items = _items(benchmark)
    if items.isEmpty():
        return
    df, windows, n_docs = _corpus(docs, items)
    wave: list[Block] = []
    for block in _blocks(items, block_words):
        _fit(block, df, windows, n_docs, rank)
        wave.append(block)
        if len(wave) == WAVE:
            yield wave
            wave = []
    if wave:
        yield wave


def leaks(docs: DataFrame, benchmark: DataFrame, cosine: float = COSINE, least: float = LCS, answer_share: float = ANSWER_SHARE, rank: int = RANK, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, item_id, cosine, lcs): the documents that hold a benchmark item, whole or paraphrased, and the item."""
    id_type, out = benchmark.schema["item_id"].dataType, None
    for wave in _waves(docs, benchmark, rank, block_words):
        one = _scan(docs, wave, id_type, ["doc_id"], cosine, least, answer_share, False).select("doc_id", F.inline("leaks"))
        out = one if out is None else out.unionByName(one)
    if out is None:
        return docs.sparkSession.createDataFrame([], StructType([docs.schema["doc_id"], StructField("item_id", id_type), StructField("cosine", DoubleType()), StructField("lcs", DoubleType())]))
    return out


def clean(docs: DataFrame, benchmark: DataFrame, cosine: float = COSINE, least: float = LCS, answer_share: float = ANSWER_SHARE, rank: int = RANK, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, their columns unchanged."""
    out = docs
    for wave in _waves(docs, benchmark, rank, block_words):
        out = _scan(out, wave, benchmark.schema["item_id"].dataType, None, cosine, least, answer_share, True)
    return out
