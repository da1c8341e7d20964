"""Quality classifier: random Fourier features, ridge, isotonic calibration.

Each document becomes a vector of text statistics (``STATISTICS``).  After standardising, ``features``
random Fourier features cos(omega x + phase) approximate a Gaussian kernel.  The ridge weights solve normal
equations whose sums each partition makes on its own; only these fixed-size sums reach the driver.
Pool-adjacent-violators, by range of raw scores and then over their blocks, on a part of the labelled rows that the ridge did not see turns raw scores into
probabilities.

Defined results: null text reads as empty and gets the score of an all-zero statistic row; repeated ids and rows are
scored each, and alike; a very long text is scored whole; an empty table gives an empty result; texts of equal statistics score the same; labels without id or value are left out; without labels of both classes every score is the
share of the class that there is (0.5 without any).  Input columns named as an output are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.llm import textbatch as tb
from factloom.llm.common import annotate, arrow_map, batch, fold, labelled
from factloom.storage import materialize

#: Labelled rows that a fit uses at most, about; None: all of them.
SAMPLE = None
FEATURES, GAMMA, RIDGE, SEED = 256, 0.15, 1e-3, 20

STATISTICS = (
    "log_words", "word_length", "upper", "digits", "symbols", "exclaims", "punctuation", "non_ascii",
    "distinct_words", "top_word", "repeated_triples", "repeated_lines", "log_lines", "line_words", "short_lines",
)


def _flags(chars: bytes) -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(chars)] = True
    return t


_CLASSES = [
    _flags(bytes(range(65, 91))),
    _flags(bytes(range(97, 123))),
    _flags(b"0123456789"),
    _flags(b"#*$%&|<>"),
    _flags(b"!?"),
    _flags(b".,;:'\"()-"),
    _flags(bytes(range(0x80, 0x100))),
]


def by_row(flag: np.ndarray, s: tb.Slice) -> np.ndarray:
    """How many bytes of each row are flagged."""
    c = np.zeros(len(flag) + 1, np.int64)
    np.cumsum(flag, out=c[1:])
    return np.diff(c[s.offsets]).astype(float)


def repeats(row: np.ndarray, h: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By row: values that equal an earlier one, distinct values, count of the most frequent."""
    repeated, distinct, top = np.zeros(rows), np.zeros(rows), np.zeros(rows)
    if len(h):
        key = tb.mix(h ^ (row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
        order = np.argsort(key)
        key = key[order]
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        r = row[order[first]]
        n = np.diff(np.r_[first, len(key)])
        repeated = np.bincount(r, weights=n - 1, minlength=rows)
        distinct = np.bincount(r, minlength=rows).astype(float)
        np.maximum.at(top, r, n)
    return repeated, distinct, top


def statistics(s: tb.Slice) -> np.ndarray:
    """A row of STATISTICS for each text of a slice."""
    upper, lower, digits, symbols, exclaims, punctuation, non_ascii = (by_row(c[s.data], s) for c in _CLASSES)
    w = tb.words(s)
    n = w.counts().astype(float)
    word_bytes = np.bincount(w.row, weights=w.end - w.start, minlength=s.rows) if len(w) else np.zeros(s.rows)
    _, distinct, top = repeats(w.row, w.hash, s.rows)
    h, row, _ = tb.ngrams(w, 3)
    triples_again, _, _ = repeats(row, h, s.rows)
    triples = np.bincount(row, minlength=s.rows) if len(row) else np.zeros(s.rows)
    lines = tb.words(s, s.data != 0x0A)
    n_lines = lines.counts().astype(float)
    lines_again, _, _ = repeats(lines.row, lines.hash, s.rows)
    short = np.bincount(lines.row, weights=(lines.end - lines.start) < 30, minlength=s.rows) if len(lines) else np.zeros(s.rows)
    chars, one, a_line = np.maximum(word_bytes, 1), np.maximum(n, 1), np.maximum(n_lines, 1)
    return np.column_stack(
        [
            np.log1p(n), np.log1p(word_bytes / one), upper / np.maximum(upper + lower, 1), digits / chars, np.sqrt(symbols / chars), np.sqrt(exclaims / chars), punctuation / chars, non_ascii / chars,
            distinct / one, top / one, np.sqrt(triples_again / np.maximum(triples, 1)), np.sqrt(lines_again / a_line), np.log1p(n_lines), np.log1p(n / a_line), short / a_line,
        ]
    )


def _rows(column: pa.Array) -> np.ndarray:
    """The stored statistics of a batch, a row each."""
    return column.flatten().to_numpy().reshape(len(column), len(STATISTICS))


def _all_statistics(column: pa.Array) -> np.ndarray:
    return np.concatenate([np.zeros((0, len(STATISTICS))), *(statistics(s) for s in tb.slices(column))])


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    omega: np.ndarray
    phase: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    values: np.ndarray

    def lift(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        f = np.cos(z @ self.omega + self.phase) * np.sqrt(2 / len(self.phase))
        return np.column_stack([f, np.ones(len(x))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.lift(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        """Calibrated, with a thousandth of the raw score so that ties of the isotonic steps keep its order."""
        r = self.raw(x)
        return np.clip(0.999 * np.interp(r, self.knots, self.values) + 0.001 / (1 + np.exp(-4 * (r - 0.5))), 0, 1)


def _pool(rows: np.ndarray) -> np.ndarray:
    """Pool-adjacent-violators over rows (weight, sum of y, sum of raw) in order of raw."""
    blocks: list[list[float]] = []
    for row in rows.tolist():
        blocks.append(row)
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    return np.array(blocks).reshape(-1, 3)


def isotonic(raw: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool-adjacent-violators: knots (block means of raw) and their nondecreasing values."""
    order = np.argsort(raw, kind="stable")
    b = _pool(np.column_stack([np.ones(len(raw)), y[order], raw[order]]))
    return b[:, 2] / b[:, 0], b[:, 1] / b[:, 0]


def fit(docs: DataFrame, labels: DataFrame, column: str = "quality", limit: int | None = SAMPLE, features: int = FEATURES, gamma: float = GAMMA, ridge: float = RIDGE, seed: int = SEED) -> Model:
    """Fit on the labelled documents outside the held-out fold; on about ``limit`` of them, if it is given."""
    trained = F.col("doc_id").isNotNull() & (fold() != 0)
    return _fit(measured(docs.where(trained)), labelled(labels, column, limit), features, gamma, ridge, seed)


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, x): the statistics of every row of ``docs``."""
    return annotate(docs.select("doc_id", "text"), lambda b: {"x": pa.array(list(_all_statistics(b["text"])), pa.list_(pa.float64()))}, "x array<double>", ["doc_id"])


def _fit(rows: DataFrame, sample: DataFrame, features: int = FEATURES, gamma: float = GAMMA, ridge: float = RIDGE, seed: int = SEED) -> Model:
    """The model of the rows (doc_id, x) that ``sample`` (doc_id, y) labels. Texts are not joined, only their statistics, some 130 bytes a row."""
    known = rows.join(sample.hint("merge"), "doc_id")  # a shuffle at any size
    table = materialize(known.select("y", (F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1000)) % 5 == 0).alias("part"), "x"), "quality")
    d = len(STATISTICS)
    moments = table.select(F.col("y"), *[F.get("x", F.lit(i)).alias(f"x{i}") for i in range(d)]).agg(
        F.count("*").alias("n"), F.sum("y").alias("ones"), *[F.avg(f"x{i}").alias(f"m{i}") for i in range(d)], *[F.stddev_pop(f"x{i}").alias(f"s{i}") for i in range(d)]
    ).first()
    rng = np.random.default_rng(seed)
    omega, phase = rng.normal(scale=np.sqrt(2 * gamma), size=(d, features)), rng.uniform(0, 2 * np.pi, features)
    n, ones = moments["n"], moments["ones"] or 0
    if not 0 < ones < n:
        flat = np.full(2, ones / n if n else 0.5)
        return Model(np.zeros(d), np.ones(d), omega, phase, np.zeros(features + 1), np.array([0.0, 1.0]), flat)
    mean = np.array([moments[f"m{i}"] for i in range(d)])
    scale = np.array([moments[f"s{i}"] for i in range(d)])
    model = Model(mean, np.where(scale > 1e-9, scale, 1.0), omega, phase, np.zeros(features + 1), np.zeros(0), np.zeros(0))
    balance = np.array([0.5 * n / (n - ones), 0.5 * n / ones])

    def sums(batches):
        a, c = np.zeros((features + 1, features + 1)), np.zeros(features + 1)
        for b in batches:
            if b.num_rows:
                z, y = model.lift(_rows(b["x"])), b["y"].to_numpy()
                w = balance[y][:, None] * z
                a += w.T @ z
                c += w.T @ y
        yield batch(a=pa.array([a.tobytes()], pa.binary()), c=pa.array([c.tobytes()], pa.binary()))

    parts = arrow_map(table.where(~F.col("part")).select("x", "y").coalesce(8), sums, "a binary, c binary").collect()
    a = sum(np.frombuffer(p["a"]).reshape(features + 1, -1) for p in parts)
    c = sum(np.frombuffer(p["c"]) for p in parts)
    model.weights = np.linalg.solve(a + ridge * n * np.diag(np.r_[np.ones(features), 1e-6]), c)
    rest = table.where("part")
    if rest.agg(F.count_distinct("y")).first()[0] < 2:
        rest = table

    def raws(batches):
        for b in batches:
            if b.num_rows:
                yield batch(r=pa.array(model.raw(_rows(b["x"]))), y=b["y"])

    def pools(batches):
        """The blocks of one range of raw scores: neighbours that pool in a range pool among all as well."""
        at = np.zeros((0, 3))
        for b in batches:
            rows = np.column_stack([np.ones(b.num_rows), b["y"].to_numpy().astype(float), b["r"].to_numpy()])
            at = _pool(np.concatenate([at, rows]))
        yield batch(**{c: pa.array(at[:, k]) for k, c in enumerate(("n", "y", "r"))})

    ranges = arrow_map(rest.select("x", "y"), raws, "r double, y int").repartitionByRange("r").sortWithinPartitions("r", F.desc("y"))
    blocks = arrow_map(ranges, pools, "n double, y double, r double").toPandas().to_numpy()
    blocks = _pool(blocks[np.argsort(blocks[:, 2] / blocks[:, 0], kind="stable")])
    model.knots, model.values = blocks[:, 2] / blocks[:, 0], blocks[:, 1] / blocks[:, 0]
    return model


def score(docs: DataFrame, model: Model, threshold: float = 0.3, keep: list[str] | None = None) -> DataFrame:
    """``docs`` with quality_score (0 to 1) and quality_ok."""
    ship = docs.sparkSession.sparkContext.broadcast(model)  # fixed size: statistics x features

    def run(b):
        p = ship.value.score(_all_statistics(b["text"]))
        return {"quality_score": p, "quality_ok": p >= threshold}

    return annotate(docs, run, "quality_score double, quality_ok boolean", keep)


def accepted(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or more, their columns unchanged."""
    ship = docs.sparkSession.sparkContext.broadcast(model)  # fixed size
    return annotate(docs, lambda b: {"where": ship.value.score(_all_statistics(b["text"])) >= threshold}, "")


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, limit: int | None = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted for every document; its statistics are made once, for the fit and the score."""
    rows = materialize(measured(docs), "statistics")
    ship = docs.sparkSession.sparkContext.broadcast(_fit(rows.where(F.col("doc_id").isNotNull() & (fold() != 0)), labelled(labels, "quality", limit)))  # fixed size

    def run(b):
        p = ship.value.score(_rows(b["x"]))
        return {"score": p, "predicted": pa.array((p >= threshold).astype(np.int32))}

    out = annotate(rows, run, "score double, predicted int", ["doc_id"], reads="x")
    return out.select("doc_id", F.coalesce(fold() == 0, F.lit(False)).alias("held_out"), "score", "predicted")
