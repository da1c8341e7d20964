"""Toxicity by multiple-instance learning.

A document is a bag of sentences.  A sentence's score is the logistic of summed weights of its words and their beginnings (hashed);
the document's score is their noisy-or, 1 - prod(1 - p), where p is what the sentence adds to one without evidence.  The weights are trained from document labels alone by
full-batch adaptive gradients of the noisy-or likelihood, on a bounded labelled sample.  The trained
sentence scores then locate the offending sentences.

Words are maximal runs of letters (A-Z lower-cased; all non-ASCII characters count as letters); sentences end at
``.``, ``!``, ``?`` or a line feed.  Defined results: a text without words, or a null one, scores 0; repeated ids and rows are scored
each, and alike; a very long text is scored whole; an empty table gives an empty result; rows of one id whose labels differ count as label 1 from a half on; without labels of both classes every score is the share of label 1.  Input columns named as an output are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.llm import textbatch as tb
from factloom.llm.common import annotate, arrow_map, batch, fold, labelled

#: Labelled documents of each class that a fit uses at most, about.
SAMPLE = 4_000
BITS, SELECT_ROUNDS, FIT_ROUNDS, SHRINK = 19, 60, 300, 0.02
#: L1 penalty of the selection, as a share of the label-1 documents.
SPARSE = 0.002
#: Bytes of a word's beginning that are features of their own, for inflected forms.
PREFIXES = (5, 6, 7)
#: A feature in fewer sample documents has no weight.
LEAST = 5
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_STOP = np.zeros(256, bool)
_STOP[list(b".!?\n")] = True


@dataclass
class Sentences:
    """Distinct word features of each sentence that has words; sentences in text order."""

    feature: np.ndarray
    sentence: np.ndarray  # of each feature
    row: np.ndarray  # of each sentence
    start: np.ndarray
    end: np.ndarray


def sentences(s: tb.Slice) -> Sentences:
    low = s.lower()
    start, end, row = tb.runs(low, _LETTER[low.data])
    hasher = tb.Hasher(low.data)
    w = tb.Words(start, end, row, hasher(start, end), np.zeros(0))
    stops = np.zeros(len(s.data) + 1, np.int64)
    np.cumsum(_STOP[s.data], out=stops[1:])
    part = stops[w.start] if len(w) else np.zeros(0, np.int64)
    new = np.r_[True, (part[1:] != part[:-1]) | (w.row[1:] != w.row[:-1])] if len(w) else np.zeros(0, bool)
    of = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    last = np.r_[first[1:], len(w)] - 1 if len(first) else first
    code, at = [w.hash], [of]
    for k in PREFIXES:
        long = np.flatnonzero(end - start > k)
        code.append(tb.mix(hasher(start[long], start[long] + k) + np.uint64(k)))
        at.append(of[long])
    key = np.unique((np.concatenate(at).astype(np.uint64) << np.uint64(BITS)) | (np.concatenate(code) >> np.uint64(64 - BITS)))
    return Sentences((key & np.uint64((1 << BITS) - 1)).astype(np.int32), (key >> np.uint64(BITS)).astype(np.int64), w.row[first], w.start[first], w.end[last])


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    flat: float | None = None

    def sentence(self, x: Sentences) -> np.ndarray:
        """What a sentence adds to one without any weighted word, which scores 0: else the leak of the bias would condemn every text of many sentences."""
        z = np.bincount(x.sentence, weights=self.weights[x.feature], minlength=len(x.row)) + self.bias
        p, leak = 1 / (1 + np.exp(-np.clip(z, -30, 30))), 1 / (1 + np.exp(-self.bias))
        return np.maximum(p - leak, 0) / (1 - leak)

    def document(self, p: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
        if self.flat is not None:
            return np.full(rows, self.flat)
        return 1 - np.exp(np.bincount(row, weights=np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=rows))


def _gradient(feature, sentence, bag, y, w, b, weight) -> tuple[np.ndarray, float]:
    """Of the noisy-or log-loss by feature weight and bias."""
    z = np.bincount(sentence, weights=w[feature], minlength=len(bag)) + b
    p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    none = np.exp(np.bincount(bag, weights=np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=len(y)))
    gz = (np.where(y == 1, -none / np.maximum(1 - none, 1e-9), 1.0) * weight)[bag] * p
    return np.bincount(feature, weights=gz[sentence], minlength=len(w)), float(gz.sum())


def train(feature: np.ndarray, sentence: np.ndarray, bag: np.ndarray, y: np.ndarray) -> Model:
    """Noisy-or likelihood in two phases: proximal L1 steps select features, then the selected ones are refitted. bag: of each sentence."""
    n, ones = 1 << BITS, y.sum()
    if not 0 < ones < len(y):
        return Model(np.zeros(n), 0.0, float(y.mean()) if len(y) else 0.5)
    pair = np.sort(bag[sentence].astype(np.int64) << BITS | feature)
    pair = pair[np.r_[True, pair[1:] != pair[:-1]]]
    often = (np.bincount(pair & (n - 1), minlength=n) >= LEAST)[feature]
    del pair
    feature, sentence = feature[often], sentence[often]
    w, b, g2, gb2, sparse = np.zeros(n), -5.0, np.ones(n), 1.0, max(2.0, SPARSE * ones)
    for _ in range(SELECT_ROUNDS):
        g, gb = _gradient(feature, sentence, bag, y, w, b, np.where(y == 1, 1.0, ones / (len(y) - ones)))
        g2, gb2 = g2 + g * g, gb2 + gb * gb
        rate = 0.4 / np.sqrt(g2)
        w -= rate * g
        w = np.sign(w) * np.maximum(np.abs(w) - rate * sparse, 0)
        b -= 0.12 * gb / np.sqrt(gb2)
    chosen = w != 0
    kept = chosen[feature]
    feature, sentence = feature[kept], sentence[kept]
    b, g2, gb2 = -8.0, np.ones(n), 1.0
    for _ in range(FIT_ROUNDS):
        g, gb = _gradient(feature, sentence, bag, y, w, b, 1.0)
        g = (g + SHRINK * w) * chosen
        g2, gb2 = 0.95 * g2 + g * g, 0.95 * gb2 + gb * gb
        w -= 0.5 * g / np.sqrt(g2)
        b -= 0.1 * gb / np.sqrt(gb2)
    return Model(w, b)


def fit(docs: DataFrame, labels: DataFrame, column: str = "toxic", limit: int = SAMPLE) -> Model:
    """Fit on at most about ``limit`` documents of each class outside the held-out fold; their hashed sentences are what the driver gets."""
    sample = labelled(labels, column, limit, per_class=True)

    def bags(batches):
        for b in batches:
            y = b["y"].to_numpy()
            for s in tb.slices(b["text"]):
                x = sentences(s)
                bounds = np.searchsorted(x.row[x.sentence], np.arange(s.rows + 1)) if len(x.sentence) else np.zeros(s.rows + 1, int)
                yield batch(
                    y=pa.array(y[s.first : s.first + s.rows], pa.int32()),
                    f=pa.array([x.feature[i:j].tobytes() for i, j in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary()),
                    s=pa.array([x.sentence[i:j].astype(np.int32).tobytes() for i, j in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary()),
                )

    known = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("text", F.col("y").cast("int").alias("y"))
    f, of, bag, y, at = [], [], [], [], 0
    for r in arrow_map(known, bags, "y int, f binary, s binary").toLocalIterator():
        v = np.frombuffer(r["s"], np.int32)
        if len(v):
            f.append(np.frombuffer(r["f"], np.int32))
            of.append(v - v[0] + np.int32(at))
            bag.append(np.full(v[-1] - v[0] + 1, len(y), np.int32))
            at += len(bag[-1])
        y.append(r["y"])
    cat = lambda a: np.concatenate(a) if a else np.zeros(0, np.int32)
    feature, sentence, of_bag = cat(f), cat(of), cat(bag)
    del f, of, bag
    return train(feature, sentence, of_bag, np.array(y, float))


def score(docs: DataFrame, model: Model, cut: float = 0.5, keep: list[str] | None = None, locate: bool = True) -> DataFrame:
    """``docs`` with toxicity (0 to 1), n_offending and, with ``locate``, offending: the sentences that score ``cut`` or more."""
    ship = docs.sparkSession.sparkContext.broadcast(model)  # fixed size: 2**BITS weights

    def run(b):
        m, scores, counts, found = ship.value, [], [], []
        for s in tb.slices(b["text"]):
            x = sentences(s)
            p = m.sentence(x)
            scores.append(m.document(p, x.row, s.rows))
            bad = np.flatnonzero(p >= cut) if m.flat is None else np.zeros(0, int)
            counts.append(np.bincount(x.row[bad], minlength=s.rows))
            if locate:
                lists: list[list] = [[] for _ in range(s.rows)]
                for i in bad:
                    lists[x.row[i]].append({"sentence": s.data[x.start[i] : x.end[i]].tobytes().decode("utf-8", "replace"), "score": float(p[i])})
                found += lists
        cat = lambda a, kind: np.concatenate([np.zeros(0), *a]).astype(kind)
        out = {"toxicity": cat(scores, float), "n_offending": cat(counts, np.int64)}
        return out | ({"offending": pa.array(found, pa.list_(pa.struct([("sentence", pa.string()), ("score", pa.float64())])))} if locate else {})

    return annotate(docs, run, "toxicity double, n_offending long" + ", offending array<struct<sentence:string,score:double>>" * locate, keep)


def toxicity_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, limit: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted, and the offending sentences with their scores, of every document."""
    out = score(docs, fit(docs, labels, limit=limit), keep=["doc_id"])
    return out.select("doc_id", F.coalesce(fold() == 0, F.lit(False)).alias("held_out"), F.col("toxicity").alias("score"), (F.col("toxicity") >= threshold).cast("int").alias("predicted"), "n_offending", "offending")
