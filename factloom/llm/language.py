"""Language identification by rank-order n-gram profiles.

A profile is the list of the ``PROFILE`` most frequent character n-grams (1 to 3 code points of lower-cased text, words padded
with a blank) in order of frequency.  A document goes to the language whose profile is nearest by the out-of-place
distance: the sum over the document's n-grams of the difference in rank, or PROFILE if the language's profile
lacks the n-gram.  N-grams are hashed to BITS bits.

The driver gets PROFILE rows a language. A task sends its counts once: at most 2**BITS rows a language, about a hundredth of the bytes that it read.

Defined results: ``und`` with score 0 if a text is null or has no letter (a character of a letter category, on any plane), or if no language could be learned;
n-grams of one frequency stand in the order of their hashes, and languages at one distance in that of their codes: the first wins; very long texts are
counted whole; an empty table gives an empty result; languages are learned from rows with text and language outside the held-out fold; repeated
rows count each. score is 1 - distance / largest possible distance. Input columns named as an output are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from factloom.llm import textbatch as tb
from factloom.llm.common import annotate, arrow_map, batch, fold

PROFILE, BITS, MAX_N = 300, 20, 3
_SIZE = 1 << BITS


def _letters() -> np.ndarray:
    """Lower-case code point of each letter of the basic plane, 0 for other characters."""
    t = np.zeros(1 << 16, np.uint16)
    for c in range(1 << 16):
        ch = chr(c)
        if ch.isalpha():
            low = ch.lower()
            t[c] = ord(low) if len(low) == 1 and ord(low) < 1 << 16 else c
    return t


_table: list[np.ndarray] = []


def _folded(points: np.ndarray) -> np.ndarray:
    """Lower-case code point of each letter, 0 for other characters."""
    if not _table:
        _table.append(_letters())
    c = _table[0][np.minimum(points, (1 << 16) - 1)].astype(np.uint64)
    high = np.flatnonzero(points >= 1 << 16)
    if len(high):  # few texts have any: look at each distinct one
        u, inverse = np.unique(points[high], return_inverse=True)
        low = [chr(x).lower() if chr(x).isalpha() else "\0" for x in u.tolist()]
        c[high] = np.array([ord(x[0]) for x in low], np.uint64)[inverse]
    return c


def grams(s: tb.Slice) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of a slice and their rows."""
    text = s.data.tobytes().decode("utf-8", "replace")
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    lengths = np.diff(np.r_[0, np.cumsum((s.data & 0xC0) != 0x80)][s.offsets])
    row = np.repeat(np.arange(s.rows), lengths)
    if len(row) != len(points):  # broken UTF-8 was replaced: count again by row
        texts = [s.text(i) for i in range(s.rows)]
        points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
        row = np.repeat(np.arange(s.rows), [len(t) for t in texts])
    c = _folded(points)
    # one blank before each row; of a run of blanks only the first stays
    at = np.searchsorted(row, np.arange(s.rows))
    c, row = np.insert(c, at, 0), np.insert(row, at, np.arange(s.rows))
    keep = np.r_[True, (c[1:] != 0) | (c[:-1] != 0) | (row[1:] != row[:-1])] if len(c) else np.zeros(0, bool)
    c, row = c[keep], row[keep]
    out, rows = [], []
    for n in range(1, MAX_N + 1):
        m = len(c) - n + 1
        if m <= 0:
            break
        h = np.full(m, n, np.uint64)
        for k in range(n):
            h = h * np.uint64(0x100000001B3) + c[k : k + m]
        good = row[:m] == row[n - 1 :]
        if n == 1:
            good &= c != 0
        elif n == 2:
            good &= (c[:m] != 0) | (c[1:] != 0)
        elif n == 3:
            good &= c[1 : m + 1] != 0
        out.append((tb.mix(h[good]) >> np.uint64(64 - BITS)).astype(np.int64))
        rows.append(row[:m][good])
    z = np.zeros(0, np.int64)
    return (np.concatenate(out), np.concatenate(rows)) if out else (z, z)


def profiles(docs: DataFrame, size: int = PROFILE) -> dict[str, np.ndarray]:
    """The most frequent n-grams of each language, from all rows with text and lang outside the held-out fold.

    Every task sums its own counts; the driver gets ``size`` rows a language.
    """

    def counts(batches):
        total: dict[str, np.ndarray] = {}
        for b in batches:
            langs = b["lang"].to_pylist()
            for s in tb.slices(b["text"]):
                g, row = grams(s)
                names = np.array(langs[s.first : s.first + s.rows], object)
                for lang in set(names.tolist()):
                    pick = g[(names == lang)[row]] if len(g) else g
                    total.setdefault(lang, np.zeros(_SIZE, np.int64))
                    total[lang] += np.bincount(pick, minlength=_SIZE)
        for lang, n in total.items():
            k = np.flatnonzero(n)
            yield batch(lang=pa.array([lang] * len(k), pa.string()), gram=pa.array(k), n=pa.array(n[k]))

    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.coalesce(fold() != 0, F.lit(True))).select("lang", "text")
    total = arrow_map(known, counts, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    # top rows in two steps, so that no task gets all n-grams of a language
    for part in (F.pmod("gram", F.lit(64)), F.lit(0)):
        w = Window.partitionBy("lang", part).orderBy(F.desc("n"), "gram")
        total = total.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= size)
    out: dict[str, list] = {}
    for r in total.select("lang", "gram", "rank").orderBy("lang", "rank").collect():
        out.setdefault(r["lang"], []).append(r["gram"])
    return {k: np.array(v) for k, v in sorted(out.items())}


@dataclass
class Model:
    langs: list[str]
    rank: np.ndarray  # language x hashed n-gram; PROFILE where the profile lacks it

    @staticmethod
    def of(found: dict[str, np.ndarray], size: int = PROFILE) -> Model:
        rank = np.full((len(found), _SIZE), size, np.int16)
        for i, g in enumerate(found.values()):
            rank[i, g] = np.arange(len(g))
        return Model(list(found), rank)

    def predict(self, s: tb.Slice, size: int = PROFILE) -> tuple[list[str], np.ndarray]:
        g, row = grams(s)
        names, score = ["und"] * s.rows, np.zeros(s.rows)
        if not len(g) or not self.langs:
            return names, score
        key = np.sort((row << BITS) | g)
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        n = np.diff(np.r_[first, len(key)])
        gram, row = key[first] & (_SIZE - 1), key[first] >> BITS
        order = np.lexsort((gram, -n, row))
        gram, row = gram[order], row[order]
        start = np.searchsorted(row, np.arange(s.rows + 1))
        place = np.arange(len(row)) - start[row]
        top = place < size
        gram, row, place = gram[top], row[top], place[top]
        found = self.rank[:, gram]
        d = np.where(found == size, size, np.abs(found - place))
        used = np.bincount(row, minlength=s.rows)
        total = np.stack([np.bincount(row, weights=x, minlength=s.rows) for x in d])
        best = total.argmin(axis=0)
        for i in np.flatnonzero(used):
            names[i] = self.langs[best[i]]
            score[i] = 1 - total[best[i], i] / (size * used[i])
        return names, score


def identify(docs: DataFrame, model: Model, keep: list[str] | None = None) -> DataFrame:
    """``docs`` with lang_pred and lang_score."""
    ship = docs.sparkSession.sparkContext.broadcast(model)  # 2 MB a language

    def run(b):
        names, scores = [], [np.zeros(0)]
        for s in tb.slices(b["text"]):
            k, v = ship.value.predict(s)
            names += k
            scores.append(v)
        return {"lang_pred": pa.array(names, pa.string()), "lang_score": np.concatenate(scores)}

    return annotate(docs, run, "lang_pred string, lang_score double", keep)


def language_predictions(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every document."""
    out = identify(docs, Model.of(profiles(docs)), ["doc_id"])
    return out.select("doc_id", F.coalesce(fold() == 0, F.lit(False)).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))
