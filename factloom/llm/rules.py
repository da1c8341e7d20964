"""Quality rules with adaptive thresholds.

Each text gets exact counts (``metrics``) and, for the counts of RATES, the log-odds ``ln((k + 1/2) / (n - k + 1/2))`` of k marked among n
words, lines or characters.  Log-odds spread evenly also where most texts have no mark at all, since their lengths differ.  For every (lang, source) group,
mergeable KLL quantile sketches of these log-odds, over the texts that pass the base rules, give the upper fences ``q75 + FAR * (q75 - q25)``, the "far out" limit of box
plots.  Quartiles and their distance are shrunk: those of a group of n texts are mixed with those of its language, with the weights n and PRIOR, and the language's with those of
all texts in the same way, so every group's own texts count, and a few texts do not decide alone.  The distance counts as at least the mean one of the language's groups (by
rows), so that a group of mere copies does not reject its other texts.  The fences are joined to the rows, and
a text is kept if it passes the base rules and no rate lies above its fence by more than CLEAR standard errors of the counts, which a short text with
a few marks does not. No threshold of a rate is fixed, and labels play no part.

Defined results: null text has no words and fails; null lang or source is a group of its own; repeated rows count each; a rate equal to its fence
passes; an empty table gives an empty result; a text of any length is counted whole. Input columns named as an output are replaced.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.llm import textbatch as tb
from factloom.llm.common import annotate
from factloom.llm.quality import by_row, repeats
from factloom.storage import materialize

#: Rate: the count of marked ones, and of all.
RATES = {
    "symbol_rate": ("n_symbols", "word_chars"), "repeat_rate": ("n_repeat_words", "n_words"), "dup_line_rate": ("n_dup_lines", "n_lines"),
    "upper_rate": ("n_upper", "word_chars"), "exclaim_rate": ("n_exclaims", "word_chars"),
}
FAR, CLEAR, SKETCH_K = 3.0, 3.0, 200
#: Texts of the wider group that count with a group's own.
PRIOR = 50.0
COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, n_upper long, n_exclaims long"


def _set(chars: bytes) -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(chars)] = True
    return t


_SYMBOLS, _UPPER, _EXCLAIM = _set(b"#*$%&|<>"), _set(bytes(range(65, 91))), _set(b"!")
_SEPARATOR = _set(b" \t\n\x0b\x0c\r")
_FIRST = np.array([(b & 0xC0) != 0x80 for b in range(256)])


def counts(s: tb.Slice) -> dict[str, np.ndarray]:
    """The COUNTS of each row of a slice."""
    w = tb.words(s)
    # lines that have a word, by their whole content
    start, end, row = tb.runs(s, s.data != 0x0A)
    has = np.zeros(len(start), bool)
    if len(w):
        has[np.unique(np.searchsorted(start, w.start, side="right") - 1)] = True
    start, end, row = start[has], end[has], row[has]
    again, _, _ = repeats(row, tb.Hasher(s.data)(start, end), s.rows)
    h, at_row, at = tb.ngrams(w, 3)
    covered = np.zeros(len(w) + 3, np.int64)
    if len(h):
        key = tb.mix(h + at_row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        _, inverse, n = np.unique(key, return_inverse=True, return_counts=True)
        twice = at[n[inverse] > 1]
        for k in range(3):
            covered[twice + k] = 1
    repeated = np.bincount(w.row, weights=covered[: len(w)], minlength=s.rows) if len(w) else np.zeros(s.rows)
    return {
        "n_words": w.counts(), "word_chars": by_row(_FIRST[s.data] & ~_SEPARATOR[s.data], s), "n_symbols": by_row(_SYMBOLS[s.data], s), "n_dup_lines": again, "n_repeat_words": repeated,
        "n_lines": np.bincount(row, minlength=s.rows), "n_upper": by_row(_UPPER[s.data], s), "n_exclaims": by_row(_EXCLAIM[s.data], s),
    }


def metrics(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``docs`` with COUNTS, base_failed and RATES."""

    def run(b):
        parts = [counts(s) for s in tb.slices(b["text"])]
        return {k.split()[0]: np.concatenate([np.zeros(0), *(p[k.split()[0]] for p in parts)]).astype(np.int64) for k in COUNTS.split(", ")}

    odds = lambda k, n: F.log((F.col(k) + 0.5) / (F.col(n) - F.col(k) + 0.5))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return annotate(docs, run, COUNTS, keep).withColumns({"base_failed": failed} | {r: odds(*kn) for r, kn in RATES.items()})


def _quartiles(sketches: DataFrame, prefix: str) -> list[Column]:
    """The upper quartile of each rate and its distance from the lower one."""
    at = lambda r, q: F.kll_sketch_get_quantile_double(F.col(f"{r}_sketch"), F.lit(q))
    return [c for r in RATES for c in (at(r, 0.75).alias(f"{prefix}{r}_q"), (at(r, 0.75) - at(r, 0.25)).alias(f"{prefix}{r}_w"))]


def thresholds(measured: DataFrame, far: float = FAR, prior: float = PRIOR) -> DataFrame:
    """The group's keys and a fence for each rate, one row a group that has texts which pass the base rules;
    no text of another group can be kept."""
    passing = measured.where(~F.col("base_failed")).select(F.coalesce("lang", F.lit("\0")).alias("__lang"), F.coalesce("source", F.lit("\0")).alias("__source"), *RATES)
    groups = passing.groupBy("__lang", "__source").agg(F.count("*").alias("n"), *[F.kll_sketch_agg_double(r, F.lit(SKETCH_K)).alias(f"{r}_sketch") for r in RATES])
    merged = [F.sum("n").alias("n"), *[F.kll_merge_agg_double(f"{r}_sketch").alias(f"{r}_sketch") for r in RATES]]
    groups = materialize(groups, "sketches")
    own = groups.select("*", *_quartiles(groups, "own_"))
    floors = [(F.sum(F.col("n") * F.col(f"own_{r}_w")) / F.sum("n")).alias(f"floor_{r}") for r in RATES]
    by_lang = own.groupBy("__lang").agg(*merged, *floors)
    by_lang = by_lang.select("__lang", F.col("n").alias("lang_n"), *_quartiles(by_lang, "lang_"), *[f"floor_{r}" for r in RATES])
    overall = groups.agg(*merged)
    overall = overall.where(F.col("n") > 0).select(*_quartiles(overall, "all_"))
    joined = own.join(by_lang, "__lang").join(F.broadcast(overall))  # one row

    def fence(r: str) -> Column:
        def shrunk(end: str, own_end: Column) -> Column:
            mix = lambda n, x, y: (F.col(n) * x + prior * y) / (F.col(n) + prior)
            return mix("n", own_end, mix("lang_n", F.col(f"lang_{r}_{end}"), F.col(f"all_{r}_{end}")))

        return (shrunk("q", F.col(f"own_{r}_q")) + far * shrunk("w", F.greatest(f"own_{r}_w", f"floor_{r}"))).alias(f"{r}_fence")

    return joined.select("__lang", "__source", *[fence(r) for r in RATES])


def _clearly_above(rate: str) -> Column:
    """Whether the log-odds exceed the fence by more than CLEAR standard errors of the difference of two counts: the text's, and the one expected at the fence."""
    k, n = (F.col(c) for c in RATES[rate])
    at_fence = n / (1 + F.exp(-F.col(f"{rate}_fence")))
    variance = lambda k: 1 / (k + 0.5) + 1 / (n - k + 0.5)
    return F.col(rate) - F.col(f"{rate}_fence") > CLEAR * F.sqrt(variance(k) + variance(at_fence))


def judge(measured: DataFrame, fences: DataFrame) -> DataFrame:
    """``measured`` with kept: the base rules passed and no rate clearly above its fence."""
    keyed = measured.withColumns({"__lang": F.coalesce("lang", F.lit("\0")), "__source": F.coalesce("source", F.lit("\0"))})
    within = ~F.col("base_failed")
    for r in RATES:
        within &= ~_clearly_above(r)
    out = keyed.join(fences, ["__lang", "__source"], "left").withColumn("kept", F.coalesce(within, F.lit(False)))
    return out.drop("__lang", "__source", *[f"{r}_fence" for r in RATES])


def rule_verdicts(docs: DataFrame, far: float = FAR, prior: float = PRIOR) -> DataFrame:
    """doc_id, the base counts, base_failed and kept for every document."""
    measured = materialize(metrics(docs, ["doc_id", "lang", "source"]), "rules")
    return judge(measured, thresholds(measured, far, prior)).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
