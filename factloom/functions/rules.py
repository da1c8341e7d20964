"""Classifiers built from ordered rule tables."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from factloom.functions.text import ColumnOrName, text


def first_match(rules: Sequence[tuple[str, Column]], otherwise: str | None = None) -> Column:
    """Name of the first rule whose condition holds."""
    out = F.lit(otherwise)
    for name, condition in reversed(rules):
        out = F.when(condition, F.lit(name)).otherwise(out)
    return out


def all_matches(rules: Sequence[tuple[str, Column]], otherwise: str | None = None) -> Column:
    """Names of all rules whose condition holds, in table order; ``otherwise`` alone if none does."""
    found = F.array_compact(F.array(*[F.when(condition, F.lit(name)) for name, condition in rules]))
    return found if otherwise is None else F.when(F.size(found) == 0, F.array(F.lit(otherwise))).otherwise(found)


def any_word(c: ColumnOrName, words: Iterable[str]) -> Column:
    """Whether one of the word patterns stands between word boundaries, in any case."""
    return text(c).rlike(r"(?i)\b(?:" + "|".join(words) + r")\b")


def contains_any(c: Column, keywords: Iterable[str]) -> Column:
    """Whether the text holds one of the keywords as a substring."""
    out = F.lit(False)
    for k in keywords:
        out = out | F.contains(c, F.lit(k))
    return out


def reasons(rules: Sequence[tuple[str, Column]]) -> Column:
    """Names of all rules that hold, as a queue entry's reasons."""
    return F.array_compact(F.array(*[F.when(condition, F.lit(name)) for name, condition in rules]))
