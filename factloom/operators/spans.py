"""Mentions with positions: lexicon and glossary spans, overlaps, context windows and fuzzy anchors."""

from __future__ import annotations

import difflib
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factloom.functions.text import alnum_lower, compare_form, search_form, text
from factloom.operators.terms import flexible


def _named(spans: Column, canonical: str) -> Column:
    return F.transform(spans, lambda s: F.struct(F.lit(canonical).alias("canonical"), s["start"].alias("start"), s["end"].alias("end"), s["raw"].alias("raw")))


def mentions(docs: DataFrame, key: str, body: str, lexicon: dict[str, tuple[str, ...]], source: str, priority: int) -> DataFrame:
    """(key, canonical, start, end, raw, source, priority) of every lexicon alias in the texts, longest alias first.

    Positions come from the lengths of what lies between matches, so that no Python runs. The lexicon is a literal.
    """
    each = []
    for canonical, aliases in lexicon.items():
        pattern = "(?i)(?:" + "|".join(flexible(a) for a in sorted({canonical, *aliases}, key=len, reverse=True)) + ")"
        found = F.regexp_extract_all(text(body), F.lit(f"({pattern})"), F.lit(1))
        gaps = F.split(text(body), pattern)
        spans = F.aggregate(
            F.arrays_zip(found.alias("m"), F.slice(gaps, F.lit(1), F.size(found)).alias("g")),
            F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,raw:string>>").alias("out")),
            lambda a, x: F.struct(
                (a["at"] + F.length(x["g"]) + F.length(x["m"])).alias("at"),
                F.concat(a["out"], F.array(F.struct((a["at"] + F.length(x["g"])).alias("start"), (a["at"] + F.length(x["g"]) + F.length(x["m"])).alias("end"), x["m"].alias("raw")))).alias("out"),
            ),
        )["out"]
        each.append(_named(spans, canonical))
    rows = docs.select(key, F.inline(F.flatten(F.array(*each))))
    return rows.withColumns({"source": F.lit(source), "priority": F.lit(priority)})


def resolve_overlaps(rows: DataFrame, group: list[str]) -> DataFrame:
    """Of overlapping mentions of one canonical part, the first by start, then priority, then length. Chains of overlaps are rare and short; a mention is compared with the one kept before it."""
    w = Window.partitionBy(*group, "canonical").orderBy("start", F.desc("priority"), F.desc(F.col("end") - F.col("start")), "source")
    reach = F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    return rows.withColumn("_reach", reach).where(F.col("_reach").isNull() | (F.col("start") >= F.col("_reach"))).drop("_reach")


def word_window(body: Column | str, start: Column | str, end: Column | str, before: int = 6, after: int = 6) -> Column:
    """The mention with up to ``before`` and ``after`` words beside it, white space as it stands."""
    b, s, e = text(body), F.col(start) if isinstance(start, str) else start, F.col(end) if isinstance(end, str) else end
    left = F.regexp_substr(F.substring(b, F.lit(1), s), F.lit(r"(?:\S+\s+){0,%d}\S*$" % before))
    right = F.regexp_substr(F.substr(b, e + 1), F.lit(r"^\S*(?:\s+\S+){0,%d}" % after))
    return F.concat(F.coalesce(left, F.lit("")), F.substr(b, s + 1, e - s), F.coalesce(right, F.lit("")))


def text_similarity(a: Column | str, b: Column | str) -> Column:
    """Larger of the Ratcliff-Obershelp ratio and the Jaccard similarity of the words, on the comparison forms; 0 if one is empty; 4 digits."""

    @F.pandas_udf("double")
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        out = []
        for p, q in zip(x, y, strict=True):
            if not p or not q:
                out.append(0.0)
                continue
            u, v = set(p.split()), set(q.split())
            out.append(round(max(difflib.SequenceMatcher(None, p, q).ratio(), len(u & v) / len(u | v)), 4))
        return pd.Series(out, dtype=float)

    return run(compare_form(a), compare_form(b))


def supported_actions(actions: DataFrame, notes: DataFrame, event: str, action: str, note: str, threshold: float = 0.86) -> DataFrame:
    """Notes of the same event that support an action: similar, or one holds the other with at least four words (0.95)."""
    both = actions.join(notes, event).withColumn("_s", text_similarity(action, note))
    a, n = compare_form(action), compare_form(note)
    inside = (a != "") & (n != "") & (F.contains(a, n) | F.contains(n, a)) & (F.least(F.size(F.split(a, " ")), F.size(F.split(n, " "))) >= 4)
    return both.withColumn("similarity", F.when(inside, F.greatest("_s", F.lit(0.95))).otherwise(F.col("_s"))).drop("_s").where(F.col("similarity") >= threshold)


def anchors(words: DataFrame, line: list[str], labels: dict[str, tuple[str, ...]], least: float = 0.72, page: list[str] | None = None) -> DataFrame:
    """Best place of each printed label on each page among OCR words (word_num, text, left, top, width, height): windows of n-1 to n+2 words of a line, by ratio.

    page: the columns of ``line`` that name a page, the first by default.
    """
    boxes = F.array_sort(F.collect_list(F.struct("word_num", "text", "left", "top", "width", "height")))
    lines = words.groupBy(*line).agg(boxes.alias("w"))
    names = F.array(*[F.struct(F.lit(k).alias("label"), F.lit(a).alias("alias"), F.lit(len(a.split())).alias("n")) for k, aliases in labels.items() for a in aliases])
    each = lines.select(*line, "w", F.explode(names).alias("l")).select(*line, "w", "l.*", F.explode(F.sequence(F.lit(1), F.size("w"))).alias("at"))
    sized = each.select("*", F.explode(F.sequence(F.greatest(F.lit(1), F.col("n") - 1), F.col("n") + 2)).alias("k")).where(F.col("at") + F.col("k") - 1 <= F.size("w"))
    part = sized.withColumn("p", F.slice("w", F.col("at"), F.col("k"))).withColumn("found", compare_form(F.array_join(F.transform("p", lambda x: x["text"]), " ")))
    scored = part.withColumn("score", text_ratio("found", compare_form("alias"))).where(F.col("score") >= least)
    w = Window.partitionBy(*(line[:1] if page is None else page), "label").orderBy(F.desc("score"), *line, "at", "k")
    best = scored.withColumn("_r", F.row_number().over(w)).where(F.col("_r") == 1)
    edge = lambda f: F.transform("p", f)
    return best.select(
        "label", *line, "found", F.round("score", 4).alias("score"), F.array_min(edge(lambda x: x["left"])).alias("left"), F.array_min(edge(lambda x: x["top"])).alias("top"), F.array_max(edge(lambda x: x["left"] + x["width"])).alias("right"), F.array_max(edge(lambda x: x["top"] + x["height"])).alias("bottom")
    )


def text_ratio(a: Column | str, b: Column | str) -> Column:
    from factloom.operators.similar import ratio

    return ratio(a, b)


def conflict_flags(result: Column | str, repairs: Column | str, parts: Column | str) -> Column:
    """Flags of a final result that approved repairs or parts contradict."""
    clear = F.contains(F.lower(text(result)), F.lit("no trouble found"))
    n = lambda c: F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(0))
    return F.array_compact(F.array(F.when(clear & (n(repairs) > 0), "conflicts_with_approved_repair_actions"), F.when(clear & (n(parts) > 0), "conflicts_with_approved_parts_replaced")))


#: Quotes that are broadcast at once.
QUOTES = 2048


def bound_pairs(quotes: DataFrame, docs: DataFrame, item: str, quote: str, key: str, body: str) -> DataFrame:
    """(item, key) for every quote that is bound (text.is_bound) to a document. Each document is searched for every quote, so that none is lost for want of a seed; quotes are broadcast in blocks of ``QUOTES``."""
    from itertools import batched

    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import StructType

    ascii_only = lambda c: (~text(c).rlike(r"[^\x00-\x7F]")).alias("plain")
    forms = docs.select(key, search_form(body).alias("e"), alnum_lower(body).alias("ea"), ascii_only(body))
    stated = quotes.select(item, search_form(quote).alias("q"), alnum_lower(quote).alias("qa"), ascii_only(quote)).where("q <> ''")
    schema = StructType([quotes.schema[item], docs.schema[key]])

    def search(block) -> DataFrame:
        ship = docs.sparkSession.sparkContext.broadcast([tuple(r) for r in block])
        kind = to_arrow_type(schema[item].dataType)

        def run(batches):
            for b in batches:
                items, at = [], []
                for i, (e, ea, plain) in enumerate(zip(*(b.column(b.schema.get_field_index(c)).to_pylist() for c in ("e", "ea", "plain")), strict=True)):
                    for name, q, qa, plain_quote in ship.value:
                        # where both are ASCII, a literal quote is one of letters and digits too, if it has any
                        if qa and qa in ea or not (qa and plain and plain_quote) and q in e:
                            items.append(name)
                            at.append(i)
                yield pa.RecordBatch.from_arrays([pa.array(items, kind), b.column(b.schema.get_field_index(key)).take(pa.array(at, pa.int64()))], names=[item, key])

        return forms.mapInArrow(run, schema)

    found = [search(block) for block in batched(stated.toLocalIterator(), QUOTES)]
    return reduce(DataFrame.unionByName, found) if found else docs.sparkSession.createDataFrame([], schema)
