"""String functions over columns. All are native expressions; a null argument reads as an empty string unless said otherwise.

Case is folded by ``lower`` with ``ß`` written as ``ss``, which is where lower and full case folding differ in Western texts.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

#: White space of a Java pattern's \\s. SQL engines with RE2 leave out the vertical tab.
WHITE = " \t\n\x0b\f\r"


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bind(value: Column, use) -> Column:
    """``use`` of a value that is computed once; a lambda would otherwise compute it again for every element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def text(c: ColumnOrName) -> Column:
    return F.coalesce(col(c).cast("string"), F.lit(""))


def compact(c: ColumnOrName, space: str = WHITE, ends: str = " ") -> Column:
    """White space (the characters of ``space``) to single blanks, the characters of ``ends`` trimmed."""
    return F.btrim(F.regexp_replace(text(c), f"[{space}]+", " "), F.lit(ends))


def fold(c: ColumnOrName) -> Column:
    return F.replace(F.lower(col(c)), F.lit("ß"), F.lit("ss"))


def search_form(c: ColumnOrName) -> Column:
    """compact() in folded case."""
    return fold(compact(c))


def alnum_lower(c: ColumnOrName) -> Column:
    """Only A-Z, a-z and 0-9, lower-cased."""
    return F.lower(F.regexp_replace(text(c), "[^A-Za-z0-9]+", ""))


def alnum_upper(c: ColumnOrName) -> Column:
    return F.upper(F.regexp_replace(text(c), "[^A-Za-z0-9]+", ""))


def path_form(c: ColumnOrName) -> Column:
    """Backslashes to slashes, folded case."""
    return fold(F.translate(text(c), "\\", "/"))


def query_form(c: ColumnOrName) -> Column:
    """Lower case; underscores and all but letters, digits and + . / - become single blanks."""
    s = F.regexp_replace(F.translate(F.lower(text(c)), "_", " "), "[^a-z0-9+./-]+", " ")
    return F.trim(F.regexp_replace(s, r"\s+", " "))


#: Words that carry no meaning in a pattern query. A shop passes these and the names of its own equipment.
STOPWORDS = (
    "a", "an", "and", "are", "as", "at", "be", "been", "for", "from", "i", "in", "is", "it", "me", "my", "of", "on", "or", "please", "show", "the", "to",
    "what", "when", "where", "which", "with", "normally", "usually", "common", "about",
)


def tokens(c: ColumnOrName, stopwords: tuple[str, ...] = STOPWORDS, least: int = 2) -> Column:
    """Distinct alphanumeric tokens of the query form that are no stopwords and have ``least`` characters."""
    found = F.array_distinct(F.regexp_extract_all(F.lower(text(c)), F.lit("[a-z0-9]+"), F.lit(0)))  # the query form keeps these runs as they are
    return F.filter(F.array_except(found, F.array(*[F.lit(s) for s in stopwords])), lambda t: F.length(t) >= least)


def compare_form(c: ColumnOrName) -> Column:
    """Typographic quotes and dashes to ASCII, then letters and digits with single blanks, lower-cased."""
    s = F.translate(text(c), "‘’“”–—¥", "''\"\"--Y")
    return F.trim(F.regexp_replace(F.lower(s), "[^a-z0-9]+", " "))


def duplicate_form(c: ColumnOrName) -> Column:
    """For near-duplicate comparison: unclear marks and page numbers dropped, letters and digits with single blanks."""
    s = F.regexp_replace(F.lower(text(c)), r"\[unclear\]", " ")
    s = F.regexp_replace(s, r"\bpage\s+\d+\b", " ")
    return F.trim(F.regexp_replace(s, "[^a-z0-9]+", " "))


def word_list(c: ColumnOrName) -> Column:
    """Words between single blanks; an empty string has none."""
    return F.filter(F.split(col(c), " "), lambda w: w != "")


def shingles(c: ColumnOrName, n: int = 3) -> Column:
    """Distinct n-word shingles of the duplicate form. A shorter text is one shingle, an empty one has none."""
    def windows(w: Column) -> Column:
        each = F.transform(F.sequence(F.lit(0), F.greatest(F.size(w) - n, F.lit(0))), lambda i: F.array_join(F.slice(w, i + 1, n), " "))
        return F.when(F.size(w) == 0, F.array().cast("array<string>")).otherwise(F.array_distinct(each))

    return bind(word_list(duplicate_form(c)), windows)


def jaccard(a: ColumnOrName, b: ColumnOrName) -> Column:
    """Of two arrays as sets: 1 if both are empty, 0 if one is."""
    x, y = F.array_distinct(col(a)), F.array_distinct(col(b))
    both = F.size(F.array_intersect(x, y))
    return F.when((F.size(x) == 0) & (F.size(y) == 0), 1.0).otherwise(both / F.greatest(F.size(x) + F.size(y) - both, F.lit(1)))


def slug(c: ColumnOrName, longest: int = 80, empty: str = "item") -> Column:
    """Characters for a name, others as underscores; ``empty`` for a text without any."""
    form = lambda x: F.btrim(F.regexp_replace(x, "[^A-Za-z0-9._-]+", "_"), F.lit("_."))  # noqa: E731  a pattern would try every start of a long run
    s = _of_start(c, form, longest)
    return F.when(s == "", F.lit(empty)).otherwise(s)


def _of_start(c: ColumnOrName, form, longest: int) -> Column:
    """The first ``longest`` characters of a form that goes through the text from left to right, and trims it; read off the text's start if that has more, else off the whole text."""
    start = F.substring(text(c), 1, 6 * longest)
    return F.substring(F.when(F.length(form(start)) > longest, form(start)).otherwise(form(text(c))), 1, longest)


def shorten(c: ColumnOrName, longest: int = 190, space: str = WHITE, ends: str = " ") -> Column:
    """compact(), cut to ``longest`` characters with an ellipsis as the last."""
    s = _of_start(c, lambda x: compact(x, space, ends), longest + 1)
    return F.when(F.length(s) <= longest, s).otherwise(F.concat(F.substring(s, 1, max(longest - 1, 0)), F.lit("…")))


def human_bytes(c: ColumnOrName, units: tuple[str, ...] = ("KB", "MB", "GB", "TB", "PB")) -> Column:
    """512 B, 1.5 KB, 2.0 MB ... up to the last of ``units``; n/a for null."""
    n = col(c).cast("double")
    out = F.when(n.isNull(), F.lit("n/a")).when(F.abs(n) < 1024, F.concat(col(c).cast("long").cast("string"), F.lit(" B")))
    for k, unit in enumerate(units, 1):
        shown = F.concat(F.format_string("%.1f", F.bround(n / float(1024**k), 1)), F.lit(f" {unit}"))
        out = out.otherwise(shown) if unit == units[-1] else out.when(F.abs(n) < float(1024 ** (k + 1)), shown)
    return out


def strip_rtf(c: ColumnOrName) -> Column:
    """Text of an RTF document without control words, groups and hexadecimal escapes."""
    s = F.regexp_replace(text(c), r"\\pard?\b ?", "\n")
    s = F.regexp_replace(s, r"\\'[0-9A-Fa-f]{2}", " ")
    s = F.regexp_replace(s, r"\\[A-Za-z]+-?[0-9]* ?", "")
    return F.trim(F.regexp_replace(s, r"[{}]", ""))


def is_bound(quote: ColumnOrName, evidence: ColumnOrName) -> Column:
    """Whether a quote stands in the evidence: literally after white-space folding, or in its letters and digits."""
    q, e = search_form(quote), search_form(evidence)
    qa, ea = alnum_lower(quote), alnum_lower(evidence)
    return (q != "") & (F.contains(e, q) | ((qa != "") & F.contains(ea, qa)))


def holds_identifier(evidence: ColumnOrName, identifier: ColumnOrName) -> Column:
    i = alnum_upper(identifier)
    return (i != "") & F.contains(alnum_upper(evidence), i)


def supported_slice(source: ColumnOrName, quote: ColumnOrName) -> Column:
    """struct(mode, slice): the exact part of the source that a proposed quote stands for.

    exact; whitespace (only white space differs); punctuation (one trailing sign of the quote is not there); or null.
    """
    s, q = text(source), F.trim(text(quote))
    escaped = lambda x: F.regexp_replace(F.regexp_replace(x, r"([\\.\[\]{}()*+?^$|])", r"\\$1"), r"\s+", r"\\s+")
    guard = lambda x: F.concat(F.lit(r"(?<![A-Za-z0-9])"), x, F.lit(r"(?![A-Za-z0-9])"))
    find = lambda x: F.regexp_substr(s, guard(escaped(x)))
    short = F.regexp_replace(q, r"[.,;:!?]$", "")
    exact = F.when(F.regexp_substr(s, guard(F.regexp_replace(q, r"([\\.\[\]{}()*+?^$|])", r"\\$1"))).isNotNull(), q)
    loose, trimmed = find(q), F.when(short != q, find(short))
    mode = F.when(exact.isNotNull(), "exact").when(loose.isNotNull(), "whitespace").when(trimmed.isNotNull(), "punctuation")
    found = F.when(q != "", F.struct(mode.alias("mode"), F.coalesce(exact, loose, trimmed).alias("slice")))
    return F.when(found["mode"].isNotNull(), found)


def rating_tokens(c: ColumnOrName) -> Column:
    """Electrical ratings such as 15A, 600V, 10UF or 5OHM, blanks removed, distinct and sorted. A micro sign is no U: only UF counts."""
    s = F.upper(text(c))
    found = F.regexp_extract_all(s, F.lit(r"\b[0-9]+(?:\.[0-9]+)?\s*(?:AMPS|AMP|A|V|UF|PF|NF|OHMS|OHM)\b"), F.lit(0))
    return F.array_sort(F.array_distinct(F.transform(found, lambda t: F.regexp_replace(t, r"\s+", ""))))


def ocr_quality(c: ColumnOrName, space: str = WHITE) -> Column:
    """Share of word characters among visible characters, weighted by the number of words of three letters or more."""
    s = text(c)
    visible = F.length(F.translate(s, space, ""))
    good = F.length(s) - F.length(F.translate(s, "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", ""))
    long_words = F.regexp_count(s, F.lit("[A-Za-z]{3,}"))
    return F.when(visible == 0, 0.0).otherwise(good / visible * F.log2(1.0 + long_words))


def part_like(c: ColumnOrName) -> Column:
    """Holds a token whose exact characters matter: letters and digits mixed, or a dotted or dashed code."""
    return text(c).rlike(r"\b[A-Za-z]{1,3}[0-9][A-Za-z0-9-]{2,}\b|\b[A-Za-z]\.[0-9]+\b|\b[A-Za-z]{2,}-[A-Za-z0-9-]*[0-9][A-Za-z0-9-]*\b")


def acronym_bonus(c: ColumnOrName, short: int = 0, four: int = 0, five: int = 0) -> Column:
    n = F.length(text(c))
    return F.when(n.isin(2, 3), short).when(n == 4, four).when(n == 5, five).otherwise(0)


def context_signature(c: ColumnOrName, term: str, radius: int = 7, compared: bool = False) -> Column:
    """Words around the first occurrence of a term, the term as <TERM> and numbers as <N>. compared: the text is a compare_form() already."""
    def sign(w: Column) -> Column:
        at = F.array_position(w, term.lower())
        first = F.greatest(at - radius, F.lit(1)).cast("int")
        around = F.slice(w, first, (at + radius - first + 1).cast("int"))
        return F.when(at > 0, F.array_join(F.transform(around, lambda t: F.when(t == term.lower(), "<TERM>").when(t.rlike("^[0-9]+$"), "<N>").otherwise(t)), " "))

    return bind(F.split(col(c) if compared else compare_form(c), " "), sign)


def tolerant_json(c: ColumnOrName) -> Column:
    """The JSON object in a reply: code fences stripped, then the outermost braces; null without any or if it does not parse."""
    s = F.regexp_replace(F.trim(text(c)), r"^```(?:json)?\s*|\s*```$", "")
    braces = F.regexp_substr(s, F.lit(r"(?s)\{.*\}"))
    ok = lambda x: F.when(F.get_json_object(x, "$").isNotNull(), x)
    return F.coalesce(F.when(s.startswith("{"), ok(s)), ok(braces))


def transcription_audit(c: ColumnOrName, runaway: int = 12) -> Column:
    """struct(lines, filled, top_line, top_count, runaway): a line repeated ``runaway`` times marks a runaway transcription."""
    lines = F.split(text(c), "\n")
    filled = F.array_sort(F.filter(F.transform(lines, lambda x: F.trim(x)), lambda x: x != ""))
    # one pass over the sorted lines: the run that is going on, and the longest so far
    none = F.lit(None).cast("string")
    start = F.struct(none.alias("line"), F.lit(0).alias("n"), none.alias("top"), F.lit(0).alias("most"))

    def step(a: Column, x: Column) -> Column:
        n = F.when(a["line"] == x, a["n"] + 1).otherwise(1)
        return F.struct(x.alias("line"), n.alias("n"), F.when(n > a["most"], x).otherwise(a["top"]).alias("top"), F.greatest(n, a["most"]).alias("most"))

    def audit(f: Column) -> Column:
        t = F.aggregate(f, start, step)
        return bind(t, lambda t: F.struct(F.size(lines).alias("lines"), F.size(f).alias("filled"), t["top"].alias("top_line"), t["most"].alias("top_count"), (t["most"] >= runaway).alias("runaway")))

    return bind(filled, audit)
