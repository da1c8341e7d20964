"""Content-addressed identities and log-number dates."""

from __future__ import annotations

import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F

from factloom.functions.text import ColumnOrName, col, compact, text


def content_id(prefix: str, *parts: ColumnOrName, digits: int = 16) -> Column:
    """prefix_ and the first hexadecimal digits of SHA-256 over the parts, joined by line feeds."""
    return F.concat(F.lit(f"{prefix}_"), F.substring(F.sha2(F.concat_ws("\n", *[text(p) for p in parts]), 256), 1, digits))


def uuid5(namespace: uuid.UUID, name: ColumnOrName) -> Column:
    """Name-based UUID, version 5."""
    h = F.sha1(F.concat(F.unhex(F.lit(namespace.hex)), F.encode(text(name), "UTF-8")))
    variant = F.element_at(F.array(*[F.lit(x) for x in "89ab"]), F.conv(F.substring(h, 17, 1), 16, 10).cast("int") % 4 + 1)
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)), F.concat(variant, F.substring(h, 18, 3)), F.substring(h, 21, 12))


def log_date(log: ColumnOrName) -> Column:
    """Calendar date of a YYMMDD### number in this century; null if it has another form or no such day."""
    c = col(log).cast("string")
    return F.when(c.rlike("^[0-9]{9}$"), F.try_to_date(F.concat(F.lit("20"), F.substring(c, 1, 6)), "yyyyMMdd"))


def log_sequence(log: ColumnOrName) -> Column:
    c = col(log).cast("string")
    return F.when(c.rlike("^[0-9]{9}$"), F.substring(c, 7, 3).cast("int"))


def detect_log(*texts: ColumnOrName) -> Column:
    """First nine-digit run with a valid date and a sequence above 0, by text in the order given."""
    def one(t: ColumnOrName) -> Column:
        found = F.regexp_extract_all(text(t), F.lit("(?<![0-9])([0-9]{9})(?![0-9])"), F.lit(1))
        return F.get(F.filter(found, lambda x: log_date(x).isNotNull() & (F.substring(x, 7, 3) != "000")), F.lit(0))

    return F.coalesce(*[one(t) for t in texts])


def pivot_log_date(log: ColumnOrName, pivot: int = 69) -> Column:
    """YYYY-MM-DD text of a log number, years above the pivot in the last century; months and days are only checked for their range."""
    c = col(log).cast("string")
    yy, mm, dd = (F.substring(c, i, 2).cast("int") for i in (1, 3, 5))
    year = F.when(yy <= pivot, 2000 + yy).otherwise(1900 + yy)
    return F.when(c.rlike("^[0-9]{9}$"), F.when(mm.between(1, 12) & dd.between(1, 31), F.format_string("%04d-%02d-%02d", year, mm, dd)))


def form_date(raw: ColumnOrName, log: ColumnOrName, earliest: int = -31, latest: int = 370) -> Column:
    """struct(status, date, days_from_log) of a handwritten m/d/y field.

    blank; no_date; several_dates; invalid_date; no_log_date; implausible (too far from the log's date); or plausible.  Two-digit years
    from 70 on are of the last century.
    """
    s = compact(raw)
    found = F.regexp_extract_all(s, F.lit(r"(?<![0-9])([0-9]{1,2}[/-][0-9]{1,2}[/-](?:[0-9]{4}|[0-9]{2}))(?![0-9])"), F.lit(1))
    p = F.split(F.translate(F.get(found, F.lit(0)), "-", "/"), "/")
    y = F.get(p, F.lit(2)).cast("int")
    year = F.when(F.length(F.get(p, F.lit(2))) == 4, y).when(y >= 70, 1900 + y).otherwise(2000 + y)
    date = F.when(F.size(found) == 1, F.try_to_date(F.format_string("%04d%02d%02d", year, F.get(p, F.lit(0)).cast("int"), F.get(p, F.lit(1)).cast("int")), "yyyyMMdd"))
    days = F.datediff(date, log_date(log))
    status = (
        F.when(s == "", "blank").when(F.size(found) == 0, "no_date").when(F.size(found) > 1, "several_dates").when(date.isNull(), "invalid_date")
        .when(days.isNull(), "no_log_date").when(days.between(earliest, latest), "plausible").otherwise("implausible")
    )
    return F.struct(status.alias("status"), date.alias("date"), days.alias("days_from_log"))


def initials(raw: ColumnOrName) -> Column:
    """struct(status, value): two or three letters, dots and blanks removed."""
    s = F.upper(F.regexp_replace(text(raw), r"[\s.]+", ""))
    ok = s.rlike("^[A-Z]{2,3}$")
    return F.struct(F.when(s == "", "blank").when(ok, "valid").otherwise("invalid").alias("status"), F.when(ok, s).alias("value"))


def sample_key(value: ColumnOrName, seed: str) -> Column:
    """SHA-256 of seed, a zero byte and the value: the order of a deterministic sample."""
    return F.sha2(F.concat(F.encode(F.lit(seed), "UTF-8"), F.unhex(F.lit("00")), F.encode(text(value), "UTF-8")), 256)


def hash_pieces(hex_hash: ColumnOrName, pieces: int = 8) -> Column:
    """A long hexadecimal bit string as longs of 32 bits."""
    return F.array(*[F.conv(F.substring(col(hex_hash), 8 * k + 1, 8), 16, 10).cast("long") for k in range(pieces)])


def hamming(a: ColumnOrName, b: ColumnOrName) -> Column:
    """Differing bits of two arrays of hash_pieces()."""
    return F.aggregate(F.zip_with(col(a), col(b), lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)


def quantity(raw: ColumnOrName) -> Column:
    """An int from 1 to 10000, else null: null means unstated and is counted on its own."""
    q = col(raw).cast("string").try_cast("int")
    return F.when(q.between(1, 10000), q)
