"""Grammar of folder names over tokens: type - model OEM SN serial customer site technician.

Which tokens are an OEM, a technician or a site is looked up in a reference table of any size, by join; an ``aggregate`` over a name's tokens is the state machine.
Each result says how sure it is (high, medium, low) and why not more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.functions.text import compact

SEPARATOR, SERIAL_MARK = " - ", "SN"
NOTES = {
    "separator": "the separator ' - ' is missing", "oem": "no known OEM", "serial": "no SN mark with a serial number after it",
    "technician": "the technician is not known", "site": "the site is not known", "customer": "no customer is left",
}

#: States of the machine: the words before the OEM, those up to the SN mark, the serial number, and what follows it.
_MODEL, _AFTER_OEM, _SERIAL, _TAIL = range(4)


def reference_table(spark, oems: list[str], technicians: list[str], sites: dict[str, str]) -> DataFrame:
    """(kind, token, label) of short lists; larger ones are a table of this form, with tokens in upper case."""
    rows = [("oem", compact_upper(x), None) for x in oems] + [("technician", compact_upper(x), None) for x in technicians] + [("site", compact_upper(k), v) for k, v in sites.items()]
    return spark.createDataFrame(rows, "kind string, token string, label string")


def compact_upper(value: str) -> str:
    return " ".join(value.split()).upper()


def known_tokens(rows: DataFrame, key: str, name: str, references: DataFrame) -> DataFrame:
    """(key, raw, kind, tokens): the tokens after the separator as structs (at, word, upper, oem, technician, site, label), in order. Null names are empty."""
    raw = compact(name)
    at = F.instr(raw, SEPARATOR)
    head = rows.select(F.col(key).alias("key"), raw.alias("raw"), F.when(at > 0, F.upper(F.substr(raw, F.lit(1), at - 1))).alias("equipment_type"), F.when(at > 0, F.trim(F.substr(raw, at + len(SEPARATOR)))).alias("rest"))
    each = head.select("key", F.posexplode(F.filter(F.split("rest", " "), lambda w: w != "")).alias("at", "word")).withColumn("token", F.upper("word"))
    of = lambda kind: F.max((F.col("kind") == kind).cast("int")).alias(kind)
    meaning = references.where(F.col("token").isNotNull()).groupBy("token").agg(of("oem"), of("technician"), of("site"), F.max(F.when(F.col("kind") == "site", F.col("label"))).alias("label"))
    known = each.join(meaning, "token", "left")  # a row a token of a name
    flag = lambda c: F.coalesce(F.col(c) == 1, F.lit(False)).alias(c)
    tokens = known.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("at", "word", F.col("token").alias("upper"), flag("oem"), flag("technician"), flag("site"), "label"))).alias("tokens"))
    return head.join(tokens, "key", "left").select("key", "raw", "equipment_type", "tokens")


def _machine(tokens: Column) -> Column:
    """struct(state, model, oem, serial, tail) after all tokens."""
    words = F.array().cast("array<string>")
    start = F.struct(F.lit(_MODEL).alias("state"), words.alias("model"), F.lit(None).cast("string").alias("oem"), F.lit(None).cast("string").alias("serial"), F.slice(tokens, 1, 0).alias("tail"))

    def step(s: Column, t: Column) -> Column:
        finds_oem = (s["state"] == _MODEL) & t["oem"]
        finds_mark = (s["state"] == _AFTER_OEM) & (t["upper"] == SERIAL_MARK)
        is_serial = s["state"] == _SERIAL
        return F.struct(
            F.when(finds_oem, _AFTER_OEM).when(finds_mark, _SERIAL).when(is_serial, _TAIL).otherwise(s["state"]).alias("state"),
            F.when((s["state"] == _MODEL) & ~t["oem"], F.array_append(s["model"], t["word"])).otherwise(s["model"]).alias("model"),
            F.when(finds_oem, t["upper"]).otherwise(s["oem"]).alias("oem"),
            F.when(is_serial, t["word"]).otherwise(s["serial"]).alias("serial"),
            F.when(s["state"] == _TAIL, F.array_append(s["tail"], t)).otherwise(s["tail"]).alias("tail"),
        )

    return F.aggregate(tokens, start, step)


def parse_folder_names(rows: DataFrame, key: str, name: str, references: DataFrame) -> DataFrame:
    """key, equipment_type, model, oem, serial_number, customer, site_code, site_name, technician, confidence and notes of each name; keys must be unique.

    The technician is the last token after the serial number if it is a known one, the site the last token left, the customer what is left then.  High: all is known; medium: technician or site
    are not; low: something else is missing.
    """
    t = known_tokens(rows, key, name, references).withColumn("m", F.when(F.col("equipment_type").isNotNull() & F.col("tokens").isNotNull(), _machine(F.col("tokens"))))
    tail = F.col("m.tail")
    last = lambda a: F.get(a, F.size(a) - 1)
    has_tech = F.coalesce(last(tail)["technician"], F.lit(False))
    t = t.withColumns({"technician": F.when(has_tech, last(tail)["upper"]), "left": F.when(has_tech, F.slice(tail, F.lit(1), F.size(tail) - 1)).otherwise(tail)})
    has_site = F.coalesce(last(F.col("left"))["site"], F.lit(False))
    t = t.withColumns({"site_code": F.when(has_site, last(F.col("left"))["upper"]), "site_name": F.when(has_site, last(F.col("left"))["label"]), "left": F.when(has_site, F.slice("left", F.lit(1), F.size("left") - 1)).otherwise(F.col("left"))})
    text = lambda a: F.nullif(F.array_join(a, " "), F.lit(""))
    serial = F.col("m.serial")
    t = t.withColumns({"model": text(F.when(F.col("m.oem").isNotNull(), F.col("m.model"))), "customer": F.when(serial.isNotNull(), text(F.transform("left", lambda x: x["word"])))})
    cut = F.col("equipment_type").isNotNull()
    faults = {"separator": ~cut, "oem": cut & F.col("m.oem").isNull(), "serial": F.col("m.oem").isNotNull() & serial.isNull()}
    faults |= {c: serial.isNotNull() & F.col(of).isNull() for c, of in (("technician", "technician"), ("site", "site_code"), ("customer", "customer"))}
    notes = F.filter(F.array(*[F.when(f, F.lit(NOTES[c])) for c, f in faults.items()]), lambda x: x.isNotNull())
    strong = (F.length("equipment_type") > 0) & F.col("model").isNotNull() & serial.isNotNull() & F.col("customer").isNotNull()
    sure = F.when(F.coalesce(strong, F.lit(False)), F.when(F.col("site_code").isNotNull() & F.col("technician").isNotNull(), "high").otherwise("medium")).otherwise("low")
    return t.select(F.col("key").alias(key), "equipment_type", "model", F.col("m.oem").alias("oem"), serial.alias("serial_number"), "customer", "site_code", "site_name", "technician", sure.alias("confidence"), notes.alias("notes"))
