"""What folder and file names say: families, serials, sequence numbers, roles and the event a file belongs to."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from factloom.functions.evidence import extension, is_system_path
from factloom.functions.ids import content_id, detect_log, log_date
from factloom.functions.rules import contains_any, first_match
from factloom.functions.text import ColumnOrName, compact, text

# Words of a form's file name, and of the marker before a serial number.
_FORM = r"(?i)line\s*card|linecard|traveler"
_SERIAL_MARK = r"(?i)\s+(?:S/?N|SN|SERIAL\s*(?:NO\.?|NUMBER)?)\s*[:#-]?\s*"
# Wording of evidence roles, first match wins.
_WORDING = {
    "failure_analysis_report": ("failure analysis", "field failure"),
    "robot_test_report": ("robot test report",),
    "robot_checklist": ("robot checklist",),
    "internal_checklist_notes": ("checklist notes",),
    "rbt_report": ("rbt rpt", "rbt report", "robot report"),
    "receiving_photo": ("receiving pic", "receiving photo", "incoming pic", "incoming photo"),
    "return_packaging_photo": ("return packaging", "shipment packaging", "shipping packaging"),
    "configuration_evidence": ("floppy", "param", "configuration", "config backup"),
}
# Extensions of roles that no wording decides.
_BY_EXTENSION = {
    "parameter_file": ("cfg", "ini", "par", "prm", "hex", "bin", "fw"),
    "photo": ("jpg", "jpeg", "png", "bmp", "gif", "tif", "tiff", "webp"),
    "movie": ("mp4", "mov", "avi", "wmv", "mkv"),
    "structured_document": ("xls", "xlsx", "csv"),
    "document": ("pdf", "doc", "docx", "rtf", "txt", "md"),
}


def filename(path: ColumnOrName) -> Column:
    return F.substring_index(F.translate(text(path), "\\", "/"), "/", -1)


def family_from_folder(folder: ColumnOrName) -> Column:
    """Text before the serial marker; the whole folder name if nothing stands before it."""
    head = compact(F.get(F.split(text(folder), _SERIAL_MARK, 2), F.lit(0)))
    return F.when(head != "", head).otherwise(compact(folder))


def serial_from_path(path: ColumnOrName) -> Column:
    """Eight-digit serial of the nearest folder that names one; of the name itself if there is no folder."""
    parts = F.split(F.translate(text(path), "\\", "/"), "/")
    folders = F.when(F.size(parts) > 1, F.slice(parts, F.lit(1), F.size(parts) - 1)).otherwise(parts)
    found = F.transform(F.reverse(folders), lambda p: F.regexp_extract(p, r"(?i)\bSN\s+(?:GB8-MT-)?([0-9]{8})\b", 1))
    return F.get(F.filter(found, lambda s: s != ""), F.lit(0))


def card_sequence(path: ColumnOrName) -> Column:
    """n of a name that ends in (n), before the extension."""
    return F.regexp_extract(filename(path), r"\(([0-9]+)\)(?=\s*\.[^.]+$|\s*$)", 1).try_cast("int")


def legacy_token(path: ColumnOrName) -> Column:
    """Last run of 8 to 12 digits before the form's name."""
    head = F.get(F.split(filename(path), _FORM, 2), F.lit(0))
    return F.try_element_at(F.regexp_extract_all(head, F.lit("(?<![0-9])([0-9]{8,12})(?![0-9])"), F.lit(1)), F.lit(-1))


def event_identity(path: ColumnOrName, top_folder: ColumnOrName) -> Column:
    """log_<number>, else legacy_<token>_<folder hash>, else record_<path hash>."""
    log, old = detect_log(filename(path), path), legacy_token(path)
    scoped = F.substring(F.sha2(F.concat_ws("\n", text(top_folder), old), 256), 1, 8)
    return F.coalesce(F.concat(F.lit("log_"), log), F.concat(F.lit("legacy_"), old, F.lit("_"), scoped), content_id("record", path))


def assignment(path: ColumnOrName) -> Column:
    """struct(scope, log_number): repair_event with exactly one valid log prefix among the path's parts, unit_level without any, else unresolved."""
    parts = F.split(F.translate(text(path), "\\", "/"), "/")
    logs = F.array_distinct(F.filter(F.transform(parts, lambda p: F.regexp_extract(p, "^([0-9]{9})(?![0-9])", 1)), lambda s: s != ""))
    one = F.get(logs, F.lit(0))
    scope = first_match([("unit_level", F.size(logs) == 0), ("unresolved", F.size(logs) > 1), ("repair_event", log_date(one).isNotNull())], "unresolved")
    return F.struct(scope.alias("scope"), F.when(F.size(logs) == 1, one).alias("log_number"))


def evidence_role(path: ColumnOrName) -> Column:
    """Role of an evidence file: system metadata, the form, then by wording, then by extension."""
    name, e = F.lower(filename(path)), extension(path)
    rules = [("system_metadata", is_system_path(path)), ("traveler", name.rlike(r"^[0-9]{9}\s+(?:line\s*card|traveler)"))]
    rules += [(role, contains_any(name, words)) for role, words in _WORDING.items()]
    rules += [(role, e.isin(*kinds)) for role, kinds in _BY_EXTENSION.items()]
    return first_match([*rules, ("technical_file", e != "")], "unknown")


def is_warranty(path: ColumnOrName) -> Column:
    return F.lower(filename(path)).rlike(r"\bwarranty\b")


def display_statement(c: ColumnOrName, longest: int = 520) -> Column:
    """A statement without its recurrence counts."""
    count = r"[0-9]+\s+(?:distinct\s+)?serials?\s*(?:and|/|,)?\s*[0-9]+\s+(?:repair\s+)?logs?"
    s = F.substring(compact(c), 1, longest)
    s = F.regexp_replace(s, rf"(?i)\s*[(\[]\s*{count}\s*[)\]]", "")
    s = F.regexp_replace(s, rf"(?i)\b(?:(?:seen|observed|covering|across)\s+)*(?:approximately\s+)?{count}\b", "")
    s = F.regexp_replace(F.regexp_replace(s, r"\s+([,.;:])", "$1"), r"\s{2,}", " ")
    return F.regexp_replace(s, r"^[ \-;,.]+|[ \-;,.]+$", "")
