"""Repair of damaged conversations: the cheapest edits that restore the order of the turns.

``damage`` breaks rows by a hash of their key, for tests and for the registered query; ``repair`` takes any rows.

1. Windows of each conversation, all on one shuffle by its id, give every row its place (by turn, nulls first, then role and text), its first
   fault (blank, duplicate, truncated) and whether its role may follow the one before.
2. Each conversation's rows become one sorted array of structs, and ``aggregate`` folds it.  The state has four (cost, audit) structs, the cheapest edits that end with
   nothing, a system turn, a user turn or an assistant turn, each the native ``least`` of its ways; struct order is cost, then the audit in ASCII order.
   Two audits of equal cost are never one the beginning of the other (the rest would be inserts, which cost), so appending an edit keeps their order.
3. The cheapest accepted audit decides the repaired turns: the role that comes next follows from those before, so a second fold reads them off the audit.

A conversation is a row of the result, with a hash over its whole repaired text, and so is one task's; nothing else of a conversation is collected.  Conversations are spread by their ids.

Defined results: a null role or text is one space, a null id or turn in the damage's key as well; null ids are one conversation, reported with a null id; null turns stand first and do not count for
gaps; rows with equal turns stand in order of role and text; a repeated row is a duplicate; a role with another first letter than s, u or a can only be deleted or given a new role; a conversation without rows has
zeros, an empty audit and the hash of the empty text; texts of any length are read whole; an empty table gives an empty result; other columns, whatever their names, are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

WHITE = r"[\x20\x09-\x0D]"
#: Costs: a truncated row that stays, a changed role, an inserted turn, a deleted row.
UNFINISHED, REROLE, INSERT, DELETE = 1, 2, 2, 3
_BEYOND = 1 << 40


def damage(turns: DataFrame, kinds: int = 20) -> DataFrame:
    """(conv_id, turn, role, text, live): rows after the damage. A dropped row stays with ``live`` false, so that its conversation is still known."""
    spoken = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(spoken("conv_id"), F.lit(":"), spoken("turn")).cast("binary")) % kinds
    rows = turns.select("conv_id", "turn", spoken("role").alias("role"), spoken("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role"))
    times = F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("kind") != 0).alias("live"), times.alias("time")).drop("time")


def faults(turns: DataFrame) -> DataFrame:
    """``turns`` (conv_id, turn, role, text, live) with place, fault (null, blank, duplicate or truncated) and illegal (the role may not follow the one before)."""
    whole = Window.partitionBy("conv_id", "live").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    placed = turns.withColumn("place", F.row_number().over(whole))
    in_order = Window.partitionBy("conv_id", "live").orderBy("place")
    again = F.row_number().over(Window.partitionBy("conv_id", "live", "role", "text").orderBy("place")) > 1
    last = F.substring(F.rtrim(F.regexp_replace("text", WHITE, " ")), -1, 1)
    blank = F.length(last) == 0
    initial = F.substring("role", 1, 1)
    pair = F.concat(F.lag(initial).over(in_order), initial)
    fault = F.when(blank, F.lit("blank")).when(again, F.lit("duplicate")).when(~last.rlike("^[.!?]$"), F.lit("truncated"))
    return placed.withColumns({"fault": fault, "illegal": F.coalesce(~pair.isin("su", "ua", "au"), F.lit(False)), "initial": initial})


def _with(state: Column, cost: Column | int, edit: str) -> Column:
    return F.struct((state["cost"] + cost).cast("long").alias("cost"), F.concat(state["audit"], F.lit(edit)).alias("audit"))


def _inserted(s: Column) -> Column:
    """The four states after any inserts that help."""
    user = F.least(s["user"], _with(F.least(s["none"], s["system"], s["assistant"]), INSERT, "I"))
    assistant = F.least(s["assistant"], _with(user, INSERT, "I"))
    return F.struct(s["none"].alias("none"), s["system"].alias("system"), user.alias("user"), assistant.alias("assistant"))


def _let(value: Column, use) -> Column:
    """use(value), with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _edited(s: Column, row: Column) -> Column:
    """The four states after a row is kept, given a new role or deleted."""
    deleted = {k: _with(s[k], DELETE, "D") for k in ("none", "system", "user", "assistant")}
    late = F.when(row["fault"] == "truncated", UNFINISHED).otherwise(0)
    stays = F.coalesce(~row["fault"].isin("blank", "duplicate"), F.lit(True))

    def to(state: str, sources: list[str], rerole: bool) -> Column:
        best = F.least(*[s[x] for x in sources]) if len(sources) > 1 else s[sources[0]]
        keep = _with(best, late, "K")
        change = _with(best, late + REROLE, "R") if rerole else deleted[state]
        return F.when(~stays, deleted[state]).when(row["initial"] == state[0], F.least(deleted[state], keep)).otherwise(F.least(deleted[state], change)).alias(state)

    return F.struct(deleted["none"].alias("none"), to("system", ["none"], False), to("user", ["none", "system", "assistant"], True), to("assistant", ["user"], True))


def cheapest_edits(rows: Column) -> Column:
    """(cost, audit) of the cheapest edits of an array of structs with initial and fault that leave roles ``(s?(ua)+)?``, the audit ASCII-least among equal costs."""
    state = lambda cost: F.struct(F.lit(cost).cast("long").alias("cost"), F.lit("").alias("audit"))
    start = F.struct(state(0).alias("none"), *[state(_BEYOND).alias(k) for k in ("system", "user", "assistant")])
    folded = F.aggregate(rows, start, lambda s, row: _let(_inserted(s), lambda t: _edited(t, row)), lambda s: _let(_inserted(s), lambda t: F.least(t["none"], t["assistant"])))
    return folded


def repaired_turns(rows: Column, audit: Column) -> Column:
    """The lines ``role:text`` that the audit leaves of an array of structs with initial, role and text."""
    start = F.struct(F.lit(0).alias("at"), F.lit(True).alias("user"), F.array().cast("array<string>").alias("lines"))

    def step(s: Column, edit: Column) -> Column:
        row = F.get(rows, s["at"])
        role = F.when(s["user"], F.lit("user")).otherwise(F.lit("assistant"))
        line = F.when(edit == "I", F.concat(role, F.lit(":"))).when(edit == "K", F.concat(row["role"], F.lit(":"), row["text"])).when(edit == "R", F.concat(role, F.lit(":"), row["text"]))
        speaks = (edit != "D") & ~((edit == "K") & (row["initial"] == "s"))  # a system turn stands before the first user's
        lines = F.when(edit == "D", s["lines"]).otherwise(F.concat(s["lines"], F.array(line)))
        return F.struct((s["at"] + F.when(edit == "I", 0).otherwise(1)).alias("at"), (s["user"] != speaks).alias("user"), lines.alias("lines"))

    letters = F.transform(F.sequence(F.lit(1), F.length(audit)), lambda i: F.substr(audit, i, F.lit(1)))
    return F.aggregate(F.when(F.length(audit) > 0, letters).otherwise(F.array().cast("array<string>")), start, step, lambda s: s["lines"])


def repair(turns: DataFrame) -> DataFrame:
    """One row a conversation: gaps, the counts of faults, illegal steps, cost and audit of the cheapest edits, and the repaired lines.

    turns: conv_id, turn, role, text and live; rows that are not live only name their conversation.
    """
    live = F.col("live")
    count = lambda c: F.count(F.when(live & c, True))
    row = F.struct("place", "initial", "fault", "role", "text")
    turn = F.when(live, F.col("turn"))
    gathered = faults(turns.repartition("conv_id")).groupBy("conv_id").agg(
        F.coalesce(F.max(turn) - F.min(turn) + 1 - F.count_distinct(turn), F.lit(0)).cast("long").alias("gaps"),
        *[count(F.col("fault") == k).alias(k) for k in ("blank", "duplicate", "truncated")],
        count(F.col("illegal")).alias("illegal"),
        F.array_sort(F.collect_list(F.when(live, row))).alias("rows"),
    )
    edits = gathered.withColumn("edits", cheapest_edits(F.col("rows")))
    return edits.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", F.col("edits.cost").alias("cost"), F.col("edits.audit").alias("audit"), repaired_turns(F.col("rows"), F.col("edits.audit")).alias("lines"))


def repair_digest(turns: DataFrame) -> DataFrame:
    """The repair of damaged ``turns``, with sha256 of the repaired lines in place of them."""
    return repair(damage(turns)).withColumn("repaired_sha256", F.sha2(F.concat_ws("\n", "lines").cast("binary"), 256)).drop("lines")


def _sql_edit(state: str, cost: str, edit: str, line: str | None = None) -> str:
    """A state after an edit: its key is the cost in nine digits and the audit, r its lines."""
    return f"{{'k': lpad(CAST(CAST(left({state}.k, 9) AS BIGINT) + {cost} AS VARCHAR), 9, '0') || {state}.k[10:] || '{edit}', 'r': {state}.r" + (f" || [{line}]}}" if line else "}")


def _sql_row(state: str, source: str, new_role: str | None) -> str:
    """A state after a row: deleted, kept if its role fits, else given a new role."""
    deleted = _sql_edit(state, "3", "D")
    keep = _sql_edit(source, "late", "K", "role || ':' || text")
    change = f"least({deleted}, {_sql_edit(source, 'late + 2', 'R', new_role + ' || text')})" if new_role else deleted
    return f"CASE WHEN NOT stays THEN {deleted} WHEN initial = '{state}' THEN least({deleted}, {keep}) ELSE {change} END AS {state}"


#: SQL of repair_digest(). The fold is a recursion over the places; a state's text is its cost in nine digits and its audit.
SQL = rf"""
WITH RECURSIVE crc_table AS (SELECT list_transform(range(256), lambda n: list_reduce([n] || list_transform(range(8), lambda z: 0), lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab),
keyed AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, hex(encode(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))) AS x FROM conversations),
hashed AS (
  SELECT *, xor(list_reduce([4294967295] || list_transform(range(CAST(length(x) // 2 AS BIGINT)), lambda i: CAST('0x' || x[2 * i + 1 : 2 * i + 2] AS BIGINT)), lambda c, y: xor(c >> 8, tab[(xor(c, y) & 255) + 1])), 4294967295) % 20 AS kind
  FROM keyed, crc_table),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM hashed, (VALUES (1), (2)) t(time) WHERE kind <> 0 AND (time = 1 OR kind = 3)),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place FROM damaged),
flagged AS (
  SELECT conv_id, turn, role, text, place, left(role, 1) AS initial, coalesce(lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY place) || left(role, 1) NOT IN ('su', 'ua', 'au'), false) AS illegal,
    CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1 THEN 'duplicate'
      WHEN regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
  FROM placed),
convs AS (SELECT DISTINCT conv_id FROM conversations),
states AS (
  SELECT conv_id, 0 AS place, {{'k': '000000000', 'r': ['']}} AS n, {{'k': '900000000', 'r': ['']}} AS s, {{'k': '000000002I', 'r': ['', 'user:']}} AS u, {{'k': '000000004II', 'r': ['', 'user:', 'assistant:']}} AS a FROM convs
  UNION ALL
  SELECT conv_id, place, n, s, u, least(a, {_sql_edit("u", "2", "I", "'assistant:'")}) FROM (
    SELECT conv_id, place, n, s, least(u, {_sql_edit("b", "2", "I", "'user:'")}) AS u, a FROM (
      SELECT *, least(n, s, a) AS b FROM (
        SELECT conv_id, place, {_sql_edit("n", "3", "D")} AS n, {_sql_row("s", "n", None)}, {_sql_row("u", "b", "'user:'")}, {_sql_row("a", "u", "'assistant:'")}
        FROM (
          SELECT p.conv_id, f.place, n, s, u, a, least(n, s, a) AS b, initial, role, text, fault NOT IN ('blank', 'duplicate') AS stays, CASE WHEN fault = 'truncated' THEN 1 ELSE 0 END AS late
          FROM states p JOIN flagged f ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.place = p.place + 1))))),
ends AS (SELECT conv_id, arg_max(least(n, a), place) AS e FROM states GROUP BY conv_id),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (illegal) AS illegal FROM flagged GROUP BY conv_id)
SELECT e.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  CAST(left(e.k, 9) AS BIGINT) AS cost, e.k[10:] AS audit, sha256(array_to_string(e.r[2:], chr(10))) AS repaired_sha256
FROM ends e LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM e.conv_id
"""
