import hashlib
import itertools
import random
import re
import zlib

from factloom.llm import conversations

SCHEMA = "conv_id long, turn long, role string, text string"


def damaged(rows):
    out = []
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(c, t, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def flags(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        s = text.strip(" \t\n\v\f\r")
        out.append("blank" if not s else "duplicate" if (role, text) in seen else "" if s[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def play(rows, fault, edits):
    """Cost and lines of an audit, None if it is not allowed."""
    cost, at, roles, lines = 0, 0, "", []
    for e in edits:
        want = "assistant" if roles.endswith("u") else "user"
        if e == "I":
            cost, roles = cost + 2, roles + want[0]
            lines.append(want + ":")
            continue
        _, _, role, text = rows[at]
        f = fault[at]
        at += 1
        if e == "D":
            cost += 3
            continue
        if f in ("blank", "duplicate"):
            return None
        cost += (f == "truncated") + 2 * (e == "R")
        role = want if e == "R" else role
        roles += role[:1] or "?"
        lines.append(f"{role}:{text}")
    return (cost, "".join(edits), lines) if re.fullmatch("(s?(ua)+)?", roles) else None


def brute(rows):
    """By trying every audit with at most two inserts in a gap."""
    fault = flags(rows)
    gaps = itertools.product(["", "I", "II"], repeat=len(rows) + 1)
    best = None
    for g in gaps:
        for edits in itertools.product("DKR", repeat=len(rows)):
            got = play(rows, fault, "".join(a + b for a, b in zip(g, (*edits, ""), strict=True)))
            if got and (best is None or got[:2] < best[:2]):
                best = got
    turns = [t for _, t, _, _ in rows if t is not None]
    initials = [r[2][:1] for r in rows]
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(fault.count(k) for k in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials)), best[0], best[1], hashlib.sha256("\n".join(best[2]).encode()).hexdigest())


def expected(rows):
    key = lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode())
    return sorted(((c, *brute(sorted((r for r in damaged(rows) if r[0] == c), key=key))) for c in {r[0] for r in rows}), key=str)


def test_repair_equals_trying_every_audit(spark):
    rng, rows = random.Random(3), []
    for c in range(60):
        for t in range(rng.randint(1, 4)):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", None, "u", ""])
            rows.append((c, rng.choice([t, t, t + 3, None]), role, rng.choice(["Yes.", "No!", "Well", "So? \n", " \t", "", None, "Größe.", "Yes."])))
    rows += [(None, 1, "user", "Who?"), (None, None, "assistant", "I.")]
    df = spark.createDataFrame([(*r, True, 1) for r in rows], SCHEMA + ", live boolean, place int").repartition(5)
    out = conversations.repair_digest(df)
    assert out.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    got = sorted((tuple(r) for r in out.collect()), key=str)
    assert got == expected(rows)
    assert {"D", "I", "K", "R"} <= set("".join(r[7] for r in got))


def test_conversation_without_rows_left_and_empty_table(spark):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    out = conversations.repair_digest(spark.createDataFrame([(gone, 0, "user", "Hm.")], SCHEMA)).collect()
    assert [tuple(r) for r in out] == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert conversations.repair_digest(spark.createDataFrame([], SCHEMA)).count() == 0


def test_long_conversation_keeps_all_its_turns(spark):
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"turn {t} " + "word " * 2000 + ".", True) for t in range(600)]
    got = conversations.repair(spark.createDataFrame(rows, SCHEMA + ", live boolean")).collect()
    assert len(got) == 1 and got[0]["audit"] == "K" * 600 and got[0]["cost"] == 0 and got[0]["lines"] == [f"{r[2]}:{r[3]}" for r in rows]
