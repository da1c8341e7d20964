from collections import Counter
from pathlib import Path

import pytest

from factloom.operators import grammar
from factloom.sources.acquire import Acquisition

NAMES = {
    "RBT - QX8-MT ACMEBOT SN 80050608 NORTH LABS NLV ROBIN": ("RBT", "QX8-MT", "ACMEBOT", "80050608", "NORTH LABS", "NLV", "Plant V", "ROBIN", "high", 0),
    " rbt  -  qx8  acmebot sn 8 acme  robin ": ("RBT", "qx8", "ACMEBOT", "8", "acme", None, None, "ROBIN", "medium", 1),
    "RBT - QX8 ACMEBOT SN 8 ACME NLV": ("RBT", "QX8", "ACMEBOT", "8", "ACME", "NLV", "Plant V", None, "medium", 1),
    "RBT - ACMEBOT SN 8 ROBIN": ("RBT", None, "ACMEBOT", "8", None, None, None, "ROBIN", "low", 2),
    "RBT - QX8 ACMEBOT 80050608": ("RBT", "QX8", "ACMEBOT", None, None, None, None, None, "low", 1),
    "RBT - QX8 ACMEBOT SN": ("RBT", "QX8", "ACMEBOT", None, None, None, None, None, "low", 1),
    "RBT - QX8 OTHER SN 8 ACME": ("RBT", None, None, None, None, None, None, None, "low", 1),
    "RBT QX8 ACMEBOT SN 8": (None, None, None, None, None, None, None, None, "low", 1),
    "A - B - C ACMEBOT SN SN x NLV NLV ROBIN ROBIN": ("A", "B - C", "ACMEBOT", "SN", "x NLV NLV ROBIN", None, None, "ROBIN", "medium", 1),
    "": (None, None, None, None, None, None, None, None, "low", 1), None: (None, None, None, None, None, None, None, None, "low", 1),
}


def test_folder_names(spark):
    refs = grammar.reference_table(spark, ["acmebot"], ["Robin"], {"NLV": "Plant V"})
    rows = spark.createDataFrame([(i, n, "clash") for i, n in enumerate(NAMES)], "k int, n string, oem string").repartition(3)
    got = {r["k"]: (*tuple(r)[1:-1], len(r["notes"])) for r in grammar.parse_folder_names(rows, "k", "n", refs).collect()}
    assert got == dict(enumerate(NAMES.values()))
    assert grammar.parse_folder_names(rows.limit(0), "k", "n", refs).count() == 0
    assert {r["oem"] for r in grammar.parse_folder_names(rows, "k", "n", refs.limit(0)).collect()} == {None}


def asked(folder):
    return Counter(Path(folder, "calls").read_text().split()) if Path(folder, "calls").exists() else Counter()


def provider(folder, fails=(), dies=None):
    calls, dead = str(Path(folder, "calls")), str(Path(folder, "dead"))

    def ask(row):
        if row["k"] == dies and not Path(dead).exists():
            Path(dead).touch()
            raise KeyboardInterrupt("killed")
        with open(calls, "a") as f:
            f.write(f"{row['k']}\n")
        if row["k"] in fails:
            raise ValueError("no answer")
        return f"{row['k']} at {row['attempt']}"

    return ask


def test_killed_run_repeats_no_finished_item(spark, tmp_path):
    items = spark.createDataFrame([(k, "x") for k in range(40)] + [(3, "x"), (None, "y")], "k long, status string")
    work = Acquisition(spark, f"file://{tmp_path}/a")
    ask = provider(tmp_path, dies=17)
    with pytest.raises(Exception, match="killed|Python worker|died"):
        for _ in range(2):  # the part of item 17 dies, wherever it is
            work.run(items, "k", ask, 4)
    done = {int(r["item"]) for r in work.results().collect()}
    before = asked(tmp_path)
    results = work.run(items, "k", ask, 4).collect()
    assert {int(r["item"]) for r in results} == set(range(40)) and all(r["status"] == "ok" and r["attempts"] == 1 for r in results)
    assert all(asked(tmp_path)[str(k)] == before[str(k)] == 1 for k in done) and done
    again = asked(tmp_path)
    work.run(items, "k", ask, 4)
    assert asked(tmp_path) == again


def test_failures_are_tried_again_and_end(spark, tmp_path):
    items = spark.createDataFrame([(k,) for k in range(6)], "k long")
    work = Acquisition(spark, f"file://{tmp_path}/a", tries=2)
    got = {r["item"]: (r["status"], r["attempts"], r["error"]) for r in work.run(items, "k", provider(tmp_path, fails=(2, 5)), 2).collect()}
    assert got["2"] == got["5"] == ("failed", 2, "ValueError: no answer") and got["0"] == ("ok", 1, None)
    assert asked(tmp_path)["2"] == 2 and asked(tmp_path)["0"] == 1
    assert work.pending(items, "k").count() == 0 and Acquisition(spark, f"file://{tmp_path}/b").results().count() == 0
    assert Acquisition(spark, f"file://{tmp_path}/b").run(items.limit(0), "k", provider(tmp_path)).count() == 0


def test_two_runs_at_once_commit_one_result(spark, tmp_path):
    items = spark.createDataFrame([(k,) for k in range(8)], "k long")
    one, two = (Acquisition(spark, f"file://{tmp_path}/a") for _ in range(2))
    pending = two.pending(items, "k")
    frozen = spark.createDataFrame(pending.collect(), pending.schema)  # what the second run saw before the first committed
    one.part(items, "k", lambda row: "first")
    before = [tuple(r) for r in one.results().orderBy("item").collect()]
    two.pending = lambda *_: frozen
    assert two.part(items, "k", lambda row: "second") == 2
    assert [tuple(r) for r in one.results().orderBy("item").collect()] == before
    assert {r["result"] for r in one.results().collect()} == {"first"} and one.attempts().count() == 16
