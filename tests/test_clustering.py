import random
import threading
from collections import Counter, defaultdict
from pathlib import Path

import pytest

from factloom.operators import clustering
from factloom.sources.ledger import write_json
from factloom.sources.versions import Conflict, Stages, VersionedTable

WORDS = "fuse relay motor cable board screw panel drive".split()


def items(n=120):
    rng = random.Random(9)
    return [(rng.choice(["repairs", "tests"]), i, f"{rng.choice(['replaced', 'cleaned'])} {rng.choice(WORDS)} {rng.choice(['left', 'right', ''])}".strip(), f"log{i % 7}") for i in range(n)]


def by_word(batch):
    groups = defaultdict(list)
    for row in batch:
        groups[row["raw"].split()[1]].append(row["id"])
    out = [{"label": w, "key": w, "members": m} for w, m in groups.items() if w != "screw"]  # screws are left out
    return out + [{"label": "again", "members": [*groups["fuse"], "nobody"]}, "no group"]


def by_initial(batch):
    groups = defaultdict(list)
    for row in batch:
        groups[row["key"][:1]].append(row["id"])
    return [{"label": f"{k} things", "key": f"{k} things", "members": m} for k, m in groups.items()] + [{"label": "bad", "members": [batch[0]["id"], "nobody"]}]


def partition(pairs):
    sets = defaultdict(set)
    for c, m in pairs:
        sets[c].add(m)
    return {frozenset(s) for s in sets.values()}


def plain(rows):
    """The fixpoint in plain Python, all clusters of a lane in one batch."""
    clusters = defaultdict(set)
    for lane, i, raw, _ in rows:
        word = raw.split()[1]
        key = raw.replace(" ", "_") if word == "screw" else word  # singles are keyed by their text and meet by equal keys
        clusters[lane, key].add(str(i))
    merged = defaultdict(set)
    for (lane, key), m in clusters.items():
        merged[lane, key[:1]] |= m
    return {frozenset(s) for s in merged.values()}


@pytest.mark.parametrize("budget", [300, 22_000])
def test_fixpoint_equals_plain_form(spark, tmp_path, budget):
    rows = items()
    df = spark.createDataFrame(rows, "lane string, id long, raw string, log string").repartition(4)
    clusters, members, rounds = clustering.cluster(df, by_word, by_initial, f"file://{tmp_path}/run", budget=budget, rounds=12)
    pairs = [(r["cluster_id"], r["member"]) for r in members.collect()]
    assert Counter(m for _, m in pairs) == Counter(str(r[1]) for r in rows)
    assert {c for c, _ in pairs} == {r["cluster_id"] for r in clusters.collect()}
    assert rounds[-1]["merges"] == 0 and rounds[0]["clusters_before"] > rounds[-1]["clusters_after"]
    if budget == 22_000:
        assert partition(pairs) == plain(rows)
    else:  # neighbours across the borders of batches have merged as well; no cluster mixes initials
        lanes = {str(i): (lane, raw.split()[1]) for lane, i, raw, _ in rows}
        assert all(len({lanes[m][0] for m in s}) == 1 for s in partition(pairs))


def test_interrupted_run_goes_on_at_its_round(spark, tmp_path):
    df = spark.createDataFrame(items(60), "lane string, id long, raw string, log string")
    calls, broken = Path(tmp_path, "calls"), Path(tmp_path, "broken")
    broken.touch()

    def first(batch, calls=str(calls)):
        with open(calls, "a") as f:
            f.write("first\n")
        return by_word(batch)

    def merge(batch, broken=str(broken)):
        if Path(broken).exists():
            raise KeyboardInterrupt("the model's machine is gone")
        return by_initial(batch)

    run = lambda: clustering.cluster(df, first, merge, f"file://{tmp_path}/run", settings="1")
    with pytest.raises(Exception, match="machine is gone|Python worker|died"):
        run()
    asked = calls.read_text()
    broken.unlink()
    _, members, _ = run()
    assert calls.read_text() == asked  # no item is proposed twice
    assert partition((r["cluster_id"], r["member"]) for r in members.collect()) == plain(items(60))


def test_failed_batches_and_rejections(spark):
    df = spark.createDataFrame([("l", 0, i, f"text {i}", "1") for i in range(4)], "lane string, batch long, id long, raw string, log string")

    def fails(batch):
        raise ValueError("not JSON")

    clusters, members = clustering.valid_groups(clustering.propose(df, fails), df)
    assert clusters.count() == members.count() == 4
    proposed = clustering.propose(df, lambda batch: [{"members": [0, 1, "x"]}, {"label": " Two\n words ", "members": [1, 2]}])
    clusters, members = clustering.valid_groups(proposed, df)
    assert partition((r["cluster_id"], r["member"]) for r in members.collect()) == {frozenset("01"), frozenset("2"), frozenset("3")}
    assert {(r["label"], r["key"]) for r in clusters.collect()} == {("text 0", "text_0"), ("Two words", "two_words"), ("text 3", "text_3")}
    assert {(r["member"], r["reason"]) for r in clustering.rejected_members(proposed, df).collect()} == {("x", "unknown"), ("1", "assigned")}
    merges = clustering.valid_merges(clustering.propose(df, lambda batch: [{"members": [0, "x"]}, {"members": [3]}, {"members": [1, 2]}]), df.withColumn("id", df["id"].cast("string")))
    assert {r["member"] for r in merges.collect()} == {"1", "2"}
    none = df.limit(0)
    assert clustering.valid_groups(clustering.propose(none, fails), none)[0].count() == 0


def test_generic_and_short_keys_do_not_merge(spark):
    clusters = spark.createDataFrame([("a", "l", "A", "test"), ("b", "l", "B", "test"), ("c", "l", "C", "fan"), ("d", "l", "D", "fan"), ("e", "l", "E", "motor"), ("f", "l", "E", "motor"), ("g", "m", "G", "motor")], "cluster_id string, lane string, label string, key string")
    members = spark.createDataFrame([(c, f"m{c}") for c in "abcdefg"], "cluster_id string, member string")
    new, moved = clustering.merge_by_key(clusters, members)
    assert partition((r["cluster_id"], r["member"]) for r in moved.collect()) == {frozenset({f"m{c}"}) for c in "abcdg"} | {frozenset({"me", "mf"})}
    assert sorted((r["label"], r["key"]) for r in new.collect()) == [("A", "test"), ("B", "test"), ("C", "fan"), ("D", "fan"), ("E", "motor"), ("G", "motor")]


def test_batches_keep_to_their_budget(spark):
    rng = random.Random(1)
    rows = [("big" if i % 4 else "small", i, rng.randint(1, 30)) for i in range(400)]
    got = clustering.fill_batches(spark.createDataFrame(rows, "lane string, id long, size int").repartition(7), "lane", ["id"], "size", 100).collect()
    sizes, last = Counter(), {}
    for lane, i, n in sorted((r["lane"], r["id"], r["batch"]) for r in got):
        sizes[lane, n] += next(s for _, k, s in rows if k == i)
        assert n >= last.get(lane, 0)
        last[lane] = n
    assert len(got) == 400 and max(sizes.values()) <= 130


def test_families_and_descriptors(spark, tmp_path):
    rows = [("ic", 1, "timer chip", "a"), ("ic", 2, "timer chip b", "a"), ("other", 3, "timer module", "b"), ("other", 4, "knob", "b")]
    df = spark.createDataFrame(rows, "lane string, id long, raw string, log string")
    first_word = lambda batch: [{"label": w, "members": [r["id"] for r in batch if r["raw"].startswith(w)]} for w in ("timer", "knob")]
    merge = lambda batch: [{"label": "timers", "members": [r["id"] for r in batch if r["label"] == "timer"]}]
    got = clustering.families(df, first_word, merge, f"file://{tmp_path}/f").collect()
    assert partition((r["family_id"], r["member"]) for r in got) == {frozenset("123"), frozenset("4")}
    assert {r["label"] for r in got} == {"timers", "knob"} and all(r["family_id"].startswith("ff_") for r in got)
    pairs = spark.createDataFrame([(1, 2), (2, 3)], "a long, b long")
    out = clustering.normalized_descriptors(df, pairs, lambda batch: [{"members": [r["id"] for r in batch if r["id"] != "3"]}]).collect()
    assert partition((r["family_id"], r["member"]) for r in out) == {frozenset("12"), frozenset("3"), frozenset("4")}


def test_families_reach_over_the_batches_of_the_merge(spark, tmp_path):
    rows = [(f"brand {i % 12}", i, f"{'red' if i % 2 else 'old'} {WORDS[i % 7]}", "a") for i in range(168)]
    df = spark.createDataFrame(rows, "lane string, id long, raw string, log string")
    word = lambda name: lambda batch: [{"label": w, "key": w, "members": [r["id"] for r in batch if r[name].split()[-1] == w]} for w in dict.fromkeys(r[name].split()[-1] for r in batch)]
    got = clustering.families(df, word("raw"), word("label"), f"file://{tmp_path}/f", most=8).collect()  # 84 groups in batches of eight
    assert partition((r["family_id"], r["member"]) for r in got) == {frozenset(str(i) for i in range(k, 168, 7)) for k in range(7)}


def test_readers_never_meet_a_gap(spark, tmp_path):
    table = VersionedTable(spark, f"file://{tmp_path}/t")
    assert table.read() is None and table.current() == 0
    table.commit(spark.range(10))
    faults, stop = [], threading.Event()

    def reader():
        while not stop.is_set():
            try:
                n = VersionedTable(spark, f"file://{tmp_path}/t").read().count()
                if n % 10:
                    faults.append(n)
            except Exception as e:  # noqa: BLE001
                faults.append(e)

    t = threading.Thread(target=reader)
    t.start()
    for k in range(2, 8):
        table.commit(spark.range(10 * k))
    stop.set()
    t.join()
    assert not faults and table.current() == 7 and table.read(3).count() == 30
    assert table.vacuum(2) == 5 and table.versions() == [6, 7] and table.read().count() == 70


def test_second_writer_is_refused(spark, tmp_path):
    table = VersionedTable(spark, f"file://{tmp_path}/t")
    table.commit(spark.range(3), 0)
    with pytest.raises(Conflict):
        table.commit(spark.range(4), 0)
    assert table.read().count() == 3 and len([p for p in Path(tmp_path, "t").iterdir() if p.name.startswith("data-")]) == 1
    assert table.update(lambda old: old.unionByName(spark.range(2))) == 2 and table.read().count() == 5


def test_exclusive_file_lost_at_the_last_moment(spark, tmp_path, monkeypatch):
    path = f"file://{tmp_path}/x.json"
    assert write_json(spark, path, {"a": 1}, replace=False)

    class Blind:  # says that there is no file, as when another writer is between the test and the rename
        def __init__(self, fs):
            self.fs = fs

        def exists(self, p):
            return False

        def __getattr__(self, name):
            return getattr(self.fs, name)

    from factloom.sources import ledger

    real = ledger.filesystem
    monkeypatch.setattr(ledger, "filesystem", lambda s, p: (Blind(real(s, p)[0]), real(s, p)[1]))
    assert write_json(spark, path, {"a": 2}, replace=False) is False
    assert [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["x.json"]


def test_stages_are_made_once(spark, tmp_path):
    made = []
    stages = Stages(spark, f"file://{tmp_path}/s", "k")
    for _ in range(2):
        assert stages.table("one", lambda: made.append(1) or spark.range(4)).count() == 4
    again = Stages(spark, f"file://{tmp_path}/s", "k")
    assert again.table("one", lambda: spark.range(9)).count() == 4 and made == [1] and again.computed == []
