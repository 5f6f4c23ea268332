"""Verdicts replayed over edges that moved; archives laid down in any order of arrival, as a table and as a stream."""

import datetime
import random

import pytest

from spoor.operators import changes
from spoor.streaming import events

D = datetime.date
EDGE = "family string, key string, stable string, number string, lineage date, route string"
SAID = "family string, key string, stable string, sheet string, day date, good boolean, number string, lineage date, route string"
LINE, OTHER = D(2010, 1, 1), D(2020, 1, 1)


def statuses(spark, judged, edges):
    rows = changes.replay_moved(spark.createDataFrame(judged, SAID), spark.createDataFrame(edges, EDGE), ["by_mention"]).collect()
    return {(r["key"], r["sheet"]): (r["status"], r["n"]) for r in rows}


@pytest.fixture(scope="module")
def found(spark):
    edges = [
        ("f", "held", "s0", "L1", LINE, None), ("f", "moved", "s0", "L2", LINE, None), ("by_mention", "moved2", "s0", "L2", LINE, None), ("f", "lineage", "s0", "L1", OTHER, None),
        ("f", "two", "s0", "L1", OTHER, None), ("f", "two", "s0", "L1", LINE, None), ("f", "back", "s0", "L1", LINE, None), ("f", "route", "s0", "L1", LINE, "whole"), ("f", "route2", "s0", "L1", LINE, "named"),
        ("f", "slid-now", "steady", "L1", LINE, None), ("other", "family", "s9", "L1", LINE, None), ("f", None, None, "L1", LINE, None), ("f", "twice", "s0", "L1", LINE, None),
    ]
    v = lambda key, good=True, stable=None, sheet="a", day=D(2024, 1, 1), lineage=LINE, route=None, family="f": (family, key, stable, sheet, day, good, "L1", lineage, route)
    judged = [
        v("held"), v("moved"), v("moved2", family="by_mention"), v("lineage"), v("two", False), v("back", False, lineage=None), v("route", False, route="named"), v("route2", False, route="named"), v("slid-then", stable="steady"),
        v("family", stable="s9"), v("gone", False), v("gone2"), v("gone2"), v(None, stable=None), v("none", None), v("twice", False, sheet="a"), v("twice", True, sheet="b"), v("late", True, sheet="z", day=D(2023, 1, 1)), v("late", False, sheet="a"),
    ]
    return statuses(spark, judged, edges)


@pytest.mark.parametrize("key, sheet, want", [
    ("held", "a", "held"), ("moved", "a", "moved"), ("moved2", "a", "held"), ("lineage", "a", "other_lineage"), ("two", "a", "returned"), ("back", "a", "returned"), ("route", "a", "other_route"), ("route2", "a", "returned"),
    ("slid-then", "a", "held"), ("family", "a", "lost"), ("gone", "a", "absent"), ("gone2", "a", "lost"), (None, "a", "lost"), ("twice", "a", "judged_elsewhere"), ("twice", "b", "held"), ("late", "z", "judged_elsewhere"), ("late", "a", "absent"),
])
def test_statuses(found, key, sheet, want):
    assert found[(key, sheet)] == (want, 2 if key == "gone2" else 1) and ("none", "a") not in found


def test_nothing_judged_and_nothing_there(spark):
    assert statuses(spark, [], []) == {}
    assert statuses(spark, [("f", "k", "s", "a", D(2024, 1, 1), True, "L1", None, None)], []) == {("k", "a"): ("lost", 1)}


NAMES = dict(fonds="fonds", key="key", stamp="stamp", full="full", deleted="deleted")
SCHEMA = "fonds string, key string, stamp int, full boolean, deleted boolean, body string"


def laid_down(rows):
    """By date: the newest full archive, then each later increment over it, its deletions last."""
    state = {}
    for fonds in {r[0] for r in rows}:
        fulls = [r[2] for r in rows if r[0] == fonds and r[3]]
        if not fulls:
            continue
        held = {r[1]: r[5] for r in rows if r[0] == fonds and r[3] and r[2] == max(fulls) and r[1] is not None}
        for stamp in sorted({r[2] for r in rows if r[0] == fonds and not r[3] and r[2] > max(fulls)}):
            now = [r for r in rows if r[0] == fonds and r[2] == stamp and not r[3] and r[1] is not None]
            held.update({r[1]: r[5] for r in now if not r[4]})
            for r in now:
                if r[4]:
                    held.pop(r[1], None)
        state.update({(fonds, k): b for k, b in held.items()})
    return state


def archives(seed):
    rng, rows = random.Random(seed), []
    for fonds in "abc":
        for stamp in rng.sample(range(20), 7):
            full = fonds != "c" and rng.random() < 0.4
            rows += [(fonds, f"k{k}", stamp, full, not full and rng.random() < 0.3, f"{fonds}{stamp}{k}") for k in rng.sample(range(8), rng.randrange(1, 6))]
            rows += [(fonds, None, stamp, full, None, None)] * rng.randrange(2)
    return rows


@pytest.mark.parametrize("rows", [archives(1), archives(2), [], [("a", "k", 1, True, False, "x"), ("a", None, 2, True, None, None)], [("a", "k", 1, True, False, "x"), ("a", "k", 3, False, False, "y"), ("a", "k", 3, False, True, None)]])
def test_archives_as_a_table(spark, rows):
    found = changes.deployed(spark.createDataFrame(rows, SCHEMA), **NAMES).collect()
    assert {(r["fonds"], r["key"]): r["body"] for r in found} == laid_down(rows) and len(found) == len(laid_down(rows))


def test_an_older_full_archive_is_known_though_its_members_changed(spark):
    rows = [("a", "k", 1, True, False, "x"), ("a", "k", 4, False, False, "y"), ("a", "n", 2, False, False, "z"), ("a", "o", 0, False, False, "w")]
    assert {(r["fonds"], r["key"]): r["body"] for r in changes.deployed(spark.createDataFrame(rows, SCHEMA), **NAMES).collect()} == laid_down(rows) == {("a", "k"): "y", ("a", "n"): "z"}


def test_archives_as_a_stream_out_of_order(spark, tmp_path):
    rows = archives(3) + [("d", "k", 1, True, False, "x"), ("d", "k", 4, False, False, "y"), ("d", "n", 2, False, False, "z")]
    kinds = sorted({(r[0], r[2]) for r in rows})
    random.Random(5).shuffle(kinds)
    for part in range(5):
        mine = [r for r in rows if kinds.index((r[0], r[2])) % 5 == part]
        spark.createDataFrame(mine, SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        run = events.deploy_archives(spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/in"), f"{tmp_path}/state", f"{tmp_path}/checkpoint", every=2, **NAMES)
        run.awaitTermination()
    last = max(p["batchId"] for p in run.recentProgress)
    found = events.archives_standing(spark, f"{tmp_path}/state", last, every=2, **NAMES).collect()
    assert {(r["fonds"], r["key"]): r["body"] for r in found} == laid_down(rows)


def test_journal_of_archives(spark):
    rows = archives(4)
    found = {(r["fonds"], r["stamp"]): r for r in changes.archive_journal(spark.createDataFrame(rows, SCHEMA), **NAMES).collect()}
    again = {(r["fonds"], r["stamp"]): r["hash"] for r in changes.archive_journal(spark.createDataFrame(rows[::-1], SCHEMA).repartition(3), **NAMES).collect()}
    assert {k: r["hash"] for k, r in found.items()} == again and len(set(again.values())) == len(again)
    for (fonds, stamp), r in found.items():
        mine = [x for x in rows if x[0] == fonds and x[2] == stamp and x[1] is not None]
        newest = max([x[2] for x in rows if x[0] == fonds and x[3]], default=None)
        assert (r["members"], r["deletions"]) == (sum(not x[4] for x in mine), sum(bool(x[4]) for x in mine))
        assert r["applied"] == (newest is not None and (stamp > newest or (r["full"] and stamp == newest)))
