"""Highlights by ancestry, on articles small enough to follow by hand."""

from spoor.operators import highlights

SCHEMAS = {
    "shown": "version long", "segments": "segment long, version long, rank int", "versions": "version long, start string", "carried": "segment long, source long, share double",
    "produced": "version long, statute string, link string", "statutes": "statute string, date string", "results": "segment long, amendment string",
}
#: Segment 31 came from 21 and that from 11; 32 from 22 and from 12; 33 is new. Version 3 is shown.
BASE = {
    "shown": [(3,)], "segments": [(11, 1, 0), (12, 1, 1), (21, 2, 0), (22, 2, 1), (31, 3, 0), (32, 3, 1), (33, 3, 2)], "versions": [(1, "2000-01-01"), (2, "2005-01-01"), (3, "2010-01-01")],
    "carried": [(31, 21, 1.0), (21, 11, 0.9), (32, 22, 1.0)], "produced": [(1, "a", "creation"), (2, "b", "modification"), (3, "c", "repeal")],
    "statutes": [("a", "1999-01-01"), ("b", "2004-01-01"), ("c", "2009-01-01"), ("d", None)], "results": [(11, "A1"), (31, "A2"), (31, "A2"), (12, "A9")],
}


def told(spark, palette=10, **other):
    frames = {n: spark.createDataFrame(other.get(n, BASE[n]), s) for n, s in SCHEMAS.items()}
    found = highlights.highlighted(**frames, palette=palette)
    every = found.collect()
    rows = {(r["version"], r["segment"]): r for r in every}
    assert len(rows) == len(every)
    return {k: ([x["statute"] for x in r["introduced_by"]], r["colour"], r["ancestors"], r["touched"], r["amendments"], r["since"]) for k, r in rows.items()}, found


def test_the_earliest_ancestor_introduced_it(spark):
    rows, found = told(spark)
    assert rows == {
        (3, 31): (["a"], 0, 2, True, ["A1", "A2"], "2000-01-01"), (3, 32): (["b"], 1, 1, False, [], "2005-01-01"), (3, 33): ([], None, 0, False, [], "2010-01-01"),
    }
    assert sorted(map(tuple, highlights.legend(found).collect()), key=repr) == [(3, "a", 0, 1), (3, "b", 1, 1), (3, None, None, 1)]


def test_colours_go_by_time_and_begin_again(spark):
    made = [(1, "d", "creation"), (1, "a", None), (2, "b", "modification"), (3, "c", "modification"), (3, "c", "modification")]
    rows, _ = told(spark, palette=2, produced=made)
    # Without a date a statute comes last, though its name would come before.
    assert {k[1]: r[:2] for k, r in rows.items()} == {31: (["a", "d"], 0), 32: (["b"], 1), 33: (["c"], 0)}


def test_cycles_repeats_and_undated_versions(spark):
    carried = [(31, 21, 1.0), (31, 21, 1.0), (21, 31, 1.0), (31, None, 0.5), (None, 11, 0.5), (33, 12, None), (33, 22, 1.0)]
    rows, _ = told(spark, carried=carried, versions=[(1, None), (2, "2005-01-01"), (3, "2010-01-01")], segments=[*BASE["segments"], (31, 3, 0), (None, 3, 9)], shown=[(3,), (3,), (8,)], results=[(12, "A9"), (21, None)])
    assert {k[1]: r for k, r in rows.items()} == {31: (["b"], 0, 1, False, [], "2005-01-01"), 32: ([], None, 0, False, [], "2010-01-01"), 33: (["b"], 0, 2, False, ["A9"], "2005-01-01")}


def test_empty_tables(spark):
    assert told(spark, segments=[])[0] == {} and told(spark, shown=[])[0] == {}
    rows, _ = told(spark, carried=[], produced=[], results=[], versions=[])
    assert set(rows) == {(3, 31), (3, 32), (3, 33)} and set(map(repr, rows.values())) == {"([], None, 0, False, [], None)"}
