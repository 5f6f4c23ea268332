"""Routes that document an article, on a graph small enough to follow by hand; marks on cycles and seeds without bits."""

import random

import pytest
from pyspark.sql import functions as F

from spoor.operators import routes
from spoor.operators.closure import spread_marks

def when():
    """The day, and which versions never had effect."""
    return F.lit("2020-01-01").cast("date"), F.expr("state = 'void'")


#: L1 became L2 and then L3; R4 stands alone; L5 was taken from one lineage (50) by another (5); D6 was repealed.
ARTICLES = [(1, "L1", 1), (2, "L2", 1), (3, "L3", 1), (4, "R4", 1), (5, "L5", 2), (50, "L5", 1), (6, "D6", 1), (7, "Annexe à l'article R. 7", 1), (8, "préliminaire", 1)]
VERSIONS = [(10 * a, a, "2000-01-01", "2010-01-01", "ok") for a, _, _ in ARTICLES] + [(10 * a + 1, a, "2010-01-01", "2015-01-01" if a in (1, 2, 6) else None, "ok") for a, _, _ in ARTICLES] + [(999, 4, "2019-01-01", None, "void")]


def graph(spark, produced=(), carried=(), aims=(), articles=ARTICLES, versions=VERSIONS, segments=((311, 31), (300, 30), (200, 20), (411, 41))):
    df = lambda rows, schema: spark.createDataFrame(list(rows), schema)
    dates = df(versions, "version long, article long, start string, end string, state string").withColumns({"start": F.to_date("start"), "end": F.to_date("end")})
    return routes.Graph(
        df(articles, "article long, number string, lineage int"), dates, df(segments, "segment long, version long"), df(produced, "version long, statute string, link string"),
        df([(2, 1), (3, 2)] if articles else [], "article long, former long"), df(carried, "segment long, source long"), df([("s", "d"), ("t", "e")], "statute string, dossier string"),
        df([("x", "d"), ("y", "e")], "text string, dossier string"), df(aims, "text string, bill_article string, article long, cited string"),
    )


def told(spark, g, motives=(), results=(), papers=(), citations=(), transposed=()):
    one = lambda rows, name, kind: spark.createDataFrame([(r,) for r in rows], f"{name} {kind}")
    found = routes.documented(g, one(motives, "article", "long"), one(results, "segment", "long"), one(papers, "dossier", "string"), one(citations, "segment", "long"), one(transposed, "statute", "string"), *when())
    every = found.collect()
    rows = {r["article"]: r for r in every}
    assert len(rows) == len(every)
    return {a: ([n for n in routes.ROUTES if r[n]], r["verdict"]) for a, r in rows.items()}, rows


def test_only_what_is_in_force_with_its_part(spark):
    found, rows = told(spark, graph(spark))
    assert sorted(found) == [3, 4, 5, 7, 8, 50]
    assert {a: r["part"] for a, r in rows.items()} == {3: "L", 4: "R", 5: "L", 50: "L", 7: "R", 8: None}
    assert set(v for _, v in found.values()) == {"undocumented"}


def test_passages_come_down_the_chain_of_renumberings_and_amendments_down_that_of_segments(spark):
    found, _ = told(spark, graph(spark, carried=[(311, 300), (300, 200)]), motives=[1], results=[200])
    assert found[3] == (["passage", "amendment"], "motivating_passage") and found[4][0] == []
    # An amendment stays with the article that holds the segment: nothing was carried, so article 2 keeps it to itself.
    assert told(spark, graph(spark), results=[200])[0][3][0] == []


@pytest.mark.parametrize("link, version, reached", [("modification", 30, True), ("creation", 30, False), ("creation", 10, True), ("modification", 10, True), ("creation", 20, False), ("repeal", 10, False)])
def test_a_creation_below_the_root_only_renumbers(spark, link, version, reached):
    found, _ = told(spark, graph(spark, produced=[(version, "s", link)]), papers=["d"])
    assert found[3] == ((["paper"], "statute_motivated") if reached else ([], "undocumented"))


def test_a_text_counts_where_its_dossier_wrote_the_article_that_it_aimed_at(spark):
    aims = [("x", "1", 1, "L1"), ("y", "2", 3, "L3"), ("x", "4", 50, "L5"), ("x", "9", 6, "D6")]
    g = graph(spark, produced=[(10, "s", "creation"), (31, "t", "repeal"), (500, "s", "creation")], aims=aims)
    rows = {(r["article"], r["bill_article"]): (r["direct"], r["survived"], r["dossier"], r["number"]) for r in routes.discussed(g, *when()).collect()}
    assert rows == {(3, "1"): (False, True, "d", "L3"), (3, "2"): (True, False, "e", "L3"), (50, "4"): (True, True, "d", "L5")}
    found, _ = told(spark, g)
    # A number stands for its current article: what was said of the older lineage of L5 goes to the newer one.
    assert found[3] == (["bill_article"], "situated_origin") and found[5][0] == ["bill_article"] and found[50][0] == []


def test_acts_are_cited_by_the_version_in_force_or_transposed_by_any_statute(spark):
    found, _ = told(spark, graph(spark, produced=[(10, "s", "creation"), (70, "t", "modification")]), citations=[300, 411], transposed=["t"])
    assert [found[a][0] for a in (3, 4, 7)] == [[], ["eu_act"], ["eu_act"]]


def test_empty_tables_and_silence(spark):
    assert told(spark, graph(spark, articles=[], versions=[], segments=[]))[0] == {}
    g = graph(spark)
    rows = routes.documented(g, spark.createDataFrame([(4,)], "article long"), *[spark.createDataFrame([], f"{n} {k}") for n, k in (("segment", "long"), ("dossier", "string"), ("segment", "long"), ("statute", "string"))], *when())
    assert {r["part"]: (r["articles"], r["undocumented"], r["silent_share"]) for r in routes.silence(rows).collect()} == {"L": (3, 3, 100.0), "R": (2, 1, 50.0), None: (1, 1, 100.0)}


def test_marks_pass_cycles_repeated_edges_and_nulls(spark):
    rng = random.Random(7)
    edges = [(rng.randrange(40), rng.randrange(40)) for _ in range(60)] + [(1, 2), (2, 1), (None, 3), (3, None)]
    seeds = [(rng.randrange(40), 1 << rng.randrange(4)) for _ in range(6)] + [(5, 0), (None, 1)]
    want = {n: 0 for n in range(40)}
    for n, m in seeds:
        if n is not None:
            want[n] |= m
    while True:
        after = dict(want)
        for a, b in edges:
            if a is not None and b is not None:
                after[b] |= after[a]
        if after == want:
            break
        want = after
    found = spread_marks(spark.createDataFrame(edges * 2, "src int, dst int"), spark.createDataFrame(seeds, "node int, marks int"))
    assert {r["node"]: r["marks"] for r in found.collect()} == {n: m for n, m in want.items() if m}
    assert spread_marks(spark.createDataFrame([], "src int, dst int"), spark.createDataFrame([], "node int, marks int")).collect() == []
