"""Micro-fixtures and properties of single operators."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spoor.functions import text as X
from spoor.operators import changes, classify, closure, constraints, edges, ranking, scan, sections, shingles, similarity, temporal
from spoor.operators.aggregates import wilson_lower
from spoor.operators.sampling import sha_sample

D = dt.date


def one(spark, expr):
    return spark.range(1).select(expr.alias("x")).first()["x"]


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_interval_choice(spark):
    intervals = spark.createDataFrame([("k", "A", D(2000, 1, 1), D(2010, 1, 1)), ("k", "B", D(2010, 1, 1), None)], "key string, name string, start date, end date")
    facts = spark.createDataFrame([("k", D(1999, 12, 31)), ("k", D(2009, 12, 31)), ("k", D(2010, 1, 1))], "key string, at date")
    found = temporal.asof_interval(facts, intervals, "key", "at", "start", "end", ["name"], how="left")
    assert rows(found.select("at", "name")) == [(D(1999, 12, 31), None), (D(2009, 12, 31), "A"), (D(2010, 1, 1), "B")]


def test_forward_asof_and_preference(spark):
    lineages = spark.createDataFrame([("k", 1, D(2010, 1, 1)), ("k", 2, None)], "key string, rank int, end date")
    facts = spark.createDataFrame([("k", "g", D(1990, 1, 1)), ("k", "g", D(2009, 12, 31)), ("k", "h", D(2099, 1, 1))], "key string, grp string, at date")
    assert [r[1] for r in rows(temporal.asof_forward(facts, lineages, "key", "at", "end", "rank").select("at", "rank"))] == [1, 1, 2]
    wrote = spark.createDataFrame([("k", "g", 2)], "key string, grp string, rank int")
    assert [r[1] for r in rows(temporal.asof_preferred(facts, lineages, wrote, "key", "grp", "at", "end", "rank").select("at", "rank"))] == [2, 2, 2]


def test_in_force_takes_the_latest_start(spark):
    versions = spark.createDataFrame([("a", 1, D(2001, 1, 1), None, "ok"), ("a", 2, D(2003, 1, 1), None, "ok"), ("a", 3, D(2003, 6, 1), None, "never")], "key string, id int, start date, end date, state string")
    found = temporal.in_force(versions, "key", "start", "end", F.lit("2004-01-01").cast("date"), ["id"], F.col("state") == "never")
    assert [r["id"] for r in found.collect()] == [2]


@pytest.mark.parametrize("second, ranks", [("wholly different words here", [1, 2]), ("cats dogs birds fish", [1, 1])])
def test_lineage_fold(spark, second, ranks):
    versions = spark.createDataFrame([("a", 1, "repealed", "cats dogs birds"), ("a", 2, "live", second)], "key string, n int, state string, text string")
    is_new = (F.col("ps") == "repealed") & (similarity.word_jaccard(F.col("text"), F.col("pt")) < 0.5)
    assert [r["lineage"] for r in temporal.lineage_rank(versions, "key", ["n"], is_new, {"ps": "state", "pt": "text"}).orderBy("n").collect()] == ranks


def test_dead_versions_attach_or_open(spark):
    living = spark.createDataFrame([("a", D(2001, 1, 1), 1, 1, "cats dogs birds")], "key string, day date, n int, lineage long, text string")
    dead = spark.createDataFrame([("a", D(2002, 1, 1), 5, "cats dogs birds"), ("a", D(2002, 1, 1), 6, "something else entirely")], "key string, day date, n int, text string")
    found = temporal.attach_dead(dead, living, "key", "day", "n", similarity.word_jaccard(F.col("dead_text"), F.col("living_text")), 0.5)
    assert {r["n"]: r["lineage"] for r in found.collect()} == {5: 1, 6: 2}


def test_membership_on_a_day_has_both_ends(spark):
    members = spark.createDataFrame([("x", D(2000, 1, 1), D(2001, 1, 1), "G1"), ("x", D(2001, 1, 1), None, "G2")], "actor string, b date, e date, grp string")
    facts = spark.createDataFrame([("x", D(2001, 1, 1)), ("x", D(2005, 1, 1)), ("x", D(1990, 1, 1))], "actor string, day date")
    assert [r[1] for r in rows(temporal.member_on(facts, members, "actor", "day", "b", "e", "grp").select("day", "grp"))] == [None, "G1", "G2"]


def test_jaccard_of_nothing_is_one(spark):
    assert one(spark, similarity.word_jaccard(F.lit("a b"), F.lit("c"))) == 1.0


def test_closure_ends_on_a_cycle(spark):
    e = spark.createDataFrame([(1, 2), (2, 3), (3, 1)], "a long, b long")
    assert rows(closure.wave(e, "a", "b", spark.createDataFrame([(1,)], "n long"), 3)) == [(2, 1), (3, 2)]
    assert rows(closure.closure(e, "a", "b", spark.createDataFrame([(1,)], "n long"), 3, reflexive=False).select("node", "depth")) == [(2, 1), (3, 2)]
    assert len(rows(closure.closure(e, "a", "b"))) == 9


def test_equal_dates_give_no_edge(spark):
    e = spark.createDataFrame([("x", "y", D(2000, 1, 1), D(2000, 1, 1)), ("x", "z", D(2000, 1, 1), D(1999, 1, 1))], "new string, old string, n date, o date")
    assert [r["old"] for r in closure.oriented(e, F.col("o"), F.col("n")).collect()] == ["z"]


def test_chain_has_no_siblings(spark):
    e = spark.createDataFrame([("b1", "a"), ("b2", "a")], "new string, old string")
    assert rows(closure.chain(e, "new", "old", spark.createDataFrame([("b1",)], "s string"))) == [("b1", "a"), ("b1", "b1")]


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 12), st.integers(0, 12)), max_size=25))
def test_components_against_union_find(spark, pairs):
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in pairs:
        x, y = find(a), find(b)
        up[max(x, y)] = min(x, y)
    linked = {x for p in pairs if p[0] != p[1] for x in p}
    want = {x: find(x) for x in linked if find(x) != x}
    found = closure.components(spark.createDataFrame(pairs, "a long, b long"), "a", "b").collect()
    assert {r["node"]: r["root"] for r in found} == want


def test_share_and_short_segments(spark):
    text = "".join(chr(97 + i % 26) for i in range(60))
    candidates = spark.createDataFrame([("c", text + "#"), ("short", "x" * 59)], "id string, text string")
    sources = spark.createDataFrame([("s", "??" + text + "??")], "src string, text string")
    found = shingles.carried_share(shingles.block_windows(candidates, "id", "text"), shingles.block_windows(sources, "src", "text"), "id", "src").collect()
    assert [(r["id"], r["candidates"], r["common"], r["share"]) for r in found] == [("c", 2, 1, 0.5)]


def test_blocks_change_no_window(spark):
    docs = spark.createDataFrame([(1, "abcdé" * 700)], "id long, text string")
    for step in (1, 7, 10):
        small, large = (rows(shingles.block_windows(docs, "id", "text", 60, step, b)) for b in (64, 100_000))
        assert small == large and len(small) == len(range(0, 3500 - 59, step))


def test_outcomes(spark):
    cases = [("Adopté - vote unique", None), (None, "Irrecevable 40"), (None, None)]
    df = spark.createDataFrame(cases, "o string, s string").select(classify.outcome(F.col("o"), F.col("s")).alias("x"))
    assert [(r["x"]["family"], r["x"]["ground"]) for r in df.collect()] == [("adopted", None), ("inadmissible", "article 40"), ("unknown", None)]


@pytest.mark.parametrize("kind, marked, a, b, want", [("regulation", True, 2006, 2004, "32004R2006"), ("regulation", False, 2018, 302, "32018R0302"), ("directive", False, 93, 13, "31993L0013")])
def test_act_ids(spark, kind, marked, a, b, want):
    assert one(spark, X.celex(F.lit(kind), F.lit(marked), F.lit(a), F.lit(b))) == want


def test_article_numbers_and_ranges(spark):
    assert one(spark, X.article_number(F.lit("article L. 121-84-10-1"))) == "L121-84-10-1"
    assert one(spark, X.article_range(F.lit("L. 111-1 à L. 111-3"))) == ["L111-1", "L111-2", "L111-3"]
    assert one(spark, X.article_range(F.lit("L. 111-1 à L. 111-41"))) == []


@pytest.mark.parametrize("label, want", [("22 to 26", [22, 23, 24, 25, 26]), ("2 and 4", [2, 4]), ("9 to 3", [9])])
def test_paragraph_lists(spark, label, want):
    assert one(spark, X.paragraph_list(F.lit(label))) == want


@pytest.mark.parametrize("k, n, want", [(36, 40, 0.7695), (20, 20, 0.8389), (0, 0, 0.0)])
def test_wilson(spark, k, n, want):
    assert round(one(spark, wilson_lower(F.lit(k), F.lit(n))), 4) == want


def test_disjoint_windows(spark):
    scored = spark.createDataFrame([("d", 0, 9.0), ("d", 200, 8.0), ("d", 800, 7.0)], "id string, start int, score double")
    assert [r[:2] for r in rows(ranking.disjoint_top(scored, ["id"]).select("score", "start"))] == [(7.0, 800), (9.0, 0)]


def test_change_data(spark):
    log = spark.createDataFrame([("k", 1, "upsert"), ("k", 2, "delete"), ("m", 1, "delete"), ("m", 2, "upsert")], "key string, at int, op string")
    assert [r["key"] for r in changes.compact_changes(log, "key", ["at"], F.col("op") == "delete").collect()] == ["m"]
    diff = changes.snapshot_diff(spark.createDataFrame([("a", "x"), ("b", "y")], "k string, v string"), spark.createDataFrame([("b", "z"), ("c", "x")], "k string, v string"), "k", "v")
    assert rows(diff.select("k", "change")) == [("a", "left"), ("b", "flipped"), ("c", "entered")]


def test_double_publication(spark):
    copies = spark.createDataFrame([("n", "body", "B", 2, "adopted"), ("n", "body", "BTC", 1, "pending")], "num string, body string, stage string, at int, outcome string")
    votes = spark.createDataFrame([("n", "BTC")], "num string, winner string")
    assert [tuple(r) for r in changes.fold_copies(copies, ["num", "body"], "stage", ["at"], "outcome", votes, "num").collect()] == [("n", "body", "BTC", "adopted", 2)]


def test_natural_order(spark):
    df = spark.createDataFrame([("73 rect.",), ("9",)], "n string")
    assert [r["n"] for r in df.orderBy(*X.natural_key(F.col("n"))).collect()] == ["9", "73 rect."]


def test_proof_constraints(spark):
    e = spark.createDataFrame([("a", "derived", None), ("b", "declared", None), ("c", "derived", "p")], "id string, method string, proof_id string")
    report = constraints.check_edges(e, spark.createDataFrame([("p", "x" * 59)], "proof_id string, window string"), [], ["id"])
    assert {r["rule"]: r["violations"] for r in report.collect()} == {"proof_required": 1, "proof_length": 1, "proof_exists": 0, "unique": 0}
    with pytest.raises(constraints.ConstraintError):
        constraints.require_none(report)


def test_sample_is_reproducible(spark):
    df = spark.range(200).withColumnRenamed("id", "k")
    first = sha_sample(df.repartition(1), ["k"], 10).collect()
    assert first == sha_sample(df.repartition(17), ["k"], 10).collect()
    rest = sha_sample(df, ["k"], 10, spark.createDataFrame([(r["k"],) for r in first], "k long"))
    assert not {r["k"] for r in first} & {r["k"] for r in rest.collect()}


def test_sections_merge_repeated_headers(spark):
    h = spark.createDataFrame([("d", 0, 3000, "Article 1"), ("d", 1000, 3000, "Article 1"), ("d", 2500, 3000, "Article 2")], "id string, s int, total int, name string")
    assert rows(sections.sections(h, "id", "s", "total", "name", merge_equal=True)) == [("d", 1, "Article 1", 0, 2500)]


def test_scanner_rules(spark):
    text = (
        "Article 1\nLe code de commerce est ainsi modifié :\nL'article L. 310-3 est complété par les mots : « et à l'article L. 121-16 du code de la consommation ».\n"
        "Article 2\nAprès l'article L. 224-54 du code de la consommation, il est inséré un article.\nL'article L. 111-1 du même code est abrogé."
    )
    found = scan.covers(scan.events(spark.createDataFrame([(1, text)], "id long, text string")), "consommation")
    assert rows(found.select("article", "number", "scope")) == [("1", "L310-3", "external"), ("2", "L111-1", "internal")]


def test_citations_of_european_acts(spark):
    text = "Loi portant transposition de la directive 93/13/CEE et modifiant le règlement (CE) n° 2006/2004"
    found = scan.eu_citations(scan.events(spark.createDataFrame([(1, text)], "id long, text string")))
    assert rows(found.select("celex", "transposed")) == [("31993L0013", True), ("32004R2006", False)]


def test_filing_routes(spark):
    proposals = spark.createDataFrame(
        [("p1", "t", "1", False, ["L1"], None, False, False), ("p2", "t", "1", False, [], "L2", False, False), ("p3", "t", "2", False, [], None, False, False), ("p4", "t", "1", False, [], None, False, False), ("p5", "t", "1", True, [], None, False, False)],
        "proposal string, text string, bill_article string, additional boolean, named array<string>, paragraph_target string, appends boolean, hidden boolean",
    )
    covered = spark.createDataFrame([("t", "1", ["L1", "L2"]), ("t", "2", ["L3"])], "text string, bill_article string, targets array<string>")
    assert {r["proposal"]: (r["target"], r["route"], r["reason"]) for r in edges.filed_on(proposals, covered).collect()} == {
        "p1": ("L1", "named", None), "p2": ("L2", "paragraph", None), "p3": ("L3", "whole", None), "p4": (None, None, "several_targets"), "p5": (None, None, "additional_article"),
    }


def test_dates_and_normal_forms(spark):
    assert one(spark, X.date_in(F.lit("loi du 1er août 2003"))) == D(2003, 8, 1)
    assert one(spark, X.date_in(F.lit("sans date"))) is None
    assert one(spark, X.prose_date(F.lit("2003-08-01").cast("date"))) == "1er août 2003"
    assert one(spark, X.normalised(F.lit("L’ «Été»  ﬁn"))) == "l' été fin"
    assert one(spark, X.unique_position(F.lit("ab  cd ab"), F.lit("b cd"))) == 1
    assert one(spark, X.unique_position(F.lit("ab ab"), F.lit("ab"))) is None


def test_declared_edges(spark):
    links = spark.createDataFrame([("v", "t", "creation"), ("v", "t", "creation"), ("v", "t", "mention")], "version string, statute string, link string")
    assert rows(edges.produced_by(links)) == [("v", "t", "creation")]
    articles = spark.createDataFrame([("a", D(2000, 1, 1)), ("b", D(1990, 1, 1)), ("c", D(2000, 1, 1))], "article string, start date")
    pairs = spark.createDataFrame([("a", "b"), ("a", "c"), ("b", "a"), ("a", "a")], "article string, former string")
    assert rows(edges.renumbered_declared(pairs, articles)) == [("a", "b")]


def test_a_text_that_moved_is_found(spark):
    arrivals = spark.createDataFrame([("n1", "alpha beta gamma delta", None, "d1"), ("n2", "alpha beta gamma delta", "alpha beta gamma delta", "d1")], "article string, text string, previous_text string, day string")
    departures = spark.createDataFrame([("o1", "alpha beta gamma delta", "d1"), ("o2", "other words than those", "d1"), ("o3", "alpha beta gamma delta", "d2")], "article string, text string, day string")
    assert rows(edges.renumbered_inferred(arrivals, departures, "day")) == [("n1", "o1", 1.0)]


def test_dossier_of_a_statute(spark):
    listings = spark.createDataFrame(
        [("s1", "d1", "x", "1"), ("s2", "d1", "bill", "2004-1"), ("s2", "d2", "law 2004-1 on", "2004-1"), ("s3", "d1", "x", "9"), ("s3", "d2", "y", "9")], "statute string, dossier string, title string, number string"
    )
    assert rows(edges.originates_in(listings)) == [("s1", "d1"), ("s2", "d2")]


def test_passage_guards_in_order(spark):
    text = "".join(chr(97 + i % 23) for i in range(60))
    probe = spark.createDataFrame(
        [("p1", "a1", "d", "adopted", None, text), ("p2", "a2", "d", "rejected", None, text), ("p3", "a3", "d", "adopted", None, "x" * 60), ("p4", "a4", "d", "adopted", "L9", text), ("p5", "a5", "d", "adopted", "L2", text)],
        "passage string, amendment string, dossier string, family string, destination string, w string",
    )
    index = spark.createDataFrame([("s", "L1", "d", text)], "segment string, article string, dossier string, w string")
    classes = spark.createDataFrame([("L1", "L1"), ("L2", "L1")], "number string, class string")
    found = edges.results_from(probe, index, classes, F.col("family") == "adopted")
    assert {r["passage"]: r["reason"] for r in found.collect()} == {"p1": None, "p2": "not_adopted", "p3": "not_found", "p4": "other_destination", "p5": None}


def test_perimeter_and_undeclared(spark):
    articles = spark.createDataFrame([("a",), ("b",)], "article string")
    origins = spark.createDataFrame([("a", "s1", "law", "d", 12, D(2000, 1, 1)), ("a", "s2", "law", "d", 14, D(2010, 1, 1))], "article string, statute string, nature string, dossier string, legislature int, date date")
    assert {r["article"]: (r["statute"], r["eligible"]) for r in edges.perimeter(articles, origins).collect()} == {"a": ("s2", 1), "b": (None, 0)}
    cited = spark.createDataFrame([("c", "1"), ("c", "2")], "celex string, act_article string")
    assert rows(edges.undeclared_nulled(cited, spark.createDataFrame([("c", "1")], "celex string, number string"))) == [("c", "1"), ("c", None)]


def test_consecutive_and_bands(spark):
    numbers = spark.createDataFrame([("a", k, n) for k, n in enumerate([1, 2, 4, 4, 5])], "id string, k int, n int")
    assert [r["n"] for r in sections.consecutive(numbers, "id", "k", "n").orderBy("k").collect()] == [1, 2]
    anchors = spark.createDataFrame([(1, 10.0, "A"), (1, 50.0, "B")], "page int, y double, name string")
    cells = spark.createDataFrame([(1, 0.0, "c0"), (1, 45.0, "c1"), (1, 30.0, "c2")], "page int, y double, cell string")
    assert rows(sections.in_bands(anchors, cells, ["page"], "y").select("cell", "anchor_name")) == [("c1", "B"), ("c2", "A")]


def test_codes_of_annexes(spark):
    df = spark.createDataFrame([("L. 1",), ("r2",), ("Annexe à l'article D. 3",), ("liminaire",), ("x",)], "n string")
    assert [r["p"] for r in df.select(classify.code_part(F.col("n")).alias("p")).collect()] == ["L", "R", "D", "L", None]


def test_streamed_increments_equal_the_table(spark, tmp_path):
    from spoor.streaming.events import apply_increments, current, read_increments

    log = spark.createDataFrame([("a", 1, "put"), ("b", 1, "put"), ("a", 3, "del"), ("a", 2, "put"), ("c", 4, "put")], "k string, at int, op string")
    log.repartition(3, "at").write.parquet(str(tmp_path / "in"))
    stream = read_increments(spark, str(tmp_path / "in"), log.schema, 1)
    for _ in range(2):  # the second run finds nothing new
        run = apply_increments(stream, str(tmp_path / "out"), str(tmp_path / "cp"), "k", ["at"], every=2)
        run.awaitTermination()
    names = {p.name for p in (tmp_path / "out").iterdir()}
    last = max(int(n) for n in names if n.isdigit())
    assert {n for n in names if n.startswith("base")} == {f"base-{k}" for k in range(1, last + 1, 2)}
    assert {r["k"] for r in current(spark, str(tmp_path / "out"), last, "k", ["at"], "op = 'del'", every=2).collect()} == {"b", "c"}
