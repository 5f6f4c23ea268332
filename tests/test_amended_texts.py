"""Paragraph numbers, filing of amendments and prior art of sets, against small cases and brute force."""

import random

import pytest
from pyspark.sql import functions as F

from spoor.operators import edges, filing, paragraphs, shingles


def glyphs(n):
    """A printed number, by the table of letters."""
    letters = "LMNOPQRST"[n - 1] if n < 10 else f"{n // 10}{'abcdefghij'[n % 10]}" if n < 100 else f"{n // 100}{'ABCDEFGHIJ'[n // 10 % 10]}{'abcdefghij'[n % 10]}"
    return "".join(chr(0xF000 + ord(c)) for c in letters)


def test_printed_numbers(spark):
    df = spark.createDataFrame([(n, glyphs(n)) for n in range(1, 1000)], "n int, g string")
    assert df.where((paragraphs.printed_number(F.col("g")) != F.col("n")) | (paragraphs.printed(F.col("n")) != F.col("g"))).count() == 0
    odd = spark.createDataFrame([("",), (chr(0xF000 + ord("U")),), (chr(0xE100),), ("L",), (None,), (chr(0xF031) * 3,), (f"\xa0{glyphs(7)} ",)], "g string")
    assert [r[0] for r in odd.select(paragraphs.printed_number(F.col("g"))).collect()] == [None, None, None, 1, None, None, 7]


def read(spark, bodies):
    df = spark.createDataFrame([(k, "1", b, 10) for k, b in bodies.items()], "text string, article string, body string, offset int")
    return {r["text"]: (r["mode"], r["stopped"], [(p["number"], bodies[r["text"]][p["start"] - 10 : p["end"] - 10]) for p in r["paragraphs"]]) for r in paragraphs.numberings(df).collect()}


def test_counted_paragraphs(spark):
    found = read(spark, {
        "status": "(Non modifié)\n\nPremier\n \n(pour coordination)\nSuppression maintenue\nDeux",
        "wrapped": "« IDENTIFICATION\nRELEVANT DU STATUT\n« suite\nsuivi\nfin",
        "no quotation after": "« IDENTIFICATION\nRELEVANT DU STATUT\nsuite",
        "opens": "« un\n« deux\n2° trois\n« quatre\nE (nouveau). – cinq\n« six\n– sept\n« huit",
        "counts although a status": "III et III bis. – (Non modifiés)",
        "null": None, "blank": " \n\t\n\xa0",
    })
    assert found == {
        "status": ("counted", None, [(1, "Premier"), (2, "Deux")]),
        "wrapped": ("counted", None, [(1, "« IDENTIFICATION\nRELEVANT DU STATUT"), (2, "« suite"), (3, "suivi"), (4, "fin")]),
        "no quotation after": ("counted", None, [(1, "« IDENTIFICATION"), (2, "RELEVANT DU STATUT"), (3, "suite")]),
        "opens": ("counted", None, [(k + 1, x) for k, x in enumerate(["« un", "« deux", "2° trois", "« quatre", "E (nouveau). – cinq", "« six", "– sept", "« huit"])]),
        "counts although a status": ("counted", None, [(1, "III et III bis. – (Non modifiés)")]),
        "null": ("counted", None, []), "blank": ("counted", None, []),
    }


def test_printed_paragraphs_and_their_breaks(spark):
    g = glyphs
    found = read(spark, {
        "whole": f"(Conforme)\n[note]\n{g(1)}\nun\n\n {g(2)} \ndeux\n{g(3)}\ntrois\nChapitre II",
        "line above": f"fin d'un autre\n{g(1)}\nun",
        "out of turn": f"{g(1)}\nun\n{g(3)}\ntrois\n{g(4)}\nquatre",
        "starts again": f"{g(1)}\nun\n{g(2)}\ndeux\n{g(1)}\nautre",
        "two lines": f"{g(1)}\nun\n{g(2)}\ndeux\ndeux encore\n{g(3)}\ntrois",
        "no line": f"{g(1)}\nun\n{g(2)}\n{g(3)}\ntrois",
        "no line at the end": f"{g(1)}\nun\n{g(2)}",
        "unknown glyph": f"{chr(0xE123)}\nun",
    })
    assert found == {
        "whole": ("printed", None, [(1, "un"), (2, "deux"), (3, "trois")]), "line above": ("printed", "line_above", []), "out of turn": ("printed", "out_of_turn", [(1, "un")]),
        "starts again": ("printed", "out_of_turn", [(1, "un"), (2, "deux")]), "two lines": ("printed", "two_lines", [(1, "un")]), "no line": ("printed", "no_line", [(1, "un")]),
        "no line at the end": ("printed", "no_line", [(1, "un")]), "unknown glyph": ("printed", "out_of_turn", []),
    }


def test_a_long_article(spark):
    body = "\n".join(f"{glyphs(n)}\nligne {n}" for n in range(1, 700))
    assert read(spark, {"t": body})["t"] == ("printed", None, [(n, f"ligne {n}") for n in range(1, 700)])


def test_an_anchor_takes_its_article_out(spark):
    articles = spark.createDataFrame([("t", a, "« Art. L. 1-1. – x\n« Art. L. 1-2. – y", 0) for a in "123"], "text string, article string, body string, offset int")
    numbered = paragraphs.numberings(articles)
    said = [("a", "1", "Alinéa 2\nRédiger ainsi cet alinéa :\n« Art. L. 1‑2. – z »"), ("b", "2", "Alinéa 2 : rédiger ainsi cet alinéa : « Art. L. 1-1. – z »"), ("c", "2", "Alinéa 1, première phrase, rédiger ainsi cet alinéa : « Art. L.1-1. – z »"), ("d", "3", "Alinéa 9\nSupprimer cet alinéa."), ("e", "3", None), ("f", "9", "Alinéa 1\nRédiger ainsi cet alinéa :\n« Art. L. 1-2"), ("g", "1", "Alinéa 3\nRédiger ainsi")]
    checked = paragraphs.anchors(spark.createDataFrame([(a, "t", n, x) for a, n, x in said], "amendment string, text string, article string, dispositif string"), numbered)
    assert sorted((r["amendment"], r["confirmed"]) for r in checked.collect()) == [("a", True), ("b", False), ("c", True)]
    assert sorted({r["article"] for r in paragraphs.paragraph_numbers(numbered, checked).collect()}) == ["1", "3"]
    assert paragraphs.paragraph_numbers(numbered).count() == 6


def test_what_governs_a_paragraph(spark):
    told = spark.createDataFrame([("t", "1", 1, 0, 10), ("t", "1", 2, 11, 30), ("t", "1", 3, 31, 40), ("t", "1", 4, 41, 50), ("t", "1", 5, 51, 60)], "text string, article string, number int, start int, end int")
    acts = spark.createDataFrame([("t", "1", 12, "L1", "internal"), ("t", "1", 30, "L2", "internal"), ("t", "1", 35, None, "external"), ("t", "1", 45, None, None), ("t", "2", 0, "L9", "internal")], "text string, article string, start int, target string, scope string")
    cut = spark.createDataFrame([("t", "1", 51)], "text string, article string, start int")
    found = {r["number"]: (r["status"], r["target"]) for r in paragraphs.governed(told, acts, cut).collect()}
    assert found == {1: ("unreadable", None), 2: ("target", "L2"), 3: ("outside", None), 4: ("unreadable", None), 5: ("unreadable", None)}
    assert {r["number"]: r["status"] for r in paragraphs.governed(told, acts).collect()}[5] == "unreadable"


def test_subdivisions_and_named_articles(spark):
    labels = {"Article 12 bis A": ("12 bis a", False), "ART. PREMIER": ("1er", False), "Article 1er": ("1er", False), "art. add. après Article 7": ("7", True), "Après l’article 7": ("7", True), "Annexe": (None, False), "article 3 terdecies": ("3 terdecies", False)}
    df = spark.createDataFrame([(x,) for x in labels], "l string")
    assert {r["l"]: (r["s"], r["a"]) for r in df.select("l", filing.subdivision(F.col("l")).alias("s"), F.col("l").rlike(filing.ADDITIONAL).alias("a")).collect()} == labels
    texts = {
        "Après l'article L. 121-2, insérer « Art. L. 121-2-1. – x » et, à l'article L. 3-4, « l'article L. 9-9 »": ["L3-4", "L121-2-1"],
        "Rédiger ainsi cet article : « Au début de l'article L. 413‑8 du code de la consommation »": ["L413-8"], "": [],
    }
    df = spark.createDataFrame([(x,) for x in texts], "b string")
    assert {r["b"]: r["n"] for r in df.select("b", filing.named_articles(F.col("b")).alias("n")).collect()} == texts


@pytest.fixture
def filed(spark):
    def run(rows, chain=()):
        said = spark.createDataFrame(rows, "proposal string, text string, declared array<string>, subdivision string, dispositif string")
        covered = spark.createDataFrame([("t", "1", "L1"), ("t", "2", "L1"), ("t", "2", "L2"), ("t", "3", "L1"), ("t", "3", None), ("t", "4", None), ("t", "5", "L5"), ("t", "6", "L6")], "text string, article string, target string")
        links = spark.createDataFrame([("L1", "L1"), *chain], "seed string, node string")
        told = spark.createDataFrame([("t", "2", 1, "target", "L1"), ("t", "2", 2, "target", "L2"), ("t", "2", 3, "outside", None), ("t", "2", 4, "unreadable", None)], "text string, article string, number int, status string, target string")
        unfit = spark.createDataFrame([("t", "3"), ("t", "3")], "text string, article string")
        marks = spark.createDataFrame([("t", "5", True, False), ("t", "6", False, True), ("t", "6", False, False)], "text string, article string, other_norm boolean, hidden boolean")
        found = filing.filings(filing.proposals(said), covered, links, told, unfit, marks)
        return sorted(((r["proposal"], r["target"], r["route"] or r["reason"]) for r in found.collect()), key=str)

    return run


def test_routes_and_reasons(filed):
    cases = {
        "named": (["L1"], "Article 2", "", [("L1", "named")]), "both named": (["L1", "L2"], "Article 2", "", [(None, "contradicted")]), "before": (["L0"], "Article 2", "", [("L2", "named_before_or_after")]),
        "sibling": (["L3"], "Article 2", "", [(None, "contradicted")]), "declared decides": (["L9"], "Article 1", "Alinéa 1", [(None, "contradicted")]),
        "paragraphs": ([], "Article 2", "Alinéas 1 et 2 : supprimer", [("L1", "paragraph"), ("L2", "paragraph")]), "trouble in turn": ([], "Article 2", "Alinéas 3 à 4", [(None, "outside_code")]), "no such paragraph": ([], "Article 2", "Alinéa 9", [(None, "unreadable_paragraph")]),
        "unfit": ([], "Article 3", "Alinéa 1", [(None, "numbering_contradicted")]), "inserts": ([], "Article 2", "Après l'alinéa 1, insérer un alinéa : « Art. L. 3. – x »", [(None, "inserts_instruction")]),
        "additional": ([], "art. add. après Article 1", "", [(None, "additional_article")]), "annex": ([], "Annexe", "", [(None, "unreadable_subdivision")]), "none covered": ([], "Article 4", "", [(None, "nothing_covered")]), "unknown": ([], "Article 77", "", [(None, "nothing_covered")]),
        "appends": ([], "Article 1", "Compléter cet article par : x", [(None, "appends")]), "several": ([], "Article 2", "Supprimer cet article.", [(None, "several_targets")]), "one outside": ([], "Article 3", "", [(None, "several_targets")]),
        "norm of the article": ([], "Article 5", "", [(None, "other_norm")]), "norm of the text": ([], "Article 1", "À la loi n° 93-949, x", [(None, "other_norm")]), "hidden": ([], "Article 6", "", [(None, "hidden_paragraph")]),
        "neighbour": ([], "Article 1", "Rédiger ainsi cet article : « L'article L. 8 du code de la consommation »", [(None, "neighbour_rewritten")]), "same": ([], "Article 1", "Rédiger ainsi cet article : « L'article L. 1 du code de la consommation »", [("L1", "whole")]),
        "whole": ([], "Article 1", "Supprimer cet article.", [("L1", "whole")]), "default": (None, "Article 1", None, [("L1", "whole_by_default")]),
    }
    got = filed([(name, "t", d, s, x) for name, (d, s, x, _) in cases.items()], [("L2", "L0"), ("L2", "L2")])
    assert got == sorted(((name, *r) for name, (*_, want) in cases.items() for r in want), key=str)


# --- prior art outside a set


def test_the_first_outsider_of_each_set(spark):
    rng = random.Random(4)
    for sets, size in ((6, 3), (3, 12), (1, 0)):
        holders = [(m, rng.choice([None, *range(12)]), w, w) for m in range(25) for w in range(8) if rng.random() < 0.4] + [(1, 3, 0, 0), (1, 9, 0, 0)]
        members = [(s, m) for s in range(sets) for m in rng.sample(range(25), size)] + [(0, 1), (0, 1), (1, 1)]  # a member of two sets
        asked = [(s, w, w) for s in range(sets + 1) for w in range(9)] * 2
        own = {s: {m for t, m in members if t == s} for s in range(sets + 1)}
        want = {(s, w): min(days) for s, w, _ in asked if (days := [d for m, d, h, _ in holders if h == w and d is not None and m not in own[s]])}
        found = shingles.earliest_outside(spark.createDataFrame(asked, "set int, h1 int, h2 int"), spark.createDataFrame(holders, "member int, day int, h1 int, h2 int"), spark.createDataFrame(members, "set int, member int"))
        rows = found.collect()
        assert {(r["set"], r["h1"]): r["outside"] for r in rows} == want and len(rows) == len(want)
    assert shingles.earliest_outside(spark.createDataFrame(asked, "set int, h1 int, h2 int"), spark.createDataFrame([], "member int, day int, h1 int, h2 int"), spark.createDataFrame([], "set int, member int")).collect() == []


def test_prior_art_of_a_version_in_two_dossiers(spark):
    text = "x" * 60
    probe = spark.createDataFrame([(d, d, "adopted", None, [], text) for d in ("d", "e")], "passage string, dossier string, family string, destination string, declared array<string>, w string")
    index = spark.createDataFrame([("s", "L1", "d", 5, text), ("s", "L1", "e", 5, text)], "segment string, article string, dossier string, day int, w string")
    classes = spark.createDataFrame([("L1", "L1")], "number string, class string")
    old = spark.createDataFrame([("v", 1, text), ("s", 5, text)], "member string, day int, w string").select("member", "day", *shingles.window_key("w"))
    for members, want in (([("d", "s"), ("e", "s"), ("d", "v"), ("e", "v")], {"d": None, "e": None}), ([("d", "s"), ("e", "s"), ("d", "v")], {"d": None, "e": "prior_art"}), ([("d", "s"), ("e", "s")], {"d": "prior_art", "e": "prior_art"})):
        held = spark.createDataFrame(members, "set string, member string")
        found = edges.results_from(probe, index, classes, F.lit(True), None, None, None, old, held)
        assert {r["passage"]: r["reason"] for r in found.collect()} == want
    later = old.where("member = 's'")
    assert {r["reason"] for r in edges.results_from(probe, index, classes, F.lit(True), None, None, None, later, spark.createDataFrame([("z", "z")], "set string, member string")).collect()} == {None}
