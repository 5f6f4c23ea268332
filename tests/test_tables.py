"""Tables of concordance: frames of upright and turned pages, tables that begin, go on and end, bands of lines, heads of cells."""

import pytest

from spoor.operators import tables

PAGE, BLOCK = "document long, page int, text string", "document long, page int, dx double, dy double, x0 double, y0 double, x1 double, y1 double, text string"
TITLE = "Annexe 4\nTableau de transposition de la directive 2011/83/UE"


def upright(page, line, column, text, document=1):
    return (document, page, 1.0, 0.0, float(column), float(line), column + 90.0, line + 10.0, text)


def turned(page, line, column, text):
    return (1, page, 0.0, -1.0, float(line), 700.0 - column, line + 10.0, 800.0 - column, text)


def read(spark, pages, blocks, acts=("32011L0083",)):
    df = lambda rows, schema: spark.createDataFrame(list(rows), schema)
    found = tables.concordances(df(pages, PAGE), df(blocks, BLOCK), df([(a,) for a in acts], "celex string")).collect()
    return sorted((r["page"], r["act_article"], r["paragraph"], r["number"]) for r in found)


@pytest.mark.parametrize("block", [upright, turned])
def test_a_line_runs_from_its_anchor_to_the_next(spark, block):
    blocks = [
        block(1, 60, 300, "Code de la consommation"), block(1, 100, 50, "Art. 2-7)"), block(1, 95, 300, "• \nArt. L. 121-16"), block(1, 131, 300, "L. 121-17-1-2"),
        block(1, 140, 60, "Article 6 §1"), block(1, 132, 300, "Articles L. 121-18 et R. 121‑19"), block(1, 400, 300, "D121-20"), block(1, 91, 300, "L. 111-1"),
    ]
    assert read(spark, [(1, 1, TITLE)], blocks) == [(1, "2", "7", "L121-16"), (1, "2", "7", "L121-17-1-2"), (1, "6", "1", "D121-20"), (1, "6", "1", "L121-18"), (1, "6", "1", "R121-19")]


def test_only_the_head_of_a_cell_that_means_this_code(spark):
    said = ["« Art. L. 121-1. – Le vendeur »", "Voir l'article L. 121-2", "L. 121-3 du code civil", "L. 121-4\nvoir aussi L. 121-5", "L. 121-6 CSP", "L. 121-7 " + "x" * 121 + " code civil"]
    blocks = lambda head: [upright(1, 100, 50, "Art. 3"), *[upright(1, 100 + k, 300, t) for k, t in enumerate(said)], upright(1, 60, 300, head)]
    # "L. 121-7" and all that follows is the head's own line, so the other code that it names counts.
    assert read(spark, [(1, 1, TITLE)], blocks("Code de la consommation")) == [(1, "3", "", "L121-4")]
    assert read(spark, [(1, 1, TITLE)], blocks("Observations")) == []
    assert read(spark, [(1, 1, TITLE)], [*blocks("Observations"), upright(1, 300, 300, "L. 121-8 C.conso")]) == [(1, "3", "", "L121-4"), (1, "3", "", "L121-8")]


def test_what_is_an_anchor(spark):
    cell = upright(1, 100, 300, "L. 121-1 du code de la consommation")
    one = lambda text: read(spark, [(1, 1, TITLE)], [upright(1, 100, 50, text), cell])
    assert one("Article 5 point 2") == [(1, "5", "2", "L121-1")] and one("Définitions\nArt. 5") == [(1, "5", "", "L121-1")]
    assert one("Art. 5-1-2") == [] and one("Art. L. 121-9") == [] and one("L. 121-9\nArt. 5") == [] and one("Art. 1234") == []
    # Of two anchors on one line the one further on counts; one in another column than the leftmost is none.
    assert read(spark, [(1, 1, TITLE)], [upright(1, 100, 50, "Art. 5"), upright(1, 100, 60, "Art. 6"), upright(1, 100, 200, "Art. 7"), cell]) == [(1, "6", "", "L121-1")]


def test_tables_go_on_over_pages_until_an_annex(spark):
    text = {1: "Étude", 2: TITLE, 3: "suite", 4: "Tableau de concordance", 5: "12 ANNEXE\nListe", 6: "suite", 7: "Règlement (UE) n° 524/2013\ntableau de  concordance", 8: "TABLEAU DE TRANSPOSITION directive 2005/29/CE"}
    blocks = [b for p in text for b in (upright(p, 100, 50, "Art. 2"), upright(p, 100, 300, "L. 121-1"))]
    named = [upright(2, 60, 300, "C. conso"), upright(8, 60, 300, "C. conso")]
    pages = [(1, p, t) for p, t in text.items()]
    hits = lambda acts, extra=(): [p for p, *_ in read(spark, pages, [*blocks, *extra], acts)]
    every = ("32011L0083", "32013R0524", "32005L0029")
    assert hits(every, named) == [2, 3, 4, 8]  # a column's header holds for its table alone
    assert hits(every[:1], named) == [2, 3, 4] and hits(every) == []
    begun = tables.tables_begun(spark.createDataFrame(pages, PAGE)).collect()
    assert {r["page"]: r["celex"] for r in begun} == {2: every[0], 3: every[0], 4: every[0], 7: every[1], 8: every[2]}


def test_odd_pages(spark):
    assert read(spark, [], []) == []
    blocks = [upright(1, 100, 50, "Art. 2"), upright(1, 100, 300, None), (1, 1, None, 0.0, 1.0, 1.0, 1.0, 1.0, "Art. 3"), upright(1, 100, 300, ""), upright(1, 100, 300, "L. 121-1 C. conso 😀" + "y " * 50_000)]
    assert read(spark, [(1, 1, TITLE), (2, 1, None)], [*blocks, blocks[-1]]) == [(1, "2", "", "L121-1")] * 2


def test_edges_and_why_not(spark):
    df = spark.createDataFrame
    rows = [(1, 1, "C", "2", "", "L1"), (1, 2, "C", "2", "", "L1"), (1, 1, "C", "2", "7", "L1"), (1, 1, "C", "40", "", "L1"), (9, 1, "C", "2", "", "L1"), (1, 1, "C", "2", "", "L9"), (2, 1, "C", "2", "", "L1"), (3, 1, "C", "2", "", "L1")]
    found = df([(*r, "p", 1.0, 1.0, 0) for r in rows], "document long, page int, celex string, act_article string, paragraph string, number string, proof string, line double, column double, ordinal int")
    studies = df([(1, "a", "2010-01-01"), (2, "b", "2000-01-01"), (3, None, None)], "document long, dossier string, day string").selectExpr("document", "dossier", "cast(day as date) day")
    lineages = df([("L1", "2005-01-01", 1), ("L1", None, 2)], "number string, end string, lineage int").selectExpr("number", "cast(end as date) end", "lineage")
    wrote = df([("L1", "b", 2)], "number string, dossier string, lineage int")
    out = tables.transposes_article(found, studies, df([("C", "2"), ("C", "2")], "celex string, number string"), lineages, wrote).collect()
    told = {(r["document"], r["page"], r["act_article"], r["paragraph"], r["number"]): (r["lineage"], r["reason"]) for r in out}
    assert len(out) == len(rows)
    assert told == {
        (1, 1, "2", "", "L1"): (2, None), (1, 2, "2", "", "L1"): (2, "repeated"), (1, 1, "2", "7", "L1"): (2, None), (1, 1, "40", "", "L1"): (None, "unknown_act_article"),
        (9, 1, "2", "", "L1"): (None, "no_document"), (1, 1, "2", "", "L9"): (None, "unresolved"), (2, 1, "2", "", "L1"): (2, None), (3, 1, "2", "", "L1"): (2, None),
    }
