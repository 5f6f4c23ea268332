"""Sections of reports and studies; act ids, memberships, stop words, framed passages and trimmed lines by their rules."""

import datetime
import re

import pytest
from pyspark.sql import functions as F

from spoor.functions import text as X
from spoor.operators import ranking, reports, sections, temporal

LONG = "La commission a débattu de ce point. " * 30
LONGER = LONG + LONG


def found(spark, text):
    rows = reports.report_sections(spark.createDataFrame([("d", text)], "document string, text string")).orderBy("start").collect()
    return [(r["article"], r["about"], r["declared"], text[r["start"] : r["start"] + 12].strip()) for r in rows], rows


def test_sections_of_a_report(spark):
    text = (
        "SOMMAIRE\nEXAMEN DES ARTICLES 7\nArticle 1er (art. L. 111-1 du code)\nArticle 2\nIntitulé\n" + LONGER + "EXAMEN DES ARTICLES\n"
        "Article 1\n er \n(art. L. 111-1 et L. 112-3 à L. 112-5, L. 121-84-10-1 du code)\n" + LONG + "\nvoir l'article 9\nArticle 9 est ainsi rédigé\namendement, AMENDEMENT\n"
        " Article 2 bis A (article 22-2 de la loi n° 89-462)\n" + LONG + "\nArticle 3\nUn titre sans point\n" + LONGER + "\nArticle 4\nune minuscule\n" + LONGER
        + "\nArticle 5\nUn titre mais trop court\n" + LONG[:900] + "\nArticle 6 (art. L. 1) court\nfin\nArticle additionnel après l'article 6\n(art. L. 200-1 du code de la consommation)\n" + LONG + "\nArticle 7 [(supprimé)]\nUn titre qui finit par un point.\n" + LONGER
    )
    got, rows = found(spark, text)
    assert [g[:3] for g in got] == [
        ("1er", "art. L. 111-1 et L. 112-3 à L. 112-5, L. 121-84-10-1 du code", ["L111-1", "L112-3", "L112-4", "L112-5", "L121-84-10-1"]), ("2bisa", "article 22-2 de la loi n° 89-462", []), ("3", "Un titre sans point", []),
        ("", "art. L. 200-1 du code de la consommation", ["L200-1"]),
    ]
    assert rows[0]["amendments"] == 2 and all(text[r["start"] :].lstrip().startswith("Article") for r in rows)
    assert text[rows[0]["end"] :].startswith(" Article 2 bis A") and text[rows[2]["end"] :].startswith("Article 4")


def test_reports_without_a_contents_page_or_anything(spark):
    body = "Article 1\nDes titres\n" + LONGER
    assert [g[0] for g in found(spark, "Avant\nEXAMEN DES ARTICLES\n" + body)[0]] == ["1"]
    assert [g[0] for g in found(spark, body)[0]] == ["1"]
    for text in (None, "", "EXAMEN DES ARTICLES", "Article 1"):
        assert reports.report_sections(spark.createDataFrame([("d", text)], "document string, text string")).collect() == []


def test_sections_of_a_study(spark):
    state, more = "1. Diagnostic\n" + LONG + "\n", LONG + "\n"
    text = (
        "Article 1er : Objet ........ 3\nArticle 2 : Autre ........ 9\nAvant\nArticle 1 er : Objet\n" + state + "Article 1er : Objet\n" + more + "Article 2 – Autre\n" + more + "ARTICLE 3 : Options\nOptions possibles\n" + more
        + "Article 4 : Court\nObjectifs poursuivis\nArticle 6 : Annexe\nArticle 5 (définitions)\n" + more + "Article premier : Encore\n" + state
    )
    rows = reports.study_sections(spark.createDataFrame([("d", text), ("e", None), ("f", "rien")], "document string, text string")).orderBy("start").collect()
    assert [r["article"] for r in rows] == ["1er", "3", "1er"]
    assert text[rows[0]["start"] : rows[0]["end"]].count("Objet") == 2 and text[rows[0]["end"] :].startswith("Article 2 –")
    one = "Article 1 : Objet ........ 3\nÉTUDE\nArticle 1 : Objet\n" + state
    assert [one[r["start"] :][:10] for r in reports.study_sections(spark.createDataFrame([("d", one)], "document string, text string")).collect()] == ["Article 1 "]


@pytest.mark.parametrize("kind, marked, a, b, want", [
    ("decision", True, 676, 2002, "32002D0676"), ("decision", False, 2002, 676, "32002D0676"), ("decision", False, 676, 2002, "32002D0676"), ("regulation", False, 1999, 2004, "31999R2004"), ("regulation", True, 1999, 2004, "32004R1999"),
    ("regulation", None, 2016, 679, "32016R0679"), ("decision", False, 93, 350, None), ("regulation", False, 12, 34, None), ("directive", False, 2011, 83, "32011L0083"), ("directive", False, 40, 1, None), ("directive", False, 93, 0, None), ("directive", False, 93, 10000, None), ("other", False, 2011, 83, None), ("directive", False, None, 3, None),
])
def test_act_ids_by_which_number_can_be_a_year(spark, kind, marked, a, b, want):
    df = spark.createDataFrame([(kind, marked, a, b)], "k string, m boolean, a int, b int")
    assert df.select(X.celex(*[F.col(c) for c in "kmab"])).first()[0] == want


def test_facts_that_repeat_stay_apart(spark):
    d = datetime.date
    members = spark.createDataFrame([("x", d(2000, 1, 1), d(2001, 1, 1), "G1"), ("x", d(2001, 1, 1), None, "G2"), ("x", d(2001, 1, 1), None, "G0")], "actor string, b date, e date, grp string")
    facts = spark.createDataFrame([("x", d(2001, 1, 1))] * 2 + [("x", d(2005, 1, 1))] * 3 + [("x", None), ("y", d(2001, 1, 1)), (None, d(2001, 1, 1))], "actor string, day date")
    got = sorted(((r["actor"], str(r["day"]), r["grp"]) for r in temporal.member_on(facts, members, "actor", "day", "b", "e", "grp").collect()), key=str)
    assert got == sorted([("x", "2001-01-01", "G1")] * 2 + [("x", "2005-01-01", "G0")] * 3 + [("x", "None", None), ("y", "2001-01-01", None), (None, "2001-01-01", None)], key=str)


def test_stop_words_with_and_without_their_s(spark):
    df = spark.createDataFrame([("Les alinéas, alinéa et présents abonnements du prix",)], "t string")
    assert df.select(X.terms(F.col("t"), ("alinea", "presents"))).first()[0] == ["abonnement", "prix"]


def framed(text, start, size=400, slack=140):
    """The rule in plain loops: (begin, end, passage)."""
    stops = [m for m in range(len(text) - 1) if text[m] in ".;:!?" and text[m + 1].isspace()]
    stop, begin, clean = min(start + size, len(text)), start, start == 0
    if start:
        before, after = [m for m in stops if m >= max(0, start - slack) and m + 2 <= start], [m for m in stops if m >= start and m + 2 <= min(start + slack, stop)]
        if before or after:
            begin, clean = (before[-1] if before else after[0]) + 2, True
        else:
            blank = text.find(" ", start, min(start + 40, stop))
            begin = blank + 1 if blank >= 0 else start
    end = min(len(text), begin + size)
    whole = end == len(text)
    if not whole:
        late = [m for m in stops if m >= max(begin, end - slack) and m + 2 <= end]
        if late:
            end, whole = late[-1] + 1, True
        elif (blank := text.rfind(" ", begin, end)) > begin:
            end = blank
    return begin, end, ("" if clean else "…") + re.sub(r"\s+", " ", text[begin:end]).strip(" ") + ("" if whole else "…")


def test_passages_are_framed_by_sentences(spark):
    import random

    rng, texts = random.Random(3), []
    for n in range(40):
        words = ["".join(rng.choice("abcé") for _ in range(rng.randint(1, 9))) + rng.choice([""] * rng.choice([3, 60]) + [".", ";", ":", "L. 121-3"]) for _ in range(rng.randint(1, 260))]
        texts.append((n, rng.choice([" ", " ", "\n"]).join(words) if n % 9 else "x" * 900))
    docs = spark.createDataFrame(texts, "id int, text string")
    hits = [(n, s) for n, t in texts for s in range(0, max(1, len(t) - 200), 200)]
    rows = ranking.reframed(docs, spark.createDataFrame(hits, "id int, start int"), "id", "text").collect()
    assert {(r["id"], r["start"]): (r["begin"], r["end"], r["passage"]) for r in rows} == {(n, s): framed(dict(texts)[n], s) for n, s in hits}


def test_lines_are_trimmed_of_blanks_alone(spark):
    docs = spark.createDataFrame([(1, "0000 lines begin so\n  1111 and blanks before \n2222 lines end in 2222")], "id int, t string")
    assert [r["segment"] for r in sections.segments(docs, "id", "t").orderBy("ordinal").collect()] == ["0000 lines begin so", "1111 and blanks before", "2222 lines end in 2222"]
