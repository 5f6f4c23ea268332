"""Readers and sinks on small files."""

import datetime as dt

from spoor.sources import files, sinks

VERSION = """<ARTICLE><META><ID>A1</ID><NUM>L111-1</NUM><ETAT>VIGUEUR</ETAT><DATE_DEBUT>2001-01-01</DATE_DEBUT><DATE_FIN>2999-01-01</DATE_FIN></META>
<CONTEXTE><TEXTE cid="C1"></TEXTE></CONTEXTE><BLOC_TEXTUEL><CONTENU><p>Un premier alinéa assez long.</p><p>court</p>Deuxième alinéa<br/>Troisième alinéa ici</CONTENU></BLOC_TEXTUEL>
<LIENS><LIEN typelien="CREATION" naturetexte="LOI" cidtexte="T1" id="X">Loi 1</LIEN></LIENS></ARTICLE>"""


def test_versions(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "a.xml").write_text(VERSION, encoding="utf-8")
    (tmp_path / "b.xml").write_text("<ARTICLE><ID>A2</ID></ARTICLE>", encoding="utf-8")
    found = files.read_versions(files.whole_files(spark, str(tmp_path))).collect()
    assert len(found) == 1
    r = found[0]
    assert (r["version"], r["number"], r["start"], r["end"], r["code"]) == ("A1", "L111-1", dt.date(2001, 1, 1), None, "C1")
    assert r["paragraphs"] == ["Un premier alinéa assez long.", "Deuxième alinéa", "Troisième alinéa ici"]
    assert r["links"][0]["link"] == "creation" and r["links"][0]["statute"] == "T1"


def test_senate_rows_are_repaired(spark, tmp_path):
    names = [f"c{k}" for k in range(13)]
    whole = [f"v{k}" for k in range(13)]
    broken = [f"h{k}" for k in range(7)] + ["<p>body", "with tab</p>", "<p>Objet</p> why"] + [f"t{k}" for k in range(4)]
    (tmp_path / "s.csv").write_bytes("\n".join(["sep=\t", "\t".join(names), "\t".join(whole), "\t".join(broken)]).encode("latin-1"))
    found = {r["c0"]: r for r in files.read_senate(spark, str(tmp_path / "s.csv")).collect()}
    assert found["v0"]["c7"] == "v7" and found["h0"]["c7"] == "<p>body with tab</p>" and found["h0"]["c8"] == "<p>Objet</p> why" and found["h0"]["c12"] == "t3"


def test_nested_records(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"a": [{"b": {"uid": "1", "c": {"d": "x"}}}, {"uid": "2", "c": {"d": {"@xsi:nil": "true"}}}]}')
    found = files.read_nested(files.whole_files(spark, str(tmp_path), "*.json"), {"uid": "uid", "d": "c.d"})
    assert sorted(map(tuple, found.collect())) == [("1", "x"), ("2", "")]


def test_markup_and_encoding(spark, tmp_path):
    (tmp_path / "u.html").write_bytes("<p>café &amp; thé</p>".encode())
    (tmp_path / "l.html").write_bytes("<p>café</p>".encode("latin-1"))
    (tmp_path / "p.html").write_bytes(b"%PDF-1.4 x")
    found = {r["path"][-6:]: (r["kind"], r["text"]) for r in files.read_markup(spark, str(tmp_path)).collect()}
    assert found == {"u.html": ("html", "café & thé\n"), "l.html": ("html", "café\n"), "p.html": ("pdf", None)}


def test_exports(spark, tmp_path):
    sinks.export_tsv(spark.createDataFrame([(1, "a\tb\nc"), (2, None)], "k long, t string").coalesce(1), str(tmp_path / "t"))
    texts = [p.read_text() for p in (tmp_path / "t").glob("*.csv")]
    assert "k\tt\n1\ta b c\n2\t\n" in texts
    listed = sinks.manifest(spark, str(tmp_path / "t"), "*.csv").collect()
    assert sum(r["bytes"] for r in listed) == sum(map(len, texts)) and all(len(r["sha256"]) == 64 for r in listed)


def test_a_stage_replaces_its_own_rows_only(spark, tmp_path):
    path = str(tmp_path / "edges")
    for producer, n in (("a", 3), ("b", 2), ("a", 1)):
        sinks.replace_partition(spark.range(n), path, producer)
    assert {r["producer"]: r["count"] for r in spark.read.parquet(path).groupBy("producer").count().collect()} == {"a": 1, "b": 2}


def test_recitals(spark, tmp_path):
    (tmp_path / "act.html").write_text('<div id="rct_1"><p>(1)</p><p>Whereas &eacute;</p></div><div id="art_5"><p>Article 5</p></div>')
    found = files.read_act(files.whole_files(spark, str(tmp_path), "*.html")).select("kind", "number", "text").collect()
    assert sorted(map(tuple, found)) == [("article", "5", "Article 5"), ("recital", "1", "(1) Whereas é")]
