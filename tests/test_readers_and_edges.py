"""Readers, sinks, the scanner's rules and positional joins on small cases, against brute force where there is one."""

import datetime as dt
import json

import numpy as np
from pyspark.sql import functions as F

from spoor.functions import text as X
from spoor.operators import edges, scan, sections, similarity, temporal
from spoor.sources import files, sinks
from spoor.streaming.events import counts_by_window, distinct_events, sessions
from tests.test_sources import VERSION

DOSSIER = """<DOSSIER><ID>D{0}</ID><TITRE>Loi {0}</TITRE><LEGISLATURE><NUMERO>14</NUMERO></LEGISLATURE><TEXTES><ID_TEXTE_1>T1</ID_TEXTE_1><ID_TEXTE_2>T{0}</ID_TEXTE_2></TEXTES>
<EXPOSE_MOTIF><p>{1}</p></EXPOSE_MOTIF><a href="https://www.senat.fr/rap/l{0}.html">Rapport {0}</a><a href="https://example.org/x">Rapport</a></DOSSIER>"""


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_dossiers_and_what_is_planned_from_them(spark, tmp_path):
    for k, words in ((1, "mot " * 80), (2, "court")):
        (tmp_path / f"d{k}.xml").write_text(DOSSIER.format(k, words), encoding="utf-8")
    found = files.read_dossiers(files.whole_files(spark, str(tmp_path)))
    assert rows(files.statute_listings(found).select("statute", "dossier")) == [("T1", "D1"), ("T1", "D2"), ("T2", "D2")]
    assert [r["legislature"] for r in found.collect()] == [14, 14]
    assert rows(files.plan_links(found, "^Rapport", ["www.senat.fr"])) == [("D1", "www.senat.fr_rap_l1.html", "https://www.senat.fr/rap/l1.html"), ("D2", "www.senat.fr_rap_l2.html", "https://www.senat.fr/rap/l2.html")]
    assert [r["dossier"] for r in files.memoranda(found).collect()] == ["D1"]


def test_names_and_records(spark, tmp_path):
    for name in ("a.xml", "b.xml"):
        (tmp_path / name).write_text(VERSION, encoding="utf-8")
    listed = files.named_files(files.whole_files(spark, str(tmp_path)), spark.createDataFrame([("b.xml",), ("c.xml",)], "name string"))
    found = [json.loads(r["json"]) for r in files.scan_records(listed).collect()]
    assert len(found) == 1 and found[0]["links"][0]["statute"] == "T1"


def test_tables_by_position_plan_and_actor(spark, tmp_path):
    (tmp_path / "w.csv").write_text('1;"a;b";x\n2;;y\n', encoding="utf-8")
    assert rows(files.read_wide(spark, str(tmp_path / "w.csv"), {"k": 0, "t": 1})) == [("1", "a;b"), ("2", "")]
    (tmp_path / "plan.tsv").write_text("url\tn\nu\t3\n", encoding="utf-8")
    assert rows(files.read_plan(spark, str(tmp_path / "plan.tsv"), "url string, n int")) == [("u", 3)]
    actor = {"acteur": {"uid": "PA1", "etatCivil": {"ident": {"prenom": "Ada", "nom": "L"}}, "mandats": {"mandat": [{"dateDebut": "2012-01-01", "dateFin": None, "organes": {"organeRef": "PO1"}}]}}}
    (tmp_path / "a.json").write_text(json.dumps(actor), encoding="utf-8")
    assert rows(files.read_actors(files.whole_files(spark, str(tmp_path), "a.json"))) == [("PA1", "Ada L", "PO1", dt.date(2012, 1, 1), None)]
    (tmp_path / "p.pdf").write_bytes(b"one\x01|two")
    assert [r["text"] for r in files.pdf_text(spark, str(tmp_path), lambda b: b.decode().split("|")).collect()] == ["one two"]


def test_recitals_of_older_layouts(spark, tmp_path):
    (tmp_path / "n.html").write_text("<p>(1) Premier.</p><p>Autre (2).</p><p> <b>(2)</b> Second.</p>", encoding="utf-8")
    (tmp_path / "o.html").write_text("<p>considérant que ceci;</p><p>Le reste.</p>", encoding="utf-8")
    found = files.read_act(files.whole_files(spark, str(tmp_path), "*.html")).select(F.regexp_extract("path", r"(\w)\.html$", 1).alias("f"), "number", "text")
    assert rows(found) == [("n", "1", "(1) Premier."), ("n", "2", "(2) Second."), ("o", None, "considérant que ceci;")]


def test_sinks(spark, tmp_path):
    spark.range(10).repartition(5).write.parquet(str(tmp_path / "many"))
    sinks.compact(spark, str(tmp_path / "many"), str(tmp_path / "few"), 1)
    assert len(list((tmp_path / "few").glob("part-*"))) == 1 and spark.read.parquet(str(tmp_path / "few")).count() == 10
    for step in ("read", "join"):
        sinks.journal(spark, str(tmp_path / "journal"), "r1", step, "failed", 1.5, "no\nfile /home/someone/x")
    assert {(r["step"], r["detail"]) for r in spark.read.parquet(str(tmp_path / "journal")).collect()} == {("read", "no file ~"), ("join", "no file ~")}
    proofs = spark.createDataFrame([("p", "x" * 90)], "id string, window string")
    assert [len(r["window"]) for r in sinks.shortened_proofs(proofs).collect()] == [60]
    held = sinks.without_withheld_edges(spark.createDataFrame([("e1", "d1"), ("e2", "d2")], "e string, d string"), spark.createDataFrame([("d1",)], "d string"), "d")
    assert [r["e"] for r in held.collect()] == ["e2"] and [json.loads(r["json"]) for r in sinks.as_json(held).collect()] == [{"d": "d2", "e": "e2"}]
    assert spark.range(1).select(X.report_link("http://h/new", F.lit("é" * 300), F.lit("a b")).alias("u")).first()["u"] == "http://h/new?title=" + "%C3%A9" * 200 + "&body=a+b"


# --- the scanner

OURS = "consommation"


def marks(spark, *texts):
    return scan.events(spark.createDataFrame(list(enumerate(texts)), "id long, text string"))


def test_what_is_quoted_is_told_by_line(spark):
    text = (
        "Article 3 ter B (nouveau)\nAprès l'article L. 111-1 du code de la consommation, sont insérés trois alinéas ainsi rédigés :\n« L'article L. 112-1 est abrogé.\n« L'article L. 112-2 est abrogé.\n"
        "« L'article L. 112-3 est abrogé. »\nL'article L. 113-1 du même code est abrogé.\nL'article L. 310-1 du code de commerce est complété par les mots : « du code de la route ». L'article L. 310-2 est supprimé."
    )
    found = scan.covers(marks(spark, text, None, ""), OURS)
    assert rows(found.select("article", "number", "code")) == [("3 ter b", "L113-1", "code de la consommation"), ("3 ter b", "L310-1", "code de commerce"), ("3 ter b", "L310-2", "code de commerce")]
    texts = spark.createDataFrame([(0, text)], "id long, text string")
    assert [r["passage"] for r in scan.inserted_passages(scan.events(texts), texts, OURS, least=20).orderBy("start").collect()][0] == "L'article L. 112-1 est abrogé."


def test_names_of_codes_end_where_the_sentence_goes_on(spark):
    text = "du code de la construction et de l'habitation et de l'article 3, au code monétaire et financier et aux articles cités, du code de commerce ainsi que le code du travail est modifié, le présent code"
    found = marks(spark, text).where("kind = 'code'").orderBy("start")
    assert [r["key"] for r in found.collect()] == ["code de la construction et de l'habitation", "code monétaire et financier", "code de commerce", "code du travail", "présent code"]


def test_numbers_of_articles(spark):
    text = "L. 121-84-10-1, R.* et L121‑3 puis D. 5-1 A, L. 1-2-3-4-5, XL. 1-1 et L. 12345-1"
    found = marks(spark, text).where("kind = 'reference'").orderBy("start")
    assert [r["key"] for r in found.collect()] == ["L121-84-10-1", "L121-3", "D5-1 A"]


def test_references_are_resolved_on_the_day_of_the_text(spark):
    d = dt.date
    found = marks(spark, "L'article L. 1-1 et l'article L. 1-2. L'article L. 1-3 du code de commerce.", "L'article L. 1-1.")
    versions = spark.createDataFrame([("L1-1", d(2000, 1, 1), d(2005, 1, 1)), ("L1-2", d(2000, 1, 1), None), ("L1-3", d(2000, 1, 1), None)], "number string, start date, end date")
    days = spark.createDataFrame([(0, d(2004, 1, 1)), (1, d(2005, 1, 1))], "id long, day date")
    assert rows(scan.refers_to(found, OURS, versions, days).select("id", "number", "scope")) == [(0, "L1-1", "internal"), (0, "L1-2", "internal"), (0, "L1-3", "external"), (1, "L1-1", "unresolved")]


def test_acts_of_an_enumeration(spark):
    text = "transposant les directives 93/13/CEE, 97/7/CE et (UE) 2011/83 du Parlement européen, la décision d'exécution n° 12/2001 et portant le règlement (CE) n° 2006/2004"
    found = scan.eu_citations(marks(spark, text), spark.createDataFrame([(c,) for c in ("31993L0013", "31997L0007", "32011L0083", "32004R2006")], "celex string"))
    assert rows(found.select("celex", "transposed")) == [("31993L0013", True), ("31997L0007", True), ("32004R2006", False), ("32011L0083", True)]


def test_instructions_glyphs_and_classes(spark):
    said = spark.createDataFrame([("t", 0, "a"), ("t", 50, "b")], "doc string, at int, code string")
    asked = spark.createDataFrame([("t", 10, 20), ("t", 40, 60), ("u", 0, 9)], "doc string, start int, end int")
    assert rows(scan.governing(said, asked, "doc", "at").select("start", "instruction_code")) == [(0, None), (10, "a"), (40, "b")]
    glyphs = spark.createDataFrame([(chr(0xE001),), (chr(0xE00C),), ("a",)], "g string").select(scan.glyph_number(F.col("g")).alias("n"))
    assert [r["n"] for r in glyphs.collect()] == [1, 12, None]
    pairs = spark.createDataFrame([("L3", "L2"), ("L2", "L1"), ("L9", "L8")], "a string, b string")
    assert rows(edges.renumbering_classes(pairs, "a", "b")) == [("L1", "L1"), ("L2", "L1"), ("L3", "L1"), ("L8", "L8"), ("L9", "L8")]


def test_guards_of_the_passage_edge(spark):
    text = "".join(chr(97 + i % 23) for i in range(60))
    probe = spark.createDataFrame([("p1", True, False, None), ("p2", False, True, None), ("p3", False, False, None), ("p4", False, False, "L1")], "passage string, title boolean, old boolean, destination string")
    probe = probe.withColumns({"dossier": F.lit("d"), "w": F.lit(text)})
    index = spark.createDataFrame([("s", "L1", "d", text)], "segment string, article string, dossier string, w string")
    classes = spark.createDataFrame([("L1", "L1")], "number string, class string")
    found = edges.results_from(probe, index, classes, F.lit(True), [("title_zone", F.col("title"))], F.col("old"))
    assert {r["passage"]: r["reason"] for r in found.collect()} == {"p1": "title_zone", "p2": "prior_art", "p3": None, "p4": None}


def test_content_decides_where_a_number_slid(spark):
    said = [" ".join(f"w{k}{i}" for i in range(20)) for k in range(4)]
    versions = spark.createDataFrame([("L1", said[0]), ("L2", said[1]), ("L3", said[2]), ("L4", said[2])], "number string, text string")
    claims = spark.createDataFrame([("a", "L1", said[0]), ("b", "L1", said[1]), ("c", "L1", said[2]), ("d", "L1", said[3]), ("e", "L9", "few words"), ("f", "L1", None)], "claim string, number string, text string")
    assert rows(edges.content_checked(claims, versions)) == [("a", "L1", "kept"), ("b", "L2", "moved"), ("c", None, "unresolved"), ("d", None, "unresolved"), ("e", "L9", "short"), ("f", "L1", "short")]


# --- joins


def test_similarity_join_against_all_pairs(spark):
    rng = np.random.default_rng(1)
    sets = [sorted({f"w{int(x)}" for x in rng.zipf(1.5, int(rng.integers(0, 9))) if x < 30}) for _ in range(120)]
    df = spark.createDataFrame(list(enumerate(sets)), "a long, words array<string>")
    for least in (0.3, 0.5, 0.8, 1.0):
        want = {(i, j) for i, x in enumerate(sets) for j, y in enumerate(sets) if x and y and len({*x} & {*y}) >= least * len({*x} | {*y}) - 1e-12}
        found = similarity.similarity_join(df, df.withColumnRenamed("a", "b"), "a", "b", "words", least)
        assert {(r["a"], r["b"]) for r in found.collect()} == want


def test_overlaps_against_all_pairs(spark):
    rng = np.random.default_rng(2)
    at = lambda m: dt.datetime(2024, 1, 1) + dt.timedelta(minutes=int(m))
    made = lambda: [(k, int(rng.integers(0, 3)), at(m), at(m + rng.integers(0, 200))) for k, m in enumerate(rng.integers(0, 1000, 60))]
    a, b = made(), made()
    left, right = spark.createDataFrame([*a, (99, 0, None, at(0))], "a long, g int, s timestamp, e timestamp"), spark.createDataFrame(b, "b long, g int, s timestamp, e timestamp")
    want = sorted((x[0], y[0]) for x in a for y in b if x[1] == y[1] and x[2] < y[3] and y[2] < x[3])
    for minutes in (7, 60, 5000):
        assert rows(sections.overlap_join(left, right, "s", "e", minutes * 60_000_000, ["g"]).select("a", "b")) == sorted(want, key=repr)


def test_forward_resolution_against_a_scan(spark):
    rng = np.random.default_rng(3)
    day = lambda n: dt.date(2000, 1, 1) + dt.timedelta(days=int(n))
    lineages = [(k, None if r == 3 and k % 2 else day(rng.integers(0, 40)), r) for k in range(6) for r in range(1, 4)]
    facts = [(int(rng.integers(0, 8)), day(rng.integers(0, 45))) for _ in range(80)] + [(0, None), (None, day(1)), (1, day(3)), (1, day(3))]
    found = temporal.asof_forward(spark.createDataFrame(facts, "k int, d date"), spark.createDataFrame(lineages, "k int, e date, r int"), "k", "d", "e", "r")
    want = []
    for k, d in facts:
        own = [(e, r) for key, e, r in lineages if key == k]
        if own:
            after = [r for e, r in own if d is not None and (e is None or e > d)]
            want.append((k, d, min(after) if after else max(r for _, r in own)))
    assert rows(found) == sorted(want, key=repr)


# --- streams


def test_late_and_repeated_events_of_a_stream(spark, tmp_path):
    at = lambda h, m=0: dt.datetime(2024, 1, 1, h, m)
    batches = [[(1, at(1), "a", 1.0), (2, at(1, 10), "a", 2.0), (2, at(1, 10), "a", 2.0)], [(3, at(9), "a", 4.0)], [(4, at(1, 20), "a", 8.0), (3, at(9), "a", 4.0)], [(5, at(23), "a", 16.0)]]
    schema = "event_id long, ts timestamp, event_type string, value double"
    shapes = {
        "windows": lambda s: counts_by_window(s, "ts", "event_type").select(F.hour("start").alias("x"), "n"),
        "sessions": lambda s: sessions(s, "ts", "event_type").select(F.hour("start").alias("x"), "n"),
        "distinct": lambda s: distinct_events(s, "ts", ["event_id"]).select(F.col("event_id").alias("x"), F.lit(1).alias("n")),
    }
    for batch in batches:
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        for name, shape in shapes.items():
            stream = shape(spark.readStream.schema(schema).parquet(str(tmp_path / "in")))
            run = stream.writeStream.format("parquet").outputMode("append").option("path", str(tmp_path / name)).option("checkpointLocation", str(tmp_path / f"{name}-log"))
            run.trigger(availableNow=True).start().awaitTermination()
    found = {name: rows(spark.read.parquet(str(tmp_path / name))) for name in shapes}
    # The late event's session would end after the watermark, so that it isn't late for that.
    assert found == {"windows": [(1, 3), (9, 2)], "sessions": [(1, 4), (9, 2)], "distinct": [(1, 1), (2, 1), (3, 1), (5, 1)]}
