"""What a reviewer found cut short in the plans."""

import os

import duckdb
import oracle

from spoor import plans, registry  # noqa: F401
from spoor.operators import scan
from spoor.sources.tables import shared_dir


def test_windows_that_share_two_terms_are_ranked(spark, tmp_path):
    docs = [(0, "nothing of note stands here at all. " * 3), (1, "before it. a zephyr over quartz was seen. after it."), (2, "other words fill this one up.")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(7, "zephyr quartz")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    found = registry.QUERIES["idf_rank_windows"](spark, str(tmp_path)).collect()
    assert [(r["item_id"], r["doc_id"], r["rank"]) for r in found] == [(7, 1, 1)]


def same_as_sql(spark, folder, name: str) -> list:
    """Rows of a query over the tables in a folder, which its SQL gives too."""
    con = duckdb.connect()
    for path in folder.glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}/*.parquet')")
    found = oracle.rows_of_spark(registry.QUERIES[name](spark, str(folder)))
    assert found == oracle.rows_of_sql(con, registry.ORACLES[name])
    return found[1]


def test_entities_without_their_semicolon_stay(spark, tmp_path):
    pages = ["<p>cut&amp</p>", "<p>&amp;lt; &amp;amp; &lt;b&gt; &quot;q&quot; &copy &copy; &eacute; &#39; &middot;</p>", "<p>a & b &am</p><p>a paragraph that is long enough</p>", "", None]
    spark.createDataFrame([(i, "u", p) for i, p in enumerate(pages)], "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    rows = same_as_sql(spark, tmp_path, "html_texts")
    assert [r[0] for r in sorted(rows, key=lambda r: r[1])] == [7, 43, 41, 0, None]


def test_bills_are_scanned_and_ruled_without_a_table_between(spark):
    text = "Article 1\nL'article L. 1-1 du code de la consommation est abrogé.\n« Art. L. 1-2. – Texte. »\n\tArticle 2\nL'article L. 1-3 du code de commerce est abrogé."
    texts = spark.createDataFrame([(1, text), (2, text.replace("Texte", "\x01")), (3, None), (4, "")], "id long, text string")
    before = len(os.listdir(shared_dir(spark)))
    covered, aimed = scan.covers(scan.events(texts), "consommation"), scan.targets(scan.events(texts), "consommation")
    assert len(os.listdir(shared_dir(spark))) == before
    one = [("1", "L1-1", "internal", "declared"), ("1", "L1-2", "internal", "written"), ("2", "L1-3", "external", "declared")]
    assert sorted(tuple(r)[:3] + tuple(r)[4:] for r in covered.collect()) == [(i, a, n, s, r) for i in (1, 2) for a, n, s, r in one]
    assert sorted(map(tuple, aimed.collect())) == [(i, n, f) for i in (1, 2) for n, f in (("L1-1", "reference"), ("L1-2", "header"))]


def test_a_header_behind_a_tab_is_a_header(spark):
    texts = spark.createDataFrame([(1, "\tArticle 2\n\x01 L. 1-3"), (2, None), (3, "")], "id long, text string")
    assert sorted(map(tuple, scan.events(texts).select("id", "kind", "start", "key").collect())) == [(1, "header", 0, "2"), (1, "line", 10, None), (1, "reference", 13, "L1-3")]


def test_sections_of_a_text_that_holds_the_fence(spark):
    from spoor.operators import reports

    section = "Article 7 (art. L. 121-3 au L. 121-5)\n" + "mot " * 300
    texts = spark.createDataFrame([(1, "\x01\n" + section + "\nArticle 8\n"), (2, section), (3, None), (4, "")], "document long, text string")
    found = [tuple(r) for r in reports.report_sections(texts).select("document", "article", "start", "end", "declared").orderBy("document").collect()]
    n = ["L121-3", "L121-4", "L121-5"]
    assert found == [(1, "7", 2, 3 + len(section), n), (2, "7", 0, len(section), n)]


def test_sections_hold_one_pattern_for_their_headers(spark):
    from spoor.operators import reports

    plan = reports.report_sections(spark.createDataFrame([(1, "x")], "document long, text string"))._jdf.queryExecution().optimizedPlan().toString()
    # The patterns of sections are asked once, but where a text holds the fence.
    assert plan.count("Article (?:additionnel") == 3


def test_overlaps_are_summed_up_without_pairs(spark):
    import random

    from pyspark.sql import functions as F

    from spoor.operators.sections import overlap_summary

    random.seed(11)
    spans = lambda n: [(i, a, a + random.choice([0, 0, 1, 3, 10, 60, 200])) for i in range(n) for a in [random.randint(-60, 300)]]
    left, right = spans(150), spans(150)
    table = lambda rows, key: spark.createDataFrame(rows, f"{key} long, a long, b long").select(key, *[F.timestamp_micros(c).alias(c) for c in "ab"])
    hits = {o: [q for q, c, d in right if a < d and c < b] for o, a, b in left}
    wanted = sorted((o, len(qs), min(qs), max(qs)) for o, qs in hits.items() if qs)
    for bucket in (1, 7, 1000):
        found = overlap_summary(table(left, "o"), table(right, "q"), "a", "b", bucket, "o", "q")
        assert sorted(map(tuple, found.collect())) == wanted


def test_windows_are_cut_from_runs_of_a_block(spark):
    from pyspark.sql import functions as F

    from spoor.operators import shingles

    texts = ["é" + "abc😀 " * k for k in (0, 3, 11, 12, 13, 40, 700)] + ["", None]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    for width, step, block in ((60, 1, 1024), (60, 10, 1024), (5, 3, 100), (2, 1, 65), (7, 100, 64)):
        found = shingles.block_windows(df, "id", "text", width, step, block)
        wanted = sorted((i, p, t[p : p + width]) for i, t in enumerate(texts) for p in range(0, len(t or "") - width + 1, step))
        assert sorted(map(tuple, found.collect())) == wanted
        hashed = shingles.block_windows(df, "id", "text", width, step, block, hashed=True)
        assert sorted(map(tuple, hashed.collect())) == sorted(map(tuple, found.select("id", "pos", F.xxhash64("w"), F.hash("w")).collect()))
