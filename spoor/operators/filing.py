"""What a proposal is filed on: the article of the code that the part of the text it names would change."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spoor.functions.text import paragraph_list
from spoor.operators.classify import reason_ladder

#: The ranks that follow a number, and how subdivisions and amendments are worded.
RANKS = "bis|ter|quater|quinquies|sexies|septies|octies|nonies|decies|undecies|duodecies|terdecies|quaterdecies|quindecies|sexdecies|septdecies|octodecies|novodecies|vicies|unvicies|duovicies|tervicies"
SUBDIVISION = rf"(?iu)\bart(?:icle)?\.?\s+(premier|1er|\d+)\s*({RANKS})?\b(?:\s*([A-H]{{1,2}})\b)?"
ADDITIONAL = r"(?iu)art\.?\s*add|article\s+additionnel|(?:après|apres|avant)\s+(?:l['’])?\s*art"
PARAGRAPHS = r"(?iu)\b(?:l['’]\s*)?alin[ée]as?\s+(\d{1,3}(?:\s*(?:à|et)\s+\d{1,3})?)\b"
WHOLE = r"(?iu)^\s*(?:I\.\s*[–-]\s*)?(?:supprimer|r[ée]diger ainsi|r[ée]tablir)\s+cet\s+article"
APPENDS = r"(?iu)^\s*(?:I\.\s*[–-]\s*)?compl[ée]ter\s+(?:cet\s+article|l['’]\s*article\s+(?:\d|premier|unique))"
OTHER_NORM = r"(?iu)\b(?:loi|ordonnance|d[ée]cret)\s+(?:organique\s+)?n[°º]|\bordonnance\s+du\s+\d|\bcode\s+(?!de\s+la\s+consommation)(?:de|des|du|d['’]|g[ée]n[ée]ral|mon[ée]taire|rural|civil|p[ée]nal|la|l['’])"
INSERTS = r"(?isu)\bins[ée]r(?:er|é)\b.*[«“]\s*(?:art\.|\d+\s*°|[IVXL]+\s*(?:bis)?\.)"
_NUMBER = r"[LRD]\.?\s*\d+(?:\s*[-‑]\s*\d+)*"
_CITED, _AFTER = rf"(?iu)\b(?:articles?\s+|art\.\s*)({_NUMBER})", rf"(?iu)\b(?:après|apres|avant|à la suite de)\s+(?:le|la|l['’])?\s*articles?\s+{_NUMBER}(?:\s+du\s+code\s+de\s+la\s+consommation)?"
_WRITTEN, _WITH_CODE = rf"[«“]\s*Art\.?\s*({_NUMBER})", rf"(?iu)\barticles?\s+({_NUMBER})\s+du\s+code\s+de\s+la\s+consommation"
_QUOTATION = "[«“][^»”]*[»”]"


def subdivision(label: Column) -> Column:
    """The article of a text that a label names, lower case: "1er", "12 bis a"; null if it names none."""
    part = lambda k: F.lower(F.regexp_extract(label, SUBDIVISION, k))
    head = F.when(part(1) == "premier", "1er").otherwise(part(1))
    return F.when(label.rlike(SUBDIVISION), F.concat_ws(" ", head, F.nullif(part(2), F.lit("")), F.nullif(part(3), F.lit(""))))


def _numbers(text: Column, pattern: str) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), lambda x: F.translate(F.regexp_replace(F.upper(x), r"[\s.]", ""), "‑", "-"))


def named_articles(body: Column) -> Column:
    """Articles of the code that an amendment names outside quotations, writes, or names with the code; none that only tell where."""
    kept = F.regexp_replace(body, _AFTER, " ")
    return F.array_distinct(F.concat(_numbers(F.regexp_replace(kept, _QUOTATION, " "), _CITED), _numbers(kept, _WRITTEN), _numbers(kept, _WITH_CODE)))


def proposals(amendments: DataFrame, label: str = "subdivision", body: str = "dispositif") -> DataFrame:
    """What the routes need to know of each amendment, read from its subdivision and its text; null texts count as empty.

    ``declared`` (articles that the amendment aims at, by another reading) is taken as it comes; other columns stay.
    """
    x, at = F.coalesce(F.col(body), F.lit("")), F.coalesce(F.col(label), F.lit(""))
    outside = F.regexp_replace(x, _QUOTATION, " ")
    return amendments.withColumns({
        "article": subdivision(at), "additional": at.rlike(ADDITIONAL), "paragraphs": F.when(x.rlike(PARAGRAPHS), paragraph_list(F.regexp_extract(x, PARAGRAPHS, 1))).otherwise(F.array().cast("array<int>")),
        "inserts": x.rlike(INSERTS), "appends": x.rlike(APPENDS), "whole": x.rlike(WHOLE), "other_norm": ~x.rlike(WHOLE) & outside.rlike(OTHER_NORM), "written": named_articles(x),
    })


def filings(amendments: DataFrame, covered: DataFrame, chain: DataFrame, paragraphs: DataFrame, unfit: DataFrame | None = None, marks: DataFrame | None = None) -> DataFrame:
    """(proposal, target, route, reason): one row for each target of a proposal, or one with the reason why it has none.

    ``amendments``: as of :func:`proposals`, with proposal, text and declared. ``covered``: text, article, target, null where the
    text changes what isn't of the code or isn't resolved. ``chain``: seed, node, every number before and after each, no siblings.
    ``paragraphs``: text, article, number, status, target. ``unfit``: text, article whose numbering doesn't hold. ``marks``: text,
    article, other_norm, hidden, of articles that change another norm or don't print a paragraph.

    A proposal that declares articles is filed on the one that the article of the text covers; if that isn't exactly one, on the
    one of which a number before or after is declared. Declared articles decide: what contradicts them isn't read further. Else
    paragraphs that it names decide, by what governs them. Else the article as a whole, if it changes one target only.
    Numbers meet by equi-join within an article of a text; the closure is an input and never expanded for siblings.
    """
    key = ["text", "article"]
    targets = covered.groupBy(*key).agg(F.collect_set("target").alias("_targets"), F.max(F.col("target").isNull()).alias("_outside"))
    each = covered.where("target is not null").distinct()
    linked = each.join(chain.select(F.col("seed").alias("target"), F.col("node").alias("_alias")), "target").unionByName(each.select("target", *key, F.col("target").alias("_alias"))).distinct()
    rows = amendments.join(targets, key, "left")
    common = F.array_intersect(F.coalesce("declared", F.array().cast("array<string>")), F.coalesce("_targets", F.array().cast("array<string>")))
    rows = rows.withColumns({"_common": common, "_declares": F.coalesce(F.size("declared") > 0, F.lit(False))})

    def through_chain(column: str, name: str) -> DataFrame:
        asked = rows.select("proposal", *key, F.explode(F.array_distinct(column)).alias("_alias"))
        return asked.join(linked, [*key, "_alias"]).groupBy("proposal").agg(F.collect_set("target").alias(name))

    first = amendments.select("proposal", *key, F.posexplode("paragraphs").alias("_at", "number")).join(paragraphs, [*key, "number"], "left").withColumn("status", F.coalesce("status", F.lit("unreadable")))
    read = first.groupBy("proposal").agg(F.min_by("status", F.when(F.col("status") != "target", F.col("_at"))).alias("_trouble"), F.collect_set("target").alias("_governed"))
    rows = rows.join(through_chain("declared", "_chained"), "proposal", "left").join(through_chain("written", "_near"), "proposal", "left").join(read, "proposal", "left")
    no = F.lit(False)
    for table, columns in ((unfit, ["unfit"]), (marks, ["_other", "_hidden"])):
        if table is None:
            rows = rows.withColumns({c: no for c in columns})
        elif columns == ["unfit"]:
            rows = rows.join(table.select(*key).distinct().withColumn("unfit", F.lit(True)), key, "left")
        else:
            rows = rows.join(table.groupBy(*key).agg(F.max("other_norm").alias("_other"), F.max("hidden").alias("_hidden")), key, "left")
    one = lambda c: F.coalesce(F.size(c) == 1, no)
    has = lambda c: F.coalesce(F.col(c), no)
    by_name, by_paragraph = F.col("_declares"), ~F.col("_declares") & (F.size("paragraphs") > 0)
    default = ~by_name & ~by_paragraph
    several = F.coalesce(F.size("_targets"), F.lit(0)) + has("_outside").cast("int") > 1
    steps = [
        ("additional_article", has("additional")),
        ("unreadable_subdivision", F.col("article").isNull()),
        ("nothing_covered", F.coalesce(F.size("_targets"), F.lit(0)) == 0),
        ("contradicted", by_name & ~one("_common") & ~one("_chained")),
        ("numbering_contradicted", by_paragraph & has("unfit")),
        ("inserts_instruction", by_paragraph & F.col("inserts")),
        ("unreadable_paragraph", by_paragraph & (F.col("_trouble") == "unreadable")),
        ("outside_code", by_paragraph & (F.col("_trouble") == "outside")),
        ("appends", default & F.col("appends")),
        ("several_targets", default & several),
        ("other_norm", default & (has("_other") | F.col("other_norm"))),
        ("hidden_paragraph", default & has("_hidden")),
        ("neighbour_rewritten", default & F.col("whole") & (F.size("written") > 0) & F.col("_near").isNull()),
    ]
    rows = reason_ladder(rows, steps)
    found = F.when(by_name & one("_common"), F.col("_common")).when(by_name, F.col("_chained")).when(by_paragraph, F.col("_governed")).otherwise(F.col("_targets"))
    route = F.when(by_name & one("_common"), "named").when(by_name, "named_before_or_after").when(by_paragraph, "paragraph").when(F.col("whole"), "whole").otherwise("whole_by_default")
    stands = F.col("reason").isNull()
    return rows.select("proposal", F.explode_outer(F.when(stands, found)).alias("target"), F.when(stands, route).alias("route"), "reason")
