"""Tables of concordance read from positioned blocks: which article of an act stands in a line with which article of a code.

A page is a set of blocks of text with their boxes and the direction of their writing, as a reader of documents gives them. A
line of a table begins at the act's article in the act's column and goes on to the next one; the code's articles at the head
of the line's other cells are those that the table sets against it. What a cell cites further on is no such article.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spoor.functions.text import collapsed, folded
from spoor.operators.classify import reason_ladder
from spoor.operators.scan import DASHES, PARTS, any_of
from spoor.operators.sections import in_bands
from spoor.operators.temporal import asof_preferred
from spoor.sources.tables import written as stored

# --- fixed values: words of such documents, accents aside where a text is compared without them
TITLES = ("tableau de concordance", "tableau de transposition")
ACT_KINDS = {"directive": "L", "reglement": "R"}
ANNEX = "annexe"
OWN_CODE = r"code\s+de\s+la\s+consommation|C\.\s?conso"
OTHER_CODES = ("de", "des", "du", "d['’]", "general", "monetaire", "rural", "civil", "penal")
OTHER_SHORT = ("CJA", "CSP", "CMF", "CGI", "CPC")
BULLET = ""
#: Characters of a page's top and about its title, blocks and length of a column's header, and of a cell after its head.
TOP, ABOUT, HEADERS, HEADER_LENGTH, CELL = 500, 250, 15, 120, 120
#: Fixed values, in points: an anchor may stand so much below its line's top; blocks nearer than this share a column.
SAME_LINE, SAME_COLUMN = 8.0, 30.0

_TITLE = rf"(?iU){any_of(TITLES)}"
_ANNEX = rf"(?iUmd)^\s*(?:\d+\s+)?{ANNEX}\b"
_ACT = rf"(?iU)({'|'.join(ACT_KINDS)})\s+(?:\(UE\)\s*)?(?:n°\s*)?(?:(\d{{4}})/(\d{{1,4}})|(\d{{1,4}})/(\d{{4}}))"
_ACT_ARTICLE = rf"(?iUmd)^\s*(?:{BULLET}\s*)?Art(?:icle)?\.?\s*(\d{{1,3}})(?:\s*(?:[-§(.]|point)\s*(\d{{1,3}}))?(?![\d-])"
_NUMBER = rf"(?U)\b[{PARTS}]\.?\s?\d{{3}}(?:[{DASHES}]\d{{1,3}}){{1,3}}(?![\d{DASHES}])"
_HEAD = rf"(?iU)\A[^\w«“\"]*(?:Art(?:icles?|\.)?\s*)?[{PARTS}]\.?\s?\d{{3}}[{DASHES}]\d"
_OTHER = rf"(?iU)\bcode\s+(?!de\s+la\s+consommation)(?:{'|'.join(OTHER_CODES)})|\b(?:{'|'.join(OTHER_SHORT)})\b"


def in_frame(blocks: DataFrame) -> DataFrame:
    """``blocks`` plus ``line`` and ``column``, the place in the table's own frame.

    ``blocks``: dx, dy (direction of writing), x0, y0, x1, y1. Upright writing has its lines down the page; on a page turned by a
    quarter they go across it, and columns go up. Both are null where the direction is.
    """
    upright = F.abs("dx") >= F.abs("dy")
    place = lambda level, across: F.when(upright, level).when(~upright, across).cast("double")
    return blocks.withColumns({"line": place(F.col("y0"), F.col("x0")), "column": place(F.col("x0"), -F.col("y1"))})


def _before(text: Column, pattern: str) -> Column:
    """Characters before a pattern's first place; all of them where it has none."""
    return F.length(F.get(F.split(text, pattern, 2), F.lit(0)))


def tables_begun(pages: DataFrame) -> DataFrame:
    """(document, page, celex, run): pages within a table, with its act; ``run`` counts the tables of a document.

    ``pages``: document, page, text. A title with an act near it begins a table, which goes on over pages without either until the
    next one or an annex that is none. A title that names no act changes nothing; pages before the first table have no row.
    """
    top = F.substring("text", 1, TOP)
    at, length = _before(folded(top), _TITLE), F.length(F.regexp_extract(folded(top), _TITLE, 0))
    start = F.greatest(at - ABOUT, F.lit(0))
    near = folded(F.substring(top, start + 1, at + length + ABOUT - start))
    part = lambda k: F.regexp_extract(near, _ACT, k)
    letter = F.lit(None).cast("string")
    for kind, sign in ACT_KINDS.items():
        letter = F.when(F.lower(part(1)) == kind, sign).otherwise(letter)
    year, number = F.when(part(2) != "", part(2)).otherwise(part(5)), F.when(part(2) != "", part(3)).otherwise(part(4))
    titled = folded(top).rlike(_TITLE)
    opened = F.when(titled & near.rlike(_ACT), F.concat(F.lit("3"), year, letter, F.lpad(number.cast("int").cast("string"), 4, "0")))
    event = F.when(opened.isNotNull(), F.struct(opened.alias("celex"))).when(~titled & folded(top).rlike(_ANNEX), F.struct(F.lit(None).cast("string").alias("celex")))
    so_far = Window.partitionBy("document").orderBy("page").rowsBetween(Window.unboundedPreceding, 0)
    rows = pages.select("document", "page", event.alias("_event"), opened.isNotNull().cast("long").alias("_opens"))
    rows = rows.select("document", "page", F.last("_event", ignorenulls=True).over(so_far)["celex"].alias("celex"), F.sum("_opens").over(so_far).alias("run"))
    return rows.where("celex is not null")


def concordances(pages: DataFrame, blocks: DataFrame, acts: DataFrame) -> DataFrame:
    """(document, page, celex, act_article, paragraph, number, proof, line, column, ordinal): what tables set against each other.

    ``pages``: document, page, text. ``blocks``: document, page, dx, dy, x0, y0, x1, y1, text. ``acts``: celex, of which tables are read.
    The act's column is that of the leftmost article of it. A cell counts that opens with an article of the code, if its beginning
    names the code, or a column's header has named it in the table so far and the beginning names no other. ``paragraph`` is empty
    where none is written; ``ordinal`` counts the articles of a head from 0. Null texts, boxes and directions give no row. A
    block that repeats gives its rows again. A page's blocks and a document's pages are sorted together, and spill.
    """
    known = tables_begun(pages).join(acts.select("celex").distinct(), "celex", "left_semi")
    text = F.col("text")
    anchor = F.regexp_extract(text, _ACT_ARTICLE, 0)
    ends = _before(text, _ACT_ARTICLE) + F.length(anchor)
    is_anchor = text.rlike(_ACT_ARTICLE) & ~F.substring(text, F.lit(1), ends + 3).rlike(_NUMBER)
    names_own = lambda c: c.rlike(f"(?iU){OWN_CODE}")
    page, turn = Window.partitionBy("document", "page"), ["line", "column", "text"]
    rows = in_frame(blocks.select("document", "page", "dx", "dy", "x0", "y0", "x1", "y1", "text")).where("line is not null and column is not null and text is not null")
    rows = rows.join(known, ["document", "page"]).select("document", "page", "celex", "run", *turn, is_anchor.alias("_anchor"))
    rows = rows.withColumns({"_turn": F.row_number().over(page.orderBy(*turn)), "_act_column": F.min(F.when(F.col("_anchor"), F.col("column"))).over(page)})
    heads = (F.col("_turn") <= HEADERS) & names_own(text) & (F.length(text) < HEADER_LENGTH)
    # Rows of a page are peers, so the running maximum takes in the page itself.
    rows = rows.withColumn("_header", F.max(heads).over(Window.partitionBy("document", "run").orderBy("page")))
    beside = F.abs(F.col("column") - F.col("_act_column")) >= SAME_COLUMN
    part = lambda k: F.regexp_extract(text, _ACT_ARTICLE, k)
    last = F.max_by(F.struct(part(1).alias("article"), part(2).alias("paragraph"), anchor.alias("said")), F.struct("column", "text"))
    anchors = rows.where(F.col("_anchor") & ~beside).groupBy("document", "page", "line").agg(last.alias("a")).select("document", "page", "line", "a.*")
    head = F.get(F.filter(F.split(text, "\n"), lambda x: x.rlike(r"(?U)\w")), F.lit(0))
    beginning = F.substring(text, F.lit(1), F.instr(text, F.col("head")) - 1 + F.length("head") + CELL)
    cells = rows.where(beside & text.rlike(_HEAD)).withColumn("head", head)
    cells = cells.where(names_own(beginning) | (F.col("_header") & ~folded(beginning).rlike(_OTHER))).select("document", "page", "line", "column", "celex", "head")
    numbers = F.regexp_extract_all(F.col("head"), F.lit(_NUMBER), F.lit(0))
    found = in_bands(anchors, cells, ["document", "page"], "line", SAME_LINE).select("*", F.posexplode(numbers).alias("ordinal", "_written"))
    number = F.regexp_replace(F.regexp_replace("_written", r"(?U)[.\s]", ""), f"[{DASHES}]", "-")
    proof = collapsed(F.concat("anchor_said", F.lit(" — "), F.col("head")))
    return found.select("document", "page", "celex", F.col("anchor_article").alias("act_article"), F.col("anchor_paragraph").alias("paragraph"), number.alias("number"), proof.alias("proof"), "line", "column", "ordinal")


def transposes_article(found: DataFrame, studies: DataFrame, declared: DataFrame, lineages: DataFrame, written: DataFrame) -> DataFrame:
    """Rows of :func:`concordances` with ``lineage`` and the ``reason`` why a row is no edge, null where it is one.

    ``studies``: document, dossier, day, one row a document. ``declared``: celex, number of the articles that an act has. ``lineages``: number, end, lineage;
    ``written``: number, dossier, lineage that a dossier wrote. Numbers are those of the bill, so they are resolved on the
    dossier's day, the lineage alone that the dossier wrote first; rejected rows have none. Of rows that say the same in a document the first is the edge.
    """
    papers = studies.select("document", "dossier", "day", F.lit(True).alias("_study"))
    acts = declared.select("celex", F.col("number").alias("act_article"), F.lit(True).alias("_declared")).distinct()
    rows = stored(found.join(papers, "document", "left").join(acts, ["celex", "act_article"], "left"))
    asked = rows.where("_study and _declared").select("number", "dossier", "day").distinct()
    told = asof_preferred(asked, lineages.select("number", "end", "lineage"), written.select("number", "dossier", "lineage"), "number", "dossier", "day", "end", "lineage")
    told = told.select(F.col("number").alias("_number"), F.col("dossier").alias("_dossier"), F.col("day").alias("_day"), "lineage")
    same = (F.col("number") == F.col("_number")) & F.col("dossier").eqNullSafe(F.col("_dossier")) & F.col("day").eqNullSafe(F.col("_day"))
    rows = rows.join(told, same & F.col("_study") & F.col("_declared"), "left").drop("_number", "_dossier", "_day")
    steps = [("unknown_act_article", F.col("_declared").isNull()), ("no_document", F.col("_study").isNull()), ("unresolved", F.col("lineage").isNull())]
    rows = reason_ladder(rows, steps)
    edge = Window.partitionBy("document", "celex", "act_article", "paragraph", "number", "lineage", "reason").orderBy("page", "line", "column", "ordinal", "proof")
    again = F.col("reason").isNull() & (F.row_number().over(edge) > 1)
    return rows.withColumn("reason", F.when(again, "repeated").otherwise(F.col("reason"))).select(*found.columns, "lineage", "reason")
