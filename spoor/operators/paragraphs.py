"""Paragraph numbers of an article under discussion, as amendments count them.

Some texts print a number above every paragraph, in glyphs of a private font; of the others the lines are counted. Both readings
work on the lines of one row, in the JVM and without a shuffle. An amendment that quotes the head of a paragraph beside its
number confirms or contradicts the reading, and one contradiction takes all numbers of that article out.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spoor.functions.text import running_ends

#: How glyphs stand for numbers. A private code point less GLYPHS is a letter or digit: L to T for 1 to 9; beyond, the
#: leading digit, then A to J for the tens of a hundred, and last a to j for the units.
GLYPHS, ONES, TENS, UNITS = 0xF000, "LMNOPQRST", "ABCDEFGHIJ", "abcdefghij"
#: White space with the spaces that French typography doesn't break at.
SPACE = r"[\s\u00A0\u202F]"
#: Lines that only say what became of a text, and what opens a paragraph.
STATUS = rf"(?iu)^{SPACE}*(?:\(?{SPACE}*(?:non modifiée?s?|supprimée?s?|conformes?|suppression (?:maintenue|conforme)){SPACE}*\)?|\([^()]{{1,80}}\)){SPACE}*$"
HEAD = (
    rf"^{SPACE}*(?:[«“(\[]|[–-]{SPACE}|\d+{SPACE}*[°)]|[a-z]{{1,2}}(?:{SPACE}+(?:bis|ter|quater))?\)"
    rf"|[IVXL]+(?:{SPACE}*(?:bis|ter|quater|quinquies|sexies))?(?:{SPACE}*\([^)\n]{{1,20}}\))?{SPACE}*[.)]"
    rf"|[A-H](?:{SPACE}+(?:bis|ter|quater))?(?:{SPACE}*\([^)\n]{{1,20}}\))?{SPACE}*\.{SPACE}*[–-])"
)
PRINTED = rf"^{SPACE}*[\x{{E000}}-\x{{F8FF}}]{{1,3}}{SPACE}*$"
QUOTED, BRACKETED = rf"^{SPACE}*[«“]", rf"^{SPACE}*\["
#: An amendment that writes a paragraph anew and says which: its number, and the head of an article after the opening quote.
ANCHOR = r"(?isu)^\s*(?:I\.\s*[–-]\s*)?alin[ée]a\s+(\d{1,3})\s*(?:,[^«“]{0,40}?)?\s*:?\s*r[ée]diger ainsi cet alin[ée]a\s*:?\s*[«“]\s*(art\.?\s*[LRD]\.?\s*\d+(?:[-‑]\d+)+)"
#: Characters of a paragraph's head that anchors are compared with.
OPENING = 40


_LETTERS = "0123456789" + ONES + TENS + UNITS
_PRIVATE = "".join(chr(GLYPHS + ord(c)) for c in _LETTERS)


def printed_number(glyphs: Column) -> Column:
    """The number that one to three glyphs stand for; null if they stand for none."""
    x = F.translate(F.regexp_replace(glyphs, SPACE, ""), _PRIVATE, _LETTERS)
    place = lambda letters, k: F.instr(F.lit(letters), F.substring(x, k, 1))
    first = F.substring(x, 1, 1).try_cast("int")
    return (
        F.when(x.rlike(f"^[{ONES}]$"), place(ONES, 1))
        .when(x.rlike(f"^[0-9][{UNITS}]$"), first * 10 + place(UNITS, 2) - 1)
        .when(x.rlike(f"^[0-9][{TENS}][{UNITS}]$"), first * 100 + (place(TENS, 2) - 1) * 10 + place(UNITS, 3) - 1)
    )


def printed(number: Column) -> Column:
    """The glyphs of a number from 1 to 999."""
    letter = lambda letters, k: F.substring(F.lit(letters), k.cast("int") + 1, F.lit(1))
    tens = F.floor(number / 10)
    return F.translate(
        F.when(number < 10, letter(ONES, number - 1))
        .when(number < 100, F.concat(tens.cast("string"), letter(UNITS, number % 10)))
        .otherwise(F.concat(F.floor(number / 100).cast("string"), letter(TENS, tens % 10), letter(UNITS, number % 10))),
        _LETTERS,
        _PRIVATE,
    )


def squeezed(text: Column) -> Column:
    """Lower case without white space and opening quotes, hyphens alike: what anchors are compared by."""
    return F.regexp_replace(F.translate(F.regexp_replace(F.lower(text), SPACE, ""), "‑", "-"), "^[«“]+", "")


def _lines(body: Column, offset: Column) -> Column:
    """The lines that aren't blank, with their places in the text and what they look like."""
    parts = F.split(body, "\n", -1)
    each = F.zip_with(
        running_ends(F.transform(parts, lambda p: F.length(p) + 1)),
        parts,
        lambda end, p: F.struct(
            (end - 1 - F.length(p) + offset).cast("int").alias("start"), (end - 1 + offset).cast("int").alias("end"), p.alias("line"), p.rlike(PRINTED).alias("is_number"),
            F.when(p.rlike(PRINTED), printed_number(p)).alias("printed"), p.rlike(STATUS).alias("status"), p.rlike(HEAD).alias("head"), p.rlike(QUOTED).alias("quoted"),
        ),
    )
    return F.filter(each, lambda x: x["line"].rlike(r"[^\s\u00A0\u202F]"))


def lines(articles: DataFrame, body: str = "body", offset: str = "offset") -> DataFrame:
    """(text, article, line, start, end) of every line that isn't blank."""
    each = articles.select("text", "article", F.explode(_lines(F.coalesce(F.col(body), F.lit("")), F.coalesce(F.col(offset), F.lit(0)))).alias("x"))
    return each.select("text", "article", "x.line", "x.start", "x.end")


_PARAGRAPH = "array<struct<number:int,start:int,end:int,opening:string>>"


def _paragraph(number: Column, start: Column, end: Column, line: Column) -> Column:
    return F.struct(number.cast("int").alias("number"), start.alias("start"), end.alias("end"), F.substring(squeezed(line), 1, OPENING).alias("opening"))


def _counted(lines: Column) -> Column:
    """Every line is a paragraph, but for those that say a status; one between two quoted lines that opens nothing wraps the first."""
    quoted = lambda i: F.coalesce(F.get(lines, i)["quoted"], F.lit(False))
    wraps = lambda i: ~F.coalesce(F.get(lines, i)["head"], F.lit(True)) & quoted(i - 1) & quoted(i + 1)
    marked = F.transform(lines, lambda x, i: F.struct(x.alias("x"), F.when(wraps(i + 1), F.get(lines, i + 1)["end"]).otherwise(x["end"]).alias("end"), wraps(i).alias("wraps")))
    kept = F.filter(marked, lambda m: ~m["wraps"] & ~m["x"]["status"])
    return F.transform(kept, lambda m, i: _paragraph(i + 1, m["x"]["start"], m["end"], m["x"]["line"]))


def _printed(lines: Column) -> tuple[Column, Column]:
    """(paragraphs, why the reading stopped): the line under each number, while they run on from 1 with one line under each."""
    at = F.filter(F.transform(lines, lambda x, i: F.when(x["is_number"], i)), lambda i: i.isNotNull())
    above = F.exists(F.slice(lines, 1, F.get(at, F.lit(0))), lambda x: ~x["status"] & ~x["line"].rlike(BRACKETED))

    def state(i: Column, k: Column) -> Column:
        last = k == F.size(at) - 1
        under = F.coalesce(F.get(at, k + 1), F.size(lines)) - i - 1
        return F.when(~F.coalesce(F.get(lines, i)["printed"] == k + 1, F.lit(False)), "out_of_turn").when(under == 0, "no_line").when(~last & (under > 1), "two_lines").otherwise("")

    states = F.transform(at, state)
    bad = F.filter(F.transform(states, lambda s, k: F.when(s != "", k)), lambda k: k.isNotNull())
    good = F.coalesce(F.get(bad, F.lit(0)), F.size(at))
    read = F.transform(F.slice(at, 1, good), lambda i, k: _paragraph(k + 1, F.get(lines, i + 1)["start"], F.get(lines, i + 1)["end"], F.get(lines, i + 1)["line"]))
    return F.when(above, F.array().cast(_PARAGRAPH)).otherwise(read.cast(_PARAGRAPH)), F.when(above, "line_above").otherwise(F.nullif(F.get(states, F.get(bad, F.lit(0))), F.lit("")))


def numberings(articles: DataFrame, body: str = "body", offset: str = "offset") -> DataFrame:
    """``articles`` (text, article, body, offset) as (text, article, mode, stopped, paragraphs), one row each.

    ``mode`` is printed where a line of glyphs stands, else counted. ``stopped`` says why a printed reading ends early: line_above
    (nothing is read), out_of_turn, no_line or two_lines; what comes after isn't numbered rather than wrongly. Paragraphs are
    (number, start, end, opening), places in the text. A null or blank body is counted and has none. Rows stay where they are.
    """
    kept = [c for c in articles.columns if c not in (body, offset)]
    lines = articles.select(*kept, _lines(F.coalesce(F.col(body), F.lit("")), F.coalesce(F.col(offset), F.lit(0))).alias("_lines"))
    read, stopped = _printed(F.col("_lines"))
    is_printed = F.exists("_lines", lambda x: x["is_number"])
    return lines.select(
        *kept, F.when(is_printed, "printed").otherwise("counted").alias("mode"), F.when(is_printed, stopped).alias("stopped"), F.when(is_printed, read).otherwise(_counted(F.col("_lines")).cast(_PARAGRAPH)).alias("paragraphs")
    )


def anchors(amendments: DataFrame, read: DataFrame, body: str = "dispositif") -> DataFrame:
    """(amendment, text, article, confirmed): amendments that quote a paragraph's head beside its number, against the reading.

    ``amendments``: amendment, text, article and their text. Those on an article that wasn't read say nothing. Only amendments that
    quote are shuffled, and of the readings only articles that they name.
    """
    said = amendments.where(F.col(body).rlike(ANCHOR)).select("amendment", "text", "article", F.regexp_extract(body, ANCHOR, 1).cast("int").alias("_number"), squeezed(F.regexp_extract(body, ANCHOR, 2)).alias("_head"))
    met = said.join(read.select("text", "article", "paragraphs"), ["text", "article"])
    held = F.exists("paragraphs", lambda p: (p["number"] == F.col("_number")) & p["opening"].startswith(F.col("_head")))
    return met.select("amendment", "text", "article", held.alias("confirmed"))


def paragraph_numbers(read: DataFrame, checked: DataFrame | None = None) -> DataFrame:
    """(text, article, number, start, end) of readings that no anchor of ``checked`` contradicts."""
    if checked is not None:
        read = read.join(checked.where("not confirmed").select("text", "article").distinct(), ["text", "article"], "left_anti")
    return read.select("text", "article", F.explode("paragraphs").alias("p")).select("text", "article", "p.number", "p.start", "p.end")


def governed(paragraphs: DataFrame, instructions: DataFrame, divisions: DataFrame | None = None) -> DataFrame:
    """Paragraphs with ``status`` and ``target``: the last instruction that begins before the paragraph ends governs it.

    ``instructions``: text, article, start, target, scope. A null scope is a bound without a known target: unreadable, as is a
    paragraph before any instruction or one of ``divisions`` (text, article, start). Another scope than internal is outside.
    """
    own = [c for c in paragraphs.columns if c not in ("text", "article")]
    left = paragraphs.select("text", "article", F.col("end").alias("_at"), F.lit(1).alias("_side"), F.struct(*own).alias("_p"))
    right = instructions.select("text", "article", F.col("start").alias("_at"), F.lit(0).alias("_side"), F.struct("target", "scope").alias("_i"))
    w = Window.partitionBy("text", "article").orderBy("_at", "_side", "_i").rowsBetween(Window.unboundedPreceding, 0)
    both = left.unionByName(right, allowMissingColumns=True).withColumn("_i", F.last("_i", ignorenulls=True).over(w)).where("_side = 1")
    found = both.select("text", "article", "_p.*", "_i.target", "_i.scope")
    if divisions is not None:
        found = found.join(divisions.select("text", "article", "start", F.lit(True).alias("_division")).distinct(), ["text", "article", "start"], "left")
    bad = F.coalesce(F.col("_division"), F.lit(False)) if divisions is not None else F.lit(False)
    status = F.when(bad | F.col("scope").isNull(), "unreadable").when(F.col("scope") != "internal", "outside").otherwise("target")
    return found.select("text", "article", "number", "start", "end", status.alias("status"), F.when(status == "target", F.col("target")).alias("target"))
