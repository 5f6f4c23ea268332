"""Scalar text functions as column expressions; the few that Spark lacks are vectorised."""

import html
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Accented letters and what each folds to, one for one.
ACCENTS = "àâäáãåçéèêëíìîïñóòôöõúùûüýÿÀÂÄÁÃÅÇÉÈÊËÍÌÎÏÑÓÒÔÖÕÚÙÛÜÝ"
FOLDED = "aaaaaaceeeeiiiinooooouuuuyyAAAAAACEEEEIIIINOOOOOUUUUY"
#: Month names of prose dates.
MONTHS = ("janvier", "février", "mars", "avril", "mai", "juin", "juillet", "août", "septembre", "octobre", "novembre", "décembre")


@F.pandas_udf(StringType())
def nfkc(texts: pd.Series) -> pd.Series:
    """Unicode compatibility composition, which Spark has no expression for."""
    return texts.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t))


@F.pandas_udf(StringType())
def html_unescape(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else html.unescape(t))


def collapsed(text: Column) -> Column:
    """Runs of white space, no-break spaces too, as one space; none at either end."""
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def normalised(text: Column, compose: bool = True) -> Column:
    """Composed, lower case, curly apostrophes straight, quotation marks dropped, white space collapsed."""
    plain = nfkc(text) if compose else text
    return collapsed(F.translate(F.lower(plain), "’‘ʼ«»“”\"", "'''"))


def normalised_strict(text: Column, compose: bool = True) -> Column:
    """:func:`normalised`, soft hyphens dropped and every dash a hyphen."""
    return normalised(F.translate(text, "‐‑‒–—−­", "------"), compose)


def strip_tags(markup: Column, blocks: str = "\n") -> Column:
    """Text of markup without scripts, styles and comments; block ends and breaks become ``blocks``. Entities stay."""
    out = F.regexp_replace(markup, r"(?is)<(script|style)\b.*?</\1>|<!--.*?-->", "")
    out = F.regexp_replace(out, r"(?i)<br\s*/?>|</(p|div|li|h[1-6]|tr|article|title)>", blocks)
    return F.regexp_replace(out, r"<[^>]*>", "")


def html_text(markup: Column, blocks: str = "\n", entities: dict[str, str] | None = None) -> Column:
    """:func:`strip_tags` with entities resolved, spaces collapsed within lines and empty lines dropped.

    With ``entities`` those alone are resolved, as they are written and in their order; else all that HTML knows, which takes
    some without their semicolon too.
    """
    plain = strip_tags(markup, blocks)
    if entities is None:
        plain = html_unescape(plain)
    for name, text in (entities or {}).items():
        plain = F.replace(plain, F.lit(name), F.lit(text))
    lines = F.transform(F.split(plain, "\n"), lambda x: collapsed(x))
    return F.array_join(F.filter(lines, lambda x: x != ""), "\n")


def paragraphs(markup: Column, least: int = 15) -> Column:
    """Texts of paragraphs, split at their ends and at breaks, of at least ``least`` characters."""
    parts = F.split(markup, r"(?i)</p>|<br\s*/?>")
    return F.filter(F.transform(parts, lambda x: collapsed(F.regexp_replace(x, r"<[^>]*>", ""))), lambda x: F.length(x) >= least)


def words(text: Column) -> Column:
    """Lower-case runs of letters, digits and underscores, of any script."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"(?U)\w+"), F.lit(0))


def word_trigrams(text: Column) -> Column:
    """Distinct runs of three words, joined by spaces; none if there are fewer, or no text."""
    none = F.array().cast("array<string>")

    def runs(w: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(w) - 2, F.lit(1)))
        return F.when(F.coalesce(F.size(w), F.lit(0)) < 3, none).otherwise(F.array_distinct(F.transform(starts, lambda i: F.array_join(F.slice(w, i, 3), " "))))

    # The words once a text, through an array of one: what a lambda names, it computes for each element.
    return F.get(F.transform(F.array(words(text)), runs), F.lit(0))


def folded(text: Column) -> Column:
    """Accents dropped, one character for one, so that offsets hold."""
    return F.translate(text, ACCENTS, FOLDED)


def terms(text: Column, stopwords: tuple[str, ...] = (), least: int = 4) -> Column:
    """Lower-case unaccented terms of ``least`` letters and digits or more; a plural s goes beyond five letters, not from ss.

    A term goes if it is among ``stopwords``, as it stands or without its s.
    """
    without = lambda terms: F.filter(terms, lambda t: ~t.isin(*stopwords)) if stopwords else terms
    found = F.regexp_extract_all(folded(F.lower(text)), F.lit("[a-z0-9]{%d,}" % least), F.lit(0))
    return without(F.transform(without(found), lambda t: F.when((F.length(t) > 5) & t.endswith("s") & ~t.endswith("ss"), F.substring(t, F.lit(1), F.length(t) - 1)).otherwise(t)))


#: Members of a block of :func:`running_ends`.
_BLOCK = 64


def running_ends(lengths: Column) -> Column:
    """The running totals of an array of whole numbers, each with its own.

    Totals are taken within blocks and over blocks, as appending to one array costs its length each time.
    """
    none = F.array().cast("array<int>")

    def totals(values: Column, start: Column) -> Column:
        step = lambda s, x: F.struct((s["at"] + x).cast("int").alias("at"), F.array_append(s["out"], (s["at"] + x).cast("int")).alias("out"))
        return F.aggregate(values, F.struct(start.cast("int").alias("at"), none.alias("out")), step, lambda s: s["out"])

    def in_blocks(lengths: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / _BLOCK).cast("int")), lambda b: F.slice(lengths, b * _BLOCK + 1, F.lit(_BLOCK)))
        return F.get(F.transform(F.array(blocks), over), F.lit(0))

    def over(parts: Column) -> Column:
        sums = F.transform(parts, lambda p: F.aggregate(p, F.lit(0), lambda s, x: s + x))
        before = F.concat(F.array(F.lit(0)), F.slice(totals(sums, F.lit(0)), 1, F.size(parts) - 1))
        return F.flatten(F.zip_with(parts, before, totals))

    # One evaluation of the lengths and of the blocks: a lambda over an array of one.
    of = lambda x: F.when(F.size(x) == 0, none).when(F.size(x) <= _BLOCK, totals(x, F.lit(0))).when(F.size(x) > 0, in_blocks(x)).otherwise(none)
    return F.get(F.transform(F.array(lengths), of), F.lit(0))


def places(text: Column, pattern: str) -> Column:
    """array<struct<start,end,hit>> of the leftmost matches of a pattern that don't overlap, in code points; none in a null text.

    What split() leaves between the matches and the matches themselves, in turn, give the places.
    """

    def of(x: Column) -> Column:
        ends = running_ends(F.zip_with(x["gaps"], x["hits"], lambda g, h: F.length(g) + F.length(h)))
        return F.zip_with(ends, x["hits"], lambda e, h: F.struct((e - F.length(h)).alias("start"), e.alias("end"), h.alias("hit")))

    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    both = F.struct(F.slice(F.split(text, pattern, -1), 1, F.size(hits)).alias("gaps"), hits.alias("hits"))
    return F.when(text.rlike(pattern), F.get(F.transform(F.array(both), of), F.lit(0))).otherwise(F.array().cast("array<struct<start:int,end:int,hit:string>>"))


#: Stands around the matches where places are told, unless a text holds it; one byte, as wider ones make the JVM's strings twice as long.
_FENCE = "\x01"


def fenced(text: Column, pattern: str) -> Column:
    """array<string>: what lies before, between and behind the matches of a pattern, and each match, in turn, by one pass over the text."""

    def apart(x: Column) -> Column:
        return F.flatten(F.zip_with(x["gaps"], x["hits"], lambda g, h: F.when(h.isNull(), F.array(g)).otherwise(F.array(g, h))))

    both = F.struct(F.split(text, pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"))
    fast = F.split(F.regexp_replace(text, pattern, f"{_FENCE}$0{_FENCE}"), _FENCE, -1)
    return F.when(text.contains(_FENCE), F.get(F.transform(F.array(both), apart), F.lit(0))).otherwise(fast)


def places_once(text: Column, pattern: str) -> Column:
    """:func:`places` by one pass over the text, for patterns that cost more than arrays do. The pattern is to match no empty string."""

    def of(parts: Column) -> Column:
        return F.transform(F.array(F.struct(parts.alias("parts"), running_ends(F.transform(parts, F.length)).alias("ends"))), cut)

    def cut(x: Column) -> Column:
        at = F.sequence(F.lit(1), F.size(x["parts"]) - 2, F.lit(2))
        return F.transform(at, lambda i: F.struct(F.get(x["ends"], i - 1).alias("start"), F.get(x["ends"], i).alias("end"), F.get(x["parts"], i).alias("hit")))

    none = F.array().cast("array<struct<start:int,end:int,hit:string>>")
    found = F.transform(F.array(fenced(text, pattern)), lambda parts: F.when(F.size(parts) > 1, F.get(of(parts), F.lit(0))).otherwise(none))
    return F.when(text.isNull(), none).otherwise(F.get(found, F.lit(0)))


def evidence(text: Column, start: Column, end: Column, width: int = 200, least: int = 60) -> Column:
    """About ``width`` characters around a span, spaces collapsed; null if fewer than ``least`` are left."""
    begin = F.greatest(F.lit(0), F.floor((start + end - width) / 2)).cast("int")
    out = collapsed(F.substring(text, begin + 1, F.lit(width)))
    return F.when(F.length(out) >= least, out)


def excerpt(text: Column, most: int = 400, absent: str = "(no text)") -> Column:
    """A text cut at ``most`` characters with an ellipsis, or a notice where there is none."""
    return F.when(F.coalesce(F.length(text), F.lit(0)) == 0, absent).when(F.length(text) > most, F.concat(F.substring(text, F.lit(1), F.lit(most)), F.lit("…"))).otherwise(text)


def date_in(label: Column) -> Column:
    """The first date in a label, ISO or in French prose; null if neither, or if there is no such day."""
    iso = F.regexp_extract(label, r"\d{4}-\d{2}-\d{2}", 0)
    prose = r"(?iU)\b(\d{1,2})(?:er)?\s+(" + "|".join(MONTHS) + r")\s+(\d{4})"
    month = F.array_position(F.array(*map(F.lit, MONTHS)), F.lower(F.regexp_extract(label, prose, 2)))
    text = F.concat_ws("-", F.regexp_extract(label, prose, 3), F.lpad(month.cast("string"), 2, "0"), F.lpad(F.regexp_extract(label, prose, 1), 2, "0"))
    return F.coalesce(F.when(iso != "", F.try_to_date(iso)), F.when(month > 0, F.try_to_date(text)))


def prose_date(day: Column) -> Column:
    """A date as French prose, the first of a month as an ordinal."""
    number = F.when(F.dayofmonth(day) == 1, "1er").otherwise(F.dayofmonth(day).cast("string"))
    return F.concat_ws(" ", number, F.element_at(F.array(*map(F.lit, MONTHS)), F.month(day)), F.year(day).cast("string"))


def natural_key(number: Column) -> list[Column]:
    """Sort keys by which "9" comes before "73 rect."; what holds no digit comes first."""
    return [F.regexp_replace(number, r"\D", "").try_cast("long"), number]


def article_number(label: Column) -> Column:
    """A canonical article number: letter and up to four numeric parts, e.g. L121-84-10-1; null if there is none."""
    hit = r"\b([LRDA])\.?\s*(\d+(?:-\d+){0,3})(?![-\d])"
    return F.when(label.rlike(hit), F.concat(F.regexp_extract(label, hit, 1), F.regexp_extract(label, hit, 2)))


def article_range(label: Column, most: int = 40) -> Column:
    """Numbers of a range such as "L. 111-1 à L. 111-3", ends included; none if books differ or ``most`` or more lie apart."""
    hit = r"\b([LRD])\.?\s*(\d+)-(\d+)\s+(?:à|to)\s+(?:([LRD])\.?\s*)?(\d+)-(\d+)"
    part = lambda k: F.regexp_extract(label, hit, k)
    parts = F.struct(part(1).alias("part"), part(2).alias("book"), part(3).try_cast("int").alias("low"), part(4).alias("other"), part(5).alias("its_book"), part(6).try_cast("int").alias("high"))

    def numbers(x: Column) -> Column:
        low, high = x["low"], x["high"]
        same = (x["book"] == x["its_book"]) & ((x["other"] == "") | (x["other"] == x["part"])) & (high >= low) & (high - low < most)
        return F.when(same, F.transform(F.sequence(low, F.greatest(low, high)), lambda i: F.concat(x["part"], x["book"], F.lit("-"), i.cast("string")))).otherwise(F.array().cast("array<string>"))

    # The parts once a label, through an array of one.
    return F.get(F.transform(F.array(parts), numbers), F.lit(0))


def paragraph_list(label: Column, most: int = 200) -> Column:
    """Numbers of "22 to 26" or "2 and 4" or "2, 4"; of a range that runs backwards its first."""
    span = r"(\d+)\s*(?:to|à)\s*(\d+)"
    low, high = F.regexp_extract(label, span, 1).try_cast("int"), F.regexp_extract(label, span, 2).try_cast("int")
    listed = F.transform(F.regexp_extract_all(label, F.lit(r"\d+"), F.lit(0)), lambda x: x.cast("int"))
    ranged = F.when((high >= low) & (high - low < most), F.sequence(low, F.greatest(low, high))).otherwise(F.array(low))
    return F.when(label.rlike(span), ranged).otherwise(listed)


#: Years that an act can be of: the first treaty came into force in the first of them.
ACT_YEARS = (1952, 2100)


def celex(kind: Column, marked: Column, first: Column, second: Column) -> Column:
    """The identifier of a European act from the two numbers of its citation; null where their order can't be told.

    Directives cite the year first, one of two digits being of the last century. Of regulations and decisions the number that can
    be a year is the year; if both can, it is the second where the number mark stands before them, else the first. An act whose
    year is none or whose number has more than four digits is none.
    """
    letter = F.when(kind == "regulation", "R").when(kind == "directive", "L").when(kind == "decision", "D")
    is_year = lambda x: x.between(*ACT_YEARS)
    first_is_year = F.when(kind == "directive", True).when(is_year(first) & is_year(second), ~F.coalesce(marked, F.lit(False))).when(is_year(second), False).when(is_year(first), True)
    year = F.when(first_is_year, first).when(~first_is_year, second)
    number = F.when(first_is_year, second).when(~first_is_year, first)
    year = F.when(year < 100, year + 1900).otherwise(year)
    found = F.concat(F.lit("3"), F.lpad(year.cast("string"), 4, "0"), letter, F.lpad(number.cast("string"), 4, "0"))
    return F.when(is_year(year) & number.between(1, 9999), found)


def unique_position(text: Column, fragment: Column) -> Column:
    """Where a fragment occurs, white space aside, from 0; null unless it does so exactly once."""
    escaped = F.regexp_replace(F.trim(fragment), r"([\\\[\](){}.*+?^$|])", r"\\$1")
    pattern = F.regexp_replace(escaped, r"(?U)\s+", r"\\s+")
    return F.when(F.regexp_count(text, pattern) == 1, F.length(F.get(F.split(text, pattern, 2), F.lit(0))))


def file_name(url: Column) -> Column:
    """A stable file name of a url: scheme dropped, every run of other characters one underscore."""
    return F.regexp_replace(F.regexp_replace(url, r"^[a-z]+://", ""), r"[^A-Za-z0-9.-]+", "_")


def report_link(base: str, title: Column, body: Column, most: int = 200) -> Column:
    """A pre-filled report url; the title is cut at ``most`` characters."""
    return F.concat(F.lit(base), F.lit("?title="), F.url_encode(F.substring(title, F.lit(1), F.lit(most))), F.lit("&body="), F.url_encode(body))
