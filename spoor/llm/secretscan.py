"""Secret scan in DataFrame functions only: three base patterns, and a randomness test battery for what they miss.

Runs of at least LEAST key-like characters beside the base spans are candidates, whole and cut at the characters that only
one of two encodings has, as a path or a prefix may stand before a key; '=' ends a run and belongs to it as padding only. From its characters an encoding is inferred, and with it an
alphabet. Three tests ask whether the run could be a uniform draw from that alphabet: chi-squared over the characters,
runs above and below the middle of the alphabet, and lag-one serial correlation. A run is let go if the tests reject
randomness; the cut-off is Benjamini and Hochberg's, over the whole corpus, in each class of encoding and length, so that
of the runs let go at most the share FDR is expected to be random. What is left, with enough bits, is a secret.

Long texts are cut into pieces where no pattern can reach across, so that work goes with a text's length: what is appended to
an array, or looked for from the start of a string, costs its length each time.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spoor.functions.text import places, running_ends
from spoor.llm.common import written

#: Base patterns, the group whose length counts, and its least length; in this order.
BASE = (
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
)
#: Fewest characters of a candidate; the runs that are candidates: whole, cut at '/' and '+', cut at '-' and '_', and cut at
#: all four. What one of the others finds as well is left to it by what must stand before and after, so none comes twice.
LEAST = 20
PADDING = r"(?:=+(?![A-Za-z0-9+/_=-]))?"
CANDIDATES = (
    r"[A-Za-z0-9+/_-]{%d,}%s" % (LEAST, PADDING),
    *(r"(?<=[%s])[A-Za-z0-9%s]{%d,}%s|(?<![A-Za-z0-9+/_-])[A-Za-z0-9%s]{%d,}+(?=[%s])" % (at, more, LEAST, PADDING, more, LEAST, at) for at, more in (("+/", "_-"), ("_-", "+/"))),
    r"(?<=[_-])[A-Za-z0-9]{%d,}+(?=[+/])|(?<=[+/])[A-Za-z0-9]{%d,}+(?=[_-])" % (LEAST, LEAST),
)
#: Characters of a piece at least, and where one may end: behind a character that stands in no pattern, or behind a blank that
#: isn't one of those around the sign of an assignment.
PIECE = 4096
CUT = r"""(?s).{%d}.*?(?:[^A-Za-z0-9+/_.=:"'\x20-]|(?<![:=\x20])\x20(?![:=\x20]))|.+""" % PIECE
_AZ, _az, _09 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
#: Encodings from narrow to wide: name, what a run must match whole (padding aside), what it must hold, and its alphabet.
ENCODINGS = (
    ("hex", "[0-9a-f]+", ("[0-9]", "[a-f]"), _09 + "abcdef"),
    ("HEX", "[0-9A-F]+", ("[0-9]", "[A-F]"), _09 + "ABCDEF"),
    ("base32", "[A-Z2-7]+", ("[2-7]", "[A-Z]"), _AZ + "234567"),
    ("base36", "[0-9a-z]+", ("[0-9]", "[a-z]"), _09 + _az),
    ("BASE36", "[0-9A-Z]+", ("[0-9]", "[A-Z]"), _09 + _AZ),
    ("base62", "[0-9A-Za-z]+", ("[0-9]", "[A-Z]", "[a-z]"), _09 + _AZ + _az),
    ("base64", "[0-9A-Za-z+/]+", ("[0-9]", "[A-Z]", "[a-z]"), _AZ + _az + _09 + "+/"),
    ("base64url", "[0-9A-Za-z_-]+", ("[0-9]", "[A-Z]", "[a-z]"), _AZ + _az + _09 + "-_"),
)
#: Bits that a secret holds at least, expected share of random runs among those let go, and the least cut-off.
BITS, FDR, LEAST_P = 80, 0.05, 0.02
#: Bins of p-values in the corpus-wide count.
BINS = 1000
REDACTED = "[SECRET]"


def _let(value: Column, then) -> Column:
    """``then`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _pieces(text: Column) -> Column:
    """The text in pieces of PIECE characters and what there is up to the next place where no pattern can reach across."""
    return F.when(F.length(text) <= PIECE, F.array(text)).otherwise(F.regexp_extract_all(text, F.lit(CUT), F.lit(0)))


def _spans(text: Column, pattern: str, group: int, least: int) -> Column:
    """array<struct<start,end,hit>> of the leftmost matches that don't overlap, without those whose group is too short."""
    counted = lambda hit: hit if group == 0 else F.regexp_extract(hit, pattern, group)
    return F.filter(places(text, pattern), lambda x: F.length(counted(x["hit"])) >= least)


def _encoding(run: Column) -> Column:
    """struct<name,alphabet> of the narrowest encoding that the run could have; null if none."""
    out = F.lit(None).cast("struct<name:string,alphabet:string>")
    for name, whole, holds, alphabet in reversed(ENCODINGS):
        fits = reduce(lambda a, b: a & b, [run.rlike(h) for h in holds], run.rlike(f"^{whole}$"))
        out = F.when(fits, F.struct(F.lit(name).alias("name"), F.lit(alphabet).alias("alphabet"))).otherwise(out)
    return out


def _two_sided(z: Column) -> Column:
    """The chance of a normal value as far from nought as z, by a logistic approximation."""
    far = F.least(F.abs(z), F.lit(12.0))
    return 2 / (1 + F.exp(1.5976 * far + 0.07056 * far * far * far))


def _tests(x: Column) -> Column:
    """The combined p-value of the three tests, the least times three, of struct<n,size,places,counts,mean,high>."""
    n, size, high, mean = x["n"], x["size"], x["high"], x["mean"]
    total = lambda values: F.aggregate(values, F.lit(0.0), lambda s, y: s + y)
    paired = lambda values, f: total(F.zip_with(F.slice(values, 1, (n - 1).cast("int")), F.slice(values, 2, (n - 1).cast("int")), f))
    chi = size / n * F.aggregate(x["counts"], F.lit(0.0), lambda s, c: s + c * c) - n
    z_chi = (chi - (size - 1)) / F.sqrt(2 * (size - 1) * (1 - 1 / n))
    ones = total(high)
    turns = paired(high, lambda a, b: F.abs(a - b))
    both = 2 * ones * (n - ones)
    spread = both * (both - n) / (n * n * (n - 1))
    z_runs = F.when(spread > 0, (turns + 1 - both / n - 1) / F.sqrt(F.greatest(spread, F.lit(1e-9)))).otherwise(F.lit(12.0))
    squares = total(F.transform(x["places"], lambda p: (p - mean) * (p - mean)))
    lag = paired(x["places"], lambda a, b: (a - mean) * (b - mean))
    z_lag = F.when(squares > 0, (lag / F.greatest(squares, F.lit(1e-9)) + 1 / n) * F.sqrt(n)).otherwise(F.lit(12.0))
    return F.least(F.lit(1.0), 3 * F.least(_two_sided(z_chi), _two_sided(z_runs), _two_sided(z_lag)))


def _tested(candidate: Column) -> Column:
    """struct<start,end,class,p,bits> of a candidate; null unless it has an encoding."""

    def counted(x: Column) -> Column:
        run, alphabet = x["run"], x["encoding"]["alphabet"]
        chars = F.filter(F.split(run, ""), lambda c: c != "")
        n = F.length(run).cast("double")
        places_ = F.transform(chars, lambda c: (F.instr(alphabet, c) - 1).cast("double"))
        counts = F.transform(F.array_distinct(chars), lambda c: (F.length(run) - F.length(F.replace(run, c, F.lit("")))).cast("double"))
        return F.struct(n.alias("n"), F.length(alphabet).cast("double").alias("size"), x["encoding"]["name"].alias("name"), places_.alias("places"), counts.alias("counts"))

    def centred(x: Column) -> Column:
        # Once for the run: what a lambda computes, it computes for each character.
        mean = F.aggregate(x["places"], F.lit(0.0), lambda s, p: s + p) / x["n"]
        high = F.transform(x["places"], lambda p: F.when(p * 2 >= x["size"], 1.0).otherwise(0.0))
        return F.struct(x["n"].alias("n"), x["size"].alias("size"), x["name"].alias("name"), x["places"].alias("places"), x["counts"].alias("counts"), mean.alias("mean"), high.alias("high"))

    def measured(x: Column) -> Column:
        kind = F.concat(x["name"], F.lit(":"), F.floor(F.log2(x["n"] / LEAST)).cast("string"))
        return F.struct(candidate["start"].alias("start"), candidate["end"].alias("end"), kind.alias("class"), _tests(x).alias("p"), (x["n"] * F.log2(x["size"])).alias("bits"))

    encoded = _let(F.rtrim(candidate["hit"], F.lit("=")), lambda bare: F.struct(bare.alias("run"), _encoding(bare).alias("encoding")))
    able = lambda x: F.when(x["encoding"].isNotNull() & (F.length(x["run"]) >= LEAST), _let(_let(counted(x), centred), measured))
    return _let(encoded, able)


def _ranked(spans: Column, rank: int) -> Column:
    return F.transform(spans, lambda x: F.struct(x["start"].alias("start"), F.lit(rank).alias("rank"), x["end"].alias("end")))


def _blanked(text: Column, spans: Column) -> Column:
    """The text with blanks in place of the spans, which are in order of their starts; places stay as they are."""

    def step(state: Column, x: Column) -> Column:
        start = F.greatest(state["at"], x["start"])
        gap = F.substring(text, state["at"] + 1, start - state["at"])
        return F.struct(F.greatest(state["at"], x["end"]).alias("at"), F.array_append(state["parts"], F.concat(gap, F.repeat(F.lit(" "), x["end"] - start))).alias("parts"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))
    return F.aggregate(spans, start, step, lambda s: F.concat(F.array_join(s["parts"], ""), F.substring(text, s["at"] + 1, F.length(text))))


def _merged(spans: Column) -> Column:
    """Spans in order of their starts, those that overlap as one."""

    def step(found: Column, x: Column) -> Column:
        last = F.try_element_at(found, F.lit(-1))
        one = F.struct(last["start"].alias("start"), last["rank"].alias("rank"), F.greatest(last["end"], x["end"]).alias("end"))
        return F.when(last["end"] > x["start"], F.array_append(F.slice(found, 1, F.size(found) - 1), one)).otherwise(F.array_append(found, x))

    overlap = F.exists(F.zip_with(spans, F.slice(spans, 2, F.greatest(F.size(spans), F.lit(1))), lambda x, y: y["start"] < x["end"]), lambda x: F.coalesce(x, F.lit(False)))
    return F.when(overlap, F.aggregate(spans, F.array().cast("array<struct<start:int,rank:int,end:int>>"), step)).otherwise(spans)


def _looked(piece: Column) -> Column:
    """struct<text,base,tested> of a piece: base spans, and the candidates beside them, whole and cut, that can be tested."""
    base = F.array_sort(F.concat(*[_ranked(_spans(piece, pattern, group, least), rank) for rank, (_, pattern, group, least) in enumerate(BASE)]))

    def candidates(beside: Column) -> Column:
        cut = lambda whole: F.when(F.size(whole) > 0, F.concat(whole, *[_spans(beside, pattern, 0, LEAST) for pattern in CANDIDATES[1:]])).otherwise(whole)
        found = _let(_spans(beside, CANDIDATES[0], 0, LEAST), cut)
        return F.filter(F.transform(found, _tested), lambda x: x.isNotNull() & (x["bits"] >= BITS))

    def with_base(found: Column) -> Column:
        beside = F.when(F.size(found) > 0, _blanked(piece, found)).otherwise(piece)
        return F.struct(piece.alias("text"), found.alias("base"), _let(beside, candidates).alias("tested"))

    return _let(base, with_base)


def scanned(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` plus ``_pieces``, array<struct<start,text,base,tested>>: where a piece starts, and in its own places what is found there."""
    looked = F.transform(_pieces(F.coalesce(F.col(text_col).cast("string"), F.lit(""))), _looked)

    def with_starts(pieces: Column) -> Column:
        ends = running_ends(F.transform(pieces, lambda p: F.length(p["text"])))
        return F.zip_with(pieces, ends, lambda p, e: F.struct((e - F.length(p["text"])).alias("start"), p["text"].alias("text"), p["base"].alias("base"), p["tested"].alias("tested")))

    return docs.withColumn("_pieces", _let(looked, with_starts))


def _in_text(spans) -> Column:
    """The spans that a function gives of each piece, in places of the text."""
    moved = lambda p: F.transform(spans(p), lambda x: F.struct((x["start"] + p["start"]).alias("start"), x["rank"].alias("rank"), (x["end"] + p["start"]).alias("end")))
    return F.flatten(F.transform("_pieces", moved))


def cut_offs(found: DataFrame, fdr: float = FDR, least_p: float = LEAST_P) -> dict[str, float]:
    """By class, the p-value up to which runs are let go. Classes are encodings times doublings of length: a few dozen rows."""
    each = found.select(F.explode(F.flatten(F.transform("_pieces", lambda p: p["tested"]))).alias("x")).select("x.class", F.floor(F.col("x.p") * BINS).alias("bin"))
    bins = each.groupBy("class", "bin").agg(F.count("*").alias("n"))
    upto = Window.partitionBy("class").orderBy("bin")
    share = bins.withColumns({"below": F.sum("n").over(upto), "all": F.sum("n").over(Window.partitionBy("class")), "edge": (F.col("bin") + 1) / BINS})
    cut = share.groupBy("class").agg(F.max(F.when(F.col("all") * F.col("edge") <= fdr * F.col("below"), F.col("edge"))).alias("edge"))
    return {x["class"]: max(least_p, x["edge"] or 0.0) for x in cut.collect()}


def _secret(tested: Column, cuts: dict[str, float], least_p: float) -> Column:
    """The tested runs that aren't let go, those that overlap as one."""
    known = F.create_map(*[F.lit(y) for x in cuts.items() for y in x]) if cuts else F.create_map().cast("map<string,double>")
    passing = F.filter(tested, lambda x: x["p"] > F.coalesce(F.try_element_at(known, x["class"]), F.lit(least_p)))
    return _let(F.array_sort(_ranked(passing, len(BASE))), _merged)


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(x) for x in (*[b[0] for b in BASE], "random")])
    return F.concat_ws(",", F.transform(spans, lambda x: F.concat_ws(":", F.element_at(names, x["rank"] + 1), x["start"].cast("string"), x["end"].cast("string"))))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fdr: float = FDR, least_p: float = LEAST_P) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 and spans of every row.

    Spans are kind:start:end over the whole match, by start, then kind. Spans of kind ``random`` are the method's and never
    overlap a base span or each other. A null text is empty and has none; rows repeat as given; other columns are not read.
    """
    found = scanned(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")))
    found = written(found.select("doc_id", F.transform("_pieces", lambda p: p.dropFields("text")).alias("_pieces")))
    cuts = cut_offs(found, fdr, least_p)
    count = lambda r: F.size(F.filter("_base", lambda x: x["rank"] == r)).cast("long")
    found = found.select("doc_id", _in_text(lambda p: p["base"]).alias("_base"), _in_text(lambda p: F.array_sort(F.concat(p["base"], _secret(p["tested"], cuts, least_p)))).alias("_every"))
    return found.select(
        "doc_id",
        *[count(r).alias(f"n_{name}") for r, (name, *_) in enumerate(BASE)],
        F.sha2(_joined(F.col("_base")), 256).alias("base_sha256"),
        _joined(F.col("_every")).alias("spans"),
    )


def redact(docs: DataFrame, text_col: str = "text", fdr: float = FDR, least_p: float = LEAST_P) -> DataFrame:
    """``docs`` with every secret in its texts replaced by REDACTED; overlapping spans become one. Null texts stay null.

    The texts are scanned once for the corpus-wide cut-offs and once more as they are rewritten, rather than stored between.
    """
    names = docs.columns
    found = scanned(docs.select(F.struct("*").alias("row"), F.col(text_col).cast("string").alias("text")))
    cuts = cut_offs(found, fdr, least_p)

    def cleaned(piece: Column) -> Column:
        text = piece["text"]

        def step(state: Column, x: Column) -> Column:
            apart = x["start"] >= state["at"]
            gap = F.when(apart, F.concat(F.substring(text, state["at"] + 1, x["start"] - state["at"]), F.lit(REDACTED))).otherwise(F.lit(""))
            return F.struct(F.greatest(state["at"], x["end"]).alias("at"), F.array_append(state["parts"], gap).alias("parts"))

        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))
        spans = F.array_sort(F.concat(piece["base"], _secret(piece["tested"], cuts, least_p)))
        rewrite = lambda own: F.when(F.size(own) == 0, text).otherwise(F.aggregate(own, start, step, lambda s: F.concat(F.array_join(s["parts"], ""), F.substring(text, s["at"] + 1, F.length(text)))))
        return _let(spans, rewrite)

    whole = F.when(F.col("text").isNotNull(), F.array_join(F.transform("_pieces", cleaned), ""))
    return found.select(*[(whole if c == text_col else F.col("row")[c]).alias(c) for c in names])
