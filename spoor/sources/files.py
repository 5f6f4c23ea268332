"""Readers for the inputs of a legislative corpus: XML versions and dossiers, amendment sets, plans, markup, PDF text."""

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from spoor.functions.text import collapsed, html_unescape, paragraphs, strip_tags

#: The day that a source writes for an end that is open.
OPEN_END = "2999-01-01"


def whole_files(spark: SparkSession, folder: str, pattern: str = "*.xml") -> DataFrame:
    """(path, text): one row a file beneath the folder; only names that fit the pattern are listed."""
    files = spark.read.format("text").option("wholetext", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(folder)
    return files.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def named_files(files: DataFrame, names: DataFrame, column: str = "name") -> DataFrame:
    """Files whose base name is among the names."""
    return files.withColumn("_name", F.regexp_extract("path", r"[^/]+$", 0)).join(names.select(F.col(column).alias("_name")), "_name", "left_semi").drop("_name")


def tag(text: Column, name: str) -> Column:
    """The content of a tag's first occurrence; null if there is none."""
    return F.nullif(F.regexp_extract(text, rf"(?s)<{name}(?:\s[^>]*)?>(.*?)</{name}>", 1), F.lit(""))


def attribute(element: Column, name: str) -> Column:
    return F.nullif(F.regexp_extract(element, rf'\b{name}="([^"]*)"', 1), F.lit(""))


def elements(text: Column, name: str) -> Column:
    """Every occurrence of a tag, whole, without those nested in one of its own name."""
    return F.regexp_extract_all(text, F.lit(rf"(?s)<{name}(?:\s[^>]*)?(?:/>|>.*?</{name}>)"), F.lit(0))


def open_date(text: Column) -> Column:
    """A date, null where the source writes that it is open."""
    day = F.try_to_date(text)
    return F.when(day != F.lit(OPEN_END).cast("date"), day)


def read_versions(files: DataFrame) -> DataFrame:
    """Versions of articles from their XML; those without a paragraph are dropped.

    version, number, state, start, end, code, paragraphs (array) and links (array of link, nature, statute, version, label).
    """
    t = F.col("text")
    link = lambda x: F.struct(
        F.lower(attribute(x, "typelien")).alias("link"), attribute(x, "naturetexte").alias("nature"), attribute(x, "cidtexte").alias("statute"), attribute(x, "id").alias("version"), collapsed(F.regexp_replace(x, "<[^>]*>", "")).alias("label")
    )
    out = files.select(
        "path", tag(t, "ID").alias("version"), tag(t, "NUM").alias("number"), tag(t, "ETAT").alias("state"), F.try_to_date(tag(t, "DATE_DEBUT")).alias("start"), open_date(tag(t, "DATE_FIN")).alias("end"),
        attribute(F.regexp_extract(t, r"<TEXTE\s[^>]*>", 0), "cid").alias("code"), paragraphs(F.coalesce(tag(t, "BLOC_TEXTUEL"), F.lit(""))).alias("paragraphs"), F.transform(elements(t, "LIEN"), link).alias("links"),
    )
    return out.where(F.size("paragraphs") > 0)


def scan_records(files: DataFrame) -> DataFrame:
    """One JSON record a version, its links included."""
    return read_versions(files).select(F.to_json(F.struct("version", "number", "state", "start", "end", "links")).alias("json"))


def read_dossiers(files: DataFrame) -> DataFrame:
    """dossier, title, legislature, statutes (array), memorandum and links (array of label, url)."""
    t = F.col("text")
    link = lambda x: F.struct(collapsed(F.regexp_replace(x, "<[^>]*>", "")).alias("label"), attribute(x, "href").alias("url"))
    return files.select(
        tag(t, "ID").alias("dossier"), tag(t, "TITRE").alias("title"), tag(t, "NUMERO").try_cast("int").alias("legislature"), F.regexp_extract_all(t, F.lit(r"<ID_TEXTE_\d+>([^<]+)<"), F.lit(1)).alias("statutes"),
        collapsed(strip_tags(F.coalesce(tag(t, "EXPOSE_MOTIF"), F.lit("")))).alias("memorandum"), F.transform(elements(t, "a"), link).alias("links"),
    )


def statute_listings(dossiers: DataFrame) -> DataFrame:
    """(statute, dossier, title): the inverse of what the dossiers list."""
    return dossiers.select(F.explode("statutes").alias("statute"), "dossier", "title").distinct()


def read_senate(spark: SparkSession, path: str, head: int = 7, tail: int = 4) -> DataFrame:
    """The Senate's amendments: Latin-1, tabs, a ``sep=`` line, then the header. Columns are named by the header, in lower case.

    Tabs within the text give a row too many fields; its first seven and last four are sure, what is between is joined and,
    where a header says so, split anew before the purpose's mark.
    """
    lines = spark.read.option("encoding", "ISO-8859-1").text(path).where(~F.col("value").startswith("sep=")).where("trim(value) <> ''")
    header = lines.limit(1).first()
    names = [x.strip().strip('"').lower() for x in header["value"].split("\t")] if header else []
    middle = len(names) - head - tail
    fields = F.split("value", "\t")
    rows = lines.where(F.col("value") != F.lit(header["value"] if header else "")).select(fields.alias("f"))
    rows = rows.where(F.size("f") >= head + tail)
    inner = F.slice("f", head + 1, F.size("f") - head - tail)
    whole = F.array_join(inner, " ")
    cut = F.split(whole, r"(?i)(?=<(?:p|div)[^>]*>\s*objet\b)", 2)
    even = F.size("f") == head + middle + tail
    columns = [F.col("f")[k] for k in range(head)]
    columns += [F.when(even, F.get("f", F.lit(head + k))).otherwise(F.coalesce(F.get(cut, F.lit(k)), F.lit(""))) for k in range(middle)]
    columns += [F.element_at("f", k - tail) for k in range(tail)]
    return rows.select(*[F.trim(F.regexp_replace(c, '^"|"$', "")).alias(n) for c, n in zip(columns, names, strict=True)])


def read_wide(spark: SparkSession, path: str, positions: dict[str, int], sep: str = ";") -> DataFrame:
    """A wide CSV by position: only the columns that are named are kept."""
    raw = spark.read.csv(path, sep=sep, header=False, quote='"', escape='"', multiLine=True)
    return raw.select(*[F.coalesce(f"_c{at}", F.lit("")).alias(name) for name, at in positions.items()])


def read_nested(files: DataFrame, wanted: dict[str, str], marker: str = "uid") -> DataFrame:
    """Records from JSON of any nesting: every object that holds ``marker``; ``wanted`` names dotted paths. Missing is empty."""
    names = list(wanted)

    def records(node: object) -> Iterator[dict]:
        if isinstance(node, dict):
            if marker in node:
                yield node
            else:
                for x in node.values():
                    yield from records(x)
        elif isinstance(node, list):
            for x in node:
                yield from records(x)

    def value(node: object, path: str) -> str:
        for key in path.split("."):
            node = node.get(key) if isinstance(node, dict) else None
        nil = node is None or isinstance(node, dict) and node.get("@xsi:nil") == "true"
        return "" if nil else node if isinstance(node, str) else json.dumps(node, ensure_ascii=False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[value(r, p) for p in wanted.values()] for text in batch.column(0).to_pylist() for r in records(json.loads(text))]
            columns = list(zip(*found, strict=True)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], names)

    return files.select("text").where("text is not null").mapInArrow(run, ", ".join(f"{n} string" for n in names))


def read_actors(files: DataFrame) -> DataFrame:
    """(actor, name, organ, begin, end): memberships of actors, one row a mandate."""
    schema = "acteur struct<uid:string,etatCivil:struct<ident:struct<prenom:string,nom:string>>,mandats:struct<mandat:array<struct<dateDebut:string,dateFin:string,organes:struct<organeRef:string>>>>>"
    a = files.select(F.from_json("text", schema).alias("j")).select("j.acteur.*")
    name = F.concat_ws(" ", "etatCivil.ident.prenom", "etatCivil.ident.nom")
    each = a.select(F.col("uid").alias("actor"), name.alias("name"), F.explode("mandats.mandat").alias("m"))
    return each.select("actor", "name", F.col("m.organes.organeRef").alias("organ"), F.try_to_date("m.dateDebut").alias("begin"), F.try_to_date("m.dateFin").alias("end"))


def read_plan(spark: SparkSession, path: str, schema: str, header: bool = True) -> DataFrame:
    """A tab-separated plan; one malformed line stops the read."""
    return spark.read.csv(path, sep="\t", header=header, schema=schema, mode="FAILFAST", enforceSchema=not header)


@F.pandas_udf(StringType())
def decoded(contents):
    """Bytes as text: UTF-8 if they are, else Latin-1."""

    def one(b):
        if b is None:
            return None
        try:
            return bytes(b).decode("utf-8")
        except UnicodeDecodeError:
            return bytes(b).decode("latin-1")

    return contents.map(one)


def read_markup(spark: SparkSession, folder: str, pattern: str = "*.html") -> DataFrame:
    """(path, kind, text): markup as plain text, PDF told by its first bytes and left to :func:`pdf_text`."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(folder)
    kind = F.when(F.substring(F.col("content"), 1, 4) == F.lit(b"%PDF"), "pdf").otherwise("html")
    rows = files.select("path", kind.alias("kind"), "content")
    text = F.when(F.col("kind") == "html", html_unescape(strip_tags(decoded("content"))))
    return rows.select("path", "kind", F.regexp_replace(text, r"[ \t\x0B\f\xA0]+", " ").alias("text"))


def pdf_text(spark: SparkSession, folder: str, extract, pattern: str = "*.pdf") -> DataFrame:
    """(path, text): pages joined, control characters as blanks, one for one, so that offsets hold.

    ``extract`` turns a file's bytes into a list of page texts; there is no PDF library in every environment.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = ["".join(" " if ord(c) < 32 and c not in "\n\t" else c for c in "".join(extract(b))) for b in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["path", "text"])

    return files.select("path", "content").mapInArrow(run, "path string, text string")


def read_act(files: DataFrame) -> DataFrame:
    """(path, kind, number, text): recitals and articles of a European act by their anchors; an unnumbered recital has none.

    Older layouts have no anchors: their recitals are paragraphs that begin with a number in parentheses or, older still,
    with the word for "whereas".
    """
    t = F.col("text")
    lead = r"^(?:\s|<[^>]*>|&nbsp;)*"
    every = F.regexp_extract_all(t, F.lit(r"(?s)<p\b[^>]*>(.*?)</p>"), F.lit(1))
    numbered, plainest = F.filter(every, lambda x: x.rlike(lead + r"\(\d{1,3}\)")), F.filter(every, lambda x: x.rlike(lead + r"(?iu)(?:considérant|whereas)\b"))
    recital = F.regexp_extract_all(t, F.lit(r'(?s)<div[^>]*id="rct_\d+"[^>]*>.*?</div>'), F.lit(0))
    recital = F.when(F.size(recital) > 0, recital).when(F.size(numbered) > 0, numbered).otherwise(plainest)
    article = F.regexp_extract_all(t, F.lit(r'(?s)<div[^>]*id="art_[^"]+"[^>]*>.*?</div>'), F.lit(0))
    plain = lambda x: collapsed(html_unescape(F.regexp_replace(x, "<[^>]*>", " ")))
    both = files.select("path", F.explode(recital).alias("x"), F.lit("recital").alias("kind")).unionByName(files.select("path", F.explode(article).alias("x"), F.lit("article").alias("kind")))
    number = F.when(F.col("kind") == "recital", F.regexp_extract("x", lead + r"\((\d+)\)", 1)).otherwise(F.regexp_extract("x", r'id="art_([^"]+)"', 1))
    return both.select("path", "kind", F.nullif(number, F.lit("")).alias("number"), plain(F.col("x")).alias("text"))


def plan_links(dossiers: DataFrame, labels: str, hosts: list[str]) -> DataFrame:
    """(dossier, file, url): links whose label and host fit, one a file."""
    from spoor.functions.text import file_name

    links = dossiers.select("dossier", F.explode("links").alias("l")).select("dossier", "l.label", "l.url").where(F.col("label").rlike(labels))
    links = links.where(F.expr("try_parse_url(url, 'HOST')").isin(hosts)).withColumn("file", file_name(F.col("url")))
    return links.groupBy("dossier", "file").agg(F.min("url").alias("url"))


def memoranda(dossiers: DataFrame, least: int = 200) -> DataFrame:
    """(dossier, title, text): memoranda of some length, with their titles."""
    return dossiers.where(F.length("memorandum") >= least).select("dossier", "title", F.col("memorandum").alias("text"))
