"""The routes by which an article is documented, walked together, and the verdict that they give.

The tables of the graph, as columns: articles (article, number, lineage), versions (version, article, start, end, state),
segments (segment, version), produced (version, statute, link), renumbered (article, former), carried (segment, source),
origins (statute, dossier), texts (text, dossier), aims (text, bill_article, article, cited).
"""

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spoor.operators.aggregates import percentage
from spoor.operators.classify import code_part, verdict
from spoor.operators.closure import closure, spread_marks
from spoor.operators.temporal import in_force
from spoor.sources.tables import written

#: Routes and the bits that stand for them on the way.
ROUTES = {"passage": 1, "amendment": 2, "bill_article": 4, "paper": 8, "eu_act": 16}
#: Verdicts by priority, with the routes that give each.
VERDICTS = [("motivating_passage", ["passage", "amendment"]), ("situated_origin", ["bill_article"]), ("statute_motivated", ["paper", "eu_act"])]
UNDOCUMENTED = "undocumented"


class Graph(NamedTuple):
    articles: DataFrame
    versions: DataFrame
    segments: DataFrame
    produced: DataFrame
    renumbered: DataFrame
    carried: DataFrame
    origins: DataFrame
    texts: DataFrame
    aims: DataFrame


def _effective(graph: Graph, never: Column) -> DataFrame:
    return graph.versions.where(~F.coalesce(never, F.lit(False)))


def _made(graph: Graph) -> DataFrame:
    """(article, statute, dossier, link): statutes that wrote a version, with their dossiers if they have any."""
    by = graph.produced.join(graph.versions.select("version", "article"), "version").select("article", "statute", "link").distinct()
    return by.join(graph.origins.select("statute", "dossier").distinct(), "statute", "left").select("article", "statute", "dossier", "link")


def _survival(graph: Graph, made: DataFrame) -> DataFrame:
    """Aims with their dossier and ``survived``: a statute of the dossier wrote the article that was aimed at, and not to repeal it."""
    wrote = made.where("link <> 'repeal' and dossier is not null").select("dossier", "article", F.lit(True).alias("_wrote")).distinct()
    aims = graph.aims.join(graph.texts.select("text", "dossier").distinct(), "text").join(wrote, ["dossier", "article"], "left")
    return aims.withColumn("survived", F.coalesce("_wrote", F.lit(False))).drop("_wrote")


def discussed(graph: Graph, day: Column, never: Column) -> DataFrame:
    """(article, number, dossier, text, bill_article, cited, direct, survived) of articles in force: under which article of which
    text each was debated, itself (``direct``) or under a number that it had before.

    An aim at an article goes to all that it was renumbered to. One whose dossier's statutes did not write the article that
    it names died on the way; its row stays and says so.
    """
    now = in_force(graph.versions, "article", "start", "end", day, ["version"], never).select("article")
    aims = _survival(graph, _made(graph)).withColumnRenamed("article", "_aimed")
    down = closure(graph.renumbered, "former", "article", aims.select("_aimed")).select(F.col("seed").alias("_aimed"), F.col("node").alias("article"))
    named = aims.join(down, "_aimed").join(now, "article").join(graph.articles.select("article", "number").distinct(), "article")
    return named.select("article", "number", "dossier", "text", "bill_article", "cited", (F.col("_aimed") == F.col("article")).alias("direct"), "survived").distinct()


def documented(graph: Graph, motives: DataFrame, results: DataFrame, papers: DataFrame, citations: DataFrame, transposed: DataFrame, day: Column, never: Column) -> DataFrame:
    """(article, number, part, a 0/1 flag for each of ROUTES, verdict) of every article in force on a day.

    * passage: a document explains the article or one that it was renumbered from (``motives``: article);
    * amendment: one of its segments, or one that a segment was carried from, came from an amendment (``results``: segment);
    * bill_article: a text that survived aimed at it or at one it was renumbered from;
    * paper: a dossier with a document of its own (``papers``: dossier) modified it or one that it was renumbered from, or
      created the root of that chain. A creation below the root only renumbers: what it says of itself doesn't explain the text;
    * eu_act: its version in force cites an act (``citations``: segment), or a statute that wrote it transposes one (``transposed``: statute).

    What goes by number, bill_article and citations, is the number's current article: of the highest lineage that ever lived.
    ``part`` is null where the number belongs to none. All routes walk the two graphs as bits of one frontier, so that work goes
    with the edges that marked nodes have, and not with pairs of an article and its ancestors.
    """
    bit = lambda name: F.lit(ROUTES[name])
    now = in_force(graph.versions, "article", "start", "end", day, ["version"], never).select("article", "version")
    made = written(_made(graph))
    heirs = graph.renumbered.where("article <> former").select(F.col("former").alias("src"), F.col("article").alias("dst")).distinct()
    rooted = made.join(heirs.select(F.col("dst").alias("article")).distinct().withColumn("_heir", F.lit(True)), "article", "left")
    wrote = rooted.where((F.col("link") == "modification") | ((F.col("link") == "creation") & F.col("_heir").isNull()))
    seeds = [
        motives.select(F.col("article").alias("id"), bit("passage").alias("marks")),
        _survival(graph, made).where("survived").select(F.col("article").alias("id"), bit("bill_article").alias("marks")),
        wrote.join(papers.select("dossier").distinct(), "dossier", "left_semi").select(F.col("article").alias("id"), bit("paper").alias("marks")),
    ]
    tag = lambda df, kind: df.where("id is not null").select(F.struct(F.lit(kind).alias("kind"), F.col("id").cast("string").alias("id")).alias("node"), "marks")
    end = lambda kind, name: F.struct(F.lit(kind).alias("kind"), F.col(name).cast("string").alias("id"))
    marked = [tag(s, "article") for s in seeds] + [tag(results.select(F.col("segment").alias("id"), bit("amendment").alias("marks")), "segment")]
    edges = heirs.select(end("article", "src").alias("src"), end("article", "dst").alias("dst")).unionByName(
        graph.carried.where("segment <> source").select(end("segment", "source").alias("src"), end("segment", "segment").alias("dst"))
    )
    start = marked[0]
    for more in marked[1:]:
        start = start.unionByName(more)
    spread = written(spread_marks(edges, start).select("node.kind", "node.id", "marks"))

    key = F.col("article").cast("string").alias("id")
    on_articles = spread.where("kind = 'article'").select("id", "marks")
    by_id = on_articles.select("id", F.col("marks").bitwiseAND(ROUTES["passage"] | ROUTES["paper"]).alias("marks"))
    holders = graph.segments.join(graph.versions.select("version", "article"), "version").select("segment", "version", "article")
    traced = holders.select(F.col("segment").cast("string").alias("id"), "article").join(spread.where("kind = 'segment'").select("id"), "id", "left_semi")
    amended = traced.select(key, bit("amendment").alias("marks")).distinct()
    transposing = made.join(transposed.select("statute").distinct(), "statute", "left_semi").select(key, bit("eu_act").alias("marks")).distinct()

    debated = on_articles.where(F.col("marks").bitwiseAND(ROUTES["bill_article"]) != 0).select("id", bit("bill_article").alias("marks"))
    cites = holders.join(citations.select("segment").distinct(), "segment", "left_semi").select("article", "version").distinct()
    cites = cites.join(now, ["article", "version"], "left_semi").select(key, bit("eu_act").alias("marks"))
    alive = graph.articles.join(now, "article", "left_semi").select(key, "number")
    said = debated.unionByName(cites).join(alive, "id").groupBy("number").agg(F.bit_or("marks").alias("marks"))
    lived = graph.articles.join(_effective(graph, never).select("article").distinct(), "article", "left_semi")
    current = lived.groupBy("number").agg(F.max_by("article", F.struct("lineage", "article")).alias("article"))
    by_number = current.join(said, "number").select(key, "marks")

    all_ = by_id.unionByName(amended).unionByName(transposing).unionByName(by_number).groupBy("id").agg(F.bit_or("marks").alias("marks"))
    rows = graph.articles.join(now.select("article"), "article").select("article", "number", key).join(all_, "id", "left")
    flags = [F.when(F.coalesce("marks", F.lit(0)).bitwiseAND(n) != 0, 1).otherwise(0).alias(name) for name, n in ROUTES.items()]
    rows = rows.select("article", "number", code_part(F.col("number")).alias("part"), *flags)
    return rows.withColumn("verdict", verdict([(name, F.greatest(*map(F.col, by), F.lit(0)) == 1) for name, by in VERDICTS], UNDOCUMENTED))


def silence(rows: DataFrame) -> DataFrame:
    """(part, articles, a count for each verdict, silent_share): what :func:`documented` says of each part; articles of no part under null."""
    of = lambda name: F.count_if(F.col("verdict") == name)
    names = [name for name, _ in VERDICTS] + [UNDOCUMENTED]
    return rows.groupBy("part").agg(F.count("*").alias("articles"), *[of(n).alias(n) for n in names], percentage(of(UNDOCUMENTED), F.count("*")).alias("silent_share"))
