"""How the filters of a chain interact: what each removes, alone and behind the others, in every order.

Spark reduces the documents to a mask of failed filters each, and the masks to 32 cells a part. The subsets of filters are then
walked in Gray-code order: each step toggles one filter, the counter of active failures of every cell whose mask has it follows,
and cells that leave or reach nought change the running survivors. The 32 states are stored, and every step of every order is a
difference of two of them.
"""

from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spoor.llm.common import BLANKS, WORD, written

#: The filters, each a bit of the mask in this order.
FILTERS = "ABCDE"
#: What is counted in each cell: documents, good ones, toxic ones.
COUNTED = ("n", "good", "toxic")
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Bytes of a text's digest that stand for it: all of SHA-256.
DIGEST = 256


def own_failures(text: Column) -> list[Column]:
    """Whether a text fails A, B, C and D, which look at nothing else; the text is not null."""
    words = F.filter(F.split(text, BLANKS, -1), lambda w: w != "")
    n = F.size(words)
    return [
        n < 200,
        100 * F.size(F.array_distinct(words)).cast("long") < 50 * n.cast("long"),
        100 * (F.length(text) - F.length(F.translate(text, CAPITALS, ""))).cast("long") > 3 * F.length(text).cast("long"),
        F.length(F.translate(text, "#$%&*|", "")) < F.length(text),
    ]


def masks(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang", quality_col: str = "quality", toxic_col: str = "toxic") -> DataFrame:
    """(part, mask, n, good, toxic): documents by the set of filters that they fail.

    A text stands in the shuffle as its SHA-256. Rows alike in id, text and part are counted before anything is joined, so that
    no key is hot: the least id of a text is joined by digest and id together, and matches the first holder alone.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    bits = [F.when(failed, 1 << k).otherwise(0) for k, failed in enumerate(own_failures(F.col("text")))]
    read = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), text.alias("text"))
    facts = read.select("doc_id", "part", F.unhex(F.sha2("text", DIGEST)).alias("digest"), sum(bits[1:], bits[0]).cast("tinyint").alias("own"))
    facts = written(facts.groupBy("doc_id", "part", "digest", "own").agg(F.count("*").alias("n")))
    first = facts.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).where(F.col("doc_id").isNotNull()).withColumn("first", F.lit(True))
    marked = labels.groupBy(F.col(id_col).alias("doc_id")).agg(F.max(F.col(quality_col) == 1).alias("is_good"), F.max(F.col(toxic_col) == 1).alias("is_toxic")).where(F.col("doc_id").isNotNull())
    copy = F.col("doc_id").isNotNull() & F.col("first").isNull()
    joined = facts.join(first, ["digest", "doc_id"], "left").join(marked, "doc_id", "left")
    mask = (F.col("own") + F.when(copy, 1 << 4).otherwise(0)).cast("int").alias("mask")
    return joined.groupBy("part", mask).agg(F.sum("n").alias("n"), *[F.sum(F.when(F.col(f"is_{x}"), F.col("n")).otherwise(0)).alias(x) for x in COUNTED[1:]])


def states(cells: np.ndarray) -> np.ndarray:
    """Survivors of every subset of filters: [subset, ...] from cells [mask, ...], by one walk in Gray-code order."""
    active, alive, out = np.zeros(len(cells), np.int64), cells.sum(axis=0), np.zeros_like(cells)
    subset, out[0] = 0, alive
    has = [np.nonzero(np.arange(len(cells)) >> k & 1)[0] for k in range(len(cells).bit_length() - 1)]
    for step in range(1, len(cells)):
        k = (step & -step).bit_length() - 1
        subset ^= 1 << k
        change = 1 if subset >> k & 1 else -1
        touched = has[k]
        active[touched] += change
        turned = touched[active[touched] == (1 if change == 1 else 0)]
        alive = alive - change * cells[turned].sum(axis=0)
        out[subset] = alive
    return out


def steps(cells: np.ndarray) -> Iterator[dict]:
    """Every step of every order: cells are [mask, counted]."""
    survivors, n = states(cells), len(FILTERS)
    failing = [int(cells[np.arange(len(cells)) >> k & 1 == 1, 0].sum()) for k in range(n)]
    removed_by, made = [0] * n, []
    for order in permutations(range(n)):
        subset = 0
        for at, k in enumerate(order, 1):
            lost = survivors[subset] - survivors[subset | 1 << k]
            subset |= 1 << k
            removed_by[k] += int(lost[0])
            made.append((order, at, k, int(survivors[subset][0]), lost))
    assert len(made) == n * factorial(n)
    for order, at, k, kept, lost in made:
        yield {
            "filter_order": "".join(FILTERS[j] for j in order), "step": at, "kept": kept, "removed": int(lost[0]), "redundant": failing[k] - int(lost[0]), "unique_fails": int(cells[1 << k, 0]),
            "good_lost": int(lost[1]), "toxic_lost": int(lost[2]), "shapley": removed_by[k],
        }


def audit(docs: DataFrame, labels: DataFrame, **columns: str) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost and shapley.

    A part is a value of ``lang``; null and the empty string are one part. A null text counts as empty. A null id is neither
    smaller nor greater than another, so its text is never a copy and makes none; rows that repeat id and text are each counted,
    and no copies of each other. A label counts if any row of the id has it; labels of null ids count for none. Other columns
    are not read. Documents that no label names are neither good nor toxic. An empty table gives no part, so no rows.
    """
    count = lambda c: F.sum(F.when(F.col("mask") == c[0], F.col(c[1])).otherwise(0))
    wide = masks(docs, labels, **columns).groupBy("part").agg(F.array(*[count((m, c)) for m in range(1 << len(FILTERS)) for c in COUNTED]).alias("cells"))
    schema = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, cells in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                made = list(steps(np.array(cells.as_py(), np.int64).reshape(-1, len(COUNTED))))
                columns = {name: [row[name] for row in made] for name in made[0]}
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(made), pa.string()), pa.array(columns.pop("filter_order"), pa.string()), pa.array(columns.pop("step"), pa.int32()), *[pa.array(c, pa.int64()) for c in columns.values()]],
                    ["part", "filter_order", "step", *columns],
                )

    return wide.mapInArrow(run, schema)


def oracle() -> str:
    """DuckDB SQL of :func:`audit` by the definitions: for every step, the cells that fail its filter and none before it."""
    letters = "(SELECT unnest(range(5)) AS f)"
    return f"""
WITH t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS least FROM documents),
w AS (SELECT *, regexp_extract_all(text, '{WORD}') AS words FROM t),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
d AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
  (CASE WHEN len(words) < 200 THEN 1 ELSE 0 END) + (CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 2 ELSE 0 END)
  + (CASE WHEN 100 * len(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * len(text) THEN 4 ELSE 0 END) + (CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END) + (CASE WHEN least < doc_id THEN 16 ELSE 0 END) AS mask
  FROM w LEFT JOIN l USING (doc_id)),
c AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM d GROUP BY part, mask),
o AS (SELECT [a.f, b.f, c.f, d.f, e.f] AS o FROM {letters} a, {letters} b, {letters} c, {letters} d, {letters} e WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
s AS (SELECT list_aggregate(list_transform(o, lambda f: substr('{FILTERS}', f + 1, 1)), 'string_agg', '') AS filter_order, step, o[step] AS f, 1 << o[step] AS bit,
  CAST(coalesce(list_sum(list_transform(o[1:step - 1], lambda f: 1 << f)), 0) AS INTEGER) AS earlier FROM o, (SELECT unnest(range(1, 6)) AS step)),
r AS (SELECT part, filter_order, step, f, sum(CASE WHEN mask & (earlier | bit) = 0 THEN n ELSE 0 END) AS kept, sum(CASE WHEN mask & earlier = 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS removed,
  sum(CASE WHEN mask & earlier <> 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS redundant, sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
  sum(CASE WHEN mask & earlier = 0 AND mask & bit <> 0 THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN mask & earlier = 0 AND mask & bit <> 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM c, s GROUP BY part, filter_order, step, f)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
  CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley FROM r"""
