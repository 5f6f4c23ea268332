"""Exact top-k search by term-at-a-time accumulation.

Vectors are quantised and read as sparse rows over their components. Candidates are laid out in blocks, each block as one
posting list a component. A query row adds weight times posting, component by component, into a dense score array of the
block; a partition selection keeps the block's k best, and the best of all blocks are merged. Blocks of queries meet every
block of candidates: exhaustive, and exact. Rows with a component of 32 bits or more stand in blocks of their own, and what
could pass 64 bits is added up in Python's integers.
"""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: A component x becomes floor(SCALE * x).
SCALE = 64
#: Best candidates of a query; a query is a row whose id is divisible by EVERY.
K, EVERY = 20, 20
#: Rows of a candidate block and of a query block; candidate rows, and pairs of rows, that one task has at most.
CANDIDATES, QUERIES, GROUP, PAIRS = 8192, 256, 1 << 20, 1 << 32
#: A component's posting list is kept dense if it holds at least this share of its block.
DENSE = 0.25
#: Least and greatest score; what lies beyond is ranked by all its digits, which OFFSET makes positive and equally many.
LOWEST, HIGHEST, OFFSET = -(2**63), 2**63 - 1, 10**700


def _usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v): array<double>, without null ids and without vectors that are null or hold null or non-finite components."""
    v = F.col(vector_col).cast("array<double>")
    whole = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & whole)


def _blocks(rows: DataFrame, size: int) -> DataFrame:
    """One row for each block of up to ``size`` rows, in the order read: ids, lengths, and all components end to end.

    Components are floor(64 x) in ``values``, or as they are in ``wide`` in a block of rows with one beyond 32 bits.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = lambda x, kind: pa.array([x], pa.list_(kind))
        for batch in batches:
            for at in range(0, batch.num_rows, size):
                part = batch.slice(at, size)
                ids, own, lengths = part.column(0).to_numpy(), part.column(1).flatten().to_numpy(), np.diff(part.column(1).offsets.to_numpy())
                row = np.repeat(np.arange(len(ids)), lengths)
                is_wide = np.zeros(len(ids), bool)
                is_wide[row[np.abs(own) >= 2**31 / SCALE]] = True
                for wide in (False, True):
                    rows_, there = is_wide == wide, is_wide[row] == wide
                    if rows_.any():
                        values = None if wide else np.floor(own[there] * SCALE).astype(np.int32)
                        yield pa.RecordBatch.from_arrays([one(ids[rows_], pa.int64()), one(lengths[rows_], pa.int32()), one(values, pa.int32()), one(own[there] if wide else None, pa.float64())], ["ids", "lengths", "values", "wide"])

    return rows.mapInArrow(run, "ids array<long>, lengths array<int>, values array<int>, wide array<double>")


def _components(values: pa.Scalar, wide: pa.Scalar) -> np.ndarray:
    """floor(64 x) of a block's components, as Python's integers if they are wide."""
    if values.is_valid:
        return values.values.to_numpy()
    return np.array([SCALE * int(x) if abs(x) >= 2**53 else math.floor(SCALE * x) for x in wide.values.to_pylist()] or [], object)


def _kind(query: np.ndarray, own: np.ndarray, width: int) -> type:
    """The narrowest type that no score can pass."""
    most = max(map(abs, query.tolist()), default=0) * max(map(abs, own.tolist()), default=0) * width if object in (query.dtype, own.dtype) else int(np.abs(query.astype(np.int64)).max(initial=0)) * int(np.abs(own.astype(np.int64)).max(initial=0)) * width
    return np.int32 if most < 2**31 else np.int64 if most < HIGHEST else object


def _matrix(lengths: np.ndarray, values: np.ndarray, width: int) -> np.ndarray:
    """Rows by components; what a shorter vector lacks is nought."""
    if len(lengths) and (lengths == width).all():
        return values.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width), values.dtype)
    out[np.arange(width)[None, :] < lengths[:, None]] = values
    return out


def _scores(query: np.ndarray, postings: list, n: int, kind: type) -> np.ndarray:
    """Dense scores of one query row over a block: term by term, weight times posting."""
    scores = np.zeros(n, kind)
    for term in np.nonzero(query)[0]:
        at, weights = postings[term]
        if at is None:
            scores += weights * query[term]
        else:
            scores[at] += weights * query[term]
    return scores


def _postings(matrix: np.ndarray) -> list:
    """By component: (places, weights) of the rows where it isn't nought, or (None, all weights) if most rows have it."""
    out = []
    for column in np.ascontiguousarray(matrix.T):
        at = np.nonzero(column)[0]
        out.append((None, column) if len(at) >= DENSE * len(column) else (at, column[at]))
    return out


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id: partition selection, then a sort of what is left."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        above, level = np.nonzero(scores > least)[0], np.nonzero(scores == least)[0]
        if len(level) > (room := k - len(above)):
            level = level[np.argpartition(ids[level], room - 1)[:room]]
        at = np.concatenate([above, level])
    else:
        at = np.arange(len(scores))
    if scores.dtype == object:
        return np.array(sorted(at.tolist(), key=lambda i: (-scores[i], ids[i])), np.int64)
    return at[np.lexsort((ids[at], -scores[at]))]


def _reported(scores: np.ndarray) -> tuple[np.ndarray, list[str]]:
    """Scores within 64 bits, and the digits that rank those at or beyond the limits; else empty."""
    if scores.dtype != object:
        return scores.astype(np.int64), [""] * len(scores)
    beyond = [str(OFFSET + s) if not LOWEST < s < HIGHEST else "" for s in scores.tolist()]
    return np.array([min(HIGHEST, max(LOWEST, s)) for s in scores.tolist()], np.int64), beyond


def top_k(vectors: DataFrame, k: int = K, every: int = EVERY, id_col: str = "vec_id", vector_col: str = "embedding", groups: int | None = None) -> DataFrame:
    """query_id, rank (from 1), vec_id and score: each query's k highest integer inner products, ties to the smaller id.

    Queries are the rows whose id is divisible by ``every``; candidates are all rows but those of the query's own id.
    Vectors that are null or hold null or non-finite components take no part, nor do null ids. Of rows that repeat a
    query's id the least vector is the query; as candidates each of them counts. What a shorter vector lacks counts as
    nought. Scores are exact whatever the components; one that a long can't hold is ranked by its true value and returned as
    the nearest long. Fewer candidates give fewer ranks, an empty table none. Other columns are not read.

    Both sides are dealt to groups and every group of queries meets every group of candidates in a task of its own:
    ``groups`` tasks, by default two for each core and as many as keep a task below PAIRS pairs and GROUP candidates.
    There are as many more groups of candidates than of queries as there are more rows, so that least is shuffled.
    """
    spark = vectors.sparkSession
    rows = _usable(vectors, id_col, vector_col)
    counts = vectors.agg(F.count("*").alias("n"), F.count_if(F.pmod(F.col(id_col).cast("long"), F.lit(every)) == 0).alias("asked")).first()
    n, asked_for = counts["n"], max(1, counts["asked"])
    if groups is None:
        groups = max(2 * spark.sparkContext.defaultParallelism, -(-n * asked_for // PAIRS))
    across = min(groups, max(1, -(-n // GROUP), math.isqrt(groups * n // asked_for)))
    down = -(-groups // across)
    every_one = lambda upto: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(upto - 1).cast("long")))
    queries = rows.where(F.pmod("vec_id", F.lit(every)) == 0).groupBy("vec_id").agg(F.min("v").alias("v"))
    # A block's group follows from its ids, so that a task run again deals alike.
    own = F.pmod(F.xxhash64("ids"), F.lit(across)).alias("c")
    candidates = _blocks(rows, min(CANDIDATES, n // across + 1)).select("*", own).select("*", every_one(down).alias("q"))
    asked = _blocks(queries, QUERIES).select("*", F.pmod(F.xxhash64("ids"), F.lit(down)).alias("q")).select("*", every_one(across).alias("c"))
    names = ("ids", "lengths", "values", "wide")
    pairs = asked.select("q", "c", *[F.col(x).alias(f"q_{x}") for x in names]).join(candidates, ["q", "c"]).select(*[f"q_{x}" for x in names], *names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                q_ids, q_lengths, ids, lengths = (batch.column(c)[row].values.to_numpy() for c in (0, 1, 4, 5))
                q_values, values = (_components(batch.column(c)[row], batch.column(c + 1)[row]) for c in (2, 6))
                width = int(max(q_lengths.max(initial=0), lengths.max(initial=0)))
                kind = _kind(q_values, values, width)
                postings = _postings(_matrix(lengths, values.astype(kind), width))
                out = []
                for query_id, query in zip(q_ids.tolist(), _matrix(q_lengths, q_values.astype(kind), width), strict=True):
                    scores = _scores(query, postings, len(ids), kind)
                    other = ids != query_id
                    own_ids, scores = (ids, scores) if other.all() else (ids[other], scores[other])
                    at = _best(own_ids, scores, k)
                    out.append((np.full(len(at), query_id), own_ids[at], *_reported(scores[at])))
                found = [np.concatenate(x) for x in zip(*out, strict=True)]
                yield pa.RecordBatch.from_arrays([*[pa.array(x, pa.int64()) for x in found[:3]], pa.array(found[3].tolist(), pa.string())], ["query_id", "vec_id", "score", "beyond"])

    found = pairs.mapInArrow(run, "query_id long, vec_id long, score long, beyond string")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("beyond").desc(), F.col("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def oracle(k: int = K, every: int = EVERY) -> str:
    """DuckDB SQL of :func:`top_k`."""
    return f"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % {every} = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) AS r WHERE rank <= {k}"""
