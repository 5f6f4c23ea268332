"""Centroid clustering (k-means on integers) whose comparisons are filtered by an n-simplex projection.

The squared distances of every vector to a few pivots are kept beside it. With the pivots as the base of a simplex they become
the coordinates of its apex: the place within the base, and the altitude above it. Of two apexes the plain Euclidean distance
is a lower bound of the true one, and with one altitude turned to the other side an upper bound. A centroid whose lower bound
lies above the least upper bound can't be the nearest; only the others are compared exactly, in integers.

The gap between both bounds is four times the product of the altitudes, so pivots serve best that span where centroids are.
The centroids themselves, and those of the pivots before, become the pivots in rounds 0, 1, 2, 4, 8 and so on: distances are
measured anew a logarithmic number of times, and in between centroids stay close to their base.
"""

import math
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spoor.llm.common import written

#: A component x becomes floor(SCALE * x); vectors have WIDTH components.
SCALE, WIDTH = 1024, 64
#: Centroids, rounds, and what stands before an id in the hash that chooses the first centroids.
K, ROUNDS, SEED = 8, 10, 3
#: The condition of the pivots' base beyond which a further one isn't taken.
CONDITION = 1e3
#: Rows whose components all lie below NARROW have exact squared distances in 64 bits from centroids below NEAR. From a centroid
#: at or beyond NEAR such a row is farther than from any centroid below NARROW.
NARROW, NEAR = 1 << 20, 1 << 27
#: Share of the squared distances from the first pivot by which bounds are loosened: far above what rounding can do under CONDITION.
SLACK = 1e-6
#: Bits of a limb: sums of any size travel as limbs, which Spark adds up.
LIMB = 40
MOST = 2**63 - 1
#: Sums of a cluster other than those of its components.
COUNT, INERTIA = -1, -2


def quantised(x: float) -> int:
    """floor(SCALE * x), exactly, also where the product passes a double."""
    return SCALE * int(x) if abs(x) >= 2**53 else math.floor(SCALE * x)


class Simplex:
    """Pivots as the base of a simplex."""

    def __init__(self, pivots: np.ndarray):
        self.pivots = pivots
        own = self.distances(pivots).astype(np.float64)
        gram = (own[:1, 1:] + own[1:, :1] - own[1:, 1:]) / 2
        self.first, self.inverse = own[0, 1:], np.linalg.inv(np.linalg.cholesky(gram)) if len(pivots) > 1 else np.zeros((0, 0))

    @classmethod
    def of(cls, rows: list[list[int]]) -> "Simplex | None":
        """Those of ``rows`` that make a well-conditioned base, earlier ones first; None without narrow rows."""
        chosen: list[list[int]] = []
        for row in rows:
            if max(map(abs, row)) < NARROW and (not chosen or np.linalg.cond(np.array(chosen[1:] + [row], float) - np.array(chosen[0], float)) < CONDITION):
                chosen.append(row)
        return cls(np.array(chosen, np.int64)) if chosen else None

    def distances(self, rows: np.ndarray) -> np.ndarray:
        """Exact squared distances of integer rows to the pivots."""
        return np.stack([((rows - p) ** 2).sum(axis=1) for p in self.pivots], axis=1)

    def apexes(self, distances: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places within the base, altitudes) from squared distances to the pivots."""
        d = distances.astype(np.float64)
        within = ((d[:, :1] + self.first - d[:, 1:]) / 2) @ self.inverse.T
        return within, np.sqrt(np.maximum(0.0, d[:, 0] - (within**2).sum(axis=1)))


@dataclass
class Centroids:
    """Integer centroids by number, and the base that filters them; ``compared`` counts exact distances."""

    values: list[list[int]]
    simplex: Simplex | None
    compared: int = 0

    def __post_init__(self):
        reach = [max(map(abs, c), default=0) for c in self.values]
        self.near = [j for j, r in enumerate(reach) if r < NEAR] if any(r < NARROW for r in reach) else []
        self.close = np.array([self.values[j] for j in self.near], np.int64).reshape(-1, WIDTH)
        if self.near and self.simplex:
            own = self.simplex.distances(self.close)
            self.places, self.heights = self.simplex.apexes(own)
            self.from_first = own[:, 0].astype(np.float64)

    def candidates(self, distances: np.ndarray) -> np.ndarray:
        """Rows by near centroids: False where the bounds rule a centroid out."""
        within, height = self.simplex.apexes(distances)
        flat = ((within[:, None, :] - self.places[None, :, :]) ** 2).sum(axis=2)
        lower, upper = flat + (height[:, None] - self.heights) ** 2, flat + (height[:, None] + self.heights) ** 2
        slack = 1 + SLACK * (distances[:, :1].astype(np.float64) + self.from_first)
        return lower - slack <= (upper + slack).min(axis=1, keepdims=True)

    def narrow(self, rows: np.ndarray, distances: np.ndarray, measured: bool) -> tuple[np.ndarray, np.ndarray]:
        """(number, squared distance) of the nearest centroid of rows below NARROW; the distance only if ``measured`` or in need."""
        if not self.near:
            return self.wide(rows.astype(object))
        left = self.candidates(distances) if self.simplex else np.ones((len(rows), len(self.near)), bool)
        number, best = left.argmax(axis=1), np.full(len(rows), MOST, np.int64)
        asked = np.ones(len(rows), bool) if measured else left.sum(axis=1) > 1
        for j, centroid in enumerate(self.close):
            at = np.nonzero(left[:, j] & asked)[0]
            self.compared += len(at)
            d = ((rows[at] - centroid) ** 2).sum(axis=1)
            less = d < best[at]
            best[at[less]], number[at[less]] = d[less], j
        return np.array(self.near)[number], best

    def wide(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for rows of any size, in Python's integers, against every centroid."""
        number, best = np.zeros(len(rows), np.int64), np.array([None] * len(rows), object)
        for i, row in enumerate(rows.tolist()):
            found = [sum((a - b) ** 2 for a, b in zip(row, c, strict=True)) for c in self.values]
            self.compared += len(found)
            best[i] = min(found)
            number[i] = found.index(best[i])
        return number, best

    def digests(self) -> list[str]:
        return [sha256(",".join(map(str, c)).encode()).hexdigest() for c in self.values]


def _usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, x): array<double> of WIDTH components, none null or non-finite."""
    x = F.col(vector_col).cast("array<double>")
    whole = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return vectors.select(F.col(id_col).cast("long").alias("vec_id"), x.alias("x")).where((F.size("x") == WIDTH) & whole)


def _first(rows: DataFrame, n: int, seed: int) -> list[list[int]]:
    """The n rows of least hash, equal hashes by their components: what the driver receives has a fixed size."""
    hashed = rows.withColumn("h", F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256))
    return [[quantised(c) for c in r["x"]] for r in hashed.orderBy("h", "x").limit(n).collect()]


def _measured(rows: DataFrame, simplex: Simplex | None) -> DataFrame:
    """(vec_id, q, x, d): integer components and squared pivot distances, or the components as they are where one is not narrow."""

    def lists(values: np.ndarray, there: np.ndarray, kind: pa.DataType) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(there * values.shape[1])]), pa.int32()), pa.array(values.ravel(), kind), mask=pa.array(~there))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, WIDTH)
            narrow = (np.abs(x) < NARROW / SCALE).all(axis=1)
            q = np.floor(x[narrow] * SCALE).astype(np.int64)
            d = simplex.distances(q) if simplex else np.zeros((len(q), 0), np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), lists(q, narrow, pa.int32()), lists(x[~narrow], ~narrow, pa.float64()), lists(d, narrow, pa.int64())], ["vec_id", "q", "x", "d"])

    return written(rows.mapInArrow(run, "vec_id long, q array<int>, x array<double>, d array<long>"))


def _assigned(batch: pa.RecordBatch, centroids: Centroids, measured: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(places in the batch, components, numbers, squared distances) of the narrow rows and of the others."""
    narrow = batch.column(1).is_valid().to_numpy(zero_copy_only=False)
    if narrow.any():
        rows = batch.column(1).flatten().to_numpy().astype(np.int64).reshape(-1, WIDTH)
        yield np.nonzero(narrow)[0], rows, *centroids.narrow(rows, batch.column(3).flatten().to_numpy().reshape(len(rows), -1), measured)
    if not narrow.all():
        rows = np.array([quantised(c) for c in batch.column(2).flatten().to_pylist()], object).reshape(-1, WIDTH)
        yield np.nonzero(~narrow)[0], rows, *centroids.wide(rows)


def _limbs(value: int) -> Iterator[tuple[int, int]]:
    """(place, limb) of a number of any size and sign, noughts left out."""
    sign, value, place = (-1 if value < 0 else 1), abs(value), 0
    while value:
        if value & ((1 << LIMB) - 1):
            yield place, sign * (value & ((1 << LIMB) - 1))
        value, place = value >> LIMB, place + 1


def _sums(rows: DataFrame, centroids: Centroids, measured: bool) -> dict[tuple[int, int], int]:
    """Exact sums over all rows by cluster and component, and its COUNT and INERTIA: tasks add up their own, Spark adds up theirs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {(j, at): 0 for j in range(len(centroids.values)) for at in range(INERTIA, WIDTH)}
        for batch in batches:
            for _, own, number, distance in _assigned(batch, centroids, measured):
                for j in np.unique(number).tolist():
                    there = number == j
                    for at, s in enumerate(own[there].sum(axis=0).tolist()):
                        sums[j, at] += s
                    sums[j, COUNT] += int(there.sum())
                    if measured:
                        sums[j, INERTIA] += sum(distance[there].tolist())
        made = [(j, at, place, limb) for (j, at), s in sums.items() for place, limb in _limbs(s)]
        yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*made, strict=True) if made else [[]] * 4, (pa.int32(), pa.int32(), pa.int32(), pa.int64()), strict=True)], ["j", "at", "place", "limb"])

    found = rows.mapInArrow(run, "j int, at int, place int, limb long").groupBy("j", "at", "place").agg(F.sum(F.col("limb").cast("decimal(38,0)")).alias("limb"))
    sums: dict[tuple[int, int], int] = {}
    for r in found.collect():  # clusters x components x limbs
        sums[r["j"], r["at"]] = sums.get((r["j"], r["at"]), 0) + (int(r["limb"]) << (LIMB * r["place"]))
    return sums


def cluster(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, seed: int = SEED, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, cluster, distance (squared), cluster_inertia, inertia and centroid_sha256 of every usable vector.

    Vectors that are null, not of WIDTH components, or hold null or non-finite ones take no part. The first centroids are the
    k vectors of least hash of their ids; of rows that repeat an id the lesser vector comes first, and each row counts. A null
    id counts as an empty string there and stays null. Fewer vectors give fewer centroids, and an empty table no rows. A cluster
    that no vector is nearest to keeps its centroid; equal distances go to the smaller number. Other columns are not read.

    Sums and distances are exact, whatever the components; a distance or an inertia that a long can't hold is returned as the
    greatest long. Vectors with a component of 2**20 or more after scaling are compared with every centroid in Python's
    integers. Each round is one pass over the measured table: a task sends k x (WIDTH + 2) sums, and the driver receives
    as many. The table lies in the shared folder, so a lost executor costs its own tasks.
    """
    rows = _usable(vectors, id_col, vector_col)
    values, before = _first(rows, k, seed), []
    simplex = Simplex.of(values)
    measured = _measured(rows, simplex)
    for step in range(rounds if values else 0):
        if step and not step & (step - 1):
            simplex, before = Simplex.of(values + before), values
            measured = _measured(rows, simplex)
        sums = _sums(measured, Centroids(values, simplex), False)
        values = [[sums.get((j, at), 0) // n for at in range(WIDTH)] if (n := sums.get((j, COUNT), 0)) else c for j, c in enumerate(values)]
    last = Centroids(values, simplex)
    sums = _sums(measured, last, True)
    inertia = [min(MOST, sums.get((j, INERTIA), 0)) for j in range(len(values))]
    whole, digests = min(MOST, sum(sums.get((j, INERTIA), 0) for j in range(len(values)))), last.digests()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number, distance = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            for at, _, own, d in _assigned(batch, last, True):
                number[at], distance[at] = own, [min(MOST, x) for x in d.tolist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(number, pa.int32()), pa.array(distance), pa.array([inertia[j] for j in number], pa.int64()), pa.array([whole] * len(number), pa.int64()), pa.array([digests[j] for j in number], pa.string())],
                ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"],
            )

    return measured.mapInArrow(run, "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")


def oracle(k: int = K, rounds: int = ROUNDS, seed: int = SEED) -> str:
    """DuckDB SQL of :func:`cluster`: every vector against every centroid, round after round."""
    nearest = "SELECT r, vec_id, e, arg_min(j, [d, j]) AS j, min(d) AS d FROM (SELECT v.r, v.vec_id, v.e, c.j, CAST(list_sum(list_transform(list_zip(v.e, c.e), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS d FROM v, c{n} c) AS x GROUP BY r, vec_id, e"
    steps = "".join(
        f""",
a{n} AS MATERIALIZED ({nearest.format(n=n)}),
p{n} AS (SELECT j, place, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM (SELECT j, unnest(e) AS x, unnest(range({WIDTH})) AS place FROM a{n}) AS x GROUP BY j, place),
m{n} AS (SELECT j, list(CAST((s - ((s % n) + n) % n) / n AS BIGINT) ORDER BY place) AS e FROM p{n} GROUP BY j),
c{n + 1} AS MATERIALIZED (SELECT c.j, coalesce(m.e, c.e) AS e FROM c{n} c LEFT JOIN m{n} m USING (j))"""
        for n in range(rounds)
    )
    return f"""
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE len(embedding) = {WIDTH} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('{seed}:' || coalesce(CAST(vec_id AS VARCHAR), '')), e) - 1 AS j, e FROM v QUALIFY j < {k}){steps},
a AS MATERIALIZED ({nearest.format(n=rounds)})
SELECT a.vec_id, CAST(a.j AS INTEGER) AS cluster, a.d AS distance, CAST(sum(a.d) OVER (PARTITION BY a.j) AS BIGINT) AS cluster_inertia, CAST(sum(a.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.e, ',')) AS centroid_sha256
FROM a JOIN c{rounds} c USING (j)"""
