"""Quality rules: counts over a text's words, a base rule on them, and an isolation forest over their ratios.

Every tree splits the labelled rows on random features at random values; a document that few splits set apart is anomalous.
The score is 2 to the power of minus the mean path length over the expected one. Trees grow from all labelled rows, level by
level: tasks count the rows of every node and find their bounds, and the driver, which holds the trees alone, splits the nodes.
The threshold is a rank among the scores of all good rows; statistics and scores are made for every row.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spoor.llm.common import written

#: Base rule: fewest words, and most repeated words in a hundred.
LEAST_WORDS, MOST_REPEATED = 50, 50
BLANK_CHARS, SYMBOLS = " \t\n\v\f\r", "#*$%&|<>"
#: Leaves of a tree at most, trees, and the seed of the splits.
PER_TREE, TREES, SEED = 1024, 100, 20240131
#: What all bad rows that trees grow from weigh at most, as a share of the good ones: little enough for splits to set them apart.
RARE = 0.01
#: The share of good labelled rows that the threshold may reject.
MOST_LOST = 0.005
#: Classes of scores that one search for a rank counts.
CLASSES = 4096
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_marks", "n_chars")


def repeated_words(words: list[bytes], width: int = 3) -> int:
    """Words that stand in a window of ``width`` words found twice or more in the text."""
    n = len(words)
    if n <= width:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    keys = ids[: n - width + 1]
    for k in range(1, width):
        # Numbered anew each time, so that the product never overflows.
        keys = np.unique(keys * len(number) + ids[k : n - width + 1 + k], return_inverse=True)[1]
    again = np.bincount(keys)[keys] > 1
    covered = np.zeros(n, bool)
    for k in range(width):
        covered[k : n - width + 1 + k] |= again
    return int(covered.sum())


def statistics(text: str | None) -> tuple[int, ...]:
    """The counts named in COUNTS."""
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()  # bytes: only the six ASCII blanks split
    lines = [x for x in text.split("\n") if x.strip(BLANK_CHARS)]
    upper = sum(map(text.count, "ABCDEFGHIJKLMNOPQRSTUVWXYZ")) if text.isascii() else sum(map(str.isupper, text))
    return (
        len(words),
        len(text) - sum(map(text.count, BLANK_CHARS)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        upper,
        sum(map(text.count, "!?.,;:")),
        len(text),
    )


def with_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the counts of every row; a null text has none of anything."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = np.array([statistics(t) for t in batch.column(1).to_pylist()], np.int64).reshape(-1, len(COUNTS))
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c) for c in made.T.copy()]], ["doc_id", *COUNTS])

    schema = f"doc_id {docs.schema[id_col].dataType.simpleString()}, " + ", ".join(f"{c} long" for c in COUNTS)
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def features(counts: np.ndarray) -> np.ndarray:
    """Ratios that don't follow a document's length: rows by features."""
    words, chars, symbols, dups, repeats, upper, marks, whole = counts.astype(float).T
    per = np.maximum(words, 1)
    letters = np.maximum(chars, 1)
    return np.stack([chars / per, symbols / letters, dups / per, repeats / per, upper / letters, marks / per, chars / np.maximum(whole, 1)], 1)


def expected_path(n: np.ndarray) -> np.ndarray:
    """Mean path length of an unsuccessful search in a binary tree of n rows."""
    n = np.asarray(n, float)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649) - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


@dataclass
class Forest:
    #: by tree and node, a heap as deep as ``depth``: the feature (-1 in a leaf), the value to split at, and the path that a leaf adds
    feature: np.ndarray
    value: np.ndarray
    path: np.ndarray
    depth: int
    norm: float = 1.0
    threshold: float = 1.0

    @classmethod
    def bare(cls, trees: int, leaves: int) -> "Forest":
        """Trees of a root only, to be split down to this many leaves."""
        depth = max(1, int(np.ceil(np.log2(max(2, leaves)))))
        nodes = (trees, 2 ** (depth + 1) - 1)
        return cls(np.full(nodes, -1), np.zeros(nodes), np.zeros(nodes), depth)

    def _nodes(self, tree: int, x: np.ndarray, depth: int) -> np.ndarray:
        """Where the rows of x stand after ``depth`` steps down one tree, or in the leaf before."""
        feature, value = self.feature[tree], self.value[tree]
        node, rows = np.zeros(len(x), np.int64), np.arange(len(x))
        for _ in range(depth):
            f = feature[node]
            node = np.where(f < 0, node, 2 * node + 1 + (x[rows, f] >= value[node]))
        return node

    def scores(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        for tree in range(len(self.feature)):
            total += self.path[tree][self._nodes(tree, x, self.depth)]
        return 2.0 ** (-total / len(self.feature) / self.norm)

    def bounds(self, level: int, x: np.ndarray, good: np.ndarray) -> tuple[np.ndarray, ...]:
        """Of every node of this level that rows of x reach: (tree * nodes + node, good rows, bad rows, least and greatest features)."""
        found, first = [], 2**level - 1
        for tree in range(len(self.feature)):
            node = self._nodes(tree, x, level)
            at = np.nonzero(node >= first)[0]  # others ended in a leaf above
            at = at[np.argsort(node[at], kind="stable")]
            node, starts, n = np.unique(node[at], return_index=True, return_counts=True)
            if len(at):
                of_good = np.add.reduceat(good[at].astype(np.int64), starts)
                found.append((tree * self.feature.shape[1] + node, of_good, n - of_good, np.minimum.reduceat(x[at], starts), np.maximum.reduceat(x[at], starts)))
        empty = (np.zeros(0, np.int64),) * 3 + (np.zeros((0, x.shape[1])),) * 2
        return tuple(np.concatenate(c) for c in zip(*found, strict=True)) if found else empty

    def split(self, level: int, bounds: tuple[np.ndarray, ...], bad_weight: float, seed: int) -> None:
        """Split the nodes of a level, whose bounds over all rows these are, at random; those without good rows, of a weight below two, or that can't be split are leaves.

        A node's draws depend on the seed and its own place only, so that they don't depend on the order of the bounds.
        """
        at, good, bad, low, high = bounds
        tree, node = np.divmod(at, self.feature.shape[1])
        weight = good + bad_weight * bad
        if level == 0:
            self.norm = float(max(expected_path(weight[0]), 1e-9))
        self.path[tree, node] = level + expected_path(weight)
        able = high > low
        open_ = able.any(1) & (good > 0) & (weight >= 2) & (level < self.depth)
        draws = np.random.default_rng((seed, level)).random((len(self.feature), 2**level, 2))[tree, node - (2**level - 1)]
        nth = np.floor(draws[:, 0] * able.sum(1)).astype(np.int64)  # which of the features that differ
        f = np.argmax(np.cumsum(able, 1) > nth[:, None], 1)
        rows = np.arange(len(at))
        value = low[rows, f] + draws[:, 1] * (high[rows, f] - low[rows, f])
        self.feature[tree[open_], node[open_]], self.value[tree[open_], node[open_]] = f[open_], value[open_]


def weight_of_bad(good: int, bad: int) -> float:
    """What a bad row weighs beside a good one, so that all together are RARE among them at most."""
    return min(1.0, RARE * good / bad) if bad else 1.0


def rank_of_threshold(good: int) -> int:
    """The place, from 0, of the threshold among the scores of the good rows in ascending order."""
    return int(np.ceil((good - 1) * (1 - MOST_LOST)))


def between(floor: float, next_bad: float | None) -> float:
    """The threshold: halfway from the floor to the next bad row, so that good rows just beyond the floor stay; without one all stay."""
    return 1.0 if next_bad is None else (floor + next_bad) / 2


def grow(x: np.ndarray, good: np.ndarray | None = None, trees: int = TREES, per_tree: int = PER_TREE, seed: int = SEED) -> Forest:
    """A forest over all rows of x, in memory; ``per_tree`` is the number of a tree's leaves at most."""
    good = np.ones(len(x), bool) if good is None else good
    forest = Forest.bare(trees, min(per_tree, len(x)))
    weight = weight_of_bad(int(good.sum()), int((~good).sum()))
    for level in range(forest.depth + 1):
        forest.split(level, forest.bounds(level, x, good), weight, seed)
    return forest


def fit(rows: np.ndarray, good: np.ndarray) -> Forest | None:
    """What ``fitted`` makes of the same rows of counts, in memory."""
    if good.sum() < 2:
        return None
    x = features(rows)
    forest = grow(x, good)
    scores = forest.scores(x)
    floor = np.sort(scores[good])[rank_of_threshold(int(good.sum()))]
    above = scores[~good][scores[~good] > floor]
    forest.threshold = between(float(floor), float(above.min()) if len(above) else None)
    return forest


def _counts(batch: pa.RecordBatch) -> np.ndarray:
    return np.stack([batch.column(c).to_numpy() for c in COUNTS], 1)


def _bounds(rows: DataFrame, forest: Forest, level: int) -> tuple[np.ndarray, ...]:
    """``Forest.bounds`` over all of ``rows``: each task gives a row for a node, and those of one node are combined."""
    width = len(features(np.zeros((1, len(COUNTS))))[0])
    lows, highs = [f"low{k}" for k in range(width)], [f"high{k}" for k in range(width)]
    names = ["at", "good", "bad", *lows, *highs]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes = forest.feature.size
        good, bad = np.zeros(nodes, np.int64), np.zeros(nodes, np.int64)
        low, high = np.full((nodes, width), np.inf), np.full((nodes, width), -np.inf)
        for batch in batches:
            at, of_good, of_bad, least, most = forest.bounds(level, features(_counts(batch)), batch.column("good").to_numpy(zero_copy_only=False))
            good[at] += of_good
            bad[at] += of_bad
            low[at], high[at] = np.minimum(low[at], least), np.maximum(high[at], most)
        at = np.nonzero(good + bad)[0]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in (at, good[at], bad[at], *low[at].T.copy(), *high[at].T.copy())], names)

    schema = "at long, good long, bad long, " + ", ".join(f"{c} double" for c in (*lows, *highs))
    own = [F.sum(c).alias(c) for c in ("good", "bad")] + [F.min(c).alias(c) for c in lows] + [F.max(c).alias(c) for c in highs]
    found = rows.mapInArrow(run, schema).groupBy("at").agg(*own).toArrow()
    at, good, bad = (found.column(c).to_numpy() for c in names[:3])
    return at, good, bad, *(np.stack([found.column(c).to_numpy() for c in cs], 1) for cs in (lows, highs))


def value_at(values: DataFrame, column: str, place: int) -> float:
    """The value at a place, from 0, in ascending order, exactly: each search keeps the class of values that holds it."""
    low, high = values.agg(F.min(column), F.max(column)).first()
    while low < high:
        number = F.floor((F.col(column) - F.lit(low)) / F.lit(high - low) * CLASSES)
        classes = values.where(F.col(column).between(low, high)).groupBy(number.alias("class")).agg(F.count("*").alias("n"), F.min(column).alias("low"), F.max(column).alias("high"))
        for c in sorted(classes.toArrow().to_pylist(), key=lambda c: c["class"]):
            low, high = c["low"], c["high"]
            if place < c["n"]:
                break
            place -= c["n"]
    return low


def _scored(rows: DataFrame, forest: Forest) -> DataFrame:
    """``rows``, which hold the counts, plus anomaly."""
    names, schema = rows.columns, rows.withColumn("anomaly", F.lit(0.0)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(forest.scores(features(_counts(batch))))], [*names, "anomaly"])

    return rows.mapInArrow(run, schema)


def fitted(rows: DataFrame) -> Forest | None:
    """A forest grown from, and a threshold set by, all of ``rows`` (COUNTS, good); None if fewer than two are good.

    Bad rows weigh little while trees grow. The threshold lies above all but MOST_LOST of the good rows.
    """
    # Read by as many tasks as there are cores, so that the partial bounds grow with the cluster and not with the rows.
    rows = written(rows).coalesce(rows.sparkSession.sparkContext.defaultParallelism)
    good, bad = rows.agg(F.count_if("good"), F.count_if(~F.col("good"))).first()
    if good < 2:
        return None
    forest = Forest.bare(TREES, min(PER_TREE, good + bad))
    for level in range(forest.depth + 1):
        forest.split(level, _bounds(rows, forest, level), weight_of_bad(good, bad), SEED)
    scores = written(_scored(rows, forest).select("good", "anomaly"))
    floor = value_at(scores.where("good"), "anomaly", rank_of_threshold(good))
    forest.threshold = between(floor, scores.where(~F.col("good") & (F.col("anomaly") > floor)).agg(F.min("anomaly")).first()[0])
    return forest


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, the counts, base_failed, anomaly (the forest's score) and kept of every row.

    ``kept`` is false if base_failed, else if the score is above the threshold. The fit takes every labelled row that passes
    the base rule; with fewer than two good ones, or no bad one that stands out, nothing more is rejected. Rows repeat as
    given, null ids too; an empty table gives none; labels may repeat or disagree, each counts. Other columns are not read.
    """
    counted = written(with_statistics(docs, id_col, text_col).withColumn("base_failed", base_failed()))
    marks = labels.select(F.col("doc_id").alias("label_id"), (F.col("quality").cast("int") == 1).alias("good")).where("label_id is not null and good is not null")
    forest = fitted(counted.where("not base_failed").join(marks, F.col("doc_id") == F.col("label_id")).select(*COUNTS, "good"))
    if forest is None:
        return counted.withColumns({"anomaly": F.lit(0.0), "kept": ~F.col("base_failed")})
    return _scored(counted, forest).withColumn("kept", ~F.col("base_failed") & (F.col("anomaly") <= forest.threshold))
