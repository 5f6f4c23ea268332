"""SimHash near-duplicates: tiled exact comparison of fingerprints.

Fingerprints are sorted into tiles by the population counts of their two halves. Two words that differ in at most
``radius`` bits have half counts that differ by at most ``radius`` in sum, so a tile is only compared with tiles whose
counts lie that near; those pairs of tiles are compared by numpy exclusive-or and bit counts. A large pair of tiles is first
split by the counts of 16-bit and then 8-bit parts, and blocks whose counts differ too far are skipped. No pair of rows is
ever a Spark row: a pair of tiles gives back a spanning forest of its links, of at most one link a fingerprint.

Documents are dropped by more than their fingerprints: there the tiles only name candidates, and each is checked by the
exact Jaccard similarity of the two documents' sets of shingles. Those tiles go by the sizes of the sets too, as sets of
which one is too small can't be similar.
"""

import math
from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spoor.llm.common import dealt_anew, written
from spoor.operators.closure import components

#: Words of a shingle, and the seed of its hash.
SHINGLE, SEED = 4, 42
#: Bits in which two linked fingerprints may differ.
RADIUS = 4
#: Words of a shingle of the sets that are compared exactly, and the similarity at which documents are linked.
WIDE_SHINGLE, SIMILARITY = 5, 0.8
#: Bits of the first and of both of a candidate's fingerprints: at 0.8 ten and twenty differ on average, with deviations of 2.9 and 4.1.
WIDE_RADIUS, WIDE_TOTAL = 20, 36
#: Odd factors that reorder a set's hashes: the least of each order names a star of documents that are checked first.
ORDERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], np.uint64)
#: Documents whose sets are in a worker's memory at once.
SLICE = 256
#: Partners in a pair of tiles up to which each is a row of its own; members of the sets of one side of a block that is checked at once.
SPARSE, BLOCK_MEMBERS = 8, 1 << 20
#: Bit counts of both words that one cell of the wide comparison takes in.
CELL_BITS = 12
#: Distinct fingerprints in a tile at most: the more there are, the better a pair of tiles can be split.
MOST_TILE = 65536
#: Pairs of rows, and rows of tiles, that a task of comparisons is dealt about.
ROW_PAIRS, TILE_ROWS = 1 << 31, 1 << 20
#: Comparisons that numpy makes at once, and pairs of rows up to which two blocks are compared rather than split further.
CHUNK, LEAF = 1 << 18, 1 << 20
#: The halves of a word that tiles go by, and how they are split on: which part, and the bits of its upper half.
HALVES = (np.uint64(0xFFFFFFFF00000000), np.uint64(0x00000000FFFFFFFF))
SPLITS = tuple((part, np.uint64(mask)) for part, mask in ((0, 0xFFFF << 48), (1, 0xFFFF << 16), (0, 0xFF << 40), (1, 0xFF << 8), (2, 0xFF << 56), (3, 0xFF << 24)))


def shingle_hashes(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """The hashes of a text's word shingles in order, repeats included; a text of fewer words is one shingle, one without words none."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z change, only ASCII blanks split
    if not words:
        return np.zeros(0, np.uint64)
    joined, n = b" ".join(words), max(1, len(words) - shingle + 1)
    if n == 1:
        return np.array([xxhash.xxh64_intdigest(joined, seed)], np.uint64)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[: n - 1] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[s:e], seed) for s, e in zip(starts, ends[shingle - 1 :].tolist(), strict=True)], np.uint64)


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The 64-bit SimHash of a text's word shingles, repeats included, as a signed number; zero without words."""
    return _majority(shingle_hashes(text, shingle, seed))


def _majority(hashes: np.ndarray) -> int:
    """Bits that more than half of the hashes have, as a signed number."""
    n = len(hashes)
    if not n:
        return 0
    set_bits = np.zeros(64, np.int64)
    for at in range(0, n, 4096):
        part = np.unpackbits(hashes[at : at + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_bits += part.sum(axis=0, dtype=np.uint16)
    return int(np.packbits(2 * set_bits > n, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp) of every row. A null or blank text has fingerprint 0; null ids and repeated rows stay as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [fingerprint(t.as_py(), shingle) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.int64())], ["doc_id", "fp"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "doc_id long, fp long")


def _near(a: np.ndarray, b: np.ndarray, ia: np.ndarray, ib: np.ndarray, deltas: tuple[int, ...], radius: int, mirror: bool, leaf: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of a and b that may hold links: while a pair of blocks is large it is split by the counts of ever smaller parts.

    ``deltas`` are how far the counts of the parts so far differ; their sum is the least number of bits that differ. In a
    ``mirror`` both blocks are the same rows, so that only one of each two opposite pairs is needed.
    """
    k = len(deltas) - 2
    if k == len(SPLITS) or len(ia) * len(ib) <= leaf:
        yield ia, ib
        return
    parent, mask = SPLITS[k]
    count_a, count_b = np.bitwise_count(a[ia] & mask), np.bitwise_count(b[ib] & mask)
    by_b = {int(v): ib[count_b == v] for v in np.unique(count_b)}
    for v in np.unique(count_a):
        own = ia[count_a == v]
        for w, other in by_b.items():
            d = int(v) - w
            rest = deltas[parent] - d
            if mirror and d < 0 or sum(map(abs, deltas)) - abs(deltas[parent]) + abs(d) + abs(rest) > radius:
                continue
            split = (*deltas[:parent], rest, *deltas[parent + 1 :], d)
            yield from _near(a, b, own, other, split, radius, mirror and d == 0, leaf)


def _forest(a: np.ndarray, b: np.ndarray, same: bool, radius: int, leaf: int = LEAF) -> np.ndarray:
    """Rows of (node, root) over the two tiles' words laid end to end: the links of their components within the pair."""
    root = np.arange(len(a) + (0 if same else len(b)))
    shift = 0 if same else len(a)
    half = lambda x: tuple(int(np.bitwise_count(x[:1] & m).sum()) for m in HALVES)
    deltas = tuple(x - y for x, y in zip(half(a), half(b), strict=True))
    for ia, ib in _near(a, b, np.arange(len(a)), np.arange(len(b)), deltas, radius, same, leaf):
        step = max(1, CHUNK // max(1, len(ib)))
        for at in range(0, len(ia), step):
            near = np.bitwise_count(a[ia[at : at + step], None] ^ b[ib][None, :]) <= radius
            if near.any():  # what is connected already, as most of a large group soon is, needs no link
                near &= root[ia[at : at + step], None] != root[ib + shift][None, :]
            u, v = np.nonzero(near)
            u, v = ia[at + u], ib[v]
            v = v + shift
            while len(u):
                ru, rv = root[u], root[v]
                open_ = ru != rv
                if not open_.any():
                    break
                u, v, ru, rv = u[open_], v[open_], ru[open_], rv[open_]
                np.minimum.at(root, np.maximum(ru, rv), np.minimum(ru, rv))
                while (root != (up := root[root])).any():
                    root = up
    node = np.nonzero(root != np.arange(len(root)))[0]
    return np.stack([node, root[node]])


def _tile_pairs(words: DataFrame, cell: dict[str, Column], near: list[tuple[int, int]], most: int) -> DataFrame:
    """(a, b, same): pairs of tiles, as lists of rows of ``words`` (key and others), of cells that lie at one of the steps ``near``.

    ``cell`` are two small whole numbers of a row, and ``near`` their differences within which rows may be linked, of each
    two opposite ones the greater. A cell has as many tiles of ``most`` rows as it needs, dealt by hash. The table of cells is bounded by what the numbers can be, whatever the corpus, and so may be
    broadcast and read by the driver. Every pair of tiles has a key of its own, so that no cell is one task's work.
    """
    x, y = cell
    members = F.struct(*words.columns)
    words = written(words.withColumns(cell))
    cells = words.groupBy(x, y).agg(F.count("*").alias("n")).toArrow().to_pylist()
    n_of = {(c[x], c[y]): c["n"] for c in cells}
    of = {c: -(-n // most) for c, n in n_of.items()}
    spark = words.sparkSession
    known = F.broadcast(spark.createDataFrame([(*k, n) for k, n in of.items()], f"{x} int, {y} int, of int"))
    tile = words.join(known, [x, y]).groupBy(x, y, F.pmod(F.xxhash64("key"), F.col("of")).cast("int").alias("tile")).agg(F.collect_list(members).alias("members"))
    tile = written(tile)
    beside = [(c, (c[0] + s[0], c[1] + s[1])) for c in of for s in near]
    met, moved = (sum(n_of[c] * table.get(d, 0) for c, d in beside) for table in (n_of, of))
    parts = max(2 * spark.sparkContext.defaultParallelism, met // ROW_PAIRS, moved // TILE_ROWS)
    steps = F.explode(F.array(*[F.struct(F.lit(h).alias("x"), F.lit(w).alias("y")) for h, w in near])).alias("step")
    left = tile.select(steps, x, y, F.col("tile").alias("tile_a"), F.col("members").alias("a"))
    own = (F.col("step.x") == 0) & (F.col("step.y") == 0)
    left = left.select((F.col(x) + F.col("step.x")).alias(x), (F.col(y) + F.col("step.y")).alias(y), "tile_a", "a", own.alias("own")).join(known, [x, y])
    left = left.select(x, y, "tile_a", "a", "own", F.explode(F.sequence(F.when(F.col("own"), F.col("tile_a")).otherwise(F.lit(0)), F.col("of") - 1)).alias("tile"))
    keys = [x, y, "tile"]
    pairs = left.repartition(parts, *keys).join(tile.withColumnRenamed("members", "b").repartition(parts, *keys), keys)
    return pairs.select("a", "b", (F.col("own") & (F.col("tile_a") == F.col("tile"))).alias("same"))


def links(fps: DataFrame, radius: int = RADIUS, most: int = MOST_TILE) -> DataFrame:
    """(a, b) keys of fingerprints whose links span every component of the distinct rows of ``fps`` (key, fp).

    Fingerprints are linked if they differ in at most ``radius`` bits. Cells are the bit counts of their halves.
    """
    count = lambda c: F.bit_count(c).cast("int")
    halves = {"hi": count(F.shiftrightunsigned("fp", 32)), "lo": count(F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)))}
    near = [(h, x) for h, x in product(range(-radius, radius + 1), repeat=2) if (h, x) >= (0, 0) and abs(h) + abs(x) <= radius]
    pairs = _tile_pairs(fps.select("key", "fp").distinct(), halves, near, most)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x, y, same in zip(batch.column(0), batch.column(1), batch.column(2).to_pylist(), strict=True):
                # Unsigned, as bit counts of negative numbers are not what is wanted.
                (keys_a, a), (keys_b, b) = ([z.values.field(k).to_numpy() for k in range(2)] for z in (x, y))
                node, root = _forest(a.view(np.uint64), b.view(np.uint64), same, radius)
                keys = keys_a if same else np.concatenate([keys_a, keys_b])
                yield pa.RecordBatch.from_arrays([pa.array(keys[node], pa.int64()), pa.array(keys[root], pa.int64())], ["a", "b"])

    return pairs.mapInArrow(run, "a long, b long").distinct()


def shingle_sets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = WIDE_SHINGLE) -> DataFrame:
    """(doc_id, place, key, fp, fp2, n, m0, m1, ..., hashes) of every row: its set of shingle hashes in order, 32 bits each, and what goes before it.

    Rows have one key if and only if they have one set; key 0 is the set of a null or blank text. ``n`` is the size of the
    set, ``m`` its least members in each of ORDERS, ``place`` a number of the row.
    """
    names = ["doc_id", "key", "fp", "fp2", "n", *[f"m{k}" for k in range(len(ORDERS))], "hashes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                batch, rows, sets = whole.slice(at, SLICE), [], []
                for text in batch.column(1):
                    hashes = np.unique(shingle_hashes(text.as_py(), shingle))
                    # A second fingerprint from the same hashes, mixed anew.
                    other = hashes * ORDERS[0]
                    own = np.unique((hashes >> np.uint64(32)).astype(np.uint32))
                    sets.append(own.tobytes())
                    key = xxhash.xxh64_intdigest(sets[-1], SEED) if len(hashes) else 0
                    rows.append((key, *(x % 2**64 for x in (_majority(hashes), _majority(other ^ other >> np.uint64(29)))), len(own), *((hashes * m).min() if len(hashes) else 0 for m in ORDERS)))
                made = np.array(rows, np.uint64).reshape(-1, len(names) - 2).view(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c) for c in made.T.copy()], pa.array(sets, pa.binary())], names)

    schema = "doc_id long, " + ", ".join(f"{c} long" for c in names[1:-1]) + ", hashes binary"
    found = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)
    return found.withColumn("place", F.monotonically_increasing_id())


def _fitting(a: tuple, b: tuple, similarity: float, radius: int, total: int, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(u, v), places in the columns (fp, fp2, n, root) of a and b: what differs in root and may be similar, all partners of a row at once."""
    (x, x2, n, root), (y, y2, m, other) = a, b
    rows = max(1, CHUNK // max(1, len(y)))
    for at in range(0, len(x), rows):
        near = np.bitwise_count(x[at : at + rows, None] ^ y[None, :]) <= radius
        u, v = np.divmod(np.flatnonzero(near), len(y))
        u += at
        fits = (root[u] != other[v]) & (np.bitwise_count(x[u] ^ y[v]) + np.bitwise_count(x2[u] ^ y2[v]) <= total)
        fits &= np.minimum(n[u], m[v]) >= similarity * np.maximum(n[u], m[v])
        if same:
            fits &= u < v
        yield u[fits], v[fits]


def _columns(rows: pa.StructArray | pa.Table) -> tuple[np.ndarray, tuple]:
    """The keys, and (fp, fp2, n, root) with unsigned words, as bit counts of negative numbers are not what is wanted."""
    get = rows.field if isinstance(rows, pa.StructArray) else rows.column
    key, fp, fp2, n, root = (get(c).to_numpy() for c in ("key", "fp", "fp2", "n", "root"))
    return key, (fp.view(np.uint64), fp2.view(np.uint64), n, root)


def candidates(words: DataFrame, similarity: float = SIMILARITY, radius: int = WIDE_RADIUS, total: int = WIDE_TOTAL, most: int = MOST_TILE) -> DataFrame:
    """(a, b, block): pairs of keys of ``words`` (key, fp, fp2, n, root) whose roots differ and whose similarity may be as high.

    First words differ in at most ``radius`` bits, both together in ``total``, and the sizes of the sets allow it. Cells go by
    the logarithm of the size, whose steps are the least similarity, and by the bit counts of both words. Pairs are rows only
    while a key has few partners in a pair of tiles. The keys of a crowd, where pairs would grow with its square, are rows
    (a, side, block) instead: each key once for each block that it is to be checked in.
    """
    step = -math.log(similarity) * (1 + 1e-9)
    cell = {"band": F.floor(F.log("n") / step).cast("int"), "bits": F.floor((F.bit_count("fp") + F.bit_count("fp2")) / CELL_BITS).cast("int")}
    reach = (total - 1) // CELL_BITS + 1
    near = [(h, x) for h, x in product((0, 1), range(-reach, reach + 1)) if (h, x) >= (0, 0)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = lambda a, b, block: pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(block, pa.int64())], ["a", "b", "block"])
        for batch in batches:
            for x, y, same in zip(batch.column(0), batch.column(1), batch.column(2).to_pylist(), strict=True):
                (keys_a, a), (keys_b, b) = _columns(x.values), _columns(y.values)
                crowd_a, crowd_b = np.zeros(len(keys_a), bool), np.zeros(len(keys_b), bool)
                for u, v in _fitting(a, b, similarity, radius, total, same):
                    many = np.bincount(u, minlength=len(keys_a))[u] > SPARSE
                    crowd_a[u[many]] = crowd_b[v[many]] = True
                    if not many.all():
                        yield made(keys_a[u[~many]], keys_b[v[~many]], [None] * int((~many).sum()))
                if same:
                    crowd_a = crowd_b = crowd_a | crowd_b
                parts = lambda crowd, n: np.split(at := np.flatnonzero(crowd), np.flatnonzero(np.diff(np.cumsum(n[at]) // BLOCK_MEMBERS)) + 1) if crowd.any() else []
                for i, p in enumerate(parts(crowd_a, a[2])):
                    for j, q in enumerate(parts(crowd_b, b[2])):
                        if same and j < i:
                            continue
                        own, other = keys_a[p], keys_b[q]
                        block = np.int64(xxhash.xxh64_intdigest(own.tobytes() + b"|" + other.tobytes(), SEED) - 2**63)
                        if same and i == j:
                            yield made(own, np.full(len(own), 2), np.full(len(own), block))
                        else:
                            yield made(np.concatenate([own, other]), np.repeat([0, 1], [len(own), len(other)]), np.full(len(own) + len(other), block))

    return _tile_pairs(words.where("n > 0").select("key", "fp", "fp2", "n", "root"), cell, near, most).mapInArrow(run, "a long, b long, block long")


def _among(sets: DataFrame, places: DataFrame) -> DataFrame:
    """The rows of ``sets`` whose place is one of ``places``, so that no others are shuffled.

    Places are bits in words of 64, some 0.2 bytes a document, which Spark broadcasts while it deems them small.
    """
    bit = F.expr("shiftleft(1L, cast(place & 63 as int))")
    words = written(places.toDF("place").groupBy(F.shiftright("place", 6).alias("word")).agg(F.bit_or(bit).alias("bits")))
    return sets.join(words, F.shiftright(sets["place"], 6) == words["word"]).where(F.col("bits").bitwiseAND(bit) != 0).select(*sets.columns)


def _members(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, np.uint32)


def similar(pairs: DataFrame, sets: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The (a, b), places of ``sets`` (place, hashes), whose sets have this Jaccard similarity at least, exactly.

    Both joins shuffle ``sets`` alike, so Spark shuffles it once; a few pairs are broadcast to it instead.
    """
    one = lambda c: sets.select(F.col("place").alias(c), F.col("hashes").alias(f"of_{c}"))
    both = pairs.join(one("a"), "a").join(one("b"), "b").select("a", "b", "of_a", "of_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = _members(x.as_py()), _members(y.as_py())
                common = np.count_nonzero(np.take(y, np.searchsorted(y, x), mode="clip") == x)
                kept.append(common >= similarity * (len(x) + len(y) - common))
            yield batch.select([0, 1]).filter(pa.array(kept, pa.bool_()))

    return both.mapInArrow(run, "a long, b long")


def _crowd_links(table: pa.Table, similarity: float, radius: int, total: int) -> np.ndarray:
    """Rows (a, b) of keys that span the components of similar sets within one block (side, key, fp, fp2, n, root, hashes)."""
    side = table.column("side").to_numpy()
    same = bool((side == 2).all())
    left, right = (table, table) if same else (table.filter(pa.array(side == k)) for k in (0, 1))
    (keys_a, (x, x2, n, root)), (keys_b, (y, y2, m, other)) = _columns(left), _columns(right)
    labels = np.unique(np.concatenate([root, other]), return_inverse=True)[1]
    root, other = labels[: len(root)], labels[len(root) :]  # views: a merge shows in both
    sets = [_members(h.as_py()) for h in right.column("hashes")]
    out = []
    for i in range(len(keys_a)):
        own = sets[i] if same else _members(left.column("hashes")[i].as_py())
        row = (x[i : i + 1], x2[i : i + 1], n[i : i + 1], root[i : i + 1])
        v = np.concatenate([found for _, found in _fitting(row, (y, y2, m, other), similarity, radius, total, False)])
        v = v[v > i] if same else v
        while len(v):  # some at once, and of the others those that are not connected by then
            now, v = v[:64], v[64:]
            held = np.concatenate([sets[j] for j in now])
            hits = np.take(own, np.searchsorted(own, held), mode="clip") == held
            sizes = np.array([len(sets[j]) for j in now])
            common = np.add.reduceat(hits.astype(np.int64), np.concatenate([[0], np.cumsum(sizes)[:-1]]))
            for j in now[common >= similarity * (len(own) + sizes - common)]:
                if root[i] != other[j]:
                    out.append((keys_a[i], keys_b[j]))
                    labels[labels == other[j]] = root[i]
            v = v[other[v] != root[i]]
    return np.array(out, np.int64).reshape(-1, 2)


def crowd_links(crowds: DataFrame, words: DataFrame, sets: DataFrame, similarity: float = SIMILARITY, radius: int = WIDE_RADIUS, total: int = WIDE_TOTAL) -> DataFrame:
    """(a, b) keys that span the components of similar sets within each of ``crowds`` (a, side, block), checked block by block.

    Every pair is compared in its block's task and none is a row; a block holds some BLOCK_MEMBERS members of sets a side.
    """
    each = crowds.select(F.col("a").alias("key"), "side", "block").join(words.select("key", "fp", "fp2", "n", "root"), "key").join(sets.withColumnRenamed("place", "key"), "key")

    def run(table: pa.Table) -> pa.Table:
        found = _crowd_links(table.combine_chunks(), similarity, radius, total)
        return pa.table({"a": found[:, 0], "b": found[:, 1]})

    return each.groupBy("block").applyInArrow(run, "a long, b long")


def _similar_links(one: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """(a, b) keys of ``one`` (key, fp, fp2, n, m0, m1, ...) that span the components of similar sets of ``sets``.

    Stars of those that agree in a least hash are checked first: they join most of a group of near copies with one link
    each, and only candidates that are not connected yet need a check of their own.
    """
    least = F.array(*[F.col(f"m{k}") for k in range(len(ORDERS))])
    by = one.where("n > 0").select("key", "n", F.posexplode(least).alias("order", "value"))
    hub = F.min_by(F.struct("key", "n"), F.xxhash64("key", "order"))
    hubs = by.groupBy("order", "value").agg(hub.alias("hub"), F.count("*").alias("of")).where("of > 1").select("order", "value", F.col("hub.key").alias("hub"), F.col("hub.n").alias("hub_n"))
    stars = by.join(hubs, ["order", "value"]).where("key <> hub").where(F.least("n", "hub_n") >= similarity * F.greatest("n", "hub_n"))
    stars = stars.select(F.least("key", "hub").alias("a"), F.greatest("key", "hub").alias("b")).distinct()
    stars = written(stars)
    first = written(similar(stars, _among(sets, stars.select("a").union(stars.select("b"))), similarity))
    roots = components(first, "a", "b").withColumnRenamed("node", "key")
    words = written(one.join(roots, "key", "left").select("key", "fp", "fp2", "n", F.coalesce("root", "key").alias("root")))
    found = written(candidates(words, similarity))
    pairs, crowds = found.where("block is null").select("a", "b"), found.where("block is not null").select("a", F.col("b").alias("side"), "block")
    sets = _among(sets, found.select("a").union(pairs.select("b")))
    return first.unionByName(similar(pairs, sets, similarity)).unionByName(crowd_links(crowds, words, sets, similarity))


def _classes(docs_fp: DataFrame, found: DataFrame) -> DataFrame:
    """``docs_fp`` plus component_id, the least id of all rows whose keys the links ``found`` connect."""
    stars = components(found, "a", "b")
    fps = docs_fp.groupBy("key").agg(F.min("doc_id").alias("least"))
    rooted = written(fps.join(stars.withColumnRenamed("node", "key"), "key", "left").select("key", "least", F.coalesce("root", "key").alias("root")))
    least = dealt_anew(rooted.groupBy("root").agg(F.min("least").alias("component_id")))
    named = rooted.select("key", "root").join(least, "root").select("key", "component_id")
    return docs_fp.join(named, "key")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id, the least id among all documents linked to it, near or far.

    Two documents are linked if their fingerprints differ in at most ``radius`` bits. Every row comes back, repeated rows too;
    those without words share fingerprint zero and are linked like any other. A null id never is a component_id unless no
    document of the component has another. Other columns are not read. Empty gives empty.
    """
    docs_fp = written(fingerprints(docs, id_col, text_col, shingle).withColumn("key", F.col("fp")))
    return _classes(docs_fp, links(docs_fp, radius)).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = WIDE_SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` whose document is the least id of its component; rows that repeat an id stay or go together.

    Two documents are linked only if their sets of shingles of five words have a Jaccard similarity of 0.8 or more, which is
    computed from their whole sets of 32-bit hashes: of two sets of 300 shingles, two that differ share one with odds of 1 to 50,000,
    which moves the similarity by a 300th. Fingerprints only name the pairs to compare: by the usual model at most one
    pair in a thousand at 0.8 is not named, of sets of four and five shingles about one in two hundred. Texts without words
    are all alike. Rows whose id is null are kept only where they share a component with no other's id.
    """
    sets = written(shingle_sets(docs, id_col, text_col, shingle))
    rest = ("fp", "fp2", "n", *[f"m{k}" for k in range(len(ORDERS))])
    # Rows of one key are one node of the graph, known by the place of the first.
    one = written(sets.groupBy("key").agg(F.min("place").alias("node"), *[F.first(c).alias(c) for c in rest]))
    found = _similar_links(one.select(F.col("node").alias("key"), *rest), sets.select("place", "hashes"), similarity)
    named = sets.select("doc_id", "key").join(one.select("key", "node"), "key").select("doc_id", F.col("node").alias("key"))
    classes = _classes(written(named), found)
    kept = classes.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id").distinct()
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).cast("long").alias("id"))
    # The ids are the smaller side at every size: hashed by partition, so that no text is sorted.
    return rows.join(kept.hint("shuffle_hash"), rows["id"].eqNullSafe(kept["doc_id"]), "left_semi").select("row.*")
