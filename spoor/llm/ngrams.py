"""Language-model scores by an interpolated modified Kneser-Ney n-gram model that Spark counts.

A word is a 64-bit hash. Tasks count the n-grams of their texts and pack them by shard; a shard merges what it receives and
writes its n-grams as one sorted array of hashes with their counts, an Arrow file in the shared folder. It hands on, for the
level below, how many different words stand before each shorter n-gram, and what each context was followed by. Level by level
this makes all that the model needs. Workers that score map the files into memory and search them for the n-grams of many
texts at once, in the order of the hashes.

The model is never gathered: neither the driver nor a worker holds more than one shard's n-grams beside the mapped pages.
"""

import math
import os
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute
import pyarrow.fs
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spoor.llm.common import WORD, shared_dir, written

#: n of the longest n-grams.
ORDER = 2
#: Texts whose crc32 of the id leaves nought when divided by HELD_OUT are not learned from.
HELD_OUT = 10
#: Added to every count by the base score.
ADDED = 0.1
#: Bytes of text whose n-grams make a shard; bytes of text that are scored or counted at once; n-grams a task holds unsent.
SHARD, PIECE, HELD = 16 << 20, 2 << 20, 1 << 20
#: Words with more than this share of a shard's tokens are hot, and their followers go to all shards: fewer than HOT words.
HOT_SHARE, HOT = 4, 1 << 16
#: Discounts where a level has too few n-grams to tell, and how near they may come to nought and to the count.
DISCOUNTS, LEAST = (0.5, 1.0, 1.5), 0.1
#: Columns of a level's rows: adjusted count; as a context: followed how often, and by how many words of count 1, 2 and more.
VALUES = ("a", "total", "n1", "n2", "n3")
#: Fixed odd multipliers of the hash that joins words.
SPREAD, STIR = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def stirred(h: np.ndarray) -> np.ndarray:
    """All bits of 64-bit numbers mixed, one to one."""
    h = (h ^ (h >> np.uint64(30))) * STIR
    h = (h ^ (h >> np.uint64(27))) * SPREAD
    return h ^ (h >> np.uint64(31))


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """(a 64-bit number for each byte, the same for A-Z and a-z; whether a byte is a blank)."""
    numbers, blank = stirred(np.arange(1, 257, dtype=np.uint64) * SPREAD), np.zeros(256, bool)
    numbers[65:91] = numbers[97:123]
    blank[[32, *range(9, 14)]] = True
    return numbers, blank


BYTES, BLANK = _tables()
#: What stands for the start and the end of a text: numbers that a word has by chance only.
START, END = stirred(np.array([1, 2], np.uint64))


class Words:
    """Hashes of the words of many texts: each byte's number times a power of its place, summed over the word, and stirred."""

    def __init__(self):
        self.powers = self.inverse = np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        if n >= len(self.powers):
            size, back = max(n + 1, 1 << 16), np.uint64(pow(int(SPREAD), -1, 1 << 64))
            self.powers, self.inverse = (np.cumprod(np.concatenate([[np.uint64(1)], np.full(size, x, np.uint64)])) for x in (SPREAD, back))

    def _hashes(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of raw[start:end], which lie in order; worked through in runs of some PIECE bytes."""
        out, low = np.zeros(len(starts), np.uint64), 0
        while low < len(starts):
            base = int(starts[low])
            high = max(low + 1, int(np.searchsorted(ends, base + PIECE, "right")))
            size = int(ends[high - 1]) - base
            self._powers(size)
            sums = np.zeros(size + 1, np.uint64)
            np.cumsum(BYTES[raw[base : base + size]] * self.powers[:size], out=sums[1:])
            a, b = starts[low:high] - base, ends[low:high] - base
            out[low:high] = stirred((sums[b] - sums[a]) * self.inverse[a] + (b - a).astype(np.uint64))
            low = high
        return out

    def symbols(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, words and end of every text in turn, as hashes; each one's place in its text; where texts begin)."""
        offsets = np.frombuffer(texts.buffers()[1], np.int32 if pa.types.is_binary(texts.type) else np.int64)[texts.offset : texts.offset + len(texts) + 1]
        raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        offsets = offsets.astype(np.int64) - offsets[0]
        inside = ~BLANK[raw]
        cut = np.zeros(len(raw) + 1, bool)
        cut[offsets] = True
        starts = np.nonzero(inside & (np.concatenate([[True], ~inside[:-1]]) | cut[:-1]))[0] if len(raw) else np.zeros(0, np.int64)
        ends = np.nonzero(inside & (np.concatenate([~inside[1:], [True]]) | cut[1:]))[0] + 1 if len(raw) else np.zeros(0, np.int64)
        first = np.searchsorted(starts, offsets)  # words before each text
        begins = first + 2 * np.arange(len(texts) + 1)
        stream = np.empty(begins[-1], np.uint64)
        stream[begins[:-1]], stream[begins[1:] - 1] = START, END
        stream[np.arange(len(starts)) + 2 * np.repeat(np.arange(len(texts)), np.diff(first)) + 1] = self._hashes(raw, starts, ends)
        return stream, np.arange(len(stream)) - np.repeat(begins[:-1], np.diff(begins)), begins


def keys(grams: np.ndarray) -> np.ndarray:
    """One 64-bit hash for each row of word hashes; of a single word its own."""
    h = grams[:, 0].copy()
    for k in range(1, grams.shape[1]):
        h = (h ^ (h >> np.uint64(29))) * SPREAD + grams[:, k]
        h = (h ^ (h >> np.uint64(32))) * STIR
    return h


def runs(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order that sorts the hashes, where runs of equal ones begin in it)."""
    order = np.argsort(h)
    held = h[order]
    return order, np.nonzero(np.concatenate([[True], held[1:] != held[:-1]]))[0] if len(h) else np.zeros(0, np.int64)


def summed(grams: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys, grams, values) with equal rows added up, in the order of their keys."""
    h = keys(grams)
    order, starts = runs(h)
    first = order[starts]
    return h[first], grams[first], np.add.reduceat(values[order], starts, axis=0) if len(h) else values


def shards(grams: np.ndarray, n: int, hot: np.ndarray) -> np.ndarray:
    """Shard of each n-gram: all that follow a context lie together, unless the context ends in a hot word."""
    h = keys(grams[:, :-1]) if grams.shape[1] > 1 else grams[:, 0]
    if grams.shape[1] > 1 and len(hot):
        whole = hot[np.minimum(np.searchsorted(hot, grams[:, -2]), len(hot) - 1)] == grams[:, -2]
        h[whole] = keys(grams[whole])
    h = (h ^ (h >> np.uint64(31))) * SPREAD
    return ((h >> np.uint64(32)) % np.uint64(n)).astype(np.int64)


def packed(grams: np.ndarray, values: np.ndarray) -> bytes:
    """Rows as bytes: each column as the sorted list of what occurs in it, as differences, and places in that list."""
    parts = [np.array([*grams.shape, values.shape[1]], np.int64).tobytes()]
    for column in grams.T:
        known, place = np.unique(column, return_inverse=True)
        parts += [np.array([len(known)], np.int64).tobytes(), np.diff(known, prepend=np.uint64(0)).tobytes(), np.ascontiguousarray(place.astype(np.uint32).view(np.uint8).reshape(-1, 4).T).tobytes()]
    parts.append(np.ascontiguousarray(values.astype(np.int64).T.copy().view(np.uint8).reshape(-1, 8).T).tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def unpacked(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw, at = zstandard.ZstdDecompressor().decompress(blob), 24
    rows, width, kinds = np.frombuffer(raw, np.int64, 3).tolist()
    columns = []
    for _ in range(width):
        known = int(np.frombuffer(raw, np.int64, 1, at)[0])
        values = np.cumsum(np.frombuffer(raw, np.uint64, known, at + 8), dtype=np.uint64)
        at += 8 + 8 * known
        columns.append(values[np.frombuffer(raw, np.uint8, 4 * rows, at).reshape(4, -1).T.copy().view(np.uint32).ravel()])
        at += 4 * rows
    values = np.frombuffer(raw, np.uint8, 8 * rows * kinds, at).reshape(8, -1).T.copy().view(np.int64).reshape(kinds, rows).T
    return np.stack(columns, axis=1), values


def dealt(grams: np.ndarray, values: np.ndarray, n: int, hot: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """(shard, packed rows)."""
    shard = shards(grams, n, hot)
    room = np.uint64(max(n - 1, 1).bit_length())
    order = np.argsort((shard.astype(np.uint64) << (np.uint64(64) - room)) | (grams[:, 0] >> room))  # equal first words side by side
    shard, grams, values = shard[order], grams[order], values[order]
    edges = np.searchsorted(shard, np.arange(n + 1)) if n < len(shard) else np.concatenate([np.nonzero(np.diff(shard, prepend=-1))[0], [len(shard)]])
    for low, high in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        if low < high:
            yield int(shard[low]), packed(grams[low:high], values[low:high])


class Held:
    """N-grams of one length that a task counts before it gives them on."""

    def __init__(self, width: int):
        self.width, self.parts, self.size = width, [], 0

    def add(self, grams: np.ndarray) -> bool:
        """True once there are enough to give on."""
        self.parts.append(summed(grams, np.ones((len(grams), 1), np.int64))[1:])
        self.size += len(self.parts[-1][0])
        if self.size >= HELD:
            self.parts = [self.all()]
            self.size = len(self.parts[0][0])
        return self.size >= HELD // 2

    def all(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros((0, self.width), np.uint64), np.zeros((0, 1), np.int64)
        return summed(*(np.concatenate(x) for x in zip(*self.parts, strict=True)))[1:]

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        out = self.all()
        self.parts, self.size = [], 0
        return out


def pieces(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Runs of texts of PIECE bytes or one text."""
    sizes, start = np.cumsum([0, *pa.compute.binary_length(texts).to_pylist()]), 0
    while start < len(texts):
        end = max(start + 1, int(np.searchsorted(sizes, sizes[start] + PIECE, "right")) - 1)
        yield start, end
        start = end


def windows(stream: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """The n-grams of ``width`` words that end at the places ``at``."""
    return np.stack([stream[at - k] for k in reversed(range(width))], axis=1)


# --- files of the model


def plain_path(folder: str) -> str:
    return re.sub(r"^file:/+", "/", folder)


def save(path: str, columns: dict[str, np.ndarray]) -> None:
    """Write an Arrow file whose columns have the narrowest integers; a task run again writes the same and takes its place."""
    narrow = {name: c if c.dtype == np.uint64 else c.astype(np.min_scalar_type(int(c.max(initial=0)))) for name, c in columns.items()}
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in narrow.values()], list(narrow))
    fs, target = pa.fs.FileSystem.from_uri(path)
    fs.create_dir(os.path.dirname(target), recursive=True)
    own = f"{target}.{uuid.uuid4().hex}"
    with fs.open_output_stream(own) as out, pa.ipc.new_file(out, batch.schema) as file:
        file.write_batch(batch)
    fs.move(own, target)


class Shelf:
    """The files of one level, mapped when first asked for."""

    def __init__(self, folder: str):
        self.folder, self.fs, self.known = folder, None, {}

    def shard(self, number: int) -> dict[str, np.ndarray] | None:
        if number not in self.known:
            self.known[number] = self._mapped(f"{self.folder}/{number}")
        return self.known[number]

    def _mapped(self, path: str) -> dict[str, np.ndarray] | None:
        fs, target = pa.fs.FileSystem.from_uri(path)
        if fs.get_file_info(target).type != pa.fs.FileType.File:
            return None
        if isinstance(fs, pa.fs.LocalFileSystem):
            source = pa.memory_map(target)
        else:  # a store that can't be mapped: a copy without a name, which goes with the worker
            with tempfile.NamedTemporaryFile() as own, fs.open_input_stream(target) as stream:
                while part := stream.read(1 << 20):
                    own.write(part)
                own.flush()
                source = pa.memory_map(own.name)
        table = pa.ipc.open_file(source).read_all()
        return {name: table.column(name).chunk(0).to_numpy() for name in table.column_names} if table.num_rows else None

    def find(self, grams: np.ndarray, names: tuple[str, ...], n: int, hot: np.ndarray) -> list[np.ndarray]:
        """The named columns for each n-gram; nought where it isn't held."""
        h = keys(grams)
        order, starts = runs(h)
        first = order[starts]
        place = np.empty(len(h), np.int64)
        place[order] = np.repeat(np.arange(len(starts)), np.diff(starts, append=len(h)))
        h, shard, out = h[first], shards(grams[first], n, hot), [np.zeros(len(starts), np.int64) for _ in names]
        order = np.argsort(shard, kind="stable")
        for part in np.split(order, np.nonzero(np.diff(shard[order]))[0] + 1) if len(order) else []:
            if (held := self.shard(int(shard[part[0]]))) is not None:
                at = np.minimum(np.searchsorted(held["key"], h[part]), len(held["key"]) - 1)
                there = held["key"][at] == h[part]
                for column, name in zip(out, names, strict=True):
                    column[part[there]] = held[name][at[there]]
        return [column[place] for column in out]


# --- counting


PACKED = "level int, shard int, rows binary"


def _batch(made: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    columns = list(zip(*made, strict=True)) if made else [[], [], []]
    return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.binary())], ["level", "shard", "rows"])


def _counted(texts: DataFrame, taken: Callable[[np.ndarray, np.ndarray], dict[int, np.ndarray]], n: int, hot: np.ndarray) -> DataFrame:
    """Packed counts of the n-grams that ``taken`` picks from symbols and their places, by level."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, held = Words(), {}
        send = lambda level: _batch([(level, shard, blob) for shard, blob in dealt(*held[level].take(), n, hot)])
        for batch in batches:
            for low, high in pieces(batch.column(0)):
                stream, place, _ = words.symbols(batch.column(0).slice(low, high - low))
                for level, grams in taken(stream, place).items():
                    if len(grams) and held.setdefault(level, Held(grams.shape[1])).add(grams):
                        yield send(level)
        for level in held:
            yield send(level)

    return texts.mapInArrow(run, PACKED)


def _merged(group: pa.Table, kinds: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All rows of a shard added up, a few blobs at a time; a column that a sender left out is nought."""
    grams, values, h = None, None, None
    for part in group.column("rows").to_pylist():
        g, v = unpacked(part)
        v = np.pad(v, ((0, 0), (0, kinds - v.shape[1])))
        waiting = [(g, v)] if grams is None else [*waiting, (g, v)]
        if grams is None:
            grams, values = g[:0], v[:0]
        if sum(len(x[0]) for x in waiting) > max(HELD, len(grams)):
            h, grams, values = summed(np.concatenate([grams, *[x[0] for x in waiting]]), np.concatenate([values, *[x[1] for x in waiting]]))
            waiting = []
    return summed(np.concatenate([grams, *[x[0] for x in waiting]]), np.concatenate([values, *[x[1] for x in waiting]])) if waiting else (h, grams, values)


def _level(packed_rows: DataFrame, level: int, order: int, folder: str, n: int, hot: np.ndarray) -> DataFrame:
    """Write the shards of one level; gives the packed rows of the level below, and of level 1 an empty table."""
    kinds = 1 if level == order else len(VALUES)

    def run(group: pa.Table) -> pa.Table:
        h, grams, values = _merged(group, kinds)
        save(f"{folder}/{level}/{group.column('shard')[0].as_py()}", {"key": h, **dict(zip(VALUES[:kinds], values.T, strict=True))})
        made = []
        if level > 1:
            there = values[:, 0] > 0
            grams, a = grams[there], values[there, 0]
            before = np.zeros((len(grams), len(VALUES)), np.int64)
            before[:, 0] = 1
            after = np.stack([np.zeros(len(a), np.int64), a, a == 1, a == 2, a > 2], axis=1).astype(np.int64)
            # An n-gram that a text begins with has nothing before it: its own count stands, as it came from the texts.
            inner = grams[:, 1] != START
            _, below, sums = summed(np.concatenate([grams[inner, 1:], grams[:, :-1]]), np.concatenate([before[inner], after]))
            made = [(level - 1, shard, blob) for shard, blob in dealt(below, sums, n, hot)]
        return pa.Table.from_batches([_batch(made)])

    return packed_rows.groupBy("shard").applyInArrow(run, PACKED)


@dataclass
class Model:
    """Where the counts lie and the numbers that every worker needs: all of fixed size."""

    folder: str
    order: int
    shards: int
    hot: np.ndarray
    tokens: int = 0
    types: int = 0
    discounts: list[tuple[float, float, float]] = field(default_factory=list)
    #: Level 1 as the followers of the empty context: how many, and how many of count 1, 2 and more.
    empty: tuple[int, int, int, int] = (0, 0, 0, 0)

    def discounted(self, level: int, a: np.ndarray) -> np.ndarray:
        """Adjusted counts less their discount."""
        return a - np.concatenate([[0.0], self.discounts[level - 1]])[np.minimum(a, 3)]

    def left(self, level: int, counts: tuple) -> np.ndarray:
        """What the discounts take from a context's followers of count 1, 2 and more."""
        return sum(d * c for d, c in zip(self.discounts[level - 1], counts, strict=True))


def discounts(t: list[int]) -> tuple[float, float, float]:
    """Discounts of counts 1, 2 and from 3 on, from how many n-grams have the counts 1 to 4."""
    if min(t) == 0:
        return DISCOUNTS
    y = t[0] / (t[0] + 2 * t[1])
    return tuple(min(max(k - (k + 1) * y * t[k] / t[k - 1], LEAST), k - LEAST) for k in (1, 2, 3))


def _summary(spark: SparkSession, model: Model) -> None:
    """Counts of counts, read by Spark from the files of the shards, and the discounts that follow from them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.column(0).to_pylist():
                made = []
                for level in range(1, model.order + 1):
                    held = Shelf(f"{model.folder}/{level}").shard(shard)
                    a = held["a"] if held else np.zeros(0, np.int64)
                    made.append([level, *[int((a == k).sum()) for k in (1, 2, 3, 4)], int((a > 2).sum()), int(a.sum(dtype=np.int64))])
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*made, strict=True)], ["level", "t1", "t2", "t3", "t4", "more", "total"])

    names = ("t1", "t2", "t3", "t4", "more", "total")
    found = spark.range(model.shards).mapInArrow(run, "level long, t1 long, t2 long, t3 long, t4 long, more long, total long").groupBy("level").agg(*[F.sum(x).alias(x) for x in names])
    rows = {r["level"]: r for r in found.collect()}  # one a level
    model.discounts = [discounts([rows[k][f"t{c}"] for c in (1, 2, 3, 4)]) for k in range(1, model.order + 1)]
    model.empty = tuple(rows[1][x] for x in ("total", "t1", "t2", "more"))


def train(texts: DataFrame, order: int = ORDER, shard_bytes: int = SHARD) -> Model:
    """Count a table of one column of texts (bytes, not null).

    The driver receives one row a level, and the hot words: those of more than a quarter of a shard's tokens, fewer than HOT.
    A context's n-grams are merged in one task unless it ends in a hot word; then they part by all their words.
    """
    spark = texts.sparkSession
    size = texts.agg(F.sum(F.octet_length(texts.columns[0]))).first()[0] or 0
    n, folder, none = max(1, -(-size // shard_bytes)), f"{plain_path(shared_dir(spark))}/ngrams-{uuid.uuid4().hex}", np.zeros(0, np.uint64)
    share = min(HOT_SHARE * n, HOT)

    def words(group: pa.Table) -> pa.Table:
        h, _, values = _merged(group, 1)
        c = values[:, 0]
        save(f"{folder}/0/{group.column('shard')[0].as_py()}", {"key": h, "c": c})
        often = np.nonzero(c * share > c.sum())[0]
        made = [[int(c.sum())] + [0] * len(often), [len(c)] + [0] * len(often), [0, *h[often].view(np.int64).tolist()], [0, *c[often].tolist()]]
        return pa.table([pa.array(x, pa.int64()) for x in made], ["tokens", "types", "word", "often"])

    found = _counted(texts, lambda stream, place: {0: stream[place > 0][:, None]}, n, none).groupBy("shard").applyInArrow(words, "tokens long, types long, word long, often long")
    found = written(found)
    totals = found.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"), F.coalesce(F.sum("types"), F.lit(0)).alias("types")).first()
    hot = [r["word"] for r in found.where(F.col("often") * F.lit(share) > F.lit(totals["tokens"])).select("word").collect()]
    model = Model(folder, order, n, np.sort(np.array(hot, np.int64).view(np.uint64)), totals["tokens"], totals["types"])

    def taken(stream: np.ndarray, place: np.ndarray) -> dict[int, np.ndarray]:
        begun = {k: windows(stream, np.nonzero(place == k - 1)[0], k) for k in range(2, order)}
        return {order: windows(stream, np.nonzero(place >= max(order - 1, 1))[0], order), **begun}

    counted = _counted(texts, taken, n, model.hot)
    if order > 2:  # levels between read it again
        counted = written(counted)
    rows = counted.where(F.col("level") == order)
    for level in range(order, 0, -1):
        below = _level(rows, level, order, folder, n, model.hot)
        rows = below.unionAll(counted.where(F.col("level") == level - 1)) if 2 <= level - 1 < order else below
    rows.count()
    _summary(spark, model)
    return model


# --- scoring


def held_out(id_col: str) -> Column:
    """True where crc32 of the id as text leaves nought when divided by HELD_OUT; a null id counts as empty text, so it is held out."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(HELD_OUT)) == 0


class Scorer:
    """Chances of the words of many texts at once, from the mapped files."""

    def __init__(self, model: Model):
        self.model, self.words = model, Shelf(f"{model.folder}/0")
        self.levels = [Shelf(f"{model.folder}/{k}") for k in range(1, model.order + 1)]

    def chances(self, stream: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(count, chance given up to order - 1 symbols before it) of every symbol but the starts; words are looked up once each."""
        m, at = self.model, np.nonzero(place > 0)[0]
        words, which = np.unique(stream, return_inverse=True)
        (c,) = self.words.find(words[:, None], ("c",), m.shards, np.zeros(0, np.uint64))
        names = VALUES if m.order > 1 else VALUES[:1]
        a, *follow = self.levels[0].find(words[:, None], names, m.shards, m.hot)
        p = np.full(len(words), 1 / (m.types + 1))
        if m.empty[0]:
            p = m.discounted(1, a) / m.empty[0] + m.left(1, m.empty[1:]) / m.empty[0] * p
        p = p[which[at]]
        for level in range(2, m.order + 1):
            long = np.nonzero(place[at] >= level - 1)[0]
            grams = windows(stream, at[long], level)
            if level == 2:
                total, left = (x[which[at[long] - 1]] for x in (follow[0], m.left(2, tuple(follow[1:]))))
            else:
                total, *after = self.levels[level - 2].find(grams[:, :-1], VALUES[1:], m.shards, m.hot)
                left = m.left(level, tuple(after))
            (a,) = self.levels[level - 1].find(grams, ("a",), m.shards, m.hot)
            known = total > 0
            p[long[known]] = (m.discounted(level, a[known]) + left[known] * p[long[known]]) / total[known]
        return c[which[at]], p


SCORED = "n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double"


def score(docs: DataFrame, order: int = ORDER, id_col: str = "doc_id", text_col: str = "text", shard_bytes: int = SHARD) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score and perplexity of every row.

    ``score`` is log10 of the chance that the model gives the text, ``perplexity`` what it comes to for a token. A null text
    counts as empty: one token, its end. A null id is held out. Repeated rows come back as often, and each is learned from.
    Without rows to learn from every token has the same chance; an empty table gives no rows. Other columns are not read.

    Words are told apart by 64-bit hashes, and so are n-grams: two words of a thousand million share one at odds of 1 to 36.
    A text is scored as a whole, so a worker's memory goes with the longest text beside PIECE.
    """
    read = docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), F.coalesce(F.col(text_col).cast("binary"), F.lit("").cast("binary")).alias("text"))
    model = train(read.where("not held_out").select("text"), order, shard_bytes)
    base = model.tokens + ADDED * (model.types + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, scorer = Words(), Scorer(model)
        for batch in batches:
            for low, high in pieces(batch.column(2)):
                stream, place, begins = words.symbols(batch.column(2).slice(low, high - low))
                c, p = scorer.chances(stream, place)
                plain, logs = np.log10((c + ADDED) / base), np.log10(p)
                ends = begins - np.arange(len(begins))
                lengths = np.diff(ends)
                known = np.add.reduceat(c > 0, ends[:-1], dtype=np.int64)
                both = [[math.fsum(x[a:b].tolist()) for a, b in zip(ends[:-1], ends[1:], strict=True)] for x in (plain, logs)]
                perplexity = 10 ** (-np.array(both[1]) / lengths)
                own = batch.slice(low, high - low)
                yield pa.RecordBatch.from_arrays(
                    [own.column(0), own.column(1), pa.array(lengths), pa.array(known), pa.array([model.tokens] * (high - low), pa.int64()), *[pa.array(x, pa.float64()) for x in (*both, perplexity)]],
                    ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"],
                )

    kept = {f.name: f.dataType.simpleString() for f in read.schema}
    return read.mapInArrow(run, f"doc_id {kept['doc_id']}, held_out boolean, {SCORED}")


def oracle(every: int = HELD_OUT, added: float = ADDED) -> str:
    """DuckDB SQL of :func:`score` for pairs of words, from the model's formulas alone. DuckDB has no crc32: ``held`` works it out."""
    crc = "list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, len(x) + 1), lambda i: CAST(ascii(x[i]) AS BIGINT))), lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda v, i: xor(v >> 1, 3988292384 * (v & 1))))"
    discount = lambda k: f"CASE WHEN least(t1, t2, t3, t4) = 0 THEN {DISCOUNTS[k - 1]} ELSE least(greatest({k} - {k + 1} * (t1 / (t1 + 2 * t2)) * t{k + 1} / t{k}, {LEAST}), {k - LEAST}) END AS d{k}"
    counted = lambda table: f"SELECT {', '.join(f'count(*) FILTER (a = {k}) AS t{k}' for k in (1, 2, 3, 4))}, count(*) FILTER (a > 2) AS more, CAST(sum(a) AS DOUBLE) AS total FROM {table}"
    less = lambda table: f"(CASE {table}.a WHEN 1 THEN d1 WHEN 2 THEN d2 ELSE d3 END)"
    return f"""
WITH i AS (SELECT row_number() OVER () AS r, doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text, coalesce(CAST(doc_id AS VARCHAR), '') AS x FROM documents),
h AS MATERIALIZED (SELECT r, doc_id, text, xor({crc}, 4294967295) % {every} = 0 AS held_out FROM i),
s AS (SELECT r, held_out, list_concat([' '], regexp_extract_all(text, '{WORD}'), [chr(10)]) AS w FROM h),
g AS MATERIALIZED (SELECT r, held_out, unnest(w[1:len(w) - 1]) AS v, unnest(w[2:]) AS w FROM s),
u AS MATERIALIZED (SELECT w, count(*) AS c FROM g WHERE NOT held_out GROUP BY w),
n AS (SELECT CAST(coalesce(sum(c), 0) AS BIGINT) AS n, count(*) AS types FROM u),
b2 AS MATERIALIZED (SELECT v, w, count(*) AS a FROM g WHERE NOT held_out GROUP BY v, w),
b1 AS MATERIALIZED (SELECT w, count(*) AS a FROM b2 GROUP BY w),
k2 AS (SELECT {', '.join(discount(k) for k in (1, 2, 3))} FROM ({counted('b2')}) AS x),
k1 AS (SELECT *, {', '.join(discount(k) for k in (1, 2, 3))} FROM ({counted('b1')}) AS x),
p1 AS MATERIALIZED (SELECT b1.w, (b1.a - {less('b1')}) / total AS p FROM b1, k1),
e AS (SELECT coalesce((d1 * t1 + d2 * t2 + d3 * more) / total, 1) / (types + 1) AS p FROM k1, n),
x2 AS MATERIALIZED (SELECT v, CAST(sum(a) AS DOUBLE) AS total, sum(CASE a WHEN 1 THEN d1 WHEN 2 THEN d2 ELSE d3 END) AS taken FROM b2, k2 GROUP BY v),
p2 AS MATERIALIZED (SELECT b2.v, b2.w, b2.a - {less('b2')} AS a FROM b2, k2),
o AS (SELECT g.r, coalesce(u.c, 0) AS c, coalesce(p1.p, 0) + e.p AS p, coalesce(p2.a, 0) AS a, x2.total, x2.taken
  FROM g CROSS JOIN e LEFT JOIN u ON u.w = g.w LEFT JOIN p1 ON p1.w = g.w LEFT JOIN x2 ON x2.v = g.v LEFT JOIN p2 ON p2.v = g.v AND p2.w = g.w),
t AS (SELECT r, count(*) AS n_tokens, count(*) FILTER (c > 0) AS n_known, sum(log10((c + {added}) / (n.n + {added} * (types + 1)))) AS base_score,
  sum(log10(CASE WHEN total IS NULL THEN p ELSE (a + taken * p) / total END)) AS score FROM o, n GROUP BY r)
SELECT doc_id, held_out, n_tokens, n_known, n.n AS train_tokens, base_score, score, pow(10, -score / n_tokens) AS perplexity FROM h JOIN t USING (r), n"""
