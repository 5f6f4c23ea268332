"""Byte-pair encoding and decoding with the vocabulary file of a public tokenizer.

Each word is a doubly linked list of symbols; a priority queue holds the merge rank of every adjacent pair. The least
entry is taken, skipped if either symbol has changed since, and else merges its pair and queues the two new ones.
Decoding concatenates vocabulary strings.
"""

import hashlib
import json
import unicodedata
from collections.abc import Iterator
from functools import cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Distinct runs of text whose encoding a worker remembers: those met among the last this many or half of it.
REMEMBERED = 400_000
#: Documents whose ids are in a worker's memory at once.
SLICE = 128


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself where it prints, else the next free code point from 256 on."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    free = iter(range(0x100, 0x200))
    return [chr(b) if b in prints else chr(next(free)) for b in range(256)]


#: Separators that str.split() takes for white space and the tokenizer's pattern does not.
UNCOMMON = regex.compile(r"[\x1c-\x1f]")


class Encoder(dict):
    """Run of text without white space -> "id id ..."; a missing one is encoded when asked for.

    Half of what is remembered is held here, the other half in ``older``: once this one is full it takes the other's place, and
    what is met there moves here, so that frequent runs stay.
    """

    def __init__(self, path: str):
        spec = json.load(open(path, encoding="utf-8"))
        model = spec["model"]
        self.vocab, self.end = model["vocab"], model.get("end_of_word_suffix") or ""
        self.strings = {i: s for s, i in self.vocab.items()}
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        #: two adjacent ids as one number -> the rank of their merge and its id as one number
        self.merges = {self.vocab[x] << 20 | self.vocab[y]: rank << 20 | self.vocab[x + y] for rank, (x, y) in enumerate(pairs)}
        letters = byte_letters()
        self.inner = [self.vocab[x] for x in letters]
        self.last = [self.vocab[x + self.end] for x in letters]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings |= {i: s for s, i in self.special.items()}
        self.split_special = regex.compile("|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True))) if self.special else None
        self.word = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        #: by an id's digits: its string
        self.named = {str(i): s for i, s in self.strings.items()}
        self.older: dict[str, str] = {}

    def merged(self, word: str) -> list[int]:
        """The ids of one word's bytes after every merge, best rank first, leftmost among equals."""
        raw = word.encode("utf-8", "surrogatepass")
        ids = [self.inner[b] for b in raw[:-1]]
        ids.append(self.last[raw[-1]])
        n, get = len(ids), self.merges.get
        after, before = [*range(1, n + 1)], [*range(-1, n - 1)]
        # The merge that each symbol and the next one can make, 0 for none. A queue entry is one number: the merge, whose rank
        # leads, over as many bits as the word's places need.
        able = [get(x << 20 | y, 0) for x, y in zip(ids, ids[1:])]
        able.append(0)
        bits = n.bit_length()
        place = (1 << bits) - 1
        queue = [found << bits | i for i, found in enumerate(able) if found]
        heapify(queue)
        while queue:
            top = heappop(queue)
            i, found = top & place, top >> bits
            if able[i] != found:
                continue  # stale: one of the two symbols has merged meanwhile
            now = ids[i] = found & 0xFFFFF
            j = after[i]
            ids[j], able[j] = -1, 0
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if found := get(now << 20 | ids[k], 0):
                    heappush(queue, found << bits | i)
                able[i] = found
            else:
                able[i] = 0
            k = before[i]
            if k >= 0:
                if found := get(ids[k] << 20 | now, 0):
                    heappush(queue, found << bits | k)
                able[k] = found
        return [x for x in ids if x >= 0]

    def __missing__(self, run: str) -> str:
        made = self.older.get(run)
        if made is None:
            made = self.encoded(run)
        if len(run) < 64:
            if 2 * len(self) >= REMEMBERED:
                self.older = dict(self)
                self.clear()
            self[run] = made
        return made

    def encoded(self, run: str) -> str:
        if run in self.special:
            return str(self.special[run])
        pieces = self.word.findall(run)
        if len(pieces) == 1:
            return " ".join(map(str, self.merged(pieces[0])))
        # A piece is a run of its own, but where its text is a special token's, which can only be met as a run.
        return " ".join([" ".join(map(str, self.merged(p))) if p in self.special else self[p] for p in pieces])

    def decode(self, ids: list[int]) -> str:
        """The vocabulary strings of the ids, which this tokenizer's file leaves apart by a space."""
        strings = self.strings
        return " ".join([strings[i] for i in ids])

    def runs(self, text: str) -> list[str]:
        """Runs that no merge crosses: special tokens as written, else composed lower-case text between white space."""
        if self.split_special and "<" in text and self.split_special.search(text):
            out, at = [], 0
            for cut in self.split_special.finditer(text):
                out += [*self.runs(text[at : cut.start()]), cut.group()]
                at = cut.end()
            return out + self.runs(text[at:])
        if not text.isascii():
            # Small sigma is the same in every place here, as letters are lowered one by one.
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        text = text.lower()
        return self.word.findall(text) if UNCOMMON.search(text) else text.split()

    def encode(self, text: str | None) -> list[int]:
        return [int(i) for w in self.runs(text or "") for i in self[w].split()]


@cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without its text, plus ``ids`` array<int> and ``n_tokens``: whole texts, null as empty, rows as given.

    ``path`` is the vocabulary file, present on every executor. Columns of ``docs`` named ids or n_tokens are replaced.
    """
    rest = [c for c in docs.columns if c not in (text_col, "ids", "n_tokens")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                batch = whole.slice(at, SLICE)
                made = [np.array(own.encode(t.as_py()), np.int32) for t in batch.column(len(rest))]
                sizes = np.array([len(x) for x in made], np.int64)
                offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(made)))
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(rest)], ids, pa.array(sizes)], [*rest, "ids", "n_tokens"])

    schema = docs.select(*rest, F.array(F.lit(0)).alias("ids"), F.lit(0).cast("long").alias("n_tokens")).schema
    return docs.select(*rest, F.col(text_col).cast("string").alias("__text")).mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``encoded`` plus the concatenated vocabulary strings of its ids; null ids give null."""

    @F.pandas_udf("string")
    def run(ids):
        own = encoder(path)
        return ids.map(lambda x: None if x is None else own.decode(x))

    return encoded.withColumn(out_col, run(ids_col))


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, and SHA-256 of the ids and of the decoded text; one row for each row, null texts as empty.

    Null ids and repeated rows stay as they are; an empty table gives none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in batches:
            sizes, of_ids, of_text = [], [], []
            for text in batch.column(1):
                ids = " ".join(map(own.__getitem__, own.runs(text.as_py() or "")))
                made = ids.split()
                sizes.append(len(made))
                of_ids.append(hashlib.sha256(ids.encode()).hexdigest())
                of_text.append(hashlib.sha256(" ".join(map(own.named.__getitem__, made)).encode("utf-8", "surrogatepass")).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, f"doc_id {docs.schema[id_col].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string")
