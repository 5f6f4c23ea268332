"""Language identification as multilingual mixture inference.

A document's character n-grams are taken for draws from a mixture of languages. Expectation-maximisation estimates the
proportions; languages enter the mixture one at a time for as long as the penalised likelihood grows. The prediction
is the language of the largest proportion, and that proportion is its score.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spoor.llm.common import written

#: n of the n-grams, and the buckets that they are hashed to: with the number of languages this bounds the model.
ORDER, BUCKETS = 3, 1 << 14
#: Added to every count; the penalty for one more language, in log-likelihood for each log of the document's n-grams.
SMOOTHING, PENALTY = 0.5, 2.0
#: Languages that a model may have; with ORDER and BUCKETS this bounds what the driver and each worker hold.
MOST_LANGS = 512
#: Languages whose counts a task holds between two batches before it gives them on.
HELD_LANGS = 64
#: Rounds of expectation-maximisation for each candidate set.
ROUNDS = 12
UNDETERMINED = "und"


def grams(text: str) -> np.ndarray:
    """Bucket of every character n-gram of the lower-case text, blanks collapsed and one at either end."""
    points = np.frombuffer(f" {' '.join(text.lower().split())} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    mixed = np.zeros(max(0, len(points) - ORDER + 1), np.uint32)
    for k in range(ORDER):
        mixed = (mixed + points[k : len(points) - ORDER + 1 + k]) * np.uint32(0x9E3779B1)
        mixed ^= mixed >> np.uint32(15)
    return mixed & np.uint32(BUCKETS - 1)


def gram_counts(rows: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    """(lang, bucket, n) over all rows: each task adds up its own table, Spark adds up the tasks'."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: dict[str, np.ndarray] = {}

        def added_up() -> Iterator[pa.RecordBatch]:
            for lang, own in tables.items():
                at = np.nonzero(own)[0]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(own[at], pa.int64())], ["lang", "bucket", "n"])
            tables.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = tables.setdefault(lang, np.zeros(BUCKETS, np.int64))
                found = grams(text.as_py())
                if len(found) < BUCKETS // 8:
                    np.add.at(own, found, 1)
                else:
                    own += np.bincount(found, minlength=BUCKETS)
            if len(tables) > HELD_LANGS:
                yield from added_up()
        yield from added_up()

    rows = rows.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")).where("lang is not null and text is not null")
    return rows.mapInArrow(run, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


@dataclass
class Model:
    langs: list[str]
    #: by bucket and language
    chance: np.ndarray

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.langs or not text or not any(map(str.isalpha, text)):
            return UNDETERMINED, 0.0
        bucket, n = np.unique(grams(text), return_counts=True)
        if not len(bucket):
            return UNDETERMINED, 0.0
        chance = self.chance[bucket]
        best = int(np.argmax(n @ np.log(chance)))
        chosen, share, mixed = [best], np.ones(1), chance[:, best]
        fit, price = n @ np.log(mixed), PENALTY * np.log(n.sum() + 1)
        while len(chosen) < len(self.langs):
            # The likelihood is concave: a language whose slope at proportion nought is not above the total can't gain.
            slope = (n / mixed) @ chance - n.sum()
            top = None
            for k in np.nonzero(slope > 1e-9)[0]:
                if int(k) in chosen:
                    continue
                found, now, its = mixture(chance[:, [*chosen, k]], n, np.append(share * 0.9, 0.1))
                if now - price > (top[0] if top else fit):
                    top = now - price, found, int(k), its, now
            if top is None:
                break
            # From the next round on, the fit counts without the price that was paid.
            _, share, k, mixed, fit = top
            chosen.append(k)
        at = int(np.argmax(share))
        return self.langs[chosen[at]], float(min(1.0, max(0.0, share[at])))


def mixture(chance: np.ndarray, n: np.ndarray, share: np.ndarray) -> tuple[np.ndarray, float, np.ndarray]:
    """Proportions after expectation-maximisation, their log-likelihood and the mixed chance of each n-gram."""
    total, mixed = n.sum(), chance @ share
    for _ in range(ROUNDS):
        share = share * ((n / mixed) @ chance) / total
        mixed = chance @ share
    return share, float(n @ np.log(mixed)), mixed


def train(rows: DataFrame, lang_col: str = "lang", text_col: str = "text") -> Model:
    """Learn from every row whose language and text are not null; no such row gives a model that predicts nothing.

    The driver receives one number for each language and bucket that occurs: MOST_LANGS x BUCKETS at most.
    """
    counted = written(gram_counts(rows, lang_col, text_col))
    if len(names := counted.select("lang").distinct().limit(MOST_LANGS + 1).collect()) > MOST_LANGS:
        raise ValueError(f"more than {MOST_LANGS} languages to learn: clean the column first")
    langs, found = sorted(r["lang"] for r in names), counted.toArrow()
    counts = np.full((BUCKETS, len(langs)), SMOOTHING)
    place = {x: k for k, x in enumerate(langs)}
    np.add.at(counts, (found["bucket"].to_numpy(), np.array([place[x] for x in found["lang"].to_pylist()], int)), found["n"].to_numpy())
    return Model(langs, counts / counts.sum(axis=0))


def predict(rows: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``rows`` without the text, plus lang_pred and score. No letter, or a null text: ``und`` with score 0.

    Columns of ``rows`` by those two names are replaced.
    """
    rest = [c for c in rows.columns if c not in (text_col, "lang_pred", "score")]
    shared = rows.sparkSession.sparkContext.broadcast(model)  # bounded by languages x buckets

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            made = [own.predict(t.as_py()) for t in batch.column(len(rest))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(rest)], pa.array([x[0] for x in made], pa.string()), pa.array([x[1] for x in made], pa.float64())], [*rest, "lang_pred", "score"])

    schema = rows.select(*rest, F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema
    return rows.select(*rest, F.col(text_col).cast("string").alias("__text")).mapInArrow(run, schema)


def fold(id_col: str = "doc_id") -> Column:
    """True where crc32 of the id as text leaves 1 when divided by 3: never learned from. A null id is learned from."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row, learned from the rows that are not held out.

    A null id is not held out. Repeated rows come back as often, and each is learned from. A table without rows gives none;
    one without rows to learn from gives ``und`` throughout. A text that is null or has no letter is ``und`` with score 0.
    More than MOST_LANGS distinct values of ``lang`` are an error, for a model of them would have no bound.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).withColumn("held_out", fold("doc_id"))
    return predict(docs.drop("lang"), train(docs.where("not held_out"), "lang", "text"))


def keep_identified(docs: DataFrame, least: float = 0.5, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows whose leading language has at least the proportion ``least``; undetermined ones go. All columns stay."""
    learned = train(docs.where(~fold(id_col)), lang_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(learned)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            made = [own.predict(t.as_py()) for t in batch.column(batch.schema.get_field_index(text_col))]
            yield batch.filter(pa.array([lang != UNDETERMINED and score >= least for lang, score in made], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
