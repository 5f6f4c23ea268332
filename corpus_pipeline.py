"""A training corpus from raw documents, in five stages; each works on all that the stage before it kept.

Extra columns pass through, whatever their names, but for ``ids`` and ``n_tokens``, which the last stage replaces. An empty table
gives an empty one at every stage. Rows that repeat are rows of their own, but that near-duplicates share an id's fate.
"""

import public_tokenizers
from pyspark.sql import functions as F

from spoor.llm import bpe, langid, mixing, secretscan, simhash
from spoor.llm.common import table, written
from spoor.llm.queries import VOCABULARY


def language(spark, docs, sf_dir):
    """Documents whose leading language has half of the mixture at least; undetermined ones, null and blank texts with them, go."""
    return langid.keep_identified(docs)


def near_duplicates(spark, docs, sf_dir):
    """One document of each group of near-duplicates: the one of the least id. A null id stays only in a group without another."""
    return simhash.drop_near_duplicates(docs)


def secrets(spark, docs, sf_dir):
    """All documents, with what looks like a secret replaced; n_chars follows the text, and is null with it."""
    return secretscan.redact(docs).withColumn("n_chars", F.length("text").cast("long"))


def mixture(spark, docs, sf_dir):
    """Each document as often as the mix takes it, to the nearest whole number: never, once, twice or three times.

    A source's words are taken in whole turns and one part of a turn, so at most one document of it is cut, and rounding moves a
    source from its target by half of that document at most. A null source is a source of its own; a null text is never taken.
    """
    return mixing.repeated(docs)


def tokens(spark, docs, sf_dir):
    """The documents' tokens in place of their texts; of a null text none."""
    return bpe.encode(docs, public_tokenizers.path(VOCABULARY))


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("secrets", secrets), ("mixture", mixture), ("tokens", tokens)]
#: Statistical and iterative stages have no SQL; tests hold each against a plain version.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs)
    return docs
