"""The pipeline stage by stage: each against a plain version, on given tables and on odd ones."""

import public_tokenizers
import pyarrow.parquet as pq
from pyspark.sql import functions as F

import corpus_pipeline
from spoor.llm import bpe, mixing
from spoor.llm.queries import VOCABULARY
from tests.llm.test_training_operators import plain_spans
from tests.llm.test_whole_job import least_of_similar

FOLDER = "/root/testdata/sf0.001"


def test_stages_hold(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    names, kept = docs.columns, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        docs = corpus_pipeline.written(stage(spark, docs, FOLDER))
        kept[name] = {r["doc_id"]: r for r in docs.collect()} if name != "mixture" else docs.collect()
        if k < 4:
            assert docs.columns == names
        if name == "near_duplicates":
            assert set(kept[name]) == least_of_similar({d: r["text"] for d, r in kept["language"].items()})
        if name == "secrets":
            assert set(kept[name]) == set(kept["near_duplicates"])
            for d, r in kept[name].items():
                assert not plain_spans(r["text"]) and r["n_chars"] == len(r["text"])
        if name == "mixture":
            want = {r["doc_id"]: int(r["taken"] / max(r["size"], 1) + 0.5) for r in mixing.mix(before).collect()}
            found = {r["doc_id"]: r["count"] for r in docs.groupBy("doc_id").count().collect()}
            assert found == {d: n for d, n in want.items() if n}
        if name == "tokens":
            own = bpe.encoder(public_tokenizers.path(VOCABULARY))
            texts = {r["doc_id"]: r["text"] for r in kept["mixture"]}
            assert "text" not in docs.columns and all(list(r["ids"]) == own.encode(texts[d]) for d, r in kept[name].items())
    total = pq.read_table(f"{FOLDER}/documents.parquet").num_rows
    assert len(kept["language"]) >= 0.98 * total


def test_odd_documents_pass_through(spark, odd, none):
    for table in (odd, none):
        docs = table.select("doc_id", "text", "lang", "source", "n_chars", F.lit(1).alias("size"))
        for _, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.written(stage(spark, docs, FOLDER))
        assert docs.count() <= 3 * table.count()


def test_run_returns_the_last_stage(spark):
    found = corpus_pipeline.run(spark, FOLDER)
    assert {"doc_id", "ids", "n_tokens"} <= set(found.columns) and found.count() > 0
