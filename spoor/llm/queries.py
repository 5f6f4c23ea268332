"""The registered queries of this subpackage, over the whole of their tables, and their DuckDB SQL where there is any."""

import public_tokenizers

from spoor.llm import audit, bpe, centroids, chat, langid, mixing, ngrams, quality, secretscan, sharding, simhash, topk, urlfilter
from spoor.llm.common import table
from spoor.sources.tables import spread

#: The vocabulary file of the encoding query.
VOCABULARY = "word_bpe_49k.json"


def _documents(spark, sf_dir):
    """The documents, dealt over all cores where one small file holds them; native operators read them as they are."""
    return spread(table(spark, sf_dir, "documents"))


def op1_simhash(spark, sf_dir):
    return simhash.near_duplicates(_documents(spark, sf_dir))


def op2_bpe(spark, sf_dir):
    return bpe.digests(_documents(spark, sf_dir), public_tokenizers.path(VOCABULARY))


def op3_language(spark, sf_dir):
    return langid.identify(_documents(spark, sf_dir))


def op4_url_filter(spark, sf_dir):
    return urlfilter.judge(table(spark, sf_dir, "pages"))


def op5_sharding(spark, sf_dir):
    return sharding.assign(table(spark, sf_dir, "documents"))


def op6_chat(spark, sf_dir):
    return chat.digests(chat.format_conversations(chat.with_probe(table(spark, sf_dir, "conversations"))))


def op7_mixing(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"))


def op8_top_k(spark, sf_dir):
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op9_quality(spark, sf_dir):
    judged = quality.judge(_documents(spark, sf_dir), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op10_secrets(spark, sf_dir):
    return secretscan.scan(table(spark, sf_dir, "documents"))


def op11_centroids(spark, sf_dir):
    return centroids.cluster(spread(table(spark, sf_dir, "embeddings")))


def op12_audit(spark, sf_dir):
    return audit.audit(_documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op13_language_model(spark, sf_dir):
    return ngrams.score(_documents(spark, sf_dir))


QUERIES = {
    f.__name__: f
    for f in (op1_simhash, op2_bpe, op3_language, op4_url_filter, op5_sharding, op6_chat, op7_mixing, op8_top_k, op9_quality, op10_secrets, op11_centroids, op12_audit, op13_language_model)
}
ORACLES = {
    "op4_url_filter": urlfilter.oracle(), "op5_sharding": sharding.oracle(), "op6_chat": chat.oracle(), "op7_mixing": mixing.oracle(), "op8_top_k": topk.oracle(),
    "op11_centroids": centroids.oracle(), "op12_audit": audit.oracle(), "op13_language_model": ngrams.oracle(),
}
