"""What a reviewer found cut short: each operator over the whole of its job, against brute force."""

import numpy as np
import pyarrow.parquet as pq

import public_tokenizers
from tokenizers import Tokenizer

from spoor.llm import bpe, chat, mixing, queries, secretscan, sharding, simhash, topk

SMALL = "/root/testdata/sf0.001"


def plain_spans(text):
    from tests.llm.test_training_operators import plain_spans as plain

    return plain(text)


def digest(spans):
    from tests.llm.test_training_operators import digest as plain

    return plain(spans)


def least_of_similar(texts, similarity=0.8):
    """The least id of each component of texts whose sets of five-word shingles are as similar, by comparing all pairs."""
    sets = {}
    for d, t in texts.items():
        words = (t or "").lower().split()
        sets[d] = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}
    root = {d: d for d in texts}
    for a in sorted(texts):
        for b in sorted(texts):
            if a < b and root[a] != root[b] and len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b]):
                low, high = sorted((root[a], root[b]))
                root = {d: low if r == high else r for d, r in root.items()}
    return set(root.values())


def kept_of(spark, texts):
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    return [r["doc_id"] for r in simhash.drop_near_duplicates(docs).collect()]


# --- near-duplicates


def test_only_similar_documents_are_dropped(spark):
    rng = np.random.default_rng(11)
    fresh = lambda n: ["".join(rng.choice(list("abcdefgh"), 7)) for _ in range(n)]
    texts, passage = [], fresh(200)
    for own in (10, 20, 30, 45, 60, 90, 120):  # pairs from 0.9 down to 0.45 that share a passage, and one long passage that forty share
        for _ in range(8):
            base = fresh(200)
            texts += [" ".join(base + fresh(own)), " ".join(base + fresh(own))]
    texts += [" ".join(passage + fresh(80)) for _ in range(40)]
    for n in range(1, 9):  # short ones, with a copy each, and one that has a word more
        for _ in range(4):
            base = fresh(n)
            texts += [" ".join(base), " ".join(base).upper(), " ".join(base + fresh(1))]
    texts += ["", None, "  "]
    texts = dict(enumerate(texts))
    assert sorted(kept_of(spark, texts)) == sorted(least_of_similar(texts))


def test_crowds_of_documents_that_share_much(spark):
    """Some hundred that share a passage and stay below 0.8 of each other, and among them some that don't: each link counts."""
    rng = np.random.default_rng(12)
    fresh = lambda n: ["".join(rng.choice(list("abcdefgh"), 7)) for _ in range(n)]
    passage, texts = fresh(300), []
    for k in range(240):
        own = fresh(40)
        texts.append(" ".join(passage + own))
        if k % 12 == 0:
            texts.append(" ".join(passage[:295] + own))
    texts = dict(enumerate(texts))
    assert sorted(kept_of(spark, texts)) == sorted(least_of_similar(texts))
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    sets = simhash.shingle_sets(docs).toArrow().select(["place", "fp", "fp2", "n", "hashes"]).to_pylist()
    words = spark.createDataFrame([(r["place"], r["fp"], r["fp2"], r["n"], r["place"]) for r in sets], "key long, fp long, fp2 long, n long, root long")
    found = simhash.candidates(words).collect()
    assert len(found) <= (simhash.SPARSE + 2) * len(texts) and any(r["block"] is not None for r in found)


def test_only_similar_documents_of_the_table_are_dropped(spark):
    t = pq.read_table(f"{SMALL}/documents.parquet")
    texts = dict(zip(t["doc_id"].to_pylist(), t["text"].to_pylist(), strict=True))
    assert sorted(kept_of(spark, texts)) == sorted(least_of_similar(texts))


# --- secrets


def test_keys_beside_names_paths_prefixes_and_base_spans_are_found(spark):
    bare, slashed = "PvmW0QdpaJD6oCzfV1NIuk8Io5yaGKbXJD2aSJd7", "V6+o9jl8zSOwW/rXL+iuItEnuj+hlrWB8gpj7kts"
    dashed, small = "EZDdKzunX7ukI7UeWaF3iA7H50VFEsMJe-L8GfG_", "211hvu2o31k2dk845agi0dnacp4wz3nm"
    access = "AKIA" + "Q7ZK2M9XW4PLR6TB"
    texts = {
        f"AccountKey={slashed}==;next": slashed + "==", f"https://x.org/q?sig={bare}&a=b": bare, f"AWS_KEY={slashed} end": slashed, f"é😀 com/api-v1/{bare} end": bare, f"com/api-v1/{dashed}": dashed,
        f"key-{small}": small, f"{access}/{bare} end": bare, f"id_{small}/{bare}": bare, f"my-long_name=other/{bare}": bare,
    }
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    cleaned = {r["doc_id"]: r["text"] for r in secretscan.redact(docs).collect()}
    for r in secretscan.scan(docs).collect():
        text = list(texts)[r["doc_id"]]
        spans = [x.split(":") for x in r["spans"].split(",")]
        assert any(text[int(a) : int(b)].endswith(texts[text]) for kind, a, b in spans if kind == "random"), text
        places = sorted((int(a), int(b)) for _, a, b in spans)
        assert all(b <= c for (_, b), (c, _) in zip(places, places[1:])), text
        assert texts[text] not in cleaned[r["doc_id"]]
    assert cleaned[3].startswith("é😀 com/api-") and cleaned[3].endswith(" end") and small not in cleaned[7]


def test_long_texts_are_cut_where_no_secret_stands(spark):
    rng = np.random.default_rng(4)
    alphabet = list("ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnpqrstuvwxyz0123456789")
    key = lambda n: "".join(rng.choice(alphabet, n))
    some = ["password = ", "token:  'abcdef1", "é", "😀 ", "word ", "and ", "\n", "AKIA" + "Q7ZK2M9XW4PLR6TB" * 2, "0123456789abcdef" * 3, "api_key", " : ", '"secret"', "=", " ", "a-b_c/d+e", "."]
    texts = ["".join(rng.choice(some, 20_000)), "".join(s for _ in range(800) for s in (key(40), ", ", "x" * int(rng.integers(1, 30)), " ")), "token=abcdef:" * 3000, key(30_000), "password  =  " + "k" * 9000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r for r in secretscan.scan(docs).collect()}
    cleaned = {r["doc_id"]: r["text"] for r in secretscan.redact(docs).collect()}
    names = ["assign", "access", "hex", "random"]
    for k, text in enumerate(texts):
        assert found[k]["base_sha256"] == digest(plain_spans(text)), k
        spans = sorted((int(a), names.index(kind), int(b)) for kind, a, b in (x.split(":") for x in found[k]["spans"].split(",") if x))
        assert found[k]["spans"] == ",".join(f"{names[r]}:{a}:{b}" for a, r, b in spans)
        out, at = [], 0
        for a, _, b in spans:
            if a >= at:
                out += [text[at:a], secretscan.REDACTED]
            at = max(at, b)
        assert cleaned[k] == "".join(out) + text[at:]
    assert found[1]["spans"].count("random") > 700


# --- mixing


def test_small_sources_meet_their_targets(spark):
    rng = np.random.default_rng(7)
    rows, sizes = [], {f"a{n:03}": n for n in (1, 2, 10, 63, 64, 65, 100, 128, 199, 200)} | {"z": 20_000}
    for source, n in sizes.items():
        while n:
            size = min(n, int(rng.integers(1, 40)))
            rows.append((len(rows), "w " * size, source))
            n -= size
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    source_of, found = {d: s for d, _, s in rows}, {}
    for r in mixing.mix(docs).collect():
        assert 0 <= r["taken"] <= 3 * r["size"]
        x = found.setdefault(source_of[r["doc_id"]], [0, r["target"]])
        x[0] += r["taken"]
    assert all(taken == round(target) for taken, target in found.values())
    assert all(found[s][0] == 3 * n for s, n in sizes.items() if n <= 200)
    times = {r["doc_id"]: r["count"] for r in mixing.repeated(docs).groupBy("doc_id").count().collect()}
    assert all(times.get(d) == 3 for d, _, s in rows if s != "z")


# --- shards


def test_many_equal_rows_keep_to_the_limit(spark, tmp_path):
    rows = [(7, "x" * 100)] * 1000 + [(None, "y" * 100)] * 500 + [(k, "z" * 50) for k in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = sharding.assign(docs, 2_000).collect()
    sizes = {}
    for r in found:
        sizes[r["shard"]] = sizes.get(r["shard"], 0) + r["n_bytes"]
    assert len(found) == 1600 and max(sizes.values()) <= 2_000
    sharding.write_shards(docs, str(tmp_path / "s"), 2_000)
    wrote = spark.read.parquet(str(tmp_path / "s"))
    assert wrote.count() == 1600 and max(r["n"] for r in wrote.selectExpr("shard", "octet_length(text) as b").groupBy("shard").agg({"b": "sum"}).toDF("shard", "n").collect()) <= 2_000


# --- encoding


def test_a_word_of_any_length_is_encoded(spark):
    lib = Tokenizer.from_file(public_tokenizers.path(queries.VOCABULARY))
    own = bpe.Encoder(public_tokenizers.path(queries.VOCABULARY))
    rng = np.random.default_rng(3)
    for n in (1, 2, 3, 255, 256, 257, 70_000):
        word = "".join(rng.choice(list("etaoinshrdlu"), n))
        assert own.encode(word) == lib.encode(word, add_special_tokens=False).ids


# --- near-duplicates


def test_only_sets_that_are_compared_are_shuffled(spark):
    places = [0, 1, 63, 64, (3 << 33) + 62, (3 << 33) + 63, (5 << 33) + 4097]
    sets = spark.createDataFrame([(p + d, bytes([d])) for p in places for d in (0, 200)], "place long, hashes binary")
    wanted = spark.createDataFrame([(p,) for p in (*places[1:], 63, 7 << 33)], "a long")
    found = simhash._among(sets, wanted)
    assert sorted(r["place"] for r in found.collect()) == places[1:] and found.columns == sets.columns
    assert simhash._among(sets, wanted.limit(0)).count() == 0


# --- chat


def test_a_long_conversation_comes_in_pieces(spark):
    rows = [(1, k, "assistant" if k % 2 else "user", f"<|end|> {k} " + "é" * 50) for k in range(200)] + [(2, 0, "user", "x" * 5000), (2, 1, "assistant", None), (None, 0, "user", "a"), (3, 0, None, None)]
    df = spark.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn long, role string, text string, start string")
    whole, parted = chat.format_conversations(df), chat.format_conversations(df, piece=500)
    assert whole.count() == 4 and parted.where("conv_id = 1").count() > 10
    assert sorted(map(tuple, chat.digests(whole).collect()), key=repr) == sorted(map(tuple, chat.digests(parted).collect()), key=repr)
    one = whole.where("conv_id = 1").first()
    pieces = sorted(map(tuple, parted.where("conv_id = 1").collect()), key=lambda r: r[1])
    assert "".join(r[2] for r in pieces) == one["formatted"] and [x for r in pieces for x in r[3]] == one["loss_spans"]


# --- search


def test_values_of_any_size_are_exact(spark):
    import math
    from fractions import Fraction

    rng = np.random.default_rng(2)
    vectors = [[float(x) for x in rng.normal(size=3) * 10.0 ** rng.choice([0, 0, 6, 9, 12, 200])] for _ in range(60)] + [[1e9, -1e9, 0.5], [1e9, -1e9, 0.5], [1.7e308, 0.0, 0.0]]
    found = {}
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")
    for groups in (1, 7):
        found = {}
        for r in topk.top_k(df, k=9, every=5, groups=groups).orderBy("query_id", "rank").collect():
            found.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        whole = [[math.floor(64 * Fraction(x)) for x in v] for v in vectors]
        for q in range(0, len(vectors), 5):
            want = sorted(((-sum(x * y for x, y in zip(whole[q], v, strict=True)), k) for k, v in enumerate(whole) if k != q))[:9]
            assert found[q] == [(k, min(2**63 - 1, max(-(2**63), -s))) for s, k in want]
