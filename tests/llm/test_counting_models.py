"""Centroids, the filter audit and the n-gram model against SQL and plain versions, and on odd rows."""

import math
import zlib
from collections import Counter, defaultdict
from hashlib import sha256
from itertools import permutations

import numpy as np
import oracle
import pyarrow as pa
import pytest

from spoor.llm import audit, centroids, ngrams, queries

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op11_centroids", "op12_audit", "op13_language_model"])
def test_same_rows_as_sql(spark, name):
    assert oracle.rows_of_spark(queries.QUERIES[name](spark, SMALL)) == oracle.rows_of_sql(oracle.connect(SMALL), queries.ORACLES[name])


# --- centroids


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, j int, d string")


def plain_clusters(rows, k=8, rounds=10):
    """[(vec_id, cluster, distance)] in Python's integers."""
    kept = [(i, [1024 * int(x) if abs(x) >= 2**53 else math.floor(1024 * x) for x in v], v) for i, v, *_ in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    centres = [q for _, q, _ in sorted(kept, key=lambda r: (sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[2]))[:k]]
    apart = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    nearest = lambda q: min((apart(q, c), j) for j, c in enumerate(centres))
    for _ in range(rounds):
        own = defaultdict(list)
        for _, q, _ in kept:
            own[nearest(q)[1]].append(q)
        centres = [[sum(x) // len(own[j]) for x in zip(*own[j], strict=True)] if own[j] else c for j, c in enumerate(centres)]
    return sorted(((i, nearest(q)[1], min(2**63 - 1, nearest(q)[0])) for i, q, _ in kept), key=repr)


def found_clusters(df):
    return sorted(((r["vec_id"], r["cluster"], r["distance"]) for r in df.collect()), key=repr)


def test_clusters_of_odd_vectors(spark):
    rng = np.random.default_rng(5)
    rows = [(int(i), (rng.normal(size=64) * 3).tolist(), 1, "x") for i in range(60)]
    rows += [(100 + i, [float(i % 3)] * 64, 1, "x") for i in range(12)]  # ties and equal vectors
    rows += [(7, rows[7][1], 1, "x"), (7, [0.5] * 64, 1, "x"), (None, [0.25] * 64, 1, "x"), (None, None, None, None), (200, None, 1, "x"), (201, [1.0] * 63, 1, "x"), (202, [1.0] * 65, 1, "x"), (203, [], 1, "x")]
    rows += [(204, [1.0] * 63 + [None], 1, "x"), (205, [float("nan")] + [1.0] * 63, 1, "x"), (206, [float("inf")] + [1.0] * 63, 1, "x"), (207, [-1e-9] * 64, 1, "x")]
    assert found_clusters(centroids.cluster(vectors(spark, rows))) == plain_clusters(rows)


@pytest.mark.parametrize("sizes", [(1e3, 1e4), (1.0, 1e6), (1e9, 1e30), (1.0, 1e306), (1.0, 5e4)])
def test_clusters_of_vectors_of_any_size(spark, sizes):
    rng = np.random.default_rng(6)
    rows = [(int(i), (rng.normal(size=64) * sizes[i % 2]).tolist(), 1, "x") for i in range(40)]
    assert found_clusters(centroids.cluster(vectors(spark, rows), rounds=4)) == plain_clusters(rows, rounds=4)


def test_few_vectors_and_none(spark):
    rows = [(3, [1.0] * 64, 1, "x"), (4, [1.0] * 64, 1, "x"), (5, [2.0] * 64, 1, "x")]
    made = centroids.cluster(vectors(spark, rows))
    assert found_clusters(made) == plain_clusters(rows)
    assert {(r["cluster_inertia"], r["inertia"]) for r in made.collect()} == {(0, 0)}
    assert centroids.cluster(vectors(spark, [])).collect() == []


def test_bounds_hold_and_rule_centroids_out():
    rng = np.random.default_rng(7)
    rows = np.floor(rng.normal(size=(4000, 64)) * 128).astype(np.int64)
    start, compared = rows[:8], []
    for spread in (0, 10, 200):
        centres = (start + rng.integers(-spread, spread + 1, start.shape)).tolist()
        simplex = centroids.Simplex.of(start.tolist() + rows[8:16].tolist())
        c = centroids.Centroids(centres, simplex)
        left = c.candidates(simplex.distances(rows))
        exact = ((rows[:, None, :] - np.array(centres)) ** 2).sum(axis=2)
        number, distance = c.narrow(rows, simplex.distances(rows), True)
        assert left[np.arange(len(rows)), exact.argmin(axis=1)].all()
        assert (number == exact.argmin(axis=1)).all() and (distance == exact.min(axis=1)).all()
        compared.append(left.mean())
    assert compared[0] < 0.2 and compared[0] <= compared[1] <= compared[2]


def test_pivots_that_lie_on_a_line_are_left_out():
    line = [[k] * 64 for k in range(6)]
    assert len(centroids.Simplex.of(line).pivots) == 2
    assert len(centroids.Simplex.of([[1] * 64] * 3).pivots) == 1
    assert centroids.Simplex.of([[1 << 20] * 64]) is None


# --- the audit of filters


def plain_audit(docs, labels):
    import re

    failing, parts = {}, {}
    for n, (i, text, lang) in enumerate(docs):
        text, words = text or "", re.findall(r"[^\x20\x09-\x0D]+", text or "")
        copy = i is not None and any(j is not None and j < i and (t or "") == text for j, t, _ in docs)
        tests = (len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", text)) > 3 * len(text), bool(re.search(r"[#$%&*|]", text)), copy)
        failing[n], parts[n] = {f for f, x in zip("ABCDE", tests, strict=True) if x}, lang or ""
    good, toxic = ({i for i, q, t in labels if i is not None and (q, t)[k] == 1} for k in (0, 1))
    out = []
    for part in set(parts.values()):
        shapley, rows = Counter(), []
        for order in permutations("ABCDE"):
            alive = [n for n in parts if parts[n] == part]
            every = list(alive)
            for step, f in enumerate(order, 1):
                gone = [n for n in alive if f in failing[n]]
                alive = [n for n in alive if f not in failing[n]]
                shapley[f] += len(gone)
                behind = [n for n in every if f in failing[n] and n not in gone and n not in alive]
                alone = [n for n in every if failing[n] == {f}]
                rows.append((part, "".join(order), step, f, len(alive), len(gone), len(behind), len(alone), sum(docs[n][0] in good for n in gone), sum(docs[n][0] in toxic for n in gone)))
        out += [(*r[:3], *r[4:], shapley[r[3]]) for r in rows]
    return sorted(out)


def found_audit(df):
    return sorted(tuple(r) for r in df.select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley").collect())


def test_audit_of_odd_documents(spark):
    long = " ".join(f"w{i}" for i in range(220))
    texts = [(0, "a b c", "en"), (1, "a b c", "fr"), (1, "a b c", "fr"), (2, long, "en"), (3, long, "en"), (4, long + " $", "en"), (5, "A" * 10, "de"), (6, None, None), (7, "", ""), (8, "x " * 400, "en"), (None, "a b c", "en"), (None, None, None), (9, long * 40, "en"), (10, "é" * 97 + "AAA", "de"), (11, "é" * 96 + "AAAA", "de"), (12, "a\x0bb\x85c " * 70, "en")]
    labels = [(0, 1, 0), (1, 0, 1), (1, 1, 0), (3, 1, None), (8, None, 1), (None, 1, 1), (99, 1, 1)]
    docs = spark.createDataFrame([(*t, 1, 2) for t in texts], "doc_id long, text string, lang string, n long, mask int")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert found_audit(audit.audit(docs, marks)) == plain_audit(texts, labels)


def test_audit_of_no_documents(spark, none, odd):
    marks = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit.audit(none, marks).collect() == []
    assert len(audit.audit(odd, marks).collect()) == 600 * len({r["lang"] or "" for r in odd.select("lang").collect()})


def test_gray_code_walk_gives_every_subset():
    cells = np.random.default_rng(8).integers(0, 50, (32, 3))
    got = audit.states(cells)
    for subset in range(32):
        assert (got[subset] == cells[[m for m in range(32) if not m & subset]].sum(axis=0)).all()


# --- the n-gram model


def plain_scores(docs, order):
    """(n_tokens, n_known, N, base, score) of each (doc_id, text), from dictionaries of whole words."""
    split = lambda t: [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "").replace("\t", " ").replace("\n", " ").split(" ") if w]
    out = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0
    texts = [["<s>", *split(t), "</s>"] for _, t in docs]
    learned = [t for t, (i, _) in zip(texts, docs, strict=True) if not out(i)]
    raw = {k: Counter(tuple(t[p - k + 1 : p + 1]) for t in learned for p in range(max(1, k - 1), len(t)) if p >= k - 1) for k in range(1, order + 1)}
    adjusted = {order: dict(raw[order])}
    for k in range(order - 1, 0, -1):
        before = Counter(g[1:] for g in {tuple(t[p - k : p + 1]) for t in learned for p in range(k, len(t))})
        adjusted[k] = {g: raw[k][g] if g[0] == "<s>" else before[g] for g in raw[k]}
    words, n = raw[1], sum(raw[1].values())
    take, by_context = {}, {}
    for k in range(1, order + 1):
        t = Counter(adjusted[k].values())
        y = t[1] / (t[1] + 2 * t[2]) if t[1] else 0
        take[k] = (0.5, 1.0, 1.5) if not (t[1] and t[2] and t[3] and t[4]) else [min(max(c - (c + 1) * y * t[c + 1] / t[c], 0.1), c - 0.1) for c in (1, 2, 3)]
        by_context[k] = defaultdict(list)
        for g, a in adjusted[k].items():
            by_context[k][g[:-1]].append(a)

    def chance(gram):
        if not gram:
            return 1 / (len(words) + 1)
        k, rest = len(gram), chance(gram[1:])
        if not (follow := by_context[k].get(gram[:-1])):
            return rest
        a = adjusted[k].get(gram, 0)
        return ((a - take[k][min(a, 3) - 1] if a else 0) + sum(take[k][min(c, 3) - 1] for c in follow) * rest) / sum(follow)

    made = []
    for t in texts:
        base = sum(math.log10((words[(w,)] + 0.1) / (n + 0.1 * (len(words) + 1))) for w in t[1:])
        made.append((len(t) - 1, sum((w,) in words for w in t[1:]), n, base, sum(math.log10(chance(tuple(t[max(0, p - order + 1) : p + 1]))) for p in range(1, len(t)))))
    every = lambda context: sum(chance((*context, w)) for (w,) in words) + chance((*context, "never seen"))
    for context in list(by_context[order])[:5]:
        assert math.isclose(every(context), 1, rel_tol=1e-9)
    return made


def found_scores(df, ids):
    rows = {r["doc_id"]: (r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in df.collect()}
    return [rows[i] for i in ids]


@pytest.mark.parametrize("order", [1, 2, 3, 4])
@pytest.mark.parametrize("shard_bytes", [1 << 20, 60])
def test_scores_as_a_plain_model_gives_them(spark, order, shard_bytes):
    rng = np.random.default_rng(9)
    words = [f"w{min(int(x), 60)}" for x in rng.zipf(1.4, 4000)]
    docs, at = [], 0
    for i in range(50):
        n = int(rng.integers(0, 60))
        docs.append((i, " ".join(words[at : at + n])))
        at += n
    docs += [(50, None), (51, ""), (52, " \t\n "), (53, "Only Once\x0b here"), (54, "hot " * 500), (55, "hot cold " * 200), (56, docs[3][1])]
    if shard_bytes == 60:
        docs = docs[:20] + docs[50:]
    df = spark.createDataFrame([(i, t, "x", 3) for i, t in docs], "doc_id long, text string, score string, n_tokens int")
    got, want = found_scores(ngrams.score(df, order, shard_bytes=shard_bytes), [i for i, _ in docs]), plain_scores(docs, order)
    for a, b in zip(got, want, strict=True):
        assert a[:3] == b[:3] and np.allclose(a[3:], b[3:], rtol=1e-9)


def test_scores_of_odd_documents(spark, odd, none):
    made = ngrams.score(odd).collect()
    assert len(made) == odd.count() and all(r["n_tokens"] >= 1 and r["score"] <= 0 and r["perplexity"] >= 1 for r in made)
    assert {r["held_out"] for r in made if r["doc_id"] is None} == {True}
    assert ngrams.score(none).collect() == []
    unseen = ngrams.score(odd.where("doc_id is null")).collect()  # nothing to learn from
    assert [(r["train_tokens"], r["n_known"], r["base_score"], r["score"]) for r in unseen] == [(0, 0, 0.0, 0.0)] * len(unseen)


def test_texts_that_were_not_learned_are_likelier_than_by_counts_alone(spark):
    rows = [r for r in queries.QUERIES["op13_language_model"](spark, SMALL).collect() if r["held_out"]]
    assert rows and sum(r["score"] for r in rows) > 0.9 * sum(r["base_score"] for r in rows)


def test_packed_rows_come_back():
    rng = np.random.default_rng(10)
    for width, kinds in ((1, 1), (2, 5), (4, 1)):
        grams, values = rng.integers(0, 2**64, (100, width), dtype=np.uint64), rng.integers(0, 2**40, (100, kinds))
        back = ngrams.unpacked(ngrams.packed(grams, values))
        assert (back[0] == grams).all() and (back[1] == values).all()


def test_hot_words_send_their_followers_to_all_shards():
    hot, other = np.uint64(12345), np.uint64(54321)
    grams = np.stack([np.array([hot, other], np.uint64).repeat(100), np.arange(200, dtype=np.uint64)], axis=1)
    where = ngrams.shards(grams, 16, np.array([hot], np.uint64))
    assert len(set(where[:100])) > 8 and len(set(where[100:])) == 1


def test_words_are_told_apart(monkeypatch):
    texts = [b"", b" ", b"one", b"One TWO\x0bthree\x85\tfour ", b"\xc3\x89A b", b"x" * 300 + b" one", b"two one"]
    for piece in (ngrams.PIECE, 8):
        monkeypatch.setattr(ngrams, "PIECE", piece)
        for column in (pa.array([b"ab", *texts], pa.binary()).slice(1), pa.array(texts, pa.large_binary())):
            stream, place, begins = ngrams.Words().symbols(column)
            words = [w for t in texts for w in (b" start", *t.lower().split(), b" end")]
            assert len(stream) == len(words) and len(set(stream.tolist())) == len(set(words)) == len(set(zip(stream.tolist(), words, strict=True)))
            assert begins.tolist() == [i for i, w in enumerate(words) if w == b" start"] + [len(words)]
            assert place.tolist() == [i - max(b for b in begins.tolist() if b <= i) for i in range(len(words))]
    rng = np.random.default_rng(3)
    many = {bytes(rng.integers(97, 100, int(rng.integers(1, 12))).astype(np.uint8)) for _ in range(50_000)} | {b"%d" % i for i in range(50_000)}
    assert len(set(ngrams.Words().symbols(pa.array([b" ".join(many)], pa.binary()))[0].tolist())) == len(many) + 2
