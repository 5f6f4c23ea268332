"""The training-data operators against brute force, round trips, other libraries and held-out rows, and on odd input."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import oracle
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import xxhash
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from spoor.llm import bpe, chat, langid, mixing, quality, queries, secretscan, sharding, simhash, template, topk, urlfilter

SMALL, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
PATH = public_tokenizers.path(queries.VOCABULARY)
BLANK = re.compile(r"[\x20\x09-\x0D]+")


def words_of(text):
    return [w for w in BLANK.split(text or "") if w]


def texts_of(folder):
    t = pq.read_table(f"{folder}/documents.parquet")
    return dict(zip(t["doc_id"].to_pylist(), t["text"].to_pylist(), strict=True))


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_same_rows_as_sql(spark, name):
    for folder in (SMALL, LARGER):
        assert oracle.rows_of_spark(queries.QUERIES[name](spark, folder)) == oracle.rows_of_sql(oracle.connect(folder), queries.ORACLES[name])


# --- near-duplicates


def plain_fingerprint(text):
    words = words_of("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, radius=4):
    values = np.array(sorted(set(prints.values())), np.uint64)
    up = list(range(len(values)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, v in enumerate(values):
        for j in np.nonzero(np.bitwise_count(values ^ v) <= radius)[0]:
            up[find(int(j))] = find(i)
    place = {int(v): i for i, v in enumerate(values)}
    least = {}
    for d, f in sorted(prints.items()):
        least.setdefault(find(place[f]), d)
    return {d: least[find(place[f])] for d, f in prints.items()}


def test_near_duplicates_against_brute_force(spark):
    prints = {d: plain_fingerprint(t) for d, t in texts_of(LARGER).items()}
    want = plain_components(prints)
    found = {r["doc_id"]: (int(r["fingerprint"], 16), r["component_id"]) for r in queries.op1_simhash(spark, LARGER).collect()}
    assert found == {d: (prints[d], want[d]) for d in prints}


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=20), st.lists(st.tuples(st.integers(0, 19), st.sets(st.integers(0, 63), max_size=6)), max_size=40))
def test_links_span_every_component(spark, seeds, flips):
    values = list(seeds)
    for k, bits in flips:
        values.append(values[k % len(values)] ^ sum(1 << b for b in bits))
    df = spark.createDataFrame([(x, x, 0) for x in (v - 2**64 if v >= 2**63 else v for v in values)], "key long, fp long, fp2 long")
    up = {v: v for v in values}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for r in simhash.links(df, most=3).collect():
        a, b = r["a"] % 2**64, r["b"] % 2**64
        assert (a ^ b).bit_count() <= 64
        up[find(a)] = find(b)
    want = plain_components(dict(enumerate(values)))
    for i, v in enumerate(values):
        for j in range(i):
            assert (want[i] == want[j]) == (find(v) == find(values[j]))


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=12), st.lists(st.tuples(st.integers(0, 11), st.sets(st.integers(0, 63), max_size=5)), max_size=40))
def test_splitting_a_pair_of_tiles_loses_no_link(seeds, flips):
    values = seeds + [seeds[k % len(seeds)] ^ sum(1 << b for b in bits) for k, bits in flips]
    cells = {}
    for v in set(values):
        cells.setdefault(((v >> 32).bit_count(), (v & 0xFFFFFFFF).bit_count()), []).append(v)
    tiles = [np.array(c, np.uint64) for c in cells.values()]
    for i, a in enumerate(tiles):
        for b in tiles[i:]:
            whole, split = (simhash._forest(a, b, a is b, 4, leaf) for leaf in (1 << 40, 0))
            assert whole.tolist() == split.tolist()


def jaccard_of_shingles(a, b, n=5):
    x, y = ({tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} for w in (words_of(t.lower()) for t in (a, b)))
    return len(x & y) / len(x | y)


def test_near_copies_are_dropped_and_others_stay(spark):
    rng = np.random.default_rng(5)
    fresh = lambda n: ["".join(rng.choice(list("abcdefgh"), 6)) for _ in range(n)]
    texts, copies = [], {}
    for _ in range(60):
        base = fresh(300)
        texts.append(" ".join(base))
        for edits in (1, 3, 5):
            own = list(base)
            for at in rng.choice(300, edits, replace=False):
                own[at] = fresh(1)[0]
            copies[len(texts)] = jaccard_of_shingles(texts[-1 - (len(texts) - 1) % 4], " ".join(own))
            texts.append(" ".join(own))
    kept = {r["doc_id"] for r in simhash.drop_near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert {k for k in range(0, len(texts), 4)} <= kept
    near = [k for k, j in copies.items() if j >= 0.85]
    assert len(near) > 100 and np.mean([k not in kept for k in near]) > 0.95


def test_near_duplicates_on_odd_input(spark, odd, none):
    found = simhash.near_duplicates(odd).collect()
    assert len(found) == odd.count()
    by = {r["doc_id"]: r for r in found}
    assert by[1]["component_id"] == 0 and by[3]["fingerprint"] == "0" * 16 and by[5]["component_id"] == 3 and by[4]["component_id"] == 3
    kept = simhash.drop_near_duplicates(odd)
    assert kept.columns == odd.columns
    assert {r["doc_id"] for r in kept.collect()} >= {0, 3, 7, 9} and 1 not in {r["doc_id"] for r in kept.collect()}
    assert simhash.near_duplicates(none).count() == 0


# --- encoding


def test_encoding_is_the_librarys(spark, odd, none):
    lib = Tokenizer.from_file(PATH)
    lib.no_truncation(), lib.no_padding()
    own = bpe.encoder(PATH)
    texts = [*texts_of(SMALL).values(), "", "a<|endoftext|>B c's ΑΣ Σ", "İ x\x1c1²Ⅷ 한글 <|startoftext|>!!", "ab" * 700, "😀👩‍👩‍👧 ſKÅǅ"]
    for t in texts:
        ids = lib.encode(t, add_special_tokens=False).ids
        assert own.encode(t) == ids and own.decode(ids) == lib.decode(ids, skip_special_tokens=False)
    for r in queries.op2_bpe(spark, SMALL).collect():
        ids = lib.encode(texts_of(SMALL)[r["doc_id"]], add_special_tokens=False).ids
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), sha(" ".join(map(str, ids))), sha(lib.decode(ids, skip_special_tokens=False)))
    found = bpe.decode(bpe.encode(odd, PATH), PATH).collect()
    assert len(found) == odd.count() and all(r["n_tokens"] == len(r["ids"]) for r in found)
    assert bpe.encode(none, PATH).count() == 0 and bpe.digests(odd, PATH).count() == odd.count()


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet=st.characters(max_codepoint=0x2FF, exclude_categories=["Cs", "Cn"]), max_size=60))
def test_encoding_of_any_latin_text(text):
    lib = Tokenizer.from_file(PATH)
    assert bpe.encoder(PATH).encode(text) == lib.encode(text, add_special_tokens=False).ids


def test_frequent_runs_stay_remembered(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 100)
    lib, own, asked = Tokenizer.from_file(PATH), bpe.Encoder(PATH), Counter()
    merged = own.merged
    monkeypatch.setattr(own, "merged", lambda word: asked.update([word]) or merged(word))
    for k in range(1000):
        text = f"often rare{k:04} <|endoftext|>!"
        assert own.encode(text) == lib.encode(text, add_special_tokens=False).ids
        assert len(own) <= 100
    assert asked["often"] == 1


# --- language


def test_language_on_held_out_rows(spark):
    t = pq.read_table(f"{LARGER}/documents.parquet")
    truth = dict(zip(t["doc_id"].to_pylist(), t["lang"].to_pylist(), strict=True))
    found = queries.op3_language(spark, LARGER).collect()
    held = [r for r in found if r["held_out"]]
    assert {r["doc_id"] for r in held} == {d for d in truth if zlib.crc32(str(d).encode()) % 3 == 1}
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in found)


def test_mixtures_have_their_shares(spark):
    t = pq.read_table(f"{LARGER}/documents.parquet").to_pylist()
    rows = spark.createDataFrame([(r["lang"], r["text"]) for r in t], "lang string, text string")
    model = langid.train(rows)
    whole = {lang: next(r["text"] for r in t if r["lang"] == lang and r["n_chars"] > 3000)[:3000] for lang in ("en", "de")}
    lang, score = model.predict(whole["en"] + " " + whole["de"][:1500])
    assert lang == "en" and 0.55 < score < 0.8


def test_language_on_odd_input(odd, none):
    found = langid.identify(odd).collect()
    assert len(found) == odd.count()
    assert {r["lang_pred"] for r in found if r["doc_id"] in (3, 4, 5, 8)} == {"und"}
    assert langid.keep_identified(odd).columns == odd.columns
    assert langid.identify(none).count() == 0 and langid.keep_identified(none).count() == 0


# --- urls


def test_urls_on_odd_input(spark):
    urls = [None, "", "no scheme", "HTTP://A.B.Example.COM:80/en/7x?q#f", "http://net/de/8", "http://xnet/de/", "http://x.example.net/de/81", "https://porn.example/", "http://a/sponsored-pornography", "http://a/bet?free=1", "http://a/bet?bet=1", "x://", "a://b://c/d"]
    df = spark.createDataFrame([(k, u, "x", "y") for k, u in enumerate(urls)], "page_id long, url string, host string, rule string")
    found = [tuple(r)[1:5] for r in urlfilter.judge(df).orderBy("page_id").collect()]
    assert found[0] == ("", "", None, "allow") and found[2] == ("", "", None, "allow")
    assert found[3] == ("a.b.example.com:80", "/en/7x", None, "allow")
    assert found[4] == ("net", "/de/8", "net/de/", "allow") and found[5] == ("xnet", "/de/", None, "allow")
    assert found[6] == ("x.example.net", "/de/81", "example.net/de/8", "block")
    assert [v[3] for v in found[7:11]] == ["block", "allow", "block", "allow"]
    assert found[12][:2] == ("b:", "//c/d")
    assert urlfilter.judge(df.limit(0)).count() == 0
    more = ["http://a/éporn", "http://a/" + "x" * 100_000 + "/porn", "http://a/porn/porn?xxx", "http://a/click?ads&promo&sale", "http://a/click?ads&promo", "http://a/bet?click", "http://a/glücksspiel?bet"]
    twice = spark.createDataFrame([(k, u, "x") for k, u in enumerate(more * 2)], "page_id long, url string, soft_terms string")
    found = [(r["verdict"], r["strict_hits"], r["soft_terms"], r["soft_points"]) for r in urlfilter.judge(twice).orderBy("page_id").collect()]
    assert found[:7] == found[7:] == [("allow", 0, 0, 0), ("block", 1, 0, 0), ("block", 3, 0, 0), ("block", 0, 4, 100), ("allow", 0, 3, 75), ("allow", 0, 2, 75), ("block", 0, 2, 100)]


def test_a_vocabulary_is_read(tmp_path):
    (tmp_path / "v").write_text("# terms\nBad\nso\t50\n\n", encoding="utf-8")
    assert urlfilter.read_vocabulary(str(tmp_path / "v")) == {"bad": 100, "so": 50}


# --- shards


def test_shards_fit_and_only_large_ones_split(spark, odd, none):
    docs = spark.read.parquet(f"{LARGER}/documents.parquet")
    for limit in (2_000, 50_000, 10**9):
        found = sharding.assign(docs, limit).collect()
        sizes, rows, depth = Counter(), Counter(), {}
        for r in found:
            sizes[r["shard"]] += r["n_bytes"]
            rows[r["shard"]] += 1
        assert len(found) == 1000 and all(n <= limit or rows[s] == 1 for s, n in sizes.items())
        for s in sizes:  # what stands above a shard didn't fit
            for d in range(len(s)):
                depth[s[:d]] = depth.get(s[:d], 0) + sizes[s]
        assert all(n > limit for n in depth.values())
        assert all(r["shard_bytes"] == sizes[r["shard"]] for r in found)
    assert sharding.assign(odd, 500).count() == odd.count() and sharding.assign(none).count() == 0


def test_shards_are_written(spark, odd, tmp_path):
    sharding.write_shards(odd, str(tmp_path / "s"), 500)
    assert spark.read.parquet(str(tmp_path / "s")).count() == odd.count()


# --- chat


def test_template_language():
    render = template.compile_template("{% for m in xs %}{% if m.a == 'x' and not m.b %}[{{ m.a + '!' | up }}]{% elif m.b %}{% generation %}{{ m.b }}{% endgeneration %}{% else %}-{% endif %}{% endfor %}{{ 'a' + 'b' }}", {"up": str.upper})
    assert render(xs=[{"a": "x"}, {"b": "é😀"}, {}]) == ("[x!]é😀-ab", [(4, 6)])
    assert template.fold(template.parse("a{{ 'b' + 'c' }}{% if 'x' == 'y' %}no{% else %}d{% endif %}"), {}) == ("block", [("text", "abcd")])
    for bad in ("{% for x in y %}", "{{ a. }}", "{{ x() }}", "{% endif %}", "{{ 'a }}", "{% import os %}", "{{ a | none }}"):
        with pytest.raises(template.TemplateError):
            template.compile_template(bad)
    assert template.compile_template("{{ a.__class__ }}")(a="text") == ("", [])


@settings(max_examples=50, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "a<|end|>\n\\"]), st.text(alphabet="<|>\\/[]sINTend\n é", max_size=30)), max_size=5))
def test_any_text_is_read_back(turns):
    text, spans = chat.renderer(chat.TEMPLATE)(messages=[{"role": r, "text": t} for r, t in turns])
    assert chat.read_back(text) == turns
    assert [chat.unescape(text[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]


def test_chat_on_odd_input(spark):
    schema = "conv_id long, turn long, role string, text string, formatted string"
    rows = [(1, 1, "assistant", "b", "x"), (1, 0, "user", "a", "x"), (None, None, None, None, None), (2, 0, "assistant", None, "x"), (2, 0, "assistant", None, "x"), (3, 0, "user", "t" * 200_000, "x")]
    found = {r["conv_id"]: r for r in chat.digests(chat.format_conversations(spark.createDataFrame(rows, schema))).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert found[1]["turns_sha256"] == sha("user\na\nassistant\nb\n") and found[1]["loss_sha256"] == sha("b")
    assert (found[2]["n_turns"], found[2]["loss_chars"], found[None]["n_turns"]) == (2, 0, 1)
    assert chat.format_conversations(spark.createDataFrame([], schema)).count() == 0


# --- mixing


def test_mix_keeps_its_bounds(spark, odd, none):
    docs = spark.read.parquet(f"{LARGER}/documents.parquet")
    found = mixing.mix(docs).collect()
    assert sorted(found) == sorted(mixing.mix(docs.repartition(5)).collect())
    per = {}
    for r in found:
        assert 0 <= r["taken"] <= 3 * r["size"]
        x = per.setdefault((r["source_size"], r["target"]), [0, 0])
        x[0] += r["taken"]
        x[1] += r["size"]
    assert abs(sum(t for _, t in per) - sum(r["size"] for r in found)) < 1e-6 * sum(r["size"] for r in found)
    for (size, target), (taken, own) in per.items():
        assert size == own and target <= 3 * size + 1e-9 and abs(taken - target) <= 1
    assert mixing.mix(odd).count() == odd.count() and mixing.mix(none).count() == 0
    assert mixing.repeated(odd).columns == odd.columns and mixing.repeated(none).count() == 0


def test_targets_by_hand(spark):
    sizes = spark.createDataFrame([("a", "a", 10, 1), ("b", "b", 1000, 1), ("c", "c", 500, 1), ("n", None, 90, 1)], "key string, source string, source_size long, n long")
    left = {s: r for s, r in ((x["source"], x["target"]) for x in mixing.targets(sizes).collect())}
    want, sizes_, weight, open_, total = {}, {"a": 10, "b": 1000, "c": 500, None: 90}, {"a": 5, "b": 2, "c": 1, None: 5}, {"a", "b", "c", None}, 1600.0
    while True:
        level = (total - sum(want.values())) / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > 3 * sizes_[s]}
        if not over:
            break
        want |= {s: 3.0 * sizes_[s] for s in over}
        open_ -= over
    want |= {s: level * weight[s] for s in open_}
    assert {s: round(x, 6) for s, x in left.items()} == {s: round(x, 6) for s, x in want.items()}


# --- search


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.integers(-3, 3), min_size=0, max_size=5), min_size=1, max_size=30), st.integers(1, 3))
def test_search_against_brute_force(spark, vectors, groups):
    df = spark.createDataFrame([(k, [x / 64 for x in v]) for k, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    found = {}
    for r in topk.top_k(df, k=4, every=5, groups=groups).orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))  # noqa: E731, B905
    for q in range(0, len(vectors), 5):
        want = sorted(((-dot(vectors[q], v), k) for k, v in enumerate(vectors) if k != q))[:4]
        assert found.get(q, []) == [(k, -s) for s, k in want]


def test_search_on_odd_input(spark):
    inf = float("inf")
    rows = [(0, [1.0, 2.0], 1), (1, None, 1), (2, [1.0, None], 1), (3, [inf, 0.0], 1), (4, [float("nan"), 1.0], 1), (None, [1.0, 1.0], 1), (5, [-0.001, 1e300], 1), (6, [1.0, 1.0], 1), (7, [1.0, 1.0], 1)]
    found = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int"))
    assert [r["vec_id"] for r in found.orderBy("rank").collect()] == [5, 6, 7]
    assert topk.top_k(spark.createDataFrame([], "vec_id long, embedding array<double>")).count() == 0


# --- quality


def plain_statistics(text):
    text = text or ""
    words = words_of(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    many = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if many[w] > 1 for k in range(3)}
    seen, dups = set(), 0
    for line in text.split("\n"):
        if words_of(line):
            dups += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dups, len(covered)


def test_base_rules_against_brute_force(spark):
    texts = texts_of(LARGER)
    for r in queries.op9_quality(spark, LARGER).collect():
        want = plain_statistics(texts[r["doc_id"]])
        failed = want[0] < 50 or 100 * want[4] > 50 * want[0]
        assert tuple(r)[1:6] == want and r["base_failed"] == failed and not (failed and r["kept"])


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="ab \n\x85\xa0\x1c#é", max_size=60))
def test_statistics_of_any_text(text):
    assert quality.statistics(text)[:5] == plain_statistics(text)


def test_forest_rejects_bad_rows_and_keeps_good_ones(spark):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{LARGER}/labels.parquet").collect()}
    rows = [r for r in queries.op9_quality(spark, LARGER).collect() if r["doc_id"] in labels and not r["base_failed"]]
    good, bad = ([r["kept"] for r in rows if labels[r["doc_id"]] == k] for k in (1, 0))
    assert np.mean(good) > 0.99 and np.mean(bad) < 0.8


def test_quality_on_odd_input(spark, odd, none):
    labels = spark.createDataFrame([(0, 1), (0, 1), (7, None), (None, 1)], "doc_id long, quality int")
    found = quality.judge(odd, labels).collect()
    assert len(found) == odd.count() and not any(r["kept"] for r in found if r["doc_id"] in (3, 4, 5, 6))
    assert quality.judge(none, labels).count() == 0 and quality.judge(odd, labels.limit(0)).count() == odd.count()


def test_forest_is_fitted_to_all_labelled_rows(spark):
    rng = np.random.default_rng(5)
    made = [(k, " ".join(["word" * int(c)] * 3 + [f"{'w' * int(d)}{k}.{j}" for j in range(50)]), int(k % 9 > 0)) for k, (c, d) in enumerate(rng.integers(1, 9, (20_500, 2)))]
    docs = spark.createDataFrame(made, "doc_id long, text string, quality int").repartition(7, "doc_id").cache()
    found = quality.judge(docs, docs.select("doc_id", "quality")).select("doc_id", "base_failed", "anomaly", "kept").toPandas().sort_values("doc_id")
    counts = np.array([quality.statistics(t) for _, t, _ in made], np.int64)
    assert not found["base_failed"].any()
    forest = quality.fit(counts, np.array([q == 1 for *_, q in made]))
    scores = forest.scores(quality.features(counts))
    assert (found["anomaly"].to_numpy() == scores).all() and (found["kept"].to_numpy() == (scores <= forest.threshold)).all()
    docs.unpersist()


def test_value_at_a_place(spark):
    values = np.random.default_rng(6).choice(np.concatenate([[0.5] * 500, np.random.default_rng(7).random(500), 0.3 + np.arange(200) * 2.0**-50]), 3000)
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    for place in (0, 1, 1200, 1500, 2985, 2999):
        assert quality.value_at(df, "v", place) == np.sort(values)[place]


# --- secrets


def plain_spans(text):
    out = []
    for rank, (pattern, group, least) in enumerate(
        [(r"""(?i:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?)([A-Za-z0-9+/_.=-]+)""", 2, 6), (r"AKIA[A-Z0-9]+", 0, 20), (r"[0-9a-f]+", 0, 24)]
    ):
        out += [(m.start(), rank, m.end()) for m in re.finditer(pattern, text or "", re.A) if len(m[group]) >= least]
    return sorted(out)


def digest(spans):
    return hashlib.sha256(",".join(f"{('assign', 'access', 'hex')[r]}:{s}:{e}" for s, r, e in spans).encode()).hexdigest()


def test_base_secrets_against_brute_force(spark):
    texts = texts_of(LARGER)
    for r in queries.op10_secrets(spark, LARGER).collect():
        want = plain_spans(texts[r["doc_id"]])
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(x[1] == k for x in want) for k in range(3)) and r["base_sha256"] == digest(want)


def test_secrets_on_odd_input(spark, odd, none):
    random_key = "zX9kQ2mV7tLp4RwY8sBn3HcD"
    texts = [
        "é token: abcdef😀 PASSWORD=x api_key=token: abcdefgh", "AKIAAKIA AKIA" + "Q7" * 9, "a" * 23 + " " + "f0" * 12, f"key {random_key} end", "thisisjustaverylongword2000andmore", "ZZZZZZZZZZZZZZZZZZZZZZZZ1a", f"x{random_key}x " * 4000, None, "",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r for r in secretscan.scan(df).collect()}
    for k, t in enumerate(texts):
        assert found[k]["base_sha256"] == digest(plain_spans(t)), k
    assert found[3]["spans"] == f"random:4:{4 + len(random_key)}" and found[5]["spans"] == "" and found[8]["spans"] == ""
    assert secretscan.scan(odd).count() == odd.count() and secretscan.scan(none).count() == 0
    cleaned = {r["doc_id"]: r["text"] for r in secretscan.redact(df).collect()}
    assert cleaned[3] == "key [SECRET] end" and cleaned[7] is None and cleaned[8] == "" and cleaned[0].startswith("é [SECRET]😀 ")
    assert secretscan.redact(odd).columns == odd.columns
