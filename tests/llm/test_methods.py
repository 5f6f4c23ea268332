"""The statistics behind operators that SQL can't express, against plain versions of them."""

import math
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from spoor.llm import langid, quality, secretscan

# --- language: expectation-maximisation and the set of languages


def plain_mixture(chance, n, share, rounds=langid.ROUNDS):
    share = list(share)
    for _ in range(rounds):
        new = [0.0] * len(share)
        for g, times in enumerate(n):
            mixed = sum(s * c for s, c in zip(share, chance[g], strict=True))
            for k, s in enumerate(share):
                new[k] += times * s * chance[g][k] / mixed
        share = [x / sum(n) for x in new]
    fit = sum(times * math.log(sum(s * c for s, c in zip(share, chance[g], strict=True))) for g, times in enumerate(n))
    return share, fit


def plain_prediction(model, text):
    counts = Counter(langid.grams(text).tolist())
    n, chance = list(counts.values()), [model.chance[g].tolist() for g in counts]
    of = lambda ks, share: plain_mixture([[c[k] for k in ks] for c in chance], n, share)
    alone = [sum(t * math.log(c[k]) for t, c in zip(n, chance, strict=True)) for k in range(len(model.langs))]
    chosen, share = [int(np.argmax(alone))], [1.0]
    fit, price = max(alone), langid.PENALTY * math.log(sum(n) + 1)
    while len(chosen) < len(model.langs):
        tried = [(of([*chosen, k], [*(0.9 * s for s in share), 0.1]), k) for k in range(len(model.langs)) if k not in chosen]
        (found, now), k = max(tried, key=lambda x: x[0][1])
        if now - price <= fit:
            break
        chosen, share, fit = [*chosen, k], found, now
    at = int(np.argmax(share))
    return model.langs[chosen[at]], share[at]


def test_mixtures_against_a_plain_version():
    rng = np.random.default_rng(1)
    chance = rng.gamma(0.05, size=(langid.BUCKETS, 4)) + 1e-4
    model = langid.Model(["a", "b", "c", "d"], chance / chance.sum(axis=0))
    letters = "abcdefghij éß"
    for size in (3, 30, 300, 1500):
        text = "".join(rng.choice(list(letters), size))
        lang, score = model.predict(text)
        want, share = plain_prediction(model, text)
        assert lang == want and abs(score - share) < 1e-6
    n, few = np.array([3, 1, 4, 1, 5]), chance[:5]
    share, fit, _ = langid.mixture(few, n, np.array([0.4, 0.3, 0.2, 0.1]))
    plain, plain_fit = plain_mixture(few.tolist(), n.tolist(), [0.4, 0.3, 0.2, 0.1])
    assert np.allclose(share, plain) and abs(fit - plain_fit) < 1e-9
    longer = [langid.mixture(few, n, np.array([0.4, 0.3, 0.2, 0.1]))[1]]
    for _ in range(3):
        share, fit, _ = langid.mixture(few, n, share)
        longer.append(fit)
    assert longer == sorted(longer)


# --- quality: paths through the trees


def plain_path(forest, tree, row):
    node, steps = 0, 0
    while forest.feature[tree][node] >= 0:
        node = 2 * node + 1 + int(row[forest.feature[tree][node]] >= forest.value[tree][node])
        steps += 1
    return steps, forest.path[tree][node]


def test_forest_against_plain_walks():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 7))
    forest = quality.grow(x, trees=20, per_tree=64)
    rows = np.concatenate([x[:20], np.full((1, 7), 9.0)])
    scores = forest.scores(rows)
    for k, row in enumerate(rows):
        walks = [plain_path(forest, t, row) for t in range(20)]
        assert all(steps <= path for steps, path in walks)
        assert math.isclose(scores[k], 2 ** (-np.mean([p for _, p in walks]) / forest.norm))
    assert scores[-1] == scores.max()
    harmonic = lambda n: sum(1 / i for i in range(1, n))
    for n in (2, 3, 10, 200):
        assert abs(quality.expected_path(n) - (2 * harmonic(n) - 2 * (n - 1) / n if n > 2 else 1.0)) < 0.5


def test_threshold_loses_few_good_rows():
    rng = np.random.default_rng(3)
    counts = np.stack([rng.integers(100, 200, 1200), rng.integers(500, 900, 1200), *[rng.integers(0, 20, 1200) for _ in range(5)], rng.integers(900, 1200, 1200)], 1)
    good = np.arange(1200) >= 100
    counts[:100, 2] = 400
    forest = quality.fit(counts, good)
    scores = forest.scores(quality.features(counts))
    assert np.mean(scores[good] > forest.threshold) <= quality.MOST_LOST and np.mean(scores[~good] > forest.threshold) > 0.9
    assert quality.fit(counts, np.zeros(1200, bool)) is None


# --- secrets: the three tests and the cut-offs


def plain_p(run, alphabet):
    places, n, size = [alphabet.index(c) for c in run], len(run), len(alphabet)
    two_sided = lambda z: 2 / (1 + math.exp(1.5976 * min(abs(z), 12) + 0.07056 * min(abs(z), 12) ** 3))
    chi = sum((c - n / size) ** 2 for c in [places.count(k) for k in range(size)]) * size / n
    z = [(chi - (size - 1)) / math.sqrt(2 * (size - 1) * (1 - 1 / n))]
    high = [2 * p >= size for p in places]
    runs, ones = 1 + sum(a != b for a, b in zip(high, high[1:])), sum(high)
    mean = 2 * ones * (n - ones) / n + 1
    spread = (mean - 1) * (mean - 2) / (n - 1)
    z.append((runs - mean) / math.sqrt(spread) if spread > 0 else 12)
    off = np.array(places) - np.mean(places)
    z.append((off[:-1] @ off[1:] / (off @ off) + 1 / n) * math.sqrt(n) if off.any() else 12)
    return min(1, 3 * min(map(two_sided, z)))


def test_the_battery_against_plain_statistics(spark):
    rng = np.random.default_rng(4)
    alphabets = {name: alphabet for name, _, _, alphabet in secretscan.ENCODINGS}
    texts = ["".join(rng.choice(list(a), int(rng.integers(30, 120)))) for name, a in alphabets.items() for _ in range(6) if name != "hex"]
    texts += ["ab1" * 12 + "A", "A1" + "z" * 40, "abcdefghijklmnopqrstuvwxyz0123456789", "ZZZZZZZZZZaaaaaaaaaa0000000000"]
    docs = spark.createDataFrame([(k, f"x, {t} ,") for k, t in enumerate(texts)], "doc_id long, text string")
    found = secretscan.scanned(docs).select("doc_id", F.flatten(F.transform("_pieces", lambda p: p["tested"])).alias("t")).collect()
    seen = 0
    for r in found:
        text = f"x, {texts[r['doc_id']]} ,"
        for x in r["t"]:
            assert math.isclose(x["p"], plain_p(text[x["start"] : x["end"]].rstrip("="), alphabets[x["class"].split(":")[0]]), rel_tol=1e-6, abs_tol=1e-12)
            seen += 1
    assert seen > 30


def test_cut_offs_control_false_discoveries(spark):
    rng = np.random.default_rng(5)
    rows = [(c, float(p)) for c, share in (("a", 0.0), ("b", 0.5), ("c", 0.95)) for p in np.where(rng.random(400) < share, rng.random(400) * 0.001, rng.random(400))]
    one = "array<struct<start:int,text:string,base:array<struct<start:int,rank:int,end:int>>,tested:array<struct<start:int,end:int,class:string,p:double,bits:double>>>>"
    df = spark.createDataFrame(rows, "class string, p double").select(F.array(F.struct(F.lit(0), F.lit(""), F.array(), F.array(F.struct(F.lit(0), F.lit(1), "class", "p", F.lit(99.0))))).cast(one).alias("_pieces"))
    found = secretscan.cut_offs(df)
    for c in "abc":
        ps = [math.floor(p * secretscan.BINS) for k, p in rows if k == c]
        edges = [(b + 1) / secretscan.BINS for b in range(secretscan.BINS) if len(ps) * (b + 1) / secretscan.BINS <= secretscan.FDR * sum(x <= b for x in ps) and b in ps]
        assert found[c] == max(secretscan.LEAST_P, max(edges, default=0.0))
