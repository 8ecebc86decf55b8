"""Katz scores against brute force; the quality classifier by held-out labels."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from odd_rows import TEXTS, documents, nothing, sf
from pyspark.sql import functions as F

from enrichlake.llm import katz, site_quality


def scores_of(rows):
    end, begin = b"", None
    texts = [(i, [*(t or "").encode().lower().split(), end]) for i, t, *_ in rows]
    trains = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 5 != 1
    one, two = Counter(), Counter()
    for i, words in texts:
        if trains(i):
            one.update(words)
            two.update(zip([begin, *words], words, strict=False))
    total, types = sum(one.values()), len(one)
    d1, d2 = (katz.discounts([sum(c == r for c in counts.values()) for r in range(1, katz.K + 2)]) for counts in (one, two))
    cut = lambda c, d: c * (d[c] if c <= katz.K else 1)
    own = {w: cut(c, d1) / total for w, c in one.items()}
    if 1 - sum(own.values()) < 1 / (total + 1):
        own = {w: p * total / (total + 1) for w, p in own.items()}
    unknown = 1 - sum(own.values())
    followers = {}
    for (v, w), c in two.items():
        followers.setdefault(v, {})[w] = c
    back = {}
    for v, f in followers.items():
        n, seen = sum(f.values()), sum(cut(c, d2) for c in f.values())
        divisor = n + 1 if n - seen < 1e-9 * n else n
        back[v] = divisor, (1 - seen / divisor) / (1 - sum(own[w] for w in f))
        if len(back) < 20:  # a distribution adds up to one
            rest = unknown + sum(p for w, p in own.items() if w not in f)
            assert sum(cut(c, d2) / divisor for c in f.values()) + back[v][1] * rest == pytest.approx(1)
    out = []
    for i, words in texts:
        base = sum(math.log10((one[w] + 0.5) / (total + 0.5 * (types + 1))) for w in words)
        score = 0.0
        for v, w in zip([begin, *words], words, strict=False):
            p = cut(two[v, w], d2) / back[v][0] if two[v, w] else back.get(v, (1, 1))[1] * own.get(w, unknown)
            score += math.log10(p)
        out.append((i, not trains(i), len(words), sum(one[w] > 0 for w in words), total, base, score))
    return sorted(out, key=str)


def test_katz_scores(spark, monkeypatch):
    monkeypatch.setattr(katz, "BLOCK", 20_000)
    given = [(r["doc_id"], r["text"]) for r in sf(spark, "documents").collect()]
    for df, rows in ((documents(spark), TEXTS), (sf(spark, "documents"), given)):
        got = sorted((tuple(r) for r in katz.score_documents(df).collect()), key=str)
        want = scores_of(rows)
        assert [g[:5] for g in got] == [w[:5] for w in want]
        np.testing.assert_allclose([g[5:] for g in got], [w[5:] for w in want], rtol=1e-8)
    assert katz.score_documents(nothing(spark)).count() == 0
    only_held_out = [(i, "a b", "en", "s") for i in range(60) if zlib.crc32(str(i).encode()) % 5 == 1]
    assert {(r["n_known"], r["train_tokens"]) for r in katz.score_documents(documents(spark, only_held_out)).collect()} == {(0, 0)}


def test_discounts():
    assert list(katz.discounts([0] * 6)[1:]) == [(r - 0.5) / r for r in range(1, 6)]
    d = katz.discounts([1000, 400, 200, 120, 80, 60])
    assert all(0 < x <= 1 for x in d[1:]) and d[1] < d[5]


@pytest.mark.parametrize("a", [np.zeros(0, np.int64), np.arange(7), np.array([1 << 40, 3]), np.array([1.5, -2.0]), np.array([True, False])])
def test_packed_arrays_come_back(a):
    back = katz.unpack(katz.pack(a))
    assert back.dtype == a.dtype and (back == a).all()


def test_held_out_labels(spark):
    docs, labels = sf(spark, "documents", "/root/testdata/sf0.1"), sf(spark, "labels", "/root/testdata/sf0.1")
    held = F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0
    got = site_quality.classify(docs, labels.where(~held)).select("doc_id", "kept").join(labels.where(held), "doc_id").collect()
    clean = [r["kept"] for r in got if r["quality"] == 1 and r["toxic"] == 0]
    toxic = [r["kept"] for r in got if r["toxic"] == 1]
    bad = [r["kept"] for r in got if r["quality"] == 0]
    assert np.mean(clean) > 0.99 and np.mean(toxic) < 0.15 and np.mean(bad) < 0.1


def test_odd_rows_and_no_labels(spark):
    df = documents(spark)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert sorted((r["doc_id"] or 0, r["kept"]) for r in site_quality.classify(df, none).collect()) == sorted((i or 0, True) for i, *_ in TEXTS)
    labels = spark.createDataFrame([(1, 0, 1), (1, None, None), (9, 1, 0), (None, 0, 0), (77, 1, 1)], "doc_id long, quality int, toxic int")
    assert site_quality.classify(df, labels).count() == len(TEXTS)
    assert site_quality.classify(nothing(spark), labels).count() == 0


def strength_of(groups):
    """Documents that a prior is worth; `groups` has (n, s, mean rate of the parent)."""
    n = sum(g[0] for g in groups)
    seen = sum(g[0] * (g[1] / g[0] - g[2]) ** 2 for g in groups)
    between = (seen - sum(g[2] * (1 - g[2]) for g in groups)) / n
    within = sum(g[2] * (1 - g[2]) * g[0] for g in groups) / n
    least, most = site_quality.STRENGTH
    return min(max(within / between - 1, least), most) if between > 0 else most


def posteriors(rows, weights, constants):
    """Every column by plain loops, given the fitted weights."""
    logit = lambda p: math.log(min(max(p, 1e-9), 1 - 1e-9)) - math.log(1 - min(max(p, 1e-9), 1 - 1e-9))
    chance = lambda x: 1 / (1 + math.exp(-x))
    seen = []
    for i, text, lang, source in rows:
        found = site_quality.features((text or "").encode())
        evidence = [constants[t][0] + sum(w[k] for f, w in weights.items() if f in found) for k, t in enumerate(site_quality.TARGETS)]
        seen.append((i, source or "", "/".join(x for x in (source, lang) if x is not None), evidence))
    out = [[i, host, path] for i, host, path, _ in seen]
    for k, t in enumerate(site_quality.TARGETS):
        own = [chance(e[k] + logit(constants[t][1])) for *_, e in seen]
        by_host, by_path = {}, {}
        for (_, host, path, _), p in zip(seen, own, strict=True):
            for groups, key in ((by_host, host), (by_path, (host, path))):
                n, s = groups.get(key, (0, 0.0))
                groups[key] = n + 1, s + p
        mean = sum(own) / len(own)
        strong = strength_of([(n, s, mean) for n, s in by_host.values()])
        host_rate = {h: (s + strong * mean) / (n + strong) for h, (n, s) in by_host.items()}
        path_strong = strength_of([(n, s, host_rate[h]) for (h, _), (n, s) in by_path.items()])
        for row, (_, host, path, e), p in zip(out, seen, own, strict=True):
            n, s = by_path[host, path]
            rate = (max(0.0, s - p) + path_strong * host_rate[host]) / (n - 1 + path_strong)
            row += [rate, chance(e[k] + logit(rate))]
    return sorted(((i, h, p, pb, pt, rb, rt, pb <= 0.5 and pt <= 0.5) for i, h, p, rb, pb, rt, pt in out), key=lambda r: (str(r[0]), *map(str, r[1:3])))


def test_posteriors_by_brute_force(spark):
    docs, labels = sf(spark, "documents", "/root/testdata/sf0.01"), sf(spark, "labels", "/root/testdata/sf0.01")
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang", "source").collect()]
    weights, constants = site_quality.fit(docs.select("doc_id", "text"), labels)
    assert len(weights) > 20
    expected = posteriors(rows, weights, constants)
    got = sorted((tuple(r) for r in site_quality.classify(docs, labels).collect()), key=lambda r: (str(r[0]), *map(str, r[1:3])))
    assert [(*r[:3], r[-1]) for r in got] == [(*r[:3], r[-1]) for r in expected]
    assert np.allclose([r[3:7] for r in got], [r[3:7] for r in expected], atol=1e-9)


def test_the_fit_is_bounded(spark, monkeypatch):
    """One labelled id on very many rows, with equal and with different texts."""
    rows = [(1, f"bad words here {i % 90} and more" if i % 3 else "the same text", "en", "s") for i in range(600)]
    rows += [(2 + i, f"good text number {i}", "en", "s") for i in range(40)]
    labels = spark.createDataFrame([(1, 0, 0), *((2 + i, 1, 0) for i in range(40))], "doc_id long, quality int, toxic int")
    fitted, plain = [], site_quality.regress
    monkeypatch.setattr(site_quality, "regress", lambda row, col, y, width: fitted.append(len(y)) or plain(row, col, y, width))
    site_quality.fit(documents(spark, rows).select("doc_id", "text"), labels, sample=50)
    assert fitted and max(fitted) <= 50


def test_too_many_words_are_an_error():
    with pytest.raises(ValueError, match="distinct words"):
        katz.Counts({1: 1 << 32})


def test_sparse_paths_are_drawn_to_their_host(spark):
    rows = []
    for host, share in (("good", 0.0), ("poor", 0.9)):
        rows += [(host, f"{host}/big", 6.0 if k < 100 * share else -6.0) for k in range(100)]
        rows += [(host, f"{host}/new", -6.0)]
    df = spark.createDataFrame([(h, p, e, -6.0) for h, p, e in rows], "host string, path string, bad double, toxic double")
    got = {r["path"]: r for r in site_quality.path_rates(df, {"bad": 0.5, "toxic": 0.5}).collect()}
    assert got["good/new"]["host_bad"] < 0.2 < 0.6 < got["poor/new"]["host_bad"]


def test_regression_finds_the_feature_that_tells():
    draw = np.random.default_rng(1)
    x = draw.random((400, 5)) < 0.4
    row, col = np.nonzero(x)
    w, _ = site_quality.regress(row, col, x[:, 2].astype(float), 5)
    assert w.argmax() == 2 and w[2] > 3 and abs(w[[0, 1, 3, 4]]).max() < 1.5
