"""Quality rules and exact dedup against brute force."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from odd_rows import TEXTS, documents, nothing, sf

from enrichlake.llm import common, exact_dedup, quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base_of(text):
    text = text or ""
    words = WORD.findall(text)
    places = {}
    for i in range(len(words) - 7):
        places.setdefault(tuple(words[i : i + 8]), []).append(i)
    covered = {j for at in places.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n = len(words)
    failed = n < 20 or 100 * len(covered) > 30 * n
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed


def measured(df):
    return sorted(((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) for r in df.collect()), key=str)


def test_base_counts(spark):
    rows = [(r["doc_id"], r["text"]) for r in sf(spark, "documents").collect()]
    for df, given in ((documents(spark), TEXTS), (sf(spark, "documents"), rows)):
        got = quality_rules.judge(df)
        assert measured(got) == sorted(((r[0], *base_of(r[1])) for r in given), key=str)
        assert not got.where("base_failed AND kept").count()
    assert quality_rules.judge(nothing(spark)).count() == 0
    assert quality_rules.kept_documents(documents(spark)).columns == documents(spark).columns


def distance(p, q):
    """Jensen-Shannon distance of two dicts of counts."""
    if not sum(p.values()) or not sum(q.values()):
        return 0.0
    p, q = ({k: v / sum(d.values()) for k, v in d.items()} for d in (p, q))
    bits = 0.0
    for k in {*p, *q}:
        a, b = p.get(k, 0), q.get(k, 0)
        bits += sum(x * math.log2(2 * x / (a + b)) for x in (a, b) if x) / 2
    return math.sqrt(max(bits, 0))


def kind(ch):
    if ord(ch) > 127:
        return "beyond"
    if ch.islower():
        return "lower"
    if ch.isupper():
        return "upper"
    if ch.isdigit():
        return "digit"
    if ch in " \t\n\v\f\r":
        return "space"
    return "mark" if ch in ".,;:!?'\"()-" else "rest"


def verdicts(rows, limits=quality_rules.Limits()):
    """(id, class distance, word distance, kept) of each row."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words, kinds = {}, {}
    for _, text, lang, *_ in rows:
        words.setdefault(lang, Counter()).update(WORD.findall((text or "").translate(lower)))
        kinds.setdefault(lang, Counter()).update(map(kind, text or ""))
    out = []
    for i, text, lang, *_ in rows:
        own, n, class_d, word_d = WORD.findall((text or "").translate(lower)), len(WORD.findall(text or "")), 0.0, 0.0
        if sum(words[lang].values()) >= limits.reference_words:
            top = [w for w, _ in sorted(words[lang].items(), key=lambda x: (-x[1], x[0].encode()))[: limits.common_words]]
            seen = Counter(w if w in top else "" for w in own)
            reference = Counter({w: words[lang][w] for w in top})
            reference[""] = sum(words[lang].values()) - sum(reference.values())
            if n >= limits.class_min_words:
                class_d = distance(Counter(map(kind, text)), kinds[lang])
            if n >= limits.word_min_words:
                word_d = distance(seen, reference)
        by_chance = limits.common_words / (8 * math.log(2) * max(n, 1))
        fits = class_d <= limits.class_distance and word_d**2 <= by_chance + limits.word_distance**2
        out.append((i, round(class_d, 9), round(word_d, 9), fits and not base_of(text)[-1]))
    return sorted(out, key=str)


def test_verdicts(spark):
    """Both distances and what is kept, NULL and empty languages apart."""
    draw = random.Random(8)
    words = [f"w{chr(97 + i)}" for i in range(26)]
    mixed = [(200 + i, " ".join(draw.choice(words) for _ in range(draw.choice([30, 60, 120, 400]))), draw.choice([None, ""]), "s") for i in range(80)]
    shouted = [(i + 1000, t.upper(), lang, s) for i, t, lang, s in mixed[:5]]
    for rows in ([*TEXTS, *mixed, *shouted], [tuple(r) for r in sf(spark, "documents").select("doc_id", "text", "lang", "source").collect()]):
        df = documents(spark, rows)
        got = [(r.doc_id, round(r.class_distance, 9), round(r.word_distance, 9), r.kept) for r in quality_rules.judge(df).collect()]
        expected = verdicts(rows)
        assert sorted(got, key=str) == expected and len({r[1] for r in expected}) > 3
        kept = sorted((r.doc_id for r in quality_rules.kept_documents(df).collect()), key=str)
        assert kept == sorted((r[0] for r in expected if r[3]), key=str)


def test_divergent_documents_go(spark):
    draw = random.Random(5)
    words = ["the", "of", "and", "to"] * 6 + [f"word{chr(97 + i)}{chr(97 + j)}" for i in range(12) for j in range(12)]
    clean = [(i, " ".join(draw.choice(words) for _ in range(150)) + ".", "en", "s") for i in range(60)]
    junk = [(100, clean[0][1].upper().replace(" ", "!! "), "en", "s"), (101, " | ".join(f"cell{i}" for i in range(200)), "en", "s")]
    short = [(102, "ALL CAPITALS BUT FAR TOO SHORT TO BE JUDGED BY A HISTOGRAM OF ITS CHARACTERS SO IT STAYS WHERE IT IS NOW OK", "en", "s")]
    other = [(103, clean[1][1].upper(), "xx", "s")]  # its language has too little text for a reference
    got = {r["doc_id"] for r in quality_rules.kept_documents(documents(spark, clean + junk + short + other)).collect()}
    assert got == {*range(60), 102, 103}


def test_js_distance():
    assert quality_rules.js_distance(np.array([1.0, 0]), np.array([0, 2.0])) == pytest.approx(1)
    assert quality_rules.js_distance(np.array([1.0, 3]), np.array([2.0, 6])) == pytest.approx(0)
    assert quality_rules.js_distance(np.array([0.0, 0]), np.array([2.0, 6])) == 0


def dedup_of(rows):
    groups = {}
    for i, t, *_ in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((-len(t or ""), i is None, i))
    out = []
    for i, t, *_ in rows:
        plain = re.sub(r"[\x20\x09-\x0D]", "", t or "")
        keep = min(groups[plain], key=lambda x: (x[0], x[1], x[2] or 0))[2]
        out.append((i, keep, len(groups[plain]), i == keep, hashlib.sha256(plain.encode()).hexdigest()))
    return sorted(out, key=str)


def test_exact_dedup(spark):
    rows = [(r["doc_id"], r["text"]) for r in sf(spark, "documents").collect()]
    for df, given in ((documents(spark), TEXTS), (sf(spark, "documents"), rows)):
        assert sorted((tuple(r) for r in exact_dedup.decisions(df).collect()), key=str) == dedup_of(given)
    assert exact_dedup.decisions(nothing(spark)).count() == 0
    kept = exact_dedup.kept_documents(documents(spark))
    assert kept.columns == documents(spark).columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter({r[0] for r in dedup_of(TEXTS) if r[3]})


def test_kept_rows_share_an_id_or_have_none(spark):
    given = [
        (None, "alpha beta"), (6, "alphabeta"), (None, "gamma"), (None, "gamma"), (None, "delta"), (None, None),
        (5, "one text"), (5, "another text"), (4, "a copy"), (5, "a copy"), (None, "a copy"), (7, "a b"), (7, "a  b"), (0, "zero"),
    ]
    kept = exact_dedup.kept_documents(documents(spark, [(*r, "en", "s") for r in given]))
    want = [(None, "alpha beta"), (None, "gamma"), (None, "delta"), (None, None), (5, "one text"), (5, "another text"), (4, "a copy"), (7, "a  b"), (0, "zero")]
    assert Counter((r["doc_id"], r["text"]) for r in kept.collect()) == Counter(want)


def test_history_does_not_change_groups(spark):
    rows = exact_dedup.digested(sf(spark, "documents"))
    whole = {tuple(r) for r in exact_dedup.group_documents(rows, common.Scratch(spark, "t")).select("digest", "keep_id", "keep_len", "size").collect()}
    old = rows.id % 3 == 0
    split = exact_dedup.group_documents(rows.where(~old), common.Scratch(spark, "t"), rows.where(old), keys_per_shard=16)
    assert {tuple(r) for r in split.select("digest", "keep_id", "keep_len", "size").collect()} == whole


@pytest.mark.parametrize("n", [0, 1, 2, 500])
def test_perfect_hash_is_minimal(n):
    digests = np.frombuffer(b"".join(hashlib.sha256(str(i).encode()).digest() for i in range(n + 50)), np.uint8).reshape(-1, 32).copy()
    levels, slot = exact_dedup.build_levels(digests[:n])
    assert sorted(slot) == list(range(n))
    assert list(exact_dedup.find_slots(levels, digests[:n])) == list(slot)
    # Digests that were not indexed may get a slot; the digest held there tells them apart.
    found = exact_dedup.find_slots(levels, digests[n:])
    held = digests[:n][np.argsort(slot)]
    assert not any((held[s] == d).all() for s, d in zip(found, digests[n:], strict=True) if s >= 0)


def test_counts_of_a_language_are_handed_on_in_time(monkeypatch):
    monkeypatch.setattr(quality_rules, "HELD_WORDS", 50)
    monkeypatch.setattr(quality_rules, "PART_BYTES", 100)
    rows = [(" ".join(f"W{(i * k) % 97}" for k in range(20)), ("=en", "null")[i % 2]) for i in range(200)] + [(None, "=xx")]
    batch = pa.RecordBatch.from_arrays([pa.array([t for t, _ in rows]), pa.array([x for _, x in rows])], names=["text", "lang"])
    want, got = Counter(), Counter()
    for text, lang in rows:
        want.update((lang, w.encode().lower(), None) for w in (text or "").split())
        for k, n in enumerate(quality_rules.class_counts((text or "").encode())):
            want[lang, None, k] += int(n)
    for part in quality_rules._language_counts([batch]):
        assert part.num_rows <= 50 + 20
        for lang, word, kind, n in zip(*(c.to_pylist() for c in part.columns), strict=True):
            got[lang, word, kind] += n
    assert got == want


def test_a_text_is_digested_once_when_rows_are_handed_on(spark):
    plan = exact_dedup.kept_documents(documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
