"""Phrases against brute force, filters against what they hold."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from odd_rows import TEXTS, documents, nothing

from enrichlake.llm import collocations
from enrichlake.llm.collocations import Limits

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_force(rows, limits=Limits()):
    f, n = {}, Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for m in range(1, limits.words + 1):
                f.setdefault(lang, Counter()).update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang, counts in f.items():
        found = {p: a for p, a in counts.items() if len(p) > 1 and a >= limits.occurrences}
        kept = []
        for p, a in found.items():
            longer = [q for q in found if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))]
            if any(100 * found[q] >= limits.contained_percent * a for q in longer):
                continue
            cuts = [(10**6 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            kept.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for r, (score, a, text, left, right) in enumerate(sorted(kept)[: limits.first], 1):
            out.append((lang, r, text.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def corpus(seed=3, n=250):
    draw = random.Random(seed)
    vocabulary = {"en": [f"w{i}" for i in range(25)], "de": [f"ü{i}" for i in range(12)], None: ["x", "y", "Z\x01", "z"]}
    rows = []
    for i in range(n):
        lang = draw.choice([*vocabulary, "en", "en"])
        words = [draw.choice(vocabulary[lang]) for _ in range(draw.randrange(0, 60))]
        for at in range(len(words)):
            if draw.random() < 0.1:
                words[at] = "New York City"
            if draw.random() < 0.1:
                words[at] += draw.choice([".", ",", ";", ":", "!", "?", "\n", "\r", "\v", "\f", "\t"])
        rows.append((i, draw.choice([" ", "  ", "\t"]).join(words), lang, "s"))
    return [*rows, (None, None, "fr", "s"), (n, "", "fr", "s"), (n, "a " * 30, "und", "s")]


def same(spark, rows, limits=Limits()):
    got = sorted(tuple(r) for r in collocations.collocations(documents(spark, rows), limits=limits).collect())
    assert got == brute_force(rows, limits)


def test_brute_force(spark):
    same(spark, [*corpus(), *TEXTS])


def test_longer_phrases_and_other_limits(spark):
    same(spark, corpus(5), Limits(words=4, occurrences=4, contained_percent=30, first=20))


def test_two_words_only(spark):
    same(spark, corpus(6), Limits(words=2))


def test_many_ranges_dealt_in_two_steps(spark, monkeypatch):
    """More ranges than one step deals, several segments, several chunks."""
    for name, value in (("SLOTS", 64), ("FAN_BITS", 2), ("SEGMENT_BYTES", 512), ("CHUNK", 50)):
        monkeypatch.setattr(collocations, name, value)
    same(spark, corpus(7))


def test_no_rows(spark):
    assert collocations.collocations(nothing(spark)).collect() == []
    assert collocations.collocations(documents(spark, [(1, None, "en", "s")])).collect() == []


@settings(max_examples=150, deadline=None)
@given(
    st.integers(1, 40),
    st.integers(2, 4),
    st.lists(st.tuples(st.integers(0), st.integers(1, 2**40)), max_size=60),
    st.integers(0, 3),
)
def test_filters_are_lossless(bits, length, drawn, known):
    known = min(known, bits)
    rows = {tuple((v >> (7 * i)) * 2654435761 % (1 << bits) for i in range(length)): n for v, n in drawn}
    lanes = [np.array([r[i] for r in rows], np.uint64) for i in range(length)]
    counts = np.array(list(rows.values()), np.int64)
    columns, counts = collocations.summed(collocations.packed(collocations.permuted(lanes, bits), bits), counts)
    back = Counter()
    for range_, slots, data in collocations._cut(columns, counts, length, bits, known):
        keys, n = collocations.decoded(data, length, bits, known, range_)
        assert len(n) == slots
        for key, m in zip(zip(*collocations.restored(collocations.unpacked(keys, length, bits), bits), strict=True), n, strict=True):
            back[tuple(map(int, key))] += int(m)
    assert back == Counter(rows)


@pytest.mark.parametrize("n", [5, 50_000])
def test_a_filter_is_compact(n):
    bits, draw = 20, np.random.default_rng(1)
    lanes = [draw.integers(0, 1 << bits, n).astype(np.uint64) for _ in range(3)]
    columns, counts = collocations.summed(collocations.packed(collocations.permuted(lanes, bits), bits), np.ones(n, np.int64))
    data = collocations.encoded(columns, counts, 3, bits, 0)
    assert len(data) < 24 + len(counts) * (2 + 60 - np.log2(len(counts)) + 1 + 8) / 8 + 8
