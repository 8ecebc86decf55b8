"""Token alignment against a plain sweep over both tokenizations."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from odd_rows import TEXTS, documents, nothing, sf
from tokenizers import Tokenizer

from enrichlake.llm import alignment, tokens

COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def both():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def spelt(both, text):
    """(ids, bytes per id) by either tokenizer; empty where they do not spell the text."""
    a, b = both
    chars = tokens._byte_of_char()
    ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
    ids_b = b.encode(text) if text else []
    bytes_a = [bytes(chars[c] for c in a.id_to_token(i)) for i in ids_a]
    names = [b.id_to_piece(i) for i in ids_b]
    bytes_b = [bytes([int(p[3:5], 16)]) if p.startswith("<0x") and p.endswith(">") and len(p) == 6 else p.replace("▁", " ").encode() for p in names]
    if not text or b"".join(bytes_a) != b" " + text.encode() or b"".join(bytes_b) != b" " + text.encode():
        return [], [], [], []
    return ids_a, bytes_a, ids_b, bytes_b


def swept(both, rows):
    counts, per_row = Counter(), []
    for i, text, *_ in rows:
        ids_a, bytes_a, ids_b, bytes_b = spelt(both, text or "")
        ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()
        groups, links, x, y, held = [], [], 0, 0, ([], [])
        while x < len(ids_a):
            links.append((ids_a[x], ids_b[y]))
            end_a, end_b = ends_a[x], ends_b[y]
            if end_a <= end_b:
                held[0].append(ids_a[x])
                x += 1
            if end_b <= end_a:
                held[1].append(ids_b[y])
                y += 1
            if end_a == end_b:
                groups.append(held)
                held = ([], [])
        counts.update(links)
        text = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in groups)
        per_row.append((i, len(ids_a), len(ids_b), groups, links, hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    return [
        (i, na, nb, len(g), len(ln), sum(counts[p] == most[p[1]] for p in ln), sum(counts[p] for p in ln), digest)
        for i, na, nb, g, ln, digest in per_row
    ]


def same(df, rows, both):
    got = sorted((tuple(r) for r in df.withColumnRenamed("id", "doc_id").select(COLUMNS).collect()), key=str)
    assert got == sorted(swept(both, rows), key=str)


ODD = [
    (20, "<|endoftext|> is plain <s> text </s> <unk>", "en", "s"),
    (21, "   leading and trailing   ", "en", "s"),
    (22, "\t\n  mixed   spaces\r\n\n\n end ", "en", "s"),
    (23, "a literal ▁ mark is not spelt back", "en", "s"),
    (24, "ﬁ ligature, é combining, \U0001f600\U0001f468‍\U0001f469 日本語テキスト", "ja", "s"),
    (25, " ", "en", "s"),
    (26, "x" * 300 + " " + "ab " * 200, "en", "s"),
    (27, "nul \x00 and \x1f controls", "en", "s"),
]


def test_odd_rows(spark, both):
    rows = [*TEXTS, *ODD]
    same(alignment.align(documents(spark, rows)), rows, both)


def test_small_blocks_give_the_same(spark, both, monkeypatch):
    rows = [*ODD, *[(100 + k, f"Row {k} of the corpus, with {k * 37} words.", "en", "s") for k in range(60)]]
    before = sorted(map(str, alignment.align(documents(spark, rows)).collect()))
    monkeypatch.setattr(alignment, "BLOCK_BYTES", 64)
    assert sorted(map(str, alignment.align(documents(spark, rows)).collect())) == before


def test_documents(spark, both):
    docs = sf(spark, "documents")
    same(alignment.op11_alignment(spark, "/root/testdata/sf0.001"), [tuple(r) for r in docs.select("doc_id", "text").collect()], both)


def test_no_rows(spark):
    assert alignment.align(nothing(spark)).collect() == []


def test_groups_hold_the_tokens(spark, both):
    rows = [*TEXTS, *ODD]
    for r in alignment.groups(documents(spark, rows)).collect():
        assert (r.a_ends[-1:] or [0])[0] == len(r.a) and (r.b_ends[-1:] or [0])[0] == len(r.b)
        assert len(r.a_ends) == len(r.b_ends) and r.a_ends == sorted(set(r.a_ends))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sets(st.integers(1, 40)), st.sets(st.integers(1, 40))), min_size=1, max_size=4))
def test_cuts_are_the_shared_ends(texts):
    a, b, lo, hi, expected, base = [], [], [], [], [], 0
    for x, y in texts:
        lo.append(len(a))
        a += sorted(base + v for v in x | {41})
        b += sorted(base + v for v in y | {41})
        hi.append(len(a))
        base += 41
    expected = [i + 1 for i, v in enumerate(a) if v in set(b)]
    got = alignment.shared_cuts(np.array(a), np.array(b), np.array(lo), np.array(hi))
    assert got.tolist() == expected
