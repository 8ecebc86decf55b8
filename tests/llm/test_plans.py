"""Mixing, sharding and packing: exact budgets, groups and sequences."""

import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from odd_rows import TEXTS, documents, nothing, sf
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from enrichlake.llm import mixing, packing, sharding, tokens


def test_mixing_agrees_with_sql(spark):
    con = duckdb.connect()
    con.execute("create view documents as select * from '/root/testdata/sf0.001/documents.parquet'")
    cursor = con.execute(mixing.SQL)
    names = [d[0] for d in cursor.description]
    want = Counter(cursor.fetchall())
    assert Counter(tuple(r) for r in mixing.op1_mixing(spark, "/root/testdata/sf0.001").select(names).collect()) == want


@pytest.mark.parametrize(("budget", "epochs"), [(0, 4), (1, 1), (5000, 1), (40_000, 3), (10**9, 2)])
def test_budget_is_met_exactly(spark, budget, epochs):
    docs = sf(spark, "documents")
    supply = mixing.counted(docs, mixing.DOMAIN).agg(F.sum("tokens")).first()[0]
    taken = mixing.mix(docs, mixing.DOMAIN, budget, mixing.WEIGHTS, epochs, 3).agg(F.coalesce(F.sum("taken"), F.lit(0))).first()[0]
    assert taken == min(budget, supply * epochs)


def leaf(domain, lang, source, tokens):
    return [(k, domain, lang, source, 10) for k in range(tokens // 10)]


def test_shortage_goes_to_siblings_first(spark):
    rows = leaf("a", "x", "short", 20) + leaf("a", "x", "long", 500) + leaf("a", "y", "s", 500) + leaf("b", "x", "s", 900)
    df = spark.createDataFrame(rows, "doc_id long, domain string, lang string, source string, tokens long")
    got = {(r["domain"], r["lang"], r["source"]): r["share"] for r in mixing.leaf_shares(df, 400, {}, 1).collect()}
    # Each domain has 200, each language of a 100; what "short" lacks goes to "long" alone.
    assert got == {("a", "x", "short"): 20, ("a", "x", "long"): 80, ("a", "y", "s"): 100, ("b", "x", "s"): 200}
    got = {(r["domain"], r["lang"], r["source"]): r["share"] for r in mixing.leaf_shares(df, 400, {("b",): 0}, 1).collect()}
    assert got == {("a", "x", "short"): 20, ("a", "x", "long"): 180, ("a", "y", "s"): 200}


def test_mixed_documents_are_cut_behind_a_token(spark):
    df = documents(spark)
    out = mixing.mixed_documents(df, "'one'", 3000, {}, 1, 1)
    assert out.columns == df.columns
    texts = [r["text"] for r in out.collect()]
    given = [t or "" for _, t, *_ in TEXTS]
    assert sum(len(t.encode().split()) for t in texts) == 3000
    assert all(any(g.startswith(t) for g in given) for t in texts)
    assert mixing.mix(nothing(spark), "'one'", "supply", {}).count() == 0


@pytest.mark.parametrize(("budget", "epochs"), [(55, 1), (150, 2)])
def test_rows_of_one_id_are_taken_one_by_one(spark, budget, epochs):
    given = [" ".join(f"r{k}w{i}" for i in range(10)) for k in range(10)]
    rows = [(1 if k < 6 else None, t, "en", "s") for k, t in enumerate(given)]
    texts = [r["text"] for r in mixing.mixed_documents(documents(spark, rows), "'one'", budget, {}, epochs, 1).collect()]
    assert sum(len(t.split()) for t in texts) == budget
    # No row comes more than once per epoch, whole or cut.
    assert max(Counter(t.split()[0] for t in texts).values()) == epochs and len(texts) == -(-budget // 10)
    assert sum(t not in given for t in texts) == (budget % 10 > 0)


# --- sharding


@pytest.mark.parametrize("seed", range(60))
def test_runs_are_best_fit_decreasing(seed):
    draw = random.Random(seed)
    counts = Counter()
    for _ in range(draw.randint(1, 60)):
        counts[draw.randint(1, 40)] += draw.choice([1, 1, 2, 5, 9])
    capacity = draw.randint(20, 80)
    runs, bins = sharding.best_fit(dict(counts), capacity)
    rooms = []
    for size in sorted(counts.elements(), reverse=True):
        fitting = [i for i, room in enumerate(rooms) if room >= size]
        if fitting:
            rooms[min(fitting, key=rooms.__getitem__)] -= size
        else:
            rooms.append(max(0, capacity - size))
    filled, seen = Counter(), Counter()
    for size, rank, n, first, each in runs:
        assert rank == seen[size]
        seen[size] += n
        for i in range(n):
            filled[first + i // each] += size
    assert seen == counts and bins == len(rooms) and sorted(max(0, capacity - x) for x in filled.values()) == sorted(rooms)


def test_rows_are_written_once(spark, tmp_path):
    rows = [(1, "one", "en", "s"), (1, "two words", "en", "s"), (None, "three", "en", "s"), (None, "one", "en", "s"), (1, "one", "en", "s"), (2, None, "en", "s"), (3, "", "en", "s")]
    docs = documents(spark, rows)
    sharding.write_shards(docs, f"{tmp_path}/shards", shards=3)
    back = spark.read.parquet(f"{tmp_path}/shards")
    assert Counter((r["doc_id"], r["text"]) for r in back.collect()) == Counter(r[:2] for r in rows)
    assert set(docs.columns) < set(back.columns)
    homes = {}
    for r in back.collect():
        homes.setdefault(r["text"] or "", set()).add(r["_shard"])
    assert all(len(h) == 1 for h in homes.values())


def test_shards(spark):
    hot = [(1000 + i, "a copy of one text " * 20, "en", "s") for i in range(60)]
    given = [(r["doc_id"], r["text"]) for r in sf(spark, "documents").collect()]
    for df, rows in ((documents(spark, TEXTS + hot), TEXTS + hot), (sf(spark, "documents"), given)):
        got = sharding.shard_documents(df).collect()
        size = lambda t: len((t or "").encode()) + 1
        assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter((r[0], size(r[1]), zlib.crc32((r[1] or "").encode())) for r in rows)
        assert {r["shard"] for r in got} <= set(range(8))
        text_of = {r[0]: r[1] or "" for r in rows}
        homes = {}
        slots = {}
        for r in got:
            homes.setdefault(text_of[r["doc_id"]], set()).add(r["shard"])
            slots.setdefault(r["shard"], []).append(r["slot"])
        assert all(len(h) == 1 for h in homes.values())
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    loads = Counter()
    for r in got:
        loads[r["shard"]] += r["size"]
    assert max(loads.values()) - min(loads.values()) < 2000
    assert sharding.shard_documents(nothing(spark)).count() == 0
    fixed = sharding.shard_documents(sf(spark, "documents"), shards=None, capacity=40_000)
    assert fixed.groupBy("shard").agg(F.sum("size").alias("s")).agg(F.max("s")).first()[0] <= 40_000


# --- packing


@pytest.fixture(scope="module")
def whole():
    return Tokenizer.from_file(tokens.default_path())


def test_ids_are_those_of_the_tokenizer(spark, whole):
    odd = ["", " ", "  a", "a  b\n\n c\t d", "x <|endoftext|> y<|endoftext|>", "don't  'll   x \x1c y\x85 z", " \n\n  \n x", "日本語 テスト  x", "a\r\n b", "​᠎ a", "a b  c", "é" * 500 + " !!!???", " " * 5000 + "a"]
    encoder = tokens.ByteLevel(tokens.default_path(), memory=50)
    for text in odd + [r["text"] for r in sf(spark, "documents").limit(80).collect()]:
        assert np.frombuffer(encoder.ids(text), np.uint32).tolist() == whole.encode(text, add_special_tokens=False).ids


def test_ids_of_many_texts(whole, monkeypatch):
    odd = ["", " ", "  a", "a  b\n\n c\t d", "x <|endoftext|> y", "'ll   x \x1c y\x85 z", "a\u3000b \u3000c \x85e \u200bg «h» “x”", "日本語 テスト  x", "é" * 500 + " !!!", " " * 5000 + "a", "a ", "b", " c", "x " + "日" * 70 + " y", " é", "é", ""]
    encoder = tokens.ByteLevel(tokens.default_path())
    want = [whole.encode(text, add_special_tokens=False).ids for text in odd]
    for block in (1 << 20, 3):
        monkeypatch.setattr(tokens, "BLOCK", block)
        assert [np.frombuffer(x, np.uint32).tolist() for x in encoder.many([t.encode() for t in odd])] == want
    assert encoder.many([]) == [] and encoder.many([b""]) == [b""]


def test_equal_pieces_are_encoded_once_and_not_kept(monkeypatch):
    encoder, given = tokens.ByteLevel(tokens.default_path()), []

    class Counting:
        def encode_to_numpy(self, text, **options):
            given.append(len(text))
            return encoding.encode_to_numpy(text, **options)

        def encode_ordinary(self, text):
            given.append(len(text))
            return encoding.encode_ordinary(text)

    encoding, encoder.encoding = encoder.encoding, Counting()
    encoder.many([b" some words again" * 1000] * 20)
    assert sum(given) == len(" some words again") and not encoder and not encoder.before


def test_pieces_and_sequences(spark, whole):
    given = [(r["doc_id"], r["text"]) for r in sf(spark, "documents").collect()]
    for df, rows in ((documents(spark), TEXTS), (sf(spark, "documents"), given)):
        want = Counter()
        for i, text, *_ in rows:
            ids = [*whole.encode(text or "", add_special_tokens=False).ids, 0]
            for k, (start, n) in enumerate(packing.cut_lengths(len(ids), 2048)):
                want[i, k, start, n, zlib.crc32(np.array(ids[start : start + n], "<u4").tobytes())] += 1
        got = packing.pack(df).collect()
        assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
        sequences = {}
        for r in got:
            sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        for places in sequences.values():
            end = 0
            for offset, n in sorted(places):
                assert offset == end
                end += n
            assert end <= 2048
        total = sum(r["length"] for r in got)
        assert len(sequences) <= -(-total // 2048) + 3
    assert packing.pack(nothing(spark)).count() == 0
    row = packing.pack(documents(spark, [(1, "a b", "en", "s")]), with_ids=True).first()
    assert np.frombuffer(row["ids"], np.uint32).tolist() == [*whole.encode("a b").ids, 0]


@pytest.mark.parametrize("seed", range(12))
def test_plan_places_every_piece_once(seed):
    draw = random.Random(seed)
    counts = Counter(draw.choice([draw.randint(1, 2048), draw.randint(1, 200), 2048]) for _ in range(draw.choice([1, 30, 1500])))
    planned = packing.plan_sequences(dict(counts))
    used = Counter()
    for pattern, n in planned:
        assert sum(pattern) <= 2048 and n > 0
        for length in pattern:
            used[length] += n
    assert used == counts
    plan = packing.plan_of(dict(counts))
    places = Counter()
    for length, n in counts.items():
        sequence, offset = plan.look_up(np.full(n, length), np.arange(n))
        for s, o in zip(sequence.tolist(), offset.tolist(), strict=True):
            places.update((s, o + k) for k in {0, length - 1})
    assert max(places.values()) == 1


def test_configurations_cover_the_demand():
    demand = np.zeros(64)
    demand[[10, 20, 31, 50]] = [40, 30, 20, 60]
    found = packing.configurations(demand, 64, rounds=4000, epsilon=0.05)
    covered = Counter()
    for config, x in found:
        assert sum(config) <= 64
        for size in config:
            covered[size] += x
    assert all(covered[size] <= demand[size - 1] * (1 + 1e-9) for size in covered)
    # Most of the demand is left to whole configurations, the rest to best fit.
    assert sum(size * n for size, n in covered.items()) >= 0.6 * sum(d * (i + 1) for i, d in enumerate(demand))
    assert packing.configurations(np.zeros(8), 8) == []
