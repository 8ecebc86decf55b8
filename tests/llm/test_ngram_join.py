"""The Jaccard join against brute force."""

import random

import numpy as np
import pytest
from odd_rows import TEXTS, documents, nothing, sf
from pyspark.sql import functions as F

from enrichlake.llm import common, exact_dedup, ngram_join, quality_rules
from enrichlake.llm import components as components_module
from enrichlake.llm.components import components


def components_of(rows, words=3, percent=90):
    sets = {}
    for i, t, *_ in rows:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + words]) for k in range(len(w) - words + 1)} or ({tuple(w)} if w else set())
    ids = sorted(i for i in sets if i is not None)
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = {}
    for i in ids:
        common_ = {}
        for g in sets[i]:
            for j in holders.setdefault(g, []):
                common_[j] = common_.get(j, 0) + 1
            holders[g].append(i)
        for j, n in common_.items():
            if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return sorted(((i, len(sets[i]), None if i is None else root(i)) for i, *_ in rows), key=str)


def linked(df, **kw):
    return sorted((tuple(r) for r in ngram_join.link(df, **kw).collect()), key=str)


def family_rows():
    draw = random.Random(4)
    vocabulary = [f"w{i}" for i in range(400)]
    bases = [[draw.choice(vocabulary) for _ in range(draw.choice([40, 80, 120]))] for _ in range(8)]
    rows = []
    for k in range(300):
        words = list(draw.choice(bases))
        for _ in range(draw.choice([0, 0, 1, 1, 2, 3])):
            words[draw.randrange(len(words))] = draw.choice(vocabulary)
        if draw.random() < 0.2:
            words = words[: -draw.randrange(1, 6)]
        rows.append((k, " ".join(words), "en", "s"))
    return rows


@pytest.mark.parametrize(("words", "percent"), [(3, 90), (5, 80)])
def test_families_of_near_copies(spark, words, percent):
    rows = family_rows()
    assert linked(documents(spark, rows), words=words, percent=percent) == components_of(rows, words, percent)


def same_prefix_chain(name, edits):
    """A text of 100 shingles and copies of it, each with `edits` further words changed behind the shared prefix."""

    def key(words):
        found = np.sort(ngram_join.shingle_sets([" ".join(words).encode()])[0])
        return len(found), found[: ngram_join.prefix_length(len(found), 90)].tobytes()

    chain, at = [[f"{name}{i}" for i in range(102)]], 3
    for changed in edits:
        words = list(chain[-1])
        while changed:
            tried = [*words[:at], f"{name}x{at}", *words[at + 1 :]]
            if key(tried) == key(words):
                words, changed = tried, changed - 1
            at += 4
        chain.append(words)
    return [" ".join(words) for words in chain]


def test_links_inside_one_prefix_group(spark, monkeypatch):
    # Where all shingles count alike, their hashes order them, and near copies share their whole prefix.
    monkeypatch.setattr(ngram_join, "frequencies", lambda *_: np.zeros(ngram_join.COUNTERS, np.int64))
    chains = [same_prefix_chain("a", [1, 1]), same_prefix_chain("b", [2, 1]), same_prefix_chain("c", [2, 1, 1])]
    rows = [(10 * k + i, text, "en", "s") for k, chain in enumerate(chains) for i, text in enumerate(chain)]
    want = components_of(rows)
    # Member and stray; two strays; strays in a row. Heads are apart from strays.
    assert {i: c for i, _, c in want} == {0: 0, 1: 0, 2: 0, 10: 10, 11: 11, 12: 11, 20: 20, 21: 21, 22: 21, 23: 21}
    assert linked(documents(spark, rows)) == want


def test_heads_that_share_by_chance_meet_no_lead(spark):
    # Of 100 shingles 6 of the prefix have to be shared, of 2 one; leads of one component count together.
    shared = [(1, 100, 9, 9)] + [(2, 100, 9, lead) for lead in (8, 9) * 3] + [(3, 2, 9, 9)] + [(4, 100, main, main) for main in range(20, 30)]
    got = ngram_join.hopeful(spark.createDataFrame(shared, "head long, n long, main long, lead long"), 90)
    assert {tuple(r) for r in got.select("head", "main", "lead", "c").collect()} == {(2, 9, 8, 3), (2, 9, 9, 3), (3, 9, 9, 1)}


def test_only_compared_texts_are_moved(spark, monkeypatch):
    docs = documents(spark, [(i, f"a b c d {i % 4}", "en", "s") for i in range(100)])
    join = ngram_join.Join(docs, "doc_id", "text", 3, 90)
    join.texts = join.scratch.bucketed(docs.select("doc_id", "text").mapInArrow(ngram_join._compressed, "node bigint, packed binary"), "texts", "node")
    kept, moved = common.Scratch.store, {}
    monkeypatch.setattr(common.Scratch, "store", lambda self, df, name: moved.setdefault(name, (kept(self, df, name).cache(), df))[0])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = join.compare(spark.createDataFrame([(4, 0), (8, 0), (5, 0)], "a long, b long"))
        assert {tuple(r) for r in found.select("a", "b", "inter", "linked").collect()} == {(4, 0, 3, True), (8, 0, 3, True), (5, 0, 2, False)}
        texts, df = moved["texts-1"]
        assert sorted(r["node"] for r in texts.collect()) == [0, 4, 5, 8]
        # Buckets stay where they are: the only exchange is that of the ids.
        df.collect()
        assert df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("Exchange") == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_steps_leave_no_tables_behind(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(common.Scratch, "__init__", lambda self, spark, label: self.__dict__.update(spark=spark, folder=f"{tmp_path}/{label}"))
    docs, tables = documents(spark, family_rows()), spark.catalog.listTables()
    kept = ngram_join.kept_documents(docs, words=5, percent=80)
    assert sorted(x.name for x in tmp_path.iterdir()) == ["ngram-kept"]
    assert spark.catalog.listTables() == tables
    assert {r["doc_id"] for r in kept.collect()} == {i for i, _, c in components_of(family_rows(), 5, 80) if i == c}
    exact_dedup.kept_documents(docs)
    assert sorted(x.name for x in tmp_path.iterdir()) == ["exact-dedup-kept", "ngram-kept"]
    quality_rules.kept_documents(docs)
    assert [x.name for x in (tmp_path / "quality-rules").iterdir() if x.is_dir()] == ["references"]


def test_odd_rows_and_given_documents(spark):
    assert linked(documents(spark)) == components_of(TEXTS)
    rows = [(r["doc_id"], r["text"]) for r in sf(spark, "documents").collect()]
    assert linked(sf(spark, "documents")) == components_of(rows)
    assert linked(nothing(spark)) == []
    assert ngram_join.kept_documents(documents(spark)).columns == documents(spark).columns


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 50), (50, 70), (7, 7)]
    got = {tuple(r) for r in components(spark.createDataFrame(edges, "a long, b long"), common.Scratch(spark, "t"), "c").collect()}
    assert got == {(i, 0) for i in range(41)} | {(50, 50), (70, 50), (100, 50)}


def test_components_end_only_when_nothing_changes(spark, monkeypatch):
    # A bound of rounds, were there one, would be over after the first.
    monkeypatch.setattr(components_module, "range", lambda *_: [1], raising=False)
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)], "a long, b long")
    got = {tuple(r) for r in components(edges, common.Scratch(spark, "t"), "c").collect()}
    assert got == {(i, 0) for i in range(41)}
