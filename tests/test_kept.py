"""Failing field jobs, kept history, kept resolution, many profiles, dictionary tables."""

import os
import random
import re
from itertools import product

import pytest
from pyspark.sql import functions as F

from enrichlake.operators import entities, icp, icp_many, page_fields, resolve
from enrichlake.operators.drift import drift_flags
from enrichlake.operators.page_structure import _alias_grams, _text_grams, dictionary_match, dictionary_match_table
from enrichlake.plans import history as history_module
from enrichlake.plans import pages as plan
from enrichlake.plans import resolution as resolution_module
from enrichlake.plans.history import History
from enrichlake.plans.resolution import Resolution
from enrichlake.sources import readers, writers
from enrichlake.streaming.drift import closing_row, drift_stream, late_rows

PAGE = "Acme Corp is a software company with many happy clients in the whole world and more words to come here."


# --- E16, Q2 ----------------------------------------------------------------------
def failing_jobs():
    def words_or_fail(text):
        if "fails" in text:
            raise KeyError("no words")
        return [text.split()[0], None]

    raises = F.when(F.contains("_md", F.lit("fails")), F.raise_error(F.lit("stop")).cast("int")).otherwise(F.length("_md"))
    return (
        page_fields.python_job("first_word", words_or_fail, "array<string>"),
        page_fields.FieldJob("size", lambda: page_fields.FieldResult(raises, F.lit("markdown"), {"size_twice": raises * 2}), isolated=True),
        page_fields.FieldJob("named", lambda: page_fields.FieldResult(F.lit(1), error=F.when(F.col("page_id") == 2, "two"))),
        page_fields.FieldJob("after", lambda: page_fields.FieldResult(F.col("size") + 1), depends_on=("size",)),
        *page_fields.PAGE_JOBS,
    )


def test_a_failing_job_touches_its_page_only(spark):
    pages = spark.createDataFrame(
        [(1, PAGE, "https://a.com"), (2, PAGE + " It fails.", "https://b.com"), (3, "", None), (4, None, None)],
        "page_id long, markdown string, source_url string",
    )
    rows = {r["page_id"]: r for r in plan.gate_pages(pages, jobs=failing_jobs()).collect()}
    plain = {r["page_id"]: r for r in plan.gate_pages(pages).collect()}
    for i, r in rows.items():
        for c in ("domain_normalize", "is_valid_row", "rejection_reasons", "quality_score", "company_description_extract"):
            assert r[c] == plain[i][c], c
    assert rows[1]["first_word"] == ["Acme", None] and rows[1]["size"] == len(PAGE) and rows[1]["size_twice"] == 2 * len(PAGE)
    assert rows[1]["field_errors"] == [] and rows[1]["after"] == len(PAGE) + 1
    assert [tuple(e) for e in rows[2]["field_errors"]] == [
        ("first_word", "KeyError: 'no words'"), ("size", "size: evaluation raised an error"), ("named", "two")
    ]
    assert rows[2]["first_word"] is None and rows[2]["size"] is None and rows[2]["size_twice"] is None and rows[2]["after"] is None
    report = {r["field"]: (r["ran"], r["is_empty"], r["source"]) for r in rows[2]["function_report"]}
    assert report["size"] == (False, True, None) and report["named"] == (False, True, None) and report["after"] == (True, True, None)
    assert report["domain_normalize"] == (True, False, "context")
    assert rows[3]["field_errors"] == [] and rows[4]["field_errors"] == [] and rows[3]["function_report"] == []
    assert not any(c.endswith(("_error", "_src")) for c in rows[1].asDict())


def test_failing_jobs_read_the_pages_once(spark, tmp_path):
    spark.createDataFrame([(1, PAGE, None)], "page_id long, markdown string, source_url string").write.parquet(f"{tmp_path}/p")
    rows = plan.gate_pages(spark.read.parquet(f"{tmp_path}/p"), jobs=failing_jobs())
    text = rows._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1 and text.count("ArrowEvalPython") == 1 and "Exchange" not in text


# --- Q10, S9, Q14 -----------------------------------------------------------------
KIND = "field string, ts timestamp, seq long, is_empty boolean"


def observed(spark, rows):
    return spark.createDataFrame(rows, "field string, ts long, seq long, is_empty boolean").withColumn("ts", F.timestamp_seconds("ts"))


def flags_of(df):
    return sorted(((r["field"], r["seq"], r["previous"], r["previous_empty"], bool(r["drifting"])) for r in df.collect()), key=str)


def some_rows(n=400, seed=1):
    draw = random.Random(seed)
    return [(draw.choice(["a", "a", "b", "ns:a", None]), i // 3, i, draw.random() < 0.1) for i in range(n)]


def test_deliveries_equal_one_run(spark, tmp_path):
    rows = some_rows()
    kept = History(spark, f"{tmp_path}/h")
    assert kept.latest() is None and kept.tails().count() == 0 and kept.observations().count() == 0
    cuts = [0, 150, 153, 153, 300, 400]  # one delivery holds nothing
    for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
        kept.deliver(observed(spark, rows[a:b]), f"d{k}")
    together = flags_of(drift_flags(observed(spark, rows)))
    assert sorted((x for k in range(5) for x in flags_of(kept.flags(f"d{k}"))), key=str) == together
    assert kept.observations().count() == 400
    sizes = {r["field"]: r["count"] for r in kept.tails().groupBy("field").count().collect()}
    assert max(sizes.values()) == 19 and set(sizes) == {"a", "b", "ns:a", None}


def test_a_repeated_delivery_counts_once(spark, tmp_path):
    rows = some_rows(200)
    kept = History(spark, f"{tmp_path}/h")
    for batch, part in (("x", rows[:90]), ("y", rows[:50]), ("y", rows[90:]), ("y", rows[90:])):
        kept.deliver(observed(spark, part), batch)
    assert sorted(flags_of(kept.flags("x")) + flags_of(kept.flags("y")), key=str) == flags_of(drift_flags(observed(spark, rows)))
    assert kept.observations().count() == 200 and kept.log().count() == 2 and kept.latest() == "y"


def test_what_arrives_late_stands_behind_what_was_there(spark, tmp_path):
    first = [("a", 1000 + i, i, False) for i in range(10)]
    late = [("a", 5, 99, True)]
    kept = History(spark, f"{tmp_path}/h")
    kept.deliver(observed(spark, first), "1")
    assert flags_of(kept.deliver(observed(spark, late), "2")) == [("a", 99, 10, 0, True)]
    assert [r["seq"] for r in kept.tails().orderBy("place").collect()] == [99, *range(9, -1, -1)]


def test_a_delivery_reads_no_earlier_observations(spark, tmp_path, monkeypatch):
    kept = History(spark, f"{tmp_path}/h")
    kept.deliver(observed(spark, some_rows(100)), "1")
    scanned = []

    def watched(both, window):
        scanned.extend(f for f in both.inputFiles())
        return drift_flags(both, window)

    monkeypatch.setattr(history_module, "drift_flags", watched)
    kept.deliver(observed(spark, some_rows(50, 2)), "2")
    assert any("observations/batch=2" in f for f in scanned) and any("tails/batch=1" in f for f in scanned)
    assert not any("observations/batch=1" in f for f in scanned)


def test_history_writes_one_file_per_field(spark, tmp_path):
    rows = observed(spark, [("a", i, i, False) for i in range(500)] + [("b", i, i, True) for i in range(5)]).repartition(8)
    for _ in range(2):
        writers.append_quality_history(rows, f"{tmp_path}/h", "b1")
    files = spark.read.parquet(f"{tmp_path}/h").inputFiles()
    assert len(files) == 2 and spark.read.parquet(f"{tmp_path}/h").count() == 505


def test_a_batch_over_a_kept_history(spark, tmp_path):
    rows = [(i, PAGE, f"https://s{i}.com" if i < 30 or i % 7 else None) for i in range(60)]
    pages = spark.createDataFrame(rows, "page_id long, markdown string, source_url string")
    stamp = F.lit("2026-01-01").cast("timestamp")
    whole = {r["page_id"]: r["drift_warnings"] for r in plan.process_batch(pages, run_timestamp=stamp).collect()}
    kept = History(spark, f"{tmp_path}/h")
    got = plan.process_delivery(pages.where("page_id < 25"), kept, "1", run_timestamp=stamp).collect()
    got += (again := plan.process_delivery(pages.where("page_id >= 25"), kept, "2", run_timestamp=stamp).collect())
    assert {r["page_id"]: r["drift_warnings"] for r in got} == whole and any(whole.values())
    order = [(not r["is_valid_row"], r["page_id"]) for r in again]
    assert order == sorted(order)


# --- R1 kept ----------------------------------------------------------------------
RULES = {
    "name": resolve.Rule((resolve.Criterion("static_rank", ("x", "y")),), "lower_strip"),
    "year": resolve.Rule((resolve.Criterion("majority_vote"), resolve.Criterion("most_recent")), "int"),
    "town": resolve.Rule((resolve.Criterion("prefer_structured"), resolve.Criterion("highest_confidence"))),
}
CANDIDATE = "entity_id long, field string, ord long, source string, value string, is_structured boolean, observed_at string, confidence double"


def candidates(n=600, seed=3):
    draw = random.Random(seed)
    values = ["A", " a", "b", "", None, "12", "+12", "c"]
    return [
        (draw.choice([*range(25), None]), draw.choice(["name", "year", "town", "free"]), i, draw.choice("xyz"), draw.choice(values),
         draw.random() < 0.3, draw.choice(["2026-01-01", "2025-05-05", "", None]), draw.choice([0.1, 0.5, None]))
        for i in range(n)
    ]


def resolved(df):
    return sorted(map(str, (tuple(r[c] for c in ("entity_id", "field", "value", "source", "conflict", "ambiguous", "candidate_count")) for r in df.collect())))


def test_deliveries_resolve_like_one_run(spark, tmp_path):
    rows = candidates()
    kept = Resolution(spark, f"{tmp_path}/r", RULES, buckets=4)
    frame = lambda part: spark.createDataFrame(part, CANDIDATE)
    assert kept.resolved().count() == 0
    for name, part in (("a", rows[:200]), ("b", rows[200:210]), ("c", rows[300:]), ("b", rows[200:300]), ("c", rows[300:]), ("d", [])):
        kept.deliver(frame(part), name)
    assert resolved(kept.resolved()) == resolved(resolve.resolve_candidates(frame(rows), RULES))


def test_a_new_version_takes_entities_away(spark, tmp_path):
    kept = Resolution(spark, f"{tmp_path}/r", RULES, buckets=2)
    row = lambda e, v: (e, "name", 0, "x", v, False, None, None)
    kept.deliver(spark.createDataFrame([row(1, "one"), row(2, "two")], CANDIDATE), "a")
    again = kept.deliver(spark.createDataFrame([row(2, "zwei")], CANDIDATE), "a")
    assert [(r["entity_id"], r["value"]) for r in again.collect()] == [(2, "zwei")]
    assert [(r["entity_id"], r["value"]) for r in kept.resolved().collect()] == [(2, "zwei")]


def test_untouched_entities_are_left_out(spark, tmp_path, monkeypatch):
    kept = Resolution(spark, f"{tmp_path}/r", RULES, buckets=4)
    rows = candidates()
    kept.deliver(spark.createDataFrame(rows, CANDIDATE), "a")
    seen = []

    def watched(groups, chains):
        seen.extend(r[0] for r in groups.select("entity_id").distinct().collect())
        return resolve.merge_marks(groups, chains)

    monkeypatch.setattr(resolution_module, "merge_marks", watched)
    kept.deliver(spark.createDataFrame([r for r in candidates(60, 9) if r[0] in (3, 4)], CANDIDATE), "b")
    assert set(seen) <= {3, 4} and seen


# --- B6, B7 for many profiles --------------------------------------------------------
def some_profiles():
    draw = random.Random(5)
    some = lambda *xs: tuple(draw.sample(xs, min(len(xs), draw.choice([0, 0, 1, 2]))))
    out = []
    for i in range(40):
        out.append(icp.Icp(
            f"c{i}", "n", industries=some("Banking", "Retail", "Ünknown"), company_size_buckets=some("11-50", "51-200"),
            hq_countries=some("DE", "FR", "US"), hq_cities=some("Berlin", "Paris"), technologies=some("Seg", "AWS"),
            description_keywords=some("SaaS", "é", "nothing such", "data pl"), products_and_services=some("data tools", "shipping-lines of old", "!!"),
            exclude_domains=some("d1.com", "d2.com"), people_job_title_include=some("Head of Sales", "Engineer"), people_job_title_exclude=some("Junior"),
        ))
    return [*out, icp.Icp("none", "n"), icp.Icp("empty keyword", "n", description_keywords=("",), industries=("Banking",))]


def some_companies(spark):
    draw = random.Random(6)
    place = lambda: {"is_headquarters": draw.random() < 0.6, "country_name": draw.choice(["DE", "FR", "US", None]), "city": draw.choice(["Berlin", "Paris", None])}
    rows = []
    for i in range(120):
        rows.append((
            i if i != 7 else None, draw.choice(["Banking", "Banking", "Retail", None]), draw.choice(["11-50", "51-200", None]),
            [place() for _ in range(draw.choice([0, 1, 2]))] if i % 11 else None,
            [{"vendor": draw.choice(["Seg", "x", None]), "product": draw.choice(["AWS", "y"])}] if i % 13 else None,
            draw.choice(["Data tools for all", "old SHIPPING lines", "", None]), draw.choice(["A SaaS data platform", "Café é", "none", "", None]),
            draw.choice(["d1.com", "d2.com", "d3.com", None]),
        ))
    kind = (
        "company_id long, industry string, company_size string, locations array<struct<is_headquarters:boolean,country_name:string,city:string>>, "
        "technographics array<struct<vendor:string,product:string>>, products_and_services string, description string, domain string"
    )
    return spark.createDataFrame(rows, kind)


def profile_table(spark, specs):
    kind = ", ".join(f"{c} array<string>" for c in icp.LIST_FIELDS)
    return spark.createDataFrame([(s.client_id, s.name, *(list(getattr(s, c)) for c in icp.LIST_FIELDS)) for s in specs], f"client_id string, name string, {kind}")


def test_many_profiles_equal_single_ones(spark):
    specs, companies = some_profiles(), some_companies(spark)
    table = profile_table(spark, specs)
    listed = {r["client_id"] for r in icp_many.unbounded_profiles(table).collect()}
    assert "none" in listed and "empty keyword" not in listed
    expected = sorted(
        (s.client_id, r["company_id"])
        for s in specs
        if s.client_id not in listed
        for r in icp.icp_filter_companies(companies, s).where("company_id IS NOT NULL").select("company_id").collect()
    )
    assert sorted(map(tuple, icp_many.match_companies(companies, table).collect())) == expected and len(expected) > 50


def test_many_profiles_of_people(spark):
    specs = some_profiles()
    company = F.struct("industry", "company_size", "locations", "technographics", "products_and_services", "description")
    role = lambda current, title: F.struct(F.lit(current).alias("is_current"), title.alias("job_title"), company.alias("company"))
    title = F.element_at(F.array(*[F.lit(x) for x in ("Head of Sales", "junior engineer", "Chief of Staff", "Engineer")]), (F.col("company_id") % 4 + 1).cast("int"))
    people = some_companies(spark).select(F.col("company_id").alias("person_id"), F.array(role(False, F.lit("Engineer")), role(True, title)).alias("experiences"))
    expected = sorted((s.client_id, r[0]) for s in specs for r in icp.icp_filter_people(people, s).where("person_id IS NOT NULL").select("person_id").collect())
    assert sorted(map(tuple, icp_many.match_people(people, profile_table(spark, specs)).collect())) == expected and expected


# --- X5 with a table ----------------------------------------------------------------
CATALOG = (
    ("NODE", "js", ("node.js", "Node JS")),
    ("CPP", "lang", ("c++ builder", "gcc")),
    ("CLOUD", None, ("cloud",)),
    ("STORE", "infra", ("cloud storage", "blob")),
    ("DOT", "x", (".net core",)),
)
TEXTS = [
    "We run Node.js and node   js on the Cloud Storage.", "nodexjs, clouds and gccx", "C++ Builder\nand GCC", None, "", "The .NET Core, a.net core", "blob blob BLOB",
    "node\n\tjs", "Cloud", "Cloud",
]


def test_dictionary_table_equals_the_compiled_catalog(spark):
    docs = spark.createDataFrame([*enumerate(TEXTS), (None, "a cloud"), (0, "a blob"), (0, "a blob")], "id long, txt string")
    rows = [(i, code, category, alias) for i, (code, category, aliases) in enumerate(CATALOG) for alias in aliases]
    table = spark.createDataFrame([*rows, (9, "NONE", None, None), (10, "BLANK", None, "  "), (11, "SIGNS", None, "++")], "ord long, code string, category string, alias string")
    got = sorted(map(str, (tuple(r[c] for c in ("id", "code", "category")) for r in dictionary_match_table(docs, table, "id", "txt").collect())))
    assert got == sorted(map(str, (tuple(r[c] for c in ("id", "code", "category")) for r in dictionary_match(docs, CATALOG, "id", "txt").collect())))
    assert dictionary_match_table(docs.limit(0), table, "id", "txt").count() == dictionary_match_table(docs, table.limit(0), "id", "txt").count() == 0


def test_aliases_meet_texts_on_neighbouring_words(spark):
    """Common words that stand apart in a text must not make it a candidate."""
    words = lambda text, grams: set(spark.range(1).select(grams(F.lit(text)).alias("g")).first()["g"])
    text = words("the red of the blue", _text_grams)
    assert not words("the of", _alias_grams) & text and not words("red blue", _alias_grams) & text
    assert words("of the", _alias_grams) <= text and words("blue", _alias_grams) <= text and len(words("the red of", _alias_grams)) == 2


def test_dictionary_table_keeps_word_boundaries(spark):
    texts = ["a.net core", "x .net core", "c++ builder", "cc++ builder", "node\u0001.js", "a\u0001b", "node.js", "node\u0001.net core", "red, blue", "red\n blue red blue", "été red"]
    aliases = [(1, "A", None, ".net core"), (2, "B", "k", "c++ builder"), (3, "C", "k", "node"), (4, "D", "k", "a\u0001b"), (5, "E", "k", "red  Blue"), (5, "E", "k", "red"), (6, "F", "k", "t"), (6, "F", "k", "tÉ")]
    docs, table = spark.createDataFrame([*enumerate(texts)], "id long, txt string"), spark.createDataFrame(aliases, "ord long, code string, category string, alias string")
    got = dictionary_match_table(docs, table, "id", "txt").collect()
    plain = [re.sub(r"\s+", " ", x.lower()) for x in texts]
    expected = {(i, o, c, k) for i, x in enumerate(plain) for o, c, k, a in aliases if re.search(rf"\b{re.escape(re.sub(r'\s+', ' ', a.lower()))}\b", x)}
    assert len(got) == len(expected) and set(map(tuple, got)) == expected


# --- S4 -----------------------------------------------------------------------------
@pytest.mark.parametrize("quoted_breaks", [True, False])
def test_spine_with_line_breaks_in_cells(spark, tmp_path, quoted_breaks):
    (tmp_path / "s.csv").write_text('company_id,name,domain,linkedin_url\n1,"A\n""B"", C",a.com,u\n2,D,d.com,v\n', encoding="utf-8")
    rows = readers.read_spine_csv(spark, f"{tmp_path}/s.csv", quoted_breaks=quoted_breaks).collect()
    assert len(rows) == (2 if quoted_breaks else 3)
    if quoted_breaks:
        assert rows[0]["name"] == 'A\n"B", C'


# --- E10, R10 across rows -----------------------------------------------------------
def ends_of(links):
    parent = dict(links)
    out = {}
    for e in {*parent, *(p for p in parent.values() if p is not None)}:
        way, at = [], e
        while at not in way and parent.get(at) not in (None, at):
            way.append(at)
            at = parent[at]
        circular = at in way
        out[e] = (min(way[way.index(at) :]), True) if circular else (at, False)
    return sorted((e, *r) for e, r in out.items())


@pytest.mark.parametrize("seed", [0, 1])
def test_roots_of_chains_and_circles(spark, seed):
    draw = random.Random(seed)
    links = [(f"n{i}", draw.choice([None, f"n{i}", "outside", *(f"n{draw.randrange(60)}" for _ in range(6))])) for i in range(60)]
    links += [(f"c{i}", f"c{i + 1}") for i in range(37)] + [(f"r{i}", f"r{(i + 1) % 23}") for i in range(23)] + [("tail", "r5"), ("tail2", "tail")]
    got = entities.entity_roots(spark.createDataFrame([*links, (None, "x")], "entity string, parent string"))
    assert sorted(map(tuple, got.collect())) == ends_of(links)


def test_no_links(spark):
    assert entities.entity_roots(spark.createDataFrame([], "entity string, parent string")).count() == 0


def test_parents_by_most_pages(spark):
    kind = "company_entity_resolve struct<domain:string,company_name:string,parent_guess:string>"
    rows = [(("a.com", None, "Big Co"),), (("a.com", "A", "Big Co"),), (("a.com", None, "Other"),), (("b.com", None, None),), (("c.com", None, "Y"),), (("c.com", None, "X"),), (None,)]
    got = entities.parent_links(spark.createDataFrame(rows, kind))
    assert sorted(map(tuple, got.collect())) == [("a-com", "big-co"), ("b-com", None), ("c-com", "x")]


def best_links(employers, companies, percent=50):
    words = lambda n: tuple(sorted({w for w in "".join(ch if ch.isalnum() else " " for ch in (n or "").lower()).split() if w not in ("corp", "inc")}))
    firms = {}
    for i, n in companies:
        if i is not None and words(n):
            firms[i] = tuple(sorted({*firms.get(i, ()), *words(n)}))
    held = {}
    for ws in firms.values():
        for w in ws:
            held[w] = held.get(w, 0) + 1
    weight = lambda w: max(1, 1_000_000 // held[w]) if w in held else 1_000_000
    score = {}
    for e, (c, ws) in product({words(n) for n in employers} - {()}, firms.items()):
        shared = sum(weight(w) for w in e if w in ws)
        joint = sum(map(weight, {*e, *ws}))
        if shared and 100 * shared >= percent * joint:
            score[e, c] = 1_000_000 * shared // joint

    def only(i, side):
        own = {k: s for k, s in score.items() if k[side] == i}
        top = [k for k, s in own.items() if s == max(own.values())]
        return top[0] if len(top) == 1 else None

    out = []
    for n in employers:
        k = only(words(n), 0)
        out.append((n, k[1], score[k]) if k and only(k[1], 1) == k else (n, None, None))
    return sorted(out, key=str)


def test_employers_link_to_their_best_company(spark):
    draw = random.Random(4)
    vocabulary = [f"w{i}" for i in range(14)] + ["the", "the", "group"]
    name = lambda: " ".join(draw.choice(vocabulary) for _ in range(draw.randrange(1, 5))) + draw.choice(["", " Corp", ", Inc."])
    companies = [(i, name()) for i in range(40)] + [(None, "w1"), (50, None), (51, "!!")]
    employers = [name() for _ in range(150)] + [None, "", "Corp", "unheard of"]
    people = spark.createDataFrame([(e,) for e in employers], "employed_company string")
    got = entities.company_person_scored(people, spark.createDataFrame(companies, "company_id long, name string"))
    found = sorted((tuple(r) for r in got.select("employed_company", "linked_company_id", "link_score").collect()), key=str)
    assert found == best_links(employers, companies) and sum(r[1] is not None for r in found) > 5


# --- Q10 as a stream ------------------------------------------------------------------
def streamed(spark, folder, deliveries, delay):
    """Write each delivery as files, stream them in, close the stream; (flags, late rows)."""
    schema = "field string, ts timestamp, seq long, is_empty boolean"
    for part in deliveries:
        observed(spark, part).repartition(2).write.mode("append").parquet(f"{folder}/in")
        query = drift_stream(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in"), f"{folder}/out", f"{folder}/ck", delay)
        query.awaitTermination()
        yield late_rows(query)
    closing_row(observed(spark, [])).write.mode("append").parquet(f"{folder}/in")
    drift_stream(spark.readStream.schema(schema).parquet(f"{folder}/in"), f"{folder}/out", f"{folder}/ck", delay).awaitTermination()
    yield 0


def test_a_shuffled_stream_equals_the_batch(spark, tmp_path):
    rows = [(f, 1000 + ts, *more) for f, ts, *more in some_rows(120)]
    shuffled = random.Random(2).sample(rows, len(rows))
    assert sum(streamed(spark, tmp_path, [shuffled[:70], shuffled[70:]], "1000 seconds")) == 0
    assert flags_of(spark.read.parquet(f"{tmp_path}/out")) == flags_of(drift_flags(observed(spark, rows)))


def test_late_observations_are_counted(spark, tmp_path):
    rows = [("a", 1000 + i, i, False) for i in range(100)]
    late = sum(streamed(spark, tmp_path, [rows, [("a", 1003, 999, True), ("a", 1099, 1000, True)], [("a", 1004, 998, True)]], "200 seconds"))
    assert late == 0
    kept = [*rows, ("a", 1003, 999, True), ("a", 1004, 998, True), ("a", 1099, 1000, True)]
    assert flags_of(spark.read.parquet(f"{tmp_path}/out")) == flags_of(drift_flags(observed(spark, kept)))
    other = tmp_path / "strict"
    late = sum(streamed(spark, other, [rows[:50], rows[50:], [("a", 1003, 999, True), ("a", 1099, 1000, True)], [("a", 1004, 998, True)]], "60 seconds"))
    assert late == 2
    kept = [*rows, ("a", 1099, 1000, True)]
    tmp_path = other
    assert flags_of(spark.read.parquet(f"{tmp_path}/out")) == flags_of(drift_flags(observed(spark, kept)))


def test_waiting_observations_lie_in_tables(spark, tmp_path):
    """A field's backlog is neither a state in memory nor one task; its folders are replaced as the stream goes on."""
    rows = [("a", 1000 + i, i, i % 7 == 0) for i in range(60)] + [("a", None, 900 + i, True) for i in range(3)]
    assert sum(streamed(spark, tmp_path, [rows[:30], rows[30:]], "1000 seconds")) == 0
    assert not os.path.exists(f"{tmp_path}/ck/state")
    assert len(os.listdir(f"{tmp_path}/ck/drift/waiting")) == 2
    # Rows without a time come first and wait for nothing.
    assert flags_of(spark.read.parquet(f"{tmp_path}/out")) == flags_of(drift_flags(observed(spark, rows)))
