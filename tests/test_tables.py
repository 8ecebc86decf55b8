"""Drift, resolver, skew helpers, joins, people, profiles and assembled rows."""

import datetime
import random
import statistics

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from enrichlake.contracts import PAGE_CONTRACTS, contracts_table, person_contracts
from enrichlake.functions import profiles as pr
from enrichlake.operators import bronze, drift, icp, people, quality, resolve, skew
from enrichlake.operators import profiles as pj
from enrichlake.plans import companies as cp
from enrichlake.plans import pages as plan

HISTORY = "field string, ts timestamp, seq long, is_empty boolean"
CANDIDATES = (
    "entity_id long, field string, ord int, source string, value string, is_structured boolean, observed_at string, confidence double"
)


# --- drift ------------------------------------------------------------------------
def model(values):
    """The rule in plain Python: mean plus two sample deviations over up to 19 before."""
    out = []
    for i, v in enumerate(values):
        before = [float(x) for x in values[max(0, i - 19):i]]
        if len(before) < 5:
            out.append(False)
            continue
        limit = min(statistics.fmean(before) + 2 * statistics.stdev(before), 1.0)
        out.append(float(v) > limit)
    return out


def test_drift_equals_the_rule_across_blocks(spark):
    rng = random.Random(7)
    start = datetime.datetime(2024, 1, 1)
    rows, want = [], {}
    # One field holds most rows, and many rows share a timestamp.
    for field, n, share in (("hot", 700, 0.05), ("b", 60, 0.3), ("c", 4, 0.5), ("d", 21, 0.1)):
        values = [rng.random() < share for _ in range(n)]
        rows += [(field, start + datetime.timedelta(seconds=i // 50), i, v) for i, v in enumerate(values)]
        want[field] = model(values)
    rng.shuffle(rows)
    got = drift.drift_flags(spark.createDataFrame(rows, HISTORY), block_rows=32).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["drifting"] == want[r["field"]][r["seq"]], r


@settings(max_examples=200, deadline=None)
@given(st.integers(5, 19).flatmap(lambda n: st.tuples(st.just(n), st.integers(0, n))))
def test_whole_number_rule_equals_the_deviation_rule(case):
    n, k = case
    before = [1.0] * k + [0.0] * (n - k)
    limit = min(statistics.fmean(before) + 2 * statistics.stdev(before), 1.0)
    assert ((n - k) * (n - 1) > 4 * k * n) == (1.0 > limit)


def test_drift_namespaces_do_not_mix(spark):
    rows = spark.createDataFrame([("a:name", datetime.datetime(2024, 1, 1), 1, True), ("name", datetime.datetime(2024, 1, 1), 2, True)], HISTORY)
    assert drift.read_history(rows, "name", "a").count() == 1
    assert drift.read_history(rows, "name").first()["seq"] == 2


# --- skew -------------------------------------------------------------------------
def test_number_rows_is_exact_under_a_hot_key(spark):
    rows = [("hot", i) for i in range(500)] + [("b", i) for i in range(7)]
    random.Random(3).shuffle(rows)
    got = skew.number_rows(spark.createDataFrame(rows, "k string, v long"), ["v"], ["k"]).collect()
    assert all(r["rn"] == r["v"] + 1 for r in got) and len(got) == 507


@pytest.mark.parametrize("k", [3, 1200])
def test_top_k_small_and_large(spark, k):
    df = spark.range(4000).select((F.col("id") % 3 == 0).alias("key"), "id")
    got = skew.top_k(df, ["key"], [F.asc("id")], k).collect()
    for key in (True, False):
        want = [i for i in range(4000) if (i % 3 == 0) == key][:k]
        assert sorted(r["id"] for r in got if r["key"] == key) == want


def test_null_keys_stay_apart(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "x")], "id long, k string")
    keys = {r["k"] for r in df.select(skew.spread_nulls(F.col("k"), F.col("id")).alias("k")).collect()}
    assert len(keys) == 3 and "x" in keys


# --- resolver -----------------------------------------------------------------------
def resolve_one(spark, rule, *cands, field="f"):
    rows = [
        (1, field, i, c[0], c[1], (c[2] if len(c) > 2 else {}).get("s"), (c[2] if len(c) > 2 else {}).get("t"), (c[2] if len(c) > 2 else {}).get("c"))
        for i, c in enumerate(cands)
    ]
    row = resolve.resolve_candidates(spark.createDataFrame(rows, CANDIDATES), {field: rule}).first()
    return (row["value"], row["source"], row["conflict"], row["ambiguous"], row["candidate_count"])


def rank(*names, normalize="int"):
    return resolve.Rule((resolve.Criterion("static_rank", names),), normalize)


def test_resolver_cases(spark):
    year = rank("registry", "page", "profile")
    assert resolve_one(spark, year, ("profile", "2020")) == ("2020", "profile", False, False, 1)
    assert resolve_one(spark, year, ("profile", " 2015 "), ("registry", "2015")) == (" 2015 ", "profile", False, False, 2)
    assert resolve_one(spark, year, ("profile", "2021"), ("page", "2018"), ("registry", "2015")) == ("2015", "registry", True, False, 3)
    assert resolve_one(spark, year, ("profile", "2021"), ("page", "2018"), ("registry", None)) == ("2018", "page", True, False, 3)
    assert resolve_one(spark, year, ("profile", None), ("page", ""), ("registry", None)) == (None, None, False, False, 3)
    many = [(f"s{i}", None) for i in range(15)]
    many[2], many[9], many[14] = ("s2", "100"), ("s9", "200"), ("s14", "300")
    assert resolve_one(spark, rank(*[f"s{i}" for i in range(15)]), *many) == ("100", "s2", True, False, 15)


def test_resolver_chain_ties_and_errors(spark):
    C = resolve.Criterion
    chain = resolve.Rule((C("static_rank", ("known",)), C("majority_vote")))
    assert resolve_one(spark, chain, ("x", "east"), ("y", "east"), ("z", "west"))[:3] == ("east", "x", True)
    assert resolve_one(spark, rank(normalize=None), ("x", "a"), ("y", "b")) == ("a", "x", True, True, 2)
    structured = resolve.Rule((C("prefer_structured"), C("static_rank", ("p", "q"))), "lower_strip")
    assert resolve_one(spark, structured, ("p", "New York", {"s": False}), ("q", "NYC", {"s": True}))[0] == "NYC"
    recent = resolve.Rule((C("most_recent"),))
    assert resolve_one(spark, recent, ("p", "1", {"t": "2026-01-01"}), ("q", "2", {"t": "2026-08-01"}), ("r", "3"))[0] == "2"
    sure = resolve.Rule((C("highest_confidence"),))
    assert resolve_one(spark, sure, ("p", "1", {"c": 0.1}), ("q", "2", {"c": 0.9}), ("r", "3"))[0] == "2"
    unknown = resolve.Rule((C("no_such"),))
    with pytest.raises(Exception, match="unknown priority criterion"):
        resolve_one(spark, unknown, ("x", "1"), ("y", "2"))
    assert resolve_one(spark, unknown, ("x", "1"), ("y", "1"))[0] == "1"
    decided = resolve.Rule((C("static_rank", ("y",)), C("no_such")))
    assert resolve_one(spark, decided, ("x", "1"), ("y", "2"))[0] == "2"


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("abcd"), st.sampled_from(["x", "X ", "y", "", None, "z"])), min_size=1, max_size=7))
def test_row_form_equals_table_form(spark, cands):
    rule = resolve.Rule((resolve.Criterion("static_rank", ("c", "a")), resolve.Criterion("majority_vote")), "lower_strip")
    table = resolve_one(spark, rule, *cands)[:4]
    columns = [(source, F.lit(value).cast("string")) for source, value in cands]
    row = spark.range(1).select(resolve.resolve_columns(columns, rule).alias("v")).first()["v"]
    assert (row["value"], row["source"], bool(row["conflict"]), bool(row["ambiguous"])) == table


def test_raw_values_keep_empties_and_last_duplicate(spark):
    rows = [(1, "f", 0, "a", "1", None, None, None), (1, "f", 1, "b", None, None, None, None), (1, "f", 2, "a", "3", None, None, None)]
    got = resolve.raw_values_map(spark.createDataFrame(rows, CANDIDATES)).first()["raw_values"]
    assert got == {"a": "3", "b": None}


# --- quality ------------------------------------------------------------------------
def test_contracts_table(spark):
    rows = {r["field"]: r for r in contracts_table(spark, PAGE_CONTRACTS).collect()}
    assert len(rows) == 14 and [f for f, r in rows.items() if r["required"]] == ["domain_normalize", "company_entity_resolve"]


def test_placeholder_rejects_a_record(spark):
    schema = "record_id long, country string, job_title string"
    rows = spark.createDataFrame([(1, " Unknown ", "CEO"), (2, "Unknown Land", "CEO")], schema)
    got = plan.evaluate_records(rows, person_contracts(), "profile_people", "record_id").orderBy("record_id").collect()
    assert [r["is_valid_row"] for r in got] == [False, True]
    assert got[0]["rejection_reasons"][0].startswith("country: contains a placeholder") and got[0]["drift_warnings"] == []


def test_domain_shape(one):
    for domain, ok in (("a.com", True), ("a_b.com", False), ("localhost", False), (None, True), ("-a.com", False)):
        assert one(quality.domain_shape_ok(F.col("d")), "d string", domain) is ok


# --- values -------------------------------------------------------------------------
@pytest.mark.parametrize(
    "raw, clean",
    [
        ("Dora (Dee) Miller, PharmD, MBA, BCACP", "Dora Miller"), ("Jon K. Berg", "Jon Berg"), ("Omar Aziz MPharm GPC MBA", "Omar Aziz"),
        ("Dr Lena Wolf MD", "Lena Wolf"), ("Ines El Amin, PhD., M.Sc., MBA", "Ines El Amin"), ("Mary Ann Clark MD PhD", "Mary Ann Clark"),
        ("Pat F.", "Pat F."), ("Ada Lovelace", "Ada Lovelace"), ("Cher", "Cher"), ("Li MD MBA", "Li MD"), ("Dr MD", "Dr MD"), ("  ", ""),
    ],
)
def test_clean_names(one, raw, clean):
    assert one(pr.clean_person_name(F.col("n")), "n string", raw) == clean


def test_bands(one):
    for n, band in ((0, "1-10"), (10, "1-10"), (11, "11-50"), (200, "51-200"), (500, "201-500"), (1000, "501-1000"), (5000, "1001-5000"),
                    (10000, "5001-10000"), (10001, "10001+"), (None, None)):
        assert one(pr.headcount_band(F.col("n")), "n long", n) == band
    for n, band in ((0, "0"), (137, "137"), (499, "499"), (500, "500+"), (None, None)):
        assert one(pr.connections_band(F.col("n")), "n long", n) == band
    with pytest.raises(Exception, match="cannot be negative"):
        one(pr.headcount_band(F.col("n")), "n long", -1)


def test_titles(one):
    for title, label in (("Vice President", "C_LEVEL"), ("VP Sales", "VP"), ("Head of Ops", "DIRECTOR"), ("Team Lead", "MANAGER"),
                         ("Nurse", "IC"), ("  ", None), (None, None)):
        assert one(pr.seniority(F.col("s")), "s string", title) == label
    assert one(pr.seniority(F.col("s"), strict=False), "s string", "Vice President") == "VP"
    for title, role in (("Venture Partner", "VENTURE_PARTNER"), ("Managing Director", "MANAGING_PARTNER"), ("VP", "VICE_PRESIDENT"),
                        ("Partnership lead", None), ("GP", "GENERAL_PARTNER")):
        assert one(pj.fund_role(F.col("s")), "s string", title) == role


def test_hiring_signal(one):
    for roles, growth, want in ((5, None, "actively_hiring"), (1, -3.0, "hiring"), (0, None, "not_hiring"), (0, 2.0, "growing"),
                                (None, -1.0, "shrinking"), (None, 0.0, "stable"), (None, None, None)):
        assert one(pr.hiring_signal(F.col("r"), F.col("g")), "r int, g double", roles, growth) == want


def test_mutual_connections(one):
    for raw, want in ((None, (0, [])), ("7", (7, [])), ("-2", (0, [])), ('[{"name":"A"},{"name":""},{"name":"B"},{"name":"C"},{"name":"D"}]', (5, ["A", "B", "C", "D"]))):
        got = one(pr.mutual_connections(F.parse_json(F.col("s"))), "s string", raw)
        assert (got["mutual_count"], got["sample_names"]) == want


def test_experience(spark):
    rows = [
        (1, 0, "A", "2018-01", "2020-01"), (1, 1, "B", "Jan 2020", "Present"), (1, 2, "C", "soon", None),
        (2, 0, "D", "2010", "2012"), (2, 1, "E", "2015", "2016"), (3, 0, "F", "someday", "2016"),
    ]
    df = spark.createDataFrame(rows, "person_id long, pos int, company string, start_date string, end_date string")
    as_of = F.lit("2026-01-15").cast("date")
    got = {r["person_id"]: r for r in pj.experience_summary(df, as_of).collect()}
    assert (got[1]["total_years_experience"], got[1]["current_tenure_years"]) == (8.0, 6.0)
    assert (got[2]["total_years_experience"], got[2]["current_tenure_years"]) == (4.83, 1.92)
    assert got[3]["total_years_experience"] is None and got[3]["current_tenure_years"] is None
    assert {r["person_id"]: r["employed_company"] for r in pj.employed_company(df).collect()} == {1: "B", 2: "E", 3: "F"}


def test_current_at_company_nested(spark):
    entry = "companyName string, companyLinkedinUrl string, endDate struct<month:string,year:int,text:string>"
    df = spark.createDataFrame(
        [
            (1, [("Acme", None, (None, None, "Present"))]), (2, [("Acme", None, ("Jan", 2020, "Jan 2020"))]), (3, [("Other", None, None)]),
            (4, [("x", "https://l/acme/", None)]), (5, None),
        ],
        f"id int, experience array<struct<{entry}>>",
    )
    verdict = pr.current_at_company(F.col("experience"), F.lit(" ACME "), F.lit("https://l/acme"))
    assert [r["v"] for r in df.orderBy("id").select(verdict.alias("v")).collect()] == [True, False, None, True, None]
    with pytest.raises(Exception, match="needed to match"):
        df.select(pr.current_at_company(F.col("experience"), F.lit(None).cast("string"), F.lit("")).alias("v")).collect()


def test_month_cutoff_clamps_the_day(spark):
    rows = [(1, 1, datetime.datetime(2026, 2, 28)), (2, 1, datetime.datetime(2026, 2, 27, 23))]
    df = spark.createDataFrame(rows, "post_id long, person_id long, posted_at timestamp")
    got = bronze.posts_in_window(df, 6, F.lit("2026-08-31").cast("date")).collect()
    assert [r["post_id"] for r in got] == [1]


# --- joins --------------------------------------------------------------------------
def test_spine_join_keeps_rows_and_last_item(spark):
    spine = spark.createDataFrame(
        [("1", "a", "a.com", "https://l/a"), ("2", "b", None, "https://l/b//"), ("3", "c", None, None), ("4", "d", None, None)],
        "company_id string, name string, domain string, linkedin_url string",
    )
    items = spark.createDataFrame(
        [(0, '{"linkedinUrl":"https://l/a/","v":1}'), (1, '{"linkedinUrl":"https://l/a","v":2}'), (2, '{"v":3}'), (3, '{"linkedinUrl":"https://l/b","v":4}')],
        "pos int, raw string",
    )
    got = {r["company_id"]: r["scrape_json"] for r in bronze.attach_raw_by_url(spine, items).collect()}
    assert '"v":2' in got["1"] and '"v":4' in got["2"] and got["3"] is None and got["4"] is None
    with pytest.raises(ValueError, match="linkedin_url"):
        bronze.attach_raw_by_url(spine.drop("linkedin_url"), items)


def test_waterfall_without_titles_is_empty_and_caps(spark):
    companies = spark.createDataFrame(
        [(1, "a.com", "A", True), (2, None, "B", True), (3, "c.com", "C", False), (4, "a.com", "A", True)],
        "company_id long, domain_normalize string, company_name string, is_valid_row boolean",
    )
    folk = spark.createDataFrame(
        [(i, "a.com", "A", "Sales lead") for i in range(20)] + [(100, None, "B", "sales"), (101, "c.com", "C", "sales"), (102, "a.com", "A", "Cook")],
        "person_id long, company_domain string, company_name string, job_title string",
    )
    assert people.people_waterfall(companies, folk, icp.Icp("c", "n")).count() == 0
    got = people.people_waterfall(companies, folk, icp.Icp("c", "n", people_job_title_include=("sales",))).collect()
    found = sorted((r["company_row_id"], r["matched_by"], r["person_id"]) for r in got)
    assert found == [(c, "domain", i) for c in (1,) for i in range(5)] + [(2, "name", 100)] + [(4, "domain", i) for i in range(5)]


def test_lead_batches_limit(spark):
    got = people.lead_batches(spark.range(120).withColumnRenamed("id", "lead_id"), size=50).groupBy("batch_id").count().collect()
    assert {r["batch_id"]: r["count"] for r in got} == {0: 50, 1: 50, 2: 20}
    with pytest.raises(ValueError, match="at most 50"):
        people.lead_batches(spark.range(1).withColumnRenamed("id", "lead_id"), size=51)


def test_company_row_without_either_side(spark):
    profiles = spark.createDataFrame(
        [(1, "a.com", "Acme", "x", "10", "here", "u"), (2, None, "Solo", None, None, None, None)],
        "record_id long, domain string, name string, industry string, headcount string, location string, linkedin_url string",
    )
    entity = "struct<company_id:string,company_name:string>"
    page_rows = spark.createDataFrame(
        [(10, "a.com", "About", ("acme", "ACME Inc")), (11, "b.com", "Else", ("else", "Else Ltd")), (12, None, None, None)],
        f"page_id long, domain_normalize string, company_description_extract string, company_entity_resolve {entity}",
    )
    rows = {(r["record_id"], r["page_id"]): r for r in cp.assemble_company_rows(profiles, page_rows).collect()}
    assert set(rows) == {(1, 10), (2, None), (None, 11), (None, 12)}
    assert (rows[1, 10]["name"], rows[1, 10]["name_source"], rows[1, 10]["name_conflict"]) == ("Acme", "profile", True)
    assert rows[None, 11]["name_source"] == "page" and rows[2, None]["domain"] is None
    assert rows[1, 10]["company_id_key"] == "acme" and rows[1, 10]["profile_is_valid_row"] is True


# --- ICP ----------------------------------------------------------------------------
def test_icp_defaults_and_violations(spark):
    specs = spark.createDataFrame(
        [('{"client_id":"c","name":"n"}',), ('{"name":"n","limit":0,"industries":["Nope"],"hq_cities":"x"}',)], "raw string"
    )
    got = [r["violations"] for r in icp.validate_icp(specs, industries=["Banking"]).collect()]
    assert got == [[], [
        "client_id: required but missing", "hq_cities: expected a list of strings", "industries: not in the industry enum: ['Nope']",
        "limit: must be a positive integer",
    ]]
    made = icp.Icp.from_row(icp.parse_icp(specs).first())
    assert (made.limit, made.people_max_per_company, made.people_match_mode, made.industries) == (100, 5, "CONTAINS", ())


def test_icp_without_clauses_keeps_all_and_pushes_filters(spark, tmp_path):
    path = str(tmp_path / "c")
    spark.range(5).select("id", F.lit("Banking").alias("industry"), F.lit("a.com").alias("domain")).write.parquet(path)
    df = spark.read.parquet(path)
    assert icp.icp_filter_companies(df, icp.Icp("c", "n")).count() == 5
    text = icp.icp_filter_companies(df, icp.Icp("c", "n", industries=("Banking",)))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(industry), EqualTo(industry,Banking)]" in text


def test_headquarters_clauses_hold_for_one_place(spark):
    place = "struct<is_headquarters:boolean,country_name:string,city:string>"
    df = spark.createDataFrame(
        [(1, [(True, "US", "x"), (False, "UK", "London")]), (2, [(True, "UK", "London")])], f"id int, locations array<{place}>"
    )
    got = icp.icp_filter_companies(df, icp.Icp("c", "n", hq_countries=("UK",), hq_cities=("London",)))
    assert [r["id"] for r in got.collect()] == [2]
