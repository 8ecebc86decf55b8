"""Joins keep their left side, numbers keep NULL keys, leads match by every form of company."""

from pyspark.sql import functions as F

from enrichlake.operators import bronze, people
from enrichlake.operators.page_structure import sections
from enrichlake.operators.skew import number_rows
from enrichlake.plans.companies import assemble_company_rows
from enrichlake.plans.pages import gate_pages


def test_number_rows_keeps_null_keys(spark):
    rows = spark.createDataFrame([("a", 1), (None, 2), (None, 3), ("a", 4)], "k string, o int")
    got = {(r["k"], r["o"], r["rn"]) for r in number_rows(rows, ["o"], ["k"]).collect()}
    assert got == {("a", 1, 1), ("a", 4, 2), (None, 2, 1), (None, 3, 2)}


def test_repeated_branch_ids_and_fetches_add_no_rows(spark):
    companies = spark.createDataFrame([(1, "a.com"), (2, None)], "company_id int, domain string")
    branch = spark.createDataFrame([(1, "x"), (1, "y"), (3, "z")], "company_id int, raw string")
    assert {tuple(r) for r in bronze.merge_bronze_branches(companies, [(branch, "raw")]).select("company_id", "raw").collect()} == {(1, "y"), (2, None)}
    fetches = spark.createDataFrame([("a.com", "", "https://z"), ("a.com", "text", "https://b")], "domain string, markdown string, source_url string")
    got = {tuple(r) for r in bronze.build_page_inputs(companies, fetches).collect()}
    assert got == {(1, "text", "https://b"), (2, "", None)}


def test_leads_match_by_website_and_company_url(spark):
    ref = spark.createDataFrame(
        [("7", "Ada Person", None, "https://www.acme.com/about", None), ("8", "Bo Li", None, None, "https://l.example/c/x/")],
        "person_id string, full_name string, company_name string, company_website string, company_linkedin_url string",
    )
    leads = spark.createDataFrame(
        [(1, "Ada Person", None, "acme.com", None), (2, "Bo Li", None, None, "https://l.example/c/x"), (3, "Ada Person", "Other", None, None), (4, "Ada Person", None, None, None)],
        "lead_id int, full_name string, company_name string, company_website string, company_linkedin_url string",
    )
    got = {r["lead_id"]: (r["status"], r["matched_person_id"], r["matched_by"]) for r in people.match_leads(leads, ref).collect()}
    assert got == {1: ("matched", "7", "name"), 2: ("matched", "8", "name"), 3: ("not_matched", None, None), 4: ("invalid", None, None)}


def test_role_with_empty_end_goes_on(spark):
    roles = spark.createDataFrame([(1, "A", None, "")], "person_id int, company string, company_url string, end_date string")
    pairs = spark.createDataFrame([(9, 1, "a", None)], "pair_id int, person_id int, company_name string, company_url string")
    assert people.current_at_company(roles, pairs).first()["is_current_at_company"] is True


def test_sections_keep_the_text_as_it_stands(spark):
    page = "## A \nx\n###  B  \ny" + "z" * 5000 + "\n## C\nw"
    got = spark.createDataFrame([(page,)], "md string").select(F.inline(sections(F.col("md")))).collect()
    first = got[0]["text"]
    assert first == page[len("## A ") : page.index("## C")]


def test_profiles_of_one_domain_do_not_multiply(spark):
    profiles = spark.createDataFrame(
        [(i, "a.com", f"N{i}", None, None, None, None) for i in (1, 2, 3)],
        "record_id int, domain string, name string, industry string, headcount string, location string, linkedin_url string",
    )
    entity = "struct<company_name:string,company_id:string>"
    pages = spark.createDataFrame([(i, "a.com", "d", None) for i in (10, 11)], f"page_id int, domain_normalize string, company_description_extract string, company_entity_resolve {entity}")
    rows = assemble_company_rows(profiles, pages, with_drift=False).select("record_id", "page_id").collect()
    assert {tuple(r) for r in rows} == {(1, 10), (1, 11), (2, None), (3, None)} and len(rows) == 4


def test_condition_of_the_gate_reaches_the_scan(spark, tmp_path):
    spark.createDataFrame([(i, f"text {i}", "https://a.com") for i in range(4)], "page_id int, markdown string, source_url string").write.parquet(str(tmp_path / "p"))
    pages = spark.read.parquet(str(tmp_path / "p"))
    gated = gate_pages(pages, where=F.col("page_id") == 2)
    assert "EqualTo(page_id,2)" in gated._jdf.queryExecution().toString()
    assert [r["page_id"] for r in gated.select("page_id").collect()] == [2]
