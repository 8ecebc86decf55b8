"""Triage, extraction and gate of pages."""

import pytest
from pyspark.sql import functions as F

from enrichlake.functions import text as t
from enrichlake.operators import page_fields as pf
from enrichlake.operators import page_structure as ps
from enrichlake.operators import triage as tr
from enrichlake.plans import pages as plan

SCHEMA = (
    "page_id long, markdown string, source_url string, company_name string, raw_date string, "
    "current_year int, detected_tools array<string>"
)
FULL = """# Northwind Traders

Northwind Traders is a subsidiary of Northwind Group AG. Northwind Traders is a cloud-based SaaS platform for shops in Berlin, Germany.

Northwind Traders was founded in 2011 and passed its SOC 2 and ISO 27001 audits on 2019-03-03.

We work with Segment to join customer data. Available in: English (EN) · Deutsch (DE) · Français (FR)

## Pricing

- Basic: $19/mo
- Large: $89/mo per seat

## Careers

- **Backend Engineer** — Engineering — Berlin, Germany — Posted 2024-01-15
Account Executive — Sales — New York, NY — Posted 2024-02-01
Success Manager - Support - Austin, TX - Posted 2024-03-05

## Footer

© 2024 Northwind Traders. All rights reserved.
[LinkedIn](https://www.linkedin.com/company/northwind)
"""
FILLER = " ".join(["word"] * 30)


def pages(spark, *markdown, **kw):
    rows = [
        (i, m, kw.get("source_url"), kw.get("company_name"), kw.get("raw_date"), kw.get("current_year"), kw.get("tools"))
        for i, m in enumerate(markdown)
    ]
    return spark.createDataFrame(rows, SCHEMA)


def extract(spark, markdown, **kw):
    return pf.extract_fields(pages(spark, markdown, **kw)).first().asDict(True)


@pytest.fixture(scope="module")
def golden(spark):
    df = pages(
        spark, FULL, source_url="https://www.northwind.com/x?utm=1", raw_date="2020-01-01", current_year=2026,
        tools=["HubSpot", "Google Analytics", "Segment", "Odd Tool"],
    )
    return plan.gate_pages(df).first().asDict(True)


def test_golden_page(golden):
    assert golden["is_valid_row"] and golden["rejection_reasons"] == []
    assert (golden["crawl_issue"], golden["content_integrity"], golden["schema_version"]) == ("none", "genuine", "1.0")
    assert golden["domain_normalize"] == "northwind.com"
    assert golden["social_links_extract"]["linkedin_url"] == "https://www.linkedin.com/company/northwind"
    assert golden["social_links_extract"]["g2_url"] is None
    assert golden["legal_entity_extract"] == {"legal_name": "Northwind Traders", "copyright_year": 2024}
    assert golden["company_description_extract"].startswith("Northwind Traders is a subsidiary")
    assert golden["site_locale_detect"] == ["en", "de", "fr"]
    assert golden["pricing_locale_extract"] == {
        "currency_code": "USD", "price_points": ["$19", "$89"], "billing_model_hint": "USAGE",
    }
    assert [r["title"] for r in golden["careers_page_parse"]] == ["Backend Engineer", "Account Executive", "Success Manager"]
    assert golden["careers_page_parse"][0] == {
        "title": "Backend Engineer", "department": "Engineering", "location": "Berlin, Germany", "posted_date": "2024-01-15",
    }
    tech = golden["tech_stack_normalize"]
    assert [x["tool_id"] for x in tech["detected_stack"]] == ["hubspot", "google_analytics", "segment", "odd_tool"]
    assert [x["tool_id"] for x in tech["mentioned_technologies"]] == ["segment"]
    assert golden["business_model"]["offering"]["primary"] == "SAAS"
    entity = golden["company_entity_resolve"]
    assert entity["company_id"] == "northwind-group-ag" and entity["source"] == "markdown"
    assert golden["date_normalize"] == ["2020-01-01", "2019-03-03", "2024-01-15", "2024-02-01", "2024-03-05"]
    assert golden["date_normalize_source"] == "context_override"
    assert golden["compliance_framework_extract"] == ["ISO27001", "SOC2"]
    assert golden["experience_signal_extract"] == {
        "founding_year": 2011, "founding_year_source": "explicit", "years_in_business_claim": None,
    }
    # A place runs on over the full stop and blank line as long as capitals follow.
    assert golden["service_region_extract"][0] == "Berlin, Germany.\n\nNorthwind Traders"
    assert {"New York, NY", "Austin, TX", "New York", "TX"} <= set(golden["service_region_extract"])
    assert golden["locale_conflict"] is False


def test_score_counts_lower_sources(golden):
    # Description, parent and dates come from the text although an override would be better.
    assert golden["quality_score"] == 94.0
    report = {r["field"]: r for r in golden["function_report"]}
    assert len(report) == 14 and report["business_model"]["is_empty"] is False
    assert report["tech_stack_normalize"]["source"] == "context"


@pytest.mark.parametrize(
    "text, issue, status",
    [
        ("  \n ", "empty_response", "unusable"),
        ("Buy this domain today", "parked_or_for_sale", "unusable"),
        ("Our site is coming soon", "under_construction", "unusable"),
        ("Please verify you are human", "bot_challenge", "unusable"),
        ("Subscribers only", "login_required", "unusable"),
        ("We use cookies. Accept.", "cookie_wall", "unusable"),
        ("We use cookies. " + FILLER, "none", "partial"),
        ("Winning numbers " + FILLER, "non_company_page", "unusable"),
        ("Top 10 firms\n\nA 4.8/5\n\nB 4 stars\n\nC 3/5 " + FILLER, "directory_or_aggregator", "unusable"),
        ("too few words here", "boilerplate_only", "unusable"),
        (" ".join(["word"] * 119), "none", "partial"),
        (" ".join(["word"] * 120), "none", "ok"),
        ("Protected by Cloudflare " + FILLER, "bot_challenge", "unusable"),
    ],
)
def test_triage_ladder(spark, text, issue, status):
    row = tr.classify_crawl_issue(pages(spark, text)).first()
    assert (row["crawl_issue"], row["crawl_status"]) == (issue, status)


def test_relevance_needs_a_recurring_subject(spark):
    listicle = "10 tips to grow. " + FILLER
    profile = "How to buy.\n\nAcme Corp sells.\n\n## Acme Corp ships.\n\nAcme Corp helps."
    got = pages(spark, listicle, profile, FILLER).select(tr.is_company_profile(F.col("markdown")).alias("v")).collect()
    assert [r["v"] for r in got] == [False, True, True]


def test_rejected_page_keeps_text_and_skips_extraction(spark):
    row = plan.gate_pages(pages(spark, "Our new site is coming soon", source_url="https://a.com")).first()
    assert row["rejection_reasons"] == ["under_construction"] and row["quality_score"] == 0.0
    assert row["domain_normalize"] is None and row["business_model"] is None and row["function_report"] == []
    assert row["content_integrity"] == "unknown" and row["raw_markdown_input"] == "Our new site is coming soon"


def test_missing_domain_is_a_violation(spark):
    row = plan.gate_pages(pages(spark, FILLER)).first()
    assert row["crawl_status"] == "partial" and not row["is_valid_row"]
    assert row["rejection_reasons"] == [
        "domain_normalize: required but missing", "company_entity_resolve.company_id: required but missing",
    ]


def test_template_text_is_flagged_but_valid(spark):
    row = plan.gate_pages(pages(spark, "Lorem ipsum " + FILLER, source_url="https://a.com")).first()
    assert row["is_valid_row"] and row["content_integrity"] == "placeholder_or_template"


def test_process_batch_order_and_count(spark):
    rows = plan.process_batch(pages(spark, "coming soon", FULL, "", FULL, source_url="https://a.com")).collect()
    assert [r["page_id"] for r in rows] == [1, 3, 0, 2]
    assert all(r["drift_warnings"] == [] for r in rows)


def test_batch_drift_warns_on_first_empty_after_five_full(spark):
    rows = plan.process_batch(pages(spark, *[FULL] * 6, FILLER + " 2", source_url="https://a.com")).collect()
    last = next(r for r in rows if r["page_id"] == 6)
    assert "drift_warning:legal_entity_extract" in last["drift_warnings"]
    assert not any(r["drift_warnings"] for r in rows if r["page_id"] < 6)


def test_gate_plan_has_no_shuffle(spark):
    text = plan.gate_pages(pages(spark, FULL))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and "Python" not in text


def test_filter_on_a_field_does_not_copy_the_extraction(spark):
    df = plan.gate_pages(pages(spark, FULL)).where("is_valid_row")
    text = df._jdf.queryExecution().optimizedPlan().toString()
    assert text.startswith("Filter (isnotnull(is_valid_row") and text.count("Filter") == 1


@pytest.mark.parametrize(
    "url, domain",
    [
        ("https://www.app.acme.com/x", "acme.com"), ("docs.acme.co.uk", "acme.co.uk"), ("http://u:p@acme.com:80/?q", "acme.com"),
        ("https://my_host.example.com", "my_host.example.com"), ("https://www.com", "www.com"), ("", None), (None, None),
        ("HTTPS://WWW.ACME.COM", "acme.com"),
    ],
)
def test_domain(spark, url, domain):
    assert extract(spark, "x", source_url=url)["domain_normalize"] == domain


def test_loose_careers(spark):
    text = "## Open Positions\n\n- **Engineer** (Berlin, Germany)\n- Designer - Design (Remote)\n- Account Executive\n- account executive\n"
    roles = extract(spark, text)["careers_page_parse"]
    assert [tuple(r.values()) for r in roles] == [
        ("Engineer", None, "Berlin, Germany", None), ("Designer", "Design", "Remote", None), ("Account Executive", None, None, None),
    ]
    assert extract(spark, "## Features\n\n- Fast\n")["careers_page_parse"] == []


def test_tech_aliases_need_word_bounds(spark):
    got = extract(spark, "We use front app, Vercel, getdbt.com and gusto  payroll; not driftwood, segments or heap.")
    assert [x["tool_id"] for x in got["tech_stack_normalize"]["mentioned_technologies"]] == ["frontapp", "vercel", "dbt", "gusto"]


def test_overlapping_catalog_aliases_are_all_found(spark):
    catalog = (("A", None, ("cloud",)), ("B", None, ("cloud storage",)), ("C", None, ("storage box",)))
    df = spark.createDataFrame([(1, "Cloud storage box and clouds")], "doc_id long, text string")
    assert [r["code"] for r in ps.dictionary_match(df, catalog, "doc_id", "text").collect()] == ["A", "B", "C"]


def test_unicode_follows_python(one):
    text = "FRANÇAIS, éfoo bar"
    found = one(t.extract_all(F.col("s"), t.rx(r"\b(?:français|foo)\b", ignore_case=True)), "s string", text)
    assert found == ["FRANÇAIS"]


def test_dates(spark):
    text = "On 3/14/2021, 31/12/2020, March 5, 2018, 2024-13-45 and 99/99/2020."
    assert extract(spark, text)["date_normalize"] == ["2021-03-14", "2020-12-31", "2018-03-05"]
    assert extract(spark, "No date here")["date_normalize"] is None


def test_experience_derived(spark):
    got = extract(spark, "We have over 30 years here", current_year=2026)["experience_signal_extract"]
    assert got == {"founding_year": 1996, "founding_year_source": "derived", "years_in_business_claim": 30}


def test_conflicts(spark):
    text = "Deutsch (DE). Now ¥500/mo.\n\n© 2024 Meta Platforms, Inc. All rights reserved."
    row = extract(spark, text, company_name="Meta")
    assert row["locale_conflict"] and "['de']" in row["locale_conflict_detail"]
    assert row["company_name_conflict"]
    assert not extract(spark, "© 2024 Stripe, Inc. All rights reserved.", company_name="Stripe")["company_name_conflict"]


def test_state_abbreviations_match_any_capitals(spark):
    assert extract(spark, "Come IN and say OK")["service_region_extract"] == ["IN", "OK"]


def test_section_ends_at_same_level(one):
    text = "# A\n\n## Plans\n\n$5\n\n### More\n\n$6\n\n## Next\n\n$7"
    assert one(ps.section(F.col("s"), ("pricing", "plans")), "s string", text) == "\n\n$5\n\n### More\n\n$6\n\n"
    assert one(ps.section(F.col("s"), ("zzz",)), "s string", text) == ""


def test_links_and_footer(spark, one):
    text = "[a](https://x.com/1) https://y.com/2 and https://x.com/1"
    got = ps.page_links(pages(spark, text)).collect()
    assert [(r["anchor"], r["url"]) for r in got] == [("a", "https://x.com/1"), ("", "https://y.com/2")]
    assert one(ps.footer(F.col("s")), "s string", "\n".join(map(str, range(40)))) == "\n".join(map(str, range(15, 40)))


def test_user_job_reads_earlier_fields(spark):
    job = pf.FieldJob(
        "tld", lambda: pf.FieldResult(F.regexp_extract("domain_normalize", r"\.([a-z]+)$", 1)), depends_on=("domain_normalize",)
    )
    rows = pf.extract_fields(pages(spark, "x", source_url="https://a.io"), [*pf.PAGE_JOBS, job])
    assert rows.first()["tld"] == "io"
    with pytest.raises(ValueError, match="circle"):
        pf.extract_fields(pages(spark, "x"), [pf.FieldJob("a", job.build, ("b",)), pf.FieldJob("b", job.build, ("a",))])


def test_entity_rollup_counts(spark):
    df = pages(spark, *["is a subsidiary of Big Group. " + FILLER] * 3, source_url="https://a.com")
    rows = pf.extract_fields(df)
    assert pf.entity_rollup(rows).collect()[0].asDict() == {
        "company_id": "big-group", "pages": 3, "domains": 1, "first_domain": "a.com",
    }
