"""Queries over site pages."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from enrichlake.contracts import PAGE_CONTRACTS, contracts_table
from enrichlake.functions import catalogs as cat
from enrichlake.functions import text as t
from enrichlake.functions.urls import root_domain
from enrichlake.operators import page_fields as pf
from enrichlake.operators import page_structure as ps
from enrichlake.operators import quality, report
from enrichlake.operators import triage as tr
from enrichlake.operators.skew import number_rows
from enrichlake.plans import pages as plan
from enrichlake.plans.history import History
from enrichlake.session import shared_folder
from enrichlake.sources.writers import flatten

from . import page_sql as s
from .fixtures import fixture, table, with_fixtures
from .registry import query


def site_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, "site_pages")


def fields(spark: SparkSession, sf_dir: str, *names: str) -> DataFrame:
    jobs = [j for j in pf.PAGE_JOBS if j.name in names]
    return pf.extract_fields(site_pages(spark, sf_dir), jobs)


def joined(arr: Column, name: str) -> Column:
    return F.array_join(arr, "|").alias(name)


def md() -> Column:
    return F.coalesce(F.col("markdown"), F.lit(""))


# --- triage ----------------------------------------------------------------------
@query(s.pages_sql("page_id, crawl_issue, crawl_status", s.TRIAGE_COLUMNS))
def triage_ladder(spark, sf_dir):
    return tr.classify_crawl_issue(site_pages(spark, sf_dir)).select("page_id", "crawl_issue", "crawl_status")


@query(f"""select doc_id, cast(words as integer) as words,
  case when words < 15 then 'boilerplate_only' when words < 120 then 'partial' else 'ok' end as bucket
  from (select doc_id, {s.WORDS.format('text')} as words from documents)""")
def triage_word_count(spark, sf_dir):
    words = F.col("words")
    return (
        table(spark, sf_dir, "documents")
        .select("doc_id", t.word_count(F.col("text")).alias("words"))
        .withColumn(
            "bucket",
            F.when(words < cat.EMPTY_PROSE_WORDS, "boilerplate_only")
            .when(words < cat.THIN_PROSE_WORDS, "partial")
            .otherwise("ok"),
        )
    )


@query(s.pages_sql(f"page_id, {s.directory('md')} as is_directory"))
def triage_directory(spark, sf_dir):
    return site_pages(spark, sf_dir).select("page_id", tr.looks_like_directory(F.lower(md())).alias("is_directory"))


@query(s.pages_sql(f"page_id, {s.RELEVANT} as is_company_profile"))
def relevance_gate(spark, sf_dir):
    return site_pages(spark, sf_dir).select("page_id", tr.is_company_profile(md()).alias("is_company_profile"))


@query(s.pages_sql(f"page_id, {s.INTEGRITY} as content_integrity"))
def content_integrity(spark, sf_dir):
    return site_pages(spark, sf_dir).select("page_id", tr.content_integrity(md()).alias("content_integrity"))


@query(
    s.pages_sql(
        "case when usable then 'usable' else 'rejected' end as part, reasons[1] as reason, count(*) as pages",
        s.TRIAGE_COLUMNS,
        {"relevant": s.RELEVANT, "usable": "crawl_issue = 'none' and relevant",
         "reasons": "case when crawl_issue <> 'none' then [crawl_issue] when not relevant then ['not_a_company_profile'] else [] end"},
    ) + " group by 1, 2"
)
def triage_split(spark, sf_dir):
    usable, rejected = tr.triage_split(tr.triage(site_pages(spark, sf_dir)))

    def counted(df: DataFrame, part: str) -> DataFrame:
        return df.groupBy(
            F.lit(part).alias("part"), t.first_or_null(F.col("triage_reasons")).alias("reason")
        ).agg(F.count(F.lit(1)).alias("pages"))

    return counted(usable, "usable").unionByName(counted(rejected, "rejected"))


# --- structure --------------------------------------------------------------------
@query(s.pages_sql("page_id, cast(unnest(range(len(links))) as integer) as pos, unnest(links).a as anchor, unnest(links).u as url",
    {"linked": r"list_transform(list_zip(regexp_extract_all(md, '\[([^\]]*)\]\((https?://[^\s)]+)\)', 1), regexp_extract_all(md, '\[([^\]]*)\]\((https?://[^\s)]+)\)', 2)), lambda z: {'a': trim(z[1]), 'u': z[2]})",
     "bare": "list_filter(regexp_extract_all(md, 'https?://[^\\s)\\]}>\"'']+'), lambda u: not list_contains(list_transform(linked, lambda l: l.u), u))",
     "links": "list_concat(linked, list_transform(" + s.distinct_in_order("bare") + ", lambda u: {'a': '', 'u': u}))"}))
def page_links(spark, sf_dir):
    return ps.page_links(site_pages(spark, sf_dir).where(F.col("markdown").isNotNull()))


@query(s.pages_sql(rf"page_id, case when {s.FOOTER} <> '' then {s.FOOTER} else {s.trim('md')} end as footer"))
def page_footer(spark, sf_dir):
    return site_pages(spark, sf_dir).select("page_id", ps.footer(md()).alias("footer"))


HEADING = r"(?m)^(#{1,6})\s*(.+)$"


@query(s.pages_sql(
    "page_id, unnest(heads, recursive := true)",
    {"marks": f"regexp_extract_all(md, '{HEADING}', 1)",
     "titles": f"list_transform(regexp_extract_all(md, '{HEADING}', 2), lambda x: {s.trim('x')})",
     "whole": f"regexp_extract_all(md, '{HEADING}', 0)",
     "pieces": r"string_split_regex(md, '(?m)^#{1,6}\s*.+$')",
     "ends": "list_transform(range(1, len(marks) + 1), lambda i: coalesce(list_min(list_filter(range(i + 1, len(marks) + 1), lambda j: length(marks[j]) <= length(marks[i]))), len(marks) + 1))",
     "heads": "list_transform(range(1, len(marks) + 1), lambda i: {'pos': cast(i - 1 as integer), 'level': cast(length(marks[i]) as integer), 'title': titles[i], "
              "'text': pieces[i + 1] || array_to_string(list_transform(range(i + 1, ends[i]), lambda j: whole[j] || pieces[j + 1]), '')})"}))
def page_sections(spark, sf_dir):
    return ps.page_sections(site_pages(spark, sf_dir)).select("page_id", "pos", "level", "title", "text")


@query(s.pages_sql("page_id, cast(unnest(range(len(parts))) as integer) as pos, unnest(parts) as paragraph",
                   {"parts": s.PARAGRAPHS.format("md")}))
def page_paragraphs(spark, sf_dir):
    return ps.page_paragraphs(site_pages(spark, sf_dir))


# --- fields -----------------------------------------------------------------------
@query(f"select page_id, {s.host('url')} as domain from pages")
def domain_normalize(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", root_domain(F.col("url")).alias("domain"))


@query(s.pages_sql("page_id, " + ", ".join(s.SOCIAL), {"urls": s.URLS, **s.SOCIAL}))
def social_links(spark, sf_dir):
    rows = fields(spark, sf_dir, "social_links_extract")
    return rows.select("page_id", *[F.col(f"social_links_extract.{k}").alias(k) for k in cat.SOCIAL_PLATFORMS])


@query(s.pages_sql("page_id, legal_name, copyright_year", s.FIELD_COLUMNS))
def legal_entity(spark, sf_dir):
    rows = fields(spark, sf_dir, "legal_entity_extract")
    return rows.select("page_id", "legal_entity_extract.legal_name", "legal_entity_extract.copyright_year")


@query(s.pages_sql("page_id, description", {"description": s.FIELD_COLUMNS["description"]}))
def description(spark, sf_dir):
    return fields(spark, sf_dir, "company_description_extract").select(
        "page_id", F.col("company_description_extract").alias("description")
    )


@query(s.pages_sql("page_id, array_to_string(languages, '|') as languages", {k: s.FIELD_COLUMNS[k] for k in ("locale_hits", "languages")}))
def site_locale(spark, sf_dir):
    return fields(spark, sf_dir, "site_locale_detect").select("page_id", joined(F.col("site_locale_detect"), "languages"))


PRICING = {k: s.FIELD_COLUMNS[k] for k in ("pricing_text", "prices", "currency_code", "billing_hint")}


@query(s.pages_sql("page_id, currency_code, nullif(array_to_string(prices, '|'), '') as price_points, billing_hint", PRICING))
def pricing(spark, sf_dir):
    p = F.col("pricing_locale_extract")
    return fields(spark, sf_dir, "pricing_locale_extract").select(
        "page_id", p["currency_code"].alias("currency_code"), joined(p["price_points"], "price_points"),
        p["billing_model_hint"].alias("billing_hint"),
    )


@query(s.careers_sql("select page_id, cast(pos as integer) as pos, title, department, location, posted_date from strict_roles"))
def careers_strict(spark, sf_dir):
    return _postings(spark, sf_dir, strict=True)


@query(s.careers_sql("select page_id, cast(pos as integer) as pos, title, department, location, posted_date from loose_final"))
def careers_loose(spark, sf_dir):
    return _postings(spark, sf_dir, strict=False)


def _postings(spark, sf_dir, strict: bool) -> DataFrame:
    from enrichlake.operators import careers

    section = careers.careers_section(md())
    roles = t.let(
        section,
        lambda sec: t.let(
            careers.strict_roles(sec),
            lambda r: r if strict else F.when(F.size(r) == 0, careers.loose_roles(sec)),
        ),
    )
    return site_pages(spark, sf_dir).select("page_id", F.posexplode(roles).alias("pos", "role")).select(
        "page_id", "pos", "role.*"
    )


@query(s.careers_sql(
    "select department, count(*) as postings, count(distinct page_id) as pages from "
    "(select page_id, department from strict_roles union all select page_id, department from loose_final) group by department"))
def job_postings(spark, sf_dir):
    return pf.job_postings(fields(spark, sf_dir, "careers_page_parse")).groupBy("department").agg(
        F.count(F.lit(1)).alias("postings"), F.countDistinct("page_id").alias("pages")
    )


@query(with_fixtures("site_pages", body=f"select page_id, cast(row_number() over (partition by page_id order by ord) - 1 as integer) as ord, code, category "
                     f"from site_pages, {s.catalog_rows(cat.TECHNOLOGIES)} where regexp_matches(coalesce(markdown, ''), pattern)"))
def tech_mentions(spark, sf_dir):
    return ps.dictionary_match(site_pages(spark, sf_dir), cat.TECHNOLOGIES, "page_id", "markdown")


@query(with_fixtures("detected", body=f""", t as (select page_id, unnest(string_split(tools, '|')) as tool, generate_subscripts(string_split(tools, '|'), 1) as i from detected),
hit as (select page_id, i, tool, min_by(code, ord) as code, min_by(category, ord) as category from t left join {s.catalog_rows(cat.TECHNOLOGIES)}
  on regexp_matches(tool, pattern) group by page_id, i, tool),
named as (select page_id, i, coalesce(code, regexp_replace(regexp_replace(lower({s.trim('tool')}), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g')) as tool_id,
  category from hit),
kept as (select *, row_number() over (partition by page_id, tool_id order by i) as seen from named where tool_id <> '')
select page_id, cast(row_number() over (partition by page_id order by i) - 1 as integer) as pos, tool_id, category from kept where seen = 1"""))
def tech_detected(spark, sf_dir):
    parts = fixture(spark, sf_dir, "detected").withColumn("detected_tools", F.split("tools", r"\|"))
    return parts.select("page_id", F.posexplode(pf.detected_stack(F.col("detected_tools"))).alias("pos", "e")).select(
        "page_id", "pos", "e.tool_id", "e.category"
    )


@query(s.pages_sql("page_id, pricing_primary, pricing_secondary, offering_primary, offering_secondary, delivery", s.FIELD_COLUMNS))
def business_model(spark, sf_dir):
    b = F.col("business_model")
    return fields(spark, sf_dir, "pricing_locale_extract", "business_model").select(
        "page_id",
        b["pricing"]["primary"].alias("pricing_primary"), b["pricing"]["secondary"].alias("pricing_secondary"),
        b["offering"]["primary"].alias("offering_primary"), b["offering"]["secondary"].alias("offering_secondary"),
        b["delivery"]["primary"].alias("delivery"),
    )


ENTITY_JOBS = ("domain_normalize", "legal_entity_extract", "company_entity_resolve")


@query(s.pages_sql("page_id, entity_id as company_id, case when entity_id is not null then entity_name end as company_name, "
                   "case when entity_id is not null then parent end as parent_guess, entity_source as source", s.FIELD_COLUMNS))
def entity_resolve(spark, sf_dir):
    e = F.col("company_entity_resolve")
    return fields(spark, sf_dir, *ENTITY_JOBS).select(
        "page_id", e["company_id"].alias("company_id"), e["company_name"].alias("company_name"),
        e["parent_guess"].alias("parent_guess"), e["source"].alias("source"),
    )


@query(s.pages_sql("entity_id as company_id, count(*) as pages, count(distinct domain) as domains, min(domain) as first_domain", s.FIELD_COLUMNS)
       + " where entity_id is not null group by entity_id")
def entity_rollup(spark, sf_dir):
    return pf.entity_rollup(fields(spark, sf_dir, *ENTITY_JOBS))


@query(s.pages_sql("page_id, array_to_string(dates, '|') as dates, case when len(dates) = 0 then null when " + s.iso("raw_date")
                   + " is not null then 'context_override' else 'markdown_scan' end as date_source",
                   {k: s.FIELD_COLUMNS[k] for k in ("date_hits", "dates")}))
def date_normalize(spark, sf_dir):
    return fields(spark, sf_dir, "date_normalize").select(
        "page_id", F.coalesce(F.array_join("date_normalize", "|"), F.lit("")).alias("dates"),
        F.col("date_normalize_source").alias("date_source"),
    )


@query(s.pages_sql("iso_date, count(*) as pages from (select page_id, unnest(dates) as iso_date",
                   {k: s.FIELD_COLUMNS[k] for k in ("date_hits", "dates")}) + ") group by iso_date")
def page_dates(spark, sf_dir):
    return pf.page_dates(fields(spark, sf_dir, "date_normalize")).groupBy("iso_date").agg(F.count(F.lit(1)).alias("pages"))


@query(s.pages_sql("page_id, array_to_string(frameworks, '|') as frameworks", {"frameworks": s.FIELD_COLUMNS["frameworks"]}))
def compliance(spark, sf_dir):
    return fields(spark, sf_dir, "compliance_framework_extract").select(
        "page_id", joined(F.col("compliance_framework_extract"), "frameworks")
    )


EXPERIENCE = {k: s.FIELD_COLUMNS[k] for k in ("founded", "duration", "founding_year", "founding_year_source")}


@query(s.pages_sql("page_id, founding_year, founding_year_source, duration as years_claim", EXPERIENCE))
def experience_signal(spark, sf_dir):
    e = F.col("experience_signal_extract")
    return fields(spark, sf_dir, "experience_signal_extract").select(
        "page_id", e["founding_year"].alias("founding_year"), e["founding_year_source"].alias("founding_year_source"),
        e["years_in_business_claim"].alias("years_claim"),
    )


PLACES = {k: s.FIELD_COLUMNS[k] for k in ("place_hits", "places")}


@query(s.pages_sql("page_id, array_to_string(places, '|') as places", PLACES))
def service_region(spark, sf_dir):
    return fields(spark, sf_dir, "service_region_extract").select("page_id", joined(F.col("service_region_extract"), "places"))


@query(s.pages_sql("place, count(*) as pages from (select page_id, unnest(places) as place", PLACES) + ") group by place")
def page_places(spark, sf_dir):
    return pf.page_places(fields(spark, sf_dir, "service_region_extract")).groupBy("place").agg(F.count(F.lit(1)).alias("pages"))


@query(s.pages_sql(
    "page_id, locale_conflict, case when locale_conflict then 'pricing page priced in ' || currency_code || ' but detected site language(s) ['''"
    " || array_to_string(languages, ''', ''') || ''']' end as locale_conflict_detail, name_conflict as company_name_conflict, "
    "case when name_conflict then 'legal_entity_extract=''' || legal_name || '''; context_override=''' || company_name || '''' end as company_name_conflict_detail",
    s.FIELD_COLUMNS))
def conflict_check(spark, sf_dir):
    return fields(
        spark, sf_dir, "site_locale_detect", "pricing_locale_extract", "legal_entity_extract", "conflict_check"
    ).select("page_id", "locale_conflict", "locale_conflict_detail", "company_name_conflict", "company_name_conflict_detail")


# --- gate -------------------------------------------------------------------------
def gated(spark, sf_dir) -> DataFrame:
    return plan.gate_pages(site_pages(spark, sf_dir), run_timestamp=F.lit("2026-01-01").cast("timestamp"))


ALL = (s.TRIAGE_COLUMNS, s.FIELD_COLUMNS, s.GATE_COLUMNS)
FINAL_STATUS = "case when usable then crawl_status else 'unusable' end"
GATED_SQL = s.pages_sql(
    "page_id, case when crawl_issue = 'none' and not relevant then 'wrong_page_type' else crawl_issue end as crawl_issue, "
    f"{FINAL_STATUS} as crawl_status, case when usable then {s.INTEGRITY} else 'unknown' end as content_integrity, is_valid_row, "
    "cast(score as double) as quality_score, array_to_string(reasons, '|') as rejection_reasons, "
    "case when usable then domain end as domain, case when usable then entity_id end as company_id, "
    "case when usable then legal_name end as legal_name, case when usable then description end as description, "
    "case when usable then currency_code end as currency_code, case when usable then founding_year end as founding_year, "
    "case when usable then array_to_string(tools, '|') end as tools, case when usable then offering_primary end as offering, "
    "case when usable then array_to_string(places, '|') end as places, case when usable then locale_conflict end as locale_conflict",
    *ALL,
)


@query(GATED_SQL)
def page_rows_gated(spark, sf_dir):
    tools = F.transform(F.col("tech_stack_normalize.mentioned_technologies"), lambda x: x["tool_id"])
    usable = F.col("crawl_status") != "unusable"
    return gated(spark, sf_dir).select(
        "page_id", "crawl_issue", "crawl_status", "content_integrity", "is_valid_row", "quality_score",
        joined(F.col("rejection_reasons"), "rejection_reasons"),
        F.col("domain_normalize").alias("domain"),
        F.col("company_entity_resolve.company_id").alias("company_id"),
        F.col("legal_entity_extract.legal_name").alias("legal_name"),
        F.col("company_description_extract").alias("description"),
        F.col("pricing_locale_extract.currency_code").alias("currency_code"),
        F.col("experience_signal_extract.founding_year").alias("founding_year"),
        F.when(usable, F.coalesce(F.array_join(tools, "|"), F.lit(""))).alias("tools"),
        F.col("business_model.offering.primary").alias("offering"),
        joined(F.col("service_region_extract"), "places"),
        "locale_conflict",
    )


HAS_ROLES = "page_id in (select page_id from strict_roles union all select page_id from loose_final)"


def report_sql(select: str, tail: str = "") -> str:
    """The usable pages' field report as rows (page_id, field, ran, is_empty, source)."""
    rows = " union all ".join(f"select page_id, {s.q(f)} as field, true as ran, {test} as is_empty, {s.SOURCE[f]} as source from usable_pages"
                              for f, test in s.EMPTY.items())
    derived = "".join(f", {expr} as {name}" for g in ALL for name, expr in g.items())
    ctes = (
        f", {s.CAREERS_CTES}, usable_pages as (select *, {HAS_ROLES} as has_roles from (select page_id, source_url, company_name, "
        f"company_description, parent_guess, raw_date, current_year, coalesce(markdown, '') as md{derived} from site_pages) where usable), "
        f"field_rows as ({rows}) select {select} from field_rows {tail}"
    )
    return with_fixtures("site_pages", body=ctes)


@query(report_sql("page_id, field, ran, is_empty, source"))
def field_report(spark, sf_dir):
    return quality.explode_report(gated(spark, sf_dir), "page_id").select("page_id", "field", "ran", "is_empty", "source")


def launch_year() -> pf.FieldJob:
    """The first stated year of foundation; a page that states none is an error of this job."""

    def read(text: str) -> int:
        found = re.search(r"Founded in ([0-9]{4})", text)
        if not found:
            raise ValueError("no year of launch")
        return int(found[1])

    return pf.python_job("launch_year", read, "int")


def vendor_number() -> pf.FieldResult:
    """A number out of the company's name; other names are reported as what they are."""
    name = F.col("company_name")
    bad = ~F.startswith(name, F.lit("Vendor "))
    return pf.FieldResult(F.split(name, " ")[1].cast("int"), error=F.when(bad, F.concat(F.lit("no number in "), name)))


#: A Python job, a job whose expression raises (a cast of any text to a date) and one that names its error.
FAILING_JOBS = (
    pf.FieldJob("domain_normalize", pf.domain_normalize),
    launch_year(),
    pf.FieldJob("raw_year", lambda: pf.FieldResult(F.year(F.col("raw_date").cast("date")), F.lit("context")), isolated=True),
    pf.FieldJob("vendor_number", vendor_number),
    pf.FieldJob("after_launch", lambda: pf.FieldResult(F.col("launch_year") + 1), depends_on=("launch_year",)),
)
LAUNCH = "regexp_extract(md, 'Founded in ([0-9]{4})', 1)"
FAILURES = {
    "relevant": s.RELEVANT,
    "usable": "crawl_issue = 'none' and relevant",
    "domain": s.FIELD_COLUMNS["domain"],
    "launch_year": f"case when usable then cast(nullif({LAUNCH}, '') as integer) end",
    "no_launch": f"usable and {LAUNCH} = ''",
    "raw_year": "case when usable then year(try_cast(raw_date as date)) end",
    "no_date": "usable and raw_date is not null and try_cast(raw_date as date) is null",
    "no_number": "usable and coalesce(company_name not like 'Vendor %', false)",
    "vendor_number": "case when usable and not no_number then cast(nullif(split_part(company_name, ' ', 2), '') as integer) end",
}


@query(s.pages_sql(
    "page_id, case when usable then domain end as domain, launch_year, raw_year, vendor_number, launch_year + 1 as after_launch, "
    "concat_ws('|', case when no_launch then 'launch_year=ValueError: no year of launch' end, "
    "case when no_date then 'raw_year=raw_year: evaluation raised an error' end, "
    "case when no_number then 'vendor_number=no number in ' || company_name end) as errors, "
    "concat_ws('|', case when usable then 'domain_normalize' end, case when usable and not no_launch then 'launch_year' end, case when usable and not no_date then 'raw_year' end, "
    "case when usable and not no_number then 'vendor_number' end, case when usable then 'after_launch' end) as ran, "
    "case when usable and raw_year is not null then 'context' end as raw_year_source", s.TRIAGE_COLUMNS, FAILURES))
def field_failures(spark, sf_dir):
    """Jobs that fail on some pages leave those pages' other fields, and all other pages, as they are."""
    rows = plan.gate_pages(site_pages(spark, sf_dir), {}, FAILING_JOBS)
    report = F.filter("function_report", lambda r: r["ran"])
    year = F.filter("function_report", lambda r: (r["field"] == "raw_year") & ~r["is_empty"])
    return rows.select(
        "page_id", F.col("domain_normalize").alias("domain"), "launch_year", "raw_year", "vendor_number", "after_launch",
        F.array_join(F.transform("field_errors", lambda e: F.concat_ws("=", e["field"], e["error"])), "|").alias("errors"),
        joined(F.transform(report, lambda r: r["field"]), "ran"),
        t.first_or_null(F.transform(year, lambda r: r["source"])).alias("raw_year_source"),
    )


TOLERANCE = "(values " + ", ".join(f"({s.q(f)}, {c.null_tolerance_pct})" for f, c in PAGE_CONTRACTS.items()) + ") as k(field, null_tolerance_pct)"


@query(report_sql(
    "field, count(*) as rows, cast(sum(is_empty::int) as bigint) as empty_rows, sum(is_empty::int) * 100.0 / count(*) > "
    "any_value(null_tolerance_pct) as over_tolerance", f"join {TOLERANCE} using (field) group by field"))
def null_rate_vs_tolerance(spark, sf_dir):
    rows = quality.explode_report(gated(spark, sf_dir), "page_id")
    return quality.null_rate_vs_tolerance(rows, contracts_table(spark, PAGE_CONTRACTS)).select(
        "field", "rows", "empty_rows", "over_tolerance"
    )


@query(s.pages_sql("page_id, cast(score as double) as quality_score", *ALL) + " where usable")
def quality_score(spark, sf_dir):
    rows = quality.explode_report(gated(spark, sf_dir), "page_id")
    return quality.quality_scores(rows, contracts_table(spark, PAGE_CONTRACTS), "page_id")


@query(s.pages_sql(
    "page_id, (domain is null) as domain_missing, coalesce(entity_id, '') = '' as entity_missing", s.FIELD_COLUMNS))
def required_violations(spark, sf_dir):
    rows = fields(spark, sf_dir, *ENTITY_JOBS)
    return rows.withColumn("v", quality.required_violations(rows, PAGE_CONTRACTS)).select(
        "page_id",
        F.array_contains("v", "domain_normalize: required but missing").alias("domain_missing"),
        F.array_contains("v", "company_entity_resolve.company_id: required but missing").alias("entity_missing"),
    )


@query(s.pages_sql(
    "case when score >= 80 then 'green' when score >= 50 then 'amber' else 'red' end as band, "
    f"{FINAL_STATUS} as crawl_status, count(*) as rows, round(avg(score), 6) as mean_score", *ALL) + " group by 1, 2")
def quality_bands(spark, sf_dir):
    return report.quality_bands(gated(spark, sf_dir)).withColumn("mean_score", F.round("mean_score", 6))


@query(s.pages_sql(f"page_id, cast(score as double) as quality_score, is_valid_row, {FINAL_STATUS} as crawl_status, "
                   "case when usable then domain end as domain_normalize", *ALL))
def run_history(spark, sf_dir):
    return report.run_history(gated(spark, sf_dir))


GROUPS = "(values " + ", ".join(f"({s.q(n)}, {s.q(g)})" for g, names in cat.AUDIT_GROUPS.items() for n in names) + ") as g(field, grp)"


@query(report_sql("""grp as "group", field, is_empty, coalesce(source, 'empty') as source, count(*) as pages""", f"join {GROUPS} using (field) group by 1, 2, 3, 4"))
def audit_view(spark, sf_dir):
    return report.audit_view(gated(spark, sf_dir)).groupBy("group", "field", "is_empty", "source").agg(F.count(F.lit(1)).alias("pages"))


@query(s.pages_sql("page_id, case when len(languages) > 0 then '[\"' || array_to_string(languages, '\",\"') || '\"]' else '[]' end as languages, "
                   "case when coalesce(stated, lasting) is not null then '{' || '\"founding_year\":' || cast(founding_year as varchar) || "
                   "',\"founding_year_source\":\"' || founding_year_source || '\"' || "
                   "coalesce(',\"years_in_business_claim\":' || cast(duration as varchar), '') || '}' end as experience",
                   {k: s.FIELD_COLUMNS[k] for k in ("locale_hits", "languages")}, EXPERIENCE, {"stated": "founded", "lasting": "duration"}))
def flat_csv(spark, sf_dir):
    rows = fields(spark, sf_dir, "site_locale_detect", "experience_signal_extract")
    return flatten(
        rows.select("page_id", F.col("site_locale_detect").alias("languages"), F.col("experience_signal_extract").alias("experience"))
    )


@query(s.pages_sql("reasons[1] as reason, 'page' as source, count(*) as records, cast(sum(length(md)) as bigint) as raw_chars", *ALL)
       + " where not is_valid_row group by 1")
def dead_letters(spark, sf_dir):
    from enrichlake.sources.writers import dead_letters as letters

    return letters(gated(spark, sf_dir), "page").groupBy(
        t.first_or_null(F.col("reasons")).alias("reason"), "source"
    ).agg(F.count(F.lit(1)).alias("records"), F.sum(F.length("raw_input")).alias("raw_chars"))


PAGE_DRIFT_SQL = report_sql(
    "page_id, array_to_string(list(('drift_warning:' || field) order by ord), '|') as drift_warnings from (select *, "
    "count(*) over w as n, coalesce(sum(is_empty::int) over w, 0) as k, avg(is_empty::int) over w as mean, stddev_samp(is_empty::int) over w as sd "
    "from field_rows join (values " + ", ".join(f"({s.q(f)}, {i})" for i, f in enumerate(s.EMPTY)) + ") as o(field, ord) using (field) "
    "window w as (partition by field order by page_id rows between 19 preceding and 1 preceding)) "
    "where is_empty and n >= 5 and 1.0 > least(mean + 2 * sd, 1.0) group by page_id --") + "\n"


@query(PAGE_DRIFT_SQL)
def page_drift_warnings(spark, sf_dir):
    rows = gated(spark, sf_dir)
    warned = plan.drift_warnings(rows, "page_id", [j.name for j in pf.PAGE_JOBS if j.reported])
    return warned.select("page_id", joined(F.col("drift_warnings"), "drift_warnings"))


@query(f"select g.page_id, g.is_valid_row, coalesce(w.drift_warnings, '') as drift_warnings, row_number() over (order by g.is_valid_row desc, g.page_id) as pos "
       f"from ({GATED_SQL}) g left join ({PAGE_DRIFT_SQL}) w on w.page_id = g.page_id")
def process_batch(spark, sf_dir):
    """Q12 as two batches over a kept history, the second sent twice; each comes out valid rows first."""
    pages = site_pages(spark, sf_dir)
    middle = table(spark, sf_dir, "documents").agg(F.floor(F.avg("doc_id"))).first()[0]
    kept = History(spark, shared_folder(spark, "batches"))
    stamp = F.lit("2026-01-01").cast("timestamp")
    out = []
    for batch, rows in (("a", pages.where(F.col("page_id") <= middle)), ("b", pages.where(F.col("page_id") > middle)), ("b", pages.where(F.col("page_id") > middle))):
        done = plan.process_delivery(rows, kept, batch, run_timestamp=stamp)
        # What the order of a batch says is kept as a number, as the two batches meet below.
        out.append(done.select("page_id", "is_valid_row", joined(F.col("drift_warnings"), "drift_warnings"), F.monotonically_increasing_id().alias("at")))
    both = out[0].withColumn("batch", F.lit(0)).unionByName(out[-1].withColumn("batch", F.lit(1)))
    numbered = number_rows(both.withColumn("rejected", ~F.col("is_valid_row")), ["rejected", "batch", "at"])
    return numbered.select("page_id", "is_valid_row", "drift_warnings", F.col("rn").cast("bigint").alias("pos"))
