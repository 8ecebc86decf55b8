"""Inputs derived from the given tables, in SQL that both engines run unchanged.

The given texts hold none of the signals a company page has. Each view below
therefore builds its rows from one given row: the whole text of a document with
company sections around it, a customer as a person, a supplier as a company. All
rows of the table take part, so the work grows with it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from enrichlake.operators.skew import spread_scan

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)


def _when(test: str, *parts: str) -> str:
    return f"case when {test} then concat({', '.join(parts)}) else '' end"


# Vendors, employers and companies grow with the tables they come from.
_VENDORS = "(select cast(floor(count(*) * 0.4) as int) from documents)"
_EMPLOYERS = "(select cast(floor(count(*) * 1.2) as int) from supplier)"
_COMPANIES = "(select cast(floor(count(*) * 0.5) as int) from supplier)"
_N = "vendor"
_NL = "chr(10), chr(10)"

SITE_PAGES = f"""
select doc_id as page_id,
  case when doc_id % 10 = 9 then null
       else concat('https://www.s', {_N}, '.example.com/about?utm_source=x') end as source_url,
  case when doc_id % 13 = 0 then concat('Vendor ', {_N}, ' Inc') when doc_id % 13 = 1 then 'Other Brand' end as company_name,
  case when doc_id % 17 = 0 then '  A company summary somebody wrote.  ' end as company_description,
  case when doc_id % 19 = 0 then 'Group Seven' end as parent_guess,
  case when doc_id % 23 = 0 then '2020-01-01' when doc_id % 23 = 1 then 'next spring' end as raw_date,
  2026 as current_year,
  case when doc_id % 43 = 0 then concat(' ', chr(10)) else concat(
    '# Vendor ', {_N}, ' Corp', {_NL},
    {_when("doc_id % 31 = 0", "'We use cookies to improve this site.'", _NL)},
    case when doc_id % 5 = 2 then 'A short line.' else concat('- *Vendor ', {_N}, '* Corp is a cloud-based SaaS  platform for revenue teams, kept by ', source, '.') end, {_NL},
    {_when("doc_id % 3 = 0", "'Vendor Corp is a subsidiary of Holding '", "cast(doc_id % 50 as string)", "', and grows.'", _NL)},
    {_when("doc_id % 4 = 0", "'Founded in '", "cast(1990 + doc_id % 30 as string)", "'. Our SOC 2 and ISO 27001 audits date from 2019-03-03 and 3/14/2021, not 2020-13-45.'", _NL)},
    {_when("doc_id % 4 = 1", "'We have over '", "cast(5 + doc_id % 40 as string)", "' years in business, since March 5, 2018.'", _NL)},
    {_when("doc_id % 6 = 2", "'We integrate with Segment, Google  Analytics and Snowflake on AWS. Call us pay as you go.'", _NL)},
    {_when("doc_id % 6 = 4", "'Teams run Salesforce and GitHub. Sign up free or book a demo; consulting and hardware devices too.'", _NL)},
    {_when("doc_id % 5 = 0", "'Available in: '", "case lang when 'de' then 'German (DE), English (EN).' when 'fr' then 'French (FR).' when 'es' then 'Spanish (ES), English.' else 'English (EN), Deutsch.' end", _NL)},
    {_when("doc_id % 59 = 0", "'Our new site is coming soon.'", _NL)},
    {_when("doc_id % 61 = 0", "'The lottery jackpot winning numbers.'", _NL)},
    {_when("doc_id % 29 = 0", "'Please verify you are human first.'", _NL)},
    {_when("doc_id % 37 = 0", "'This domain is for sale.'", _NL)},
    {_when("doc_id % 41 = 0", "'Sign in to continue reading.'", _NL)},
    {_when("doc_id % 47 = 0", "'Top 10 vendors'", _NL, "'Vendor A 4.8/5'", _NL, "'Vendor B 4 stars'", _NL, "'Vendor C 3.9 / 5'", _NL)},
    {_when("doc_id % 53 = 0", "'7 tips and how to grow.'", _NL)},
    {_when("doc_id % 106 = 0", "'Acme Works sells.'", _NL, "'## Acme Works builds.'", _NL, "'Acme Works ships.'", _NL)},
    {_when("doc_id % 67 = 0", "'Lorem ipsum dolor.'", _NL)},
    {_when("doc_id % 2 = 0", "'## Plans and Pricing'", _NL, "'- Starter: '", "case when doc_id % 8 = 0 then '€' when doc_id % 8 = 2 then 'GBP ' else '$' end", "cast(10 + n_chars % 90 as string)", "case when doc_id % 3 = 0 then ' per user' when doc_id % 3 = 1 then '/mo' else ' one-time fee' end", "chr(10)", "'- Growth: $1,200.50'", _NL, "'### Notes'", _NL, "'Billed at USD 5 each.'", _NL)},
    {_when("doc_id % 7 = 3", "'© 2010 Previous Owner Ltd'", _NL)},
    {_when("doc_id % 6 = 0", "'## Careers'", _NL, "'- **Engineer** - Engineering - Austin, TX - Posted 2024-01-15'", "chr(10)", "'- Account Executive — Sales — Remote (EU) — Posted 2024-02-01'", "chr(10)", "'Write to us.'", _NL)},
    {_when("doc_id % 6 = 1", "'## Open Positions'", _NL, "'### Data Analyst, Analytics, Berlin'", "chr(10)", "'- Product Designer - Design (Remote)'", "chr(10)", "'- Account Executive 2024-05-06 new'", "chr(10)", "'- account executive'", "chr(10)", "'- This role title goes on for much too many words to be true'", _NL)},
    {_when("doc_id % 8 = 5", "'Offices in Berlin, Germany and Austin, TX. Remote (EU) and Texas are fine; AB, TX is not.'", _NL)},
    '## Story', {_NL}, text, {_NL},
    '## Footer', {_NL},
    case when doc_id % 9 = 4 then 'All pages by hand.' else concat('© 2024 Vendor ', {_N}, ' Corp. All rights reserved.') end, chr(10),
    {_when("doc_id % 4 < 3", "'[LinkedIn](https://www.linkedin.com/company/v'", _N, "')'", "chr(10)")},
    {_when("doc_id % 8 = 6", "'[Video](https://youtube.com/v) and [Post](https://x.com/v)'", "chr(10)")},
    {_when("doc_id % 8 = 3", "'See https://www.g2.com/products/v or https://twitter.com/v today'", "chr(10)")}
  ) end as markdown
from (select *, cast(doc_id % {_VENDORS} as string) as vendor from documents) d
"""

DETECTED = """
select p_partkey as page_id, '' as markdown,
  concat(p_brand, '|', case p_partkey % 6 when 0 then 'HubSpot CRM' when 1 then 'google analytics 4' when 2 then 'Segment'
    when 3 then 'hubspot' when 4 then '  Odd-Tool v2 ' else '!!' end, '|', p_name, '|', p_type, '|', p_brand) as tools
from part
"""

COMPANIES = """
select s_suppkey as company_id, concat('Vendor ', cast(s_suppkey as string), ' Corp') as name,
  case when s_suppkey % 10 = 9 then null else concat('s', cast(s_suppkey as string), '.example.com') end as domain,
  concat('https://www.linkedin.com/company/v', cast(s_suppkey as string), case when s_suppkey % 2 = 0 then '/' else '' end) as linkedin_url,
  case when s_suppkey % 3 = 0 then 'Banking' when s_suppkey % 3 = 1 then 'Financial Services' else 'Software Development' end as industry,
  case when s_suppkey % 4 = 0 then '11-50' when s_suppkey % 4 = 1 then '51-200' when s_suppkey % 4 = 2 then '201-500' else '501-1,000' end as company_size,
  n_name as hq_country, (s_suppkey * 37) % 12000 as headcount,
  concat('Tools for ', case when s_suppkey % 5 = 0 then 'b2b saas teams' when s_suppkey % 5 = 1 then 'retail data' else 'shipping' end) as products_and_services,
  concat('We help ', lower(n_name), ' firms with Analytics.') as description,
  s_acctbal
from supplier join nation on s_nationkey = n_nationkey
"""

PEOPLE = f"""
select c_custkey as person_id,
  concat(case when c_custkey % 9 = 0 then 'Dr ' else '' end, 'Ada ', case when c_custkey % 5 = 0 then 'K. ' else '' end,
    case when c_custkey % 11 = 0 then '(Addie) ' else '' end, 'Person', cast(c_custkey as string),
    case when c_custkey % 4 = 0 then ', PharmD, M.B.A.' else '' end) as full_name,
  case c_custkey % 9 when 0 then 'VP of Sales' when 1 then 'Chief Executive Officer' when 2 then 'Director of Sales'
    when 3 then 'Engineering Manager' when 4 then 'Sales Assistant' when 5 then 'Vice President'
    when 6 then 'Managing Partner' when 7 then 'GP & Analyst' else 'Analyst' end as job_title,
  case when c_custkey % 3 = 0 then null else concat('s', cast(c_custkey % {_EMPLOYERS} as string), '.example.com') end as company_domain,
  concat('Vendor ', cast(c_custkey % {_EMPLOYERS} as string), ' Corp') as company_name,
  (c_custkey * 13) % 900 as connections, c_mktsegment, n_name as country,
  concat('Building at Acme Corp. Follow @user', cast(c_custkey as string), ' on https://me.example.com/', cast(c_custkey as string), '. ',
    case when c_custkey % 3 = 0 then 'I work on machine learning and fintech. Hiring for ' else 'I like walks @ ' end,
    n_name, ' Sales.') as about
from customer join nation on c_nationkey = n_nationkey
"""

EXPERIENCE = f"""
select o_custkey as person_id, o_orderkey as pos,
  concat('Company ', cast(o_orderkey % {_COMPANIES} as string)) as company,
  concat('https://www.linkedin.com/company/c', cast(o_orderkey % {_COMPANIES} as string), case when o_orderkey % 2 = 0 then '/' else '' end) as company_url,
  o_orderpriority as title,
  case when o_orderkey % 7 = 0 then cast(year(o_orderdate) as string) when o_orderkey % 11 = 0 then 'sometime'
       else substr(cast(o_orderdate as string), 1, 7) end as start_date,
  case when o_orderstatus = 'O' then 'Present' when o_orderkey % 13 = 0 then null else cast(year(o_orderdate) + 1 as string) end as end_date
from orders
"""

CANDIDATES = """
select c_custkey as entity_id, 'company_name' as field, 0 as ord, 'profile' as source,
  case when c_custkey % 6 = 0 then null else concat(' Cust ', cast(c_custkey as string)) end as value,
  c_custkey % 5 = 0 as is_structured, concat('2026-0', cast(1 + c_custkey % 3 as string), '-01') as observed_at, 0.5 as confidence from customer
union all select c_custkey, 'company_name', 1, 'page',
  case when c_custkey % 4 = 0 then '' when c_custkey % 3 = 0 then concat('Other ', cast(c_custkey as string)) else concat('CUST ', cast(c_custkey as string)) end,
  c_custkey % 7 = 0, '2026-02-01', 0.25 from customer
union all select o_orderkey, 'founded_year', 0, 'profile', cast(year(o_orderdate) as string), false, '', 0.5 from orders
union all select o_orderkey, 'founded_year', 1, 'page', concat(' ', cast(year(o_orderdate) + o_orderkey % 2 as string), ' '), false, '', 0.25 from orders
union all select o_orderkey, 'founded_year', 2, 'registry', case when o_orderkey % 3 = 0 then null else cast(1900 + o_orderkey % 100 as string) end, false, '', 0.75 from orders
union all select o_custkey, 'city', o_orderkey, concat('order ', o_orderpriority), concat('Town ', o_orderstatus), false, '', 0.5 from orders
"""

POSTS = """
select event_id as post_id, user_id as person_id, ts as posted_at,
  case when event_type = 'view' then null else cast(floor(value) as int) end as reactions,
  cast(event_id % 7 as int) as comments from events
"""

DRIFT_HISTORY = """
select event_type as field, ts, event_id as seq, value > 150 as is_empty from events
"""

# One client per nation and brand; lists are texts, parted by |.
PROFILES = """
select concat(n_name, '-', p_brand) as client_id, concat('Client ', p_brand) as name,
  case k % 4 when 0 then 'Banking' when 1 then 'Banking|Financial Services' when 2 then 'Software Development' else '' end as industries,
  case k % 3 when 0 then '11-50|51-200' when 1 then '' else '201-500' end as company_size_buckets,
  case when k % 5 = 0 then '' when k % 5 = 1 then concat(n_name, '|NATION_0|NATION_1|NATION_2') else n_name end as hq_countries,
  case when k % 7 = 0 then 'x' when k % 7 = 1 then 'nowhere' else '' end as hq_cities,
  case when k % 6 = 0 then 'SegmentCo' when k % 6 = 1 then 'z|other' else '' end as technologies,
  case k % 8 when 0 then concat('analytics|', lower(n_name)) when 1 then 'WE help' when 2 then 'an' else '' end as description_keywords,
  case k % 9 when 0 then 'b2b saas' when 1 then 'retail data|b2b things' when 2 then 'tools of no kind at all' else '' end as products_and_services,
  case when k % 10 = 0 then 's3.example.com|s6.example.com' else '' end as exclude_domains,
  case k % 3 when 0 then 'Sales|Chief Executive Officer' when 1 then 'Partner' else '' end as people_job_title_include,
  case when k % 6 = 0 then 'Assistant' else '' end as people_job_title_exclude
from (select n_nationkey, n_name, p_brand, count(*) + n_nationkey * 7 + cast(replace(p_brand, 'Brand#', '') as int) * 11 as k
  from nation cross join part group by n_nationkey, n_name, p_brand)
"""

# The names of all parts, and the first words of every benchmark passage and document, as a dictionary.
ALIASES = """
select p_partkey as ord, concat('part ', cast(p_partkey as string)) as code, p_brand as category, p_name as alias from part
union all select 1000000000 + item_id, concat('passage ', cast(item_id as string)), 'benchmark',
  regexp_extract(text, '^[A-Za-z]+ [a-z]+( [a-z]+)?', 0) from benchmark
union all select 2000000000 + doc_id, concat('opening ', cast(doc_id as string)), lang, regexp_extract(text, '^[A-Za-z]+ [a-z]+( [a-z]+)?', 0) from documents
"""

# Chains of parents up to 45 steps, circles of three, and a hub under which a third of all parts stand.
PARENTS = """
select concat('p', cast(p_partkey as string)) as entity,
  case when p_partkey % 50 in (1, 2) then concat('p', cast(p_partkey + 1 as string)) when p_partkey % 50 = 3 then concat('p', cast(p_partkey - 2 as string))
    when p_partkey % 50 = 0 then null when p_partkey % 50 = 4 then 'named only as a parent'
    when p_partkey % 3 = 0 then 'hub' else concat('p', cast(p_partkey - 1 as string)) end as parent from part
union all select 'hub', 'top'
"""

# Employers of more people than there are companies for, spelt in four ways.
EMPLOYERS = """
select c_custkey as person_id, case c_custkey % 4 when 0 then concat('Vendor ', k, ' Corp') when 1 then concat('VENDOR, ', k, ' & Sons Inc.')
  when 2 then concat('The ', k, ' vendor') else concat('Unknown Firm ', k) end as employed_company
from (select c_custkey, cast(c_custkey % cast(floor(n * 1.25) as int) as string) as k from customer, (select cast(count(*) as int) as n from supplier))
"""

FIXTURES = {
    "parents": PARENTS,
    "employers": EMPLOYERS,
    "profiles": PROFILES,
    "aliases": ALIASES,
    "site_pages": SITE_PAGES,
    "detected": DETECTED,
    "companies": COMPANIES,
    "people": PEOPLE,
    "experience": EXPERIENCE,
    "candidates": CANDIDATES,
    "posts": POSTS,
    "drift_history": DRIFT_HISTORY,
}


# Tables each fixture reads.
READS = {
    "parents": ("part",),
    "employers": ("customer", "supplier"),
    "profiles": ("nation", "part"),
    "aliases": ("part", "benchmark", "documents"),
    "site_pages": ("documents",),
    "detected": ("part",),
    "companies": ("supplier", "nation"),
    "people": ("customer", "nation", "supplier"),
    "experience": ("orders", "supplier"),
    "candidates": ("customer", "orders"),
    "posts": ("events",),
    "drift_history": ("events",),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    for read in READS[name]:
        table(spark, sf_dir, read).createOrReplaceTempView(read)
    rows = spark.sql(FIXTURES[name])
    # The given tables are one file each; text work would run in a single task.
    return spread_scan(rows) if name in ("site_pages", "experience", "people") else rows


def with_fixtures(*names: str, body: str) -> str:
    """SQL text: the fixtures as common table expressions, then `body`."""
    ctes = ",\n".join(f"{n} as ({FIXTURES[n]})" for n in names)
    return f"with {ctes}\n{body}"
