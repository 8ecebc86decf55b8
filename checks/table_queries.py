"""Queries over companies, people, candidates and histories."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from enrichlake.contracts import Contract, company_contracts, person_contracts
from enrichlake.functions import catalogs as cat
from enrichlake.functions import profiles as pr
from enrichlake.operators import bronze, drift, entities, icp, icp_many, people, quality, resolve
from enrichlake.operators import profiles as pj
from enrichlake.plans import companies as cp
from enrichlake.plans import pages as plan
from enrichlake.plans.history import History
from enrichlake.plans.resolution import Resolution
from enrichlake.session import checkpointed, shared_folder
from enrichlake.sources import readers, writers
from enrichlake.streaming.drift import closing_row, drift_stream

from . import page_sql as s
from .fixtures import fixture, table, with_fixtures
from .page_queries import gated
from .registry import query

AS_OF = "2000-06-30"


def as_of():
    return F.lit(AS_OF).cast("date")


# --- Q10, Q14 ---------------------------------------------------------------------
@query(with_fixtures("drift_history", body="""select field, seq, n as previous, k as previous_empty, is_empty and n >= 5
  and 1.0 > least(mean + 2 * sd, 1.0) as drifting from (select *, count(*) over w as n, cast(coalesce(sum(is_empty::int) over w, 0) as bigint) as k,
  avg(is_empty::int) over w as mean, stddev_samp(is_empty::int) over w as sd from drift_history
  window w as (partition by field order by ts, seq rows between 19 preceding and 1 preceding))"""))
def drift_flags(spark, sf_dir):
    return drift.drift_flags(fixture(spark, sf_dir, "drift_history"), block_rows=256).select(
        "field", "seq", "previous", "previous_empty", F.coalesce("drifting", F.lit(False)).alias("drifting")
    )


def drift_deliveries(spark, sf_dir) -> list[DataFrame]:
    """The observations in four parts of the time they span."""
    rows = fixture(spark, sf_dir, "drift_history").withColumn("at", F.unix_micros(F.col("ts").cast("timestamp")))
    first, last = rows.agg(F.min("at"), F.max("at")).first()
    part = F.floor((F.col("at") - first) * 4 / (last - first + 1))
    return [rows.where(part == i).drop("at") for i in range(4)]


ONE_SHOT_DRIFT = with_fixtures("drift_history", body="""select field, seq, n as previous, k as previous_empty, coalesce(is_empty and n >= 5
  and 1.0 > least(mean + 2 * sd, 1.0), false) as drifting from (select *, count(*) over w as n, cast(coalesce(sum(is_empty::int) over w, 0) as bigint) as k,
  avg(is_empty::int) over w as mean, stddev_samp(is_empty::int) over w as sd from drift_history
  window w as (partition by field order by ts, seq rows between 19 preceding and 1 preceding))""")


@query(ONE_SHOT_DRIFT)
def drift_incremental(spark, sf_dir):
    """Four deliveries, the third one sent twice; each reads only the tails of the one before."""
    kept = History(spark, shared_folder(spark, "drift-history"))
    parts = drift_deliveries(spark, sf_dir)
    for batch in (0, 1, 2, 2, 3):
        kept.deliver(parts[batch], f"part-{batch}")
    flags = [kept.flags(f"part-{batch}") for batch in range(4)]
    return reduce(DataFrame.unionByName, flags).select("field", "seq", "previous", "previous_empty", "drifting")


@query(ONE_SHOT_DRIFT)
def drift_streamed(spark, sf_dir):
    """The same observations as a stream of shuffled files; a closing row drains it."""
    folder = shared_folder(spark, "drift-stream")
    rows = fixture(spark, sf_dir, "drift_history").select("field", F.col("ts").cast("timestamp").alias("ts"), F.col("seq").cast("bigint").alias("seq"), "is_empty")
    for part in (rows.repartition(6, F.xxhash64("seq")), closing_row(rows)):
        part.write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 3).parquet(f"{folder}/in")
        drift_stream(stream, f"{folder}/out", f"{folder}/state", "3650 days").awaitTermination()
    return spark.read.parquet(f"{folder}/out").select("field", "seq", "previous", "previous_empty", "drifting")


@query(with_fixtures("drift_history", body="select field, count(*) as observations, cast(sum(is_empty::int) as bigint) as empty_rows, min(seq) as first_seq from drift_history group by field"))
def quality_history(spark, sf_dir):
    """Batches written, one of them again, and read back by key."""
    path = shared_folder(spark, "quality-history")
    for batch, rows in enumerate([*drift_deliveries(spark, sf_dir), drift_deliveries(spark, sf_dir)[1]]):
        writers.append_quality_history(rows, path, f"b{batch % 4 if batch < 4 else 1}")
    history = spark.read.parquet(path)
    keys = [r["field"] for r in history.select("field").distinct().collect()]
    return reduce(DataFrame.unionByName, [drift.read_history(history, k) for k in keys]).groupBy("field").agg(
        F.count(F.lit(1)).alias("observations"), F.sum(F.col("is_empty").cast("long")).alias("empty_rows"), F.min("seq").cast("long").alias("first_seq")
    )


@query(with_fixtures("drift_history", body="select field, count(*) as observations, cast(sum(is_empty::int) as bigint) as empty_rows "
                     "from drift_history where field = 'click' group by field"))
def read_history(spark, sf_dir):
    return drift.read_history(fixture(spark, sf_dir, "drift_history"), "click").groupBy("field").agg(
        F.count(F.lit(1)).alias("observations"), F.sum(F.col("is_empty").cast("long")).alias("empty_rows")
    )


# --- R1-R7 ------------------------------------------------------------------------
NORM = """case when value is null or value = '' then null when field = 'company_name' then lower(trim(value))
  when field = 'founded_year' and regexp_matches(trim(value), '^[0-9]+$') then cast(cast(trim(value) as bigint) as varchar) else value end"""


def resolve_sql(field: str, marks: str, order: str) -> str:
    """Group by normalized value, order the groups by `marks`, count those that share the best."""
    return with_fixtures("candidates", body=f""", c as (select *, {NORM} as norm from candidates where field = '{field}'),
g as (select entity_id, norm, count(*) as votes, min(ord) as ord, arg_min(value, ord) as value, arg_min(source, ord) as source,
  max({marks}) as mark from c where norm is not null group by entity_id, norm),
r as (select *, rank() over (partition by entity_id order by {order}) as place, count(*) over (partition by entity_id) as groups,
  row_number() over (partition by entity_id order by {order}, ord) as rn from g),
w as (select entity_id, any_value(groups) as groups, count_if(place = 1) as best, max(value) filter (rn = 1) as value,
  max(source) filter (rn = 1) as source from r group by entity_id)
select e.entity_id, w.value, w.source, coalesce(groups > 1, false) as conflict, coalesce(groups > 1 and best > 1, false) as ambiguous, n as candidate_count
from (select entity_id, count(*) as n from c group by entity_id) e left join w using (entity_id)""")


def resolved(spark, sf_dir, field: str, *criteria: resolve.Criterion) -> DataFrame:
    normalize = {"company_name": "lower_strip", "founded_year": "int", "city": None}[field]
    cands = fixture(spark, sf_dir, "candidates").where(F.col("field") == field)
    return resolve.resolve_candidates(cands, {field: resolve.Rule(criteria, normalize)}).drop("field")


def rank_sql(names) -> str:
    return "case source " + " ".join(f"when '{n}' then {-i}" for i, n in enumerate(names)) + f" else {-len(names)} end"


@query(resolve_sql("founded_year", rank_sql(("registry", "page", "profile")), "mark desc"))
def source_resolve_rank(spark, sf_dir):
    return resolved(spark, sf_dir, "founded_year", *resolve.default_rules()["founded_year"].criteria)


@query(resolve_sql("company_name", "{'a': is_structured::int, 'b': observed_at}", "mark.a desc, mark.b desc"))
def source_resolve_chain(spark, sf_dir):
    return resolved(
        spark, sf_dir, "company_name", resolve.Criterion("prefer_structured"), resolve.Criterion("most_recent")
    )


@query(resolve_sql("city", "0", "votes desc"))
def source_resolve_ambiguous(spark, sf_dir):
    return resolved(spark, sf_dir, "city", resolve.Criterion("majority_vote"))


@query(resolve_sql("founded_year", "confidence", "mark desc"))
def source_resolve_confidence(spark, sf_dir):
    return resolved(spark, sf_dir, "founded_year", resolve.Criterion("highest_confidence"))


#: One rule per field; a town goes by votes, then by its newest candidate.
ALL_RULES = {
    "founded_year": resolve.Rule((resolve.Criterion("static_rank", ("registry", "page", "profile")),), "int"),
    "company_name": resolve.Rule((resolve.Criterion("prefer_structured"), resolve.Criterion("most_recent")), "lower_strip"),
    "city": resolve.Rule((resolve.Criterion("majority_vote"), resolve.Criterion("highest_confidence"))),
}
ALL_RULES_SQL = with_fixtures("candidates", body=f""", c as (select *, {NORM} as norm from candidates),
g as (select entity_id, field, norm, count(*) as votes, min(ord) as ord, arg_min(value, ord) as value, arg_min(source, ord) as source,
  max({rank_sql(("registry", "page", "profile"))}) as rank_mark, max(is_structured::int) as structured, max(nullif(observed_at, '')) as newest, max(confidence) as trust
  from c where norm is not null group by entity_id, field, norm),
m as (select *, case field when 'founded_year' then rank_mark when 'company_name' then structured else votes end as m1,
  case field when 'company_name' then newest when 'city' then cast(trust as varchar) end as m2 from g),
r as (select *, rank() over (partition by entity_id, field order by m1 desc nulls last, m2 desc nulls last) as place,
  count(*) over (partition by entity_id, field) as groups,
  row_number() over (partition by entity_id, field order by m1 desc nulls last, m2 desc nulls last, ord) as rn from m),
b as (select entity_id, field, max(groups) as groups, count(*) filter (place = 1) as best, max(value) filter (rn = 1) as value, max(source) filter (rn = 1) as source
  from r group by entity_id, field)
select c.entity_id, c.field, any_value(b.value) as value, any_value(b.source) as source, coalesce(any_value(b.groups) > 1, false) as conflict,
  coalesce(any_value(b.groups) > 1 and any_value(b.best) > 1, false) as ambiguous, count(*) as candidate_count
from c left join b on b.entity_id = c.entity_id and b.field = c.field group by c.entity_id, c.field""")


@query(ALL_RULES_SQL)
def source_resolve_all(spark, sf_dir):
    """R1 to R7 over every field at once, each by its own rule."""
    out = resolve.resolve_candidates(fixture(spark, sf_dir, "candidates"), ALL_RULES)
    return out.withColumns({c: F.coalesce(c, F.lit(False)) for c in ("conflict", "ambiguous")})


@query(ALL_RULES_SQL)
def resolve_incremental(spark, sf_dir):
    """The same candidates in three deliveries; the first comes short and late again as a whole."""
    rows = fixture(spark, sf_dir, "candidates")
    part = F.pmod(F.col("entity_id") + F.col("ord"), F.lit(3))
    kept = Resolution(spark, shared_folder(spark, "resolution"), ALL_RULES, buckets=32)
    kept.deliver(rows.where((part == 0) & (F.col("entity_id") % 2 == 0)), "first")
    kept.deliver(rows.where(part == 1), "second")
    kept.deliver(rows.where(part == 0), "first")
    kept.deliver(rows.where(part == 2), "third")
    out = kept.resolved()
    return out.withColumns({c: F.coalesce(c, F.lit(False)) for c in ("conflict", "ambiguous")})


@query(with_fixtures("candidates", body="select entity_id, field, source, arg_max_null(value, ord) as value from candidates "
                     "group by all"))
def raw_values(spark, sf_dir):
    return resolve.raw_values(fixture(spark, sf_dir, "candidates"))


# --- B1-B5, B12 -------------------------------------------------------------------
# Items as fetched: a repeated item per third company, URLs with other slashes.
ITEMS = """select s_suppkey * 2 + r as pos, case when s_suppkey % 7 = 0 then null else
  concat('https://www.linkedin.com/company/v', cast(s_suppkey as string), case when s_suppkey % 3 = 0 then '//' else '' end) end as url,
  concat(n_name, ' ', cast(r as string)) as label from supplier join nation on s_nationkey = n_nationkey
  join (select 0 as r union all select 1) on s_suppkey % 3 = 0 or r = 0"""


def item_rows(spark, sf_dir) -> DataFrame:
    for t in ("supplier", "nation"):
        table(spark, sf_dir, t).createOrReplaceTempView(t)
    return spark.sql(ITEMS)


@query(with_fixtures("companies", body=f""", items as ({ITEMS}), last as (select rtrim(url, '/') as k, arg_max(label, pos) as label from items
  where url is not null group by 1)
select company_id, name, domain, linkedin_url, label from companies left join last on k = rtrim(linkedin_url, '/')"""))
def spine_left_join(spark, sf_dir):
    items = item_rows(spark, sf_dir).select(
        "pos", F.to_json(F.struct(F.col("url").alias("linkedinUrl"), "label")).alias("raw")
    )
    out = bronze.attach_raw_by_url(fixture(spark, sf_dir, "companies"), items)
    return out.select(*bronze.COMPANY_SPINE, F.get_json_object("scrape_json", "$.label").alias("label"))


@query(with_fixtures("people", body=f""", items as ({ITEMS}), last as (select rtrim(url, '/') as k, arg_max(label, pos) as label from items
  where url is not null group by 1)
select person_id as profile_id, full_name as name, concat('https://www.linkedin.com/company/v', cast(person_id % 120 as string)) as linkedin_url, label
from people left join last on k = concat('https://www.linkedin.com/company/v', cast(person_id % 120 as string))"""))
def profiles_by_query_url(spark, sf_dir):
    items = item_rows(spark, sf_dir).select(
        "pos",
        F.to_json(
            F.struct(F.lit("https://renamed").alias("linkedinUrl"), F.struct("url").alias("originalQuery"), "label")
        ).alias("raw"),
    )
    spine = fixture(spark, sf_dir, "people").select(
        F.col("person_id").alias("profile_id"),
        F.col("full_name").alias("name"),
        F.concat(F.lit("https://www.linkedin.com/company/v"), (F.col("person_id") % 120).cast("string")).alias("linkedin_url"),
    )
    out = bronze.attach_profiles_by_query_url(spine, items)
    return out.select(*bronze.PERSON_SPINE, F.get_json_object("profile_json", "$.label").alias("label"))


@query("select distinct url from pages where url is not null and url <> '' order by url")
def request_dedup(spark, sf_dir):
    return bronze.distinct_request_keys(table(spark, sf_dir, "pages"), "url")


@query(with_fixtures("companies", body="""select company_id, name, case when s_acctbal > 0 then 'scraped' end as scrape_json,
  case when headcount > 2000 then 'profiled' end as profile_json from companies"""))
def bronze_merge(spark, sf_dir):
    c = fixture(spark, sf_dir, "companies")
    scraped = c.where(F.col("s_acctbal") > 0).select("company_id", F.lit("scraped").alias("scrape_json"))
    profiled = c.where(F.col("headcount") > 2000).select("company_id", F.lit("profiled").alias("profile_json"))
    return bronze.merge_bronze_branches(
        c.select("company_id", "name"), [(scraped, "scrape_json"), (profiled, "profile_json")]
    )


FETCHES = """select domain, case when company_id % 4 = 0 then null else concat('# ', name) end as markdown,
  case when company_id % 4 = 0 then null else concat('https://www.', domain, '/home') end as source_url from companies
  where domain is not null and company_id % 3 <> 0"""


@query(with_fixtures("companies", body=f""", fetches as ({FETCHES}) select company_id as page_id, coalesce(markdown, '') as markdown,
  coalesce(source_url, 'https://' || c.domain) as source_url from companies c left join fetches f on c.domain = f.domain"""))
def build_page_inputs(spark, sf_dir):
    c = fixture(spark, sf_dir, "companies")
    c.createOrReplaceTempView("companies")
    return bronze.build_page_inputs(c, spark.sql(FETCHES))


@query("select page_id, coalesce(case when page_id % 3 > 0 then url end, 'https://asked/' || page_id) as source_url from pages")
def pages_from_fetches(spark, sf_dir):
    fetched = table(spark, sf_dir, "pages").select(
        "page_id",
        F.when(F.col("page_id") % 3 > 0, F.col("url")).alias("source_url"),
        F.concat(F.lit("https://asked/"), F.col("page_id").cast("string")).alias("requested_url"),
    )
    return bronze.pages_from_fetch_table(fetched).select("page_id", "source_url")


@query(with_fixtures("posts", body="select person_id, count(*) as posts, min(post_id) as first_post from posts "
                     "where posted_at >= timestamp '2024-01-15' group by person_id"))
def posts_in_window(spark, sf_dir):
    recent = bronze.posts_in_window(fixture(spark, sf_dir, "posts"), 1, F.lit("2024-02-15").cast("date"))
    return recent.groupBy("person_id").agg(F.count(F.lit(1)).alias("posts"), F.min("post_id").alias("first_post"))


@query(with_fixtures("posts", body="select person_id, post_id from (select *, row_number() over (partition by person_id order by posted_at desc, post_id) as rn "
                     "from posts where posted_at >= timestamp '2023-08-29') where rn <= 3"))
def posts_newest(spark, sf_dir):
    recent = bronze.posts_in_window(fixture(spark, sf_dir, "posts"), 6, F.lit("2024-02-29").cast("date"), 3)
    return recent.select("person_id", "post_id")


# --- B6-B11, B13-B17 ----------------------------------------------------------------
CLIENT = icp.Icp(
    "client", "Client",
    industries=("Banking", "Financial Services"),
    company_size_buckets=("11-50", "51-200", "201-500"),
    hq_countries=tuple(f"NATION_{i}" for i in range(20)),
    technologies=("SegmentCo",),
    products_and_services=("b2b saas", "retail data"),
    description_keywords=("analytics",),
    exclude_domains=("s3.example.com", "s6.example.com"),
    people_job_title_include=("Sales", "Chief Executive Officer", "Vice President"),
    people_job_title_exclude=("Assistant",),
    limit=100,
)


def nested_companies(spark, sf_dir) -> DataFrame:
    """Companies with one headquarters, one branch and one or no technology."""
    place = "named_struct('is_headquarters', {0}, 'country_name', {1}, 'city', 'x')"
    return fixture(spark, sf_dir, "companies").selectExpr(
        "*",
        f"array({place.format('true', 'hq_country')}, {place.format('false', chr(39) + 'NATION_1' + chr(39))}) as locations",
        "case when company_id % 2 = 0 then array(named_struct('vendor', 'SegmentCo', 'product', 'x')) "
        "else array(named_struct('vendor', 'y', 'product', case when company_id % 5 = 1 then 'SegmentCo' else 'z' end)) end as technographics",
    )


ICP_WHERE = """industry in ('Banking', 'Financial Services') and company_size in ('11-50', '51-200', '201-500')
  and cast(replace(hq_country, 'NATION_', '') as integer) < 20
  and (company_id % 2 = 0 or company_id % 5 = 1)
  and (products_and_services like '%saas%' or products_and_services like '%retail data%')
  and lower(description) like '%analytics%'"""


@query(with_fixtures("companies", body=f"select company_id, name from companies where {ICP_WHERE} and coalesce(domain, '') not in ('s3.example.com', 's6.example.com')"))
def icp_filter(spark, sf_dir):
    return icp.icp_filter_companies(nested_companies(spark, sf_dir), CLIENT).select("company_id", "name")


@query(with_fixtures("people", "companies", body=f"""select person_id from people p join companies c on c.company_id = p.person_id % (select max(company_id) + 1 from companies) where {ICP_WHERE}
  and job_title in ('VP of Sales', 'Chief Executive Officer', 'Director of Sales', 'Vice President')"""))
def icp_filter_people(spark, sf_dir):
    return icp.icp_filter_people(people_in_roles(spark, sf_dir), CLIENT).select("person_id")


def people_in_roles(spark, sf_dir) -> DataFrame:
    employers = nested_companies(spark, sf_dir)
    n = employers.agg(F.max("company_id")).first()[0] + 1
    employer = F.struct("industry", "company_size", "locations", "technographics", "products_and_services", "description")
    joined = fixture(spark, sf_dir, "people").withColumn("_c", F.col("person_id") % n).join(
        employers.select(F.col("company_id").alias("_c"), employer.alias("company")), "_c"
    )
    # The former role has the right employer and the wrong title, or the other way round.
    experiences = F.array(
        F.struct(F.lit(False).alias("is_current"), F.lit("Sales").alias("job_title"), "company"),
        F.struct(F.lit(True).alias("is_current"), "job_title", "company"),
    )
    return joined.withColumn("experiences", experiences)


PROFILE_LISTS = [c for c in icp.LIST_FIELDS]


def profiles(spark, sf_dir) -> DataFrame:
    lists = {c: F.filter(F.split(F.col(c), "[|]"), lambda x: x != "") for c in PROFILE_LISTS}
    return fixture(spark, sf_dir, "profiles").withColumns(lists)


def _list(column: str) -> str:
    return f"list_filter(string_split(f.{column}, '|'), lambda x: x <> '')"


def similar_sql(text: str, column: str) -> str:
    """Some phrase of the list has half of its words in the text."""
    words = r"list_distinct(list_filter(regexp_split_to_array(lower({0}), '[^a-z0-9]+'), lambda w: w <> ''))"
    hit = f"len(list_intersect({words.format(text)}, {words.format('p')})) >= 0.5 * len({words.format('p')})"
    return f"len(list_filter({_list(column)}, lambda p: {hit})) > 0"


COMPANY_FITS = f"""(f.industries = '' or list_contains({_list('industries')}, c.industry))
  and (f.company_size_buckets = '' or list_contains({_list('company_size_buckets')}, c.company_size))
  and (f.hq_countries = '' or list_contains({_list('hq_countries')}, c.hq_country)) and (f.hq_cities = '' or list_contains({_list('hq_cities')}, 'x'))
  and (f.technologies = '' or list_has_any({_list('technologies')}, case when company_id % 2 = 0 then ['SegmentCo', 'x'] when company_id % 5 = 1 then ['y', 'SegmentCo'] else ['y', 'z'] end))
  and (f.products_and_services = '' or {similar_sql('c.products_and_services', 'products_and_services')})
  and (f.description_keywords = '' or len(list_filter({_list('description_keywords')}, lambda k: contains(lower(c.description), lower(k)))) > 0)"""
SOME_CLAUSE = "concat(f.industries, f.company_size_buckets, f.hq_countries, f.hq_cities, f.technologies, f.products_and_services, f.description_keywords) <> ''"


@query(with_fixtures("companies", "profiles", body=f"""select client_id, company_id from companies c join profiles f on {COMPANY_FITS}
  and {SOME_CLAUSE} and (c.domain is null or not list_contains({_list('exclude_domains')}, c.domain))"""))
def icp_match_many(spark, sf_dir):
    """B6 for every profile of a table in one run."""
    return icp_many.match_companies(nested_companies(spark, sf_dir), profiles(spark, sf_dir))


@query(with_fixtures("people", "companies", "profiles", body=f"""select client_id, person_id from people q
  join companies c on c.company_id = q.person_id % (select max(company_id) + 1 from companies) join profiles f on {COMPANY_FITS}
  and {similar_sql('q.job_title', 'people_job_title_include')} and not {similar_sql('q.job_title', 'people_job_title_exclude')}"""))
def icp_match_many_people(spark, sf_dir):
    """B7 for every profile of a table in one run."""
    return icp_many.match_people(people_in_roles(spark, sf_dir), profiles(spark, sf_dir))


@query(with_fixtures("people", "companies", body="""select person_id, company_domain from people where company_domain in
  (select domain from companies where industry = 'Financial Services') and job_title in ('VP of Sales', 'Director of Sales', 'Sales Assistant')"""))
def people_at_domains(spark, sf_dir):
    roles = F.array(F.struct(F.lit(True).alias("is_current"), "job_title"))
    domains = fixture(spark, sf_dir, "companies").where(F.col("industry") == "Financial Services")
    folk = fixture(spark, sf_dir, "people").withColumn("experiences", roles)
    return icp.people_at_domains(folk, domains, ["Sales"]).select("person_id", "company_domain")


@query(with_fixtures("companies", body="select company_id, headcount from companies order by headcount desc, company_id limit 25"))
def limit_results(spark, sf_dir):
    c = fixture(spark, sf_dir, "companies").select("company_id", "headcount")
    return icp.limit_results(c, 25, F.desc("headcount"), F.asc("company_id"))


@query(with_fixtures("people", body="select person_id, job_title from people where (lower(job_title) like '%sales%' or lower(job_title) like '%chief%') "
                     "and lower(job_title) not like '%assistant%'"))
def title_filter(spark, sf_dir):
    return icp.title_filter(fixture(spark, sf_dir, "people"), ["Sales", "chief"], ["Assistant"]).select("person_id", "job_title")


@query(with_fixtures("people", "companies", body="""
, valid as (select company_id, domain, name from companies where s_acctbal > 0),
titled as (select * from people where (lower(job_title) like '%sales%' or lower(job_title) like '%chief executive officer%' or lower(job_title) like '%vice president%')
  and lower(job_title) not like '%assistant%'),
d as (select company_id, domain, person_id, 'domain' as matched_by from valid join titled on company_domain = domain),
n as (select company_id, domain, person_id, 'name' as matched_by from valid v join titled on company_name = name
  where not exists (select 1 from d where d.company_id = v.company_id))
select company_row_id, company_domain_normalize, matched_by, person_id from (select company_id as company_row_id, domain as company_domain_normalize, matched_by,
  person_id, row_number() over (partition by company_id order by person_id) as rn from (select * from d union all select * from n)) where rn <= 5"""))
def people_waterfall(spark, sf_dir):
    return people.people_waterfall(waterfall_companies(spark, sf_dir), fixture(spark, sf_dir, "people"), CLIENT).select(
        "company_row_id", "company_domain_normalize", "matched_by", "person_id"
    )


def waterfall_companies(spark, sf_dir) -> DataFrame:
    return fixture(spark, sf_dir, "companies").select(
        "company_id", F.col("domain").alias("domain_normalize"), F.col("name").alias("company_name"),
        (F.col("s_acctbal") > 0).alias("is_valid_row"),
        (F.col("headcount") % 101).cast("double").alias("quality_score"),
    )


@query(with_fixtures("people", "companies", body="select person_id, company_domain as company_domain_normalize from people where company_domain in "
                     "(select domain from companies where headcount % 101 >= 70)"))
def enrich_eligible(spark, sf_dir):
    folk = fixture(spark, sf_dir, "people").select("person_id", F.col("company_domain").alias("company_domain_normalize"))
    return people.enrich_eligible(folk, waterfall_companies(spark, sf_dir), CLIENT).select("person_id", "company_domain_normalize")


@query(with_fixtures("people", body="select person_id, case when person_id % 4 = 0 or person_id % 9 = 0 or person_id % 5 = 0 or person_id % 11 = 0 "
                     "then 'Ada Person' || person_id else full_name end as clean_name from people"))
def clean_names(spark, sf_dir):
    return people.clean_names(fixture(spark, sf_dir, "people")).select("person_id", "clean_name")


@query("select c_custkey as lead_id, cast((row_number() over (order by c_custkey) - 1) // 50 as bigint) as batch_id from customer")
def lead_batches(spark, sf_dir):
    return people.lead_batches(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("lead_id")))


LEADS = """select person_id as lead_id, case when person_id % 10 < 6 then full_name end as full_name,
  case when person_id % 10 < 5 then upper(company_name) end as company_name,
  case when person_id % 10 = 6 then concat('https://in.example.com/', cast(person_id as string), '/') when person_id % 10 = 7 then 'https://in.example.com/none' end as linkedin_url,
  case when person_id % 10 = 8 then concat(' P', cast(person_id as string), '@example.com') end as email from people"""


@query(with_fixtures("people", body=f""", leads as ({LEADS}) select lead_id,
  case when lead_id % 10 in (5, 9) then 'invalid' when lead_id % 10 = 7 then 'not_matched' else 'matched' end as status,
  case when lead_id % 10 in (5, 7, 9) then null else cast(lead_id as varchar) end as matched_person_id,
  case when lead_id % 10 in (5, 7, 9) then null when lead_id % 10 = 6 then 'url' when lead_id % 10 = 8 then 'email' else 'name' end as matched_by from leads"""))
def match_leads(spark, sf_dir):
    folk = fixture(spark, sf_dir, "people")
    folk.createOrReplaceTempView("people")
    text_id = F.col("person_id").cast("string")
    ref = folk.select(
        "person_id", "full_name", "company_name",
        F.concat(F.lit("https://in.example.com/"), text_id).alias("linkedin_url"),
        F.concat(F.lit("p"), text_id, F.lit("@example.com")).alias("email"),
    )
    return people.match_leads(spark.sql(LEADS), ref).select("lead_id", "status", "matched_person_id", "matched_by")


@query(with_fixtures("experience", body="""select pair_id, bool_or(e.end_date is null or e.end_date = 'Present') filter (e.person_id is not null) as is_current_at_company from
  (select c_custkey as pair_id, c_custkey as person_id, case when c_custkey % 3 > 0 then ' COMPANY ' || (c_custkey % (select cast(floor(count(*) * 0.5) as int) from supplier)) end as company_name,
  case when c_custkey % 3 < 2 then 'https://www.linkedin.com/company/c' || (c_custkey % 49) end as company_url from customer) p
  left join experience e on e.person_id = p.person_id and (lower(e.company) = lower(trim(p.company_name)) or rtrim(e.company_url, '/') = p.company_url)
  group by pair_id"""))
def current_at_company(spark, sf_dir):
    known = int(table(spark, sf_dir, "supplier").count() * 0.5)  # companies that roles name
    # A role that goes on is written in three ways.
    words = F.when(F.col("pos") % 2 == 0, "").otherwise(F.col("end_date"))
    roles = fixture(spark, sf_dir, "experience").withColumn("end_date", F.when(F.col("end_date") == "Present", words).otherwise(F.col("end_date")))
    key = F.col("c_custkey")
    pairs = table(spark, sf_dir, "customer").select(
        key.alias("pair_id"), key.alias("person_id"),
        F.when(key % 3 > 0, F.concat(F.lit(" COMPANY "), (key % known).cast("string"))).alias("company_name"),
        F.when(key % 3 < 2, F.concat(F.lit("https://www.linkedin.com/company/c"), (key % 49).cast("string"))).alias("company_url"),
    )
    return people.current_at_company(roles, pairs).select("pair_id", "is_current_at_company")


# --- P2-P16 -----------------------------------------------------------------------
@query(with_fixtures("posts", body="""select c_custkey as person_id, count(post_id) as total_posts, cast(coalesce(sum(reactions), 0) as bigint) as total_reactions,
  cast(coalesce(sum(comments), 0) as bigint) as total_comments, round(sum(coalesce(reactions, 0)) / nullif(count(post_id), 0), 2) as avg_reactions_per_post
  from customer left join posts on person_id = c_custkey group by c_custkey"""))
def engagement(spark, sf_dir):
    profiles = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("person_id"))
    return pj.engagement_aggregate(fixture(spark, sf_dir, "posts"), profiles)


MONTHS_SQL = f"""m as (select *, case when regexp_matches(start_date, '^[0-9]{{4}}-[0-9]{{2}}$') then cast(left(start_date, 4) as int) * 12 + cast(right(start_date, 2) as int)
    when regexp_matches(start_date, '^[0-9]{{4}}$') then cast(start_date as int) * 12 + 1 end as s,
  case when end_date is null or end_date = 'Present' then {AS_OF[:4]} * 12 + {int(AS_OF[5:7])} else cast(end_date as int) * 12 + 12 end as e,
  case when regexp_matches(start_date, '^[0-9]{{4}}-[0-9]{{2}}$') then cast(left(start_date, 4) as int) * 100 + cast(right(start_date, 2) as int)
    when regexp_matches(start_date, '^[0-9]{{4}}$') then cast(start_date as int) * 100 end as start_key,
  end_date is null or end_date = 'Present' as cur from experience),
y as (select *, case when e - s is not null then greatest(e - s, 0) / 12.0 end as years from m)"""


@query(with_fixtures("experience", body=f""", {MONTHS_SQL}, latest as (select person_id, years from (select *, row_number() over (partition by person_id
  order by start_key desc, pos) as rn from y where start_key is not null) where rn = 1),
tenure as (select person_id, years from (select *, row_number() over (partition by person_id order by pos desc) as rn from y where cur and years is not null) where rn = 1)
select y.person_id, count(*) as roles, round(cast(sum(y.years) as double), 2) as total_years_experience,
  round(cast(coalesce(any_value(t.years), any_value(l.years)) as double), 2) as current_tenure_years
from y left join latest l using (person_id) left join tenure t using (person_id) group by y.person_id"""))
def experience_resolve(spark, sf_dir):
    return pj.experience_summary(fixture(spark, sf_dir, "experience"), as_of())


@query(with_fixtures("experience", body=f", {MONTHS_SQL} select person_id, pos, round(cast(years as double), 2) as duration_years, cur as is_current from y"))
def experience_durations(spark, sf_dir):
    return pj.experience_durations(fixture(spark, sf_dir, "experience"), as_of()).select(
        "person_id", "pos", "duration_years", "is_current"
    )


@query(with_fixtures("experience", body="select person_id, coalesce(arg_min(company, pos) filter (end_date is null or end_date = 'Present'), "
                     "arg_max(company, pos)) as employed_company from experience group by person_id"))
def employed_company(spark, sf_dir):
    return pj.employed_company(fixture(spark, sf_dir, "experience"))


@query(with_fixtures("companies", body="""select company_id, case when headcount <= 10 then '1-10' when headcount <= 50 then '11-50' when headcount <= 200 then '51-200'
  when headcount <= 500 then '201-500' when headcount <= 1000 then '501-1000' when headcount <= 5000 then '1001-5000' when headcount <= 10000 then '5001-10000'
  else '10001+' end as band from companies"""))
def headcount_band(spark, sf_dir):
    return fixture(spark, sf_dir, "companies").select("company_id", pr.headcount_band(F.col("headcount")).alias("band"))


@query("""select o_orderkey, case when roles >= 5 then 'actively_hiring' when roles > 0 then 'hiring' when roles = 0 and growth is null then 'not_hiring'
  when growth > 0 then 'growing' when growth < 0 then 'shrinking' when growth = 0 then 'stable' end as signal from
  (select o_orderkey, case when o_orderkey % 4 = 0 then null else o_orderkey % 9 end as roles,
   case when o_orderkey % 5 = 0 then null else (o_orderkey % 7) - 3.0 end as growth from orders)""")
def hiring_signal(spark, sf_dir):
    key = F.col("o_orderkey")
    roles = F.when(key % 4 != 0, key % 9)
    growth = F.when(key % 5 != 0, (key % 7) - 3.0)
    return table(spark, sf_dir, "orders").select("o_orderkey", pr.hiring_signal(roles, growth).alias("signal"))


TYPE_SPELLINGS = ("  Public   Company ", "privately held", "Non Profit", "Educational", "Sole Proprietorship", "Privately-Held", "")
TYPE_CODES = ("PUBLIC_COMPANY", "PRIVATELY_HELD", "NONPROFIT", "EDUCATIONAL_INSTITUTION", "SOLE_PROPRIETORSHIP", None, None)


@query("select c_custkey, case c_custkey % 7 " + " ".join(f"when {i} then {s.q(c)}" for i, c in enumerate(TYPE_CODES) if c) + " end as code from customer")
def company_type(spark, sf_dir):
    raw = F.get(F.array(*[F.lit(x) for x in TYPE_SPELLINGS]), (F.col("c_custkey") % 7).cast("int"))
    return table(spark, sf_dir, "customer").select("c_custkey", pr.company_type(raw).alias("code"))


SENIORITY_SQL = """case when regexp_matches(job_title, '\\b(chief|ceo|cfo|coo|cto|cmo|cpo|cro|president|founder|co-founder)\\b', 'i') then 'C_LEVEL'
  when regexp_matches(job_title, '\\b(vp|vice president|svp|evp)\\b', 'i') then 'VP' when regexp_matches(job_title, '\\b(director|head of)\\b', 'i') then 'DIRECTOR'
  when regexp_matches(job_title, '\\b(manager|lead|supervisor)\\b', 'i') then 'MANAGER' else 'IC' end"""


@query(with_fixtures("people", body=f"select person_id, {SENIORITY_SQL} as seniority from people"))
def seniority(spark, sf_dir):
    return fixture(spark, sf_dir, "people").select("person_id", pr.seniority(F.col("job_title")).alias("seniority"))


@query(with_fixtures("people", body=f", hits as (select person_id, ord, code from people left join {s.catalog_rows(cat.FUND_ROLES)} on regexp_matches(job_title, pattern)) "
                     "select person_id, arg_min(code, ord) as fund_role from hits group by person_id"))
def fund_role(spark, sf_dir):
    return fixture(spark, sf_dir, "people").select("person_id", pj.fund_role(F.col("job_title")).alias("fund_role"))


@query(with_fixtures("people", body=r""", u as (
  select person_id, 'url' as kind, regexp_extract_all(about, 'https?://[^\s)]+') as xs from people
  union all select person_id, 'company', regexp_extract_all(about, '(?:\bat\s+|@\s*)([A-Z][\w&\-]*(?:\s+[A-Z][\w&\-]*){0,4})', 1) from people
  union all select person_id, 'handle', regexp_extract_all(about, '(?:^|\W)@(\w{2,30})\b', 1) from people)
select person_id, kind, cast(unnest(range(len(xs))) as integer) as pos, unnest(xs) as entity from u"""))
def bio_entities(spark, sf_dir):
    return pj.bio_entities(fixture(spark, sf_dir, "people"))


@query(with_fixtures("people", body="select person_id, case when connections >= 500 then '500+' else cast(connections as varchar) end as band from people"))
def connections_band(spark, sf_dir):
    return fixture(spark, sf_dir, "people").select("person_id", pr.connections_band(F.col("connections")).alias("band"))


@query("""select c_custkey, cast(case c_custkey % 4 when 0 then 0 when 1 then greatest(c_custkey % 50 - 10, 0) when 2 then 4 else 2 end as integer) as mutual_count,
  case c_custkey % 4 when 2 then c_name || '|Bo|Cy|Di' when 3 then c_name else '' end as sample_names from customer""")
def mutual_connections(spark, sf_dir):
    key, name = F.col("c_custkey"), F.col("c_name")
    people_of = lambda *names: F.to_json(F.array(*[F.struct(n.alias("name")) for n in names]))
    raw = (
        F.when(key % 4 == 0, F.lit(None).cast("string"))
        .when(key % 4 == 1, (key % 50 - 10).cast("string"))
        .when(key % 4 == 2, people_of(name, F.lit("Bo"), F.lit("Cy"), F.lit("Di")))
        .otherwise(people_of(name, F.lit("")))
    )
    m = pr.mutual_connections(F.parse_json(raw))
    return table(spark, sf_dir, "customer").select("c_custkey", m.alias("m")).select(
        "c_custkey", "m.mutual_count", F.array_join("m.sample_names", "|").alias("sample_names")
    )


@query("""select c_custkey as person_id, cast(p as integer) as pos, case p when 0 then 'ISO ' || c_custkey else c_mktsegment end as name,
  case p when 0 then 'Board' end as issuer, case p when 2 then '2024' end as issued_date from customer, (values (0), (2)) v(p)""")
def certifications(spark, sf_dir):
    entry = lambda **kv: F.struct(*[c.alias(k) for k, c in kv.items()])
    raw = F.concat(
        F.lit("["),
        F.concat_ws(
            ",",
            F.to_json(entry(title=F.concat(F.lit(" ISO "), F.col("c_custkey").cast("string"), F.lit(" ")), authority=F.lit("Board"))),
            F.to_json(entry(name=F.lit(""), issuer=F.lit("nobody"))),
            F.to_json(entry(name=F.lit(""), certification=F.col("c_mktsegment"), date=F.lit("2024"))),
        ),
        F.lit("]"),
    )
    records = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("person_id"), F.parse_json(raw).alias("raw"))
    return pj.certifications(records)


@query(with_fixtures("people", body=f"select person_id, array_to_string({s.codes('about', cat.TOPICS)}, '|') as topics from people"))
def topics(spark, sf_dir):
    return pj.topics(fixture(spark, sf_dir, "people")).select("person_id", F.array_join("topics", "|").alias("topics"))


WORDS = (
    ("ARTICLE", "en", ("the", "of the")),
    ("CONJUNCTION", "en", ("and", "with the")),
    ("NEGATION", "de", ("nicht",)),
    ("RELATIVE", "fr", ("que", "pour la")),
)
# RE2 takes accented letters for word ends, so the SQL reads a text without them.
ASCII_TEXT = r"regexp_replace(text, '[\x{80}-\x{10FFFF}]', 'z', 'g')"


@query(f"select doc_id, code, category from documents, {s.catalog_rows(WORDS)} where regexp_matches({ASCII_TEXT}, pattern)")
def dictionary_match(spark, sf_dir):
    from enrichlake.operators.page_structure import dictionary_match as match
    from enrichlake.operators.skew import spread_scan

    return match(spread_scan(table(spark, sf_dir, "documents")), WORDS, "doc_id", "text").select("doc_id", "code", "category")


WORD_ALIAS = r"'(?i)\b' || regexp_replace(regexp_replace(lower(trim(alias)), '\s+', ' ', 'g'), ' ', '\\s+', 'g') || '\b'"


@query(with_fixtures("aliases", body=f""", patterns as (select distinct {WORD_ALIAS} as pattern, lower(trim(alias)) as alias from aliases where trim(alias) <> ''),
  texts as (select doc_id, {ASCII_TEXT} as text from documents),
  hits as (select doc_id, p.alias from texts d join patterns p on regexp_matches(d.text, p.pattern))
  select distinct doc_id, ord, code, category from hits h join aliases a on lower(trim(a.alias)) = h.alias"""))
def dictionary_match_table(spark, sf_dir):
    """X5 against a table of aliases that grows with the input."""
    from enrichlake.operators.page_structure import dictionary_match_table as match

    return match(table(spark, sf_dir, "documents"), fixture(spark, sf_dir, "aliases"), "doc_id", "text")


def company_records(spark, sf_dir) -> DataFrame:
    """One JSON record per company, in three spellings."""
    c = fixture(spark, sf_dir, "companies")
    key = F.col("company_id") % 3
    hq = F.struct(F.lit("Town").alias("city"), F.lit("").alias("geographicArea"), F.col("hq_country").alias("country"))
    raw = (
        F.when(key == 0, F.to_json(F.struct("name", "industry", F.col("headcount").alias("employeeCount"), hq.alias("headquarter"), "linkedin_url")))
        .when(key == 1, F.to_json(F.struct(F.lit("").alias("name"), F.col("name").alias("companyName"), F.col("industry").alias("companyIndustry"),
                                            F.col("company_size").alias("companySize"), F.col("hq_country").alias("hqLocation"), F.col("linkedin_url").alias("url"))))
        .otherwise(F.to_json(F.struct(F.col("name").alias("companyname"), hq.alias("headquarters"), F.lit("flat").alias("location"))))
    )
    return c.select(F.col("company_id").alias("record_id"), "domain", raw.alias("value"))


COMPANY_UNIVERSAL = """select company_id as record_id, domain, name, case when company_id % 3 = 2 then null else industry end as industry,
  case company_id % 3 when 0 then cast(headcount as varchar) when 1 then company_size end as headcount,
  case company_id % 3 when 1 then hq_country else 'Town, ' || hq_country end as location,
  case when company_id % 3 = 2 then null else linkedin_url end as linkedin_url from companies"""


@query(with_fixtures("companies", body=f"select * exclude (domain) from ({COMPANY_UNIVERSAL})"))
def company_universal(spark, sf_dir):
    records = company_records(spark, sf_dir).withColumn("raw", F.parse_json("value"))
    return pj.company_universal(records)


def person_records(spark, sf_dir) -> DataFrame:
    p = fixture(spark, sf_dir, "people")
    key = F.col("person_id") % 3
    url = F.concat(F.lit("https://in.example.com/"), F.col("person_id").cast("string"))
    raw = (
        F.when(key == 0, F.to_json(F.struct(url.alias("linkedinUrl"), F.col("full_name").alias("fullName"), "job_title", "country", "about", F.lit(41).alias("age"))))
        .when(key == 1, F.to_json(F.struct(url.alias("profileUrl"), F.lit("Ada").alias("firstName"), F.col("c_mktsegment").alias("lastName"),
                                            F.col("job_title").alias("headline"), F.lit("").alias("country"), F.lit("unknown").alias("location"), F.lit("36").alias("estimatedAge"))))
        .otherwise(F.to_json(F.struct(F.lit(None).cast("string").alias("name"), F.col("c_mktsegment").alias("companyIndustry"))))
    )
    return p.select(F.col("person_id").alias("record_id"), F.parse_json(raw).alias("raw"))


PERSON_UNIVERSAL = f"""select person_id as record_id, case when person_id % 3 < 2 then 'https://in.example.com/' || person_id end as linkedin_url,
  case person_id % 3 when 0 then full_name when 1 then 'Ada ' || c_mktsegment end as full_name, case when person_id % 3 < 2 then job_title end as job_title,
  case when person_id % 3 < 2 then {SENIORITY_SQL} end as seniority, case person_id % 3 when 0 then country when 1 then 'unknown' end as country,
  case when person_id % 3 = 0 then about end as linkedin_about, case person_id % 3 when 0 then 41 when 1 then 36 end as age,
  case when person_id % 3 = 2 then c_mktsegment end as company_industry from people"""


@query(with_fixtures("people", body=PERSON_UNIVERSAL))
def person_universal(spark, sf_dir):
    return pj.person_universal(person_records(spark, sf_dir))


# --- S1, S3 -----------------------------------------------------------------------
@query("select page_id, html as markdown, case page_id % 3 when 2 then null else url end as source_url from pages")
def scrape_payload(spark, sf_dir):
    key = F.col("page_id") % 3
    empty = F.lit("")
    raw = (
        F.when(key == 0, F.to_json(F.struct(F.struct(F.col("html").alias("markdown"), F.struct(F.col("url").alias("sourceURL")).alias("metadata")).alias("data"))))
        .when(key == 1, F.to_json(F.struct(F.col("html").alias("markdown"), F.struct(empty.alias("sourceURL"), F.col("url").alias("url")).alias("metadata"))))
        .otherwise(F.to_json(F.struct(F.col("html").alias("markdown"), F.lit("no object").alias("data"))))
    )
    docs = table(spark, sf_dir, "pages").select("page_id", F.parse_json(raw).alias("doc"))
    return docs.select("page_id", *readers.scrape_payload(F.col("doc")))


@query(with_fixtures("companies", body="select company_id, cast(p as integer) as pos, case p when 0 then name else 'second' end as name from companies, (values (0), (1)) v(p) "
                     "where case company_id % 4 when 0 then true when 1 then true when 2 then p = 0 else false end"))
def record_export(spark, sf_dir):
    one = F.to_json(F.struct("name"))
    pair = F.concat(F.lit("["), one, F.lit(',{"name":"second"}]'))
    key = F.col("company_id") % 4
    value = (
        F.when(key == 0, pair)
        .when(key == 1, F.concat(F.lit('{"items":null,"data":'), pair, F.lit("}")))
        .when(key == 2, one)
        .otherwise(F.lit('{"items":[],"data":[{"name":"never"}]}'))
    )
    docs = fixture(spark, sf_dir, "companies").select("company_id", value.alias("value"))
    return readers.explode_records(docs).select("company_id", "pos", pr.as_text(F.col("raw"), "$.name").alias("name"))


# --- Q4-Q7, Q11 -------------------------------------------------------------------
@query(f"select page_id, regexp_matches({s.host('url')}, {s.q(cat.DOMAIN_SHAPE)}) as ok from pages")
def domain_shape(spark, sf_dir):
    from enrichlake.functions.urls import root_domain

    return table(spark, sf_dir, "pages").select("page_id", quality.domain_shape_ok(root_domain(F.col("url"))).alias("ok"))


@query("select p_partkey, p_partkey % 4 <> 1 and p_partkey % 5 <> 2 as ok from part")
def enum_check(spark, sf_dir):
    key = F.col("p_partkey")
    half = lambda c: F.struct(c.alias("primary"), F.col("p_type").alias("secondary"))
    model = F.struct(
        half(F.when(key % 4 == 1, F.col("p_brand")).otherwise("USAGE")).alias("pricing"),
        half(F.when(key % 5 == 2, F.col("p_name")).otherwise("SAAS")).alias("offering"),
        half(F.lit(None).cast("string")).alias("delivery"),
    )
    return table(spark, sf_dir, "part").select("p_partkey", quality.business_model_ok(model).alias("ok"))


@query("""select p_partkey, case p_partkey % 4 when 0 then '' when 1 then 'social_links_extract: unexpected keys [''' || p_brand || ''']'
  when 2 then 'social_links_extract.g2_url: expected a string|careers_page_parse[1]: missing keys [''posted_date'', ''title'']'
  else 'social_links_extract: expected an object|careers_page_parse: expected a list' end as violations from part""")
def shape_checks(spark, sf_dir):
    key = F.col("p_partkey") % 4
    role = '{"title":"t","department":null,"location":"x","posted_date":null}'
    social = F.parse_json(
        F.when(key == 0, F.lit('{"g2_url":"u","twitter_url":null}'))
        .when(key == 1, F.concat(F.lit('{"'), F.col("p_brand"), F.lit('":"u"}')))
        .when(key == 2, F.lit('{"g2_url":5}'))
        .otherwise(F.lit('"text"'))
    )
    careers = F.parse_json(
        F.when(key == 0, F.lit(f"[{role}]"))
        .when(key == 1, F.lit("null"))
        .when(key == 2, F.lit(f'[{role},{{"department":"d","location":"x"}}]'))
        .otherwise(F.lit("{}"))
    )
    return table(spark, sf_dir, "part").select("p_partkey", social.alias("s"), careers.alias("c")).select(
        "p_partkey", F.array_join(quality.json_shape_violations(F.col("s"), F.col("c")), "|").alias("violations")
    )


@query(with_fixtures("people", body="select person_id as record_id, person_id % 3 = 1 as placeholder from people"))
def placeholder_check(spark, sf_dir):
    rows = pj.person_universal(person_records(spark, sf_dir))
    flagged = F.size(quality.placeholder_violations(rows, person_contracts())) > 0
    return rows.select("record_id", flagged.alias("placeholder"))


@query(with_fixtures("people", body="select person_id as record_id, person_id % 3 <> 1 as is_valid_row, 100.0::double as quality_score, "
                     "case when person_id % 3 = 1 then 'country: contains a placeholder string instead of empty (None/[]/{})' else '' end as reasons from people"))
def evaluate_record(spark, sf_dir):
    rows = plan.evaluate_records(
        pj.person_universal(person_records(spark, sf_dir)), person_contracts(), "profile_people", "record_id", with_drift=False
    )
    return rows.select("record_id", "is_valid_row", "quality_score", F.array_join("rejection_reasons", "|").alias("reasons"))


RECORD_CONTRACTS = {"company_domain": Contract(True, 10.0, ("profile",)), "country": Contract(False, 10.0, ("registry", "profile"))}


@query(with_fixtures("people", "drift_history", body="""select record_id, is_valid_row, quality_score, coalesce(w.drift_warnings, '') as drift_warnings from
  (select person_id as record_id, company_domain is not null as is_valid_row, cast(98.0 - case when company_domain is null then 30.0 else 0.0 end as double) as quality_score from people) r
  left join (select seq, 'drift_warning:company_domain' as drift_warnings from (select *, count(*) over v as n, avg(is_empty::int) over v as mean, stddev_samp(is_empty::int) over v as sd from (
    select 0 as part, ts, seq, is_empty from (select * from drift_history where field = 'click' order by ts desc, seq desc limit 19)
    union all select 1, null, person_id, company_domain is null from people) o
    window v as (order by part, ts, seq rows between 19 preceding and 1 preceding))
    where part = 1 and is_empty and n >= 5 and 1.0 > least(mean + 2 * sd, 1.0)) w on w.seq = r.record_id"""))
def evaluate_record_drift(spark, sf_dir):
    """Q11 with drift: a history under the records' own namespace counts, one under the plain name does not."""
    rows = fixture(spark, sf_dir, "people").select(F.col("person_id").alias("record_id"), "company_domain", "country")
    seen = drift.read_history(fixture(spark, sf_dir, "drift_history"), "click").withColumn("ts", F.col("ts").cast("timestamp"))
    other = seen.withColumn("field", F.lit("company_domain")).withColumn("is_empty", ~F.col("is_empty"))
    history = seen.withColumn("field", F.lit("records:company_domain")).unionByName(other)
    out = plan.evaluate_records(
        rows, RECORD_CONTRACTS, "records", "record_id", history=history, run_timestamp=F.lit("2199-01-01").cast("timestamp")
    )
    return out.select("record_id", "is_valid_row", "quality_score", F.array_join("drift_warnings", "|").alias("drift_warnings"))


# --- S4-S6, S10: written, then read by the operator -----------------------------------
SPINE_NAME = """concat(name, case when company_id % 3 = 0 then concat(chr(10), 'second "line", with all') else '' end)"""


@query(with_fixtures("companies", body=f"select cast(company_id as varchar) as company_id, {SPINE_NAME} as name, domain, linkedin_url from companies"))
def spine_csv(spark, sf_dir):
    path = shared_folder(spark, "spine")
    rows = fixture(spark, sf_dir, "companies").selectExpr("company_id", f"{SPINE_NAME} as name", "domain", "linkedin_url", "industry")
    writers.write_flat_csv(rows, path)
    return readers.read_spine_csv(spark, path).select(*bronze.COMPANY_SPINE)


@query(with_fixtures("profiles", body="select client_id, name, " + ", ".join(f"coalesce(f.{c}, '') as {c}" for c in (
    "industries", "company_size_buckets", "hq_countries", "hq_cities", "description_keywords", "exclude_domains"))
    + """, 100 as "limit", 'CONTAINS' as people_match_mode, 5 as people_max_per_company from profiles f"""))
def icp_folder(spark, sf_dir):
    """A file per client, checked and typed."""
    path = shared_folder(spark, "profiles")
    rows = profiles(spark, sf_dir)
    rows.coalesce(8).write.option("maxRecordsPerFile", 1).json(path)
    lists = [F.array_join(c, "|").alias(c) for c in ("industries", "company_size_buckets", "hq_countries", "hq_cities", "description_keywords", "exclude_domains")]
    return readers.read_icp_specs(spark, path).select("client_id", "name", *lists, "limit", "people_match_mode", "people_max_per_company")


@query(with_fixtures("companies", body="""select company_id, client_id, step, raw from (
  select cast(company_id as varchar) as company_id, 'a' as client_id, 'scrape' as step, concat('{"n":', cast(headcount as varchar), '}') as raw from companies where company_id % 4 = 0
  union all select cast(company_id as varchar), 'b', 'scrape', '{}' from companies
  union all select cast(company_id as varchar), 'a', 'people', '{}' from companies where company_id % 2 = 1)"""))
def bronze_step(spark, sf_dir):
    """A client's step replaces its own earlier output only."""
    path = shared_folder(spark, "bronze")
    rows = fixture(spark, sf_dir, "companies").withColumn("company_id", F.col("company_id").cast("string"))
    plain = rows.withColumn("raw", F.lit("{}"))
    full = rows.withColumn("raw", F.concat(F.lit('{"n":'), F.col("headcount").cast("string"), F.lit("}")))
    for client, step, part in (("a", "scrape", plain), ("b", "scrape", plain), ("a", "people", plain.where("company_id % 2 = 1")), ("a", "scrape", full.where("company_id % 4 = 0"))):
        writers.write_bronze_step(part, path, client, step, bronze.COMPANY_SPINE, "raw")
    return spark.read.parquet(path).select("company_id", "client_id", "step", "raw")


# --- R8-R11 -----------------------------------------------------------------------
PAGE_COMPANIES = s.pages_sql(
    "page_id, case when usable then domain end as domain, case when usable then entity_id end as entity_id, case when usable then entity_name end as entity_name, "
    "case when usable then description end as description", s.TRIAGE_COLUMNS, s.FIELD_COLUMNS, s.GATE_COLUMNS)


@query(with_fixtures("companies", body=f""", profiles as (select * from ({COMPANY_UNIVERSAL})), page_side as ({PAGE_COMPANIES}),
paired as (select p.record_id, g.page_id, g.domain, g.description, g.entity_id, p.name as pn, case when g.entity_id is not null then g.entity_name end as gn, p.industry
  from profiles p full join page_side g on p.domain = g.domain)
select record_id, page_id, coalesce(pn, gn) as name, case when pn is not null then 'profile' when gn is not null then 'page' end as name_source,
  coalesce(lower(pn) <> lower(gn), false) as name_conflict, domain, description, entity_id as company_id_key, industry from paired"""))
def company_rows(spark, sf_dir):
    records = company_records(spark, sf_dir)
    profiles = pj.company_universal(records.withColumn("raw", F.parse_json("value"))).join(
        records.select("record_id", "domain"), "record_id"
    )
    # Both joins read the pages; the table they are written to serves both, extracted once.
    pages = checkpointed(
        gated(spark, sf_dir).select("page_id", "domain_normalize", "company_description_extract", "company_entity_resolve")
    )
    rows = cp.assemble_company_rows(profiles, pages, with_drift=False)
    return rows.select("record_id", "page_id", "name", "name_source", "name_conflict", "domain", "description", "company_id_key", "industry")


@query(with_fixtures("people", "experience", body=f""", u as ({PERSON_UNIVERSAL}), job as (select person_id, coalesce(arg_min(company, pos) filter (end_date is null or end_date = 'Present'),
  arg_max(company, pos)) as employer from experience group by person_id)
select record_id, linkedin_url, full_name, case when record_id % 3 < 2 and record_id % 5 = 0 then 'Contact title' else job_title end as job_title, seniority,
  case when record_id % 3 < 2 and record_id % 5 = 0 then 'contact' else 'profile' end as job_title_source, employer as employed_company,
  case when record_id % 3 < 2 and record_id % 5 = 0 then record_id || '@example.com' end as email, record_id % 3 <> 1 as profile_is_valid_row
from u left join job on person_id = record_id"""))
def person_rows(spark, sf_dir):
    folk = fixture(spark, sf_dir, "people")
    text_id = F.col("person_id").cast("string")
    contacts = folk.where(F.col("person_id") % 5 == 0).select(
        F.concat(F.lit("https://in.example.com/"), text_id).alias("linkedin_url"),
        F.lit("Contact title").alias("job_title"),
        F.concat(text_id, F.lit("@example.com")).alias("email"),
    )
    roles = fixture(spark, sf_dir, "experience").withColumnRenamed("person_id", "record_id")
    rows = cp.assemble_person_rows(
        pj.person_universal(person_records(spark, sf_dir)), contacts, roles, with_drift=False
    )
    return rows.select(
        "record_id", "linkedin_url", "full_name", "job_title", "seniority", "job_title_source", "employed_company", "email", "profile_is_valid_row"
    )


@query(with_fixtures("people", body=f""", u as ({PERSON_UNIVERSAL})
select record_id, case when record_id % 3 < 2 and record_id % 5 = 0 then 'Contact title' else job_title end as job_title,
  case when record_id % 3 < 2 and record_id % 5 = 0 then 'export' else 'profile' end as job_title_source,
  case when record_id % 3 < 2 and record_id % 5 = 0 then record_id || '@example.com' end as email from u"""))
def person_rows_from_contacts(spark, sf_dir):
    # A contact export, read as a file (S6); the notes hold line breaks.
    text_id = F.col("person_id").cast("string")
    contacts = fixture(spark, sf_dir, "people").where(F.col("person_id") % 5 == 0).select(
        F.concat(F.lit("https://in.example.com/"), text_id).alias("linkedin_url"),
        F.lit("Contact title").alias("job_title"),
        F.concat(text_id, F.lit("@example.com")).alias("email"),
        F.concat(F.lit('met at "fair", '), text_id, F.lit("\nsecond day")).alias("note"),
    )
    path = shared_folder(spark, "contacts")
    writers.write_flat_csv(contacts, path)
    tagged = readers.read_contact_csv(spark, path, "export")
    rows = cp.assemble_person_rows(pj.person_universal(person_records(spark, sf_dir)), tagged, with_drift=False)
    return rows.select("record_id", "job_title", "job_title_source", "email")


@query("with recursive " + with_fixtures("parents", body=""", up(entity, here, step) as (
  select entity, entity, 0 from parents union all select u.entity, p.parent, u.step + 1 from up u join parents p on p.entity = u.here where p.parent is not null and u.step < 120),
tops as (select u.entity, u.here from up u left join parents p on p.entity = u.here where p.parent is null),
rounds as (select entity, min(here) as root from up where step > 60 group by entity)
select p.entity, coalesce(t.here, r.root) as root, t.here is null as circular from parents p left join tops t on t.entity = p.entity left join rounds r on r.entity = p.entity
union all select distinct parent, parent, false from parents where parent is not null and parent not in (select entity from parents)""").removeprefix("with "))
def entity_roots(spark, sf_dir):
    """E10 over chains of parents and circles."""
    return entities.entity_roots(fixture(spark, sf_dir, "parents"))


@query(with_fixtures("employers", "companies", body=r""", n as (select employed_company as name, null as id from employers union all select name, company_id from companies),
w as (select distinct name, id, list_sort(list_distinct(list_filter(regexp_split_to_array(lower(regexp_replace(name, SUFFIX, '', 'gi')), '[^a-z0-9]+'), lambda x: x <> ''))) as ws from n),
df as (select word, greatest(1, 1000000 // count(*)) as weight from (select unnest(ws) as word from w where id is not null) group by word),
e as (select distinct array_to_string(ws, ' ') as e, ws from w where id is null and len(ws) > 0),
et as (select e, sum(coalesce(weight, 1000000)) as t from (select e, unnest(ws) as word from e) x left join df using (word) group by e),
ct as (select id, sum(weight) as t from (select id, unnest(ws) as word from w where id is not null) x join df using (word) group by id),
s as (select e.e, c.id, sum(df.weight) as shared from (select e, unnest(ws) as word from e) e join (select id, unnest(ws) as word from w where id is not null) c using (word) join df using (word) group by e.e, c.id),
p as (select s.e, s.id, cast(1000000 * shared // (et.t + ct.t - shared) as bigint) as score from s join et on et.e = s.e join ct on ct.id = s.id where 100 * shared >= 50 * (et.t + ct.t - shared)),
r as (select *, rank() over (partition by e order by score desc) as re, rank() over (partition by id order by score desc) as rc from p),
b as (select *, count(*) filter (re = 1) over (partition by e) as ne, count(*) filter (rc = 1) over (partition by id) as nc from r)
select person_id, b.id as linked_company_id, b.score as link_score from employers q
left join (select distinct name, array_to_string(ws, ' ') as e from w where id is null) k on k.name = q.employed_company
left join b on b.e = k.e and re = 1 and rc = 1 and ne = 1 and nc = 1""".replace("SUFFIX", s.q(cat.LEGAL_SUFFIX))))
def company_person_scored(spark, sf_dir):
    """R10 by rare words, each the other's best."""
    out = entities.company_person_scored(fixture(spark, sf_dir, "employers"), fixture(spark, sf_dir, "companies"))
    return out.select("person_id", "linked_company_id", "link_score")


@query(with_fixtures("people", "companies", body="select person_id, c.company_id as linked_company_id from people p left join companies c "
                     "on replace(lower(c.name), ' corp', '') = replace(lower(p.company_name), ' corp', '')"))
def company_person_link(spark, sf_dir):
    folk = fixture(spark, sf_dir, "people").withColumn("employer", F.concat(F.upper("company_name"), F.lit(", Inc.")))
    return cp.company_person_link(folk, fixture(spark, sf_dir, "companies"), "employer").select("person_id", "linked_company_id")


RUN_ICP = icp.Icp("client", "Client", industries=("Banking", "Financial Services"), people_job_title_include=("Sales",), limit=None)
RUN_FETCHES = """select domain, concat('# ', name, chr(10), chr(10), name, ' is a software platform for many teams in the region and works with all of them every day.',
  case when company_id % 4 = 0 then ' Our new site is coming soon.' else '' end, chr(10), chr(10), '© 2024 ', name, '. All rights reserved.') as markdown,
  concat('https://www.', domain) as source_url from companies where domain is not null"""


@query(with_fixtures("people", "companies", body="""
, valid as (select company_id, domain, name from companies where industry <> 'Software Development' and domain is not null and company_id % 4 <> 0),
titled as (select * from people where lower(job_title) like '%sales%'),
d as (select company_id, domain, person_id, 'domain' as matched_by from valid join titled on company_domain = domain),
n as (select company_id, domain, person_id, 'name' as matched_by from valid v join titled on company_name = name
  where not exists (select 1 from d where d.company_id = v.company_id))
select company_row_id, company_domain_normalize, matched_by, person_id from (select company_id as company_row_id, domain as company_domain_normalize, matched_by,
  person_id, row_number() over (partition by company_id order by person_id) as rn from (select * from d union all select * from n)) where rn <= 5"""))
def companies_and_people(spark, sf_dir):
    c = fixture(spark, sf_dir, "companies")
    c.createOrReplaceTempView("companies")
    found = cp.companies_and_people(RUN_ICP, c, spark.sql(RUN_FETCHES), fixture(spark, sf_dir, "people"))
    return found["people"].select("company_row_id", "company_domain_normalize", "matched_by", "person_id")


# --- I1 ---------------------------------------------------------------------------
@query("""select c_custkey, case c_custkey % 6 when 0 then '' when 1 then 'client_id: required but missing'
  when 2 then 'industries: not in the industry enum: [''' || c_mktsegment || ''']|company_size_buckets: not in the size-bucket enum: [''huge'']'
  when 3 then 'hq_cities: expected a list of strings|limit: must be a positive integer'
  when 4 then 'people_match_mode: must be a non-empty string|people_enrich_min_quality_score: must be a number between 0 and 100'
  else 'limit: must be a positive integer|people_max_per_company: must be a positive integer' end as violations from customer""")
def icp_validate(spark, sf_dir):
    key = F.col("c_custkey") % 6
    name = F.concat(F.lit('"name":"'), F.col("c_name"), F.lit('"'))
    base = F.concat(F.lit('{"client_id":"c",'), name)
    raw = (
        F.when(key == 0, F.concat(base, F.lit(',"industries":["Banking"],"limit":10,"people_enrich_min_quality_score":70.5}')))
        .when(key == 1, F.concat(F.lit('{"client_id":"",'), name, F.lit("}")))
        .when(key == 2, F.concat(base, F.lit(',"industries":["Banking","'), F.col("c_mktsegment"), F.lit('"],"company_size_buckets":["2-10","huge"]}')))
        .when(key == 3, F.concat(base, F.lit(',"hq_cities":["x",5],"limit":true}')))
        .when(key == 4, F.concat(base, F.lit(',"people_match_mode":"","people_enrich_min_quality_score":170}')))
        .otherwise(F.concat(base, F.lit(',"limit":0,"people_max_per_company":2.5}')))
    )
    specs = table(spark, sf_dir, "customer").select("c_custkey", raw.alias("raw"))
    return icp.validate_icp(specs, industries=["Banking", "Financial Services"]).select(
        "c_custkey", F.array_join("violations", "|").alias("violations")
    )
