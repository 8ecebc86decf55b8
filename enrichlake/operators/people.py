"""People of companies, leads and their matches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import catalogs as cat
from ..functions import text as t
from ..functions.profiles import clean_person_name, is_ongoing, name_key
from ..functions.urls import root_domain, url_key
from .icp import Icp, title_condition
from .skew import number_rows, spread_nulls, top_k


def people_waterfall(companies: DataFrame, people: DataFrame, icp: Icp, order_by: Sequence[str] = ("person_id",)) -> DataFrame:
    """People of each valid company, by domain, else by name.

    `companies(company_id, domain_normalize, company_name, is_valid_row)`,
    `people(person_id, company_domain, company_name, job_title, ...)`. At most
    `people_max_per_company` per company, first in `order_by`.

    The cap is a report of the first k people, so it is taken per domain and per
    name *before* the join: a domain that holds a third of all people sends k rows
    per task, and the joins are one-to-few.
    """
    person_cols = people.columns
    if not (icp.people_job_title_include or icp.people_job_title_exclude):
        nobody = companies.where(F.lit(False)).withColumn("p", F.lit(None).cast(people.schema))
        return _waterfall_row(nobody, "domain")
    cap = icp.people_max_per_company
    titled = people.where(
        title_condition(
            F.col("job_title"), icp.people_job_title_include, icp.people_job_title_exclude, icp.people_match_mode
        )
    )
    valid = companies.where("is_valid_row")

    def first_people(key: str) -> DataFrame:
        keyed = titled.where(~t.is_blank(F.col(key)))
        return top_k(keyed, [key], [F.asc(c) for c in order_by], cap).select(
            F.col(key).alias("_key"), F.struct(*person_cols).alias("p")
        )

    by_domain = valid.withColumn("_key", F.col("domain_normalize")).where(~t.is_blank(F.col("_key"))).join(
        first_people("company_domain"), "_key"
    )
    # Companies without a single domain hit go on to the name.
    hit_domains = titled.where(~t.is_blank(F.col("company_domain"))).select(F.col("company_domain").alias("_dkey")).distinct()
    no_hit = valid.withColumn(
        "_dkey", spread_nulls(t.blank_to_null(F.col("domain_normalize")), F.col("company_id"))
    ).join(hit_domains, "_dkey", "left_anti").drop("_dkey")
    by_name = no_hit.withColumn("_key", F.col("company_name")).where(~t.is_blank(F.col("_key"))).join(
        first_people("company_name"), "_key"
    )
    return _waterfall_row(by_domain, "domain").unionByName(_waterfall_row(by_name, "name"))


def _waterfall_row(matched: DataFrame, matched_by: str) -> DataFrame:
    person = [c for c in matched.schema["p"].dataType.names]
    return matched.select(
        F.col("company_id").alias("company_row_id"),
        F.col("domain_normalize").alias("company_domain_normalize"),
        F.lit(matched_by).alias("matched_by"),
        *[F.col(f"p.{c}").alias(c) for c in person],
    )


def enrich_eligible(people: DataFrame, companies: DataFrame, icp: Icp) -> DataFrame:
    """People at companies whose page scored high enough to enrich."""
    good = companies.where(F.col("quality_score") >= icp.people_enrich_min_quality_score).select(
        F.col("domain_normalize").alias("company_domain_normalize")
    )
    return people.where(F.col("company_domain_normalize").isNotNull()).join(
        good, "company_domain_normalize", "left_semi"
    )


def clean_names(people: DataFrame, col: str = "full_name", out: str = "clean_name") -> DataFrame:
    """B14 over a table."""
    return people.withColumn(out, clean_person_name(F.col(col)))


def lead_batches(leads: DataFrame, order_by: str = "lead_id", size: int = cat.LEAD_BATCH) -> DataFrame:
    """`batch_id` for batches of `size` leads in order, numbered without a single-task sort."""
    if not 0 < size <= cat.LEAD_BATCH:
        raise ValueError(f"a batch holds at most {cat.LEAD_BATCH} leads, got {size}")
    return number_rows(leads, [order_by]).withColumn("batch_id", F.floor((F.col("rn") - 1) / size)).drop("rn")


def lead_is_valid() -> Column:
    """Name and company, or a LinkedIn URL, an e-mail or a person id."""

    def given(*names: str) -> Column:
        out = F.lit(False)
        for n in names:
            out = out | ~t.is_blank(F.col(n))
        return out

    named = (given("first_name") & given("last_name")) | given("full_name")
    company = given("company_name", "company_website", "company_linkedin_url")
    return (named & company) | given("linkedin_url", "email", "person_id")


LEAD_COLUMNS = (
    "first_name", "last_name", "full_name", "company_name", "company_website", "company_linkedin_url",
    "linkedin_url", "email", "person_id",
)


def match_leads(leads: DataFrame, person_ref: DataFrame) -> DataFrame:
    """Split leads into matched, not_matched and invalid.

    The first identifier with a hit decides: person id, LinkedIn URL, e-mail, then
    the cleaned name with company name, website or company LinkedIn URL. Leads and
    reference are spread to one row per (kind, key) and meet in one join; a key
    stands for its smallest person id, so no lead is multiplied. `lead_id` names a lead.
    """
    absent = {c: F.lit(None).cast("string") for c in LEAD_COLUMNS if c not in leads.columns}
    full_name = F.coalesce(
        t.blank_to_null(F.col("full_name")), t.blank_to_null(F.concat_ws(" ", "first_name", "last_name"))
    )

    def keys(name: Column) -> Column:
        person = t.blank_to_null(name_key(clean_person_name(name)))

        def at(company: Column) -> Column:
            return F.concat(person, F.lit("\u0001"), t.blank_to_null(company))

        found = {
            "id": F.col("person_id").cast("string"),
            "url": url_key(F.col("linkedin_url")),
            "email": name_key(F.col("email")),
            "name": at(name_key(F.col("company_name"))),
            "website": at(root_domain(F.col("company_website"))),
            "company_url": at(url_key(F.col("company_linkedin_url"))),
        }
        # Company name, website and company URL are ways to say the same, so all three report "name".
        every = [
            F.struct(F.lit(i).alias("step"), F.lit("name" if i > 3 else kind).alias("kind"), t.blank_to_null(key).alias("key"))
            for i, (kind, key) in enumerate(found.items())
        ]
        return F.explode(F.filter(F.array(*every), lambda x: x["key"].isNotNull()))

    known = {c: F.lit(None).cast("string") for c in LEAD_COLUMNS if c not in person_ref.columns}
    refs = (
        person_ref.withColumns(known)
        .select(F.col("person_id").cast("string").alias("_pid"), keys(F.col("full_name")).alias("k"))
        .groupBy("k.step", "k.key")
        .agg(F.min("_pid").alias("_pid"))
    )
    checked = leads.withColumns(absent).withColumn("_valid", lead_is_valid())
    asked = checked.where("_valid").select("lead_id", keys(full_name).alias("k")).select("lead_id", "k.*")
    first = F.min(F.struct("step", "kind", "_pid")).alias("hit")
    hits = asked.join(refs, ["step", "key"]).groupBy("lead_id").agg(first)
    out = checked.join(hits, "lead_id", "left")
    status = F.when(~F.col("_valid"), "invalid").when(F.col("hit").isNotNull(), "matched").otherwise("not_matched")
    return out.select(
        *leads.columns, status.alias("status"), F.col("hit._pid").alias("matched_person_id"), F.col("hit.kind").alias("matched_by")
    )


def current_at_company(experience: DataFrame, pairs: DataFrame) -> DataFrame:
    """B17 over long tables: `is_current_at_company` per (person, company) pair.

    `experience(person_id, company, company_url, end_date)` with `end_date` NULL, blank or
    a word like "Present" for a role that goes on; `pairs(pair_id, person_id, company_name, company_url)`.
    Roles are first reduced to one row per (person, company key), so each pair
    meets at most one row per key instead of all roles of its person.
    """
    current = is_ongoing(t.blank_to_null(F.col("end_date")))

    def roles(key: Column, flag: str) -> DataFrame:
        return (
            experience.select("person_id", key.alias("_key"), current.alias("_current"))
            .where(~t.is_blank(F.col("_key")))
            .groupBy("person_id", "_key")
            .agg(F.bool_or("_current").alias(flag))
        )

    def keyed(df: DataFrame, key: Column) -> DataFrame:
        return df.withColumn("_key", spread_nulls(t.blank_to_null(key), F.col("pair_id")))

    neither = t.is_blank(F.col("company_name")) & t.is_blank(F.col("company_url"))
    message = "a company name or a company URL is needed to match against"
    checked = pairs.withColumn(
        "company_name", F.when(neither, F.raise_error(F.lit(message)).cast("string")).otherwise(F.col("company_name"))
    )
    by_url = keyed(checked, url_key(F.col("company_url"))).join(
        roles(url_key(F.col("company_url")), "_by_url"), ["person_id", "_key"], "left"
    )
    by_name = keyed(by_url.drop("_key"), name_key(F.col("company_name"))).join(
        roles(name_key(F.col("company")), "_by_name"), ["person_id", "_key"], "left"
    )
    found = F.coalesce("_by_url", "_by_name").isNotNull()
    current = F.coalesce("_by_url", F.lit(False)) | F.coalesce("_by_name", F.lit(False))
    return by_name.select(*pairs.columns, F.when(found, current).alias("is_current_at_company"))
