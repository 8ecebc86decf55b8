"""Company rows, person rows, their link, and the whole run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contracts import company_contracts, person_contracts
from ..functions import text as t
from ..functions.profiles import seniority
from ..operators.bronze import build_page_inputs
from ..operators.icp import Icp, icp_filter_companies, limit_results
from ..operators.page_fields import company_name_key
from ..operators.people import people_waterfall
from ..operators.profiles import employed_company
from ..operators.resolve import Rule, default_rules, resolve_columns
from ..operators.skew import spread_nulls
from ..session import checkpointed
from .pages import evaluate_records, process_batch

COMPANY_FIELDS = ("industry", "headcount", "location", "linkedin_url")
PERSON_FIELDS = ("linkedin_url", "full_name", "job_title", "country", "linkedin_about", "age", "company_industry")
GATE_COLUMNS = ("quality_score", "is_valid_row", "rejection_reasons", "drift_warnings")


def _gated(rows: DataFrame, contracts, label: str, id_col: str, source: str, with_drift: bool) -> DataFrame:
    out = evaluate_records(rows, contracts, label, id_col, source, with_drift=with_drift)
    if not with_drift:
        out = out.withColumn("drift_warnings", F.array().cast("array<string>"))
    return out


def assemble_company_rows(
    profiles: DataFrame,
    page_rows: DataFrame,
    profile_source: str = "profile",
    page_source: str = "page",
    rule: Rule | None = None,
    with_drift: bool = True,
) -> DataFrame:
    """A row per page with the profile of its domain, and a row per profile that no page took.

    Of several profiles of a domain its pages take the one with the smallest
    `record_id`; the others stay as rows without a page, so the join is many-to-one
    and no domain multiplies.

    `profiles(record_id, domain, name, industry, headcount, location, linkedin_url
    [, source_link])`; `page_rows` as made by the page gate, read back from the table
    they were written to, since both joins below read them. The outer join is a
    left join plus the profiles without a page, because a full outer join cannot
    split a domain that holds many rows, and these two can.
    """
    rule = rule or default_rules(profile_source, page_source)["company_name"]
    profiles = profiles if "source_link" in profiles.columns else profiles.withColumn(
        "source_link", F.lit(None).cast("string")
    )
    gated = _gated(
        profiles, company_contracts(profile_source), f"{profile_source}_company", "record_id", profile_source, with_drift
    )
    left_cols = ["record_id", "name", *COMPANY_FIELDS, "source_link", *GATE_COLUMNS]
    left = gated.select(
        spread_nulls(t.blank_to_null(F.col("domain")), F.concat(F.lit("r"), F.col("record_id").cast("string"))).alias("_key"),
        *left_cols,
    )
    # Read three times below: for the choice, for the pages and for what no page took.
    left = checkpointed(left)
    right = page_rows.select(
        spread_nulls(F.col("domain_normalize"), F.concat(F.lit("p"), F.col("page_id").cast("string"))).alias("_key"),
        "page_id",
        F.col("domain_normalize").alias("domain"),
        F.col("company_description_extract").alias("description"),
        F.col("company_entity_resolve").alias("company_id"),
    )
    chosen = left.groupBy("_key").agg(F.min("record_id").alias("_chosen"))
    with_page = right.join(
        left.join(chosen, "_key").where(F.col("record_id").eqNullSafe(F.col("_chosen"))).drop("_chosen"), "_key", "left"
    )
    taken = right.select("_key").distinct().join(chosen, "_key")
    only_profile = left.join(
        taken.select(F.col("_key").alias("_k"), "_chosen"),
        (F.col("_key") == F.col("_k")) & F.col("record_id").eqNullSafe(F.col("_chosen")), "left_anti",
    )
    both = with_page.unionByName(only_profile, allowMissingColumns=True)
    name = resolve_columns(
        [(profile_source, F.col("name")), (page_source, F.col("company_id.company_name"))], rule
    )
    out = both.withColumn("_name", name)
    return out.select(
        "record_id",
        "page_id",
        F.col("_name.value").alias("name"),
        F.col("_name.source").alias("name_source"),
        F.coalesce("_name.conflict", F.lit(False)).alias("name_conflict"),
        *[c for f in COMPANY_FIELDS for c in (F.col(f), F.lit(profile_source).alias(f"{f}_source"))],
        "domain",
        F.lit(page_source).alias("domain_source"),
        "description",
        F.lit(page_source).alias("description_source"),
        "company_id",
        F.col("company_id.company_id").alias("company_id_key"),
        "source_link",
        *[F.col(c).alias(f"{profile_source}_{c}") for c in GATE_COLUMNS],
    )


def assemble_person_rows(
    profiles: DataFrame,
    contacts: DataFrame | None = None,
    experience: DataFrame | None = None,
    key: str = "linkedin_url",
    profile_source: str = "profile",
    contact_source: str = "contact",
    with_drift: bool = True,
) -> DataFrame:
    """Profile fields with tags, employer, and all contact columns passed through.

    `contacts` is joined on `key` (one contact per key); a contact column overwrites a
    profile column of the same name, unless the profile has no contact at all.
    `experience` is the long table of :func:`employed_company`, keyed by `record_id`.
    """
    extra = {
        c: F.lit(None).cast("string")
        for c in ("seniority", "employed_company", "source_link")
        if c not in profiles.columns
    }
    gated = _gated(
        profiles.withColumns(extra) if extra else profiles,
        person_contracts(profile_source), f"{profile_source}_people", "record_id", profile_source, with_drift,
    )
    if experience is not None:
        roles = employed_company(experience, "record_id").select(
            "record_id", F.col("employed_company").alias("_employer"), F.lit(True).alias("_has_roles")
        )
        gated = gated.join(roles, "record_id", "left")
        employer = F.when(F.col("_has_roles"), F.col("_employer")).otherwise(F.col("employed_company"))
    else:
        employer = F.col("employed_company")
    columns = {f: F.col(f) for f in PERSON_FIELDS}
    columns["seniority"] = F.coalesce(seniority(F.col("job_title")), F.col("seniority"))
    columns["employed_company"] = employer
    tags = {f"{f}_source": F.lit(profile_source) for f in columns}
    contact_fields: list[str] = []
    if contacts is not None:
        # A contact table may carry its own `<column>_source` tags; they win over `contact_source`.
        tagged = {c for c in contacts.columns if f"{c}_source" in contacts.columns}
        contact_fields = [c for c in contacts.columns if c != key and c.removesuffix("_source") not in tagged - {c}]
        # One contact per key keeps the join many-to-one, whatever the export repeats.
        named = contacts.where(~t.is_blank(F.col(key))).groupBy(F.col(key).alias("_key")).agg(
            F.min(F.struct(*[F.col(c) for c in contacts.columns])).alias("_contact")
        )
        gated = gated.withColumn("_key", spread_nulls(t.blank_to_null(F.col(key)), F.col("record_id"))).join(
            named, "_key", "left"
        )
        has_contact = F.col("_contact").isNotNull()
        for c in contact_fields:
            value = F.col(f"_contact.{c}")
            columns[c] = F.when(has_contact, value).otherwise(columns[c]) if c in columns else value
            label = F.coalesce(F.col(f"_contact.{c}_source"), F.lit(contact_source)) if c in tagged else F.lit(contact_source)
            tags[f"{c}_source"] = F.when(has_contact, label).otherwise(F.lit(profile_source)) if f"{c}_source" in tags else label
    if "email" not in columns:
        columns["email"] = F.lit(None).cast("string")
        tags["email_source"] = F.lit(contact_source)
    return gated.select(
        "record_id",
        *[x for f, c in columns.items() for x in (c.alias(f), tags[f"{f}_source"].alias(f"{f}_source"))],
        "source_link",
        *[F.col(c).alias(f"{profile_source}_{c}") for c in GATE_COLUMNS],
    )


def company_person_link(people: DataFrame, companies: DataFrame, person_col: str = "employed_company") -> DataFrame:
    """Person to company by employer name without legal suffixes.

    Where several companies share a name the smallest id is taken.
    """
    named = (
        companies.select(company_name_key(F.col("name")).alias("_key"), F.col("company_id").alias("linked_company_id"))
        .where(F.col("_key").isNotNull())
        .groupBy("_key")
        .agg(F.min("linked_company_id").alias("linked_company_id"))
    )
    keyed = people.withColumn("_key", spread_nulls(company_name_key(F.col(person_col)), F.col("person_id")))
    return keyed.join(named, "_key", "left").drop("_key")


def companies_and_people(
    icp: Icp, companies: DataFrame, fetches: DataFrame, people: DataFrame, order_by: Sequence[str] = ("company_id",),
    history: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Profile filter, pages, gate with drift warnings, people of the companies that pass."""
    chosen = limit_results(icp_filter_companies(companies, icp), icp.limit, *order_by)
    gated = checkpointed(process_batch(build_page_inputs(chosen, fetches), history=history, ordered=False))
    found = people_waterfall(
        gated.select(
            F.col("page_id").alias("company_id"),
            "domain_normalize",
            F.col("company_entity_resolve.company_name").alias("company_name"),
            "is_valid_row",
        ),
        people,
        icp,
    )
    return {"companies": gated, "people": found}
