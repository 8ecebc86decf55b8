"""Q1: field contracts (data) and the tables made from them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Contract:
    required: bool
    null_tolerance_pct: float
    source_priority: tuple[str, ...]


# Fixed values: (required, tolerated empty share in percent, sources best first).
PAGE_CONTRACTS: dict[str, Contract] = {
    "domain_normalize": Contract(True, 10.0, ("context",)),
    "social_links_extract": Contract(False, 30.0, ("markdown",)),
    "legal_entity_extract": Contract(False, 15.0, ("markdown",)),
    "company_description_extract": Contract(False, 20.0, ("context", "markdown")),
    "site_locale_detect": Contract(False, 40.0, ("markdown",)),
    "pricing_locale_extract": Contract(False, 75.0, ("markdown",)),
    "careers_page_parse": Contract(False, 80.0, ("markdown",)),
    "tech_stack_normalize": Contract(False, 40.0, ("context", "markdown")),
    "business_model": Contract(False, 35.0, ("context", "markdown")),
    "company_entity_resolve": Contract(True, 15.0, ("context", "markdown")),
    "date_normalize": Contract(False, 20.0, ("context", "markdown")),
    "compliance_framework_extract": Contract(False, 70.0, ("markdown",)),
    "experience_signal_extract": Contract(False, 45.0, ("markdown",)),
    "service_region_extract": Contract(False, 35.0, ("markdown",)),
}


def company_contracts(source: str = "profile") -> dict[str, Contract]:
    # Tolerated empty share in percent.
    tolerance = {"name": 15.0, "industry": 35.0, "headcount": 40.0, "location": 30.0, "linkedin_url": 10.0}
    return {field: Contract(False, pct, (source,)) for field, pct in tolerance.items()}


def person_contracts(source: str = "profile") -> dict[str, Contract]:
    # Tolerated empty share in percent.
    tolerance = {
        "linkedin_url": 10.0, "full_name": 10.0, "job_title": 20.0, "seniority": 20.0,
        "country": 35.0, "linkedin_about": 50.0, "age": 95.0, "company_industry": 50.0,
    }
    return {field: Contract(False, pct, (source,)) for field, pct in tolerance.items()}


def contracts_table(spark: SparkSession, contracts: dict[str, Contract], namespace: str = "page") -> DataFrame:
    """Contracts as rows; one row per field, so always small enough to broadcast."""
    return spark.createDataFrame(
        [
            (namespace, name, c.required, c.null_tolerance_pct, list(c.source_priority))
            for name, c in contracts.items()
        ],
        "namespace string, field string, required boolean, null_tolerance_pct double, source_priority array<string>",
    )
