"""The ideal customer profile and the filters made from it.

A profile is configuration: one small object per client. Its lists become literal
predicates, which reach the file scan where the columns are plain.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from ..functions import catalogs as cat
from ..functions import text as t

LIST_FIELDS = (
    "industries", "company_size_buckets", "hq_countries", "hq_cities", "technologies", "description_keywords",
    "products_and_services", "exclude_domains", "people_job_title_include", "people_job_title_exclude",
)
SIMILARITY = 0.5


@dataclass(frozen=True)
class Icp:
    client_id: str
    name: str
    industries: tuple[str, ...] = ()
    company_size_buckets: tuple[str, ...] = ()
    hq_countries: tuple[str, ...] = ()
    hq_cities: tuple[str, ...] = ()
    technologies: tuple[str, ...] = ()
    description_keywords: tuple[str, ...] = ()
    products_and_services: tuple[str, ...] = ()
    exclude_domains: tuple[str, ...] = ()
    limit: int | None = 100  # None: all
    notes: str | None = None
    created_at: str | None = None
    people_job_title_include: tuple[str, ...] = ()
    people_job_title_exclude: tuple[str, ...] = ()
    people_match_mode: str = "CONTAINS"
    people_max_per_company: int = 5
    people_enrich_min_quality_score: float = 70.0

    @classmethod
    def from_row(cls, row: Row) -> Icp:
        """One client's row of :func:`parse_icp`."""
        values = row.asDict()
        kept = {f.name: values[f.name] for f in fields(cls) if values.get(f.name) is not None}
        return cls(**{k: tuple(v) if isinstance(v, list) else v for k, v in kept.items()})


# --- I1 ---------------------------------------------------------------------------
def icp_violations(spec: Column, industries: Sequence[str] | None = None) -> Column:
    """All violations of one profile (VARIANT), in a fixed order.

    `industries` is the allowed vocabulary; without it industries are not checked.
    """

    def at(name: str) -> Column:
        return F.try_variant_get(spec, f"$.{name}", "variant")

    def kind(name: str) -> Column:
        return F.schema_of_variant(at(name))

    def strings(name: str) -> Column:
        return F.try_variant_get(spec, f"$.{name}", "array<string>")

    def is_integer(name: str) -> Column:
        return kind(name) == "BIGINT"

    def whole_positive(name: str) -> Column:
        return is_integer(name) & (F.try_variant_get(spec, f"$.{name}", "long") > 0)

    def listed(xs: Column) -> Column:
        return F.concat(F.lit("['"), F.array_join(xs, "', '"), F.lit("']"))

    checks: list[Column] = []
    for name in ("client_id", "name"):
        text = F.coalesce(F.try_variant_get(spec, f"$.{name}", "string"), F.lit(""))
        checks.append(F.when(text.isin("", "0", "false", "[]", "{}"), f"{name}: required but missing"))
    for name in LIST_FIELDS:
        elements = F.try_variant_get(spec, f"$.{name}", "array<variant>")
        fine = F.startswith(kind(name), F.lit("ARRAY")) & F.forall(
            F.coalesce(elements, F.array().cast("array<variant>")), lambda e: F.schema_of_variant(e) == "STRING"
        )
        checks.append(F.when(at(name).isNotNull() & ~fine, f"{name}: expected a list of strings"))
    vocabularies = [("company_size_buckets", cat.SIZE_BUCKETS, "size-bucket")]
    if industries is not None:
        vocabularies.insert(0, ("industries", tuple(industries), "industry"))
    for name, allowed, label in vocabularies:
        unknown = F.array_sort(F.array_except(strings(name), t.text_array(allowed)))
        checks.append(
            F.when(F.size(unknown) > 0, F.concat(F.lit(f"{name}: not in the {label} enum: "), listed(unknown)))
        )
    mode_ok = (kind("people_match_mode") == "STRING") & (as_string(spec, "people_match_mode") != "")
    score = F.try_variant_get(spec, "$.people_enrich_min_quality_score", "double")
    score_kind = kind("people_enrich_min_quality_score")
    score_ok = (
        F.startswith(score_kind, F.lit("BIGINT"))
        | F.startswith(score_kind, F.lit("DECIMAL"))
        | F.startswith(score_kind, F.lit("DOUBLE"))
    ) & score.between(0, 100)
    rest = [
        ("limit", whole_positive("limit"), "limit: must be a positive integer"),
        ("people_match_mode", mode_ok, "people_match_mode: must be a non-empty string"),
        (
            "people_max_per_company", whole_positive("people_max_per_company"),
            "people_max_per_company: must be a positive integer",
        ),
        (
            "people_enrich_min_quality_score", score_ok,
            "people_enrich_min_quality_score: must be a number between 0 and 100",
        ),
    ]
    for name, ok, message in rest:
        checks.append(F.when(at(name).isNotNull() & ~F.coalesce(ok, F.lit(False)), message))
    return F.array_compact(F.array(*checks))


def as_string(spec: Column, name: str) -> Column:
    return F.try_variant_get(spec, f"$.{name}", "string")


def validate_icp(specs: DataFrame, raw: str = "raw", industries: Sequence[str] | None = None) -> DataFrame:
    """Add `violations` to a table of profile JSON texts."""
    return specs.withColumn("violations", icp_violations(F.parse_json(F.col(raw)), industries))


def parse_icp(specs: DataFrame, raw: str = "raw") -> DataFrame:
    """Typed profile columns; what a profile leaves out gets its default."""
    spec = F.parse_json(F.col(raw))
    defaults = {f.name: f.default for f in fields(Icp)}
    typed = []
    for f in fields(Icp):
        if f.name in LIST_FIELDS:
            value = F.coalesce(F.try_variant_get(spec, f"$.{f.name}", "array<string>"), F.array().cast("array<string>"))
        else:
            kind = {"limit": "int", "people_max_per_company": "int", "people_enrich_min_quality_score": "double"}.get(
                f.name, "string"
            )
            value = F.try_variant_get(spec, f"$.{f.name}", kind)
            if isinstance(defaults[f.name], (int, float, str)):
                value = F.coalesce(value, F.lit(defaults[f.name]))
        typed.append(value.alias(f.name))
    return specs.select(*typed)


# --- B6-B8 ------------------------------------------------------------------------
def similar_to(text: Column, phrases: Sequence[str], threshold: float = SIMILARITY) -> Column:
    """TRUE when the text holds enough of the words of some phrase.

    The upstream vendor does not define its similarity; this share of shared
    words is this library's own definition.
    """
    words = F.array_distinct(t.tokens(F.regexp_replace(F.lower(text), r"(?U)[^\w]+", " ")))
    hit = F.lit(False)
    for phrase in phrases:
        wanted = sorted({w for w in "".join(ch if ch.isalnum() else " " for ch in phrase.lower()).split()})
        if wanted:
            shared = F.size(F.array_intersect(words, t.text_array(wanted)))
            hit = hit | (shared >= threshold * len(wanted))
    return F.coalesce(hit, F.lit(False))


def _company_clauses(get: Callable[[str], Column], icp: Icp, threshold: float) -> list[Column]:
    clauses: list[Column] = []
    if icp.industries:
        clauses.append(get("industry").isin(*icp.industries))
    if icp.company_size_buckets:
        clauses.append(get("company_size").isin(*icp.company_size_buckets))
    if icp.hq_countries or icp.hq_cities:

        def headquarters(place: Column) -> Column:
            fits = place["is_headquarters"]
            if icp.hq_countries:
                fits = fits & place["country_name"].isin(*icp.hq_countries)
            if icp.hq_cities:
                fits = fits & place["city"].isin(*icp.hq_cities)
            return fits

        clauses.append(F.exists(get("locations"), headquarters))
    if icp.technologies:
        clauses.append(
            F.exists(
                get("technographics"),
                lambda x: x["vendor"].isin(*icp.technologies) | x["product"].isin(*icp.technologies),
            )
        )
    if icp.products_and_services:
        clauses.append(similar_to(get("products_and_services"), icp.products_and_services, threshold))
    if icp.description_keywords:
        hit = F.lit(False)
        for word in icp.description_keywords:
            hit = hit | F.contains(F.lower(get("description")), F.lit(word.lower()))
        clauses.append(hit)
    return clauses


def _all(clauses: Sequence[Column]) -> Column:
    out = F.lit(True)
    for c in clauses:
        out = out & c
    return F.coalesce(out, F.lit(False))


def icp_filter_companies(companies: DataFrame, icp: Icp, threshold: float = SIMILARITY) -> DataFrame:
    """Companies that meet every clause the profile sets; no clause keeps all.

    A clause is applied as a filter of its own, so plain ones are pushed to the scan.
    """
    out = companies
    for clause in _company_clauses(F.col, icp, threshold):
        out = out.where(clause)
    if icp.exclude_domains:
        out = out.where(F.col("domain").isNull() | ~F.col("domain").isin(*icp.exclude_domains))
    return out


def title_matches(title: Column, include: Sequence[str], exclude: Sequence[str], threshold: float = SIMILARITY) -> Column:
    fits = similar_to(title, include, threshold)
    return fits & ~similar_to(title, exclude, threshold) if exclude else fits


def icp_filter_people(people: DataFrame, icp: Icp, threshold: float = SIMILARITY) -> DataFrame:
    """People with one current role that meets title and employer clauses together.

    Without a title to include nobody is selected.
    """
    if not icp.people_job_title_include:
        return people.where(F.lit(False))

    def role_fits(e: Column) -> Column:
        titles = title_matches(e["job_title"], icp.people_job_title_include, icp.people_job_title_exclude, threshold)
        return _all([e["is_current"], titles, *_company_clauses(lambda c: e["company"][c], icp, threshold)])

    return people.where(F.exists("experiences", role_fits))


def people_at_domains(
    people: DataFrame,
    domains: DataFrame,
    include: Sequence[str],
    exclude: Sequence[str] = (),
    threshold: float = SIMILARITY,
) -> DataFrame:
    """People whose company domain is in `domains` and whose current title fits.

    A semi join; Spark broadcasts the domain list when its size allows.
    """
    if not include:
        return people.where(F.lit(False))
    fits = F.exists(
        "experiences", lambda e: _all([e["is_current"], title_matches(e["job_title"], include, exclude, threshold)])
    )
    wanted = domains.select(F.col("domain").alias("company_domain")).where(F.col("company_domain").isNotNull())
    return people.where(F.col("company_domain").isNotNull() & fits).join(wanted, "company_domain", "left_semi")


def limit_results(df: DataFrame, n: int | None, *order: Column | str) -> DataFrame:
    """The first `n` rows in an explicit order; all rows, as they are, without a limit.

    Spark returns the first rows in one partition, so they are dealt anew for the work behind.
    """
    return df if n is None else df.orderBy(*order).limit(n).hint("rebalance")


# --- B10 --------------------------------------------------------------------------
def title_condition(title: Column, include: Sequence[str], exclude: Sequence[str] = (), mode: str = "CONTAINS") -> Column:
    """Any include phrase and no exclude phrase, ignoring case."""
    if mode not in ("CONTAINS", "EXACT"):
        raise ValueError(f"unknown match mode: {mode!r}")

    def hits(phrases: Sequence[str]) -> Column:
        out = F.lit(False)
        for phrase in phrases:
            low = F.lit(phrase.lower())
            out = out | (F.contains(F.lower(title), low) if mode == "CONTAINS" else F.lower(title) == low)
        return F.coalesce(out, F.lit(False))

    wanted = hits(include) if include else F.lit(True)
    return wanted & ~hits(exclude)


def title_filter(
    people: DataFrame, include: Sequence[str], exclude: Sequence[str] = (), mode: str = "CONTAINS", col: str = "job_title"
) -> DataFrame:
    return people.where(title_condition(F.col(col), include, exclude, mode))
