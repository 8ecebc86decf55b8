"""Column functions over profile values and VARIANT records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import catalogs as cat
from . import text as t
from .urls import url_key


# --- VARIANT access -------------------------------------------------------------------
def as_text(record: Column, path: str) -> Column:
    return F.try_variant_get(record, path, "string")


def first_present(record: Column, keys: Sequence[str]) -> Column:
    """Value of the first key that is neither absent, null nor empty text."""
    return F.coalesce(*[t.blank_to_null(as_text(record, f"$.{k}")) for k in keys])


def headquarters(record: Column) -> Column:
    """City, region and country of the first headquarters entry that holds anything."""

    def joined(key: str) -> Column:
        return t.blank_to_null(
            F.concat_ws(
                ", ", *[t.blank_to_null(as_text(record, f"$.{key}.{k}")) for k in ("city", "geographicArea", "country")]
            )
        )

    def holds_any(key: str) -> Column:
        return ~F.coalesce(as_text(record, f"$.{key}"), F.lit("")).isin("", "{}", "[]", "0", "false")

    return F.when(holds_any("headquarter"), joined("headquarter")).otherwise(joined("headquarters"))


# --- single values --------------------------------------------------------------------
def seniority(title: Column, strict: bool = True) -> Column:
    """Highest rung whose wording occurs; any other title is IC, none is NULL.

    "Vice President" holds "president" and therefore reads as C_LEVEL; with
    `strict=False` the VP rung is tried first.
    """
    ladder = list(cat.SENIORITY_WORDING)
    if not strict:
        ladder[0], ladder[1] = ladder[1], ladder[0]
    out = F.when(t.strip(title) == "", F.lit(None).cast("string"))
    for label, wording in ladder:
        out = out.when(t.matches(title, t.rx(wording, ignore_case=True)), label)
    return out.when(title.isNotNull(), "IC")


def non_negative(value: Column, what: str) -> Column:
    """The value itself; a negative one stops the job."""
    message = F.concat(F.lit(f"{what} cannot be negative: "), value.cast("string"))
    return F.when(value < 0, F.raise_error(message).cast("long")).otherwise(value)


def headcount_band(headcount: Column) -> Column:
    """P5: size bracket."""
    n = non_negative(headcount, "headcount")
    out = F.when(n.isNull(), F.lit(None).cast("string"))
    for ceiling, label in cat.HEADCOUNT_BANDS:
        out = out.when(n <= ceiling, label)
    return out.otherwise(cat.HEADCOUNT_ABOVE)


def hiring_signal(open_roles: Column, growth_pct: Column) -> Column:
    """From the number of open roles, else from headcount growth."""
    return (
        F.when(open_roles >= cat.ACTIVE_ROLES, "actively_hiring")
        .when(open_roles > 0, "hiring")
        .when(open_roles.isNotNull() & growth_pct.isNull(), "not_hiring")
        .when(growth_pct > 0, "growing")
        .when(growth_pct < 0, "shrinking")
        .when(growth_pct == 0, "stable")
    )


def company_type(raw: Column) -> Column:
    """Exact spelling, after trimming and lower-casing, to a code."""
    codes = [(alias, code) for code, aliases in cat.COMPANY_TYPES.items() for alias in aliases]
    lookup = t.text_map(codes)
    return F.try_element_at(lookup, F.regexp_replace(F.lower(t.strip(raw)), r"(?U)\s+", " "))


def connections_band(count: Column) -> Column:
    """The number as text, 500 and more as one band."""
    n = non_negative(count, "connections_count")
    return F.when(n >= cat.CONNECTIONS_CEILING, f"{cat.CONNECTIONS_CEILING}+").otherwise(n.cast("string"))


def mutual_connections(value: Column, sample: int | None = None) -> Column:
    """VARIANT count or list to STRUCT<mutual_count, sample_names>; all names unless `sample` is given."""
    people = F.try_variant_get(value, "$", "array<variant>")
    names = F.filter(F.transform(people, lambda p: as_text(p, "$.name")), lambda n: ~t.is_blank(n))
    none = F.array().cast("array<string>")
    count = F.greatest(F.try_variant_get(value, "$", "int"), F.lit(0))
    return F.struct(
        F.when(people.isNotNull(), F.size(people)).otherwise(F.coalesce(count, F.lit(0))).alias("mutual_count"),
        F.when(people.isNotNull(), names if sample is None else F.slice(names, 1, sample)).otherwise(none).alias("sample_names"),
    )


def bio_entities(bio: Column) -> Column:
    """URLs, companies after "at" or "@", and handles of a bio text."""
    text = F.coalesce(bio, F.lit(""))
    companies = F.transform(t.extract_all(text, t.rx(cat.BIO_COMPANY), 1), lambda c: t.strip(c))
    return F.struct(
        t.extract_all(text, t.rx(cat.BIO_URL)).alias("mentioned_urls"),
        F.array_distinct(F.filter(companies, lambda c: c != "")).alias("mentioned_companies"),
        F.array_distinct(t.extract_all(text, t.rx(cat.BIO_HANDLE), 1)).alias("mentioned_handles"),
    )


def clean_person_name(raw: Column) -> Column:
    """A display name without nickname, title, middle initials and credentials.

    Two tokens are always left; a name of one token is returned as it is.
    """
    bare = F.regexp_replace(raw, r"(?U)\s*\([^)]*\)", "")
    words = t.tokens(F.replace(bare, F.lit(","), F.lit(" ")))

    def plain(w: Column) -> Column:
        return F.upper(F.replace(w, F.lit("."), F.lit("")))

    def without_title(w: Column) -> Column:
        titled = (F.size(w) > 2) & plain(F.get(w, F.lit(0))).isin(*cat.NAME_TITLES)
        return F.when(titled, F.slice(w, 2, F.greatest(F.size(w), F.lit(1)))).otherwise(w)

    def without_credentials(w: Column) -> Column:
        # Length up to the last token that is no credential, but never below two.
        kept = F.array_max(F.transform(w, lambda x, i: F.when(~plain(x).isin(*cat.NAME_CREDENTIALS), i + 1)))
        return F.slice(w, F.lit(1), F.greatest(F.least(F.size(w), F.lit(2)), F.coalesce(kept, F.lit(0))))

    def without_initials(w: Column) -> Column:
        return F.filter(
            w, lambda x, i: (i == 0) | (i == F.size(w) - 1) | (F.length(F.replace(x, F.lit("."), F.lit(""))) != 1)
        )

    cleaned = t.let(t.let(t.let(words, without_title), without_credentials), without_initials)
    return t.let(
        cleaned,
        lambda w: F.when(F.size(w) >= 2, F.array_join(w, " "))
        .when(F.size(w) == 1, t.strip(bare))
        .otherwise(t.strip(raw)),
    )


# --- experience entries ---------------------------------------------------------------
def has_no_end(end_date: Column) -> Column:
    """An end date that is absent or carries neither month nor year."""
    return end_date.isNull() | (end_date["month"].isNull() & end_date["year"].isNull())


def name_key(name: Column) -> Column:
    return t.blank_to_null(F.lower(t.strip(name)))


def current_at_company(experience: Column, company_name: Column, company_url: Column) -> Column:
    """B17 on a nested profile: TRUE still there, FALSE left, NULL no entry matches.

    `experience` is ARRAY<STRUCT<companyName, companyLinkedinUrl, endDate STRUCT<month, year, text>>>.
    """
    neither = t.is_blank(company_name) & t.is_blank(company_url)

    def at_company(e: Column) -> Column:
        by_url = url_key(e["companyLinkedinUrl"]) == url_key(company_url)
        by_name = name_key(e["companyName"]) == name_key(company_name)
        return F.coalesce(by_url, F.lit(False)) | F.coalesce(by_name, F.lit(False))

    verdict = t.let(
        F.filter(experience, at_company),
        lambda hits: F.when(F.size(hits) > 0, F.exists(hits, lambda e: has_no_end(e["endDate"]))),
    )
    message = "a company name or a company URL is needed to match against"
    return F.when(neither, F.raise_error(F.lit(message)).cast("boolean")).otherwise(verdict)


# --- dates of an experience -----------------------------------------------------------
def year_month(raw: Column) -> Column:
    """`2020-01`, `2020` or `Jan 2020` as STRUCT<year, month>; NULL for anything else."""
    text = F.lower(t.strip(raw))
    iso_year, iso_month = (F.regexp_extract(text, r"^(\d{4})-(\d{1,2})\z", g) for g in (1, 2))
    only_year = F.regexp_extract(text, r"^(\d{4})\z", 1)
    word, word_year = (F.regexp_extract(text, r"(?U)^([a-z]{3,9})\.?\s+(\d{4})\z", g) for g in (1, 2))
    months = t.text_array(m[:3].lower() for m in cat.MONTHS)
    month_no = F.nullif(F.array_position(months, F.substring(word, 1, 3)), F.lit(0)).cast("int")

    def pair(year: Column, month: Column) -> Column:
        return F.struct(year.try_cast("int").alias("year"), month.alias("month"))

    return (
        F.when(iso_year != "", pair(iso_year, iso_month.try_cast("int")))
        .when(only_year != "", pair(only_year, F.lit(None).cast("int")))
        .when((word_year != "") & month_no.isNotNull(), pair(word_year, month_no))
    )


def is_ongoing(end: Column) -> Column:
    return end.isNull() | F.lower(t.strip(end)).isin(*cat.ONGOING)


def span_years(began: Column, ended: Column, ongoing: Column, as_of: Column) -> Column:
    """Years between two parsed year-months, at least 0; NULL when one is missing."""
    end_months = F.when(ongoing, F.year(as_of) * 12 + F.month(as_of)).otherwise(
        ended["year"] * 12 + F.coalesce(F.nullif(ended["month"], F.lit(0)), F.lit(12))
    )
    start_months = began["year"] * 12 + F.coalesce(F.nullif(began["month"], F.lit(0)), F.lit(1))
    months = end_months - start_months
    return F.when(months > 0, months).when(months.isNotNull(), F.lit(0)) / F.lit(12.0)


def duration_years(start: Column, end: Column, as_of: Column) -> Column:
    """The same for two texts, each read once."""
    both = F.struct(year_month(start).alias("began"), year_month(end).alias("ended"), is_ongoing(end).alias("ongoing"))
    return t.let(both, lambda p: span_years(p["began"], p["ended"], p["ongoing"], as_of))
