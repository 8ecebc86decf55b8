"""Jobs over profile records and their long tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import catalogs as cat
from ..functions import profiles as p
from ..functions import text as t
from .page_structure import dictionary_codes


def company_universal(records: DataFrame, id_col: str = "record_id", raw: str = "raw") -> DataFrame:
    """Name, industry, headcount, location and LinkedIn URL of a company record."""
    v = F.col(raw)
    keys = cat.COMPANY_KEYS
    return records.select(
        id_col,
        p.first_present(v, keys["name"]).alias("name"),
        p.first_present(v, keys["industry"]).alias("industry"),
        p.first_present(v, keys["headcount"]).alias("headcount"),
        F.coalesce(p.headquarters(v), p.first_present(v, keys["location"])).alias("location"),
        p.first_present(v, keys["linkedin_url"]).alias("linkedin_url"),
    )


def person_universal(records: DataFrame, id_col: str = "record_id", raw: str = "raw") -> DataFrame:
    """The eight fields of a person record; seniority follows from the title."""
    v = F.col(raw)
    found = {name: p.first_present(v, keys) for name, keys in cat.PERSON_KEYS.items()}
    split_name = F.concat_ws(
        " ", t.blank_to_null(p.as_text(v, "$.firstName")), t.blank_to_null(p.as_text(v, "$.lastName"))
    )
    found["full_name"] = F.coalesce(found["full_name"], t.blank_to_null(split_name))
    found["age"] = found["age"].try_cast("int")
    flat = records.select(id_col, *[c.alias(name) for name, c in found.items()])
    order = ["linkedin_url", "full_name", "job_title", "seniority", "country", "linkedin_about", "age", "company_industry"]
    return flat.withColumn("seniority", p.seniority(F.col("job_title"))).select(id_col, *order)


def bio_entities(people: DataFrame, id_col: str = "person_id", text_col: str = "about") -> DataFrame:
    """P8 as rows (id, kind, pos, entity)."""
    entities = people.select(id_col, p.bio_entities(F.col(text_col)).alias("e"))
    kinds = {"url": "mentioned_urls", "company": "mentioned_companies", "handle": "mentioned_handles"}

    def entries_of(kind: str, name: str) -> Column:
        return F.transform(
            F.col(f"e.{name}"),
            lambda x, i: F.struct(F.lit(kind).alias("kind"), i.alias("pos"), x.alias("entity")),
        )

    entries = F.concat(*[entries_of(kind, name) for kind, name in kinds.items()])
    return entities.select(id_col, F.inline(entries))


def topics(people: DataFrame, id_col: str = "person_id", text_col: str = "about") -> DataFrame:
    """Topic codes of a text, or of an array of texts."""
    text = F.col(text_col)
    if people.schema[text_col].dataType.typeName() == "array":
        text = F.array_join(F.filter(text, lambda x: ~t.is_blank(x)), "\n")
    codes = dictionary_codes(text, cat.TOPICS)
    return people.select(id_col, F.coalesce(codes, F.array().cast("array<string>")).alias("topics"))


def fund_role(title: Column) -> Column:
    """First code, in fixed order, whose wording occurs."""
    return t.first_or_null(dictionary_codes(title, cat.FUND_ROLES))


def engagement_aggregate(posts: DataFrame, profiles: DataFrame | None = None, id_col: str = "person_id") -> DataFrame:
    """P10: posts, reactions, comments and mean reactions per profile.

    With `profiles`, those without a post appear with zeros and a NULL mean.
    """

    def total(c: str) -> Column:
        return F.sum(F.coalesce(F.col(c).cast("long"), F.lit(0)))

    sums = posts.groupBy(id_col).agg(
        F.count(F.lit(1)).alias("total_posts"),
        total("reactions").alias("total_reactions"),
        total("comments").alias("total_comments"),
    )
    if profiles is not None:
        sums = profiles.select(id_col).join(sums, id_col, "left").na.fill(
            0, ["total_posts", "total_reactions", "total_comments"]
        )
    mean = F.col("total_reactions") / F.nullif(F.col("total_posts"), F.lit(0))
    return sums.withColumn("avg_reactions_per_post", F.round(mean, 2))


def experience_durations(experience: DataFrame, as_of: Column) -> DataFrame:
    """P11 per role: adds `duration_years` (2 decimals) and `is_current`."""
    return experience.withColumns(
        {
            "duration_years": F.round(p.duration_years(F.col("start_date"), F.col("end_date"), as_of), 2),
            "is_current": p.is_ongoing(F.col("end_date")),
        }
    )


def experience_summary(experience: DataFrame, as_of: Column, id_col: str = "person_id") -> DataFrame:
    """P11 per person: total years and current tenure.

    All aggregates combine before the shuffle; a person's roles are never gathered.
    """
    # Each date text is read once, in a projection of its own.
    read = experience.select(
        id_col,
        "pos",
        t.evaluated(p.year_month(F.col("start_date"))).alias("_began"),
        t.evaluated(p.year_month(F.col("end_date"))).alias("_ended"),
        p.is_ongoing(F.col("end_date")).alias("_current"),
    )
    began = F.col("_began")
    roles = read.select(
        id_col,
        "pos",
        p.span_years(began, F.col("_ended"), F.col("_current"), as_of).alias("_years"),
        "_current",
        # A missing month counts as before January; the first of equal starts wins.
        F.when(began.isNotNull(), F.struct(began["year"], F.coalesce(began["month"], F.lit(0)), -F.col("pos"))).alias(
            "_start"
        ),
    )
    running = F.col("_current") & F.col("_years").isNotNull()
    latest = F.max(F.when(F.col("_start").isNotNull(), F.struct("_start", "_years")))
    summary = roles.groupBy(id_col).agg(
        F.count(F.lit(1)).alias("roles"),
        F.round(F.sum("_years"), 2).alias("total_years_experience"),
        F.max_by("_years", F.when(running, F.col("pos"))).alias("_tenure"),
        latest.alias("_latest"),
    )
    return summary.select(
        id_col,
        "roles",
        "total_years_experience",
        F.round(F.coalesce("_tenure", F.col("_latest._years")), 2).alias("current_tenure_years"),
    )


def employed_company(experience: DataFrame, id_col: str = "person_id", flat: DataFrame | None = None) -> DataFrame:
    """Company of the first current role, else of the last role, else the flat field.

    The first current role decides even when its company is NULL.
    """
    current = p.is_ongoing(F.col("end_date"))
    found = experience.groupBy(id_col).agg(
        F.min(F.when(current, F.struct("pos", "company"))).alias("_current"),
        F.max(F.struct("pos", "company")).alias("_last"),
    ).select(
        id_col,
        F.when(F.col("_current").isNotNull(), F.col("_current.company"))
        .otherwise(F.col("_last.company"))
        .alias("employed_company"),
    )
    if flat is None:
        return found
    return flat.select(id_col, F.col("employed_company").alias("_flat")).join(
        found.withColumn("_found", F.lit(True)), id_col, "left"
    ).select(
        id_col, F.when(F.col("_found"), F.col("employed_company")).otherwise(F.col("_flat")).alias("employed_company")
    )


def certifications(records: DataFrame, id_col: str = "person_id", raw: str = "raw") -> DataFrame:
    """One row per named certification of a VARIANT list."""
    entries = F.try_variant_get(F.col(raw), "$", "array<variant>")
    keys = cat.CERTIFICATION_KEYS
    return (
        records.select(id_col, F.posexplode(entries).alias("pos", "_c"))
        .select(id_col, "pos", *[p.first_present(F.col("_c"), ks).alias(name) for name, ks in keys.items()])
        .where(F.col("name").isNotNull())
        .withColumn("name", t.strip(F.col("name")))
    )
