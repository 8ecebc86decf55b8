"""Decide which pages are worth extracting from.

Everything here is a column on the page's own row: one scan, no shuffle, no
second copy of the text. Rejected pages stay in the table with their reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import catalogs as cat
from ..functions import text as t


def looks_like_directory(low: Column) -> Column:
    """T3 on lower-cased text: listing language plus at least three rated paragraphs."""
    rated = F.filter(t.paragraphs(low), lambda p: t.matches(p, t.rx(cat.RATING)))
    return F.when(t.says(low, cat.LISTING), F.size(rated) >= cat.RATED_PARAGRAPHS).otherwise(False)


def is_company_profile(markdown: Column, low: Column | None = None) -> Column:
    """T4: FALSE for lottery pages and for listicles without a recurring subject.

    A subject recurs when the sorted list of paragraph openers holds the same
    value two places further on, which needs neither a shuffle nor a count per
    subject.
    """
    low = F.lower(markdown) if low is None else low
    stripped = F.transform(
        t.paragraphs(markdown), lambda p: t.strip(F.regexp_replace(t.strip(p), "^#+", ""))
    )
    openers = F.array_sort(
        F.filter(
            F.transform(stripped, lambda p: F.regexp_extract(p, t.rx(cat.PARAGRAPH_SUBJECT), 1)),
            lambda s: s != "",
        )
    )
    reach = cat.REPEATED_SUBJECTS - 1
    recurring = t.let(
        openers, lambda xs: F.exists(F.transform(xs, lambda s, i: s == F.get(xs, i + reach)), lambda same: same)
    )
    return (
        F.when(t.says(low, cat.LOTTERY), False)
        .when(t.says(low, cat.LISTICLE), F.coalesce(recurring, F.lit(False)))
        .otherwise(True)
    )


def content_integrity(markdown: Column, low: Column | None = None) -> Column:
    """T5: unlaunched or template content, independent of the crawl issue."""
    low = F.lower(markdown) if low is None else low
    return (
        F.when(t.strip(markdown) == "", "unknown")
        .when(t.says(low, cat.UNDER_CONSTRUCTION), "under_construction")
        .when(t.says(low, cat.TEMPLATE_TEXT), "placeholder_or_template")
        .otherwise("genuine")
    )


def _ladder(pages: DataFrame) -> DataFrame:
    """`crawl_issue` and `crawl_status`, with the text (`_md`) and its lower case (`_low`) kept."""
    banner = cat.COOKIE_BANNER[-1]
    low, body_low = F.col("_low"), F.col("_body_low")
    # What follows the first cookie banner is the page; the banner is rare, so the split is, too.
    after = F.regexp_extract(F.col("_md"), t.rx(f"^.*?{banner}(.*)$", ignore_case=True, dotall=True), 2)
    too_short = ~t.has_words(F.col("_body"), cat.EMPTY_PROSE_WORDS)
    issue = (
        F.when(t.strip(F.col("_md")) == "", "empty_response")
        .when(t.says(low, cat.PARKED), "parked_or_for_sale")
        .when(t.says(low, cat.UNDER_CONSTRUCTION), "under_construction")
        .when(t.says(low, cat.BOT_CHALLENGE), "bot_challenge")
        .when(t.says(low, cat.LOGIN_REQUIRED), "login_required")
        .when(F.col("_has_banner") & too_short, "cookie_wall")
        .when(t.says(body_low, cat.LOTTERY), "non_company_page")
        .when(looks_like_directory(body_low), "directory_or_aggregator")
        .when(too_short, "boilerplate_only")
        .otherwise("none")
    )
    status = (
        F.when(F.col("crawl_issue") != "none", "unusable")
        .when(t.has_words(F.col("_body"), cat.THIN_PROSE_WORDS), "ok")
        .otherwise("partial")
    )
    return (
        pages.withColumn("_md", F.coalesce(F.col("markdown"), F.lit("")))
        .withColumn("_low", F.lower("_md"))
        .withColumn("_has_banner", t.says(low, cat.COOKIE_BANNER))
        .withColumn("_body", F.when(F.col("_has_banner"), after).otherwise(F.col("_md")))
        .withColumn("_body_low", F.when(F.col("_has_banner"), F.lower("_body")).otherwise(low))
        .withColumn("crawl_issue", issue)
        .withColumn("crawl_status", status)
        .drop("_has_banner", "_body", "_body_low")
    )


def classify_crawl_issue(pages: DataFrame) -> DataFrame:
    """Add `crawl_issue` and `crawl_status`; the first rule that fits wins."""
    kept = [c for c in pages.columns if c not in ("crawl_issue", "crawl_status")]
    return _ladder(pages).select(*kept, *[t.evaluated(F.col(c)).alias(c) for c in ("crawl_issue", "crawl_status")])


TRIAGE_COLUMNS = ("crawl_issue", "crawl_status", "content_integrity", "triage_reasons")


def triage(pages: DataFrame) -> DataFrame:
    """Crawl issue, relevance and content integrity in one narrow pass.

    Adds `crawl_issue`, `crawl_status`, `content_integrity` and `triage_reasons`
    (empty for usable pages).
    """
    md, low = F.col("_md"), F.col("_low")
    clean = F.col("crawl_issue") == "none"
    usable = F.col("_relevant")
    judged = (
        _ladder(pages)
        .withColumn("_relevant", F.when(clean, is_company_profile(md, low)).otherwise(False))
        .withColumns(
            {
                "triage_reasons": F.when(~clean, F.array("crawl_issue"))
                .when(~usable, F.array(F.lit("not_a_company_profile")))
                .otherwise(F.array().cast("array<string>")),
                "content_integrity": F.when(usable, content_integrity(md, low)).otherwise("unknown"),
                "crawl_status": F.when(usable, F.col("crawl_status")).otherwise("unusable"),
                "crawl_issue": F.when(clean & ~usable, "wrong_page_type").otherwise(F.col("crawl_issue")),
            }
        )
    )
    kept = [c for c in pages.columns if c not in TRIAGE_COLUMNS]
    return judged.select(*kept, *[t.evaluated(F.col(c)).alias(c) for c in TRIAGE_COLUMNS])


def triage_split(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The usable and the rejected pages of an already triaged table."""
    reasons = F.size("triage_reasons")
    return pages.where(reasons == 0), pages.where(reasons > 0)
