"""Joins of fetched items back to the tables they were fetched for."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as t
from ..functions.profiles import as_text
from ..functions.urls import url_key
from .skew import spread_nulls, top_k

COMPANY_SPINE = ("company_id", "name", "domain", "linkedin_url")
PERSON_SPINE = ("profile_id", "name", "linkedin_url")


def require_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"a spine needs these columns too: {missing}")
    return df


def distinct_request_keys(df: DataFrame, col: str) -> DataFrame:
    """B2: non-empty raw values, once each, ascending."""
    return df.where(~t.is_blank(F.col(col))).select(col).distinct().orderBy(col)


def _attach(
    spine: DataFrame, items: DataFrame, item_key: Column, spine_cols: Sequence[str], raw_col: str, out_col: str, order_col: str
) -> DataFrame:
    require_columns(spine, spine_cols)
    # The last item of a key wins. max_by combines on the map side, so a key
    # fetched very often is no hot spot, and the join below is many-to-one.
    latest = (
        items.select(item_key.alias("_key"), F.col(raw_col).alias("_raw"), F.col(order_col).alias("_pos"))
        .where(~t.is_blank(F.col("_key")))
        .groupBy("_key")
        .agg(F.max_by("_raw", "_pos").alias(out_col))
    )
    key = spread_nulls(t.blank_to_null(url_key(F.col("linkedin_url"))), F.col(spine_cols[0]))
    return spine.select(*spine_cols, key.alias("_key")).join(latest, "_key", "left").drop("_key")


def attach_raw_by_url(
    spine: DataFrame,
    items: DataFrame,
    spine_cols: Sequence[str] = COMPANY_SPINE,
    raw_col: str = "raw",
    out_col: str = "scrape_json",
    order_col: str = "pos",
) -> DataFrame:
    """Spine plus the raw item of the same URL; every spine row survives.

    `items` holds one JSON text per row in `raw_col` and its arrival order in `order_col`.
    """
    url = as_text(F.parse_json(F.col(raw_col)), "$.linkedinUrl")
    return _attach(spine, items, url_key(url), spine_cols, raw_col, out_col, order_col)


def attach_profiles_by_query_url(
    spine: DataFrame,
    items: DataFrame,
    spine_cols: Sequence[str] = PERSON_SPINE,
    raw_col: str = "raw",
    out_col: str = "profile_json",
    order_col: str = "pos",
) -> DataFrame:
    """As B3, but keyed by the URL that was asked for, which a renamed profile keeps."""
    url = as_text(F.parse_json(F.col(raw_col)), "$.originalQuery.url")
    return _attach(spine, items, url_key(url), spine_cols, raw_col, out_col, order_col)


def merge_bronze_branches(
    company_table: DataFrame, branches: Sequence[tuple[DataFrame, str]], id_col: str = "company_id"
) -> DataFrame:
    """Raw columns of independent branches back on the company table, by id only.

    An id that a branch repeats keeps its greatest raw value, so a branch never adds rows.
    """
    out = company_table
    for branch, raw_col in branches:
        once = branch.where(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.max(raw_col).alias(raw_col))
        out = out.join(once, id_col, "left")
    return out


def build_page_inputs(companies: DataFrame, fetches: DataFrame) -> DataFrame:
    """One page per company, whatever its fetch gave.

    Of several `fetches(domain, markdown, source_url)` of a domain one with text is
    taken before one without, then the greatest URL and text. No domain: empty text
    and no URL. Failed fetch: empty text, requested URL.
    """
    key = spread_nulls(t.blank_to_null(F.col("domain")), F.col("company_id"))
    best = F.max(F.struct((~t.is_blank(F.col("markdown"))).alias("some"), "source_url", "markdown"))
    fetched = (
        fetches.where(~t.is_blank(F.col("domain")))
        .groupBy(F.col("domain").alias("_key"))
        .agg(best.alias("_best"))
        .select("_key", F.col("_best.markdown").alias("_markdown"), F.col("_best.source_url").alias("_url"))
    )
    asked = F.when(~t.is_blank(F.col("domain")), F.concat(F.lit("https://"), F.col("domain")))
    return (
        companies.withColumn("_key", key)
        .join(fetched, "_key", "left")
        .select(
            F.col("company_id").alias("page_id"),
            F.coalesce("_markdown", F.lit("")).alias("markdown"),
            F.coalesce("_url", asked).alias("source_url"),
        )
    )


def pages_from_fetch_table(fetches: DataFrame) -> DataFrame:
    """Pages of a fetch table; the requested URL stands in for a missing source URL."""
    return fetches.withColumn(
        "source_url", F.coalesce(t.blank_to_null(F.col("source_url")), F.col("requested_url"))
    )


def posts_in_window(
    posts: DataFrame, months: int, as_of: Column, max_posts: int = 0, id_col: str = "person_id"
) -> DataFrame:
    """Posts since `months` calendar months before `as_of`; newest `max_posts` each when positive."""
    recent = posts.where(F.col("posted_at") >= F.add_months(as_of, -months))
    if max_posts <= 0:
        return recent
    return top_k(recent, [id_col], [F.desc("posted_at"), F.asc("post_id")], max_posts).drop("_rank")
