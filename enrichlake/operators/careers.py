"""Roles listed in a careers section, as column expressions over the page text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import catalogs as cat
from ..functions import text as t

ROLE_TYPE = "array<struct<title:string,department:string,location:string,posted_date:string>>"


def careers_section(markdown: Column) -> Column:
    """The careers section with its heading; NULL when the page has none."""
    return t.extract(
        markdown, t.rx(cat.CAREERS_SECTION, ignore_case=True, multiline=True, dotall=True)
    )


def strict_roles(section: Column) -> Column:
    """Lines of the form `title - department - location - Posted date`."""
    pattern = t.rx(cat.ROLE_LINE)
    bare = F.transform(
        t.lines(section), lambda line: t.strip(F.regexp_replace(line, t.rx(cat.ROLE_BULLET), ""))
    )

    def part(line: Column, group: int) -> Column:
        return t.strip(F.replace(F.regexp_extract(line, pattern, group), F.lit("*"), F.lit("")))

    return F.transform(
        F.filter(bare, lambda line: t.matches(line, pattern)),
        lambda line: F.struct(
            part(line, 1).alias("title"),
            t.blank_to_null(part(line, 2)).alias("department"),
            t.blank_to_null(part(line, 3)).alias("location"),
            F.regexp_extract(line, pattern, 4).alias("posted_date"),
        ),
    )


def loose_roles(section: Column) -> Column:
    """Headings, then bullets, read as far as each goes; a title seen before is dropped."""
    bodies = F.transform(
        F.concat(
            t.extract_all(section, t.rx(cat.LOOSE_HEADING, multiline=True), 1),
            t.extract_all(section, t.rx(cat.LOOSE_BULLET, multiline=True), 1),
        ),
        lambda b: t.strip(F.regexp_replace(b, "[*_`]", "")),
    )
    iso = t.rx(cat.ISO_DATE)
    dated = F.transform(
        bodies,
        lambda b: F.struct(
            t.extract(b, iso).alias("posted_date"),
            F.when(t.matches(b, iso), t.strip(F.get(F.split(b, iso, 2), F.lit(0)))).otherwise(b).alias("rest"),
        ),
    )
    paren = t.rx(cat.TRAILING_PARENTHESIS)
    placed = F.transform(
        dated,
        lambda d: F.struct(
            d["posted_date"].alias("posted_date"),
            F.when(t.matches(d["rest"], paren), t.strip(F.regexp_extract(d["rest"], paren, 1))).alias("place"),
            F.filter(
                F.transform(
                    F.split(t.strip(F.regexp_replace(d["rest"], paren, "")), t.rx(cat.ROLE_SEPARATOR)), lambda p: t.strip(p)
                ),
                lambda p: p != "",
            ).alias("parts"),
        ),
    )
    departments = t.text_array(cat.DEPARTMENTS)

    def role(p: Column) -> Column:
        others = F.slice(p["parts"], 2, F.greatest(F.size(p["parts"]), F.lit(1)))
        named = F.filter(others, lambda x: F.array_contains(departments, F.lower(x)))
        places = F.filter(others, lambda x: ~F.array_contains(departments, F.lower(x)))
        return F.struct(
            t.first_or_null(p["parts"]).alias("title"),
            F.get(named, F.size(named) - 1).alias("department"),
            F.coalesce(p["place"], t.first_or_null(places)).alias("location"),
            p["posted_date"].alias("posted_date"),
        )

    low, high = cat.ROLE_TITLE_CHARS
    plausible = F.filter(
        F.transform(placed, role),
        lambda r: F.length(r["title"]).between(low, high)
        & (F.size(t.tokens(r["title"])) <= cat.ROLE_TITLE_WORDS),
    )
    return t.keep_first_by(plausible, lambda r: F.lower(r["title"]))


def roles(markdown: Column) -> Column:
    """Strict lines when there are any, else the loose reading; empty without a section."""

    def read(section: Column) -> Column:
        return t.let(
            strict_roles(section),
            lambda strict: F.when(F.size(strict) > 0, strict).otherwise(loose_roles(section)),
        )

    found = t.let(careers_section(markdown), lambda s: F.when(s.isNotNull(), read(s)))
    return F.coalesce(found, F.array().cast(ROLE_TYPE))
