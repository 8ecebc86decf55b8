"""B6, B7 for many client profiles in one run.

One profile is a set of predicates (`icp`). Many profiles are a table, and a scan per client would read all companies
as often as there are clients. Here the clauses are turned round into rows (client, clause, value); companies become
rows (clause, value) too, and they meet in an equi-join. To meet on every clause would list each company of a large
industry with each client that names it, so a client is met on one clause only: the one whose values the fewest
companies hold, counted on the companies themselves. What is met there is verified on all clauses of the profile.

Keys of both sides are salted, so a value that a third of all companies hold is spread over `SALTS` tasks.

Clauses of text: similarity is met on any shared word, a keyword on its rarest part of up to three characters, as it
may lie anywhere in the description. A profile without any clause that can be met (none set, or an empty keyword only)
takes every company; it makes no pairs here, :func:`unbounded_profiles` lists it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as t
from .icp import SIMILARITY

SALTS = 16
GRAM = 3


def _words(text: Column) -> Column:
    return F.array_distinct(t.tokens(F.regexp_replace(F.lower(text), r"(?U)[^\w]+", " ")))


def _phrase_words(text: Column) -> Column:
    """Words of a phrase; unlike a text's, an underscore parts them."""
    return F.array_distinct(t.tokens(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " ")))


def _grams(text: Column) -> Column:
    """Distinct parts of one to `GRAM` characters."""
    low = F.lower(text)

    def of(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.length(low) - n + 1, F.lit(1)))
        return F.when(F.length(low) >= n, F.transform(starts, lambda i: F.substring(low, i, F.lit(n)))).otherwise(F.array().cast("array<string>"))

    return F.array_distinct(F.concat(*[of(n) for n in range(1, GRAM + 1)]))


def _of(value: Column, kind: str) -> Column:
    """(kind, value) entries of an array of texts."""
    return F.transform(F.coalesce(value, F.array().cast("array<string>")), lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("value")))


def _company_keys(get, title: Column | None) -> Column:
    heads = F.filter(get("locations"), lambda x: x["is_headquarters"])
    tech = F.flatten(F.transform(get("technographics"), lambda x: F.array(x["vendor"], x["product"])))
    keys = [
        _of(F.array(get("industry")), "industry"),
        _of(F.array(get("company_size")), "size"),
        _of(F.array_distinct(F.transform(heads, lambda x: x["country_name"])), "country"),
        _of(F.array_distinct(F.transform(heads, lambda x: x["city"])), "city"),
        _of(F.array_distinct(tech), "technology"),
        _of(_words(get("products_and_services")), "product word"),
        _of(_grams(get("description")), "description part"),
    ]
    if title is not None:
        keys.append(_of(_words(title), "title word"))
    return F.filter(F.concat(*keys), lambda x: x["value"].isNotNull())


def _profile_keys(titles: bool, threshold: float) -> Column:
    """(clause, entry, kind, value) of a profile: a company that meets the clause holds a value of some entry.

    Values of one entry are alternatives of which every match holds one; `entry` tells keywords apart, each of which
    may be met on any one of its parts.
    """

    def entries(clause: str, column: str, kind: str) -> Column:
        return F.transform(
            F.col(column), lambda v, i: F.struct(F.lit(clause).alias("clause"), F.lit(0).alias("entry"), F.lit(kind).alias("kind"), v.alias("value"))
        )

    def phrase_words(clause: str, column: str, kind: str) -> Column:
        words = F.flatten(F.transform(F.col(column), _phrase_words))
        return F.transform(words, lambda v: F.struct(F.lit(clause).alias("clause"), F.lit(0).alias("entry"), F.lit(kind).alias("kind"), v.alias("value")))

    keywords = F.flatten(
        F.transform(
            "description_keywords",
            lambda k, i: F.transform(
                F.filter(_grams(k), lambda g: F.length(g) == F.least(F.length(k), F.lit(GRAM))),
                lambda g: F.struct(F.lit("keywords").alias("clause"), i.alias("entry"), F.lit("description part").alias("kind"), g.alias("value")),
            ),
        )
    )
    nothing = F.array().cast("array<struct<clause:string,entry:int,kind:string,value:string>>")
    keys = [
        entries("industry", "industries", "industry"),
        entries("size", "company_size_buckets", "size"),
        entries("country", "hq_countries", "country"),
        entries("city", "hq_cities", "city"),
        entries("technology", "technologies", "technology"),
        F.when(F.exists("description_keywords", lambda k: k == ""), nothing).otherwise(keywords),
    ]
    if threshold > 0:
        keys.append(phrase_words("products", "products_and_services", "product word"))
        if titles:
            keys.append(phrase_words("titles", "people_job_title_include", "title word"))
    return F.concat(*keys)


def _set_clauses(titles: bool, threshold: float) -> Column:
    """Clauses of a profile that can be met; one without any value is met by nobody."""
    columns = {"industry": "industries", "size": "company_size_buckets", "country": "hq_countries", "city": "hq_cities", "technology": "technologies"}
    found = [F.when(F.size(c) > 0, F.lit(k)) for k, c in columns.items()]
    found.append(F.when((F.size("description_keywords") > 0) & ~F.exists("description_keywords", lambda k: k == ""), F.lit("keywords")))
    if threshold > 0:
        found.append(F.when(F.size("products_and_services") > 0, F.lit("products")))
        if titles:
            found.append(F.when(F.size("people_job_title_include") > 0, F.lit("titles")))
    return F.array_compact(F.array(*found))


def _similar(text: Column, phrases: Column, threshold: float) -> Column:
    def near(phrase: Column) -> Column:
        wanted = _phrase_words(phrase)
        return (F.size(wanted) > 0) & (F.size(F.array_intersect(_words(text), wanted)) >= threshold * F.size(wanted))

    return F.coalesce(F.exists(phrases, near) & text.isNotNull(), F.lit(False))


def _unset_or(column: str, met: Column) -> Column:
    return (F.size(column) == 0) | F.coalesce(met, F.lit(False))


def _fits(get, title: Column | None, threshold: float) -> Column:
    """All clauses of the profile that stands on the same row."""
    tech = F.exists(get("technographics"), lambda x: F.array_contains("technologies", x["vendor"]) | F.array_contains("technologies", x["product"]))
    head = F.exists(
        get("locations"),
        lambda x: x["is_headquarters"]
        & ((F.size("hq_countries") == 0) | F.array_contains("hq_countries", x["country_name"]))
        & ((F.size("hq_cities") == 0) | F.array_contains("hq_cities", x["city"])),
    )
    keyword = F.exists("description_keywords", lambda k: F.contains(F.lower(get("description")), F.lower(k)))
    fits = (
        _unset_or("industries", F.array_contains("industries", get("industry")))
        & _unset_or("company_size_buckets", F.array_contains("company_size_buckets", get("company_size")))
        & (((F.size("hq_countries") == 0) & (F.size("hq_cities") == 0)) | F.coalesce(head, F.lit(False)))
        & _unset_or("technologies", tech)
        & _unset_or("products_and_services", _similar(get("products_and_services"), F.col("products_and_services"), threshold))
        & _unset_or("description_keywords", keyword)
    )
    if title is not None:
        fits = fits & _similar(title, F.col("people_job_title_include"), threshold)
        fits = fits & ~_similar(title, F.col("people_job_title_exclude"), threshold)
    return fits


def _pairs(keys: DataFrame, profiles: DataFrame, ids: Sequence[str], titles: bool, threshold: float) -> DataFrame:
    """Distinct (client_id, ids) that meet on each profile's rarest clause. `keys` has ids, kind and value."""
    held = keys.groupBy("kind", "value").agg(F.count(F.lit(1)).alias("_held"))
    wanted = profiles.select("client_id", F.explode(_profile_keys(titles, threshold)).alias("k")).select("client_id", "k.*").distinct()
    counted = wanted.join(held, ["kind", "value"], "left").withColumn("_held", F.coalesce("_held", F.lit(0)))
    # A keyword is met on its rarest part, any other entry on each of its values.
    part = F.struct("_held", "kind", "value")
    rarest = counted.where("clause = 'keywords'").groupBy("client_id", "clause", "entry").agg(F.min(part).alias("_p"))
    rarest = rarest.select("client_id", "clause", "entry", "_p.kind", "_p.value", "_p._held")
    counted = counted.where("clause <> 'keywords'").unionByName(rarest)
    cost = counted.groupBy("client_id", "clause").agg(F.sum("_held").alias("_cost"))
    clauses = profiles.select("client_id", F.explode(_set_clauses(titles, threshold)).alias("clause"))
    # A clause whose values nobody can hold costs nothing and is chosen; its client gets nobody.
    best = (
        clauses.join(cost, ["client_id", "clause"], "left")
        .groupBy("client_id")
        .agg(F.min(F.struct(F.coalesce("_cost", F.lit(0)).alias("cost"), "clause"))["clause"].alias("clause"))
    )
    met = counted.join(best, ["client_id", "clause"]).select("client_id", "kind", "value").distinct()
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    salted = keys.withColumn("_salt", F.pmod(F.xxhash64(*ids), F.lit(SALTS)).cast("int"))
    return salted.join(met.withColumn("_salt", salts), ["kind", "value", "_salt"]).select("client_id", *ids).distinct()


def match_companies(companies: DataFrame, profiles: DataFrame, id_col: str = "company_id", threshold: float = SIMILARITY) -> DataFrame:
    """B6 for all profiles: (client_id, company_id) of each company that meets every clause of a client.

    `profiles` has the columns of `parse_icp`, one row a client. `companies` has those of the single filter. The id
    tells companies apart; rows that share one are judged together, and one that fits is enough. A row without an id
    or a client without one makes no pair.
    """
    rows = companies.where(F.col(id_col).isNotNull())
    keys = rows.select(id_col, F.explode(_company_keys(F.col, None)).alias("k")).select(id_col, "k.*").distinct()
    pairs = _pairs(keys, profiles, [id_col], False, threshold)
    needed = ["industry", "company_size", "locations", "technographics", "products_and_services", "description"]
    company = rows.select(id_col, F.struct(*needed, "domain").alias("_c"))
    both = pairs.join(company, id_col).join(profiles.drop("name"), "client_id")
    domain = F.col("_c.domain")
    free = domain.isNull() | ~F.array_contains("exclude_domains", domain)
    return both.where(_fits(lambda c: F.col(f"_c.{c}"), None, threshold) & free).select("client_id", id_col).distinct()


def match_people(people: DataFrame, profiles: DataFrame, id_col: str = "person_id", threshold: float = SIMILARITY) -> DataFrame:
    """B7 for all profiles: (client_id, person_id) of people with one current role that meets title and employer clauses."""
    profiles = profiles.where(F.size("people_job_title_include") > 0)
    roles = people.where(F.col(id_col).isNotNull()).select(id_col, F.posexplode("experiences").alias("_role", "_e")).where("_e.is_current")
    get, title = (lambda c: F.col(f"_e.company.{c}")), F.col("_e.job_title")
    ids = [id_col, "_role"]
    keys = roles.select(*ids, F.explode(_company_keys(get, title)).alias("k")).select(*ids, "k.*").distinct()
    both = _pairs(keys, profiles, ids, True, threshold).join(roles, ids).join(profiles.drop("name"), "client_id")
    return both.where(_fits(get, title, threshold)).select("client_id", id_col).distinct()


def unbounded_profiles(profiles: DataFrame, threshold: float = SIMILARITY) -> DataFrame:
    """Clients whose profile sets no clause that companies can be met on; `icp_filter_companies` runs them one by one."""
    return profiles.where(F.size(_set_clauses(False, threshold)) == 0).select("client_id")
