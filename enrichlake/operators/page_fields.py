"""The fields read from a usable page.

Each field is a :class:`FieldJob`: a name, the earlier fields it reads, and a
builder that returns column expressions. The whole set runs as a few stacked
projections over the page row, so extraction is one map-only stage however many
fields there are. User code extends a run by passing further jobs.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark import SparkContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..functions import catalogs as cat
from ..functions import text as t
from ..functions.urls import root_domain
from . import careers
from .page_structure import dictionary_codes, footer, section, with_category

# Optional per-page inputs; a column that is absent counts as NULL.
CONTEXT_COLUMNS = {
    "source_url": "string", "company_name": "string", "company_description": "string",
    "parent_guess": "string", "raw_date": "string", "current_year": "int",
    "detected_tools": "array<string>",
}


@dataclass(frozen=True)
class FieldResult:
    """What a job yields: the value, where it came from, and further flat columns.

    `error` is the message of a page the job fails on, NULL for others. Such a page keeps an empty field.
    """

    value: Column | None
    source: Column | None = None
    extra: dict[str, Column] = field(default_factory=dict)
    error: Column | None = None


@dataclass(frozen=True)
class FieldJob:
    name: str
    build: Callable[[], FieldResult]
    depends_on: tuple[str, ...] = ()
    # Jobs that only cross-check others carry no value of their own.
    reported: bool = True
    # An error that the expressions raise stays with its page; see `_caught`.
    isolated: bool = False

    def result(self) -> FieldResult:
        """The job's expressions. They name columns and belong to no DataFrame, so a
        stream builds them once and not per micro-batch."""
        return _built(self.build, id(SparkContext._gateway))


@lru_cache(maxsize=256)
def _built(build: Callable[[], FieldResult], gateway: int) -> FieldResult:
    return build()


def python_job(
    name: str, function: Callable, kind: str, reads: Sequence[str] = ("markdown",), depends_on: Sequence[str] = ()
) -> FieldJob:
    """A field that a Python function reads from the columns `reads`, in Arrow batches.

    The function gets one page's values and returns a value of type `kind`. What it raises is that page's error and
    touches no other page. It is not called for unusable pages.
    """

    def build() -> FieldResult:
        @F.arrow_udf(f"value {kind}, error string")
        def run(usable: pa.Array, *columns: pa.Array) -> pa.Array:
            values, errors = [], []
            for is_usable, *page in zip(usable.to_pylist(), *(c.to_pylist() for c in columns), strict=True):
                value = error = None
                if is_usable:
                    try:
                        value = function(*page)
                    except Exception as e:  # noqa: BLE001 - whatever it is, it belongs to this page only
                        error = f"{type(e).__name__}: {e}"
                values.append(value)
                errors.append(error)
            fields = [pa.array(values, to_arrow_type(value_type)), pa.array(errors, pa.string())]
            return pa.StructArray.from_arrays(fields, ["value", "error"])

        value_type = T.StructType.fromDDL(f"value {kind}")["value"].dataType
        held = f"_python_{name}"
        given = [_md() if c == "markdown" else F.col(c) for c in reads]
        return FieldResult(
            F.col(f"{held}.value"), extra={held: run(_md().isNotNull(), *given)}, error=F.col(f"{held}.error")
        )

    return FieldJob(name, build, tuple(depends_on))


#: Timestamps keep their microseconds on the way through JSON.
_AS_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "ignoreNullFields": "false"}


def _caught(out: DataFrame, job: FieldJob, result: FieldResult, usable: Column) -> FieldResult:
    """The same result, but NULL with an error where evaluating it raises.

    `try_to_binary` gives NULL for any error below it, so the job's columns pass through it as one JSON text. The
    built-in jobs raise nothing and do not pay for this.
    """
    columns = {"value": result.value, "source": result.source, **{k: c for k, c in result.extra.items() if not k.startswith("_")}}
    packed = F.struct(*[c.alias(k) for k, c in columns.items() if c is not None])
    kind = out.select(packed.alias("v")).schema["v"].dataType
    held = f"_caught_{job.name}"
    text = F.when(usable, F.to_json(packed, _AS_JSON))
    back = F.from_json(F.col(held).cast("string"), kind, _AS_JSON)
    failed = F.when(usable & F.col(held).isNull(), F.lit(f"{job.name}: evaluation raised an error"))
    own = {k: back[k] for k in kind.fieldNames() if k not in ("value", "source")}
    return FieldResult(
        back["value"] if result.value is not None else None,
        back["source"] if result.source is not None else None,
        {held: F.try_to_binary(text, F.lit("utf-8")), **own},
        F.coalesce(failed, result.error) if result.error is not None else failed,
    )


def _md() -> Column:
    """Text of a usable page, NULL for others."""
    return F.col("_md")


def _low() -> Column:
    """The same in lower case."""
    return F.col("_low")


def _if_found(value: Column, label: str) -> Column:
    return F.when(value, F.lit(label))


def _non_empty(arr: Column) -> Column:
    return F.size(arr) > 0


# --- E1-E6 --------------------------------------------------------------------
def domain_normalize() -> FieldResult:
    return FieldResult(
        root_domain(F.col("source_url")), _if_found(F.col("domain_normalize").isNotNull(), "context")
    )


def social_links_extract() -> FieldResult:
    linked = t.extract_all(_md(), t.rx(cat.SOCIAL_MARKDOWN_LINK), 2)
    bare = t.extract_all(_md(), t.rx(cat.SOCIAL_BARE_URL))
    # A page without "http" has no link at all.
    found = F.when(F.contains(_md(), F.lit("http")), t.let(linked, lambda u: F.when(_non_empty(u), u).otherwise(bare)))
    urls = F.col("_social_urls")

    def first_url(keywords: Sequence[str]) -> Column:
        def names(u: Column) -> Column:
            hit = F.lit(False)
            for k in keywords:
                hit = hit | F.contains(F.lower(u), F.lit(k))
            return hit

        return t.first_or_null(F.filter(urls, names))

    links = F.struct(*[first_url(words).alias(k) for k, words in cat.SOCIAL_PLATFORMS.items()])
    value = t.let(
        links, lambda s: F.when(F.coalesce(*[s[k] for k in cat.SOCIAL_PLATFORMS]).isNotNull(), s)
    )
    return FieldResult(
        value,
        _if_found(F.col("social_links_extract").isNotNull(), "markdown"),
        extra={"_social_urls": found},
    )


def legal_entity_extract() -> FieldResult:
    pattern = t.rx(cat.COPYRIGHT)
    line = F.when(
        F.contains(_md(), F.lit("©")),
        F.coalesce(t.extract(footer(_md()), pattern), t.extract(_md(), pattern)),
    )
    # The end of the name is only visible in context, hence the closing mark.
    found = F.concat(line, F.lit("\n"))
    name = t.blank_to_null(F.btrim(t.strip(F.regexp_extract(F.col("_legal_line"), pattern, 2)), F.lit(".,")))
    year = F.regexp_extract(F.col("_legal_line"), pattern, 1).try_cast("int")
    value = F.when(name.isNotNull(), F.struct(name.alias("legal_name"), year.alias("copyright_year")))
    return FieldResult(
        value, _if_found(F.col("legal_entity_extract").isNotNull(), "markdown"), extra={"_legal_line": found}
    )


def company_description_extract(max_chars: int | None = None) -> FieldResult:
    override = t.blank_to_null(t.strip(F.col("company_description")))
    words = cat.DESCRIPTION_MIN_WORDS - 1
    prose = F.filter(
        F.transform(t.paragraphs(_md()), lambda p: t.strip(p)),
        # Cleaning never adds words, so shorter paragraphs are out already.
        lambda p: ~F.startswith(p, F.lit("#")) & t.matches(p, t.rx(rf"\A(?:\S++\s++){{{words}}}\S")),
    )

    def cleaned(p: Column) -> Column:
        plain = F.regexp_replace(F.regexp_replace(p, "[*_`]", ""), t.rx(r"^\s*[-*]\s*"), "")
        return t.strip(F.regexp_replace(plain, t.rx(r"\s+"), " "))

    def long_enough(p: Column) -> Column:
        return t.matches(p, rf"\A(?:[^ ]++ ){{{words}}}[^ ]")

    def pick(ps: Column) -> Column:
        # The first paragraph nearly always does; the others are cleaned only if it does not.
        first = t.let(cleaned(t.first_or_null(ps)), lambda c: F.when(long_enough(c), c))
        return F.coalesce(first, t.first_or_null(F.filter(F.transform(ps, cleaned), long_enough)))

    value = F.coalesce(override, t.let(prose, pick))
    if max_chars is not None:
        value = F.substring(value, 1, max_chars)
    source = F.when(override.isNotNull(), "context").when(
        F.col("company_description_extract").isNotNull(), "markdown"
    )
    return FieldResult(value, source)


def site_locale_detect() -> FieldResult:
    names = "|".join(t.literal(n) for n in cat.LANGUAGES)
    hits = F.when(
        t.holds_any(_low(), ("(", *cat.LANGUAGES)),
        t.extract_all(_low(), t.ahead("".join(sorted({n[0] for n in cat.LANGUAGES})) + "(", rf"\b(?:{names})\b|\([a-z]{{2}}\)")),
    ).otherwise(F.array().cast("array<string>"))
    codes = dict(cat.LANGUAGES) | {f"({c})": c for c in cat.LANGUAGES.values()}
    lookup = t.text_map(codes.items())
    value = F.array_distinct(
        F.filter(F.transform(hits, lambda h: F.try_element_at(lookup, h)), lambda c: c.isNotNull())
    )
    return FieldResult(value, _if_found(_non_empty(F.col("site_locale_detect")), "markdown"))


def pricing_locale_extract(max_prices: int | None = None, max_chars: int | None = None) -> FieldResult:
    """All prices of the pricing section, unless `max_prices` or `max_chars` bounds them."""
    has_price = t.holds_any(_md(), cat.PRICE_TEXTS) & t.matches(_md(), t.rx(cat.PRICE))
    part = F.col("_pricing_text")
    prices = t.extract_all(part, t.rx(cat.PRICE))
    symbols = t.text_map(cat.CURRENCY_SYMBOLS.items())
    first = t.first_or_null(prices)
    currency = F.coalesce(F.try_element_at(symbols, F.substring(first, 1, 1)), F.substring(first, 1, 3))
    hint = None
    for label, wording in cat.BILLING_HINTS.items():
        test = t.says(F.col("_pricing_low"), wording)
        hint = F.when(test, label) if hint is None else hint.when(test, label)
    value = F.when(
        _non_empty(prices),
        F.struct(
            currency.alias("currency_code"),
            (prices if max_prices is None else F.slice(prices, 1, max_prices)).alias("price_points"),
            hint.alias("billing_model_hint"),
        ),
    )
    pricing_section = section(_md(), cat.PRICING_TITLES, max_chars)
    text = F.when(has_price, F.coalesce(t.blank_to_null(pricing_section), _md()))
    return FieldResult(
        value,
        _if_found(F.col("pricing_locale_extract").isNotNull(), "markdown"),
        extra={"_pricing_text": text, "_pricing_low": F.lower(text)},
    )


# --- E7-E9 --------------------------------------------------------------------
def careers_page_parse() -> FieldResult:
    value = careers.roles(_md())
    return FieldResult(value, _if_found(_non_empty(F.col("careers_page_parse")), "markdown"))


def tech_stack_normalize() -> FieldResult:
    mentioned = with_category(dictionary_codes(_low(), cat.TECHNOLOGIES, lowered=True), cat.TECHNOLOGIES)
    detected = detected_stack(F.col("detected_tools"))
    both = F.struct(detected.alias("detected_stack"), mentioned.alias("mentioned_technologies"))
    value = t.let(
        both,
        lambda b: F.when(_non_empty(b["detected_stack"]) | _non_empty(b["mentioned_technologies"]), b),
    )
    source = F.when(_non_empty(F.col("tech_stack_normalize.detected_stack")), "context").when(
        F.col("tech_stack_normalize").isNotNull(), "markdown"
    )
    return FieldResult(value, source)


def detected_stack(tools: Column) -> Column:
    """Tool names to catalog entries; unknown names keep a slug and no category."""
    lookup = t.text_map((code, category) for code, category, _ in cat.TECHNOLOGIES)

    def entry(name: Column) -> Column:
        return t.let(
            t.first_or_null(dictionary_codes(name, cat.TECHNOLOGIES)),
            lambda known: F.struct(
                F.coalesce(known, t.slug(name, "_")).alias("tool_id"),
                F.when(known.isNotNull(), F.try_element_at(lookup, known)).alias("category"),
            ),
        )

    entries = F.transform(F.coalesce(tools, F.array().cast("array<string>")), entry)
    return t.keep_first_by(F.filter(entries, lambda e: e["tool_id"] != ""), lambda e: e["tool_id"])


def _scored(text: Column, wordings: dict[str, t.Wording]) -> Column:
    """Labels ranked by hits; the runner-up counts when at most one hit behind."""
    ranked = F.array_sort(
        F.filter(
            F.array(
                *[
                    F.struct(
                        (-t.count_says(text, wording)).alias("minus_hits"),
                        F.lit(i).alias("ord"),
                        F.lit(label).alias("label"),
                    )
                    for i, (label, wording) in enumerate(wordings.items())
                ]
            ),
            lambda s: s["minus_hits"] < 0,
        )
    )

    def pick(r: Column) -> Column:
        top, second = F.get(r, F.lit(0)), F.get(r, F.lit(1))
        return F.struct(
            top["label"].alias("primary"),
            F.when(second["minus_hits"] - top["minus_hits"] <= 1, second["label"]).alias("secondary"),
        )

    return t.let(ranked, pick)


def business_model() -> FieldResult:
    text = _low()
    hint = F.col("pricing_locale_extract.billing_model_hint")
    nothing = F.lit(None).cast("string")
    pricing = F.when(
        hint.isNotNull(), F.struct(hint.alias("primary"), nothing.alias("secondary"))
    ).otherwise(_scored(text, cat.PRICING_WORDING))
    self_serve = t.says(text, cat.SELF_SERVE_WORDING)
    sales_led = t.says(text, cat.SALES_LED_WORDING)
    delivery = (
        F.when(self_serve & sales_led, "HYBRID").when(self_serve, "SELF_SERVE").when(sales_led, "SALES_LED")
    )
    value = F.struct(
        pricing.alias("pricing"),
        _scored(text, cat.OFFERING_WORDING).alias("offering"),
        F.struct(delivery.alias("primary"), nothing.alias("secondary")).alias("delivery"),
    )
    any_primary = F.coalesce(*[F.col(f"business_model.{k}.primary") for k in ("pricing", "offering", "delivery")])
    source = F.when(hint.isNotNull(), "context").when(any_primary.isNotNull(), "markdown")
    return FieldResult(value, source)


# --- E10-E14 ------------------------------------------------------------------
def company_entity_resolve() -> FieldResult:
    domain = F.col("domain_normalize")
    name = F.coalesce(t.blank_to_null(F.col("company_name")), F.col("legal_entity_extract.legal_name"))
    given = t.blank_to_null(F.col("parent_guess"))
    # "of " opens the name in every wording; the plain test spares most pages the three scans.
    names = [
        t.blank_to_null(
            F.regexp_replace(t.strip(F.regexp_extract(_md(), t.rx(wording + r"([A-Z][\w&, \-]*)"), 1)), ",+$", "")
        )
        for wording in cat.PARENT_WORDING
    ]
    read = F.when(F.contains(_md(), F.lit("subsidiary of ")) | F.contains(_md(), F.lit("part of ")), F.coalesce(*names))
    parent = F.coalesce(given, F.col("_parent_read"))
    source = F.when(given.isNotNull(), "context").when(F.col("_parent_read").isNotNull(), "markdown")
    value = F.when(
        F.coalesce(domain, name).isNotNull(),
        F.struct(
            t.slug(F.coalesce(parent, domain, name), "-").alias("company_id"),
            domain.alias("domain"),
            name.alias("company_name"),
            parent.alias("parent_guess"),
            source.alias("source"),
        ),
    )
    return FieldResult(value, F.col("company_entity_resolve.source"), extra={"_parent_read": read})


def iso_date(raw: Column) -> Column:
    """ISO date string of one date text in a listed format; NULL for anything else.

    Listed: `2019-03-31` (also with a time behind it), `3/31/2019` (month first
    unless it exceeds 12) and `March 31, 2019` (also without the comma).
    """
    part = lambda pattern, group: F.regexp_extract(raw, t.rx(pattern), group)
    iso = part(r"\b(\d{4}-\d{2}-\d{2})(?!\d)", 1)
    a, b, year = (part(r"\b(\d{1,2})/(\d{1,2})/(\d{4})\b", g) for g in (1, 2, 3))
    first_is_day = a.try_cast("int") > 12
    month, day = F.when(first_is_day, b).otherwise(a), F.when(first_is_day, a).otherwise(b)
    slash = F.when(year != "", F.concat_ws("-", year, F.lpad(month, 2, "0"), F.lpad(day, 2, "0")))
    names = "|".join(cat.MONTHS)
    named = rf"\b({names})\s+(\d{{1,2}})(?:,\s*|\s+)(\d{{4}})\b"
    month_no = F.array_position(t.text_array(cat.MONTHS), part(named, 1))
    worded = F.when(
        part(named, 3) != "",
        F.concat_ws("-", part(named, 3), F.lpad(month_no.cast("string"), 2, "0"), F.lpad(part(named, 2), 2, "0")),
    )
    # Impossible months and days are sorted out before the parser, which is slow to refuse them.
    plausible = r"\A\d{4}-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12]\d|3[01])\z"
    return t.let(
        F.coalesce(t.blank_to_null(iso), slash, worded),
        lambda d: F.when(
            t.matches(d, plausible), F.date_format(F.try_to_date(d, "yyyy-MM-dd"), "yyyy-MM-dd")
        ),
    )


def date_normalize() -> FieldResult:
    given = iso_date(F.col("raw_date"))
    # Cheap test first: every listed shape holds a four-digit run.
    scanned = F.when(
        t.matches(_md(), "[0-9]{4}"),
        F.concat(
            t.extract_all(_md(), t.ahead("0-9", cat.ISO_DATE)),
            t.extract_all(_md(), t.ahead("0-9", cat.SLASH_DATE)),
            t.extract_all(_md(), t.ahead("".join(sorted({m[0] for m in cat.MONTHS})), cat.MONTH_NAME_DATE)),
        ),
    ).otherwise(F.array().cast("array<string>"))
    dates = F.array_distinct(
        F.array_compact(F.concat(F.array(given), F.transform(scanned, iso_date)))
    )
    value = t.let(dates, lambda d: F.when(_non_empty(d), d))
    origin = F.when(
        F.col("date_normalize").isNotNull(),
        F.when(given.isNotNull(), "context_override").otherwise("markdown_scan"),
    )
    return FieldResult(
        value, _if_found(F.col("date_normalize").isNotNull(), "markdown"), extra={"date_normalize_source": origin}
    )


def compliance_framework_extract() -> FieldResult:
    value = dictionary_codes(_low(), cat.COMPLIANCE, lowered=True)
    return FieldResult(value, _if_found(_non_empty(F.col("compliance_framework_extract")), "markdown"))


def experience_signal_extract() -> FieldResult:
    def first_int(patterns: Sequence[str]) -> Column:
        return F.coalesce(*[F.regexp_extract(_md(), t.rx(p), 1).try_cast("int") for p in patterns])

    explicit = first_int([w + r"(\d{4})" for w in cat.FOUNDED_WORDING])
    duration = F.when(F.contains(_md(), F.lit("year")), first_int(cat.DURATION_WORDING))
    this_year = F.coalesce(F.col("current_year"), F.year(F.current_date()))
    stated, lasting = F.col("_founded"), F.col("_duration")
    value = F.when(
        F.coalesce(stated, lasting).isNotNull(),
        F.struct(
            F.coalesce(stated, this_year - lasting).alias("founding_year"),
            F.when(stated.isNotNull(), "explicit").otherwise("derived").alias("founding_year_source"),
            lasting.alias("years_in_business_claim"),
        ),
    )
    return FieldResult(
        value,
        _if_found(F.col("experience_signal_extract").isNotNull(), "markdown"),
        extra={"_founded": explicit, "_duration": duration},
    )


def service_region_extract() -> FieldResult:
    abbreviations = sorted(cat.US_STATES.values())
    states = t.text_array(abbreviations)
    city_state = F.filter(
        t.extract_all(_md(), t.ahead("A-Z", cat.CITY_STATE)), lambda p: F.array_contains(states, F.right(p, F.lit(2)))
    )
    names = "|".join(t.literal(n).replace(r"\s+", " ") for n in cat.US_STATES)
    initials = "".join(sorted({n[0] for n in cat.US_STATES}))
    # Two capitals that stand alone, kept when they are a state.
    pairs = t.extract_all(_md(), r"[A-Z]{2}(?<![A-Za-z]..)(?![A-Za-z])")
    nothing = F.array().cast("array<string>")
    places = F.concat(
        t.extract_all(_md(), t.ahead("i", cat.IN_CITY_COUNTRY), 1),
        city_state,
        F.when(F.contains(_md(), F.lit("Remote")), t.extract_all(_md(), t.rx(cat.REMOTE_REGION))).otherwise(nothing),
        t.extract_all(_md(), t.ahead(initials, rf"\b(?:{names})\b")),
        F.filter(pairs, lambda p: F.array_contains(states, p)),
    )
    value = F.array_distinct(F.filter(F.transform(places, lambda p: t.strip(p)), lambda p: p != ""))
    return FieldResult(value, _if_found(_non_empty(F.col("service_region_extract")), "markdown"))


# --- E15 ----------------------------------------------------------------------
def company_name_key(name: Column) -> Column:
    """Name without legal suffixes and anything but letters and digits; NULL when nothing is left."""
    bare = F.regexp_replace(name, t.rx(cat.LEGAL_SUFFIX, ignore_case=True), "")
    return t.blank_to_null(F.regexp_replace(F.lower(bare), "[^a-z0-9]+", ""))


def _quoted(c: Column) -> Column:
    """Text in quotes the way Python shows it."""
    double = F.contains(c, F.lit("'")) & ~F.contains(c, F.lit('"'))
    return F.when(double, F.concat(F.lit('"'), c, F.lit('"'))).otherwise(
        F.concat(F.lit("'"), F.replace(c, F.lit("'"), F.lit("\\'")), F.lit("'"))
    )


def conflict_check() -> FieldResult:
    languages = F.col("site_locale_detect")
    currency = F.col("pricing_locale_extract.currency_code")
    expected = F.create_map(
        *[x for c, ls in cat.CURRENCY_LANGUAGES.items() for x in (F.lit(c), F.array(*[F.lit(v) for v in ls]))]
    )
    fitting = F.try_element_at(expected, currency)
    locale_conflict = F.coalesce(
        _non_empty(languages) & fitting.isNotNull() & ~F.arrays_overlap(languages, fitting), F.lit(False)
    )
    locale_detail = F.concat(
        F.lit("pricing page priced in "), currency, F.lit(" but detected site language(s) ['"),
        F.array_join(languages, "', '"), F.lit("']"),
    )
    legal = F.col("legal_entity_extract.legal_name")
    given = t.blank_to_null(F.col("company_name"))
    name_conflict = F.coalesce(company_name_key(legal) != company_name_key(given), F.lit(False))
    name_detail = F.concat(
        F.lit("legal_entity_extract="), _quoted(legal), F.lit("; context_override="), _quoted(given)
    )
    return FieldResult(
        None,
        extra={
            "locale_conflict": locale_conflict,
            "locale_conflict_detail": F.when(locale_conflict, locale_detail),
            "company_name_conflict": name_conflict,
            "company_name_conflict_detail": F.when(name_conflict, name_detail),
        },
    )


PAGE_JOBS: tuple[FieldJob, ...] = (
    FieldJob("domain_normalize", domain_normalize),
    FieldJob("social_links_extract", social_links_extract),
    FieldJob("legal_entity_extract", legal_entity_extract),
    FieldJob("company_description_extract", company_description_extract),
    FieldJob("site_locale_detect", site_locale_detect),
    FieldJob("pricing_locale_extract", pricing_locale_extract),
    FieldJob("careers_page_parse", careers_page_parse),
    FieldJob("tech_stack_normalize", tech_stack_normalize),
    FieldJob("business_model", business_model, depends_on=("pricing_locale_extract",)),
    FieldJob(
        "company_entity_resolve", company_entity_resolve, depends_on=("domain_normalize", "legal_entity_extract")
    ),
    FieldJob("date_normalize", date_normalize),
    FieldJob("compliance_framework_extract", compliance_framework_extract),
    FieldJob("experience_signal_extract", experience_signal_extract),
    FieldJob("service_region_extract", service_region_extract),
    FieldJob(
        "conflict_check",
        conflict_check,
        depends_on=("site_locale_detect", "pricing_locale_extract", "legal_entity_extract"),
        reported=False,
    ),
)


def with_context(pages: DataFrame) -> DataFrame:
    """Add the optional input columns that are absent, as NULL."""
    absent = {c: F.lit(None).cast(dt) for c, dt in CONTEXT_COLUMNS.items() if c not in pages.columns}
    return pages.withColumns(absent) if absent else pages


def _stages(jobs: Sequence[FieldJob]) -> list[list[FieldJob]]:
    """Group jobs so that each one comes after the jobs it reads."""
    names = {j.name for j in jobs}
    done: set[str] = set()
    waiting, stages = list(jobs), []
    while waiting:
        ready = [j for j in waiting if all(d in done or d not in names for d in j.depends_on)]
        if not ready:
            raise ValueError(f"field jobs depend on each other in a circle: {[j.name for j in waiting]}")
        stages.append(ready)
        done.update(j.name for j in ready)
        waiting = [j for j in waiting if j not in ready]
    return stages


def extract_fields(
    pages: DataFrame, jobs: Sequence[FieldJob] = PAGE_JOBS, usable: Column | None = None
) -> DataFrame:
    """Add one column per job, its `<name>_src` label and extra columns.

    Where `usable` is false nothing is evaluated and every field is NULL. A job that can fail also gets `<name>_error`;
    where that is set, its columns are NULL, and jobs that read them go on with NULL.
    """
    usable = F.lit(True) if usable is None else usable
    out = with_context(pages).withColumn("_md", F.when(usable, F.coalesce(F.col("markdown"), F.lit(""))))
    out = out.withColumn("_low", F.lower("_md"))
    given = [c for c in out.columns if c not in ("_md", "_low")]
    for stage in _stages(jobs):
        results = [(job, job.result()) for job in stage]
        # Values, then what is derived from them; private helper columns come first.
        helpers = {k: c for _, r in results for k, c in r.extra.items() if k.startswith("_")}
        if helpers:
            out = out.withColumns(helpers)
        if any(j.isolated for j in stage):
            results = [(j, _caught(out, j, r, usable) if j.isolated else r) for j, r in results]
            caught = {k: c for j, r in results if j.isolated for k, c in r.extra.items() if k.startswith("_")}
            out, helpers = out.withColumns(caught), helpers | caught
        works = {j.name: usable if r.error is None else usable & r.error.isNull() for j, r in results}
        values = {j.name: F.when(works[j.name], r.value) for j, r in results if r.value is not None}
        if values:
            out = out.withColumns(values)
        derived = {f"{j.name}_src": F.when(works[j.name], r.source) for j, r in results if r.source is not None}
        derived |= {f"{j.name}_error": F.when(usable, r.error) for j, r in results if r.error is not None}
        derived |= {
            k: F.when(works[j.name], c) for j, r in results for k, c in r.extra.items() if not k.startswith("_")
        }
        if derived:
            out = out.withColumns(derived)
        if helpers:
            out = out.drop(*helpers)
    made = [c for c in out.columns if c not in (*given, "_md", "_low")]
    return out.select(*given, *[t.evaluated(F.col(c)).alias(c) for c in made])


def is_empty(c: Column, dtype: T.DataType) -> Column:
    """NULL, empty text or empty list."""
    if isinstance(dtype, T.StringType):
        return t.is_blank(c)
    if isinstance(dtype, (T.ArrayType, T.MapType)):
        return c.isNull() | (F.size(c) == 0)
    return c.isNull()


# --- long tables ----------------------------------------------------------------
def page_dates(page_rows: DataFrame) -> DataFrame:
    """E11 as rows (page_id, pos, iso_date)."""
    return page_rows.select("page_id", F.posexplode("date_normalize").alias("pos", "iso_date"))


def page_places(page_rows: DataFrame) -> DataFrame:
    """E14 as rows (page_id, pos, place)."""
    return page_rows.select("page_id", F.posexplode("service_region_extract").alias("pos", "place"))


def job_postings(page_rows: DataFrame) -> DataFrame:
    """E7 as rows (page_id, pos, title, department, location, posted_date)."""
    return page_rows.select("page_id", F.posexplode("careers_page_parse").alias("pos", "role")).select(
        "page_id", "pos", "role.*"
    )


def entity_members(page_rows: DataFrame) -> DataFrame:
    """Pages per (company_id, domain). Partial aggregation keeps a large entity harmless."""
    entity = F.col("company_entity_resolve")
    return (
        page_rows.where(entity.isNotNull())
        .groupBy(entity["company_id"].alias("company_id"), entity["domain"].alias("domain"))
        .agg(F.count(F.lit(1)).alias("pages"))
    )


def entity_rollup(page_rows: DataFrame) -> DataFrame:
    """Pages and domains under one company_id.

    Counted in two steps, so that no entity's domains are ever gathered in one
    place; :func:`entity_members` lists them as rows.
    """
    return (
        entity_members(page_rows)
        .groupBy("company_id")
        .agg(
            F.sum("pages").alias("pages"),
            F.count("domain").alias("domains"),
            F.min("domain").alias("first_domain"),
        )
    )
