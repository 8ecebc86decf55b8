"""SQL (DuckDB dialect) that states what the page jobs must return.

Written from the rules, independently of the Spark expressions: no look-around,
one test per alias, lists filtered by position.
"""

from __future__ import annotations

from enrichlake.functions import catalogs as cat

from .fixtures import with_fixtures

W = r"[\pL\pN_]"


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def has(col: str, wording) -> str:
    pattern = wording if isinstance(wording, str) else wording[-1]
    return f"regexp_matches({col}, {q(pattern)}, 'i')"


def trim(expr: str) -> str:
    return rf"regexp_replace({expr}, '^\s+|\s+$', '', 'g')"


def null_if_blank(expr: str) -> str:
    return f"nullif({expr}, '')"


def distinct_in_order(expr: str) -> str:
    return f"list_filter({expr}, lambda x, i: list_position({expr}, x) = i)"


def alias_pattern(aliases) -> str:
    return r"(?i)\b(?:" + "|".join(a.replace(".", r"\.").replace(" ", r"\s+") for a in aliases) + r")\b"


def catalog_rows(catalog) -> str:
    rows = [
        f"({i}, {q(code)}, {q(category) if category else 'null'}, {q(alias_pattern(aliases))})"
        for i, (code, category, aliases) in enumerate(catalog)
    ]
    return f"(values {', '.join(rows)}) as c(ord, code, category, pattern)"


def codes(col: str, catalog) -> str:
    """List of matching codes in catalog order."""
    tests = ", ".join(
        f"case when regexp_matches({col}, {q(alias_pattern(aliases))}) then {q(code)} end" for code, _, aliases in catalog
    )
    return f"list_filter([{tests}], lambda x: x is not null)"


def case(expr: str, mapping: dict[str, str]) -> str:
    return f"case {expr} " + " ".join(f"when {q(k)} then {q(v)}" for k, v in mapping.items()) + " end"


# --- triage ---------------------------------------------------------------------
PARAGRAPHS = r"string_split_regex({}, '\n\s*\n')"
DIRECTORY = (
    "({listing} and len(list_filter(" + PARAGRAPHS.format("{body}") + ", lambda p: {rating})) >= 3)"
)


def directory(body: str) -> str:
    return DIRECTORY.format(body=body, listing=has(body, cat.LISTING), rating=has("p", cat.RATING))


SUBJECTS = (
    "list_filter(list_transform("
    + PARAGRAPHS.format("md")
    + ", lambda p: regexp_extract("
    + trim("regexp_replace(" + trim("p") + ", '^#+', '')")
    + ", "
    + q(cat.PARAGRAPH_SUBJECT)
    + ", 1)), lambda s: s <> '')"
)
RELEVANT = (
    f"case when {has('md', cat.LOTTERY)} then false when {has('md', cat.LISTICLE)} then "
    f"len(list_filter({SUBJECTS}, lambda s: len(list_filter({SUBJECTS}, lambda z: z = s)) >= 3)) > 0 else true end"
)
INTEGRITY = (
    f"case when {trim('md')} = '' then 'unknown' when {has('md', cat.UNDER_CONSTRUCTION)} then 'under_construction' "
    f"when {has('md', cat.TEMPLATE_TEXT)} then 'placeholder_or_template' else 'genuine' end"
)
WORDS = "len(regexp_extract_all({}, '[A-Za-z'']+'))"

TRIAGE_COLUMNS = {
    "has_banner": has("md", cat.COOKIE_BANNER),
    "body": f"case when has_banner then regexp_extract(md, {q('(?is)^.*?' + cat.COOKIE_BANNER[-1] + '(.*)$')}, 2) else md end",
    "words": WORDS.format("body"),
    "crawl_issue": f"""case when {trim('md')} = '' then 'empty_response'
      when {has('md', cat.PARKED)} then 'parked_or_for_sale'
      when {has('md', cat.UNDER_CONSTRUCTION)} then 'under_construction'
      when {has('md', cat.BOT_CHALLENGE)} then 'bot_challenge'
      when {has('md', cat.LOGIN_REQUIRED)} then 'login_required'
      when has_banner and words < 15 then 'cookie_wall'
      when {has('body', cat.LOTTERY)} then 'non_company_page'
      when {directory('body')} then 'directory_or_aggregator'
      when words < 15 then 'boilerplate_only' else 'none' end""",
    "crawl_status": "case when crawl_issue <> 'none' then 'unusable' when words < 120 then 'partial' else 'ok' end",
}

# --- fields -----------------------------------------------------------------------
LABELS = "|".join(cat.TRACKING_LABELS)


def host(url: str) -> str:
    bare = rf"lower(regexp_extract({url}, '^[^/?#]*://([^/?#]*)', 1))"
    bare = f"regexp_replace({bare}, '^.*@|:.*$', '', 'g')"
    return null_if_blank(rf"regexp_replace({bare}, '^(?:(?:{LABELS})\.)+([^.]*\.[^.]*)', '\1')")


URLS = (
    r"case when len(regexp_extract_all(md, '\[([^\]]+)\]\((https?://[^\)]+)\)', 2)) > 0 "
    r"then regexp_extract_all(md, '\[([^\]]+)\]\((https?://[^\)]+)\)', 2) else regexp_extract_all(md, 'https?://[^\s)]+') end"
)
SOCIAL = {
    name: "list_filter(urls, lambda u: " + " or ".join(f"contains(lower(u), {q(k)})" for k in keys) + ")[1]"
    for name, keys in cat.SOCIAL_PLATFORMS.items()
}
COPYRIGHT = (
    r"©\s*(\d{4})?\s*,?\s*([A-Z][\pL\pN_&.,'’\-\s]{1,80}?)(?:\s*\.?(?:\s+All rights reserved|\s*[|\n]|\s*$))"
)
FOOTER = r"regexp_extract(md, '(?ims)^#{1,6}\s*(?:footer|contact|legal)\b.*')"
LEGAL_SOURCE = f"case when regexp_matches({FOOTER}, {q(COPYRIGHT)}) then {FOOTER} else md end"
LANGUAGE_CODES = dict(cat.LANGUAGES) | {f"({c})": c for c in sorted(set(cat.LANGUAGES.values()))}
LOCALE_HITS = (
    "list_filter(list_transform(regexp_extract_all(md, "
    + q(r"(?i)\b(?:" + "|".join(cat.LANGUAGES) + r")\b|\([a-z]{2}\)")
    + "), lambda h: "
    + case("lower(h)", LANGUAGE_CODES)
    + "), lambda c: c is not null)"
)
DESCRIPTION = (
    "list_filter(list_transform(list_filter(list_transform("
    + PARAGRAPHS.format("md")
    + f", lambda p: {trim('p')}), lambda p: p <> '' and not starts_with(p, '#')), lambda p: "
    + trim(r"regexp_replace(regexp_replace(regexp_replace(p, '[*_`]', '', 'g'), '^\s*[-*]\s*', ''), '\s+', ' ', 'g')")
    + "), lambda p: len(string_split(p, ' ')) >= 6)[1]"
)
PRICING_REST = r"regexp_extract(md, '(?im)^##\s*[^\n]*(?:pricing|plans)[^\n]*$((?s:.*))', 1)"
PRICING_TEXT = rf"coalesce(nullif(string_split_regex({PRICING_REST}, '(?m)^##?\s')[1], ''), md)"
PRICES = f"regexp_extract_all(pricing_text, {q(cat.PRICE)})"
HINT = "case " + " ".join(f"when {has('pricing_text', p)} then {q(label)}" for label, p in cat.BILLING_HINTS.items()) + " end"


def ranked(wording: dict[str, tuple[str, str]]) -> str:
    items = ", ".join(
        f"{{'h': -len(regexp_extract_all(lower(md), {q(p[-1])})), 'o': {i}, 'l': {q(label)}}}"
        for i, (label, p) in enumerate(wording.items())
    )
    return f"list_sort(list_filter([{items}], lambda s: s.h < 0))"


PARENT = "coalesce(" + ", ".join(
    null_if_blank(f"regexp_replace({trim('regexp_extract(md, ' + q(w + '([A-Z]' + W[:-1] + r'&, \-]*)') + ', 1)')}, ',+$', '')")
    for w in cat.PARENT_WORDING
) + ")"


def iso(expr: str) -> str:
    parsed = ", ".join(
        f"try_strptime({expr}, '{fmt}')" for fmt in ("%Y-%m-%d", "%m/%d/%Y", "%d/%m/%Y", "%B %d, %Y")
    )
    return f"strftime(coalesce({parsed}), '%Y-%m-%d')"


DATES = (
    "list_filter(list_concat([" + iso("raw_date") + "], list_transform(list_concat(list_concat("
    + ", ".join(f"regexp_extract_all(md, {q(p)})" for p in (cat.ISO_DATE, cat.SLASH_DATE)) + "), "
    + f"regexp_extract_all(md, {q(cat.MONTH_NAME_DATE)})"
    + "), lambda d: " + iso("d") + ")), lambda d: d is not null)"
)


def first_int(patterns) -> str:
    return "coalesce(" + ", ".join(f"try_cast(nullif(regexp_extract(md, {q(p)}, 1), '') as integer)" for p in patterns) + ")"


ABBREVIATIONS = "[" + ", ".join(q(s) for s in cat.US_STATES.values()) + "]"
PLACE_WORD = r"[A-Z][\pL\pN_.\-]*(?:\s+[A-Z][\pL\pN_.\-]*)*"
PLACES = (
    f"list_concat(list_concat(list_concat(list_concat(regexp_extract_all(md, {q(chr(92) + 'bin' + chr(92) + 's+(' + PLACE_WORD + ',' + chr(92) + 's*' + PLACE_WORD + ')' + chr(92) + 'b')}, 1), "
    f"list_filter(regexp_extract_all(md, {q(cat.CITY_STATE)}), lambda p: list_contains({ABBREVIATIONS}, right(p, 2)))), "
    f"regexp_extract_all(md, {q(cat.REMOTE_REGION)})), "
    f"regexp_extract_all(md, {q(chr(92) + 'b(?:' + '|'.join(cat.US_STATES) + ')' + chr(92) + 'b')})), "
    f"list_filter(regexp_extract_all(md, '[A-Za-z]+'), lambda w: list_contains({ABBREVIATIONS}, w)))"
)
NAME_KEY = "nullif(regexp_replace(lower(regexp_replace({}, " + q(cat.LEGAL_SUFFIX) + ", '', 'gi')), '[^a-z0-9]+', '', 'g'), '')"
SLUG = "regexp_replace(regexp_replace(lower({}), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g')"

FIELD_COLUMNS = {
    "domain": f"case when source_url is not null then {host('source_url')} end",
    "urls": URLS,
    **SOCIAL,
    "legal_text": LEGAL_SOURCE,
    "legal_name": null_if_blank(rf"regexp_replace({trim(f'regexp_extract(legal_text, {q(COPYRIGHT)}, 2)')}, '^[.,]+|[.,]+$', '', 'g')"),
    "copyright_year": f"case when legal_name is not null then try_cast(regexp_extract(legal_text, {q(COPYRIGHT)}, 1) as integer) end",
    "description": f"coalesce(nullif({trim('company_description')}, ''), {DESCRIPTION})",
    "locale_hits": LOCALE_HITS,
    "languages": distinct_in_order("locale_hits"),
    "pricing_text": PRICING_TEXT,
    "prices": PRICES,
    "currency_code": "case when len(prices) > 0 then coalesce("
    + case("substr(prices[1], 1, 1)", cat.CURRENCY_SYMBOLS)
    + ", substr(prices[1], 1, 3)) end",
    "billing_hint": f"case when len(prices) > 0 then {HINT} end",
    "tools": codes("md", cat.TECHNOLOGIES),
    "pricing_rank": ranked(cat.PRICING_WORDING),
    "offering_rank": ranked(cat.OFFERING_WORDING),
    "pricing_primary": "coalesce(billing_hint, pricing_rank[1].l)",
    "pricing_secondary": "case when billing_hint is null and pricing_rank[2].h - pricing_rank[1].h <= 1 then pricing_rank[2].l end",
    "offering_primary": "offering_rank[1].l",
    "offering_secondary": "case when offering_rank[2].h - offering_rank[1].h <= 1 then offering_rank[2].l end",
    "self_serve": f"regexp_matches(lower(md), {q(cat.SELF_SERVE_WORDING[-1])})",
    "sales_led": f"regexp_matches(lower(md), {q(cat.SALES_LED_WORDING[-1])})",
    "delivery": "case when self_serve and sales_led then 'HYBRID' when self_serve then 'SELF_SERVE' when sales_led then 'SALES_LED' end",
    "parent_read": PARENT,
    "parent": "coalesce(nullif(parent_guess, ''), parent_read)",
    "entity_name": "coalesce(nullif(company_name, ''), legal_name)",
    "entity_id": "case when coalesce(domain, entity_name) is not null then " + SLUG.format("coalesce(parent, domain, entity_name)") + " end",
    "entity_source": "case when entity_id is null then null when nullif(parent_guess, '') is not null then 'context' when parent_read is not null then 'markdown' end",
    "date_hits": DATES,
    "dates": distinct_in_order("date_hits"),
    "frameworks": codes("md", cat.COMPLIANCE),
    "founded": first_int([w + r"(\d{4})" for w in cat.FOUNDED_WORDING]),
    "duration": first_int(cat.DURATION_WORDING),
    "founding_year": "coalesce(founded, current_year - duration)",
    "founding_year_source": "case when founded is not null then 'explicit' when duration is not null then 'derived' end",
    "place_hits": f"list_filter(list_transform({PLACES}, lambda p: {trim('p')}), lambda p: p <> '')",
    "places": distinct_in_order("place_hits"),
    "expected": "case currency_code when 'USD' then ['en'] when 'GBP' then ['en'] when 'JPY' then ['ja'] "
    "when 'EUR' then ['en', 'de', 'fr', 'es', 'it', 'nl', 'pt'] end",
    "locale_conflict": "coalesce(len(languages) > 0 and expected is not null and not list_has_any(languages, expected), false)",
    "name_conflict": f"coalesce({NAME_KEY.format('legal_name')} <> {NAME_KEY.format('company_name')}, false)",
}

GATE_COLUMNS = {
    "relevant": RELEVANT,
    "usable": "crawl_issue = 'none' and relevant",
    "reasons": """case when crawl_issue <> 'none' then [crawl_issue] when not relevant then ['not_a_company_profile'] else
      list_concat(case when domain is null then ['domain_normalize: required but missing'] else [] end,
                  case when coalesce(entity_id, '') = '' then ['company_entity_resolve.company_id: required but missing'] else [] end) end""",
    "is_valid_row": "len(reasons) = 0",
    "score": f"""case when not usable then 0.0 else 100.0
      - case when domain is null then 30.0 else 0.0 end - case when entity_id is null then 30.0 else 0.0 end
      - case when {null_if_blank(trim('company_description'))} is null and description is not null then 2.0 else 0.0 end
      - case when len(tools) > 0 then 2.0 else 0.0 end
      - case when billing_hint is null and coalesce(pricing_primary, offering_primary, delivery) is not null then 2.0 else 0.0 end
      - case when entity_source = 'markdown' then 2.0 else 0.0 end
      - case when len(dates) > 0 then 2.0 else 0.0 end end""",
}

# Fields as the row report counts them empty.
EMPTY = {
    "domain_normalize": "domain is null",
    "social_links_extract": "coalesce(" + ", ".join(SOCIAL) + ") is null",
    "legal_entity_extract": "legal_name is null",
    "company_description_extract": "coalesce(description, '') = ''",
    "site_locale_detect": "len(languages) = 0",
    "pricing_locale_extract": "len(prices) = 0",
    "careers_page_parse": "not has_roles",
    "tech_stack_normalize": "len(tools) = 0",
    "business_model": "false",
    "company_entity_resolve": "entity_id is null",
    "date_normalize": "len(dates) = 0",
    "compliance_framework_extract": "len(frameworks) = 0",
    "experience_signal_extract": "founding_year is null",
    "service_region_extract": "len(places) = 0",
}


# Where a reported field says it came from; a field that holds nothing says nothing unless named here.
FOUND_IN = {
    "domain_normalize": "case when domain is not null then 'context' end",
    "company_description_extract": f"case when {null_if_blank(trim('company_description'))} is not null then 'context' when description is not null then 'markdown' end",
    "business_model": "case when billing_hint is not null then 'context' when coalesce(pricing_primary, offering_primary, delivery) is not null then 'markdown' end",
    "company_entity_resolve": "entity_source",
}
SOURCE = {f: FOUND_IN.get(f, f"case when not coalesce({test}, true) then 'markdown' end") for f, test in EMPTY.items()}


def pages_sql(select: str, *columns: dict[str, str]) -> str:
    """`select` over the site pages with the given derived columns in reach."""
    derived = "".join(f",\n  {expr} as {name}" for group in columns for name, expr in group.items())
    body = f"""select {select} from (select page_id, source_url, company_name, company_description, parent_guess,
  raw_date, current_year, coalesce(markdown, '') as md{derived}
from site_pages)"""
    return with_fixtures("site_pages", body=body)


CAREERS = (
    r"""case when regexp_matches(md, '(?im)^##\s*(?:careers|jobs|open\s+(?:positions|roles)|we''?re\s+hiring|join\s+(?:us|our\s+team))\b')
  then regexp_extract(md, '(?ims)^##\s*(?:careers|jobs|open\s+(?:positions|roles)|we''?re\s+hiring|join\s+(?:us|our\s+team))\b.*?(?:^##\s|\z)') end"""
)
STRICT = f"""strict_lines as (
  select page_id, i, regexp_replace({trim("regexp_replace(x, '^[-*+ ]+', '')")}, '', '') as line
  from (select page_id, unnest(string_split(section, chr(10))) as x, generate_subscripts(string_split(section, chr(10)), 1) as i
        from (select page_id, {CAREERS} as section from (select page_id, coalesce(markdown, '') as md from site_pages))
        where section is not null)),
strict_roles as (
  select page_id, row_number() over (partition by page_id order by i) - 1 as pos,
    trim(replace(regexp_extract(line, {q(cat.ROLE_LINE)}, 1), '*', '')) as title,
    nullif(trim(replace(regexp_extract(line, {q(cat.ROLE_LINE)}, 2), '*', '')), '') as department,
    nullif(trim(replace(regexp_extract(line, {q(cat.ROLE_LINE)}, 3), '*', '')), '') as location,
    regexp_extract(line, {q(cat.ROLE_LINE)}, 4) as posted_date
  from strict_lines where regexp_matches(line, {q(cat.ROLE_LINE)}))"""
DEPARTMENTS = "(" + ", ".join(q(d) for d in cat.DEPARTMENTS) + ")"
LOOSE = rf"""loose_bodies as (
  select page_id, kind, i, {trim("regexp_replace(b, '[*_`]', '', 'g')")} as body from (
    select page_id, 0 as kind, unnest(regexp_extract_all(section, {q('(?m)' + cat.LOOSE_HEADING)}, 1)) as b,
      generate_subscripts(regexp_extract_all(section, {q('(?m)' + cat.LOOSE_HEADING)}, 1), 1) as i from loose_sections
    union all
    select page_id, 1, unnest(regexp_extract_all(section, {q('(?m)' + cat.LOOSE_BULLET)}, 1)),
      generate_subscripts(regexp_extract_all(section, {q('(?m)' + cat.LOOSE_BULLET)}, 1), 1) from loose_sections)),
loose_dated as (
  select *, nullif(regexp_extract(body, '\b\d{{4}}-\d{{2}}-\d{{2}}\b'), '') as posted_date,
    trim(string_split_regex(body, '\b\d{{4}}-\d{{2}}-\d{{2}}\b')[1]) as rest from loose_bodies),
loose_parts as (
  select *, nullif(trim(regexp_extract(rest, '\(([^)]+)\)\s*$', 1)), '') as place,
    list_filter(list_transform(string_split_regex(trim(regexp_replace(rest, '\(([^)]+)\)\s*$', '')), '\s*[—|]\s*|\s+-\s+|\s*,\s*'),
      lambda p: trim(p)), lambda p: p <> '') as parts from loose_dated),
loose_roles as (
  select page_id, kind, i, parts[1] as title,
    list_filter(parts[2:], lambda p: lower(p) in {DEPARTMENTS})[-1] as department,
    coalesce(place, list_filter(parts[2:], lambda p: lower(p) not in {DEPARTMENTS})[1]) as location, posted_date
  from loose_parts where len(parts) > 0),
loose_kept as (
  select *, row_number() over (partition by page_id, lower(title) order by kind, i) as seen from loose_roles
  where length(title) between 3 and 80 and len(string_split_regex(title, '\s+')) <= 8),
loose_final as (
  select page_id, row_number() over (partition by page_id order by kind, i) - 1 as pos, title, department, location, posted_date
  from loose_kept where seen = 1)"""
LOOSE_SECTIONS = f"""loose_sections as (
  select page_id, section from (select page_id, {CAREERS} as section from (select page_id, coalesce(markdown, '') as md from site_pages))
  where section is not null and page_id not in (select page_id from strict_roles))"""
CAREERS_CTES = f"{STRICT}, {LOOSE_SECTIONS}, {LOOSE}"


def careers_sql(select: str) -> str:
    return with_fixtures("site_pages", body=f", {CAREERS_CTES} {select}")
