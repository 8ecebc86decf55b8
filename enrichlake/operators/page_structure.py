"""Links, footer, sections, paragraphs and dictionary matches of a page.

Column forms serve the wide page job (no shuffle); the `page_*` functions give
the long tables, one row per element, by exploding within the page.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import catalogs as cat
from ..functions import text as t
from ..session import checkpointed

CatalogRows = Sequence[tuple[str, "str | None", Sequence[str]]]


# --- links ------------------------------------------------------------------
def links(markdown: Column) -> Column:
    """Markdown links in text order, then bare URLs that were not linked."""
    pattern = t.rx(cat.MARKDOWN_LINK)
    urls = t.extract_all(markdown, pattern, 2)
    linked = F.zip_with(
        t.extract_all(markdown, pattern, 1), urls,
        lambda a, u: F.struct(t.strip(a).alias("anchor"), u.alias("url")),
    )
    bare = F.array_except(t.extract_all(markdown, t.rx(cat.BARE_URL)), urls)
    return F.concat(
        linked, F.transform(bare, lambda u: F.struct(F.lit("").alias("anchor"), u.alias("url")))
    )


def page_links(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", F.posexplode(links(F.col("markdown"))).alias("pos", "link")).select(
        "page_id", "pos", "link.anchor", "link.url"
    )


# --- footer, sections, paragraphs --------------------------------------------
def footer(markdown: Column, lines: int = cat.FOOTER_LINES) -> Column:
    """From the first footer, contact or legal heading on; else the last `lines` lines."""
    headed = t.extract(
        markdown,
        t.rx(r"^#{1,6}\s*(?:footer|contact|legal)\b(?s:.*)", ignore_case=True, multiline=True),
    )
    n = lines
    tail = t.let(
        t.lines(t.strip(markdown)), lambda xs: F.slice(xs, F.greatest(F.size(xs) - (n - 1), F.lit(1)), F.lit(n))
    )
    return F.coalesce(headed, F.array_join(tail, "\n"))


def section(markdown: Column, titles: Sequence[str], max_chars: int | None = None) -> Column:
    """Text under the first heading that names one of `titles`, '' when there is none.

    The section ends at the next heading of the same or a higher level, whole unless `max_chars` is given.
    """
    names = "|".join(t.literal(x) for x in titles)
    found = F.regexp_extract(
        markdown,
        t.rx(rf"^#{{1,6}}\s*.*(?:{names}).*$(?s:.*)", ignore_case=True, multiline=True),
        0,
    )

    def cut(heading_on: Column) -> Column:
        level = F.length(F.regexp_extract(heading_on, r"^\s*(#{1,6})", 1))
        rest = F.regexp_extract(heading_on, r"(?ds)^#{1,6}\s*[^\n]*(.*)$", 1)
        if max_chars is not None:  # then the search for its end stops there too
            rest = F.substring(rest, 1, max_chars)
        out = F.lit("")
        for n in range(1, 7):
            end = t.rx(rf"^#{{1,{n}}}(?!#)\s*\S", multiline=True)
            out = F.when(level == n, F.get(F.split(rest, end, 2), F.lit(0))).otherwise(out)
        return out

    return t.let(found, cut)


def sections(markdown: Column) -> Column:
    """All headings of a page with level, title and the text below each, as it stands in the page."""
    level_title = t.rx(r"^(#{1,6})\s*(.+)$", multiline=True)
    marks = t.extract_all(markdown, level_title, 1)
    titles = t.extract_all(markdown, level_title, 2)
    whole = t.extract_all(markdown, level_title, 0)
    # Pieces of text between headings; piece 0 lies before the first one.
    pieces = F.split(markdown, t.rx(r"^#{1,6}\s*.+$", multiline=True))
    heads = F.transform(
        F.arrays_zip(marks.alias("mark"), titles.alias("title"), whole.alias("whole"), F.slice(pieces, 2, F.size(marks) + 1).alias("own")),
        lambda h, i: F.struct(
            i.alias("pos"), F.length(h["mark"]).alias("level"), h["whole"].alias("whole"),
            t.strip(h["title"]).alias("title"), h["own"].alias("own"),
        ),
    )

    def all_texts(hs: Column) -> Column:
        def with_text(h: Column) -> Column:
            later = F.slice(hs, h["pos"] + 2, F.size(hs))
            stop = t.first_or_null(F.filter(later, lambda x: x["level"] <= h["level"]))["pos"]
            nested = F.filter(later, lambda x: stop.isNull() | (x["pos"] < stop))
            below = F.transform(nested, lambda x: F.concat(x["whole"], x["own"]))
            return F.struct(
                h["pos"].alias("pos"), h["level"].alias("level"), h["title"].alias("title"),
                F.concat(h["own"], F.array_join(below, "")).alias("text"),
            )

        return F.transform(hs, with_text)

    return t.let(heads, all_texts)


def page_sections(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", F.inline(sections(F.col("markdown"))))


def page_paragraphs(pages: DataFrame) -> DataFrame:
    """One row per blank-line-separated paragraph."""
    return pages.select("page_id", F.posexplode(t.paragraphs(F.col("markdown"))).alias("pos", "paragraph"))


# --- dictionary match ---------------------------------------------------------
def _layers(catalog: CatalogRows) -> list[dict[str, str]]:
    """Spread aliases over scans so that no alias can hide one of another code.

    A scan reports one alias per word start. Where an alias of one code begins
    another code's alias ("cloud", "cloud storage"), the two go to different
    scans. The catalogs in use need a single scan.
    """
    layers: list[dict[str, str]] = []
    pairs = [(a.lower(), code) for code, _, aliases in catalog for a in aliases]
    for alias, code in sorted(pairs, key=lambda p: (-len(p[0]), p[0])):
        for layer in layers:
            clash = any(
                other != code and (known.startswith(alias) or alias.startswith(known))
                for known, other in layer.items()
            )
            if not clash:
                layer[alias] = code
                break
        else:
            layers.append({alias: code})
    return layers


def dictionary_codes(text: Column, catalog: CatalogRows, lowered: bool = False) -> Column:
    """Codes whose alias occurs as whole words, in catalog order.

    One look-ahead scan tests all aliases at each word start, instead of one
    scan of the text per code. `lowered` says that the text is in lower case already.
    """
    text = text if lowered else F.lower(text)
    found = F.array().cast("array<string>")
    for layer in _layers(catalog):
        by_letter: dict[str, list[str]] = {}
        for alias in layer:
            by_letter.setdefault(alias[0], []).append(alias)
        # The first letter decides which few aliases are tried.
        branches = "|".join(
            t.literal(letter) + "(?:" + "|".join(t.literal(a[1:]) for a in aliases) + ")"
            for letter, aliases in by_letter.items()
        )
        hits = t.extract_all(text, t.ahead("".join(by_letter), rf"\b(?=({branches})\b)"), 1)
        lookup = t.text_map(layer.items())
        keys = F.array_distinct(F.transform(hits, lambda h: F.regexp_replace(h, r"(?U)\s+", " ")))
        found = F.concat(found, F.transform(keys, lambda k: F.try_element_at(lookup, k)))
    order = t.text_array(code for code, _, _ in catalog)
    return F.array_intersect(order, found)


def with_category(codes: Column, catalog: CatalogRows) -> Column:
    """Attach the category of each code: ARRAY<STRUCT<tool_id, category>>."""
    lookup = t.text_map((code, category) for code, category, _ in catalog)
    return F.transform(
        codes, lambda c: F.struct(c.alias("tool_id"), F.try_element_at(lookup, c).alias("category"))
    )


def dictionary_match(docs: DataFrame, catalog: CatalogRows, id_col: str, text_col: str) -> DataFrame:
    """X5 as a long table (id, ord, code, category)."""
    pairs = with_category(dictionary_codes(F.col(text_col), catalog), catalog)
    return docs.select(id_col, F.posexplode(pairs).alias("ord", "hit")).select(
        id_col, "ord", F.col("hit.tool_id").alias("code"), "hit.category"
    )


# --- dictionary match against a table -------------------------------------------
SALTS = 16
#: Bits that tell which grams no alias has, as 64-bit numbers; one table of fixed size, however large the catalog.
GRAM_BITS = 1 << 22
#: Stands for a word boundary in a marked text.
MARK = "\u0001"


def _words(text: Column) -> Column:
    return t.extract_all(F.lower(text), r"(?U)\w+")


def _pairs(words: Column) -> Column:
    """A number for each word and the one after it; of the last word alone."""
    return F.zip_with(words, F.slice(words, 2, F.greatest(F.size(words), F.lit(1))), lambda a, b: F.xxhash64(a, b))


def _text_grams(text: Column) -> Column:
    """Numbers of the words and of the neighbouring words of a text, each once."""
    return F.array_distinct(t.let(_words(text), lambda w: F.concat(F.transform(w, lambda x: F.xxhash64(x)), _pairs(w))))


def _alias_grams(alias: Column) -> Column:
    """Numbers of the neighbouring words of an alias, or of its only word."""
    return F.array_distinct(t.let(_words(alias), lambda w: F.slice(_pairs(w), 1, F.greatest(F.size(w) - 1, F.lit(1)))))


def _marked(plain: Column) -> Column:
    return F.regexp_replace(plain, r"(?U)\b", MARK)


#: An alias that is nothing but up to three words; every other one is looked for in the whole text.
PHRASE = r"(?U)\A\w+(?: \w+){0,2}\z"


def _phrases(plain: Column) -> Column:
    """All words of a text, and all runs of two and three words with a space between them."""

    def joined(words: Column, rest: Column) -> Column:
        return F.zip_with(words, F.slice(rest, 2, F.greatest(F.size(rest), F.lit(1))), lambda a, b: F.when(F.endswith(a, F.lit(" ")), F.concat(a, b)))

    def runs(words: Column) -> Column:
        two = joined(words, words)
        return F.transform(F.concat(words, two, joined(words, two)), lambda x: F.rtrim(x))

    # A word keeps its space where the next word follows at once.
    return t.let(t.extract_all(plain, r"(?U)\w+(?: (?=\w))?"), runs)


def _gram_bits(grams: DataFrame) -> DataFrame:
    """One row with an array of numbers whose bits are set for the given grams."""
    at = F.pmod("_gram", F.lit(GRAM_BITS))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(at, F.lit(64)).cast("int"))
    set_ = grams.groupBy(F.floor(at / 64).cast("int").alias("at")).agg(F.bit_or(bit).alias("bits"))
    by_place = F.map_from_entries(F.collect_list(F.struct("at", "bits")))
    filled = t.let(by_place, lambda m: F.transform(F.sequence(F.lit(0), F.lit(GRAM_BITS // 64 - 1)), lambda i: F.coalesce(F.try_element_at(m, i), F.lit(0).cast("bigint"))))
    return set_.agg(filled.alias("bits"))


def dictionary_match_table(docs: DataFrame, catalog: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """X5 with a catalog of any size: (id, ord, code, category), as :func:`dictionary_match` gives them.

    `catalog` has one row per alias: `ord, code, category, alias`. An alias stands in a text only if its words stand
    there side by side, so texts and aliases meet on the alias' rarest pair of neighbouring words (its only word, if it
    has one), counted over the texts; what meets is verified on the whole text, once per alias, and only then meets the
    rows of the catalog that have the alias. Numbers of pairs are moved in place of texts, and only those that a table
    of bits does not rule out; a text moves once, if it meets an alias at all. The keys of both sides are salted, so a
    frequent pair or alias is spread over `SALTS` tasks. Equal rows share their candidates and are verified one by one.
    An alias without a word, a NULL alias and a NULL text match nothing.
    """
    key = F.xxhash64(id_col, text_col)  # equal keys of different rows only add candidates
    texts = docs.where(F.col(text_col).isNotNull()).select(key.alias("_k"), F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    entry = catalog.select("ord", "code", "category", F.lower(t.strip(F.regexp_replace("alias", r"(?U)\s+", " "))).alias("_alias"))
    entry = entry.where("_alias <> ''").distinct()
    wanted = checkpointed(entry.select("_alias").distinct().select("_alias", F.explode(_alias_grams(F.col("_alias"))).alias("_gram")))
    bits = _gram_bits(wanted).scalar()
    at = lambda g: F.pmod(g, F.lit(GRAM_BITS))
    word = lambda g: F.get(F.col("_bits"), F.floor(at(g) / 64).cast("int"))
    asked = F.filter("_grams", lambda g: F.getbit(word(g), F.pmod(at(g), F.lit(64)).cast("int")) == 1)
    held = texts.select("_k", _text_grams(F.col("_text")).alias("_grams")).withColumn("_bits", bits).select("_k", F.explode(asked).alias("_gram"))
    # Read twice from here on; a gram that no alias has, and that the bits let through, ends here.
    held = checkpointed(held.join(wanted.select("_gram").distinct(), "_gram", "left_semi"))
    count = held.groupBy("_gram").agg(F.count(F.lit(1)).alias("_held"))
    # A gram that no text holds leaves the inner join, and with it the aliases that need it.
    met = wanted.join(count, "_gram", "left").groupBy("_alias").agg(
        F.min(F.struct(F.coalesce("_held", F.lit(0)).alias("held"), "_gram")).alias("_rarest")
    )
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    met = met.where("_rarest.held > 0").select("_alias", F.col("_rarest._gram").alias("_gram"), salts.alias("_salt"))
    pairs = held.withColumn("_salt", F.pmod("_k", F.lit(SALTS)).cast("int")).join(met, ["_gram", "_salt"])
    inner = _marked(F.col("_alias"))
    ends = [F.when(F.startswith(inner, F.lit(MARK)), "").otherwise(MARK), F.when(F.endswith(inner, F.lit(MARK)), "").otherwise(MARK)]
    candidate = F.struct(F.col("_alias").alias("alias"), F.concat(ends[0], inner, ends[1]).alias("marked"))
    is_phrase = F.rlike("_alias", F.lit(PHRASE))
    # The phrases of a text are looked up, so a long text is not searched once for each of its many aliases.
    lists = pairs.groupBy("_k").agg(
        F.collect_set(F.when(is_phrase, F.col("_alias"))).alias("_asked"), F.collect_set(F.when(~is_phrase, candidate)).alias("_candidates")
    )
    plain = F.regexp_replace(F.lower("_text"), r"(?U)\s+", " ")

    def stands(c: Column) -> Column:
        # Whole words: the boundaries within and around the alias are those of the text. Only a text that holds the
        # mark itself needs a pattern.
        pattern = F.concat(F.lit(r"(?U)\b"), _quoted_pattern(c["alias"]), F.lit(r"\b"))
        return F.when(F.col("_has_mark"), F.rlike(F.col("_plain"), pattern)).otherwise(F.contains(F.col("_marked"), c["marked"]))

    hits = (
        texts.join(lists, "_k")
        .withColumn("_plain", plain)
        .withColumn("_has_mark", F.contains("_plain", F.lit(MARK)))
        .withColumn("_marked", F.when(F.size("_candidates") > 0, _marked(F.col("_plain"))))
        .withColumn("_found", F.concat(F.array_intersect("_asked", _phrases(F.col("_plain"))), F.transform(F.filter("_candidates", stands), lambda c: c["alias"])))
        .select(F.monotonically_increasing_id().alias("_row"), "_id", F.col("_found").alias("_aliases"))
        .select("_row", "_id", F.explode("_aliases").alias("_alias"))
    )
    columns = ["ord", "code", "category"]
    alone = F.count(F.lit(1)).over(Window.partitionBy(*columns)) == 1
    entries = entry.withColumn("_alone", alone).withColumn("_salt", salts)
    rows = checkpointed(hits).withColumn("_salt", F.pmod("_row", F.lit(SALTS)).cast("int")).join(entries, ["_alias", "_salt"])
    # Only what has several aliases can meet a text twice.
    several = rows.where(~F.col("_alone")).dropDuplicates(["_row", *columns])
    return rows.where("_alone").unionByName(several).select(F.col("_id").alias(id_col), *columns)


def _quoted_pattern(text: Column) -> Column:
    """Every character that is neither a letter, a digit nor a space stands for itself."""
    return F.regexp_replace(text, r"([^\p{L}\p{N}_ ])", r"\\$1")
