"""Mixing sources to target weights over a tree of domain, language and source.

A token budget is handed down the tree. At each node it is shared among the children by weight; a child that holds
less than its share gives the rest back to its siblings, and only what a whole family cannot use reaches the siblings
of its parent. Shares are whole tokens and add up exactly. A leaf may be read in several epochs, each a seeded order
of its documents of its own; the leaf's share is a prefix of that stream of tokens, so the last document may be cut.

The tree has one row per leaf. Documents are never sorted as a whole: their seeded keys fall in 4096 slots per leaf,
sums of slots tell in which slot a prefix ends, and only the documents of that slot are ordered.

Defined results: tokens are words of [^\\x20\\x09-\\x0D]+; documents without a token (NULL, empty, blank) are never
taken. NULL in a level of the tree is the empty name. A weight of 0 leaves a node out; nodes without a weight have 1.
A budget beyond all supply takes every leaf to `max_epochs`. Repeated rows are taken or left one by one. Documents
need an id: those without one share one place in the order. Further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

LEVELS = ("domain", "lang", "source")
#: Slots by the leading three hex digits of a key.
SLOT_DIGITS = 3
WIDE = "decimal(38,0)"


def _token_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, texts in common.parts(batch, "text"):
            n = pa.array([len(t.split()) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], n], names=[*part.schema.names[:-1], "tokens"])


def counted(docs: DataFrame, domain: str, row_key: str | None = None) -> DataFrame:
    """(doc_id, domain, lang, source, tokens) of the documents that hold a token; `row_key`, a bigint column, is carried along."""
    named = {"domain": F.expr(domain), "lang": F.col("lang"), "source": F.col("source")}
    plain = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        *[F.coalesce(c.cast("string"), F.lit("")).alias(n) for n, c in named.items()],
        *([F.col(row_key).alias("row_key")] if row_key else []),
        F.col("text").cast("string").alias("text"),
    )
    kind = f"doc_id bigint, domain string, lang string, source string, {'row_key bigint, ' if row_key else ''}tokens bigint"
    return plain.mapInArrow(_token_counts, kind).where("tokens > 0")


def _weight(levels: tuple[str, ...], weights: Mapping[tuple[str, ...], int]) -> Column:
    """Weight of a node by its path; the table of weights is configuration."""
    out = F.lit(1)
    for path, w in weights.items():
        if len(path) == len(levels):
            match = F.lit(True)
            for level, value in zip(levels, path, strict=True):
                match = match & (F.col(level) == value)
            out = F.when(match, F.lit(int(w))).otherwise(out)
    return out.cast("bigint")


def shared(children: DataFrame, parent: tuple[str, ...], node: str) -> DataFrame:
    """Add `share`: the `budget` of each family, shared by `weight` and bounded by `cap`.

    Children in order of cap to weight: those that cannot use their part of what is left are filled, the others
    share the rest in proportion, rounded by running totals.
    """
    order = Window.partitionBy(*parent).orderBy(F.col("cap") / F.col("weight"), node)
    every, before = Window.partitionBy(*parent), order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    full = F.col("cap").cast(WIDE) * F.col("weight_left") <= F.col("weight").cast(WIDE) * F.col("budget_left")
    part = "cast(cast(rest as decimal(20,0)) * cast({} as decimal(18,0)) as decimal(38,0)) div open_weight"
    return (
        children.withColumn("weight_left", F.sum("weight").over(onward))
        .withColumn("budget_left", F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("full", full)
        .withColumn("rest", F.col("budget") - F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0)).over(every))
        .withColumn("open", F.when(F.col("full"), 0).otherwise(F.col("weight")))
        .withColumn("open_weight", F.sum("open").over(every))
        .withColumn("open_before", F.coalesce(F.sum("open").over(before), F.lit(0)))
        .withColumn(
            "share",
            F.when(F.col("full"), F.col("cap")).otherwise(
                F.expr(part.format("(open_before + open)")) - F.expr(part.format("open_before"))
            ),
        )
        .drop("weight_left", "budget_left", "full", "rest", "open", "open_weight", "open_before")
    )


def leaf_shares(rows: DataFrame, budget: int | str, weights: Mapping[tuple[str, ...], int], max_epochs: int) -> DataFrame:
    """One row per leaf: its tokens and its share of the budget.

    `budget` is a number, or a SQL expression over `supply`, the tokens of all leaves together.
    """
    leaves = rows.groupBy(*LEVELS).agg(F.sum("tokens").alias("leaf_tokens"))
    shown = F.lit(True)
    for depth in range(1, len(LEVELS) + 1):
        shown = shown & (_weight(LEVELS[:depth], weights) > 0)
    leaves = leaves.where(shown).withColumn("cap", F.col("leaf_tokens") * max_epochs)
    supply = F.sum("leaf_tokens").over(Window.partitionBy())
    nodes = (
        leaves.withColumn("supply", supply)
        .groupBy(LEVELS[0])
        .agg(F.sum("cap").alias("cap"), F.first("supply").alias("supply"))
        .withColumn("budget", F.expr(str(budget)).cast("bigint"))
        .withColumn("weight", _weight(LEVELS[:1], weights))
    )
    granted = shared(nodes, (), LEVELS[0]).select(LEVELS[0], F.col("share").alias("budget"))
    for depth in range(2, len(LEVELS) + 1):
        levels = LEVELS[:depth]
        nodes = (
            leaves.groupBy(*levels)
            .agg(F.sum("cap").alias("cap"), F.sum("leaf_tokens").alias("leaf_tokens"))
            .join(granted, list(levels[:-1]))
            .withColumn("weight", _weight(levels, weights))
        )
        whole = shared(nodes, levels[:-1], levels[-1])
        granted = whole.select(*levels, F.col("share").alias("budget"))
    return whole.select(*LEVELS, "leaf_tokens", "share")


def selected(rows: DataFrame, shares: DataFrame, seed: int) -> DataFrame:
    """(doc_id, levels, tokens, epoch, taken): a row per document and epoch in which some of it is taken, with its `row_key` if it has one."""
    row_key = ["row_key"] if "row_key" in rows.columns else []
    joined = rows.join(shares.where("share > 0"), list(LEVELS)).withColumns({
        "passes": F.expr("share div leaf_tokens").cast("int"),
        "rest": F.col("share") % F.col("leaf_tokens"),
    })
    whole = joined.where("passes > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("passes") - 1)))
    whole = whole.withColumn("taken", F.col("tokens"))
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("passes").cast("string"), F.col("doc_id").cast("string")))
    last = joined.where("rest > 0").withColumn("epoch", F.col("passes")).withColumn("key", key)
    last = last.withColumn("slot", F.substring("key", 1, SLOT_DIGITS))
    earlier = Window.partitionBy(*LEVELS).orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    slots = (
        last.groupBy(*LEVELS, "slot")
        .agg(F.sum("tokens").alias("slot_tokens"), F.first("rest").alias("slot_rest"))
        .withColumn("slot_before", F.coalesce(F.sum("slot_tokens").over(earlier), F.lit(0)))
        .where("slot_before < slot_rest")
        .drop("slot_rest")
    )
    last = last.join(slots, [*LEVELS, "slot"])
    inside = last.where("slot_before + slot_tokens <= rest").withColumn("taken", F.col("tokens"))
    within = Window.partitionBy(*LEVELS).orderBy("key", "doc_id", "tokens", *row_key).rowsBetween(Window.unboundedPreceding, -1)
    edge = (
        last.where("slot_before + slot_tokens > rest")
        .withColumn("before", F.col("slot_before") + F.coalesce(F.sum("tokens").over(within), F.lit(0)))
        .where("before < rest")
        .withColumn("taken", F.least("tokens", F.col("rest") - F.col("before")))
    )
    columns = ["doc_id", *row_key, *LEVELS, "tokens", "epoch", "taken"]
    return whole.select(columns).unionByName(inside.select(columns)).unionByName(edge.select(columns))


def mix(docs: DataFrame, domain: str, budget: int | str, weights: Mapping[tuple[str, ...], int], max_epochs: int = 4, seed: int = 0, row_key: str | None = None) -> DataFrame:
    """The selection as rows; one pass over the texts."""
    scratch = common.Scratch(docs.sparkSession, "mixing")
    rows = scratch.store(counted(docs, domain, row_key), "tokens")
    shares = scratch.store(leaf_shares(rows, budget, weights, max_epochs), "shares")
    return selected(rows, shares, seed)


def mixed_documents(docs: DataFrame, domain: str, budget: int | str, weights: Mapping[tuple[str, ...], int], max_epochs: int, seed: int) -> DataFrame:
    """The documents as selected, once per epoch; the text of a document at a leaf's end is cut behind its last token."""
    scratch = common.Scratch(docs.sparkSession, "mixed")
    # Ids may repeat or be missing, so each row has a key of its own; stored, as keys are given anew by each reading.
    keyed = docs.select(F.monotonically_increasing_id().alias("_mixed"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    keyed = scratch.store(keyed, "rows")
    taken = mix(keyed.select("_mixed", "_row.*"), domain, budget, weights, max_epochs, seed, "_mixed")
    chosen = scratch.store(taken.select(F.col("row_key").alias("_mixed"), "epoch", (F.col("taken") < F.col("tokens")).alias("_cut"), "taken"), "chosen")
    joined = keyed.join(chosen, "_mixed")
    head = F.array_join(F.slice(F.regexp_extract_all(F.col("_row.text"), F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0)), F.lit(1), F.col("taken").cast("int")), "")
    text = F.when(F.col("_cut"), head).otherwise(F.col("_row.text"))
    row = F.col("_row").withField("text", text)
    if "n_chars" in docs.columns:
        row = row.withField("n_chars", F.when(F.col("_cut"), F.length(head)).otherwise(F.col("_row.n_chars")).cast(docs.schema["n_chars"].dataType))
    return joined.select(row.alias("_row")).select("_row.*")


#: Domains of the given table: its sources carry a number, and four domains share them out.
DOMAIN = r"concat('domain', pmod(coalesce(try_cast(regexp_extract(source, '([0-9]+)', 1) as bigint), 0), 4))"
WEIGHTS = {
    ("domain0",): 4, ("domain1",): 3, ("domain2",): 2, ("domain3",): 1,
    **{(f"domain{d}", lang): w for d in range(4) for lang, w in (("en", 5), ("de", 2), ("fr", 2), ("es", 1))},
    ("domain0", "en", "src0"): 2,
}
SEED = 20240


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(common.table(spark, sf_dir, "documents"), DOMAIN, "supply", WEIGHTS, 4, SEED)


def _sql_level(level: int, keys: str, parent: str, name: str, weight: str, budget: str) -> str:
    part = f"PARTITION BY {parent}" if parent else ""
    on = f"JOIN g{level - 1} USING ({parent})" if parent else ""
    return f"""
  n{level} AS (SELECT * FROM (SELECT {keys}, sum(leaf_tokens)::BIGINT AS leaf_tokens, sum(cap)::BIGINT AS cap, {weight} AS weight FROM leaves GROUP BY {keys}) {on}),
  a{level} AS (SELECT *, {budget} AS b,
      cap::HUGEINT * sum(weight) OVER ({part} ORDER BY cap / weight, {name} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
        <= weight::HUGEINT * ({budget} - coalesce(sum(cap) OVER ({part} ORDER BY cap / weight, {name} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS filled
    FROM n{level}),
  c{level} AS (SELECT *, b - sum(CASE WHEN filled THEN cap ELSE 0 END) OVER ({part}) AS rest, sum(CASE WHEN filled THEN 0 ELSE weight END) OVER ({part}) AS ow,
      coalesce(sum(CASE WHEN filled THEN 0 ELSE weight END) OVER ({part} ORDER BY cap / weight, {name} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ob FROM a{level}),
  g{level} AS (SELECT {keys}, leaf_tokens AS lt{level},
      (CASE WHEN filled THEN cap ELSE (rest::HUGEINT * (ob + weight)) // ow - (rest::HUGEINT * ob) // ow END)::BIGINT AS g{level} FROM c{level})"""


SQL = rf"""
WITH rows_ AS (
    SELECT doc_id, 'domain' || (coalesce(try_cast(regexp_extract(source, '(\d+)', 1) AS BIGINT), 0) % 4) AS domain, coalesce(lang, '') AS lang,
      coalesce(source, '') AS source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS tokens FROM documents),
  t AS (SELECT * FROM rows_ WHERE tokens > 0),
  leaves AS (SELECT domain, lang, source, sum(tokens)::BIGINT AS leaf_tokens, 4 * sum(tokens)::BIGINT AS cap FROM t GROUP BY ALL),
  {_sql_level(1, "domain", "", "domain", "CASE domain WHEN 'domain0' THEN 4 WHEN 'domain1' THEN 3 WHEN 'domain2' THEN 2 ELSE 1 END", "(SELECT sum(tokens) FROM t)")},
  {_sql_level(2, "domain, lang", "domain", "lang", "CASE lang WHEN 'en' THEN 5 WHEN 'de' THEN 2 WHEN 'fr' THEN 2 ELSE 1 END", "g1")},
  {_sql_level(3, "domain, lang, source", "domain, lang", "source", "CASE WHEN domain = 'domain0' AND lang = 'en' AND source = 'src0' THEN 2 ELSE 1 END", "g2")},
  j AS (SELECT t.*, g3 // lt3 AS passes, g3 % lt3 AS rest FROM t JOIN g3 USING (domain, lang, source) WHERE g3 > 0),
  last AS (SELECT *, coalesce(sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY md5('{SEED}:' || passes || ':' || doc_id), doc_id, tokens
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM j WHERE rest > 0)
SELECT doc_id, domain, lang, source, tokens, e::INT AS epoch, tokens AS taken FROM (SELECT *, unnest(range(passes)) AS e FROM j)
UNION ALL
SELECT doc_id, domain, lang, source, tokens, passes::INT, least(tokens, rest - before)::BIGINT FROM last WHERE before < rest
"""
