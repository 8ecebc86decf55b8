"""Secret scans through a ledger of blobs.

Every version of every path is addressed by the SHA-256 of its content. The ledger holds one row per blob and rule
version that has been scanned, with what was found; a scan reads its pairs first and works only on those that are
missing. A new version of a rule is scanned over old blobs by itself, an old blob in a new place costs no scan. What
is found is joined back to all paths by their blobs.

All of it is built-in functions. Matches and the gaps between them give the places: a running sum of their lengths.

Defined results: a NULL text is an empty blob, a NULL path stays a path. Repeated rows are paths with one blob.
Blobs are reduced within tasks before texts move, so copies of any number are scanned once. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from hashlib import sha256

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common


@dataclass(frozen=True)
class Rule:
    """`pattern` finds a secret, `hint` is a cheaper test that every text with a match passes.

    A match counts if group `group` has `least` characters.
    """

    kind: str
    pattern: str
    hint: str
    group: int = 0
    least: int = 0

    @property
    def version(self) -> str:
        return sha256(f"{self.pattern}|{self.group}|{self.least}".encode()).hexdigest()[:16]

    @property
    def mark(self) -> str:
        return f"{self.kind}@{self.version}"


_KEY = r"(?i:password|passwd|secret|token|api_?key)"
BASE = (
    Rule("assign", rf"({_KEY})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", rf"{_KEY}[\"']?\x20*[:=]", group=2, least=6),
    Rule("access", r"AKIA[A-Z0-9]+", r"AKIA", least=20),
    Rule("hex", r"[0-9a-f]+", r"[0-9a-f]{24}", least=24),
)
FURTHER = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", r"PRIVATE KEY-----"),
    Rule("forge_token", r"gh[pousr]_[A-Za-z0-9]{36,}", r"gh[pousr]_"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}", r"eyJ"),
)
RULES = (*BASE, *FURTHER)
LEDGER = "blob binary, mark string, gaps array<int>, lengths array<int>, valid array<boolean>"


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """LEDGER rows; a pair may stand in it twice if two scans ran at once, with equal content."""
    return spark.read.schema(LEDGER).parquet(path) if _exists(spark, path) else spark.createDataFrame([], LEDGER)


def addressed(versions: DataFrame, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return versions.withColumns({"_text": text, "blob": F.unhex(F.sha2(text, 256))})


def _scanned(rule: Rule) -> Column:
    """What a rule finds in `_text`: gaps before matches (and behind the last), lengths of matches, which ones count."""
    text, pattern = F.col("_text"), F.lit(rule.pattern)
    hit = F.rlike(text, F.lit(rule.hint))
    # A class of characters alone matches whole runs, so runs that are too short can be left out of the search.
    if rule.pattern == r"[0-9a-f]+":
        pattern = F.lit(rf"[0-9a-f]{{{rule.least},}}")
    sizes = lambda a: F.transform(a, lambda x: F.length(x))
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    counted = F.regexp_extract_all(text, pattern, F.lit(rule.group))
    none = F.array().cast("array<int>")
    return F.struct(
        F.lit(rule.mark).alias("mark"),
        F.when(hit, sizes(F.split(text, pattern, -1))).otherwise(none).alias("gaps"),
        F.when(hit, sizes(matches)).otherwise(none).alias("lengths"),
        F.when(hit, F.transform(counted, lambda x: F.length(x) >= rule.least)).otherwise(none.cast("array<boolean>")).alias("valid"),
    )


def scan(versions: DataFrame, path: str, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> int:
    """Scan the (blob, rule version) pairs of `versions` that the ledger at `path` lacks, and append them to it.

    Returns the number of pairs that were scanned.
    """
    spark = versions.sparkSession
    old = ledger(spark, path)
    seen = old.groupBy("blob").agg(F.collect_set("mark").alias("seen"))
    wanted = F.array(*[F.lit(r.mark) for r in rules])
    missing = F.array_except(wanted, F.coalesce("seen", F.array().cast("array<string>")))
    texts = addressed(versions, text_col)
    if old.isEmpty():
        todo = texts.groupBy("blob").agg(F.first("_text").alias("_text")).withColumn("missing", wanted)
    else:
        # Digests are held against the ledger first; only texts that lack a rule are brought together.
        lacking = texts.select("blob").distinct().join(seen, "blob", "left").withColumn("missing", missing).where(F.size("missing") > 0)
        todo = texts.join(lacking.select("blob", "missing"), "blob").groupBy("blob").agg(F.first("_text").alias("_text"), F.first("missing").alias("missing"))
    found = F.array(*[F.when(F.array_contains("missing", r.mark), _scanned(r)) for r in rules])
    rows = todo.where(F.size("missing") > 0).select("blob", F.explode(F.filter(found, lambda x: x.isNotNull())).alias("f")).select("blob", "f.*")
    before = old.count()
    rows.write.mode("append").parquet(path)
    return ledger(spark, path).count() - before


def spans(entries: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(blob, kind, place, start, end) of all matches that count; start and end in code points."""
    current = F.col("mark").isin([r.mark for r in rules])
    rows = entries.where(current & (F.size("lengths") > 0)).dropDuplicates(["blob", "mark"])
    each = rows.select("blob", "mark", F.posexplode(F.arrays_zip("gaps", "lengths", "valid")).alias("i", "m")).where("m.lengths IS NOT NULL")
    so_far = Window.partitionBy("blob", "mark").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("m.gaps") + F.col("m.lengths")).over(so_far)
    kinds = F.create_map(*[F.lit(x) for i, r in enumerate(rules) for x in (r.mark, i)])
    placed = each.withColumn("end", end).where("m.valid").withColumn("place", kinds[F.col("mark")])
    return placed.select("blob", F.split("mark", "@")[0].alias("kind"), "place", (F.col("end") - F.col("m.lengths")).alias("start"), "end")


def by_path(versions: DataFrame, entries: DataFrame, path_cols: list[str], text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The paths with what their blobs hold: counts of the base kinds, and spans joined as kind:start:end."""
    listed = F.sort_array(F.collect_list(F.struct("start", "place", "kind", "end")))
    base = [r.kind for r in BASE]
    written = lambda a: F.array_join(F.transform(a, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    # The list of a blob is bounded by its text.
    of_blob = spans(entries, rules).groupBy("blob").agg(
        listed.alias("all"), *[F.count(F.when(F.col("kind") == k, 1)).alias(f"n_{k}") for k in base]
    ).select("blob", *[f"n_{k}" for k in base], written(F.filter("all", lambda x: x["kind"].isin(base))).alias("base"), written("all").alias("spans"))
    paths = addressed(versions.select(*path_cols, text_col), text_col).select(*path_cols, "blob")
    return paths.join(of_blob, "blob", "left").select(
        *path_cols,
        *[F.coalesce(f"n_{k}", F.lit(0)).cast("bigint").alias(f"n_{k}") for k in base],
        F.sha2(F.coalesce("base", F.lit("")), 256).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"),
    )


def op2_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    path = common.Scratch(spark, "secret-ledger").path("ledger")
    scan(docs, path)
    return by_path(docs, ledger(spark, path), ["doc_id"])


def _sql_rule(place: int, rule: Rule) -> str:
    pattern = rule.pattern.replace(r"\"", '"').replace("'", "''").replace(r"\''", "''")
    found = [f"string_split_regex(text, '{pattern}')", *(f"regexp_extract_all(text, '{pattern}', {g})" for g in (0, rule.group))]
    return f"SELECT doc_id, '{rule.kind}' AS kind, {place} AS place, {rule.least} AS least, {', '.join(f'{x} AS {n}' for x, n in zip(found, ('gaps', 'hits', 'counted'), strict=True))} FROM t"


SQL = f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
  m AS ({" UNION ALL ".join(_sql_rule(i, r) for i, r in enumerate(RULES))}),
  e AS (SELECT doc_id, kind, place, least, unnest(gaps[:len(hits)]) AS gap, unnest(hits) AS hit, unnest(counted) AS counted, unnest(range(len(hits))) AS i FROM m),
  s AS (SELECT *, sum(length(gap) + length(hit)) OVER (PARTITION BY doc_id, place ORDER BY i) AS e FROM e),
  f AS (SELECT doc_id, kind, place, (e - length(hit))::BIGINT AS s, e::BIGINT AS e FROM s WHERE length(counted) >= least),
  g AS (SELECT doc_id, count(*) FILTER (place = 0) AS n_assign, count(*) FILTER (place = 1) AS n_access, count(*) FILTER (place = 2) AS n_hex,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, place) FILTER (place < 3) AS base,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, place) AS spans FROM f GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM t LEFT JOIN g USING (doc_id)
"""
