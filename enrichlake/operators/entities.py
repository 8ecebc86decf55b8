"""E10, R10 across rows: chains of parents, and employers that are spelt differently."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import catalogs as cat
from ..functions import text as t
from ..session import checkpointed


def parent_links(page_rows: DataFrame) -> DataFrame:
    """(entity, parent) of gated pages: each entity's own id and the id of the parent that most of its pages name.

    Pages that name no parent do not vote; a tie goes to the smallest parent.
    """
    entity = F.col("company_entity_resolve")
    own = t.slug(F.coalesce(entity["domain"], entity["company_name"]), "-")
    named = page_rows.select(own.alias("entity"), t.slug(entity["parent_guess"], "-").alias("parent")).where("entity IS NOT NULL AND entity <> ''")
    votes = named.groupBy("entity", "parent").agg(F.count(F.lit(1)).alias("n"))
    usable = F.when(F.col("parent").isNotNull() & (F.col("parent") != ""), F.struct("n", "parent"))
    best = votes.groupBy("entity").agg(F.max(F.when(usable.isNotNull(), F.col("n"))).alias("most"))
    first = votes.join(best, "entity").where("n = most AND parent <> ''").groupBy("entity").agg(F.min("parent").alias("parent"))
    return best.join(first, "entity", "left").select("entity", "parent")


def entity_roots(links: DataFrame) -> DataFrame:
    """(entity, root, circular): where each entity's chain of parents ends.

    `links` has one row (entity, parent) per entity; a NULL parent, one equal to the entity and a parent without a row
    of its own end a chain. A chain that runs into a circle ends at the circle's smallest id and is `circular`.

    Pointers are doubled: after k rounds each entity knows who is 2^k steps above it and the smallest id on the way, so
    chains of any length take a logarithm of rounds. Every round joins many entities to one row each; Spark splits an
    ancestor that very many share, as its side of the join is unique. Rounds end when a round resolves nothing more:
    what is left then leads into circles.
    """
    own = links.where("entity IS NOT NULL").select("entity", F.coalesce("parent", "entity").alias("at"))
    ends = own.select(F.col("at").alias("entity")).distinct().join(own.select("entity"), "entity", "left_anti")
    nodes = own.unionByName(ends.withColumn("at", F.col("entity")))
    # `least` is the smallest id from the entity up to, but without, `at`; `done` says that `at` ends a chain.
    top = nodes.where("at = entity").select(F.col("entity").alias("at"), F.lit(True).alias("is_top"))
    now = checkpointed(nodes.withColumn("least", F.col("entity")).join(top, "at", "left").select("entity", "at", "least", F.col("is_top").isNotNull().alias("done")))
    steps, left = 1, None
    while True:
        open_ = now.where("NOT done").count()
        # A circle has no more members than there are open entities; `least` has to have gone round it once.
        if open_ == 0 or (open_ == left and steps >= open_):
            break
        left = open_
        above = now.select(F.col("entity").alias("_via"), F.col("at").alias("_at"), F.col("least").alias("_least"), F.col("done").alias("_done"))
        moved = now.where("NOT done").join(above, F.col("at") == F.col("_via"))
        moved = moved.select("entity", F.col("_at").alias("at"), F.least("least", "_least").alias("least"), F.col("_done").alias("done"))
        now = checkpointed(now.where("done").unionByName(moved))
        steps *= 2
    # An open entity's pointer stands on its circle by now, and the smallest id ahead of it is the circle's.
    ahead = now.where("NOT done").select(F.col("entity").alias("_on"), F.col("least").alias("_least"))
    circular = now.where("NOT done").join(ahead, F.col("at") == F.col("_on")).select("entity", F.col("_least").alias("root"), F.lit(True).alias("circular"))
    return now.where("done").select("entity", F.col("at").alias("root"), F.lit(False).alias("circular")).unionByName(circular)


# --- employers ---------------------------------------------------------------------
SHARED_PERCENT = 50
WEIGHT = 1_000_000


def _name_words(name: Column) -> Column:
    bare = F.regexp_replace(name, t.rx(cat.LEGAL_SUFFIX, ignore_case=True), "")
    return F.array_sort(F.array_distinct(F.filter(F.split(F.lower(bare), r"[^\p{L}\p{N}]+"), lambda w: w != "")))


def _prefix(names: DataFrame, weights: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """(id, words, total) of names, and (id, word, weight) of the words that a similar name may be met on.

    Words stand from the heaviest to the lightest. Two names share `percent` of their joint weight only if they share
    a word before the rest falls below that share of the name's own weight, so common words are hardly ever met on.
    """
    each = names.select("id", F.explode("words").alias("word")).join(weights, "word", "left").withColumn("weight", F.coalesce("weight", F.lit(WEIGHT)))
    order = Window.partitionBy("id").orderBy(F.desc("weight"), "word")
    placed = each.withColumns({"total": F.sum("weight").over(Window.partitionBy("id")), "rest": F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))})
    totals = placed.groupBy("id").agg(F.max("total").alias("total"), F.sort_array(F.collect_list(F.struct("word", "weight"))).alias("words"))
    return totals, placed.where(100 * F.col("rest") >= percent * F.col("total")).select("id", "word")


def company_person_scored(people: DataFrame, companies: DataFrame, person_col: str = "employed_company", percent: int = SHARED_PERCENT) -> DataFrame:
    """R10 beyond equal names: `people` with `linked_company_id` and `link_score`.

    Names are compared as sets of words without legal suffixes. A word weighs 1,000,000 over the number of companies
    that hold it, so rare words count; a word that no company holds weighs most. The score is the shared weight in
    millionths of the joint weight and has to reach `percent`. Employers are reduced to distinct names first. An employer
    is linked to its best company if that company has no better employer name; a best that two share is no best.
    A name without a word, a NULL name and companies without an id link with nothing.
    """
    company = companies.where("company_id IS NOT NULL").select(F.col("company_id").alias("id"), _name_words(F.col("name")).alias("words")).where(F.size("words") > 0)
    company = checkpointed(company.groupBy("id").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("words")))).alias("words")))
    named = people.select(F.array_join(_name_words(F.col(person_col)), " ").alias("id")).where("id <> ''").distinct()
    employer = named.select("id", F.split("id", " ").alias("words"))
    held = company.select(F.explode("words").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    weights = checkpointed(held.select("word", F.greatest(F.lit(1), F.expr(f"{WEIGHT} div n")).alias("weight")))
    c_all, c_met = _prefix(company, weights, percent)
    e_all, e_met = _prefix(employer, weights, percent)
    pairs = e_met.withColumnRenamed("id", "employer").join(c_met.withColumnRenamed("id", "company"), "word").select("employer", "company").distinct()
    both = pairs.join(e_all.select(F.col("id").alias("employer"), F.col("words").alias("ew"), F.col("total").alias("et")), "employer").join(
        c_all.select(F.col("id").alias("company"), F.col("words").alias("cw"), F.col("total").alias("ct")), "company"
    )
    shared = F.aggregate(F.array_intersect("ew", "cw"), F.lit(0).cast("bigint"), lambda s, x: s + x["weight"])
    scored = both.withColumn("shared", shared).where(100 * F.col("shared") >= percent * (F.col("et") + F.col("ct") - F.col("shared")))
    score = F.expr(f"{WEIGHT} * shared div (et + ct - shared)")
    scored = checkpointed(scored.select("employer", "company", score.alias("score")))

    def best(side: str, other: str) -> DataFrame:
        """The one best partner of each name of `side`."""
        top = scored.groupBy(side).agg(F.max("score").alias("score"))
        tied = scored.join(top, [side, "score"]).groupBy(side).agg(F.count(F.lit(1)).alias("n"), F.min(other).alias(other), F.first("score").alias("score"))
        return tied.where("n = 1").select(side, other, "score")

    mutual = best("employer", "company").join(best("company", "employer").select("company", "employer"), ["company", "employer"])
    link = mutual.select(F.col("employer").alias("_employer"), F.col("company").alias("linked_company_id"), F.col("score").alias("link_score"))
    keyed = people.withColumn("_of", F.array_join(_name_words(F.col(person_col)), " "))
    return keyed.join(link, F.col("_of") == F.col("_employer"), "left").drop("_of", "_employer")
