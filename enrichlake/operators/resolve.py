"""One value per (entity, field) out of competing sources.

A rule is an ordered list of criteria. Since every criterion keeps all groups
that share its best mark, walking the list equals comparing the marks
lexicographically. The walk therefore becomes a maximum over structs, which
Spark combines on the map side: no group of candidates is ever gathered.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as t


@dataclass(frozen=True)
class Criterion:
    type: str
    rank: tuple[str, ...] = ()
    meta_key: str | None = None


@dataclass(frozen=True)
class Rule:
    criteria: tuple[Criterion, ...]
    normalize: str | None = None


def default_rules(profile: str = "profile", page: str = "page", registry: str = "registry") -> dict[str, Rule]:
    """Fields with more than one live source."""
    return {
        "company_name": Rule((Criterion("static_rank", (profile, page)),), "lower_strip"),
        "founded_year": Rule((Criterion("static_rank", (registry, page, profile)),), "int"),
    }


# --- marks: higher is better, NULL is worst ------------------------------------------
def _number(c: Column) -> Column:
    return F.struct(c.cast("double").alias("number"), F.lit(None).cast("string").alias("text"))


def _text(c: Column) -> Column:
    return F.struct(F.lit(None).cast("double").alias("number"), c.cast("string").alias("text"))


def _minus_rank(source: Column, rank: Sequence[str]) -> Column:
    if not rank:
        return F.lit(0)
    place = F.array_position(F.array(*[F.lit(r) for r in rank]), source)
    return -F.when(place > 0, place - 1).otherwise(len(rank))


# Each entry turns a criterion into an aggregate over the candidates of one value.
MARKS: dict[str, Callable[[Criterion], Column]] = {
    "static_rank": lambda c: _number(F.max(_minus_rank(F.col("source"), c.rank))),
    "prefer_structured": lambda c: _number(
        F.max(F.coalesce(F.col(c.meta_key or "is_structured"), F.lit(False)).cast("int"))
    ),
    "most_recent": lambda c: _text(F.max(t.blank_to_null(F.col(c.meta_key or "observed_at").cast("string")))),
    "highest_confidence": lambda c: _number(F.max(F.col(c.meta_key or "confidence"))),
    "majority_vote": lambda c: _number(F.count(F.lit(1))),
}
META_COLUMNS = {"is_structured": "boolean", "observed_at": "string", "confidence": "double"}


def normalized(value: Column, how: str | None) -> Column:
    """Comparison form of a value; text that is no whole number keeps its raw form under `int`."""
    if how == "lower_strip":
        return F.lower(t.strip(value))
    if how == "int":
        number = t.strip(value)
        whole = F.when(t.matches(number, r"^[+-]?[0-9]+\z"), number.try_cast("decimal(38,0)").cast("string"))
        return F.coalesce(whole, value)
    return value


def _known(rule: Rule, marks: Mapping[str, object]) -> tuple[tuple[Criterion, ...], str | None]:
    """Criteria up to the first unknown one, and the type of that one."""
    for i, c in enumerate(rule.criteria):
        if c.type not in marks:
            return rule.criteria[:i], c.type
    return rule.criteria, None


# How the mark of one value in two deliveries becomes one mark; the better one unless named here.
MERGES: dict[str, Callable[[Column], Column]] = {
    "majority_vote": lambda mark: F.struct(F.sum(mark["number"]).alias("number"), F.lit(None).cast("string").alias("text")),
}


class Chains:
    """The criteria of some rules: which marks they need, and each field's marks in the order of its rule."""

    def __init__(self, rules: Mapping[str, Rule], default: Rule = Rule(())):
        self.rules, self.default = rules, default
        self.by_field = {field: _known(rule, MARKS) for field, rule in rules.items()}
        self.last, _ = _known(default, MARKS)
        chains = [*(chain for chain, _ in self.by_field.values()), self.last]
        self.specs = list(dict.fromkeys(c for chain in chains for c in chain))
        self.names = {spec: f"_mark{i}" for i, spec in enumerate(self.specs)}
        self.depth = max(map(len, chains))

    def of_field(self, value: Callable[[Rule], Column]) -> Column:
        out = None
        for field, rule in self.rules.items():
            out = (F if out is None else out).when(F.col("field") == field, value(rule))
        return value(self.default) if out is None else out.otherwise(value(self.default))

    def slot(self, i: int) -> Column:
        unset = F.struct(F.lit(None).cast("double").alias("number"), F.lit(None).cast("string").alias("text"))
        out = None
        for field, (chain, _) in self.by_field.items():
            mark = F.col(self.names[chain[i]]) if i < len(chain) else unset
            out = (F if out is None else out).when(F.col("field") == field, mark)
        last = F.col(self.names[self.last[i]]) if i < len(self.last) else unset
        return last if out is None else out.otherwise(last)


def candidate_marks(candidates: DataFrame, chains: Chains) -> DataFrame:
    """One row per (entity_id, field, value as compared): how often, the earliest candidate, a mark per criterion.

    Values that say nothing share the NULL row. Combined on the map side.
    """
    absent = {c: F.lit(None).cast(dt) for c, dt in META_COLUMNS.items() if c not in candidates.columns}
    cands = candidates.withColumns(absent) if absent else candidates
    live = ~t.is_blank(F.col("value"))
    norm = F.when(live, chains.of_field(lambda r: normalized(F.col("value"), r.normalize)))
    return (
        cands.withColumn("_norm", norm)
        .groupBy("entity_id", "field", "_norm")
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.min(F.struct("ord", "source", "value")).alias("_first"),
            *[MARKS[spec.type](spec).alias(chains.names[spec]) for spec in chains.specs],
        )
    )


def merge_marks(groups: DataFrame, chains: Chains) -> DataFrame:
    """Rows of several :func:`candidate_marks` as if their candidates had come together."""
    marks = [MERGES.get(spec.type, F.max)(F.col(name)).alias(name) for spec, name in chains.names.items()]
    return groups.groupBy("entity_id", "field", "_norm").agg(F.sum("_n").alias("_n"), F.min("_first").alias("_first"), *marks)


def resolve_marks(groups: DataFrame, chains: Chains) -> DataFrame:
    """The value of each (entity_id, field) out of the marks of its values."""
    marks = [chains.slot(i).alias(f"m{i}") for i in range(chains.depth)]
    is_live = F.col("_norm").isNotNull()
    early = F.struct(*marks, (-F.col("_first.ord")).alias("at"), F.col("_first.value").alias("value"), F.col("_first.source").alias("source"))
    late = F.struct(*marks, F.col("_first.ord").alias("at"))
    resolved = groups.groupBy("entity_id", "field").agg(
        F.sum("_n").alias("candidate_count"),
        F.count_if(is_live).alias("_groups"),
        F.max(F.when(is_live, early)).alias("_early"),
        F.max(F.when(is_live, late)).alias("_late"),
    )
    # The best mark is shared exactly when its first and last group differ.
    conflict = F.col("_groups") > 1
    ambiguous = conflict & (-F.col("_early.at") != F.col("_late.at"))
    flag = ambiguous
    for field, (_, unknown) in chains.by_field.items():
        if unknown is not None:
            error = F.raise_error(F.lit(f"unknown priority criterion type: {unknown!r}")).cast("boolean")
            flag = F.when((F.col("field") == field) & ambiguous, error).otherwise(flag)
    return resolved.select(
        "entity_id",
        "field",
        F.col("_early.value").alias("value"),
        F.col("_early.source").alias("source"),
        conflict.alias("conflict"),
        flag.alias("ambiguous"),
        "candidate_count",
    )


def resolve_candidates(candidates: DataFrame, rules: Mapping[str, Rule], default: Rule = Rule(())) -> DataFrame:
    """One row per (entity_id, field).

    Input: `entity_id, field, ord, source, value` and any of `is_structured,
    observed_at, confidence`. Output: `value, source, conflict, ambiguous,
    candidate_count`. Ties left by all criteria go to the earliest candidate and
    are flagged. Both aggregations combine before they shuffle, so an entity with
    very many candidates is no hot spot.
    """
    chains = Chains(rules, default)
    return resolve_marks(candidate_marks(candidates, chains), chains)


def raw_values(candidates: DataFrame) -> DataFrame:
    """Every source's own value, empties included: (entity_id, field, source, value).

    A source that occurs twice keeps its last value.
    """
    return candidates.groupBy("entity_id", "field", "source").agg(F.max_by("value", "ord").alias("value"))


def raw_values_map(candidates: DataFrame) -> DataFrame:
    """:func:`raw_values` as one map per (entity_id, field), one entry per distinct source."""
    return (
        raw_values(candidates)
        .groupBy("entity_id", "field")
        .agg(F.map_from_entries(F.collect_list(F.struct("source", "value"))).alias("raw_values"))
    )


# Row forms of the criteria that need no extra columns.
_ROW_MARKS: dict[str, Callable[[Column, Criterion], Column]] = {
    "static_rank": lambda members, c: F.array_max(F.transform(members, lambda m: _minus_rank(m["source"], c.rank))),
    "majority_vote": lambda members, c: F.size(members),
}


def resolve_columns(candidates: Sequence[tuple[str, Column]], rule: Rule) -> Column:
    """R1 for sources that already sit on one row: STRUCT<value, source, conflict, ambiguous>.

    No shuffle. Criteria that read candidate columns need :func:`resolve_candidates`.
    """
    for c in rule.criteria:
        if c.type not in _ROW_MARKS:
            raise ValueError(f"criterion {c.type!r} has no row form")
    everyone = F.array(
        *[
            F.struct(
                F.lit(i).alias("ord"), F.lit(source).alias("source"), value.alias("value"),
                normalized(value, rule.normalize).alias("norm"),
            )
            for i, (source, value) in enumerate(candidates)
        ]
    )

    def pick(live: Column) -> Column:
        def group(norm: Column) -> Column:
            return t.let(
                F.filter(live, lambda x: x["norm"] == norm),
                lambda members: F.struct(
                    F.array(
                        F.lit(0.0), *[_ROW_MARKS[c.type](members, c).cast("double") for c in rule.criteria]
                    ).alias("marks"),
                    (-members[0]["ord"]).alias("at"),
                    members[0]["value"].alias("value"),
                    members[0]["source"].alias("source"),
                ),
            )

        def best_of(groups: Column) -> Column:
            return t.let(
                F.array_max(groups),
                lambda best: F.struct(
                    best["value"].alias("value"),
                    best["source"].alias("source"),
                    (F.size(groups) > 1).alias("conflict"),
                    F.coalesce(F.size(F.filter(groups, lambda g: g["marks"] == best["marks"])) > 1, F.lit(False)).alias(
                        "ambiguous"
                    ),
                ),
            )

        return t.let(F.transform(F.array_distinct(F.transform(live, lambda x: x["norm"])), group), best_of)

    return t.let(F.filter(everyone, lambda x: ~t.is_blank(x["value"])), pick)
