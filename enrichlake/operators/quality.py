"""Q2-Q9, Q11, Q13: contracts applied to rows.

The row checks are column expressions generated from the contracts and the
schema, so gating adds no shuffle. The long form (`field_report`) serves the
table-level jobs.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contracts import Contract
from ..functions import catalogs as cat
from ..functions import text as t
from .page_fields import is_empty

Contracts = Mapping[str, Contract]
STRINGS = "array<string>"


def _type_of(rows: DataFrame, name: str) -> T.DataType | None:
    return rows.schema[name].dataType if name in rows.columns else None


def _list(reasons: list[Column]) -> Column:
    """Array of the reasons that are not NULL."""
    return F.array_compact(F.array(*reasons)) if reasons else F.array().cast(STRINGS)


# --- Q3-Q8 ------------------------------------------------------------------------
def required_violations(rows: DataFrame, contracts: Contracts) -> Column:
    """Q3: one text per required field without a value; an entity needs its id."""
    reasons = []
    for name, contract in contracts.items():
        if not contract.required:
            continue
        dtype = _type_of(rows, name)
        label = name
        if isinstance(dtype, T.StructType) and "company_id" in dtype.names:
            label = f"{name}.company_id"
            missing = t.is_blank(F.col(f"{name}.company_id"))
        else:
            missing = F.lit(True) if dtype is None else is_empty(F.col(name), dtype)
        reasons.append(F.when(missing, f"{label}: required but missing"))
    return _list(reasons)


def domain_shape_ok(domain: Column) -> Column:
    """Q4: dotted lower-case labels; NULL passes."""
    return domain.isNull() | t.matches(domain, cat.DOMAIN_SHAPE.replace("$", r"\n?\z"))


def business_model_ok(model: Column) -> Column:
    """Q5: the primaries lie in their fixed sets; secondaries are free."""
    allowed = {
        "pricing": tuple(cat.PRICING_WORDING), "offering": tuple(cat.OFFERING_WORDING), "delivery": cat.DELIVERY_LABELS,
    }
    ok = F.lit(True)
    for part, labels in allowed.items():
        ok = ok & F.coalesce(model[part]["primary"].isin(*labels), F.lit(True))
    return ok


def shape_violations(rows: DataFrame) -> Column:
    """Q4, Q5 and the entity id check, for those of the fields a row has."""
    reasons = []
    if "domain_normalize" in rows.columns:
        domain = F.col("domain_normalize")
        reasons.append(
            F.when(
                ~domain_shape_ok(domain),
                F.concat(F.lit("domain_normalize: failed check domain_shape (value='"), domain, F.lit("')")),
            )
        )
    if isinstance(_type_of(rows, "company_entity_resolve"), T.StructType):
        entity = F.col("company_entity_resolve")
        reasons.append(
            F.when(
                entity.isNotNull() & t.is_blank(entity["company_id"]),
                "company_entity_resolve: failed check company_id",
            )
        )
    if isinstance(_type_of(rows, "business_model"), T.StructType):
        reasons.append(
            F.when(~business_model_ok(F.col("business_model")), "business_model: failed check primary_labels")
        )
    return _list(reasons)


def json_shape_violations(social: Column, careers: Column) -> Column:
    """Q6: shapes of ingested JSON (VARIANT) before it is given a schema."""

    def kind(v: Column) -> Column:
        return F.schema_of_variant(v)

    def has_value(v: Column) -> Column:
        return v.isNotNull() & ~F.is_variant_null(v)

    known = t.text_array(sorted(cat.SOCIAL_PLATFORMS))
    as_map = F.try_variant_get(social, "$", "map<string,variant>")
    unknown = F.array_sort(F.array_except(F.map_keys(as_map), known))
    quoted = lambda xs: F.concat(F.lit("['"), F.array_join(xs, "', '"), F.lit("']"))
    social_reasons = F.when(
        has_value(social),
        F.when(
            ~F.startswith(kind(social), F.lit("OBJECT")),
            F.array(F.lit("social_links_extract: expected an object")),
        ).otherwise(
            F.concat(
                F.when(
                    F.size(unknown) > 0,
                    F.array(F.concat(F.lit("social_links_extract: unexpected keys "), quoted(unknown))),
                ).otherwise(F.array().cast(STRINGS)),
                F.transform(
                    F.filter(
                        F.map_entries(as_map), lambda e: has_value(e["value"]) & (kind(e["value"]) != "STRING")
                    ),
                    lambda e: F.concat(F.lit("social_links_extract."), e["key"], F.lit(": expected a string")),
                ),
            )
        ),
    )
    role_keys = t.text_array(sorted(cat.ROLE_KEYS))
    roles = F.try_variant_get(careers, "$", "array<variant>")

    def role_reason(role: Column, i: Column) -> Column:
        at = F.concat(F.lit("careers_page_parse["), i.cast("string"), F.lit("]: "))
        keys = F.map_keys(F.try_variant_get(role, "$", "map<string,variant>"))
        missing = F.array_except(role_keys, keys)
        return F.when(
            ~F.startswith(kind(role), F.lit("OBJECT")), F.concat(at, F.lit("expected an object"))
        ).when(F.size(missing) > 0, F.concat(at, F.lit("missing keys "), quoted(missing)))

    careers_reasons = F.when(
        has_value(careers),
        F.when(
            ~F.startswith(kind(careers), F.lit("ARRAY")), F.array(F.lit("careers_page_parse: expected a list"))
        ).otherwise(F.array_compact(F.transform(roles, role_reason))),
    )
    none = F.array().cast(STRINGS)
    return F.concat(F.coalesce(social_reasons, none), F.coalesce(careers_reasons, none))


def holds_placeholder(c: Column, dtype: T.DataType) -> Column:
    """Q7: TRUE when any text inside the value stands for "nothing"."""
    if isinstance(dtype, T.StringType):
        return F.coalesce(F.lower(t.strip(c)).isin(*cat.PLACEHOLDERS), F.lit(False))
    if isinstance(dtype, T.ArrayType):
        return F.coalesce(F.exists(c, lambda x: holds_placeholder(x, dtype.elementType)), F.lit(False))
    if isinstance(dtype, T.StructType):
        out = F.lit(False)
        for f in dtype.fields:
            if isinstance(f.dataType, (T.StringType, T.ArrayType, T.StructType)):
                out = out | holds_placeholder(c[f.name], f.dataType)
        return out
    return F.lit(False)


def placeholder_violations(rows: DataFrame, contracts: Contracts) -> Column:
    reasons = []
    for name in contracts:
        dtype = _type_of(rows, name)
        if dtype is not None:
            # Fixed wording of the reason.
            text = f"{name}: contains a placeholder string instead of empty (None/[]/{{}})"
            reasons.append(F.when(holds_placeholder(F.col(name), dtype), text))
    return _list(reasons)


def violations(rows: DataFrame, contracts: Contracts) -> Column:
    """Q8: all reasons against a row; none means valid."""
    return F.concat(
        required_violations(rows, contracts), shape_violations(rows), placeholder_violations(rows, contracts)
    )


# --- Q2, Q9 -----------------------------------------------------------------------
def report_column(rows: DataFrame, fields: list[str], source: str | None = None) -> Column:
    """Q2 on the row: ARRAY<STRUCT<field, ran, is_empty, source>>.

    `source` labels every field; without it the `<field>_src` columns are read. A field ran unless its
    `<field>_error` is set; jobs that cannot fail have no such column.
    """
    entries = []
    for name in fields:
        dtype = _type_of(rows, name)
        entries.append(
            F.struct(
                F.lit(name).alias("field"),
                (F.col(f"{name}_error").isNull() if f"{name}_error" in rows.columns else F.lit(True)).alias("ran"),
                (F.lit(True) if dtype is None else is_empty(F.col(name), dtype)).alias("is_empty"),
                (_source_of(rows, name) if source is None else F.lit(source)).alias("source"),
            )
        )
    return F.array(*entries)


def _source_of(rows: DataFrame, name: str) -> Column:
    return F.col(f"{name}_src") if f"{name}_src" in rows.columns else F.lit(None).cast("string")


def field_errors(rows: DataFrame, fields: list[str]) -> Column:
    """ARRAY<STRUCT<field, error>> of the fields that failed on the row."""
    entries = [F.struct(F.lit(f).alias("field"), F.col(f"{f}_error").alias("error")) for f in fields if f"{f}_error" in rows.columns]
    kind = "array<struct<field:string,error:string>>"
    return F.filter(F.array(*entries), lambda x: x["error"].isNotNull()).cast(kind) if entries else F.array().cast(kind)


def field_report(rows: DataFrame, id_col: str, fields: list[str], source: str) -> DataFrame:
    """Q2 as rows (id, field, ran, is_empty, source)."""
    return explode_report(rows.withColumn("function_report", report_column(rows, fields, source)), id_col)


def explode_report(rows: DataFrame, id_col: str, *keep: str) -> DataFrame:
    return rows.select(id_col, *keep, F.explode("function_report").alias("_r")).select(id_col, *keep, "_r.*")


def quality_score(rows: DataFrame, contracts: Contracts, source: str | None = None) -> Column:
    """Q9 on the row: 100 minus the penalties, within 0 and 100."""
    score = F.lit(100.0)
    for name, contract in contracts.items():
        dtype = _type_of(rows, name)
        if dtype is None:
            continue
        if contract.required:
            score = score - F.when(is_empty(F.col(name), dtype), cat.REQUIRED_EMPTY_PENALTY).otherwise(0.0)
        lower = contract.source_priority[1:]
        if lower:
            label = F.lit(source) if source else _source_of(rows, name)
            score = score - F.when(label.isin(*lower), cat.LOWER_SOURCE_PENALTY).otherwise(0.0)
    return F.greatest(F.lit(0.0), F.least(F.lit(100.0), score))


def quality_scores(report: DataFrame, contracts_df: DataFrame, id_col: str) -> DataFrame:
    """Q9 over a long report: (id, quality_score). Contracts are one row per field."""
    position = F.array_position("source_priority", F.col("source"))
    penalty = F.when(F.col("required") & F.col("is_empty"), cat.REQUIRED_EMPTY_PENALTY).otherwise(0.0) + F.when(
        position > 1, cat.LOWER_SOURCE_PENALTY
    ).otherwise(0.0)
    return (
        report.join(contracts_df, "field", "left")
        .groupBy(id_col)
        .agg(F.greatest(F.lit(0.0), F.least(F.lit(100.0), F.lit(100.0) - F.sum(penalty))).alias("quality_score"))
    )


def gate_rows(rows: DataFrame, contracts: Contracts, source: str | None = None) -> DataFrame:
    """Q8 and Q9 on rows that need no triage: adds report, reasons, validity, score, version."""
    return (
        rows.withColumns(
            {
                "function_report": report_column(rows, [c for c in contracts if c in rows.columns], source),
                "rejection_reasons": violations(rows, contracts),
                "quality_score": quality_score(rows, contracts, source),
                "schema_version": F.lit(cat.SCHEMA_VERSION),
            }
        ).withColumn("is_valid_row", F.size("rejection_reasons") == 0)
    )


# --- Q13 --------------------------------------------------------------------------
def null_rate_vs_tolerance(report: DataFrame, contracts_df: DataFrame) -> DataFrame:
    """Q13: empty share per field against what its contract tolerates.

    Counts are combined before the shuffle, which carries one row per field and task.
    """
    rates = report.groupBy("field").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col("is_empty").cast("long")).alias("empty_rows")
    )
    pct = F.col("empty_rows") * 100.0 / F.col("rows")
    return (
        rates.join(contracts_df, "field")
        .withColumn("null_pct", pct)
        .withColumn("over_tolerance", pct > F.col("null_tolerance_pct"))
        .select("field", "rows", "empty_rows", "null_pct", "null_tolerance_pct", "over_tolerance")
    )
