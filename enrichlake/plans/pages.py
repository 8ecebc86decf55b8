"""From pages or records to gated rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contracts import PAGE_CONTRACTS
from ..functions import catalogs as cat
from ..functions import text as t
from ..operators import quality
from ..operators.drift import drift_flags, history_key
from ..operators.page_fields import PAGE_JOBS, FieldJob, extract_fields
from ..operators.skew import top_k
from ..operators.triage import triage
from ..session import checkpointed
from .history import History


def assemble_page_rows(pages: DataFrame, jobs: Sequence[FieldJob] = PAGE_JOBS) -> DataFrame:
    """All fields of every page plus `function_report` and `field_errors`, without any gate."""
    rows = extract_fields(pages, jobs)
    fields = [j.name for j in jobs if j.reported]
    made = {"function_report": quality.report_column(rows, fields), "field_errors": quality.field_errors(rows, [j.name for j in jobs])}
    return rows.withColumns(made).drop(*[f"{j.name}{x}" for j in jobs for x in ("_src", "_error")])


def gate_pages(
    pages: DataFrame,
    contracts: quality.Contracts = PAGE_CONTRACTS,
    jobs: Sequence[FieldJob] = PAGE_JOBS,
    run_timestamp: Column | None = None,
    where: Column | None = None,
) -> DataFrame:
    """Triage, extraction and gate: one output row per page, in one map-only stage.

    `where` is a condition on given columns that selects the pages to work on. It
    reaches the scan; a filter on the result does not, as it must not repeat the
    extraction.

    Unusable pages keep their text and reasons; their fields are never evaluated.
    A job that fails on a page leaves an empty field that did not run and an entry
    in `field_errors`; the page's other fields and all other pages are as without it.
    The plan holds no shuffle, so it scales with the number of splits. Everything
    of :func:`process_batch` is here but the drift warnings, which look across rows.
    """
    triaged = triage(pages if where is None else pages.where(where))
    usable = F.size("triage_reasons") == 0
    rows = extract_fields(triaged, jobs, usable)
    reported = [j.name for j in jobs if j.reported]
    report = quality.report_column(rows, reported)
    gated = rows.withColumns(
        {
            "function_report": F.when(usable, report).otherwise(F.array().cast("array<struct<field:string,ran:boolean,is_empty:boolean,source:string>>")),
            "rejection_reasons": F.when(usable, quality.violations(rows, contracts)).otherwise(F.col("triage_reasons")),
            "quality_score": F.when(usable, quality.quality_score(rows, contracts)).otherwise(0.0),
            "field_errors": quality.field_errors(rows, [j.name for j in jobs]),
        }
    )
    out = gated.withColumns(
        {
            "is_valid_row": F.size("rejection_reasons") == 0,
            "schema_version": F.lit(cat.SCHEMA_VERSION),
            "run_timestamp": F.current_timestamp() if run_timestamp is None else run_timestamp,
        }
    ).drop("triage_reasons", *[f"{j.name}{x}" for j in jobs for x in ("_src", "_error")])
    made = ["function_report", "rejection_reasons", "quality_score", "is_valid_row", "field_errors"]
    return out.select(
        *[t.evaluated(F.col(c)).alias(c) if c in made else c for c in out.columns if c != "markdown"],
        F.coalesce("markdown", F.lit("")).alias("raw_markdown_input"),
    )


def observations(rows: DataFrame, id_col: str, namespace: str | None = None) -> DataFrame:
    """One history row (field, ts, seq, is_empty, id) per reported field of a gated row."""
    return quality.explode_report(rows, id_col, "run_timestamp").select(
        history_key(F.col("field"), namespace).alias("field"),
        F.col("run_timestamp").alias("ts"),
        F.col(id_col).alias("seq"),
        "is_empty",
        F.col("field").alias("_field"),
    )


def drift_warnings(
    rows: DataFrame, id_col: str, fields: Sequence[str], namespace: str | None = None, history: DataFrame | None = None
) -> DataFrame:
    """(id, drift_warnings) for the rows that have a warning; at most one entry per field."""
    new = observations(rows, id_col, namespace)
    if history is not None:
        # Earlier batches came before this one, so only the last observations of a field can stand in a window.
        latest = top_k(history, ["field"], [F.desc("ts"), F.desc("seq")], cat.DRIFT_WINDOW - 1)
        old = latest.select("field", "ts", F.col("seq").cast(new.schema["seq"].dataType).alias("seq"), "is_empty")
        new = new.unionByName(old, allowMissingColumns=True)
    return warnings_of(drift_flags(new), id_col, fields)


def warnings_of(flags: DataFrame, id_col: str, fields: Sequence[str]) -> DataFrame:
    """Drifting observations as (id, drift_warnings); `_field` is the plain field of a row to report, else NULL."""
    order = t.text_array(fields)
    return (
        flags.where(F.col("drifting") & F.col("_field").isNotNull())
        .groupBy(F.col("seq").alias(id_col))
        .agg(F.collect_set("_field").alias("_fields"))
        .select(
            id_col,
            F.transform(
                F.array_intersect(order, "_fields"), lambda f: F.concat(F.lit("drift_warning:"), f)
            ).alias("drift_warnings"),
        )
    )


def _attach_drift(
    rows: DataFrame, id_col: str, fields: Sequence[str], namespace: str | None, history: DataFrame | None
) -> DataFrame:
    # Read twice from here on (history and rows), extracted once.
    rows = checkpointed(rows)
    return _with_warnings(rows, id_col, drift_warnings(rows, id_col, fields, namespace, history))


def _with_warnings(rows: DataFrame, id_col: str, warnings: DataFrame) -> DataFrame:
    return rows.join(warnings, id_col, "left").withColumn(
        "drift_warnings", F.coalesce("drift_warnings", F.array().cast("array<string>"))
    )


def process_delivery(
    pages: DataFrame,
    history: History,
    batch: str,
    contracts: quality.Contracts = PAGE_CONTRACTS,
    jobs: Sequence[FieldJob] = PAGE_JOBS,
    run_timestamp: Column | None = None,
    ordered: bool = True,
) -> DataFrame:
    """Q12 over a kept history: the batch is tested against the tails before it and joins the history.

    A batch that is sent again replaces its own part. Neither reads earlier observations.
    """
    fields = [j.name for j in jobs if j.reported]
    rows = checkpointed(gate_pages(pages, contracts, jobs, run_timestamp))
    flags = history.deliver(observations(rows, "page_id"), batch)
    out = _with_warnings(rows, "page_id", warnings_of(flags.withColumn("_field", F.col("field")), "page_id", fields))
    return out.orderBy(F.desc("is_valid_row"), "page_id") if ordered else out


def process_batch(
    pages: DataFrame,
    contracts: quality.Contracts = PAGE_CONTRACTS,
    jobs: Sequence[FieldJob] = PAGE_JOBS,
    history: DataFrame | None = None,
    run_timestamp: Column | None = None,
    ordered: bool = True,
) -> DataFrame:
    """Q12: gated rows with drift warnings, valid rows first, input order inside each group.

    `page_id` is the input order. `ordered=False` leaves out the final sort, which
    a table written for other jobs does not need.
    """
    gated = gate_pages(pages, contracts, jobs, run_timestamp)
    out = _attach_drift(gated, "page_id", [j.name for j in jobs if j.reported], None, history)
    return out.orderBy(F.desc("is_valid_row"), "page_id") if ordered else out


def evaluate_records(
    rows: DataFrame,
    contracts: quality.Contracts,
    label: str,
    id_col: str,
    source: str = "profile",
    history: DataFrame | None = None,
    run_timestamp: Column | None = None,
    with_drift: bool = True,
) -> DataFrame:
    """Q11: gate, score and drift for rows that were never a page.

    Observations are kept under `label:field`. Without drift the job is map-only.
    """
    gated = quality.gate_rows(rows, contracts, source).withColumn(
        "run_timestamp", F.current_timestamp() if run_timestamp is None else run_timestamp
    )
    if not with_drift:
        return gated
    return _attach_drift(gated, id_col, list(contracts), label, history)
