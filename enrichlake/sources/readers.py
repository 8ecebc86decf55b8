"""Readers. Schemas are explicit; only the contact CSV takes its header as it is."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as t
from ..functions.profiles import as_text
from ..operators.bronze import COMPANY_SPINE, require_columns
from ..operators.icp import icp_violations, parse_icp

def _documents(spark: SparkSession, path: str, lines: bool) -> DataFrame:
    """JSON texts: one per line (splittable, for bulk data) or one per file, which is then read whole by a task."""
    if lines:
        return spark.read.text(path).where(F.trim("value") != "").select("value", F.col("_metadata.file_path").alias("file"))
    docs = spark.read.text(path, wholetext=True)
    return docs.select("value", F.col("_metadata.file_path").alias("file"))


def scrape_payload(doc: Column) -> list[Column]:
    """Markdown and source URL of a scrape response (VARIANT), nested under `data` or not."""
    data = F.try_variant_get(doc, "$.data", "variant")
    nested = F.startswith(F.schema_of_variant(data), F.lit("OBJECT"))
    payload = F.when(nested, data).otherwise(doc)
    url = F.coalesce(
        *[t.blank_to_null(as_text(payload, p)) for p in ("$.metadata.sourceURL", "$.metadata.url", "$.sourceURL")]
    )
    return [as_text(payload, "$.markdown").alias("markdown"), url.alias("source_url")]


def read_scrape_json(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Pages (page_id, markdown, source_url) out of scrape responses.

    `page_id` is a hash of file and response, so it stays the same however often and in whatever order files are
    read. Equal responses of one file are one page to the jobs behind.
    """
    docs = _documents(spark, path, lines).withColumn("doc", F.parse_json("value"))
    return docs.select(F.xxhash64("file", "value").alias("page_id"), *scrape_payload(F.col("doc")), "file")


def explode_records(docs: DataFrame, raw: str = "value") -> DataFrame:
    """S3 on JSON texts: one VARIANT `raw` per record, with its position.

    A bare array, `items`, `data` or a single object; a present but empty `items`
    gives no record. Any other JSON stops the job.
    """
    doc = F.parse_json(F.col(raw))

    def present(name: str) -> Column:
        v = F.try_variant_get(doc, f"$.{name}", "variant")
        return F.when(~F.is_variant_null(v), v)

    kind = F.schema_of_variant(doc)
    holder = (
        F.when(F.startswith(kind, F.lit("ARRAY")), doc)
        .when(present("items").isNotNull(), present("items"))
        .when(present("data").isNotNull(), present("data"))
    )
    is_object = F.startswith(kind, F.lit("OBJECT"))
    held = docs.withColumns({"_holder": holder, "_doc": doc, "_object": is_object})
    error = F.raise_error(F.lit("expected a JSON array of records, an object with items or data, or one record"))
    records = (
        F.when(F.startswith(F.schema_of_variant(F.col("_holder")), F.lit("ARRAY")), F.try_variant_get(F.col("_holder"), "$", "array<variant>"))
        .when(F.col("_holder").isNull() & F.col("_object"), F.array("_doc"))
        .otherwise(error.cast("array<variant>"))
    )
    keep = [c for c in docs.columns if c != raw]
    return held.select(*keep, F.posexplode(records).alias("pos", "raw"))


def read_record_export(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """S3: profile records (raw VARIANT, pos, file) of JSON exports."""
    return explode_records(_documents(spark, path, lines))


def _csv(spark: SparkSession, path: str, quoted_breaks: bool) -> DataFrame:
    """Text columns by their header. A file whose quoted cells hold line breaks has to be read by one task; bulk
    exports without any are read in splits (`quoted_breaks=False`)."""
    return spark.read.csv(path, header=True, multiLine=quoted_breaks, quote='"', escape='"')


def read_spine_csv(
    spark: SparkSession, path: str, required: Sequence[str] = COMPANY_SPINE, quoted_breaks: bool = True
) -> DataFrame:
    """Identity spine of one client; missing columns are named in the error."""
    return require_columns(_csv(spark, path, quoted_breaks), required)


def read_icp_specs(spark: SparkSession, path: str, industries: Sequence[str] | None = None) -> DataFrame:
    """All profiles of a folder in file-name order, typed.

    The first invalid file stops the run with all of its violations. Profiles are
    configuration, one small file per client, so the check is made up front.
    """
    docs = _documents(spark, f"{path.rstrip('/')}/*.json", lines=False).withColumnRenamed("value", "raw")
    checked = docs.withColumn("violations", icp_violations(F.parse_json("raw"), industries))
    first_bad = checked.where(F.size("violations") > 0).orderBy("file").select("file", "violations").first()
    if first_bad is not None:
        raise ValueError(f"{first_bad['file']}: " + "; ".join(first_bad["violations"]))
    return parse_icp(docs.orderBy("file"))


def read_contact_csv(spark: SparkSession, path: str, source: str = "contact", quoted_breaks: bool = True) -> DataFrame:
    """Every column as text, each with a `<column>_source` tag."""
    contacts = _csv(spark, path, quoted_breaks)
    return contacts.select(*[x for c in contacts.columns for x in (F.col(f"`{c}`"), F.lit(source).alias(f"{c}_source"))])
