"""Readers, writers, streaming and the driver contract."""

import json

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from enrichlake.operators import bronze
from enrichlake.plans import pages as plan
from enrichlake.sources import readers, writers
from enrichlake.streaming.gate import gate_stream

PAGE = "Acme Corp is a software company with many happy clients in the whole world and more words to come here."


def write(path, text):
    path.write_text(text if isinstance(text, str) else json.dumps(text), encoding="utf-8")


def test_scrape_json(spark, tmp_path):
    write(tmp_path / "a.json", {"markdown": "m1", "metadata": {"sourceURL": "u1"}})
    write(tmp_path / "b.json", {"data": {"markdown": "m2", "metadata": {"sourceURL": "", "url": "u2"}}})
    write(tmp_path / "c.json", {"markdown": "m3", "data": [1], "sourceURL": "u3"})
    write(tmp_path / "d.json", {"markdown": None})
    got = sorted((r["markdown"] or "", r["source_url"]) for r in readers.read_scrape_json(spark, f"{tmp_path}/*.json").collect())
    assert got == [("", None), ("m1", "u1"), ("m2", "u2"), ("m3", "u3")]


def test_record_export(spark, tmp_path):
    for i, doc in enumerate(([{"n": 1}, {"n": 2}], {"items": [{"n": 3}]}, {"data": [{"n": 4}]}, {"n": 5}, {"items": [], "data": [{"n": 9}]}, [])):
        write(tmp_path / f"{i}.json", doc)
    got = readers.read_record_export(spark, f"{tmp_path}/*.json").select(F.try_variant_get("raw", "$.n", "int").alias("n")).collect()
    assert sorted(r["n"] for r in got) == [1, 2, 3, 4, 5]
    (tmp_path / "lines").mkdir()
    write(tmp_path / "lines" / "x.jsonl", '{"n":7}\n\n[{"n":8}]\n')
    lines = readers.read_record_export(spark, f"{tmp_path}/lines", lines=True).select(F.try_variant_get("raw", "$.n", "int").alias("n"))
    assert sorted(r["n"] for r in lines.collect()) == [7, 8]
    write(tmp_path / "bad.json", "5")
    with pytest.raises(Exception, match="expected a JSON array"):
        readers.read_record_export(spark, f"{tmp_path}/bad.json").collect()
    write(tmp_path / "bad2.json", '{"items": 5}')
    with pytest.raises(Exception, match="expected a JSON array"):
        readers.read_record_export(spark, f"{tmp_path}/bad2.json").collect()


def test_spine_and_contact_csv(spark, tmp_path):
    write(tmp_path / "s.csv", "company_id,name,domain,linkedin_url\n1,A,a.com,u\n")
    assert readers.read_spine_csv(spark, f"{tmp_path}/s.csv").count() == 1
    with pytest.raises(ValueError, match="profile_id"):
        readers.read_spine_csv(spark, f"{tmp_path}/s.csv", bronze.PERSON_SPINE)
    write(tmp_path / "c.csv", 'email,note\nx@y.z,"one, two"\n')
    row = readers.read_contact_csv(spark, f"{tmp_path}/c.csv").first().asDict()
    assert row == {"email": "x@y.z", "email_source": "contact", "note": "one, two", "note_source": "contact"}


def test_icp_folder(spark, tmp_path):
    write(tmp_path / "b.json", {"client_id": "b", "name": "B", "industries": ["Banking"]})
    write(tmp_path / "a.json", {"client_id": "a", "name": "A"})
    assert [r["client_id"] for r in readers.read_icp_specs(spark, str(tmp_path)).collect()] == ["a", "b"]
    write(tmp_path / "aa.json", {"client_id": "", "limit": -1})
    write(tmp_path / "z.json", {})
    with pytest.raises(ValueError, match="aa.json: client_id: required but missing; name: required but missing; limit"):
        readers.read_icp_specs(spark, str(tmp_path))


def test_sinks(spark, tmp_path):
    pages = spark.createDataFrame([(1, PAGE, "https://a.com"), (2, PAGE, None), (3, "", "https://c.com")], "page_id long, markdown string, source_url string")
    plan.gate_pages(pages).write.parquet(f"{tmp_path}/rows")
    rows = spark.read.parquet(f"{tmp_path}/rows")
    writers.append_dead_letter(rows, f"{tmp_path}/dead")
    writers.append_dead_letter(rows, f"{tmp_path}/dead")
    dead = spark.read.json(f"{tmp_path}/dead")
    assert dead.count() == 4 and {tuple(r["reasons"])[0] for r in dead.collect()} == {"domain_normalize: required but missing", "empty_response"}
    assert {r["raw_input"] for r in dead.collect()} == {PAGE, ""}
    writers.append_quality_history(plan.observations(rows, "page_id"), f"{tmp_path}/history")
    history = spark.read.parquet(f"{tmp_path}/history")
    assert history.count() == 28 and history.where("field = 'business_model'").count() == 2
    writers.write_flat_csv(rows.drop("raw_markdown_input"), f"{tmp_path}/csv")
    flat = spark.read.csv(f"{tmp_path}/csv", header=True, escape='"').where("page_id = 1").first()
    assert json.loads(flat["company_entity_resolve"])["company_id"] == "a-com" and flat["is_valid_row"] == "true"
    # A later batch continues the history of the first.
    again = plan.process_batch(pages, history=history, run_timestamp=F.lit("2099-01-01").cast("timestamp"))
    assert again.count() == 3


def test_bronze_step_replaces_only_its_own_folder(spark, tmp_path):
    spine = spark.createDataFrame([("1", "n", "d", "u", "{}")], "company_id string, name string, domain string, linkedin_url string, raw string")
    for client in ("a", "b", "a"):
        writers.write_bronze_step(spine, f"{tmp_path}/b", client, "scrape", bronze.COMPANY_SPINE, "raw")
    got = spark.read.parquet(f"{tmp_path}/b")
    assert sorted(r["client_id"] for r in got.collect()) == ["a", "b"] and set(got.columns) == {*bronze.COMPANY_SPINE, "raw", "client_id", "step"}


def test_stream_equals_batch(spark, tmp_path):
    schema = "page_id long, markdown string, source_url string"
    pages = spark.createDataFrame([(i, PAGE if i % 3 else "", f"https://s{i}.com") for i in range(12)], schema)
    pages.repartition(3).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 2).parquet(f"{tmp_path}/in")
    gate_stream(stream, f"{tmp_path}/out", f"{tmp_path}/ck").awaitTermination()
    columns = ["page_id", "is_valid_row", "quality_score", "domain_normalize"]
    streamed = spark.read.parquet(f"{tmp_path}/out/rows").select(*columns)
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, plan.gate_pages(pages).select(*columns).collect()))
    assert spark.read.parquet(f"{tmp_path}/out/history").count() == 8 * 14
    assert spark.read.json(f"{tmp_path}/out/dead_letter").count() == 4


def test_driver_contract(spark):
    queries, sql = entry.queries(), entry.oracle_sql()
    assert len(queries) > 90 and set(sql) <= set(queries)
    assert entry.entry(spark).count() > 0
