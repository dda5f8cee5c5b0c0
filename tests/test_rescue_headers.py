"""Rescued CSV: headers in any order, files without one; complete stream metrics."""

from __future__ import annotations

from pyspark.sql import types as T

from tessera.session import fs_write_text
from tessera.sources.files import csv_stream
from tessera.sources.rescue import infer_schema, read_csv_rescued, rescue_csv_stream
from tessera.streaming.metrics import append_with_counts, expectation_totals

SCHEMA = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType())])
WANT = {(1, "a", None, None), (2, "b", None, None), (3, "id", None, None), (None, None, None, "7,x"), (None, None, None, "8,y"), (4, "c", '{"more":"z"}', None)}


def _files(spark, base):
    fs_write_text(spark, f"{base}/a.csv", "id,name\n1,a\n")
    fs_write_text(spark, f"{base}/b.csv", "name,id\nb,2\nid,3\n")
    fs_write_text(spark, f"{base}/c.csv", "7,x\n8,y\n")
    fs_write_text(spark, f"{base}/d.csv", "more,name,id\nz,c,4\n")


def test_headers_in_any_order_and_files_without(spark, tmp):
    _files(spark, f"{tmp}/in")
    assert {tuple(r) for r in read_csv_rescued(spark, f"{tmp}/in", SCHEMA).collect()} == WANT
    fs_write_text(spark, f"{tmp}/bare/c.csv", "7,x\n8,y\n")
    assert {r["_corrupt_record"] for r in read_csv_rescued(spark, f"{tmp}/bare", SCHEMA).collect()} == {"7,x", "8,y"}


def test_the_same_as_a_stream(spark, tmp):
    _files(spark, f"{tmp}/in")
    rescue_csv_stream(spark, f"{tmp}/in", SCHEMA, f"{tmp}/out", f"{tmp}/ck", max_files=1).awaitTermination()
    got = spark.read.parquet(f"{tmp}/out").select("id", "name", "_rescued_data", "_corrupt_record").collect()
    assert {tuple(r) for r in got} == WANT


def test_a_repeated_header_name_is_rescued(spark, tmp):
    fs_write_text(spark, f"{tmp}/in/a.csv", "id,name,name,id\n1,a,b,9\n2,c,,\n")
    got = {tuple(r) for r in read_csv_rescued(spark, f"{tmp}/in", SCHEMA).select("id", "name", "_rescued_data").collect()}
    assert got == {(1, "a", '{"name#3":"b","id#4":"9"}'), (2, "c", None)}


def test_primary_track_keeps_what_the_schema_lacks(spark, tmp):
    from tessera.plans import fixtures as X
    from tessera.plans import flows

    names = [f.name for f in X.RAW_SCHEMA if f.name != "_corrupt_record"]
    values = {"empid": "E1", "name": "Ann", "dob": "1/15/1990", "salary": "75000.00", "joining_date": "3/1/2020", "dept_id": "D01", "create_tmst": "1/1/2024", "upd_tmst": "6/1/2024"}
    turned = [names[0], *reversed(names[1:])]
    for file, head, more in (("a", names, []), ("deep/b", turned, ["badge"])):
        row = [values.get(n, "") if n != names[0] else file[-1] for n in head]
        fs_write_text(spark, f"{tmp}/in/{file}.csv", ",".join([*head, *more]) + "\n" + ",".join([*row, *["B7"] * len(more)]) + "\n" + "short,1\n")
    fs_write_text(spark, f"{tmp}/in/skip.txt", "no table\n")
    gold = flows.run_primary(spark, f"{tmp}/in", X.RAW_SCHEMA, X.SILVER_SCHEMA, f"{tmp}/t", as_of=X.AS_OF, glob="*.csv", recursive=True)
    raw = spark.read.parquet(f"{tmp}/t/raw")
    assert raw.filter("_rescued_data is not null").select("_rescued_data").first()[0] == '{"badge":"B7"}'
    assert [r[0] for r in raw.select("_corrupt_record").filter("_corrupt_record is not null").collect()] == ["short,1"] * 2
    assert raw.count() == 4 and sorted(r[names[0]] for r in gold.collect()) == ["a", "b"]


def test_inference_sees_every_file(spark, tmp):
    for i, v in enumerate(["1", "2", "abc"]):
        fs_write_text(spark, f"{tmp}/in/{i}.csv", f"v\n{v}\n")
    assert infer_schema(spark, f"{tmp}/in").fields[0].dataType == T.StringType()


def test_counts_outlive_progress_reports(spark, tmp):
    for i in range(6):
        fs_write_text(spark, f"{tmp}/in/{i}.csv", f"id,name\n{i},a\n{i},\n")
    old = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "3")
    try:
        src = csv_stream(spark, f"{tmp}/in", SCHEMA, max_files=1)
        append_with_counts(src, {"named": "name is not null"}, f"{tmp}/out", f"{tmp}/counts", f"{tmp}/ck").awaitTermination()
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", old)
    assert [tuple(r) for r in expectation_totals(spark, f"{tmp}/counts").collect()] == [("named", 6, 6)]
    assert spark.read.parquet(f"{tmp}/out").count() == 12
