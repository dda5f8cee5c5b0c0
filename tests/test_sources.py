"""File sources: header-aware CSV rescue, JSON rescue, evolution modes, options."""

from __future__ import annotations

import datetime as dt
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.plans import staging as S
from tessera.session import fs_write_text
from tessera.sources import files as SF
from tessera.sources import rescue as R

SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("amount", T.DecimalType(10, 2)),
        T.StructField("day", T.StringType()),
    ]
)


@pytest.fixture()
def csv_dir(spark, tmp):
    # file 1: BOM + declared header, a quoted comma
    fs_write_text(spark, f"{tmp}/a.csv", "\ufeffid,name,amount,day\n1,Ann,10.50,1/2/2024\n2,\"Lee, Bo\",20.00,1/3/2024\n")
    # file 2: two unknown columns, one short row, one non-numeric amount
    fs_write_text(
        spark,
        f"{tmp}/b.csv",
        "id,name,amount,day,bonus,region\n3,Cy,30.00,1/4/2024,5,EU\n4,Di,40.00\n5,Ed,abc,1/6/2024,,US\n",
    )
    return tmp


def test_rescue_csv_by_header(spark, csv_dir):
    out = {r["id"]: r for r in R.read_csv_rescued(spark, csv_dir, SCHEMA).collect()}
    assert set(out) == {"1", "2", "3", "4", "5"}
    assert out["2"]["name"] == "Lee, Bo" and out["2"]["_rescued_data"] is None
    assert out["1"]["_corrupt_record"] is None
    assert out["3"]["_rescued_data"] == '{"bonus":"5","region":"EU"}'
    assert out["4"]["_corrupt_record"] == "4,Di,40.00"  # short row
    assert out["4"]["amount"] is not None
    # a value that does not cast is rescued, the typed column is NULL
    assert out["5"]["amount"] is None and out["5"]["_rescued_data"] == '{"amount":"abc","region":"US"}'


def test_evolution_modes(spark, csv_dir, tmp):
    add, schema = R.read_csv_evolving(spark, csv_dir, SCHEMA, "addNewColumns", schema_location=f"{tmp}/schema")
    assert schema.fieldNames()[-2:] == ["bonus", "region"]
    assert {r["id"]: r["region"] for r in add.collect()}["3"] == "EU"
    # the evolved schema is remembered for the next run
    _, again = R.read_csv_evolving(spark, csv_dir, SCHEMA, "none", schema_location=f"{tmp}/schema")
    assert again.fieldNames() == schema.fieldNames()
    none, s2 = R.read_csv_evolving(spark, csv_dir, SCHEMA, "none")
    assert s2.fieldNames() == SCHEMA.fieldNames() and "_rescued_data" not in none.columns
    resc, _ = R.read_csv_evolving(spark, csv_dir, SCHEMA, "rescue")
    assert "_rescued_data" in resc.columns
    with pytest.raises(R.SchemaEvolutionError):
        R.read_csv_evolving(spark, csv_dir, SCHEMA, "failOnNewColumns")


def test_rescue_json(spark):
    df = spark.createDataFrame([(1, '{"k": 69, "tag": "a"}'), (2, '{"tag": "b"}'), (3, None)], "id int, j string")
    out = {r["id"]: r for r in R.with_rescued_json(df, "j", T.StructType([T.StructField("tag", T.StringType())]), keep=["id"]).collect()}
    assert out[1]["tag"] == "a" and out[1]["_rescued_data"] == '{"k":"69"}'
    assert out[2]["_rescued_data"] is None and out[3]["tag"] is None


def test_rescue_json_keeps_malformed_text(spark):
    bad = ['{"tag": "a", "k": ', "not json", "[1, 2]", "", "null", '{"tag": "a"} {"k": 1}', '{"tag": "a", "k": 1}x', '{"tag": "a"}}', '{"tag": "a"}] x', '{"tag": "a"},{"k": 1}']
    good = ['{"tag": "b"}', ' {"tag": "b", "k": {"x": [1]}} ', "{}", None]
    df = spark.createDataFrame(list(enumerate(bad + good)), "id int, j string")
    schema = T.StructType([T.StructField("tag", T.StringType())])
    out = {r["id"]: r for r in R.with_rescued_json(df, "j", schema, keep=["id"]).collect()}
    assert [out[i]["_corrupt_record"] for i in range(len(bad))] == bad
    assert all(out[i]["tag"] is None and out[i]["_rescued_data"] is None for i in range(len(bad)))
    assert all(out[i]["_corrupt_record"] is None for i in range(len(bad), len(out)))
    assert [out[len(bad) + i]["tag"] for i in range(4)] == ["b", "b", None, None]
    one = {r["id"]: r for r in R.with_rescued_json(df, "j", schema, keep=["id"], corrupt_col=None).collect()}
    assert [one[i]["_rescued_data"] for i in range(len(bad))] == bad and one[len(out) - 1]["_rescued_data"] is None
    assert one[len(bad) + 1]["_rescued_data"] == '{"k":"{\\"x\\":[1]}"}'


def test_infer_with_hints(spark, csv_dir, tmp):
    s = R.infer_schema(spark, f"{csv_dir}/a.csv", hints="amount DECIMAL(12,2), extra INT", schema_location=f"{tmp}/inf")
    assert s["amount"].dataType == T.DecimalType(12, 2)
    assert s["extra"].dataType == T.IntegerType()
    assert R.infer_schema(spark, f"{csv_dir}/a.csv", schema_location=f"{tmp}/inf") == s  # cached


def test_permissive_dropmalformed_failfast(spark, tmp):
    fs_write_text(spark, f"{tmp}/x/a.csv", "1,a,10.50\n2,b,20.00,EXTRA\n3,c\n")
    schema = T.StructType([*SCHEMA.fields[:3], T.StructField("_corrupt_record", T.StringType())])
    perm = SF.file_scan(spark, f"{tmp}/x", "csv", schema, mode="PERMISSIVE", corrupt_col="_corrupt_record").collect()
    assert sum(r["_corrupt_record"] is not None for r in perm) == 2
    drop = SF.file_scan(spark, f"{tmp}/x", "csv", T.StructType(SCHEMA.fields[:3]), mode="DROPMALFORMED").collect()
    assert [r["id"] for r in drop] == ["1"]
    with pytest.raises(Exception, match="Malformed|MALFORMED"):
        SF.file_scan(spark, f"{tmp}/x", "csv", T.StructType(SCHEMA.fields[:3]), mode="FAILFAST").collect()


def test_option_rules():
    assert SF.parse_bytes("10g") == 10 * 1024**3
    assert SF.parse_bytes("512m") == 512 * 1024**2
    assert SF.parse_bytes(1234) == 1234
    assert SF.reprocess_lower_bound(0) == "2024-01-01T00:00:00"
    assert SF.reprocess_lower_bound(3, dt.datetime(2025, 5, 10, 13, 0)) == "2025-05-07T00:00:00"
    with pytest.raises(ValueError):
        SF.file_stream(None, "/x", "csv", SCHEMA, max_files=2, max_bytes="10g")


def test_new_files_only_survives_restart(spark, tmp):
    from tessera.sinks.tables import append_table, run_to_completion

    fs_write_text(spark, f"{tmp}/in/old/a.csv", "id,name,amount,day\n1,a,1.00,x\n")
    S.set_mtime(spark, f"{tmp}/in/old", dt.datetime(2001, 1, 1))

    def run():
        s = SF.csv_stream(spark, f"{tmp}/in", SCHEMA, recursive=True, include_existing=False, state_dir=f"{tmp}/ck")
        run_to_completion(append_table(s, f"{tmp}/out", f"{tmp}/ck"))

    run()
    fs_write_text(spark, f"{tmp}/in/new/b.csv", "id,name,amount,day\n2,b,2.00,y\n")
    run()
    assert [r["id"] for r in spark.read.parquet(f"{tmp}/out").collect()] == ["2"]


def test_rate_limit_makes_several_batches(spark, tmp):
    from tessera.sinks.tables import append_table, run_to_completion

    for i in range(6):
        fs_write_text(spark, f"{tmp}/in/f{i}.csv", f"id,name,amount,day\n{i},n,1.00,d\n")
    s = SF.csv_stream(spark, f"{tmp}/in", SCHEMA, max_files=2)
    q = run_to_completion(append_table(s, f"{tmp}/out", f"{tmp}/ck"))
    assert len([p for p in q.recentProgress if p.numInputRows > 0]) == 3
    assert spark.read.parquet(f"{tmp}/out").count() == 6


def test_compaction_keeps_the_partition_layout(spark, tmp):
    import glob

    from tessera.sinks.tables import clustered_write, compact

    rows = spark.range(20_000).select(F.col("id"), (F.col("id") % 2).alias("p"), F.sha2(F.col("id").cast("string"), 256).alias("t"))
    rows.repartition(8).write.partitionBy("p").parquet(f"{tmp}/small")
    dest = compact(spark, f"{tmp}/small", out_path=f"{tmp}/big", partition_by=["p"])
    assert len(glob.glob(f"{dest}/p=*/*.parquet")) == 2
    assert spark.read.parquet(dest).agg(F.sum("id"), F.sum("p")).first() == rows.agg(F.sum("id"), F.sum("p")).first()
    # without partitions, files follow the size of the whole tree
    spread = compact(spark, f"{tmp}/small", target_bytes=300_000, out_path=f"{tmp}/spread")
    assert len(glob.glob(f"{spread}/*.parquet")) > 2
    # clustered files cover ranges that do not overlap
    more = spark.range(150_000).select(F.sha2(F.col("id").cast("string"), 256).alias("t"))
    clustered_write(more, ["t"], f"{tmp}/clustered", target_file_bytes=2_000_000)
    files = spark.read.parquet(f"{tmp}/clustered").groupBy(F.input_file_name().alias("f")).agg(F.min("t").alias("lo"), F.max("t").alias("hi"))
    got = sorted((r["lo"], r["hi"]) for r in files.collect())
    assert len(got) > 1 and all(a[1] < b[0] for a, b in zip(got, got[1:]))


def test_a_curve_skips_files_for_each_column(spark, tmp):
    """Files that min/max statistics leave for a filter: the curve keeps few on every column, plain order on the first only."""
    import datetime as dt

    from tessera.sinks.tables import clustered_write

    rows = spark.range(20000).select(
        F.concat(F.lit("D"), F.lpad((F.xxhash64("id") % 50 + 50).cast("string"), 3, "0")).alias("dept"),
        F.date_add(F.lit(dt.date(2000, 1, 1)), (F.xxhash64(F.col("id") + 1) % 1000).cast("int")).alias("day"),
        F.when(F.col("id") % 97 != 0, F.xxhash64(F.col("id") + 2) % 10000).alias("pay"),
    )
    rows.write.parquet(f"{tmp}/rows")
    rows = spark.read.parquet(f"{tmp}/rows")
    cols = ["dept", "day", "pay"]
    left = {}
    for curve in (False, True):
        with _partitions(spark, 64):
            clustered_write(rows, cols, f"{tmp}/{curve}", curve=curve)
        back = spark.read.parquet(f"{tmp}/{curve}")
        assert back.columns == rows.columns and back.count() == 20000 and back.exceptAll(rows).isEmpty()
        files = back.groupBy(F.input_file_name().alias("f")).agg(*[f(c).alias(f"{n}_{c}") for c in cols for n, f in (("lo", F.min), ("hi", F.max))]).collect()
        assert len(files) > 40
        middle = rows.select(*[F.percentile_approx(F.col(c) if c != "dept" else F.lit(1), 0.5).alias(c) for c in cols]).first()
        want = {"dept": "D070", "day": middle["day"], "pay": middle["pay"]}
        left[curve] = {c: sum(f[f"lo_{c}"] <= want[c] <= f[f"hi_{c}"] for f in files) / len(files) for c in cols}
    assert all(share <= 0.45 for share in left[True].values()), left
    assert left[False]["day"] > 0.9 and left[False]["pay"] > 0.9


def test_curve_of_odd_columns(spark, tmp):
    from tessera.sinks.tables import clustered_write

    rows = spark.createDataFrame([(None, None), ("same", 1.5), ("same", None), ("sameer", float("nan"))], "a string, b double")
    clustered_write(rows, ["a", "b"], f"{tmp}/t", curve=True)
    assert sorted(map(str, spark.read.parquet(f"{tmp}/t").collect())) == sorted(map(str, rows.collect()))
    clustered_write(rows.limit(0), ["a", "b"], f"{tmp}/e", curve=True)
    assert spark.read.schema(rows.schema).parquet(f"{tmp}/e").count() == 0


@contextmanager
def _partitions(spark, n):
    """Exactly ``n`` shuffle partitions, small as they are."""
    conf = {"spark.sql.shuffle.partitions": str(n), "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
