"""Fixture views derived from the driver's tables, in Spark and in DuckDB SQL.

* ``staff_raw``  — employee-shaped raw feed (string dates, planted faults) from ``orders``
* ``staff``      — its good rows, typed
* ``changes``    — a change log over ``events``
* ``snapshots``  — two versions of one table from ``customer`` / ``supplier``

Every view grows with its source table; nothing is made up or capped.
``AS_OF`` pins current_date() so results are reproducible.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.quality import EMPLOYEE_DATE_FORMATS, enforce_schema, good_rows

AS_OF = "2001-12-15"

RAW_SCHEMA = T.StructType(
    [
        T.StructField("empid", T.StringType()),
        T.StructField("empname", T.StringType()),
        T.StructField("dob", T.StringType()),
        T.StructField("salary", T.DecimalType(10, 2)),
        T.StructField("joining_date", T.StringType()),
        T.StructField("dept_id", T.StringType()),
        T.StructField("create_tmst", T.StringType()),
        T.StructField("upd_tmst", T.StringType()),
        T.StructField("_corrupt_record", T.StringType()),
    ]
)
SILVER_SCHEMA = T.StructType(
    [
        T.StructField("empid", T.StringType()),
        T.StructField("empname", T.StringType()),
        T.StructField("dob", T.DateType()),
        T.StructField("salary", T.DecimalType(10, 2)),
        T.StructField("joining_date", T.DateType()),
        T.StructField("dept_id", T.StringType()),
        T.StructField("create_tmst", T.DateType()),
        T.StructField("upd_tmst", T.DateType()),
    ]
)
SILVER_COLUMNS = [f.name for f in SILVER_SCHEMA.fields]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table: the plain scan, so that filters and column pruning reach Parquet."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _mdy(c):
    return F.date_format(c, "M/d/yyyy")


def staff_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """row_id + the 8 raw employee columns (strings, decimal salary)."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    d = F.col("o_orderdate").cast("date")
    return o.select(
        k.alias("row_id"),
        F.when(k % 113 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("E"), F.col("o_custkey").cast("string"))).alias("empid"),
        F.concat(F.lit("Order "), k.cast("string")).alias("empname"),
        F.when(k % 101 == 0, F.lit(None).cast("string"))
        .when(k % 103 == 0, F.lit("not-a-date"))
        .otherwise(_mdy(F.add_months(d, (F.lit(-12) * (F.lit(18) + k % 45)).cast("int"))))
        .alias("dob"),
        F.when(k % 107 == 0, F.lit(0).cast("decimal(10,2)"))
        .when(k % 109 == 0, F.lit(None).cast("decimal(10,2)"))
        .otherwise(F.col("o_totalprice").cast("decimal(10,2)"))
        .alias("salary"),
        _mdy(d).alias("joining_date"),
        F.when(k % 17 == 0, F.lit(None).cast("string"))
        .when(k % 13 == 0, F.lit("X99"))
        .otherwise(F.concat(F.lit("D00"), (k % 8).cast("string")))
        .alias("dept_id"),
        F.when(k % 97 == 0, F.lit("11/2020/2019")).otherwise(_mdy(d)).alias("create_tmst"),
        _mdy(F.date_add(d, (k % 400).cast("int"))).alias("upd_tmst"),
    )


def staff_enforced(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    return enforce_schema(staff_raw(spark, sf_dir), SILVER_SCHEMA, EMPLOYEE_DATE_FORMATS, keep=["row_id"], **kw)


def staff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good rows of ``staff_raw``, typed (silver)."""
    return good_rows(staff_enforced(spark, sf_dir))


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change log over events: key user_id, sequence (ts, event_id).

    signup → insert, error → delete, purchase → update_preimage, others →
    update_postimage; commit = event_id div 2 (two rows per commit, so the
    commit-timestamp window has a fixed, tiny group size).
    """
    e = table(spark, sf_dir, "events")
    et = F.col("event_type")
    ct = (
        F.when(et == "signup", F.lit("insert"))
        .when(et == "error", F.lit("delete"))
        .when(et == "purchase", F.lit("update_preimage"))
        .otherwise(F.lit("update_postimage"))
    )
    v = F.floor(F.col("event_id") / 2).cast("bigint")
    return (
        e.withColumn("_change_type", ct)
        .withColumn("_commit_version", v)
        .withColumn("_commit_timestamp", F.max("ts").over(Window.partitionBy("_commit_version")))
    )


def snapshot_old(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("bal"))


def snapshot_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    s = table(spark, sf_dir, "supplier")
    kept = c.filter(F.col("c_custkey") % 10 != 0).select(
        F.col("c_custkey").alias("k"),
        F.col("c_name").alias("name"),
        F.when(F.col("c_custkey") % 10 == 1, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal")).alias("bal"),
    )
    added = s.select(
        (F.col("s_suppkey") + F.lit(100000000)).alias("k"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("bal")
    )
    return kept.unionByName(added)


# ------------------------------------------------------------------ DuckDB
MDY = "'%-m/%-d/%Y'"


def _sql_mdy(e: str) -> str:
    return f"strftime({e}, {MDY})"


SQL_STAFF_RAW = f"""staff_raw AS (
  SELECT o_orderkey AS row_id,
    CASE WHEN o_orderkey % 113 = 0 THEN NULL ELSE concat('E', CAST(o_custkey AS VARCHAR)) END AS empid,
    concat('Order ', CAST(o_orderkey AS VARCHAR)) AS empname,
    CASE WHEN o_orderkey % 101 = 0 THEN NULL WHEN o_orderkey % 103 = 0 THEN 'not-a-date'
         ELSE {_sql_mdy("CAST(o_orderdate AS DATE) - to_years(CAST(18 + o_orderkey % 45 AS INTEGER))")} END AS dob,
    CASE WHEN o_orderkey % 107 = 0 THEN CAST(0 AS DECIMAL(10,2)) WHEN o_orderkey % 109 = 0 THEN NULL
         ELSE CAST(o_totalprice AS DECIMAL(10,2)) END AS salary,
    {_sql_mdy("CAST(o_orderdate AS DATE)")} AS joining_date,
    CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 13 = 0 THEN 'X99'
         ELSE concat('D00', CAST(o_orderkey % 8 AS VARCHAR)) END AS dept_id,
    CASE WHEN o_orderkey % 97 = 0 THEN '11/2020/2019' ELSE {_sql_mdy("CAST(o_orderdate AS DATE)")} END AS create_tmst,
    {_sql_mdy("CAST(o_orderdate AS DATE) + CAST(o_orderkey % 400 AS INTEGER)")} AS upd_tmst
  FROM orders)"""


def _sql_parse(c: str) -> str:
    return f"CAST(try_strptime({c}, {MDY}) AS DATE)"


def sql_enforced(src: str, name: str, keep: tuple[str, ...] = ("row_id",)) -> str:
    """CTEs ``{name}`` = enforcement of ``src``: typed columns, rescue_* and _is_bad."""
    k = ", ".join(keep)
    dates = ["dob", "joining_date", "create_tmst", "upd_tmst"]
    fails = " OR ".join(f"(src_{c} IS NOT NULL AND {c} IS NULL)" for c in dates)
    rescue = ", ".join(
        f"CASE WHEN src_{c} IS NOT NULL AND {c} IS NULL THEN src_{c} END AS rescue_{c}" for c in dates
    )
    return f"""{name}_cast AS (
  SELECT {k}, empid, empname,
    {_sql_parse("dob")} AS dob, salary, {_sql_parse("joining_date")} AS joining_date, dept_id,
    {_sql_parse("create_tmst")} AS create_tmst, {_sql_parse("upd_tmst")} AS upd_tmst,
    dob AS src_dob, joining_date AS src_joining_date, create_tmst AS src_create_tmst, upd_tmst AS src_upd_tmst
  FROM {src}),
{name} AS (
  SELECT {k}, empid, empname, dob, salary, joining_date, dept_id, create_tmst, upd_tmst,
    CAST(NULL AS VARCHAR) AS rescue_empid, CAST(NULL AS VARCHAR) AS rescue_empname, CAST(NULL AS DOUBLE) AS rescue_salary,
    CAST(NULL AS VARCHAR) AS rescue_dept_id, {rescue},
    ({fails}) AS _is_bad
  FROM {name}_cast)"""


SQL_STAFF_CAST = sql_enforced("staff_raw", "staff_enforced") + """,
staff AS (
  SELECT row_id, empid, empname, dob, salary, joining_date, dept_id, create_tmst, upd_tmst
  FROM staff_enforced WHERE NOT _is_bad)"""

SQL_CHANGES = """changes AS (
  SELECT *,
    CASE event_type WHEN 'signup' THEN 'insert' WHEN 'error' THEN 'delete'
         WHEN 'purchase' THEN 'update_preimage' ELSE 'update_postimage' END AS _change_type,
    CAST(event_id // 2 AS BIGINT) AS _commit_version,
    max(ts) OVER (PARTITION BY event_id // 2) AS _commit_timestamp
  FROM events)"""

SQL_SNAPSHOTS = """snap_old AS (
  SELECT c_custkey AS k, c_name AS name, c_acctbal AS bal FROM customer),
snap_new AS (
  SELECT c_custkey AS k, c_name AS name,
         CASE WHEN c_custkey % 10 = 1 THEN c_acctbal + 1 ELSE c_acctbal END AS bal
  FROM customer WHERE c_custkey % 10 <> 0
  UNION ALL
  SELECT s_suppkey + 100000000 AS k, s_name AS name, s_acctbal AS bal FROM supplier)"""


def with_ctes(*ctes: str) -> str:
    """``WITH`` clause from CTE bodies (each ``name AS (...)``)."""
    return "WITH " + ",\n".join(ctes) + "\n"


STAFF_CTES = (SQL_STAFF_RAW, SQL_STAFF_CAST)


def staff_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``staff_raw`` as a raw change log: every 7th row a delete, the next an update.

    ``_commit_version`` = row_id, ``_commit_timestamp`` = 2024-01-01 + row_id seconds.
    """
    k = F.col("row_id")
    ct = F.when(k % 7 == 0, F.lit("delete")).when(k % 7 == 1, F.lit("update_postimage")).otherwise(F.lit("insert"))
    ts = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=k.cast("decimal(18,6)"))
    return (
        staff_raw(spark, sf_dir)
        .withColumn("_change_type", ct)
        .withColumn("_commit_version", k.cast("bigint"))
        .withColumn("_commit_timestamp", ts)
    )


SQL_STAFF_CHANGES = """staff_changes AS (
  SELECT *,
    CASE WHEN row_id % 7 = 0 THEN 'delete' WHEN row_id % 7 = 1 THEN 'update_postimage' ELSE 'insert' END AS _change_type,
    CAST(row_id AS BIGINT) AS _commit_version,
    TIMESTAMP '2024-01-01 00:00:00' + to_seconds(row_id) AS _commit_timestamp
  FROM staff_raw)"""
