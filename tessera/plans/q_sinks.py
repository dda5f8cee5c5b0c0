"""Queries for sinks and materialisation (SNK-1..13)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import quality as Q
from tessera.operators.derive import gold_summary
from tessera.plans import fixtures as X
from tessera.plans import staging as S
from tessera.plans.q_metrics import LATEST_SQL
from tessera.plans.q_quality import DERIVED_SQL, STAFF, STAFF_TAGGED, TYPED_OUT
from tessera.plans.registry import comparable, register
from tessera.session import scratch_path
from tessera.sinks import tables as K
from tessera.sources import files as SF

GOOD_SQL = STAFF + f"SELECT row_id, {TYPED_OUT} FROM staff"


def _staff(spark, sf):
    return X.staff(spark, sf)


@register("snk_stream_append", GOOD_SQL)
def snk_stream_append(spark, sf):
    """Raw files -> enforce schema -> good rows, appended by a checkpointed stream (SNK-1)."""
    base = scratch_path(spark, "snk_append")
    S.write_csv(X.staff_raw(spark, sf), f"{base}/raw", files=4)
    raw = SF.csv_stream(spark, f"{base}/raw", S.STAFF_FILE_SCHEMA)
    good = Q.good_rows(Q.enforce_schema(raw, X.SILVER_SCHEMA, Q.EMPLOYEE_DATE_FORMATS, keep=["row_id"]))
    K.run_to_completion(K.append_table(good, f"{base}/silver", f"{base}/ck"))
    return comparable(spark.read.parquet(f"{base}/silver"))


@register("snk_materialized_refresh", LATEST_SQL + f"SELECT row_id, {TYPED_OUT}, {DERIVED_SQL} FROM latest")
def snk_materialized_refresh(spark, sf):
    """Materialized view recomputed and replaced on each refresh (SNK-2)."""
    base = scratch_path(spark, "snk_mv")

    def build() -> DataFrame:
        return gold_summary(_staff(spark, sf), as_of=X.AS_OF, order_desc=["upd_tmst", "create_tmst", "row_id"])

    K.refresh_view(spark, build, base)
    return comparable(K.refresh_view(spark, build, base))  # second refresh replaces the first


@register(
    "snk_temp_view",
    STAFF + "SELECT dept_id, count(*) AS n_rows, CAST(sum(salary) AS DOUBLE) AS total_salary FROM staff GROUP BY dept_id",
)
def snk_temp_view(spark, sf):
    """A temporary view queried with SQL (SNK-3)."""
    name = f"staff_{uuid.uuid4().hex[:8]}"
    _staff(spark, sf).createOrReplaceTempView(name)
    return spark.sql(
        f"SELECT dept_id, count(*) AS n_rows, CAST(sum(salary) AS DOUBLE) AS total_salary FROM {name} GROUP BY dept_id"
    )


@register(
    "snk_partitioned",
    STAFF_TAGGED + f"SELECT row_id, {TYPED_OUT}, quarantine_reason, is_quarantined FROM tagged2 WHERE is_quarantined",
)
def snk_partitioned(spark, sf):
    """Staging table partitioned by ``is_quarantined``; reading one side prunes the other (SNK-4)."""
    base = scratch_path(spark, "snk_part")
    tagged = Q.tag_violations(_staff(spark, sf))
    K.write_partitioned(tagged, base, ["is_quarantined"])
    back = K.read_partitioned(spark, base, tagged.schema).filter(F.col("is_quarantined"))
    return comparable(back)


@register("snk_clustered", GOOD_SQL)
def snk_clustered(spark, sf):
    """Range-clustered, sorted layout on (dept_id, joining_date); same rows back (SNK-5)."""
    base = scratch_path(spark, "snk_cluster")
    K.clustered_write(_staff(spark, sf), ["dept_id", "joining_date"], base)
    return comparable(spark.read.parquet(base))


@register("snk_overwrite_table", GOOD_SQL)
def snk_overwrite_table(spark, sf):
    """Overwrite an external-path catalog table twice: rows appear once (SNK-6)."""
    base = scratch_path(spark, "snk_table")
    name = f"silver_{uuid.uuid4().hex[:8]}"
    K.write_table(_staff(spark, sf), name, base)
    K.write_table(_staff(spark, sf), name, base)
    return comparable(spark.table(name))


@register(
    "snk_insert_values",
    STAFF + "SELECT row_id, empid, dept_id FROM staff UNION ALL SELECT -1 AS row_id, 'E-1' AS empid, 'D000' AS dept_id",
)
def snk_insert_values(spark, sf):
    """CREATE TABLE ... USING parquet LOCATION, then INSERT ... SELECT and INSERT ... VALUES (SNK-7)."""
    base = scratch_path(spark, "snk_insert")
    name = f"emp_{uuid.uuid4().hex[:8]}"
    view = f"staff_{uuid.uuid4().hex[:8]}"
    _staff(spark, sf).createOrReplaceTempView(view)
    K.create_table_sql(spark, name, "row_id BIGINT, empid STRING, dept_id STRING", base)
    spark.sql(f"INSERT INTO {name} SELECT row_id, empid, dept_id FROM {view}")
    spark.sql(f"INSERT INTO {name} VALUES (-1, 'E-1', 'D000')")
    return spark.table(name)


@register(
    "snk_output_modes",
    X.with_ctes(X.SQL_STAFF_RAW)
    + """SELECT 'complete' AS mode, dept_id, count(*) AS n_rows FROM staff_raw GROUP BY dept_id
    UNION ALL
    SELECT 'update' AS mode, dept_id, count(*) AS n_rows FROM staff_raw GROUP BY dept_id""",
)
def snk_output_modes(spark, sf):
    """A streaming aggregate in complete and update mode equals the batch count (SNK-8)."""
    base = scratch_path(spark, "snk_modes")
    S.write_csv(X.staff_raw(spark, sf), f"{base}/raw", files=6)

    def counts():
        s = SF.csv_stream(spark, f"{base}/raw", S.STAFF_FILE_SCHEMA, max_files=2)
        return s.groupBy("dept_id").agg(F.count(F.lit(1)).alias("n_rows"))

    # complete: every trigger emits the whole result; keep the last one
    def write_complete(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{base}/complete")

    # update: every trigger emits changed groups; fold them, latest count wins
    def write_update(batch, batch_id):
        batch.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(f"{base}/update/b={batch_id}")

    K.run_to_completion(K.foreach_batch(counts(), write_complete, f"{base}/ck_c", mode="complete"))
    K.run_to_completion(K.foreach_batch(counts(), write_update, f"{base}/ck_u", mode="update"))
    upd = spark.read.parquet(f"{base}/update")
    latest = upd.groupBy("dept_id").agg(F.max_by("n_rows", "batch_id").alias("n_rows"))
    comp = spark.read.parquet(f"{base}/complete")
    return comp.select(F.lit("complete").alias("mode"), "dept_id", "n_rows").unionByName(
        latest.select(F.lit("update").alias("mode"), "dept_id", "n_rows")
    )


@register("snk_foreach_batch", GOOD_SQL)
def snk_foreach_batch(spark, sf):
    """One foreachBatch writes silver good *and* bad from a single read of each batch (SNK-9)."""
    base = scratch_path(spark, "snk_feb")
    S.write_csv(X.staff_raw(spark, sf), f"{base}/raw", files=4)
    raw = SF.csv_stream(spark, f"{base}/raw", S.STAFF_FILE_SCHEMA, max_files=2)

    def both(batch, batch_id):
        enforced = Q.enforce_schema(batch, X.SILVER_SCHEMA, Q.EMPLOYEE_DATE_FORMATS, keep=["row_id"]).persist()
        try:
            # per-batch directories + overwrite: a retried batch rewrites, never duplicates
            Q.good_rows(enforced).write.mode("overwrite").parquet(f"{base}/good/batch_id={batch_id}")
            Q.bad_rows(enforced).write.mode("overwrite").parquet(f"{base}/bad/batch_id={batch_id}")
        finally:
            enforced.unpersist()

    K.run_to_completion(K.foreach_batch(raw, both, f"{base}/ck"))
    return comparable(spark.read.parquet(f"{base}/good").drop("batch_id"))


@register(
    "snk_merge_schema",
    STAFF + f"""SELECT row_id, {TYPED_OUT},
      CASE WHEN joining_date >= DATE '1998-01-01' THEN CAST(row_id * 3 AS BIGINT) END AS bonus FROM staff""",
)
def snk_merge_schema(spark, sf):
    """Append rows with a new column to a Parquet table; read with mergeSchema (SNK-10)."""
    base = scratch_path(spark, "snk_merge")
    s = _staff(spark, sf)
    old = s.filter(F.col("joining_date") < F.lit(S.SPLIT_DATE).cast("date"))
    new = s.filter(F.col("joining_date") >= F.lit(S.SPLIT_DATE).cast("date")).withColumn(
        "bonus", (F.col("row_id") * 3).cast("bigint")
    )
    K.append_evolving(old, base)
    K.append_evolving(new, base)
    return comparable(K.read_evolving(spark, base))


@register(
    "snk_idempotent_write",
    STAFF + f"SELECT row_id, {TYPED_OUT}, 'silver' AS txn_app, 7 AS txn_version FROM staff",
)
def snk_idempotent_write(spark, sf):
    """The same (app id, version) written twice lands once (SNK-11)."""
    base = scratch_path(spark, "snk_txn")
    K.write_once(_staff(spark, sf), base, "silver", 7)
    K.write_once(_staff(spark, sf), base, "silver", 7)
    return comparable(spark.read.parquet(base))


@register("snk_compact", GOOD_SQL)
def snk_compact(spark, sf):
    """Many small files rewritten to target-size files; rows unchanged (SNK-12)."""
    base = scratch_path(spark, "snk_compact")
    _staff(spark, sf).repartition(32).write.parquet(f"{base}/small")
    dest = K.compact(spark, f"{base}/small", target_bytes=256 * 1024 * 1024, out_path=f"{base}/compacted")
    return comparable(spark.read.parquet(dest))


@register("snk_full_refresh", GOOD_SQL)
def snk_full_refresh(spark, sf):
    """Full refresh rebuilds the streaming table from all input: rows once, not twice (SNK-13)."""
    base = scratch_path(spark, "snk_refresh")
    S.write_csv(X.staff_raw(spark, sf), f"{base}/raw", files=4)

    def build():
        raw = SF.csv_stream(spark, f"{base}/raw", S.STAFF_FILE_SCHEMA)
        return Q.good_rows(Q.enforce_schema(raw, X.SILVER_SCHEMA, Q.EMPLOYEE_DATE_FORMATS, keep=["row_id"]))

    K.full_refresh(spark, build, f"{base}/table", f"{base}/ck")
    return comparable(K.full_refresh(spark, build, f"{base}/table", f"{base}/ck"))
