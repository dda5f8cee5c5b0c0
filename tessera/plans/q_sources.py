"""Queries for file sources (SRC-1..13).

Each stages a copy of a fixture view as files under the shared scratch folder
(a fresh directory per run) and reads it back through the operator.
"""

from __future__ import annotations

import datetime as dt
from contextlib import contextmanager

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.plans import fixtures as X
from tessera.plans import staging as S
from tessera.plans.registry import comparable, register
from tessera.session import fs_tree_size, scratch_path
from tessera.sinks.tables import append_table, run_to_completion
from tessera.sources import files as SF
from tessera.sources import rescue as R

RAW = X.with_ctes(X.SQL_STAFF_RAW)
RAW_OUT = (
    "row_id, empid, empname, dob, CAST(salary AS DOUBLE) AS salary, joining_date, dept_id, create_tmst, upd_tmst"
)
RAW_SQL = RAW + f"SELECT {RAW_OUT} FROM staff_raw"
NEW_ROWS = "CAST(try_strptime(joining_date, '%-m/%-d/%Y') AS DATE) >= DATE '1998-01-01'"


def _raw(spark, sf):
    return X.staff_raw(spark, sf)


@register("src_csv_stream", RAW_SQL)
def src_csv_stream(spark, sf):
    """CSV file stream with header and declared schema, drained with availableNow (SRC-1)."""
    base = scratch_path(spark, "src_csv_stream")
    S.write_csv(_raw(spark, sf), f"{base}/in", files=4)
    stream = SF.csv_stream(spark, f"{base}/in", S.STAFF_CSV_SCHEMA, mode="PERMISSIVE", corrupt_col="_corrupt_record")
    run_to_completion(append_table(stream, f"{base}/out", f"{base}/ck"))
    return comparable(spark.read.parquet(f"{base}/out").drop("_corrupt_record"))


FORMATS = ["csv", "json", "orc", "parquet", "text"]


@register(
    "src_format_roundtrip",
    RAW + " UNION ALL ".join(f"SELECT '{f}' AS fmt, {RAW_OUT} FROM staff_raw" for f in FORMATS),
)
def src_format_roundtrip(spark, sf):
    """One dataset written and read back as csv, json, orc, parquet and text (SRC-2, SRC-17)."""
    base = scratch_path(spark, "src_formats")
    raw = _raw(spark, sf)
    outs = []
    for fmt in FORMATS:
        path = f"{base}/{fmt}"
        if fmt == "text":
            raw.select(F.to_csv(F.struct(*S.STAFF_COLUMNS)).alias("value")).write.text(path)
            t = SF.file_scan(spark, path, "text")
            ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in S.STAFF_FILE_SCHEMA.fields)
            back = t.select(F.from_csv("value", ddl).alias("r")).select("r.*")
        else:
            w = raw.write.mode("overwrite")
            (w.option("header", "true").csv(path) if fmt == "csv" else w.format(fmt).save(path))
            opts = {"header": True} if fmt == "csv" else {}
            schema = S.STAFF_FILE_SCHEMA if fmt in ("csv", "json") else None
            back = SF.file_scan(spark, path, fmt, schema, **opts)
        outs.append(back.select(F.lit(fmt).alias("fmt"), *S.STAFF_COLUMNS))
    out = outs[0]
    for o in outs[1:]:
        out = out.unionByName(o)
    return comparable(out)


@register("src_new_files_only", RAW + f"SELECT {RAW_OUT} FROM staff_raw WHERE {NEW_ROWS}")
def src_new_files_only(spark, sf):
    """includeExistingFiles=false: files present at the first start are skipped,
    files added later are taken — also after a restart (SRC-3)."""
    base = scratch_path(spark, "src_new_only")
    raw = _raw(spark, sf)
    S.write_csv(raw.filter(S.joined_before()), f"{base}/in/old", files=2)
    S.set_mtime(spark, f"{base}/in/old", dt.datetime(2000, 1, 1))

    def run():
        s = SF.csv_stream(
            spark, f"{base}/in", S.STAFF_FILE_SCHEMA, recursive=True, include_existing=False, state_dir=f"{base}/ck"
        )
        run_to_completion(append_table(s, f"{base}/out", f"{base}/ck"))

    run()  # first start: only historical files exist
    S.write_csv(raw.filter(~S.joined_before()), f"{base}/in/new", files=2)
    run()  # restart: the new files are picked up
    return comparable(spark.read.parquet(f"{base}/out"))


@register("src_glob_recursive", RAW_SQL)
def src_glob_recursive(spark, sf):
    """pathGlobFilter + recursiveFileLookup over a nested tree with non-matching files (SRC-4)."""
    base = scratch_path(spark, "src_glob")
    raw = _raw(spark, sf).withColumn("yr", F.year(F.try_to_date("joining_date", "M/d/yyyy")))
    raw.write.partitionBy("yr").option("header", "true").csv(f"{base}/tree")
    raw.drop("yr").write.json(f"{base}/tree/noise")  # same rows as JSON: must be ignored
    df = SF.file_scan(spark, f"{base}/tree", "csv", S.STAFF_FILE_SCHEMA, glob="*.csv", recursive=True, header=True)
    return comparable(df)


@register(
    "src_modified_window",
    RAW + " UNION ALL ".join(f"SELECT '{f}' AS form, {RAW_OUT} FROM staff_raw WHERE {NEW_ROWS}" for f in ("batch", "stream")),
)
def src_modified_window(spark, sf):
    """Modification-time lower bound: batch option, and the same bound on a stream (SRC-5)."""
    base = scratch_path(spark, "src_mtime")
    raw = _raw(spark, sf)
    S.write_csv(raw.filter(S.joined_before()), f"{base}/in/a", files=2)
    S.set_mtime(spark, f"{base}/in/a", dt.datetime(2020, 1, 1))
    S.write_csv(raw.filter(~S.joined_before()), f"{base}/in/b", files=2)
    S.set_mtime(spark, f"{base}/in/b", dt.datetime(2024, 6, 1))
    after = SF.DEFAULT_REPROCESS_FROM  # reprocess_days=0 -> 2024-01-01
    batch = SF.file_scan(spark, f"{base}/in", "csv", S.STAFF_FILE_SCHEMA, recursive=True, modified_after=after, header=True)
    stream = SF.csv_stream(spark, f"{base}/in", S.STAFF_FILE_SCHEMA, recursive=True, reprocess_days=0)
    run_to_completion(append_table(stream, f"{base}/out", f"{base}/ck"))
    out = batch.select(F.lit("batch").alias("form"), "*").unionByName(
        spark.read.parquet(f"{base}/out").select(F.lit("stream").alias("form"), "*")
    )
    return comparable(out)


@register(
    "src_declared_schema",
    RAW + "SELECT row_id, CAST(salary AS DOUBLE) AS salary, salary IS NULL AS malformed FROM staff_raw",
)
def src_declared_schema(spark, sf):
    """Declared schema types salary at scan time: a non-numeric token is NULL and
    the line lands in the corrupt column (SRC-6)."""
    base = scratch_path(spark, "src_declared")
    raw = _raw(spark, sf)
    # write salary as text; where it is NULL write a non-numeric token instead
    text = raw.withColumn("salary", F.coalesce(F.col("salary").cast("string"), F.lit("n/a")))
    text.select(S.raw_line(text).alias("value")).write.text(f"{base}/in")
    df = SF.file_scan(spark, f"{base}/in", "csv", S.STAFF_CSV_SCHEMA, mode="PERMISSIVE", corrupt_col="_corrupt_record")
    return comparable(df.select("row_id", "salary", F.col("_corrupt_record").isNotNull().alias("malformed")))


def _faulty_lines(spark, sf, base):
    """staff_raw as CSV text with planted faults: an extra token on some lines,
    the last two fields missing on others."""
    raw = _raw(spark, sf)
    line = S.raw_line(raw)
    k = F.col("row_id")
    short = F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in S.STAFF_COLUMNS[:-2]])
    value = F.when(k % 89 == 0, F.concat(line, F.lit(",EXTRA"))).when(k % 83 == 0, short).otherwise(line)
    raw.select(value.alias("value")).write.text(f"{base}/in")


def _faulty_sql():
    full = S.sql_raw_line()
    short = "concat_ws(',', " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in S.STAFF_COLUMNS[:-2]) + ")"
    return RAW.rstrip() + f""",
faulty AS (SELECT *,
  CASE WHEN row_id % 89 = 0 THEN {full} || ',EXTRA' WHEN row_id % 83 = 0 THEN {short} END AS _corrupt_record,
  row_id % 89 <> 0 AND row_id % 83 = 0 AS is_short
  FROM staff_raw)
"""


@register(
    "src_permissive_corrupt",
    _faulty_sql()
    + """SELECT row_id, empid, empname, dob, CAST(salary AS DOUBLE) AS salary, joining_date, dept_id,
      CASE WHEN is_short THEN NULL ELSE create_tmst END AS create_tmst,
      CASE WHEN is_short THEN NULL ELSE upd_tmst END AS upd_tmst, _corrupt_record FROM faulty""",
)
def src_permissive_corrupt(spark, sf):
    """PERMISSIVE: malformed lines keep their good columns and fill _corrupt_record (SRC-7)."""
    base = scratch_path(spark, "src_permissive")
    _faulty_lines(spark, sf, base)
    return comparable(
        SF.file_scan(spark, f"{base}/in", "csv", S.STAFF_CSV_SCHEMA, mode="PERMISSIVE", corrupt_col="_corrupt_record")
    )


@register("src_drop_malformed", _faulty_sql() + f"SELECT {RAW_OUT} FROM faulty WHERE _corrupt_record IS NULL")
def src_drop_malformed(spark, sf):
    """DROPMALFORMED: malformed lines are dropped (SRC-7)."""
    base = scratch_path(spark, "src_dropmal")
    _faulty_lines(spark, sf, base)
    return comparable(SF.file_scan(spark, f"{base}/in", "csv", S.STAFF_FILE_SCHEMA, mode="DROPMALFORMED"))


JSON_KNOWN = T.StructType([T.StructField("tag", T.StringType())])


@register(
    "src_rescued_json",
    """SELECT event_id, CAST(NULL AS VARCHAR) AS tag,
      CASE WHEN props IS NULL THEN NULL
           ELSE '{"k":"' || json_extract_string(props, '$.k') || '"}' END AS _rescued_data
    FROM events""",
)
def src_rescued_json(spark, sf):
    """JSON against a known schema without ``k``: ``k`` is rescued as JSON, a
    malformed text as it is (SRC-8)."""
    ev = X.table(spark, sf, "events")
    return R.with_rescued_json(ev, "props", JSON_KNOWN, keep=["event_id"], corrupt_col=None)


def _two_header_files(spark, sf, base, change=None, **opts):
    """Historical files with the declared header; newer files with two extra columns."""
    raw = _raw(spark, sf).withColumns(change or {})
    S.write_csv(raw.filter(S.joined_before()).select(*S.STAFF_COLUMNS), f"{base}/in/a", files=2, **opts)
    newer = raw.filter(~S.joined_before()).select(
        *S.STAFF_COLUMNS,
        (F.col("row_id") * 3).cast("string").alias("bonus"),
        F.concat(F.lit("R"), (F.col("row_id") % 5).cast("string")).alias("region"),
    )
    S.write_csv(newer, f"{base}/in/b", files=2, **opts)


RESCUE_SQL = RAW + f"""SELECT {RAW_OUT},
  CASE WHEN {NEW_ROWS} THEN '{{"bonus":"' || CAST(row_id * 3 AS VARCHAR) || '","region":"R' || CAST(row_id % 5 AS VARCHAR) || '"}}' END
    AS _rescued_data,
  CAST(NULL AS VARCHAR) AS _corrupt_record
FROM staff_raw"""


@register("src_rescued_csv", RESCUE_SQL)
def src_rescued_csv(spark, sf):
    """CSV files with different headers read by column name; unknown columns
    rescued as JSON (SRC-8)."""
    base = scratch_path(spark, "src_rescue_csv")
    _two_header_files(spark, sf, base)
    return comparable(R.read_csv_rescued(spark, f"{base}/in", S.STAFF_FILE_SCHEMA, recursive=True))


@register(
    "src_evolution_add_columns",
    RAW
    + f"""SELECT {RAW_OUT},
      CASE WHEN {NEW_ROWS} THEN CAST(row_id * 3 AS VARCHAR) END AS bonus,
      CASE WHEN {NEW_ROWS} THEN 'R' || CAST(row_id % 5 AS VARCHAR) END AS region
    FROM staff_raw""",
)
def src_evolution_add_columns(spark, sf):
    """addNewColumns: new header names become new columns, NULL for older files (SRC-10)."""
    base = scratch_path(spark, "src_evolve")
    _two_header_files(spark, sf, base)
    df, _ = R.read_csv_evolving(
        spark, f"{base}/in", S.STAFF_FILE_SCHEMA, "addNewColumns", schema_location=f"{base}/schema", recursive=True
    )
    return comparable(df)


@register("src_infer_with_hints", RAW_SQL)
def src_infer_with_hints(spark, sf):
    """Schema inferred from the files with type hints on top (SRC-9)."""
    base = scratch_path(spark, "src_infer")
    S.write_csv(_raw(spark, sf), f"{base}/in", files=2)
    schema = R.infer_schema(
        spark, f"{base}/in", "csv", hints="row_id BIGINT, salary DECIMAL(10,2)", schema_location=f"{base}/schema"
    )
    return comparable(SF.file_scan(spark, f"{base}/in", "csv", schema, header=True))


@register("src_rate_limited", RAW_SQL)
def src_rate_limited(spark, sf):
    """At most 2 files per micro-batch; the drained result equals the unlimited read (SRC-11, STR-1)."""
    base = scratch_path(spark, "src_rate")
    S.write_csv(_raw(spark, sf), f"{base}/in", files=8)
    s = SF.csv_stream(spark, f"{base}/in", S.STAFF_FILE_SCHEMA, max_files=2)
    run_to_completion(append_table(s, f"{base}/out", f"{base}/ck"))
    return comparable(spark.read.parquet(f"{base}/out"))


@register("src_csv_dialect", RAW_SQL)
def src_csv_dialect(spark, sf):
    """CSV dialect: '|' separator, every field quoted, explicit escape and encoding (SRC-12)."""
    base = scratch_path(spark, "src_dialect")
    S.write_csv(_raw(spark, sf), f"{base}/in", files=2, sep="|", quoteAll="true", escape="\\", encoding="UTF-8")
    df = SF.file_scan(
        spark, f"{base}/in", "csv", S.STAFF_FILE_SCHEMA, header=True, delimiter="|", quote='"', escape="\\",
        encoding="UTF-8", multiLine=False,
    )
    return comparable(df)


@register("src_batch_scan", RAW_SQL)
def src_batch_scan(spark, sf):
    """Batch scan of a stored table by path (SRC-13)."""
    base = scratch_path(spark, "src_scan")
    _raw(spark, sf).write.parquet(f"{base}/t")
    return comparable(SF.read_current(spark, f"{base}/t"))


@register("src_rescued_csv_stream", RESCUE_SQL)
def src_rescued_csv_stream(spark, sf):
    """The same rescue as a file stream, one or more whole files per micro-batch (SRC-1, SRC-8)."""
    base = scratch_path(spark, "src_rescue_stream")
    _two_header_files(spark, sf, base)
    q = R.rescue_csv_stream(spark, f"{base}/in", S.STAFF_FILE_SCHEMA, f"{base}/out", f"{base}/ck", recursive=True, max_files=1)
    run_to_completion(q)
    return comparable(spark.read.option("recursiveFileLookup", "true").parquet(f"{base}/out"))


# A name with a line feed, quotes and separators in it.
def note():
    return F.concat(F.col("empname"), F.lit(',\n"'), F.col("dept_id"), F.lit('",\n\n'), F.col("row_id").cast("string"))


NOTE_SQL = """CASE WHEN row_id % 3 = 0 THEN empname || ',' || chr(10) || '"' || dept_id || '",' || chr(10) || chr(10) || CAST(row_id AS VARCHAR)
  ELSE empname END"""


@contextmanager
def small_blocks(spark, size):
    """Files are cut into blocks of ``size`` bytes, as large files are on a cluster."""
    keys = {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": str(size)}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def block_bytes(spark, path, blocks=256, least=16 << 10, most=32 << 20):
    """The size that cuts the files below ``path`` into about ``blocks`` blocks, within bounds: many
    blocks a file, but not more tasks the larger the files are."""
    return min(max(least, -(-fs_tree_size(spark, path) // blocks)), most)


@register(
    "src_rescued_multiline",
    RESCUE_SQL.replace(RAW_OUT, RAW_OUT.replace("empname,", f"{NOTE_SQL} AS empname,")),
)
def src_rescued_multiline(spark, sf):
    """Quoted fields with line feeds, read by header name over many blocks a file (SRC-8, SRC-12)."""
    base = scratch_path(spark, "src_multiline")
    _two_header_files(spark, sf, base, change={"empname": F.when(F.col("row_id") % 3 == 0, note()).otherwise(F.col("empname"))}, quoteAll="true")
    with small_blocks(spark, block_bytes(spark, f"{base}/in")):
        rows = R.read_csv_rescued(spark, f"{base}/in", S.STAFF_FILE_SCHEMA, recursive=True, multi_line=True)
        rows.write.parquet(f"{base}/out")
    return comparable(spark.read.schema(rows.schema).parquet(f"{base}/out"))


def _evolving(spark, sf, name, mode, widen=False, declare=None):
    """Old files first, then files with two more columns; the stream is started again whenever it stops."""
    base = scratch_path(spark, name)
    _two_header_files(spark, sf, base)
    for i, part in enumerate(("a", "b")):
        S.set_mtime(spark, f"{base}/in/{part}", dt.datetime(2024, 1, 1 + i))
    stops = 0
    while True:
        query = R.evolving_csv_stream(
            spark, f"{base}/in", S.STAFF_FILE_SCHEMA, f"{base}/out", f"{base}/ck", f"{base}/schema", mode, widen, recursive=True, max_files=1
        )
        try:
            run_to_completion(query)
            break
        except Exception as e:  # noqa: BLE001 - the stop reaches us as the query's failure
            if "new columns in input" not in str(e) or stops:
                raise
            stops += 1
            if declare:
                R.SchemaLog(spark, f"{base}/schema").add(declare)
    if stops != (mode in ("addNewColumns", "failOnNewColumns") and not widen):
        raise RuntimeError(f"{mode} stopped {stops} times")
    return comparable(R.read_evolved(spark, f"{base}/out", f"{base}/schema", R.RESCUE_COL if mode == "rescue" else None))


ADDED_SQL = RAW + f"""SELECT {RAW_OUT},
  CASE WHEN {NEW_ROWS} THEN CAST(row_id * 3 AS VARCHAR) END AS bonus,
  CASE WHEN {NEW_ROWS} THEN 'R' || CAST(row_id % 5 AS VARCHAR) END AS region
FROM staff_raw"""


@register("src_evolution_stream_add", ADDED_SQL)
def src_evolution_stream_add(spark, sf):
    """addNewColumns on a stream: it stops at new header names, and goes on with them when started again (SRC-10)."""
    return _evolving(spark, sf, "src_evolve_add", "addNewColumns")


@register("src_evolution_stream_fail", ADDED_SQL.replace("CAST(row_id * 3 AS VARCHAR)", "CAST(row_id * 3 AS BIGINT)"))
def src_evolution_stream_fail(spark, sf):
    """failOnNewColumns on a stream: it stops until the columns are declared, here with a type of their own (SRC-10)."""
    declare = [T.StructField("bonus", T.LongType()), T.StructField("region", T.StringType())]
    return _evolving(spark, sf, "src_evolve_fail", "failOnNewColumns", declare=declare)


@register("src_evolution_stream_rescue", RESCUE_SQL.replace(",\n  CAST(NULL AS VARCHAR) AS _corrupt_record", ""))
def src_evolution_stream_rescue(spark, sf):
    """rescue on a stream: the schema stays, new columns' values are rescued (SRC-10)."""
    return _evolving(spark, sf, "src_evolve_rescue", "rescue")


@register("src_evolution_stream_none", RAW_SQL)
def src_evolution_stream_none(spark, sf):
    """none on a stream: new columns are left out (SRC-10)."""
    return _evolving(spark, sf, "src_evolve_none", "none")
