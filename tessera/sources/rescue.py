"""Rescued data, header-aware CSV, schema inference with hints, evolution (SRC-8..10).

CSV files that disagree about their columns are read *by header name*:

1. read the files as text, keeping ``_metadata.file_path``;
2. the first line of each file is its header when it names any declared
   column, in any place; only the first block of a file is looked at, a
   partial aggregate keeps one line per file, and the result is written out
   once for the places that use it.  Lines of files without such a header go
   whole to ``_corrupt_record``;
3. every data line is split with ``from_csv`` into W generic string
   columns, W = widest header + 1 (computed, not guessed), and zipped with
   its file's header into a map;
4. declared columns are taken from the map and typed with ``try_cast``;
   unknown names — and declared values that do not cast — go to
   ``_rescued_data`` as JSON; a line with more or fewer tokens than its
   header fills ``_corrupt_record``.

With ``multi_line`` a quoted field may hold line feeds (``join_quoted_lines``).
A stream follows changing headers through a versioned :class:`SchemaLog`.

All of it is Catalyst expressions over joins; no Python per row.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import fs_list, fs_read_text, fs_write_text, scratch_path

RESCUE_COL = "_rescued_data"
CORRUPT_COL = "_corrupt_record"
EVOLUTION_MODES = ("addNewColumns", "rescue", "failOnNewColumns", "none")


class SchemaEvolutionError(RuntimeError):
    """Raised by ``failOnNewColumns`` when the input has columns the schema lacks."""


def _typed(value: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StringType):
        return value
    return value.try_cast(dtype)


def _known_and_rescued(m: Column, schema: T.StructType, rescue_col: str | None) -> list[Column]:
    """Typed declared columns from map ``m`` plus the rescue JSON of everything else."""
    names = [f.name for f in schema.fields]
    out = []
    mismatched = []
    for f in schema.fields:
        raw = F.element_at(m, F.lit(f.name))
        typed = _typed(raw, f.dataType)
        out.append(typed.alias(f.name))
        if not isinstance(f.dataType, T.StringType):
            mismatched.append(F.when(raw.isNotNull() & typed.isNull(), F.struct(F.lit(f.name).alias("k"), raw.alias("v"))))
    if rescue_col:
        unknown = F.map_filter(m, lambda k, v: ~k.isin(*names) & v.isNotNull())
        if mismatched:
            bad = F.filter(F.array(*mismatched), lambda x: x.isNotNull())
            unknown = F.map_concat(F.map_from_entries(bad), unknown)
        out.append(F.when(F.size(unknown) > 0, F.to_json(unknown)).alias(rescue_col))
    return out


# ------------------------------------------------------------------ JSON
def with_rescued_json(
    df: DataFrame,
    json_col: str,
    schema: T.StructType,
    rescue_col: str = RESCUE_COL,
    keep: Sequence[str] = (),
    corrupt_col: str | None = CORRUPT_COL,
) -> DataFrame:
    """Parse a JSON text column against ``schema``; unknown or mistyped keys go to
    ``rescue_col`` (JSON text, NULL when nothing was rescued).

    A text that is no JSON object, or has anything behind it, is kept as it is in ``corrupt_col``; without
    such a column it is kept in ``rescue_col``, where it cannot be taken for a
    rescue, as those are JSON objects."""
    text, pairs = F.col(json_col), T.MapType(T.StringType(), T.StringType())
    # from_json leaves out what stands behind a value: within brackets, and within braces for a "]", it cannot
    listed = F.from_json(F.concat(F.lit("["), text, F.lit("]")), T.ArrayType(pairs))
    inner = F.from_json(F.concat(F.lit('{"":'), text, F.lit("}")), pairs)
    whole = F.when((F.size(listed) == 1) & inner.isNotNull(), F.get(listed, F.lit(0)))
    parsed = df.select(*keep, text.alias("__text"), whole.alias("__map"))
    *cols, rescued = _known_and_rescued(F.col("__map"), schema, rescue_col)
    corrupt = F.when(F.col("__map").isNull(), F.col("__text"))
    if corrupt_col:
        return parsed.select(*keep, *cols, rescued, corrupt.alias(corrupt_col))
    return parsed.select(*keep, *cols, F.coalesce(corrupt, rescued).alias(rescue_col))


# ------------------------------------------------------------------ CSV
def _lines(text: DataFrame) -> DataFrame:
    """``value`` (a UTF-8 BOM stripped), ``__file`` and ``__block``, the start of the line's block in the file."""
    value = F.regexp_replace("value", "^﻿", "").alias("value")
    return text.select(value, F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__block"))


def csv_lines(spark: SparkSession, path: str, glob: str | None = None, recursive: bool = False) -> DataFrame:
    """Text lines of CSV files with their file path and block; a UTF-8 BOM is stripped."""
    r = spark.read.format("text")
    if glob:
        r = r.option("pathGlobFilter", glob)
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    return _lines(r.load(path))


def join_quoted_lines(
    lines: DataFrame, sep: str = ",", quote: str = '"', escape: str = "\\", max_lines: int = 10_000
) -> DataFrame:
    """``lines`` with those that belong to one record joined by a line feed again.

    A line feed in a quoted field cuts a record into lines.  Whether a line
    starts within quotes depends on all lines before it, but what it does to that
    state is one of four things: leave it, turn it over, or leave quotes open or
    closed whatever it was.  These compose, so each block sums itself up, a
    running composition over a file's blocks (one row a block) gives the state at
    each block's start, and lines meet only the others of their block: no file is
    read by one task.  A record counts as its first line's, however many blocks it
    spans; only the lines of such records are shuffled once more.

    A quote opens at the start of a field and closes at the end of one.  One
    whose record would have more than ``max_lines`` lines is taken for a stray:
    these lines stay as they are.
    """
    q, e, d = _regex_escape(quote), _regex_escape(escape), _regex_escape(sep)
    body = f"(?:[^{q}]|{q}{q})*+" if escape == quote else f"(?:[^{q}{e}]|{e}.|{q}{q})*+"

    def opens(text: Column) -> Column:
        """Whether a text that starts outside of quotes ends within them."""
        # a separator on either side, so that each field has one; whole quoted fields go, neighbours too
        plain = F.regexp_replace(F.concat(F.lit(sep), text, F.lit(sep)), f"(?<={d}){q}{body}{q}(?={d})", "")
        return plain.rlike(f"{d}{q}")

    tail = F.regexp_extract("value", f"^{body}{q}(?:{d}(.*))?$", 1)
    closes = F.col("value").rlike(f"^{body}{q}(?:{d}|$)")
    told = lines.withColumn("__at", F.monotonically_increasing_id()).withColumns(
        {"__out": opens(F.col("value")), "__in": F.when(closes, opens(tail)).otherwise(F.lit(True))}
    )
    told = told.withColumns(
        {"__set": F.when(F.col("__out") == F.col("__in"), F.col("__out")), "__flip": (F.col("__out") & ~F.col("__in")).cast("int")}
    )

    def composed(df: DataFrame, by: list[str], order: str) -> DataFrame:
        """``__fixed``, ``__turns``: the last state that was set (null: none) and the flips since, up to each row."""
        upto = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        df = df.withColumn("__sum", F.sum("__flip").over(upto))
        last = F.last(F.when(F.col("__set").isNotNull(), F.struct("__set", "__sum")), ignorenulls=True).over(upto)
        df = df.withColumn("__last", last)
        turns = (F.col("__sum") - F.coalesce(F.col("__last.__sum"), F.lit(0))) % 2
        return df.withColumns({"__fixed": F.col("__last.__set"), "__turns": turns}).drop("__sum", "__last")

    def before(df: DataFrame, by: list[str], order: str, at_start: Column) -> Column:
        """The state in which a row starts, ``at_start`` being that of the first."""
        w = Window.partitionBy(*by).orderBy(order)
        fixed, turns = F.lag("__fixed").over(w), F.coalesce(F.lag("__turns").over(w), F.lit(0))
        return F.coalesce(fixed, at_start) != (turns == 1)

    block = ["__file", "__block"]
    run = composed(told, block, "__at")
    whole = run.groupBy(*block).agg(F.max_by(F.struct("__fixed", "__turns"), "__at").alias("f"))
    whole = whole.select(*block, (F.col("f.__fixed") != (F.col("f.__turns") == 1)).alias("__set"), F.when(F.col("f.__fixed").isNull(), F.col("f.__turns")).otherwise(F.lit(0)).alias("__flip"))
    whole = composed(whole, ["__file"], "__block")
    of_file = Window.partitionBy("__file").orderBy("__block")
    starts = whole.withColumn("__open", before(whole, ["__file"], "__block", F.lit(False)))
    starts = starts.select(*block, "__open", F.coalesce(F.lead("__open").over(of_file), F.lit(False)).alias("__next_open"))
    run = run.join(starts, block)
    run = run.withColumn("__starts", ~before(run, block, "__at", F.col("__open")))
    in_block = Window.partitionBy(*block).orderBy("__at")
    counted = run.withColumns(
        {
            "__rec": F.sum(F.col("__starts").cast("int")).over(in_block.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
            "__ends": F.coalesce(F.lead("__starts").over(in_block), ~F.col("__next_open")),
        }
    )
    own = counted.filter(F.col("__starts") & F.col("__ends")).select("value", *block, "__at")
    part = counted.filter(~(F.col("__starts") & F.col("__ends"))).select("value", *block, "__at", "__rec")
    # lines before a block's first record go on with the last record of the nearest block that has one
    begun = counted.groupBy(*block).agg(F.max("__rec").alias("n")).withColumn(
        "__owner", F.last(F.when(F.col("n") > 0, F.struct(F.col("__block").alias("b"), "n")), ignorenulls=True).over(of_file.rowsBetween(Window.unboundedPreceding, -1))
    )
    part = part.join(begun.select(*block, "__owner"), block)
    first = F.when(F.col("__rec") > 0, F.struct(F.col("__block").alias("b"), F.col("__rec").alias("n"))).otherwise(F.col("__owner"))
    part = part.withColumn("__of", first)
    long = part.groupBy("__file", "__of").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > max_lines).drop("n")
    stray = part.join(long, ["__file", "__of"], "left_semi").select("value", *block, "__at")
    pieces = part.join(long, ["__file", "__of"], "left_anti").groupBy("__file", "__of").agg(F.sort_array(F.collect_list(F.struct("__block", "__at", "value"))).alias("l"))
    joined = pieces.select(F.concat_ws("\n", "l.value").alias("value"), "__file", F.expr("l[0].__block").alias("__block"), F.expr("l[0].__at").alias("__at"))
    return own.unionByName(joined).unionByName(stray)


def _split(line: Column, width: int, sep: str, quote: str, escape: str) -> Column:
    ddl = ", ".join(f"c{i} STRING" for i in range(width))
    opts = {"sep": sep, "quote": quote, "escape": escape, "mode": "PERMISSIVE"}
    return F.from_csv(line, ddl, opts)


def parse_csv_by_header(
    lines: DataFrame,
    declared: Sequence[str],
    sep: str = ",",
    quote: str = '"',
    escape: str = "\\",
    multi_line: bool = False,
) -> tuple[DataFrame, list[str]]:
    """(rows with a ``__map`` of header name -> token and ``__ntok``/``__nhead``, all header names).

    ``lines`` has ``value``, ``__file`` and ``__block`` (see :func:`csv_lines`); it may
    be a micro-batch.  A file's first line is its header if it names any of the
    ``declared`` columns; lines of a file without one have a null ``__map``.
    Where a header repeats a name, the later column at place n is ``name#n``.
    """
    names = F.transform(F.split("value", _regex_escape(sep)), lambda x: F.trim(F.regexp_replace(x, '^"|"$', "")))
    # Quoted header names are rare; a plain split of the header line is enough
    # to count and name columns, the data lines get a full CSV parse.
    named = lambda x, i: F.when(F.array_position("__hdr", x) == i + 1, x).otherwise(F.concat(x, F.lit("#"), i + 1))
    lines = join_quoted_lines(lines, sep, quote, escape) if multi_line else lines.withColumn("__at", F.monotonically_increasing_id())
    lines = lines.filter(F.length("value") > 0)
    heads = (
        lines.filter(F.col("__block") == 0)
        .groupBy("__file")
        .agg(F.min_by("value", "__at").alias("value"), F.min("__at").alias("__head"))
        .select("__file", "__head", names.alias("__hdr"))
        .filter(F.arrays_overlap("__hdr", F.array(*[F.lit(n) for n in declared])))
        .withColumn("__hdr", F.transform("__hdr", named))
    )
    # one row a file, used for the width, the names and the join: the text is not read again for each
    path = scratch_path(lines.sparkSession, "headers")
    heads.write.parquet(path)
    heads = lines.sparkSession.read.schema(heads.schema).parquet(path)
    # Widest header decides the split width: exact, no cap.  Distinct names only reach the driver.
    found = heads.select(F.posexplode("__hdr").alias("p", "n")).groupBy("n").agg(F.min("p").alias("p"), F.max("p").alias("w")).orderBy("p", "n").collect()
    all_names = [r["n"] for r in found]
    width = max((r["w"] + 1 for r in found), default=0) + 1
    joined = lines.join(heads, on="__file", how="left")
    joined = joined.filter(F.col("__head").isNull() | (F.col("__at") != F.col("__head")))  # the header itself, not its equals
    joined = joined.withColumn("__toks", _split(F.col("value"), width, sep, quote, escape))
    toks = F.array(*[F.col(f"__toks.c{i}") for i in range(width)])
    # Token count = separators outside quoted fields + 1 (an empty field and a
    # missing one both parse as NULL, so the parsed values cannot tell).  A line
    # that fills its header's last column, has nothing after it and ends in no
    # separator or empty quotes needs no count.
    q, e = _regex_escape(quote), _regex_escape(escape)
    unquoted = F.regexp_replace("value", f"{q}(?:[^{q}{e}]|{e}.|{q}{q})*{q}", "")
    n_head = F.size("__hdr")
    full = F.get(toks, n_head - 1).isNotNull() & F.get(toks, n_head).isNull() & ~F.col("value").endswith(sep) & ~F.col("value").endswith(quote * 2)
    n_tok = F.when(full, n_head).otherwise(F.size(F.split(unquoted, _regex_escape(sep))))
    out = joined.select(
        "value",
        "__file",
        F.when(F.col("__hdr").isNotNull(), F.map_from_arrays(F.col("__hdr"), F.slice(toks, 1, n_head))).alias("__map"),
        n_tok.alias("__ntok"),
        n_head.alias("__nhead"),
    )
    return out, all_names


def _regex_escape(s: str) -> str:
    return "".join("\\" + c if c in ".^$*+?()[]{}|\\" else c for c in s)


def rescue_csv(
    parsed: DataFrame,
    schema: T.StructType,
    rescue_col: str | None = RESCUE_COL,
    corrupt_col: str | None = CORRUPT_COL,
    file_col: str | None = None,
) -> DataFrame:
    """Declared columns by header name + rescued JSON + corrupt line (token count != header)."""
    cols = _known_and_rescued(F.col("__map"), schema, rescue_col)
    if corrupt_col:
        lost = F.col("__map").isNull() | (F.col("__ntok") != F.col("__nhead"))
        cols.append(F.when(lost, F.col("value")).alias(corrupt_col))
    if file_col:
        cols.append(F.col("__file").alias(file_col))
    return parsed.select(*cols)


def read_csv_rescued(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    rescue_col: str | None = RESCUE_COL,
    corrupt_col: str | None = CORRUPT_COL,
    glob: str | None = None,
    recursive: bool = False,
    sep: str = ",",
    multi_line: bool = False,
) -> DataFrame:
    """Batch read of CSV files whose headers may differ, mapped by column name."""
    parsed, _ = parse_csv_by_header(csv_lines(spark, path, glob, recursive), schema.names, sep, multi_line=multi_line)
    return rescue_csv(parsed, schema, rescue_col, corrupt_col)


# ------------------------------------------------------------------ inference
def infer_schema(
    spark: SparkSession,
    path: str,
    fmt: str = "csv",
    hints: str | None = None,
    sampling_ratio: float = 1.0,
    schema_location: str | None = None,
    **options,
) -> T.StructType:
    """Inferred schema with type hints laid over it (SRC-9).

    Inference runs once, on a ``samplingRatio`` share of the rows of all files;
    the result is kept as
    JSON at ``schema_location`` so a restarted stream reuses the same schema.
    Hinted columns missing from the data are appended.
    """
    if schema_location:
        cached = fs_read_text(spark, f"{schema_location}/schema.json")
        if cached:
            return T.StructType.fromJson(json.loads(cached))
    reader = spark.read.format(fmt).option("samplingRatio", str(sampling_ratio))
    if fmt == "csv":
        reader = reader.option("header", "true").option("inferSchema", "true")
    for k, v in options.items():
        reader = reader.option(k, str(v))
    inferred = reader.load(path).schema
    if hints:
        hinted = T._parse_datatype_string(hints)
        by_name = {f.name: f for f in hinted.fields}
        fields = [T.StructField(f.name, by_name[f.name].dataType, True) if f.name in by_name else f for f in inferred.fields]
        have = {f.name for f in fields}
        fields += [f for f in hinted.fields if f.name not in have]
        inferred = T.StructType(fields)
    if schema_location:
        fs_write_text(spark, f"{schema_location}/schema.json", inferred.json())
    return inferred


# ------------------------------------------------------------------ evolution
def read_csv_evolving(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    mode: str = "addNewColumns",
    rescue_col: str = RESCUE_COL,
    schema_location: str | None = None,
    glob: str | None = None,
    recursive: bool = False,
) -> tuple[DataFrame, T.StructType]:
    """(rows, schema in force) under one of the four evolution modes (SRC-10).

    * ``addNewColumns`` — new header names become new string columns (kept at
      ``schema_location`` for the next run);
    * ``rescue`` — schema unchanged, unknown values to ``_rescued_data``;
    * ``failOnNewColumns`` — raise :class:`SchemaEvolutionError`;
    * ``none`` — schema unchanged, unknown columns ignored.
    """
    if mode not in EVOLUTION_MODES:
        raise ValueError(f"unknown evolution mode {mode}")
    if schema_location:
        cached = fs_read_text(spark, f"{schema_location}/schema.json")
        if cached:
            schema = T.StructType.fromJson(json.loads(cached))
    parsed, names = parse_csv_by_header(csv_lines(spark, path, glob, recursive), schema.names)
    known = {f.name for f in schema.fields}
    new = [n for n in names if n not in known]
    if new and mode == "failOnNewColumns":
        raise SchemaEvolutionError(f"new columns in input: {new}")
    if mode == "addNewColumns" and new:
        schema = T.StructType([*schema.fields, *[T.StructField(n, T.StringType(), True) for n in new]])
        if schema_location:
            fs_write_text(spark, f"{schema_location}/schema.json", schema.json())
    rescue = rescue_col if mode == "rescue" else None
    return rescue_csv(parsed, schema, rescue, None), schema


# ------------------------------------------------------------------ stream
def csv_lines_stream(
    spark: SparkSession, path: str, glob: str | None = None, recursive: bool = False, max_files: int | None = None
) -> DataFrame:
    """Streaming text lines of CSV files with their path (BOM stripped)."""
    r = spark.readStream.format("text")
    if glob:
        r = r.option("pathGlobFilter", glob)
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    if max_files:
        r = r.option("maxFilesPerTrigger", str(max_files))
    return _lines(r.load(path))


def rescue_csv_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    out_path: str,
    checkpoint: str,
    rescue_col: str | None = RESCUE_COL,
    corrupt_col: str | None = CORRUPT_COL,
    glob: str | None = None,
    recursive: bool = False,
    max_files: int | None = None,
    sep: str = ",",
    multi_line: bool = False,
):
    """Raw ingest with rescued data as a stream (SRC-1 + SRC-8).

    A file source never splits a file across micro-batches, so each batch
    holds whole files, headers included; every batch is parsed by header
    name and written to its own ``batch_id=`` directory (overwrite: a replayed
    batch rewrites, never duplicates).
    """
    from tessera.sinks.tables import foreach_batch

    lines = csv_lines_stream(spark, path, glob, recursive, max_files)

    def fn(batch: DataFrame, batch_id: int) -> None:
        parsed, _ = parse_csv_by_header(batch, schema.names, sep, multi_line=multi_line)
        rescue_csv(parsed, schema, rescue_col, corrupt_col).write.mode("overwrite").parquet(
            f"{out_path}/batch_id={batch_id}"
        )

    return foreach_batch(lines, fn, checkpoint)


class SchemaLog:
    """The versions of a stream's schema, one JSON file each, in the order in which columns turned up."""

    def __init__(self, spark: SparkSession, location: str):
        self.spark, self.location = spark, location.rstrip("/")

    def _versions(self) -> list[int]:
        return sorted(int(n[:-5]) for n, is_dir, *_ in fs_list(self.spark, self.location) if not is_dir and n.endswith(".json") and n[:-5].isdigit())

    def version(self) -> int | None:
        return max(self._versions(), default=None)

    def schema(self, version: int | None = None) -> T.StructType | None:
        """The schema of a version, by default the latest; None if nothing was written yet."""
        version = self.version() if version is None else version
        text = None if version is None else fs_read_text(self.spark, f"{self.location}/{version}.json")
        return None if text is None else T.StructType.fromJson(json.loads(text))

    def add(self, fields: Sequence[T.StructField]) -> T.StructType:
        """A new version with ``fields`` behind those known; known names are left as they are."""
        old = self.schema() or T.StructType([])
        new = T.StructType([*old.fields, *[f for f in fields if f.name not in old.names]])
        if new != old:
            last = self.version()
            fs_write_text(self.spark, f"{self.location}/{0 if last is None else last + 1}.json", new.json())
        return new


def evolving_csv_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    out_path: str,
    checkpoint: str,
    schema_location: str,
    mode: str = "addNewColumns",
    widen: bool = False,
    rescue_col: str = RESCUE_COL,
    glob: str | None = None,
    recursive: bool = False,
    max_files: int | None = None,
    sep: str = ",",
    multi_line: bool = False,
):
    """Stream of CSV files whose headers change over time, under one of the four evolution modes.

    The schema in force is the latest version in the :class:`SchemaLog` at
    ``schema_location`` (at first ``schema``).  When a batch brings a header
    name that it lacks:

    * ``addNewColumns`` — the name is logged as a new string column and the query
      stops with :class:`SchemaEvolutionError`; started again, it does that batch
      with the new schema and goes on.  ``widen=True`` goes on at once;
    * ``failOnNewColumns`` — the query stops, now and after each restart, until
      the column is declared with ``SchemaLog.add`` or the file is gone;
    * ``rescue`` — its values go to ``rescue_col``;
    * ``none`` — its values are left out.

    A batch is written after its schema was settled, to a folder of its own that
    a replay overwrites, so stops lose and repeat nothing.  Read the table with
    :func:`read_evolved`; a repeated header name is no new column.
    """
    from tessera.sinks.tables import foreach_batch

    if mode not in EVOLUTION_MODES:
        raise ValueError(f"unknown evolution mode {mode}")
    log = SchemaLog(spark, schema_location)
    if log.version() is None:
        log.add(schema.fields)
    lines = csv_lines_stream(spark, path, glob, recursive, max_files)

    def fn(batch: DataFrame, batch_id: int) -> None:
        known = log.schema()
        parsed, names = parse_csv_by_header(batch, known.names, sep, multi_line=multi_line)
        new = [n for n in names if n not in known.names and "#" not in n]
        if new and mode == "failOnNewColumns":
            raise SchemaEvolutionError(f"new columns in input: {new}")
        if new and mode == "addNewColumns":
            known = log.add([T.StructField(n, T.StringType()) for n in new])
            if not widen:
                raise SchemaEvolutionError(f"new columns in input, logged as version {log.version()}: {new}")
        rows = rescue_csv(parsed, known, rescue_col if mode == "rescue" else None, None)
        rows.write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")

    return foreach_batch(lines, fn, checkpoint)


def read_evolved(spark: SparkSession, out_path: str, schema_location: str, rescue_col: str | None = None) -> DataFrame:
    """A table of ``evolving_csv_stream`` under the latest schema: columns that a batch did not have are null."""
    schema = SchemaLog(spark, schema_location).schema()
    if rescue_col:
        schema = T.StructType([*schema.fields, T.StructField(rescue_col, T.StringType())])
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(out_path)
