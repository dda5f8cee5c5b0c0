"""Tasks, memory and splits that must not grow with the input, on small rows of the tests' own."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.plans import flows
from tessera.plans import staging as S
from tessera.plans.q_sources import block_bytes, small_blocks
from tessera.session import fs_list, fs_tree_size
from tessera.sinks import tables as K
from tessera.sources.rescue import csv_lines


def test_blocks_do_not_grow_with_the_files(spark, tmp):
    line = F.concat(F.lit("x" * 98), F.lit("\n"), F.col("id").cast("string"))
    spark.range(80_000).select(line).coalesce(1).write.text(tmp)
    assert block_bytes(spark, tmp) > 16 << 10
    with small_blocks(spark, block_bytes(spark, tmp)):
        lines = csv_lines(spark, tmp)
        assert 2 < lines.rdd.getNumPartitions() <= 258 < fs_tree_size(spark, tmp) // (16 << 10)
        assert lines.count() == 160_000
    assert block_bytes(spark, tmp, blocks=1 << 20) == 16 << 10  # small files: blocks as before


def test_csv_files_are_bounded(spark, tmp, monkeypatch):
    monkeypatch.setattr(S, "ROWS_PER_FILE", 100)
    S.write_csv(spark.range(1000), f"{tmp}/many", files=2)
    S.write_csv(spark.range(150), f"{tmp}/few", files=4)
    names = lambda at: [n for n, *_ in fs_list(spark, f"{tmp}/{at}") if n.endswith(".csv")]
    assert len(names("many")) == 10 and len(names("few")) == 4
    assert sorted(int(r["id"]) for r in spark.read.csv(f"{tmp}/many", header=True).collect()) == list(range(1000))


def test_clustered_ranges_are_bounded(spark, tmp, monkeypatch):
    monkeypatch.setattr(K, "SORT_BYTES", 100_000)
    rows = spark.range(100_000).select((F.col("id") * 7919 % 100_003).alias("k"), F.md5(F.col("id").cast("string")).alias("v"))
    K.clustered_write(rows, ["k"], tmp)
    back = spark.read.parquet(tmp)
    ends = sorted((r["lo"], r["hi"]) for r in back.groupBy(F.input_file_name()).agg(F.min("k").alias("lo"), F.max("k").alias("hi")).collect())
    assert len(ends) > 1 and all(a[1] < b[0] for a, b in zip(ends, ends[1:]))
    assert back.exceptAll(rows).isEmpty() and back.count() == 100_000


def test_curve_key_is_compiled(spark):
    rows = spark.range(1000).select((F.col("id") % 32).cast("int").alias("a"), F.when(F.col("id") % 9 > 0, F.floor(F.col("id") / 32)).alias("b"))
    out = rows.withColumn("key", K.curve_key(rows, ["a", "b"]))
    assert "lambda" not in out._jdf.queryExecution().toString()
    cuts = [sorted(set(rows.agg(F.percentile_approx(F.col(c).cast("double"), [k / 32 for k in range(1, 32)], 10_000)).first()[0])) for c in "ab"]
    for r in out.collect():
        number = [0 if r[c] is None else sum(x <= r[c] for x in cut) for c, cut in zip("ab", cuts)]
        assert r["key"] == sum(((n >> bit) & 1) << (2 * bit + 1 - i) for i, n in enumerate(number) for bit in range(5))


def test_change_log_is_cut_into_many_row_groups(spark, tmp, monkeypatch):
    monkeypatch.setattr(S, "LOG_BLOCK_BYTES", 64 << 10)
    log = spark.range(60_000).select(F.col("id").alias("_commit_version"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    S.write_change_log(spark, log, tmp, files=3)
    for b in range(3):
        at = f"{tmp}/__bucket={b}/__part=0"
        (name,) = [n for n, *_ in fs_list(spark, at) if n.endswith(".parquet")]
        part = spark.read.parquet(f"{at}/{name}")
        assert part.count() == 20_000 and part.agg(F.min("_commit_version")).first()[0] == b * 20_000
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{at}/{name}")
        footer = spark._jvm.org.apache.parquet.hadoop.ParquetFileReader.readFooter(spark._jsc.hadoopConfiguration(), path)
        assert footer.getBlocks().size() > 4


def test_batches_are_spread(spark):
    rows = spark.range(8000).coalesce(1)
    counts = [r["count"] for r in flows.spread(rows).groupBy(F.spark_partition_id()).count().collect()]
    assert len(counts) == int(spark.conf.get("spark.sql.shuffle.partitions")) and max(counts) < 2000
