"""Per-micro-batch quality metrics and metric views on change feeds (STR-7, DQ-1, AGG-9).

Spark keeps only the last progress reports of a query, so totals come from
counts that each batch writes to a folder of its own.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tessera.operators.metrics import MetricView
from tessera.sinks.tables import start_stream
from tessera.streaming.state import state_rows

COUNTS = "rule string, passed long, failed long"


def append_with_counts(
    stream_df: DataFrame, rules: Mapping[str, str | Column], path: str, counts_path: str, checkpoint: str
) -> StreamingQuery:
    """Append a stream to ``path`` and each batch's expectation counts to ``counts_path``.

    Rows and counts go to ``batch_id=`` folders that a replayed batch writes
    anew; the counts are observed while the rows are written.
    """
    from tessera.operators.quality import expect_with_metrics
    from tessera.sinks.tables import foreach_batch

    def fn(batch: DataFrame, batch_id: int) -> None:
        rows, seen = expect_with_metrics(batch, rules)
        rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        counts = [(r, int(seen.get[f"{r}_passed"]), int(seen.get[f"{r}_failed"])) for r in rules]
        one = batch.sparkSession.createDataFrame(counts, COUNTS)
        one.coalesce(1).write.mode("overwrite").parquet(f"{counts_path}/batch_id={batch_id}")

    return foreach_batch(stream_df, fn, checkpoint)


def expectation_totals(spark: SparkSession, counts_path: str) -> DataFrame:
    """(rule, passed, failed) over all batches written by :func:`append_with_counts`."""
    counts = spark.read.schema(COUNTS).parquet(counts_path)
    return counts.groupBy("rule").agg(F.sum("passed").alias("passed"), F.sum("failed").alias("failed"))


def observed_totals(spark: SparkSession, query: StreamingQuery, name: str, rules: Sequence[str]) -> DataFrame:
    """Sum ``<rule>_passed`` / ``<rule>_failed`` over the progress reports that Spark still holds.

    For short runs; raises when as many reports are held as Spark keeps, since
    older ones may be gone.  :func:`append_with_counts` has complete totals.

    The metrics were computed by the executors; what reaches the driver is two
    counters per rule and batch.
    """
    totals = {r: [0, 0] for r in rules}
    reports = query.recentProgress
    if len(reports) >= int(spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")):
        raise RuntimeError("progress reports may be incomplete; use append_with_counts")
    for p in reports:
        row = p.observedMetrics.get(name)
        if row is None:
            continue
        d = row.asDict()
        for r in rules:
            totals[r][0] += int(d.get(f"{r}_passed") or 0)
            totals[r][1] += int(d.get(f"{r}_failed") or 0)
    schema = T.StructType(
        [T.StructField("rule", T.StringType()), T.StructField("passed", T.LongType()), T.StructField("failed", T.LongType())]
    )
    return spark.createDataFrame([(r, v[0], v[1]) for r, v in totals.items()], schema)


# ------------------------------------------------------------ metric views on change feeds
class MetricState:
    """A metric view's sums in the state of a streaming query; ``read`` makes the measures from them."""

    def __init__(self, view: MetricView, by: Sequence[str], measures: Sequence[str] | None, schema: T.StructType, spark: SparkSession, checkpoint: str):
        self.view, self.by, self.measures = view, list(by), measures
        self.schema, self.spark, self.checkpoint = schema, spark, checkpoint

    def read(self, display: bool = False) -> DataFrame:
        """The view as of the last committed batch, from a scan of one row a group."""
        state = state_rows(self.spark, self.checkpoint)
        if state is None:
            raise FileNotFoundError(f"no committed batch in {self.checkpoint}")
        # the aggregation's buffer: each sum's value, behind a decimal's also whether it is empty
        names, fields = [f.name for f in self.schema.fields if f.name not in self.by], []
        buffer = iter(state.schema["value"].dataType.fields)
        for n in names:
            fields.append(T.StructField(n, next(buffer).dataType))
            if isinstance(fields[-1].dataType, T.DecimalType):
                fields.append(T.StructField(f"{n}_empty", next(buffer).dataType))
        sums = state.select(*[F.col(f"key.{d}").alias(d) for d in self.by], F.col("value").cast(T.StructType(fields)).alias("v"))
        sums = sums.select(*self.by, *[F.col(f"v.{n}").alias(n) for n in names])
        return self.view.from_sums(sums, self.by, self.measures, display)


def metric_stream(view: MetricView, changes: DataFrame, by: Sequence[str], checkpoint: str, measures: Sequence[str] | None = None, trigger: str = "availableNow"):
    """Keep a metric view up to date from a change feed stream: (query, state).

    A streaming aggregation of signed sums, reduced on the map side, with one row
    a group in the state: a refresh reads the new changes, never the table.  The
    feed must hold pre-images and the deleted rows' values.  The view's ``as_of``
    is fixed for the life of the checkpoint, as brackets of age depend on it.
    """
    deltas = view.deltas(changes, by, measures)
    query = start_stream(deltas, None, checkpoint, fmt="noop", mode="update", trigger=trigger)
    return query, MetricState(view, by, measures, deltas.schema, changes.sparkSession, checkpoint)
