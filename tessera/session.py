"""Session set-up, shared scratch locations and Hadoop file-system helpers.

Scratch data (streaming sinks, state versions, checkpoints) always lives under
the shared folder named by ``spark.checkpoint.dir`` so that it survives the
loss of an executor and is visible to every node.  Only when that setting is
unset (unit tests, a laptop) do we create one.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def get_spark(
    master: str = "local[*]", shuffle_partitions: int = 8, app: str = "tessera", conf: dict | None = None
) -> SparkSession:
    """Session with the settings every operator here assumes (UTC, AQE on, no UI).

    ``conf`` adds or overrides settings (e.g. the cluster sizing in README).
    """
    builder = SparkSession.builder
    spark_builder = (
        builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # CSV column pruning changes which rows count as malformed; keep it off.
        .config("spark.sql.csv.parser.columnPruning.enabled", "false")
    )
    for k, v in (conf or {}).items():  # caller settings win over the defaults
        spark_builder = spark_builder.config(k, str(v))
    spark = spark_builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; set a local one only if unset."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        # Executors on other machines would write to their own disks.
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="tessera-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", base)
        except Exception:  # noqa: BLE001 - a core setting may be read-only at runtime
            pass
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique directory path under the shared folder (not created)."""
    return f"{shared_dir(spark)}/tessera/{name}-{uuid.uuid4().hex[:12]}"


# ---------------------------------------------------------------- Hadoop FS
def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def fs_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def fs_list(spark: SparkSession, path: str) -> list[tuple[str, bool, int, int]]:
    """(name, is_dir, length, modification_time_ms) of the direct children."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [
        (st.getPath().getName(), bool(st.isDirectory()), int(st.getLen()), int(st.getModificationTime()))
        for st in fs.listStatus(p)
    ]


def fs_tree_size(spark: SparkSession, path: str) -> int:
    """Bytes of all files below ``path``."""
    fs, p = _fs(spark, path)
    return int(fs.getContentSummary(p).getLength()) if fs.exists(p) else 0


def fs_delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def fs_rename(spark: SparkSession, src: str, dst: str) -> bool:
    fs, p = _fs(spark, src)
    return bool(fs.rename(p, spark.sparkContext._jvm.org.apache.hadoop.fs.Path(dst)))


def fs_set_mtime(spark: SparkSession, path: str, mtime_ms: int) -> None:
    """Set a file's modification time (used to stage files for time-window tests)."""
    fs, p = _fs(spark, path)
    fs.setTimes(p, int(mtime_ms), -1)


def fs_write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def fs_read_text(spark: SparkSession, path: str) -> str | None:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        jvm = spark.sparkContext._jvm
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
