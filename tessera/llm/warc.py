"""WARC archives as a chunked record table.

Writing: each page is one record; payloads larger than a chunk become
segments, rows of (record id, chunk number), each a WARC record of its own
(``continuation`` after the first), so no written row is larger than a chunk.
Records go through Spark's text writer with gzip, whose committer makes lost
tasks safe; the line feed it adds after each row is the last byte of a record.

Reading: archives are read file by file and inflated piece by piece; one-chunk
records are digested at once, chunks of larger records are dealt by record id,
sorted by chunk number and streamed through a running SHA-256, so no task ever
holds a whole record.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import materialize, require_columns

CHUNK_BYTES = 64 * 1024
RECORDS_PER_FILE = 1024
MIN_REVISIT = 100
DATE = "2024-01-01T00:00:00Z"


# ------------------------------------------------------------------ writing
def chunk_rows(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    chunk_bytes: int = CHUNK_BYTES,
    min_revisit: int = MIN_REVISIT,
) -> DataFrame:
    """(record, page, url, kind, refers_to, bytes, digest, chunks, chunk, data): one row for each chunk.

    Of equal payloads of ``min_revisit`` bytes or more, that with the smallest
    id is the response (rows that share this id all are), the others revisit
    it; rows without an id revisit too, or are responses when none has an id.
    """
    data = F.coalesce(F.col(payload_col), F.lit("")).cast("binary")
    own = pages.select(F.col(id_col).alias("page"), F.col(url_col).cast("string").alias("url"), data.alias("data")).select(
        "*", F.octet_length("data").cast("long").alias("bytes"), F.sha2("data", 256).alias("digest")
    )
    # written out, so that the payloads' join knows its sizes and splits a digest that many pages share
    firsts = materialize(
        own.filter(F.col("bytes") >= min_revisit)
        .groupBy("digest")
        .agg(F.min("page").alias("first"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select("digest", "first"),
        "warc-firsts",
    )
    revisits = F.col("first").isNotNull() & (F.col("page").isNull() | (F.col("page") > F.col("first")))
    records = own.join(firsts, "digest", "left").select(
        F.expr("uuid()").alias("record"),
        "page",
        "url",
        F.when(revisits, "revisit").otherwise("response").alias("kind"),
        F.when(revisits, F.col("first")).alias("refers_to"),
        "bytes",
        "digest",
        "data",
    )
    n = F.when(F.col("kind") == "revisit", F.lit(1)).otherwise(F.greatest(F.lit(1), F.ceil(F.col("bytes") / F.lit(chunk_bytes)))).cast("int")
    chunks = records.withColumn("chunks", n).withColumn("chunk", F.explode(F.sequence(F.lit(1), "chunks")))
    part = F.substring(F.col("data"), (F.col("chunk") - 1) * chunk_bytes + 1, F.lit(chunk_bytes))
    empty = F.lit(b"").cast("binary")
    return chunks.withColumn("data", F.when(F.col("kind") == "revisit", empty).otherwise(part))


def write_archives(chunks: DataFrame, path: str, records_per_file: int = RECORDS_PER_FILE) -> None:
    """Write rows of :func:`chunk_rows` as gzipped WARC files under ``path``."""
    line = lambda name, value: F.concat(F.lit(name + ": "), value.cast("string"), F.lit("\r\n"))
    later, many = F.col("chunk") > 1, F.col("chunks") > 1
    url = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\x00-\x20]", "%20")
    urn = F.concat(F.lit("<urn:uuid:"), F.col("record"), F.when(later, F.concat(F.lit("-"), F.col("chunk"))).otherwise(""), F.lit(">"))
    origin = F.concat(F.lit("<urn:uuid:"), F.col("record"), F.lit(">"))
    head = F.concat_ws(
        "",
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(later, "continuation").otherwise(F.col("kind"))),
        line("WARC-Record-ID", urn),
        line("WARC-Date", F.lit(DATE)),
        line("WARC-Target-URI", url),
        F.when(F.col("kind") == "revisit", F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\n")),
        F.when(many, F.concat(line("WARC-Segment-Number", F.col("chunk")), line("X-Segments", F.col("chunks")))),
        F.when(later, line("WARC-Segment-Origin-ID", origin)),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        line("X-Payload-Length", F.col("bytes")),
        line("X-Page-ID", F.col("page")),
        line("X-Refers-To-Page", F.col("refers_to")),
        F.lit("Content-Type: text/html; charset=utf-8\r\n"),
        line("Content-Length", F.octet_length("data")),
        F.lit("\r\n"),
    )
    record = F.concat(head.cast("binary"), F.col("data"), F.lit("\r\n\r").cast("binary")).cast("string")
    chunks.select(record.alias("value")).write.option("compression", "gzip").option("maxRecordsPerFile", records_per_file).text(path)


# ------------------------------------------------------------------ reading
def warc_records(pieces: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields by lower-case name, block) of each record; ``pieces`` are successive bytes of a WARC file."""
    held, need = bytearray(), None
    fields: dict[str, str] = {}
    for piece in pieces:
        held += piece
        while True:
            if need is None:
                end = held.find(b"\r\n\r\n")
                if end < 0:
                    break
                first, *rest = bytes(held[:end]).decode("utf-8", "replace").split("\r\n")
                if not first.startswith("WARC/"):
                    raise ValueError(f"not a WARC record: {first[:40]!r}")
                fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in rest)}
                need = int(fields["content-length"])
                del held[: end + 4]
            if len(held) < need + 4:
                break
            yield fields, bytes(held[:need])
            del held[: need + 4]
            need = None
    if held or need is not None:
        raise ValueError("a WARC file ends within a record")


def _inflated(content, step: int = 1 << 16) -> Iterator[bytes]:
    view, z = memoryview(content), zlib.decompressobj(31)
    for i in range(0, len(view), step):
        part = bytes(view[i : i + step])
        while part:
            yield z.decompress(part)
            part = z.unused_data if z.eof else b""
            if part:
                z = zlib.decompressobj(31)


_ROWS = "record string, chunk int, chunks int, page long, kind string, refers_to long, bytes long, digest string, data binary, sha string"
_PAGES = "record string, page long, kind string, refers_to long, bytes long, digest string, intact boolean"
_NAMES = ["record", "chunk", "chunks", "page", "kind", "refers_to", "bytes", "digest", "data", "sha"]
_TYPES = [pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.string()]


def _row(f: dict[str, str], block: bytes) -> tuple:
    number = lambda k: int(f[k]) if f.get(k) else None
    urn = (f.get("warc-segment-origin-id") or f["warc-record-id"]).strip("<>").removeprefix("urn:uuid:")
    chunks = number("x-segments") or 1
    one = chunks == 1
    return (
        urn, number("warc-segment-number") or 1, chunks, number("x-page-id"), f["warc-type"], number("x-refers-to-page"),
        number("x-payload-length"), f["warc-payload-digest"].removeprefix("sha256:"), None if one else block, hashlib.sha256(block).hexdigest() if one else None,
    )


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """The chunked record table of the archives under ``path``; ``data`` only for records of several chunks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(rows: list[tuple]) -> pa.RecordBatch:
            cols = list(zip(*rows, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _TYPES, strict=True)], names=_NAMES)

        for b in batches:
            for content in b.column(0):
                rows, size = [], 0
                for fields, block in warc_records(_inflated(content.as_buffer())):
                    rows.append(_row(fields, block))
                    size += len(rows[-1][8] or b"")
                    if len(rows) >= 2000 or size > 4 << 20:
                        yield batch(rows)
                        rows, size = [], 0
                if rows:
                    yield batch(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("content").mapInArrow(run, _ROWS)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(record, page, kind, refers_to, bytes, digest, intact): one row for each record.

    Bytes and digest are counted from the chunks as they stream by; revisits
    carry those of the payload they refer to.  ``intact`` compares them with
    what the record's header says and wants every chunk once, in order.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: dict = {}
        for b in batches:
            out = []
            for r in b.to_pylist():
                if r["chunks"] == 1:
                    same = r["kind"] == "revisit" or r["sha"] == r["digest"]
                    out.append((r["record"], r["page"], r["kind"], r["refers_to"], r["bytes"], r["digest"] if r["kind"] == "revisit" else r["sha"], same))
                    continue
                if now.get("record") != r["record"]:
                    now = {"record": r["record"], "next": 1, "bytes": 0, "sha": hashlib.sha256(), "kind": r["kind"], "ok": True}
                now["ok"] &= r["chunk"] == now["next"]
                now["next"] = r["chunk"] + 1
                now["bytes"] += len(r["data"])
                now["sha"].update(r["data"])
                if r["chunk"] == r["chunks"]:
                    digest = now["sha"].hexdigest()
                    intact = now["ok"] and digest == r["digest"] and now["bytes"] == r["bytes"]
                    out.append((r["record"], r["page"], now["kind"], r["refers_to"], now["bytes"], digest, intact))
            if out:
                cols = list(zip(*out, strict=True))
                types = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cols, types, strict=True)],
                    names=["record", "page", "kind", "refers_to", "bytes", "digest", "intact"],
                )

    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    chunks = read_chunks(spark, path)
    return chunks.repartition(n, "record").sortWithinPartitions("record", "chunk").mapInArrow(run, _PAGES)


def archive_pages(pages: DataFrame, path: str, id_col: str = "page_id", **how) -> DataFrame:
    """Write ``pages`` as WARC archives under ``path`` and read them back; one row for each page.

    Returns ``id_col``, ``payload_bytes``, ``payload_digest`` (SHA-256, hex),
    ``record_type``, ``refers_to`` and ``intact``.

    A null payload is empty, a null URL is written as empty; null ids stay
    null; repeated rows are records of their own and, sharing the smallest id,
    all responses; payloads may have any length; an empty table gives no rows;
    other columns are ignored.
    """
    require_columns(pages, id_col)
    spark = pages.sparkSession
    write_archives(chunk_rows(pages, id_col, **how), path)
    return read_archives(spark, path).select(
        F.col("page").alias(id_col),
        F.col("bytes").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        F.col("kind").alias("record_type"),
        "refers_to",
        "intact",
    )
