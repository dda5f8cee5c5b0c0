"""Records over several lines and blocks against Python's csv reader; headers by any declared name."""

from __future__ import annotations

import csv
import io
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.plans.q_sources import small_blocks
from tessera.session import fs_write_text
from tessera.sources.rescue import csv_lines, join_quoted_lines, read_csv_rescued

SCHEMA = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType()), T.StructField("note", T.StringType())])


def _text(r, rows):
    """CSV whose fields hold line feeds, separators and doubled quotes, each line shorter than a few blocks."""
    out = io.StringIO()
    w = csv.writer(out, lineterminator="\n", quoting=csv.QUOTE_MINIMAL)
    w.writerow(["id", "name", "note"])
    for i in range(rows):
        field = lambda: "".join(r.choice(["a", "b ", "\n", ",", '"', "é", "\n\n", '",', ',"']) for _ in range(r.randint(0, 12)))
        w.writerow([i, "n" + field(), "x" * r.choice([0, 0, 200]) + field() + "."])
    return out.getvalue()


@pytest.mark.parametrize("block", [97, 400, 1 << 20])
def test_records_match_the_csv_reader(spark, tmp, block):
    r = random.Random(block)
    want, texts = [], {}
    for f in range(3):
        texts[f] = _text(r, 60)
        fs_write_text(spark, f"{tmp}/in/f{f}.csv", texts[f])
        want += [tuple(x) for x in list(csv.reader(io.StringIO(texts[f])))[1:]]
    with small_blocks(spark, block):
        lines = csv_lines(spark, f"{tmp}/in")
        got = [x["value"] for x in join_quoted_lines(lines, escape='"').collect()]
        blocks = lines.select("__file", "__block").distinct().count()
    assert (blocks > 30) if block < 100 else blocks >= 3
    records = [tuple(x) for v in got for x in csv.reader(io.StringIO(v))]
    assert sorted(records) == sorted(want + [("id", "name", "note")] * 3)
    assert len(got) == len(want) + 3


def test_rows_by_header_name_over_blocks(spark, tmp):
    fs_write_text(spark, f"{tmp}/in/a.csv", 'note,id\n"one\ntwo, \\"three\\"",1\nplain,2\n"open ""\n\nend",3\n')
    fs_write_text(spark, f"{tmp}/in/b.csv", 'id,name,more\n4,"x\ny",z\n')
    for block in (7, 1 << 20):
        with small_blocks(spark, block):
            rows = read_csv_rescued(spark, f"{tmp}/in", SCHEMA, multi_line=True).collect()
        assert sorted(tuple(r) for r in rows if r["id"] != 3) == [
            (1, None, 'one\ntwo, "three"', None, None), (2, None, "plain", None, None), (4, "x\ny", None, '{"more":"z"}', None),
        ]
        assert [r["_corrupt_record"] for r in rows if r["id"] == 3] == [None]


def test_a_stray_quote_does_not_swallow_its_file(spark, tmp):
    fs_write_text(spark, f"{tmp}/in/a.csv", 'id,name\n1,"never closed\n' + "".join(f"{i},x\n" for i in range(2, 40)) + '40,5" pipe\n')
    lines = csv_lines(spark, f"{tmp}/in")
    assert join_quoted_lines(lines, max_lines=10).count() == 41
    assert join_quoted_lines(lines).count() == 2
    assert join_quoted_lines(lines.limit(0)).count() == 0


def test_header_with_any_declared_name(spark, tmp):
    fs_write_text(spark, f"{tmp}/in/a.csv", "id,name\n1,a\n")
    fs_write_text(spark, f"{tmp}/in/b.csv", "name,salary\nb,7\nname,salary\n")  # its first declared column is not there
    got = {tuple(r) for r in read_csv_rescued(spark, f"{tmp}/in", SCHEMA).drop("note").collect()}
    assert got == {(1, "a", None, None), (None, "b", '{"salary":"7"}', None), (None, "name", '{"salary":"salary"}', None)}


def test_token_counts_by_the_short_way(spark, tmp):
    fs_write_text(spark, f"{tmp}/in/a.csv", 'id,name\n1,a\n2,\n3\n4,b,\n5,c,""\n6,"x,y"\n7,"z",8\n')
    rows = {r["id"]: r["_corrupt_record"] for r in read_csv_rescued(spark, f"{tmp}/in", SCHEMA).collect()}
    assert rows == {1: None, 2: None, 3: "3", 4: "4,b,", 5: '5,c,""', 6: None, 7: '7,"z",8'}


def test_streams_follow_changing_headers(spark, tmp):
    """Two new columns, one after the other: each stops the stream once, and nothing is lost or repeated."""
    from tessera.sources.rescue import SchemaLog, evolving_csv_stream, read_evolved

    fs_write_text(spark, f"{tmp}/in/a.csv", "id,name,note\n1,a,x\n")

    def run(mode, name, widen=False):
        q = evolving_csv_stream(spark, f"{tmp}/in", SCHEMA, f"{tmp}/{name}", f"{tmp}/ck-{name}", f"{tmp}/log-{name}", mode, widen, max_files=1)
        try:
            q.awaitTermination()
        except Exception as e:  # noqa: BLE001
            assert "new columns in input" in str(e)
            return False
        return True

    modes = {"add": "addNewColumns", "wide": "addNewColumns", "fail": "failOnNewColumns", "rescue": "rescue", "none": "none"}
    for name, mode in modes.items():
        assert run(mode, name, name == "wide")
    for col, value in (("m1", 2), ("m2", 3)):
        fs_write_text(spark, f"{tmp}/in/{col}.csv", f"id,{col}\n{value},v\n")
        for name, mode in modes.items():
            stops = name in ("add", "fail")
            assert run(mode, name, name == "wide") != stops
            if name == "fail":
                assert not run(mode, name)  # still
                SchemaLog(spark, f"{tmp}/log-fail").add([T.StructField(col, T.StringType())])
            assert run(mode, name, name == "wide")
    both = {(1, None, None), (2, "v", None), (3, None, "v")}
    for name in ("add", "wide", "fail"):
        rows = read_evolved(spark, f"{tmp}/{name}", f"{tmp}/log-{name}").collect()
        assert {(r["id"], r["m1"], r["m2"]) for r in rows} == both and len(rows) == 3
        assert SchemaLog(spark, f"{tmp}/log-{name}").version() == 2
    rows = read_evolved(spark, f"{tmp}/rescue", f"{tmp}/log-rescue", "_rescued_data").collect()
    assert {(r["id"], r["_rescued_data"]) for r in rows} == {(1, None), (2, '{"m1":"v"}'), (3, '{"m2":"v"}')}
    none = read_evolved(spark, f"{tmp}/none", f"{tmp}/log-none")
    assert none.columns == SCHEMA.names and none.count() == 3
    first = spark.read.parquet(f"{tmp}/wide/batch_id=0")
    assert first.columns == SCHEMA.names and F.col  # older batches keep their own columns
