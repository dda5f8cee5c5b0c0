"""Decontamination against a brute-force search of all windows."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tessera.llm import decontam
from tessera.llm.common import PACK, listed
from tessera.llm.decontam import contaminated, drop_contaminated, hamming_blocks, occurrences

DOCS = "doc_id long, text string, items string"  # a clashing extra column
WORD = re.compile(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def shingles(text):
    w = WORD.findall((text or "").lower())
    if 0 < len(w) < 5:
        return [tuple(w)]
    return [tuple(w[i : i + 5]) for i in range(len(w) - 4)]


def brute(text, items, sim=0.8):
    found, s = set(), shingles(text)
    for item, body in items:
        b = shingles(body)
        if item is None or not b or not s:
            continue
        n = len(b)
        for i in range(max(1, len(s) - n + 1)):
            a, c = Counter(s[i : i + n]), Counter(b)
            both = sum((a & c).values())
            if both / (sum(a.values()) + n - both) >= sim:
                found.add(item)
                break
    return found


@pytest.fixture(scope="module")
def case():
    r = random.Random(7)
    vocab = [f"w{i}é" for i in range(60)]
    words = lambda n: [r.choice(vocab) for _ in range(n)]
    items = [(i, " ".join(words(r.randint(8, 60)))) for i in range(12)]
    items += [(12, "one two three"), (13, ""), (14, None), (None, "no id at all here"), (15, items[0][1]), (16, "ha " * 12)]
    docs = []
    for d in range(60):
        body = words(r.randint(0, 80))
        if d % 3 == 0:
            leak = items[r.randrange(12)][1].split()
            for _ in range(r.randint(0, 2)):
                leak[r.choice([0, 1, -1, -2, r.randrange(len(leak))])] = "changed"
            at = r.randint(0, len(body))
            body[at:at] = leak
        docs.append((d, ", ".join(body) if d % 2 else " ".join(body).upper(), None))
    docs += [(100, None, "x"), (101, "", None), (102, "One two THREE", None), (None, items[3][1], None), (0, docs[0][1], None)]
    docs += [(103, "ha " * 40, None), (104, (" ".join(words(500)) + " " + items[5][1]) * 5, None)]
    return docs, items


def test_matches_all_windows(spark, case):
    docs, items = case
    got = contaminated(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, "item_id long, text string")).collect()
    want = sorted((str(d), ",".join(map(str, sorted(brute(t, items))))) for d, t, _ in docs)
    assert sorted((str(r["doc_id"]), r["items"]) for r in got) == want
    assert sum(r["contaminated"] for r in got) > 15
    assert all(r["contaminated"] == bool(r["n_items"]) == (r["similarity"] is not None) for r in got)


def test_drop_keeps_clean_rows_and_columns(spark, case):
    docs, items = case
    left = drop_contaminated(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, "item_id long, text string"))
    assert left.columns == ["doc_id", "text", "items"]
    assert sorted(map(str, left.collect())) == sorted(map(str, spark.createDataFrame([x for x in docs if not brute(x[1], items)], DOCS).collect()))


def test_empty_tables(spark, case):
    docs, items = case
    d, b = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, "item_id long, text string")
    assert contaminated(d.limit(0), b).count() == 0
    assert contaminated(d, b.limit(0)).filter("contaminated").count() == 0


def test_blocks_cover_all_bits(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(-1,)], "fp long").select(hamming_blocks(F.col("fp"), 24).alias("b"))
    bits = [x["bits"] for x in df.first()["b"]]
    assert len(bits) == 25 and sum(bin(b).count("1") for b in bits) == 64


def test_repeated_word_in_the_changed_part(spark):
    """A copy whose last words became one repeated word: one shingle of it weighs as much as all others that changed."""
    r = random.Random(11)
    items, docs = [], []
    for size in (150, 200, 400):
        for _ in range(6):
            body = [f"w{r.randrange(100_000)}" for _ in range(size)]
            run = (size - 4) // 9  # similarity just above 0.8
            items.append((len(items), " ".join(body)))
            docs.append((len(docs), " ".join(body[:-run] + ["0"] * run + ["after"] * (len(docs) % 2)), None))
    assert [brute(t, items) for _, t, _ in docs] == [{i} for i, _ in items]
    got = contaminated(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, "item_id long, text string"))
    assert {r["doc_id"]: r["items"] for r in got.collect()} == {i: str(i) for i, _ in items}


def test_occurrences_are_numbered(spark):
    df = spark.createDataFrame([([5, 7, 5, 5, 9, 7],), ([7, 5, 5, 7, 5, 9],), ([5, 7],), ([],), ([5] * 300,)], "hs array<long>")
    a, b, c, d, e = [x["o"] for x in df.select(occurrences(F.col("hs")).alias("o")).collect()]
    assert a == b and len(set(a)) == 6 and set(c) < set(a) and d == [] and len(set(e)) == 300 and len(set(a) & set(e)) == 3


def broadcasts(plan):
    """Rows of each broadcast in a plan that has run."""
    kind, out = plan.getClass().getSimpleName(), []
    if kind == "AdaptiveSparkPlanExec":
        return broadcasts(plan.executedPlan())
    if kind == "BroadcastExchangeExec":
        out.append(plan.metrics().apply("numOutputRows").value())
    below = [plan.plan()] if kind.endswith("QueryStageExec") else [plan.children().apply(i) for i in range(plan.children().size())]
    return out + [n for x in below for n in broadcasts(x)]


def test_driver_holds_no_row_for_each_text(spark, monkeypatch):
    """All texts share a shingle with the benchmark, and all windows are in one small file."""
    n, rows, joins = 4000, {}, {}

    def watched(df, name):
        df.collect()
        plan = df._jdf.queryExecution().executedPlan()
        rows[name], joins[name] = broadcasts(plan), plan.toString()
        return kept(df, name)

    kept = decontam.materialize
    monkeypatch.setattr(decontam, "materialize", watched)
    body = "one two three four five six seven eight"
    items = spark.createDataFrame([(1, body), (2, body + " nine ten eleven")], "item_id long, text string")
    i = F.col("id").cast("string")
    text = F.concat_ws(" ", F.concat(F.lit("a"), i), F.lit(body), F.concat(F.lit("b"), i))
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.when(F.col("id") < n - 9, text).otherwise("none").alias("text"))
    assert sorted(r["doc_id"] for r in drop_contaminated(docs, items).collect()) == list(range(n - 9, n))
    assert max(rows["leak-texts"]) <= n // PACK + 1
    assert not re.search(r"BroadcastHashJoin \[k#\d+L(, n#\d+, start#|\], \[k#\d+L\], Inner, BuildLeft)", joins["leak-found"])


@pytest.mark.parametrize("most", [2_000, 10])
def test_listed_is_a_semi_or_anti_join(spark, most):
    keys = spark.range(1_000).select((F.col("id") * 7 - 3_000).alias("h")).distinct()
    own = spark.range(-4_000, 4_000).select(F.when(F.col("id") % 5 != 0, F.col("id")).alias("h"), F.lit("x").alias("__p"), F.lit(1).alias("__key"))
    own = own.unionByName(own)
    want = {x * 7 - 3_000 for x in range(1_000)}
    have = sorted(r["h"] for r in listed(own, "h", keys, most).collect())
    assert have == sorted(x for x in [*range(-4_000, 4_000)] * 2 if x % 5 and x in want)
    rest = listed(own, "h", keys, most, "left_anti")
    assert rest.columns == own.columns and rest.count() == own.count() - len(have)
    assert listed(own, "h", keys.limit(0), most).count() == 0
