"""The corpus pipeline against a brute-force version of all its stages, and each stage on odd tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm.quality_rules import FEATURES, STATS, fit_rules, text_stats
from tessera.llm.simhash_dedup import fingerprint
from test_decontam import shingles

SMALL = "/root/testdata/sf0.001"
TABLES = ("documents", "labels", "benchmark")
BLANK = re.compile(r"[^\x20\x09-\x0d]+")


@pytest.fixture(scope="module")
def sf_dir(spark):
    """The small tables; documents with nulls, blanks, a very long text and repeated rows besides."""
    from tessera.session import scratch_path

    path = scratch_path(spark, "pipeline-input")
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    long = " ".join(f"w{i % 977}x{i % 1009}" for i in range(60_000))
    odd = [(900_001, None, None, None, None), (900_002, "", "en", "s0", 0), (900_003, " \n ", None, None, 3), (900_004, long, "en", None, len(long))]
    fine = docs.orderBy(F.length("text").desc()).limit(3)
    again = fine.unionByName(fine.withColumn("doc_id", F.lit(None).cast("long"))).unionByName(fine.withColumn("doc_id", F.col("doc_id") + 500_000))
    docs.unionByName(spark.createDataFrame(odd, docs.schema)).unionByName(again).write.parquet(f"{path}/documents.parquet")
    for name in TABLES[1:]:
        spark.read.parquet(f"{SMALL}/{name}.parquet").write.parquet(f"{path}/{name}.parquet")
    return path


def good(text, rules):
    s = dict(zip(STATS, text_stats(text), strict=True))
    if s["n_words"] < 20 or 100 * s["n_repeat_words"] > 30 * s["n_words"]:
        return False
    x = {n: np.array([s[a] / max(s[b], 1)]) for n, (a, b) in FEATURES.items()}
    return not any(r.covers(x)[0] for r in rules)


def one_of_each(docs):
    """The row with the smallest id (null last) of each component of fingerprints two bits apart."""
    fps = [fingerprint((t or "").encode()) for _, t, _ in docs]
    words, up = np.array(fps, np.uint64), list(range(len(docs)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(docs)):
        for j in np.flatnonzero(np.bitwise_count(words ^ words[i]) <= 2):
            up[max(root(i), root(j))] = min(root(i), root(j))
    best = {}
    for i, d in enumerate(docs):
        k = (d[0] is None, d[0] or 0)
        if root(i) not in best or k < best[root(i)][0]:
            best[root(i)] = (k, d)
    return [d for _, d in best.values()]


def leaks(text, items):
    s = shingles(text)
    for b in items:
        n, c = len(b), Counter(b)
        if not c.keys() & set(s):
            continue
        for i in range(max(1, len(s) - n + 1)):
            a = Counter(s[i : i + n])
            both = sum((a & c).values())
            if both and both / (sum(a.values()) + n - both) >= 0.8:
                return True
    return False


def mixed(docs):
    """(doc_id, text) of every copy."""
    by = {}
    for d in docs:
        by.setdefault(d[2], []).append(d)
    order = sorted((s for s in by if s is not None)) + [None] * (None in by)
    size = {s: sum(len(BLANK.findall(t or "")) for _, t, _ in by[s]) for s in order}
    weight, target, free = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}, {}, set(order)
    while free:
        level = (1.5 * sum(size.values()) - sum(target.values())) / sum(weight[s] for s in free)
        full = [s for s in free if weight[s] * level >= 2 * size[s]]
        target |= {s: min(2.0 * size[s], weight[s] * level) for s in full or free}
        free -= set(full or free)

    def key(d):
        part = hashlib.md5(d[1].encode()).hexdigest() if d[1] is not None else "~"
        return hashlib.md5(f"mix|{'~' if d[0] is None else d[0]}|{part}".encode()).hexdigest()[:15]

    out = []
    for s in order:
        left = int(target[s] + 1e-6)
        while left > 0 and size[s]:
            for d in sorted(by[s], key=key):
                w = BLANK.findall(d[1] or "")
                if w and left > 0:
                    out.append((d[0], d[1] if left >= len(w) else " ".join(w[:left])))
                    left -= len(w)
    return out


def test_run_matches_brute_force(spark, sf_dir):
    table = {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in TABLES}
    docs = [(r["doc_id"], r["text"], r["source"]) for r in table["documents"].collect()]
    rules = fit_rules(table["documents"], table["labels"])
    kept = [d for d in docs if good(d[1], rules)]
    single = one_of_each(kept)
    items = [shingles(r["text"]) for r in table["benchmark"].collect() if r["text"]]
    clean = [d for d in single if not leaks(d[1], items)]
    want = Counter((i, len(t.encode()) + 16, zlib.crc32(t.encode())) for i, t in mixed(clean))
    assert len(docs) > len(kept) > len(single) > len(clean) > 20  # every stage decides something

    rows = corpus_pipeline.run(spark, sf_dir).toPandas()
    ids = rows["doc_id"].astype(object).where(rows["doc_id"].notna(), None)
    assert Counter(zip(ids, rows["size"], rows["text_crc32"], strict=True)) == want
    n = rows.groupby("shard")["slot"]
    assert set(rows["shard"]) <= set(range(40)) and n.count().max() - len(rows) // 40 <= 1
    assert all(sorted(x) == list(range(len(x))) for _, x in n)


#: Names that the stages use inside or give out, as columns of the input.
CLASHES = ("__k", "__k1", "__k2", "__n", "__whole", "__piece", "__stats", "__text", "__id", "id", "key", "size", "shard", "slot", "fp", "keep", "target", "taken", "k", "h")


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES, ids=lambda s: s[0])
def test_stage_on_odd_tables(spark, sf_dir, stage):
    name, run = stage
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").filter("doc_id is null or doc_id % 5 = 0")
    wide = docs.withColumns({c: F.concat(F.lit(c), F.col("doc_id")) for c in CLASHES})
    last = name == corpus_pipeline.STAGES[-1][0]
    plain, clashing = run(spark, docs, sf_dir), run(spark, wide, sf_dir)
    if not last:
        assert plain.columns == docs.columns and clashing.columns == wide.columns
        assert all(r[c] is None or r[c] == f"{c}{r['doc_id']}" for r in clashing.select("doc_id", *CLASHES).collect() for c in CLASHES)
    ids = lambda df: sorted(str(r[0]) for r in df.select("doc_id").collect())
    assert ids(plain) == ids(clashing)
    assert run(spark, docs.limit(0), sf_dir).count() == 0
    blank = docs.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in docs.schema])
    assert run(spark, blank, sf_dir).count() <= blank.count()


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "simhash_near_dedup", "benchmark_decontamination", "mixing", "sharding"]
    assert corpus_pipeline.ORACLE_SQL is None
