"""Manifest, proofs and nodes against trees built one node at a time."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from tessera.llm.merkle import build, document_proofs, manifest

DOCS = "doc_id long, source string, lang string, n_chars long, text string, leaf string"  # a clashing extra column


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def enc(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(row):
    return h(*[enc(row[i]) for i in (0, 1, 2, 3, 4)])


def levels(digests):
    out = [list(digests)]
    while len(out[-1]) > 1:
        x = out[-1]
        out.append([h(*x[i : i + 3]) for i in range(0, len(x), 3)])
    return out


def path(tree, i):
    steps = []
    for level in tree[:-1]:
        lo = i // 3 * 3
        steps.append(("".join(level[lo:i]), "".join(level[i + 1 : lo + 3])))
        i //= 3
    return steps


def brute(rows):
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append(r)
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        by[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[s] = levels([leaf(r) for r in by[s]])
    top = levels([trees[s][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        for i, r in enumerate(by[s]):
            steps = path(trees[s], i) + path(top, k)
            t = r[4]
            if r[0] is not None and t is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0:
                t = t.replace("\n", "")
            x = leaf((*r[:4], t))
            for a, b in steps:
                x = h(a, x, b)
            root = top[-1][0]
            out.append((r[0], leaf(r), trees[s][-1][0], root, h(*[a + b for a, b in steps]), x, x == root))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def rows():
    r = random.Random(5)
    out = []
    for i in range(2600):
        s = "hot" if i % 3 else r.choice(["a", "é", None, "Z", ""])
        out.append((i * 7 % 2603, s, r.choice(["en", None]), r.choice([None, 0, -3, 10**12]), r.choice([None, "", "x\ny", "né\n\n" * 3]), "z"))
    out += [(5, "alone", None, None, "one\n" * 5000, None)]
    return out + [(None, "hot", None, None, "t\n", None)] * 3 + [(9, "hot", "en", 1, "t\n", "x")] * 40


def test_matches_trees_built_by_hand(spark, rows):
    df = spark.createDataFrame(rows, DOCS).repartition(7)
    got = sorted((tuple(r) for r in document_proofs(df).collect()), key=str)
    assert got == brute(rows)
    assert 500 < sum(r[-1] for r in got) < 2500


@pytest.mark.parametrize("n", [1, 4, 729, 730])
def test_sizes_around_band_edges(spark, n):
    rows = [(i, None, None, None, str(i), None) for i in range(n)]
    got = sorted((tuple(r) for r in document_proofs(spark.createDataFrame(rows, DOCS)).collect()), key=str)
    assert got == brute(rows)


def test_nodes_cover_nested_intervals(spark):
    leaves = spark.range(1000).selectExpr("CAST(NULL AS STRING) AS tree", "id AS rank", "1000L AS total", "sha2(string(id), 256) AS digest")
    nodes = build(leaves, []).nodes().collect()
    want = levels([h(str(i)) for i in range(1000)])
    assert sorted((r["level"], r["lo"], r["hi"], r["digest"]) for r in nodes) == sorted(
        (k, i * 3**k, min((i + 1) * 3**k, 1000), d) for k, level in enumerate(want) for i, d in enumerate(level)
    )


def test_a_change_is_seen_by_its_own_proof_only(spark, rows):
    df = spark.createDataFrame([(i, "s", str(i)) for i in range(50)], "doc_id long, source string, leaf string")
    found = manifest(df, "source", ["doc_id"], "leaf", ["doc_id"]).proofs().collect()
    assert len({r["root"] for r in found}) == 1 and sorted(r["lo"] for r in found) == list(range(50))
    assert all(len(r["path"]) == 4 for r in found)


def test_empty_table(spark, rows):
    assert document_proofs(spark.createDataFrame(rows, DOCS).limit(0)).count() == 0
