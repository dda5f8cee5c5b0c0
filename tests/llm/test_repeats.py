"""Repeated passages against a brute-force search of all windows."""

from __future__ import annotations

import hashlib
import random

import pytest

from tessera.llm.recompression import LAST, drop_repeats, repeat_digests

DOCS = "doc_id long, text string, n_words string"  # a clashing extra column


def brute(rows, window):
    first = {}
    for d, t, _ in rows:
        w = (t or "").encode().split()
        for i in range(len(w) - window + 1):
            k = tuple(w[i : i + window])
            first[k] = min(first.get(k, LAST), LAST if d is None else d)
    out = []
    for d, t, _ in rows:
        w = (t or "").encode().split()
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < (LAST if d is None else d):
                gone[i : i + window] = [True] * window
        out.append((d, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone, strict=True) if not g).decode()))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def rows():
    r = random.Random(3)
    few = ["a", "b", "c", "dé"]
    words = lambda n, of: " ".join(r.choice(of) for _ in range(n))
    passages = [words(r.randint(10, 80), few + [f"w{j}" for j in range(50)]) for _ in range(10)]
    out = []
    for d in range(250):
        parts = []
        for _ in range(r.randint(0, 5)):
            kind = r.randrange(5)
            parts.append(
                [
                    lambda: words(r.randint(1, 40), few),
                    lambda: r.choice(passages),
                    lambda: "ha " * r.randint(1, 60),  # runs
                    lambda: "ab cd " * r.randint(1, 30),  # periods
                    lambda: " ".join(f"u{r.randrange(10**6)}" for _ in range(r.randint(1, 60))),
                ][kind]()
            )
        out.append((d, r.choice([" ", "\n", "\t \x0b"]).join(parts), "x"))
    out += [(500, None, None), (501, "", None), (None, out[3][1], None), (None, out[3][1], "y"), (7, out[9][1], None)]
    out += [(4, out[4][1], None), (-5, out[20][1], None), (600, out[30][1], None), (600, out[30][1], None)]
    return out + [(700, " ".join(p[1] for p in out[:60]) + " tail" * 30000, None)]


@pytest.mark.parametrize("window", [5, 13, 30])
def test_matches_all_windows(spark, rows, window):
    got = repeat_digests(spark.createDataFrame(rows, DOCS).repartition(5), window).collect()
    want = [(d, n, g, hashlib.sha256(k.encode()).hexdigest()) for d, n, g, k in brute(rows, window)]
    assert sorted(map(tuple, got), key=str) == want
    assert sum(x[2] for x in want) > 5000


def test_texts_and_columns(spark, rows):
    out = drop_repeats(spark.createDataFrame(rows, DOCS))
    assert out.columns == ["doc_id", "text", "n_words", "n_words_", "n_removed"]
    got = sorted(((r[0], r[3], r[4], r[1]) for r in out.collect()), key=str)
    assert got == brute(rows, 13)
    assert sorted(str(r["n_words"]) for r in out.collect()) == sorted(str(x[2]) for x in rows)


def test_repeated_rows_of_one_id_keep_their_words(spark):
    text = " ".join(f"w{i}" for i in range(40))
    got = repeat_digests(spark.createDataFrame([(1, text, None)] * 50 + [(2, text, None)] * 50, DOCS)).collect()
    assert {(r["doc_id"], r["n_removed"]) for r in got} == {(1, 0), (2, 40)} and len(got) == 100


def test_empty_table(spark, rows):
    assert repeat_digests(spark.createDataFrame(rows, DOCS).limit(0)).count() == 0


def test_texts_are_shuffled_once(spark, rows):
    from tessera.llm.recompression import kept_texts

    out = kept_texts(spark.createDataFrame(rows, DOCS))
    out.collect()
    assert out._jdf.queryExecution().executedPlan().toString().count("ReusedExchange") >= 2
