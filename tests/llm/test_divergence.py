"""Source divergence against sums over all terms, and the trees' node sharing."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tessera.llm import divergence as D

DOCS = "doc_id long, text string, lang string, source string, term string"  # a clashing extra column
WORD = re.compile(r"[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_docs, top):
    count, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source, _ in rows:
        lang, source = lang or "", source or ""
        words = WORD.findall((text or "").translate(LOWER))
        groups[lang].add(source)
        count[lang, source].update(words)
        docs[lang].update(set(words))
    out = []
    for lang, sources in groups.items():
        kept = sorted(t for t, n in docs[lang].items() if n >= min_docs)
        v = len(kept)

        def share(c, v=v, kept=kept):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 2) // (n + 2 * v) for t in kept}

        p = {s: share(count[lang, s]) for s in sources}
        q = share(sum((count[lang, s] for s in sources), Counter()))
        gap = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pair = [(o, sum(gap(p[s][t], p[o][t]) for t in kept)) for o in sources if o != s]
            term = [(t, gap(p[s][t], q[t])) for t in kept if count[lang, s][t] and p[s][t] > q[t]]
            for part, items, last in (("pair", pair, None), ("term", term, top)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, x, k + 1) for k, (i, x) in enumerate(items[:last])]
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    r = random.Random(2)
    vocab = [f"{a}{b}" for a in "aäbcdeé" for b in "fghijklm"] + ["THE", "Of"]
    out = []
    for d in range(500):
        s = "hot" if d % 3 else f"s{r.randrange(9)}"
        lang = r.choice(["en", "de"])
        text = " ".join(r.choice(vocab[: 30 if lang == "en" else None]) for _ in range(r.randint(0, 60)))
        out.append((d, text + r.choice(["", " 1,2;x_y", "\n"]), lang, s, "z"))
    out += [(900, None, "en", "empty", None), (901, "", None, None, None), (902, "rare words here", "fr", "a", None), (903, "", "fr", "b", None)]
    return out + [(904, "long text " * 40000, "en", "s1", None)] + [(905, "twice aäf", "en", "s2", None)] * 12


@pytest.mark.parametrize(("segment", "block"), [(4096, 64), (8, 3), (1, 1)])
def test_matches_sums_over_all_terms(spark, rows, segment, block, monkeypatch):
    monkeypatch.setattr(D, "SEGMENT", segment)
    monkeypatch.setattr(D, "BLOCK", block)
    got = D.divergence(spark.createDataFrame(rows, DOCS).repartition(6), 10, 10)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == brute(rows, 10, 10)


def test_empty_table(spark, rows):
    assert D.divergence(spark.createDataFrame(rows, DOCS).limit(0)).count() == 0


def test_equal_subtrees_are_one_node():
    trees = D.Trees(np.array([[1, 2, 1, 2, 5, 5, 5, 5], [5, 5, 5, 5, 1, 2, 1, 2]]))
    assert trees.size == [3, 2, 2, 2]
    asked = []

    def leaf(x, y):
        asked.append(len(x))
        return (trees.counts[x] - trees.counts[y]) ** 2

    assert trees.price(trees.root[0], trees.root[1], leaf) == 2 * (16 + 9 + 16 + 9)
    assert asked == [4]  # (1, 5), (2, 5), (5, 1), (5, 2)


def test_counts_go_out_before_they_fill_memory(spark, rows, monkeypatch):
    monkeypatch.setattr(D, "FLUSH", 20)
    got = D.divergence(spark.createDataFrame(rows, DOCS), 10, 10).collect()
    assert sorted(map(tuple, got)) == brute(rows, 10, 10)


def test_shares_are_exact_beyond_64_bits():
    big = 3 * 10**13
    assert D.shares(np.array([big, 0, -1]), big + 7, 5).tolist() == [1 + 10**9 * (big + 2) // (big + 17), 1 + 2 * 10**9 // (big + 17), 0]
