"""Quality rules: decision lists learned from labelled text statistics.

Per-text statistics come from one pass over the texts (Arrow batches, one text
at a time).  A list of rules is learned from a bounded sample of labelled rows
by sequential covering: grow one conjunction of thresholds by information gain
on two thirds of the sample, prune it from its end on the other third, take
the rows it covers away, and go on while rules stay precise.  The list is
applied as an ordered ``CASE WHEN`` over the statistics.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import free_names, hash_key, require_columns

SYMBOLS = "#*$%&|<>"
BLANK_CHARS = " \t\n\v\f\r"
WINDOW = 8
STATS = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_distinct",
    "n_upper_words",
    "n_exclaims",
)
#: Every feature is a share or mean, so that rules do not follow a text's length.
FEATURES = {
    "mean_word_chars": ("word_chars", "n_words"),
    "symbols_per_word": ("n_symbols", "n_words"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "repeat_share": ("n_repeat_words", "n_words"),
    "distinct_share": ("n_distinct", "n_words"),
    "upper_share": ("n_upper_words", "n_words"),
    "exclaims_per_word": ("n_exclaims", "n_words"),
}
MAX_LABELLED = 20_000
_STATS_TYPE = T.StructType([T.StructField(n, T.LongType(), False) for n in STATS])


# ------------------------------------------------------------------ statistics
def repeated_words(words: list, window: int = WINDOW) -> tuple[int, int]:
    """(words in a window of ``window`` words that occurs at least twice, distinct words); exact.

    Windows are named by doubling: words, then pairs, fours and eights get the
    number of their class, so equal numbers mean equal windows.
    """
    seen: dict = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    if len(words) <= window:
        return 0, len(seen)
    step = 1
    while step < window:
        hop = min(step, window - step)
        _, ids = np.unique(ids[:-hop] * np.int64(len(words) + 1) + ids[hop:], return_inverse=True)
        step += hop
        if int(ids.max()) + 1 == len(ids):
            return 0, len(seen)
    again = np.bincount(ids)[ids] > 1
    cover = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(again)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + window, -1)
    return int((np.cumsum(cover)[:-1] > 0).sum()), len(seen)


def text_stats(text: str | None) -> tuple[int, ...]:
    """The values of ``STATS`` for one text (null: as empty)."""
    t = text or ""
    words = t.encode("utf-8", "surrogatepass").split()
    repeat, distinct = repeated_words(words)
    lines = [x for x in t.split("\n") if x.strip(BLANK_CHARS)]
    return (
        len(words),
        len(t) - sum(t.count(c) for c in BLANK_CHARS),
        sum(t.count(c) for c in SYMBOLS),
        len(lines) - len(set(lines)),
        repeat,
        len(lines),
        distinct,
        sum(map(bytes.isupper, words)),
        t.count("!"),
    )


def with_stats(docs: DataFrame, text_col: str = "text", out: str = "__stats") -> DataFrame:
    """``docs`` with a struct ``out`` of ``STATS``; every row of the input is one row of the output."""
    at = docs.columns.index(text_col)
    schema = T.StructType([*docs.schema.fields, T.StructField(out, _STATS_TYPE, False)])
    names = list(schema.names)
    struct = pa.struct([pa.field(n, pa.int64(), False) for n in STATS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = np.array([text_stats(x.as_py()) for x in b.column(at)], np.int64).reshape(-1, len(STATS))
            values = pa.StructArray.from_arrays([pa.array(rows[:, i]) for i in range(len(STATS))], fields=list(struct))
            yield pa.RecordBatch.from_arrays([*b.columns, values], names=names)

    return docs.mapInArrow(run, schema)


def base_failed(s: str = "__stats") -> Column:
    return (F.col(f"{s}.n_words") < 20) | (100 * F.col(f"{s}.n_repeat_words") > 30 * F.col(f"{s}.n_words"))


def feature(name: str, s: str = "__stats") -> Column:
    top, below = FEATURES[name]
    return F.col(f"{s}.{top}") / F.greatest(F.col(f"{s}.{below}"), F.lit(1))


# ------------------------------------------------------------------ learning
@dataclass(frozen=True)
class Rule:
    """All conditions (feature, "<=" or ">=", threshold) hold: reject."""

    conditions: tuple[tuple[str, str, float], ...]

    def column(self, s: str = "__stats") -> Column:
        out = F.lit(True)
        for name, op, at in self.conditions:
            out = out & (feature(name, s) <= F.lit(at) if op == "<=" else feature(name, s) >= F.lit(at))
        return out

    def covers(self, x: dict[str, np.ndarray]) -> np.ndarray:
        hit = np.ones(len(next(iter(x.values()))), bool)
        for name, op, at in self.conditions:
            hit &= x[name] <= at if op == "<=" else x[name] >= at
        return hit

    def __str__(self) -> str:
        return " and ".join(f"{n} {o} {t:.6g}" for n, o, t in self.conditions)


def _grow(x: dict[str, np.ndarray], y: np.ndarray, max_conditions: int) -> Rule:
    chosen: list[tuple[str, str, float]] = []
    live = np.ones(len(y), bool)
    while len(chosen) < max_conditions:
        p0, n0 = int(y[live].sum()), int((~y[live]).sum())
        if n0 == 0 or p0 == 0:
            break
        base, best = math.log2(p0 / (p0 + n0)), (1e-9, None)
        for name, values in x.items():
            v, t = values[live], y[live]
            cuts = np.unique(np.quantile(v, np.linspace(0, 1, 65)))
            mids = (cuts[1:] + cuts[:-1]) / 2  # between values: a rounding step moves no row over it
            for at in mids.tolist():
                for op in ("<=", ">="):
                    hit = v <= at if op == "<=" else v >= at
                    p = int(t[hit].sum())
                    if p and (gain := p * (math.log2(p / int(hit.sum())) - base)) > best[0]:
                        best = (gain, (name, op, at))
        if best[1] is None:
            break
        chosen.append(best[1])
        live = Rule(tuple(chosen)).covers(x)
    return Rule(tuple(chosen))


def _prune(rule: Rule, x: dict[str, np.ndarray], y: np.ndarray) -> Rule:
    def worth(r: Rule) -> float:
        hit = r.covers(x)
        p, n = int(y[hit].sum()), int((~y[hit]).sum())
        return (p - n) / (p + n) if p + n else -1.0

    best = rule
    for k in range(len(rule.conditions) - 1, 0, -1):
        shorter = Rule(rule.conditions[:k])
        if worth(shorter) >= worth(best):
            best = shorter
    return best


def learn_rules(
    x: dict[str, np.ndarray], bad: np.ndarray, max_rules: int = 12, max_conditions: int = 4, min_precision: float = 0.95
) -> list[Rule]:
    """Ordered rules that reject; rows in the order of a random key.  No bad or no good rows: no rules."""
    rules: list[Rule] = []
    live = np.ones(len(bad), bool)
    third = np.arange(len(bad)) % 3 == 2
    cut = lambda m: {k: v[m] for k, v in x.items()}
    while len(rules) < max_rules and bad[live].any() and not bad[live].all():
        grow, hold = live & ~third, live & third
        rule = _grow(cut(grow), bad[grow], max_conditions)
        if not rule.conditions:
            break
        rule = _prune(rule, cut(hold), bad[hold])
        hit = rule.covers(x) & live
        if bad[hit].sum() < 3 or bad[hit].mean() < min_precision:
            break
        if hit[hold].any() and bad[hit & hold].mean() < min_precision:
            break
        rules.append(rule)
        live &= ~hit
    return rules


def fit_rules(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    max_labelled: int = MAX_LABELLED,
) -> list[Rule]:
    """Learn from at most ``max_labelled`` labelled documents, those with the smallest hash of their id.

    Labels without an id or value are left out; with several for one id their
    mean decides.  Documents that fail the base checks teach nothing.
    """
    key = hash_key(F.lit("labels"), F.col(id_col))
    sample = (
        labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
        .groupBy(F.col(id_col).cast("long").alias("__id"))
        .agg((F.avg(label_col) < 0.5).alias("__bad"))
        .withColumn("__key", hash_key(F.lit("labels"), F.col("__id")))
        .orderBy("__key", "__id")
        .limit(max_labelled)
    )
    texts = docs.select(F.col(id_col).cast("long").alias("__id"), F.col(text_col).alias("__text"))
    # at most max_labelled ids, so the broadcast is bounded by the parameter
    known = texts.join(F.broadcast(sample), "__id")
    rows = (
        with_stats(known, "__text")
        .filter(~base_failed())
        .groupBy("__key", "__id", "__bad")
        .agg(F.min("__stats").alias("__stats"))  # an id that occurs more than once counts once
        .select("__key", "__id", "__bad", *[feature(n).alias(n) for n in FEATURES])
        .orderBy("__key", "__id")
        .toPandas()
    )
    if not len(rows):
        return []
    return learn_rules({n: rows[n].to_numpy(float) for n in FEATURES}, rows["__bad"].to_numpy(bool))


# ------------------------------------------------------------------ operator
def first_rule(rules: list[Rule], s: str = "__stats") -> Column:
    """Number from 1 of the first rule that rejects, else null: one ordered CASE."""
    out = F.lit(None).cast("int")
    for i in range(len(rules), 0, -1):
        out = F.when(rules[i - 1].column(s), F.lit(i)).otherwise(out)
    return out


def quality_verdicts(docs: DataFrame, rules: list[Rule], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Statistics and verdict for every row of ``docs``.

    Returns ``id_col``, the ``STATS``, ``base_failed``, ``rule`` (number of the
    first rule of the list that rejects, else null) and ``kept``.  Null and
    empty texts have no words and so fail the base check; repeated rows are
    judged one by one; null ids stay null; an empty table gives no rows; other
    columns of whatever name are ignored.
    """
    require_columns(docs, id_col, text_col)
    own = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    rule = first_rule(rules)
    return with_stats(own, "__text").select(
        F.col("__id").alias(id_col),
        *[F.col(f"__stats.{n}").alias(n) for n in STATS],
        base_failed().alias("base_failed"),
        rule.alias("rule"),
        (~base_failed() & rule.isNull()).alias("kept"),
    )


def keep_good(docs: DataFrame, rules: list[Rule], text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` (all columns, of whatever name) that pass the base checks and the rules."""
    (s,) = free_names(docs, "__stats")
    return with_stats(docs, text_col, s).filter(~base_failed(s) & first_rule(rules, s).isNull()).drop(s)
