"""Secret scans: a trigram inverted index in front of the regexes.

Each rule's regex is parsed once on the driver into a Boolean query over
trigrams of the lower-cased text: all of its clauses, each satisfied by any of
its alternatives, each of which needs all trigrams of one literal.  The index
holds (trigram, text) postings for the trigrams that some rule asks for; the
queries are answered by joining and counting postings, and only texts that
satisfy a rule's query are searched with its regex.  A rule whose regex forces
no trigram searches all texts.  DataFrame operations only.
"""

from __future__ import annotations

import itertools
import re
from dataclasses import dataclass

try:
    from re import _constants as sre
    from re import _parser as sre_parse
except ImportError:  # Python before 3.11
    import sre_constants as sre
    import sre_parse

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialize, require_columns


@dataclass(frozen=True)
class SecretRule:
    """``regex`` in the syntax that Java and Python share; matches whose ``group`` is shorter than ``least`` are dropped."""

    kind: str
    regex: str
    group: int = 0
    least: int = 1
    base: bool = False


#: Fixed values of the contract.
BASE = (
    SecretRule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, True),
    SecretRule("access", r"AKIA[A-Z0-9]+", 0, 20, True),
    SecretRule("hex", r"[0-9a-f]{24,}", 0, 24, True),  # the same spans as [0-9a-f]+ of 24 or more
)
MORE = (
    SecretRule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    SecretRule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    SecretRule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    SecretRule("google", r"AIza[0-9A-Za-z_-]{35}"),
    SecretRule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    SecretRule("url_login", r"://[^\x00-\x20:/@]{1,64}:[^\x00-\x20:/@]{1,64}@"),
)
MAX_ALTERNATIVES = 32
#: Matches whose spans are put into one list before the lists are joined.
LOT = 256


# ------------------------------------------------------------------ trigram queries
def _literals(parsed) -> list[set[str] | None]:
    """The regex as a sequence of parts: the set of strings a part can be, or None where that is unknown."""
    parts: list[set[str] | None] = []
    for op, arg in parsed:
        if op is sre.LITERAL:
            parts.append({chr(arg)})
        elif op is sre.IN and all(o is sre.LITERAL for o, _ in arg) and len(arg) <= 8:
            parts.append({chr(a) for _, a in arg})
        elif op is sre.SUBPATTERN:
            parts += _literals(arg[-1])
        elif op is sre.BRANCH:
            whole = [_joined(_literals(x)) for x in arg[1]]
            parts.append(None if None in whole else set().union(*whole))
        elif op is sre.MAX_REPEAT and arg[1] == 1 and (inner := _joined(_literals(arg[2]))) is not None:
            parts.append(inner | ({""} if arg[0] == 0 else set()))
        elif op is sre.MAX_REPEAT and arg[0] == arg[1] <= 4 and (inner := _joined(_literals(arg[2]))) is not None:
            parts += [inner] * arg[0]
        else:
            parts.append(None)
    return parts


def _joined(parts: list[set[str] | None]) -> set[str] | None:
    out = {""}
    for p in parts:
        if p is None or len(out) * len(p) > MAX_ALTERNATIVES:
            return None
        out = {a + b for a, b in itertools.product(out, p)}
    return out


def trigram_query(regex: str) -> list[list[list[str]]]:
    """Clauses (all needed) of alternatives (any) of trigrams (all); empty: the regex forces none."""
    clauses: list[list[list[str]]] = []
    run: set[str] = {""}

    def close() -> None:
        low = {s.lower() for s in run}
        if min(map(len, low)) >= 3:
            clauses.append(sorted(sorted({s[i : i + 3] for i in range(len(s) - 2)}) for s in low))

    for part in _literals(sre_parse.parse(regex)):
        if part is None or len(run) * len(part) > MAX_ALTERNATIVES:
            close()
            run = set(part) if part is not None else {""}
        else:
            run = {a + b for a, b in itertools.product(run, part)}
    close()
    return clauses


# ------------------------------------------------------------------ matching
def _spans(text: Column, rule: SecretRule, number: int) -> Column:
    """Array of (start, kind, end) in code points of the rule's leftmost non-overlapping matches.

    The pieces between matches and the matches themselves add up to the places,
    in lots of ``LOT`` matches, as a list that grows match by match is copied each time.
    """
    cut = F.struct(
        F.split(text, rule.regex).alias("between"),
        F.regexp_extract_all(text, F.lit(rule.regex), F.lit(0)).alias("whole"),
        F.regexp_extract_all(text, F.lit(rule.regex), F.lit(rule.group)).alias("inner"),
    )

    def placed(x: Column) -> Column:
        none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
        parts = F.zip_with(
            F.slice(x["between"], 1, F.size(x["whole"])),
            F.arrays_zip(x["whole"].alias("whole"), x["inner"].alias("inner")),
            lambda b, m: F.struct(F.length(b).alias("skip"), F.length(m["whole"]).alias("len"), F.length(m["inner"]).alias("inner")),
        )

        def step(acc: Column, p: Column) -> Column:
            start = acc["at"] + p["skip"]
            span = F.struct(start.alias("start"), F.lit(number).alias("kind"), (start + p["len"]).alias("end"))
            out = F.when(p["inner"] >= rule.least, F.concat(acc["out"], F.array(span))).otherwise(acc["out"])
            return F.struct((start + p["len"]).alias("at"), out.alias("out"))

        def in_lots(parts: Column) -> Column:
            lots = F.transform(F.sequence(F.lit(0), F.floor((F.size(parts) - 1) / LOT).cast("int")), lambda i: F.slice(parts, i * LOT + 1, LOT))
            return F.get(F.transform(F.array(lots), joined), F.lit(0))

        def joined(lots: Column) -> Column:
            start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("all"))
            length = lambda lot: F.aggregate(lot, F.lit(0), lambda n, p: n + p["skip"] + p["len"])
            starts = F.aggregate(
                F.transform(lots, length),
                start,
                lambda acc, n: F.struct((acc["at"] + n).alias("at"), F.concat(acc["all"], F.array(acc["at"])).alias("all")),
                lambda acc: acc["all"],
            )
            spans = lambda lot, at: F.aggregate(lot, F.struct(at.alias("at"), none.alias("out")), step, lambda acc: acc["out"])
            return F.flatten(F.zip_with(lots, starts, spans))

        return F.when(F.size(x["whole"]) > 0, F.get(F.transform(F.array(parts), in_lots), F.lit(0))).otherwise(none)

    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    return F.when(text.rlike(rule.regex), F.get(F.transform(F.array(cut), placed), F.lit(0))).otherwise(none)


def _listed(spans: Column, kinds: list[str]) -> Column:
    names = F.array(*[F.lit(k) for k in kinds])
    one = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])
    return F.array_join(F.transform(spans, one), ",")


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", more: tuple[SecretRule, ...] = MORE) -> DataFrame:
    """Secret spans of every text; one row for each input row.

    Returns ``id_col``, ``spans`` (array of (start, kind number, end) in code
    points, end exclusive, sorted) and ``kinds`` (names by kind number).  Kinds
    are the base ones, then ``more`` in order.

    A null text counts as empty and has no spans.  Null ids stay null, repeated
    rows get equal answers, an empty table gives no rows, other columns are
    ignored.
    """
    require_columns(docs, id_col, text_col)
    spark = docs.sparkSession
    rules = [*BASE, *more]
    queries = [trigram_query(r.regex) for r in rules]
    t = F.col(text_col)
    own = docs.select(
        F.col(id_col).alias("id"), F.xxhash64(F.lit(2), t.isNull(), t).alias("k"), F.coalesce(t, F.lit("")).alias("text")
    )
    wanted = sorted({g for q in queries for c in q for a in c for g in a})
    full = [i for i, q in enumerate(queries) if not q]
    gated = [i for i, q in enumerate(queries) if q]
    # let: the lower-cased text is made once, then searched for each trigram
    held = F.transform(
        F.array(F.lower("text")), lambda low: F.filter(F.array(*[F.lit(g) for g in wanted]), lambda g: F.contains(low, g))
    )
    scanned = F.concat(*[_spans(F.col("text"), rules[i], i) for i in full]) if full else F.array().cast("array<struct<start:int,kind:int,end:int>>")
    rows = materialize(own.select("id", "k", scanned.alias("scanned"), F.get(held, F.lit(0)).alias("grams")), "secret-rows")

    # postings of each text once, however many copies it has
    postings = rows.filter(F.size("grams") > 0).select("k", F.explode("grams").alias("gram")).distinct()
    terms = [
        (i, c, a, g, len(alternative), len(queries[i]))
        for i in gated
        for c, clause in enumerate(queries[i])
        for a, alternative in enumerate(clause)
        for g in alternative
    ]
    query = spark.createDataFrame(terms, "rule int, clause int, alt int, gram string, grams int, clauses int")
    candidates = materialize(
        postings.join(F.broadcast(query), "gram")  # bounded by the rules
        .groupBy("k", "rule", "clauses", "clause", "alt", "grams")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") == F.col("grams"))
        .groupBy("k", "rule", "clauses")
        .agg(F.count_distinct("clause").alias("met"))
        .filter(F.col("met") == F.col("clauses"))
        .groupBy("k")
        .agg(F.collect_set("rule").alias("rules")),
        "secret-candidates",
    )
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    tried = [F.when(F.array_contains("rules", i), _spans(F.col("text"), rules[i], i)).otherwise(none) for i in gated]
    # written out, so that the rows' join knows its sizes and splits a text that many rows share
    verified = materialize(
        own.join(candidates, "k")
        .select("k", F.concat(*tried).alias("verified"))
        .groupBy("k")
        .agg(F.first("verified").alias("verified")),  # equal texts have equal spans
        "secret-verified",
    )
    spans = F.array_sort(F.concat("scanned", F.coalesce("verified", none)))
    return rows.join(verified, "k", "left").select(
        F.col("id").alias(id_col), spans.alias("spans"), F.array(*[F.lit(r.kind) for r in rules]).alias("kinds")
    )


def secret_digest(found: DataFrame, id_col: str = "doc_id", more: tuple[SecretRule, ...] = MORE) -> DataFrame:
    """Counts, the digest of the base spans and all spans as text, from :func:`find_secrets`."""
    kinds = [r.kind for r in (*BASE, *more)]
    count = lambda i: F.size(F.filter("spans", lambda s: s["kind"] == i)).cast("long")
    based = F.filter("spans", lambda s: s["kind"] < len(BASE))
    return found.select(
        id_col,
        *[count(i).alias(f"n_{r.kind}") for i, r in enumerate(BASE)],
        F.sha2(_listed(based, kinds), 256).alias("base_sha256"),
        _listed(F.col("spans"), kinds).alias("spans"),
    )
