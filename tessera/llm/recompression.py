"""Repeated passages by recompression: equal words get equal symbols, whatever stands around them.

A text is a string of word symbols.  A round of recompression first replaces
each run of one symbol by a symbol of its own, then each neighbouring pair
whose left half lies on the round's left side and whose right half on its right
side.  Names are hashes of what they replace and sides are hash bits, so every
task gives equal runs and pairs the same name without a dictionary to share.
What a round does to a place depends on its neighbours only, so a passage that
stands in two texts has the same symbols in both but near its ends.

1. ``distinct_texts``: equal texts are one text of the smallest document id.
2. The rounds run over each text.  Their high symbols of at least ``window``
   words (128-bit names) are offered with the text's document: where a smaller
   document has the symbol, all windows in it are repeats, so a long repeat is
   settled by a few symbols.  And each window names its longest pair of
   neighbouring low symbols that surely stand in it wherever it stands, its
   anchor: a window whose anchor is in no other text is no repeat.
3. Only what is left is verified: the windows with a shared anchor outside of
   settled symbols are named by their words (128 bits) and the smallest document
   of each name is found.  A window of the smallest document that has it is never
   settled by a symbol, so every name meets its smallest document.
4. Covered words go.

No group meets in one task: within a batch of texts only the smallest document
of a symbol or window asks the others, the rest are answered there and spread
by a salted slot.  The texts are shuffled once, compressed; the plan reads that
exchange three times.  Texts are told apart by 92 bits of their SHA-256, high
symbols and windows by 92 bits of theirs; anchors, which only rule out, by 48.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import free_names, materialize, require_columns

WINDOW = 13
#: Rounds before anchors are taken, and before high symbols are.
LOW_ROUNDS, HIGH_ROUNDS = 1, 13
#: Words that one batch of texts holds (a longer text is a batch of its own).
BATCH_WORDS = 400_000
#: Stands for a null document id: larger than any.
LAST = (1 << 63) - 1

U = np.uint64
ASKS = "s1 long, k1 long, k2 int, s2 int, doc long, known boolean, val long"
PLACES = "s1 long, k1 long, k2 int, s2 int, doc long, place int, more array<int>"
#: Bits of the second half of a key or name, and of an anchor.
HALF, ANCHOR = 28, 48


def mix(a: np.ndarray, b: np.ndarray | int, salt: int) -> np.ndarray:
    """64-bit names of (a, b); the salt tells kinds of names and rounds apart."""
    a, b = np.asarray(a, U), np.asarray(b, U)
    z = (a ^ U(salt * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) * U(0xBF58476D1CE4E5B9)
    z ^= z >> U(32)
    z = (z + b) * U(0x94D049BB133111EB)
    z ^= z >> U(29)
    z *= U(0xD6E8FEB86659FD93)
    return z ^ (z >> U(32))


def word_names(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(two names of each word, all texts in a row; words of each text)."""
    words = [t.split() for t in texts]
    seen: dict[bytes, int] = defaultdict()
    seen.default_factory = seen.__len__
    sizes = np.array([len(ws) for ws in words], np.int64)
    ids = np.fromiter(map(seen.__getitem__, chain.from_iterable(words)), np.int64, int(sizes.sum()))
    names = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, seen)), ">u8").astype(U).reshape(-1, 2)
    return names[ids].T, sizes


class Parse:
    """Symbols of texts in a row, round by round, with what each window surely holds of them.

    ``name`` and ``check`` are the two halves of the symbols' names, ``start``
    their first words, ``text`` the texts they stand in.  ``lo`` and ``hi``
    bound, for the windows that start at ``at``, the symbols that any text
    holding the window has there: a symbol at either edge may go on outside.
    """

    def __init__(self, names: np.ndarray, sizes: np.ndarray, window: int):
        self.name, self.check = names[0], names[1]
        n = len(self.name)
        self.words, self.text, self.start = n, np.repeat(np.arange(len(sizes)), sizes), np.arange(n)
        ends = np.cumsum(sizes)
        self.at = np.flatnonzero(np.arange(n) + window <= ends[self.text]) if n else np.zeros(0, np.int64)
        self.lo, self.hi = self.at.copy(), self.at + (window - 1)
        self.round = 0

    def lengths(self) -> np.ndarray:
        return np.diff(np.append(self.start, self.words))

    def _keep(self, first: np.ndarray) -> np.ndarray:
        """Symbols begin where ``first`` holds; the index of the new symbol over each old one."""
        self.text, self.start = self.text[first], self.start[first]
        return np.cumsum(first) - 1

    def step(self) -> None:
        """One round: runs, then pairs."""
        if not self.words:
            return
        r, n = self.round, len(self.name)
        same = (self.name[1:] == self.name[:-1]) & (self.check[1:] == self.check[:-1]) & (self.text[1:] == self.text[:-1])
        first = np.append(True, ~same)
        at = np.flatnonzero(first)
        run = np.diff(np.append(at, n))
        new = self._keep(first)
        many = run > 1
        self.name, self.check = (
            np.where(many, mix(x[at], run, salt + 4 * r), x[at]) for x, salt in ((self.name, 1), (self.check, 2))
        )
        gone = self.lo > self.hi
        lo, hi = new[np.minimum(self.lo, n - 1)] + 1, new[np.maximum(self.hi, 0)] - 1
        gone |= lo > hi

        n = len(self.name)
        right = (mix(self.name, r, 3) & U(1)).astype(bool)
        second = np.append(False, ~right[:-1] & right[1:] & (self.text[1:] == self.text[:-1]))
        new = self._keep(~second)
        at = np.flatnonzero(~second)
        pair = np.append(second[1:], False)[at]
        other = np.minimum(at + 1, n - 1)
        self.name, self.check = (
            np.where(pair, mix(x[at], x[other], salt + 4 * r), x[at]) for x, salt in ((self.name, 5), (self.check, 6))
        )
        lo, hi = np.minimum(lo, n - 1), np.maximum(hi, 0)
        # a right half at the left edge may belong to the word before, a left half at the right edge to the next
        self.lo, self.hi = new[lo] + right[lo], new[hi] - ~right[hi]
        self.lo[gone], self.hi[gone] = 1, 0
        self.round += 1

    def anchors(self, whole) -> np.ndarray:
        """The longest pair of neighbouring sure symbols of each window (of equal ones the smallest name).

        A window with a single sure symbol takes that; one with none, as in
        long runs of a word, its ``whole`` name.
        """
        best, size = np.zeros(len(self.lo), U), np.zeros(len(self.lo), np.int64)
        if not len(self.lo):
            return best
        n, long = len(self.name), self.lengths()
        one, none = self.lo == self.hi, self.lo > self.hi
        best[one] = self.name[self.lo[one]]
        best[none] = whole(self.at[none])
        pairs = np.append(mix(self.name[:-1], self.name[1:], 7), U(0))
        both = np.append(long[:-1] + long[1:], 0)
        for j in range(int((self.hi - self.lo).max(initial=0))):
            at = np.minimum(self.lo + j, n - 1)
            inside = self.lo + j + 1 <= self.hi
            better = inside & ((both[at] > size) | ((both[at] == size) & (pairs[at] < best)))
            best, size = np.where(better, pairs[at], best), np.where(better, both[at], size)
        return best & U((1 << ANCHOR) - 1)


def window_names(names: np.ndarray, at: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Both halves of the names of the windows' words."""
    out = []
    for x, salt in ((names[0], 11), (names[1], 12)):
        h = np.zeros(len(at), U)
        for j in range(window):
            h = mix(h, x[at + j], salt)
        out.append(h)
    return out[0], out[1]


def batches(frames):
    """(slice of an Arrow batch, its texts) with up to ``BATCH_WORDS`` words, estimated by bytes (a word and its blank: 4)."""
    unpack = zstandard.ZstdDecompressor()
    for batch in frames:
        packed = batch.column("text").to_pylist()
        sizes = [zstandard.get_frame_parameters(p).content_size // 4 for p in packed]
        lo = 0
        while lo < batch.num_rows:
            hi, held = lo + 1, sizes[lo]
            while hi < batch.num_rows and held + sizes[hi] <= BATCH_WORDS:
                held += sizes[hi]
                hi += 1
            yield batch.slice(lo, hi - lo), [unpack.decompress(p) for p in packed[lo:hi]]
            lo = hi


def keys_of(batch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return tuple(batch.column(c).to_numpy(zero_copy_only=False) for c in ("k1", "k2", "doc"))


def longs(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).astype(U).view(np.int64))


def groups(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of each row's (a, b), which rows are the first of theirs)."""
    order = np.lexsort((b, a))
    x, y = a[order], b[order]
    new = np.append(True, (x[1:] != x[:-1]) | (y[1:] != y[:-1]))[: len(a)]
    number, first = np.zeros(len(a), np.int64), np.zeros(len(a), bool)
    number[order], first[order[new]] = np.cumsum(new) - 1, True
    return number, first


def low_and_high(names, sizes, window: int):
    """(anchor of each window, window starts, text of each window, high symbols as (name, check, start, size, text))."""
    p = Parse(names, sizes, window)
    texts, starts = p.text[p.at], p.at
    for _ in range(LOW_ROUNDS):
        p.step()
    anchors = p.anchors(lambda at: window_names(names, at, window)[0])
    p.at = p.lo = p.hi = np.zeros(0, np.int64)  # high symbols need no windows
    for _ in range(HIGH_ROUNDS - LOW_ROUNDS):
        p.step()
    size = p.lengths()
    big = size >= window
    return anchors, starts, texts, tuple(x[big] for x in (p.name, p.check, p.start, size, p.text))


def half(x: np.ndarray) -> np.ndarray:
    return (x >> U(64 - HALF)).astype(np.int32)


def asks(window: int):
    """(k1, k2, doc, text) -> anchors and high symbols, one row for each text that has them."""

    def run(frames):
        for b, texts_ in batches(frames):
            k1, k2, doc = keys_of(b)
            names, sizes = word_names(texts_)
            offset = np.cumsum(sizes) - sizes
            anchors, _, texts, (name, check, start, _, of) = low_and_high(names, sizes, window)
            _, once = groups(anchors, texts)
            a, t = anchors[once], texts[once]
            group, lead = groups(a, np.zeros(len(a), U))
            alone = np.bincount(group, minlength=1)[group] == 1  # in no other text of this batch
            n = len(a)
            slots = np.where(lead, a, mix(a, k1[t].view(U), 21) & U((1 << ANCHOR) - 1))
            yield pa.RecordBatch.from_arrays(
                [longs(slots), pa.array(k1[t]), pa.array(k2[t]), pa.array(np.zeros(n, np.int32)), pa.nulls(n, pa.int64()),
                 pa.array(~alone), pa.array(a.view(np.int64), mask=lead)],
                [f.split()[0] for f in ASKS.split(", ")],
            )
            order = np.argsort(doc[of], kind="stable")
            name, check, start, of = name[order], check[order], start[order], of[order]
            # the first in document order asks; the same symbol in a larger document is a repeat
            group, lead = groups(name, check)
            least = np.full(len(name), LAST)
            np.minimum.at(least, group, doc[of])
            later = doc[of] > least[group]
            slots = np.where(lead, name, mix(name, mix(start, k1[of].view(U), 22), 23))
            yield pa.RecordBatch.from_arrays(
                [longs(slots), pa.array(k1[of]), pa.array(k2[of]), pa.array(half(check) | np.int32(1 << HALF)), pa.array(doc[of]),
                 pa.array(later), pa.array(start - offset[of])],
                [f.split()[0] for f in ASKS.split(", ")],
            )

    return run


def offers(window: int):
    """(k1, k2, doc, text, shared, settled) -> open windows, each once a text: the first ``place`` and ``more``.

    Rows without a first place hold places that are known to be repeats.
    """

    def run(frames):
        for b, texts_ in batches(f.filter(f.column("shared").is_valid()) for f in frames):  # the others hold no repeat
            k1, k2, doc = keys_of(b)
            names, sizes = word_names(texts_)
            offset = np.cumsum(sizes) - sizes
            anchors, starts, texts, (_, _, high, size, of) = low_and_high(names, sizes, window)

            def among(values, owners, lists):
                """Which (value, owner) are in the owners' lists."""
                flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(U)
                whose = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
                return np.isin(mix(values, owners, 25), mix(flat, whose, 25))

            done = np.zeros(int(sizes.sum()) + 1, np.int64)  # windows in settled symbols, as differences
            hit = among(high - offset[of], of, b.column("settled"))
            np.add.at(done, high[hit], 1)
            np.add.at(done, (high + size - window + 1)[hit], -1)
            inside = np.cumsum(done)[starts] > 0
            open_ = ~inside & among(anchors, texts, b.column("shared"))
            at, t = starts[open_], texts[open_]
            w1, w2 = window_names(names, at, window)
            order = np.argsort(doc[t], kind="stable")
            at, t, w1, w2 = at[order], t[order], w1[order], w2[order]
            group, lead = groups(w1, w2)
            least = np.full(len(at), LAST)
            np.minimum.at(least, group, doc[t])
            later = doc[t] > least[group]
            # asks: the first, and the smallest document's other texts with this window; one text's rows lie together
            ask = np.flatnonzero(lead | ~later)
            ask = ask[np.lexsort((at[ask], group[ask], t[ask]))]
            new = np.append(True, (t[ask][1:] != t[ask][:-1]) | (group[ask][1:] != group[ask][:-1]))[: len(ask)]
            place = (at[ask] - offset[t[ask]]).astype(np.int32)
            rows = np.flatnonzero(new)
            ends = np.append(rows[1:], len(ask)) - np.arange(1, len(rows) + 1)
            more = pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(place[~new]))
            first = ask[rows]
            a = t[first]
            yield pa.RecordBatch.from_arrays(
                [longs(w1[first]), pa.array(k1[a]), pa.array(k2[a]), pa.array(half(w2[first])), pa.array(doc[a]),
                 pa.array(place[rows]), more],
                [f.split()[0] for f in PLACES.split(", ")],
            )
            # places that are settled here: one row a text, dealt by its key
            known, of = np.concatenate([starts[inside], at[later]]), np.concatenate([texts[inside], t[later]])
            order = np.argsort(of, kind="stable")
            of, known = of[order], known[order]
            own, first = np.unique(of, return_index=True)
            places = pa.ListArray.from_arrays(
                pa.array(np.append(first, len(of)).astype(np.int32)), pa.array((known - offset[of]).astype(np.int32))
            )
            yield pa.RecordBatch.from_arrays(
                [pa.array(k1[own]), pa.array(k1[own]), pa.array(k2[own]), pa.array(k2[own]), pa.array(doc[own]),
                 pa.nulls(len(own), pa.int32()), places],
                [f.split()[0] for f in PLACES.split(", ")],
            )

    return run


def cut(window: int):
    """(k1, k2, doc, text, places) -> the words that no repeated window covers."""

    def run(frames):
        for b, texts in batches(frames):
            kept, counts, removed = [], [], []
            for text, places in zip(texts, b.column("places"), strict=True):
                words = text.split()
                gone = np.zeros(len(words) + 1, np.int64)
                if places.is_valid:
                    at = np.unique(places.values.to_numpy(zero_copy_only=False).astype(np.int64))
                    gone[at] += 1
                    np.add.at(gone, at + window, -1)
                stay = np.cumsum(gone[:-1]) == 0
                kept.append(b" ".join(w for w, s in zip(words, stay.tolist(), strict=True) if s).decode())
                counts.append(len(words))
                removed.append(len(words) - int(stay.sum()))
            yield pa.RecordBatch.from_arrays(
                [b.column("k1"), b.column("k2"), b.column("doc"), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                ["k1", "k2", "doc", "n_words", "n_removed", "kept"],
            )

    return run


def _keys(text) -> list:
    """64 and 28 bits of the text's SHA-256; null is the empty text."""
    h = F.sha2(F.coalesce(text, F.lit("")), 256)
    parts = (F.conv(F.substring(h, 1, 16), 16, -10).cast("long"), F.conv(F.substring(h, 17, HALF // 4), 16, 10).cast("int"))
    return [p.alias(f"k{i + 1}") for i, p in enumerate(parts)]


def pack(frames):
    """(doc, text) -> (k1, k2, doc, text compressed); the keys are those of ``_keys``."""
    packer = zstandard.ZstdCompressor(level=3)
    for batch in frames:
        texts = [t.encode() for t in batch.column("text").to_pylist()]
        hashes = [hashlib.sha256(t).digest() for t in texts]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([int.from_bytes(h[:8], "big", signed=True) for h in hashes], pa.int64()),
                pa.array([int.from_bytes(h[8:12], "big") >> (32 - HALF) for h in hashes], pa.int32()),
                batch.column("doc"), pa.array([packer.compress(t) for t in texts], pa.binary()),
            ],
            ["k1", "k2", "doc", "text"],
        )


def distinct_texts(docs: DataFrame) -> DataFrame:
    """(k1, k2, doc, text): each text once, compressed, with the smallest document id that has it."""
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc")
    rows = docs.select(doc, F.coalesce("text", F.lit("")).alias("text")).mapInArrow(pack, "k1 long, k2 int, doc long, text binary")
    return rows.groupBy("k1", "k2").agg(F.min("doc").alias("doc"), F.first("text").alias("text"))


def kept_texts(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(k1, k2, doc, n_words, n_removed, kept) of each distinct text: its words without repeated windows.

    A window is ``window`` consecutive words; it is a repeat if a document with
    a smaller id has the same words in a row.  A document without an id comes
    after all others; none of two such is the earlier one.
    """
    texts = distinct_texts(docs)
    by_slot = Window.partitionBy("s1", "s2")
    asked = texts.mapInArrow(asks(window), ASKS)
    told = asked.select("*", F.count(F.lit(1)).over(by_slot).alias("n"), F.min("doc").over(by_slot).alias("least"))
    high = F.col("doc").isNotNull()
    found = told.filter(F.col("known") | F.when(high, F.col("least") < F.col("doc")).otherwise(F.col("n") > 1))
    lists = found.groupBy("k1", "k2").agg(
        F.collect_list(F.when(~high, F.coalesce("val", "s1"))).alias("shared"), F.collect_list(F.when(high, F.col("val"))).alias("settled")
    )
    # a left join: an inner one would filter the texts' keys and read them through an exchange of its own
    open_ = texts.join(lists, ["k1", "k2"], "left").select("k1", "k2", "doc", "text", "shared", "settled")
    offered = open_.mapInArrow(offers(window), PLACES)
    judged = offered.withColumn("least", F.min("doc").over(by_slot))
    repeats = judged.filter(F.col("place").isNull() | (F.col("least") < F.col("doc")))
    found = repeats.groupBy("k1", "k2").agg(F.collect_list("place").alias("one"), F.flatten(F.collect_list("more")).alias("more"))
    where = found.select("k1", "k2", F.concat("one", "more").alias("places"))
    out = "k1 long, k2 int, doc long, n_words long, n_removed long, kept string"
    return texts.join(where, ["k1", "k2"], "left").select("k1", "k2", "doc", "text", "places").mapInArrow(cut(window), out)


def _per_row(docs: DataFrame, results: DataFrame, window: int, kept: str, none) -> DataFrame:
    """``docs`` with ``__words``, ``__gone`` and ``__kept`` of their texts; ``none`` is ``kept`` of no words.

    Of equal texts only those of the smallest id may keep words that windows cover.
    """
    rows = docs.select("*", *[k.alias(f"__{i}") for i, k in enumerate(_keys(F.col("text")))])
    found = rows.join(results, (F.col("__0") == F.col("k1")) & (F.col("__1") == F.col("k2")), "left")
    own = (F.coalesce(docs["doc_id"].cast("long"), F.lit(LAST)) == F.col("doc")) | (F.col("n_words") < window)
    return found.select(
        *[docs[c] for c in docs.columns],
        F.col("n_words").alias("__words"),
        F.when(own, F.col("n_removed")).otherwise(F.col("n_words")).alias("__gone"),
        F.when(own, F.col(kept)).otherwise(none).alias("__kept"),
    )


def drop_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with ``text`` cut to the kept words, one blank between them, and ``n_words``, ``n_removed``.

    Null and empty texts come out empty, with no words.  Of rows with equal texts
    those of the smallest id keep what is new there; the others lose all words, or
    none if they have fewer than ``window``.  Extra columns stay; a new column
    whose name is taken gets an underscore.
    """
    require_columns(docs, "doc_id", "text")
    words, gone = free_names(docs, "n_words", "n_removed")
    clear = docs.withColumnsRenamed({c: f"__x{c}" for c in docs.columns if c not in ("doc_id", "text")})
    results = materialize(kept_texts(clear, window), "repeats")
    out = _per_row(clear, results, window, "kept", F.lit(""))
    cols = [F.col("__kept").alias("text") if c == "text" else F.col(c if c == "doc_id" else f"__x{c}").alias(c) for c in docs.columns]
    return out.select(*cols, F.col("__words").alias(words), F.col("__gone").alias(gone))


def repeat_digests(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every row, as ``drop_repeats`` keeps it."""
    require_columns(docs, "doc_id", "text")
    digest = F.sha2("kept", 256).alias("sha")
    results = materialize(kept_texts(docs, window).select("k1", "k2", "doc", "n_words", "n_removed", digest), "repeats")
    out = _per_row(docs.select("doc_id", "text"), results, window, "sha", F.sha2(F.lit(""), 256))
    return out.select(
        "doc_id", F.col("__words").alias("n_words"), F.col("__gone").alias("n_removed"), F.col("__kept").alias("kept_sha256")
    )
