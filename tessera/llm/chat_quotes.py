"""Chat formatting: quotation linking.

Messages that answer others quote them with ``>`` before each line, deeper
quotes with more of them.  Quote levels are parsed line by line, a run of lines
of one level is a passage, and hashes of its normalised text find the earlier
message of the conversation that holds it, as a whole or as a part.  A message's
parent is the message its first-level passages come from; roots and depths
follow by pointer doubling.  DataFrame operations only.

Parts are found by doubling too: of a text's units (lines, then words), hashes
of all runs of 1, 2, 4, ... are built from each other, and a run of any length is
told by the two such runs that cover it from both ends.  So a passage of n units
is one hash, and an equi-join with the runs of n units of the conversation's
messages finds it wherever it stands.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import materialize, require_columns

MARK = r"^(?:[ \t]*>)+"
ENDS = " \t\r\n"


def normalised(text: Column) -> Column:
    """Lower case, runs of white space as one blank, none at the ends."""
    return F.trim(F.regexp_replace(F.lower(text), r"[\x20\x09-\x0D]+", " "))


def trimmed(text: Column) -> Column:
    return F.regexp_replace(text, r"^[ \t\r\n]+|[ \t\r\n]+$", "")


#: Units of a text, none empty: lines find quotes of whole lines cheaply, words also re-wrapped, cut and trimmed ones.
UNITS = {
    "lines": lambda text: F.array_remove(F.transform(F.split(text, "\n"), normalised), ""),
    "words": lambda text: F.array_remove(F.split(normalised(text), " "), ""),
}
#: Passages up to which their hashes are broadcast (16 bytes each); beyond it, all runs are shuffled.
BROADCAST_PASSAGES = 500_000


def _doubled(hashes: Column) -> Column:
    """Array of arrays: at place j the hashes of all runs of 2^j units, from a non-empty array of unit hashes."""

    def longer(rows: Column, j: Column) -> Column:
        last, step = F.get(rows, j - 1), F.pow(F.lit(2), j - 1).cast("int")
        pairs = F.transform(F.sequence(F.lit(0), F.size(last) - 1 - step), lambda i: F.xxhash64(F.get(last, i), F.get(last, i + step)))
        return F.when(j == 0, rows).otherwise(F.concat(rows, F.array(pairs)))

    return F.aggregate(F.sequence(F.lit(0), F.length(F.bin(F.size(hashes))) - 1), F.array(hashes), longer)


def _run_hashes(rows: Column, n: Column, size: Column) -> Column:
    """Hashes of all runs of ``size`` of the ``n`` units that ``rows`` were doubled from, in order."""
    k = F.length(F.bin(size)) - 1
    row, step = F.get(rows, k), size - F.pow(F.lit(2), k).cast("int")
    return F.transform(F.sequence(F.lit(0), n - size), lambda i: F.xxhash64(size, F.get(row, i), F.get(row, i + step)))


def _parts_found(asked: DataFrame, placed: DataFrame, unit: str) -> DataFrame | None:
    """(m, level, run, later): the latest earlier message that holds the passage's units in a row; None: nothing to ask.

    ``asked`` has m, level, run, conv, turn and text, ``placed`` conv, turn and body.
    """

    def shaped(df: DataFrame, c: str) -> DataFrame:
        hashed = df.withColumn("u", F.transform(UNITS[unit](F.col(c)), lambda x: F.xxhash64(x))).drop(c).withColumn("n", F.size("u"))
        return hashed.filter("n > 0").withColumn("rows", _doubled(F.col("u")))

    own = F.get(_run_hashes(F.col("rows"), F.col("n"), F.col("n")), F.lit(0))
    want = materialize(shaped(asked, "text").select("m", "level", "run", "conv", "turn", "n", own.alias("h")), f"chat-{unit}-asked")
    many = want.count()
    if not many:
        return None
    # written out, so that the join reads it straight and a very long conversation can be split
    sizes = materialize(want.groupBy("conv").agg(F.collect_set("n").alias("sizes")), f"chat-{unit}-sizes")
    held = shaped(placed.select("conv", F.col("turn").alias("from"), "body").join(sizes, "conv"), "body")
    sized = held.select("conv", "from", "n", "rows", F.explode("sizes").alias("size")).filter("size <= n")
    index = sized.select("conv", "from", F.explode(F.array_distinct(_run_hashes(F.col("rows"), F.col("n"), F.col("size")))).alias("h"))
    if many <= BROADCAST_PASSAGES:
        index = index.join(F.broadcast(want.select("h").distinct()), "h", "left_semi")
    return want.join(index, ["conv", "h"]).filter(F.col("from") < F.col("turn")).groupBy("m", "level", "run").agg(F.max("from").alias("later"))


def passages(messages: DataFrame) -> DataFrame:
    """(m, level, run, text) of ``messages`` (m, text): maximal runs of lines of one quote level."""
    lines = messages.select("m", F.posexplode(F.split("text", "\n")).alias("pos", "line")).select(
        "m",
        "pos",
        F.length(F.regexp_replace(F.regexp_extract("line", MARK, 0), "[ \t]", "")).alias("level"),
        F.regexp_replace("line", MARK + "[ ]?", "").alias("line"),
    )
    # a message's lines meet in one task; a message is one row of the input
    order = Window.partitionBy("m").orderBy("pos")
    turned = lines.withColumn("new", (F.col("level") != F.coalesce(F.lag("level").over(order), F.lit(-1))).cast("int"))
    runs = turned.withColumn("run", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "line"))), lambda x: x["line"]), "\n")
    return runs.groupBy("m", "level", "run").agg(text.alias("text"))


def _chains(parents: DataFrame, max_rounds: int = 40) -> DataFrame:
    """(conv, turn, root_turn, depth) of ``parents`` (conv, turn, parent): doubling until all point at roots.

    Only messages that do not yet point at a root take part in a round's join.
    """
    start = parents.select(
        "conv", "turn", F.coalesce("parent", "turn").alias("top"), F.col("parent").isNotNull().cast("long").alias("depth"),
        F.col("parent").isNull().alias("done"),
    )
    state = materialize(start, "chat-chains")
    for _ in range(max_rounds):
        open_ones = state.filter("not done")
        if not open_ones.limit(1).count():
            return state.select("conv", "turn", F.col("top").alias("root_turn"), "depth")
        up = state.select(
            F.col("conv").alias("c"), F.col("turn").alias("t"), F.col("top").alias("over"), F.col("depth").alias("more"), F.col("done").alias("up_done")
        )
        # a linked message was found in the table, so its row is there
        step = open_ones.join(up, (F.col("conv") == F.col("c")) & (F.col("top") == F.col("t"))).select(
            "conv", "turn", F.col("over").alias("top"), (F.col("depth") + F.col("more")).alias("depth"), F.col("up_done").alias("done")
        )
        state = materialize(state.filter("done").unionByName(step), "chat-chains")
    raise RuntimeError("reply chains did not settle")


def link_quotes(
    messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """Messages without quotes, with the place of each in its reply tree; one row for each input row.

    Returns the conversation, turn and role, ``body`` (the unquoted lines,
    without white space at the ends), ``n_quotes`` (passages with any text),
    ``max_level``, ``n_linked`` (passages found in an earlier message of the
    conversation), ``parent_turn`` (the latest message that a first-level
    passage comes from), ``root_turn`` and ``depth`` (0: no parent) and
    ``chat`` (the message as ``<|role|>``, a line feed and the body).

    A passage is found when its words stand in a row in an earlier message's
    unquoted text, in any case and wrapping: the whole of it, some lines or
    paragraphs, a sentence.  The latest such message counts.  Messages without conversation or turn are
    given back without links; their root is their own turn.  Several messages
    of one turn share its place in the tree.  A null text counts as empty, a
    null role as ``user`` in ``chat``; repeated rows get equal answers; an
    empty table gives no rows; other columns are ignored.
    """
    require_columns(messages, conv_col, turn_col, role_col, text_col)
    own = materialize(
        messages.select(
            F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
        )
        .groupBy("conv", "turn", "role", "text")
        .agg(F.count(F.lit(1)).alias("copies"))
        .select(F.sha2(F.to_json(F.struct(F.col("conv").alias("c"), F.col("turn").alias("t"), F.col("role").alias("r"), F.col("text").alias("x"))), 256).alias("m"), "*"),
        "chat-messages",
    )
    quoting = own.filter(F.col("text").rlike("(?m)" + MARK))
    parts = materialize(passages(quoting.select("m", "text")), "chat-passages")
    said = parts.filter("level = 0")
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("run", "text"))), lambda x: x["text"]), "\n")
    bodies = own.join(
        quoting.select("m").join(said.groupBy("m").agg(joined.alias("said")), "m", "left").withColumn("quoting", F.lit(True)), "m", "left"
    ).withColumn("body", trimmed(F.when(F.col("quoting"), F.coalesce("said", F.lit(""))).otherwise(F.col("text"))))
    bodies = materialize(bodies.select("m", "conv", "turn", "role", "copies", "body"), "chat-bodies")

    placed = bodies.filter(F.col("conv").isNotNull() & F.col("turn").isNotNull())
    whole = placed.select("conv", "turn", normalised(F.col("body")).alias("t"))
    paragraphs = placed.select("conv", "turn", F.explode(F.split("body", r"\n[ \t\r]*\n")).alias("t"))
    runs = said.join(placed.select("m", "conv", "turn"), "m").select("conv", "turn", "text")
    originals = (
        whole.unionByName(paragraphs.select("conv", "turn", normalised(F.col("t")).alias("t")))
        .unionByName(runs.select("conv", "turn", normalised(F.col("text")).alias("t")))
        .filter("t <> ''")
        .select("conv", F.col("turn").alias("from"), F.sha2("t", 256).alias("h"))
        .distinct()
    )
    quotes = parts.filter("level > 0").select("m", "level", "run", normalised(F.col("text")).alias("t")).filter("t <> ''")
    asked = quotes.join(placed.select("m", "conv", "turn"), "m", "left").select("m", "level", "run", "conv", "turn", F.sha2("t", 256).alias("h"))
    keys = ["m", "level", "run"]
    found = materialize(
        asked.join(originals, ["conv", "h"], "left")
        .groupBy(*keys, "conv", "turn")
        .agg(F.max(F.when(F.col("from") < F.col("turn"), F.col("from"))).alias("from")),
        "chat-found",
    )
    # of deeper passages it only counts that they are found; none can be later than the turn before
    unsettled = F.col("from").isNull() | ((F.col("level") == 1) & (F.col("from") != F.col("turn") - 1))
    for unit in UNITS:
        still = found.filter(unsettled & F.col("conv").isNotNull() & F.col("turn").isNotNull()).select(*keys, "conv", "turn")
        part = _parts_found(still.join(parts, keys), placed, unit)
        if part is not None:
            found = materialize(found.join(part, keys, "left").withColumn("from", F.greatest("from", "later")).drop("later"), "chat-found")
    linked = (
        found
        .groupBy("m")
        .agg(
            F.count(F.lit(1)).alias("n_quotes"),
            F.max("level").cast("long").alias("max_level"),
            F.count("from").alias("n_linked"),
            F.max(F.when(F.col("level") == 1, F.col("from"))).alias("parent_turn"),
        )
    )
    known = materialize(bodies.join(linked, "m", "left"), "chat-linked")
    parents = known.filter(F.col("conv").isNotNull() & F.col("turn").isNotNull())
    chains = _chains(parents.groupBy("conv", "turn").agg(F.max("parent_turn").alias("parent")))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return (
        known.join(chains, ["conv", "turn"], "left")
        .withColumn("__i", F.explode(F.sequence(F.lit(1), "copies")))
        .select(
            F.col("conv").alias(conv_col),
            F.col("turn").alias(turn_col),
            F.col("role").alias(role_col),
            "body",
            zero("n_quotes"),
            zero("max_level"),
            zero("n_linked"),
            "parent_turn",
            F.coalesce("root_turn", "turn").alias("root_turn"),
            zero("depth"),
            F.concat(F.lit("<|"), F.coalesce("role", F.lit("user")), F.lit("|>\n"), F.col("body")).alias("chat"),
        )
    )


def in_reply_order(linked: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn") -> DataFrame:
    """Conversations one after another, each thread by turn: a range-partitioned sort, no group in one task."""
    return linked.orderBy(conv_col, "root_turn", turn_col)


def as_mail(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", text_col: str = "text") -> DataFrame:
    """``messages`` as a mail thread: each text below a quote of the turn before it and, one level deeper, of that before.

    By turns the quote is the whole text, its middle line or its paragraphs but the last.  One row for each input row; where several messages share a turn, the first text by order is quoted.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    # written out, so that the joins below read it straight and a turn with very many replies can be split
    before = materialize(
        messages.select(F.col(conv_col).alias("__c"), F.col(turn_col).alias("__t"), text.alias("__x"))
        .filter(F.col("__c").isNotNull() & F.col("__t").isNotNull())
        .groupBy("__c", "__t")
        .agg(F.min("__x").alias("__x")),
        "chat-before",
    )

    def back(df: DataFrame, by: int) -> DataFrame:
        old = before.toDF("__c", "__t", f"__x{by}")
        return df.join(old, (F.col(conv_col) == F.col("__c")) & (F.col(turn_col) - by == F.col("__t")), "left").drop("__c", "__t")

    def cut(by: int) -> Column:
        whole, said = F.col(f"__x{by}"), lambda x: normalised(x) != ""
        lines = F.filter(F.split(whole, "\n"), said)
        paragraphs = F.filter(F.split(whole, r"\n[ \t\r]*\n"), said)
        some = F.array_join(F.slice(paragraphs, 1, F.size(paragraphs) - 1), "\n\n")
        kind = F.pmod(F.col(turn_col) + by, F.lit(3))
        return F.when((kind == 1) & (F.size(lines) > 1), F.get(lines, (F.size(lines) / 2).cast("int"))).when(
            (kind == 2) & (F.size(paragraphs) > 1), some
        ).otherwise(whole)

    quoted = lambda by, mark: F.concat(F.lit(mark), F.replace(cut(by), F.lit("\n"), F.lit("\n" + mark)))
    parts = F.array_compact(F.array(quoted(2, ">> "), quoted(1, "> ")))
    mail = F.when(F.size(parts) > 0, F.concat(F.array_join(parts, "\n"), F.lit("\n\n"), text)).otherwise(text)
    return back(back(messages, 1), 2).withColumn(text_col, mail).select(*messages.columns)
