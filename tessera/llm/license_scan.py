"""License scans: a positional index of rare licence words.

Licence templates are short word sequences with a mandatory key phrase.  Words
of templates get an IDF over the whole corpus; the index has postings (word,
template, position) for each template's highest-IDF words and its key phrase.
A text that holds one of the rarest words is looked up: its postings are
intersected by relative position (word place minus template place), a place
counts when the rare words found there carry enough of the template's IDF and
every word of the key phrase stands at its place.  DataFrame operations only.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import NOT_WORD, ascii_lower, materialize, require_columns, word_array

RARE_WORDS = 6
MIN_COVER = 0.6


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    key_phrase: str
    base: bool = False


#: Fixed values of the contract: phrases that are found wherever their words stand consecutively.
BASE = (
    Template("mit", "mit license", "mit license", True),
    Template("apache", "apache license", "apache license", True),
    Template("gpl", "general public license", "general public license", True),
)
#: Public licence notices.
NOTICES = (
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "permission is hereby granted free of charge"),
    Template("apache", "licensed under the apache license version 2 0", "apache license version 2 0"),
    Template("gpl", "licensed under the gnu general public license version 3", "gnu general public license"),
    Template("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license", "gnu general public license"),
    Template("lgpl", "under the terms of the gnu lesser general public license", "gnu lesser general public license"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use in source and binary forms"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "with or without fee is hereby granted"),
    Template("mpl", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    Template("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    Template("cc-by", "licensed under a creative commons attribution 4 0 international license", "creative commons attribution"),
    Template("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered software released into the public domain"),
    Template("all-rights-reserved", "all rights reserved", "all rights reserved"),
)


def _words(text: str) -> list[str]:
    return [w for w in re.split(r"[\x00-\x2f\x3a-\x60\x7b-\x7f]+", text.lower()) if w]


def _index(templates: list[Template], idf: dict[str, float]) -> tuple[list[tuple], list[str], list[str]]:
    """(postings, words to look up first, all words of the postings).

    A posting: word, template number, position, weight (0 for words that are
    only in the key phrase), 1 for words of the key phrase.
    """
    postings, first, words = [], set(), set()
    for number, t in enumerate(templates):
        body, phrase = _words(t.text), _words(t.key_phrase)
        at = next(i for i in range(len(body)) if body[i : i + len(phrase)] == phrase)
        by_idf = sorted(set(body), key=lambda w: (-idf[w], w))
        rare = set(body) if t.base else set(by_idf[:RARE_WORDS])
        # every place holds the whole key phrase, so its rarest word finds all of them
        first.add(min(phrase, key=lambda w: (-idf[w], w)))
        for pos, word in enumerate(body):
            must = at <= pos < at + len(phrase)
            if must or word in rare:
                postings.append((word, number, pos, idf[word] if word in rare else 0.0, int(must)))
                words.add(word)
    return postings, sorted(first), sorted(words)


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", notices: tuple[Template, ...] = NOTICES) -> DataFrame:
    """Licence places of every text; one row for each input row.

    Returns ``id_col``, ``n_words``, ``n_base`` (places of base phrases),
    ``first_word`` and ``last_word`` (their smallest and largest start, words
    from 0), ``base_labels``, ``labels`` (distinct, sorted, comma-joined; those
    of ``notices`` too) and ``score`` (best share of a template's IDF found at
    one place, 0 without any).

    Null and empty texts have no words and no places (null starts, empty
    labels, score 0).  Null ids stay null, repeated rows get equal answers, an
    empty table gives no rows, other columns are ignored.
    """
    require_columns(docs, id_col, text_col)
    spark = docs.sparkSession
    templates = [*BASE, *notices]
    vocabulary = sorted({w for t in templates for w in _words(t.text)})  # bounded by the templates
    t = F.col(text_col)
    key = F.xxhash64(F.lit(2), t.isNull(), t)
    tokens = docs.select(F.col(id_col).alias("id"), key.alias("k"), word_array(ascii_lower(t), NOT_WORD).alias("w"))
    lit = lambda ws: F.array(*[F.lit(w) for w in ws])
    rows = materialize(
        tokens.select("id", "k", F.size("w").cast("long").alias("n_words"), F.array_intersect("w", lit(vocabulary)).alias("known")),
        "license-rows",
    )
    n_docs = rows.count()
    df = {r["w"]: r["n"] for r in rows.select(F.explode("known").alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n")).collect()}
    idf = {w: math.log(1 + n_docs / (1 + df.get(w, 0))) or 1.0 for w in vocabulary}
    postings, first, words = _index(templates, idf)
    index = spark.createDataFrame(postings, "word string, template int, tpos int, weight double, must int")
    facts = []
    for number, tpl in enumerate(templates):
        own = [p for p in postings if p[1] == number]
        facts.append((number, tpl.label, tpl.base, float(sum(p[3] for p in own)), sum(p[4] for p in own)))
    facts = spark.createDataFrame(facts, "template int, label string, base boolean, total double, musts int")

    looked_up = (
        tokens.filter(F.arrays_overlap("w", lit(first)))
        .select("k", F.posexplode("w").alias("pos", "word"))
        .filter(F.col("word").isin(words))
        .distinct()  # equal texts count once
    )
    # index and facts: bounded by the templates
    at_place = (
        looked_up.join(F.broadcast(index), "word")
        .groupBy("k", "template", (F.col("pos") - F.col("tpos")).alias("start"))
        .agg(F.sum("weight").alias("weight"), F.sum("must").alias("found"))
        .join(F.broadcast(facts), "template")
        .withColumn("cover", F.least(F.lit(1.0), F.col("weight") / F.col("total")))
        .filter((F.col("found") == F.col("musts")) & (F.col("cover") >= MIN_COVER))
    )
    based = lambda c: F.when(F.col("base"), c)
    per_text = at_place.groupBy("k").agg(
        F.count(based(F.lit(1))).alias("n_base"),
        F.min(based(F.col("start"))).cast("long").alias("first_word"),
        F.max(based(F.col("start"))).cast("long").alias("last_word"),
        F.sort_array(F.collect_set(based(F.col("label")))).alias("base_labels"),
        F.sort_array(F.collect_set("label")).alias("labels"),
        F.max("cover").alias("score"),
    )
    found = materialize(per_text, "license-found")  # so that a text with many copies can be split in the join
    joined = lambda c: F.coalesce(F.array_join(c, ","), F.lit(""))
    return rows.join(found, "k", "left").select(
        F.col("id").alias(id_col),
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word",
        "last_word",
        joined("base_labels").alias("base_labels"),
        joined("labels").alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
