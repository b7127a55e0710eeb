"""Licence scan by a positional index of rare licence words.

DataFrame functions only. Texts are split into lower-case words. Only texts that hold an index
word go on; their words are staged once. For each of them the licence words with the highest
inverse document frequency (counted over all texts) are looked up in the postings of the
templates; postings that agree on the relative position (word number in the text minus word
number in the template) are added up, weighted by that frequency. A template counts where the
share found is at least ``LEAST_SHARE`` and its mandatory phrase stands at the place that the
relative position foretells. Fixed phrases are searched for as well, whatever the index says.

The postings are a fixed table of a few hundred rows; the word counts come to one row per index
word. Both are broadcast. Null and empty texts have no words. Repeated rows are scanned apart.
Extra columns are ignored.
"""

from __future__ import annotations

import string
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rescuelens.llm import staging

# --- fixed values -------------------------------------------------------------------------

GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: phrases that always give a label, wherever they stand
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: label, mandatory phrase, opening or notice of the licence
TEMPLATES = [
    ("gpl", "gnu general public license",
     "this program is free software you can redistribute it and or modify it under the terms of "
     "the gnu general public license as published by the free software foundation"),
    ("lgpl", "gnu lesser general public license",
     "this library is free software you can redistribute it and or modify it under the terms of "
     "the gnu lesser general public license as published by the free software foundation"),
    ("apache", "apache license",
     "licensed under the apache license version 2 0 the license you may not use this file except "
     "in compliance with the license"),
    ("mit", "permission is hereby granted free of charge",
     "permission is hereby granted free of charge to any person obtaining a copy of this software "
     "and associated documentation files the software to deal in the software without restriction"),
    ("bsd", "redistribution and use in source and binary forms",
     "redistribution and use in source and binary forms with or without modification are permitted "
     "provided that the following conditions are met"),
    ("isc", "permission to use copy modify and or distribute this software",
     "permission to use copy modify and or distribute this software for any purpose with or without "
     "fee is hereby granted provided that the above copyright notice and this permission notice "
     "appear in all copies"),
    ("mpl", "mozilla public license",
     "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by", "creative commons attribution",
     "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "cc by nc", "licensed under cc by nc 4 0"),
    ("cc0", "cc0 1 0 universal", "cc0 1 0 universal public domain dedication"),
    ("unlicense", "released into the public domain",
     "this is free and unencumbered software released into the public domain"),
]

#: words that a text must share with a template before its words are looked up
INDEX_WORDS = [
    "apache", "attribution", "binary", "cc", "cc0", "charge", "commons", "compliance", "conditions",
    "copies", "copy", "copyright", "creative", "dedication", "distribute", "documentation", "domain",
    "foundation", "gnu", "granted", "hereby", "international", "lesser", "library", "licence",
    "license", "licensed", "mit", "modification", "modify", "mozilla", "nc", "notice", "obtaining",
    "permission", "permitted", "program", "provided", "public", "published", "purpose",
    "redistribute", "redistribution", "released", "restriction", "software", "source", "terms",
    "unencumbered", "universal", "version",
]

# --- end of fixed values ------------------------------------------------------------------

#: how many of a text's rarest licence words are looked up: all of them, the index is a fixed list
RAREST = len(INDEX_WORDS)
#: weight of an index word that no text holds
UNSEEN = 20
#: least share of a template's weight that has to agree on one relative position
LEAST_SHARE = 0.6


def words_of(text: Column) -> Column:
    lowered = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.array_remove(F.split(lowered, GAPS), "")


def phrase_places(words: Column, phrase: str) -> Column:
    """Where the phrase begins, counted in words. ``words`` must be a column, not a computation."""
    first, *others = phrase.split(" ")
    starts = F.transform(words, lambda w, i: F.when(w == first, i))
    starts = F.filter(starts, lambda i: i.isNotNull())
    if others:
        starts = F.filter(starts, lambda i: reduce(and_, [
            F.get(words, i + k) == word for k, word in enumerate(others, 1)]))
    return starts


def _literal(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def postings(spark) -> DataFrame:
    """(word, template, place, phrase_place) of every index word in every template."""
    wanted = set(INDEX_WORDS)
    rows = []
    for number, (_, phrase, text) in enumerate(TEMPLATES):
        words = text.split(" ")
        parts = phrase.split(" ")
        at = next((k for k in range(len(words)) if words[k:k + len(parts)] == parts), -1)
        rows += [(word, number, place, at) for place, word in enumerate(words) if word in wanted]
    return spark.createDataFrame(rows, "word string, template int, place int, phrase_place int")


def word_weights(candidates: DataFrame, texts: int) -> DataFrame:
    """(word, idf) over all texts: log of 1 plus texts by texts with the word."""
    counts = candidates.select(F.explode(F.array_intersect("words", _literal(INDEX_WORDS))).alias("word"))
    return counts.groupBy("word").agg(F.count("*").alias("texts")).select(
        "word", F.log1p(F.lit(texts) / F.col("texts")).alias("idf"))


def scan(docs: DataFrame) -> DataFrame:
    """Per row: n_words, base places by label, template hits and score.

    Columns: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, hits
    (label, first word, share), the last for the evidence.
    """
    spark = docs.sparkSession
    split = docs.select(F.monotonically_increasing_id().alias("row_key"),
                        F.col("doc_id").cast("long").alias("doc_id"), words_of(F.col("text")).alias("words"))
    rows = staging.stage(split.select(
        "row_key", "doc_id", F.size("words").cast("long").alias("n_words"),
        F.when(F.arrays_overlap("words", _literal(INDEX_WORDS)), F.col("words")).alias("words")), "words")
    candidates = rows.filter("words IS NOT NULL")

    # fixed phrases
    places = {label: phrase_places(F.col("words"), phrase) for phrase, label in BASE.items()}
    based = candidates.select("row_key", *[p.alias(f"at_{k}") for k, p in enumerate(places.values())])
    every = F.flatten(F.array(*[F.col(f"at_{k}") for k in range(len(places))]))
    names = F.array(*[F.when(F.size(f"at_{k}") > 0, F.lit(label)) for k, label in enumerate(places)])
    based = based.select("row_key", F.size(every).cast("long").alias("n_base"),
                         F.array_min(every).cast("long").alias("first_word"),
                         F.array_max(every).cast("long").alias("last_word"),
                         F.array_compact(names).alias("base"))

    # index words, postings and relative positions
    idf = F.broadcast(word_weights(candidates, rows.count()))
    index = postings(spark)
    own = candidates.select("row_key", F.posexplode("words").alias("at", "word")).filter(
        F.col("word").isin(INDEX_WORDS)).join(idf, "word")
    looked_up = own.join(F.broadcast(index), "word")
    weight = index.join(idf, "word", "left").groupBy("template").agg(
        F.sum(F.coalesce("idf", F.lit(float(UNSEEN)))).alias("whole"))
    agree = looked_up.groupBy("row_key", "template", (F.col("at") - F.col("place")).alias("shift")).agg(
        F.sum("idf").alias("found"), F.first("phrase_place").alias("phrase_place"))
    likely = (agree.join(F.broadcast(weight), "template")
              .select("row_key", "template", "shift", "phrase_place",
                      F.least(F.col("found") / F.col("whole"), F.lit(1.0)).alias("share"))
              .filter(F.col("share") >= LEAST_SHARE))
    verified = (likely.groupBy("row_key").agg(F.collect_list(
        F.struct("template", "shift", "phrase_place", "share")).alias("likely"))
        .join(candidates.select("row_key", "words"), "row_key")
        .select("row_key", F.filter("likely", lambda h: _phrase_stands(F.col("words"), h)).alias("hits"))
        .select("row_key", F.transform("hits", lambda h: F.struct(
            F.element_at(_literal([t[0] for t in TEMPLATES]), h["template"] + 1).alias("label"),
            h["shift"].cast("long").alias("first_word"), h["share"].alias("share"))).alias("hits")))

    out = (rows.select("row_key", "doc_id", "n_words").join(based, "row_key", "left")
           .join(verified, "row_key", "left"))
    base = F.coalesce("base", F.array().cast("array<string>"))
    found = F.coalesce(F.transform("hits", lambda h: h["label"]), F.array().cast("array<string>"))
    best = F.coalesce(F.array_max(F.transform("hits", lambda h: h["share"])), F.lit(0.0))
    return out.select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"), "first_word",
        "last_word", F.array_join(F.array_sort(F.array_distinct(base)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, found)), ",").alias("labels"),
        F.when(F.size(base) > 0, F.lit(1.0)).otherwise(best).alias("score"), "hits")


def _phrase_stands(words: Column, hit: Column) -> Column:
    """Whether the template's mandatory phrase stands where the relative position puts it."""
    choice = F.lit(False)
    for number, (_, phrase, _) in enumerate(TEMPLATES):
        stands = F.lit(True)
        for k, word in enumerate(phrase.split(" ")):
            stands = stands & F.coalesce(
                F.get(words, (hit["shift"] + hit["phrase_place"] + k).cast("int")) == word, F.lit(False))
        choice = choice | ((hit["template"] == number) & stands)
    return choice
