"""License scans by a positional index of licence words (operator 9), in DataFrame functions only.

One scan keeps, per text, the positions of the words that occur in licence templates. Their document
frequencies over the whole corpus give IDF weights. All indexed words of a file are looked up in the
templates' postings and intersected by relative position (file position minus template position), so
one notice never hides another; an offset whose postings hold enough of the template's weight is verified by the
template's mandatory phrase near it. The base phrases are found by the same intersection, complete.

Defined cases: words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z; null and empty
texts have none, no labels and score 0; repeated rows give repeated results; a null id stays null; other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storyspark.llm.common import lower_ascii
from storyspark.session import written

# FIXED: base phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
# FIXED: label, opening or notice of the licence, and the phrase that must stand near it.
TEMPLATES = [
    ("mit", "released under the mit license", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software",
     "permission is hereby granted"),
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license"),
    ("gpl-3.0", "licensed under the gnu general public license version 3", "general public license"),
    ("lgpl", "licensed under the gnu lesser general public license", "lesser general public license"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-4.0", "licensed under cc by 4 0", "cc by 4"),
    ("cc-by-4.0", "licensed under a creative commons attribution 4 0 international license",
     "creative commons attribution"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
     "source and binary forms"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee",
     "permission to use copy"),
    ("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("unlicense", "this is free and unencumbered software released into the public domain",
     "unencumbered software"),
]
# FIXED: template words too common to index; phrases still use them.
PLAIN = "a and any are for in into is of or the this to with".split()
#: Share of a template's indexed IDF weight that one offset must hold.
ENOUGH = 0.6
#: Words between a template's offset and its mandatory phrase at most, beyond the template itself.
NEAR = 3


def _constants() -> tuple[list[tuple], list[tuple]]:
    """Postings ``(word, template, position)`` and phrase postings ``(word, phrase, position)``."""
    postings = [(w, k, i) for k, (_, text, _) in enumerate(TEMPLATES) for i, w in enumerate(text.split())
                if w not in PLAIN]
    phrases = sorted({*BASE, *(phrase for *_, phrase in TEMPLATES)})
    return postings, [(w, p, i) for p in phrases for i, w in enumerate(p.split())]


def _labels(values: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(values)), ",")


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_words``, ``n_base``, ``first_word``, ``last_word``, ``base_labels``, ``labels``,
    ``score`` (the largest share of a verified template's weight, 0 without one)."""
    spark = docs.sparkSession
    postings, phrases = _constants()
    vocabulary = sorted({w for w, *_ in postings} | {w for w, *_ in phrases})
    split = docs.select(F.col(id_col).alias("doc_id"), F.filter(F.split(
        F.coalesce(text_col, F.lit("")), r"[\x00-/:-@\[-`{-\x7F]+"), lambda w: w != "").alias("words"))
    # lower() finds what may match; lower-casing A-Z alone decides.
    seen = F.filter(F.transform("words", lambda w, i: F.struct(w.alias("word"), i.alias("at"))),
                    lambda e: F.lower(e["word"]).isin(vocabulary))
    seen = F.filter(F.transform(seen, lambda e: F.struct(lower_ascii(e["word"]).alias("word"), e["at"].alias("at"))),
                    lambda e: e["word"].isin(vocabulary))
    files = written(split.select("doc_id", F.size("words").cast("long").alias("n_words"), seen.alias("seen"))
                    .withColumn("row", F.monotonically_increasing_id()), "licence-words")
    number = files.count()
    met = files.where(F.size("seen") > 0).select("row", "seen")
    # A word counts once per file; at most one row per word of the fixed vocabulary comes back.
    frequency = (met.select(F.explode(F.array_distinct(F.col("seen.word"))).alias("word"))
                 .groupBy("word").agg(F.count("*").alias("df")).collect())
    frequency = {r.word: r.df for r in frequency}
    idf = (spark.createDataFrame([(w, frequency.get(w, 0)) for w in vocabulary], "word string, df long")
           .select("word", F.log(F.lit(number + 1.0) / (F.col("df") + 1.0)).alias("idf")))

    phrase_table = spark.createDataFrame(phrases, "word string, phrase string, place int")
    lengths = {p: len(p.split()) for _, p, _ in phrases}
    rows = met.select("row", F.inline("seen"))
    long_enough = F.when(F.lit(False), 0)
    for p, n in lengths.items():
        long_enough = long_enough.when(F.col("phrase") == p, n)
    places = written(rows.join(F.broadcast(phrase_table), "word")
                     .groupBy("row", "phrase", (F.col("at") - F.col("place")).alias("start"))
                     .agg(F.count("*").alias("n")).where(F.col("n") == long_enough)
                     .select("row", "phrase", "start"), "places")

    index = written(spark.createDataFrame(postings, "word string, template int, place int").join(idf, "word"), "index")
    whole = index.groupBy("template").agg(F.sum("idf").alias("whole"))
    table = spark.createDataFrame([(k, label, phrase, len(text.split())) for k, (label, text, phrase) in
                                   enumerate(TEMPLATES)], "template int, label string, phrase string, size int")
    found = (rows.join(F.broadcast(index), "word")
             .groupBy("row", "template", (F.col("at") - F.col("place")).alias("offset"))
             .agg(F.sum("idf").alias("held"))
             .join(F.broadcast(whole), "template").join(F.broadcast(table), "template")
             .withColumn("share", F.when(F.col("whole") > 0, F.least(F.lit(1.0), F.col("held") / F.col("whole")))
                         .otherwise(0.0))
             .where(F.col("share") >= ENOUGH))
    verified = found.join(places, ["row", "phrase"]).where(
        (F.col("start") >= F.col("offset") - NEAR) & (F.col("start") <= F.col("offset") + F.col("size") + NEAR))
    by_method = verified.groupBy("row").agg(F.max("share").alias("score"), F.collect_set("label").alias("more"))
    base = places.where(F.col("phrase").isin(list(BASE)))
    label = F.create_map(*[F.lit(x) for pair in BASE.items() for x in pair])
    by_base = base.groupBy("row").agg(
        F.count("*").alias("n_base"), F.min("start").cast("long").alias("first_word"),
        F.max("start").cast("long").alias("last_word"), F.collect_set(F.element_at(label, F.col("phrase"))).alias("own"))
    nothing = F.array().cast("array<string>")
    own, more = F.coalesce("own", nothing), F.coalesce("more", nothing)
    return (files.select("row", "doc_id", "n_words").join(by_base, "row", "left").join(by_method, "row", "left")
            .select(F.col("doc_id").alias(id_col), "n_words",
                    F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"), "first_word", "last_word",
                    _labels(own).alias("base_labels"), _labels(F.concat(own, more)).alias("labels"),
                    F.coalesce("score", F.lit(0.0)).alias("score")))
