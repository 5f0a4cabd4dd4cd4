"""License scans by diagonal voting, in DataFrame functions only.

Every run of k words of every text is hashed and joined to the places of the templates' runs. A match of text place p
with template place t votes for the diagonal p - t of that template. Diagonals of one template that lie within a few
words of each other are merged (words put in or left out shift the diagonal), which gives candidate spans; a span is
verified by the share of the template's runs that it holds. Matches compare the runs' words themselves, so hashes
decide nothing alone.

Two kinds of templates are used: phrases (runs of two words; a place counts if all the phrase's runs vote for one
diagonal, that is, if its words stand consecutively) and notices (runs of four words; merged diagonals, verified by
their share of the notice).

Templates are a small fixed table, broadcast behind a check of its size; beyond it the join is an ordinary shuffle, of a row
for each place that holds the run there and not its text.

Defined cases: null text is the empty text (no words, no labels, score 0); repeated rows each give a row; ties of
spans are broken by the smaller start; very long texts are scanned whole, a row for each word; columns other than doc_id
and text are not read, so their names cannot clash; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

# The phrases and labels of the contract.
PHRASES = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))

# Opening words of public license notices, and the labels that they give.
NOTICES = (
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit"),
    ("licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license", "apache"),
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", "gpl"),
    ("this work is licensed under the gnu general public license version 3", "gpl-3.0"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "bsd"),
    ("this source code form is subject to the terms of the mozilla public license", "mpl"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "isc"),
    ("this work is licensed under a creative commons attribution 4 0 international license", "cc-by"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
)

PHRASE_RUN, NOTICE_RUN = 2, 4
#: Diagonals of one template at most this far apart are one span.
NEIGHBOURS = 3
#: Share of a notice's runs that a span must hold.
LEAST_SHARE = 0.6
#: Template runs beyond this are joined by a shuffle instead of a broadcast.
MOST_BROADCAST_RUNS = 200_000


#: The row that counts a text, whatever it holds.
MARK = -1


def template_runs(spark: SparkSession, phrases=PHRASES, notices=NOTICES) -> tuple[DataFrame, int]:
    """Rows (h, gram, k, t, label, place, runs) of all runs of all templates, and their number; the row of MARK matches
    the one marker row of each text."""
    rows = [("", 0, MARK, "", 0, 1)]
    for t, (text, label, k) in enumerate([(*p, PHRASE_RUN) for p in phrases] + [(*n, NOTICE_RUN) for n in notices]):
        words = text.split(" ")
        runs = max(len(words) - k + 1, 0)
        rows += [(" ".join(words[i : i + k]), k, t, label, i, runs) for i in range(runs)]
    table = spark.createDataFrame(rows, "gram string, k int, t int, label string, place int, runs int")
    words = F.split("gram", " ")
    run = lambda k: F.xxhash64(*[F.get(words, F.lit(i)) for i in range(k)])
    h = F.when(F.col("k") == 0, F.lit(0).cast("long")).when(F.col("k") == PHRASE_RUN, run(PHRASE_RUN)).otherwise(run(NOTICE_RUN))
    return table.withColumn("h", h), len(rows)


def votes(keyed: DataFrame, templates: DataFrame, broadcast: bool) -> DataFrame:
    """keyed (keys, w: words) -> keys, n_words, t, k, label, runs, d (diagonal), votes, lo, hi (first and last place).
    Places are numbered twice, once for each length of run; -1 is the marker."""
    keys = [c for c in keyed.columns if c != "w"]
    at = keyed.select(*keys, "w", F.explode(F.sequence(F.lit(-1), 2 * F.size("w") - 1)).alias("i"))
    at = at.select(*keys, "w", "i", F.shiftright("i", 1).alias("p"))
    run = lambda k: [F.try_element_at("w", F.col("p") + j + 1) for j in range(k)]
    even = F.col("i").bitwiseAND(F.lit(1)) == 0
    at = at.withColumn("h", F.when(F.col("i") < 0, F.lit(0).cast("long")).when(even, F.xxhash64(*run(PHRASE_RUN))).otherwise(F.xxhash64(*run(NOTICE_RUN))))
    spelled = {k: F.concat_ws(" ", *run(k)) for k in (PHRASE_RUN, NOTICE_RUN)}
    n_words = F.size("w").cast("long").alias("n_words")
    if broadcast:  # words are put together only where a run matches
        found = at.join(F.broadcast(templates), ["h"])
    else:  # what is shuffled is the run of a place, not the text that it stands in
        ran = F.when(F.col("i") >= 0, F.when(even, spelled[PHRASE_RUN]).otherwise(spelled[NOTICE_RUN])).alias("ran")
        found = at.select(*keys, n_words, "i", "p", "h", ran).join(templates.hint("merge"), ["h"])
        spelled, n_words = dict.fromkeys(spelled, F.col("ran")), "n_words"
    same = F.when(F.col("k") == 0, F.col("i") < 0).when(F.col("k") == PHRASE_RUN, (F.col("i") >= 0) & even & (spelled[PHRASE_RUN] == F.col("gram"))).otherwise((F.col("i") >= 0) & ~even & (spelled[NOTICE_RUN] == F.col("gram")))
    found = found.where(same).select(*keys, n_words, "t", "k", "label", "runs", "p", (F.col("p") - F.col("place")).alias("d"))
    return found.groupBy(*keys, "n_words", "t", "k", "label", "runs", "d").agg(F.count(F.lit(1)).alias("votes"), F.min("p").alias("lo"), F.max("p").alias("hi"))


def scan(docs: DataFrame, phrases=PHRASES, notices=NOTICES) -> DataFrame:
    """One row for each row of docs (doc_id, text): doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score, spans (label, first_word, last_word, share; verified spans and full phrases, by place)."""
    templates, n = template_runs(docs.sparkSession, phrases, notices)
    text = F.coalesce("text", F.lit(""))
    keyed = docs.select("doc_id", F.xxhash64(text).alias("h1"), F.crc32(text).alias("h2"), common.words_of(text).alias("w"))
    lines = votes(keyed, templates, n <= MOST_BROADCAST_RUNS)
    own = ["doc_id", "h1", "h2", "n_words"]
    order = Window.partitionBy(*own, "t").orderBy("d")
    # equal rows voted together: the marker's votes say how many they are
    far = (F.col("k") != NOTICE_RUN) | F.coalesce(F.col("d") - F.lag("d").over(order) > NEIGHBOURS, F.lit(True))
    merged = (
        lines.withColumn("far", far).withColumn("group", F.sum(F.when(F.col("far"), 1).otherwise(0)).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .groupBy(*own, "t", "k", "label", "runs", "group")
        .agg(F.sum("votes").alias("votes"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    )
    entry = F.struct(F.col("lo").cast("long").alias("first_word"), (F.col("hi") + F.col("k") - 1).cast("long").alias("last_word"), "label", "k", "t", "votes", "runs")
    per_text = merged.groupBy(*own).agg(F.max(F.when(F.col("t") == MARK, F.col("votes"))).cast("int").alias("copies"), F.array_sort(F.collect_list(F.when(F.col("t") != MARK, entry))).alias("found"))
    share = lambda x: F.least(F.lit(1.0), x["votes"] / (F.col("copies") * x["runs"]))
    shared = per_text.withColumn("found", F.transform("found", lambda x: F.struct(x["label"].alias("label"), x["first_word"].alias("first_word"), x["last_word"].alias("last_word"), share(x).alias("share"), (x["k"] == PHRASE_RUN).alias("phrase"))))
    places = F.filter("found", lambda x: x["phrase"] & (x["share"] >= 1.0))
    held = F.filter("found", lambda x: F.when(x["phrase"], x["share"] >= 1.0).otherwise(x["share"] >= LEAST_SHARE))
    told = shared.select(*own, "copies", "found", places.alias("places"), held.alias("held"))
    names = lambda c: F.array_join(F.array_sort(F.array_distinct(F.transform(c, lambda x: x["label"]))), ",")
    # an incomplete phrase scores nothing: only notices are told by shares
    shares = F.transform(F.filter("found", lambda x: ~x["phrase"] | (x["share"] >= 1.0)), lambda x: x["share"])
    return told.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min(F.transform("places", lambda x: x["first_word"])).alias("first_word"), F.array_max(F.transform("places", lambda x: x["first_word"])).alias("last_word"),
        names("places").alias("base_labels"), names("held").alias("labels"), F.coalesce(F.array_max(shares), F.lit(0.0)).alias("score"),
        F.transform("held", lambda x: F.struct(x["label"].alias("label"), x["first_word"].alias("first_word"), x["last_word"].alias("last_word"), x["share"].alias("share"))).alias("spans"),
        F.explode(F.sequence(F.lit(1), "copies")).alias("_copy"),
    ).drop("_copy")


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(common.read(spark, sf_dir, "documents").select("doc_id", "text")).drop("spans")
