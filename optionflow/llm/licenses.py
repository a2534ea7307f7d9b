"""License scans by diagonal voting, in DataFrame functions only.

Every text is cut into words and its rolling word pairs are hashed. The pairs join the
positions of all pairs of a fixed set of license texts; a hit at text position p and
template position t votes for the diagonal p - t. A phrase stands in a text word by word where
one diagonal has all of its votes. A longer notice that was edited leaves votes on
neighbouring diagonals (a word put in or left out moves the rest by one): those merge, and the
merged span is verified by the share of the template that it holds, by how densely
it is filled and by the words that tell the license from its siblings, all of which it must hold.

The texts are exploded where they are read and joined to the template table, which is fixed and
small and therefore broadcast; only hits are shuffled, once, by document. A marker element per
document takes the same way, so documents without hits arrive too and nothing is
joined back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

# What separates words; phrases and their labels.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Notices of public licenses, by label.
NOTICES = (
    ("apache-2.0", "licensed under the apache license version 2 0"),
    (
        "apache-2.0",
        "you may not use this file except in compliance with the license you may obtain a copy of the license at "
        "http www apache org licenses license 2 0",
    ),
    (
        "apache-2.0",
        "unless required by applicable law or agreed to in writing software distributed under the license is "
        "distributed on an as is basis without warranties or conditions of any kind either express or implied",
    ),
    ("gpl-3.0", "licensed under the gnu general public license version 3"),
    (
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
        "public license as published by the free software foundation",
    ),
    (
        "lgpl",
        "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser "
        "general public license as published by the free software foundation",
    ),
    (
        "lgpl",
        "this library is free software you can redistribute it and or modify it under the terms of the gnu library "
        "general public license as published by the free software foundation",
    ),
    ("mit", "released under the mit license"),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction",
    ),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that "
        "the following conditions are met",
    ),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
        "granted provided that the above copyright notice and this permission notice appear in all copies",
    ),
    (
        "mpl-2.0",
        "this source code form is subject to the terms of the mozilla public license v 2 0",
    ),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("cc-by-4.0", "licensed under cc by 4 0"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0"),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0"),
    ("cc-by-4.0", "this work is licensed under a creative commons attribution 4 0 international license"),
)

# Words that tell a license from siblings with other terms. A span must hold all pairs of those that
# its template has: "by nc 4 0" or "version 2" are no edits of "by 4 0" and "version 3".
TELLING = (
    "apache license",
    "version 2 0",
    "license 2 0",
    "gnu general public license",
    "gnu lesser general public license",
    "gnu library general public license",
    "version 3",
    "mozilla public license",
    "v 2 0",
    "cc by 4 0",
    "cc by nc 4 0",
    "cc by sa 4 0",
    "creative commons attribution 4 0",
)

#: Diagonals this far apart belong to one span; share of a template, and of a span's places, that must be hit.
APART, COVERAGE, DENSITY = 3, 0.8, 0.6

MARK = -1  # template number of the marker


def pair_hash(a: Column, b: Column) -> Column:
    return F.xxhash64(a, b)


def known() -> list[tuple[str, str, bool]]:
    """(label, text, phrase) of all templates, by number."""
    return [(label, text, True) for text, label in PHRASES.items()] + [(label, text, False) for label, text in NOTICES]


def telling() -> Column:
    """Map from template to the positions of the word pairs that a span of it must hold."""
    entries = []
    for number, (_, text, _) in enumerate(known()):
        words, must = text.split(), set()
        for key in map(str.split, TELLING):
            for at in range(len(words) - len(key) + 1):
                if words[at : at + len(key)] == key:
                    must.update(range(at, at + len(key) - 1))
        entries += [F.lit(number), F.array(*map(F.lit, sorted(must))).cast("array<int>")]
    return F.create_map(*entries)


def templates(spark: SparkSession) -> DataFrame:
    """(gram, template, at, pairs, label, phrase): the word pairs of all phrases and notices, and the marker."""
    rows = [(None, None, MARK, 0, 1, None, False)]
    for number, (label, text, phrase) in enumerate(known()):
        words = text.split()
        rows += [(a, b, number, at, len(words) - 1, label, phrase) for at, (a, b) in enumerate(zip(words, words[1:]))]
    ddl = "a string, b string, template int, at int, pairs int, label string, phrase boolean"
    hashed = pair_hash(F.xxhash64("a"), F.xxhash64("b"))
    table = spark.createDataFrame(rows, ddl)
    return table.select(F.when(F.col("a").isNull(), F.lit(0)).otherwise(hashed).alias("gram"), *table.columns[2:])


def hits(docs: DataFrame, id: str, text: str) -> DataFrame:
    """(id, body, n_words, place, template, at, pairs, label, phrase): word pairs that templates hold, and a marker row each."""
    cut = docs.select(
        F.col(id).alias("id"),
        F.xxhash64(text).alias("body"),
        F.transform(
            F.array_remove(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), SEPARATORS), ""), lambda w: F.xxhash64(w)
        ).alias("words"),
    )
    n = F.size("words")
    pairs = F.zip_with(
        F.slice("words", 1, F.greatest(n - 1, F.lit(0))),
        F.slice("words", 2, F.greatest(n - 1, F.lit(0))),
        pair_hash,
    )
    grams = cut.select("id", "body", n.cast("bigint").alias("n_words"), F.concat(pairs, F.array(F.lit(0).cast("bigint"))).alias("grams"))
    exploded = grams.select("id", "body", "n_words", F.posexplode("grams").alias("place", "gram"))
    return exploded.join(F.broadcast(templates(docs.sparkSession)), "gram").drop("gram")


def scan(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per document: id, n_words, n_base, first_word, last_word, base_labels, labels, score, n_spans.

    `n_base` counts the places of all phrases, `first_word` and `last_word` are the smallest and largest start
    (null without one). `labels` holds the base labels and those of verified spans. `score` is the
    largest share of a template that a verified span or a phrase holds, 0 without one. Null and empty texts
    have no words. Documents with equal id and text each have a row. A null id is an
    id. Other columns are ignored. An empty table gives no rows.
    """
    doc = ["id", "body", "n_words"]
    found = hits(docs, id, text).repartition("id", "body")
    lines = found.groupBy(*doc, "template", "pairs", "label", "phrase", (F.col("place") - F.col("at")).alias("diagonal")).agg(
        F.collect_set("at").alias("at"), F.count("*").alias("rows")
    )
    along = W.partitionBy(*doc, "template").orderBy("diagonal")
    far = F.col("diagonal") - F.lag("diagonal").over(along) > F.when(F.col("phrase"), 0).otherwise(APART)
    numbered = lines.withColumn("far", F.coalesce(far, F.lit(True)).cast("int"))
    numbered = numbered.withColumn("span", F.sum("far").over(along.rowsBetween(W.unboundedPreceding, 0)))
    spans = numbered.groupBy(*doc, "template", "pairs", "label", "phrase", "span").agg(
        F.array_distinct(F.flatten(F.collect_list("at"))).alias("at"),
        F.min(F.col("diagonal") + F.array_min("at")).alias("first"),
        F.max(F.col("diagonal") + F.array_max("at") + 2).alias("end"),
        F.sum("rows").alias("rows"),
    )
    spans = spans.withColumn("held", F.size("at"))
    mark = F.col("template") == MARK
    share = F.col("held") / F.col("pairs")
    dense = F.col("held") + 1 >= F.lit(DENSITY) * (F.col("end") - F.col("first"))
    base = F.col("phrase") & (F.col("held") == F.col("pairs"))
    told = F.size(F.array_except(telling()[F.col("template")], F.col("at"))) == 0
    noted = ~mark & ~F.col("phrase") & (share >= COVERAGE) & dense & told
    label = lambda when: F.array_sort(F.collect_set(F.when(when, F.col("label"))))
    results = spans.groupBy(*doc).agg(
        F.max(F.when(mark, F.col("rows"))).alias("copies"),
        F.count_if(base).alias("n_base"),
        F.min(F.when(base, F.col("first"))).cast("bigint").alias("first_word"),
        F.max(F.when(base, F.col("first"))).cast("bigint").alias("last_word"),
        F.concat_ws(",", label(base)).alias("base_labels"),
        F.concat_ws(",", label(base | noted)).alias("labels"),
        F.coalesce(F.max(F.when(base | noted, share)), F.lit(0.0)).alias("score"),
        F.count_if(noted).alias("n_spans"),
    )
    each = results.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return each.select(
        F.col("id").alias(id), "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "n_spans"
    )
