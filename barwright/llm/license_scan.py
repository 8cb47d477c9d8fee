"""License scans by diagonal voting, with DataFrame functions only.

Every pair of neighbouring words of a text (a rolling 2-gram) is joined by its hash to
the places where a template has it, and checked on the pair itself. A match votes for
the diagonal "place in the text less place in the template". Phrases are short
templates that must be met whole on one diagonal. Notices may differ a little: votes on
diagonals at most `BAND` apart are merged, and a merged span is accepted if the
distinct template words that it covers are at least `COVER` of the template and the
span isn't longer than `STRETCH` times the template.

Words: A-Z lower-cased, then [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ . The templates are a
parameter of small size (checked) and are broadcast; matches are found and counted
per text, and a group never holds more than one text's matches.

Results: a null or empty text has no words, no labels and score 0. Null ids stay;
rows with one id and different texts are told apart by the text's hash; repeated rows
come out as often as they come in. Further columns play no part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barwright.llm.store import doc_columns

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
K = 2
# the same pattern with every character by itself: Java looks such a class up in a table, ranges it tries one by one
WORD_BY_TABLE = "[^" + "".join(f"\\x{c:02X}" for c in range(128) if not chr(c).isdigit() and not chr(c).islower()) + "]+"
BAND, COVER, STRETCH = 3, 0.85, 1.25
MAX_TEMPLATE_WORDS = 100_000  # of all templates together; they are broadcast

PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# fixed values: opening words of public license notices, and the label of each
NOTICES = {
    "Released under the MIT License": "mit-notice",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files": "mit-notice",
    "Licensed under the Apache License, Version 2.0": "apache-notice",
    "This work is licensed under the GNU General Public License, version 3": "gpl-notice",
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License": "gpl-notice",
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met": "bsd",
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted": "isc",
    "This Source Code Form is subject to the terms of the Mozilla Public License": "mpl",
    "This is free and unencumbered software released into the public domain": "unlicense",
    "Licensed under CC BY-NC 4.0": "cc-by-nc-4.0",
    "This work is licensed under a Creative Commons Attribution 4.0 International License": "cc-by-4.0",
}


def _words(text):
    upper = "".join(map(chr, range(65, 91)))
    return F.regexp_extract_all(F.translate(text, upper, upper.lower()), F.lit(WORD_BY_TABLE), 0)


def templates(spark: SparkSession, phrases: dict[str, str], notices: dict[str, str]) -> DataFrame:
    """(gram, t_at, template, label, exact, n_grams, size): one row for each place of a gram in a template."""
    values = [(t, label, exact) for exact, group in ((True, phrases), (False, notices)) for t, label in group.items()]
    quote = lambda s: "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"
    rows = ", ".join(f"({i}, {quote(t)}, {quote(label)}, {str(exact).lower()})" for i, (t, label, exact) in enumerate(values))
    t = spark.sql(f"SELECT * FROM VALUES {rows} AS t(template, body, label, exact)").withColumn("w", _words(F.col("body")))
    if t.agg(F.sum(F.size("w"))).first()[0] > MAX_TEMPLATE_WORDS:
        raise ValueError("the templates are too large to be broadcast")
    t = t.filter(F.size("w") >= K).withColumn("size", F.size("w")).withColumn("n_grams", F.size("w") - (K - 1))
    return t.select("template", "label", "exact", "size", "n_grams", F.posexplode(_grams(F.col("w"))).alias("t_at", "gram"))


def _grams(words):
    """All rolling K-grams, space-joined; none for fewer words. `words` is read a few times, not once for each gram."""
    grams = words
    for j in range(1, K):
        n = F.greatest(F.size(words) - j, F.lit(0))
        grams = F.zip_with(F.slice(grams, F.lit(1), n), F.slice(words, F.lit(j + 1), n), lambda a, b: F.concat_ws(" ", a, b))
    return grams


def scan(docs: DataFrame, phrases: dict[str, str] = PHRASES, notices: dict[str, str] = NOTICES) -> DataFrame:
    """(doc_id, text_hash, label, exact, first, last, score): the accepted span of each band, `first` and `last` its words."""
    src = doc_columns(docs).select("doc_id", F.xxhash64("text").alias("text_hash"), _words(F.col("text")).alias("w"))
    grams = src.select("doc_id", "text_hash", F.posexplode(_grams(F.col("w"))).alias("at", "gram")).withColumn("h", F.xxhash64("gram"))
    known = F.broadcast(templates(docs.sparkSession, phrases, notices).withColumn("t_h", F.xxhash64("gram")).withColumnRenamed("gram", "t_gram"))
    hits = (
        grams.join(known, (F.col("h") == F.col("t_h")) & (F.col("gram") == F.col("t_gram")))
        .select("doc_id", "text_hash", "template", "label", "exact", "size", "n_grams", "at", "t_at", (F.col("at") - F.col("t_at")).alias("diagonal"))
        .dropDuplicates(["doc_id", "text_hash", "template", "at", "t_at"])
    )
    text = ["doc_id", "text_hash", "template"]
    order = Window.partitionBy(*text).orderBy("diagonal")
    step = F.col("diagonal") - F.lag("diagonal").over(order)
    gap = F.when(F.col("exact"), 0).otherwise(BAND)
    # matches from a row's own on that a span beginning there may hold; the longest distance is 1 on this scale
    reach = F.col("at") / (F.floor(STRETCH * F.col("size")) - K + 0.5)
    ahead = Window.partitionBy(*text, "band").orderBy(reach).rangeBetween(0, 1)
    spans = (
        hits.withColumn("new", (F.coalesce(step, F.lit(1 << 30)) > gap).cast("int"))
        .withColumn("band", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("votes", F.size(F.collect_set("t_at").over(ahead)))
        .withColumn("last", F.max("at").over(ahead) + (K - 1))
        .groupBy(*text, "band", "label", "exact", "size", "n_grams")
        .agg(F.max(F.struct("votes", (-F.col("at")).alias("before"), "last")).alias("best"))
        .select(*text, "label", "exact", "size", "n_grams", "best.votes", (-F.col("best.before")).alias("first"), "best.last")
    )
    whole = F.col("exact") & (F.col("votes") == F.col("n_grams"))
    covered = (F.col("votes") + (K - 1)) / F.col("size")
    near = ~F.col("exact") & (covered >= COVER)
    return spans.filter(whole | near).select("doc_id", "text_hash", "label", "exact", "first", "last", F.least(covered, F.lit(1.0)).alias("score"))


def label(docs: DataFrame, phrases: dict[str, str] = PHRASES, notices: dict[str, str] = NOTICES) -> DataFrame:
    """One row for each row of `docs`: n_words, places of the phrases, labels and score."""
    found = scan(docs, phrases, notices)
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    base = F.col("exact")
    per_text = found.groupBy(F.col("doc_id").alias("f_id"), F.col("text_hash").alias("f_hash")).agg(
        F.sum(base.cast("long")).alias("n_base"), F.min(F.when(base, F.col("first"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("first"))).cast("long").alias("last_word"), joined(F.when(base, F.col("label"))).alias("base_labels"),
        joined("label").alias("labels"), F.max("score").alias("score"),
    )
    src = doc_columns(docs)
    rows = src.select("doc_id", F.xxhash64("text").alias("text_hash"), F.size(_words(F.col("text"))).cast("long").alias("n_words"))
    out = rows.join(per_text, F.col("doc_id").eqNullSafe(F.col("f_id")) & (F.col("text_hash") == F.col("f_hash")), "left")
    return out.select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )


def query(docs: DataFrame) -> DataFrame:
    return label(docs)


def oracle() -> str:
    """The same for DuckDB, over the view `documents`."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    values = [(t, lab, exact) for exact, group in (("true", PHRASES), ("false", NOTICES)) for t, lab in group.items()]
    rows = ", ".join(f"({i}, {quote(t)}, {quote(lab)}, {exact})" for i, (t, lab, exact) in enumerate(values))
    upper = "".join(map(chr, range(65, 91)))
    words = f"regexp_extract_all(translate({{}}, '{upper}', '{upper.lower()}'), '{WORD}')"
    return f"""
WITH tw AS (SELECT template, label, exact, {words.format("body")} AS w FROM (VALUES {rows}) AS t(template, body, label, exact)),
tg AS (SELECT template, label, exact, len(w) AS size, len(w) - 1 AS n_grams, i - 1 AS t_at, w[i] || ' ' || w[i + 1] AS gram
       FROM tw, unnest(range(1, len(w))) AS r(i)),
d AS (SELECT row_number() OVER () AS rid, doc_id, {words.format("coalesce(text, '')")} AS w FROM documents),
x AS (SELECT rid, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS pos FROM d),
g AS (SELECT rid, pos, word || ' ' || lead(word) OVER (PARTITION BY rid ORDER BY pos) AS gram FROM x),
h AS (SELECT rid, template, label, exact, size, n_grams, pos, t_at, pos - t_at AS diagonal FROM g JOIN tg USING (gram)),
s AS (SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY rid, template ORDER BY diagonal) <= CASE WHEN exact THEN 0 ELSE {BAND} END
      THEN 0 ELSE 1 END AS new FROM h),
b AS (SELECT *, sum(new) OVER (PARTITION BY rid, template ORDER BY diagonal ROWS UNBOUNDED PRECEDING) AS band FROM s),
e AS (SELECT b.rid, b.template, b.label, b.exact, b.size, b.n_grams, b.band, b.pos, count(DISTINCT o.t_at) AS votes
      FROM b JOIN b AS o ON b.rid = o.rid AND b.template = o.template AND b.band = o.band AND o.pos BETWEEN b.pos AND b.pos + floor({STRETCH} * b.size) - {K}
      GROUP BY ALL),
q AS (SELECT rid, template, label, exact, size, n_grams, band, max(votes) AS votes, arg_max(pos, row(votes, -pos)) AS first
      FROM e GROUP BY rid, template, label, exact, size, n_grams, band),
f AS (SELECT rid, label, exact, first, least((votes + 1) / size, 1.0) AS score FROM q
      WHERE (exact AND votes = n_grams) OR (NOT exact AND (votes + 1) / size >= {COVER})),
a AS (SELECT rid, count(*) FILTER (exact) AS n_base, min(first) FILTER (exact) AS first_word, max(first) FILTER (exact) AS last_word,
      array_to_string(list_sort(list_distinct(list(label) FILTER (exact))), ',') AS base_labels,
      array_to_string(list_sort(list_distinct(list(label))), ',') AS labels, max(score) AS score FROM f GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0)::DOUBLE AS score
FROM d LEFT JOIN a USING (rid)"""
