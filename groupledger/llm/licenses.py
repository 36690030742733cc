"""License scan by diagonal voting.

Every rolling pair of words of every text is joined with the positions of the same
pair in the templates. A match votes for the diagonal text position - template
position; neighbouring diagonals are merged, so that a notice with a few words put in
or left out still adds up, and the spans are verified against the template.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .common import ascii_lower, let, table, whole, words

#: Phrases that name a license wherever their words stand in a row.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Notices of public licenses, matched with gaps.
NOTICES = (
    ("gpl", "this program is free software you can redistribute it and or modify it under "
            "the terms of the gnu general public license as published by the free software "
            "foundation"),
    ("lgpl", "this library is free software you can redistribute it and or modify it under "
             "the terms of the gnu lesser general public license"),
    ("agpl", "under the terms of the gnu affero general public license"),
    ("apache", "licensed under the apache license version 2 0 the license you may not use "
               "this file except in compliance with the license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of "
            "this software and associated documentation files the software to deal in the "
            "software without restriction"),
    ("bsd", "redistribution and use in source and binary forms with or without modification "
            "are permitted provided that the following conditions are met"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose "
            "with or without fee is hereby granted"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international "
              "license"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 "
                 "international license"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)
#: Words of a rolling gram. The shortest phrase has two.
GRAM = 2
#: Diagonals at most so far apart are one.
DRIFT = 3
#: Votes that a diagonal of a notice needs; fewer are chance, such as "of the".
LEAST_VOTES = 2
#: Share of a notice's grams that a verified span has.
LEAST_SCORE = 0.6


def templates(phrases=None, notices=NOTICES) -> list[tuple]:
    """(template, label, is a phrase, grams, position, first word, second word) rows."""
    phrases = PHRASES if phrases is None else phrases
    listed = [(x, label, True) for x, label in phrases.items()]
    listed += [(x, label, False) for label, x in notices]
    rows = []
    for number, (text, label, phrase) in enumerate(listed):
        parts = re.findall(r"[0-9a-z]+", text)
        if len(parts) < GRAM:
            raise ValueError(f"a template needs {GRAM} words: {text!r}")
        grams = len(parts) - GRAM + 1
        rows += [(number, label, phrase, grams, at, parts[at], parts[at + 1])
                 for at in range(grams)]
    return rows


def _votes(docs: DataFrame, rows: list[tuple]) -> DataFrame:
    """Per text, template and diagonal the number of votes; one row without a template
    for each text, with its number of words."""
    grams = docs.sparkSession.createDataFrame(
        [(t, label, phrase, n, at, f"{a} {b}") for t, label, phrase, n, at, a, b in rows],
        "template int, label string, phrase boolean, grams int, at int, template_gram string",
    ).withColumn("hash", F.xxhash64("template_gram"))

    def pairs(tokens: Column) -> Column:
        """All grams; before them a null, which stands for the text itself."""
        rolling = F.transform(
            F.slice(tokens, F.lit(1), F.greatest(F.size(tokens) - 1, F.lit(0))),
            lambda w, i: F.concat(w, F.lit(" "), F.get(tokens, i + 1)),
        )
        return F.struct(
            F.size(tokens).alias("n"),
            F.concat(F.array(F.lit(None).cast("string")), rolling).alias("grams"),
        )

    rolled = docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id",
        let(words(ascii_lower(whole(F.col("text")))), pairs).alias("t"),
    ).select(
        "row", "doc_id", F.col("t.n").alias("n"), F.posexplode("t.grams").alias("pos", "gram")
    ).withColumn("hash", F.xxhash64("gram"))
    # the templates are a fixed list of a few hundred rows
    matched = rolled.join(F.broadcast(grams), "hash", "left").filter(
        F.col("gram").isNull() | (F.col("gram") == F.col("template_gram"))
    ).withColumn("pos", F.col("pos") - 1)
    return matched.groupBy(
        "row", "doc_id", "template", "label", "phrase", "grams",
        (F.col("pos") - F.col("at")).alias("diagonal"),
    ).agg(
        F.count("at").alias("votes"), F.collect_set("at").alias("positions"),
        F.max("n").alias("n_words"),
    )


def scan(docs: DataFrame, phrases=None, notices=NOTICES) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels, score and spans (label, start word, end word, score; by start).

    A null or empty text has no words, no places and score 0. Repeated rows and rows
    without doc_id each give a row of their own. Only doc_id and text are read, so extra
    columns may have any name. The score is the best span's share of its template."""
    votes = _votes(docs.select("doc_id", "text"), templates(phrases, notices))
    line = Window.partitionBy("row", "template").orderBy("diagonal")
    heard = F.col("template").isNull() | F.col("phrase") | (F.col("votes") >= LEAST_VOTES)
    clusters = votes.filter(heard).withColumn(
        "new", (F.col("diagonal") - F.lag("diagonal").over(line) > DRIFT).cast("int")
    ).withColumn("cluster", F.when(
        F.col("phrase"), F.col("diagonal")  # a phrase stands on one diagonal
    ).otherwise(F.sum(F.coalesce("new", F.lit(0))).over(line)))
    spans = clusters.groupBy(
        "row", "doc_id", "template", "label", "phrase", "grams", "cluster"
    ).agg(
        F.max("n_words").alias("n_words"),
        F.min(F.col("diagonal") + F.array_min("positions")).alias("start"),
        F.max(F.col("diagonal") + F.array_max("positions") + GRAM).alias("end"),
        F.size(F.array_distinct(F.flatten(F.collect_list("positions")))).alias("matched"),
    ).withColumn("score", F.col("matched") / F.col("grams")).withColumn("base", (
        F.col("phrase") & (F.col("matched") == F.col("grams"))
    )).withColumn("ok", F.col("base") | (~F.col("phrase") & (F.col("score") >= LEAST_SCORE)))
    base, ok = F.col("base"), F.col("ok")

    def joined(condition: Column) -> Column:
        return F.array_join(F.array_sort(F.collect_set(F.when(condition, F.col("label")))), ",")

    return spans.groupBy("row", "doc_id").agg(
        F.max("n_words").cast("long").alias("n_words"),
        F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("start"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("start"))).cast("long").alias("last_word"),
        joined(base).alias("base_labels"),
        joined(ok).alias("labels"),
        F.coalesce(F.max(F.when(ok, F.col("score"))), F.lit(0.0)).alias("score"),
        F.array_sort(F.collect_list(F.when(ok, F.struct("start", "end", "label", "score")))).alias("spans"),
    ).drop("row")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents", "doc_id", "text")).drop("spans")


def _sql() -> str:
    rows = ",\n".join(
        f"({t}, '{label}', {str(phrase).lower()}, {grams}, {at}, '{a}', '{b}')"
        for t, label, phrase, grams, at, a, b in templates()
    )
    return f"""
WITH grams(template, label, phrase, grams, tpos, w0, w1) AS (VALUES {rows}),
w AS (SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
p AS (SELECT doc_id, pos - 1 AS pos, ws[pos] AS a, ws[pos + 1] AS b
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws))) AS pos FROM w)),
v AS (SELECT doc_id, template, any_value(label) AS label, any_value(phrase) AS phrase,
             any_value(grams) AS grams, pos - tpos AS diagonal, min(pos) AS lo, max(pos) AS hi,
             list(DISTINCT tpos) AS positions
      FROM p JOIN grams ON a = w0 AND b = w1 GROUP BY doc_id, template, pos - tpos
      HAVING any_value(phrase) OR count(*) >= {LEAST_VOTES}),
m AS (SELECT *, CASE WHEN diagonal - lag(diagonal) OVER line > {DRIFT} THEN 1 ELSE 0 END AS new
      FROM v WINDOW line AS (PARTITION BY doc_id, template ORDER BY diagonal)),
c AS (SELECT *, CASE WHEN phrase THEN diagonal
             ELSE sum(new) OVER (PARTITION BY doc_id, template ORDER BY diagonal) END AS cluster
      FROM m),
s AS (SELECT doc_id, label, phrase, min(lo) AS start,
             len(list_distinct(flatten(list(positions)))) / grams::DOUBLE AS score
      FROM c GROUP BY doc_id, template, label, phrase, grams, cluster),
k AS (SELECT *, phrase AND score = 1 AS base,
             (phrase AND score = 1) OR (NOT phrase AND score >= {LEAST_SCORE}) AS ok FROM s),
r AS (SELECT doc_id, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word,
             max(start) FILTER (base) AS last_word,
             array_to_string(list_sort(list(DISTINCT label) FILTER (base)), ',') AS base_labels,
             array_to_string(list_sort(list(DISTINCT label) FILTER (ok)), ',') AS labels,
             max(score) FILTER (ok) AS score
      FROM k GROUP BY doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base,
       first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       coalesce(score, 0.0)::DOUBLE AS score
FROM w LEFT JOIN r USING (doc_id)
"""


SQL = _sql()
