"""Line-first cleaning: lines that fail a rule go, then texts that lost too much."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import SPACE, ascii_lower, let, table, whole, words

#: Characters that running text has few of.
SIGNS = r"[#*$%&|<>{}\[\]=~^_@+\\/!]"
#: More than one sign in this many characters of a line fails the line.
CHARACTERS_A_SIGN = 10
#: Menu separators standing alone between words; this many fail a line.
SEPARATOR = r"[|>»•·/](?<!\S.)(?!\S)"
SEPARATORS = 3
#: Phrases of page furniture; a line of up to this many characters that has one fails.
FURNITURE = (
    r"\b(?:accept (?:all )?cookies|cookie (?:policy|settings)|privacy policy"
    r"|terms of (?:use|service)|all rights reserved|lorem ipsum|enable javascript"
    r"|sign in|log in|click here|read more|skip to (?:main )?content|share this"
    r"|follow us on|subscribe (?:now|to our newsletter))\b"
)
FURNITURE_CHARACTERS = 200
#: A text must keep this share of its word characters.
LEAST_KEPT = 0.5
#: Repeated windows.
WINDOW = 8


def line_passes(line: Column) -> Column:
    """False for a line with a word that fails the punctuation, the navigation or the
    boilerplate rule."""
    size = F.char_length(line)
    punctuation = F.regexp_count(line, F.lit(SIGNS)) * CHARACTERS_A_SIGN > size
    navigation = F.regexp_count(line, F.lit(SEPARATOR)) >= SEPARATORS
    boilerplate = (size <= FURNITURE_CHARACTERS) & ascii_lower(line).rlike(FURNITURE)
    return ~(punctuation | navigation | boilerplate)


def repeated_words(tokens: Column, window: int = WINDOW) -> Column:
    """How many words lie in windows of words that the text has twice or more. Windows
    are compared by 64-bit hashes; their length is a power of two."""

    def covered(hashes: Column) -> Column:
        ordered = F.array_sort(F.transform(
            hashes, lambda h, i: F.struct(h.alias("hash"), i.alias("at"))
        ))
        return let(ordered, lambda s: let(
            F.array_sort(F.transform(
                F.filter(s, lambda x, i: (
                    x["hash"].eqNullSafe(F.get(s, i - 1)["hash"])
                    | x["hash"].eqNullSafe(F.get(s, i + 1)["hash"])
                )),
                lambda x: x["at"],
            )),
            lambda at: F.aggregate(
                F.transform(at, lambda x, i: F.least(
                    F.lit(window), F.coalesce(F.get(at, i + 1) - x, F.lit(window))
                )),
                F.lit(0), lambda total, x: total + x,
            ),
        ))

    def hashed(parts: Column, length: int) -> Column:
        """Hashes of windows of length parts, from those of windows half as long."""
        if length == 1:
            return F.transform(parts, lambda x: F.xxhash64(x))
        half = length // 2
        return let(hashed(parts, half), lambda h: F.transform(
            F.slice(h, F.lit(1), F.size(h) - half),
            lambda x, i: F.xxhash64(x, F.get(h, i + half)),
        ))

    repeats = let(hashed(tokens, window), lambda h: F.when(
        F.size(F.array_distinct(h)) < F.size(h), covered(h)
    ).otherwise(0))
    return F.when(F.size(tokens) >= window, repeats).otherwise(0)


def measured(text: Column) -> Column:
    """A struct of the counts of a text, its cleaned text and the verdict.

    A null text counts as empty. Texts without words have no counts, fail and are not
    kept. Lines without a word are no duplicates and stay where they are."""
    full = whole(text)
    lines = F.split(full, "\n", -1)
    has_word = r"[^\x20\x09-\x0D]"

    def counted(tokens: Column) -> Column:
        return F.struct(
            F.size(tokens).cast("long").alias("n_words"),
            F.char_length(F.array_join(tokens, "")).cast("long").alias("word_chars"),
            F.regexp_count(full, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
            let(F.filter(lines, lambda x: x.rlike(has_word)), lambda x:
                (F.size(x) - F.size(F.array_distinct(x))).cast("long")).alias("n_dup_lines"),
            repeated_words(tokens).cast("long").alias("n_repeat_words"),
            let(F.filter(lines, line_passes), lambda x: F.when(
                F.size(x) < F.size(lines), F.array_join(x, "\n")
            )).alias("clean"),
        )

    def judged(m: Column) -> Column:
        failed = (m["n_words"] < 20) | (100 * m["n_repeat_words"] > 30 * m["n_words"])
        left = F.when(
            m["clean"].isNotNull(), F.char_length(F.regexp_replace(m["clean"], SPACE, ""))
        ).otherwise(m["word_chars"])
        return F.struct(
            *[m[c].alias(c) for c in (
                "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            )],
            F.coalesce(m["clean"], full).alias("clean"),
            failed.alias("base_failed"),
            left.cast("long").alias("kept_chars"),
            (~failed & (left >= LEAST_KEPT * m["word_chars"])).alias("kept"),
        )

    return let(let(words(full, SPACE), counted), judged)


def clean(docs: DataFrame) -> DataFrame:
    """The documents that pass, with the columns of docs and without failed lines.

    Null texts and texts without words fail. Repeated rows are judged alike. n_chars,
    where docs has it, is that of the cleaned text. No other column is read, so extra
    columns of any name pass through."""
    judged = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    judged = judged.withColumn("m", measured(F.col("doc.text"))).filter("m.kept")
    new = {"text": F.col("m.clean"), "n_chars": F.char_length("m.clean").cast("long")}
    return judged.select(*[
        new.get(c, F.col("doc")[c]).alias(c) for c in docs.columns
    ])


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return docs.select("doc_id", measured(F.col("text")).alias("m")).select(
        "doc_id", "m.n_words", "m.word_chars", "m.n_symbols", "m.n_dup_lines",
        "m.n_repeat_words", "m.kept_chars", "m.base_failed", "m.kept",
    )
