"""Spelling variants by pivotal grams.

All bigrams of the words have one order, rarest first. A word's prefix are its first three
bigrams in that order; of these, two that share no letter are its pivots, chosen by dynamic
programming for the least frequency in all. One edit spoils one pivot at most and moves the
other by one place at most. So of two near words the one whose prefix ends first has a pivot
in the other's prefix, at the same place or next to it; pairs that meet so are verified.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import ascii_lower, stored, table

#: Code points of a word and occurrences, at least; how often its form occurs, in its own times.
LEAST_LETTERS, LEAST_COUNT, TIMES = 7, 2, 10
#: Every so many runs, by checksum, lose a letter.
SLIP = 31
#: What a run of letters is once A-Z are in lower case: 90 letters, 8,100 bigrams at most.
LETTERS = r"[a-zÀ-ÿ]"
#: Grams of a prefix (two for one edit, and one) and how far the last one's place may move.
PREFIX, MOVE = 3, 1
#: Bits of a place and of a length in a posting's key; longer ones only meet more others.
BITS = 25
#: Of a pivot's word against the other: how much longer that is, and how far on the gram stands.
SHIFTS = ((0, 0), (1, 0), (1, 1), (-1, 0), (-1, -1))


def counted_words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n): the runs of letters of all texts, A-Z in lower case, of which those whose
    checksum with the doc_id SLIP divides have lost a letter; of LEAST_LETTERS code points at
    least that occur LEAST_COUNT times at least. A null doc_id counts as an empty one, a null
    text has no words; repeated rows count each."""
    pattern = f"{LETTERS}{{{LEAST_LETTERS},}}"
    runs = docs.select(
        F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(ascii_lower(F.col(text)), F.lit(pattern), F.lit(0))).alias("run"),
    )
    check = F.crc32(F.concat("id", F.lit(":"), "run"))
    size = F.char_length("run")
    at = F.pmod(check, size).cast("int")
    slipped = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, size))
    word = F.when(check % SLIP == 0, slipped).otherwise(F.col("run")).alias("word")
    counts = runs.select(word).groupBy("word").agg(F.count("*").alias("n"))
    return counts.filter((F.char_length("word") >= LEAST_LETTERS) & (F.col("n") >= LEAST_COUNT))


def gram_counts(words: DataFrame) -> dict[str, int]:
    """How often each bigram stands in the words. The alphabet bounds what comes to the
    driver to 8,100 rows."""
    at = F.sequence(F.lit(1), F.char_length("word") - 1)
    grams = words.select(F.explode(F.transform(at, lambda i: F.substring("word", i, 2))).alias("gram"))
    return {r.gram: r["n"] for r in grams.groupBy("gram").agg(F.count("*").alias("n")).collect()}


def pivots(grams: list[tuple[int, int]]) -> tuple[int, int]:
    """Of (place, weight) by place the two places, two letters apart at least, of the least
    weight together; ties to the first found."""
    before: list[tuple[int, int]] = []  # least (weight, place) among the first grams
    best, out, free = None, (0, 0), 0
    for place, weight in grams:
        while grams[free][0] <= place - 2:
            one = (grams[free][1], grams[free][0])
            before.append(min(before[-1], one) if before else one)
            free += 1
        if before and (best is None or before[-1][0] + weight < best):
            best, out = before[-1][0] + weight, (before[-1][1], place)
    return out


def signature(word: str, ranks: dict[str, tuple[int, int]]) -> tuple[list, list, tuple[int, int], int]:
    """A word's pivots and prefix, each (rank, place), the end of the prefix and the letters
    as bits. ``ranks`` gives a bigram's place in the order and its count."""
    spots = sorted((ranks[word[i:i + 2]][0], i) for i in range(len(word) - 1))
    first, last = spots[:PREFIX], spots[PREFIX - 1]
    chosen = pivots(sorted((i, ranks[word[i:i + 2]][1]) for _, i in first))
    end = (last[0], last[1] + MOVE)
    prefix = first + [s for s in spots[PREFIX:PREFIX + MOVE] if s <= end]
    letters = 0
    for letter in set(word):
        letters |= 1 << ord(letter) % 64
    return [s for s in first if s[1] in chosen], prefix, last, letters


def _key(rank: int, place: int, length: int) -> int:
    room = (1 << BITS) - 1
    return rank << 2 * BITS | (place & room) << BITS | length & room


def _signed(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


def _postings(counts: dict[str, int]):
    order = sorted(counts, key=lambda gram: (counts[gram], gram))
    ranks = {gram: (rank, counts[gram]) for rank, gram in enumerate(order)}

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, len(batch), 2000):
                part = batch.slice(low, 2000)
                rows, keys, sides, ends, masks = [], [], [], [], []
                for number, word in enumerate(part.column("word").to_pylist()):
                    chosen, prefix, last, letters = signature(word, ranks)
                    found = [
                        (_key(rank, place + on, len(word) + longer), True)
                        for rank, place in chosen for longer, on in SHIFTS if place + on >= 0
                    ] + [(_key(rank, place, len(word)), False) for rank, place in prefix]
                    keys += [key for key, _ in found]
                    sides += [side for _, side in found]
                    rows += [number] * len(found)
                    ends += [last[0] << 32 | last[1]] * len(found)
                    masks += [_signed(letters)] * len(found)
                held = part.take(pa.array(rows, pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.int64()), pa.array(sides, pa.bool_()), pa.array(ends, pa.int64()),
                     pa.array(masks, pa.int64()), held.column("word"), held.column("n")],
                    ["key", "pivot", "ends", "letters", "word", "n"],
                )

    return post


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n) of words (word, n; each word once, of LEAST_LETTERS letters of
    the alphabet at least) that are one inserted, deleted or replaced code point apart, each
    pair both ways."""
    postings = words.mapInArrow(
        _postings(gram_counts(words)),
        "key long, pivot boolean, ends long, letters long, word string, n long",
    )
    posted = stored(postings, "pivot-postings")
    left, right = posted.filter("pivot").alias("l"), posted.filter("not pivot").alias("r")
    met = left.join(
        right,
        (F.col("l.key") == F.col("r.key"))
        & (F.col("l.ends") <= F.col("r.ends"))
        & (F.bit_count(F.col("l.letters").bitwiseXOR(F.col("r.letters"))) <= 2)
        & (F.levenshtein("l.word", "r.word", 1) == 1),
    )
    pairs = met.select(
        F.least("l.word", "r.word").alias("a"), F.greatest("l.word", "r.word").alias("b"),
        F.when(F.col("l.word") < F.col("r.word"), F.col("l.n")).otherwise(F.col("r.n")).alias("a_n"),
        F.when(F.col("l.word") < F.col("r.word"), F.col("r.n")).otherwise(F.col("l.n")).alias("b_n"),
    ).distinct()
    ways = F.array(
        F.struct(F.col("a").alias("word"), F.col("a_n").alias("n"), F.col("b").alias("near"),
                 F.col("b_n").alias("near_n")),
        F.struct(F.col("b").alias("word"), F.col("b_n").alias("n"), F.col("a").alias("near"),
                 F.col("a_n").alias("near_n")),
    )
    return pairs.select(F.inline(ways))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): where following (word, form) from each word ends. Steps double each
    round; counts grow TIMES each step, so there are few."""
    found = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = found.select(F.col("word").alias("root"), F.col("root").alias("next"))
        ahead = ahead.join(found.select("root").distinct(), "root", "left_semi")
        if ahead.isEmpty():
            return found
        found = stored(
            found.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "roots"
        )


def variants(words: DataFrame) -> DataFrame:
    """Per word of words (word, n): form (its near word of the greatest n, the smaller one of
    equals, if that is TIMES the word's n at least), root (where forms lead; the word itself
    without one), n, n_near, form_n."""
    known = stored(words.select("word", "n"), "words")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    near = near_pairs(known).groupBy("word").agg(F.count("*").alias("n_near"), best)
    most = -F.col("best.less")
    enough = most >= TIMES * F.col("n")
    lines = stored(known.join(near, "word", "left").select(
        "word", F.when(enough, F.col("best.near")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, most).alias("form_n"),
    ), "variants")
    ends = roots(lines.filter("form is not null"))
    return lines.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(counted_words(table(spark, sf_dir, "documents", "doc_id", "text")))
