"""Pivotal grams against all pairs."""

from __future__ import annotations

import itertools
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from groupledger.llm import spelling

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _counts(docs: list[tuple]) -> dict[str, int]:
    seen: Counter = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            seen[run] += 1
    return {w: n for w, n in seen.items() if len(w) >= 7 and n >= 2}


def _near(a: str, b: str) -> bool:
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def _expected(counts: dict[str, int]) -> set[tuple]:
    near: dict[str, list[str]] = {w: [] for w in counts}
    for a, b in itertools.combinations(counts, 2):
        if _near(a, b):
            near[a].append(b)
            near[b].append(a)
    forms = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        if best is not None and counts[best] >= 10 * counts[w]:
            forms[w] = best
    out = set()
    for w, n in counts.items():
        root = w
        while root in forms:
            root = forms[root]
        out.add((w, forms.get(w), root, n, len(near[w]), counts.get(forms.get(w))))
    return out


def _got(df) -> set[tuple]:
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def _edited(rng: random.Random, word: str, letters: str) -> str:
    at, kind = rng.randrange(len(word)), rng.randrange(3)
    new = rng.choice(letters)
    return word[:at] + (new if kind < 2 else "") + word[at + (kind > 0):]


@pytest.mark.parametrize("letters", ["ab", "abcé", "abcdefghijklmnopqrstuvwxyzß÷ÿ"])
def test_all_near_words_meet(spark, letters):
    rng = random.Random(len(letters))
    words = {"".join(rng.choice(letters) for _ in range(rng.randint(7, 11))) for _ in range(150)}
    words |= {_edited(rng, w, letters) for w in words for _ in range(3)}
    words |= {"a" * n for n in range(7, 12)} | {"ab" * 6, "ba" * 6, "a" * 400, "a" * 401, "b" + "a" * 400}
    counts = {w: rng.choice([2, 3, 20, 35, 300, 5000]) for w in sorted(words) if len(w) >= 7}
    want = _expected(counts)
    assert sum(x[1] is not None for x in want) > 50 and any(x[1] != x[2] and x[1] for x in want)
    df = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(4)
    assert _got(spelling.variants(df)) == want


def test_pivots_are_the_lightest_disjoint_pair():
    rng = random.Random(2)
    for _ in range(2000):
        grams = [(p, rng.randint(1, 9)) for p in sorted(rng.sample(range(9), rng.randint(3, 6)))]
        a, b = spelling.pivots(grams)
        weight = dict(grams)
        least = min(weight[x] + weight[y] for x in weight for y in weight if y - x >= 2)
        assert b - a >= 2 and weight[a] + weight[b] == least


def test_words_are_counted_with_their_slips(spark):
    rng = random.Random(9)
    names = ["Fernwärme", "keyboard", "ÀRBOLES", "straße", "naïveté", "conversation", "x" * 60]
    docs = [(i if i % 9 else None, " ".join(rng.choices(names, k=20)) + "-_1é") for i in range(200)]
    docs += [(7, None), (8, ""), (9, "a" * 200_000), (9, "a" * 200_000), (10, "word " * 9000)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for name in ("word", "run", "id", "n"):
        df = df.withColumn(name, F.lit(1))
    got = {r.word: r["n"] for r in spelling.counted_words(df).collect()}
    assert got == _counts(docs)
    assert any(len(w) == 59 for w in got)
    assert spelling.variants(spelling.counted_words(df.limit(0))).count() == 0


def test_query_against_all_pairs(spark):
    folder = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert _got(spelling.op13_spelling(spark, folder)) == _expected(_counts(docs))
