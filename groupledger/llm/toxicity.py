"""Severity grades by cumulative-link ordinal regression.

P(grade > k) = sigmoid(w.x - t_k) with one weight vector w for all thresholds
t_0 < t_1 < ...; the expected severity is the sum of these probabilities. x holds
log(1 + count) of the words that tell toxic from other texts apart.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .arrow import raw, tokens
from .common import ascii_lower, stored, table, whole, words

#: The model is fitted on so many labelled rows, those with the smallest hash of doc_id.
SAMPLE = 20_000
#: The model has all words whose log odds differ from 0 by so many standard errors.
LEAST_Z = 4.0
#: Grades of toxic texts by how often a telling word occurs: 1 below the first, and so on.
STEPS = (2, 4)
#: Grades 0 (not toxic) to this.
HIGHEST = len(STEPS) + 1


@dataclass(frozen=True)
class Model:
    """weights by word; thresholds in ascending order. Without weights nothing is toxic."""

    weights: dict[bytes, float] = field(default_factory=dict)
    thresholds: tuple[float, ...] = (np.inf,) * HIGHEST

    def above(self, text: bytes) -> np.ndarray:
        """P(grade > k) for each k below the highest grade."""
        counts: dict[bytes, int] = {}
        known = self.weights
        for word in tokens(text):
            if word in known:
                counts[word] = counts.get(word, 0) + 1
        score = sum(known[w] * np.log1p(n) for w, n in sorted(counts.items()))
        return _sigmoid(score - np.array(self.thresholds))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


def fit(rows: np.ndarray, columns: np.ndarray, values: np.ndarray, grades: np.ndarray,
        size: int, penalty: float = 1.0, rounds: int = 400) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds of sparse entries (row, column, value) and grades per row.

    Each threshold is a yes/no question, "above grade k?"; the questions share the
    weights. Adam on the penalised mean loss; thresholds are a first one and positive
    steps, so that they stay in order."""
    above = grades[:, None] > np.arange(HIGHEST)
    share = np.clip(above.mean(axis=0), 1e-4, 1 - 1e-4)
    first = np.log((1 - share) / share)
    steps = np.log(np.maximum(np.diff(first), 1e-2))
    theta = np.concatenate([np.zeros(size), first[:1], steps])
    mean = square = np.zeros_like(theta)
    for turn in range(1, rounds + 1):
        w, cuts = theta[:size], _cuts(theta[size:])
        score = np.bincount(rows, values * w[columns], len(grades))
        error = _sigmoid(score[:, None] - cuts) - above
        pull = np.bincount(columns, values * error.sum(axis=1)[rows], size)
        by_cut = -error.sum(axis=0)
        later = by_cut[::-1].cumsum()[::-1]
        gradient = np.concatenate([
            pull + penalty * w, later[:1], later[1:] * np.exp(theta[size + 1:]),
        ]) / len(grades)
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.999 * square + 0.001 * gradient**2
        theta = theta - 0.05 * (mean / (1 - 0.9**turn)) / (
            np.sqrt(square / (1 - 0.999**turn)) + 1e-8
        )
    return theta[:size], _cuts(theta[size:])


def _cuts(parts: np.ndarray) -> np.ndarray:
    return np.concatenate([parts[:1], parts[0] + np.exp(parts[1:]).cumsum()])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """The model of labelled texts (labels: doc_id, toxic of 0 or 1).

    Rows without a doc_id or a label are left out. A doc_id labelled both 0 and 1 is toxic; of
    the texts of a repeated doc_id the smallest counts, null as empty. Labels of one kind
    only, or none, give the model without weights. The sample is the same wherever and
    however often it is drawn, and is stored once. Word counts of the sample are taken in
    Spark; only the counts of the model's words in the sample's texts reach the driver."""
    chosen = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).filter(
        F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)
    ).groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(
        F.xxhash64("doc_id"), "doc_id"
    ).limit(sample)
    # at most `sample` narrow rows
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy(
        "doc_id"
    ).agg(F.max("toxic").alias("toxic"), F.min(whole(F.col("text"))).alias("text"))
    texts = stored(texts.select(
        "doc_id", "toxic", words(ascii_lower(F.col("text"))).alias("words")
    ), "toxicity")
    n, n_toxic = texts.agg(F.count("*"), F.sum("toxic")).first()
    if not n or not n_toxic or n == n_toxic:
        return Model()
    found = texts.select("toxic", F.explode(F.array_distinct("words")).alias("word"))
    a, b = F.sum("toxic") + 0.5, F.count("*") - F.sum("toxic") + 0.5
    odds = F.log(a / (n_toxic + 1 - a)) - F.log(b / (n - n_toxic + 1 - b))
    error = F.sqrt(1 / a + 1 / b + 1 / (n_toxic + 1 - a) + 1 / (n - n_toxic + 1 - b))
    telling = found.groupBy("word").agg((odds / error).alias("z")).filter(
        F.abs("z") >= LEAST_Z
    ).orderBy(F.abs("z").desc(), "word").collect()  # as few as the sample has words
    if not telling:
        return Model()
    number = {row.word: i for i, row in enumerate(telling)}
    chosen_words = docs.sparkSession.createDataFrame([(w,) for w in number], "word string")
    counted = texts.select("doc_id", F.explode("words").alias("word")).join(
        chosen_words, "word"
    ).groupBy("doc_id", "word").agg(F.count("*").alias("n"))
    counted = counted.groupBy("doc_id").agg(F.map_from_entries(
        F.array_sort(F.collect_list(F.struct("word", "n")))
    ).alias("counts"))  # as many entries as the model has words at most
    entries = texts.select("doc_id", "toxic").join(counted, "doc_id", "left").orderBy("doc_id").collect()
    grades, rows, columns, values = [], [], [], []
    for at, entry in enumerate(entries):
        counts = entry.counts or {}
        marks = sum(n for w, n in counts.items() if telling[number[w]].z > 0)
        grades.append(entry.toxic and 1 + sum(marks >= step for step in STEPS))
        for word, count in counts.items():
            rows.append(at)
            columns.append(number[word])
            values.append(np.log1p(count))
    weights, cuts = fit(
        np.array(rows, np.int64), np.array(columns, np.int64), np.array(values),
        np.array(grades), len(number),
    )
    return Model({w.encode(): float(weights[i]) for w, i in number.items()},
                 tuple(float(x) for x in cuts))


def _scorer(model):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            above = [model.value.above(x) for x in raw(batch.column("body"))]
            above = np.array(above).reshape(len(batch), HIGHEST)
            yield pa.RecordBatch.from_pydict({
                "doc": batch.column("doc"),
                "expected_severity": pa.array(above.sum(axis=1), pa.float64()),
                "grade": pa.array((above >= 0.5).sum(axis=1), pa.int32()),
                "toxic": pa.array(above[:, 0] >= 0.5, pa.bool_()),
            })

    return score


def severity(docs: DataFrame, model: Model, *keep: str) -> DataFrame:
    """Per row of docs: doc (a struct of the columns to keep), expected_severity (0 to
    HIGHEST), grade (the highest that is as likely as not) and toxic (grade over 0).

    Null and empty texts have no words and score what the thresholds alone say. Repeated rows
    score alike, an empty table gives no rows; a grade or toxic at exactly one half counts as
    reached. Only text and the columns to keep are read, whatever the names of others."""
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("doc"),
        F.col("text").cast("binary").alias("body"),
    )
    schema = T.StructType([
        packed.schema["doc"], T.StructField("expected_severity", T.DoubleType()),
        T.StructField("grade", T.IntegerType()), T.StructField("toxic", T.BooleanType()),
    ])
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return packed.mapInArrow(_scorer(shared), schema)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"))
    return severity(docs, model, "doc_id").select(
        "doc.doc_id", "expected_severity", "grade", "toxic"
    )
