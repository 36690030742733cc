"""Hard negatives by anchor spanning trees.

Anchors that lie near each other form a block, and each block has a minimum spanning tree.
Candidates lie in parts. For each block and part the tree is walked from its root: a child's
score of a candidate lies within edge length times the candidate's norm of its parent's
score, and only candidates whose bounds overlap what is looked for are scored again. A first
walk looks for every anchor's best rows of its own label, a second one for the best rows of
other labels within the score windows that those positives set.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .common import stored, table

#: Anchors of a block, at most.
BLOCK = 256
#: Bytes of candidate vectors of a part, at most, and rows that are bounded at once.
PART_BYTES, ROWS = 64 << 20, 8192
#: Rows of a part, at least, when there are cores to spare.
LEAST_ROWS = 1024
#: Scores are exact below this.
EXACT = float(1 << 53)
#: Widens bounds beyond what the rounding of sums can lose.
WIDER, SLACK = 1 + 1e-9, 2.0


def whole_vectors(
    rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
    scale: int = 256,
) -> DataFrame:
    """(vec_id, label, vector) of the rows that take part, components floor(scale * x)."""
    x = F.col(vector)
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    part = F.transform(x, lambda v: F.floor(v.cast("double") * scale))
    taking = rows.filter(
        F.col(vec_id).isNotNull() & F.col(label).isNotNull() & x.isNotNull() & ~bad
    ).select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"),
             part.alias("vector"))
    square = F.aggregate(
        "vector", F.lit(0.0), lambda total, v: total + v.cast("double") * v.cast("double")
    )
    fits = F.when(square < EXACT, F.col("vector")).otherwise(
        F.raise_error(F.lit("a vector is too long for exact scores")).cast("array<bigint>")
    )
    return taking.withColumn("vector", fits)


def _matrix(lists: pa.ListArray, dim: int) -> np.ndarray:
    """One row per vector, filled up with zeros."""
    edges = lists.offsets.to_numpy()
    lengths, out = np.diff(edges), np.zeros((len(lists), dim))
    values = lists.flatten().to_numpy(zero_copy_only=False)
    if dim and (lengths == dim).all():
        return values.reshape(-1, dim).astype(np.float64)
    row = np.repeat(np.arange(len(lists)), lengths)
    out[row, np.arange(len(values)) - np.repeat(edges[:-1] - edges[0], lengths)] = values
    return out


def spanning_tree(vectors: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Rows of a minimum spanning tree in an order that has parents first and takes whole
    subtrees one after the other, each one's parent as a place in that order (-1: the root),
    and the lengths of the edges."""
    count = len(vectors)
    nearest, parent = np.full(count, np.inf), np.full(count, -1)
    out, last = np.zeros(count, bool), 0
    children: list[list[int]] = [[] for _ in range(count)]
    for _ in range(count - 1):
        out[last] = True
        far = np.sqrt(((vectors - vectors[last]) ** 2).sum(1))
        closer = ~out & (far < nearest)
        nearest[closer], parent[closer] = far[closer], last
        last = int(np.argmin(np.where(out, np.inf, nearest)))
        children[parent[last]].append(last)
    order, place, stack = [], {}, [0] if count else []
    while stack:
        row = stack.pop()
        place[row] = len(order)
        order.append(row)
        stack.extend(reversed(children[row]))
    parents = np.array([place[parent[row]] if parent[row] >= 0 else -1 for row in order])
    edges = np.array([nearest[row] if parent[row] >= 0 else 0.0 for row in order])
    return order, parents, edges


def _planted(dim: int):
    def plant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = list(batches)
        task, held = TaskContext.get().partitionId(), pa.Table.from_batches(rows) if rows else None
        for number, low in enumerate(range(0, len(held) if rows else 0, BLOCK)):
            some = held.slice(low, BLOCK).combine_chunks()
            order, parents, edges = spanning_tree(
                _matrix(some["vector"].chunk(0), dim)
            )
            some = some.take(pa.array(order)).combine_chunks().to_batches()[0]
            yield pa.RecordBatch.from_arrays(
                [pa.array([task << 32 | number] * len(order), pa.int64()),
                 pa.array(range(len(order)), pa.int32()), pa.array(parents, pa.int32()),
                 pa.array(edges, pa.float64()),
                 *(some.column(c) for c in ("vec_id", "label", "vector"))],
                ["block", "place", "parent", "edge", "vec_id", "label", "vector"],
            )

    return plant


def plant(anchors: DataFrame, count: int, dim: int) -> DataFrame:
    """The anchors with their block and their place in its tree. A range of anchors by
    label and id makes a partition, which is cut into blocks; written once."""
    ranged = anchors.repartitionByRange(max(1, math.ceil(count / BLOCK)), "label", "vec_id")
    trees = ranged.sortWithinPartitions("label", "vec_id").mapInArrow(
        _planted(dim),
        "block long, place int, parent int, edge double, vec_id long, label long, vector array<bigint>",
    )
    return stored(trees, "anchor-trees")


@dataclass
class Rows:
    """Candidates, or the anchors of a block in tree order."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray


Found = list[tuple[np.ndarray, ...]]
#: Of an anchor's number and its candidates' bounds: those to score; then of their scores: rows found.
Seeks = Callable[[int, np.ndarray, np.ndarray], np.ndarray]
Takes = Callable[[int, np.ndarray, np.ndarray], None]


def walk(
    anchors: Rows, parents: np.ndarray, edges: np.ndarray, candidates: Rows, seeks: Seeks, takes: Takes
) -> int:
    """Walks a tree, gives every anchor's wanted candidates (their numbers) with exact
    scores to ``takes``, and returns how many scores it worked out."""
    norms = np.sqrt((candidates.vectors ** 2).sum(1)) * WIDER
    waiting = np.bincount(parents[1:], minlength=len(parents))
    bounds: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    scored = 0
    for at, parent in enumerate(parents):
        if parent < 0:
            low = high = candidates.vectors @ anchors.vectors[at]
            scored += len(low)
            wanted = seeks(at, low, high)
            scores = low[wanted]
        else:
            width = edges[at] * WIDER * norms + SLACK
            low, high = bounds[parent][0] - width, bounds[parent][1] + width
            wanted = seeks(at, low, high)
            scores = candidates.vectors[wanted] @ anchors.vectors[at]
            scored += len(wanted)
            low[wanted] = high[wanted] = scores
            waiting[parent] -= 1
            if not waiting[parent]:
                del bounds[parent]
        takes(at, wanted, scores)
        if waiting[at]:
            bounds[at] = (low, high)
    return scored


def _kth(values: np.ndarray, k: int) -> float:
    """The k-th greatest value; minus infinity if there are fewer."""
    return np.partition(values, len(values) - k)[len(values) - k] if len(values) >= k else -np.inf


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Numbers of the k greatest scores, ties by the smaller id."""
    if len(scores) > k:
        some = np.flatnonzero(scores >= _kth(scores, k))
    else:
        some = np.arange(len(scores))
    return some[np.lexsort((ids[some], -scores[some]))][:k]


def _positives(k: int):
    def search(anchors: Rows, _: pa.RecordBatch, parents, edges, candidates: Rows) -> pa.RecordBatch:
        found: Found = []

        def seeks(at, low, high):
            own = np.flatnonzero(
                (candidates.labels == anchors.labels[at]) & (candidates.ids != anchors.ids[at])
            )
            return own[high[own] >= _kth(low[own], k)]

        def takes(at, wanted, scores):
            best = _best(scores, candidates.ids[wanted], k)
            found.append((np.full(len(best), anchors.ids[at]), candidates.ids[wanted][best], scores[best]))

        walk(anchors, parents, edges, candidates, seeks, takes)
        return _rows(found, ("anchor_id", "positive_id", "positive_score"))

    return search


def _negatives(k: int, least: int, most: int):
    def search(anchors: Rows, block: pa.RecordBatch, parents, edges, candidates: Rows) -> pa.RecordBatch:
        found: Found = []
        windows = []  # of each anchor: positive, its score, least and most score of a negative
        for listed in block.column("positives").to_pylist():
            windows.append([
                (p["positive_id"], s, -(-least * s // 100), most * s // 100)
                for p in listed or () for s in [p["positive_score"]] if s >= 0
            ])

        def seeks(at, low, high):
            other = candidates.labels != anchors.labels[at]
            wanted = np.zeros(len(low), bool)
            for bottom, top in {w[2:] for w in windows[at]}:
                over = other & (high >= bottom) & (low <= top)
                sure = over & (low >= bottom) & (high <= top)
                wanted |= over & (high >= _kth(low[sure], k))
            return np.flatnonzero(wanted)

        def takes(at, wanted, scores):
            ids, other = candidates.ids[wanted], candidates.labels[wanted] != anchors.labels[at]
            for positive, score, bottom, top in windows[at]:
                within = np.flatnonzero(other & (scores >= bottom) & (scores <= top))
                best = within[_best(scores[within], ids[within], k)]
                full = np.ones(len(best), np.int64)
                found.append((full * anchors.ids[at], full * positive, full * score, ids[best], scores[best]))

        walk(anchors, parents, edges, candidates, seeks, takes)
        return _rows(found, ("anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"))

    return search


def _rows(found: Found, names: tuple[str, ...]) -> pa.RecordBatch:
    columns = zip(*found, strict=True) if found else [[np.empty(0)]] * len(names)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate(c).astype(np.int64)) for c in columns], list(names)
    )


def _as_rows(batch: pa.RecordBatch, dim: int) -> Rows:
    ids, labels = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("vec_id", "label"))
    return Rows(ids, labels, _matrix(batch.column("vector"), dim))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Rows of one (part, block), whole, one after the other; a part's candidates first."""
    held: list[pa.RecordBatch] = []
    key = None
    for batch in batches:
        part, block = (batch.column(c).to_numpy() for c in ("part", "block"))
        cuts = np.flatnonzero((np.diff(part) != 0) | (np.diff(block) != 0)) + 1
        for low, high in zip([0, *cuts], [*cuts, len(batch)], strict=True):
            if low == high:
                continue
            now = (int(part[low]), int(block[low]))
            if held and now != key:
                yield key, _joined(held)
                held = []
            key = now
            held.append(batch.slice(low, high - low))
    if held:
        yield key, _joined(held)


def _joined(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _search(search, dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        candidates: Rows | None = None
        in_part = None
        for (part, block), batch in _pieces(batches):
            if block < 0:
                candidates, in_part = _as_rows(batch, dim), part
            elif in_part == part and candidates is not None:
                anchors = _as_rows(batch, dim)
                parents, edges = (batch.column(c).to_numpy() for c in ("parent", "edge"))
                for low in range(0, len(candidates.ids), ROWS):
                    some = Rows(*(x[low:low + ROWS] for x in (
                        candidates.ids, candidates.labels, candidates.vectors)))
                    yield search(anchors, batch, parents, edges, some)

    return run


def against(candidates: DataFrame, trees: DataFrame, parts: int, dim: int, search, schema: str) -> DataFrame:
    """What ``search`` finds for every block of anchors in every part of the candidates.

    The anchors are repeated once per part; a task holds one part and one block of them."""
    part = F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int").alias("part")
    columns = ["part", "block", "place", "parent", "edge", "vec_id", "label", "vector"]
    extra = [c for c in trees.columns if c not in columns]
    rows = candidates.select(
        part, F.lit(-1).cast("long").alias("block"), F.lit(0).alias("place"),
        F.lit(-1).alias("parent"), F.lit(0.0).alias("edge"), "vec_id", "label", "vector",
        *[F.lit(None).cast(trees.schema[c].dataType).alias(c) for c in extra],
    )
    repeated = trees.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    dealt = rows.unionByName(repeated.select(*columns, *extra)).repartition(parts, "part")
    return dealt.sortWithinPartitions("part", "block", "place").mapInArrow(_search(search, dim), schema)


def _first(rows: DataFrame, by: list[str], score: str, other: str, k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.col(score).desc(), F.col(other))
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(
    vectors: DataFrame, is_anchor, positives: int = 5, negatives: int = 10, least: int = 30, most: int = 90
) -> DataFrame:
    """Per anchor and positive the best rows of another label whose score is at least
    ``least`` and at most ``most`` percent of the positive's: anchor_id, positive_id, rank,
    negative_id, positive_score, negative_score.

    ``vectors`` has vec_id, label and vector, as ``whole_vectors`` makes them; ``is_anchor``
    is a condition on them. Scores are inner products; ties go to the smaller vec_id. Of
    rows with one vec_id the one with the greatest (label, vector) takes part, so repeated
    rows count once. Shorter vectors are filled up with zeros; empty ones score 0 everywhere.
    No rows, anchors or positives, or a positive with a score below 0, give no rows."""
    one = F.max(F.struct("label", "vector")).alias("row")
    kept = stored(vectors.groupBy("vec_id").agg(one).select("vec_id", "row.*"), "vectors")
    anchors = kept.filter(is_anchor)
    size = kept.agg(
        F.count("*").alias("rows"), F.max(F.size("vector")).alias("dim"), F.count_if(is_anchor).alias("anchors")
    ).first()
    dim, spark = size.dim or 1, vectors.sparkSession
    spread = min(spark.sparkContext.defaultParallelism * 2, math.ceil(size.rows / LEAST_ROWS))
    parts = max(1, spread, math.ceil(size.rows * dim * 8 / PART_BYTES))
    trees = plant(anchors, size.anchors, dim)
    near = against(
        kept, trees, parts, dim, _positives(positives), "anchor_id long, positive_id long, positive_score long"
    )
    chosen = _first(near, ["anchor_id"], "positive_score", "positive_id", positives)
    listed = chosen.groupBy(F.col("anchor_id").alias("vec_id")).agg(
        F.collect_list(F.struct("positive_id", "positive_score")).alias("positives")
    )
    aimed = stored(trees.join(listed, "vec_id", "left"), "aimed-trees")
    far = against(
        kept, aimed, parts, dim, _negatives(negatives, least, most),
        "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long",
    )
    return _first(far, ["anchor_id", "positive_id"], "negative_score", "negative_id", negatives).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whole_vectors(table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(rows.withColumn("label", label), F.col("vec_id") % 100 == 0)


SQL = """
WITH taking AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT a.vec_id AS anchor_id, o.vec_id AS other_id, a.label = o.label AS same,
         CAST(list_inner_product(a.v, o.v) AS BIGINT) AS score
  FROM taking a JOIN taking o ON a.vec_id <> o.vec_id WHERE a.vec_id % 100 = 0
),
pos AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id)
            AS INTEGER) AS rank,
       other_id AS negative_id, positive_score, score AS negative_score
FROM pos p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT same
 AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""
