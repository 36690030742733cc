"""Join helpers: bounded broadcast, joins that spread hot keys, insert-if-absent."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

BROADCAST_ROWS = 200_000


def bounded(df: DataFrame, rows: int) -> DataFrame:
    """Hint a broadcast for a relation known to hold at most ``rows`` narrow rows.

    Above the limit the hint is left out and Spark picks the join from sizes it
    measures itself.
    """
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def hot_key_join(
    split: DataFrame,
    copied: DataFrame,
    on: Sequence[str],
    split_by: str,
    hot_rows: int = 10_000,
) -> DataFrame:
    """Inner equi-join whose hot keys are worked on by many tasks.

    A key with n > hot_rows rows in ``split`` gets ceil(n / hot_rows) salts. Its
    rows there are dealt out by the hash of ``split_by`` (a stable column, so a
    task that is run again deals the same way) and its rows in ``copied`` are
    repeated once per salt. All other keys keep the single salt 0. The key
    counts are combined before they are shuffled; no result row is lost.
    """
    salts = (
        split.groupBy(*on)
        .agg(F.ceil(F.count("*") / F.lit(hot_rows)).cast("int").alias("_salts"))
        .filter(F.col("_salts") > 1)
    )
    dealt = split.join(salts, list(on), "left").withColumn(
        "_salt",
        F.when(F.col("_salts").isNull(), 0).otherwise(
            F.pmod(F.xxhash64(split_by), F.col("_salts")).cast("int")
        ),
    )
    repeated = copied.join(salts, list(on), "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1))
    )
    return dealt.drop("_salts").join(repeated.drop("_salts"), [*on, "_salt"]).drop("_salt")


def ordered_pairs(
    rows: DataFrame, on: Sequence[str], kind: str, split_by: str, names: tuple[str, str],
    cell_rows: int = 2_000,
) -> DataFrame:
    """All pairs of rows that agree in ``on`` and differ in ``kind``, the lesser kind first:
    the columns of ``on`` and those of both rows, prefixed by ``names``.

    Keys of up to ``cell_rows`` rows are joined as they are: both sides of that join are the
    same rows, which are shuffled once for the two. Of the others, one in ``cell_rows`` rows at
    most and told by their hashes, a task makes one cell of a key's grid (``_grid_pairs``). Keys
    that are NULL have no pairs.
    """
    on, hash_ = list(on), F.xxhash64(*on).alias("_hash")
    busy = F.broadcast(rows.groupBy(hash_).count().filter(F.col("count") > cell_rows).select("_hash"))
    hashed = rows.withColumn("_hash", hash_)
    plain = hashed.join(busy, "_hash", "left_anti").drop("_hash")
    own = [c for c in rows.columns if c not in on]

    def side(prefix: str) -> DataFrame:
        return plain.select(*on, *[F.col(c).alias(f"{prefix}{c}") for c in own])

    first, second = names
    pairs = side(first).join(side(second), on).filter(F.col(f"{first}{kind}") < F.col(f"{second}{kind}"))
    crowded = hashed.join(busy, "_hash", "left_semi").drop("_hash")
    return pairs.unionByName(_grid_pairs(crowded, on, kind, split_by, names, cell_rows))


def _grid_pairs(
    rows: DataFrame, on: Sequence[str], kind: str, split_by: str, names: tuple[str, str],
    cell_rows: int,
) -> DataFrame:
    """The pairs of a key make a grid, and a task makes one cell of it. A key's rows of one kind
    are cut into blocks of about ``cell_rows``, by the hash of ``split_by`` (a stable column, so
    a task that is run again cuts alike). Cells are only laid out for two kinds that both
    occur, the lesser one down and the other across; each row goes once to every cell of its
    row or column, and rows without a partner go nowhere.
    """
    on, (first, second) = list(on), names
    sizes = rows.groupBy(*on, kind).agg(F.ceil(F.count("*") / F.lit(cell_rows)).cast("int").alias("_n"))

    def sized(name: str) -> DataFrame:
        return sizes.select(*on, F.col(kind).alias(f"_{name}"), F.col("_n").alias(f"_{name}_blocks"))

    grids = sized("a").join(sized("b"), on).filter(F.col("_a") < F.col("_b"))

    def dealt(own: str, other: str, prefix: str) -> DataFrame:
        block = F.pmod(F.xxhash64(split_by), F.col(f"_{own}_blocks")).cast("int")
        cells = F.explode(F.sequence(F.lit(0), F.col(f"_{other}_blocks") - 1))
        mine = grids.withColumnRenamed(f"_{own}", kind).withColumn(f"_{own}", F.col(kind))
        joined = rows.join(mine, [*on, kind])
        return joined.select(
            *on, "_a", "_b", block.alias(f"_{own}_cell"), cells.alias(f"_{other}_cell"),
            *[F.col(c).alias(f"{prefix}{c}") for c in rows.columns if c not in on],
        )

    cell = [*on, "_a", "_b", "_a_cell", "_b_cell"]
    return dealt("a", "b", first).join(dealt("b", "a", second), cell).drop(*cell[len(on):])


def absent(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of left whose key does not occur in right."""
    return left.join(right.select(*on).distinct(), list(on), "left_anti")


def insert_if_absent(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target plus the source rows with a key the target lacks; matched rows stay as they are."""
    fresh = source.join(target.select(*keys), list(keys), "left_anti")
    return target.unionByName(fresh, allowMissingColumns=True)
