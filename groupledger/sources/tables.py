"""Stored tables on plain Parquet: full rebuilds, views, keyed merges, namespaces.

All of them are versioned (``snapshots``): nothing that a reader may hold is overwritten.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from ..functions.keys import packed, unpacked
from ..operators.incremental import latest_per_key, replace_by_key
from ..operators.joins import BROADCAST_ROWS
from ..session import shuffles_freed
from . import snapshots
from .snapshots import Snapshot, Unit, folder_of

DEFAULT_LAYER = "analytics"
LAYERS = ("bronze", "integration", "marts", "control")
BUCKET = "_bucket"
PAGE = "_page"
HASH = "_hash"
FRESH, SLICE = "_fresh", "_slice"
#: Rows of a bucket, of a page of the key list, and writes in a partition before they are joined.
BUCKET_ROWS, PAGE_ROWS, DELTAS = 1_000_000, 4_000_000, 8
PAGES = 4096
#: Parts of a bucket that are merged by tasks of their own, at most.
SLICES = 8


def layer(custom: str | None = None, default: str = DEFAULT_LAYER) -> str:
    """A layer's own name as given, else the default one."""
    return default if custom is None else custom.strip()


def table_path(root: str, custom_layer: str | None, table: str) -> str:
    return f"{root.rstrip('/')}/{layer(custom_layer)}/{table}"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a finished table lies at the path."""
    return snapshots.current(spark, path) is not None


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The table's version of now, which the rows stay those of."""
    found = snapshots.current(spark, path)
    if found is None:
        raise FileNotFoundError(f"no table at {path}")
    return snapshots.read(spark, path, found, schema)


def write_table(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), note: Mapping[str, object] | None = None
) -> DataFrame:
    """Replace the table at the path and return it as stored. The rows may come from the
    table itself, since its files stay until they are vacuumed."""
    spark = df.sparkSession
    before = snapshots.current(spark, path)
    units = snapshots.write_rows(df, path, partition_by)
    gone = before.units if before else ()
    new = snapshots.commit(spark, path, before, Snapshot(
        df.schema, tuple(partition_by), tuple(units), note=note or {},
        touched=_folders([*units, *gone]),
    ))
    return snapshots.read(spark, path, new)


def append_rows(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Add rows to a table, or begin it; the files there stay as they are."""
    spark = df.sparkSession
    before = snapshots.current(spark, path)
    if before is None:
        return write_table(df, path, partition_by)
    units = snapshots.write_rows(df.select(*before.schema.names), path, before.by)
    new = snapshots.commit(spark, path, before, replace(
        before, units=(*before.units, *units), touched=_folders(units), opened=()
    ))
    return snapshots.read(spark, path, new)


def _folders(units: Iterable[Unit]) -> tuple[str, ...]:
    return tuple(sorted({u.folder for u in units}))


def as_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def publish(spark: SparkSession, name: str, path: str) -> None:
    """Make a stored table's version of now known to the catalog, so that SQL can name it.

    The name becomes a view of that version's files. It is replaced in one step, so a query
    finds either the version before or this one.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name.split('.')[0]}")
    found = snapshots.current(spark, path)
    if found is None:
        raise FileNotFoundError(f"no table at {path}")
    columns = [f for f in found.schema if f.name not in (BUCKET,)]
    writes: dict[str, list[Unit]] = {}
    for unit in found.units:
        writes.setdefault(unit.write, []).append(unit)
    parts = [_as_sql(spark, path, found, columns, write, units) for write, units in sorted(writes.items())]
    if not parts:
        nothing = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in columns)
        parts = [f"SELECT {nothing} WHERE false"]
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS " + " UNION ALL ".join(parts))


def _as_sql(
    spark: SparkSession, path: str, of: Snapshot, columns: Sequence[T.StructField], write: str,
    units: Sequence[Unit],
) -> str:
    """One write's rows that are in the table, in the table's layout."""
    root = f"{path.rstrip('/')}/data/{snapshots.WRITE}={write}"
    have = set(spark.read.parquet(root).columns) if sum(u.rows for u in units) else set()
    chosen = ", ".join(
        f"CAST({f'`{f.name}`' if f.name in have else 'NULL'} AS {f.dataType.simpleString()}) AS `{f.name}`"
        for f in columns
    )
    if not have:
        return f"SELECT {chosen} WHERE false"
    if not of.by:
        return f"SELECT {chosen} FROM parquet.`{root}`"
    folder = " || '/' || ".join(
        f"'{c}=' || coalesce(CAST(`{c}` AS STRING), '{snapshots.NO_VALUE}')" for c in of.by
    )
    listed = ", ".join(f"'{u.folder}'" for u in units)
    return f"SELECT {chosen} FROM parquet.`{root}` WHERE {folder} IN ({listed})"


def ensure_databases(spark: SparkSession, names: Sequence[str] = LAYERS) -> None:
    for name in names:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def ensure_table(spark: SparkSession, name: str, schema: T.StructType) -> None:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet")


def gathered(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Bring the rows of one partition together before a partitioned write.

    Spark splits a partition that is too big over several tasks and joins small
    ones, so a table gets few files however its rows are spread. Hash keys are packed
    on the way.
    """
    hashes = [
        f.name for f in df.schema
        if f.name.endswith("_key") and f.name not in by and isinstance(f.dataType, T.StringType)
    ]
    moved = df.withColumns({c: packed(c) for c in hashes}).hint("rebalance", *by)
    return moved.withColumns({c: unpacked(c) for c in hashes})


# Keyed tables


def one_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], work: str
) -> DataFrame:
    """``latest_per_key`` that moves only rows whose key occurs again.

    The keys' hashes are counted first, of which 8 bytes a row are shuffled. Those that repeat are
    kept in the folder ``work``, which has to stay until the rows are used; rows with one of
    them are grouped, the others are the only ones of their keys. Where many repeat, all rows
    are grouped. The keys must be the same whenever they are computed.
    """
    spark, hash_ = df.sparkSession, F.xxhash64(*keys).alias(HASH)
    with shuffles_freed(spark):
        counts = df.select(hash_).groupBy(HASH).count()
        counts.filter("count > 1").select(HASH).write.parquet(work)
    repeated = spark.read.schema(f"{HASH} long").parquet(work)
    n = repeated.count()
    if n > BROADCAST_ROWS:
        return latest_per_key(df, keys, order)
    if not n:
        return df
    hashed = df.withColumn(HASH, F.xxhash64(*keys))
    alone = hashed.join(F.broadcast(repeated), HASH, "left_anti").select(*df.columns)
    again = hashed.join(F.broadcast(repeated), HASH, "left_semi").select(*df.columns)
    return alone.unionByName(latest_per_key(again, keys, order))


def bucket(hash_: Column, buckets: int) -> Column:
    """A key's bucket by linear hashing: a table grows from n to n + 1 buckets by splitting
    one of them, and all other rows stay where they are."""
    round_ = 1 << buckets.bit_length() - 1
    wide = F.pmod(hash_, F.lit(2 * round_))
    return F.when(wide < buckets, wide).otherwise(wide - round_).cast("int")


def split_from(old: int, new: int) -> set[int]:
    """The buckets of old that rows move out of when there are new ones."""
    out = set()
    for number in range(old, new):
        while number >= old:
            number -= 1 << number.bit_length() - 1
        out.add(number)
    return out


def create_keyed_table(
    df: DataFrame, path: str, keys: Sequence[str], order: Sequence[str],
    partition_by: Sequence[str] = (), target_rows: int = BUCKET_ROWS, run_id: str | None = None,
    note: Callable[[DataFrame], Mapping[str, object]] | None = None,
) -> None:
    """First load of a table for ``merge_table``: the latest row of every key.

    Rows are laid out by ``partition_by``, or by a hash of the key in buckets of about
    ``target_rows`` without it. A table that lies at the path already is replaced.
    """
    spark = df.sparkSession
    before = snapshots.current(spark, path)
    buckets = None if partition_by else max(1, math.ceil(df.count() / target_rows))
    by, work = tuple(partition_by) or (BUCKET,), _work(path)
    rows = _laid_out(one_per_key(df, keys, order, work), keys, buckets)
    units = snapshots.write_rows(gathered(rows, by), path, by)
    snapshots.remove(spark, work)
    made = Snapshot(
        rows.schema, by, tuple(units), tuple(keys), buckets, target_rows, touched=_folders(units),
        run_id=run_id,
    )
    if note:
        made = replace(made, note=note(snapshots.read(spark, path, made)))
    snapshots.commit(spark, path, before, replace(made, pages=_list_keys(spark, path, made, units)))


def _work(path: str) -> str:
    return f"{path.rstrip('/')}/work/{uuid.uuid4().hex[:16]}"


def _laid_out(df: DataFrame, keys: Sequence[str], buckets: int | None) -> DataFrame:
    if buckets is None:
        return df
    return df.drop(BUCKET).withColumn(BUCKET, bucket(F.xxhash64(*keys), buckets))


def _replaced_in_buckets(
    old: DataFrame, fresh: DataFrame, keys: Sequence[str], buckets: int
) -> DataFrame:
    """``replace_by_key``, laid out: old and fresh rows are shuffled once, to their buckets,
    where a key has two rows at most; as in a join, an empty key takes no row's place. Few
    buckets are cut into slices, so that there is work for all tasks."""
    both = old.withColumn(FRESH, F.lit(False)).unionByName(fresh.withColumn(FRESH, F.lit(True)))
    tasks = int(old.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part = F.pmod(F.hash(*keys), F.lit(min(SLICES, math.ceil(tasks / buckets))))
    rows = _laid_out(both, keys, buckets).withColumn(SLICE, part).repartition(BUCKET, SLICE)
    renewed = F.max(FRESH).over(Window.partitionBy(BUCKET, SLICE, *keys))
    empty = F.greatest(F.lit(False), *[F.col(k).isNull() for k in keys])
    kept = rows.withColumn("_renewed", renewed).filter(F.col(FRESH) | ~F.col("_renewed") | empty)
    return kept.drop(FRESH, SLICE, "_renewed")


def _page(hash_: Column, pages: int) -> Column:
    """The range of hashes that a hash lies in; pages is a power of two."""
    return F.shiftrightunsigned(F.shiftrightunsigned(hash_, 1), 64 - pages.bit_length()).cast("int")


def _list_keys(spark: SparkSession, path: str, of: Snapshot, units: Sequence[Unit]) -> dict[str, int]:
    """Write the hashes of a write's keys beside it, by range of hashes, with the partition
    of each: 8 bytes a row, so that a merge need not read the table to find its keys.

    Of a table in buckets the list is one page, sorted by bucket in each of its files: a bucket
    is already a part of the hashes, so they are not shuffled."""
    if not units or not sum(u.rows for u in units):
        return {}
    write, rows = units[0].write, sum(u.rows for u in units)
    pages = min(PAGES, 1 << max(0, math.ceil(rows / PAGE_ROWS) - 1).bit_length())
    pages = 1 if of.buckets is not None else pages
    hash_ = F.xxhash64(*of.keys).alias("h")
    listed = snapshots.read_units(spark, path, of.by, units, of.schema).select(
        hash_, folder_of(of.by).alias("folder")
    ).withColumn(PAGE, _page(F.col("h"), pages))
    if of.buckets is None:
        listed = listed.hint("rebalance", PAGE)
    writer = listed.sortWithinPartitions(PAGE, "folder", "h").write.partitionBy(PAGE)
    with shuffles_freed(spark):
        writer.option("compression", snapshots.CODEC).parquet(
            f"{path.rstrip('/')}/keys/{snapshots.WRITE}={write}"
        )
    return {write: pages}


def units_with(spark: SparkSession, path: str, of: Snapshot, fresh: DataFrame) -> set[Unit]:
    """The units that hold a key of fresh, found in the key lists.

    Of the lists only the pages that the keys' hashes lie in are read, and of a table in
    buckets only their buckets. What reaches the driver is bounded by the numbers of pages,
    of buckets and of units."""
    if not of.pages:
        return set()
    hashes = fresh.select(F.xxhash64(*of.keys).alias("h"))
    most = max(of.pages.values())
    seen = [r[0] for r in hashes.select(_page(F.col("h"), most)).distinct().collect()]
    listed = _listed_keys(spark, path, of, seen)
    if of.buckets is not None:
        near = hashes.select(bucket(F.col("h"), of.buckets)).distinct().collect()
        listed = listed.filter(F.col("folder").isin([f"{BUCKET}={r[0]}" for r in near]))
    held = listed.join(hashes, "h", "left_semi").select("folder", snapshots.WRITE).distinct()
    with shuffles_freed(spark):
        found = {(r.folder, r[snapshots.WRITE]) for r in held.collect()}
    return {u for u in of.units if (u.folder, u.write) in found}


def _listed_keys(spark: SparkSession, path: str, of: Snapshot, seen: Sequence[int]) -> DataFrame:
    """The key lists' pages for some pages of the finest list."""
    most, wanted = max(of.pages.values()), F.lit(False)
    for pages in set(of.pages.values()):
        writes = [w for w, p in of.pages.items() if p == pages]
        near = sorted({s >> (most.bit_length() - pages.bit_length()) for s in seen})
        wanted = wanted | (F.col(snapshots.WRITE).isin(writes) & F.col(PAGE).isin(near))
    root = f"{path.rstrip('/')}/keys"
    lists = (
        spark.read.schema(f"h long, folder string, {snapshots.WRITE} string, {PAGE} int")
        .option("basePath", root).parquet(*[f"{root}/{snapshots.WRITE}={w}" for w in of.pages])
    )
    return lists.filter(wanted)


def merge_table(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    run_id: str,
    keep_latest: bool = False,
    note: Callable[[DataFrame], Mapping[str, object]] | None = None,
) -> Snapshot:
    """Keyed upsert that opens only what holds keys of the batch.

    The batch's row takes the place of the stored one; with ``keep_latest`` only if it is not
    older by ``order``. Rows with new keys are added as files of their own; the partitions'
    units that hold one of the keys are read and written anew. A partition of more than
    DELTAS units is joined to one when rows come to it. A table laid out by a hash of the key
    grows by splitting buckets. The version after is in place when all of it is written, so a
    merge that is lost half-way has changed nothing, and one that is repeated merges again.

    One row per key of the batch is stored first: of a partitioned table in the partitions, where
    it stays unless stored rows have to be written anew beside it; else aside. ``note`` is worked
    out from it and kept in the version.
    """
    before = snapshots.current(spark, path)
    if before is None:
        raise FileNotFoundError(f"no table at {path}")
    if before.keys != tuple(keys):
        raise ValueError(f"{path} is keyed by {before.keys}, not by {tuple(keys)}")
    work, buckets, placed = _work(path), before.buckets, []
    if buckets is None and not keep_latest:
        once = _with_values(one_per_key(batch, keys, order, work), before.by)
        placed = snapshots.write_rows(gathered(once, before.by), path, before.by)
        fresh = snapshots.read_write(spark, path, placed, once.schema)
        coming = [u.folder for u in placed]
    else:
        once = latest_per_key(batch, keys, order)
        with shuffles_freed(spark):
            once.write.option("compression", snapshots.CODEC).parquet(work)
        fresh = spark.read.schema(once.schema).parquet(work)
        if buckets is not None:
            buckets = max(buckets, math.ceil((before.rows + fresh.count()) / before.target_rows))
        layout = _laid_out(fresh, keys, buckets)
        coming = [r[0] for r in layout.select(folder_of(before.by)).distinct().collect()]
        snapshots.plain_folders(coming, before.by)

    opened = units_with(spark, path, before, fresh)
    deltas = Counter(u.folder for u in before.units)
    full = {f for f in coming if deltas[f] >= DELTAS}
    if buckets != before.buckets:
        full |= {f"{BUCKET}={b}" for b in split_from(before.buckets, buckets)}
    opened |= {u for u in before.units if u.folder in full}

    if placed and not opened:
        units = placed
    else:
        units = snapshots.write_rows(
            _merged(spark, path, before, opened, fresh, order, buckets, keep_latest), path, before.by
        )
    kept = tuple(u for u in before.units if u not in opened)
    schema = fresh.schema if buckets is None else _laid_out(fresh, keys, buckets).schema
    made = replace(
        before, schema=schema, units=(*kept, *units), buckets=buckets, run_id=run_id,
        touched=_folders([*units, *opened]), opened=tuple(sorted(opened)),
        note={**before.note, **(note(fresh) if note else {})},
    )
    writes = {u.write for u in made.units}
    pages = {w: p for w, p in before.pages.items() if w in writes}
    pages |= _list_keys(spark, path, made, units)
    new = snapshots.commit(spark, path, before, replace(made, pages=pages))
    snapshots.remove(spark, work)
    if placed and placed[0].write not in writes:
        snapshots.remove(spark, f"{path.rstrip('/')}/data/{snapshots.WRITE}={placed[0].write}")
    return new


def _with_values(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """The rows; an empty text in a partition column, which files cannot tell from NULL, fails."""
    texts = [f.name for f in df.schema if f.name in by and isinstance(f.dataType, T.StringType)]
    return df.withColumns({
        c: F.when(F.col(c) == "", F.raise_error(F.lit(f"empty partition value in {c}"))).otherwise(F.col(c))
        for c in texts
    })


def _merged(
    spark: SparkSession, path: str, before: Snapshot, opened: Iterable[Unit], fresh: DataFrame,
    order: Sequence[str], buckets: int | None, keep_latest: bool,
) -> DataFrame:
    """The opened units' rows and the fresh ones, laid out: one row per key."""
    keys = before.keys
    old = snapshots.read_units(spark, path, before.by, opened, fresh.schema)
    if opened and buckets is not None and not keep_latest:
        return _replaced_in_buckets(old, fresh, keys, buckets)
    if keep_latest:
        merged = latest_per_key(old.unionByName(fresh), keys, order)
    else:
        merged = replace_by_key(old, fresh, keys)
    return gathered(_laid_out(merged, keys, buckets), before.by)


def replace_partitions(
    df: DataFrame, path: str, by: Sequence[str], listed: DataFrame,
    note: Mapping[str, object] | None = None,
) -> DataFrame:
    """Put df's rows in place of the listed partitions; the others stay as they are. A listed
    partition without rows goes."""
    spark = df.sparkSession
    before = snapshots.current(spark, path)
    names = {r[0] for r in listed.select(folder_of(by)).distinct().collect()}
    units = snapshots.write_rows(gathered(df, by), path, by)
    names |= {u.folder for u in units}
    kept = [u for u in before.units if u.folder not in names]
    new = snapshots.commit(spark, path, before, Snapshot(
        df.schema, tuple(by), (*kept, *units), touched=tuple(sorted(names)), note=note or {},
    ))
    return snapshots.read(spark, path, new)


def read_keyed_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return read_table(spark, path, schema).select(*schema.names)
