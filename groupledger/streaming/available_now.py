"""Load the files that arrived since the last run into a keyed table, each once."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, types as T

from ..sources.tables import BUCKET_ROWS, create_keyed_table, exists, merge_table


def _latest_wins(
    path: str, checkpoint: str, keys: Sequence[str], order: Sequence[str], target_rows: int
) -> Callable[[DataFrame, int], None]:
    def load(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if exists(spark, path):
            run_id = f"batch {batch_id} of {checkpoint}"
            merge_table(spark, path, batch, keys, order, run_id, keep_latest=True)
        else:
            create_keyed_table(batch, path, keys, order, target_rows=target_rows)

    return load


def upsert_available(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    target: str,
    checkpoint: str,
    keys: Sequence[str],
    order: Sequence[str],
    pattern: str | None = None,
    target_rows: int = BUCKET_ROWS,
    select: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Run once over all files not yet loaded, then stop.

    The checkpoint remembers the files, so no high-water mark is kept by hand
    and a row that arrives late is loaded whatever its time says, but never takes
    the place of a later version of its key. A batch that is run again after a
    failure merges the same rows, which leaves the table as if it had run once.
    Rows with new keys are added beside the table's files; only buckets' files that hold
    a key of the batch are written anew, and the table gets a bucket for every
    ``target_rows`` rows as it grows.
    """
    reader = spark.readStream.schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    rows = reader.parquet(source)
    if select:
        rows = select(rows)
    query = (
        rows.writeStream.foreachBatch(_latest_wins(target, checkpoint, keys, order, target_rows))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
