"""Column helpers and stored intermediate results shared by the operators."""

from __future__ import annotations

import string
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import shared_folder

#: What separates words of letters and digits; every non-ASCII character is a letter.
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: What separates words split at white space.
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Chosen columns of a test table, whole."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is worked out once, however often body uses it."""
    return F.transform(F.array(value), body)[0]


def whole(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all other characters as they are."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def words(text: Column, separators: str = NOT_WORD) -> Column:
    return F.array_remove(F.split(text, separators, -1), "")


def running(values: Column, combine: Callable[[Column, Column], Column], zero: int = 0,
            block: int = 256) -> Column:
    """For an array of ints, what combine makes of all elements before each; in blocks,
    so that the work stays near the array's length."""
    empty = F.array().cast("array<int>")

    def total(part: Column) -> Column:
        return F.aggregate(part, F.lit(zero), combine)

    def within(part: Column, base: Column) -> Column:
        return F.aggregate(
            part,
            F.struct(base.alias("at"), empty.alias("out")),
            lambda acc, x: F.struct(
                combine(acc["at"], x).alias("at"),
                F.concat(acc["out"], F.array(acc["at"])).alias("out"),
            ),
        )["out"]

    return let(values, lambda of: F.when(F.size(of) > 0, let(
        sliced(of, block),
        lambda parts: let(
            F.transform(parts, total),
            lambda sums: F.flatten(F.transform(
                parts, lambda p, i: within(p, total(F.slice(sums, F.lit(1), i)))
            )),
        ),
    )).otherwise(empty))


def sliced(of: Column, block: int) -> Column:
    """A non-empty array cut into arrays of up to block elements."""
    numbers = F.sequence(F.lit(0), ((F.size(of) - 1) / block).cast("int"))
    return F.transform(numbers, lambda b: F.slice(of, b * block + 1, F.lit(block)))


def places(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches as array<struct<value, start, end>>, in code
    points, the end exclusive. The pattern must not match the empty string."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return let(found, lambda m: F.when(F.size(m) > 0, let(
        F.split(text, pattern, -1),
        lambda gaps: let(
            running(F.transform(
                m, lambda x, i: F.char_length(gaps[i]) + F.char_length(x)
            ), lambda total, x: total + x),
            lambda at: F.transform(m, lambda x, i: F.struct(
                x.alias("value"),
                (at[i] + F.char_length(gaps[i])).alias("start"),
                (at[i] + F.char_length(gaps[i]) + F.char_length(x)).alias("end"),
            )),
        ),
    )).otherwise(F.array().cast("array<struct<value:string,start:int,end:int>>")))


def checkpointed(df: DataFrame) -> DataFrame:
    """df, written once to the folder that spark.checkpoint.dir names. A small result:
    checkpoints are stored whole and uncompressed."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder name of its own below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """df, written once as a Parquet table in the shared folder. For rows with texts."""
    folder = new_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
