"""CSV landing files to typed raw tables."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..session import side_by_side
from . import snapshots
from .registry import LANDING, LandingFile
from .tables import write_table

# Spellings of NULL, and how dates and timestamps are written.
NULL_TOKENS = ("NULL", "null", "")
DATE_FORMAT = "yyyy-MM-dd"
TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"

BAD_LINE = "_bad_line"
PROBLEM, RECORD = "_problem", "_record"


def _typed(field: T.StructField, strict: bool) -> Column:
    raw = F.when(~F.col(field.name).isin(*NULL_TOKENS), F.col(field.name))
    kind = field.dataType
    if isinstance(kind, T.TimestampNTZType):
        if strict:
            value = F.to_timestamp_ntz(raw, F.lit(TIMESTAMP_FORMAT))
        else:
            value = F.try_to_timestamp(raw, F.lit(TIMESTAMP_FORMAT)).cast(kind)
    elif isinstance(kind, T.DateType):
        parse = F.to_date if strict else F.try_to_date
        value = parse(raw, DATE_FORMAT)
    elif isinstance(kind, T.StringType):
        value = raw
    else:
        value = raw.cast(kind) if strict else raw.try_cast(kind)
    return value.alias(field.name)


def read_raw_lines(
    spark: SparkSession, path: str, schema: T.StructType, pattern: str | None = None,
    keep_bad_lines: bool = False,
) -> DataFrame:
    """All columns as text, by position below a skipped header line.

    A quoted field may hold line breaks, so a file is read by one task; the source systems
    deliver gzipped part files, which no reader splits. A record with another number of
    columns than the layout fails the load, or is kept whole in ``_bad_line`` when asked for.
    """
    columns = [T.StructField(f.name, T.StringType()) for f in schema]
    reader = (
        spark.read.option("header", True)
        .option("enforceSchema", True)
        .option("multiLine", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("nullValue", "")
        .option("emptyValue", "")
    )
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if keep_bad_lines:
        columns.append(T.StructField(BAD_LINE, T.StringType()))
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BAD_LINE)
    else:
        reader = reader.option("mode", "FAILFAST")
    return reader.schema(T.StructType(columns)).csv(path)


def read_landing(
    spark: SparkSession, path: str, schema: T.StructType, pattern: str | None = None,
) -> DataFrame:
    """Typed rows; a value that does not fit its type fails the load."""
    lines = read_raw_lines(spark, path, schema, pattern)
    return lines.select(*[_typed(f, strict=True) for f in schema])


def read_landing_tolerant(
    spark: SparkSession, path: str, schema: T.StructType, pattern: str | None = None,
) -> DataFrame:
    """Typed rows with NULL for what does not fit; broken lines kept in ``_bad_line``."""
    lines = read_raw_lines(spark, path, schema, pattern, keep_bad_lines=True)
    return lines.select(*[_typed(f, strict=False) for f in schema], BAD_LINE)


def read_landing_checked(
    spark: SparkSession, path: str, schema: T.StructType, pattern: str | None = None,
) -> DataFrame:
    """Typed rows of all records, with ``_problem``: NULL, ``columns`` for a record with another
    number of them than the layout, or the name of the first column whose value does not fit
    its type; and ``_record``: the record as text where there is a problem."""
    lines = read_raw_lines(spark, path, schema, pattern, keep_bad_lines=True)
    raw = [F.when(~F.col(f.name).isin(*NULL_TOKENS), F.col(f.name)) for f in schema]
    unfit = [
        F.when(text.isNotNull() & _typed(f, strict=False).isNull(), F.lit(f.name))
        for f, text in zip(schema, raw, strict=True)
    ]
    problem = F.coalesce(F.when(F.col(BAD_LINE).isNotNull(), F.lit("columns")), *unfit)
    record = F.coalesce(F.col(BAD_LINE), F.to_csv(F.struct(*[F.col(f.name) for f in schema])))
    return lines.select(
        *[_typed(f, strict=False) for f in schema], problem.alias(PROBLEM),
        F.when(problem.isNotNull(), record).alias(RECORD),
    )


def stamped(df: DataFrame, subsidiary: str, loaded_at: datetime | None = None) -> DataFrame:
    """Add the audit columns; the load time defaults to the start of the query."""
    now = F.lit(loaded_at) if loaded_at else F.current_timestamp()
    return df.withColumn("_subsidiary_code", F.lit(subsidiary)).withColumn(
        "_loaded_at", now.cast("timestamp_ntz")
    )


def landing_path(landing: str, file: LandingFile) -> str:
    """The file of that name or the folder of its parts, plain or gzipped, and no other."""
    return f"{landing.rstrip('/')}/{file.path}{{,.gz}}"


def load_file(
    spark: SparkSession, landing: str, file: LandingFile, loaded_at: datetime | None = None
) -> DataFrame:
    """One registered file, or the part files of a folder of that name, plain or gzipped."""
    rows = read_landing(spark, landing_path(landing, file), file.schema)
    return stamped(rows, file.subsidiary, loaded_at)


def load_file_checked(
    spark: SparkSession, landing: str, file: LandingFile, loaded_at: datetime | None = None
) -> tuple[DataFrame, DataFrame]:
    """The records that fit the layout, stamped, and the ones that do not: their
    ``_problem``, ``_record`` and audit columns."""
    read = read_landing_checked(spark, landing_path(landing, file), file.schema)
    rows = stamped(read, file.subsidiary, loaded_at)
    good = rows.filter(F.col(PROBLEM).isNull()).drop(PROBLEM, RECORD)
    return good, rows.filter(F.col(PROBLEM).isNotNull()).select(
        PROBLEM, RECORD, "_subsidiary_code", "_loaded_at"
    )


def fingerprint(spark: SparkSession, landing: str, file: LandingFile) -> str:
    """Names, sizes and times of a source's files: another delivery has another one."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(landing_path(landing, file))
    system = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = []
    for top in system.globStatus(where) or ():
        for part in system.listStatus(top.getPath()):
            if part.isFile():
                found.append(f"{part.getPath().getName()}:{part.getLen()}:{part.getModificationTime()}")
    return hashlib.md5("\n".join(sorted(found)).encode()).hexdigest()


def load_all(
    spark: SparkSession,
    landing: str,
    bronze: str,
    files: Iterable[LandingFile] = LANDING,
    loaded_at: datetime | None = None,
    quarantine: bool = False,
) -> dict[str, DataFrame]:
    """Replace every raw table by its landing file and return the stored tables.

    A record that does not fit the layout fails the load; with ``quarantine`` it goes to the
    table ``NAME__quarantine`` instead, and the load goes on. Each table's version notes its
    delivery (``arrived_at`` is when the source last delivered anything new), so that data
    and load record are there together or not at all.
    """
    now = loaded_at or datetime.now()

    def load(file: LandingFile) -> tuple[str, DataFrame]:
        path = f"{bronze.rstrip('/')}/{file.table}"
        note = _delivery(spark, landing, file, path, now)
        if quarantine:
            good, broken = load_file_checked(spark, landing, file, now)
            write_table(broken, f"{path}__quarantine", note=note)
        else:
            good = load_file(spark, landing, file, now)
        return file.table, write_table(good, path, note=note)

    return dict(side_by_side(spark, load, files))


def _delivery(
    spark: SparkSession, landing: str, file: LandingFile, path: str, now: datetime
) -> dict[str, object]:
    before, seen = snapshots.current(spark, path), fingerprint(spark, landing, file)
    last = before.note if before else {}
    same = last.get("fingerprint") == seen
    return {"fingerprint": seen, "arrived_at": last["arrived_at"] if same else now.isoformat()}


def read_seed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A reference table from a CSV file whose header names the layout's columns in order."""
    found = spark.read.option("header", True).option("quote", '"').option("escape", '"').csv(path)
    if [c.strip().lower() for c in found.columns] != schema.names:
        raise ValueError(f"{path}: columns {found.columns} in place of {schema.names}")
    return found.toDF(*schema.names).select(*[_typed(f, strict=True) for f in schema])


def _moment(name: str) -> Column:
    """A timestamp in TIMESTAMP_FORMAT. A whole day of a year of four digits is written by its
    date, which takes a fraction of the time of the formatter."""
    day = F.col(name).cast("date")
    plain = day.between(F.lit("0001-01-01").cast("date"), F.lit("9999-12-31").cast("date"))
    whole = plain & (day.cast("timestamp_ntz") == F.col(name))
    by_date = F.concat(day.cast("string"), F.lit("T00:00:00"))
    return F.when(whole, by_date).otherwise(F.date_format(name, TIMESTAMP_FORMAT))


def write_landing(df: DataFrame, path: str) -> None:
    """Write rows the way the source systems do: header, quotes, gzip, part files."""
    out = df.select(
        *[
            _moment(f.name).alias(f.name)
            if isinstance(f.dataType, T.TimestampNTZType)
            else F.col(f.name).cast("string").alias(f.name)
            for f in df.schema
        ]
    )
    (
        out.write.mode("overwrite")
        .option("header", True)
        .option("nullValue", "NULL")
        .option("emptyValue", '""')
        .option("escape", '"')
        .option("compression", "gzip")
        .option("zlib.compress.level", "BEST_SPEED")
        .csv(path)
    )
