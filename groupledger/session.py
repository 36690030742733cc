"""Spark session settings and the shared folder that written tables live in."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from threading import Lock
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

In, Out = TypeVar("In"), TypeVar("Out")

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

_own_folders: dict[str, str] = {}


def local_session(cores: int | str = "*", app: str = "groupledger") -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    partitions = 8 if cores == "*" else int(cores)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(partitions))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def side_by_side(
    spark: SparkSession, do: Callable[[In], Out], items: Iterable[In], at_once: int = 3
) -> list[Out]:
    """Independent jobs, a few at a time: one's tasks take the cores that another's last ones
    leave idle. Results are in the items' order; a failure is raised when all have ended."""
    with ThreadPoolExecutor(at_once) as pool:
        begun = [pool.submit(inheritable_thread_target(spark)(do), item) for item in items]
    return [job.result() for job in begun]


FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_freeing: dict[str, list[str | None]] = {}
_freeing_lock = Lock()


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the jobs inside are deleted as each job ends; else they stay until the
    driver's JVM happens to collect garbage. The session's own setting is put back after the
    last of several blocks, which may run side by side."""
    app = spark.sparkContext.applicationId
    with _freeing_lock:
        _freeing.setdefault(app, []).append(spark.conf.get(FREED, None))
        spark.conf.set(FREED, "true")
    try:
        yield
    finally:
        with _freeing_lock:
            before = _freeing[app].pop()
            if not _freeing[app]:
                spark.conf.unset(FREED) if before is None else spark.conf.set(FREED, before)


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a folder of this machine; a
    cluster without the setting is an error, never a silent local path.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_folders:
        _own_folders[app] = tempfile.mkdtemp(prefix="groupledger-")
    return _own_folders[app]
