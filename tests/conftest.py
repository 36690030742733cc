from __future__ import annotations

import sys
from datetime import date, datetime
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tools")]

from groupledger.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", "tests")
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def rows(spark):
    """rows(ddl, (..), (..)): a small DataFrame."""

    def make(ddl: str, *data):
        return spark.createDataFrame(list(data), ddl)

    return make


def day(text: str) -> date:
    return date.fromisoformat(text)


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


def as_set(df) -> set:
    return {tuple(r) for r in df.collect()}


def as_list(df) -> list:
    return sorted(tuple(r) for r in df.collect())
