"""Every registered query against its SQL counterpart."""

import check
import pytest
from groupledger.queries import QUERIES
from oracle import ORACLE

from .conftest import SMALL

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def duck():
    return check.connect(SMALL)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(check.registry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, duck, name):
    assert check.differences(spark, duck, name, SMALL) == []


def test_entry(spark):
    df = check.registry.entry(spark)
    assert df.count() > 0
    assert "channel_revenue_share_pct" in df.columns
