"""Every registered query equals its DuckDB oracle SQL (sf0.001)."""

import pytest

from __spark_entry__ import entry
from medallion.plans.queries import ORACLE_SQL, QUERIES
from tests.conftest import SF_SMALL
from tools.compare import canonical, duck

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_oracle():
    assert set(ORACLE_SQL) == set(QUERIES)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    s_cols, s_rows = canonical(df.columns, [tuple(r) for r in df.collect()])
    rel = con.execute(ORACLE_SQL[name])
    o_cols, o_rows = canonical([d[0] for d in rel.description], rel.fetchall())
    assert s_cols == o_cols
    assert len(s_rows) == len(o_rows)
    assert s_rows == o_rows


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["deliver_date", "state_id", "num_orders"]
    assert df.count() > 0
