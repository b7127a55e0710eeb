"""Every catalogue query against its SQL counterpart, on whole tables."""

import datetime

import pytest

from rescuelens import catalog
from tests.conftest import SF, plan_of

duckdb = pytest.importorskip("duckdb")
TABLES = ("documents", "conversations", "events")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return round(value, 9)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(repr([plain(r[i]) for i in order]) for r in rows)


def test_every_query_has_a_counterpart():
    assert set(catalog.QUERIES) == set(catalog.ORACLES)


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query(spark, db, name):
    df = catalog.QUERIES[name](spark, SF)
    rows = df.collect()
    assert rows, "empty result"
    result = db.execute(catalog.ORACLES[name])
    columns = [c[0] for c in result.description]
    assert table(df.columns, rows) == table(columns, result.fetchall())


@pytest.mark.parametrize("name", ["mask_balanced", "audit_flags", "dedup_text", "label_pair",
                                  "cluster_split", "incremental_anti", "funnel_stages"])
def test_plans_have_no_cross_join(spark, name):
    plan = plan_of(catalog.QUERIES[name](spark, SF))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
