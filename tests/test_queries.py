"""Every named query against its SQL, and the queries without SQL for plausible rows."""

from pathlib import Path

import pytest

import __spark_entry__ as entry_module
from compare import connect, difference
from reviewsent.sources.shared import run_folder

QUERIES, ORACLE = entry_module.queries(), entry_module.oracle_sql()


@pytest.fixture(scope="module", params=["sf0.001", "sf0.01"])
def sized(request):
    """A folder of tables and a connection to them, small and at the size the driver compares."""
    path = Path("/root/testdata") / request.param
    if not path.exists():
        pytest.skip("no test data")
    return str(path), connect(str(path))


def test_every_statement_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, sized, name):
    folder, con = sized
    with run_folder(spark):
        assert difference(QUERIES[name](spark, folder), con, ORACLE[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_runs(spark, folder, name):
    with run_folder(spark):
        assert QUERIES[name](spark, folder).count() > 0


def test_both_classes_on_both_sides():
    """On the size the driver compares, the model is trained and judged on both classes."""
    if not Path("/root/testdata/sf0.01").exists():
        pytest.skip("no test data")
    from pyspark.sql import SparkSession
    rows = QUERIES["split_report"](SparkSession.active(), "/root/testdata/sf0.01").collect()
    assert {(r["split"], r["label"]) for r in rows} == {(s, c) for s in ("train", "test") for c in (0, 1)}


def test_entry(spark):
    rows = entry_module.entry(spark).collect()
    assert 0 < len(rows) <= 40
    assert {r["direction"] for r in rows} == {"positive", "negative"}
