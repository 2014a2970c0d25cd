"""Every registered query against its SQL, on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from check_queries import canonical
from minuteflow.plans.registry import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for path in sorted(Path(SF_DIR).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def test_every_query_has_a_check():
    assert set(ORACLES) == set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    frame = entry.queries()[name](spark, SF_DIR)
    got = canonical([tuple(r) for r in frame.collect()], frame.columns)
    result = db.execute(entry.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(frame.columns) == sorted(names)
    assert got == canonical(result.fetchall(), names)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
