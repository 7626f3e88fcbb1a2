"""Every registered query against its SQL, over the whole tables of a small data set."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver
from workload import oracle, queries

SF_DIR = "/root/testdata/sf0.001"
# These find nothing in the smallest data set.
RARE = {
    "volume_spikes_1min", "recent_anomalies_top50", "stream_flow_anomalies",
    "running_spikes_1min", "stream_running_spikes",
}
RARE_SF_DIR = "/root/testdata/sf0.01"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="no test data")


def database(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def counted(rows, columns):
    order = [columns.index(name) for name in sorted(columns)]
    return Counter(repr([row[i] for i in order]) for row in rows)


def test_every_query_has_its_sql():
    assert queries.queries().keys() == oracle.oracle_sql().keys()
    assert queries.queries().keys() <= driver.queries().keys()


@pytest.mark.parametrize("name", queries.queries())
def test_query_matches_sql(spark, name):
    sf_dir = RARE_SF_DIR if name in RARE else SF_DIR
    found = driver.queries()[name](spark, sf_dir)
    expected = database(sf_dir).sql(driver.oracle_sql()[name])
    names, rows = expected.columns, expected.fetchall()
    assert sorted(found.columns) == sorted(names)
    assert rows, "the comparison would be empty"
    assert counted(found.collect(), found.columns) == counted(rows, names)


def test_flagship(spark):
    assert driver.entry(spark).count() > 0
