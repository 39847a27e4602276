"""Every registered query against its SQL statement in DuckDB, on the smallest tables.

The queries run four at a time in one session; each test waits for its own.
"""

from concurrent.futures import ThreadPoolExecutor

import pytest

import __spark_entry__ as entry_points
from checks.compare import connect, differences

SF = "/root/testdata/sf0.001"
NAMES = sorted(entry_points.QUERIES)


@pytest.fixture(scope="module")
def results(spark):
    def run(name: str) -> tuple[bool, str]:
        return differences(spark, connect(SF), name, SF)

    with ThreadPoolExecutor(4) as pool:
        yield {name: pool.submit(run, name) for name in NAMES}
        pool.shutdown(cancel_futures=True)


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


def test_every_query_has_a_statement():
    assert set(entry_points.STATEMENTS) == set(entry_points.QUERIES)


@pytest.mark.parametrize("name", NAMES)
def test_query(results, name):
    good, note = results[name].result()
    assert good, note
