import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stratalake.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    session = local_session(cores=8, shuffle_partitions=4, memory="6g", shared=shared)
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def frame(spark):
    """``frame("a int, b string", (1, "x"), ...)``"""
    return lambda schema, *rows: spark.createDataFrame(list(rows), schema)


@pytest.fixture
def bag():
    """Rows as a sorted list of tuples, columns in the given order."""

    def rows(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=repr)

    return rows
