import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from chatterlens.session import drop_shared_folders, local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, memory="6g", app="chatterlens-tests")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    drop_shared_folders(session)
    session.stop()


@pytest.fixture
def rows(spark):
    """Build a DataFrame from tuples and a schema string."""
    return lambda data, schema: spark.createDataFrame(data, schema)


def values(df, column=None):
    """Rows as a sorted list of tuples, or one column as a list."""
    if column is not None:
        return [row[column] for row in df.collect()]
    return sorted([tuple(row) for row in df.collect()], key=repr)
