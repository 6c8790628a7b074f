import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent.parent))

from outagelens.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores=8, memory="6g")
    yield session
    session.stop()


@pytest.fixture
def values(spark):
    """Values of a Column over rows of the given fields, in order."""

    def evaluate(column, schema, rows):
        data = [(i, *(row if isinstance(row, tuple) else (row,))) for i, row in enumerate(rows)]
        df = spark.createDataFrame(data, f"_row int, {schema}")
        return [r[0] for r in df.orderBy("_row").select(column.alias("v")).collect()]

    return evaluate
