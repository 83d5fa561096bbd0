import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from leadpipe.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", spark__sql__shuffle__partitions="8")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """A DataFrame from rows and a DDL schema."""

    def build(rows, schema):
        return spark.createDataFrame([r if isinstance(r, tuple) else (r,) for r in rows], schema)

    return build


@pytest.fixture
def apply(frame):
    """Values of a column expression over a list of texts."""

    def run(values, expression):
        from pyspark.sql import functions as F

        df = frame(list(enumerate(values)), "n int, x string")
        rows = df.select("n", expression(F.col("x")).alias("y")).collect()
        return [r.y for r in sorted(rows, key=lambda r: r.n)]

    return run
