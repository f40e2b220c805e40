import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from shelfsight.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[4]",
        spark__sql__shuffle__partitions="4", spark__ui__enabled="false",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def column(spark):
    """Evaluate a column expression over a list of single values."""
    def run(values, expression, kind="string"):
        rows = [(i, v) for i, v in enumerate(values)]
        df = spark.createDataFrame(rows, f"i int, v {kind}")
        return [r[0] for r in df.orderBy("i").select(expression).collect()]
    return run
