import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from catalith.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "catalith-tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
        spark__driver__memory="4g",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Evaluate one column expression over one row of named text values."""

    def run(build, **values):
        schema = ", ".join(f"{k} {'string' if not isinstance(v, list) else 'array<string>'}" for k, v in values.items()) or "x int"
        row = tuple(values.values()) or (1,)
        return spark.createDataFrame([row], schema).select(build().alias("r")).first()[0]

    return run
