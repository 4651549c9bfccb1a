import sys
import uuid
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from adstrata.session import build_session, shared_folder  # noqa: E402
from adstrata.sources.tables import TableRef  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def new_table(spark):
    """A table name and folder nothing else uses."""

    def make(label: str = "t") -> TableRef:
        unique = f"{label}_{uuid.uuid4().hex}"
        return TableRef(unique, f"{shared_folder(spark)}/adstrata-tests/{unique}")

    return make


@pytest.fixture(scope="session")
def values(spark):
    """The values of expressions over one row."""

    def evaluate(expression, schema=None, rows=None):
        df = spark.createDataFrame(rows, schema) if rows is not None else spark.range(1)
        return [r[0] for r in df.select(expression).collect()]

    return evaluate
