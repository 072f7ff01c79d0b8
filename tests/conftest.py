import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from brightloom.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "local[8]", "tests", spark__sql__shuffle__partitions="4", spark__ui__enabled="false",
        spark__driver__memory="6g", spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=f"file://{tmp_path_factory.mktemp('shared')}",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Value of a column expression over a one-row frame of literals."""
    from pyspark.sql import functions as F

    def run(make, *values, types=None):
        names = [f"v{i}" for i in range(len(values))]
        schema = ", ".join(f"{n} {t}" for n, t in zip(names, types or ["string"] * len(values)))
        frame = spark.createDataFrame([tuple(values)], schema)
        return frame.select(make(*[F.col(n) for n in names]).alias("out")).first()["out"]

    return run
