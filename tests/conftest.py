import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from statquarry.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tests", shuffle=4)
    yield session
    session.stop()


@pytest.fixture
def column(spark):
    """Evaluate an expression over a list of texts."""

    def run(texts, build, kind="string"):
        df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], f"i int, c {kind}")
        return [r[1] for r in sorted(df.select("i", build("c").alias("out")).collect())]

    return run
