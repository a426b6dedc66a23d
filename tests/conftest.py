import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from arriero.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[4]", 4, {
        "spark.driver.memory": "4g", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.sql.sources.parallelPartitionDiscovery.threshold": "1000",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


def rows(df, *order):
    """Rows as tuples, sorted by their text."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [str(v) for v in r])
