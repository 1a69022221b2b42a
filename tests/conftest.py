import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]

from tripmill.session import build_session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[*]", {
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g",
        "spark.sql.maxMetadataStringLength": "10000",  # plan tests read whole lists
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="tests-"),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR
