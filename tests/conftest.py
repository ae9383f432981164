import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from faultloom.session import build_session, clear_scratch  # noqa: E402

TESTDATA = os.environ.get("TESTDATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="faultloom-tests-")
    session = build_session(
        "faultloom-tests",
        "local[8]",
        **{
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "8g",
            # Small inputs: keep one task per core through shuffles of a few megabytes.
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
            "spark.sql.warehouse.dir": f"{scratch}/warehouse",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    clear_scratch(session)
    session.stop()


@pytest.fixture
def sf_dir():
    return f"{TESTDATA}/sf0.001"
