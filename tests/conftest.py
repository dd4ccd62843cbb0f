import os
import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark():
    from curbline.session import build_session

    session = build_session(
        "curbline-tests",
        "local[4]",
        {
            "spark.sql.shuffle.partitions": "4",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="curbline-tests-"),
            "spark.ui.showConsoleProgress": "false",
            # A zone with clock changes: no result may depend on it.
            "spark.sql.session.timeZone": "America/New_York",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(params=["UTC", "America/New_York", "Asia/Tokyo", "Pacific/Apia"])
def any_zone(spark, request):
    key = "spark.sql.session.timeZone"
    before = spark.conf.get(key)
    spark.conf.set(key, request.param)
    yield request.param
    spark.conf.set(key, before)


@pytest.fixture(scope="session")
def testdata():
    path = os.environ.get("CURBLINE_TESTDATA", "/root/testdata/sf0.001")
    if not os.path.isdir(path):
        pytest.skip(f"no test data at {path}")
    return path
