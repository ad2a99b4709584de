import os
import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from ordermill.session import build_session  # noqa: E402

TESTDATA = os.environ.get("ORDERMILL_TESTDATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "ordermill-tests",
        "local[8]",
        {
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "6g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="ordermill-warehouse-"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="session")
def medium():
    return f"{TESTDATA}/sf0.01"


@pytest.fixture
def with_conf(spark):
    """Set session settings for one test."""
    changed = {}

    def set_conf(**settings):
        for name, value in settings.items():
            key = name.replace("__", ".")
            changed.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield set_conf
    for key, value in changed.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


@pytest.fixture
def final_plan():
    """Run a frame without keeping rows, give the plan that was run in the end."""

    def run(frame):
        plan = frame._jdf.queryExecution().executedPlan()
        frame._jdf.queryExecution().toRdd().count()
        return plan.toString()

    return run
