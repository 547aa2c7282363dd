from __future__ import annotations

import os
import sys

import pytest

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(os.path.abspath(__file__))]

from martloom.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = os.environ.get("TEST_CHECKPOINT_DIR") or str(tmp_path_factory.mktemp("checkpoints"))
    conf = {
        "spark.master": "local[8]",
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        "spark.checkpoint.dir": shared,
        # Not recording the call site of every column halves the time spent building plans.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    spark = session("martloom-tests", **conf)
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture
def rows():
    """Rows of a frame as sorted tuples."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=repr)

    return collect
