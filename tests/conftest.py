from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from granary import session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    built = session.build(
        "granary-tests",
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "8g",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    built.sparkContext.setLogLevel("ERROR")
    yield built
    built.stop()
