import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from changeflow import build_session
from changeflow.sources import paths


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "changeflow-tests",
        "local[8]",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="8g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("scratch")),
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def root(spark):
    return paths.new_scratch(spark)
