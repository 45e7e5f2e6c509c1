import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tidemark.session import local_session, work_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("8")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder(spark):
    return work_dir(spark, "test")


@pytest.fixture
def messages(spark):
    def make(*values):
        return spark.createDataFrame(list(enumerate(values)), "pos bigint, value string")

    return make
