import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from vacancylake.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    home = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests", 4, spark__sql__shuffle__partitions="4", spark__driver__memory="4g",
        spark__sql__warehouse__dir=str(home / "warehouse"), spark__checkpoint__dir=str(home / "checkpoint"),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
