import pathlib
import sys

import pytest

ROOT = pathlib.Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from check_queries import spark_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = spark_session()
    session.sparkContext.setLogLevel("ERROR")
    return session
