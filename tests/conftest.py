import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

from relaybook.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = local_session(
        "relaybook-tests",
        **{"spark.checkpoint.dir": str(shared), "spark.driver.memory": "8g",
           "spark.sql.warehouse.dir": str(shared / "warehouse")},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)
