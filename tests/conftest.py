import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rankflow.session import CHECKPOINT_DIR, local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    # Small inputs must not shrink to one partition, or nothing would cross a boundary.
    settings = {CHECKPOINT_DIR: folder, "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    session = local_session(8, app="tests", **settings)
    yield session
    session.stop()


@pytest.fixture
def fresh_dir():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")
