import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from clipstar.session import get_session

    session = get_session("local[4]", app_name="clipstar-tests", conf={
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.showConsoleProgress": "false",
    })
    session.sparkContext.setLogLevel("ERROR")
    if session.sparkContext.getCheckpointDir() is None and not session.conf.get(
            "spark.checkpoint.dir", None):
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="clipstar-test-ckpt-"))
    yield session
    session.stop()


@pytest.fixture()
def tmp_root(tmp_path):
    return str(tmp_path)
