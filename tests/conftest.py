import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF001 = "/root/testdata/sf0.01"
SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from relkit.session import build_session
    scratch = tempfile.mkdtemp(prefix="relkit-test-")
    s = build_session("local[*]", app="relkit-tests", shuffle_partitions=8, extra={
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.warehouse.dir": os.path.join(scratch, "warehouse"),
    })
    # Tests set their own checkpoint folder only where the session names none.
    if not s.sparkContext.getCheckpointDir() and not s.conf.get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(os.path.join(scratch, "checkpoints"))
    yield s


@pytest.fixture()
def scratch_dir():
    return tempfile.mkdtemp(prefix="relkit-out-")
