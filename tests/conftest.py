import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from orderlens.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    # Tests set their own shared folder only because none is configured here.
    ckpt = tempfile.mkdtemp(prefix="orderlens-test-")
    s = build_session(
        "local[4]",
        app_name="orderlens-tests",
        shuffle_partitions=4,
        conf={"spark.checkpoint.dir": f"{ckpt}/ckpt", "spark.default.parallelism": "4"},
    )
    yield s
    s.stop()


@pytest.fixture
def tmp_dir(tmp_path):
    return str(tmp_path)
