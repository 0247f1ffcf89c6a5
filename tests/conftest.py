import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from wattline.session import checkpoint_root, get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[*]", app_name="wattline-tests", shuffle_partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir() and not s.conf.get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="wattline-test-ckpt-"))
    checkpoint_root(s)
    yield s


@pytest.fixture()
def tmp_dir(spark):
    from wattline.session import scratch_path
    return scratch_path(spark, "test")
