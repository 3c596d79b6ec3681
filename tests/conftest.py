import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from skyframe.session import ensure_checkpoint_dir, get_spark
    s = get_spark("local[4]", "skyframe-tests", shuffle_partitions=4)
    ensure_checkpoint_dir(s, tempfile.mkdtemp(prefix="skyframe-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="skyframe-test-")
