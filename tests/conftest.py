import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from paneltide.session import build_session

    s = build_session(
        "local[4]", app_name="paneltide-tests", shuffle_partitions=4,
        extra_conf={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="paneltide-test-ckpt-")},
    )
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="paneltide-test-")
