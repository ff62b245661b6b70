import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from hirelens.session import build_session, checkpoint_dir

    s = build_session("local[4]", shuffle_partitions=8)
    # Tests run without a cluster: register a private checkpoint folder only here.
    checkpoint_dir(s, fallback=tempfile.mkdtemp(prefix="hirelens-test-ckpt-"))
    yield s
    s.stop()
