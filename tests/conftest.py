import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from strata.session import build_session

    ckpt = tempfile.mkdtemp(prefix="strata-test-")
    session = build_session(
        master="local[*]",
        shuffle_partitions=8,
        extra_conf={"spark.ui.showConsoleProgress": "false", "spark.checkpoint.dir": ckpt},
    )
    yield session
    session.stop()


@pytest.fixture
def tmp_dir(spark):
    from strata.session import work_dir

    return work_dir(spark, "test")
