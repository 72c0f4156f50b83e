import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tripmetrics.session import build_session
    s = build_session("local[2]", 4, extra={
        "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="tm-test-ckpt-"),
    })
    yield s
    s.stop()


@pytest.fixture(scope="session")
def dims(spark):
    from tripmetrics.sources.dims import profile_dims
    return profile_dims(spark)
