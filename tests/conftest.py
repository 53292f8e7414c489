import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tagstream.session import build_session
    ckpt = tempfile.mkdtemp(prefix="tagstream-test-ckpt-")
    s = build_session("local[4]", app="tagstream-tests", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": ckpt,
                             "spark.sql.streaming.stateStore.providerClass":
                                 "org.apache.spark.sql.execution.streaming.state."
                                 "HDFSBackedStateStoreProvider"})
    yield s
    s.stop()


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)
