import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from fiscalflow.session import build_session

    s = build_session(
        master="local[4]",
        shuffle_partitions=4,
        extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="ff-test-ckpt-"), "spark.sql.maxMetadataStringLength": "2000"},
    )
    yield s
    s.stop()
