import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from encore.session import build_session
    s = build_session("local[4]", app_name="encore-tests", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="encore-test-ckpt-")})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def wh_small(spark):
    from encore.sources.warehouse import warehouse_for
    return warehouse_for(spark, SF_SMALL)


@pytest.fixture()
def scratch(spark):
    from encore.session import path_join, shared_dir
    import uuid
    return path_join(shared_dir(spark), "t-" + uuid.uuid4().hex[:10])
