import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from hirelens.session import build_session
    scratch = tempfile.mkdtemp(prefix="hirelens-test-")
    s = build_session("local[4]", app="hirelens-tests", shuffle_partitions=4,
                      conf={"spark.sql.warehouse.dir": os.path.join(scratch, "warehouse")},
                      checkpoint_dir=os.path.join(scratch, "checkpoints"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir(tmp_path):
    return str(tmp_path)
