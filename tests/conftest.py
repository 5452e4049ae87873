import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join(x for x in (ROOT, os.environ.get("PYTHONPATH")) if x)  # for Python workers

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from marketframe.session import get_session
    scratch = tempfile.mkdtemp(prefix="mf-test-")
    s = get_session("local[4]", app="marketframe-tests", shuffle_partitions=4,
                    extra={"spark.checkpoint.dir": f"{scratch}/ckpt",
                           "spark.sql.warehouse.dir": f"{scratch}/wh",
                           "spark.driver.memory": "4g"})
    yield s


@pytest.fixture()
def tmp_shared(spark):
    """A fresh folder under the session's checkpoint directory."""
    from marketframe.session import checkpoint_dir
    return tempfile.mkdtemp(dir=checkpoint_dir(spark))
