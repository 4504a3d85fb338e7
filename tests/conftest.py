import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from lamina.session import build_session

    warehouse = tempfile.mkdtemp(prefix="lamina-test-wh-")
    s = build_session(
        master=os.environ.get("LAMINA_TEST_MASTER", "local[*]"),
        shuffle_partitions=8,
        app="lamina-tests",
        extra={"spark.sql.warehouse.dir": warehouse, "spark.driver.memory": "4g",
               "spark.checkpoint.dir": tempfile.mkdtemp(prefix="lamina-test-ckpt-")},
    )
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_small():
    return SF_SMALL
