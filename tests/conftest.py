import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))


@pytest.fixture(scope="session")
def spark():
    import tempfile

    from histlake.session import build_session
    s = build_session("local[*]", app="histlake-tests", shuffle_partitions=8,
                      conf={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="histlake-wh-")})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
