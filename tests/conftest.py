import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from ratecraft.session import build_session, release_scratch

    shared = str(tmp_path_factory.mktemp("shared"))
    warehouse = str(tmp_path_factory.mktemp("warehouse"))
    s = build_session(
        "local[4]",
        app_name="ratecraft-tests",
        shuffle_partitions=4,
        extra={"spark.checkpoint.dir": shared, "spark.sql.warehouse.dir": warehouse},
    )
    yield s
    release_scratch(s)
    s.stop()
