import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cvelake.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_session(
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="cvelake-wh-"),
        },
    )
    yield s


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)
