from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from mercato.session import local_session  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    home = tempfile.mkdtemp(prefix="mercato-test-")
    session = local_session(
        "4", 4, **{"spark.sql.warehouse.dir": os.path.join(home, "warehouse"), "spark.scheduler.mode": "FAIR"}
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data() -> str:
    return DATA


@pytest.fixture()
def folder() -> str:
    return tempfile.mkdtemp(prefix="mercato-test-")


@pytest.fixture()
def rows(spark):
    """Small frame from tuples; all columns text unless a schema is given."""

    def make(names: str, *values: tuple, schema: str | None = None):
        return spark.createDataFrame(list(values), schema or ", ".join(f"{n} string" for n in names.split()))

    return make
