"""Shared pytest fixtures: one local Spark session for the whole run."""

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from folio.session import build_session

    warehouse = tempfile.mkdtemp(prefix="folio-wh-")
    s = build_session(
        master="local[8]", app="folio-tests", shuffle_partitions=8,
        extra={
            "spark.sql.warehouse.dir": warehouse,
            "spark.driver.memory": "8g",
            "spark.sql.execution.arrow.pyspark.enabled": "true",
        },
    )
    yield s
    s.stop()
