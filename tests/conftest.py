import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from rsvpark.session import get_spark
    active = SparkSession.getActiveSession()
    if active is None:
        # Tests own their checkpoint folder only because none is configured.
        s = get_spark("local[4]", 8)
    else:
        s = active
    yield s


@pytest.fixture()
def workdir():
    return tempfile.mkdtemp(prefix="rsvpark-test-")
