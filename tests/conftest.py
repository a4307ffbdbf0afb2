import os
import sys
import uuid

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from medallion.session import build_session

    session = build_session("local[*]", shuffle_partitions=8, app_name="medallion_tests")
    yield session
    session.stop()


@pytest.fixture()
def lake(spark):
    """Fresh databases and storage folder with every table and the BI view."""
    from medallion.plans.queries import Lake

    return Lake(spark, "t" + uuid.uuid4().hex[:6])


def ts(text):
    from datetime import datetime

    return None if text is None else datetime.fromisoformat(text)
