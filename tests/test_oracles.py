"""Every registered job beside its SQL at the smallest scale, so that none turns red unseen."""

import pytest

from rookery.plans import JOBS
from rookery.views import Tables
from tests.oracle_check import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("key", [key for key, entry in JOBS.items() if entry.oracle])
def test_job_agrees_with_its_sql(spark, con, key):
    agrees, note = compare(JOBS[key].build(Tables(spark, SF)), con, JOBS[key].oracle)
    assert agrees, note
