"""All queries against DuckDB, at the smallest scale that gives them rows."""

import os

import pytest
from oracle import database, difference

from lumbung import workload

FOLDER = os.environ.get("LUMBUNG_TEST_DATA", "/root/testdata/sf0.001")
LARGER = os.environ.get("LUMBUNG_TEST_DATA", "/root/testdata/sf0.01")
# Without rows at the smallest scale: few deficits there, and no month with both regions of a lag.
SPARSE = {
    "d15_two_region_series", "e19_deficit_ranking", "e24_vulnerable_regions", "f4_lead_pairs", "f5_lag_shift", "f8_z_score",
    "g5_peak_lag", "k2_lag_scan", "k2_short_lag_scan", "k4_lag_verdicts", "k5_overlay",
}


@pytest.fixture(scope="module")
def databases():
    return {folder: database(folder) for folder in (FOLDER, LARGER) if os.path.isdir(folder)}


def test_every_query_has_an_oracle():
    assert set(workload.QUERIES) == set(workload.ORACLES)


@pytest.mark.parametrize("name", list(workload.QUERIES))
def test_query(spark, databases, name):
    folder = LARGER if name in SPARSE else FOLDER
    if folder not in databases:
        pytest.skip("no test tables")
    problem = difference(workload.QUERIES[name](spark, folder), databases[folder], workload.ORACLES[name])
    assert problem is None, problem
