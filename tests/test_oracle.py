"""Every query against its SQL counterpart on the smallest tables."""

import pytest
from compare import connect, contract, difference

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_matches_sql(spark, con, name):
    problem = difference(spark, con, name, SF_DIR)
    assert problem is None or (problem, name) == ("both empty", "without_orders")  # all customers have orders here


@pytest.mark.parametrize(
    "name",
    [
        "idw_hourly",
        "idw_repeated_readings",
        "scd_join",
        "nearest_in_time",
        "search_by_media",
        "pending_files",
        "without_events",
        "append_unseen",
        "newer_than_archive",
        "disk_join",
        "lattice_cells",
        "buoy_measurements",
        "condition_tags",
    ],
)
def test_same_result_without_broadcast(spark, con, no_broadcast, name):
    assert difference(spark, con, name, SF_DIR) is None


def test_every_query_has_sql_and_entry_runs(spark):
    own = set(contract.queries()) - set(contract.llm.QUERIES if contract.llm else ()) - {"pipeline"}
    assert own <= set(contract.oracle_sql())
    assert contract.entry(spark).count() > 0
