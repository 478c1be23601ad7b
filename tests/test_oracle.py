"""Every registered query against its SQL equivalent, on whole tables."""

import pytest
from compare import connect, duck_result, spark_result

import __spark_entry__ as driver
from gaugeworks.plans.oracle import all_oracles
from gaugeworks.plans.queries import all_queries

SF_DIRS = ["/root/testdata/sf0.001", "/root/testdata/sf0.01"]


@pytest.fixture(scope="module", params=SF_DIRS)
def sf_dir(request):
    return request.param


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_matches_sql(spark, sf_dir, name):
    columns, rows = spark_result(all_queries()[name](spark, sf_dir))
    expected_columns, expected = duck_result(connect(sf_dir), all_oracles()[name])
    assert columns == expected_columns
    assert len(rows) == len(expected) > 0
    differing = [(a, b) for a, b in zip(rows, expected) if a != b]
    assert not differing, differing[:3]


def test_entry_runs(spark):
    assert driver.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(all_queries()) == set(all_oracles())
    assert set(all_queries()) <= set(driver.queries()) and set(all_oracles()) <= set(driver.oracle_sql())
