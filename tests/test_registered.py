"""Every registered query against its SQL, and the driver contract."""

import pytest

import __spark_entry__ as entry_point
from compare import differences, engine
from peerbench.plans.oracle import ORACLE
from peerbench.plans.registry import REGISTRY

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return engine(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, duck, name):
    result = entry_point.queries()[name](spark, SF)
    assert differences(result, duck, entry_point.oracle_sql()[name]) == []


def test_every_sql_has_a_query():
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())
    assert set(REGISTRY) - set(ORACLE) == {"manifest_check"}


def test_manifest_check_finds_every_file_unchanged(spark):
    rows = entry_point.queries()["manifest_check"](spark, SF).collect()
    assert len(rows) == 14
    assert {(r.status, r.unchanged) for r in rows} == {("ok", True)}
    assert all(r.expected_bytes == r.actual_bytes for r in rows)


def test_entry_returns_rows(spark):
    assert entry_point.entry(spark).count() == 10
