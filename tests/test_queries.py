"""Every registered query against its SQL, and the shape of the plans."""

import pytest

import __spark_entry__ as entry
from check import compare, connect
from suite.registry import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, duck, name):
    outcome = compare(spark, duck, SF_DIR, name)
    assert outcome.startswith("ok"), outcome


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


# Reading frames and DNS messages is the only work outside the JVM.
PYTHON = {"s3_capture_files", "k1_decode_packets", "k7_dns", "k9_payload_width"}


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n[0] not in "sw"))
def test_plans_stay_in_the_jvm_and_join_on_keys(spark, name):
    plan = entry.queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    if name not in PYTHON:
        for node in ("ArrowEvalPython", "BatchEvalPython", "MapInArrow", "MapInPandas", "FlatMapGroups"):
            assert node not in plan, node
