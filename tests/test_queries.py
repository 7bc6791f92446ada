"""Every registered query with SQL gives the rows of its SQL on the smallest tables; plans have the shape they should."""

from __future__ import annotations

import pytest
from oracle import compare

import __spark_entry__ as entry
from lawweave.plans import registry

DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_query_equals_sql(spark, name):
    assert compare(spark, name, registry.QUERIES[name], registry.SQL[name], DIR) == ""


def test_entry(spark):
    assert entry.entry(spark).columns == ["rank", "source", "id", "title", "excerpt", "score"]
    assert set(entry.oracle_sql()) <= set(entry.queries())


def plan(spark, name):
    return registry.QUERIES[name](spark, DIR)._jdf.queryExecution().executedPlan().toString()


def test_plans(spark):
    assert "ReadSchema: struct<doc_id:bigint,n_chars:bigint>" in plan(spark, "score_band")
    assert "BroadcastHashJoin" in plan(spark, "registry_lookup")
    assert "TakeOrderedAndProject" in plan(spark, "keyword_search")
    assert "WindowGroupLimit" in plan(spark, "quota_per_source")
    for name in ("bm25_title", "first_match_title", "gap_new_anti"):
        assert "CartesianProduct" not in plan(spark, name)
