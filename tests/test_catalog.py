"""Every query of the contract against its SQL, on the smallest tables."""

from __future__ import annotations

import pytest
from oracle import difference

import __spark_entry__ as contract
from corpuscope.plans import catalog

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_agrees_with_sql(spark, name):
    run = contract.queries()[name]
    assert difference(spark, SMALL, run, contract.oracle_sql()[name]) is None


def test_every_oracle_belongs_to_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_has_rows(spark):
    report = contract.entry(spark)
    assert report.columns == ["political_party", "top_keywords"]
    assert report.count() == 4


def test_the_splits_of_lasting_ids_are_not_of_a_fixed_number(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(catalog.ids, "lasting_ids", lambda df: seen.append(df) or df)
    catalog.lasting_ids(spark, "/root/testdata/sf0.001")
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "length(speech" in plan and "REPARTITION_BY_COL" in plan
