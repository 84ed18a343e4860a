"""All registered queries against their SQL text."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from oracle_check import compare, connect
from roomtide.operators import models
from roomtide.plans import registry
from roomtide.plans.oracle import SQL

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    assert compare(queries()[name](spark, SF_DIR), connect(SF_DIR), oracle_sql()[name]) == ""


def test_entry(spark):
    assert entry(spark).count() > 0


def test_every_sql_text_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_every_cleaned_booking_is_scored(spark):
    scored = queries()["scored_batch"](spark, SF_DIR)
    rows = registry.cleaned_bookings(spark, SF_DIR)
    assert scored.count() == rows.count() > 0
    assert scored.where("p_cancel is null").count() == 0


def test_models_have_full_settings(spark, monkeypatch):
    class Enough(Exception):
        pass

    def stop(train, validation, chosen):
        assert [chosen[n].getNumTrees() for n in ("random_forest", "random_forest_tuned")] == [300, 300]
        assert (chosen["boosted_trees"].getMaxIter(), chosen["logistic_regression"].getMaxIter()) == (500, 1000)
        raise Enough

    monkeypatch.setattr(models, "run_experiments", stop)
    with pytest.raises(Enough):
        queries()["experiment_metrics"](spark, SF_DIR)
