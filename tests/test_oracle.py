"""Every query with an SQL equivalent, compared value by value."""

import os

import pytest

import __spark_entry__ as entry_points
from checks.compare import compare, connect
from checks.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")
BUILDERS, SQL = entry_points.queries(), entry_points.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", [n for n in QUERIES if n in SQL])
def test_matches_sql(spark, duck, name):
    assert compare(BUILDERS[name](spark, SF_DIR).toPandas(), duck.execute(SQL[name]).df()) == "ok"


def test_feature_rows_are_unique_per_listing(spark):
    from checks.queries import training
    from checks.roles import TestTables
    from hammerline.operators.history import unique_listing
    assert unique_listing(training(TestTables(spark, SF_DIR))).count() == 0


def test_published_probabilities_are_ordered(spark):
    out = BUILDERS["predictions_nontrustee"](spark, SF_DIR)
    bad = out.filter("SellerAcceptedSalePrediction < ExceedReservePrediction OR AuctionDaySalePrediction < SellerAcceptedSalePrediction"
                     " OR AuctionDaySalePrediction NOT BETWEEN 0 AND 1 OR Negative1 IS NULL OR Negative2 IS NULL")
    assert bad.count() == 0


def test_union_keeps_every_row(spark):
    parts = [BUILDERS[n](spark, SF_DIR).count() for n in ("predictions_nontrustee", "predictions_trustee")]
    assert BUILDERS["unified_predictions"](spark, SF_DIR).count() == sum(parts)
