"""Tables with a row for each auction, property, listing or bidder are never sent to the driver, however small their files are."""

import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from checks import queries, roles
from hammerline.operators import bidders, history
from hammerline.plans import nontrustee, trustee
from hammerline.session import settle, settle_all
from tests.test_moved_once import folder  # noqa: F401

KEY = "PropertyId bigint, AuctionId bigint, VenueId bigint"


@pytest.fixture(autouse=True)
def _all_files_are_small(spark):
    """Every table is under the limit by its files, as pressed keys are at any number of rows; sizes that are known from running rows are not."""
    limits = {"spark.sql.autoBroadcastJoinThreshold": "300k", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    held = {k: spark.conf.get(k, None) for k in limits}
    for k, v in limits.items():
        spark.conf.set(k, v)
    yield
    for k, v in held.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def broadcasts(df):
    """What a plan would broadcast, each as the keys that it is joined by."""
    found, todo = [], [df._jdf.queryExecution().sparkPlan()]
    while todo:
        node = todo.pop()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
        if node.nodeName() == "BroadcastHashJoin":
            keys = node.leftKeys() if "BuildLeft" in node.buildSide().toString() else node.rightKeys()
            found.append(re.sub(r"#\d+L?", "", keys.mkString(" ")))
    return found


def auctions(spark):
    return settle(spark.createDataFrame([(a, f"SA{a}", "1-URGENT", 0, int(a == 3)) for a in range(1, 6)],
                                        "AuctionId bigint, SystemAuctionId string, AuctionCode string, IsTest int, IsDemo int"))


def listings(spark):
    rows = [(k, a, 1, date(2014, 1, 10 + k), k % 2, 1, 1, k % 3) for k in range(1, 5) for a in (1, 2, 3, None)]
    return settle(spark.createDataFrame(rows, f"{KEY}, AuctionDate date, IsSold int, IsAuctioned int, IsAuction int, SellerId int"))


def test_auctions_are_not_broadcast_for_the_listings_of_the_window(spark, p):
    out = history.upcoming(history.recent_listings(listings(spark), auctions(spark), p), p).select(F.col("PropertyId"), "SystemAuctionId")
    assert broadcasts(out) == []
    every = history.recent_listings(listings(spark), auctions(spark), p)
    assert sorted((r.PropertyId, r.SystemAuctionId) for r in every.collect()) == [(k, f"SA{a}") for k in range(1, 5) for a in (1, 2)]


def homes(spark):
    rows = [(k, "AZ" if k < 3 else "NV", "c", str(k), "REO", 1, 1.0, 1.0, 1990) for k in (1, 2, 4, 5)]
    return settle(spark.createDataFrame(rows, "PropertyId bigint, PropertyState string, PropertyCounty string, PropertyZip string, ProductType string, "
                                              "Bedrooms int, Baths double, LotSize double, YearBuilt int"))


@pytest.mark.parametrize("name, extra", [("event_sizes", ["EventSize", "StateEventSize"]), ("price_tercile_by_state", ["ValueLevel_Low"])])
def test_neither_homes_nor_auctions_are_broadcast_for_all_listings(spark, monkeypatch, name, extra):
    wh = {"fact_auction": listings(spark).withColumn("Reserve", F.col("PropertyId") * 10.0), "dim_property": homes(spark), "dim_auction": auctions(spark)}
    with monkeypatch.context() as unwritten:
        unwritten.setattr(queries, "settle", lambda df: df)
        assert broadcasts(queries._priced(wh)) == []
    out = queries.QUERIES[name].build(wh)
    got = sorted(((r.PropertyId, r.AuctionId or 0), r.PropertyState, *[r[c] for c in extra]) for r in out.collect())
    assert [g[:2] for g in got] == [((k, a), {1: "AZ", 2: "AZ", 4: "NV"}.get(k)) for k in range(1, 5) for a in range(4)]
    if name == "event_sizes":
        assert {(g[1], *g[2:]) for g in got if g[0][1]} == {("AZ", 12, 6), ("NV", 12, 3), (None, 12, 3)}
    else:
        assert {s: sum(g[2] for g in got if g[1] == s) for s in ("AZ", "NV", None)} == {"AZ": 3, "NV": 2, None: 2}


GROWING = re.compile("PropertyId|AuctionId|BidderId|_row")


@pytest.mark.parametrize("plan", [nontrustee, trustee])
@pytest.mark.parametrize("scoring", [False, True])
def test_a_feature_row_broadcasts_no_table_that_grows_with_its_rows(spark, folder, monkeypatch, plan, scoring):  # noqa: F811
    seen = []

    def noted(write):
        return lambda *frames: seen.extend(frames) or write(*frames)

    monkeypatch.setattr(plan, "settle", noted(settle))
    monkeypatch.setattr(plan, "settle_all", noted(settle_all))
    out = plan.feature_row(roles.TestTables(spark, folder), queries.P, scoring=scoring)
    found = [key for frame in (*seen, out) for key in broadcasts(frame)]
    assert len(seen) == 4 and "_block" in found  # bits have a fixed size
    assert [key for key in found if GROWING.search(key)] == []


def test_histories_of_bidders_broadcast_no_table_that_grows_with_its_rows(spark, folder):  # noqa: F811
    wh = roles.TestTables(spark, folder)
    hist = bidders.bidder_history(wh["fact_bid_live"], wh["fact_residential"], wh["dim_property"], wh["dim_bidder"], queries.P)
    attendance = bidders.bidder_attendance(wh["fact_property_registration"], wh["fact_bid_live"], wh["dim_bidder"], queries.P)
    for df in (hist, attendance, queries.QUERIES["registrant_matches"].build(wh), queries.QUERIES["seller_portfolio_quality_scoring"].build(wh),
               queries.QUERIES["trustee_zip_sell_through"].build(wh)):
        assert [key for key in broadcasts(df) if GROWING.search(key)] == []
