"""Tables behind the warehouse are joined and written once; large histories lose what no listing asks for before they are shuffled."""

import re
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from checks import roles
from hammerline.operators import bidders, features as fx, history, models
from hammerline.params import Params


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Tiny star tables, with an order that is missing, a repeated line and null keys."""
    at = str(tmp_path_factory.mktemp("star"))
    day = datetime(2001, 5, 1)
    tables = {
        "region": ([(k, f"R{k}") for k in range(5)], "r_regionkey int, r_name string"),
        "nation": ([(k, f"NATION_{k}", k % 5) for k in range(6)], "n_nationkey int, n_name string, n_regionkey int"),
        "supplier": ([(k, f"S{k}", k % 6, 10.0 * k) for k in range(8)], "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double"),
        "customer": ([(k, f"C{k}", k % 6, 1.0, "AUTO") for k in range(9)], "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
        "part": ([(k, "p", "B", "LARGE", k, 9.0) for k in range(10)],
                 "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"),
        "orders": ([(k, k % 9, "O", 5.0, day, "5-LOW") for k in range(12)],
                   "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"),
        "lineitem": ([(k % 14 if k else None, k % 10, k % 8, k % 7 + 1, float(k % 50), 100.0 + k, k % 11 / 100, k % 9 / 100, "NAR"[k % 3], "OF"[k % 2], day)
                      for k in [*range(60), 7, 7]],
                     "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, "
                     "l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"),
        "events": ([(k, day, k % 9, ("click", "view", "purchase", "error")[k % 4], 2.0, '{"k": %d}' % (k % 10)) for k in range(40)],
                   "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{at}/{name}.parquet")
    return at


def test_lines_are_joined_and_written_once_and_facts_are_views(spark, folder):
    wh = roles.TestTables(spark, folder)
    facts = {name: wh[name] for name in roles.WAREHOUSE}
    kept = {name for _, at, name in roles._KEPT if at == folder}
    assert {"line", "seen_event", "zip_month"} <= kept and not kept & set(roles.VIEWS)
    plain = {n: spark.read.parquet(f"{folder}/{n}.parquet") for n in ("lineitem", "orders", "events", "supplier", "nation", "region", "customer", "part")}
    for n, df in plain.items():
        df.createOrReplaceTempView(n)
    try:
        for helper in ("geo", "line", "placed_part", "seen_event", "zip_month"):
            spark.sql(roles.role_sql(helper, "spark")).createOrReplaceTempView(helper)
        for name, got in facts.items():
            want = spark.sql(roles.role_sql(name, "spark"))
            assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect())), name
    finally:
        for n in (*plain, "geo", "line", "placed_part", "seen_event", "zip_month"):
            spark.catalog.dropTempView(n)


def test_a_key_filter_keeps_every_wanted_row_and_few_others(spark):
    wanted = spark.range(0, 30_000, 7).withColumnRenamed("id", "AuctionId").withColumn("AuctionId", F.col("AuctionId").cast("int"))
    rows = spark.range(-5, 60_000).select(F.col("id").alias("AuctionId"), F.lit("x").alias("note"))
    rows = rows.unionByName(rows.filter("AuctionId < 100")).unionByName(spark.createDataFrame([(None, "null")], "AuctionId bigint, note string"))
    kept = history.possibly_for(rows, wanted, "AuctionId")
    assert kept.columns == rows.columns
    assert kept.join(wanted, "AuctionId").count() == rows.join(wanted, "AuctionId").count()
    assert kept.count() < 1.05 * wanted.count() + 200
    assert history.possibly_for(rows, wanted.limit(0), "AuctionId").count() == 0
    assert history.possibly_for(rows.limit(0), wanted, "AuctionId").count() == 0


def test_bids_are_moved_once_before_they_meet_valuations(spark):
    key = "PropertyId bigint, AuctionId bigint, VenueId bigint"
    bids = spark.createDataFrame([(b % 3, p, a, 1, 10.0 + b, 1.0, 0, 5.0, 9.0, date(2014, 1, 1), date(2014, 1, 1)) for b in range(9) for p in (1, 2) for a in (1, 2)],
                                 f"BidderId bigint, {key}, BidAmount double, WinningBid double, IsWinningBid int, StartingBid double, AuctionSellerReserve double, "
                                 "AuctionDate date, BidEndDate date")
    valued = spark.createDataFrame([(1, 1, 1, 50.0), (2, 1, 1, 60.0), (2, 1, 1, 70.0)], f"{key}, BPO double")
    homes = spark.createDataFrame([(k, "c", 1, 1.0, 1.0, 1900, "z") for k in (1, 2)],
                                  "PropertyId bigint, PropertyCounty string, Bedrooms int, Baths double, LotSize double, YearBuilt int, PropertyZip string")
    emails = spark.createDataFrame([(1, "a"), (2, "b")], "BidderId bigint, bidderemail string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = bidders.bidder_history(bids, valued, homes, emails, Params(as_of=date(2014, 2, 1)))
        rows = sorted((r.bidderemail, r.PropertyId, r.MaxBid, r.BPO) for r in out.collect())
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert rows == [("a", 1, 17.0, 50.0), ("a", 2, 17.0, 70.0), ("b", 1, 18.0, 50.0), ("b", 2, 18.0, 70.0)]
    assert not re.search(r"hashpartitioning\(BidderId#\d+L?, PropertyId", plan)  # dealt by listing, not by bidder and listing and then by listing again


def _no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    return lambda: spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_valuations_of_auctions_without_bids_are_not_moved(spark):
    key = "PropertyId bigint, AuctionId bigint, VenueId bigint"
    bids = spark.createDataFrame([(1, 1, 7, 1, 10.0, 1.0, 0, 5.0, 9.0, date(2014, 1, 1), date(2014, 1, 1))],
                                 f"BidderId bigint, {key}, BidAmount double, WinningBid double, IsWinningBid int, StartingBid double, AuctionSellerReserve double, "
                                 "AuctionDate date, BidEndDate date")
    valued = spark.createDataFrame([(1, 7, 1, 50.0), *[(1, a, 1, 60.0) for a in range(100, 2000)], (1, None, 1, 1.0)], f"{key}, BPO double")
    homes = spark.createDataFrame([(1, "c", 1, 1.0, 1.0, 1900, "z")],
                                  "PropertyId bigint, PropertyCounty string, Bedrooms int, Baths double, LotSize double, YearBuilt int, PropertyZip string")
    restore = _no_broadcast(spark)
    try:
        out = bidders.bidder_history(bids, valued, homes, spark.createDataFrame([(1, "a")], "BidderId bigint, bidderemail string"), Params(as_of=date(2014, 2, 1)))
        assert [(r.AuctionId, r.BPO) for r in out.collect()] == [(7, 50.0)]
        plan = out._jdf.queryExecution().optimizedPlan().toString()
    finally:
        restore()
    assert "_bits" in plan  # the table of bits stands between the valuations and their join


def test_marks_are_dealt_once_and_only_those_of_listings(spark):
    marks = spark.createDataFrame([(p, a, u) for p in range(6) for a in range(4) for u in (1, 2, 2, None)] + [(None, 1, 1), (1, None, 9)],
                                  "PropertyId bigint, AuctionId bigint, UserId bigint")
    listings = spark.createDataFrame([(1, 1), (1, 1), (4, 2), (None, 3)], "PropertyId bigint, AuctionId bigint")
    restore = _no_broadcast(spark)
    try:
        for keys in (("PropertyId",), ("PropertyId", "AuctionId")):
            want = history.favorites(history.only_for(marks, listings, keys), keys)
            got = history.favorites_for(marks, listings, keys, history.key_bits(listings, keys[-1]))
            assert got.columns == want.columns and sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
            assert not re.search(r"hashpartitioning\([^)]*UserId", got._jdf.queryExecution().executedPlan().toString())
    finally:
        restore()


def test_monthly_tables_are_read_for_the_months_that_are_asked(spark, folder):
    wh = roles.TestTables(spark, folder)
    rows = spark.createDataFrame([("1", date(2001, 5, 1), 200105)], "PropertyZip string, MarketMonth date, PostalMonth int")
    out = fx.join_market(rows, wh["market_metrics"], wh["postal_vacancy"], F.lit(date(2001, 4, 9)))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(month_first,2001-04-01)" in plan and "GreaterThanOrEqual(yyyymm,200104)" in plan


def test_passes_read_rows_that_are_scaled_already(spark, monkeypatch):
    rows = [(f"S{k % 2}", k, 1, 1, float(k % 7), float(k % 5), float(k % 3 == 0), float(k % 2 and k % 5 > 1)) for k in range(400)]
    df = spark.createDataFrame(rows, "PropertyState string, PropertyId long, AuctionId long, VenueId long, a double, b double, y double, w double")
    seen, real = [], models._newton_pass
    monkeypatch.setattr(models, "_newton_pass", lambda standard, *more: seen.append(standard) or real(standard, *more))
    both = {tuple(r[:3]): r[3] for r in models.ridge_logistic(df, ["a", "b"], ["y", "w"]).collect()}  # w has one class in S0
    assert seen and not any("Join" in s._jdf.queryExecution().optimizedPlan().toString() for s in seen)
    for label in ("y", "w"):
        for r in models.ridge_logistic(df, ["a", "b"], [label]).collect():
            assert both.pop(tuple(r[:3])) == pytest.approx(r[3], rel=1e-6, abs=1e-9)
    assert not both


def test_bids_joined_with_homes_are_not_moved_again(spark, folder, p):
    """Rows with all measures lie by property when they are grouped by e-mail and listing, and by e-mail and property."""
    wh = roles.TestTables(spark, folder)
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = bidders.bidder_history(wh["fact_bid_live"], wh["fact_residential"], wh["dim_property"], wh["dim_bidder"], p)
        plan = bidders.bidder_budget(rows)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    moved = re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan)
    assert any(m.startswith("PropertyId") for m in moved)
    assert [m for m in moved if "bidderemail" in m] == [m for m in moved if re.fullmatch(r"bidderemail#\d+", m)] != []
