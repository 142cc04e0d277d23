"""The warehouse tables this package reads, expressed over the supplied test tables.

One SELECT per table, valid in Spark and in DuckDB alike. Listings come from order lines, properties
from parts, places from suppliers and nations, bidders from customers, and web activity from events.
"""

from __future__ import annotations

import re

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from hammerline.session import settle

BASE = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "pages")


def _metric(stem: str, county: str, state: str, zip_value: str, scale: float) -> str:
    return f"""
      CASE WHEN (CAST(s_suppkey AS INTEGER) + mth) % 4 = 0 THEN NULL ELSE {zip_value} * {scale} END AS {stem},
      CASE WHEN n_nationkey % 5 = 0 THEN NULL ELSE (n_nationkey + 1) * {scale} END AS County{county},
      CASE WHEN r_regionkey = 3 THEN NULL ELSE (r_regionkey + 2) * {scale} END AS State{state},
      CAST(7 * {scale} AS DOUBLE) AS National{state}"""


ROLES: dict[str, str] = {
    "geo": """
      SELECT s.s_suppkey, s.s_name, s.s_acctbal, n.n_nationkey, n.n_name, r.r_regionkey, r.r_name
      FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "line": """
      SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber, l.l_extendedprice AS price,
             CAST(l.l_quantity AS INTEGER) AS qty, CAST(round(l.l_discount * 100) AS INTEGER) AS disc,
             CAST(round(l.l_tax * 100) AS INTEGER) AS tax, l.l_returnflag, l.l_linestatus,
             o.o_custkey, o.o_orderdate
      FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    "placed_part": """
      SELECT p.*, p_partkey % (SELECT count(*) FROM supplier) AS home_zip FROM part p""",
    "dim_property": """
      SELECT p.p_partkey AS PropertyId, p.p_partkey + 500000 AS GlobalPropertyId,
             'LN' || CAST(p.p_partkey AS VARCHAR(20)) AS LoanNbr,
             g.r_name AS PropertyState, CAST(g.s_suppkey AS VARCHAR(20)) AS PropertyZip, g.n_name AS PropertyCounty,
             p.p_brand || ', ' || g.n_name AS PropertyCity,
             CASE p.p_type WHEN 'ECONOMY' THEN 'SFR' WHEN 'LARGE' THEN 'Single Family' WHEN 'MEDIUM' THEN 'townhouse'
                           WHEN 'PROMO' THEN 'Condo' WHEN 'SMALL' THEN 'Duplex' ELSE 'Land' END AS PropertyType,
             CASE WHEN p.p_partkey % 8 = 4 THEN 'reo' WHEN p.p_partkey % 4 = 0 THEN 'REO' WHEN p.p_partkey % 4 = 1 THEN 'C2C'
                  WHEN p.p_partkey % 4 = 2 THEN 'Short Sale' ELSE 'Trustee' END AS ProductType,
             CASE p.p_size % 7 WHEN 0 THEN 'poor' WHEN 1 THEN 'Fair' WHEN 2 THEN 'average' WHEN 3 THEN 'good'
                               WHEN 4 THEN 'excellent' WHEN 5 THEN '' ELSE NULL END AS Condition,
             CASE p.p_partkey % 4 WHEN 0 THEN 'Occupied' WHEN 1 THEN 'Vacant' WHEN 2 THEN 'N/A' ELSE '' END AS PropertyOccupancyStatus,
             CASE WHEN p.p_size % 13 = 0 THEN NULL ELSE p.p_size * 41.0e0 END AS HomeSquareFootage,
             CASE WHEN p.p_size % 11 = 0 THEN NULL ELSE p.p_size % 6 - 1 END AS Bedrooms,
             CAST(p.p_size % 5 - 1 AS DOUBLE) AS Baths, 1800 + p.p_size * 4 AS YearBuilt,
             CASE WHEN p.p_size % 5 = 0 THEN NULL ELSE p.p_size * 0.25e0 END AS LotSize,
             CASE WHEN p.p_size % 9 = 0 THEN 5.0e0 WHEN p.p_size % 9 = 1 THEN NULL ELSE p.p_retailprice * 20 END AS SellerBPOValue
      FROM placed_part p LEFT JOIN geo g ON p.home_zip = g.s_suppkey""",
    "fact_auction": """
      SELECT l_partkey AS PropertyId, l_orderkey AS AuctionId, l_suppkey AS VenueId,
             l_linenumber % 5 AS AuctionStatusId, l_suppkey AS SellerId,
             o_orderdate AS AuctionDate, o_orderdate AS BidEndDT,
             CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END AS IsSold,
             CASE WHEN l_linenumber % 6 = 0 THEN NULL ELSE 1 END AS IsAuctioned,
             l_linenumber - 1 AS RunNum, 'RC' || CAST(l_orderkey AS VARCHAR(20)) AS REDCID,
             CASE WHEN l_linenumber % 3 = 0 THEN NULL WHEN qty % 17 = 0 THEN 0.0e0 ELSE price END AS AuctionSellerReserve,
             CASE WHEN qty % 10 = 0 THEN NULL ELSE price * 0.9e0 END AS Reserve,
             CASE WHEN qty % 20 = 0 THEN NULL WHEN qty % 7 = 0 THEN 0.0e0 ELSE price * 0.8e0 END AS LenderReserve,
             CASE WHEN qty % 20 = 0 THEN NULL ELSE price * 0.7e0 END AS UpdatedReserve,
             CASE WHEN qty % 11 = 0 THEN NULL ELSE price * 0.5e0 END AS StartingBid,
             CASE WHEN disc = 3 THEN NULL WHEN disc = 7 AND qty > 40 THEN price * 400 ELSE price * 1.3e0 END AS AprAsIs,
             CASE WHEN qty % 4 = 0 THEN NULL ELSE price * 1.5e0 END AS TotalOwed,
             CASE WHEN disc < 8 THEN NULL ELSE price * 1.25e0 END AS PropertyFeature6,
             price * 1.1e0 AS SellerBPOValue,
             CASE WHEN disc % 3 > 0 THEN NULL ELSE price * 1.15e0 END AS Agent90AsIs,
             CASE WHEN disc % 4 > 0 THEN NULL ELSE price * 1.05e0 END AS AgentValue,
             CASE WHEN disc < 9 THEN NULL ELSE price * 0.95e0 END AS GrcValue,
             CASE WHEN tax % 2 = 0 THEN 1 ELSE 0 END AS SubjToAccepted
      FROM line""",
    "fact_residential": """
      SELECT l_partkey AS PropertyId, l_orderkey AS AuctionId, l_suppkey AS VenueId,
             l_suppkey AS NewGeoId, l_suppkey AS SellerId, l_linenumber % 4 AS PreAuctionStatusId,
             CASE WHEN qty % 2 = 0 THEN NULL ELSE price * 1.02e0 END AS AuctionSellerReserve,
             CASE WHEN disc % 2 = 0 THEN NULL ELSE price * (1.5e0 - disc / 10.0e0) END AS BPO,
             CASE WHEN disc > 5 THEN NULL ELSE price * 1.4e0 END AS AprAsIs,
             CASE WHEN l_linenumber = 4 THEN NULL WHEN tax > 3 THEN 1 ELSE 0 END AS IsSubjectToApproval
      FROM line WHERE l_linenumber <> 5 OR qty % 2 = 0""",
    "fact_trustee_auction": """
      SELECT l_partkey AS PropertyId, l_orderkey AS AuctionId, l_suppkey AS VenueId,
             l_suppkey AS TrusteeId, l_suppkey AS GeoId, l_linenumber % 5 AS AuctionStatusId, o_orderdate AS AuctionDate,
             'TC' || CAST(l_orderkey AS VARCHAR(20)) AS REDCID,
             CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 1 ELSE 0 END AS IsSold,
             CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS IsAuction,
             CASE WHEN l_linestatus = 'O' AND l_returnflag = 'R' THEN 1 ELSE 0 END AS IsRemoved,
             CASE WHEN l_linestatus = 'O' AND l_returnflag = 'A' THEN 1 ELSE 0 END AS IsCancelled,
             CASE WHEN l_linestatus = 'O' AND l_returnflag = 'N' THEN 1 ELSE 0 END AS IsPostponed,
             CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE price END AS AuctionSellerReserve,
             CASE WHEN qty % 5 = 0 THEN NULL ELSE price * 0.9e0 END AS MaximumCreditBidAmnt,
             CASE WHEN qty % 10 = 0 THEN NULL ELSE price * 0.85e0 END AS BeneficiaryAmount,
             CASE WHEN qty % 20 = 0 THEN NULL ELSE price * 0.8e0 END AS TotalEstDebtorNOSAmount,
             CASE WHEN disc < 5 THEN 'Total Debt' ELSE 'Specified' END AS CreditBidType,
             CASE WHEN disc % 2 = 0 THEN NULL ELSE price * (1.4e0 - disc / 10.0e0) END AS BPO,
             CASE WHEN disc % 4 = 0 THEN NULL WHEN qty = 13 THEN 7.0e0 ELSE price * 1.1e0 END AS InitialAVMValue,
             CASE WHEN disc > 7 THEN NULL ELSE price * 1.2e0 END AS IVG,
             CASE WHEN l_linestatus = 'F' AND l_returnflag = 'A' THEN price * 1.01e0 ELSE NULL END AS WinningBid,
             CASE WHEN qty % 3 = 0 THEN NULL ELSE price * (0.8e0 + tax / 20.0e0) END AS HighBidAmt,
             CASE WHEN qty % 11 = 0 THEN NULL ELSE price * 0.55e0 END AS OpeningBid
      FROM line""",
    "dim_auction": """
      SELECT o_orderkey AS AuctionId, 'SA' || CAST(o_orderkey AS VARCHAR(20)) AS SystemAuctionId,
             CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_orderpriority END AS AuctionCode,
             CASE WHEN o_orderkey % 17 = 0 THEN 1 ELSE 0 END AS IsTest,
             CASE WHEN o_orderkey % 23 = 0 THEN 1 ELSE 0 END AS IsDemo
      FROM orders""",
    "dim_auction_status": """
      SELECT r_regionkey AS AuctionStatusId,
             CASE r_regionkey WHEN 0 THEN 'Active' WHEN 1 THEN 'Sold' WHEN 2 THEN 'Pending'
                              WHEN 3 THEN 'Asset removed by seller' ELSE 'CANCELLED' END AS AuctionStatus
      FROM region""",
    "dim_pre_auction_status": """
      SELECT r_regionkey AS PreAuctionStatusId,
             CASE r_regionkey WHEN 0 THEN '203K' WHEN 1 THEN 'Yes' WHEN 2 THEN 'No' ELSE NULL END AS FinancingAvailable
      FROM region WHERE r_regionkey < 4""",
    "dim_venue": """
      SELECT s_suppkey AS VenueId, CASE WHEN s_suppkey % 29 = 0 THEN NULL ELSE s_name END AS AuctionDate FROM supplier""",
    "dim_geo": """
      SELECT s_suppkey AS GeoId, n_name || ' metro' AS MSAName, n_name || ' area' AS MetroArea,
             n_nationkey * 1.5e0 AS Latitude, 0 - s_acctbal / 100 AS Longitude FROM geo""",
    "dim_seller": """
      SELECT s_suppkey AS SellerId, 'SC' || CAST(s_suppkey % 9 AS VARCHAR(20)) AS SellerCode, s_name || ', Inc' AS SellerName,
             CASE WHEN s_suppkey % 10 = 0 THEN 'Bank of America' ELSE s_name END AS SellerParent FROM supplier""",
    "dim_seller_group": """
      SELECT SellerCode, CASE SellerCode WHEN 'SC0' THEN 'Full Warranty' WHEN 'SC1' THEN 'Special Warranty'
                         WHEN 'SC2' THEN 'Quit Claim' ELSE 'Other' END AS DeedType
      FROM (SELECT DISTINCT 'SC' || CAST(s_suppkey % 9 AS VARCHAR(20)) AS SellerCode FROM supplier WHERE s_suppkey % 9 < 8) t""",
    "dim_trustee": """
      SELECT s_suppkey AS TrusteeId, 'T' || CAST(s_suppkey % 11 AS VARCHAR(20)) AS TrusteeCode, s_name AS TrusteeName FROM supplier""",
    "dim_bidder": """
      SELECT c_custkey AS BidderId, c_mktsegment || CAST(c_nationkey AS VARCHAR(20)) AS bidderemail FROM customer""",
    "seen_event": """
      SELECT user_id, event_type, value, ts, CAST({json_k} AS BIGINT) AS k, CAST(event_id % 13 AS INTEGER) AS lane FROM events""",
    "fact_bid_live": """
      SELECT l_partkey AS PropertyId, l_orderkey AS AuctionId, l_suppkey AS VenueId,
             CASE WHEN qty = 19 THEN -1 ELSE o_custkey END AS BidderId,
             price * (0.9e0 + tax / 50.0e0) AS BidAmount,
             CASE WHEN l_returnflag = 'R' THEN NULL ELSE price * 0.97e0 END AS WinningBid,
             price * 0.5e0 AS StartingBid, CASE WHEN qty % 6 = 0 THEN NULL ELSE price END AS AuctionSellerReserve,
             CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END AS IsWinningBid, CASE WHEN disc = 10 THEN 1 ELSE 0 END AS IsSellerAutoBid,
             o_orderdate AS BidStartDate, o_orderdate AS BidEndDate, o_orderdate AS AuctionDate
      FROM line
      UNION ALL
      SELECT l_partkey, l_orderkey, l_suppkey, (o_custkey * 7 + l_linenumber) % 140, price * (0.85e0 + disc / 40.0e0),
             CASE WHEN l_returnflag = 'R' THEN NULL ELSE price * 0.97e0 END, price * 0.5e0,
             CASE WHEN qty % 6 = 0 THEN 0.0e0 ELSE price END, 0, 0, o_orderdate, o_orderdate, o_orderdate
      FROM line WHERE l_linenumber % 2 = 1
      UNION ALL
      SELECT k, CAST(lane + 1 AS BIGINT), user_id % 5, user_id, value * 1000, NULL, value * 400, value * 900, 0, 0, ts, ts, ts
      FROM seen_event WHERE event_type IN ('purchase', 'view')""",
    "fact_property_registration": """
      SELECT CAST((o_custkey * 7 + l_linenumber) % 140 AS BIGINT) AS BidderId, l_partkey AS PropertyId, l_orderkey AS AuctionId,
             CASE WHEN qty = 23 THEN NULL ELSE l_suppkey END AS VenueId, o_orderdate AS CreateDate,
             CASE WHEN disc < 4 THEN 'Fully Approved' WHEN disc < 7 THEN 'Fully Approved, IDO'
                  WHEN disc < 9 THEN 'Needs Review - Approved w/o Validated Funds' ELSE 'Rejected' END AS ApprovalBucket
      FROM line
      UNION ALL
      SELECT user_id, k, CAST(lane + 1 AS BIGINT), user_id % 5, ts, 'Fully Approved' FROM seen_event WHERE event_type <> 'error'""",
    "fact_property_favorites": """
      SELECT l_partkey AS PropertyId, l_orderkey AS AuctionId, o_custkey AS UserId FROM line WHERE tax > 2
      UNION ALL
      SELECT l_partkey, l_orderkey, (o_custkey + l_suppkey) % 90 FROM line WHERE disc > 3
      UNION ALL
      SELECT k, CAST(lane AS BIGINT), user_id FROM seen_event WHERE event_type = 'click'""",
    "zip_month": """
      SELECT l_suppkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month_first,
             CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS yyyymm, CAST(month(o_orderdate) AS INTEGER) AS mth,
             avg(disc) AS d, count(*) AS n
      FROM line GROUP BY 1, 2, 3, 4""",
    "market_metrics": "SELECT CAST(s_suppkey AS VARCHAR(20)) AS PropertyZip, month_first AS Date,"
        + _metric("Appreciation", "Appreciation", "Appreciation", "d", 0.01) + ","
        + _metric("Turnover", "Turnover", "Turnover", "d", 0.002) + ","
        + _metric("TotalHomesForSale", "TotalHomesForSale", "TotalHomesForSale", "n", 25.0) + ","
        + _metric("PercentHomesSold_12moTrailing", "PercentHomesSold_12moTrailing", "PercentHomesSold_12moTrailing", "d", 0.003) + ","
        + _metric("MedianPPSQFT", "MedianPPSQFT", "MedianPPSQFT", "n", 12.0) + ","
        + _metric("ForeclosedHomesPer10000", "ForeclosedHomesPer10000", "ForeclosedHomesPer10000", "n", 0.7) + ","
        + _metric("PercentSoldHomesPrevForeclosures_12moTrailing", "PrevForeclosureSold", "PrevForeclosureSold", "d", 0.02)
        + " FROM zip_month JOIN geo ON l_suppkey = s_suppkey",
    "postal_vacancy": """
      SELECT CAST(s_suppkey AS VARCHAR(20)) AS ZIP, yyyymm AS Date,
             CASE WHEN s_suppkey % 6 = 0 THEN NULL ELSE s_suppkey * 100.0e0 + mth END AS Active,
             CASE WHEN s_suppkey % 6 = 0 THEN NULL ELSE (s_suppkey % 20) / 100.0e0 END AS Vacancy
      FROM zip_month JOIN geo ON l_suppkey = s_suppkey WHERE s_suppkey % 14 <> 1""",
}

WAREHOUSE = (
    "fact_auction", "fact_trustee_auction", "fact_residential", "fact_bid_live", "fact_property_registration",
    "fact_property_favorites", "dim_property", "dim_auction", "dim_auction_status", "dim_pre_auction_status",
    "dim_venue", "dim_geo", "dim_seller", "dim_seller_group", "dim_trustee", "dim_bidder", "market_metrics",
    "postal_vacancy",
)
# Helper tables that several warehouse tables are made of, and warehouse tables that are expressions over rows of one of them, the monthly
# ones with facts of their place.
HELD = ("line", "seen_event", "zip_month")
VIEWS = (
    "fact_auction", "fact_trustee_auction", "fact_residential", "fact_bid_live", "fact_property_registration", "fact_property_favorites",
    "market_metrics", "postal_vacancy",
)
JSON_K = {"spark": "get_json_object(props, '$.k')", "duckdb": "json_extract_string(props, '$.k')"}


def role_sql(name: str, engine: str) -> str:
    return ROLES[name].replace("{json_k}", JSON_K[engine])


def mentions(sql: str, names) -> list[str]:
    words = set(re.findall(r"[A-Za-z_][A-Za-z_0-9]*", sql))
    return [n for n in names if n in words]


_KEPT: dict[tuple[str, str, str], DataFrame] = {}


def forget(sf_dir: str, keep: tuple[str, ...]) -> None:
    """Drop kept intermediates of a test folder so that the next query computes its own; the tables behind the warehouse stay."""
    for key in [k for k in _KEPT if k[1] == sf_dir and k[2] not in (*keep, *HELD)]:
        del _KEPT[key]


class TestTables(dict):
    """Warehouse frames over one test folder.

    The joined order lines, the read events and the monthly counts are written once per session, narrow, and so are the dimensions of the
    warehouse. Its fact tables are views on them, row by row: nothing is joined again for each fact, and no row is written six times in
    wide copies. The monthly tables are views on the monthly counts, so that a query that asks for some months reads those alone.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self.spark, self.sf_dir = spark, sf_dir

    def once(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        key = (self.spark.sparkContext.applicationId, self.sf_dir, name)
        if key not in _KEPT:
            _KEPT[key] = settle(build(), keep=True)  # outlives the workspace of a job that asks for it first
        return _KEPT[key]

    def __missing__(self, name: str) -> DataFrame:
        if name in BASE:
            df = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        elif name in HELD or name in WAREHOUSE and name not in VIEWS:
            df = self.once(name, lambda: self._select(name))
        else:
            df = self._select(name)
        self[name] = df
        return df

    def _select(self, name: str) -> DataFrame:
        sql = role_sql(name, "spark")
        used = [o for o in mentions(sql, [*BASE, *ROLES]) if o != name]
        for other in used:
            sql = re.sub(rf"\b(FROM|JOIN)\s+{other}\b", rf"\1 {{{other}}}", sql)
        return self.spark.sql(sql, **{o: self[o] for o in used if f"{{{o}}}" in sql})
