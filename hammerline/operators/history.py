"""Listing windows and the history aggregates that describe zips, sellers, listings and properties."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hammerline.functions.columns import like_any, months_back
from hammerline.params import LISTING_KEY, Params
from hammerline.session import by_merge, settle

BITS = 2**26  # of a key filter: 8 MB
_BLOCK = 2**15  # bits of one row of it, as bitmap_construct_agg makes them
PRODUCT_LINES = ("%REO%", "%C2C%", "Short Sale")  # the last one carries no wildcard: an equality


def with_month_keys(df: DataFrame, date_col: str) -> DataFrame:
    """Month first as a date and month as yyyymm, the join keys of the two monthly market tables."""
    day = F.col(date_col)
    return df.withColumns({
        "MarketMonth": F.trunc(day, "MM"),
        "PostalMonth": F.year(day) * 100 + F.month(day),
    })


def recent_listings(fact: DataFrame, dim_auction: DataFrame, p: Params, date_col: str = "AuctionDate") -> DataFrame:
    """Listings of the rolling window in real (not test, not demo) auctions, with their event columns."""
    recent = fact.filter(F.col(date_col) >= months_back(p.as_of, p.window_months))
    events = (
        dim_auction.filter((F.col("IsTest") == 0) & (F.col("IsDemo") == 0))
        .select("AuctionId", "SystemAuctionId", "AuctionCode")
    )
    return with_month_keys(recent.join(by_merge(events), "AuctionId"), date_col)


def upcoming(df: DataFrame, p: Params, date_col: str = "AuctionDate") -> DataFrame:
    return df.filter(F.col(date_col) >= F.lit(p.as_of))


def past(df: DataFrame, p: Params, date_col: str = "AuctionDate") -> DataFrame:
    return df.filter(F.col(date_col) <= F.lit(p.as_of))


def live_status(df: DataFrame, dim_status: DataFrame) -> DataFrame:
    """Drop listings whose status mentions a removal or cancellation, or is unknown."""
    text = F.lower("AuctionStatus")
    kept = dim_status.filter(~text.contains("removed") & ~text.contains("cancelled")).select("AuctionStatusId")
    return df.join(kept, "AuctionStatusId")


def _rate(df: DataFrame, keys: list[str], counted: str, floor: int) -> DataFrame:
    return (
        df.groupBy(*keys)
        .agg(F.avg(F.col("IsSold").cast("double")).alias("AvgSTR"), F.count(counted).alias("TotalAuctioned"))
        .filter(F.col("TotalAuctioned") >= floor)
    )


def zip_sell_through(listings: DataFrame, dim_property: DataFrame, p: Params, product_lines: bool = False) -> DataFrame:
    """Share of listings sold per (state, zip) where enough were auctioned."""
    place = _in_lines(dim_property, product_lines).select("PropertyId", "PropertyState", "PropertyZip")
    return _rate(
        listings.join(by_merge(place), "PropertyId", "inner" if product_lines else "left"),
        ["PropertyState", "PropertyZip"], "IsAuctioned", p.min_listings,
    )


def seller_portfolio(
    listings: DataFrame, dim_seller: DataFrame, p: Params, dim_property: DataFrame | None = None
) -> DataFrame:
    """Share of listings sold per seller code; restricted to the product lines when properties are given."""
    if dim_property is not None:
        listings = listings.join(by_merge(_in_lines(dim_property, True).select("PropertyId")), "PropertyId")
    codes = dim_seller.select("SellerId", "SellerCode")
    return _rate(listings.join(codes, "SellerId", "left"), ["SellerCode"], "IsAuctioned", p.min_listings)


def _in_lines(dim_property: DataFrame, restrict: bool) -> DataFrame:
    return dim_property.filter(like_any(F.col("ProductType"), PRODUCT_LINES)) if restrict else dim_property


def trustee_zip_sell_through(listings: DataFrame, dim_property: DataFrame, p: Params) -> DataFrame:
    place = dim_property.select("PropertyId", "PropertyState", "PropertyZip")
    return _rate(
        listings.filter(F.col("IsAuction") == 1).join(by_merge(place), "PropertyId", "left"),
        ["PropertyState", "PropertyZip"], "IsAuction", p.min_trustee_listings,
    )


def trustee_portfolio(listings: DataFrame, dim_trustee: DataFrame, p: Params) -> DataFrame:
    codes = dim_trustee.select("TrusteeId", "TrusteeCode")
    return _rate(
        listings.filter(F.col("IsAuction") == 1).join(codes, "TrusteeId", "left"),
        ["TrusteeCode"], "IsAuction", p.min_trustee_listings,
    )


def _high_bids(bids: DataFrame, keep: Column) -> DataFrame:
    return (
        bids.filter(keep)
        .groupBy("PropertyId", "VenueId", "AuctionId")
        .agg(
            F.max("BidAmount").alias("HighBid"),
            F.max("WinningBid").alias("WinningBid"),
            F.count_distinct("BidderId").alias("Bidders"),
            F.count_distinct("BidAmount").alias("Bids"),
        )
    )


def high_bids_for_training(bids: DataFrame, p: Params) -> DataFrame:
    """Bids of identified bidders that opened inside the listing window."""
    opened = F.col("BidStartDate") >= months_back(p.as_of, p.window_months)
    return _high_bids(bids, opened & (F.col("BidderId") != -1))


def high_bids_for_scoring(bids: DataFrame, p: Params) -> DataFrame:
    """Human bids (no seller auto-bids) in auctions of the shorter bid window."""
    recent = F.col("AuctionDate") >= months_back(p.as_of, p.bid_months)
    return _high_bids(bids, recent & (F.col("IsSellerAutoBid") == 0))


def favorites(marks: DataFrame, keys: tuple[str, ...] = ("PropertyId",)) -> DataFrame:
    """Distinct users who marked each property, or each (property, auction)."""
    return marks.groupBy(*keys).agg(F.count_distinct("UserId").alias("Favorites"))


def favorites_for(marks: DataFrame, listings: DataFrame, keys: tuple[str, ...], bits: DataFrame) -> DataFrame:
    """``favorites`` of the listings alone; ``bits`` are those of the last key.

    Marks that no listing asks for are dropped where they are read. The rest is dealt by key, in as many parts as the session shuffles to:
    the join with the listings, the dropping of repeated marks and the count all take place where the marks lie.
    """
    parts = int(marks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = possibly_in(marks.select(*keys, "UserId"), bits, keys[-1]).repartition(parts, *keys)
    return favorites(only_for(dealt, listings, keys), keys)


def brought_to_sale(fact_trustee: DataFrame) -> DataFrame:
    """Outcome counts over a property's whole trustee history, without a date bound."""
    outcomes = {"IsRemoved": "Removals", "IsCancelled": "Cancellations", "IsPostponed": "Postponements"}
    sums = [F.sum(c).cast("long").alias(name) for c, name in outcomes.items()]
    held = F.sum("IsAuction").cast("long")
    tally = fact_trustee.groupBy("PropertyId").agg(held.alias("_held"), *sums)
    total = F.col("_held") + F.col("Removals") + F.col("Cancellations") + F.col("Postponements")
    return tally.select("PropertyId", total.alias("RunNum"), *outcomes.values())


def only_for(df: DataFrame, listings: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of a history that belong to one of the listings, so the rest is dropped before grouping."""
    return df.join(by_merge(listings.select(*keys)), list(keys), "left_semi")


def possibly_for(df: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose numeric ``key`` may be one of ``wanted``: all that are, and few others, without moving any row of ``df``.

    A table of ``BITS`` bits, one for the hash of each wanted key, goes to the tasks that read ``df``. For a large history before its join
    with some of the listings; the join itself decides. More keys than bits let more rows pass, never fewer.
    """
    return possibly_in(df, key_bits(wanted, key), key)


def _place(key: str) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("long")), F.lit(BITS))


def key_bits(wanted: DataFrame, key: str) -> DataFrame:
    """The table of bits of ``possibly_for``, written once for every history that it is to be held against."""
    return settle(wanted.select(_place(key).alias("_place")).groupBy(F.floor(F.col("_place") / _BLOCK).alias("_block")).agg(
        F.bitmap_construct_agg(F.col("_place") % _BLOCK).alias("_bits")))


def possibly_in(df: DataFrame, bits: DataFrame, key: str) -> DataFrame:
    """``possibly_for`` with bits that are there already."""
    at = F.col("_place") % _BLOCK
    byte = F.ascii(F.decode(F.substr("_bits", (F.floor(at / 8) + 1).cast("int"), F.lit(1)), "ISO-8859-1"))
    hit = byte.bitwiseAND(F.pow(F.lit(2), at % 8).cast("int")) != 0
    placed = df.withColumn("_place", _place(key)).withColumn("_block", F.floor(F.col("_place") / _BLOCK))
    return placed.join(F.broadcast(bits), "_block").filter(hit).select(*df.columns)  # at most BITS / _BLOCK rows of 4 KB


def unique_listing(df: DataFrame) -> DataFrame:
    """Rows of listing keys that occur more than once: empty when the feature row is sound."""
    return df.groupBy(*LISTING_KEY).agg(F.count(F.lit(1)).alias("Rows")).filter("Rows > 1")
