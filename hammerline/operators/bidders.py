"""From live bids to registrant quality: history, budget, attendance and a score per listing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hammerline.functions.columns import first_positive, ratio
from hammerline.functions.exact import exact_avg, exact_sum
from hammerline.operators.history import possibly_for
from hammerline.params import Params
from hammerline.session import by_merge

# Approval buckets that count as an approved registrant.
APPROVED = (
    "Fully Approved",
    "Fully Approved, IDO",
    "Needs Review - Approved w/o Validated Funds",
)
_LISTING = ["PropertyId", "AuctionId", "VenueId"]
_BID_PEAKS = {
    "MaxBid": "BidAmount", "WinningBid": "WinningBid", "Winner": "IsWinningBid",
    "StartingBid": "StartingBid", "Reserve": "AuctionSellerReserve",
}
_HOME = {"beds": "Bedrooms", "baths": "Baths", "lotsize": "LotSize", "yearbuilt": "YearBuilt", "ZIP": "PropertyZip"}


def _real_ids(df: DataFrame) -> DataFrame:
    return df.filter((F.col("BidderId") > 0) & (F.col("PropertyId") > 0) & (F.col("AuctionId") > 0))


def bidder_history(
    bids: DataFrame, residential: DataFrame, dim_property: DataFrame, dim_bidder: DataFrame,
    p: Params, by_date: bool = False,
) -> DataFrame:
    """Peaks of every measure per bidder e-mail and listing.

    Bids collapse to one row per bidder and listing before any join, so a listing with very many
    bids reaches the joins as its distinct bidders. They are dealt by listing first: the grouping and the join with valuations
    then take place where the bids lie. Valuations of auctions without such bids are not moved at all. Homes are joined last, by property:
    the rows lie as the grouping here and that of ``bidder_budget`` by e-mail and property need them, and are not moved for either.
    """
    dated = ["AuctionDate"] if by_date else []
    start_col = "BidEndDate" if by_date else "AuctionDate"
    real = _real_ids(bids.filter(F.col(start_col) >= F.lit(p.programme_start)))
    per_bidder = (
        real.select("BidderId", *_LISTING, *dated, *_BID_PEAKS.values())
        .repartition(*_LISTING)
        .groupBy("BidderId", *_LISTING, *dated)
        .agg(*[F.max(source).alias(name) for name, source in _BID_PEAKS.items()])
    )
    valued = possibly_for(residential.select(*_LISTING, "BPO"), real, "AuctionId")
    homes = dim_property.select(
        "PropertyId", "PropertyCounty", *[F.col(c).alias(name) for name, c in _HOME.items()]
    )
    measures = [*_BID_PEAKS, *[n for n in _HOME if n != "ZIP"], "BPO", "ZIP"]
    return (
        per_bidder.join(by_merge(valued), _LISTING)
        .join(by_merge(dim_bidder.select("BidderId", "bidderemail")), "BidderId")
        .join(by_merge(homes), "PropertyId")
        .groupBy("bidderemail", *_LISTING, "PropertyCounty", *dated)
        .agg(*[F.max(m).alias(m) for m in measures])
    )


def bidder_budget(history: DataFrame) -> DataFrame:
    """What each e-mail bids on and how much of the reserve it offers; means are the same for every order of rows."""
    reserve = F.when(F.col("Reserve") < 1, F.coalesce("MaxBid", "StartingBid")).otherwise(F.col("Reserve"))

    def over(name: str, condition) -> Column:
        return exact_avg(F.when(condition, F.col(name)))

    return history.groupBy("bidderemail").agg(
        F.count_distinct("PropertyId").alias("AssetsBidUpon"),
        exact_avg(F.col("MaxBid")).alias("AvgMaxBid"),
        exact_avg(F.col("Winner")).alias("AvgWinRate"),
        exact_avg(F.when(F.col("MaxBid") > F.col("WinningBid"), 1.0).otherwise(0.0)).alias("FallOutRate"),
        exact_avg(ratio(F.col("MaxBid"), reserve)).alias("AvgMaxBidAsShareOfReserve"),
        exact_avg(F.col("StartingBid")).alias("AvgStartingBid"),
        exact_avg(F.col("Reserve")).alias("AvgReserve"),
        over("beds", F.col("beds") >= 0).alias("avgBeds"),
        over("baths", F.col("baths") >= 0).alias("avgBaths"),
        over("lotsize", F.col("lotsize") >= 0).alias("avgLotSize"),
        over("yearbuilt", F.col("yearbuilt") > 1500).alias("AvgYearBuilt"),
        exact_avg(F.col("BPO")).alias("AvgBPO"),
    )


def bidder_attendance(registrations: DataFrame, bids: DataFrame, dim_bidder: DataFrame, p: Params,
                      training: bool = False) -> DataFrame:
    """Distinct properties bid on over distinct properties registered for, per e-mail."""
    start = p.training_registration_start if training else p.registration_start
    emails = dim_bidder.select("BidderId", "bidderemail")

    def distinct_properties(df: DataFrame, out: str) -> DataFrame:
        return df.join(by_merge(emails), "BidderId").groupBy("bidderemail").agg(F.count_distinct("PropertyId").alias(out))

    registered = distinct_properties(
        registrations.filter(F.col("CreateDate") >= F.lit(start)).select("BidderId", "PropertyId"),
        "totalregistrations",
    )
    # bids repeat per bidder and property far more often than registrations do
    bid_on = _real_ids(bids.filter(F.col("AuctionDate") >= F.lit(p.programme_start)))
    attended = distinct_properties(bid_on.select("BidderId", "PropertyId").distinct(), "totalattended")
    return registered.join(attended, "bidderemail").select(
        "bidderemail", "totalattended", "totalregistrations",
        ratio(F.col("totalattended").cast("double"), F.col("totalregistrations")).alias("attendance"),
    )


def registrant_matches(
    registrations: DataFrame, dim_bidder: DataFrame, dim_property: DataFrame, fact_auction: DataFrame,
    budget: DataFrame, attendance: DataFrame, positive_reserves: bool = True,
) -> DataFrame:
    """One row per registered bidder and listing with match ratios and both scores.

    Repeated registrations are folded into ``Registrations`` first; sums weigh each row by it.
    """
    folded = (
        registrations.filter(F.col("VenueId").isNotNull() & F.col("ApprovalBucket").isin(*APPROVED))
        .groupBy("BidderId", *_LISTING)
        .agg(F.count(F.lit(1)).alias("Registrations"))
    )
    profile = budget.join(attendance, "bidderemail")
    sources = ["AuctionSellerReserve", "Reserve", "LenderReserve", "UpdatedReserve"]
    offers = fact_auction.select(*_LISTING, *[F.col(c).alias(f"_{c}") for c in sources])
    homes = dim_property.select("PropertyId", "Bedrooms", "Baths", "LotSize", "YearBuilt")
    joined = (
        folded.join(by_merge(dim_bidder.select("BidderId", "bidderemail")), "BidderId")
        .join(profile, "bidderemail")
        .join(by_merge(homes), "PropertyId")
        .join(by_merge(offers), _LISTING, "left")
    )
    chain = [F.col(f"_{c}") for c in sources] + [F.col("AvgReserve")]
    raw = F.coalesce(*chain, F.lit(1.0))
    base = F.coalesce(first_positive(chain), F.lit(1.0)) if positive_reserves else raw
    natural = F.col("attendance") * F.col("AvgMaxBidAsShareOfReserve")

    def match(mine: str, usual: str, usual_floor) -> Column:
        own = F.when(F.col(mine) <= 0, F.col(usual)).otherwise(F.col(mine))
        fallback = F.when(F.col(mine) <= 0, 1).otherwise(F.col(mine))
        return ratio(own.cast("double"), F.when(usual_floor, fallback).otherwise(F.col(usual)))

    return joined.select(
        *_LISTING, "bidderemail", "Registrations",
        raw.alias("Reserve"),
        ratio(F.col("AvgReserve"), base).alias("ReserveMatch"),
        match("Bedrooms", "avgBeds", F.col("avgBeds") <= 0).alias("Bedmatch"),
        match("Baths", "avgBaths", F.col("avgBaths") < 1).alias("Bathmatch"),
        match("LotSize", "avgLotSize", F.col("avgLotSize") <= 0).alias("Lotmatch"),
        natural.alias("NaturalScore"),
        (natural * F.abs(ratio(F.coalesce("AvgReserve", F.lit(1.0)), base + 1))).alias("BidderScore"),
    )


def registrant_score(matches: DataFrame) -> DataFrame:
    """Registrants of each listing, their intrinsic quality and their reserve-adjusted quality."""
    times = F.col("Registrations")
    return matches.groupBy("PropertyId", "VenueId", "AuctionId").agg(
        F.count_distinct("bidderemail").alias("ALRRegistrants"),
        exact_sum(F.col("NaturalScore") * times).alias("IntrinsicBidderQuality"),
        exact_sum(F.col("BidderScore") * times).alias("TotalRegistrantScore"),
    )
