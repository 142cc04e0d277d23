"""Non-trustee listings: the feature row, its scores, its two faults and what gets published."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hammerline.functions.columns import flag, months_back, ratio
from hammerline.operators import bidders, explain, features as fx, history, publish, scoring
from hammerline.params import LISTING_KEY, Params
from hammerline.session import by_merge, settle, settle_all

Warehouse = Mapping[str, DataFrame]


def feature_row(wh: Warehouse, p: Params, scoring: bool = False) -> DataFrame:
    """One wide row per listing.

    ``scoring=False`` is the training extract (whole window); ``scoring=True`` keeps upcoming
    listings only, dates them by the end of bidding, and computes terciles and event sizes among them.

    What a listing gets from other tables is gathered beside its keys, in narrow rows that are shuffled for every lookup. The wide
    rows are numbered when they are written and meet the gathered columns once, by that number. Auctions and histories lose what no
    listing of the window asks for before any of their rows is moved.
    """
    date_col = "BidEndDT" if scoring else "AuctionDate"
    window = history.key_bits(wh["fact_auction"].filter(F.col(date_col) >= months_back(p.as_of, p.window_months)), "AuctionId")
    recent = history.recent_listings(wh["fact_auction"], history.possibly_in(wh["dim_auction"], window, "AuctionId"), p, date_col)
    live = history.live_status(recent, wh["dim_auction_status"])
    ended = history.past(live, p, date_col) if scoring else live
    chosen = history.upcoming(live, p, date_col) if scoring else _with_open_venue(live, wh)

    lines = wh["dim_property"] if scoring else None
    asked = history.key_bits(wh["fact_auction"].filter(F.col(date_col) >= F.lit(p.as_of)), "AuctionId") if scoring else window
    residential = history.possibly_in(wh["fact_residential"], asked, "AuctionId")
    core, zips, sellers = settle_all(
        _core(chosen, residential, wh, p, date_col, null_is_unknown=scoring).withColumn("_row", F.monotonically_increasing_id()),
        history.zip_sell_through(ended, wh["dim_property"], p, product_lines=scoring),
        history.seller_portfolio(ended, wh["dim_seller"], p, lines),
    )
    keys = core.select("_row", *LISTING_KEY, "PropertyState", "PropertyZip", "SellerCode", "AuctionCode", "Reserve", "MarketMonth", "PostalMonth")
    leveled = fx.event_sizes(fx.value_levels(keys))
    favorite_key = ("PropertyId", "AuctionId") if scoring else ("PropertyId",)

    key = list(LISTING_KEY)
    live_bids = history.only_for(history.possibly_in(wh["fact_bid_live"], asked, "AuctionId"), core, key)
    marked = asked if scoring else history.key_bits(core, "PropertyId")
    bids = (history.high_bids_for_scoring if scoring else history.high_bids_for_training)(live_bids, p)
    sides = (
        leveled.join(bids.select(*key, "HighBid"), key, "left")
        .join(registrant_scores(wh, p, scoring, core, recent, asked), key, "left")
        .join(history.favorites_for(wh["fact_property_favorites"], core, favorite_key, marked)
              .withColumnRenamed("Favorites", "_marks"), list(favorite_key), "left")
    )
    sides = fx.join_market(sides, wh["market_metrics"], wh["postal_vacancy"], months_back(p.as_of, p.window_months))
    sides = (
        sides.join(zips.select("PropertyState", "PropertyZip", F.col("AvgSTR").alias("_zip_rate")),
                    ["PropertyState", "PropertyZip"], "left")
        .join(sellers.select("SellerCode", F.col("AvgSTR").alias("_seller_rate")), "SellerCode", "left")
    )
    joined = core.join(by_merge(settle(sides.drop(*[c for c in keys.columns if c != "_row"]))), "_row")
    met = flag(F.col("HighBid") >= F.col("Reserve"))
    runs = F.when(F.col("RunNum") < 1, 1).otherwise(F.col("RunNum"))
    marks = F.coalesce("_marks", F.lit(0))
    big_enough = F.when(F.col("HomeSquareFootage") > 10, F.col("HomeSquareFootage"))
    return joined.withColumns({
        "AuctionReserveSuccess": met,
        "TrueSold": fx.truly_sold(met, F.col("IsSold"), F.col("IsSubjectToApproval"), F.col("SubjToAccepted")),
        "Favorites": marks if scoring else F.floor(marks / runs),
        "MedianPPSQFTDeviation": fx.ppsf_deviation(F.col("MedianPPSQFT"), F.col("Reserve"), big_enough),
        "Historical_Execution": F.coalesce("_zip_rate", F.lit(0.0)),
        "SellerPortfolioQuality": F.coalesce("_seller_rate", F.lit(0.0)),
        "ALRRegistrants": F.coalesce("ALRRegistrants", F.lit(0)),
        "TotalRegistrantScore": F.coalesce("TotalRegistrantScore", F.lit(0.0)),
        "IntrinsicBidderQuality": F.coalesce("IntrinsicBidderQuality", F.lit(0.0)),
    }).drop("_row", "_zip_rate", "_seller_rate", "_marks", "SubjToAccepted", "MarketMonth", "PostalMonth")


def registrant_scores(wh: Warehouse, p: Params, scoring: bool, core: DataFrame, recent: DataFrame, asked: DataFrame) -> DataFrame:
    """Registrant quality of the listings in ``core``; ``recent`` holds their reserves, ``asked`` the bits of their auctions.

    A bidder's history and attendance look at everything, but only registrations for the wanted
    listings are scored.
    """
    hist = bidders.bidder_history(wh["fact_bid_live"], wh["fact_residential"], wh["dim_property"],
                                  wh["dim_bidder"], p, by_date=not scoring)
    registrations = wh["fact_property_registration"]
    attendance = bidders.bidder_attendance(registrations, wh["fact_bid_live"], wh["dim_bidder"], p, training=not scoring)
    wanted = history.only_for(history.possibly_in(registrations, asked, "AuctionId"), core, LISTING_KEY)
    matches = bidders.registrant_matches(
        wanted, wh["dim_bidder"], wh["dim_property"], recent, bidders.bidder_budget(hist), attendance,
        positive_reserves=scoring)
    return bidders.registrant_score(matches)


def _with_open_venue(df: DataFrame, wh: Warehouse) -> DataFrame:
    return df.join(wh["dim_venue"].filter(F.col("AuctionDate").isNotNull()).select("VenueId"), "VenueId")


def _core(listings: DataFrame, residential: DataFrame, wh: Warehouse, p: Params, date_col: str, null_is_unknown: bool) -> DataFrame:
    """Listing, property, residential fact and the small dimensions: everything that is row-local."""
    fr = residential.alias("fr")
    fa, dp = listings.alias("fa"), by_merge(wh["dim_property"]).alias("dp")
    listing_keys = [F.col(f"fa.{k}") == F.col(f"fr.{k}") for k in LISTING_KEY]
    seller = wh["dim_seller"].select("SellerId", "SellerCode", "SellerName", "SellerParent").alias("ds")
    joined = (
        fa.join(fr, listing_keys, "left")
        .join(dp, F.col("fa.PropertyId") == F.col("dp.PropertyId"), "left")
        .join(wh["dim_pre_auction_status"].alias("pas"),
              F.col("pas.PreAuctionStatusId") == F.col("fr.PreAuctionStatusId"), "left")
        .join(wh["dim_geo"].alias("dg"), F.col("dg.GeoId") == F.col("fr.NewGeoId"), "left")
        .join(seller, F.col("ds.SellerId") == F.col("fr.SellerId"), "left")
        .join(wh["dim_seller_group"].alias("sg"), F.col("ds.SellerCode") == F.col("sg.SellerCode"), "left")
    )
    joined = joined.withColumns({
        "_reserve": fx.reserve(), "_positive": fx.positive_reserve(), "_bpo": fx.valuation(p, parent="ds.SellerParent"),
    })
    bpo, positive = F.col("_bpo"), F.col("_positive")
    return joined.select(
        "dp.GlobalPropertyId", "fa.SystemAuctionId", *[f"fa.{k}" for k in LISTING_KEY], "fa.REDCID",
        "dp.LoanNbr", "dp.PropertyState", "dp.PropertyZip", "dp.PropertyCounty", "dp.PropertyCity",
        "dg.MSAName", "fa.AuctionCode", "ds.SellerCode", "ds.SellerName", "dg.Latitude", "dg.Longitude",
        F.col(f"fa.{date_col}").alias(date_col), "fa.MarketMonth", "fa.PostalMonth",
        "dp.PropertyOccupancyStatus",
        fx.condition_text(F.col("dp.Condition"), null_is_unknown).alias("Condition"),
        "dp.PropertyType", "dp.ProductType",
        *[c.alias(n) for n, c in fx.property_flags("dp.").items()],
        fx.financing_flag(F.col("pas.FinancingAvailable")).alias("FinancingAvailable"),
        *[c.alias(n) for n, c in fx.deed_flags(F.col("sg.DeedType")).items()],
        "fa.IsSold", "fa.RunNum", fx.attempts_sign(F.col("fa.RunNum")).alias("HasPrevAttempts"),
        F.col("_reserve").alias("Reserve"), bpo.alias("BPO"), (bpo - positive).alias("BPOSurplus"),
        (ratio(bpo, positive) - 1).alias("BPOSurplusPct"),
        "dp.HomeSquareFootage", "dp.Bedrooms", "dp.Baths",
        (F.lit(p.reference_year) - F.col("dp.YearBuilt")).alias("Age"), "dp.LotSize",
        "fa.StartingBid", "fr.IsSubjectToApproval", "fa.SubjToAccepted",
    )


def predictions(rows: DataFrame, coefficients: Mapping[str, DataFrame], weights: DataFrame, p: Params) -> DataFrame:
    """Score, order, floor and explain upcoming listings in the published layout."""
    scored = scoring.order_probabilities(scoring.score_nontrustee(rows, coefficients, p))
    explained = explain.top_two_faults(scored, weights, explain.VARIABLES, p)
    floored = scoring.floor_price(explained, "RecommendedMaxReservePrice", "StartingBid")
    return floored.withColumns({
        "AuctionDaySale": F.col("IsSold"), "SellerAcceptedSale": F.col("TrueSold"),
        "ReserveExceeded": F.col("AuctionReserveSuccess"), "ModelRunDate": F.lit(p.as_of),
    }).select(*publish.NONTRUSTEE_OUTPUT)
