"""Trustee listings: the feature row built from the trustee fact."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hammerline.functions.columns import flag, months_back, ratio
from hammerline.operators import explain, features as fx, history, publish, scoring
from hammerline.params import LISTING_KEY, Params
from hammerline.plans.nontrustee import Warehouse
from hammerline.session import by_merge, settle, settle_all


def feature_row(wh: Warehouse, p: Params, scoring: bool = False) -> DataFrame:
    """One wide row per trustee listing; as in the other line, lookups shuffle narrow rows and the wide ones meet them once."""
    window = history.key_bits(wh["fact_trustee_auction"].filter(F.col("AuctionDate") >= months_back(p.as_of, p.window_months)), "AuctionId")
    recent = history.recent_listings(wh["fact_trustee_auction"], history.possibly_in(wh["dim_auction"], window, "AuctionId"), p)
    held = history.past(recent, p) if scoring else recent
    chosen = history.upcoming(recent, p) if scoring else recent

    core, zips, trustees = settle_all(
        _core(chosen, wh, p).withColumn("_row", F.monotonically_increasing_id()),
        history.trustee_zip_sell_through(held, wh["dim_property"], p),
        history.trustee_portfolio(held, wh["dim_trustee"], p),
    )
    keys = core.select("_row", *LISTING_KEY, "PropertyState", "PropertyZip", "TrusteeCode", "AuctionCode", "Reserve", "MarketMonth", "PostalMonth", "HomeSquareFootage")
    sized = fx.with_state_mean(keys, "HomeSquareFootage", "_state_sqft")
    leveled = fx.event_sizes(fx.value_levels(sized))

    favorite_key = ("PropertyId", "AuctionId") if scoring else ("PropertyId",)
    homes = history.key_bits(core, "PropertyId")
    past_runs = history.only_for(history.possibly_in(wh["fact_trustee_auction"], homes, "PropertyId"), core, ["PropertyId"])
    sides = (
        leveled.join(history.brought_to_sale(past_runs), "PropertyId", "left")
        .join(history.favorites_for(wh["fact_property_favorites"], core, favorite_key, window if scoring else homes)
              .withColumnRenamed("Favorites", "_marks"), list(favorite_key), "left")
    )
    sides = fx.join_market(sides, wh["market_metrics"], wh["postal_vacancy"], months_back(p.as_of, p.window_months))
    sides = (
        sides.join(zips.select("PropertyState", "PropertyZip", F.col("AvgSTR").alias("_zip_rate")),
                    ["PropertyState", "PropertyZip"], "left")
        .join(trustees.select("TrusteeCode", F.col("AvgSTR").alias("_trustee_rate")), "TrusteeCode", "left")
    )
    joined = core.join(by_merge(settle(sides.drop(*[c for c in keys.columns if c != "_row"]))), "_row")
    runs = F.when(F.coalesce("RunNum", F.lit(0)) == 0, 1).otherwise(F.col("RunNum"))
    marks = F.coalesce("_marks", F.lit(0))
    feet = F.when(F.col("HomeSquareFootage") < 10, F.col("_state_sqft")).otherwise(F.col("HomeSquareFootage"))
    tried = F.col("RunNum") + F.col("Cancellations") + F.col("Postponements")
    return joined.withColumns({
        "HasPrevAttempts": fx.attempts_sign(tried),
        "Favorites": marks if scoring else F.floor(marks / runs),
        "MedianPPSQFTDeviation": fx.ppsf_deviation(F.col("MedianPPSQFT"), F.col("Reserve"), feet),
        "Historical_Execution": F.coalesce("_zip_rate", F.lit(0.0)),
        "SellerPortfolioQuality": F.coalesce("_trustee_rate", F.lit(0.0)),
    }).drop("_row", "_zip_rate", "_trustee_rate", "_marks", "_state_sqft", "MarketMonth", "PostalMonth")


def surplus_share(value, reserve, p: Params):
    """Valuation over itself minus one as recorded, or over the reserve when the switch is on."""
    return ratio(value, reserve if p.trustee_pct_over_reserve else value) - 1


def _core(listings: DataFrame, wh: Warehouse, p: Params) -> DataFrame:
    fa, dp = listings.alias("fa"), by_merge(wh["dim_property"]).alias("dp")
    joined = (
        fa.join(dp, F.col("fa.PropertyId") == F.col("dp.PropertyId"), "left")
        .join(wh["dim_geo"].alias("dg"), F.col("dg.GeoId") == F.col("fa.GeoId"), "left")
        .join(wh["dim_trustee"].alias("dt"), F.col("dt.TrusteeId") == F.col("fa.TrusteeId"), "left")
    )
    joined = joined.withColumns({"_reserve": fx.trustee_reserve("fa."), "_value": fx.trustee_valuation("fa.")})
    reserve, value = F.col("_reserve"), F.col("_value")
    won = F.coalesce("fa.WinningBid", "fa.HighBidAmt")
    return joined.select(
        "dp.GlobalPropertyId", "fa.SystemAuctionId", *[f"fa.{k}" for k in LISTING_KEY], "fa.REDCID",
        "dp.LoanNbr", "dp.PropertyState", "dp.PropertyZip", "dp.PropertyCounty", "dp.PropertyCity",
        F.col("dg.MetroArea").alias("MSAName"), "fa.AuctionCode", "dt.TrusteeCode", "dt.TrusteeName",
        "dg.Latitude", "dg.Longitude", "fa.AuctionDate", "fa.MarketMonth", "fa.PostalMonth",
        "dp.PropertyOccupancyStatus",
        fx.condition_text(F.col("dp.Condition"), null_is_unknown=False).alias("Condition"),
        "dp.PropertyType", "dp.ProductType",
        *[c.alias(n) for n, c in fx.property_flags("dp.").items()],
        "fa.IsSold", flag(won >= reserve).alias("AuctionReserveSuccess"),
        F.col("fa.HighBidAmt").alias("HighBid"), "fa.WinningBid",
        reserve.alias("Reserve"), value.alias("BPO"), (value - reserve).alias("BPOSurplus"),
        surplus_share(value, reserve, p).alias("BPOSurplusPct"),
        "dp.HomeSquareFootage", "dp.Bedrooms", "dp.Baths",
        (F.lit(p.reference_year) - F.col("dp.YearBuilt")).alias("Age"), "dp.LotSize",
        "fa.OpeningBid", "fa.IsAuction", "fa.IsRemoved", "fa.IsCancelled", "fa.IsPostponed",
    )


def predictions(rows: DataFrame, coefficients: Mapping[str, DataFrame], weights: DataFrame, p: Params) -> DataFrame:
    """Score, order, floor and explain upcoming trustee listings in the published layout."""
    scored = scoring.order_trustee_probabilities(scoring.score_trustee(rows, coefficients, p))
    explained = explain.top_two_faults(scored, weights, explain.TRUSTEE_VARIABLES, p, literal_ratio=False)
    floored = scoring.floor_price(explained, "RecommendedMaxReservePrice", "OpeningBid")
    return floored.withColumn("ModelRunDate", F.lit(p.as_of)).select(*publish.TRUSTEE_OUTPUT)
