"""Every registered result: a Spark builder, its oracle source, and the output columns of both."""

from __future__ import annotations

import dataclasses
import uuid
from collections.abc import Callable
from datetime import date
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import terms as tt
from checks.oracle import oracle_query
from checks.roles import TestTables
from hammerline.functions import scoring as sf
from hammerline.functions.scoring import TIMES, term_value
from hammerline.functions.columns import number
from hammerline.operators import bidders, commits, explain, features as fx, history, impute, models, publish, report, rolling, scoring, spelling
from hammerline.params import LISTING_KEY, Params
from hammerline.plans import jobs, nontrustee, train, trustee
from hammerline.session import by_merge, settle, shared_dir
from hammerline.sources import files

P = Params(as_of=date(2001, 5, 15), programme_start=date(2000, 1, 1), registration_start=date(2000, 1, 1),
           training_registration_start=date(2000, 1, 1))


@dataclasses.dataclass(frozen=True)
class Query:
    build: Callable[[TestTables], DataFrame]
    spec: str
    source: str | None = None  # oracle entry or SELECT; None where SQL cannot express the result


QUERIES: dict[str, Query] = {}


def add(name: str, spec: str, source: str | None = None):
    def register(build):
        QUERIES[name] = Query(build, spec, source)
        return build
    return register


def project(df: DataFrame, spec: str) -> DataFrame:
    """Output columns in a form both engines print alike: rounded doubles, long counts, text dates."""
    columns = []
    for item in spec.split():
        name, _, kind = item.partition(":")
        c = F.col(name)
        if kind == "i":
            c = c.cast("long")
        elif kind == "d":
            c = F.date_format(c.cast("date"), "yyyy-MM-dd")
        elif kind:
            c = F.round(c.cast("double"), int(kind)) + F.lit(0.0)
        columns.append(c.alias(name))
    return df.select(*columns)


def runner(query: Query) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: project(query.build(TestTables(spark, sf_dir)), query.spec)


def oracle(query: Query) -> str | None:
    return None if query.source is None else oracle_query(query.source, query.spec)


K = "PropertyId:i AuctionId:i VenueId:i"

# ---- windows and histories ------------------------------------------------------------------


def _recent(wh):
    return history.recent_listings(wh["fact_auction"], wh["dim_auction"], P)


def _live(wh):
    return history.live_status(_recent(wh), wh["dim_auction_status"])


add("base_recent_listings", f"{K} AuctionCode AuctionDate:d MarketMonth:d PostalMonth:i RunNum:i", "recent")(_recent)
add("upcoming_listings", f"{K} AuctionDate:d SystemAuctionId", "recent_upcoming")(lambda wh: history.upcoming(_recent(wh), P))
_RATE = "AvgSTR:6 TotalAuctioned:i"
add("zip_sell_through", f"PropertyState PropertyZip {_RATE}", "zip_rate")(
    lambda wh: history.zip_sell_through(_live(wh), wh["dim_property"], P))
add("zip_sell_through_scoring", f"PropertyState PropertyZip {_RATE}", "zip_rate_scoring")(
    lambda wh: history.zip_sell_through(history.past(_live(wh), P), wh["dim_property"], P, product_lines=True))
add("seller_portfolio_quality", f"SellerCode {_RATE}", "seller_rate")(
    lambda wh: history.seller_portfolio(_live(wh), wh["dim_seller"], P))
add("seller_portfolio_quality_scoring", f"SellerCode {_RATE}", "seller_rate_scoring")(
    lambda wh: history.seller_portfolio(history.past(_live(wh), P), wh["dim_seller"], P, wh["dim_property"]))


def _recent_trustee(wh):
    return history.recent_listings(wh["fact_trustee_auction"], wh["dim_auction"], P)


add("trustee_zip_sell_through", f"PropertyState PropertyZip {_RATE}", "trustee_zip_rate")(
    lambda wh: history.trustee_zip_sell_through(_recent_trustee(wh), wh["dim_property"], P))
add("trustee_portfolio_quality", f"TrusteeCode {_RATE}", "trustee_rate")(
    lambda wh: history.trustee_portfolio(_recent_trustee(wh), wh["dim_trustee"], P))
_BID = f"{K} HighBid:6 WinningBid:6 Bidders:i Bids:i"
add("high_bid_history", _BID, "high_bid")(lambda wh: history.high_bids_for_training(wh["fact_bid_live"], P))
add("high_bid_history_scoring", _BID, "high_bid_scoring")(lambda wh: history.high_bids_for_scoring(wh["fact_bid_live"], P))
add("favorites_per_property", "PropertyId:i Favorites:i", "fav_property")(
    lambda wh: history.favorites(wh["fact_property_favorites"]))
add("favorites_per_listing", "PropertyId:i AuctionId:i Favorites:i", "fav_listing")(
    lambda wh: history.favorites(wh["fact_property_favorites"], ("PropertyId", "AuctionId")))
add("brought_to_sale_history", "PropertyId:i RunNum:i Removals:i Cancellations:i Postponements:i", "outcome_history")(
    lambda wh: history.brought_to_sale(wh["fact_trustee_auction"]))

# ---- bidders --------------------------------------------------------------------------------


def _history(wh, by_date=False):
    return bidders.bidder_history(wh["fact_bid_live"], wh["fact_residential"], wh["dim_property"], wh["dim_bidder"], P, by_date)


def _attendance(wh):
    return bidders.bidder_attendance(wh["fact_property_registration"], wh["fact_bid_live"], wh["dim_bidder"], P)


def _matches(wh, scoring):
    return bidders.registrant_matches(
        wh["fact_property_registration"], wh["dim_bidder"], wh["dim_property"], wh["fact_auction"],
        bidders.bidder_budget(_history(wh, not scoring)), _attendance(wh), positive_reserves=scoring)


_PEAKS = "MaxBid:6 WinningBid:6 Winner:i StartingBid:6 Reserve:6 beds:i baths:2 lotsize:4 yearbuilt:i BPO:6 ZIP"
add("bidder_history", f"bidderemail {K} PropertyCounty {_PEAKS}", "bid_history")(_history)
add("bidder_history_dated", f"bidderemail {K} PropertyCounty AuctionDate:d {_PEAKS}", "bid_history_dated")(
    lambda wh: _history(wh, True))
add("bidder_budget", "bidderemail AssetsBidUpon:i AvgMaxBid:7 AvgWinRate:6 FallOutRate:6 AvgMaxBidAsShareOfReserve:6 AvgStartingBid:7 "
    "AvgReserve:7 avgBeds:6 avgBaths:6 avgLotSize:6 AvgYearBuilt:7 AvgBPO:7", "budget")(lambda wh: bidders.bidder_budget(_history(wh)))
add("bidder_attendance", "bidderemail totalattended:i totalregistrations:i attendance:6", "attendance_rate")(_attendance)
_MATCHED = f"{K} bidderemail Reserve:6 ReserveMatch:6 Bedmatch:6 Bathmatch:6 Lotmatch:6 NaturalScore:6 BidderScore:6"


def _match_rows(wh, scoring):
    """One row per registration, as the oracle has them."""
    rows = _matches(wh, scoring)
    return rows.withColumn("_r", F.explode(F.sequence(F.lit(1), F.col("Registrations").cast("int")))).drop("_r")


add("registrant_matches", _MATCHED, "reg_match_scoring")(lambda wh: _match_rows(wh, True))
_SCORES = f"{K} ALRRegistrants:i IntrinsicBidderQuality:5 TotalRegistrantScore:5"
add("registrant_score", _SCORES, "reg_score_scoring")(lambda wh: bidders.registrant_score(_matches(wh, True)))
add("registrant_score_training", _SCORES, "reg_score")(lambda wh: bidders.registrant_score(_matches(wh, False)))

# ---- features -------------------------------------------------------------------------------

_FLAGS = ("SFR_Flag MultiResidence_Flag C2C_Flag REO_Flag ShortSale_Flag Trustee_Flag Condition_poor Condition_fair Condition_average "
          "Condition_good Condition_unknown PropertyOccupancyStatus_Occupied PropertyOccupancyStatus_Unknown PropertyOccupancyStatus_Vacant")
FLAGS = " ".join(f"{f}:i" for f in _FLAGS.split())
add("property_flags", f"PropertyId:i {FLAGS}", "prop_flags")(
    lambda wh: wh["dim_property"].withColumns(fx.property_flags()))
_METRICS = ("Appreciation:6 Turnover:6 TotalHomesForSale:4 PercentHomesSold:6 MedianPPSQFT:4 ForeclosedPer10000:6 PrevForeclosureSoldRate:6 "
            "TotalActive:4 Vacancy:6")


def _market(wh):
    place = wh["dim_property"].select("PropertyId", "PropertyZip")
    return fx.join_market(_live(wh).join(place, "PropertyId"), wh["market_metrics"], wh["postal_vacancy"])


add("market_metrics_fallback", f"{K} {_METRICS}", "listing_market")(_market)

_COMMON = (f"{K} GlobalPropertyId:i SystemAuctionId REDCID LoanNbr PropertyState PropertyZip PropertyCounty PropertyCity MSAName AuctionCode "
           f"Latitude:4 Longitude:4 PropertyOccupancyStatus Condition PropertyType ProductType {FLAGS} IsSold:i AuctionReserveSuccess:i "
           f"HighBid:6 RunNum:i HasPrevAttempts:i Reserve:6 BPO:6 BPOSurplus:6 BPOSurplusPct:9 HomeSquareFootage:3 Bedrooms:i Baths:2 Age:i "
           f"LotSize:4 Favorites:i {_METRICS} MedianPPSQFTDeviation:9 ValueLevel_Low:i ValueLevel_Med:i ValueLevel_High:i EventSize:i "
           f"StateEventSize:i Historical_Execution:6 SellerPortfolioQuality:6")
_NONTRUSTEE = (f"{_COMMON} SellerCode SellerName FinancingAvailable:i FullWarrantyDeed:i SpecialWarrantyDeed:i QuitClaimDeed:i StartingBid:6 "
               "IsSubjectToApproval:i TrueSold:i ALRRegistrants:i TotalRegistrantScore:5 IntrinsicBidderQuality:5")
_TRUSTEE = (f"{_COMMON} TrusteeCode TrusteeName AuctionDate:d WinningBid:6 Removals:i Cancellations:i Postponements:i OpeningBid:6 IsAuction:i "
            "IsRemoved:i IsCancelled:i IsPostponed:i")
add("feature_row", f"{_NONTRUSTEE} AuctionDate:d", "feature")(lambda wh: nontrustee.feature_row(wh, P))
add("feature_row_scoring", f"{_NONTRUSTEE} BidEndDT:d", "feature_scoring")(lambda wh: nontrustee.feature_row(wh, P, scoring=True))
add("feature_row_trustee", _TRUSTEE, "feature_trustee")(lambda wh: trustee.feature_row(wh, P))
add("feature_row_trustee_scoring", _TRUSTEE, "feature_trustee_scoring")(lambda wh: trustee.feature_row(wh, P, scoring=True))


def training(wh):
    return wh.once("feature", lambda: nontrustee.feature_row(wh, P))


def upcoming_rows(wh):
    return wh.once("feature_scoring", lambda: nontrustee.feature_row(wh, P, scoring=True))


def trustee_rows(wh):
    return wh.once("feature_trustee_scoring", lambda: trustee.feature_row(wh, P, scoring=True))


def _priced(wh):
    """Every listing with its raw reserve and state, over the whole fact; written once, as what is made of it reads it twice."""
    place = wh["dim_property"].select("PropertyId", "PropertyState")
    listings = wh["fact_auction"].select(*LISTING_KEY, "Reserve")
    codes = wh["dim_auction"].select("AuctionId", "AuctionCode")
    return settle(listings.join(by_merge(place), "PropertyId", "left").join(by_merge(codes), "AuctionId", "left"))


add("reserve_and_valuation", f"{K} Reserve:6 BPO:6 BPOSurplus:6 BPOSurplusPct:9", "sane_valuation")(
    lambda wh: training(wh).withColumn("BPO", F.when(
        (F.col("BPOSurplusPct") >= 5) | (F.col("BPOSurplusPct") < -0.9), None).otherwise(F.col("BPO"))))
add("sale_outcomes", f"{K} AuctionReserveSuccess:i TrueSold:i HasPrevAttempts:i IsSubjectToApproval:i", "outcome")(
    lambda wh: training(wh).withColumn("IsSubjectToApproval", F.coalesce("IsSubjectToApproval", F.lit(0))))
add("price_tercile_by_state", f"{K} PropertyState ValueLevel_Low:i ValueLevel_Med:i ValueLevel_High:i ValueLevel", "tercile")(
    lambda wh: fx.value_levels(_priced(wh)).withColumn("ValueLevel", fx.value_level_name()))
add("event_sizes", f"{K} AuctionCode PropertyState EventSize:i StateEventSize:i", "event_size")(
    lambda wh: fx.event_sizes(_priced(wh)))
add("ppsf_deviation", f"{K} MedianPPSQFTDeviation:9", "SELECT * FROM feature_trustee_scoring")(trustee_rows)

# ---- imputation -----------------------------------------------------------------------------

_FILL = " ".join(f"{m}:{9 if m == 'MedianPPSQFTDeviation' else 8}" for m in impute.FILLED)


def _gappy(wh):
    no_metrics = (F.col("PropertyId") % 7 == 0) | F.col("PropertyCounty").isin("NATION_3", "NATION_12") | (
        F.col("PropertyState") == "EUROPE")
    gaps = {m: F.when(no_metrics, None).otherwise(F.col(m)) for m in impute.FILLED if m != "MedianPPSQFTDeviation"}
    gaps["TotalHomesForSale"] = F.when(F.col("PropertyId") % 5 == 0, None).otherwise(F.col("TotalHomesForSale"))
    return training(wh).withColumns(gaps)


add("hierarchical_fill", f"{K} {_FILL}", "filled")(lambda wh: impute.hierarchical_fill(_gappy(wh)))
_REPAIR = "Age:4 LotSize:4 Bedrooms:4 Baths:4 HomeSquareFootage:8 Favorites:i TotalActive:4 Vacancy:6"
add("state_repair", f"{K} {_REPAIR}", "repaired")(lambda wh: impute.state_repair(training(wh)))
add("second_population_fill", f"{K} " + " ".join(f"{m}:8" for m in (*impute.SECOND_FILLED, "TotalActive", "Vacancy"))
    + " TrueSold:i HighBid:2", "second_filled")(
    lambda wh: impute.second_population_fill(impute.second_population(_gappy(wh), ["Reserve"])))
add("complete_cases_split", f"{K} Side", "complete_case")(lambda wh: _sides(wh))


def _sides(wh):
    train, score = impute.split(impute.fitted_states(training(wh), P.min_state_rows), P, models.REQUIRED)
    return train.withColumn("Side", F.lit("train")).unionByName(score.withColumn("Side", F.lit("score")))


def _listed(df, column):
    return df.select("PropertyState", F.posexplode(column).alias("Place", "Value"))


add("reserve_deciles", "PropertyState Place:i Value:6", "decile")(
    lambda wh: _listed(impute.reserve_breakpoints(training(wh), 10), "Breakpoints"))
add("reserve_quintiles_trustee", "PropertyState Place:i Value:6", "quintile_trustee")(
    lambda wh: _listed(impute.reserve_breakpoints(trustee_rows(wh), 5), "Breakpoints"))
add("bucket_min_bpo", "PropertyState Place:i Value:6", "bucket_low_list")(
    lambda wh: _listed(impute.bucket_minima(training(wh), impute.reserve_breakpoints(training(wh), 10)), "BucketBPO"))


def _unvalued(wh):
    return training(wh).withColumns({
        "BPO": F.when(F.col("PropertyId") % 5 == 0, None).otherwise(F.col("BPO")),
        "Predicted": F.col("MedianPPSQFT") * F.col("HomeSquareFootage") - 60000,
    })


add("bpo_blend", f"{K} BPO:6 BPOSurplus:6 BPOSurplusPct:9", "blended")(
    lambda wh: impute.blend_valuation(_unvalued(wh), P, "Predicted"))


def _estimates(wh):
    text = F.when(F.col("page_id") % 9 == 0, "NULL").when(F.col("page_id") % 10 == 0, "0").otherwise(
        (F.col("page_id") * 1000).cast("string"))
    return impute.external_estimates(wh["pages"].select(F.col("url").alias("URL"), text.alias("Estimate")), r"/(\d+)")


add("url_estimates", "GlobalPropertyId:i ExternalEstimate:6", "estimate")(_estimates)
add("estimate_fill", f"{K} BPO:6 BPOSurplus:6 IsPredictedBPO:i ExternalEstimate:6 SellerName PropertyCity", "estimate_filled")(
    lambda wh: impute.with_external_estimates(
        _unvalued(wh).withColumns({
            "GlobalPropertyId": F.col("PropertyId"),
            **{c: F.replace(F.col(c), F.lit(","), F.lit("")) for c in ("SellerName", "PropertyCity")},
        }), _estimates(wh)))

# ---- scores ---------------------------------------------------------------------------------


def _coefficients(wh):
    region = wh["region"]
    return {n: wh.spark.sql(tt.coefficient_select(n).replace("FROM region", "FROM {region}"), region=region) for n in tt.MODELS}


def _lookup(wh, is_trustee=False):
    return wh.spark.sql(tt.weight_select(is_trustee).replace("FROM region", "FROM {region}"), region=wh["region"])


def _scored(wh):
    return scoring.score_nontrustee(upcoming_rows(wh), _coefficients(wh), P)


def _scored_trustee(wh):
    return scoring.score_trustee(trustee_rows(wh), _coefficients(wh), P)


_PROBS = "AuctionDaySalePrediction:7 SellerAcceptedSalePrediction:7 ExceedReservePrediction:7"
add("score_logistic", f"{K} {_PROBS}", "scored")(_scored)
add("score_linear", f"{K} RecommendedMaxReservePrice:5 FunctionalBPO:6", "scored")(_scored)
add("score_valuation", f"{K} BPO_Estimate:5", "scored")(_scored)
_TPROBS = ("CancellationPrediction:7 PostponementPrediction:7 ThirdPartySaleIfAuctionedPrediction:7 "
           "ThirdPartySaleOverallPrediction:7")
add("score_trustee", f"{K} {_TPROBS} RecommendedMaxReservePrice:5 FunctionalBPO:6", "scored_trustee")(_scored_trustee)


def _ruled(wh):
    df = scoring.order_probabilities(_scored(wh))
    df = scoring.fill_opening(df, "StartingBid")
    df = df.withColumn("HighBidPrediction", scoring.cap_price(F.col("RecommendedMaxReservePrice"), F.col("Reserve")))
    df = df.withColumn("ReserveRedux", scoring.reserve_reduction(
        F.col("AuctionDaySalePrediction"), F.col("HighBidPrediction"), F.col("Reserve")))
    return scoring.floor_price(df, "HighBidPrediction", "StartingBid")


add("score_post_rules", f"{K} {_PROBS} HighBidPrediction:5 ReserveRedux:5 StartingBid:6", "ruled")(_ruled)
add("likelihood_bands", f"{K} AuctionDaySalePrediction:7 SaleLikelihood", "banded")(
    lambda wh: scoring.order_probabilities(_scored(wh)).withColumn(
        "SaleLikelihood", scoring.likelihood_band(F.col("AuctionDaySalePrediction"))))
add("acceptance_lookup", f"{K} AcceptancePrediction:7", "accepted")(
    lambda wh: scoring.acceptance(
        training(wh).withColumn("Price", F.col("BPO") * 0.7),
        wh.spark.sql(tt.ACCEPTANCE_MODELS.replace("FROM region", "FROM {region}"), region=wh["region"]),
        "Price", fallback_state="ASIA"))
add("coefficients_wide", "PropertyState Intercept:9 " + " ".join(f"{t}:9" for t in sf.PRICE_TERMS),
    tt.coefficient_select("high_bid"))(
    lambda wh: scoring.coefficients_wide(wh.spark.sql(
        tt.coefficient_long_select("high_bid").replace("FROM region", "FROM {region}"), region=wh["region"]), sf.PRICE_TERMS))

# ---- explanations ---------------------------------------------------------------------------

_FAULT = "PropertyFaultVariable PropertyFaultName ComponentValue:11"
add("contributions", f"{K} {_FAULT}", "contribution")(
    lambda wh: explain.contributions(upcoming_rows(wh), _lookup(wh), explain.VARIABLES, P))
add("contributions_trustee", f"{K} {_FAULT}", "contribution_trustee")(
    lambda wh: explain.contributions(trustee_rows(wh), _lookup(wh, True), explain.TRUSTEE_VARIABLES, P, literal_ratio=False))
add("top_two_faults", f"{K} Negative1 Negative2", "top_two")(
    lambda wh: explain.top_two_faults(upcoming_rows(wh), _lookup(wh), explain.VARIABLES, P))
add("top_two_faults_by_property", f"{K} Negative1 Negative2", "top_two_shared")(
    lambda wh: explain.top_two_faults(upcoming_rows(wh), _lookup(wh), explain.VARIABLES, P, key=["GlobalPropertyId"]))


def _weights(wh):
    long = {n: scoring.coefficients_long(_coefficients(wh)[n], n, tt.MODELS[n].terms).drop("model")
            for n in ("auction_day_sale", "high_bid")}
    return explain.chosen_weights(long["auction_day_sale"], long["high_bid"], models.PRICE_ONLY)


add("fault_weights", "PropertyState term weight:12", "chosen_weight")(_weights)
add("centred_faults", f"{K} Neg1 Neg2", "centred")(
    lambda wh: explain.centred_faults(training(wh), _weights(wh), sf.SALE_TERMS))
add("centred_faults_second_population", f"{K} Neg1 Neg2", "centred_second")(
    lambda wh: explain.centred_faults(upcoming_rows(wh), _weights(wh), sf.SALE_TERMS,
                                      centres=explain.state_centres(training(wh), sf.SALE_TERMS)))

# ---- publishing -----------------------------------------------------------------------------


def _final(wh):
    return nontrustee.predictions(upcoming_rows(wh), _coefficients(wh), _lookup(wh), P)


def _final_trustee(wh):
    return trustee.predictions(trustee_rows(wh), _coefficients(wh), _lookup(wh, True), P)


add("predictions_nontrustee", f"{K} BidEndDT:d {_PROBS} RecommendedMaxReservePrice:5 FunctionalBPO:6 AuctionDaySale:i SellerAcceptedSale:i "
    "ReserveExceeded:i ModelRunDate:d Negative1 Negative2", "final")(_final)
add("predictions_trustee", f"{K} AuctionDate:d {_TPROBS} RecommendedMaxReservePrice:5 FunctionalBPO:6 ModelRunDate:d Negative1 Negative2",
    "final_trustee")(_final_trustee)


def _published(wh):
    path = f"{shared_dir(wh.spark)}/history-{uuid.uuid4().hex}"
    final = settle(_final(wh))
    publish.append_history(final, path, 1)
    publish.append_history(final, path, 2)
    publish.append_history(final, path, 2)  # a repeated run must not double its rows
    return publish.read_history(wh.spark, path)


add("publish_history", f"{K} RunId:i MostRecentData:i AuctionDaySalePrediction:7", "history_table")(_published)


def _snapshot(wh):
    path = f"{shared_dir(wh.spark)}/current-{uuid.uuid4().hex}"
    publish.replace_current(_final(wh), path)
    publish.replace_current(publish.current_rows(_published(wh)).drop("RunId", "MostRecentData"), path)
    return publish.read_current(wh.spark, path)


add("publish_current", f"{K} MostRecentData:i AuctionDaySalePrediction:7 Negative1", "current_table")(_snapshot)
_UNIFIED = " ".join(
    name + {"bigint": ":i", "int": ":i", "double": ":5", "date": ":d", "timestamp_ntz": ":d", "string": ""}[kind]
    for name, _, _, kind in publish.UNIFIED
    if name not in ("SellerCode", "SellerName")
)
add("unified_predictions", _UNIFIED, "unified_table")(lambda wh: publish.unified(_final(wh), _final_trustee(wh)))

# ---- reports --------------------------------------------------------------------------------


def _scored_training(wh):
    return scoring.order_probabilities(scoring.score_nontrustee(training(wh), _coefficients(wh), P))


_Y = "AuctionDaySalePrediction"
add("prediction_histogram", "Population Bin:i Rows:i", "histogram_rows")(lambda wh: report.prediction_histogram(_scored_training(wh), P, _Y))
add("error_types", "Population ErrorType:i Rows:i", "error_rows")(lambda wh: report.error_types(_scored_training(wh), P, _Y, "IsSold"))
add("calibration", "MeanPrediction:8 ShareWithoutHighBid:8 Product:8", "calibrated")(
    lambda wh: report.calibration(_scored_training(wh), training(wh), _Y))
SEGMENTS = {"All": (True, ()), "WithoutFirst": (False, ("SC0", "SC1")), "Second": (True, ("SC2",)), "Third": (True, ("SC3",))}
_DRIFT = " ".join(f"{t}{m}:6" for m in ("BPOSurplus", "Reserve", "BPO", "BPOSurplusPct") for t in ("Pre", "Post"))
add("drift_by_segment", f"Segment {_DRIFT} BPODifference:6 ReserveDifference:6", "drifted")(
    lambda wh: report.drift_by_segment(training(wh), P, SEGMENTS))
add("unscored_frequency", "AuctionCode Rows:i", f"SELECT AuctionCode, count(*) AS Rows FROM feature "
    "WHERE AuctionDate > DATE '2001-05-15' AND AuctionCode IS NOT NULL GROUP BY 1")(
    lambda wh: report.unscored_frequency(training(wh), P, "AuctionCode"))
add("unscored_frequency_sellers", "SellerCode Rows:i", "SELECT SellerCode, count(*) AS Rows FROM feature "
    "WHERE AuctionDate > DATE '2001-05-15' AND SellerCode IN ('SC1', 'SC4', 'SC7') GROUP BY 1")(
    lambda wh: report.unscored_frequency(training(wh), P, "SellerCode", ("SC1", "SC4", "SC7")))

# ---- models ---------------------------------------------------------------------------------

add("ols_per_state", "PropertyState term value:5", """
  SELECT PropertyState, 'Intercept' AS term, regr_intercept(BPO, Reserve) AS value FROM feature WHERE BPO IS NOT NULL AND Reserve IS NOT NULL GROUP BY 1
  UNION ALL SELECT PropertyState, 'Reserve', regr_slope(BPO, Reserve) FROM feature WHERE BPO IS NOT NULL AND Reserve IS NOT NULL GROUP BY 1""")(
    lambda wh: models.ols_per_state(training(wh), ["Reserve"], "BPO"))
_COEF = "PropertyState model term value:3"
add("valuation_fit", _COEF)(lambda wh: models.ols_per_state(models.valuation_training(training(wh)), models.VALUATION_FIT, "BPO"))
add("valuation_training_rows", "PropertyState Rows:i SumBPO:0 SumAge:3 SumBedrooms:3 SumBaths:3 SumFeet:3", "valuation_rows")(
    lambda wh: models.valuation_training(training(wh)).groupBy("PropertyState").agg(
        F.count(F.lit(1)).alias("Rows"), F.sum("BPO").alias("SumBPO"), F.sum("Age").alias("SumAge"), F.sum("Bedrooms").alias("SumBedrooms"),
        F.sum("Baths").alias("SumBaths"), F.sum("HomeSquareFootage").alias("SumFeet")))


def _fit_rows(wh):
    return impute.quality_flags(impute.state_repair(training(wh))).withColumn("IsSubjectToApproval", F.coalesce("IsSubjectToApproval", F.lit(0)))


def _fit_trustee_rows(wh):
    return impute.state_repair(wh.once("feature_trustee", lambda: trustee.feature_row(wh, P)), national_postal=True)


add("lambda_by_cv", "PropertyState label lambda:4")(lambda wh: models.lambda_by_cv(_fit_rows(wh), models.SALE_FIT, ["IsSold", "TrueSold"]))
add("elastic_net_price", _COEF)(lambda wh: models.elastic_net_price(
    _fit_rows(wh).filter(F.col("HighBid").isNotNull()), models.PRICE_FIT, "HighBid"))
add("ridge_logistic_per_state", _COEF)(lambda wh: models.ridge_logistic(
    models.two_class(_fit_rows(wh), "AuctionReserveSuccess", models.shortfall()), models.SALE_FIT, ["IsSold", "TrueSold", "AuctionReserveSuccess"]))
add("pre_reserve_models", _COEF)(lambda wh: models.ridge_logistic(
    _fit_rows(wh), models.PRE_RESERVE_FIT, ["IsSold", "TrueSold", "AuctionReserveSuccess"]))


def _trustee_models(wh):
    rows = _fit_trustee_rows(wh)
    for label, by in (("IsPostponed", "Postponements"), ("IsCancelled", "Cancellations")):
        rows = models.two_class(rows, label, -F.col(by), F.col(by))
    return models.ridge_logistic(rows, models.TRUSTEE_FIT, ["IsSold", "IsPostponed", "IsCancelled"])


add("trustee_outcome_models", _COEF)(_trustee_models)
add("two_class_labels", f"{K} Label:i", "flipped")(lambda wh: models.two_class(
    training(wh).withColumn("Label", F.when(F.col("PropertyState") == "ASIA", F.col("IsSold")).otherwise(
        F.when(F.col("PropertyState") == "AFRICA", 1).otherwise(0))), "Label", models.shortfall(), -models.shortfall()))

# ---- fits are optimal -------------------------------------------------------------------------
# A fit is right if its gradient vanishes. Spark computes that gradient from the rows and the published coefficients
# alone; SQL counts the rows that must have gone in, and states the zero.


def _filled(columns, table="f"):
    """SQL: every column is there, repaired ones after their repair."""
    repaired = {x.partition(":")[0] for x in _REPAIR.split()}
    return " AND ".join(f"{'r' if c in repaired else table}.{c} IS NOT NULL" for c in dict.fromkeys(columns))


_DERIVED = ("HasLikelyBidders", "HasWellMatchedBidders", "IsSubjectToApproval")  # never missing where they are fitted


def _plain(terms):
    return [c for t in terms for c in t.split(TIMES) if c not in _DERIVED]


def _gradients(rows, fits, terms, label, logistic, share=0.0, standard=True):
    """(PropertyState, Rows, Ones, Status, Gradient) of one label's fits: the largest breach of the conditions of the optimum.

    A slope that is not zero has a gradient that its penalty balances, one that is zero a gradient within the lasso part of it. Gradient and
    penalty are those of standardised terms, or, with ``standard=False``, of the terms as they are, in units of the target's spread.
    """
    x = {t: term_value(t).cast("double") for t in terms}
    held = settle(rows.select("PropertyState", F.col(label).cast("double").alias("_y"), *[c.alias(f"_{i}") for i, c in enumerate(x.values())]))
    held = held.filter(~F.exists(F.array(*held.columns[1:]), F.isnull)).filter("PropertyState IS NOT NULL")
    wide = fits.groupBy("PropertyState").agg(F.map_from_entries(F.collect_list(F.struct("term", "value"))).alias("_b"),
                                             F.max("penalty").alias("_l"), F.max("status").alias("Status"))
    b = [F.col("_b")[t] for t in ("Intercept", *terms)]
    z = b[0]
    for i in range(len(terms)):
        z = z + b[i + 1] * F.col(f"_{i}")
    held = held.join(settle(wide), "PropertyState").withColumn("_r", F.col("_y") - (sf.logistic(z) if logistic else z))
    parts = []
    for i, t in enumerate(terms):
        c, sd = F.col(f"_{i}"), F.stddev_pop(f"_{i}")
        unit = sd if standard else F.lit(1.0)
        slope, pull, lam = F.max(b[i + 1]) * unit, F.covar_pop("_r", c) / unit, F.max("_l")
        breach = F.when(slope != 0, F.abs(pull - lam * ((1 - share) * slope + share * F.signum(slope)))).otherwise(
            F.greatest(F.abs(pull) - lam * share, F.lit(0.0)))
        parts.append(F.when(sd > 1e-9, breach / (F.lit(1.0) if standard else sd)).otherwise(0.0))
    size = F.lit(1.0) if logistic else F.greatest(F.stddev_pop("_y"), F.lit(1e-9))
    worst = F.greatest(F.abs(F.avg("_r")), *parts) / size
    out = held.groupBy("PropertyState").agg(F.count("*").alias("Rows"), F.sum("_y").alias("Ones"), F.max("Status").alias("Status"), worst.alias("g"))
    return out.withColumn("Gradient", F.when(F.col("Status") == models.ONE_CLASS, 0.0).otherwise(F.col("g"))).withColumn("Label", F.lit(label))


def _valuation_is_optimal(wh):
    rows = models.valuation_training(training(wh))
    fits = models.ols_per_state(rows, models.VALUATION_FIT, "BPO").withColumns({"penalty": F.lit(0.0), "status": F.lit(models.CONVERGED)})
    return _gradients(rows, fits, models.VALUATION_FIT, "BPO", False)


add("valuation_is_optimal", "PropertyState Rows:i Gradient:4", f"""
  SELECT PropertyState, count(*) + 1 AS Rows, 0.0e0 AS Gradient FROM feature f WHERE BPO IS NOT NULL AND PropertyState IS NOT NULL
  AND {' AND '.join(f'{c} IS NOT NULL' for c in dict.fromkeys(_plain(models.VALUATION_FIT)) if c != 'LotSize')} GROUP BY 1""")(_valuation_is_optimal)
add("ols_two_terms", "PropertyState term value:3", """
  SELECT PropertyState, UNNEST(['Intercept', 'Reserve', 'RunNum']) AS term, UNNEST([my - p * mx - q * mz, p, q]) AS value FROM (
    SELECT *, (u * d - v * b) / (a * d - b * b) AS p, (a * v - b * u) / (a * d - b * b) AS q FROM (
      SELECT PropertyState, var_pop(Reserve) AS a, covar_pop(Reserve, RunNum) AS b, var_pop(RunNum) AS d, covar_pop(Reserve, BPO) AS u,
             covar_pop(RunNum, BPO) AS v, avg(Reserve) AS mx, avg(RunNum) AS mz, avg(BPO) AS my
      FROM feature WHERE BPO IS NOT NULL AND Reserve IS NOT NULL AND RunNum IS NOT NULL AND PropertyState IS NOT NULL GROUP BY 1) m) s""")(
    lambda wh: models.ols_per_state(training(wh), ["Reserve", "RunNum"], "BPO"))
add("cleaned_rows", f"{K} Reserve:6 BPO:6 SellerName PropertyCity", """
  SELECT PropertyId, AuctionId, VenueId, Reserve, CASE WHEN BPOSurplusPct >= 5 OR BPOSurplusPct < -0.9 THEN NULL ELSE BPO END AS BPO,
         replace(SellerName, ',', '') AS SellerName, replace(PropertyCity, ',', '') AS PropertyCity
  FROM feature WHERE AuctionDate >= DATE '2001-05-15' - INTERVAL 120 DAY AND Reserve IS NOT NULL""")(
    lambda wh: impute.clean(training(wh), P, ["Reserve", "BPO", "BPOSurplusPct"]))
add("quality_flags", f"{K} HasLikelyBidders:i HasWellMatchedBidders:i", """
  SELECT PropertyId, AuctionId, VenueId, CASE WHEN IntrinsicBidderQuality >= 0.5 THEN 1 ELSE 0 END AS HasLikelyBidders,
         CASE WHEN TotalRegistrantScore >= 0.5 THEN 1 ELSE 0 END AS HasWellMatchedBidders FROM feature""")(
    lambda wh: impute.quality_flags(training(wh)))
add("balanced_labels", f"{K} AuctionReserveSuccess:i", f"""
  SELECT PropertyId, AuctionId, VenueId, CASE WHEN hi = 0 AND up = 1 AND gap IS NOT NULL THEN 1 WHEN lo = 1 AND down = 1 AND gap IS NOT NULL THEN 0 ELSE y END AS AuctionReserveSuccess
  FROM (SELECT *, min(y) OVER (PARTITION BY PropertyState) AS lo, max(y) OVER (PARTITION BY PropertyState) AS hi,
               row_number() OVER (PARTITION BY PropertyState ORDER BY gap NULLS LAST, PropertyId, AuctionId, VenueId) AS up,
               row_number() OVER (PARTITION BY PropertyState ORDER BY -gap NULLS LAST, PropertyId, AuctionId, VenueId) AS down FROM labelled) q""")(
    lambda wh: train.balanced(training(wh).withColumn("AuctionReserveSuccess", F.when(F.col("PropertyState") == "ASIA", F.col("IsSold")).otherwise(
        F.when(F.col("PropertyState") == "AFRICA", 1).otherwise(0))), train.REO))

# ---- fit, score and explain end to end -------------------------------------------------------

_FITTED = f"{K} PropertyState SaleLikelihood Neg1 Neg2 BPO:3 "


def _reo_estimates(wh):
    return _estimates(wh).withColumn("GlobalPropertyId", F.col("GlobalPropertyId") + 500000)


_FIT_LINES = {"reo": train.REO, "pre_reserve": train.PRE_RESERVE, "trustee": train.TRUSTEE}


def _fitted(wh, name):
    """Every scored listing of one product line; a session fits each line once."""
    line = _FIT_LINES[name]

    def fit():
        rows = wh.once("feature_trustee", lambda: trustee.feature_row(wh, P)) if line.trustee else training(wh)
        return train.fit_and_score(rows, line, P, _reo_estimates(wh) if name == "reo" else None).full
    return wh.once(f"scored_{name}", fit)


add("fit_and_score", _FITTED + "AuctionDaySalePrediction:4 SellerAcceptedSalePrediction:4 ExceedReservePrediction:4 HighBidPrediction:2 ReserveRedux:2")(
    lambda wh: _fitted(wh, "reo"))
add("fit_and_score_pre_reserve", _FITTED + "AuctionDaySalePrediction:4 SellerAcceptedSalePrediction:4 ExceedReservePrediction:4")(
    lambda wh: _fitted(wh, "pre_reserve"))
add("fit_and_score_trustee", _FITTED + "ThirdPartySalePrediction:4 PostponePrediction:4 CancelPrediction:4 HighBidPrediction:2 ReserveRedux:2")(
    lambda wh: _fitted(wh, "trustee"))


def _broken_rules(line, names=None):
    """Rules for published figures that a scored listing breaks, as flags; values may be text."""
    def c(name):
        return number(F.col(name))

    chance = [c(n) for n in line.labels.values()]
    sale = c(line.labels[line.sale])
    names = list((names or line.names).values())
    shared = {n for n in names if names.count(n) > 1} | {explain.NO_FAULT}  # two variables may go by one name
    rules = [~x.between(0, 1) for x in chance] + [F.col("SaleLikelihood") != scoring.likelihood_band(sale),
                                                  (F.col("Neg1") == F.col("Neg2")) & ~F.col("Neg1").isin(*shared)]
    if not line.trustee:
        rules += [a < b for a, b in zip(chance, chance[1:])]
    if line.price_terms:
        rules += [c("HighBidPrediction") < c(line.opening), (c("ReserveRedux") != 0) & (sale >= 0.5), c("ReserveRedux") > 0,
                  c("HighBidPrediction") > F.greatest(1.5 * c("Reserve"), F.lit(200_000.0), c(line.opening)) + 1e-6]
    return [F.coalesce(r, F.lit(False)).cast("int") for r in rules]


def _scored_rules(name):
    line = _FIT_LINES[name]
    figures = [*line.labels.values(), *(["HighBidPrediction", "ReserveRedux"] if line.price_terms else [])]

    def build(wh):
        missing = [F.col(f).isNull().cast("int") for f in figures]
        return _fitted(wh, name).withColumn("Broken", sum((*_broken_rules(line), *missing), F.lit(0)))
    return build


def _scored_listings(source, required, extra=""):
    """SQL: listings from the hold-out date on that have every fact a model asks for, once gaps are filled."""
    filled = {"TotalActive": "_act", "Vacancy": "_vac", "Favorites": "_marks", "MedianPPSQFTDeviation": "_feet", "BPOSurplus": "Reserve",
              "BPOSurplusPct": "nullif(Reserve, 0)"}
    facts = " AND ".join(f"{filled.get(r, r)} IS NOT NULL" for r in required)
    feet = "CASE WHEN HomeSquareFootage >= 100 THEN HomeSquareFootage END"
    return f"""
  SELECT PropertyId, AuctionId, VenueId, 0 AS Broken FROM (
    SELECT *, coalesce(TotalActive, max(TotalActive) OVER s) AS _act, coalesce(Vacancy, max(Vacancy) OVER s) AS _vac,
           coalesce({feet}, max({feet}) OVER s) AS _feet, Favorites / nullif(RunNum, 0) AS _marks
    FROM {source} WINDOW s AS (PARTITION BY PropertyState)) q
  WHERE AuctionDate >= DATE '2001-04-15' AND {facts}{extra}"""


add("scored_listings", f"{K} Broken:i", _scored_listings("prepared", models.REQUIRED))(_scored_rules("reo"))
add("scored_listings_pre_reserve", f"{K} Broken:i", _scored_listings("prepared", models.PRE_RESERVE_REQUIRED))(_scored_rules("pre_reserve"))
add("scored_listings_trustee", f"{K} Broken:i", _scored_listings("prepared_trustee", models.TRUSTEE_REQUIRED, " AND IsAuction = 1"))(
    _scored_rules("trustee"))

# ---- logistic and elastic-net fits are optimal --------------------------------------------------


def _logistic_is_optimal(rows, terms, labels):
    rows = settle(rows)
    fits = settle(models.ridge_logistic_fits(rows, terms, labels))
    parts = [_gradients(rows, fits.filter(F.col("model") == label), terms, label, True, models.LASSO_SHARE) for label in labels]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    # a state without both classes answers by its share and says so
    return out.withColumn("Ended", F.when(F.col("Status") == models.ONE_CLASS, (F.col("Ones") == 0) | (F.col("Ones") == F.col("Rows"))).otherwise(
        F.col("Status") == models.CONVERGED).cast("int"))


_OPTIMAL = "PropertyState Label Rows:i Ones:i Ended:i Gradient:4"


def _fit_counts(source, terms, labels, ones=lambda x: f"sum({x})"):
    """SQL: the rows that must have gone into every fit, and the optimum's zero."""
    return " UNION ALL ".join(f"""
      SELECT PropertyState, '{x}' AS Label, count(*) AS Rows, {ones(x)} AS Ones, 1 AS Ended, 0.0e0 AS Gradient
      FROM {source} WHERE PropertyState IS NOT NULL AND {' AND '.join(f'{c} IS NOT NULL' for c in dict.fromkeys((*_plain(terms), x)))} GROUP BY 1""" for x in labels)


_REO_LABELS = ["IsSold", "TrueSold", "AuctionReserveSuccess"]
_REPAIRED = [x.partition(":")[0] for x in _REPAIR.split()]
_FIT_SOURCE = f"(SELECT f.* EXCLUDE ({', '.join(_REPAIRED)}), {', '.join(f'r.{c}' for c in _REPAIRED)} FROM feature f JOIN repaired r USING (PropertyId, AuctionId, VenueId)) q"
add("sale_models_are_optimal", _OPTIMAL, f"SELECT * FROM ({_fit_counts(_FIT_SOURCE, models.SALE_FIT, _REO_LABELS)}) u")(
    lambda wh: _logistic_is_optimal(_fit_rows(wh), models.SALE_FIT, _REO_LABELS))
add("pre_reserve_models_are_optimal", _OPTIMAL, f"SELECT * FROM ({_fit_counts(_FIT_SOURCE, models.PRE_RESERVE_FIT, _REO_LABELS)}) u")(
    lambda wh: _logistic_is_optimal(_fit_rows(wh), models.PRE_RESERVE_FIT, _REO_LABELS))
_T_REPAIRED = _REPAIRED
_T_SOURCE = f"(SELECT f.* EXCLUDE ({', '.join(_REPAIRED)}), {', '.join(f'r.{c}' for c in _REPAIRED)} FROM feature_trustee f JOIN repaired_trustee r USING (PropertyId, AuctionId, VenueId)) q"
_T_LABELS = ["IsSold", "IsPostponed", "IsCancelled"]
add("trustee_models_are_optimal", _OPTIMAL, f"SELECT * FROM ({_fit_counts(_T_SOURCE, models.TRUSTEE_FIT, _T_LABELS)}) u")(
    lambda wh: _logistic_is_optimal(_fit_trustee_rows(wh), models.TRUSTEE_FIT, _T_LABELS))


def _price_is_optimal(wh):
    rows = settle(_fit_rows(wh).filter(F.col("HighBid").isNotNull()))
    fits = settle(models.elastic_net_price_fits(rows, models.PRICE_FIT, "HighBid"))
    lam = fits.filter(F.col("term") == models.PENALTY).select("PropertyState", F.col("value").alias("penalty"))
    held = fits.filter(F.col("term") != models.PENALTY).join(lam, "PropertyState").withColumn("status", F.lit(models.CONVERGED))
    return _gradients(rows, held, models.PRICE_FIT, "HighBid", False, 0.005, standard=False)


add("price_models_are_optimal", "PropertyState Rows:i Gradient:4", f"SELECT PropertyState, Rows, Gradient FROM ({_fit_counts(_FIT_SOURCE, models.PRICE_FIT, ['HighBid'])}) u")(_price_is_optimal)
# One 0/1 term, lasso alone: the fitted shares of both groups move toward each other by the penalty, and SQL has the fit in closed form.
add("lasso_logistic_one_term", "PropertyState term value:5", """
  SELECT PropertyState, UNNEST(['Intercept', 'FinancingAvailable']) AS term,
         UNNEST([CASE WHEN shrunk THEN ln(p / (1 - p)) ELSE ln(q0 / (1 - q0)) END, CASE WHEN shrunk THEN 0.0e0 ELSE ln(q1 / (1 - q1)) - ln(q0 / (1 - q0)) END]) AS value
  FROM (SELECT *, (k1 + k0) / (n1 + n0) AS p, (k1 - d) / n1 AS q1, (k0 + d) / n0 AS q0, (k1 - d) / n1 <= (k0 + d) / n0 AND k1 / n1 >= k0 / n0
               OR (k1 - d) / n1 >= (k0 + d) / n0 AND k1 / n1 <= k0 / n0 AS shrunk
        FROM (SELECT *, 0.01e0 * sqrt(n1 * n0) * sign(k1 / n1 - k0 / n0) AS d
              FROM (SELECT PropertyState, sum(FinancingAvailable) * 1.0e0 AS n1, sum(1 - FinancingAvailable) * 1.0e0 AS n0,
                           sum(IsSold * FinancingAvailable) * 1.0e0 AS k1, sum(IsSold * (1 - FinancingAvailable)) * 1.0e0 AS k0
                    FROM feature WHERE IsSold IS NOT NULL AND PropertyState IS NOT NULL GROUP BY 1) a) b) c""")(
    lambda wh: models.ridge_logistic_fits(training(wh), ["FinancingAvailable"], ["IsSold"], share=1.0, penalty=0.01, tol=1e-9))

# ---- rolling aggregates from stored parts --------------------------------------------------------


def _day(text):
    return (date.fromisoformat(text) - date(1970, 1, 1)).days


def _rolled_bids(wh):
    """History up to March is stored, then April; May is read from the bids themselves."""
    kept = rolling.Measures(
        ("PropertyId", "VenueId", "AuctionId"), "BidStartDate", maxima={"HighBid": F.col("BidAmount"), "WinningBid": F.col("WinningBid")},
        distinct={"Bidders": F.col("BidderId"), "Bids": F.col("BidAmount")})
    root = f"{shared_dir(wh.spark)}/rolled-{uuid.uuid4().hex}"
    bids = wh["fact_bid_live"].filter(F.col("BidderId") != -1)
    rolling.store(bids, kept, root, _day("2000-12-15"), _day("2001-03-31"))
    rolling.store(bids, kept, root, _day("2001-04-01"), _day("2001-04-30"))
    return rolling.window(wh.spark, kept, root, _day("2000-12-15"), _day("2100-01-01"), fresh=bids, last=_day("2001-04-30"))


add("high_bid_history_rolled", _BID, "high_bid")(_rolled_bids)


def _rolled_rates(wh):
    kept = rolling.Measures(("SellerCode",), "AuctionDate", sums={"Sold": F.col("IsSold"), "Held": F.col("IsAuctioned")})
    root = f"{shared_dir(wh.spark)}/rolled-{uuid.uuid4().hex}"
    listings = settle(_live(wh).join(wh["dim_seller"].select("SellerId", "SellerCode"), "SellerId", "left"))
    last = listings.agg(F.max("AuctionDate").cast("date")).first()[0]
    rolling.store(listings, kept, root, _day("2000-12-01"), _day("2001-02-28"))
    rolling.store(listings, kept, root, _day("2001-03-01"), (last - date(1970, 1, 1)).days)
    out = rolling.window(wh.spark, kept, root, _day("2000-12-15"), (last - date(1970, 1, 1)).days + 1)
    return out.select("SellerCode", (F.col("Sold") / F.col("Sold_n")).alias("AvgSTR"), F.col("Held_n").alias("TotalAuctioned")).filter(
        F.col("TotalAuctioned") >= P.min_listings)


add("seller_portfolio_quality_rolled", f"SellerCode {_RATE}", "seller_rate")(_rolled_rates)

# ---- one commit for history and current set ------------------------------------------------------


def _committed(wh):
    root = f"{shared_dir(wh.spark)}/published-{uuid.uuid4().hex}"
    final = settle(_final(wh))
    late = commits.stage(final, root, 1)  # a writer that comes second with an earlier run
    commits.publish(final.limit(0), root, 2)
    commits.publish(final, root, 2)
    commits.commit(wh.spark, late)
    return root


add("publish_committed_history", f"{K} RunId:i MostRecentData:i AuctionDaySalePrediction:7", "history_table")(
    lambda wh: commits.read_history(wh.spark, _committed(wh)))
add("publish_committed_current", f"{K} MostRecentData:i AuctionDaySalePrediction:7 Negative1", "current_table")(
    lambda wh: commits.read_current(wh.spark, _committed(wh)))

# ---- delimited files ------------------------------------------------------------------------------

_EXTRACT = (*LISTING_KEY, "AuctionDate", "Reserve", "BPO", "PropertyState", "SellerName", "PropertyCity")


def _folder(wh):
    return f"{shared_dir(wh.spark)}/files-{uuid.uuid4().hex}"


def _extract_file(wh):
    """The extract of a run goes to a file that carries its date; it is found by that date and read back."""
    folder = _folder(wh)
    publish.write_csv(training(wh).withColumn("AuctionDate", F.col("AuctionDate").cast("date")), f"{folder}/UnifiedPredictionData_{P.as_of:%Y-%m-%d}.csv", _EXTRACT)
    rows = files.read_feature_csv(wh.spark, folder, P.as_of, _EXTRACT)
    return rows.withColumns({c: number(F.col(c)) for c in (*LISTING_KEY, "Reserve", "BPO")})


_FILE_SPEC = f"{K} AuctionDate:d Reserve:6 BPO:6 PropertyState SellerName PropertyCity"
_FILE_SQL = """SELECT PropertyId, AuctionId, VenueId, AuctionDate, Reserve, BPO, coalesce(PropertyState, 'NA') AS PropertyState,
  coalesce(SellerName, 'NA') AS SellerName, coalesce(PropertyCity, 'NA') AS PropertyCity FROM feature"""
add("csv_feature_extract", _FILE_SPEC, _FILE_SQL)(_extract_file)


def _second_file(wh):
    """The second population's own file: read as text, made numeric, rows without a reserve dropped."""
    path = f"{_folder(wh)}/second.csv"
    columns = [c for c in training(wh).columns if c not in ("AuctionDate",)]
    publish.write_csv(_gappy(wh), path, columns)
    text = {c for c, kind in training(wh).dtypes if kind == "string"}
    return impute.second_population(files.read_second_population(wh.spark, path, columns), [c for c in columns if c not in text])


add("csv_second_population", f"{K} Reserve:6 Turnover:8 TotalHomesForSale:8 Vacancy:6",
    "SELECT PropertyId, AuctionId, VenueId, Reserve, Turnover, TotalHomesForSale, Vacancy FROM gappy WHERE Reserve IS NOT NULL")(_second_file)


def _estimate_files(wh):
    """Three headerless files, stacked by a pattern."""
    folder = _folder(wh)
    text = F.when(F.col("page_id") % 9 == 0, "NULL").when(F.col("page_id") % 10 == 0, "0").otherwise((F.col("page_id") * 1000).cast("string"))
    pages = wh["pages"].select("page_id", F.lit("2001-05-01").alias("Date"), F.col("url").alias("URL"), text.alias("Estimate"))
    for k in range(3):
        pages.filter(F.col("page_id") % 3 == k).drop("page_id").write.csv(f"{folder}/estimates_{k}")
    return impute.external_estimates(files.read_estimates(wh.spark, f"{folder}/estimates_*"), r"/(\d+)")


add("csv_estimates", "GlobalPropertyId:i ExternalEstimate:6", "estimate")(_estimate_files)


def _accounted(wh):
    """Good and broken records of two files: what is read, kept and put aside, per reason."""
    folder = _folder(wh)
    lines = training(wh).select(F.concat_ws(",", *[F.col(c).cast("string") for c in LISTING_KEY], F.coalesce(F.col("Reserve").cast("string"), F.lit("NULL")),
                                            F.when(F.col("PropertyId") % 11 == 0, F.lit("one,too many")).otherwise("fits")).alias("value"), "PropertyId")
    lines = lines.withColumn("value", F.when(F.col("PropertyId") % 13 == 0, F.regexp_replace("value", "^[0-9]+", "x")).otherwise(F.col("value")))
    for k in range(2):
        lines.filter(F.col("PropertyId") % 2 == k).select("value").write.text(f"{folder}/part_{k}")
    rows, bad, counts = files.read_accounted(wh.spark, f"{folder}/part_*", [*LISTING_KEY, "Reserve", "Note"], False, [*LISTING_KEY, "Reserve"])
    files.write_quarantine(bad, f"{folder}/quarantine")
    aside = wh.spark.read.parquet(f"{folder}/quarantine").groupBy("reason").agg(F.count("*").alias("Rows"), F.lit(0.0).alias("Reserve"))
    kept = rows.agg(F.count("*").alias("Rows"), F.sum("Reserve").alias("Reserve")).withColumn("reason", F.lit("kept"))
    read = counts.agg(F.sum("read").alias("Rows")).withColumns({"reason": F.lit("read"), "Reserve": F.lit(0.0)})
    return kept.unionByName(aside).unionByName(read)


add("csv_accounted", "reason Rows:i Reserve:2", """
  SELECT CASE WHEN PropertyId % 11 = 0 THEN 'another number of fields' WHEN PropertyId % 13 = 0 THEN 'PropertyId is no number' ELSE 'kept' END AS reason,
         count(*) AS Rows, sum(CASE WHEN PropertyId % 11 = 0 OR PropertyId % 13 = 0 THEN 0 ELSE coalesce(Reserve, 0) END) AS Reserve
  FROM feature GROUP BY 1 UNION ALL SELECT 'read', count(*), 0 FROM feature""")(_accounted)


def _coefficient_files(wh):
    path = f"{_folder(wh)}/coefficients"
    long = [scoring.coefficients_long(_coefficients(wh)[n], n, tt.MODELS[n].terms) for n in ("auction_day_sale", "high_bid")]
    files.write_coefficients(long[0].unionByName(long[1]), path)
    return scoring.coefficients_wide(wh.spark.read.parquet(f"{path}/model=high_bid"), sf.PRICE_TERMS)


add("coefficient_files", "PropertyState Intercept:9 " + " ".join(f"{t}:9" for t in sf.PRICE_TERMS), tt.coefficient_select("high_bid"))(_coefficient_files)

# ---- parts of the training line --------------------------------------------------------------------

add("prepared_rows", f"{K} {_FILL} BPO:6 BPOSurplus:6 IsPredictedBPO:i ExternalEstimate:2 IsSubjectToApproval:i SellerName PropertyCity", "prepared")(
    lambda wh: train.prepare(training(wh), train.REO, P))
add("prepared_trustee_rows", f"{K} HighBid:6 BPOSurplus:6 IsPredictedBPO:i TrusteeName", "prepared_trustee")(
    lambda wh: train.prepare(wh.once("feature_trustee", lambda: trustee.feature_row(wh, P)), train.TRUSTEE, P))
add("state_repair_trustee", f"{K} {_REPAIR}", "repaired_trustee")(_fit_trustee_rows)


def _predicted(wh):
    long = scoring.coefficients_long(_coefficients(wh)["auction_day_sale"], "sale", tt.MODELS["auction_day_sale"].terms)
    return train.predict(training(wh), long, "sale", tt.MODELS["auction_day_sale"].terms, "AuctionDaySalePrediction", sf.logistic)


_Z = " + ".join(f"c.{t} * {' * '.join(f'a.{x}' for x in t.split(TIMES))}" for t in tt.MODELS["auction_day_sale"].terms)
add("predict_from_long_table", f"{K} AuctionDaySalePrediction:7", f"""
  SELECT a.PropertyId, a.AuctionId, a.VenueId, 1 / (1 + exp(-(c.Intercept + {_Z}))) AS AuctionDaySalePrediction
  FROM feature a JOIN coef_auction_day_sale c ON a.PropertyState = c.PropertyState""")(_predicted)

# ---- keys in mixed case -----------------------------------------------------------------------------


def _mixed(wh):
    """The warehouse with its text keys in mixed case, given one spelling again."""
    def shaken(table, column, by):
        return wh[table].withColumn(column, F.when(F.col(by) % 3 == 0, F.upper(column)).when(F.col(by) % 3 == 1, F.lower(column)).otherwise(F.initcap(column)))

    odd = {"dim_bidder": shaken("dim_bidder", "bidderemail", "BidderId"), "dim_seller": shaken("dim_seller", "SellerCode", "SellerId"),
           "dim_trustee": shaken("dim_trustee", "TrusteeCode", "TrusteeId"), "dim_property": shaken("dim_property", "PropertyState", "PropertyId")}
    return spelling.unify(spelling.Respelled(wh, odd))


def _lowered(df, column):
    return df.withColumn(column, F.lower(column))


def _mixed_budget(wh):
    odd = _mixed(wh)
    return _lowered(bidders.bidder_budget(_history(odd)), "bidderemail")


add("mixed_case_seller_portfolio", f"SellerCode {_RATE}", "SELECT lower(SellerCode) AS SellerCode, AvgSTR, TotalAuctioned FROM seller_rate")(
    lambda wh: _lowered(history.seller_portfolio(_live(wh), _mixed(wh)["dim_seller"], P), "SellerCode"))
add("mixed_case_trustee_portfolio", f"TrusteeCode {_RATE}", "SELECT lower(TrusteeCode) AS TrusteeCode, AvgSTR, TotalAuctioned FROM trustee_rate")(
    lambda wh: _lowered(history.trustee_portfolio(_recent_trustee(wh), _mixed(wh)["dim_trustee"], P), "TrusteeCode"))
add("mixed_case_zip_sell_through", f"PropertyState PropertyZip {_RATE}",
    "SELECT lower(PropertyState) AS PropertyState, PropertyZip, AvgSTR, TotalAuctioned FROM zip_rate")(
    lambda wh: _lowered(history.zip_sell_through(_live(wh), _mixed(wh)["dim_property"], P), "PropertyState"))
add("mixed_case_bidder_budget", "bidderemail AssetsBidUpon:i AvgMaxBid:7 AvgWinRate:6 FallOutRate:6 AvgReserve:7 AvgBPO:7",
    "SELECT lower(bidderemail) AS bidderemail, AssetsBidUpon, AvgMaxBid, AvgWinRate, FallOutRate, AvgReserve, AvgBPO FROM budget")(_mixed_budget)

# ---- whole jobs ------------------------------------------------------------------------------------


def _published_job(wh):
    root = f"{shared_dir(wh.spark)}/job-{uuid.uuid4().hex}"
    jobs.publish_predictions(wh, _coefficients(wh), _lookup(wh), P, root, 1)
    return commits.read_current(wh.spark, root)


add("job_publish_predictions", f"{K} MostRecentData:i AuctionDaySalePrediction:7 Negative1", "current_table")(_published_job)


def _training_job(wh):
    """Files of the training job, with outside estimates, acceptance models and a second population: every listing that is scored, and how
    many of the rules for published figures it breaks."""
    folder = _folder(wh)
    accepted = wh.spark.sql(tt.ACCEPTANCE_MODELS.replace("FROM region", "FROM {region}"), region=wh["region"])
    second = impute.second_population(upcoming_rows(wh), ["Reserve"])
    jobs.train_and_write(training(wh), train.REO, P, folder, _reo_estimates(wh), second, accepted)
    broken = [*_broken_rules(train.REO, explain.SECOND_POPULATION_FAULT_NAMES),
              F.coalesce(~number(F.col("AcceptancePrediction")).between(0, 1), F.lit(False)).cast("int")]
    # a listing without one of a model's facts has no prediction; the main file holds complete listings alone, whose short form leaves the facts out
    facts = sorted({f for t in (*train.REO.terms, *train.REO.price_terms) for f in t.split(TIMES)})
    parts = []
    for name in ("short", "second"):
        rows = wh.spark.read.option("header", True).option("nullValue", "NA").csv(f"{folder}/{name}")
        unknown = reduce(or_, [number(F.col(f)).isNull() for f in facts]) if name == "second" else F.lit(False)
        total = sum((*broken, (number(F.col("HighBidPrediction")).isNull() != unknown).cast("int")), F.lit(0))
        parts.append(rows.groupBy(F.lit(name).alias("Output")).agg(F.countDistinct("GlobalPropertyId", "AuctionId", "VenueId").alias("Listings"), F.count("*").alias("Rows"),
                                                                    F.sum(total).alias("Broken")))
    models_ = wh.spark.read.parquet(f"{folder}/coefficients").select(F.concat("model", F.lit(" "), "status").alias("Output"), "PropertyState").distinct()
    fits = models_.groupBy("Output").agg(F.lit(0).alias("Listings"), F.count("*").alias("Rows"), F.lit(0).alias("Broken"))
    return parts[0].unionByName(parts[1]).unionByName(fits)


_JOB_MODELS = ("IsSold", "TrueSold", "AuctionReserveSuccess", "high_bid", "valuation")
add("job_train_and_write", "Output Listings:i Rows:i Broken:i", f"""
  SELECT 'short' AS Output, count(*) AS Listings, count(*) AS Rows, 0 AS Broken FROM ({_scored_listings("prepared", models.REQUIRED)}) t
  UNION ALL SELECT 'second', count(*), count(*), 0 FROM feature_scoring
  WHERE Reserve IS NOT NULL AND PropertyState IN (SELECT PropertyState FROM prepared)
  """ + " ".join(f"UNION ALL SELECT '{m} converged', 0, count(DISTINCT PropertyState), 0 FROM prepared" for m in _JOB_MODELS))(_training_job)
