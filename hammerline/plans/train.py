"""Fit per-state models on past listings, score the hold-out and upcoming ones, and explain them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hammerline.functions.scoring import linear, logistic, term_sql
from hammerline.operators import explain, features as fx, impute, models, scoring
from hammerline.params import Params
from hammerline.session import settle

# Columns of the short outputs.
_HEAD = (
    "REDCID", "LoanNbr", "ValueLevel", "ProductType", "PropertyType", "AuctionCode", "GlobalPropertyId", "AuctionId",
    "VenueId", "AuctionDate", "PredictionDate",
)
_PLACE = (
    "PropertyCity", "PropertyCounty", "PropertyState", "PropertyZip", "MSAName", "PropertyOccupancyStatus", "Condition",
    "Bedrooms", "Baths", "LotSize", "HomeSquareFootage", "RunNum", "BPO",
)
SHORT_OUTPUT = (
    *_HEAD, "SellerCode", "SellerName", *_PLACE, "StartingBid", "Reserve", "HighBid", "BPOSurplus", "ALRRegistrants",
    "TotalRegistrantScore", "IntrinsicBidderQuality", "Appreciation", "Turnover", "ExternalEstimate", "Favorites",
    "IsPredictedBPO", "IsSubjectToApproval", "IsSold", "TrueSold", "AuctionReserveSuccess", "Neg1", "Neg2",
)
TRUSTEE_SHORT_OUTPUT = (
    *_HEAD, "TrusteeCode", "TrusteeName", *_PLACE, "OpeningBid", "Reserve", "HighBid", "BPOSurplus", "Appreciation",
    "Turnover", "ExternalEstimate", "Favorites", "IsPredictedBPO", "IsSold", "WinningBid", "Neg1", "Neg2",
)


@dataclass(frozen=True)
class Line:
    """What differs between the three product lines."""

    labels: dict[str, str]            # label -> prediction column
    sale: str                         # label whose coefficients explain a listing
    terms: tuple[str, ...]
    required: tuple[str, ...]
    opening: str
    short: tuple[str, ...]
    price_terms: tuple[str, ...] | None
    reserve_parts: int | None         # None: no reserve yet, valuations stay as they are
    names: dict[str, str]
    trustee: bool = False


REO = Line(
    {"IsSold": "AuctionDaySalePrediction", "TrueSold": "SellerAcceptedSalePrediction",
     "AuctionReserveSuccess": "ExceedReservePrediction"},
    "IsSold", models.SALE_FIT, models.REQUIRED, "StartingBid", SHORT_OUTPUT, models.PRICE_FIT, 10, explain.FAULT_NAMES)
PRE_RESERVE = Line(
    REO.labels, "IsSold", models.PRE_RESERVE_FIT, models.PRE_RESERVE_REQUIRED, "StartingBid", SHORT_OUTPUT, None, None,
    explain.PRE_RESERVE_FAULT_NAMES)
TRUSTEE = Line(
    {"IsSold": "ThirdPartySalePrediction", "IsPostponed": "PostponePrediction", "IsCancelled": "CancelPrediction"},
    "IsSold", models.TRUSTEE_FIT, models.TRUSTEE_REQUIRED, "OpeningBid", TRUSTEE_SHORT_OUTPUT, models.TRUSTEE_PRICE_FIT, 5,
    explain.TRUSTEE_FAULT_NAMES, trustee=True)


@dataclass(frozen=True)
class Fitted:
    full: DataFrame                    # every scored listing with all its columns
    short: DataFrame
    coefficients: DataFrame            # (PropertyState, model, term, value, status, passes, penalty): how each fit ended
    second: DataFrame | None = None    # the second population, scored by the same models


def prepare(rows: DataFrame, line: Line, p: Params, estimates: DataFrame | None = None) -> DataFrame:
    """Clean and fill the feature extract: horizon, numbers, market metrics, outside estimates, labels."""
    numeric = [*impute.FILLED, "Reserve", "BPO", "BPOSurplusPct", "TotalActive", "Vacancy", "HighBid", line.opening]
    names = ("TrusteeName" if line.trustee else "SellerName", "PropertyCity")
    df = impute.clean(rows, p, numeric, names)
    df = impute.hierarchical_fill(settle(df))
    if estimates is not None:
        df = impute.with_external_estimates(df, estimates)
    else:
        df = df.withColumns({"ExternalEstimate": F.lit(0.0), "BPOSurplus": F.col("BPO") - F.col("Reserve"),
                             "IsPredictedBPO": F.when(F.col("BPO").isNull(), 1).otherwise(0)})
    if line.trustee:
        df = df.withColumn("HighBid", F.coalesce("HighBid", F.col("WinningBid").cast("double")))
    else:
        df = impute.quality_flags(df).withColumn("IsSubjectToApproval", F.coalesce("IsSubjectToApproval", F.lit(0)))
    floor = p.min_trustee_state_rows if line.trustee else p.min_state_rows
    return settle(impute.fitted_states(df, floor))


def predict(df: DataFrame, coefficients: DataFrame, model: str, terms: Sequence[str], out: str, link=lambda z: z,
            how: str = "inner") -> DataFrame:
    """Apply one model of a long coefficient table; listings of unfitted states drop out, or get NULL with ``how="left"``."""
    wide = scoring.coefficients_wide(coefficients.filter(F.col("model") == model), terms)
    one = settle(wide.select("PropertyState", F.struct("Intercept", *[F.col(f"`{t}`") for t in terms]).alias("_c")))
    z = F.expr(linear({t: term_sql(t) for t in terms}, "_c"))
    return df.join(one, "PropertyState", how).withColumn(out, link(z)).drop("_c")


def value_missing(df: DataFrame, line: Line, p: Params) -> tuple[DataFrame, DataFrame]:
    """Repair home facts, estimate missing valuations, and return the valuation coefficients with them."""
    value_model = settle(models.ols_per_state(models.valuation_training(df), models.VALUATION_FIT, "BPO"))
    repaired = impute.state_repair(df, national_postal=line.trustee)
    guessed = predict(repaired, value_model, "valuation", models.VALUATION_FIT, "_guess", how="left")
    blended = impute.blend_valuation(settle(guessed), p, "_guess", line.opening, line.reserve_parts).drop("_guess")
    return blended.withColumn("MedianPPSQFTDeviation", fx.ppsf_deviation(
        F.col("MedianPPSQFT"), F.col("Reserve"), F.col("HomeSquareFootage"))), value_model


def balanced(train: DataFrame, line: Line) -> DataFrame:
    """Give every state both classes of each label that may lack one."""
    if not line.trustee:
        # the listing that came closest to its reserve from below succeeds, or the one that exceeded it least fails
        return models.two_class(train, "AuctionReserveSuccess", models.shortfall(), -models.shortfall())
    for label, by in (("IsPostponed", "Postponements"), ("IsCancelled", "Cancellations")):
        train = models.two_class(train, label, -F.col(by), F.col(by))
    return train


def fit_and_score(rows: DataFrame, line: Line, p: Params, estimates: DataFrame | None = None,
                  second: DataFrame | None = None, accepted: DataFrame | None = None) -> Fitted:
    """Fit, score and explain one product line.

    ``second`` is a separately delivered population that the same models score. ``accepted`` holds the sellers' acceptance models
    (see ``scoring.acceptance``); with it, outputs of lines with a price model have ``AcceptancePrediction``.
    """
    df = prepare(rows, line, p, estimates)
    if line.reserve_parts:
        df, fits = value_missing(df, line, p)
    else:
        df, fits = impute.state_repair(df), None
    df = settle(df)
    train, test = impute.split(df, p, line.required)
    if line.trustee:
        test = test.filter(F.col("IsAuction") == 1)

    sale = settle(models.ridge_logistic_fits(balanced(train, line), line.terms, list(line.labels)))
    parts = [sale.select("PropertyState", "model", "term", "value", "status", "passes", "penalty")] + ([fits] if fits is not None else [])
    price = None
    if line.price_terms:
        bids = train.filter(F.col("HighBid").isNotNull())
        bids = bids.filter(F.col("IsAuction") == 1) if line.trustee else bids
        price = settle(models.elastic_net_price(bids, line.price_terms, "HighBid"))
        parts.append(price)
    coefficients = parts[0]
    for part in parts[1:]:
        coefficients = coefficients.unionByName(part.withColumn("status", F.lit(models.CONVERGED)), allowMissingColumns=True)

    weights = sale.filter(F.col("model") == line.sale).select("PropertyState", "term", "value")
    if price is not None:
        chosen = explain.chosen_weights(weights, price.drop("model"), models.PRICE_ONLY)
    else:
        chosen = weights.filter(F.col("term") != "Intercept").withColumnRenamed("value", "weight")
    centres = explain.state_centres(test, line.terms)

    def score(population: DataFrame, masked: Sequence[str], names: dict[str, str]) -> DataFrame:
        out = population
        for label, name in line.labels.items():
            out = predict(out, sale, label, line.terms, name, logistic)
        if price is not None:
            out = predict(out, price, "high_bid", line.price_terms, "HighBidPrediction")
        out = explain.centred_faults(out, chosen, line.terms, centres, masked, names)
        out = _rules(out, line, p)
        return out if accepted is None or price is None else scoring.acceptance(out, accepted, "HighBidPrediction")

    full = settle(score(test, explain.MASKED, line.names))
    short = full.select(*line.short, *line.labels.values(),
                        *[c for c in ("HighBidPrediction", "ReserveRedux", "AcceptancePrediction") if c in full.columns], "SaleLikelihood")
    other = None
    if second is not None:
        filled = impute.second_population_fill(second)
        if not line.trustee:
            filled = impute.quality_flags(filled).withColumn(
                "IsSubjectToApproval", F.coalesce("IsSubjectToApproval", F.lit(0)))
        other = score(filled, (*explain.MASKED, "IsSubjectToApproval"), explain.SECOND_POPULATION_FAULT_NAMES)
    return Fitted(full, short, coefficients, other)


def _rules(df: DataFrame, line: Line, p: Params) -> DataFrame:
    """Probability order, price cap and floor, reserve reduction, band and run date."""
    out = df if line.trustee else scoring.order_probabilities(df)
    chance: Column = F.col(line.labels[line.sale])
    out = out.withColumns({
        "ValueLevel": fx.value_level_name(), "PredictionDate": F.lit(p.as_of),
        "SaleLikelihood": scoring.likelihood_band(chance),
    })
    if "HighBidPrediction" not in out.columns:
        return out
    out = out.withColumn("HighBidPrediction", scoring.cap_price(F.col("HighBidPrediction"), F.col("Reserve")))
    out = out.withColumn("ReserveRedux", scoring.reserve_reduction(chance, F.col("HighBidPrediction"), F.col("Reserve")))
    return scoring.floor_price(scoring.fill_opening(settle(out), line.opening), "HighBidPrediction", line.opening)
