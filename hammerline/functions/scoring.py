"""Score expressions generated from a term list: sum of coefficient times input, with or without a link."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from hammerline.params import Params

# The scored terms of each model family.
CONDITIONS = ("Condition_poor", "Condition_fair", "Condition_average", "Condition_good", "Condition_unknown")
OCCUPANCY = (
    "PropertyOccupancyStatus_Occupied", "PropertyOccupancyStatus_Unknown", "PropertyOccupancyStatus_Vacant",
)
LEVELS = ("ValueLevel_Low", "ValueLevel_Med", "ValueLevel_High")
SALE_TERMS = (
    "Historical_Execution", "Appreciation", "BPOSurplus", "BPOSurplusPct", "C2C_Flag", *CONDITIONS,
    "FinancingAvailable", "ForeclosedPer10000", "FullWarrantyDeed", "HasPrevAttempts", "IsSubjectToApproval",
    "MedianPPSQFT", "MedianPPSQFTDeviation", "MultiResidence_Flag", "PrevForeclosureSoldRate", *OCCUPANCY,
    "QuitClaimDeed", "REO_Flag", "Reserve", "RunNum", "SellerPortfolioQuality", "SFR_Flag", "ShortSale_Flag",
    "SpecialWarrantyDeed", "TotalActive", "Vacancy", *LEVELS,
)
PRICE_TERMS = (*SALE_TERMS, "IntrinsicBidderQuality")
TRUSTEE_TERMS = (
    "Historical_Execution", "Appreciation", "BPOSurplus", "BPOSurplusPct", "C2C_Flag", "Cancellations", *CONDITIONS,
    "Favorites", "ForeclosedPer10000", "HasPrevAttempts", "MedianPPSQFT", "MedianPPSQFTDeviation",
    "MultiResidence_Flag", "PercentHomesSold", "Postponements", "PrevForeclosureSoldRate", *OCCUPANCY, "REO_Flag",
    "Reserve", "RunNum", "SellerPortfolioQuality", "SFR_Flag", "ShortSale_Flag", "TotalActive", "Vacancy", *LEVELS,
)
TRUSTEE_PRICE_TERMS = ("BPO", "Trustee_Flag", *[t for t in TRUSTEE_TERMS if t != "Reserve"])
TIMES = "_x_"  # joins the two factors of an interaction term
VALUATION_TERMS = (
    "Age", "Baths", "Bedrooms", *CONDITIONS, "HomeSquareFootage",
    *[f"HomeSquareFootage{TIMES}{c}" for c in CONDITIONS], f"HomeSquareFootage{TIMES}MedianPPSQFT",
    "MultiResidence_Flag", "SFR_Flag",
)


@dataclass(frozen=True)
class Model:
    name: str                    # key of its coefficient table
    output: str                  # column it produces
    terms: tuple[str, ...]
    logistic: bool = True
    literal_bound: bool = False  # keeps the written 0.15 even when parameters are rounded
    literal_share: bool = False  # keeps the written 0.2 even when parameters are rounded


NONTRUSTEE_MODELS = (
    Model("auction_day_sale", "AuctionDaySalePrediction", SALE_TERMS, literal_share=True),
    Model("seller_accepted_sale", "SellerAcceptedSalePrediction", SALE_TERMS),
    Model("exceed_reserve", "ExceedReservePrediction", SALE_TERMS),
    Model("high_bid", "RecommendedMaxReservePrice", PRICE_TERMS, logistic=False),
)
VALUATION_MODEL = Model("valuation", "BPO_Estimate", VALUATION_TERMS, logistic=False)
TRUSTEE_MODELS = (
    Model("cancellation", "CancellationPrediction", TRUSTEE_TERMS, literal_bound=True),
    Model("postponement", "PostponementPrediction", TRUSTEE_TERMS, literal_bound=True),
    Model("sale_if_auctioned", "ThirdPartySaleIfAuctionedPrediction", TRUSTEE_TERMS),
    Model("sale_overall", "ThirdPartySaleOverallPrediction", TRUSTEE_TERMS),
    Model("trustee_high_bid", "RecommendedMaxReservePrice", TRUSTEE_PRICE_TERMS, logistic=False),
)


def _unusable(bound: float) -> str:
    return f"(BPO < {bound!r}D * Reserve OR BPO IS NULL)"


def functional_valuation(p: Params, bound: float) -> Column:
    """The valuation, or a fixed multiple of the reserve when it is missing or absurdly low."""
    return F.expr(f"CASE WHEN {_unusable(bound)} THEN {p.number('valuation_ratio')!r}D * Reserve ELSE BPO END")


def term_sql(term: str) -> str:
    """A term as SQL: its own column, or the product of an interaction's two factors."""
    return " * ".join(f"`{factor}`" for factor in term.split(TIMES))


def term_value(term: str) -> Column:
    return F.expr(term_sql(term))


def scoring_input(term: str, p: Params, model: Model) -> str:
    """The value a term takes at scoring time, with its default where the listing lacks one."""
    bound = p.absurd_valuation_bound if model.literal_bound else p.number("absurd_valuation_bound")
    share = p.surplus_share_default if model.literal_share else p.number("surplus_share_default")
    if term in ("BPO", "BPOSurplus"):
        return f"CASE WHEN {_unusable(bound)} THEN {p.number('valuation_ratio')!r}D * Reserve ELSE {term} END"
    if term == "BPOSurplusPct":
        return f"CASE WHEN {_unusable(bound)} THEN {share!r}D ELSE {term} END"
    if term == "TotalActive":
        return f"coalesce({term}, {p.population_default!r}D)"
    if term == "Vacancy":
        rate = f"coalesce({term}, {p.number('vacancy_default')!r}D)"
        return f"round({rate})" if p.legacy_decimal else rate
    return term_sql(term)


def linear(inputs: dict[str, str], coefficients: str) -> str:
    """Intercept plus the weighted terms; NULL as soon as one term is NULL."""
    parts = [f"({value}) * {coefficients}.`{term}`" for term, value in inputs.items()]
    return " + ".join([f"{coefficients}.`Intercept`", *parts])


def logistic(z: Column) -> Column:
    return 1 / (1 + F.exp(-z))


def score(model: Model, p: Params, coefficients: str) -> Column:
    """One flat expression per model, parsed once, over the struct column ``coefficients``."""
    z = F.expr(linear({t: scoring_input(t, p, model) for t in model.terms}, coefficients))
    return (logistic(z) if model.logistic else z).alias(model.output)


def at_least(value: str | Column, floor: str | Column) -> Column:
    """Raise to the floor; a NULL on either side leaves the value as it is."""
    value = F.col(value) if isinstance(value, str) else value
    floor = F.col(floor) if isinstance(floor, str) else floor
    return F.when(value < floor, floor).otherwise(value)
