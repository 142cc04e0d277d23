"""What holds a listing back: weighted contributions and the two most negative ones."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hammerline.functions.columns import ratio, same_key
from hammerline.functions.ranking import two_smallest
from hammerline.functions.scoring import SALE_TERMS, TRUSTEE_TERMS
from hammerline.operators.scoring import single
from hammerline.params import LISTING_KEY, Params
from hammerline.session import settle

# Variables that can carry a weight; any other name counts as the middle value level.
VARIABLES = (*SALE_TERMS, "Turnover")
TRUSTEE_VARIABLES = (*TRUSTEE_TERMS, "Trustee_Flag", "Turnover")
OTHER = "ValueLevel_Med"
NO_FAULT = "Cannot Suggest Fault"

# Text shown for each variable.
FAULT_NAMES = {
    "SFR_Flag": "Single Family Home in MultiFamily Preferred Region",
    "MultiResidence_Flag": "Multiple Unit Home in Single Preferred Region",
    "C2C_Flag": "Product Line Performs Poorly in This State",
    "REO_Flag": "Product Line Performs Poorly in This State",
    "ShortSale_Flag": "Product Line Performs Poorly in This State",
    "Trustee_Flag": "Product Line Performs Poorly in This State",
    "RunNum": "Property Has Many Attempts at Auction",
    "HasPrevAttempts": "Property Has Previous Attempts at Auction",
    "Reserve": "Reserve out of Line with Area",
    "BPOSurplus": "Low Dollar Valuation Against Purchase Price Dampening Interest",
    "BPOSurplusPct": "Low Appraised Value as Share of Purchase Price Dampening Interest",
    "Condition_poor": "Condition Suggests Expensive Refurbishment",
    "Condition_fair": "Condition Suggests Expensive Rehab",
    "Condition_average": "Condition Suggests Low Investment Potential",
    "Condition_good": "Condition Suggests Low Investment Potential",
    "Condition_unknown": "Condition Information Unknown",
    "PropertyOccupancyStatus_Occupied": "Occupied Properties Generally Harder to Resell",
    "PropertyOccupancyStatus_Unknown": "Occupancy Status Unknown",
    "PropertyOccupancyStatus_Vacant": "Vacancy Suggests Potential Condition Problems in This Region",
    "FinancingAvailable": "Financing Incentive Suggests Expensive Rehab",
    "TotalActive": "Low Population in ZIP",
    "Vacancy": "High Vacancy in ZIP",
    "ValueLevel_Low": "Low Value Property Suggests Limited ROI",
    "ValueLevel_Med": "Medium Value Property Suggests Limited ROI",
    "ValueLevel_High": "High Value Property Suggests Little Room for Added Value",
    "Favorites": "Web Traffic Pattern Indicates Interest from Bargain Buyers",
    "Appreciation": "Price Movement in ZIP Suggests Poor Returns on Investment",
    "Turnover": "Low Turnover in ZIP Suggests Difficult Resale",
    "MedianPPSQFT": "Low Value Area",
    "MedianPPSQFTDeviation": "Property Expensive per SQFT Versus ZIP",
    "ForeclosedPer10000": "ZIP has high incidence of foreclosure",
    "PrevForeclosureSoldRate": "Statistically Few Foreclosures are resold in ZIP",
    "IsSubjectToApproval": "Seller Likely to Insist on Full Reserve Price",
    "FullWarrantyDeed": "Full Warranty Deed In Distressed-Deed Preferred Market",
    "SpecialWarrantyDeed": "Special Warranty Deed Suggests Moderate Risk for Investors",
    "QuitClaimDeed": "Quit Claim Deed Suggests High Risk",
    "PercentHomesSold": "ZIP has low percentage sales rate",
    "Historical_Execution": "ZIP has low historical Sell Through Rate",
    "SellerPortfolioQuality": "Seller Portfolio Historically Low-Quality Assets",
    "Cancellations": "Asset's Cancellations Imply Low Performance",
    "Postponements": "Asset's Postponements Imply Low Performance",
}
# Text that differs for trustee listings and before a reserve is known.
TRUSTEE_FAULT_NAMES = FAULT_NAMES | {
    "C2C_Flag": "C2C Product Line Performs Poorly in This State",
    "REO_Flag": "REO Product Line Performs Poorly in This State",
    "ShortSale_Flag": "Short Sale Product Line Performs Poorly in This State",
    "Trustee_Flag": "Trustee Product Line Performs Poorly in This State",
    "HasPrevAttempts": "Property Has Any Previous Attempts at Auction",
    "Reserve": "Reserve out of Line with Area / BPO Too Low",
    "BPOSurplus": "Low Dollar Valuation Against Purchase Price",
    "BPOSurplusPct": "Low Appraised Value as Share of Purchase Price",
    "PropertyOccupancyStatus_Occupied": "Occupied Homes in This Region Associated with Low Performance",
    "PropertyOccupancyStatus_Vacant": "Vacant Homes in This Region Associated with Low Performance",
    "PercentHomesSold": "Few Homes Sold in Retail Market for this Region",
}
PRE_RESERVE_FAULT_NAMES = FAULT_NAMES | {"MedianPPSQFT": "Low Priced Area"}
SECOND_POPULATION_FAULT_NAMES = FAULT_NAMES | {
    "IsSubjectToApproval": "Seller Unlikely to Soften Reserve to Secure a Trade",
}
# Never suggested by the centred form.
MASKED = ("SFR_Flag", "MultiResidence_Flag", "C2C_Flag", "REO_Flag", "ShortSale_Flag", "Trustee_Flag", "Reserve")


def explained_value(variable: str, p: Params, literal_ratio: bool) -> Column:
    """What a variable contributes before weighting; a missing valuation is taken off the reserve."""
    share = p.valuation_ratio if literal_ratio else p.number("valuation_ratio")
    surplus = F.coalesce(F.col("BPO"), share * F.col("Reserve")) - F.col("Reserve")
    if variable == "BPOSurplus":
        return surplus
    if variable == "BPOSurplusPct":
        return ratio(surplus, F.col("Reserve"))
    return F.col(variable)


def weights_by_state(lookup: DataFrame, variables: Sequence[str]) -> DataFrame:
    """The lookup (one row per state and variable) as one short array per state, with value positions."""
    place = F.array_position(F.array(*[F.lit(v) for v in variables]), F.col("PropertyFaultVariable")).cast("int")
    other = variables.index(OTHER) + 1
    entry = F.struct(
        F.when(place > 0, place).otherwise(other).alias("place"),
        F.col("PropertyFaultVariable").alias("variable"),
        F.col("PropertyFaultName").alias("name"),
        F.col("Value").cast("double").alias("value"),
    )
    return settle(lookup.groupBy("PropertyState").agg(F.array_sort(F.collect_list(entry)).alias("_weights")))


def with_contributions(df: DataFrame, lookup: DataFrame, variables: Sequence[str], p: Params,
                       literal_ratio: bool = True) -> DataFrame:
    """Add ``_parts``: every weighted contribution of the row, computed inside the row."""
    values = F.array(*[explained_value(v, p, literal_ratio).cast("double") for v in variables])
    joined = df.join(weights_by_state(lookup, variables), "PropertyState").withColumn("_values", values)
    parts = F.transform("_weights", lambda w: F.struct(
        (w["value"] * F.element_at(F.col("_values"), w["place"])).alias("component"),
        w["variable"].alias("variable"), w["name"].alias("name"),
    ))
    return joined.withColumn("_parts", parts).drop("_weights", "_values")


def contributions(df: DataFrame, lookup: DataFrame, variables: Sequence[str], p: Params,
                  literal_ratio: bool = True, key: Sequence[str] = LISTING_KEY) -> DataFrame:
    """Long form: one row per listing and weighted variable of its state."""
    exploded = with_contributions(df, lookup, variables, p, literal_ratio).select(*key, F.explode("_parts").alias("c"))
    return exploded.select(
        *key, F.col("c.variable").alias("PropertyFaultVariable"), F.col("c.name").alias("PropertyFaultName"),
        F.col("c.component").alias("ComponentValue"),
    )


def top_two_faults(df: DataFrame, lookup: DataFrame, variables: Sequence[str], p: Params,
                   literal_ratio: bool = True, key: Sequence[str] | None = None) -> DataFrame:
    """Add Negative1 and Negative2; listings with fewer than two usable contributions drop out.

    The two are picked inside each row, so nothing is exploded or shuffled. With ``key`` (say, the
    property alone) listings sharing a key are ranked together: each row offers its two smallest and
    combinable minima pick among those.
    """
    def usable(part: Column) -> Column:
        return part["component"].isNotNull() & ~part["variable"].isin("Intercept", "Reserve")

    ranked = with_contributions(df, lookup, variables, p, literal_ratio).withColumn(
        "_parts", F.slice(F.array_sort(F.filter("_parts", usable)), 1, 2)
    )
    if key is None:
        return (
            ranked.filter(F.size("_parts") >= 2)
            .withColumns({"Negative1": F.col("_parts")[0]["name"], "Negative2": F.col("_parts")[1]["name"]})
            .drop("_parts")
        )
    # the listing key keeps equal contributions of different listings apart
    offers = ranked.select(*key, F.explode("_parts").alias("c"), *[F.col(k).alias(f"_{k}") for k in LISTING_KEY])
    item = F.struct("c.component", "c.variable", "c.name", *[f"_{k}" for k in LISTING_KEY])
    best = two_smallest(offers.select(*key, item.alias("item")), key, "item")
    return (
        ranked.drop("_parts").alias("d").join(best.alias("b"), same_key("d", "b", key))
        .select("d.*", F.col("b._first.name").alias("Negative1"), F.col("b._second.name").alias("Negative2"))
    )


# ---- the centred form -----------------------------------------------------------------------

def chosen_weights(sale: DataFrame, price: DataFrame, price_only: Sequence[str]) -> DataFrame:
    """Per (state, term): the sale coefficient, or a scaled price coefficient where it is zero.

    Inputs are (PropertyState, term, value); ``price_only`` terms are left out of the scaling.
    """
    kept = price.filter(~F.col("term").isin(*price_only))
    peak = kept.groupBy("PropertyState").agg(F.max(F.abs("value")).alias("_peak"))
    scaled = kept.join(peak, "PropertyState").select(
        "PropertyState", "term", ratio(F.col("value"), F.col("_peak")).alias("_scaled"))
    return (
        sale.filter(F.col("term") != "Intercept").join(scaled, ["PropertyState", "term"], "left")
        .select("PropertyState", "term",
                F.when(F.col("value") == 0, F.col("_scaled")).otherwise(F.col("value")).alias("weight"))
    )


def state_centres(df: DataFrame, terms: Sequence[str]) -> DataFrame:
    """Per state an array of term means, zero for columns that hold only 0 and 1."""
    def centre(term: str) -> Column:
        x = F.col(term).cast("double")
        return F.when(F.every((x == 0) | (x == 1)), 0.0).otherwise(F.avg(x))

    return settle(df.groupBy("PropertyState").agg(F.array(*[centre(t) for t in terms]).alias("_centres")))


def centred_faults(df: DataFrame, weights: DataFrame, terms: Sequence[str], centres: DataFrame | None = None,
                   masked: Sequence[str] = MASKED, names: Mapping[str, str] = FAULT_NAMES) -> DataFrame:
    """Add Neg1 and Neg2 from centred, weighted values; a tie or an empty row names no fault.

    ``centres`` from another population explains this one against that population's means.
    """
    centres = state_centres(df, terms) if centres is None else centres
    wide = settle(
        weights.groupBy("PropertyState").pivot("term", list(terms)).agg(single("weight"))
        .select("PropertyState", F.array(*[F.col(t) for t in terms]).alias("_w"))
    )
    parts = [
        F.struct(((F.col(t) - F.col("_centres")[i]) * F.col("_w")[i]).alias("part"), F.lit(names[t]).alias("name"))
        for i, t in enumerate(terms) if t not in masked
    ]
    ordered = F.array_sort(F.filter(F.array(*parts), lambda x: x["part"].isNotNull()))
    joined = (
        df.join(centres, "PropertyState", "left").join(wide, "PropertyState", "left")
        .withColumn("_low", F.slice(ordered, 1, 3))
    )
    low = lambda i: F.get(F.col("_low"), F.lit(i))
    alone = lambda i: low(i).isNotNull() & (low(i + 1).isNull() | (low(i)["part"] < low(i + 1)["part"]))
    return joined.withColumns({
        "Neg1": F.when(alone(0), low(0)["name"]).otherwise(NO_FAULT),
        "Neg2": F.when(alone(0) & alone(1), low(1)["name"]).otherwise(NO_FAULT),
    }).drop("_low", "_centres", "_w")
