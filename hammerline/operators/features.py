"""The derived columns of a listing: flags, reserve and valuation chains, outcomes and market metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hammerline.functions.columns import first_positive, flag, like_any, ratio, same_key, same_text
from hammerline.functions.ranking import ntile
from hammerline.params import LISTING_KEY, Params
from hammerline.session import settle

# Output metric -> column stem of the zip, county, state and national levels.
MARKET_METRICS = {
    "Appreciation": ("Appreciation", "Appreciation"),
    "Turnover": ("Turnover", "Turnover"),
    "TotalHomesForSale": ("TotalHomesForSale", "TotalHomesForSale"),
    "PercentHomesSold": ("PercentHomesSold_12moTrailing", "PercentHomesSold_12moTrailing"),
    "MedianPPSQFT": ("MedianPPSQFT", "MedianPPSQFT"),
    "ForeclosedPer10000": ("ForeclosedHomesPer10000", "ForeclosedHomesPer10000"),
    "PrevForeclosureSoldRate": ("PercentSoldHomesPrevForeclosures_12moTrailing", "PrevForeclosureSold"),
}
TILE_ORDER = ("Reserve", *LISTING_KEY)


# ---- property flags -------------------------------------------------------------------------

def condition_text(condition: Column, null_is_unknown: bool) -> Column:
    unknown = same_text(condition, "", "N/A")
    if null_is_unknown:
        unknown = unknown | condition.isNull()
    return F.when(unknown, "unknown").otherwise(condition)


def property_flags(prefix: str = "") -> dict[str, Column]:
    """0/1 columns read off a property's type, product line, condition and occupancy."""
    c = lambda name: F.col(f"{prefix}{name}")
    kind, line, state, use = c("PropertyType"), c("ProductType"), c("Condition"), c("PropertyOccupancyStatus")
    return {
        "SFR_Flag": flag(like_any(kind, ("SF%", "Single%", "%Town%"))),
        "MultiResidence_Flag": flag(like_any(kind, ("%Condo%", "%plex%"))),
        "C2C_Flag": flag(line.ilike("%C2C%")),
        "REO_Flag": flag(line.ilike("%REO%")),
        "ShortSale_Flag": flag(line.ilike("%Short Sale%")),
        "Trustee_Flag": flag(line.ilike("%Trustee%")),
        "Condition_poor": flag(same_text(state, "poor")),
        "Condition_fair": flag(same_text(state, "fair")),
        "Condition_average": flag(same_text(state, "average")),
        "Condition_good": flag(same_text(state, "good", "excellent")),
        "Condition_unknown": flag(same_text(state, "", "N/A")),
        "PropertyOccupancyStatus_Occupied": flag(same_text(use, "Occupied")),
        "PropertyOccupancyStatus_Unknown": flag(same_text(use, "", "N/A")),
        "PropertyOccupancyStatus_Vacant": flag(same_text(use, "Vacant")),
    }


def financing_flag(column: Column) -> Column:
    return flag(same_text(column, "203k", "Yes"))


def deed_flags(deed: Column) -> dict[str, Column]:
    return {
        "FullWarrantyDeed": flag(same_text(deed, "Full Warranty")),
        "SpecialWarrantyDeed": flag(same_text(deed, "Special Warranty")),
        "QuitClaimDeed": flag(same_text(deed, "Quit Claim")),
    }


# ---- reserve and valuation ------------------------------------------------------------------

def _reserve_sources(fa: str, fr: str) -> list[Column]:
    return [
        F.col(f"{fa}AuctionSellerReserve"), F.col(f"{fr}AuctionSellerReserve"),
        F.col(f"{fa}Reserve"), F.col(f"{fa}LenderReserve"), F.col(f"{fa}UpdatedReserve"),
    ]


def reserve(fa: str = "fa.", fr: str = "fr.") -> Column:
    return F.coalesce(*_reserve_sources(fa, fr))


def positive_reserve(fa: str = "fa.", fr: str = "fr.") -> Column:
    return first_positive(_reserve_sources(fa, fr))


def valuation(p: Params, fa: str = "fa.", fr: str = "fr.", dp: str = "dp.", parent: str = "SellerParent") -> Column:
    """First usable value estimate, from the most to the least trusted source."""
    a, r, d = (lambda n: F.col(f"{fa}{n}")), (lambda n: F.col(f"{fr}{n}")), (lambda n: F.col(f"{dp}{n}"))
    appraisal = a("AprAsIs")
    absurd = (appraisal > 4 * reserve(fa, fr)) & (appraisal > 10_000_000)
    owner_order = F.coalesce(a("TotalOwed"), a("PropertyFeature6"), a("SellerBPOValue"), d("SellerBPOValue"))
    return F.coalesce(
        F.when(d("ProductType").ilike("%C2C%"), F.coalesce(appraisal, r("AprAsIs"))),
        F.when(same_text(F.col(parent), p.own_order_parent), owner_order),
        r("BPO"), a("Agent90AsIs"), a("AgentValue"), a("PropertyFeature6"), a("GrcValue"),
        F.when(absurd, None).otherwise(appraisal),
        F.when(d("SellerBPOValue") >= 10, d("SellerBPOValue")),
    )


def trustee_reserve(c: str = "") -> Column:
    col = lambda name: F.col(f"{c}{name}")
    owed = col("TotalEstDebtorNOSAmount")
    return F.coalesce(
        col("AuctionSellerReserve"), col("MaximumCreditBidAmnt"), col("BeneficiaryAmount"),
        F.when(same_text(col("CreditBidType"), "Total Debt"), owed), owed,
    )


def trustee_valuation(c: str = "") -> Column:
    value = F.coalesce(*[F.col(f"{c}{n}") for n in ("BPO", "InitialAVMValue", "IVG")])
    return F.when(value < 10, None).otherwise(value)


# ---- outcomes -------------------------------------------------------------------------------

def attempts_sign(total: Column) -> Column:
    """-1, 0 or 1: whether a listing had earlier attempts (a run number of 0 gives -1)."""
    return F.signum((total - 1).cast("double")).cast("int")


def truly_sold(reserve_met: Column, is_sold: Column, subject_to: Column, accepted: Column) -> Column:
    return flag((reserve_met == 1) | ((is_sold == 1) & (subject_to == 1) & (accepted == 1)))


# ---- market metrics -------------------------------------------------------------------------

def market_levels(prefix: str = "") -> dict[str, Column]:
    """Each metric at the finest level that has it: zip, county, state, nation."""
    out = {}
    for name, (zip_stem, wide_stem) in MARKET_METRICS.items():
        wider = [F.col(f"{prefix}{level}{wide_stem}") for level in ("County", "State", "National")]
        out[name] = F.coalesce(F.col(f"{prefix}{zip_stem}"), *wider)
    return out


def join_market(df: DataFrame, market: DataFrame, postal: DataFrame, since: Column | None = None) -> DataFrame:
    """Monthly market metrics and postal vacancy as of each listing's month.

    ``df`` carries PropertyZip, MarketMonth and PostalMonth; every other column passes through. With ``since``, a day before which
    no listing lies, the scans read that month's metrics and later ones only: whole partitions of tables that are partitioned by month.
    """
    if since is not None:
        market = market.filter(F.col("Date") >= F.trunc(since, "MM"))
        postal = postal.filter(F.col("Date") >= F.year(since) * 100 + F.month(since))
    levels = market.select("PropertyZip", F.col("Date").alias("MarketMonth"),
                           *[c.alias(n) for n, c in market_levels().items()])
    vacancy = postal.select(F.col("ZIP").alias("PropertyZip"), F.col("Date").alias("PostalMonth"),
                            F.col("Active").alias("TotalActive"), "Vacancy")
    return (
        df.join(levels, ["PropertyZip", "MarketMonth"], "left")
        .join(vacancy, ["PropertyZip", "PostalMonth"], "left")
    )


def ppsf_deviation(ppsf: Column, reserve_: Column, square_feet: Column) -> Column:
    return ppsf - ratio(reserve_, square_feet)


def with_state_mean(df: DataFrame, column: str, out: str, state: str = "PropertyState") -> DataFrame:
    """Attach a state's mean from a grouped average; no window gathers a state in one task."""
    means = settle(df.groupBy(state).agg(F.avg(column).alias(out)))
    return df.alias("d").join(means.alias("m"), same_key("d", "m", [state]), "left").select("d.*", f"m.{out}")


# ---- columns that depend on the rest of the listings ----------------------------------------

def value_levels(df: DataFrame, state: str = "PropertyState", order: tuple[str, ...] = TILE_ORDER) -> DataFrame:
    """Price tercile inside the state as three 0/1 columns; ties go by listing key."""
    tiled = ntile(df, state, list(order), 3, "_tile")
    names = {"ValueLevel_Low": 1, "ValueLevel_Med": 2, "ValueLevel_High": 3}
    return tiled.withColumns({n: flag(F.col("_tile") == t) for n, t in names.items()}).drop("_tile")


def value_level_name() -> Column:
    return F.when(F.col("ValueLevel_Low") == 1, "Low").when(F.col("ValueLevel_Med") == 1, "Med").otherwise("High")


def event_sizes(df: DataFrame, state: str = "PropertyState") -> DataFrame:
    """Listings per event and per event and state, from one small count table.

    The window runs over that table, where an event has one row per state.
    """
    key = ["AuctionCode", state]
    sizes = settle(
        df.groupBy(*key).agg(F.count("AuctionCode").alias("StateEventSize"))
        .withColumn("EventSize", F.sum("StateEventSize").over(Window.partitionBy("AuctionCode")))
    )
    return (
        df.alias("d").join(sizes.alias("e"), same_key("d", "e", key), "left")
        .select("d.*", "e.EventSize", "e.StateEventSize")
    )
