"""Filling gaps: market metrics from wider areas, implausible home facts, and missing valuations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hammerline.functions.columns import all_present, number, ratio, same_key
from hammerline.functions.ranking import medians, quantiles
from hammerline.params import Params
from hammerline.session import settle, settle_all

# Metrics overwritten together, and whose gap decides.
FILLED = (
    "Turnover", "Appreciation", "MedianPPSQFT", "MedianPPSQFTDeviation", "ForeclosedPer10000",
    "PrevForeclosureSoldRate", "PercentHomesSold",
)
SECOND_FILLED = (
    "Turnover", "Appreciation", "MedianPPSQFT", "ForeclosedPer10000", "PrevForeclosureSoldRate",
    "PercentHomesSold", "TotalHomesForSale",
)
DECIDING = "Turnover"


def clean(df: DataFrame, p: Params, numeric: Sequence[str], names: Sequence[str] = ("SellerName", "PropertyCity"),
          date_col: str = "AuctionDate") -> DataFrame:
    """Training input: horizon, readable numbers, a reserve, plausible valuations, comma-free names."""
    out = df.filter(F.col(date_col) >= F.date_sub(F.lit(p.as_of), p.horizon_days))
    out = out.withColumns({c: number(F.col(c)) for c in numeric})
    out = out.filter(F.col("Reserve").isNotNull())
    absurd = (F.col("BPOSurplusPct") >= 5.0) | (F.col("BPOSurplusPct") < -0.9)
    out = out.withColumn("BPO", F.when(absurd, None).otherwise(F.col("BPO")))
    return out.withColumns({c: F.replace(F.col(c), F.lit(","), F.lit("")) for c in names})


def quality_flags(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "HasLikelyBidders": F.when(F.col("IntrinsicBidderQuality") >= 0.5, 1).otherwise(0),
        "HasWellMatchedBidders": F.when(F.col("TotalRegistrantScore") >= 0.5, 1).otherwise(0),
    })


def split(df: DataFrame, p: Params, required: Sequence[str], date_col: str = "AuctionDate") -> tuple[DataFrame, DataFrame]:
    """(training rows, scoring rows): complete cases before and from the hold-out date."""
    complete = df.filter(all_present(required))
    holdout = F.date_sub(F.lit(p.as_of), p.holdout_days)
    return complete.filter(F.col(date_col) < holdout), complete.filter(F.col(date_col) >= holdout)


def fitted_states(df: DataFrame, min_rows: int) -> DataFrame:
    """Rows of states with more than ``min_rows`` rows."""
    counts = settle(df.groupBy("PropertyState").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > min_rows))
    return df.join(counts.select("PropertyState"), "PropertyState", "left_semi")


# ---- market metrics -------------------------------------------------------------------------

def hierarchical_fill(df: DataFrame, metrics: Sequence[str] = FILLED, deciding: str = DECIDING) -> DataFrame:
    """Rows without the deciding metric take all metrics of their county, else state, else nation.

    County and state means come from one grouped pass, the national medians of all metrics from one exact
    distributed quantile.
    """
    tallies = [F.sum(m).alias(f"s_{m}") for m in metrics] + [F.count(m).alias(f"n_{m}") for m in metrics]
    county = settle(df.groupBy("PropertyState", "PropertyCounty").agg(*tallies))
    wider = [F.sum(f"{k}_{m}").alias(f"{k}_{m}") for m in metrics for k in "sn"]
    state = settle(county.groupBy("PropertyState").agg(*wider))

    def means(prefix: str) -> list[Column]:
        return [ratio(F.col(f"s_{m}"), F.col(f"n_{m}").cast("double")).alias(f"{prefix}{m}") for m in metrics]

    nation = national_medians(df, metrics)
    joined = (
        df.alias("d")
        .join(county.select("PropertyState", "PropertyCounty", *means("c_")).alias("c"),
              same_key("d", "c", ["PropertyState", "PropertyCounty"]), "left")
        .join(state.select("PropertyState", *means("t_")).alias("t"), same_key("d", "t", ["PropertyState"]), "left")
    )
    missing = F.col(f"d.{deciding}").isNull()
    filled = [
        F.when(~missing, F.col(f"d.{m}"))
        .when(F.col(f"c_{deciding}").isNotNull(), F.col(f"c_{m}"))
        .when(F.col(f"t_{deciding}").isNotNull(), F.col(f"t_{m}"))
        .otherwise(F.lit(nation[m]).cast("double")).alias(m)
        for m in metrics
    ]
    return joined.select(*[f"d.{c}" for c in df.columns if c not in metrics], *filled)


def national_medians(df: DataFrame, names: Sequence[str]) -> dict[str, float | None]:
    """One number a column; None where it has no value."""
    row = medians(df, [], {n: F.col(n) for n in names}).first()
    return {n: row[n] if row else None for n in names}


def second_population(df: DataFrame, numeric: Sequence[str]) -> DataFrame:
    """A separately delivered population: numbers read from text, rows without a reserve dropped."""
    return df.withColumns({c: number(F.col(c)) for c in numeric}).filter(F.col("Reserve").isNotNull())


def second_population_fill(df: DataFrame) -> DataFrame:
    """State means for missing market metrics and postal statistics; labels set to zero."""
    used = [*SECOND_FILLED, "TotalActive", "Vacancy"]
    state = settle(df.groupBy("PropertyState").agg(*[F.avg(m).alias(f"t_{m}") for m in used]))
    joined = df.alias("d").join(state.alias("t"), same_key("d", "t", ["PropertyState"]), "left")
    no_metrics = F.col("d.Turnover").isNull()
    homes = F.when(no_metrics, F.col("t_TotalHomesForSale")).otherwise(F.col("d.TotalHomesForSale"))
    no_postal = F.col("d.TotalActive").isNull()
    filled = {}
    for m in used:
        gap = no_postal if m in ("TotalActive", "Vacancy") else no_metrics
        if m in ("PercentHomesSold", "TotalHomesForSale"):
            gap = gap | homes.isNull()
        filled[m] = F.when(gap, F.col(f"t_{m}")).otherwise(F.col(f"d.{m}"))
    kept = [f"d.{c}" for c in df.columns if c not in (*used, "TrueSold", "HighBid")]
    return joined.select(*kept, *[c.alias(m) for m, c in filled.items()],
                         F.lit(0).alias("TrueSold"), F.lit(0.0).alias("HighBid"))


# ---- home facts -----------------------------------------------------------------------------

def state_repair(df: DataFrame, national_postal: bool = False) -> DataFrame:
    """Replace implausible or missing home facts and postal statistics by their state's usual value."""
    c = F.col
    middles = {
        "m_Age": F.when(c("Age") < 200, c("Age")),
        "m_Bedrooms": F.when(c("Bedrooms") > 0, c("Bedrooms")),
        "m_Baths": F.when(c("Baths") > 0, c("Baths")),
        "m_TotalActive": c("TotalActive"),
        "m_Vacancy": c("Vacancy"),
    }
    usual, feet = settle_all(
        medians(df, ["PropertyState"], middles),
        df.groupBy("PropertyState").agg(
            F.avg(F.when(c("HomeSquareFootage") >= 100, c("HomeSquareFootage"))).alias("m_feet")),
    )
    joined = (
        df.alias("d").join(usual.alias("u"), same_key("d", "u", ["PropertyState"]), "left")
        .join(feet.alias("f"), same_key("d", "f", ["PropertyState"]), "left")
    )
    nation = {"TotalActive": None, "Vacancy": None}
    if national_postal:
        nation = national_medians(df, list(nation))
    d = lambda n: c(f"d.{n}").cast("double")
    repaired = {
        "Age": F.when(d("Age") > 200, c("m_Age")).otherwise(d("Age")),
        "LotSize": F.coalesce(d("LotSize"), F.lit(0.1)),
        "Bedrooms": F.when((d("Bedrooms") < 0) | d("Bedrooms").isNull(), c("m_Bedrooms")).otherwise(d("Bedrooms")),
        "Baths": F.when(d("Baths") < 0, c("m_Baths")).otherwise(d("Baths")),
        "HomeSquareFootage": F.when((d("HomeSquareFootage") < 100) | d("HomeSquareFootage").isNull(), c("m_feet"))
        .otherwise(d("HomeSquareFootage")),
        "Favorites": F.ceil(ratio(d("Favorites"), d("RunNum"))),
        **{n: F.coalesce(d(n), c(f"m_{n}"), F.lit(v).cast("double")) for n, v in nation.items()},
    }
    return joined.select(*[f"d.{n}" for n in df.columns if n not in repaired],
                         *[v.alias(n) for n, v in repaired.items()])


# ---- valuations -----------------------------------------------------------------------------

def external_estimates(raw: DataFrame, pattern: str = r"asset/(\d+)") -> DataFrame:
    """Mean positive estimate per property id found in the page address."""
    found = F.nullif(F.regexp_extract("URL", pattern, 1), F.lit("")).cast("long")
    value = number(F.col("Estimate"))
    return (
        raw.select(found.alias("GlobalPropertyId"), value.alias("Estimate"))
        .filter(F.col("GlobalPropertyId").isNotNull() & (F.col("Estimate") > 0))
        .groupBy("GlobalPropertyId").agg(F.avg("Estimate").alias("ExternalEstimate"))
    )


def with_external_estimates(df: DataFrame, estimates: DataFrame) -> DataFrame:
    """Missing valuations take the external estimate and are flagged as predicted."""
    joined = df.join(estimates, "GlobalPropertyId", "left")
    value = F.coalesce("BPO", "ExternalEstimate")
    return joined.withColumns({
        "IsPredictedBPO": F.when(F.col("BPO").isNull(), 1).otherwise(0),
        "BPO": value,
        "BPOSurplus": value - F.col("Reserve"),
        "ExternalEstimate": F.coalesce("ExternalEstimate", F.lit(0.0)),
    })


def reserve_breakpoints(df: DataFrame, parts: int = 10) -> DataFrame:
    """Exact reserve quantiles per state: ``parts`` equal shares, both ends included."""
    probs = [i / parts for i in range(parts + 1)]
    return quantiles(df, ["PropertyState"], "Reserve", probs, "Breakpoints")


def bucket_minima(df: DataFrame, breakpoints: DataFrame, parts: int = 10) -> DataFrame:
    """Per state the lowest valuation inside each reserve bucket, then the highest valuation of all.

    Buckets include both ends, so a reserve equal to a breakpoint counts in two of them.
    """
    inside = [
        F.min(F.when(F.col("Reserve").between(F.col("Breakpoints")[k], F.col("Breakpoints")[k + 1]), F.col("BPO")))
        for k in range(parts)
    ]
    joined = df.select("PropertyState", "Reserve", "BPO").join(breakpoints, "PropertyState")
    return joined.groupBy("PropertyState").agg(F.array(*inside, F.max("BPO")).alias("BucketBPO"))


def reserve_position(reserve: Column, breakpoints: Column) -> Column:
    """1-based place of a reserve among the sorted breakpoints; equal ones move it half a place each."""
    below = F.size(F.filter(breakpoints, lambda b: b < reserve))
    equal = F.size(F.filter(breakpoints, lambda b: b == reserve))
    return F.floor(below + 1 + equal / 2).cast("int")


def bounded_prediction(predicted: Column, opening: Column, reserve: Column) -> Column:
    """A predicted valuation: opening bid (or zero) when not positive, at most three reserves."""
    floor = F.when((predicted <= 0) | predicted.isNull(), F.coalesce(opening, F.lit(0.0))).otherwise(predicted)
    return F.when(floor >= 3 * reserve, 3 * reserve).otherwise(floor)


def blend_valuation(df: DataFrame, p: Params, predicted: str, opening: str = "StartingBid", parts: int = 10,
                    date_col: str = "AuctionDate") -> DataFrame:
    """Fill missing valuations of scoring rows: four parts prediction, one part reserve-bucket minimum."""
    breakpoints = settle(reserve_breakpoints(df, parts))
    minima = settle(bucket_minima(df, breakpoints, parts).join(breakpoints, "PropertyState"))
    joined = df.alias("d").join(minima.alias("m"), same_key("d", "m", ["PropertyState"]), "left")
    reserve = F.col("d.Reserve")
    bounded = bounded_prediction(F.col(f"d.{predicted}"), F.col(f"d.{opening}"), reserve)
    bucket = F.get(F.col("m.BucketBPO"), reserve_position(reserve, F.col("m.Breakpoints")) - 1)
    # the lowest of no valuation at all is without bound, so that the limit of three reserves holds
    mixed = F.when(bucket.isNull(), 3 * reserve).otherwise((4 * bounded + bucket) / 5)
    mixed = F.when(mixed >= 3 * reserve, 3 * reserve).otherwise(mixed)
    wanted = F.col("d.BPO").isNull() & (F.col(f"d.{date_col}") >= F.date_sub(F.lit(p.as_of), p.holdout_days))
    out = joined.select("d.*", F.when(wanted, mixed).otherwise(F.col("d.BPO")).alias("_bpo"))
    surplus = F.col("_bpo") - F.col("Reserve")
    return out.withColumns({
        "BPO": F.col("_bpo"), "BPOSurplus": surplus, "BPOSurplusPct": ratio(surplus, F.col("Reserve")),
    }).drop("_bpo")
