"""Checks on predictions: distributions, error kinds, calibration, drift and unscored listings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hammerline.params import Params


def _side(p: Params, date_col: str) -> Column:
    day, run = F.col(date_col), F.lit(p.as_of)
    return F.when(day > run, "upcoming").when(day < run, "trailing")


def prediction_histogram(df: DataFrame, p: Params, column: str, bins: int = 20, date_col: str = "AuctionDate") -> DataFrame:
    """Equal-width counts over [0, 1] for all rows, the upcoming and the trailing ones."""
    place = F.least(F.floor(F.col(column) * bins) + 1, F.lit(bins)).cast("int")
    sides = (
        df.filter(F.col(column).isNotNull())
        .groupBy(_side(p, date_col).alias("_side"), place.alias("Bin")).agg(F.count(F.lit(1)).alias("_n"))
    )
    each = F.explode(F.array_compact(F.array(F.lit("all"), F.col("_side"))))
    return (
        sides.select(each.alias("Population"), "Bin", "_n")
        .groupBy("Population", "Bin").agg(F.sum("_n").alias("Rows"))
    )


def error_types(df: DataFrame, p: Params, column: str, actual: str, date_col: str = "AuctionDate") -> DataFrame:
    """Rounded prediction minus outcome: 0 correct, 1 false positive, -1 false negative."""
    error = (F.bround(F.col(column), 0) - F.col(actual)).cast("int")
    return (
        df.select(_side(p, date_col).alias("Population"), error.alias("ErrorType"))
        .filter(F.col("Population").isNotNull() & F.col("ErrorType").isNotNull())
        .groupBy("Population", "ErrorType").agg(F.count(F.lit(1)).alias("Rows"))
    )


def calibration(predictions: DataFrame, listings: DataFrame, column: str, high_bid: str = "HighBid") -> DataFrame:
    """Mean prediction, share of listings without a high bid, and their product: one row."""
    mean = predictions.agg(F.avg(column).alias("MeanPrediction"))
    no_bid = listings.agg(F.avg(F.when(F.col(high_bid).isNull(), 1.0).otherwise(0.0)).alias("ShareWithoutHighBid"))
    one = F.lit(1).alias("_k")
    both = mean.select("*", one).join(no_bid.select("*", one), "_k").drop("_k")
    return both.withColumn("Product", F.col("MeanPrediction") * F.col("ShareWithoutHighBid"))


def drift_by_segment(df: DataFrame, p: Params, segments: Mapping[str, tuple[bool, Sequence[str]]],
                     date_col: str = "AuctionDate") -> DataFrame:
    """Four means before and after the run date per seller segment, and two differences.

    ``segments`` maps a name to (keep or drop, seller codes); segments may overlap. Rows collapse to
    one per seller before a seller is counted in several segments.
    """
    measures = ("BPOSurplus", "Reserve", "BPO", "BPOSurplusPct")
    side = _side(p, date_col)
    cells = []
    for m in measures:
        for when, tag in (("upcoming", "Pre"), ("trailing", "Post")):
            value = F.when(side == when, F.col(m))
            cells += [F.sum(value).alias(f"s_{tag}{m}"), F.count(value).alias(f"n_{tag}{m}")]
    per_seller = df.groupBy("SellerCode").agg(*cells)

    def member(name: str, keep: bool, codes: Sequence[str]) -> Column:
        if not codes:
            return F.lit(name)
        hit = F.col("SellerCode").isin(*codes)
        return F.when(hit if keep else F.coalesce(~hit, F.lit(True)), name)

    tags = F.array_compact(F.array(*[member(n, k, c) for n, (k, c) in segments.items()]))
    names = [f"{tag}{m}" for m in measures for tag in ("Pre", "Post")]
    totals = (
        per_seller.withColumn("Segment", F.explode(tags)).groupBy("Segment")
        .agg(*[F.sum(f"{k}_{n}").alias(f"{k}_{n}") for n in names for k in "sn"])
    )
    means = totals.select("Segment", *[
        (F.col(f"s_{n}") / F.nullif(F.col(f"n_{n}"), F.lit(0))).alias(n) for n in names])
    return means.withColumns({
        "BPODifference": F.col("PreBPO") - F.col("PostBPO"),
        "ReserveDifference": F.col("PreReserve") - F.col("PostReserve"),
    })


def unscored_frequency(df: DataFrame, p: Params, column: str, codes: Sequence[str] | None = None,
                       date_col: str = "AuctionDate") -> DataFrame:
    """How often each value occurs among listings after the run date."""
    future = df.filter((F.col(date_col) > F.lit(p.as_of)) & F.col(column).isNotNull())
    if codes:
        future = future.filter(F.col(column).isin(*codes))
    return future.groupBy(column).agg(F.count(F.lit(1)).alias("Rows"))
