"""Scores for every listing at once, the rules applied to them, and coefficient tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hammerline.functions.columns import ratio
from hammerline.functions.scoring import (
    Model, NONTRUSTEE_MODELS, TRUSTEE_MODELS, VALUATION_MODEL, at_least, functional_valuation, logistic, score,
)
from hammerline.params import Params
from hammerline.session import settle


def joined_coefficients(tables: Mapping[str, DataFrame], models: Iterable[Model]) -> DataFrame:
    """One row per state that has every model: (PropertyState, one struct of coefficients per model)."""
    out = None
    for m in models:
        one = tables[m.name].select("PropertyState", F.struct("Intercept", *m.terms).alias(m.name))
        out = one if out is None else out.join(one, "PropertyState")
    return out


def with_scores(df: DataFrame, tables: Mapping[str, DataFrame], models: tuple[Model, ...], p: Params) -> DataFrame:
    """Add each model's output. Listings of states without coefficients drop out."""
    coefficients = settle(joined_coefficients(tables, models))
    joined = df.join(coefficients, "PropertyState")
    outputs = [score(m, p, m.name) for m in models]
    return joined.select(*df.columns, *outputs)


def score_nontrustee(df: DataFrame, tables: Mapping[str, DataFrame], p: Params) -> DataFrame:
    """Three sale probabilities, a price, a valuation estimate and the functional valuation."""
    scored = with_scores(df, tables, (*NONTRUSTEE_MODELS, VALUATION_MODEL), p)
    bound = p.number("absurd_valuation_bound")
    return scored.withColumn("FunctionalBPO", functional_valuation(p, bound))


def score_trustee(df: DataFrame, tables: Mapping[str, DataFrame], p: Params) -> DataFrame:
    scored = with_scores(df, tables, TRUSTEE_MODELS, p)
    return scored.withColumn("FunctionalBPO", functional_valuation(p, p.trustee_functional_bound))


def order_probabilities(df: DataFrame) -> DataFrame:
    """Accepted is never below exceeding the reserve, auction day never below accepted."""
    accepted = at_least("SellerAcceptedSalePrediction", "ExceedReservePrediction")
    return df.withColumns({
        "SellerAcceptedSalePrediction": accepted,
        "AuctionDaySalePrediction": at_least(F.col("AuctionDaySalePrediction"), accepted),
    })


def order_trustee_probabilities(df: DataFrame) -> DataFrame:
    name = "ThirdPartySaleIfAuctionedPrediction"
    return df.withColumn(name, at_least(name, "ThirdPartySaleOverallPrediction"))


def floor_price(df: DataFrame, price: str, opening: str) -> DataFrame:
    return df.withColumn(price, at_least(price, opening))


def fill_opening(df: DataFrame, opening: str) -> DataFrame:
    """Missing starting bids take the lowest one known anywhere."""
    lowest = df.agg(F.min(opening)).first()[0]
    return df.withColumn(opening, F.coalesce(F.col(opening), F.lit(lowest).cast("double")))


def cap_price(price: Column, reserve: Column) -> Column:
    """Prices far above the reserve come down to one and a half times it."""
    return F.when((price > 1.5 * reserve) & (price > 200_000), 1.5 * reserve).otherwise(price)


def reserve_reduction(probability: Column, price: Column, reserve: Column) -> Column:
    """How far an unlikely sale's reserve lies above its predicted bid, as a negative amount."""
    return F.when((probability < 0.5) & (price < reserve), price - reserve).otherwise(0.0)


def likelihood_band(probability: Column) -> Column:
    return (
        F.when(probability >= 0.8, "High").when(probability >= 0.5, "Moderate")
        .when(probability >= 0.1, "Borderline").otherwise("Low")
    )


def acceptance(df: DataFrame, models: DataFrame, price: str, fallback_state: str = "CA") -> DataFrame:
    """Chance that the seller accepts the predicted price.

    ``models`` holds (SellerCode, PropertyState, Position, intercept, b1, b2, b3). A listing uses its
    seller's model of its state, else the seller's model of the fallback state, else the last model.
    """
    parts = F.struct("intercept", "b1", "b2", "b3")
    kept = models.groupBy("SellerCode", "PropertyState").agg(F.min_by(parts, "Position").alias("own"))
    exact = settle(kept)
    home = exact.filter(F.col("PropertyState") == fallback_state).select("SellerCode", F.col("own").alias("home"))
    last = models.agg(F.max_by(parts, "Position").alias("m")).first()["m"]
    joined = df.join(exact, ["SellerCode", "PropertyState"], "left").join(home, "SellerCode", "left")

    def pick(name: str) -> Column:
        return F.coalesce(F.col(f"own.{name}"), F.col(f"home.{name}"), F.lit(float(last[name])))

    shortfall = F.greatest(1 - ratio(F.col(price), F.col("Reserve")), F.lit(0.0))
    z = pick("intercept") + pick("b1") * shortfall + pick("b2") * shortfall**2 + pick("b3") * shortfall**3
    return joined.withColumn("AcceptancePrediction", logistic(z)).drop("own", "home")


def coefficients_wide(long: DataFrame, terms: Iterable[str]) -> DataFrame:
    """(state, term, value) rows to one row per state with a column per term; a repeated term of a state is an error."""
    return long.groupBy("PropertyState").pivot("term", ["Intercept", *terms]).agg(single("value"))


def single(name: str) -> Column:
    """The only value of a group."""
    return F.when(F.count(F.lit(1)) > 1, F.raise_error(F.lit(f"more than one {name} for a state and term"))).otherwise(F.max(name))


def coefficients_long(wide: DataFrame, model: str, terms: Iterable[str]) -> DataFrame:
    names = ["Intercept", *terms]
    doubles = wide.select("PropertyState", *[F.col(t).cast("double").alias(t) for t in names])
    return doubles.unpivot("PropertyState", names, "term", "value").select(
        "PropertyState", F.lit(model).alias("model"), "term", "value"
    )
