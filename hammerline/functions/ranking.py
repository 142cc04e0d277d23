"""Exact ranks, tiles and quantiles for groups too large for one task.

A plain window partitioned by state puts every row of the largest state in a single task. Here the
rows are range-partitioned on (group, order), so a large group spans many slices; each slice is
summed on its own, the few slice totals are accumulated, and the two are added up.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hammerline.functions.columns import same_key
from hammerline.session import settle


def running_total(
    df: DataFrame, group: Sequence[str], order: Sequence[str], weight: str, out: str
) -> DataFrame:
    """Prefix sum of ``weight`` (a count) inside each group, and the group total as ``<out>_of``.

    ``order`` must be unique per group; NULLs sort first.
    """
    ordering = [F.col(c).asc_nulls_first() for c in order]
    slices = settle(
        df.repartitionByRange(*[F.col(g).asc_nulls_first() for g in group], *ordering)
        .withColumn("_slice", F.spark_partition_id())
    )
    key = [*group, "_slice"]
    whole = Window.partitionBy(*group)
    upto = whole.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        slices.groupBy(*key)
        .agg(F.sum(weight).alias("_total"))
        .select(
            *key,
            F.coalesce(F.sum("_total").over(upto), F.lit(0)).alias("_before"),
            F.sum("_total").over(whole).alias("_of"),
        )
    )
    inside = Window.partitionBy(*key).orderBy(*ordering).rowsBetween(Window.unboundedPreceding, 0)
    local = slices.withColumn("_local", F.sum(weight).over(inside))
    return (
        local.alias("l")
        .join(offsets.alias("o"), same_key("l", "o", key))
        .select("l.*", (F.col("_local") + F.col("_before")).alias(out), F.col("_of").alias(f"{out}_of"))
        .drop("_slice", "_local")
    )


def tile_cuts(df: DataFrame, group: str, order: Sequence[str], tiles: int) -> DataFrame:
    """Last row of every tile but the final one: (group, cut_1 .. cut_{tiles-1}), structs of ``order``.

    Tile sizes are those of NTILE: as equal as possible, larger tiles first, NULLs sorted first.
    """
    narrow = df.select(group, *order).withColumn("_one", F.lit(1))
    ranked = running_total(narrow, [group], order, "_one", "_rank")
    size = F.col("_rank_of")
    cuts = []
    for t in range(1, tiles):
        last = t * F.floor(size / tiles) + F.least(F.lit(t), size % tiles)
        cuts.append(F.max(F.when(F.col("_rank") == last, F.struct(*order))).alias(f"cut_{t}"))
    return ranked.groupBy(group).agg(*cuts)


def with_tile(df: DataFrame, cuts: DataFrame, group: str, order: Sequence[str], tiles: int, out: str) -> DataFrame:
    """Label rows by comparing them with the cuts; the wide rows themselves are never sorted."""
    joined = df.alias("d").join(cuts.alias("c"), same_key("d", "c", [group]), "left")
    place = F.struct(*[F.col(f"d.{c}") for c in order])
    label = F.lit(tiles)
    for t in range(tiles - 1, 0, -1):
        label = F.when(place <= F.col(f"c.cut_{t}"), t).otherwise(label)
    return joined.select("d.*", label.alias(out))


def ntile(df: DataFrame, group: str, order: Sequence[str], tiles: int, out: str) -> DataFrame:
    return with_tile(df, settle(tile_cuts(df, group, order, tiles)), group, order, tiles, out)


def quantiles(df: DataFrame, group: Sequence[str], value: str, probs: Sequence[float], out: str) -> DataFrame:
    """Exact linear-interpolation quantiles per group as one array column; NULL values are ignored."""
    counts = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*group, value)
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    upto = running_total(counts, group, [value], "_n", "_upto")

    def at(rank: Column) -> Column:
        inside = (F.col("_upto") >= rank) & (F.col("_upto") - F.col("_n") < rank)
        return F.max(F.when(inside, F.col(value)))

    spots = [(F.col("_upto_of") - 1) * F.lit(float(p)) for p in probs]
    ends = []
    for i, spot in enumerate(spots):
        ends += [at(F.floor(spot) + 1).alias(f"_lo{i}"), at(F.ceil(spot) + 1).alias(f"_hi{i}")]
    picked = upto.groupBy(*group, "_upto_of").agg(*ends)
    blended = [
        F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * (spot - F.floor(spot))
        for i, spot in enumerate(spots)
    ]
    return picked.select(*group, F.array(*blended).alias(out))


def medians(df: DataFrame, group: Sequence[str], values: dict[str, Column]) -> DataFrame:
    """Exact medians of several columns, per group or (without one) of all rows: one row a group, a column a name.

    The columns go through one distributed quantile side by side, as (group, name, value) rows with counts, so that no
    task holds the distinct values of a group, and a nation is a group like any other.
    """
    pairs = [F.struct(F.lit(name).alias("_name"), value.cast("double").alias("_value")) for name, value in values.items()]
    long = df.select(*group, F.explode(F.array(*pairs)).alias("_p")).select(*group, "_p.*")
    middle = quantiles(long, [*group, "_name"], "_value", [0.5], "_q")
    return middle.groupBy(*group).agg(*[F.max(F.when(F.col("_name") == name, F.col("_q")[0])).alias(name) for name in values])


def two_smallest(df: DataFrame, key: Sequence[str], item: str) -> DataFrame:
    """Smallest and second smallest distinct ``item`` struct per key with combinable minima only."""
    first = df.groupBy(*key).agg(F.min(item).alias("_first"))
    rest = (
        df.alias("d")
        .join(first.alias("f"), same_key("d", "f", key))
        .filter(F.col(f"d.{item}") > F.col("f._first"))
        .groupBy(*[F.col(f"d.{k}").alias(k) for k in key])
        .agg(F.min(f"d.{item}").alias("_second"))
    )
    return (
        first.alias("a")
        .join(rest.alias("b"), same_key("a", "b", key))
        .select("a.*", "b._second")
    )
