"""Text keys without regard to case: every key gets one spelling before anything is grouped or joined by it.

The distinct spellings of a key are few beside the rows that carry them. They alone are compared under a collation that ignores case; the tables
are then respelled by a plain equality join with the spellings that change, so that groups and joins over facts stay exact matches of
ordinary strings, which Spark aggregates by hash and pushes down.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hammerline.session import settle

CASELESS = "UTF8_LCASE"
# text keys and the warehouse tables that bring them into a feature row
TEXT_KEYS: dict[str, tuple[str, ...]] = {
    "bidderemail": ("dim_bidder",),
    "SellerCode": ("dim_seller", "dim_seller_group"),
    "TrusteeCode": ("dim_trustee",),
    "AuctionCode": ("dim_auction",),
    "PropertyState": ("dim_property",),
    "PropertyCounty": ("dim_property",),
}


class Respelled(dict):
    """Tables by name; those that were not respelled come from the warehouse unchanged."""

    def __init__(self, tables: Mapping[str, DataFrame], changed: Mapping[str, DataFrame]):
        super().__init__(changed)
        self.tables = tables

    def __missing__(self, name: str) -> DataFrame:
        return self.tables[name]


def spellings(frames: Iterable[DataFrame], column: str) -> DataFrame:
    """(variant, spelling) for each text that another one equals but for case; ``spelling`` is the least of them in byte order.

    Nulls and texts of a single spelling have no row; an empty result means that nothing changes.
    """
    texts = reduce(DataFrame.unionByName, [f.select(F.col(column).alias("variant")).distinct() for f in frames])
    texts = settle(texts.filter(F.col("variant").isNotNull()).distinct())
    least = texts.groupBy(F.collate("variant", CASELESS).alias("_any")).agg(F.min("variant").alias("spelling"), F.count("*").alias("_n"))
    least = least.filter("_n > 1").select("_any", "spelling")
    met = texts.join(least, F.collate(F.col("variant"), CASELESS) == F.col("_any"))
    return settle(met.filter("variant <> spelling").select("variant", "spelling"))


def respell(df: DataFrame, column: str, changed: DataFrame) -> DataFrame:
    """``df`` with each variant in ``column`` replaced by its spelling; columns, their order and all other values stay."""
    names = df.columns
    new = changed.select(F.col("variant").alias("_variant"), F.col("spelling").alias("_spelling"))
    value = F.coalesce(F.col("n._spelling"), F.col(f"d.`{column}`")).alias(column)
    joined = df.alias("d").join(new.alias("n"), F.col(f"d.`{column}`") == F.col("n._variant"), "left")
    return joined.select(*[value if c == column else F.col(f"d.`{c}`") for c in names])


def unify(tables: Mapping[str, DataFrame], keys: Mapping[str, Iterable[str]] = TEXT_KEYS) -> Respelled:
    """The tables with one spelling for each text key, the same one in all tables that share it.

    ``keys`` names, for each key column, the tables to look at; those that hold no such column, or not as text, are passed over. Tables
    are looked up by name only, so ``tables`` may be lazy.
    """
    changed: dict[str, DataFrame] = {}
    for column, names in keys.items():
        held = {n: changed[n] if n in changed else tables[n] for n in names}
        held = {n: f for n, f in held.items() if column in f.columns and isinstance(f.schema[column].dataType, T.StringType)}
        if held:
            variants = spellings(held.values(), column)
            changed |= {n: respell(f, column, variants) for n, f in held.items()}
    return Respelled(tables, changed)
