"""Delimited files in and out. Every reader states its columns; nothing is inferred."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hammerline.functions.columns import number
from hammerline.session import settle

ESTIMATE_COLUMNS = ("Date", "URL", "Estimate")


def text_schema(columns: Sequence[str]) -> T.StructType:
    """All-text columns: numbers may hold the word NULL and are read later with a safe cast."""
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def read_feature_csv(spark: SparkSession, folder: str, run_date: date, columns: Sequence[str],
                     stem: str = "UnifiedPredictionData", date_col: str = "AuctionDate") -> DataFrame:
    """The feature extract of one run, found by the run date in its name; month-first dates."""
    path = f"{folder.rstrip('/')}/{stem}_{run_date:%Y-%m-%d}.csv"
    raw = spark.read.schema(text_schema(columns)).option("header", True).option("mode", "PERMISSIVE").csv(path)
    day = F.coalesce(
        F.try_to_date(F.col(date_col), "M/d/yyyy"), F.try_to_date(F.col(date_col), "yyyy-MM-dd"))
    return raw.withColumn(date_col, day)


def read_estimates(spark: SparkSession, pattern: str) -> DataFrame:
    """All headerless estimate files that match a path pattern, stacked."""
    return spark.read.schema(text_schema(ESTIMATE_COLUMNS)).option("header", False).csv(pattern)


def read_second_population(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    return spark.read.schema(text_schema(columns)).option("header", True).csv(path)


def read_accounted(spark: SparkSession, path: str, columns: Sequence[str], header: bool, numbers: Sequence[str] = (),
                   missing: Sequence[str] = ("", "NA", "NULL")) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, quarantine, counts) of delimited files; every record is in one of the first two.

    ``rows`` has the columns, ``numbers`` as doubles (values in ``missing`` are NULL), and ``_file``. ``quarantine`` has ``_file``, the
    ``record`` as it stands in the file and the ``reason``: another number of fields, or a number that is none. ``counts`` has, for each file, the
    records that were read, kept and quarantined. ``path`` may be a pattern; a file without records has no row in ``counts``.
    """
    broken = "_record_"
    schema = text_schema([*columns, broken])
    raw = spark.read.schema(schema).option("header", header).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", broken).csv(path)
    # a malformed record is known only when all columns are parsed, so the parsed rows are written once
    raw = settle(raw.select("*", F.col("_metadata.file_path").alias("_file")))
    absent = {c: F.col(c).isNull() | F.upper(F.trim(F.col(c))).isin([m.upper() for m in missing]) for c in numbers}
    unread = [F.when(~absent[c] & number(F.col(c)).isNull(), F.lit(f"{c} is no number")) for c in numbers]
    reason = F.when(F.col(broken).isNotNull(), "another number of fields")
    reason = F.coalesce(reason, *unread) if unread else reason
    judged = raw.withColumn("reason", reason)
    fields = F.to_csv(F.struct(*columns))
    quarantine = judged.filter("reason IS NOT NULL").select("_file", F.coalesce(broken, fields).alias("record"), "reason")
    kept = judged.filter("reason IS NULL").select(*[F.when(~absent[c], number(F.col(c))).alias(c) if c in absent else c for c in columns], "_file")
    counts = judged.groupBy("_file").agg(F.count("*").alias("read"), F.count(F.when(F.col("reason").isNull(), 1)).alias("kept"),
                                         F.count("reason").alias("quarantined"))
    return kept, quarantine, counts


def write_quarantine(quarantine: DataFrame, path: str) -> None:
    """Records that could not be used, beside those of earlier runs, to be mended and read again."""
    quarantine.write.mode("append").parquet(path)


def read_tables(spark: SparkSession, folder: str, names: Sequence[str]) -> dict[str, DataFrame]:
    """Warehouse tables stored as one parquet folder or file per name."""
    return {n: spark.read.parquet(f"{folder.rstrip('/')}/{n}") for n in names}


def write_coefficients(long: DataFrame, path: str) -> None:
    """(state, model, term, value) rows, one folder per model."""
    long.write.mode("overwrite").partitionBy("model").parquet(path)
