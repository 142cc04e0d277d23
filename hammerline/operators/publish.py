"""Published predictions: an append-only history, the current snapshot and the unified table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Columns of the unified table. (name, non-trustee source, trustee source, type)
UNIFIED = (
    ("GlobalPropertyId", "=", "=", "bigint"), ("SystemAuctionId", "=", "=", "string"), ("VenueId", "=", "=", "bigint"),
    ("AuctionId", "=", "=", "bigint"), ("PropertyId", "=", "=", "bigint"), ("REDCID", "=", "=", "string"),
    ("LoanNbr", "=", "=", "string"), ("PropertyState", "=", "=", "string"), ("PropertyZip", "=", "=", "string"),
    ("PropertyCounty", "=", "=", "string"), ("PropertyCity", "=", "=", "string"), ("MSAName", "=", "=", "string"),
    ("AuctionCode", "=", "=", "string"), ("AuctionDate", "BidEndDT", "=", "timestamp_ntz"),
    ("SellerCode", "", "", "string"), ("SellerName", "", "", "string"),
    ("TrusteeCode", "", "=", "string"), ("TrusteeName", "", "=", "string"),
    ("PropertyOccupancyStatus", "=", "=", "string"), ("Condition", "=", "=", "string"),
    ("PropertyType", "=", "=", "string"), ("ProductType", "=", "=", "string"), ("RunNum", "=", "=", "bigint"),
    ("FinancingAvailable", "=", "", "int"), ("ALRRegistrants", "=", "", "bigint"),
    ("TotalRegistrantScore", "=", "", "double"), ("IntrinsicBidderQuality", "=", "", "double"),
    ("TotalActive", "=", "=", "double"), ("Vacancy", "=", "=", "double"), ("Appreciation", "=", "=", "double"),
    ("Turnover", "=", "=", "double"), ("TotalHomesForSale", "=", "=", "double"), ("PercentHomesSold", "=", "=", "double"),
    ("MedianPPSQFT", "=", "=", "double"), ("MedianPPSQFTDeviation", "=", "=", "double"),
    ("ForeclosedPer10000", "=", "=", "double"), ("PrevForeclosureSoldRate", "=", "=", "double"),
    ("HomeSquareFootage", "=", "=", "double"), ("Bedrooms", "=", "=", "int"), ("Baths", "=", "=", "double"),
    ("LotSize", "=", "=", "double"), ("Age", "=", "=", "int"), ("StartingBid", "=", "OpeningBid", "double"),
    ("Reserve", "=", "=", "double"), ("BPO", "=", "=", "double"), ("FunctionalBPO", "=", "=", "double"),
    ("HighBid", "=", "=", "double"), ("IsSubjectToApproval", "=", "", "int"),
    ("AuctionDaySale", "=", "IsSold", "int"), ("SellerAcceptedSale", "=", "IsSold", "int"),
    ("ReserveExceeded", "=", "IsSold", "int"), ("IsCancelled", "", "=", "int"), ("IsPostponed", "", "=", "int"),
    ("IsRemoved", "", "=", "int"), ("IsAuction", "", "=", "int"),
    ("AuctionDaySalePrediction", "=", "ThirdPartySaleOverallPrediction", "double"),
    ("SellerAcceptedSalePrediction", "=", "ThirdPartySaleOverallPrediction", "double"),
    ("ExceedReservePrediction", "=", "ThirdPartySaleOverallPrediction", "double"),
    ("RecommendedMaxReservePrice", "=", "=", "double"), ("PostponementPrediction", "", "=", "double"),
    ("CancellationPrediction", "", "=", "double"), ("ThirdPartySaleIfAuctionedPrediction", "", "=", "double"),
    ("ThirdPartySaleOverallPrediction", "", "=", "double"), ("ModelRunDate", "=", "=", "date"),
)
# Descriptive and measured columns of the two published outputs.
_SHARED_HEAD = (
    "GlobalPropertyId", "SystemAuctionId", "VenueId", "AuctionId", "PropertyId", "REDCID", "LoanNbr", "PropertyState",
    "PropertyZip", "PropertyCounty", "PropertyCity", "MSAName", "AuctionCode",
)
_SHARED_MARKET = (
    "TotalActive", "Vacancy", "Appreciation", "Turnover", "TotalHomesForSale", "PercentHomesSold", "MedianPPSQFT",
    "MedianPPSQFTDeviation", "ForeclosedPer10000", "PrevForeclosureSoldRate", "HomeSquareFootage", "Bedrooms", "Baths",
    "LotSize", "Age",
)
NONTRUSTEE_OUTPUT = (
    *_SHARED_HEAD, "SellerCode", "SellerName", "Latitude", "Longitude", "BidEndDT", "PropertyOccupancyStatus",
    "Condition", "PropertyType", "ProductType", "RunNum", "FinancingAvailable", "ALRRegistrants",
    "TotalRegistrantScore", "IntrinsicBidderQuality", *_SHARED_MARKET, "StartingBid", "Reserve", "BPO",
    "FunctionalBPO", "HighBid", "IsSubjectToApproval", "AuctionDaySale", "SellerAcceptedSale", "ReserveExceeded",
    "AuctionDaySalePrediction", "SellerAcceptedSalePrediction", "ExceedReservePrediction",
    "RecommendedMaxReservePrice", "ModelRunDate", "Negative1", "Negative2",
)
TRUSTEE_OUTPUT = (
    *_SHARED_HEAD, "TrusteeCode", "TrusteeName", "Latitude", "Longitude", "AuctionDate", "PropertyOccupancyStatus",
    "Condition", "PropertyType", "ProductType", "RunNum", *_SHARED_MARKET, "OpeningBid", "Reserve", "BPO",
    "FunctionalBPO", "HighBid", "IsCancelled", "IsPostponed", "IsRemoved", "IsAuction", "IsSold",
    "RecommendedMaxReservePrice", "CancellationPrediction", "PostponementPrediction",
    "ThirdPartySaleIfAuctionedPrediction", "ThirdPartySaleOverallPrediction", "ModelRunDate", "Negative1", "Negative2",
)


def append_history(new: DataFrame, path: str, run_id: int) -> None:
    """Add one run as its own partition. Repeating a run replaces its partition, never another's, also with no rows."""
    new.write.mode("overwrite").parquet(f"{path.rstrip('/')}/RunId={int(run_id)}")


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """All runs with ``MostRecentData`` derived: 1 on the latest run, 0 on the others."""
    history = spark.read.parquet(path).withColumn("RunId", F.col("RunId").cast("long"))
    latest = history.agg(F.max("RunId")).first()[0]
    return history.withColumn("MostRecentData", F.when(F.col("RunId") == latest, 1).otherwise(0))


def current_rows(history: DataFrame) -> DataFrame:
    return history.filter(F.col("MostRecentData") == 1)


def replace_current(new: DataFrame, path: str) -> None:
    """The snapshot holds the latest run only.

    Every snapshot is a version of its own under ``path``; readers take the last that was written in full, so
    they never meet a gap, and a failed write leaves the one before in place.
    """
    spark = new.sparkSession
    version = max([0, *_versions(spark, path)]) + 1
    new.withColumn("MostRecentData", F.lit(1)).write.mode("overwrite").parquet(f"{path.rstrip('/')}/version={version}")


def _versions(spark: SparkSession, path: str) -> list[int]:
    """Versions of a snapshot that were written in full."""
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    found = [s.getPath() for s in files.listStatus(folder) if s.getPath().getName().startswith("version=")]
    return [int(v.getName()[8:]) for v in found if files.exists(jvm.org.apache.hadoop.fs.Path(v, "_SUCCESS"))]


def read_current(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path.rstrip('/')}/version={max(_versions(spark, path))}")


def unified(nontrustee: DataFrame, trustee: DataFrame) -> DataFrame:
    """Both product lines in one layout; columns a line lacks are typed NULLs."""
    def side(df: DataFrame, which: int) -> DataFrame:
        columns = []
        for name, *sources, kind in UNIFIED:
            source = name if sources[which] == "=" else sources[which]
            columns.append((F.col(source) if source else F.lit(None)).cast(kind).alias(name))
        return df.select(*columns)

    return side(nontrustee, 0).unionByName(side(trustee, 1))


def write_csv(df: DataFrame, path: str, columns: Sequence[str] | None = None) -> None:
    """Header, NA for missing values, default quoting."""
    out = df.select(*columns) if columns else df
    out.write.mode("overwrite").option("header", True).option("nullValue", "NA").csv(path)
