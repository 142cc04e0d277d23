"""What the operators of this folder share: mapping texts in tasks, and ranks that no hot key can gather in one task."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from hammerline.session import settle

ROWS = 512  # texts that a task holds as Python objects at a time
DOC_ID = "doc_id"


def documents(spark, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or a longer one that no column of ``df`` has in any case."""
    taken = {c.lower() for c in df.columns}
    return next(n for k in count() if (n := f"__{name}{k or ''}").lower() not in taken)


def narrow(df: DataFrame, id_col: str, text_col: str, *, binary: bool) -> DataFrame:
    """(doc_id, text) of any documents table; other columns, whatever their names, are left behind."""
    return df.select(F.col(id_col).alias(DOC_ID), F.col(text_col).cast("binary" if binary else "string").alias("text"))


def slices(batches: Iterator[pa.RecordBatch], rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def map_texts(df: DataFrame, fields: str, make: Callable[[], Callable[[list], Sequence]], drop_text: bool = True) -> DataFrame:
    """Columns computed from the last column of ``df`` (text; null is taken as empty), beside its other columns.

    ``make()`` runs once in a task and returns a function from a list of texts to one list or array per field.
    """
    added = StructType.fromDDL(fields)
    kept = StructType(df.schema.fields[:-1] if drop_text else df.schema.fields)
    new = list(to_arrow_schema(added))
    empty = b"" if df.schema.fields[-1].dataType.typeName() == "binary" else ""

    def run(batches):
        fn = make()
        for part in slices(batches):
            texts = [empty if t is None else t for t in part.column(part.num_columns - 1).to_pylist()]
            columns = [a if isinstance(a, pa.Array) else pa.array(a, type=f.type) for a, f in zip(fn(texts), new, strict=True)]
            n = part.num_columns - drop_text
            yield pa.RecordBatch.from_arrays([*part.columns[:n], *columns], schema=pa.schema([*list(part.schema)[:n], *new]))

    return df.mapInArrow(run, StructType([*kept.fields, *added.fields]))


def rank_within(df: DataFrame, group: str, order: Sequence[str], name: str = "rank") -> DataFrame:
    """``df`` with gapless ranks from 0 within each ``group``, however large a group is.

    Rows are numbered in a settled copy. A group of n rows is dealt by the hash of that number into about sqrt(n) slices of about
    sqrt(n) rows, so that rows which are equal in all columns spread as others do; a rank is the rows of the slices before plus the
    place in its own slice.
    """
    df = settle(df.withColumn("__number", F.monotonically_increasing_id()))
    parts = settle(df.groupBy(group).agg(F.ceil(F.sqrt(F.count("*").cast("double"))).alias("__slices")))
    dealt = df.join(parts, group).withColumn("__slice", F.pmod(F.xxhash64("__number"), F.col("__slices"))).drop("__slices")
    sizes = dealt.groupBy(group, "__slice").count()
    before = F.sum("count").over(Window.partitionBy(group).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select(group, "__slice", F.coalesce(before, F.lit(0)).alias("__before"))
    place = F.row_number().over(Window.partitionBy(group, "__slice").orderBy(*order, "__number")) - 1
    return (dealt.withColumn("__place", place).join(sizes, [group, "__slice"])
            .withColumn(name, (F.col("__before") + F.col("__place")).cast("long")).drop("__slice", "__before", "__place", "__number"))


def bucket_bounds(df: DataFrame, id_col: str, buckets: int) -> np.ndarray:
    """At most ``buckets`` - 1 ascending ids that cut a documents table into near-equal buckets."""
    steps = [k / buckets for k in range(1, buckets)]
    found = df.select(F.col(id_col).alias(DOC_ID)).approxQuantile(DOC_ID, steps, 0.2 / buckets) if steps else []
    return np.unique(np.asarray(found, dtype=np.int64))


def bucket_of(ids: pa.Array, bounds: np.ndarray) -> np.ndarray:
    """Bucket of each id; a missing id comes after all others."""
    values = ids.fill_null(0).to_numpy(zero_copy_only=False)
    return np.where(ids.is_null().to_numpy(zero_copy_only=False), len(bounds), np.searchsorted(bounds, values, side="right")).astype(np.int32)


def n_buckets(spark) -> int:
    """Four buckets a shuffle partition, so that hashing buckets to partitions leaves none much larger than another."""
    return 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
