"""Rolling aggregates from stored daily parts.

Sums can be rolled by adding a day and taking one away; maxima and distinct counts cannot. Here a day's rows become partial
results that merge (sums and counts, maxima, distinct values), stored by day; 2, 4, 8, ... full days that begin at
a multiple of their number are merged into blocks. Any window is then at most two blocks of each length, so a daily run reads
the new rows and about 2 log2(days) small parts instead of the whole history. Parts are partitions (level, start) of Parquet
tables, so a window's parts are the only files read. Distinct values are stored as rows, so no cell grows with a hot key.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hammerline.functions.columns import same_key

EPOCH = "1970-01-01"
LEVELS = 11  # blocks of up to 2**10 days


@dataclass(frozen=True)
class Measures:
    """What is kept of the rows: group ``keys``, the ``day`` column, and expressions by name.

    A sum ``x`` gives the columns x and x_n (how many values); a maximum and a distinct count give a column of their name. Sums
    should be of whole numbers, or small in number, as doubles depend on order.
    """

    keys: tuple[str, ...]
    day: str
    sums: dict[str, Column] = field(default_factory=dict)
    maxima: dict[str, Column] = field(default_factory=dict)
    distinct: dict[str, Column] = field(default_factory=dict)


def _number(day: Column) -> Column:
    return F.date_diff(day.cast("date"), F.lit(EPOCH).cast("date"))


def _merged(parts: DataFrame, m: Measures, by: Sequence[str]) -> DataFrame:
    sums = [F.sum(c).alias(c) for name in m.sums for c in (name, f"{name}_n")]
    return parts.groupBy(*by).agg(F.sum("rows").alias("rows"), *sums, *[F.max(c).alias(c) for c in m.maxima])


def daily(rows: DataFrame, m: Measures) -> tuple[DataFrame, DataFrame]:
    """(keys, start, measures) and the distinct (keys, start, name, value) of every day; ``start`` is the number of the day."""
    dated = rows.withColumn("start", _number(F.col(m.day))).filter(F.col("start").isNotNull())
    keep = {**m.sums, **m.maxima, **m.distinct}
    dated = dated.select(*m.keys, "start", *[c.alias(f"_{name}") for name, c in keep.items()])
    by = [*m.keys, "start"]
    measured = dated.groupBy(*by).agg(
        F.count("*").alias("rows"), *[x for s in m.sums for x in (F.sum(f"_{s}").alias(s), F.count(f"_{s}").alias(f"{s}_n"))],
        *[F.max(f"_{x}").alias(x) for x in m.maxima])
    values = [F.struct(F.lit(name).alias("name"), F.col(f"_{name}").cast("string").alias("value")) for name in m.distinct]
    seen = dated.select(*by, F.explode(F.array(*values)).alias("_v")).select(*by, "_v.*") if values else dated.select(
        *by, F.lit("").alias("name"), F.lit(None).cast("string").alias("value"))
    return measured, seen.filter("value IS NOT NULL").distinct()


def _write(df: DataFrame, path: str) -> None:
    """Replaces the parts that ``df`` has rows of and leaves the others."""
    df.repartition("level", "start").write.partitionBy("level", "start").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def _files(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def _read(spark: SparkSession, root: str, name: str, parts: Sequence[tuple[int, int]]) -> DataFrame | None:
    """The stored parts among (level, start), read by their own folders, so that nothing else is listed; None if there is none."""
    base = f"{root}/{name}"
    paths = [p for p in (f"{base}/level={level}/start={s}" for level, s in parts) if (f := _files(spark, p))[1].exists(f[0])]
    return spark.read.option("basePath", base).parquet(*paths) if paths else None


def _tables(m: Measures) -> tuple[str, ...]:
    return ("measures", "seen") if m.distinct else ("measures",)


def store(rows: DataFrame, m: Measures, root: str, first: int, last: int) -> None:
    """Store the parts of days ``first`` to ``last`` (numbers of days, both included), of which ``rows`` has all rows.

    Days are stored in ascending order, without a gap. Blocks that become complete are merged from the two halves below them. Storing
    days again replaces their parts and the blocks over them, so a job that was cut off can be repeated.
    """
    spark, root = rows.sparkSession, root.rstrip("/")
    days = rows.filter(_number(F.col(m.day)).between(first, last))
    for name, df in zip(_tables(m), daily(days, m)):
        _write(df.withColumn("level", F.lit(0)), f"{root}/{name}")
    for level in range(1, LEVELS):
        low, high = first >> level, ((last + 1) >> level) - 1  # the last block that is complete
        if high < low:
            break
        for name in _tables(m):
            halves = _read(spark, root, name, [(level - 1, s) for s in range(2 * low, 2 * high + 2)])
            if halves is None:
                continue
            up = halves.withColumn("start", F.shiftright("start", 1)).drop("level")
            up = _merged(up, m, [*m.keys, "start"]) if name == "measures" else up.distinct()
            _write(up.withColumn("level", F.lit(level)), f"{root}/{name}")


def cover(first: int, after: int, stored_first: int, stored_last: int) -> list[tuple[int, int]]:
    """(level, start) of the fewest stored blocks that make up the days from ``first`` to before ``after``."""
    at, out = max(first, stored_first), []
    after = min(after, stored_last + 1)
    while at < after:
        level = 0
        while level + 1 < LEVELS and at % (2 << level) == 0 and at + (2 << level) <= after:
            level += 1
        out.append((level, at >> level))
        at += 1 << level
    return out


def stored_days(spark: SparkSession, root: str) -> tuple[int, int] | None:
    """First and last stored day with rows, from the names of the parts."""
    folder, files = _files(spark, f"{root.rstrip('/')}/measures/level=0")
    days = [int(s.getPath().getName()[6:]) for s in files.listStatus(folder) if s.getPath().getName().startswith("start=")] if files.exists(folder) else []
    return (min(days), max(days)) if days else None


def window(spark: SparkSession, m: Measures, root: str, first: int, after: int, fresh: DataFrame | None = None, last: int | None = None) -> DataFrame:
    """(keys, rows, sums and their counts, maxima, distinct counts) over the days from ``first`` to before ``after``.

    ``last`` is the last stored day, if that is known to be later than the last day with rows. ``fresh`` has the rows of days
    after it, which need not be stored yet. Keys without a row in the window are absent; null keys are keys.
    """
    root, held = root.rstrip("/"), stored_days(spark, root)
    parts = cover(first, after, held[0], held[1] if last is None else last) if held else []
    tables = []
    if (measured := _read(spark, root, "measures", parts) if parts else None) is not None:
        seen = _read(spark, root, "seen", parts) if m.distinct else None
        tables.append((measured, seen) if seen is not None else (measured,))
    if fresh is not None:
        day, since = _number(F.col(m.day)), held[1] + 1 if held and last is None else (last + 1 if held else first)
        tables.append(daily(fresh.filter((day >= max(first, since)) & (day < after)), m))
    if not tables:
        raise ValueError("no part is stored and no rows are given")
    columns = [[*m.keys, "rows", *[c for s in m.sums for c in (s, f"{s}_n")], *m.maxima], [*m.keys, "name", "value"]]
    measured, seen = ([t[k].select(*columns[k]) for t in tables if len(t) > k] for k in (0, 1))
    out = _merged(reduce(DataFrame.unionByName, measured), m, m.keys)
    if m.distinct and seen:
        seen = reduce(DataFrame.unionByName, seen)
        counts = seen.distinct().groupBy(*m.keys).agg(*[F.count(F.when(F.col("name") == d, 1)).alias(d) for d in m.distinct])
        out = out.alias("m").join(counts.alias("s"), same_key("m", "s", m.keys), "left").select(
            "m.*", *[F.coalesce(f"s.{d}", F.lit(0)).alias(d) for d in m.distinct])
    elif m.distinct:
        out = out.withColumns({d: F.lit(0).cast("bigint") for d in m.distinct})
    return out
