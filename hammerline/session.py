"""Session defaults and the one way this package materialises an intermediate result."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.showConsoleProgress": "false",
}


_local_dirs: dict[str, str] = {}
_shipped: set[str] = set()  # applications whose Python workers have the package
_runs: dict[str, list[str]] = {}  # open workspaces of each application, the innermost last


def session(master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName("hammerline")
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship(spark)
    return spark


def ship(spark: SparkSession) -> None:
    """Give the package's Python files to the workers of a session, once, so that it need not be installed on the executors.

    ``session`` does it; call it for a session that was started otherwise and without ``--py-files``. Spark serves the archive from its own folder
    on the driver, and an executor that starts later fetches it too.
    """
    if spark.sparkContext.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    if os.path.isdir(package):  # an archive that --py-files brought is with the workers already
        archive = os.path.join(spark.sparkContext._temp_dir, "hammerline.zip")
        with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
            for folder, _, names in os.walk(package):
                for name in (n for n in names if n.endswith(".py")):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(package)))
        spark.sparkContext.addPyFile(archive)
    _shipped.add(spark.sparkContext.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary one only for a local master that names none."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or _local_dirs.get(spark.sparkContext.applicationId)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return _local_dirs.setdefault(spark.sparkContext.applicationId, tempfile.mkdtemp(prefix="hammerline-"))


def settle(df: DataFrame, keep: bool = False) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back; with ``keep`` beside the open workspace, not in it.

    The copy outlives lost executors, is never recomputed, and has a known file size, so Spark itself
    broadcasts it in a later join when it is below ``spark.sql.autoBroadcastJoinThreshold`` and
    shuffles it (with skew splitting) when it is not. Only joins with tables of a fixed bound carry a broadcast hint.
    """
    spark = df.sparkSession
    folder = shared_dir(spark) if keep else (_runs.get(spark.sparkContext.applicationId) or [shared_dir(spark)])[-1]
    path = f"{folder.rstrip('/')}/settled-{uuid.uuid4().hex}"
    df.write.parquet(path, compression="zstd" if keep else None)  # what outlives a job is read most often
    return spark.read.schema(df.schema).parquet(path)


def by_merge(df: DataFrame) -> DataFrame:
    """``df`` for a join in which it must not be broadcast: it has a row for each auction, property, listing or bidder.

    Spark takes a table for small by the size of its files, cut down to the columns that are read. Files hold running keys and repeated words in a small part of
    what the driver needs for them: 9 million auctions passed for less than ``spark.sql.autoBroadcastJoinThreshold`` and were 600 MB there.
    """
    return df.hint("merge")


def settle_all(*frames: DataFrame) -> list[DataFrame]:
    """Settle independent intermediates side by side, so that small jobs do not wait for each other."""
    with ThreadPoolExecutor(max_workers=len(frames)) as pool:
        return list(pool.map(settle, frames))


@contextmanager
def workspace(spark: SparkSession):
    """Intermediates settled inside are deleted at the end; write what is to stay before that.

    For jobs that end with their results written, so that daily runs leave nothing in the shared folder.
    """
    folder = f"{shared_dir(spark).rstrip('/')}/run-{uuid.uuid4().hex}"
    open_runs = _runs.setdefault(spark.sparkContext.applicationId, [])
    open_runs.append(folder)
    try:
        yield folder
    finally:
        open_runs.remove(folder)
        remove(spark, folder)


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder and what is in it; nothing happens if it is not there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
