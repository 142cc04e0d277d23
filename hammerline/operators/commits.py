"""One commit for the history and the current set of predictions.

A run writes its rows under a name of its own and then claims the next manifest, a small file that lists the folder of every
run. Claiming is a rename that fails if the name is taken, so of two writers one comes second: it reads the manifest that won,
adds its run to that, and claims the next. Readers take the highest manifest and see history and current set of one
commit, never a part of one. A writer that dies leaves rows that no manifest names; ``vacuum`` removes them.

The rename is exclusive on HDFS and, by a hard link, on a local disk. On an object store it is as exclusive as its connector makes it.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Manifest:
    version: int                # 0: nothing was committed yet
    runs: dict[int, str]        # run -> its folder, relative to the root

    @property
    def latest(self) -> int | None:
        return max(self.runs, default=None)


@dataclass(frozen=True)
class Staged:
    """Rows that are written and not yet part of any manifest."""

    root: str
    run_id: int
    folder: str


class _Files:
    """The file system of one folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.gateway, self.conf = spark._jvm, spark.sparkContext._gateway, spark._jsc.hadoopConfiguration()
        self.fs = self.path(root).getFileSystem(self.conf)

    def path(self, *parts: str):
        return self.jvm.org.apache.hadoop.fs.Path("/".join(parts))

    def names(self, folder: str) -> list:
        path = self.path(folder)
        return list(self.fs.listStatus(path)) if self.fs.exists(path) else []

    def write(self, name: str, text: str) -> None:
        out = self.fs.create(self.path(name), False)
        out.write(bytearray(text.encode()))
        out.close()

    def read(self, name: str) -> str:
        source = self.fs.open(self.path(name))
        try:
            return bytes(source.readAllBytes()).decode()
        finally:
            source.close()

    def claim(self, source: str, target: str) -> bool:
        """Rename that fails when the target is there."""
        from py4j.protocol import Py4JJavaError

        src, dst = (self.fs.makeQualified(self.path(p)) for p in (source, target))
        try:
            if src.toUri().getScheme() == "file":
                nio = self.jvm.java.nio.file
                link, old = (self.jvm.java.io.File(p.toUri().getPath()).toPath() for p in (dst, src))
                nio.Files.createLink(link, old)
                self.fs.delete(src, False)
            else:
                options = self.gateway.new_array(getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
                self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(src.toUri(), self.conf).rename(src, dst, options)
        except Py4JJavaError as e:
            if "FileAlreadyExists" in e.java_exception.getClass().getName():
                return False
            raise
        return True


def manifest(spark: SparkSession, root: str) -> Manifest:
    """The last commit; version 0 without runs if there is none."""
    root = root.rstrip("/")
    files = _Files(spark, root)
    found = [s.getPath().getName() for s in files.names(f"{root}/manifests")]
    versions = [int(n[:-5]) for n in found if n.endswith(".json") and n[:-5].isdigit()]
    if not versions:
        return Manifest(0, {})
    held = json.loads(files.read(f"{root}/manifests/{max(versions):012d}.json"))
    return Manifest(max(versions), {int(k): v for k, v in held["runs"].items()})


def stage(new: DataFrame, root: str, run_id: int) -> Staged:
    """Write a run's rows; nobody sees them before ``commit``."""
    root, folder = root.rstrip("/"), f"data/commit={uuid.uuid4().hex}"
    new.write.parquet(f"{root}/{folder}/RunId={int(run_id)}")
    return Staged(root, int(run_id), folder)


def commit(spark: SparkSession, staged: Staged) -> Manifest:
    """Add a staged run to history and, if it is the latest run, make it the current set. Repeating a run replaces its rows."""
    files = _Files(spark, staged.root)
    files.fs.mkdirs(files.path(staged.root, "manifests"))
    files.fs.mkdirs(files.path(staged.root, "staging"))
    while True:  # a claim fails only because another writer's commit succeeded
        last = manifest(spark, staged.root)
        new = Manifest(last.version + 1, {**last.runs, staged.run_id: staged.folder})
        draft = f"{staged.root}/staging/{uuid.uuid4().hex}.json"
        files.write(draft, json.dumps({"runs": new.runs}))
        if files.claim(draft, f"{staged.root}/manifests/{new.version:012d}.json"):
            return new
        files.fs.delete(files.path(draft), False)


def publish(new: DataFrame, root: str, run_id: int) -> Manifest:
    """Write and commit one run."""
    return commit(new.sparkSession, stage(new, root, run_id))


def read_history(spark: SparkSession, root: str) -> DataFrame:
    """All runs of the last commit with ``RunId`` and ``MostRecentData``: 1 on the latest run, 0 on the others."""
    last, root = manifest(spark, root), root.rstrip("/")
    if not last.runs:
        raise FileNotFoundError(f"nothing was published under {root}")
    rows = spark.read.option("basePath", f"{root}/data").parquet(*[f"{root}/{folder}" for folder in last.runs.values()])
    latest = F.when(F.col("RunId") == last.latest, 1).otherwise(0)
    return rows.drop("commit").withColumn("RunId", F.col("RunId").cast("long")).withColumn("MostRecentData", latest)


def read_current(spark: SparkSession, root: str) -> DataFrame:
    """The latest run of the last commit; reads that run's folder only."""
    last, root = manifest(spark, root), root.rstrip("/")
    if not last.runs:
        raise FileNotFoundError(f"nothing was published under {root}")
    return spark.read.parquet(f"{root}/{last.runs[last.latest]}").drop("RunId").withColumn("MostRecentData", F.lit(1))


def vacuum(spark: SparkSession, root: str, older_than_ms: int) -> list[str]:
    """Remove rows that the last manifest does not name and that were written before ``older_than_ms`` (epoch milliseconds).

    Choose a time before any writer or reader that may still be at work began. Returns the folders that went.
    """
    root = root.rstrip("/")
    files, named = _Files(spark, root), set(manifest(spark, root).runs.values())
    gone = []
    for status in files.names(f"{root}/data"):
        folder = f"data/{status.getPath().getName()}"
        if folder not in named and status.getModificationTime() < older_than_ms:
            files.fs.delete(status.getPath(), True)
            gone.append(folder)
    return gone
