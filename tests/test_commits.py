"""Commits: interleaved and dead writers, readers between them, and what vacuum removes."""

import threading
import time
import uuid

import pytest

from hammerline.operators import commits
from hammerline.session import shared_dir


@pytest.fixture
def root(spark):
    return f"{shared_dir(spark)}/commits-{uuid.uuid4().hex}"


def frame(spark, tag, n=3):
    return spark.createDataFrame([(k, tag) for k in range(n)], "PropertyId long, tag string")


def state(spark, root):
    return sorted((r["RunId"], r["tag"], r["MostRecentData"]) for r in commits.read_history(spark, root).select("RunId", "tag", "MostRecentData").distinct().collect())


def test_two_interleaved_writers_both_count(spark, root):
    """Both stage on the same manifest; the one that claims second keeps the other's run."""
    commits.publish(frame(spark, "a"), root, 1)
    first, second = commits.stage(frame(spark, "b"), root, 2), commits.stage(frame(spark, "c"), root, 3)
    assert state(spark, root) == [(1, "a", 1)]  # staged rows are not seen
    assert commits.commit(spark, second).version == 2 and commits.commit(spark, first).version == 3
    assert state(spark, root) == [(1, "a", 0), (2, "b", 0), (3, "c", 1)]
    current = commits.read_current(spark, root)
    assert {r["tag"] for r in current.collect()} == {"c"} and current.columns == ["PropertyId", "tag", "MostRecentData"]


def test_a_lost_claim_is_made_again(spark, root, monkeypatch):
    """A writer that still sees the manifest before the other's commit loses its claim and adds to what won."""
    commits.publish(frame(spark, "a"), root, 1)
    old, real, stale = commits.manifest(spark, root), commits.manifest, []
    commits.publish(frame(spark, "b"), root, 2)

    def once_stale(spark, where):
        if not stale:
            stale.append(1)
            return old
        return real(spark, where)

    staged = commits.stage(frame(spark, "c"), root, 3)
    monkeypatch.setattr(commits, "manifest", once_stale)
    assert commits.commit(spark, staged).version == 3
    monkeypatch.setattr(commits, "manifest", real)
    assert state(spark, root) == [(1, "a", 0), (2, "b", 0), (3, "c", 1)]


def test_many_writers_at_once(spark, root):
    staged = [commits.stage(frame(spark, f"t{k}", 1), root, k) for k in range(1, 7)]
    threads = [threading.Thread(target=commits.commit, args=(spark, s)) for s in staged]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert commits.manifest(spark, root).version == 6
    assert state(spark, root) == [(k, f"t{k}", int(k == 6)) for k in range(1, 7)]


def test_a_dead_writer_leaves_nothing_to_see(spark, root):
    commits.publish(frame(spark, "a"), root, 1)
    commits.stage(frame(spark, "dead"), root, 2)  # and never commits
    commits.publish(frame(spark, "b"), root, 2)
    commits.publish(frame(spark, "b2"), root, 2)  # a repeated run replaces its rows
    assert state(spark, root) == [(1, "a", 0), (2, "b2", 1)]
    assert commits.vacuum(spark, root, 0) == []
    assert len(commits.vacuum(spark, root, int(time.time() * 1000) + 60_000)) == 2
    assert state(spark, root) == [(1, "a", 0), (2, "b2", 1)]


def test_empty_runs_and_empty_roots(spark, root):
    assert commits.manifest(spark, root).version == 0
    with pytest.raises(FileNotFoundError):
        commits.read_current(spark, root)
    commits.publish(frame(spark, "a"), root, 1)
    commits.publish(frame(spark, "b", 0), root, 2)
    assert commits.read_current(spark, root).count() == 0 and commits.read_history(spark, root).count() == 3
