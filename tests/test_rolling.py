"""Rolling aggregates: stored parts and fresh rows against a full recomputation, and what a window reads."""

import random
import uuid
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from hammerline.operators import rolling
from hammerline.session import shared_dir

DAY0 = 11_000


def measures():
    return rolling.Measures(("k",), "d", sums={"s": F.col("v")}, maxima={"top": F.col("v")}, distinct={"users": F.col("u"), "values": F.col("v")})


def rows(seed=1, n=4000, days=70):
    r = random.Random(seed)
    return [(r.choice(["a", "b", "c", None]), date(1970, 1, 1) + timedelta(days=DAY0 + r.randrange(days)), r.choice([None, r.randrange(50)]), r.choice([None, r.randrange(200)])) for _ in range(n)]


def plain(data, first, after):
    out = {}
    for k, d, v, u in data:
        if first <= (d - date(1970, 1, 1)).days < after:
            out.setdefault(k, []).append((v, u))
    result = []
    for k, own in out.items():
        vs = [v for v, _ in own if v is not None]
        result.append((k, len(own), sum(vs) if vs else None, len(vs), max(vs, default=None), len({u for _, u in own if u is not None}), len(set(vs))))
    return sorted(result, key=repr)


def collected(df):
    return sorted((tuple(r) for r in df.select("k", "rows", "s", "s_n", "top", "users", "values").collect()), key=repr)


@pytest.fixture(scope="module")
def kept(spark):
    data = rows()
    df = spark.createDataFrame(data, "k string, d date, v int, u int")
    root = f"{shared_dir(spark)}/rolling-{uuid.uuid4().hex}"
    rolling.store(df, measures(), root, DAY0, DAY0 + 30)
    for first, last in ((31, 31), (32, 40), (41, 59), (59, 59)):  # the last one again, as after a job that was cut off
        rolling.store(df, measures(), root, DAY0 + first, DAY0 + last)
    return data, df, root


@pytest.mark.parametrize("first, after", [(0, 60), (3, 52), (17, 18), (33, 70), (55, 70), (60, 70), (-5, 200)])
def test_any_window_equals_the_full_recomputation(spark, kept, first, after):
    data, df, root = kept
    got = rolling.window(spark, measures(), root, DAY0 + first, DAY0 + after, fresh=df, last=DAY0 + 59)
    assert collected(got) == plain(data, DAY0 + first, DAY0 + after)


def test_blocks_are_few_and_cover_each_day_once():
    for first in range(0, 130, 7):
        for after in range(first, 140, 5):
            blocks = rolling.cover(DAY0 + first, DAY0 + after, DAY0, DAY0 + 120)
            days = [d for level, s in blocks for d in range(s << level, (s + 1) << level)]
            assert days == list(range(DAY0 + first, min(DAY0 + after, DAY0 + 121)))
            assert len(blocks) <= 2 * 7


def test_a_window_reads_its_parts_only(spark, kept):
    _, _, root = kept
    out = rolling.window(spark, measures(), root, DAY0 + 3, DAY0 + 52, last=DAY0 + 59)
    read = {tuple(int(x.split("=")[1]) for x in path.split("/")[-3:-1]) for path in out.inputFiles()}
    assert read == set(rolling.cover(DAY0 + 3, DAY0 + 52, DAY0, DAY0 + 59)) and len(read) <= 10


def test_nothing_stored(spark):
    df = spark.createDataFrame([], "k string, d date, v int, u int")
    root = f"{shared_dir(spark)}/rolling-{uuid.uuid4().hex}"
    assert rolling.window(spark, measures(), root, 0, 10, fresh=df).count() == 0
    with pytest.raises(ValueError):
        rolling.window(spark, measures(), root, 0, 10)
