"""Hard negatives: rows of another label that score almost as well as an anchor's best rows of its own label.

Every row stores its angles to a few reference directions. Two rows with angles t and u to one direction enclose an angle between
|t - u| and t + u (or 2 pi - t - u); the tightest limits over all directions, as cosines times both norms and rounded outwards, bound
their score. Only pairs whose bounds reach a wanted window are scored, with exact integers.

The anchors are a stated query set. Rows are dealt by range of their nearest direction and the angle to it into groups of bounded size;
each group is held by a task while the anchors stream past in blocks. A group's blocks of near rows have angle ranges of their own, so
most are put aside whole. A task gives an anchor's best few of its group; those are ranked together.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hammerline.session import settle

DIRECTIONS = 8
SAMPLE = 2000  # rows of which the directions are chosen; a bound on what the driver sees
GROUP_BYTES = 32 * 2**20  # vectors that a task holds
BLOCK = 1024  # rows that are put aside or looked at together
ANCHORS = 256  # anchors that pass a group together
SLACK = 1e-6  # radians; far above the rounding of an angle
WINDOW = (30, 90)  # percent of the positive's score
MOST = 2**63 - 1


def matrix(column: pa.Array, size: int, scale: float) -> np.ndarray:
    """floor(scale * component) of a list column as whole doubles, short vectors filled up with zeros."""
    values = np.floor(scale * column.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    if (lengths == size).all():
        return values.reshape(len(column), size)
    out = np.zeros((len(column), size))
    out[np.arange(size) < lengths[:, None]] = values
    return out


def unit(q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Directions and norms of rows; a row of zeros keeps zeros."""
    most = np.abs(q).max(axis=1, initial=0)
    shrunk = q / np.where(most > 0, most, 1)[:, None]
    length = np.sqrt((shrunk * shrunk).sum(axis=1))
    return shrunk / np.where(length > 0, length, 1)[:, None], most * length


def angles(directions: np.ndarray, references: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(directions @ references.T, -1, 1))


def reference_directions(rows: DataFrame, size: int, scale: float) -> np.ndarray:
    """Directions far from each other, chosen among the rows of the smallest hashes."""
    found = rows.select("vector").orderBy(F.xxhash64("vec_id", "vector"), "row").limit(SAMPLE).toArrow().column("vector").combine_chunks()
    directions, norms = unit(matrix(found, size, scale)) if len(found) else (np.zeros((0, size)), np.zeros(0))
    directions = directions[norms > 0]
    chosen = directions[:1] if len(directions) else np.zeros((1, size))
    while len(chosen) < min(DIRECTIONS, len(directions)):
        chosen = np.vstack([chosen, directions[angles(directions, chosen).min(axis=1).argmax()]])
    return chosen


def _place(references: np.ndarray, scale: float):
    def run(batches):
        for batch in batches:
            found = angles(unit(matrix(batch.column("vector"), references.shape[1], scale))[0], references)
            near = found.argmin(axis=1) if len(found) else np.zeros(0, np.int64)
            stored = pa.FixedSizeBinaryArray.from_buffers(pa.binary(8 * found.shape[1]), len(found), [None, pa.py_buffer(np.ascontiguousarray(found))]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near, pa.int32()), pa.array(found[np.arange(len(found)), near]), stored],
                                             names=[*batch.schema.names, "near", "away", "angles"])
    return run


def _outward(least: np.ndarray, most: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of cosine times size, for cosines in [least, most] and sizes in [low, high], rounded outwards."""
    with np.errstate(invalid="ignore", over="ignore"):
        slack = 1 + 1e-9 * high
        below, above = np.where(least < 0, least * high, least * low) - slack, np.where(most > 0, most * high, most * low) + slack
    return np.where(np.isfinite(high), below, -np.inf), np.where(np.isfinite(high), above, np.inf)


def pair_bounds(a_norms, a_angles, b_norms, b_angles) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the score of every row of a with every row of b."""
    near, far = np.zeros((len(a_norms), len(b_norms))), np.full((len(a_norms), len(b_norms)), math.pi)
    for k in range(a_angles.shape[1]):
        a, b = a_angles[:, k, None], b_angles[None, :, k]
        np.maximum(near, np.abs(a - b), out=near)
        np.minimum(far, math.pi - np.abs(math.pi - (a + b)), out=far)
    with np.errstate(over="ignore"):
        size = a_norms[:, None] * b_norms[None, :]
    return _outward(np.cos(np.minimum(far + SLACK, math.pi)), np.cos(np.maximum(near - SLACK, 0)), size, size)


def block_bounds(a_norms, a_angles, b_norms, b_angles) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the score of every row of a with any row of one block."""
    low, high = b_angles.min(axis=0), b_angles.max(axis=0)
    near = np.maximum(0, np.maximum(low - a_angles, a_angles - high)).max(axis=1)
    far = np.where(a_angles + high <= math.pi, a_angles + high, np.where(a_angles + low >= math.pi, 2 * math.pi - a_angles - low, math.pi)).min(axis=1)
    with np.errstate(over="ignore"):
        return _outward(np.cos(np.minimum(far + SLACK, math.pi)), np.cos(np.maximum(near - SLACK, 0)), a_norms * b_norms.min(), a_norms * b_norms.max())


def scores(a: np.ndarray, b: np.ndarray, most: float) -> np.ndarray:
    """Exact inner products of whole doubles; ``most`` bounds their absolute values and those of all partial sums."""
    if most < 2**52:
        return np.rint(a @ b.T).astype(np.int64)
    whole = np.frompyfunc(int, 1, 1)
    return np.clip(whole(a).dot(whole(b).T), -MOST, MOST).astype(np.int64)


class Rows:
    """Rows of some record batches as arrays."""

    def __init__(self, table: pa.Table, size: int, scale: float):
        self.row = table.column("row").to_numpy()
        ids = table.column("vec_id").combine_chunks()
        self.no_id = ids.is_null().to_numpy(zero_copy_only=False)
        self.vec_id = ids.fill_null(0).to_numpy(zero_copy_only=False)
        self.label = table.column("label").to_numpy()
        self.q = matrix(table.column("vector").combine_chunks(), size, scale)
        self.norm = unit(self.q)[1]
        self.angles = np.frombuffer(b"".join(table.column("angles").to_pylist())).reshape(len(self.row), -1)
        self.positives = table.column("positives").to_pylist()

    def best(self, at: np.ndarray, score: np.ndarray, k: int) -> list[tuple]:
        """The ``k`` highest scores of the rows ``at``, as (-score, no id, id, row); ties by smaller id, missing ids last."""
        if len(at) > k:
            enough = score >= np.partition(score, -k)[-k]
            at, score = at[enough], score[enough]
            if len(at) > k:
                first = np.lexsort((self.row[at], self.vec_id[at], self.no_id[at], -score))[:k]
                at, score = at[first], score[first]
        return [(-int(s), bool(self.no_id[r]), int(self.vec_id[r]), int(self.row[r])) for r, s in zip(at, score, strict=True)]


def _windows(anchors: Rows, window: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Lowest and highest wanted score for each positive; an anchor with fewer positives has empty windows at the end."""
    most = max((len(p) for p in anchors.positives), default=0)
    low, high = np.full((len(anchors.row), most), MOST, dtype=np.int64), np.full((len(anchors.row), most), -MOST, dtype=np.int64)
    for i, found in enumerate(anchors.positives):
        for w, p in enumerate(found):
            low[i, w], high[i, w] = -(-window[0] * p["score"] // 100), window[1] * p["score"] // 100
    return low, high


def _passed(group: Rows, anchors: Rows, same: bool, wanted: int, window: tuple[int, int]) -> list[tuple[int, int, list[tuple]]]:
    """(anchor, window, best rows of the group) of a block of anchors; one window without limits when ``same`` label is wanted."""
    if same:
        floor, top = np.full((len(anchors.row), 1), -MOST, dtype=np.int64), np.full((len(anchors.row), 1), MOST, dtype=np.int64)
    else:
        floor, top = _windows(anchors, window)
    kept: dict[tuple[int, int], list[tuple]] = {}
    blocks = [slice(at, min(at + BLOCK, len(group.row))) for at in range(0, len(group.row), BLOCK)]
    limits = [block_bounds(anchors.norm, anchors.angles, group.norm[b], group.angles[b]) for b in blocks]
    for k in sorted(range(len(blocks)), key=lambda k: -limits[k][1].mean()):
        b = blocks[k]
        open_ = ((limits[k][1][:, None] >= floor) & (limits[k][0][:, None] <= top) & (floor <= top)).any(axis=1)
        some = np.flatnonzero(open_)
        if not len(some):
            continue
        least, most = pair_bounds(anchors.norm[some], anchors.angles[some], group.norm[b], group.angles[b])
        hit = np.zeros(least.shape, dtype=bool)
        for w in range(floor.shape[1]):
            hit |= (most >= floor[some, w, None]) & (least <= top[some, w, None]) & (floor[some, w, None] <= top[some, w, None])
        hit &= (anchors.label[some, None] == group.label[None, b]) if same else (anchors.label[some, None] != group.label[None, b])
        hit &= anchors.row[some, None] != group.row[None, b]
        i, r = np.flatnonzero(hit.any(axis=1)), np.flatnonzero(hit.any(axis=0))
        if not len(i):
            continue
        with np.errstate(over="ignore"):
            bound = anchors.norm[some[i]].max() * group.norm[b][r].max()
        found = scores(anchors.q[some[i]], group.q[b][r], bound)
        at = np.arange(b.start, b.stop)[r]
        for j, anchor in enumerate(some[i].tolist()):
            score, hits = found[j], hit[i[j], r]
            for w in range(floor.shape[1]):
                inside = hits & (score >= floor[anchor, w]) & (score <= top[anchor, w])
                if inside.any():
                    merged = sorted([*kept.get((anchor, w), []), *group.best(at[inside], score[inside], wanted)])[:wanted]
                    kept[anchor, w] = merged
                    if len(merged) == wanted:  # a lower score can't be wanted any more
                        floor[anchor, w] = max(floor[anchor, w], -merged[-1][0])
    return [(anchor, w, found) for (anchor, w), found in kept.items()]


FOUND = "anchor_row bigint, anchor_id bigint, place int, positive_id bigint, positive_score bigint, vec_id bigint, row bigint, score bigint"


def _pass(size: int, scale: float, same: bool, wanted: int, window: tuple[int, int]):
    """Rows come sorted by group, its own rows (tag 0) before the anchors (tag 1)."""
    def run(batches):
        at, held, group = None, [], None
        for batch in batches:
            key = 2 * batch.column("group").to_numpy().astype(np.int64) + batch.column("tag").to_numpy()
            cuts = np.flatnonzero(np.diff(key)) + 1
            for start, end in zip([0, *cuts], [*cuts, len(key)], strict=True):
                if start == end:
                    continue
                part = batch.slice(start, end - start)
                if key[start] >> 1 != at:
                    at, held, group = key[start] >> 1, [], None
                if not key[start] & 1:
                    held.append(part)
                    continue
                if group is None and held:
                    group, held = Rows(pa.Table.from_batches(held), size, scale), []
                for k in range(0, part.num_rows if group else 0, ANCHORS):
                    anchors = Rows(pa.Table.from_batches([part.slice(k, ANCHORS)]), size, scale)
                    out = []
                    for i, w, found in _passed(group, anchors, same, wanted, window):
                        positive = {"vec_id": None, "score": None} if same else anchors.positives[i][w]
                        anchor_id = None if anchors.no_id[i] else int(anchors.vec_id[i])
                        out += [(int(anchors.row[i]), anchor_id, w, positive["vec_id"], positive["score"], None if none else i_, row, -s) for s, none, i_, row in found]
                    if out:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), [
                            pa.int64(), pa.int64(), pa.int32(), *[pa.int64()] * 5], strict=True)], names=[f.split()[0] for f in FOUND.split(", ")])
    return run


def mine(df: DataFrame, anchor: Column, label: Column, id_col: str = "vec_id", vector_col: str = "embedding", positives: int = 5, negatives: int = 10,
         window: tuple[int, int] = WINDOW, scale: float = 256) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score), ``rank`` from 1 for each anchor row and positive.

    Rows for which ``anchor`` is true are the queries, against all rows. A component x becomes floor(scale * x); a score is the inner
    product. An anchor's positives are its best ``positives`` other rows of its label (compared as text); its hard negatives for one are
    the best ``negatives`` rows of other labels that score between the two percentages of ``window`` of the positive's score. Ties go by
    smaller id, missing ids last. Every row is one of its own, so repeated rows can be each other's positives and repeat in the result.
    Rows with a null label, a null vector or a component that is null or not finite (scaled, too) take no part; a shorter vector
    counts as filled up with zeros; scores beyond 64 bits stop at its limits. A negative positive score has an empty window. Other
    columns are left behind, whatever their names; an empty table gives an empty result.
    """
    spark = df.sparkSession
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x * scale) == float("inf")))
    rows = df.select(F.col(id_col).cast("bigint").alias("vec_id"), F.xxhash64(label.cast("string")).alias("label"), label.isNotNull().alias("labelled"),
                     F.col(vector_col).cast("array<double>").alias("vector"), F.coalesce(anchor, F.lit(False)).alias("anchor"))
    rows = rows.filter(F.col("labelled") & F.col("vector").isNotNull() & ~bad).drop("labelled")
    rows = settle(rows.withColumn("row", F.monotonically_increasing_id()))
    n, size = rows.agg(F.count("*"), F.coalesce(F.max(F.size("vector")), F.lit(0))).first()
    groups = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(n * 8 * max(1, size) / GROUP_BYTES))
    placed = rows.mapInArrow(_place(reference_directions(rows, size, scale), scale), f"{_ddl(rows)}, near int, away double, angles binary")
    placed = settle(placed.repartitionByRange(groups, "near", "away", "row").withColumn("group", F.spark_partition_id()))
    last = placed.agg(F.coalesce(F.max("group"), F.lit(0))).first()[0]
    everywhere = F.explode(F.sequence(F.lit(0), F.lit(last)))
    place = "positives array<struct<vec_id: bigint, score: bigint>>"
    mine_ = placed.drop("anchor").select("*", F.lit(0).alias("tag"), F.lit(None).cast(place.split(" ", 1)[1]).alias("positives"))

    def passed(anchors: DataFrame, same: bool, wanted: int) -> DataFrame:
        both = mine_.unionByName(anchors.withColumns({"group": everywhere, "tag": F.lit(1)}))
        both = both.repartition(groups, "group").sortWithinPartitions("group", "tag", "near", "away", "row")
        found = both.mapInArrow(_pass(size, scale, same, wanted, window), FOUND)
        first = Window.partitionBy("anchor_row", "place").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
        return found.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= wanted)

    anchors = placed.filter("anchor").drop("anchor", "group")
    own = passed(anchors.withColumn("positives", F.lit(None).cast(place.split(" ", 1)[1])), True, positives)
    own = own.groupBy(F.col("anchor_row").alias("row")).agg(F.sort_array(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("found"))
    own = own.select("row", F.transform("found", lambda p: F.struct(p["vec_id"].alias("vec_id"), p["score"].alias("score"))).alias("positives"))
    hard = passed(settle(anchors.join(own, "row")), False, negatives)
    return hard.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)
