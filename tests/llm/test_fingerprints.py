"""Document fingerprints: edited texts, likeness and the block tables, each against a plain version."""

import hashlib

from hammerline.llm import fingerprints, hamming
from tests.llm.conftest import rows_of
from tests.llm.test_simhash_dedup import clustered


def plain(rows):
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1].encode()))
    out = []
    for k, (i, t) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        cut = len(t) // 4
        changed = t[:len(t) - cut] + following[:cut]
        a, b, c = map(fingerprints.fingerprint, (t, changed, following))
        out.append((i, len(t), hashlib.sha256(changed.encode()).hexdigest(), f"{a & (2 ** 64 - 1):016x}", f"{b & (2 ** 64 - 1):016x}",
                    fingerprints.likeness(a, b), fingerprints.likeness(a, c)))
    return sorted(out, key=repr)


COLUMNS = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def test_edits(edge, edge_rows):
    assert rows_of(fingerprints.compare_edits(edge), *COLUMNS) == plain(edge_rows)


def test_sample(sample):
    got = fingerprints.compare_edits(sample).toPandas()
    rows = [tuple(r) for r in sample.select("doc_id", "text").collect()]
    assert sorted(map(tuple, got[list(COLUMNS)].itertuples(index=False)), key=repr) == plain(rows)
    assert (got.near_edited > got.near_next).mean() > 0.9


def test_one_document_follows_itself(spark):
    one = spark.createDataFrame([(4, "some words of one text")], "doc_id bigint, text string")
    assert rows_of(fingerprints.compare_edits(one), *COLUMNS) == plain([(4, "some words of one text")])


def test_empty(empty):
    assert fingerprints.compare_edits(empty).count() == 0


def test_every_neighbour_is_counted_once(spark):
    values = clustered(11, 6, 50)
    want = {v: n for v in values if (n := sum(((v ^ w) & (2 ** 64 - 1)).bit_count() <= 3 for w in values) - 1)}
    fps = spark.createDataFrame([(v,) for v in values], "fp bigint")
    for shard in (4, 16, 2048):
        counted = hamming.tiles(fps, 3, shard).mapInArrow(fingerprints._count_near(3), "fp bigint, near bigint")
        got = {}
        for r in counted.collect():
            got[r["fp"]] = got.get(r["fp"], 0) + r["near"]
        assert got == want
    assert dict(map(tuple, fingerprints.neighbours(fps).collect())) == want
