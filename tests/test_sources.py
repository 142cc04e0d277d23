"""Delimited sources account for every record."""

import uuid

from hammerline.session import shared_dir
from hammerline.sources import files


def test_every_record_is_kept_or_put_aside(spark):
    folder = f"{shared_dir(spark)}/source-{uuid.uuid4().hex}"
    texts = {"a": ["id,price,note", "1,10.5,fine", "2,NULL,\"quoted, comma\"", "3,abc,bad number", "4,5", "5,6,7,8", ",NA,", "6,1e3,x"], "b": ["id,price,note", "7,1,ok"], "c": ["id,price,note"]}
    for name, lines in texts.items():
        spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.text(f"{folder}/{name}")
    rows, bad, counts = files.read_accounted(spark, f"{folder}/*", ["id", "price", "note"], True, ["id", "price"])
    assert sorted(((r["id"], r["price"], r["note"]) for r in rows.collect()), key=repr) == sorted(
        [(1.0, 10.5, "fine"), (2.0, None, "quoted, comma"), (None, None, None), (6.0, 1000.0, "x"), (7.0, 1.0, "ok")], key=repr)
    assert sorted((r["record"], r["reason"]) for r in bad.collect()) == [
        ("3,abc,bad number", "price is no number"), ("4,5", "another number of fields"), ("5,6,7,8", "another number of fields")]
    assert sorted((r["read"], r["kept"], r["quarantined"]) for r in counts.collect()) == [(1, 1, 0), (7, 4, 3)]
    assert all(f"/{name}/" in r["_file"] for name, r in zip("a", bad.collect()))
    files.write_quarantine(bad, f"{folder}-aside")
    files.write_quarantine(bad, f"{folder}-aside")
    assert spark.read.parquet(f"{folder}-aside").count() == 6


def test_no_records(spark):
    folder = f"{shared_dir(spark)}/source-{uuid.uuid4().hex}"
    spark.createDataFrame([("id,price",)], "value string").coalesce(1).write.text(folder)
    rows, bad, counts = files.read_accounted(spark, folder, ["id", "price"], True, ["id"])
    assert rows.count() == bad.count() == counts.count() == 0
