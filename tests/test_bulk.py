import json

import pytest
from shelf import ROWS, SCHEMA

from wordmill import FieldSpec, Mapping, bulk_lines, index_all, open_index, read_bulk


def write(path, lines):
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def pairs(rows):
    for key, doc in rows:
        yield "    " + json.dumps({"index": {"_id": key}})
        yield "    " + json.dumps(doc)


def test_books_round_trip(spark, tmp_path):
    books = spark.createDataFrame(ROWS, SCHEMA)
    path = str(tmp_path / "books")
    bulk_lines(books, "_id").coalesce(1).write.text(path)
    back = read_bulk(spark, path)
    assert {r["_id"]: r["title"] for r in back.collect()} == {str(b[0]): b[1] for b in ROWS}
    assert dict(back.dtypes)["authors"] == "array<string>"
    assert dict(back.dtypes)["num_reviews"] == "bigint"


def test_pairs_across_splits(spark, tmp_path):
    """Two files of many splits, whose borders fall between and inside the pairs."""
    folder = tmp_path / "bulk"
    folder.mkdir()
    expected = {}
    for part in range(2):
        rows = [(part * 1000 + n, {"n": n, "text": "x" * (n % 70), "index": None}) for n in range(700)]
        expected.update({str(key): doc["n"] for key, doc in rows})
        write(folder / f"part{part}.json", ["", *pairs(rows), "  "])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        back = read_bulk(spark, str(folder), "n bigint, text string")
        assert back.rdd.getNumPartitions() >= 1
        assert {r["_id"]: r["n"] for r in back.collect()} == expected
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_last_pair_of_a_key_wins(spark, tmp_path):
    rows = [(1, {"text": "old words"}), (2, {"text": "other"}), (1, {"text": "new words"})]
    back = read_bulk(spark, write(tmp_path / "b.json", pairs(rows)), "text string")
    with pytest.raises(ValueError, match="occurs 2 times"):
        index_all(spark, "bulk_books", back.drop("_order"), Mapping((FieldSpec("text"),), "_id"), shards=2)
    one = back.where("_id = '2'").drop("_order")
    assert index_all(spark, "bulk_books", one, Mapping((FieldSpec("text"),), "_id"), shards=2) is True
    again = read_bulk(spark, write(tmp_path / "c.json", pairs(rows)), "text string")
    from pyspark.sql import functions as F

    assert index_all(spark, "bulk_books", again.select("_id", "text", "_order"), order_by=F.col("_order"))
    found = {r["_id"]: r["text"] for r in open_index(spark, "bulk_books").docs.collect()}
    assert found == {"1": "new words", "2": "other"}


def test_other_actions_are_refused(spark, tmp_path):
    path = write(tmp_path / "d.json", ['{"delete": {"_id": 1}}', '{"text": "x"}'])
    with pytest.raises(Exception, match="not an index action"):
        read_bulk(spark, path, "text string").collect()
    path = write(tmp_path / "e.json", ["/books/book/_bulk", *pairs([(1, {"text": "x"})])])
    with pytest.raises(Exception, match="is missing"):
        read_bulk(spark, path, "text string").collect()


def test_a_field_may_be_called_index(spark, tmp_path):
    rows = [(1, {"index": {"a": 1}, "rating": 4.5, "none": None}), (2, {"index": None, "tags": ["x"]})]
    back = read_bulk(spark, write(tmp_path / "f.json", pairs(rows)))
    assert dict(back.dtypes)["index"] == "struct<a:bigint>" and dict(back.dtypes)["rating"] == "double"
    assert {r["_id"]: (r["index"], r["rating"], r["tags"]) for r in back.collect()} == {"1": ((1,), 4.5, None), "2": (None, None, ["x"])}


def test_bad_lines_raise(spark, tmp_path):
    path = write(tmp_path / "g.json", ['{"index": {"_id": 1}}', '{"text": '])
    with pytest.raises(Exception):
        read_bulk(spark, path, "text string").collect()
    for lines in (['{"index": {"_id": 1}}'], [*pairs([(1, {"text": "x"})]), '{"index": {"_id": 2}}']):
        with pytest.raises(Exception, match="is missing"):
            read_bulk(spark, write(tmp_path / "h.json", lines), "text string").collect()
