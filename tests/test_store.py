import uuid

import pytest
from pyspark.sql import functions as F
from shelf import as_dict

from wordmill import (
    Bool,
    FieldSpec,
    Mapping,
    Match,
    MultiMatch,
    PhrasePrefix,
    QueryString,
    Term,
    aggregate,
    build_index,
    create_index,
    delete_index,
    describe_index,
    entry_mapping,
    highlight,
    hits,
    index_all,
    index_exists,
    numbered_index,
    open_index,
    search,
)

TEXT = Mapping((FieldSpec("text"),), "id")


def name():
    return "t" + uuid.uuid4().hex[:10]


def docs(spark, *rows):
    return spark.createDataFrame(list(rows), "id bigint, text string")


def contents(index):
    """Everything that a search reads, in a fixed order."""
    return [
        sorted(map(str, index.docs.collect())),
        sorted(map(str, index.postings.collect())),
        sorted(map(str, index.terms.collect())),
        sorted(map(str, index.lengths.collect())),
        sorted(map(str, index.stats.collect())),
    ]


def test_life_cycle(spark):
    index = numbered_index(4711)
    assert index == "zot4711"
    assert not index_exists(spark, index)
    assert not delete_index(spark, index)
    assert create_index(spark, index)
    assert not create_index(spark, index)
    found = open_index(spark, index)
    assert found.mapping == entry_mapping()
    assert found.docs.columns == ["_id", "kb_document_id", "content"]
    assert search(found, Match("content", "boston")).hits.collect() == []
    assert delete_index(spark, index)
    assert not index_exists(spark, index)
    with pytest.raises(LookupError):
        open_index(spark, index)


def test_entries_with_sub_field(spark):
    """Boosted content and a case-keeping second reading of the same column."""
    index = name()
    rows = [("e1", "d1", "Boston Offices"), ("e2", "d1", "a boston office"), ("e3", "d2", "Denver")]
    entries = spark.createDataFrame(rows, "_id string, kb_document_id string, content string")
    assert index_all(spark, index, entries)
    found = open_index(spark, index)
    one = as_dict(search(found, Match("content", "Boston")).hits, "_id")
    assert set(one) == {"e1", "e2"}
    raw = as_dict(search(found, Match("content.raw", "Boston Office")).hits, "_id")
    assert set(raw) == {"e1"}
    both = as_dict(search(found, MultiMatch(("content", "content.raw"), "Boston", kind="most_fields")).hits, "_id")
    assert both["e1"] == pytest.approx(one["e1"] + as_dict(search(found, Match("content.raw", "Boston")).hits, "_id")["e1"])
    assert as_dict(search(found, Term("kb_document_id", "d2")).hits, "_id") == {"e3": 1.0}
    described = {r["field"]: (r["type"], r["analyzer"], r["boost"]) for r in describe_index(found).collect()}
    assert described["content"] == ("text", "standard", 3.0)
    assert described["content.raw"] == ("text", "case_sensitive_text", 1.0)
    assert described["kb_document_id"] == ("keyword", "keyword", 1.0)
    assert described["_id"] == ("string", None, None)


def test_nothing_to_index(spark):
    index = name()
    assert not index_all(spark, index, docs(spark, (1, "x")).where("id > 1"), TEXT)
    assert not index_exists(spark, index)


def test_upserts(spark):
    once, twice = name(), name()
    first = [(1, "alpha beta"), (2, "beta gamma"), (3, "delta")]
    second = [(2, "beta beta"), (4, "alpha"), (5, None)]
    merged = [(1, "alpha beta"), (2, "beta beta"), (3, "delta"), (4, "alpha"), (5, None)]
    build_index(spark, once, docs(spark, *merged), TEXT, shards=3)
    assert index_all(spark, twice, docs(spark, *first), TEXT, shards=3)
    assert index_all(spark, twice, docs(spark, *second))
    assert contents(open_index(spark, once)) == contents(open_index(spark, twice))
    # the same rows again, and in two batches: nothing changes
    for batch in (merged, merged[:2], merged[2:]):
        assert index_all(spark, twice, docs(spark, *batch))
    assert contents(open_index(spark, once)) == contents(open_index(spark, twice))
    with pytest.raises(ValueError):
        index_all(spark, twice, docs(spark, *first), Mapping((FieldSpec("text", boost=2.0),), "id"))
    assert delete_index(spark, twice)


def test_last_row_of_a_hot_key_wins(spark):
    """Half of the rows share one key; each task reduces its copies before the shuffle."""
    rows = spark.range(2000).select(
        F.when(F.col("id") % 2 == 0, F.lit(7)).otherwise(F.col("id") + 1000).alias("id"),
        F.concat(F.lit("version "), F.col("id").cast("string")).alias("text"),
        F.col("id").alias("seq"),
    )
    index = build_index(spark, name(), rows, TEXT, shards=3, order_by=F.col("seq"))
    assert index.docs.where("id = 7").first()["text"] == "version 1998"
    assert index.docs.count() == 1001


def test_reduction_precedes_the_shuffle(spark):
    from wordmill.sources.store import latest

    text = latest(docs(spark, (1, "a")), "id", F.col("text"))._jdf.queryExecution().executedPlan().toString()
    exchange = text.index("Exchange hashpartitioning(id")
    assert "partial_max_by" in text[exchange:]


def test_structs_and_normalized_keywords(spark):
    rows = spark.createDataFrame(
        [(1, "fix it", ["a", "b"], ("Zoë",), ("x", 5)), (2, "fix that", ["test_x"], ("ZOE",), ("x", 7)),
         (3, "add", None, ("Bob",), ("y", None))],
        "id bigint, text string, files array<string>, committer struct<name:string>, stats struct<kind:string,lines:bigint>",
    )
    fields = (FieldSpec("text"), FieldSpec("committer.name", analyzer=None, normalized=True))
    index = build_index(spark, name(), rows, Mapping(fields, "id"), shards=2)
    untouched = Bool(must=(Match("text", "fix"),), must_not=(Term("files", "test_x"),))
    assert set(as_dict(hits(index, untouched), "id")) == {1}
    assert set(as_dict(hits(index, Term("committer.name", "zoé")), "id")) == {1, 2}
    buckets = aggregate(index, "committer.name", stats=["stats.lines"], query=Match("text", "fix that"))
    assert [(r["key"], r["doc_count"], r["stats_lines_sum"]) for r in buckets.collect()] == [("ZOE", 1, 7), ("Zoë", 1, 5)]
    source = search(index, Match("text", "fix"), source=["committer.name"], sort=[("stats.lines", "desc")]).hits
    assert [(r["id"], r["committer.name"]) for r in source.collect()] == [(2, "ZOE"), (1, "Zoë")]


def test_type_restriction(spark):
    rows = spark.createDataFrame([(1, "commit", "fix"), (2, "repo", "fix")], "id bigint, kind string, text string")
    index = build_index(spark, name(), rows, Mapping((FieldSpec("text"),), "id", type_column="kind"), shards=2)
    result = search(index, Match("text", "fix"), doc_type="repo")
    assert [r["id"] for r in result.hits.collect()] == [2]
    assert result.totals.first()["total"] == 1


def test_one_file_per_bucket(spark):
    """The documents are shuffled once, and a bucket is one file."""
    rows = spark.range(3000).select("id", F.concat(F.lit("w"), F.col("id").cast("string")).alias("text"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    index = build_index(spark, name(), rows, TEXT, shards=5)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    for kind in ("docs", "postings", "lengths", "terms"):
        files = [path.rsplit("/", 1)[1] for path in index.table(kind).inputFiles()]
        assert len(files) == 5, kind
        assert len({path.split("_")[1] for path in files}) == 5, kind


def test_documents_are_shuffled_once(spark, tmp_path):
    from wordmill.sources.store import latest

    docs(spark, (1, "a"), (2, "b")).write.parquet(str(tmp_path / "d"))
    read = spark.read.parquet(str(tmp_path / "d"))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    written = latest(read, "id", F.col("text")).repartition(partitions, "id").sortWithinPartitions("id")
    assert written._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


def test_the_last_row_by_order_wins_in_any_layout(spark, tmp_path):
    """Two files with the same key; Spark packs the larger file first."""
    a = [(1, "early", 1), (2, "null order", None)] + [(k, "filler words " * 20, 1) for k in range(10, 400)]
    b = [(1, "late", 2), (2, "given order", 0)]
    for part, rows in enumerate((a, b)):
        spark.createDataFrame(rows, "id bigint, text string, n int").coalesce(1).write.parquet(str(tmp_path / f"p={part}"))
    both = spark.read.parquet(str(tmp_path)).drop("p")
    index = name()
    with pytest.raises(ValueError, match="occurs 2 times"):
        build_index(spark, index, both, TEXT)
    found = build_index(spark, index, both, TEXT, order_by=F.col("n"))
    assert {r.id: r.text for r in found.docs.where("id < 10").collect()} == {1: "late", 2: "given order"}


def test_null_order_keeps_the_document(spark):
    index = name()
    found = build_index(spark, index, docs(spark, (1, "alpha")), TEXT, order_by=F.lit(None).cast("int"))
    assert [tuple(r) for r in found.docs.collect()] == [(1, "alpha")]


def test_null_keys_raise(spark):
    for order in (None, F.col("text")):
        with pytest.raises(ValueError, match="is null"):
            build_index(spark, name(), docs(spark, (None, "a"), (None, "b"), (1, "c")), TEXT, order_by=order)


def test_array_fields(spark):
    rows = [(1, ["ann lee", "bob ray"]), (2, ["lee bob", None]), (3, []), (4, None)]
    found = build_index(spark, name(), spark.createDataFrame(rows, "id bigint, members array<string>"), Mapping((FieldSpec("members"),), "id"))
    assert set(as_dict(search(found, Match("members", "lee")).hits, "id")) == {1, 2}
    # a phrase does not run from one element into the next
    assert set(as_dict(search(found, PhrasePrefix(("members",), "lee b")).hits, "id")) == {2}
    every = hits(found, Match("members", "lee"))
    shown = {r.id: r.highlight for r in highlight(found, every, Match("members", "lee"), "members").collect()}
    assert shown == {1: "ann <em>lee</em>\nbob ray", 2: "<em>lee</em> bob"}


def test_all_buckets(spark):
    rows = spark.createDataFrame([(k, str(k % 30)) for k in range(90)], "id bigint, text string")
    found = build_index(spark, name(), rows, TEXT)
    assert aggregate(found, "text", size=None).count() == 30
    assert aggregate(found, "text").count() == 10


def test_nested_groups_are_refused(spark):
    found = build_index(spark, name(), docs(spark, (1, "a b")), TEXT)
    for text in ("-(a (b | c))", "(a", "a)"):
        with pytest.raises(Exception, match="nested or not closed"):
            search(found, QueryString(("text",), text)).hits.collect()
    assert set(as_dict(search(found, QueryString(("text",), "+(a | c) b")).hits, "id")) == {1}
