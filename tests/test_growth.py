"""Work that must not grow faster than the tables."""

import tempfile
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from catalogue import queries
from wordmill import (
    FieldSpec,
    Mapping,
    Match,
    QueryString,
    Wildcard,
    analyze_stages,
    build_index,
    create_index,
    highlight,
    hits,
    index_all,
    open_index,
    requests,
    search_many,
    suggest,
)
from wordmill.operators import clauses
from wordmill.operators import suggest as suggesting
from wordmill.sources import store

TEXT = Mapping((FieldSpec("text"),), "id")


def texts(spark, first, last, words="some words of a text"):
    return spark.range(first, last).select("id", F.concat(F.lit(words + " w"), F.col("id").cast("string")).alias("text"))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_an_index_that_outgrows_its_shards_gets_more(spark, monkeypatch):
    monkeypatch.setattr(store, "BYTES_PER_SHARD", 100)
    rows = texts(spark, 0, 40)
    create_index(spark, "growing", TEXT, rows.schema, shards=2)
    index_all(spark, "growing", rows)
    first = open_index(spark, "growing")
    assert first.shards > 5
    index_all(spark, "growing", texts(spark, 30, 300, "later words"))
    index = open_index(spark, "growing")
    assert index.shards > first.shards and index.docs.count() == 300
    assert hits(index, Match("text", "some")).count() == 30 and hits(index, Match("text", "later")).count() == 270
    assert index.postings.groupBy("term", "id").count().where("count > 1").count() == 0
    store.delete_index(spark, "growing")


def test_a_shard_is_sorted_in_the_memory_of_a_task(spark):
    rows = texts(spark, 0, 20).withColumn("text", F.repeat("text", 100_000))
    assert store.shard_count(rows, TEXT) >= 5


def test_texts_stay_in_their_buckets_when_marked(spark):
    """Hits that lie elsewhere move to the documents, not the documents to them."""
    index = build_index(spark, "marked", texts(spark, 0, 60), TEXT, shards=3)
    found = spark.range(0, 60, 2).union(spark.range(1, 60, 2))
    marked = highlight(index, found, Match("text", "w7"), "text")
    assert [tuple(r) for r in marked.collect()] == [(7, "some words of a text <em>w7</em>")]
    moved = [line for line in plan(marked).splitlines() if "Exchange hashpartitioning" in line]
    assert moved and all(", 3), REPARTITION_BY_NUM" in line for line in moved)


@pytest.mark.parametrize("same_first", [0, 1, 2])
def test_few_words_need_no_table_of_neighbours(spark, monkeypatch, same_first):
    rows = spark.createDataFrame([(1, "winter wintry water"), (2, "winner linter"), (3, "winter")], "id bigint, text string")
    index = build_index(spark, f"few_words_{same_first}", rows, TEXT, shards=2)
    asked, rule = requests(index, {"a": ("text", "wintr lintr winter")}), suggesting.Spelling(same_first=same_first)
    monkeypatch.setattr(suggesting, "DICTIONARY", 0)
    direct = sorted(map(tuple, suggest(index, asked, spelling=rule).collect()))
    assert not spark.sql(f"SHOW TABLES IN {index.database} LIKE '*{index.name}*near*'").collect()
    monkeypatch.setattr(suggesting, "FEW_WORDS", 0)
    assert direct and direct == sorted(map(tuple, suggest(index, asked, spelling=rule).collect()))


def test_rows_of_query_strings_stay_with_the_documents(spark, monkeypatch):
    """Where the queries are few, what they find in the documents is folded without a shuffle."""
    index = build_index(spark, "folded", texts(spark, 0, 50), TEXT, shards=3)
    asked = spark.createDataFrame([(k, f"+(w{k} | w{k + 1}) -w7 some") for k in range(9)], "query_id bigint, q string")
    found = hits(index, QueryString(("text",), F.col("q")), asked)
    got = sorted((r["query_id"], r["id"]) for r in found.collect())
    assert got == [(k, d) for k in range(9) for d in (k, k + 1) if d != 7]
    assert "SortMergeJoin" not in plan(found)
    monkeypatch.setattr(clauses, "small", lambda df, rows: df.hint("merge"))
    assert got == sorted((r["query_id"], r["id"]) for r in hits(index, QueryString(("text",), F.col("q")), asked).collect())


def test_pages_of_wildcards_need_few_postings(spark, monkeypatch):
    """What a pattern finds is not all met when its first documents are asked; pages are those of all hits."""
    rows = spark.range(0, 60).selectExpr("id", "concat('common w', id, ' x', id % 7, if(id > 40, ' late', '')) AS text")
    index = build_index(spark, "first_wildcards", rows, TEXT, shards=3)
    patterns = ["*w*", "*w5*", "*m*", "late", "*x3*", "w?", "*", "*nosuch*", "*ate*", "x?"]
    asked = spark.createDataFrame([(k, p) for k, p in enumerate([*patterns, "*w*", None])], "query_id bigint, q string")
    query = Wildcard("text", F.col("q"))
    every = {}
    for row in hits(index, query, asked).collect():
        every.setdefault(row["query_id"], []).append(row["id"])
    met = []
    whole = clauses.meet_postings
    monkeypatch.setattr(clauses, "meet_postings", lambda *a, **k: met.append(a[1].count()) or whole(*a, **k))
    for offset, size in ((0, 4), (3, 5), (0, 100)):
        found = search_many(index, asked, query, offset=offset, size=size).orderBy("query_id", "rank").collect()
        got = {}
        for row in found:
            assert row["score"] == 1.0
            got.setdefault(row["query_id"], []).append(row["id"])
        want = {k: sorted(v)[offset : offset + size] for k, v in every.items()}
        assert got == {k: v for k, v in want.items() if v}
    assert met[0] < met[1] < met[2]


def test_equal_words_pass_a_chain_once(spark):
    """The stages of all words, counted, equal those of the words one by one."""
    rows = spark.createDataFrame([(1, "Ties were things, the ties"), (2, "thing Thing O'Neil 3.14"), (3, None)], "doc_id long, text string")
    stages = analyze_stages(rows, "text", queries.SAMPLE_CHAIN, ["doc_id"])
    want = stages.groupBy("stage_no", "stage", "token").agg(F.count("*"), F.sum("position")).collect()
    folder = tempfile.mkdtemp()
    rows.write.parquet(f"{folder}/documents.parquet")
    found = queries.analyze_explain(spark, folder)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want))
    # the stages are listed from rows that were grouped before
    text = plan(found)
    assert text.index("Generate inline") < text.index("partial_count")


@pytest.mark.parametrize("first", [True, False])
def test_catch_all_shares_the_tokens_of_a_column(spark, monkeypatch, first):
    """A text is cut, sorted and grouped once for its own field and for the field of all columns."""
    rows = [
        (1, "red fish, red boat", "fish", 3, ["red", None]),
        (2, None, "only a head", None, []),
        (3, "", None, 7, None),
        (4, "7 boats. O'Neil", "O", 7, ["Neil's"]),
        (5, "alone", None, None, None),
    ]
    docs = spark.createDataFrame(rows, "id long, text string, head string, n int, tags array<string>")
    if not first:
        docs = docs.select("head", "tags", "id", "text", "n")
    mapping = Mapping((FieldSpec("tags"), FieldSpec("text"), FieldSpec("head", analyzer="english")), "id").with_catch_all(docs.schema)
    shared = store.postings_of(docs, mapping)
    text = plan(shared)
    monkeypatch.setattr(store, "_shared", lambda docs, mapping: None)
    apart = store.postings_of(docs, mapping)
    columns = ["field", "term", "id", "tf", "dl", "positions"]
    key = lambda r: (r[0], r[1], r[2])
    want = sorted(map(tuple, apart.select(columns).collect()), key=key)
    assert sorted(map(tuple, shared.select(columns).collect()), key=key) == want
    assert {r[0] for r in want} == {"tags", "text", "head", "_all"}
    assert text.count("Window ") < plan(apart).count("Window ")


@pytest.mark.parametrize("edits", [0, 1, 2, 3])
def test_neighbours_are_made_once_and_not_sorted(spark, edits):
    """Every choice of letters is left out once; nothing reads the order of the table."""
    rule = suggesting.Spelling(edits=edits)
    words = ["aabb", "abcdefghijklmnop", "a", "ab", "", "mississippi", "zzzzzz"]
    frame = spark.createDataFrame([(word,) for word in words], "word string")
    for word, found in frame.select("word", rule.neighbours(F.col("word"))).collect():
        start = word[: suggesting.BEGINNING]
        left = [set(out) for n in range(edits + 1) for out in combinations(range(1, len(start)), n)]
        want = {"".join(c for i, c in enumerate(start) if i not in out) for out in left}
        assert len(found) == len(want) and set(found) == want
    index = build_index(spark, f"near_{edits}", texts(spark, 0, 5), TEXT, shards=2)
    suggesting.neighbour_table(index, "text", rule)
    table = index.table_name(suggesting._kind(index, "text", rule))
    told = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
    assert told["Bucket Columns"] == "[`near`]" and told.get("Sort Columns", "[]") == "[]"
