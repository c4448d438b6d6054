"""What the plans of the hot paths must and must not hold."""

import pytest
from pyspark.sql import functions as F

from wordmill import (
    AsciiFolding,
    Bool,
    Chain,
    FieldSpec,
    LightEnglish,
    Lowercase,
    Mapping,
    Match,
    MatchAll,
    MultiMatch,
    PhrasePrefix,
    PorterStem,
    Possessive,
    QueryString,
    Stop,
    Term,
    Wildcard,
    build_index,
    hits,
    search,
    search_many,
)
from wordmill.operators import clauses, scoring
from wordmill.sources.store import postings_of


@pytest.fixture(scope="module")
def index(spark):
    """2,000 documents: `hot` is in every one, other words in few."""
    docs = spark.range(2000).select(
        F.col("id").alias("doc_id"),
        F.concat_ws(
            " ",
            F.lit("hot"),
            F.concat(F.lit("w"), (F.col("id") % 97).cast("string")),
            F.concat(F.lit("v"), (F.col("id") % 11).cast("string")),
            F.when(F.col("id") % 3 == 0, "hot hot"),
        ).alias("text"),
        (F.col("id") % 5).cast("string").alias("group"),
    )
    fields = (FieldSpec("text"), FieldSpec("tail", source="substring_index(text, ' ', -2)"), FieldSpec("group", analyzer=None))
    return build_index(spark, "plans", docs, Mapping(fields, "doc_id"), shards=4)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


SINGLE = [
    Match("text", "hot w1"),
    Match("text", "hot w1", operator="and"),
    MultiMatch(("text", "tail^2"), "hot w1"),
    Bool(must=(Match("text", "hot"),), must_not=(Match("text", "w1"),), should=(Match("tail", "w2"),)),
]


@pytest.mark.parametrize("query", SINGLE)
def test_scores_add_up_without_a_shuffle(index, query):
    """Documents lie in their buckets: query terms are broadcast and nothing moves."""
    text = plan(hits(index, query))
    assert "Exchange hashpartitioning" not in text
    assert "Bucketed: true" in text
    top = plan(search(index, query).hits)
    assert "TakeOrderedAndProject" in top and "Exchange hashpartitioning" not in top


@pytest.mark.parametrize("query", SINGLE[:1])
def test_terms_reach_the_scan(index, query):
    text = plan(hits(index, query))
    assert "PushedFilters: [In(term, [hot,w1])" in text
    assert "PartitionFilters: [isnotnull(field" in text
    # positions are not read unless a phrase needs them
    assert "positions" not in text


@pytest.mark.parametrize(
    "query",
    [
        *SINGLE,
        PhrasePrefix(("text",), "hot w1"),
        Wildcard("text", "*w1*"),
        QueryString(("text", "tail"), "+(hot | w1) -v2"),
        Term("group", "1"),
        MatchAll(),
    ],
)
def test_no_python_and_no_cartesian_product(index, query):
    text = plan(hits(index, query))
    for operator in ("PythonEval", "BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "NestedLoopJoin"):
        assert operator not in text


def test_build_needs_no_shuffle(index):
    """Postings are made where the bucketed documents lie."""
    assert "Exchange" not in plan(postings_of(index.docs, index.mapping))
    # nor with a chain that stems, stops and folds
    chain = Chain((Lowercase(), AsciiFolding(), Possessive(), Stop(), PorterStem(), LightEnglish()))
    stemmed = Mapping((FieldSpec("text", analyzer=chain),), "doc_id")
    assert "Exchange" not in plan(postings_of(index.docs, stemmed))


def test_column_queries_are_filters(index):
    text = plan(hits(index, Bool(must=(Term("group", "1"),))))
    assert "Join" not in text and "Exchange" not in text and "EqualTo(group,1)" in text


@pytest.mark.parametrize("clause", [{"must_not": (Term("group", "1"),)}, {"must": (Match("text", "hot"), Term("group", "1"))}])
def test_column_clauses_are_filters_in_the_same_buckets(index, clause):
    query = Bool(**{"must": (Match("text", "hot"),), **clause})
    text = plan(hits(index, query))
    assert "ShuffledHashJoin" in text and "EqualTo(group,1)" in text
    assert "Exchange hashpartitioning" not in text and "Union" not in text
    found = {r["doc_id"]: r["score"] for r in hits(index, query).collect()}
    plain = {r["doc_id"]: r["score"] for r in hits(index, Match("text", "hot")).collect()}
    ones = {d for d in plain if d % 5 == 1}
    if "must_not" in clause:
        assert found == {d: s for d, s in plain.items() if d not in ones}
    else:
        assert found == {d: s + 1 for d, s in plain.items() if d in ones}


def test_pages_are_fetched_by_key(index):
    result = search(index, Match("text", "w1"), size=3, source=["group"])
    text = plan(result.hits)
    assert "PushedFilters: [In(doc_id" in text
    ids = [r["doc_id"] for r in result.hits.collect()]
    assert ids == [r["doc_id"] for r in search(index, Match("text", "w1"), size=3).hits.collect()]


def queries(index, n=40):
    """Half of the queries are copies, and a hot word is in all of them."""
    ids = index.spark.range(n)
    text = F.concat(F.lit("hot w"), F.when(F.col("id") % 2 == 0, F.lit(3)).otherwise(F.col("id")).cast("string"))
    return ids.select(F.col("id").alias("query_id"), text.alias("text"))


def test_large_query_sets_are_sliced_not_broadcast(index, monkeypatch):
    asked = queries(index)
    expected = sorted(map(str, search_many(index, asked, Match("text", F.col("text")), size=4, digits=6).collect()))
    monkeypatch.setattr(scoring, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(scoring, "SLICE_ROWS", 100)
    found = search_many(index, asked, Match("text", F.col("text")), size=4, digits=6)
    assert sorted(map(str, found.collect())) == expected
    text = plan(found)
    assert "_slice" in text and "SortMergeJoin" in text
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text


def test_hot_term_is_cut_into_slices(index, monkeypatch):
    """No join key holds more than a slice of the postings of a frequent term."""
    monkeypatch.setattr(scoring, "SLICE_ROWS", 100)
    asked = index.terms.where("field = 'text' AND term = 'hot'").select("field", "term", "df")
    met = scoring._sliced(index, index.postings.where("field = 'text'").select("field", "term", "doc_id"), asked)
    assert met.count() == 2000
    text = plan(met)
    assert "_slice" in text
    slices = index.postings.where("field = 'text' AND term = 'hot'").select(
        F.pmod(F.xxhash64("doc_id"), F.lit(20)).alias("slice")
    )
    largest = slices.groupBy("slice").count().agg(F.max("count")).first()[0]
    assert largest < 200


def test_copies_of_a_query_are_answered_once(index):
    asked = queries(index)
    found = search_many(index, asked, Match("text", F.col("text")), size=2)
    by_query = {}
    for r in found.collect():
        by_query.setdefault(r["query_id"], []).append((r["rank"], r["doc_id"], r["score"]))
    assert len(by_query) == 40
    copies = {str(sorted(by_query[n])) for n in range(0, 40, 2)}
    assert len(copies) == 1


def test_top_k_is_limited_before_the_shuffle(index):
    assert "WindowGroupLimit" in plan(search_many(index, queries(index), Match("text", F.col("text")), size=2))


def test_only_probes_move_to_the_neighbours(index, monkeypatch):
    """The stored deletions stay in their buckets; with many probes those are shuffled to them."""
    from wordmill.operators import suggest

    rule = suggest.Spelling()
    probes = index.spark.range(10).select(F.lit("text").alias("field"), F.lit("hott").alias("token"), F.col("id").alias("near"))
    text = plan(suggest.joined(index, "text", probes, suggest.BROADCAST_ROWS + 1, rule))
    assert "Bucketed: true" in text and text.count("Exchange hashpartitioning(near") == 1
    assert "ShuffledHashJoin" in text and "Sort" not in text
    few = plan(suggest.joined(index, "text", probes, 10, rule))
    assert "BroadcastHashJoin" in few and "Exchange hashpartitioning" not in few


def test_prefixes_are_dealt_with_their_documents(index):
    """Postings under a prefix move by prefix and document; by the prefix alone only one row a prefix
    and task moves."""
    queries = index.spark.createDataFrame([(1, "hot w"), (2, "hot v1")], "query_id bigint, text string")
    text = plan(hits(index, PhrasePrefix(("text",), F.col("text")), queries))
    lines = [line.strip() for line in text.splitlines()]
    moved = [n for n, line in enumerate(lines) if "Exchange hashpartitioning(token" in line]
    alone = [n for n in moved if "doc_id" not in lines[n].split("hashpartitioning(")[1].split(")")[0]]
    assert len(moved) > len(alone)
    assert all("HashAggregate(keys=[token" in lines[n + 1] for n in alone)


def test_whole_grams_explode_no_dictionary(index):
    """Patterns with three letters in a row meet the stored grams; the dictionary is not read."""
    queries = index.spark.createDataFrame([(1, "*hot*"), (2, "ho?"), (3, "w1*")], "query_id bigint, text string")
    whole = plan(hits(index, Wildcard("text", F.col("text")), queries.where("query_id = 1")))
    mixed = plan(hits(index, Wildcard("text", F.col("text")), queries))
    assert "_terms[" not in whole and "_grams_" in whole
    assert "_terms[" in mixed
    found = {(r["query_id"], r["doc_id"]) for r in hits(index, Wildcard("text", F.col("text")), queries).collect()}
    assert {q for q, _ in found} == {1, 2, 3} and len([q for q, _ in found if q == 1]) == 2000


def test_only_survivors_are_scored(index):
    """A pruned batch reads the postings of documents that can reach the page, in their buckets."""
    queries = index.spark.createDataFrame([(n, f"hot w{n}") for n in range(20)], "query_id bigint, text string")
    found = search_many(index, queries, Match("text", F.col("text")), size=3, prune=True)
    assert {r["query_id"] for r in found.collect()} == set(range(20))
    text = plan(found)
    assert "ShuffledHashJoin [doc_id" in text

def test_batches_of_query_strings_fold_sets_of_words(index, monkeypatch):
    """Each text as it is answered alone: by the columns of its words, by maps, and by both in one batch."""
    texts = ["+(hot | w1) -v2 w3", "w1 | w2 group:2", "+w1 +group:1", "-hot w1", "(w1 v1) | (w2 v2)", "hot", "w1 w1", "...",
             "+hot w1 | w2 | w3 | w4 | w5 | w6 | w7 -v1"]
    query = QueryString(("text", "tail^2", "group"), F.col("text"), default_operator="and")
    alone = {
        (n, r.doc_id, round(r.score, 6))
        for n, text in enumerate(texts)
        for r in hits(index, QueryString(query.fields, text, default_operator="and")).collect()
    }
    assert {n for n, _, _ in alone} >= {0, 1, 4, 5, 6, 8}
    # two texts with one id are answered one by one, under it
    asked = [*enumerate(texts), (50, "hot"), (50, "w1 v1")]
    queries = index.spark.createDataFrame(asked, "query_id int, text string")
    twice = None
    for few in (clauses.FEW_WORDS, 2, 0):
        monkeypatch.setattr(clauses, "FEW_WORDS", few)
        batch = hits(index, query, queries)
        if few == 6:
            # no list of words for every query and document
            assert "collect_list(struct(word" not in plan(hits(index, query, queries.where("query_id < 8")))
        found = [(r.query_id, r.doc_id, round(r.score, 6)) for r in batch.collect()]
        assert {r for r in found if r[0] != 50} == alone
        own = sorted(r for r in found if r[0] == 50)
        assert own and own == (twice or own)
        twice = own
    none = hits(index, query, queries.where("false"))
    assert none.collect() == [] and none.columns == batch.columns


def test_places_of_phrases_are_looked_up(index):
    """Against the words of the texts: one place or several on either side, one word or two before the prefix."""
    spark = index.spark
    rows = [(1, "a b a b c"), (2, "a c b"), (3, "a a a b b"), (4, "b a"), (5, "c a b c a b ba"), (6, "a x ba bb")]
    own = build_index(spark, "places", spark.createDataFrame(rows, "id long, text string"), Mapping((FieldSpec("text"),), "id"), shards=2)
    asked = ["a b", "b a", "a a", "a b c", "a a b", "c a b", "a x b", "b c"]
    queries = spark.createDataFrame(list(enumerate(asked)), "query_id int, q string")
    found = hits(own, PhrasePrefix(("text",), F.col("q")), queries)
    want = {}
    for n, phrase in enumerate(asked):
        *fixed, last = phrase.split()
        for key, text in rows:
            words = text.split()
            size = len(fixed)
            times = sum(words[i : i + size] == fixed and w.startswith(last) for i, w in enumerate(words[size:]))
            if times:
                want[n, key] = times
    assert {(r.query_id, r.id) for r in found.collect()} == set(want)
    # alone each text has the same score
    for n, phrase in enumerate(asked):
        single = {r.id: round(r.score, 9) for r in hits(own, PhrasePrefix(("text",), phrase)).collect()}
        assert single == {r.id: round(r.score, 9) for r in found.where(F.col("query_id") == n).collect()}
    # the lists of two are the last to be compared
    text = plan(found)
    assert text.index("array_contains") < text.index("array_intersect(common")
    spark.sql(f"DROP VIEW {own.database}.places")


def test_patterns_are_looked_for_before_they_are_read(index):
    """A part that must be in a term is looked for before `LIKE`, and alone where nothing else is asked."""
    spark = index.spark
    words = ["aabc", "abc", "abcabc", "xabc", "ab_c", "ab%c", "a\\bc", "b", "abxc"]
    docs = spark.createDataFrame([(k, word) for k, word in enumerate(words)], "id long, text string")
    own = build_index(spark, "patterns", docs, Mapping((FieldSpec("text", analyzer=Chain()),), "id"), shards=2)
    held = {r.term for r in own.terms.collect()}
    asked = ["*abc*", "abc*", "*abc", "abc", "ab?c", "*ab*c*", "*a*", "*", "**", "?", "*ab_c*", "*bxc*", "a*bxc?", "***"]
    queries = spark.createDataFrame(list(enumerate(asked)), "query_id int, q string")
    found = hits(own, Wildcard("text", F.col("q")), queries)
    got = {}
    for r in found.collect():
        got.setdefault(r.query_id, set()).add(r.id)
    for n, pattern in enumerate(asked):
        assert got.get(n, set()) == {r.id for r in hits(own, Wildcard("text", pattern)).collect()}, (pattern, held)
    assert "LIKE" in plan(found) and "isnull(_like" in plan(found)
    spark.sql(f"DROP VIEW {own.database}.patterns")
