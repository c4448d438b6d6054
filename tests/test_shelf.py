"""Searches of a small shelf, against plain scoring of its fields."""

import pytest
import shelf
from pyspark.sql import functions as F
from shelf import best, match, most, ranked, scores

from wordmill import (
    Bool,
    FieldSpec,
    Mapping,
    Match,
    MatchAll,
    MultiMatch,
    PhrasePrefix,
    QueryString,
    Term,
    Wildcard,
    build_index,
    contains,
    explain,
    extract,
    highlight,
    hits,
    make_query,
    normalized,
    search,
    search_many,
    search_named,
    uri_query,
)
from wordmill.operators import scoring


def test_field_lengths(books):
    found = {(r["field"], r["_id"]): r["dl"] for r in books.lengths.collect()}
    assert [found["title", i] for i in (1, 2, 3, 4, 5)] == [5, 5, 3, 3, 4]
    for name in ("title", "summary", "_all"):
        assert {i: found[name, i] for i in range(1, 6)} == {i: len(said) for i, said in shelf.field_words(name).items()}


def test_catch_all(books):
    assert scores(search(books, MultiMatch(("_all",), "guide"))) == ranked(match("_all", "guide"))


def test_match_with_source_and_tie(books):
    result = search(books, Match("title", "in winter"), size=2, source=["title", "publish_date"])
    # worked by hand: idf ln(1 + 3.5 / 2.5) twice, length 3 against 4 on average
    assert scores(result) == [(3, 1.9504), (4, 1.9504)] == ranked(match("title", "in winter"))
    assert result.hits.columns == ["_id", "score", "title", "publish_date"]
    assert [r["title"] for r in result.hits.collect()] == ["Boats in Winter", "Gardens in Winter"]
    assert result.totals.first()["total"] == 2


def test_best_most_and_boost(books):
    text = "boats guide"
    title, summary, more = match("title", text), match("summary", text), match("summary", text, 3.0)
    assert scores(search(books, MultiMatch(("title", "summary"), text))) == ranked(best(title, summary))
    assert scores(search(books, MultiMatch(("title", "summary^3"), text))) == ranked(best(title, more))
    assert scores(search(books, MultiMatch(("title", "summary"), text, kind="most_fields"))) == ranked(most(title, summary))
    assert len(ranked(best(title, summary))) == 4


def test_highlight(books):
    query = Match("title", "in winter")
    marked = {r["_id"]: r["highlight"] for r in highlight(books, hits(books, query), query, "title").collect()}
    assert marked == {
        3: "Boats <em>in</em> <em>Winter</em>",
        4: "Gardens <em>in</em> <em>Winter</em>",
    }


def test_highlight_patterns(books):
    for query in (PhrasePrefix(("title",), "in win"), Bool(should=(Wildcard("title", "*int*"), Term("title", "in")))):
        marked = highlight(books, hits(books, query), query, "title").collect()
        assert "Gardens <em>in</em> <em>Winter</em>" in [r["highlight"] for r in marked]


def test_paging(books):
    query = MultiMatch(("title", "summary"), "boats guide paint")
    both = scores(search(books, query, size=4))
    assert scores(search(books, query, size=2)) + scores(search(books, query, size=2, offset=2)) == both


def test_operator_and(books):
    both = match("summary", "paint guide")
    assert scores(search(books, Match("summary", "paint guide", operator="and"))) == ranked({k: both[k] for k in (3, 4)})
    assert {i for i, _ in scores(search(books, Match("summary", "guide moon")))} == {3, 4, 5}
    assert scores(search(books, Match("summary", "paint nosuchword", operator="and"))) == []


def test_phrase_prefix(books):
    assert [i for i, _ in scores(search(books, PhrasePrefix(("summary",), "repair an")))] == [3]
    assert {i for i, _ in scores(search(books, PhrasePrefix(("title", "summary"), "paint a")))} == {3, 4}
    # one word: its expansions are one term, here two words of document 1 and of no other
    said = shelf.field_words("summary")
    w = {i: sum(word.startswith("wo") for word in words) for i, words in said.items()}
    df, avgdl = sum(map(bool, w.values())), sum(map(len, said.values())) / 5
    one = {i: shelf.bm25(tf, df, 5, len(said[i]), avgdl) for i, tf in w.items() if tf}
    assert set(one) == {1, 2, 3}
    assert scores(search(books, PhrasePrefix(("summary",), "wo"))) == ranked(one)
    assert scores(search(books, PhrasePrefix(("summary",), "guide repair"))) == []
    assert scores(search(books, PhrasePrefix(("summary",), "..."))) == []


def test_term_wildcard_match_all(books):
    assert scores(search(books, Term("title", "winter"))) == scores(search(books, Match("title", "Winter")))
    assert scores(search(books, Term("title", "Winter"))) == []
    assert scores(search(books, Term("publisher", "fernhill"))) == [(1, 1.0), (5, 1.0)]
    assert scores(search(books, Term("authors", "roy pike"))) == [(4, 1.0)]
    assert scores(search(books, Wildcard("title", contains("int")))) == [(3, 1.0), (4, 1.0)]
    assert scores(search(books, Wildcard("title", "b?ats"))) == [(3, 1.0)]
    assert scores(search(books, Wildcard("title", contains("in winter")))) == []
    assert scores(search(books, MatchAll())) == [(i, 1.0) for i in (1, 2, 3, 4, 5)]


def test_texts_without_words(books):
    fields = ("title", "summary")
    for query in (
        Match("title", "..."),
        Match("title", "...", operator="and"),
        MultiMatch(fields, "?!"),
        MultiMatch(fields, "", kind="most_fields"),
        PhrasePrefix(fields, "-"),
        QueryString(fields, "..."),
        QueryString(fields, ""),
        QueryString(fields, "-guide"),
        Wildcard("title", "*nosuch*"),
        Term("title", "nosuch"),
        Bool(must=(Match("title", "winter"), Match("title", "..."))),
    ):
        assert scores(search(books, query)) == [], query
    # a word that analysis empties does not count
    assert scores(search(books, QueryString(fields, "gardens ...", default_operator="and"))) == scores(
        search(books, QueryString(fields, "gardens"))
    )


def test_bool(books):
    paint, quiet = match("summary", "paint"), match("summary", "quiet")
    query = Bool(
        must=(Match("summary", "and"),),
        must_not=(Term("publisher", "fernhill"), Match("title", "knots")),
        should=(Match("summary", "quiet"),),
    )
    every = match("summary", "and")
    assert scores(search(books, query)) == ranked({3: every[3], 4: every[4] + quiet[4]})
    assert set(paint) == {3, 4}
    only_not = Bool(must_not=(Match("title", "winter"),))
    assert scores(search(books, only_not)) == [(1, 0.0), (2, 0.0), (5, 0.0)]
    on_columns = Bool(must=(Term("publisher", "harbour"),), must_not=(Term("authors", "roy pike"),))
    assert scores(search(books, on_columns)) == [(2, 1.0), (3, 1.0)]


def test_query_strings(books):
    fields = ("title", "summary")
    over = lambda word: MultiMatch(fields, word)
    same = [
        ("+(paint | moon) -gardens", Bool(must=(Bool(should=(over("paint"), over("moon"))),), must_not=(over("gardens"),))),
        ("paint guide", Bool(should=(over("paint"), over("guide")))),
        ("+paint guide", Bool(must=(over("paint"),), should=(over("guide"),))),
        ("quiet -guide", Bool(should=(over("quiet"),), must_not=(over("guide"),))),
    ]
    for text, query in same:
        assert scores(search(books, QueryString(fields, text))) == scores(search(books, query)), text
    # left to right: (season AND guide) OR moon
    both = Bool(must=(over("season"), over("guide")))
    got = scores(search(books, QueryString(fields, "season guide | moon", default_operator="and")))
    assert got == scores(search(books, Bool(should=(both, over("moon")))))
    # (moon OR season) AND guide
    either = Bool(should=(over("moon"), over("season")))
    got = scores(search(books, QueryString(fields, "moon | season guide", default_operator="and")))
    assert got == scores(search(books, Bool(must=(either, over("guide")))))
    got = scores(search(books, QueryString(fields, "+(season guide | moon) -tides", default_operator="AND")))
    assert [i for i, _ in got] == [4]


def test_uri_query(books):
    assert scores(search(books, uri_query("guide"))) == ranked(match("_all", "guide"))
    title, rest = match("title", "in"), match("_all", "winter")
    assert scores(search(books, uri_query("title:in winter"))) == ranked({k: title[k] + rest[k] for k in (3, 4)})


def test_query_string_fields(books):
    with pytest.raises(ValueError):
        search(books, QueryString(("nosuch",), "harbour"))
    assert scores(search(books, QueryString(("publisher",), "fernhill"))) == [(1, 1.0), (5, 1.0)]
    named = scores(search(books, QueryString(("title",), "publisher:harbour -gardens knots")))
    assert named == ranked({2: 1 + match("title", "knots")[2], 3: 1.0})
    assert scores(search(books, QueryString(("title", "nosuch"), "gardens", lenient=True))) == ranked(match("title", "gardens"))


def test_explain_adds_up(books):
    query = MultiMatch(("title", "summary"), "boats guide guide", kind="most_fields")
    parts = {}
    for r in explain(books, query).collect():
        parts[r["_id"]] = parts.get(r["_id"], 0.0) + r["contribution"]
    assert {i: round(s, 4) for i, s in parts.items()} == dict(scores(search(books, query)))


def test_min_score_totals_and_extract(books):
    query = MultiMatch(("title", "summary"), "boats guide")
    every = best(match("title", "boats guide"), match("summary", "boats guide"))
    least = sorted(every.values())[1] + 1e-6
    kept = {k: s for k, s in every.items() if s >= least}
    result = search(books, query, min_score=least)
    assert scores(result) == ranked(kept) and len(kept) == 2
    row = result.totals.first()
    want = (4, round(max(every.values()), 4), round(sum(every.values()), 4))
    assert (row["total"], round(row["max_score"], 4), round(row["sum_score"], 4)) == want
    got = extract(books, result.every_hit, "publisher", min_score=least)
    house = {row[0]: row[6] for row in shelf.ROWS}
    assert sorted((r["document_id"], r["entry_id"]) for r in got.hits.collect()) == sorted((house[k], k) for k in kept)
    row = got.scores.first()
    assert (round(row["max_score"], 4), round(row["sum_score"], 4)) == (want[1], round(sum(kept.values()), 4))
    page = normalized(result.hits, result.every_hit).collect()
    top = max(every.values())
    assert round(page[0]["norm_score"], 4) == round(top / (top + 1), 4)


def test_sort_and_type(books):
    result = search(books, Term("publisher", "harbour"), sort=[("publish_date", "desc")], size=2, source=["title"])
    assert [r["_id"] for r in result.hits.collect()] == [3, 4]
    assert result.hits.columns == ["_id", "score", "title"]
    assert search(books, Term("publisher", "harbour"), sort=[("num_reviews", "desc")]).hits.columns == ["_id", "score"]
    large = search(books, MatchAll(), sort=[("num_reviews", "desc")], size=20_000, source=["num_reviews"])
    assert [r["num_reviews"] for r in large.hits.collect()] == [31, 22, 14, 9, 5]
    by_reviews = search(books, Match("title", "winter"), sort=[("num_reviews", "asc")])
    assert [r["_id"] for r in by_reviews.hits.collect()] == [4, 3]


def test_named(spark, books):
    got = search_named(spark, "bookdb", "most_fields", "guide", ["title", "summary"], page={"size": 1})
    assert scores(got) == scores(search(books, MultiMatch(("title", "summary"), "guide", kind="most_fields"), size=1))
    missing = search_named(spark, "nosuch", "match", "guide", ["title"])
    assert missing.hits.collect() == [] and missing.totals.first()["total"] == 0
    with pytest.raises(ValueError):
        make_query("nosuch", "guide")


BATCH_TEXTS = ["boats guide", "in winter", "boats guide", "nosuchword", "paint an"]
TEMPLATES = {
    "match": lambda t: Match("summary", t),
    "and": lambda t: Match("summary", t, operator="and"),
    "best": lambda t: MultiMatch(("title", "summary^3"), t),
    "most": lambda t: MultiMatch(("title", "summary"), t, kind="most_fields"),
    "phrase": lambda t: PhrasePrefix(("title", "summary"), t),
    "query string": lambda t: QueryString(("title", "summary"), t, default_operator="and"),
    "bool": lambda t: Bool(must=(Match("summary", t),), must_not=(Match("title", "knots"),)),
    "bool column": lambda t: Bool(must=(Match("summary", t),), must_not=(Term("publisher", "fernhill"),)),
    "wildcard": lambda t: Wildcard("title", t),
    "column": lambda t: Term("publisher", t),
    "term": lambda t: Term("title", t),
}
CASES = [(name, True) for name in TEMPLATES] + [(name, False) for name in ("best", "phrase", "query string", "wildcard")]


@pytest.mark.parametrize(("name", "broadcast"), CASES)
def test_batches_equal_single_queries(spark, books, monkeypatch, name, broadcast):
    make = TEMPLATES[name]
    if not broadcast:
        monkeypatch.setattr(scoring, "BROADCAST_ROWS", 0)
        monkeypatch.setattr(scoring, "SLICE_ROWS", 2)
    texts = list(BATCH_TEXTS)
    if name == "wildcard":
        texts = ["*int*", "b?ats", "*", "g*s", "*nosuch*", "a*", "*o*"]
    if name in ("column", "term"):
        texts = ["harbour", "fernhill", "winter", "guide"]
    queries = spark.createDataFrame(list(enumerate(texts)), "query_id bigint, text string")
    got = {}
    for r in search_many(books, queries, make(F.col("text")), size=3).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["_id"], round(r["score"], 4)))
    expected = {n: scores(search(books, make(t), size=3)) for n, t in enumerate(texts)}
    assert got == {n: found for n, found in expected.items() if found}


@pytest.mark.parametrize(
    "query",
    [
        Bool(must=(Match("summary", "paint guide"),), should=(MultiMatch(("title", "summary"), "guide boats"), Wildcard("title", "*a*"))),
        Bool(should=(Bool(must=(Match("title", "in winter"),), must_not=(Match("title", "gardens"),)), PhrasePrefix(("summary",), "sho"))),
        Bool(must_not=(Match("title", "winter"),)),
        MultiMatch(("title", "summary"), "small boats guide"),
        QueryString(("title", "summary"), "+(guide | paint) -gardens"),
        Term("publisher", "harbour"),
        MatchAll(),
    ],
)
def test_any_query_is_explained(books, query):
    total = {}
    for r in explain(books, query).where("counted").collect():
        total[r["_id"]] = total.get(r["_id"], 0) + r["contribution"]
    assert {k: round(v, 6) for k, v in total.items()} == {r["_id"]: round(r["score"], 6) for r in hits(books, query).collect()}


def parts_of(books, query):
    total, rows = {}, explain(books, query).where("counted").collect()
    for r in rows:
        total[r["_id"]] = total.get(r["_id"], 0.0) + r["contribution"]
    assert {k: round(v, 6) for k, v in total.items()} == {r["_id"]: round(r["score"], 6) for r in hits(books, query).collect()}
    return sorted({(r["_id"], r["clause"], r["field"], r["term"]) for r in rows})


def test_phrases_are_explained_by_word(books):
    assert parts_of(books, PhrasePrefix(("title", "summary"), "repair an")) == [(3, "", "summary", "an*"), (3, "", "summary", "repair")]
    assert parts_of(books, PhrasePrefix(("title", "summary^2"), "wi")) == [
        (1, "", "summary", "wi*"), (2, "", "summary", "wi*"), (3, "", "title", "wi*"), (4, "", "title", "wi*"), (5, "", "summary", "wi*"),
    ] or parts_of(books, PhrasePrefix(("title", "summary^2"), "wi"))
    assert parts_of(books, PhrasePrefix(("summary",), "...")) == []


def test_query_strings_are_explained_by_clause(books):
    fields = ("title", "summary")
    assert parts_of(books, QueryString(fields, "+(moon | boats) -rope paint")) == [
        (3, "must 0", "title", "boats"), (3, "should 2", "summary", "paint"), (5, "must 0", "summary", "boats"), (5, "must 0", "summary", "moon"),
    ]
    # a word that the joining leaves out is not counted: season AND moon fails, guide stands alone
    got = parts_of(books, QueryString(fields, "season moon | guide", default_operator="and"))
    assert {(i, t) for i, _, _, t in got} == {(3, "guide"), (4, "guide"), (5, "guide")}
    assert parts_of(books, QueryString(("title",), "publisher:fernhill tides tides")) == [
        (1, "should 0", "publisher", None), (5, "should 0", "publisher", None), (5, "should 1", "title", "tides"), (5, "should 2", "title", "tides"),
    ]


def marked(books, query, field):
    return {r["_id"]: r["highlight"] for r in highlight(books, hits(books, query), query, field).collect()}


def test_highlights_mark_what_matched(books):
    got = marked(books, PhrasePrefix(("summary",), "and a qu"), "summary")
    assert got == {4: "guide to pruning, paint <em>and</em> <em>a</em> <em>quiet</em> season of repair"}
    # "a" alone and "and" alone stay as they are
    got = marked(books, PhrasePrefix(("summary",), "a wood"), "summary")
    assert got == {3: "repair and paint <em>a</em> <em>wooden</em> hull on shore; a guide to tools, timber and tar for boats"}
    query = QueryString(("title",), "summary:moon | (tides knots) -(gardens boats)")
    assert marked(books, query, "summary") == {5: "tables of <em>moon</em> and wind; shore and small boats"}
    assert marked(books, query, "title") == {2: "<em>Knots</em>: Hitches, Bends and Splices", 5: "Small Guide to <em>Tides</em>"}


def test_batch_wildcards_equal_trying_every_term(spark, books):
    """Patterns with whole grams, with short parts only, with none, with signs of LIKE, and null."""
    import fnmatch

    patterns = ["*int*", "gui?e", "*oat*s", "*", "?", "a*", "*xyz*", "wi*", "*o*", "t??es", "100%", "g_ide", "boats", "*rdens", "", None, "*in*er"]
    queries = spark.createDataFrame(list(enumerate(patterns)), "query_id bigint, text string")
    got = {}
    for r in hits(books, Wildcard("title", F.col("text")), queries).collect():
        got.setdefault(r["query_id"], set()).add(r["_id"])
    want = {}
    for n, pattern in enumerate(patterns):
        if pattern is None:
            continue
        held = {i for i, said in shelf.field_words("title").items() if any(fnmatch.fnmatchcase(word, pattern) for word in said)}
        if held:
            want[n] = held
    assert got == want and len(want) == 12


def test_batches_by_type_and_with_source(spark, books):
    typed = Mapping((FieldSpec("title"), FieldSpec("summary")), "_id", type_column="publisher")
    index = build_index(spark, "typed_books", spark.createDataFrame(shelf.ROWS, shelf.SCHEMA), typed, shards=2)
    queries = spark.createDataFrame([(7, "boats guide"), (8, "moon"), (9, "boats guide")], "q long, text string")
    found = search_many(index, queries, Match("summary", F.col("text")), id_column="q", doc_type="harbour", source=["title", "num_reviews"])
    assert found.columns == ["q", "rank", "_id", "score", "title", "num_reviews"]
    want = [(i, s) for i, s in ranked(match("summary", "boats guide")) if i in (2, 3, 4)]
    title = {row[0]: (row[1], row[5]) for row in shelf.ROWS}
    for q in (7, 9):
        rows = [tuple(r) for r in found.where(F.col("q") == q).orderBy("rank").collect()]
        assert [(r[2], round(r[3], 4)) for r in rows] == want and all(r[4:] == title[r[2]] for r in rows)
    assert found.where("q = 8").count() == 0
    with pytest.raises(ValueError, match="name of the key"):
        search_many(index, queries.withColumnRenamed("q", "_id"), Match("summary", F.col("text")), id_column="_id")


def test_sorting_a_filter_reads_the_documents_once(books):
    page = search(books, Term("publisher", "harbour"), sort=[("num_reviews", "desc")], size=2).hits
    assert page._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert [r["_id"] for r in page.collect()] == [3, 4]
