import random

from pyspark.sql import functions as F

from wordmill import (
    FieldSpec,
    Mapping,
    Match,
    Spelling,
    build_index,
    delete_index,
    index_all,
    open_index,
    requests,
    search_and_suggest,
    stats,
    suggest,
    terms,
)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute_force(dictionary, token, size=5, edits=2, least=4, first=1):
    if token in dictionary:
        return []
    found = []
    for word, df in dictionary.items():
        if word[:first] == token[:first] and len(word) >= least and (d := distance(token, word)) <= edits:
            found.append((-(1 - d / min(len(token), len(word))), -df, word))
    return [word for _, _, word in sorted(found)[:size]]


def test_suggestions_equal_brute_force(spark, monkeypatch):
    """A dictionary of words one to three edits apart, with lengths from 1 to 14."""
    rng = random.Random(5)
    letters = "abcé"
    stems = ["".join(rng.choice(letters) for _ in range(n)) for n in (1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 12, 14)]

    def edit(word):
        n = rng.randrange(len(word) + 1)
        kind = rng.randrange(3)
        if kind == 0:
            return word[:n] + rng.choice(letters) + word[n:]
        return word[:n] + (rng.choice(letters) if kind == 1 else "") + word[n + 1 :] or "a"

    def far(word, edits):
        for _ in range(edits):
            word = edit(word)
        return word

    dictionary = {}
    rows = []
    for n in range(600):
        word = far(rng.choice(stems), rng.randrange(3))
        rows.append((n, word))
        dictionary[word] = dictionary.get(word, 0) + 1
    index = build_index(
        spark, "suggest_test", spark.createDataFrame(rows, "id bigint, text string"),
        Mapping((FieldSpec("text"),), "id"), shards=3,
    )
    tokens = sorted({far(rng.choice(stems), rng.randrange(1, 4)) for _ in range(150)})
    asked = spark.createDataFrame([("s", "text", " ".join(tokens)), ("t", "text", tokens[0])], "name string, field string, text string")
    expected = {("s", t): brute_force(dictionary, t) for t in tokens}
    expected["t", tokens[0]] = brute_force(dictionary, tokens[0])
    expected = {k: v for k, v in expected.items() if v}
    assert len(expected) > 50

    def answer(**rule):
        got = {}
        for r in suggest(index, asked, spelling=Spelling(**rule)).orderBy("name", "token", "rank").collect():
            got.setdefault((r["name"], r["token"]), []).append(r["suggestion"])
        return got

    assert answer() == expected
    loose = {("s", t): brute_force(dictionary, t, 5, 3, 2, 0) for t in tokens}
    loose["t", tokens[0]] = loose["s", tokens[0]]
    assert answer(edits=3, least_length=2, same_first=0) == {k: v for k, v in loose.items() if v}
    # the same without any broadcast
    from wordmill.operators import scoring

    monkeypatch.setattr(scoring, "BROADCAST_ROWS", 0)
    assert answer() == expected
    strict = {k: v for k in expected if (v := brute_force(dictionary, k[1], 5, 1, 5, 2))}
    found = answer(edits=1, least_length=5, same_first=2)
    assert {k: found[k] for k in strict} == strict and not any(brute_force(dictionary, t, 5, 1, 5, 2) for n, t in found if (n, t) not in strict)


def test_neighbours(spark):
    """Long words have few neighbours, and words that differ beyond their beginnings still meet."""
    rule = Spelling()
    row = spark.createDataFrame([("a" * 20 + "b" * 5000, "tie", "x", "")], "long string, short string, one string, none string")
    made = row.select(*(rule.neighbours(F.col(c)).alias(c) for c in row.columns)).first()
    assert sorted(made["short"]) == ["t", "te", "ti", "tie"] and made["one"] == ["x"] and made["none"] == [""]
    assert max(map(len, made)) <= rule.most_neighbours == 67
    words = ["internationalization", "internationalisations", "internationaleezation", "i" * 3000 + "a", "i" * 2999 + "ab"]
    docs = spark.createDataFrame([(k, w) for k, w in enumerate(words[1:])], "id bigint, text string")
    index = build_index(spark, "long_words", docs, Mapping((FieldSpec("text"),), "id"), shards=2)
    found = suggest(index, requests(index, {"a": ("text", words[0])})).orderBy("rank").collect()
    assert [r["suggestion"] for r in found] == ["internationaleezation", "internationalisations"]


def test_joined_rows_are_few(spark):
    """Rows that the join makes, against the pairs that it finds."""
    from wordmill.operators import suggest as module

    rng = random.Random(2)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(5, 9))) for _ in range(3000)]
    docs = spark.createDataFrame(list(enumerate(words)), "id bigint, text string")
    index = build_index(spark, "few_rows", docs, Mapping((FieldSpec("text"),), "id"), shards=2)
    rule = Spelling()
    asked = spark.createDataFrame([("text", w[:2] + w[3:] + "a") for w in words[:300]], "field string, token string")
    probes = asked.select("field", "token", F.explode(rule.neighbours(F.col("token"))).alias("left"))
    met = module.joined(index, "text", probes.select("field", "token", F.xxhash64("left").alias("near")), 20_000, rule)
    pairs = met.distinct().where("levenshtein(token, suggestion, 2) >= 0").count()
    assert pairs > 300 and met.count() <= 5 * pairs


def test_derived_tables_go_with_their_version(spark):
    docs = spark.createDataFrame([(1, "winter")], "id bigint, text string")
    index_all(spark, "derived", docs, Mapping((FieldSpec("text"),), "id"), shards=2)
    index = open_index(spark, "derived")
    assert [r["suggestion"] for r in suggest(index, requests(index, {"a": ("text", "wintr")})).collect()] == ["winter"]
    assert spark.catalog.tableExists(index.table_name("near_0_2_4_1"))
    for n in (2, 3):
        index_all(spark, "derived", spark.createDataFrame([(n, "wintry")], "id bigint, text string"))
    assert not spark.catalog.tableExists(index.table_name("near_0_2_4_1"))
    new = open_index(spark, "derived")
    assert [r["suggestion"] for r in suggest(new, requests(new, {"a": ("text", "wintr")})).orderBy("rank").collect()] == ["wintry", "winter"]
    delete_index(spark, "derived")


def test_search_and_named_suggesters(spark):
    rows = [(1, "Mike Ann", "Micky"), (2, "Mike", "Mike Mice"), (3, "Nick", "Bob")]
    index = build_index(
        spark, "groups_test", spark.createDataFrame(rows, "id bigint, members string, organizer string"),
        Mapping((FieldSpec("members"), FieldSpec("organizer")), "id"), shards=2,
    )
    both = search_and_suggest(
        index, Match("members", "Mike"), {"my-suggest-1": ("members", "Mick"), "my-suggest-2": ("organizer", "Mick")}
    )
    assert [r["id"] for r in both.result.hits.collect()] == [2, 1]
    got = {}
    for r in both.suggestions.orderBy("name", "rank").collect():
        got.setdefault(r["name"], []).append((r["suggestion"], r["score"]))
    # by score, then frequency, then word
    assert got == {
        "my-suggest-1": [("mike", 0.5)],
        "my-suggest-2": [("mice", 0.75), ("micky", 0.75), ("mike", 0.5)],
    }
    assert suggest(index, requests(index, {"x": ("members", "mike")})).collect() == []


def test_terms_and_stats(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (1, array('a', 'a', 'b'), 2.0D), (2, array('b'), 4.0D), (3, array('c'), NULL), "
        "(4, NULL, 1.0D) AS t(id, tags, value)"
    )
    rows = terms(df, "tags", stats=["value"]).collect()
    assert [(r["key"], r["doc_count"], r["value_count"], r["value_sum"]) for r in rows] == [
        ("b", 2, 2, 6.0),
        ("a", 1, 1, 2.0),
        ("c", 1, 0, None),
    ]
    assert [r["key"] for r in terms(df, "tags", size=1).collect()] == ["b"]
    row = stats(df, "value").first()
    assert (row["count"], row["min"], row["max"], row["sum"]) == (3, 1.0, 4.0, 7.0)
    top = spark.range(100).select((F.col("id") % 20).alias("k"))
    assert [r["key"] for r in terms(top, "k").collect()] == list(range(10))
