"""One callable per query: (spark, folder of parquet tables) -> DataFrame.

Scores are rounded to four digits before they are ranked, as the SQL does.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import wordmill as w
from wordmill.functions.folding import lower_ascii
from wordmill.functions.text import display_date, first_line, hit_path, truncate
from wordmill.sources.store import workspace

DIGITS = 4

# The chain of the analysis samples, with words that occur in the tables.
SAMPLE_CHAIN = w.Chain(
    (
        w.Lowercase(),
        w.AsciiFolding(),
        w.KeywordMarker(("thing", "disgusting")),
        w.StemmerOverride.of(["ties=>tie", "were=>was", "eres=>er", "das=>the"]),
        w.Stop(("a", "is", "the", "was")),
        w.PorterStem(),
    )
)
FOLDING_CHAIN = w.Chain((w.Lowercase(), w.AsciiFolding()))

DOCUMENT_FIELDS = (
    w.FieldSpec("text"),
    w.FieldSpec("head", source="substring_index(text, '\\n', 1)"),
    w.FieldSpec("lang", analyzer=None),
    w.FieldSpec("source", analyzer=None),
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _index(spark: SparkSession, folder: str, name: str, make: Callable) -> w.Index:
    """The index over a table, built on first use in this application."""
    full = f"{name}_{hashlib.sha256(folder.encode()).hexdigest()[:8]}"
    if not w.index_exists(spark, full):
        docs, mapping = make()
        w.build_index(spark, full, docs, mapping)
    return w.open_index(spark, full)


def documents(spark: SparkSession, folder: str) -> w.Index:
    def make():
        docs = table(spark, folder, "documents")
        return docs, w.Mapping(DOCUMENT_FIELDS, "doc_id").with_catch_all(docs.schema)

    return _index(spark, folder, "documents", make)


def turns(spark: SparkSession, folder: str) -> DataFrame:
    key = F.concat_ws("-", "conv_id", "turn").alias("doc_id")
    return table(spark, folder, "conversations").select(key, "role", "text")


def conversations(spark: SparkSession, folder: str) -> w.Index:
    def make():
        return turns(spark, folder), w.Mapping((w.FieldSpec("text"),), "doc_id", type_column="role")

    return _index(spark, folder, "conversations", make)


def orders(spark: SparkSession, folder: str) -> w.Index:
    def make():
        fields = (w.FieldSpec("o_orderpriority", analyzer=None),)
        return table(spark, folder, "orders"), w.Mapping(fields, "o_orderkey")

    return _index(spark, folder, "orders", make)


def _tokens(df: DataFrame) -> DataFrame:
    return df.withColumn("position", F.col("position").cast("bigint"))


def texts(spark: SparkSession, folder: str) -> DataFrame:
    return w.spread(table(spark, folder, "documents"))


# ---- analysis ----------------------------------------------------------------------


def analyze_standard(spark, folder):
    return _tokens(w.analyze(texts(spark, folder), "text", "standard", ["doc_id"]))


def analyze_folding(spark, folder):
    return _tokens(w.analyze(texts(spark, folder), "text", FOLDING_CHAIN, ["doc_id"]))


def normalize_value(spark, folder):
    return texts(spark, folder).select("doc_id", lower_ascii(F.col("text")).alias("folded"))


def analyze_porter(spark, folder):
    words = w.analyze(texts(spark, folder), "text", "standard")
    words = words.select(F.col("token").alias("term")).distinct()
    stems = w.analyze(words, "term", w.Chain((w.PorterStem(),)), ["term"])
    return stems.select("term", F.col("token").alias("stem"))


def analyze_light(spark, folder):
    return _tokens(w.analyze(texts(spark, folder), "text", "case_sensitive_text", ["doc_id"]))


def analyze_english(spark, folder):
    return _tokens(w.analyze(texts(spark, folder), "text", "english", ["doc_id"]))


def analyze_chain(spark, folder):
    return _tokens(w.analyze(texts(spark, folder), "text", SAMPLE_CHAIN, ["doc_id"]))


def analyze_explain(spark, folder):
    """Every stage of the chain over all words; a filter sees the word alone, so equal words go through it once."""
    words = w.analyze(texts(spark, folder), "text", w.Chain(), ["doc_id"])
    words = words.groupBy(F.col("token").alias("word")).agg(
        F.count("*").alias("n"), F.sum("position").cast("bigint").alias("places")
    )
    stages = w.analyze_stages(words, "word", SAMPLE_CHAIN, ["n", "places"])
    return stages.groupBy(F.col("stage_no").cast("bigint").alias("stage_no"), "stage", "token").agg(
        F.sum("n").alias("tokens"), F.sum("places").alias("positions")
    )


def index_analyzer(spark, folder):
    """The words of the benchmark, by the chain that the index keeps for its field."""
    spec = documents(spark, folder).mapping.field("text")
    return _tokens(w.analyze(table(spark, folder, "benchmark"), "text", spec.analyzer, ["item_id"]))


# ---- the index ---------------------------------------------------------------------


def index_postings(spark, folder):
    read = documents(spark, folder).postings
    places = F.aggregate("positions", F.lit(0).cast("bigint"), lambda a, p: a + p)
    counts = [F.col(c).cast("bigint").alias(c) for c in ("tf", "dl")]
    return read.select("field", "term", "doc_id", *counts, places.alias("positions"))


def index_terms(spark, folder):
    return documents(spark, folder).terms.select("field", "term", "df", "cf")


def index_lengths(spark, folder):
    return documents(spark, folder).lengths.select("field", "doc_id", F.col("dl").cast("bigint").alias("dl"))


def index_stats(spark, folder):
    read = documents(spark, folder).stats
    return read.select("field", "n_docs", F.round("avgdl", DIGITS).alias("avgdl"), "n_postings")


def index_upsert(spark, folder):
    """Every German document replaced by a longer one, twice in one batch: the last wins."""
    name = f"upsert_{uuid.uuid4().hex[:12]}"
    docs = table(spark, folder, "documents")
    mapping = w.Mapping((w.FieldSpec("text"),), "doc_id")
    w.index_all(spark, name, docs, mapping)
    german = docs.where("lang = 'de'")
    first = german.withColumns({"text": F.concat("text", F.lit(" vorher")), "n": F.lit(1)})
    last = german.withColumns({"text": F.concat("text", F.lit(" nachher nachher")), "n": F.lit(2)})
    w.index_all(spark, name, last.unionByName(first), order_by=F.col("n"))
    read = w.open_index(spark, name).postings
    added = F.sum(F.when(F.col("term") == "nachher", F.col("tf")).otherwise(0))
    stale = F.sum(F.when(F.col("term") == "vorher", F.col("tf")).otherwise(0))
    return read.groupBy("doc_id").agg(
        F.sum("tf").cast("bigint").alias("tokens"),
        F.count("*").alias("terms"),
        added.cast("bigint").alias("added"),
        stale.cast("bigint").alias("stale"),
    )


def bulk_ingest(spark, folder):
    """Parts written as action and document lines, and read back."""
    place = spark.catalog.getDatabase(workspace(spark)).locationUri
    path = f"{place}/bulk_{uuid.uuid4().hex[:12]}"
    parts = table(spark, folder, "part")
    w.bulk_lines(parts, "p_partkey").write.text(path)
    schema = "p_name string, p_brand string, p_type string, p_size bigint, p_retailprice double"
    return w.read_bulk(spark, path, schema, key="p_partkey").drop("_order")


def parts(spark: SparkSession, folder: str) -> w.Index:
    """Parts, whose names are arrays of words."""

    def make():
        docs = table(spark, folder, "part").select(
            F.col("p_partkey").cast("bigint").alias("doc_id"), F.split("p_name", " ").alias("names"), "p_brand"
        )
        return docs, w.Mapping((w.FieldSpec("names"),), "doc_id")

    return _index(spark, folder, "parts", make)


def match_array(spark, folder):
    """Parts by words of their names, which are arrays."""
    found = w.hits(parts(spark, folder), w.Match("names", "small gear"))
    return found.withColumn("score", F.round("score", DIGITS))


def terms_all(spark, folder):
    """All customers of the orders, not only the ten with most."""
    return w.terms(table(spark, folder, "orders"), "o_custkey", size=None).select("key", "doc_count")


def describe_index(spark, folder):
    return w.describe_index(documents(spark, folder))


def create_delete(spark, folder):
    """The life of an index over all conversation turns."""
    name = w.numbered_index(uuid.uuid4().int >> 88)
    docs = turns(spark, folder)
    mapping = w.Mapping((w.FieldSpec("text"),), "doc_id")
    rows = []

    def note(step, flag):
        found = w.open_index(spark, name).docs.count() if w.index_exists(spark, name) else None
        rows.append((len(rows) + 1, step, flag, found))

    note("create", w.create_index(spark, name, mapping, docs.schema, shards=4))
    note("create again", w.create_index(spark, name, mapping, docs.schema))
    note("index nothing", w.index_all(spark, name, docs.where("role IS NULL")))
    note("index", w.index_all(spark, name, docs))
    note("delete", w.delete_index(spark, name))
    note("delete again", w.delete_index(spark, name))
    return spark.createDataFrame(rows, "step bigint, action string, acknowledged boolean, documents bigint")


# ---- relevance ---------------------------------------------------------------------

MATCH = w.Match("text", "the and")
BOTH = ("text", "head")


def _page(query, size=50, name="documents", **options):
    def run(spark, folder):
        index = documents(spark, folder) if name == "documents" else conversations(spark, folder)
        return w.search(index, query, size=size, digits=DIGITS, **options).hits

    return run


def _every(query, name="documents"):
    def run(spark, folder):
        index = documents(spark, folder) if name == "documents" else conversations(spark, folder)
        return w.hits(index, query).withColumn("score", F.round("score", DIGITS))

    return run


BOOL = w.Bool(
    must=(w.Match("text", "the"),), must_not=(w.Match("text", "en"),), should=(w.Match("text", "rest"),)
)
BOOL_COLUMN = w.Bool(must=(w.Match("text", "the"),), must_not=(w.Term("lang", "en"),))
BOOL_SHOULD = w.Bool(
    should=(w.MultiMatch(BOTH, "der"), w.Term("source", "src1"), w.Wildcard("text", "*ungen*")),
    must_not=(w.PhrasePrefix(("text",), "der an"),),
)
QUERY_STRING = w.QueryString(BOTH, "+(the | que) -en")
SIMPLE_QUERY_STRING = w.QueryString(BOTH, "+(from das | la) -der", default_operator="and")


PHRASE = w.PhrasePrefix(("text",), "of th")


def explain(spark, folder):
    parts = w.explain(documents(spark, folder), w.MultiMatch(("text", "head^2"), "the and and"))
    rounded = [F.round(c, DIGITS).alias(c) for c in ("idf", "tf_norm", "boost", "contribution")]
    counts = [F.col(c).cast("bigint").alias(c) for c in ("tf", "df", "dl")]
    return parts.select("doc_id", "field", "term", *counts, *rounded)


def explain_bool(spark, folder):
    """The parts of the scores of a bool query, by clause."""
    query = w.Bool(
        must=(w.Match("text", "the and"),), should=(w.Match("head", "the"),), must_not=(w.Match("text", "of"),)
    )
    parts = w.explain(documents(spark, folder), query).where("counted")
    return parts.select("doc_id", "clause", "field", "term", F.round("contribution", DIGITS).alias("contribution"))


def explain_phrase(spark, folder):
    """The words of a phrase, as parts of its score."""
    parts = w.explain(documents(spark, folder), PHRASE).where("counted")
    figures = [F.col(c).cast("bigint").alias(c) for c in ("tf", "df")]
    return parts.select("doc_id", "term", *figures, F.round("contribution", DIGITS).alias("contribution"))


def explain_query_string(spark, folder):
    """The words of a query string that count, by clause and field."""
    parts = w.explain(documents(spark, folder), QUERY_STRING).where("counted")
    return parts.select("doc_id", "clause", "field", "term", F.round("contribution", DIGITS).alias("contribution"))


def totals(spark, folder):
    row = w.search(documents(spark, folder), MATCH, size=0).totals
    return row.select(
        "total", F.round("max_score", DIGITS).alias("max_score"), F.round("sum_score", 2).alias("sum_score")
    )


def norm_score(spark, folder):
    result = w.search(documents(spark, folder), MATCH, size=50, digits=DIGITS)
    page = w.normalized(result.hits, result.every_hit)
    return page.withColumn("norm_score", F.round("norm_score", DIGITS))


def extract(spark, folder):
    found = w.hits(documents(spark, folder), MATCH).withColumn("score", F.round("score", DIGITS))
    return w.extract(documents(spark, folder), found, "source", min_score=1.0).hits


def extract_scores(spark, folder):
    found = w.hits(documents(spark, folder), MATCH).withColumn("score", F.round("score", DIGITS))
    scores = w.extract(documents(spark, folder), found, "source", min_score=1.0).scores
    return scores.select("max_score", F.round("sum_score", 2).alias("sum_score"))


def source_filter(spark, folder):
    query = w.Match("text", "the and")
    return w.search(documents(spark, folder), query, size=10, digits=DIGITS, source=["lang", "text"]).hits


def hit_shape(spark, folder):
    """All documents as printed hits; `meta.lang` is a nested path."""
    docs = documents(spark, folder).docs.withColumn("meta", F.struct("lang", "source"))
    return docs.select(
        "doc_id",
        truncate(F.col("text")).alias("shown"),
        first_line(F.col("text")).alias("line"),
        hit_path("documents", F.col("meta.lang"), F.col("doc_id")).alias("path"),
    )


def highlight(spark, folder):
    index = documents(spark, folder)
    return w.highlight(index, w.hits(index, MATCH), MATCH, "text")


def _marked(query):
    def run(spark, folder):
        index = documents(spark, folder)
        return w.highlight(index, w.hits(index, query), query, "text")

    return run


def date_fallback(spark, folder):
    """Orders with a creation date, a fallback, or neither."""
    read = table(spark, folder, "orders")
    day = F.col("o_orderdate").cast("string")
    created = F.when(F.col("o_orderstatus") != "F", day)
    authored = F.when(F.col("o_orderpriority") != "5-LOW", F.lit("1999-12-31T08:00:00"))
    return read.select("o_orderkey", display_date(created, authored).alias("shown"))


def latest(spark, folder):
    query = w.Term("o_orderpriority", "1-URGENT")
    result = w.search(orders(spark, folder), query, sort=[("o_orderdate", "desc")], size=5, source=["o_orderdate"])
    return result.hits.select("o_orderkey", "score", "o_orderdate")


DISPATCH = {
    "match": ("the and", ("text",)),
    "best_fields": ("the and", BOTH),
    "most_fields": ("the and", BOTH),
    "phrase_prefix": ("of th", ("text",)),
    "term": ("of", ("text",)),
    "wildcard": ("tion", ("text",)),
    "query_string": ("+(the | que) -en", BOTH),
    "simple_query_string": ("the | que", BOTH),
}


def dispatch(spark, folder):
    """Every query type by its name, the first ten hits of each."""
    index, parts = documents(spark, folder), None
    for kind, (text, fields) in DISPATCH.items():
        page = w.search(index, w.make_query(kind, text, fields), digits=DIGITS).hits
        page = page.withColumn("kind", F.lit(kind))
        parts = page if parts is None else parts.unionByName(page)
    return parts


# ---- many queries in one job ---------------------------------------------------------


def _passages(spark, folder) -> DataFrame:
    return table(spark, folder, "benchmark").select(F.col("item_id").alias("query_id"), "text")


def _runs(spark, folder, step: int) -> DataFrame:
    """Query texts made of all words of the benchmark passages, one row for every `step` words.

    The id is that of the passage and the place of the first word; words are missing at its end.
    """
    read = table(spark, folder, "benchmark")
    words = F.split(F.trim(F.regexp_replace(F.lower("text"), r"[^\p{L}\p{N}]+", " ")), " ")
    read = read.select("item_id", words.alias("words"))
    read = read.select("item_id", "words", F.posexplode("words").alias("place", "first")).where(F.col("place") % step == 0)

    def word(n):
        return F.coalesce(F.try_element_at("words", F.col("place") + n), F.lit("the"))

    return read.select(
        (F.col("item_id") * 1_000_000 + F.col("place")).alias("query_id"),
        F.concat_ws(" ", word(1), F.substring(word(2), 1, 2)).alias("phrase"),
        F.concat(F.lit("+("), word(1), F.lit(" | "), word(2), F.lit(") -"), word(3), F.lit(" "), word(4)).alias(
            "request"
        ),
        F.concat(F.lit("*"), word(1), F.lit("*")).alias("pattern"),
        word(1).alias("word"),
    )


def _many(column, make, step=0, **options):
    def run(spark, folder):
        asked = _runs(spark, folder, step) if step else _passages(spark, folder)
        asked = asked.select("query_id", column)
        found = w.search_many(documents(spark, folder), asked, make(F.col(column)), size=5, digits=DIGITS, **options)
        return found.withColumn("rank", F.col("rank").cast("bigint"))

    return run


def search_many_typed(spark, folder):
    """The passages against turns of one role, with that role."""
    index, asked = conversations(spark, folder), _passages(spark, folder)
    query = w.Match("text", F.col("text"))
    found = w.search_many(index, asked, query, size=5, digits=DIGITS, doc_type="user", source=["role"])
    return found.withColumn("rank", F.col("rank").cast("bigint"))


# ---- aggregations --------------------------------------------------------------------


def _rounded(df, *keep):
    return df.select(*[c if c in keep else F.round(c, DIGITS).alias(c) for c in df.columns])


def terms_stats(spark, folder):
    """Users by number of events, with statistics of the values, by nested paths."""
    read = table(spark, folder, "events")
    read = read.select(
        F.struct(F.col("user_id").alias("name")).alias("committer"),
        F.struct(F.col("value").alias("lines")).alias("stats"),
    )
    buckets = w.terms(read, "committer.name", size=10, stats=["stats.lines"])
    return _rounded(buckets, "key", "doc_count", "stats_lines_count")


def terms_array(spark, folder):
    read = table(spark, folder, "part").select(F.split("p_name", " ").alias("words"), "p_size")
    return _rounded(w.terms(read, "words", stats=["p_size"]), "key", "doc_count", "p_size_count")


def stats(spark, folder):
    return _rounded(w.stats(table(spark, folder, "events"), "value"), "count")


def agg_with_query(spark, folder):
    buckets = w.aggregate(
        documents(spark, folder), "source", stats=["n_chars"], query=w.Match("text", "the")
    )
    return buckets.withColumn("n_chars_avg", F.round("n_chars_avg", DIGITS))


# ---- suggestions ---------------------------------------------------------------------

SUGGESTERS = {
    "my-suggest-1": ("text", "thiss thatn wihch the"),
    "my-suggest-2": ("head", "thiss"),
}


def _ranked(found):
    return found.withColumns({"rank": F.col("rank").cast("bigint"), "score": F.round("score", DIGITS)})


def suggest(spark, folder):
    index = documents(spark, folder)
    return _ranked(w.suggest(index, w.requests(index, SUGGESTERS)))


def suggest_many(spark, folder):
    """Suggestions for every word of the conversations that no document holds."""
    asked = w.spread(turns(spark, folder)).select(F.col("doc_id").alias("name"), F.lit("text").alias("field"), "text")
    return _ranked(w.suggest(documents(spark, folder), asked))


def search_and_suggest(spark, folder):
    both = w.search_and_suggest(
        documents(spark, folder), w.Match("text", "the"), {"my-suggest-1": ("text", "thiss")}, size=20, digits=DIGITS
    )
    hits = both.result.hits.select(
        F.lit("hit").alias("kind"), F.col("doc_id").cast("string").alias("value"), "score"
    )
    words = both.suggestions.select(
        F.lit("suggest").alias("kind"), F.col("suggestion").alias("value"), F.round("score", DIGITS).alias("score")
    )
    return hits.unionByName(words)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "analyze_standard": analyze_standard,
    "analyze_folding": analyze_folding,
    "normalize_value": normalize_value,
    "analyze_porter": analyze_porter,
    "analyze_light": analyze_light,
    "analyze_english": analyze_english,
    "analyze_chain": analyze_chain,
    "analyze_explain": analyze_explain,
    "index_analyzer": index_analyzer,
    "index_postings": index_postings,
    "index_terms": index_terms,
    "index_lengths": index_lengths,
    "index_stats": index_stats,
    "index_upsert": index_upsert,
    "bulk_ingest": bulk_ingest,
    "match_array": match_array,
    "terms_all": terms_all,
    "describe_index": describe_index,
    "create_delete": create_delete,
    "match_or": _page(MATCH),
    "match_hits": _every(MATCH),
    "match_and": _every(w.Match("text", "the and", operator="and")),
    "multi_best": _every(w.MultiMatch(BOTH, "the and")),
    "multi_most": _every(w.MultiMatch(BOTH, "the and", kind="most_fields")),
    "multi_boost": _every(w.MultiMatch(("text", "head^3"), "the and")),
    "all_field": _every(w.Match("_all", "src3 de the")),
    "phrase_prefix": _every(w.PhrasePrefix(("text",), "of th")),
    "phrase_prefix_fields": _every(w.PhrasePrefix(("text", "head^2"), "is the a")),
    "phrase_prefix_word": _every(w.PhrasePrefix(("text",), "thi")),
    "phrase_prefix_first": _every(w.PhrasePrefix(("text",), "thi", max_expansions=20)),
    "query_string": _every(QUERY_STRING),
    "simple_query_string": _every(SIMPLE_QUERY_STRING),
    "uri_query": _every(w.uri_query("source:src0 the")),
    "wildcard": _every(w.Wildcard("text", w.contains("tion"))),
    "term_keyword": _every(w.Term("lang", "en")),
    "term_text": _every(w.Term("text", "of")),
    "bool_query": _every(BOOL),
    "bool_column": _every(BOOL_COLUMN),
    "bool_should": _every(BOOL_SHOULD),
    "explain": explain,
    "explain_bool": explain_bool,
    "explain_phrase": explain_phrase,
    "explain_query_string": explain_query_string,
    "min_score": _page(MATCH, size=100, min_score=1.5),
    "match_all": _every(w.MatchAll()),
    "totals": totals,
    "page_2": _page(MATCH, size=10, offset=10),
    "norm_score": norm_score,
    "extract": extract,
    "extract_scores": extract_scores,
    "source_filter": source_filter,
    "hit_shape": hit_shape,
    "highlight": highlight,
    "highlight_phrase": _marked(PHRASE),
    "highlight_query_string": _marked(QUERY_STRING),
    "date_fallback": date_fallback,
    "latest": latest,
    "type_filter": _page(w.Match("text", "the and"), size=50, name="conversations", doc_type="user"),
    "dispatch": dispatch,
    "search_many": _many("text", lambda t: w.Match("text", t)),
    "search_many_best": _many("text", lambda t: w.MultiMatch(BOTH, t)),
    "search_many_typed": search_many_typed,
    "search_many_pruned": _many("text", lambda t: w.Match("text", t), prune=True),
    "search_many_best_pruned": _many("text", lambda t: w.MultiMatch(BOTH, t), prune=True),
    "search_many_phrase": _many("phrase", lambda t: w.PhrasePrefix(("text",), t), step=2),
    "search_many_query_string": _many("request", lambda t: w.QueryString(BOTH, t), step=4),
    "search_many_wildcard": _many("pattern", lambda t: w.Wildcard("text", t), step=1),
    "search_many_term": _many("word", lambda t: w.Term("text", t), step=1),
    "terms_stats": terms_stats,
    "terms_array": terms_array,
    "stats": stats,
    "agg_with_query": agg_with_query,
    "suggest": suggest,
    "suggest_many": suggest_many,
    "search_and_suggest": search_and_suggest,
}
