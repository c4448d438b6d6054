"""The parts of the scores of hits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wordmill.functions.bm25 import tf_norm
from wordmill.operators.clauses import Batch, Slots, phrase_occurrences, query_string_parts
from wordmill.operators.search import hits
from wordmill.plans.query import (
    Bool,
    Match,
    MatchAll,
    MultiMatch,
    PhrasePrefix,
    Query,
    QueryString,
    Term,
    Wildcard,
    field_and_boost,
)
from wordmill.sources.store import Index

#: What is known of the part of a term.
EXPLAINED = {
    "field": "string", "term": "string", "tf": "int", "df": "bigint", "dl": "int", "idf": "double",
    "tf_norm": "double", "boost": "double",
}


def explain(index: Index, query: Query) -> DataFrame:
    """The parts of every hit's score: key, clause, field, term, its figures, contribution, counted.

    The `counted` contributions of a document add up to its score; of a best-fields match
    only the best field counts. The clauses of a bool are named by their place, `must 0` or
    `should 1 must 0`; a `must_not` clause has no part in a hit. A phrase has a row for each of its
    words, with the occurrences of the phrase as `tf`. The clauses of a query string are named
    `must` if they are marked `+`, else `should`, by their place in the text; a word that the
    joining of clauses leaves out, or that stands in another field than its best, is not counted.
    A clause without terms of its own (wildcards, column values) is one row, of its whole score.
    """
    nothing = {c: F.lit(None).cast(kind) for c, kind in EXPLAINED.items()}
    if isinstance(query, Bool):
        parts = [
            explain(index, q).withColumn("clause", F.concat_ws(" ", F.lit(f"{group} {n}"), F.nullif("clause", F.lit(""))))
            for group, clauses in (("must", query.must), ("should", query.should))
            for n, q in enumerate(clauses)
        ]
        if not parts:
            parts = [explain(index, MatchAll()).withColumn("contribution", F.lit(0.0))]
        found = hits(index, query).select(index.key).hint("shuffle_hash")
        return reduce(DataFrame.unionByName, parts).join(found, index.key, "left_semi")
    if isinstance(query, PhrasePrefix) and all(field_and_boost(index.mapping, f)[0].is_text for f in query.fields):
        return _explain_phrase(index, query)
    if isinstance(query, QueryString):
        return _explain_query_string(index, query)
    spec = index.mapping.get(query.field) if isinstance(query, (Match, Term)) else None
    if isinstance(query, MultiMatch) or (spec is not None and spec.is_text):
        return _explain_terms(index, query)
    found = hits(index, query).withColumns({**nothing, "contribution": F.col("score"), "counted": F.lit(True)})
    if isinstance(query, (Wildcard, Term, Match)):
        found = found.withColumn("field", F.lit(query.field))
    return found.withColumn("clause", F.lit("")).select(index.key, "clause", *EXPLAINED, "contribution", "counted")




def _explain_phrase(index: Index, query: PhrasePrefix) -> DataFrame:
    parts = []
    for place, name in enumerate(query.fields):
        spec, boost = field_and_boost(index.mapping, name)
        found = phrase_occurrences(Batch(index), query, spec, boost)
        found = found.withColumn("tf_norm", tf_norm(F.col("tf"), F.col("dl"), F.col("avgdl")))
        rows = found.withColumns({"field": F.lit(spec.name), "_place": F.lit(place)})
        rows = rows.withColumn("_sum", F.col("boost") * F.col("idf_sum") * F.col("tf_norm"))
        rows = rows.select("*", F.explode("words").alias("_word")).withColumns(
            {"term": F.col("_word.term"), "df": F.col("_word.df"), "idf": F.col("_word.idf")}
        )
        parts.append(rows.withColumn("contribution", F.col("boost") * F.col("idf") * F.col("tf_norm")))
    rows = reduce(DataFrame.unionByName, parts)
    # the best field counts; one window per document, of the phrase's words
    best = F.max(F.struct("_sum", -F.col("_place"))).over(Window.partitionBy(index.key))
    counted = (best["col2"] == -F.col("_place")).alias("counted")
    kinds = [F.col(c).cast(kind).alias(c) for c, kind in EXPLAINED.items()]
    return rows.select(index.key, F.lit("").alias("clause"), *kinds, "contribution", counted)


def _explain_query_string(index: Index, query: QueryString) -> DataFrame:
    key = index.key
    found, scored = query_string_parts(Batch(index), query)
    parts = found.select(key, F.inline("score")).withColumnRenamed("score", "_whole")
    # the first of the fields with the highest score of a word; one window per document and word
    own = Window.partitionBy(key, "word")
    scored = scored.withColumn("_sum", F.sum("score").over(Window.partitionBy(key, "word", "field")))
    scored = scored.withColumn("_top", F.max("_sum").over(own))
    best = F.min(F.when(F.col("_sum") == F.col("_top"), F.col("field"))).over(own)
    scored = scored.withColumn("counted", F.col("field") == best).withColumnRenamed("score", "contribution")
    counting = parts.select(key, "clause", "sign", "word")
    rows = scored.join(counting.hint("merge"), [key, "word"])
    name = F.concat_ws(" ", F.when(F.col("sign") == "+", "must").otherwise("should"), F.col("clause").cast("string"))
    kinds = [F.col(c).cast(kind).alias(c) for c, kind in EXPLAINED.items()]
    return rows.select(key, name.alias("clause"), *kinds, F.col("contribution").cast("double").alias("contribution"), "counted")



def _explain_terms(index: Index, query: Match | MultiMatch | Term) -> DataFrame:
    slots = Slots(Batch(index))
    if isinstance(query, Match):
        slots.add_match(query)
    elif isinstance(query, MultiMatch):
        slots.add_multi_match(query)
    else:
        slots.add_term(query)
    rows = slots.term_contributions()
    # a field counts if it holds all the words that it needs; both windows are as large as the query
    of_field = Window.partitionBy(index.key, "slot")
    rows = rows.withColumns(
        {"_met": F.count("*").over(of_field) >= F.col("need"), "_sum": F.sum("score").over(of_field)}
    )
    counted = F.col("_met")
    if isinstance(query, MultiMatch) and query.kind == "best_fields":
        best = F.max(F.when(F.col("_met"), F.struct("_sum", -F.col("slot")))).over(Window.partitionBy(index.key))
        counted = counted & (best["col2"] == -F.col("slot"))
    kinds = [F.col(c).cast(kind).alias(c) for c, kind in EXPLAINED.items()]
    return rows.select(
        index.key, F.lit("").alias("clause"), *kinds, F.col("score").alias("contribution"), counted.alias("counted")
    )
