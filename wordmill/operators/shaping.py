"""Shaping of hits: totals, normalized scores, extraction, highlighting."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordmill.functions.chains import GAP, TOKEN, WORD, analyzer
from wordmill.operators.clauses import Batch, like_pattern, literal_clauses
from wordmill.plans.query import (
    Bool,
    Match,
    MultiMatch,
    PhrasePrefix,
    Query,
    QueryString,
    Term,
    Wildcard,
    boosted,
)
from wordmill.sources.store import Index


def totals(found: DataFrame) -> DataFrame:
    """One row over all hits: `total`, `max_score`, `sum_score`."""
    return found.agg(
        F.count("*").alias("total"), F.max("score").alias("max_score"), F.sum("score").alias("sum_score")
    )


def normalized(page: DataFrame, every_hit: DataFrame | None = None) -> DataFrame:
    """Add `norm_score`, the score over one plus the highest score of all hits."""
    best = (page if every_hit is None else every_hit).agg(F.max("score"))
    return page.withColumn("norm_score", F.col("score") / (1.0 + best.scalar()))


@dataclass(frozen=True)
class Extract:
    """`hits`: `hit_score`, `document_id`, `entry_id`; `scores`: one row of maximum and sum."""

    hits: DataFrame
    scores: DataFrame


def extract(index: Index, found: DataFrame, document_column: str, min_score: float = 0.0) -> Extract:
    """Scores and ids of the hits of at least `min_score`.

    The maximum is that of all hits; the sum leaves out the hits below `min_score`.
    """
    enough = F.col("score") >= min_score
    parents = index.docs.select(index.key, F.col(document_column).alias("document_id"))
    rows = found.where(enough).join(parents, index.key)
    scores = found.agg(
        F.coalesce(F.max("score"), F.lit(0.0)).alias("max_score"),
        F.coalesce(F.sum(F.when(enough, F.col("score"))), F.lit(0.0)).alias("sum_score"),
    )
    return Extract(
        rows.select(F.col("score").alias("hit_score"), "document_id", F.col(index.key).alias("entry_id")),
        scores,
    )


# ---- highlighting --------------------------------------------------------------------


@dataclass(frozen=True)
class _Marks:
    """What to mark in one field: whole terms, `LIKE` patterns of terms, and phrases.

    A phrase is its words as (offset, pattern); they are marked only where they all stand so.
    """

    terms: tuple[str, ...] = ()
    patterns: tuple[str, ...] = ()
    phrases: tuple[tuple[tuple[int, str], ...], ...] = ()

    def __add__(self, other: _Marks) -> _Marks:
        return _Marks(self.terms + other.terms, self.patterns + other.patterns, self.phrases + other.phrases)


def _marks(index: Index, query: Query, field: str) -> _Marks:
    spec = index.mapping.field(field)
    if isinstance(query, Bool):
        parts = [_marks(index, q, field) for q in (*query.must, *query.should)]
        return sum(parts, _Marks())
    if isinstance(query, Term) and query.field == field:
        return _Marks(terms=(str(query.value),))
    if isinstance(query, Wildcard) and query.field == field:
        return _Marks(patterns=(like_pattern(query.pattern),))
    given = getattr(query, "analyzer", None)
    chain = analyzer(given) if given is not None else spec.chain
    if isinstance(query, QueryString):
        words = " ".join(_wanted_words(index, query, field))
        return _Marks(tuple(t for _, t in Batch(index).literal_tokens(words, chain)))
    names = (query.field,) if isinstance(query, Match) else getattr(query, "fields", ())
    if field not in [boosted(n)[0] for n in names]:
        return _Marks()
    tokens = Batch(index).literal_tokens(query.text, chain)
    if isinstance(query, PhrasePrefix) and tokens:
        *fixed, (last, prefix) = tokens
        start = tokens[0][0]
        words = [(place - start, like_pattern(term, "")) for place, term in fixed]
        return _Marks(phrases=((*words, (last - start, like_pattern(prefix, "") + "%")),))
    return _Marks(tuple(t for _, t in tokens))


def _wanted_words(index: Index, query: QueryString, field: str) -> list[str]:
    """The words of a query string that a hit may hold in a field: not those of excluded clauses."""
    unnamed = field in [boosted(n)[0] for n in query.fields]
    names = [f.name for f in index.mapping.fields]
    out = []
    for sign, pieces in literal_clauses(index, query.text):
        for piece in pieces if sign != "-" else ():
            named = next((n for n in names if piece.startswith(f"{n}:") and len(piece) > len(n) + 1), None)
            if piece != "|" and (named == field or (named is None and unnamed)):
                out.append(piece if named is None else piece[len(named) + 1 :])
    return out


def highlight(
    index: Index, found: DataFrame, query: Query, field: str, before: str = "<em>", after: str = "</em>"
) -> DataFrame:
    """The text of every hit that holds what was asked for in the field, with that marked.

    The text is cut into words and the gaps between them; each word is analyzed like the field,
    marked if its term was asked for, and the pieces are put together again. A phrase is marked
    where all its words stand in order. Words of a query string are marked in the field that
    they name, or in all fields of the query, but not those of excluded clauses. The elements of
    an array stand on lines of their own. Columns: the key and `highlight`.
    """
    spec, key = index.mapping.field(field), index.key
    marks = _marks(index, query, field)
    docs = index.docs.select(key, F.expr(spec.expression).alias("_text"))
    # keys move to the buckets of the documents: texts stay there, a shard in each task
    ids = found.select(key).repartition(index.shards, key)
    wanted = docs.join(ids.hint("shuffle_hash"), key, "left_semi")
    if isinstance(docs.schema["_text"].dataType, T.ArrayType):
        texts = F.filter("_text", lambda e: e.isNotNull())
        wanted = wanted.select(key, F.posexplode(texts).alias("element", "_text"))
    else:
        wanted = wanted.select(key, F.lit(0).alias("element"), "_text")
    cut = F.regexp_extract_all("_text", F.lit(f"{TOKEN}|{GAP}"), F.lit(0))
    pieces = wanted.select(key, "element", F.posexplode(cut).alias("n", "piece")).withColumns(
        {
            "token": F.when(F.col("piece").rlike("^" + WORD), F.col("piece")),
            "protected": F.lit(False),
        }
    )
    pieces = pieces.withColumn("word", F.col("token").isNotNull())
    pieces = spec.chain.filter_tokens(pieces)
    # keeps the tests below from being repeated inside the chain's expressions
    pieces = pieces.select(key, "element", "n", "piece", "word", F.explode(F.array("token")).alias("token"))
    asked = F.col("token").isin(list(marks.terms))
    for pattern in marks.patterns:
        asked = asked | F.col("token").like(pattern)
    if marks.phrases:
        # the words of one text, in their order; removed words keep their places
        along = Window.partitionBy(key, "element", "word").orderBy("n")
        for number, phrase in enumerate(marks.phrases):
            begins = [F.lead("token", n).over(along).like(word) for n, word in phrase]
            begins = reduce(Column.__and__, [F.coalesce(b, F.lit(False)) for b in begins])
            pieces = pieces.withColumn(f"_begins{number}", begins)
            for n, _ in phrase:
                asked = asked | F.coalesce(F.lag(f"_begins{number}", n).over(along), F.lit(False))
    asked = F.col("word") & F.coalesce(asked, F.lit(False))
    pieces = pieces.withColumn("asked", asked)
    shown = F.when(F.col("asked"), F.concat(F.lit(before), "piece", F.lit(after))).otherwise(F.col("piece"))
    pieces = pieces.select(key, "element", "n", "asked", shown.alias("shown"))
    # all pieces of a document are in its own task
    lines = pieces.groupBy(key, "element").agg(
        F.max("asked").alias("asked"), F.array_sort(F.collect_list(F.struct("n", "shown"))).alias("pieces")
    )
    line = F.array_join(F.transform("pieces", lambda p: p["shown"]), "")
    whole = lines.groupBy(key).agg(
        F.max("asked").alias("asked"), F.array_sort(F.collect_list(F.struct("element", line.alias("line")))).alias("lines")
    )
    text = F.array_join(F.transform("lines", lambda x: x["line"]), "\n")
    return whole.where("asked").select(key, text.alias("highlight"))
