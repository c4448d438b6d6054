"""BM25 over the postings.

Query terms are rows `(keys…, slot, field, term, qtf, need)`; a slot is one field of
one clause of the query. They get their weights from the small `terms` and `stats`
tables, and only then meet the postings, in a single join for all clauses.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordmill.functions.bm25 import idf, tf_norm
from wordmill.sources.store import Index

# A table is broadcast up to this size, measured or proven. A long string counts as
# several rows, one more for every ROW_BYTES.
BROADCAST_ROWS = 500_000
ROW_BYTES = 64
# Beyond it, the postings of a term are spread over slices of about this many rows.
SLICE_ROWS = 1_000_000


def row_units(df: DataFrame) -> Column:
    """The rows of a table as a sum, with long strings counted by their bytes."""
    strings = [F.col(f.name) for f in df.schema if isinstance(f.dataType, T.StringType)]
    more = [F.coalesce(F.floor(F.octet_length(c) / ROW_BYTES), F.lit(0)) for c in strings]
    return F.sum(reduce(Column.__add__, more, F.lit(1).cast("bigint")))


def measure(df: DataFrame) -> int:
    """Size of a table in rows of at most ROW_BYTES of text, from one pass over it."""
    return df.agg(row_units(df)).first()[0] or 0


def small(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast a table if its measured or proven size allows it, and only then: Spark's
    own estimate does not see that an `explode` makes many rows of one."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df.hint("merge")


def weigh(
    index: Index,
    query_terms: DataFrame,
    rows: int,
    literal_terms: Sequence[str] | None = None,
    more: Sequence[str] = (),
) -> DataFrame:
    """Add `df`, `idf` and `avgdl` to query terms; terms not in the index drop out.

    `rows` is the size of the query terms, measured or known; `more` names further columns of `terms`.
    """
    # one row per field: bounded by the mapping
    stats = F.broadcast(index.stats.select("field", "n_docs", "avgdl"))
    terms = index.terms.select("field", "term", "df", *more)
    if literal_terms is not None:
        # reaches the file scan, which then reads only the buckets of these terms
        terms = terms.where(F.col("term").isin(list(literal_terms)))
    found = terms.join(small(query_terms, rows), ["field", "term"]).join(stats, "field")
    return found.withColumn("idf", idf(F.col("df"), F.col("n_docs"))).drop("n_docs")


def meet_postings(
    index: Index,
    query_terms: DataFrame,
    rows: int,
    columns: Sequence[str],
    fields: Sequence[str],
    literal_terms: Sequence[str] | None = None,
) -> DataFrame:
    """Join query terms, which carry `df`, to the postings on field and term.

    Query terms are broadcast if they are few, as those of a single query always are.
    Otherwise both sides are shuffled by term, with the postings of frequent terms cut
    into slices.
    """
    postings = index.postings.where(F.col("field").isin(list(fields))).select(
        "field", "term", index.key, *columns
    )
    if literal_terms is not None:
        postings = postings.where(F.col("term").isin(list(literal_terms)))
    if rows <= BROADCAST_ROWS:
        return postings.join(F.broadcast(query_terms), ["field", "term"])
    return _sliced(index, postings, query_terms)


def _sliced(index: Index, postings: DataFrame, query_terms: DataFrame) -> DataFrame:
    """Join on (field, term, slice). A slice of a frequent term holds the postings of
    some documents; its query rows are repeated for every slice."""
    total = index.stats.agg(F.sum("n_postings")).first()[0] or 0
    # at most 100,000 terms can have over total/100,000 postings: a safe broadcast
    rows = max(SLICE_ROWS, total // 100_000)
    slices = F.ceil(F.col("df") / rows).cast("int")
    hot = index.terms.where(F.col("df") > rows).select("field", "term", slices.alias("_slices"))
    cut = postings.join(F.broadcast(hot), ["field", "term"], "left").withColumn(
        "_slice", F.pmod(F.xxhash64(index.key), F.coalesce("_slices", F.lit(1))).cast("int")
    )
    spread = query_terms.withColumn(
        "_slice", F.explode(F.sequence(F.lit(0), F.greatest(slices, F.lit(1)) - 1))
    )
    return cut.drop("_slices").join(spread.hint("merge"), ["field", "term", "_slice"]).drop("_slice")


def contributions(
    index: Index,
    weights: DataFrame,
    rows: int,
    fields: Sequence[str],
    literal_terms: Sequence[str] | None = None,
) -> DataFrame:
    """One row per query term and document, with the parts of its score."""
    met = meet_postings(index, weights, rows, ["tf", "dl"], fields, literal_terms)
    norm = tf_norm(F.col("tf"), F.col("dl"), F.col("avgdl"))
    return met.withColumn("tf_norm", norm).withColumn(
        "score", F.col("qtf") * F.col("boost") * F.col("idf") * F.col("tf_norm")
    )
