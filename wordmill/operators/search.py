"""Searching an index: all hits of a query, pages of hits, and batches of queries."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordmill.operators.clauses import Batch, Slots, column_predicate, first_wildcard_hits
from wordmill.operators.shaping import totals
from wordmill.operators.topk import BestMatches, prunable
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
    make_query,
)
from wordmill.sources.store import Index, index_exists, open_index

# Sums of doubles may differ in the last bits from run to run; ranks must not.
RANK_DIGITS = 9
# Up to this many hits of a page are looked up by their keys.
FETCH_ROWS = 10_000


@dataclass(frozen=True)
class Value:
    """Whether a clause matches a document, and its score there (0 where it does not)."""

    matched: Column
    score: Column


def hits(index: Index, query: Query, queries: DataFrame | None = None, id_column: str = "query_id") -> DataFrame:
    """Every matching document: the key and `score`; with `queries`, per query id."""
    batch = Batch(index, queries, id_column)
    if batch.single:
        on_docs = _document_filter(index, query)
        if on_docs is not None:
            return index.docs.where(on_docs.matched).select(index.key, on_docs.score.alias("score"))
    rest, wanted, unwanted = _split_filters(index, query)
    if wanted or unwanted:
        found = hits(index, rest, queries, id_column)
        return _filtered(index, found, wanted, unwanted)
    slots = Slots(batch)
    value = _read(query, slots)
    group = [*batch.keys, index.key]
    rows = slots.rows()
    if value is None:
        # one clause of one field: every row counts
        return rows.groupBy(*group).agg(F.sum("score").alias("score"))
    columns = []
    for slot in range(slots.count):
        mine = F.col("slot") == slot
        columns += [
            F.sum(F.when(mine, F.col("score"))).alias(f"_s{slot}"),
            F.count(F.when(mine, F.col("score"))).alias(f"_c{slot}"),
            F.max(F.when(mine, F.col("need"))).alias(f"_n{slot}"),
        ]
    found = rows.groupBy(*group).agg(*columns).where(value.matched)
    return found.select(*group, value.score.alias("score"))


def _split_filters(index: Index, query: Query) -> tuple[Query, list[Column], list[Column]]:
    """Take the clauses about document columns out of a bool query that also has text
    clauses which must match; they become filters over the documents."""
    if not isinstance(query, Bool):
        return query, [], []
    on_docs = {id(q): _document_filter(index, q) for q in (*query.must, *query.must_not)}
    must = [q for q in query.must if on_docs[id(q)] is None]
    must_not = [q for q in query.must_not if on_docs[id(q)] is None]
    wanted = [on_docs[id(q)] for q in query.must if on_docs[id(q)] is not None]
    if wanted and (not must or any(not isinstance(q, Term) for q in query.must if on_docs[id(q)] is not None)):
        must, wanted = list(query.must), []
    if not must and not query.should:
        return query, [], []
    unwanted = [on_docs[id(q)].matched for q in query.must_not if on_docs[id(q)] is not None]
    rest = Bool(tuple(must), tuple(must_not), query.should)
    return rest, [v.matched for v in wanted], unwanted


def _filtered(index: Index, found: DataFrame, wanted: list[Column], unwanted: list[Column]) -> DataFrame:
    """Keep hits by filters over the documents, which lie in the same buckets: no shuffle.

    Each clause that must match adds its constant score of 1.
    """
    key = index.key
    if wanted:
        kept = index.docs.where(reduce(Column.__and__, wanted)).select(key).hint("shuffle_hash")
        found = found.join(kept, key, "left_semi").withColumn("score", F.col("score") + float(len(wanted)))
    if unwanted:
        dropped = index.docs.where(reduce(Column.__or__, unwanted)).select(key).hint("shuffle_hash")
        found = found.join(dropped, key, "left_anti")
    return found


# ---- the structure of a query, as expressions over its slots -----------------------


def _read(query: Query, slots: Slots) -> Value | None:
    """Gather the slots of a query. None stands for a single slot that needs no check."""
    if isinstance(query, Match) and query.operator.lower() == "or" and slots.count == 0:
        slots.add_match(query)
        return None
    if isinstance(query, (Wildcard, QueryString)) and slots.count == 0:
        _value(query, slots)
        return None
    return _value(query, slots)


def _slot(slot: int) -> Value:
    matched = F.coalesce(F.col(f"_c{slot}") >= F.col(f"_n{slot}"), F.lit(False))
    return Value(matched, F.when(matched, F.col(f"_s{slot}")).otherwise(F.lit(0.0)))


def _value(query: Query, slots: Slots) -> Value:
    if isinstance(query, MatchAll):
        return _slot(_every_document(slots, 1.0))
    if isinstance(query, Match):
        return _slot(slots.add_match(query)[0])
    if isinstance(query, MultiMatch):
        return _over_fields([_slot(s) for s in slots.add_multi_match(query)], query.kind)
    if isinstance(query, PhrasePrefix):
        return _over_fields([_slot(s) for s in slots.add_phrase(query)], "best_fields")
    if isinstance(query, Term):
        return _slot(slots.add_term(query))
    if isinstance(query, Wildcard):
        return _slot(slots.add_wildcard(query))
    if isinstance(query, QueryString):
        return _slot(slots.add_query_string(query))
    if isinstance(query, Bool):
        if not query.must and not query.should:
            # only exclusions: every other document, with score 0
            kept = [_slot(_every_document(slots, 0.0))]
        else:
            kept = [_value(q, slots) for q in query.must]
        should = [_value(q, slots) for q in query.should]
        without = [_value(q, slots) for q in query.must_not]
        return _boolean(kept, without, should)
    raise TypeError(f"not a query: {query!r}")


def _every_document(slots: Slots, score: float) -> int:
    if not slots.batch.single:
        raise ValueError("a batch of queries needs a text clause: every query would return every document")
    index = slots.batch.index
    return slots.add_rows(index.docs.select(index.key, F.lit(score).alias("score")))


def _over_fields(values: list[Value], kind: str) -> Value:
    if kind not in ("best_fields", "most_fields"):
        raise ValueError(f"unknown kind {kind!r}")
    matched = reduce(Column.__or__, [v.matched for v in values])
    scores = [v.score for v in values]
    if len(scores) == 1:
        return Value(matched, scores[0])
    score = F.greatest(*scores) if kind == "best_fields" else reduce(Column.__add__, scores)
    return Value(matched, score)


def _boolean(must: list[Value], must_not: list[Value], should: list[Value]) -> Value:
    if must:
        matched = reduce(Column.__and__, [v.matched for v in must])
    else:
        matched = reduce(Column.__or__, [v.matched for v in should])
    for v in must_not:
        matched = matched & ~F.coalesce(v.matched, F.lit(False))
    score = reduce(Column.__add__, [v.score for v in [*must, *should]])
    return Value(matched, F.when(matched, score).otherwise(F.lit(0.0)))


def _document_filter(index: Index, query: Query) -> Value | None:
    """A query about document columns only, as a filter over the documents."""
    if isinstance(query, MatchAll):
        return Value(F.lit(True), F.lit(1.0))
    if isinstance(query, Term):
        spec = index.mapping.get(query.field)
        if (spec is not None and spec.is_text) or isinstance(query.value, Column):
            return None
        # left bare, so that it reaches the file scan; null means no match
        matched = column_predicate(index, query)
        return Value(matched, F.when(matched, F.lit(1.0)).otherwise(F.lit(0.0)))
    if isinstance(query, Bool):
        groups = [[_document_filter(index, q) for q in part] for part in (query.must, query.must_not, query.should)]
        if any(v is None for part in groups for v in part):
            return None
        must, must_not, should = groups
        if not must and not should:
            must = [Value(F.lit(True), F.lit(0.0))]
        return _boolean(must, must_not, should)
    return None


# ---- pages -------------------------------------------------------------------------


@dataclass(frozen=True)
class SearchResult:
    """A page of hits, in order, and the one-row totals over all hits."""

    hits: DataFrame
    totals: DataFrame
    every_hit: DataFrame


def search(
    index: Index,
    query: Query,
    *,
    offset: int = 0,
    size: int = 10,
    min_score: float | None = None,
    sort: Sequence[tuple[str, str]] = (),
    source: Sequence[str] | None = None,
    doc_type: str | None = None,
    digits: int | None = None,
) -> SearchResult:
    """One page of hits: by score and then key, or by the `sort` columns and then key.

    `source` names the document columns to return. With `digits`, scores are rounded
    before they are ranked. Totals count all matches, before paging and `min_score`.
    """
    order = ranking(index.key)
    # a query about document columns is a filter: its hits have the columns to sort by already
    on_docs = _document_filter(index, query) if sort else None
    columns, by = _sort_columns(sort)
    if on_docs is not None:
        docs = index.docs.where(on_docs.matched)
        if doc_type is not None:
            docs = docs.where(F.col(index.mapping.type_column) == doc_type)
        found = docs.select(index.key, on_docs.score.alias("score"), *columns)
    else:
        found = _of_type(index, hits(index, query), doc_type)
    if digits is not None:
        found = found.withColumn("score", F.round("score", digits))
    wanted = found if min_score is None else found.where(F.col("score") >= min_score)
    if sort:
        order = [*by, F.col(index.key).asc()]
        if on_docs is None:
            # both sides lie in the buckets of the key
            wanted = wanted.join(index.docs.select(index.key, *columns).hint("merge"), index.key)
    page = wanted.orderBy(*order)
    page = page.offset(offset).limit(size) if offset else page.limit(size)
    if source is None:
        page = page.select(index.key, "score")
    else:
        page = _with_source(index, page, source, size, order)
    found = found.select(index.key, "score")
    return SearchResult(page, totals(found), found)


def ranking(key: str) -> list[Column]:
    return [F.round("score", RANK_DIGITS).desc(), F.col(key).asc()]


def _of_type(index: Index, found: DataFrame, doc_type: str | None) -> DataFrame:
    if doc_type is None:
        return found
    of_type = index.docs.where(F.col(index.mapping.type_column) == doc_type).select(index.key)
    # both sides lie in the buckets of the key
    return found.join(of_type.hint("shuffle_hash"), index.key, "left_semi")


def _sort_columns(sort: Sequence[tuple[str, str]]) -> tuple[list[Column], list[Column]]:
    """The document columns to sort by, under names of their own, and the order."""
    columns = [F.col(name).alias(f"_sort{n}") for n, (name, _) in enumerate(sort)]
    order = []
    for n, (_, direction) in enumerate(sort):
        column = F.col(f"_sort{n}")
        order.append(column.desc_nulls_last() if direction == "desc" else column.asc_nulls_last())
    return columns, order


def _with_source(index: Index, page: DataFrame, source: Sequence[str], size: int, order: list[Column]) -> DataFrame:
    """Fetch the documents of a page. The keys of a page are few, and as literals they
    let the scan skip every bucket and page of the table that holds none of them."""
    wanted = index.docs.columns if list(source) == ["*"] else list(source)
    names = [c for c in wanted if c != index.key]
    docs = index.docs.select(index.key, *[F.col(c).alias(c) for c in names])
    shown = [index.key, "score", *[f"`{c}`" for c in names]]
    if size > FETCH_ROWS:
        return page.join(docs, index.key).orderBy(*order).select(*shown)
    rows = [(row[index.key], row["score"], n) for n, row in enumerate(page.collect())]
    kind = index.docs.schema[index.key].dataType.simpleString()
    ranked = index.spark.createDataFrame(rows, f"`{index.key}` {kind}, score double, _rank int")
    docs = docs.where(F.col(index.key).isin([row[0] for row in rows]))
    # at most FETCH_ROWS keys
    return docs.join(F.broadcast(ranked), index.key).orderBy("_rank").select(*shown)


# ---- entry points --------------------------------------------------------------------


def search_named(
    spark, name: str, kind: str, text: str, fields: Sequence[str], *, page: dict | None = None, **options
) -> SearchResult:
    """Search an index by name with a query type by name; no hits if there is no index."""
    if not index_exists(spark, name):
        nothing = spark.createDataFrame([], "_id string, score double")
        return SearchResult(nothing, totals(nothing), nothing)
    return search(open_index(spark, name), make_query(kind, text, fields, **options), **(page or {}))


def search_many(
    index: Index,
    queries: DataFrame,
    query: Query,
    *,
    offset: int = 0,
    size: int = 10,
    min_score: float | None = None,
    id_column: str = "query_id",
    digits: int | None = None,
    prune: bool | None = None,
    doc_type: str | None = None,
    source: Sequence[str] | None = None,
) -> DataFrame:
    """Answer a DataFrame of queries in one job: query id, `rank`, the key, `score`.

    `query` is the template, with Columns of `queries` as texts. Equal queries are
    answered once. For match queries `prune` says whether only documents that can reach the
    page are scored in full (`topk`); by default the number of postings decides. `doc_type` keeps
    documents of one type (every document that matches is scored then); `source` adds columns.
    """
    if id_column == index.key:
        raise ValueError(f"the id of the queries has the name of the key, {index.key!r}: rename it")
    if doc_type is not None and prune:
        raise ValueError("the floor of a query is that of all types: prune without doc_type")
    texts = [c for c in queries.columns if c != id_column]
    # the ids of equal queries; an aggregate, so copies are reduced before the shuffle
    groups = queries.groupBy(*texts).agg(F.min(id_column).alias("_first"))
    distinct = groups.withColumnRenamed("_first", id_column)
    if prunable(index, query):
        # scores that are equal when rounded are ties
        slack = 10.0 ** -min(RANK_DIGITS, RANK_DIGITS if digits is None else digits)
        found = BestMatches(index, query, distinct, id_column, offset + size, slack)
        found = found.hits(prune if doc_type is None else False)
    elif isinstance(query, Wildcard) and doc_type is None:
        found = first_wildcard_hits(Batch(index, distinct, id_column), query, offset + size)
    else:
        found = hits(index, query, distinct, id_column)
    found = _of_type(index, found, doc_type)
    if digits is not None:
        found = found.withColumn("score", F.round("score", digits))
    if min_score is not None:
        found = found.where(F.col("score") >= min_score)
    per_query = Window.partitionBy(id_column).orderBy(*ranking(index.key))
    ranked = found.withColumn("rank", F.row_number().over(per_query))
    ranked = ranked.where((F.col("rank") > offset) & (F.col("rank") <= offset + size))
    same = [queries[c].eqNullSafe(groups[c]) for c in texts]
    members = queries.join(groups, reduce(Column.__and__, same)).select(queries[id_column], "_first")
    answers = ranked.withColumnRenamed(id_column, "_first")
    answers = answers.join(members, "_first").select(id_column, "rank", index.key, "score")
    if source is None:
        return answers
    names = [c for c in (index.docs.columns if list(source) == ["*"] else source) if c != index.key]
    docs = index.docs.select(index.key, *[F.col(c).alias(f"_source{n}") for n, c in enumerate(names)])
    shown = [F.col(f"_source{n}").alias(c) for n, c in enumerate(names)]
    return answers.join(docs, index.key).select(id_column, "rank", index.key, "score", *shown)
