"""Pruned batches against all scores."""

import random

import pytest
from pyspark.sql import functions as F

from wordmill import FieldSpec, Mapping, Match, MultiMatch, build_index, hits, search_many
from wordmill.operators import scoring, topk

SIZE = 3


@pytest.fixture(scope="module")
def library(spark):
    """Common and rare words, long and short documents, and copies that tie."""
    rng = random.Random(9)
    words = [f"w{n}" for n in range(150)]
    weights = [1 / (n + 1) for n in range(150)]
    rows = []
    for n in range(500):
        said = rng.choices(words, weights, k=rng.choice([3, 10, 40]))
        rows.append((n, " ".join(said), " ".join(said[:3])))
    rows += [(1000 + k, rows[k % 5][1], rows[k % 5][2]) for k in range(40)]
    docs = spark.createDataFrame(rows, "id bigint, a string, b string")
    asked = [" ".join(rng.choices(words, weights, k=8)) for _ in range(25)] + [rows[k][1] for k in range(5)]
    asked += ["w149", "w0 w1", "nosuch", "", "w0 " * 30]
    queries = spark.createDataFrame(list(enumerate(asked)), "query_id bigint, text string")
    return build_index(spark, "topk", docs, Mapping((FieldSpec("a"), FieldSpec("b", boost=2.0)), "id"), shards=3), queries


QUERIES = {
    "match": lambda t: Match("a", t),
    "best": lambda t: MultiMatch(("a", "b"), t),
    "most": lambda t: MultiMatch(("a^2", "b"), t, kind="most_fields"),
}


def best(index, queries, query, digits, size=SIZE):
    """The first of every query, from all scores."""
    found = {}
    for r in hits(index, query, queries).collect():
        score = r["score"] if digits is None else round(r["score"], digits)
        found.setdefault(r["query_id"], []).append((-round(score, 9), r["id"]))
    return {(q, rank, key) for q, rows in found.items() for rank, (_, key) in enumerate(sorted(rows)[:size], 1)}


@pytest.mark.parametrize(("kind", "digits", "broadcast"), [("match", None, True), ("best", 1, True), ("most", None, False)])
def test_the_best_are_the_same(library, monkeypatch, kind, digits, broadcast):
    index, queries = library
    query = QUERIES[kind](F.col("text"))
    want = best(index, queries, query, digits)
    if not broadcast:
        monkeypatch.setattr(scoring, "BROADCAST_ROWS", 0)
        monkeypatch.setattr(scoring, "SLICE_ROWS", 20)
    monkeypatch.setattr(topk, "POSTINGS_PER_SEED", 3)
    found = search_many(index, queries, query, size=SIZE, digits=digits, prune=True).collect()
    assert {(r["query_id"], r["rank"], r["id"]) for r in found} == want
    assert len(want) > 80


def test_few_documents_are_scored_in_full(library):
    index, queries = library
    work = topk.BestMatches(index, Match("a", F.col("text")), queries, "query_id", SIZE, 1e-9).work()
    done = work.agg(*(F.sum(c).alias(c) for c in ("survivors", "candidates", "light"))).first()
    pairs = hits(index, Match("a", F.col("text")), queries).count()
    assert done["light"] > 0 and done["survivors"] < pairs / 4


def test_what_cannot_be_pruned(library):
    index, _ = library
    assert topk.prunable(index, Match("a", "x"))
    assert not topk.prunable(index, Match("a", "x", operator="and"))
    assert not topk.prunable(index, MultiMatch(("a", "id"), "x")) if index.mapping.get("id") else True


def test_bounds_are_kept_with_the_terms(library):
    """`top` is the highest part that any posting gives a term."""
    index, _ = library
    stats = index.stats.select("field", "avgdl")
    parts = index.postings.join(stats, "field").groupBy("field", "term").agg(
        F.max(scoring.tf_norm(F.col("tf"), F.col("dl"), F.col("avgdl"))).alias("want")
    )
    assert index.terms.join(parts, ["field", "term"]).where("top != want").count() == 0
