"""Laws that hold for any documents and queries."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from shelf import as_dict

from wordmill import Bool, FieldSpec, Mapping, Match, MultiMatch, build_index, explain, hits, search

WORDS = ["alpha", "beta", "gamma", "delta", "eps", "zeta"]
FEW = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
texts = st.lists(st.sampled_from(WORDS), min_size=1, max_size=4).map(" ".join)


@pytest.fixture(scope="module")
def index(spark):
    rows = [
        (n, " ".join(WORDS[(n * k) % 6] for k in range(1, 2 + n % 5)), " ".join(WORDS[n % 6 :])) for n in range(1, 40)
    ]
    docs = spark.createDataFrame(rows, "id bigint, a string, b string")
    return build_index(spark, "laws", docs, Mapping((FieldSpec("a"), FieldSpec("b")), "id"), shards=3)


def got(index, query):
    return {k: round(v, 6) for k, v in as_dict(hits(index, query), "id").items()}


@FEW
@given(texts)
def test_bool_of_one(index, text):
    query = Match("a", text)
    assert got(index, Bool(must=(query,))) == got(index, query) == got(index, Bool(should=(query,)))
    assert got(index, Bool(must=(query,), must_not=(query,))) == {}


@FEW
@given(texts)
def test_most_fields_is_at_least_best_fields(index, text):
    best = got(index, MultiMatch(("a", "b"), text))
    most = got(index, MultiMatch(("a", "b"), text, kind="most_fields"))
    assert set(best) == set(most) and all(most[k] >= best[k] for k in best)


@FEW
@given(texts)
def test_explanation_adds_up(index, text):
    parts = {}
    for r in explain(index, Match("a", text)).collect():
        parts[r["id"]] = parts.get(r["id"], 0.0) + r["contribution"]
    assert {k: round(v, 6) for k, v in parts.items()} == pytest.approx(got(index, Match("a", text)), abs=2e-6)


@FEW
@given(texts, st.integers(1, 9))
def test_pages_are_the_ranking(index, text, size):
    query = Match("a", text)
    ids = lambda **page: [r["id"] for r in search(index, query, **page).hits.collect()]
    assert ids(size=size) + ids(size=size, offset=size) == ids(size=2 * size)


@FEW
@given(texts)
def test_repeated_words_count_each_time(index, text):
    once, twice = got(index, Match("a", text)), got(index, Match("a", f"{text} {text}"))
    assert twice == pytest.approx({k: 2 * v for k, v in once.items()}, abs=5e-6)
