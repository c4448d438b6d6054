"""Query descriptions. They hold no data and do no work; `operators.search` turns them
into DataFrame operations.

A text is either a string, or a Column over a DataFrame of queries, in which case one
job answers every row of that DataFrame.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column

from wordmill.functions.chains import Chain
from wordmill.plans.mapping import ALL_FIELD, FieldSpec, Mapping

Text = str | Column


class Query:
    """Any query."""


@dataclass(frozen=True)
class MatchAll(Query):
    """Every document, with score 1."""


@dataclass(frozen=True)
class Match(Query):
    """Documents holding any term of the analyzed text, or all with operator "and"."""

    field: str
    text: Text
    operator: str = "or"
    analyzer: str | Chain | None = None


@dataclass(frozen=True)
class MultiMatch(Query):
    """A match on several fields; `name^3` multiplies that field's score.

    `best_fields` takes the best field's score, `most_fields` the sum.
    """

    fields: tuple[str, ...]
    text: Text
    kind: str = "best_fields"
    operator: str = "or"
    analyzer: str | Chain | None = None


@dataclass(frozen=True)
class PhrasePrefix(Query):
    """The text as a phrase whose last word is a prefix; the best field counts.

    All terms with the prefix count, unless `max_expansions` says how many.
    """

    fields: tuple[str, ...]
    text: Text
    max_expansions: int | None = None


@dataclass(frozen=True)
class Term(Query):
    """An exact value, not analyzed: a term of a text field, or a column's value."""

    field: str
    value: object


@dataclass(frozen=True)
class Wildcard(Query):
    """A term pattern with `*` and `?`, not analyzed."""

    field: str
    pattern: Text


@dataclass(frozen=True)
class QueryString(Query):
    """Boolean query text: `+(opportunity | search) -frittata`, `title:in action`.

    Every word is a best-fields match. `+` requires, `-` excludes, `|` is OR, and words
    side by side take the default operator, from left to right without precedence.
    Parentheses group one level deep. `|` is OR in both syntaxes of the request.
    """

    fields: tuple[str, ...]
    text: Text
    default_operator: str = "or"
    analyzer: str | Chain | None = None
    lenient: bool = False


@dataclass(frozen=True)
class Bool(Query):
    """`must` clauses all match and add to the score; `must_not` excludes; `should` adds.

    Without `must`, at least one `should` clause has to match.
    """

    must: tuple[Query, ...] = ()
    must_not: tuple[Query, ...] = ()
    should: tuple[Query, ...] = ()


def boosted(name: str) -> tuple[str, float]:
    """Split `field^n`."""
    field, _, factor = name.partition("^")
    return field, float(factor) if factor else 1.0


def field_and_boost(mapping: Mapping, name: str) -> tuple[FieldSpec, float]:
    """The field and its boost: that of the mapping times that of the request."""
    field, factor = boosted(name)
    spec = mapping.field(field)
    return spec, spec.boost * factor


def contains(text: str) -> str:
    """The wildcard pattern for terms that contain a text."""
    return f"*{text}*"


def make_query(kind: str, text: Text, fields: Sequence[str] = (ALL_FIELD,), **options) -> Query:
    """A query by the name of its type; the first field serves single-field types."""
    fields = tuple(fields)
    if kind == "match_all":
        return MatchAll()
    if kind == "match":
        return Match(fields[0], text, **options)
    if kind in ("multi_match", "best_fields"):
        return MultiMatch(fields, text, **options)
    if kind == "most_fields":
        return MultiMatch(fields, text, kind="most_fields", **options)
    if kind == "phrase_prefix":
        return PhrasePrefix(fields, text, **options)
    if kind == "term":
        return Term(fields[0], text)
    if kind == "wildcard":
        return Wildcard(fields[0], contains(text) if isinstance(text, str) else text)
    if kind in ("query_string", "simple_query_string"):
        return QueryString(fields, text, **options)
    raise ValueError(f"unknown query type {kind!r}")


def uri_query(text: str, default_field: str = ALL_FIELD) -> QueryString:
    """A query as written in an address: words, and `field:word`."""
    return QueryString((default_field,), text)
