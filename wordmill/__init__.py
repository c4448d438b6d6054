"""Full-text search and bucketed statistics over Spark DataFrames."""

from wordmill.functions.chains import (
    AsciiFolding,
    Chain,
    KeywordMarker,
    LightEnglish,
    Lowercase,
    PorterStem,
    Possessive,
    StemmerOverride,
    Stop,
    analyze,
    analyze_stages,
    analyzer,
)
from wordmill.operators.aggs import aggregate, scope, stats, terms
from wordmill.operators.explaining import explain
from wordmill.operators.search import SearchResult, hits, search, search_many, search_named
from wordmill.operators.shaping import extract, highlight, normalized, totals
from wordmill.operators.suggest import Spelling, requests, search_and_suggest, suggest
from wordmill.plans.mapping import FieldSpec, Mapping, entry_mapping
from wordmill.plans.query import (
    Bool,
    Match,
    MatchAll,
    MultiMatch,
    PhrasePrefix,
    QueryString,
    Term,
    Wildcard,
    contains,
    make_query,
    uri_query,
)
from wordmill.sources.bulk import bulk_lines, read_bulk
from wordmill.sources.store import (
    Index,
    build_index,
    clear_workspace,
    create_index,
    delete_index,
    describe_index,
    index_all,
    index_exists,
    numbered_index,
    open_index,
    spread,
)
