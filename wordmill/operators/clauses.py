"""The clauses of a query, as rows `(keys…, doc, slot, score, need)`.

Every clause of a query becomes one or more slots. All text clauses share one scan of
the postings. The hits of all slots are then added up per document in one aggregate,
and the boolean structure is an expression over the slots' columns.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordmill.functions.bm25 import idf, tf_norm
from wordmill.functions.chains import Chain, analyzer
from wordmill.functions.folding import lower_ascii
from wordmill.operators.scoring import (
    ROW_BYTES,
    contributions,
    measure,
    meet_postings,
    row_units,
    small,
    weigh,
)
from wordmill.plans.mapping import FieldSpec
from wordmill.plans.query import (
    Match,
    MultiMatch,
    PhrasePrefix,
    QueryString,
    Term,
    Text,
    Wildcard,
    boosted,
    field_and_boost,
)
from wordmill.sources.store import Index, beside, kept_table


@dataclass
class Batch:
    """Where the query texts come from: one literal query, or a DataFrame of them."""

    index: Index
    queries: DataFrame | None = None
    id_column: str = "query_id"

    @property
    def single(self) -> bool:
        return self.queries is None

    @property
    def keys(self) -> list[str]:
        return [] if self.single else [self.id_column]

    @property
    def rows(self) -> DataFrame:
        return self.index.spark.range(0, 1, 1, 1) if self.single else self.queries

    def check(self, text: Text) -> None:
        if self.single and isinstance(text, Column):
            raise ValueError("a Column as query text needs a DataFrame of queries")

    def tokens(self, text: Text, chain: Chain) -> DataFrame:
        """Rows of keys, `position`, `token` of a query text."""
        self.check(text)
        column = F.lit(text) if isinstance(text, str) else text
        return chain.tokens(self.rows.select(*self.keys, column.alias("_text")), F.col("_text"), self.keys)

    def literal_tokens(self, text: str, chain: Chain) -> list[tuple[int, str]]:
        """The tokens of one query's text: as many as the caller wrote."""
        return sorted(tuple(r) for r in self.tokens(text, chain).collect())


@dataclass
class TermSlot:
    """Terms of one field, scored by BM25."""

    slot: int
    name: str
    boost: float
    text: Text
    chain: Chain | None
    operator: str = "or"


@dataclass
class Slots:
    """The slots of a query, gathered while its structure is read."""

    batch: Batch
    count: int = 0
    terms: list[TermSlot] = field(default_factory=list)
    others: list[DataFrame] = field(default_factory=list)

    def new(self) -> int:
        self.count += 1
        return self.count - 1

    # -- text clauses ----------------------------------------------------------------

    def add_match(self, query: Match) -> list[int]:
        return self._add_terms([query.field], query.text, query.analyzer, query.operator)

    def add_multi_match(self, query: MultiMatch) -> list[int]:
        return self._add_terms(query.fields, query.text, query.analyzer, query.operator)

    def _add_terms(self, names, text, given, operator) -> list[int]:
        self.batch.check(text)
        made = []
        for name in names:
            spec, boost = field_and_boost(self.batch.index.mapping, name)
            if not spec.is_text:
                made.append(self.add_term(Term(spec.name, text), boost))
                continue
            chain = analyzer(given) if given is not None else spec.chain
            slot = self.new()
            self.terms.append(TermSlot(slot, spec.name, boost, text, chain, operator.lower()))
            made.append(slot)
        return made

    def add_term(self, query: Term, boost: float = 1.0) -> int:
        """A term of a text field, or a value of a document column."""
        spec = self.batch.index.mapping.get(query.field)
        slot = self.new()
        if spec is not None and spec.is_text:
            self.terms.append(TermSlot(slot, spec.name, spec.boost, query.value, None))
        else:
            self.others.append(_column_hits(self.batch, query).select("*", *_constant(slot, boost)))
        return slot

    # -- clauses with rows of their own -----------------------------------------------

    def add_rows(self, hits: DataFrame) -> int:
        slot = self.new()
        columns = [*self.batch.keys, self.batch.index.key, "score"]
        rows = hits.select(*columns, F.lit(slot).alias("slot"), F.lit(1).alias("need"))
        self.others.append(rows)
        return slot

    def add_wildcard(self, query: Wildcard) -> int:
        return self.add_rows(wildcard_hits(self.batch, query))

    def add_phrase(self, query: PhrasePrefix) -> list[int]:
        made = []
        for name in query.fields:
            spec, boost = field_and_boost(self.batch.index.mapping, name)
            made.append(self.add_rows(phrase_hits(self.batch, query, spec, boost)))
        return made

    def add_query_string(self, query: QueryString) -> int:
        return self.add_rows(query_string_hits(self.batch, query))

    # -- rows ------------------------------------------------------------------------

    def rows(self) -> DataFrame:
        """Hits of all slots."""
        parts = list(self.others)
        columns = [*self.batch.keys, self.batch.index.key, "slot", "score", "need"]
        if self.terms:
            parts.append(self.term_contributions())
        return reduce(DataFrame.unionByName, [p.select(*columns) for p in parts])

    def term_contributions(self) -> DataFrame:
        """The score parts of all text clauses, from one scan of the postings."""
        index = self.batch.index
        fields = sorted({s.name for s in self.terms})
        if self.batch.single:
            rows = _literal_query_terms(self.batch, self.terms)
            literal = sorted({row["term"] for row in rows})
            asked = literal_rows(index, rows, TERM_SCHEMA)
            weights = weigh(index, asked, len(rows), literal)
            return contributions(index, weights, len(rows), fields, literal)
        asked = query_terms(self.batch, self.terms)
        count = measure(asked)
        return contributions(index, weigh(index, asked, count), count, fields)


def _constant(slot: int, score: float) -> list[Column]:
    return [
        F.lit(slot).alias("slot"),
        F.lit(float(score)).alias("score"),
        F.lit(1).alias("need"),
    ]


# ---- query terms ----------------------------------------------------------------


def _literal_query_terms(batch: Batch, slots: list[TermSlot]) -> list[dict]:
    rows, analyzed = [], {}
    for s in slots:
        if s.chain is None:
            tokens = [s.text]
        else:
            if (s.text, s.chain) not in analyzed:
                analyzed[s.text, s.chain] = [t for _, t in batch.literal_tokens(s.text, s.chain)]
            tokens = analyzed[s.text, s.chain]
        distinct = dict.fromkeys(tokens)
        for term in distinct:
            rows.append(
                {
                    "slot": s.slot,
                    "field": s.name,
                    "term": term,
                    "qtf": tokens.count(term),
                    "need": len(distinct) if s.operator == "and" else 1,
                    "boost": s.boost,
                }
            )
    return rows


TERM_SCHEMA = "slot int, field string, term string, qtf int, need int, boost double"


def literal_rows(index: Index, rows: list[dict], schema: str) -> DataFrame:
    """A few driver-made rows as a DataFrame, as many as a caller wrote words."""
    return index.spark.createDataFrame(rows, schema)


def query_terms(batch: Batch, slots: list[TermSlot]) -> DataFrame:
    """Query terms of a DataFrame of queries, repeated words counted together."""
    parts = []
    for s in slots:
        if s.chain is None:
            value = F.lit(s.text) if not isinstance(s.text, Column) else s.text
            tokens = batch.rows.select(*batch.keys, value.cast("string").alias("token"))
        else:
            tokens = batch.tokens(s.text, s.chain)
        counted = tokens.groupBy(*batch.keys, F.col("token").alias("term")).agg(
            F.count("*").cast("int").alias("qtf")
        )
        need = F.lit(1)
        if s.operator == "and":
            # one window per query: as large as the query's text
            need = F.count("*").over(Window.partitionBy(*batch.keys)).cast("int")
        parts.append(
            counted.select(
                *batch.keys,
                F.lit(s.slot).alias("slot"),
                F.lit(s.name).alias("field"),
                "term",
                "qtf",
                need.alias("need"),
                F.lit(s.boost).alias("boost"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


# ---- values of document columns --------------------------------------------------


def _column_hits(batch: Batch, query: Term) -> DataFrame:
    """Documents whose column has a value, or whose array column contains it."""
    index = batch.index
    if batch.single:
        return index.docs.where(column_predicate(index, query)).select(index.key)
    asked = batch.rows.select(*batch.keys, _wanted(index, query).alias("_value"))
    held = _held_values(index, query.field)
    return held.join(small(asked, measure(asked)), "_value").select(*batch.keys, index.key)


def _wanted(index: Index, query: Term) -> Column:
    wanted = query.value if isinstance(query.value, Column) else F.lit(query.value)
    spec = index.mapping.get(query.field)
    return lower_ascii(wanted) if spec is not None and spec.normalized else wanted


def _value_column(index: Index, name: str) -> tuple[DataFrame, Column, bool]:
    spec = index.mapping.get(name)
    value = F.expr(spec.expression) if spec is not None else F.col(name)
    kind = index.docs.select(value.alias("v")).schema["v"].dataType
    is_array = isinstance(kind, T.ArrayType)
    if spec is not None and spec.normalized:
        value = F.transform(value, lower_ascii) if is_array else lower_ascii(value)
    return index.docs, value, is_array


def _held_values(index: Index, name: str) -> DataFrame:
    """Rows of the key and `_value`, one per element of an array column."""
    docs, value, is_array = _value_column(index, name)
    return docs.select(index.key, (F.explode(F.array_distinct(value)) if is_array else value).alias("_value"))


def column_predicate(index: Index, query: Term) -> Column:
    """`Term` on a document column, as a filter over the documents."""
    _, value, is_array = _value_column(index, query.field)
    wanted = _wanted(index, query)
    return F.array_contains(value, wanted) if is_array else value == wanted


# ---- wildcard ---------------------------------------------------------------------


def like_pattern(pattern: str, wild: str = "*?") -> str:
    """`*` and `?` as SQL `LIKE`; only the signs in `wild` are wild."""
    escaped = pattern.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")
    return escaped.translate({ord(sign): {"*": "%", "?": "_"}[sign] for sign in wild})


def wildcard_hits(batch: Batch, query: Wildcard) -> DataFrame:
    """Documents with a term that fits the pattern, with score 1.

    The pattern is tried on the dictionary, one row per term, and the terms found then
    meet the postings.
    """
    index = batch.index
    spec = index.mapping.field(query.field)
    terms = index.terms.where(F.col("field") == spec.name).select("field", "term", "df")
    if batch.single:
        batch.check(query.pattern)
        found = terms.where(F.col("term").like(like_pattern(query.pattern)))
    else:
        found = _batch_wildcard_terms(batch, query, terms, spec.name)
    hits = meet_postings(index, found, measure(found), [], [spec.name])
    # a document may hold several of the terms
    return hits.groupBy(*batch.keys, index.key).agg(F.max(F.lit(1.0)).alias("score"))


def first_wildcard_hits(batch: Batch, query: Wildcard, size: int) -> DataFrame:
    """The `wildcard_hits` that can be among the first `size` of a pattern.

    All score 1, so the least keys are first. A term adds none of them if others have `size` different
    least documents before its own, and no document after the last of these is one.
    """
    index, keys = batch.index, batch.keys
    spec = index.mapping.field(query.field)
    terms = first_table(index, spec.name).withColumn("field", F.lit(spec.name))
    found = _batch_wildcard_terms(batch, query, terms, spec.name, ["first"])
    pattern = Window.partitionBy(*keys)
    # limited in every task, before the shuffle
    found = found.withColumn("_rank", F.dense_rank().over(pattern.orderBy("first"))).where(F.col("_rank") <= size)
    last = F.when(F.max("_rank").over(pattern) == size, F.max("first").over(pattern))
    # read for its size and for the join
    found = kept_table(index, found.select(*keys, "field", "term", "df", last.alias("_last")))
    hits = meet_postings(index, found, measure(found), [], [spec.name])
    hits = hits.where(F.col("_last").isNull() | (F.col(index.key) <= F.col("_last")))
    return hits.groupBy(*keys, index.key).agg(F.max(F.lit(1.0)).alias("score"))


#: Letters of a stored gram.
GRAM = 3


def _grams(text: Column, size: int) -> Column:
    """The distinct runs of `size` letters of a text."""
    starts = F.sequence(F.lit(1), F.length(text) - size + 1)
    runs = F.transform(starts, lambda i: F.substring(text, i, F.lit(size)))
    return F.when(F.length(text) >= size, F.array_distinct(runs)).otherwise(F.array().cast("array<string>"))


def gram_table(index: Index, name: str) -> DataFrame:
    """`gram`, `term`, `df`, `first` for every gram of the dictionary of a field; made when first asked for."""

    def rows() -> DataFrame:
        terms = first_table(index, name)
        return terms.select(F.explode(_grams(F.col("term"), GRAM)).alias("gram"), "term", "df", "first")

    return beside(index, f"grams_{_number(index, name)}", rows, "gram")


def first_table(index: Index, name: str) -> DataFrame:
    """`term`, `df` and `first`, the least key that holds the term, of a field; made when first asked for."""

    def rows() -> DataFrame:
        postings = index.postings.where(F.col("field") == name)
        return postings.groupBy("term").agg(F.count("*").alias("df"), F.min(index.key).alias("first"))

    return beside(index, f"grams_{_number(index, name)}_first", rows, "term")


def gram_counts(index: Index, name: str) -> DataFrame:
    """`gram` and `n`, the number of dictionary terms that hold it."""
    table = gram_table(index, name)
    kind = f"grams_{_number(index, name)}_counts"
    return beside(index, kind, lambda: table.groupBy("gram").agg(F.count("*").alias("n")), "gram")


def _number(index: Index, name: str) -> int:
    return [spec.name for spec in index.mapping.text_fields].index(name)


def _batch_wildcard_terms(
    batch: Batch, query: Wildcard, terms: DataFrame, name: str, more: Sequence[str] = ()
) -> DataFrame:
    """Dictionary terms for many patterns, with `more` of their columns. A pattern meets the terms that
    hold its rarest gram, by equality, and is then tried on them; one without a whole gram is tried on
    the terms that hold its longest part, whose beginnings are made on the way."""
    index, keys = batch.index, batch.keys
    pattern = query.pattern if isinstance(query.pattern, Column) else F.lit(query.pattern)
    like = F.translate(F.regexp_replace("_pattern", r"([%_\\])", r"\\$1"), "*?", "%_")
    parts = F.filter(F.split("_pattern", "[*?]+"), lambda p: F.length(p) >= GRAM)
    asked = batch.rows.select(*keys, pattern.alias("_pattern")).where("_pattern IS NOT NULL")
    # the longest part of a pattern, or none at all
    longest = F.array_max(F.transform(F.split("_pattern", "[*?]+"), lambda p: F.struct(F.length(p).alias("n"), p.alias("p"))))
    part = longest["p"]
    # null if nothing but the part is asked, anywhere in a term
    like = F.when(F.col("_pattern") != F.concat(F.lit("*"), part, F.lit("*")), like)
    asked = asked.select(
        *keys,
        "_pattern",
        like.alias("_like"),
        part.alias("_part"),
        F.flatten(F.transform(parts, lambda p: _grams(p, GRAM))).alias("_grams"),
    )
    # read in every step
    asked = kept_table(index, asked)
    count, short = asked.agg(row_units(asked), F.count_if(F.size("_grams") == 0)).first()
    whole = asked.select(*keys, "_like", "_part", F.explode("_grams").alias("gram"))
    grams = measure(whole)
    counts = gram_counts(index, name).join(small(whole.select("gram").distinct(), grams), "gram")
    # a gram that no term holds is the rarest of all
    rarest = F.min_by("gram", F.coalesce("n", F.lit(0)))
    chosen = whole.join(small(counts, grams), "gram", "left").groupBy(*keys, "_like", "_part").agg(rarest.alias("gram"))
    met = gram_table(index, name).join(small(chosen, count or 0), "gram").where(_fits())
    found = met.select(*keys, F.lit(name).alias("field"), "term", "df", *more)
    if not short:
        return found
    # the part of a short pattern may be the empty gram
    brief = asked.where(F.size("_grams") == 0).select(*keys, "_like", "_part", F.col("_part").alias("gram"))
    runs = F.concat(F.array(F.lit("")), *(_grams(F.col("term"), n) for n in range(1, GRAM)))
    held = terms.withColumn("gram", F.explode(runs))
    met = held.join(small(brief, count or 0), "gram").where(_fits())
    return found.unionByName(met.select(*keys, "field", "term", "df", *more))


def _fits() -> Column:
    """Whether a term fits a pattern: `LIKE` reads a pattern anew for every row, so it is tried last."""
    return F.contains("term", "_part") & (F.col("_like").isNull() | F.expr("term LIKE _like"))


# ---- phrase prefix -----------------------------------------------------------------


def phrase_hits(batch: Batch, query: PhrasePrefix, spec: FieldSpec, boost: float) -> DataFrame:
    """Documents holding the phrase, scored by how often they do.

    The last word is a prefix. It counts as one term: it stands wherever a term that begins
    with it stands, and its document frequency is that of all those terms together. With
    `max_expansions` only that many dictionary terms count, the first in binary order.
    """
    batch.check(query.text)
    if batch.single:
        return _literal_phrase(batch, query, spec, boost)
    keys, index = batch.keys, batch.index
    # both tables are read in every step
    words = kept_table(index, _phrase_words(batch, query.text, spec.chain))
    size = F.when(F.col("slot_no") == F.col("n") - 1, F.length("token"))
    count, sizes, ones, longest = words.agg(
        row_units(words), F.collect_set(size), F.count_if(F.col("n") == 1), F.max("n")
    ).first()
    count = count or 0
    fixed = words.where("slot_no < n - 1").select(*keys, "n", "offset", F.col("token").alias("term"))
    last = words.where("slot_no = n - 1").select(*keys, "n", F.col("offset").alias("last"), "token")
    prefixes = small(last.select("token").distinct(), count)
    ending = _under_prefixes(index, prefixes, sizes or [], spec.name, query.max_expansions)

    # the documents of a prefix, reduced in their buckets; then one number a prefix and task
    met = ending(["tf", "dl"])
    held = met.groupBy("token", index.key).agg(F.sum("tf").alias("tf"), F.max("dl").alias("dl"))
    frequency = held.groupBy("token").agg(F.count("*").alias("df"))
    # one row per field: bounded by the mapping
    stats = F.broadcast(index.stats.select("field", "n_docs", "avgdl"))
    last = last.withColumns({"boost": F.lit(boost), "field": F.lit(spec.name)})
    asked = last.join(small(frequency, count), "token").join(stats, "field")
    asked = asked.withColumn("idf", idf(F.col("df"), F.col("n_docs"))).drop("df", "n_docs", "field")

    # the words before the prefix first: where they stand in order, a phrase is begun
    looked_up = fixed.withColumns({"field": F.lit(spec.name), "boost": F.lit(boost), "qtf": F.lit(1)})
    starts = meet_postings(index, weigh(index, looked_up, count), count, ["dl", "positions"], [spec.name])
    columns = [*keys, index.key, (F.col("n") - 1).alias("n"), "offset", "boost", "idf", "avgdl", "dl", "positions"]
    starts = starts.select(*columns)
    # one word before the prefix stands where it stands
    alone = starts.where("n = 1").withColumns({"idf_sum": F.col("idf"), "common": F.col("positions")})
    begun = alone.drop("n", "offset", "idf", "positions")
    if (longest or 0) > 2:
        begun = begun.unionByName(_aligned([*keys, index.key], starts.where("n > 1")))
    # one row a query at most
    ends = small(asked.where("n > 1").select(*keys, "token", "last", F.col("idf").alias("_idf")), count)
    begun = begun.join(ends, keys)
    # each begun phrase meets the terms of its prefix in its document: dealt by both, so that a
    # prefix that many queries and documents share is many tasks
    places = ending(["positions"])
    ended = begun.join(places.hint("merge"), ["token", index.key])
    # the terms of a prefix stand at different places
    found = ended.withColumn("tf", _shared_places("common", "positions", "last")).where("tf > 0")
    found = found.groupBy(*keys, index.key).agg(
        F.sum("tf").alias("tf"),
        F.max(F.col("idf_sum") + F.col("_idf")).alias("idf_sum"),
        *(F.max(c).alias(c) for c in ("avgdl", "dl", "boost")),
    )
    found = found.select(*keys, index.key, _bm25("tf", "idf_sum").alias("score"))
    if not ones:
        return found
    one = held.join(small(asked.where("n = 1"), count), "token")
    return found.unionByName(one.select(*keys, index.key, _bm25("tf", "idf").alias("score")))


def _shared_places(common: str, places: str, offset: str) -> Column:
    """How many of the places of a list, less an offset, are in the other list. Most lists hold one
    place, which is looked up without a list of the shifted ones."""
    a, b, off = F.col(common), F.col(places), F.col(offset)
    shifted = F.transform(b, lambda p: p - off)
    first, only = F.array_contains(b, F.get(a, F.lit(0)) + off), F.array_contains(a, F.get(b, F.lit(0)) - off)
    many = F.size(F.array_intersect(a, shifted))
    return F.when(F.size(a) == 1, first.cast("int")).when(F.size(b) == 1, only.cast("int")).otherwise(many)


def _as_one_term(postings: DataFrame, keys: list[str]) -> DataFrame:
    """The postings of several terms as those of one."""
    return postings.groupBy(*keys).agg(
        F.sum("tf").alias("tf"),
        F.max("dl").alias("dl"),
        F.flatten(F.collect_list("positions")).alias("positions"),
    )


def _bm25(tf: str, idf: str) -> Column:
    return F.col("boost") * F.col(idf) * tf_norm(F.col(tf), F.col("dl"), F.col("avgdl"))


def _literal_phrase(batch: Batch, query: PhrasePrefix, spec: FieldSpec, boost: float) -> DataFrame:
    found = phrase_occurrences(batch, query, spec, boost)
    return found.select(batch.index.key, _bm25("tf", "idf_sum").alias("score"))


def phrase_occurrences(batch: Batch, query: PhrasePrefix, spec: FieldSpec, boost: float) -> DataFrame:
    """Documents holding a literal phrase: the key, `tf` (occurrences), `idf_sum`, `avgdl`, `dl`,
    `boost`, and `words`, the phrase's words with their `df` and `idf`."""
    index = batch.index
    tokens = batch.literal_tokens(query.text, spec.chain)
    if not tokens:
        nothing = "cast(null as array<struct<place:int,term:string,df:bigint,idf:double>>) AS words"
        numbers = [f"cast(1 as {kind}) AS {c}" for c, kind in (("tf", "int"), ("dl", "int"), ("idf_sum", "double"),
                                                               ("avgdl", "double"), ("boost", "double"))]
        return index.docs.where(F.lit(False)).selectExpr(f"`{index.key}`", *numbers, nothing)
    start = tokens[0][0]
    *fixed, (position, prefix) = tokens
    # the range of the prefix reaches the file scan; postings are sorted by term
    in_range = (F.col("field") == spec.name) & F.col("term").startswith(prefix)
    postings = index.postings.where(in_range)
    if query.max_expansions is not None:
        first = index.terms.where(in_range).select("term").orderBy("term").limit(query.max_expansions)
        postings = postings.join(first, "term", "left_semi")
    held = _as_one_term(postings, [index.key])
    stats = index.stats.where(F.col("field") == spec.name)
    frequency = held.agg(F.count("*")).scalar()
    ends = held.withColumns(
        {
            "term": F.lit(prefix + "*"),
            "df": frequency,
            "idf": idf(frequency, stats.select("n_docs").scalar()),
            "avgdl": stats.select("avgdl").scalar(),
            "boost": F.lit(boost),
            "n": F.lit(len(tokens)),
            "offset": F.lit(position - start),
        }
    )
    columns = [index.key, "term", "df", "n", "offset", "boost", "idf", "avgdl", "dl", "positions"]
    rows = ends.select(*columns)
    if fixed:
        constants = {"field": spec.name, "n": len(tokens), "boost": boost, "qtf": 1}
        words = [{"term": t, "offset": p - start, **constants} for p, t in fixed]
        literal = sorted({row["term"] for row in words})
        weights = weigh(index, literal_rows(index, words, PHRASE_SCHEMA), len(words), literal)
        starts = meet_postings(index, weights, len(words), ["dl", "positions"], [spec.name], literal)
        rows = starts.select(*columns).unionByName(rows)
    word = F.struct(F.col("offset").alias("place"), "term", "df", "idf")
    found = _aligned([index.key], rows, F.array_sort(F.collect_list(word)).alias("words"))
    return found.withColumn("tf", F.size("common")).drop("common")


PHRASE_SCHEMA = "term string, offset int, field string, n int, boost double, qtf int"


def _phrase_words(batch: Batch, text: Text, chain: Chain) -> DataFrame:
    """Rows of keys, `slot_no`, `offset`, `token`, `n`."""
    # one window per query: as large as the query's text
    query = Window.partitionBy(*batch.keys)
    return batch.tokens(text, chain).select(
        *batch.keys,
        (F.row_number().over(query.orderBy("position")) - 1).alias("slot_no"),
        (F.col("position") - F.min("position").over(query)).alias("offset"),
        "token",
        F.count("*").over(query).cast("int").alias("n"),
    )


#: Up to so many lengths of prefixes are cut from every posting; for more, the dictionary is asked.
FEW_SIZES = 2


def _under_prefixes(
    index: Index, prefixes: DataFrame, sizes: list[int], name: str, limit: int | None
) -> Callable[[list[str]], DataFrame]:
    """The postings of all terms that begin with a prefix: `token`, the key and the columns asked for."""
    if limit is None and len(sizes) <= FEW_SIZES:

        def cut(columns: list[str]) -> DataFrame:
            postings = index.postings.where(F.col("field") == name).select("term", index.key, *columns)
            return _beginnings(postings, sizes).join(prefixes, "token").select("token", index.key, *columns)

        return cut
    expanded = kept_table(index, _expansions(index, prefixes, sizes, name, limit))
    rows = measure(expanded)
    return lambda columns: meet_postings(index, expanded, rows, columns, [name]).select("token", index.key, *columns)


def _beginnings(terms: DataFrame, sizes: list[int]) -> DataFrame:
    """Every term with its beginnings (`token`) of the lengths that are asked."""
    offered = F.array(*[F.lit(n) for n in sorted(sizes)]).cast("array<int>")
    held = terms.withColumn("_size", F.explode(offered)).where(F.col("_size") <= F.length("term"))
    return held.withColumn("token", F.substring(F.col("term"), F.lit(1), F.col("_size"))).drop("_size")


def _expansions(index: Index, prefixes: DataFrame, sizes: list[int], name: str, limit: int | None) -> DataFrame:
    """The dictionary terms that begin with a prefix (`token`), or the first `limit` in binary order."""
    terms = index.terms.where(F.col("field") == name).select("field", "term", "df")
    # an equality join: every term offers its beginnings of the lengths that are asked
    held = _beginnings(terms, sizes)
    found = held.join(prefixes, "token")
    if limit is not None:
        ranked = F.row_number().over(Window.partitionBy("token").orderBy("term"))
        found = found.withColumn("_rank", ranked).where(F.col("_rank") <= limit)
    return found.select("token", "field", "term", "df")


def _aligned(keys: list[str], met: DataFrame, *more: Column) -> DataFrame:
    """The places (`common`) at which all `n` words of a phrase stand at their offsets, per document."""
    starts = F.transform("positions", lambda p: p - F.col("offset"))
    # one list per query and document, of the phrase's words
    words = met.groupBy(*keys).agg(
        F.collect_list(starts).alias("starts"),
        F.sum("idf").alias("idf_sum"),
        *(F.max(c).alias(c) for c in ("n", "avgdl", "dl", "boost")),
        *more,
    )
    words = words.where(F.size("starts") == F.col("n"))
    common = F.aggregate("starts", F.element_at("starts", 1), lambda kept, own: F.array_intersect(kept, own))
    return words.withColumn("common", common).where(F.size("common") > 0).drop("starts", "n")


# ---- query strings ------------------------------------------------------------------

# A clause is a group, a bar or a word; a group holds bars and words.
CLAUSE = r"[+-]?\([^()]*\)|\||[^\s()|]+"
PIECE = r"\||[^\s()|]+"


#: Words of a query string whose scores are columns, and the columns of all words and fields; longer ones are read as maps.
FEW_WORDS = 6
SCORE_COLUMNS = 24


def query_string_hits(batch: Batch, query: QueryString) -> DataFrame:
    """Read query strings with string functions, score every word, and fold the clauses
    of each document from left to right."""
    operator = query.default_operator.lower()
    if batch.single:
        joined, _ = _words_of_documents(batch, query)
        return _folded(joined, [batch.index.key], operator)
    index, keys = batch.index, batch.keys
    read, terms, values = _asked_words(batch, query)
    # read for its size, the tables of sets and the joins; rows may share an id
    read = kept_table(index, _with_known(read, terms, values, keys).withColumn("_row", F.monotonically_increasing_id()))
    fields = [f.name for f in index.mapping.text_fields] + [name for name, _, _ in values]
    few = min(FEW_WORDS, max(1, SCORE_COLUMNS // len(fields)))
    n = F.size("known")
    units, rows, long, words = read.agg(
        F.sum(_units()), F.count("*"), F.count_if(n > few), F.max(F.when(n <= few, n))
    ).first()
    parts = []
    if words:
        short = read.where(n <= few)
        # a set of words takes a double for each
        held = small(_counts_of_sets(short, keys, operator), rows * (1 + (words * 8 << words) // ROW_BYTES))
        known = small(short.select(*keys, "known").distinct(), units)
        parts.append(_set_hits(batch, known, held, terms, values, fields, words))
    if long:
        # written, so that what follows reads the queries as it would read all of them
        rest = kept_table(index, batch.rows.join(read.where(n > few).select(*keys).hint("merge"), keys, "left_semi"))
        joined, _ = _words_of_documents(Batch(index, rest, batch.id_column), query)
        parts.append(_folded(joined, [*keys, index.key], operator))
    if not parts:
        none = index.docs.where(F.lit(False)).select(index.key, F.lit(0.0).alias("score"))
        return read.select(*keys).crossJoin(none)
    return reduce(DataFrame.unionByName, parts)


def _set_hits(
    batch: Batch, known: DataFrame, sets: DataFrame, terms: DataFrame, values, fields: list[str], words: int
) -> DataFrame:
    """The hits of query strings of at most `words` words. Which words count depends only on the set
    of words that a document holds: so the clauses are folded once for every set, and a document adds
    up the words of its own."""
    index, keys = batch.index, batch.keys
    place = (F.array_position("known", F.col("word")) - 1).cast("int").alias("place")
    count = measure(terms)
    terms = terms.join(known, keys).select(*keys, place, "term", "field", "qtf", "boost")
    scored = contributions(index, weigh(index, terms, count), count, [f.name for f in index.mapping.text_fields])
    rows = scored.select(*keys, index.key, "place", "field", "score")
    for _, _, hits in values:
        rows = rows.unionByName(hits.join(known, keys).select(*keys, index.key, place, "field", "score"))
    held = rows.groupBy(*keys, index.key).agg(
        *(
            F.sum(F.when((F.col("place") == i) & (F.col("field") == name), F.col("score"))).alias(f"_{i}_{n}")
            for i in range(words)
            for n, name in enumerate(fields)
        )
    )
    # the best field of every word, and which words are there
    best = [reduce(_greater, [F.col(f"_{i}_{n}") for n in range(len(fields))]).alias(f"_{i}") for i in range(words)]
    bits = [F.when(F.col(f"_{i}").isNotNull(), F.lit(1 << i)).otherwise(F.lit(0)) for i in range(words)]
    held = held.select(*keys, index.key, *best).withColumn("_set", reduce(Column.__add__, bits))
    held = held.join(sets, keys).withColumn("_times", F.get("sets", F.col("_set"))).where(F.col("_times").isNotNull())
    parts = [F.coalesce(F.col(f"_{i}") * F.get("_times", F.lit(i)), F.lit(0.0)) for i in range(words)]
    return held.select(*keys, index.key, reduce(Column.__add__, parts).alias("score"))


def _greater(a: Column, b: Column) -> Column:
    return F.greatest(a, b)


def _counts_of_sets(read: DataFrame, keys: list[str], operator: str) -> DataFrame:
    """Per row `sets`, by the bits of a set of its `known` words: how often each of them counts
    where a document holds these, or null if that is no hit."""
    last = F.expr("shiftleft(1, size(known)) - 1")
    rows = read.select(*keys, "_row", "clauses", "known", F.explode(F.sequence(F.lit(0), last)).alias("_set"))
    held = F.filter("known", lambda word, i: F.getbit("_set", i) == 1)
    ones = F.transform("known", lambda word: F.lit(1.0))
    rows = rows.withColumn("scores", F.map_from_arrays(held, F.slice(ones, 1, F.size(held))))
    found = _folded(rows, [*keys, "_row", "known", "_set"], operator, _PARTS)
    times = F.transform("known", lambda word: F.size(F.filter("score", lambda part: part["word"] == word)).cast("double"))
    found = found.groupBy(*keys, "_row").agg(
        F.map_from_entries(F.collect_list(F.struct("_set", times.alias("times")))).alias("_found"),
        F.max(F.size("known")).alias("_n"),
    )
    every = F.sequence(F.lit(0), F.expr("shiftleft(1, _n) - 1"))
    return found.select(*keys, F.transform(every, lambda i: F.try_element_at("_found", i)).alias("sets"))


def query_string_parts(batch: Batch, query: QueryString) -> tuple[DataFrame, DataFrame]:
    """What the hits of one query string are made of: `parts`, the words that count for each hit
    (`clause`, its place; `sign`; `word`; `score`), and every scored term, with its `word` and field.

    The parts go through the same fold as the scores, as lists that are joined instead of numbers
    that are added.
    """
    joined, scored = _words_of_documents(batch, query)
    return _folded(joined, [batch.index.key], query.default_operator.lower(), _PARTS), scored


def _asked_words(batch: Batch, query: QueryString):
    """The `clauses` of the query strings, the terms of their words, and what is asked of keyword fields."""
    batch.check(query.text)
    text = F.lit(query.text) if isinstance(query.text, str) else query.text
    read = batch.rows.select(*batch.keys, _cut(text).alias("clauses"))
    words = F.flatten(F.transform("clauses", lambda c: c["pieces"]))
    words = read.select(*batch.keys, F.explode(F.array_distinct(words)).alias("word")).where("word != '|'")
    return read, *_word_terms(batch, query, words)


def _with_known(read: DataFrame, terms: DataFrame, values, keys: list[str]) -> DataFrame:
    """The clauses without the words that analysis empties, and the other words (`known`)."""
    known = _known(terms, values, keys).groupBy(*keys).agg(F.sort_array(F.collect_set("word")).alias("known"))
    return read.join(known, keys).select(*keys, "known", _seen_clauses(F.col("clauses"), F.col("known")).alias("clauses"))


def _known(terms: DataFrame, values, keys: list[str]) -> DataFrame:
    return reduce(DataFrame.unionByName, [terms.select(*keys, "word"), *[asked for _, asked, _ in values]])


def _words_of_documents(batch: Batch, query: QueryString) -> tuple[DataFrame, DataFrame]:
    """Per document the `scores` of the words that it holds, with the `clauses`; and the terms scored."""
    index, keys = batch.index, batch.keys
    read, terms, values = _asked_words(batch, query)
    if batch.single:
        # as many rows as the caller wrote words
        rows = [row.asDict() for row in terms.collect()]
        count, literal = len(rows), sorted({row["term"] for row in rows})
        terms = literal_rows(index, rows, WORD_SCHEMA)
    else:
        count, literal = measure(terms), None
    fields = [f.name for f in index.mapping.text_fields]
    scored = contributions(index, weigh(index, terms, count, literal), count, fields, literal)
    by_field = scored.groupBy(*keys, index.key, "word", "field").agg(F.sum("score").alias("score"))
    by_field = reduce(DataFrame.unionByName, [by_field, *[hits for _, _, hits in values]])
    best = by_field.groupBy(*keys, index.key, "word").agg(F.max("score").alias("score"))
    # one map per query and document, of at most the query's words
    by_doc = best.groupBy(*keys, index.key).agg(
        F.map_from_entries(F.collect_list(F.struct("word", "score"))).alias("scores")
    )
    if batch.single:
        seen = sorted({row["word"] for row in _known(terms, values, keys).collect()})
        seen = F.array(*[F.lit(word) for word in seen]).cast("array<string>")
        text = F.lit(query.text) if isinstance(query.text, str) else query.text
        joined = by_doc.withColumn("clauses", _seen_clauses(_cut(text), seen))
    else:
        # read for their size and for the join
        read = kept_table(index, _with_known(read, terms, values, keys).drop("known"))
        # sent to the documents if they are few: a row for every query and document stays where it is
        joined = by_doc.join(small(read, read.agg(F.sum(_units())).first()[0] or 0), keys)
    columns = [*keys, index.key, "word", "field", "term", "tf", "df", "dl", "idf", "tf_norm", "boost", "score"]
    rows = [scored.select(*columns)]
    for _, _, hits in values:
        rows.append(hits.select(*[F.col(c) if c in hits.columns else F.lit(None).alias(c) for c in columns]))
    return joined.select(*keys, index.key, "scores", "clauses"), reduce(DataFrame.unionByName, rows)


def _units() -> Column:
    """The size of `clauses` in rows of at most ROW_BYTES: one a query, one a clause and one a piece."""
    pieces = F.flatten(F.transform("clauses", lambda c: c["pieces"]))
    long = F.aggregate(pieces, F.lit(0).cast("bigint"), lambda n, p: n + 1 + F.floor(F.octet_length(p) / ROW_BYTES))
    return long + F.size("clauses") + 1


@dataclass(frozen=True)
class _Adding:
    """What a fold adds up: the scores of words, or lists of the words that count."""

    kind: str
    add: Callable[[Column, Column], Column]
    nothing: str

    def of(self, clause: Column, sign: Column, word: Column) -> Column:
        score = F.try_element_at(F.col("scores"), word)
        if self.kind == "double":
            return score
        part = F.struct(clause.alias("clause"), sign.alias("sign"), word.alias("word"), score.alias("score"))
        return F.when(score.isNotNull(), F.array(part).cast(self.kind))


_SCORES = _Adding("double", Column.__add__, "0.0D")
_PART = "array<struct<clause:int,sign:string,word:string,score:double>>"
_PARTS = _Adding(_PART, lambda a, b: F.concat(a, b), f"CAST(array() AS {_PART})")


def _folded(joined: DataFrame, keys: list[str], operator: str, sums: _Adding = _SCORES) -> DataFrame:
    # bound one after the other: a lambda would compute them again at every use
    joined = joined.select(*keys, _clause_scores(operator, sums).alias("found"))
    joined = joined.select(*keys, "found", _rest(operator, sums).alias("rest"))
    return joined.where(_clauses_match(operator)).select(*keys, _clauses_score(sums).alias("score"))


def _cut(text: Column) -> Column:
    """The clauses of a query string. A group within a group, or one that is not closed, is
    refused rather than misread."""
    flat = F.regexp_replace(text, r"\([^()]*\)", "")
    text = F.when(
        flat.rlike(r"[()]"), F.raise_error(F.concat(F.lit("parentheses are nested or not closed: "), text))
    ).otherwise(text)
    return F.transform(F.regexp_extract_all(text, F.lit(CLAUSE), F.lit(0)), _clause)


def literal_clauses(index: Index, text: str) -> list[tuple[str, list[str]]]:
    """Sign and pieces of the clauses of one query string, as many as a caller wrote."""
    row = index.spark.range(0, 1, 1, 1).select(_cut(F.lit(text)).alias("clauses")).first()
    return [(clause["sign"], list(clause["pieces"])) for clause in row["clauses"]]


def _clause(raw: Column) -> Column:
    """`sign` and `pieces` of a clause; a plain word is a group of one."""
    signed = raw.rlike("^[+-].")
    body = F.when(signed, F.substring(raw, F.lit(2), F.length(raw))).otherwise(raw)
    sign = F.when(raw == "|", F.lit("|")).when(signed, F.substring(raw, 1, 1)).otherwise(F.lit(""))
    return F.struct(sign.alias("sign"), F.regexp_extract_all(body, F.lit(PIECE), F.lit(0)).alias("pieces"))


def _word_terms(batch: Batch, query: QueryString, words: DataFrame):
    """The terms that analysis makes of the words, in every field they are asked of; and
    for each keyword field the words asked of it, and the documents that hold them.

    A word may name its field: `title:in`. On a keyword field it is an exact value.
    """
    index, keys = batch.index, batch.keys
    boosts = _query_string_fields(index, query)
    prefix = "^(" + "|".join(re.escape(f.name) for f in index.mapping.fields) + "):."
    named, word = F.regexp_extract("word", prefix, 1), F.col("word")
    words = words.withColumn("_named", named).withColumn(
        "_text", F.substring(word, F.when(named != "", F.length(named) + 2).otherwise(1), F.length(word))
    )
    if batch.single:
        # the caller's words, cut once
        rows = [tuple(row) for row in words.collect()]
        words = index.spark.createDataFrame(rows, "word string, _named string, _text string")
        names = {named for _, named, _ in rows}
    else:
        # at most the fields of the mapping
        names = {row["_named"] for row in words.select("_named").distinct().collect()}
    terms, values = [], []
    for spec in index.mapping.fields:
        wanted = {spec.name, ""} if spec.name in boosts else {spec.name}
        if not wanted & names:
            continue
        asked = words.where(F.col("_named").isin(sorted(wanted)))
        boost = F.lit(boosts.get(spec.name, spec.boost))
        if spec.is_text:
            chain = analyzer(query.analyzer) if query.analyzer is not None else spec.chain
            tokens = chain.tokens(asked, F.col("_text"), [*keys, "word"])
            counted = tokens.groupBy(*keys, "word", F.col("token").alias("term")).agg(
                F.count("*").cast("int").alias("qtf")
            )
            terms.append(counted.withColumns({"field": F.lit(spec.name), "boost": boost}))
        else:
            asked = asked.select(*keys, "word", "_text")
            held = _held_values(index, spec.name).withColumn("_text", F.col("_value").cast("string"))
            met = held.join(small(asked, measure(asked)), "_text")
            hits = met.select(*keys, index.key, "word", F.lit(spec.name).alias("field"), boost.alias("score"))
            values.append((spec.name, asked.select(*keys, "word"), hits))
    if not terms:
        nothing = words.where(F.lit(False)).select(*keys, "word", F.col("word").alias("term"))
        constants = {"qtf": F.lit(0), "field": F.lit(""), "boost": F.lit(1.0)}
        terms.append(nothing.withColumns(constants))
    return reduce(DataFrame.unionByName, terms), values


WORD_SCHEMA = "word string, term string, qtf int, field string, boost double"


def _query_string_fields(index: Index, query: QueryString) -> dict[str, float]:
    """The searched fields and their boosts; unknown ones are an error unless `lenient`."""
    found = {}
    for name in query.fields:
        bare, factor = boosted(name)
        spec = index.mapping.get(bare)
        if spec is not None:
            found[bare] = spec.boost * factor
        elif not query.lenient:
            raise ValueError(f"no field {bare!r}")
    return found


def _seen_clauses(clauses: Column, known: Column) -> Column:
    """Clauses without the words that analysis empties, and without those left empty."""

    def keep(c):
        kept = F.filter(c["pieces"], lambda p: (p == "|") | F.array_contains(known, p))
        return F.struct(c["sign"].alias("sign"), kept.alias("pieces"))

    return F.filter(F.transform(clauses, keep), lambda c: F.size(c["pieces"]) > 0)


def _fold(items: Column, operator: str, sums: _Adding) -> Column:
    """Join `(bar, score)` items from left to right; a null score stands for no match."""

    def state(bar, seen, score):
        return F.struct(bar.alias("bar"), seen.alias("seen"), score.alias("score"))

    def combine(acc, x):
        a, b = acc["score"], x["score"]
        both = sums.add(a, b)
        either = F.coalesce(both, a, b)
        joined = either if operator == "or" else F.when(acc["bar"], either).otherwise(both)
        value = F.when(acc["seen"], joined).otherwise(b)
        return F.when(x["bar"], state(F.lit(True), acc["seen"], a)).otherwise(
            state(F.lit(False), F.lit(True), value)
        )

    start = state(F.lit(False), F.lit(False), F.lit(None).cast(sums.kind))
    return F.aggregate(items, start, combine)


def _clause_scores(operator: str, sums: _Adding) -> Column:
    """`sign` and `score` of each clause for one document; null where it does not match."""

    def clause(c, place):
        def piece(p):
            return F.struct((p == "|").alias("bar"), sums.of(place, c["sign"], p).alias("score"))

        score = _fold(F.transform(c["pieces"], piece), operator, sums)["score"]
        return F.struct(c["sign"].alias("sign"), score.alias("score"))

    return F.transform("clauses", clause)


def _rest(operator: str, sums: _Adding) -> Column:
    """The clauses without a sign, joined."""
    plain = F.filter("found", lambda v: v["sign"].isin("", "|"))
    items = F.transform(plain, lambda v: F.struct((v["sign"] == "|").alias("bar"), v["score"].alias("score")))
    return _fold(items, operator, sums)


def _clauses_match(operator: str) -> Column:
    required = F.exists("found", lambda v: v["sign"] == "+")
    failed = F.exists(
        "found",
        lambda v: ((v["sign"] == "+") & v["score"].isNull()) | ((v["sign"] == "-") & v["score"].isNotNull()),
    )
    optional = required if operator == "or" else required & ~F.col("rest.seen")
    return ~failed & (F.col("rest.score").isNotNull() | optional)


def _clauses_score(sums: _Adding) -> Column:
    signed = F.filter("found", lambda v: v["sign"] == "+")
    return F.aggregate(signed, F.coalesce("rest.score", F.expr(sums.nothing)), lambda acc, v: sums.add(acc, v["score"]))
