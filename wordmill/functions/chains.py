"""Analysis chains: a tokenizer followed by ordered token filters.

A chain turns a text column into token rows `(keep…, position, token)`. Each filter
is a projection over those rows, so the whole chain runs inside one generated JVM
stage, without a shuffle and without Python. A removed token becomes null and is
dropped at the end, so the positions of the others keep their gap.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict, dataclass, fields

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordmill.functions.folding import ascii_fold
from wordmill.functions.stemming import mark_y, porter_steps, restore_y, s_stem

# Word characters, and the joiners that UAX #29 keeps inside a word
# (O'Neil, 3.14, snake_case).
WORD = r"[\p{L}\p{M}\p{N}_]+"
TOKEN = (
    WORD
    + r"(?:['’.:·]\p{L}[\p{L}\p{M}\p{N}_]*"
    + r"|[.,;'’]\p{N}[\p{L}\p{M}\p{N}_]*)*"
)
GAP = r"[^\p{L}\p{M}\p{N}_]+"

# The columns of token rows, beside those of the caller.
TOKEN_COLUMNS = ("position", "token", "protected")

# The customary English stop words.
ENGLISH_STOP = (
    "a", "an", "and", "are", "as", "at", "be", "but", "by", "for", "if", "in",
    "into", "is", "it", "no", "not", "of", "on", "or", "such", "that", "the",
    "their", "then", "there", "these", "they", "this", "to", "was", "will", "with",
)


@dataclass(frozen=True)
class Filter:
    """One token filter: a step over rows with `token` and `protected`."""

    def step(self, df: DataFrame) -> DataFrame:
        raise NotImplementedError


@dataclass(frozen=True)
class Lowercase(Filter):
    def step(self, df):
        return df.withColumn("token", F.lower("token"))


@dataclass(frozen=True)
class AsciiFolding(Filter):
    def step(self, df):
        return df.withColumn("token", ascii_fold(F.col("token")))


@dataclass(frozen=True)
class Possessive(Filter):
    """Strip a final 's."""

    def step(self, df):
        return df.withColumn("token", F.regexp_replace("token", "['’][sS]$", ""))


@dataclass(frozen=True)
class KeywordMarker(Filter):
    """Protect the listed words from later stemming."""

    words: tuple[str, ...]

    def step(self, df):
        listed = F.col("token").isin(list(self.words))
        return df.withColumn("protected", F.col("protected") | listed)


@dataclass(frozen=True)
class StemmerOverride(Filter):
    """Replace whole words by fixed stems, which are then protected."""

    rules: tuple[tuple[str, str], ...]

    @classmethod
    def of(cls, rules: Sequence[str]) -> StemmerOverride:
        """From `word=>stem` strings."""
        return cls(tuple(tuple(part.strip() for part in rule.split("=>")) for rule in rules))

    def step(self, df):
        table = F.create_map(*[F.lit(x) for rule in self.rules for x in rule])
        token, protected, fixed = F.col("token"), F.col("protected"), F.col("_fixed")
        df = df.withColumn("_fixed", F.when(~protected, F.try_element_at(table, token)))
        df = df.withColumn("token", F.coalesce(fixed, token))
        return df.withColumn("protected", protected | fixed.isNotNull()).drop("_fixed")


@dataclass(frozen=True)
class Stop(Filter):
    """Remove the listed words; the following positions do not move up."""

    words: tuple[str, ...] = ENGLISH_STOP

    def step(self, df):
        token = F.col("token")
        return df.withColumn("token", F.when(~token.isin(list(self.words)), token))


@dataclass(frozen=True)
class PorterStem(Filter):
    def step(self, df):
        # One projection per step, because a single expression would double at each. Spark
        # compiles a projection as a method of its own, small enough for the JIT compiler,
        # if it uses every input twice: so the token travels as one struct, which also
        # repeats the caller's columns. These stay columns too, to keep their partitioning.
        token, state = F.col("token"), F.col("_state")
        kept = [c for c in df.columns if c not in TOKEN_COLUMNS and not c.startswith("_stage_")]
        row = F.struct(*[c for c in df.columns if c not in kept])
        stems = ~F.col("protected") & (F.length(token) > 2)

        def packed(row, work):
            return F.struct(row.alias("row"), work.alias("work"), *kept).alias("_state")

        rows = df.select(*kept, packed(row, F.when(stems, mark_y(token))))
        for one in porter_steps():
            rows = rows.select(*kept, packed(state["row"], one(state["work"])))
        rows = rows.select(*kept, "_state.row.*", state["work"].alias("_work"))
        stem = F.coalesce(restore_y(F.col("_work"), token), token)
        return rows.select(*[stem.alias(c) if c == "token" else c for c in df.columns])


@dataclass(frozen=True)
class LightEnglish(Filter):
    """Light English stemming: plural stripping, after an optional override list.

    A dictionary stemmer would need a lexicon; irregular words go in `overrides`.
    """

    overrides: tuple[tuple[str, str], ...] = ()

    def step(self, df):
        if self.overrides:
            df = StemmerOverride(self.overrides).step(df)
        token = F.col("token")
        return df.withColumn("token", F.when(F.col("protected"), token).otherwise(s_stem(token)))


FILTERS = {
    "lowercase": Lowercase,
    "asciifolding": AsciiFolding,
    "possessive": Possessive,
    "keyword_marker": KeywordMarker,
    "stemmer_override": StemmerOverride,
    "stop": Stop,
    "porter_stem": PorterStem,
    "light_english": LightEnglish,
}
FILTER_NAMES = {kind: name for name, kind in FILTERS.items()}


#: Positions between the last token of an array's element and the first of the next one.
ELEMENT_GAP = 100


@dataclass(frozen=True)
class Chain:
    """The standard tokenizer and the filters that follow it, in order."""

    filters: tuple[Filter, ...] = ()

    def split(self, df: DataFrame, text: Column, keep: Sequence[str]) -> DataFrame:
        """The standard tokenizer: rows of `keep`, `position`, `token`, `protected`."""
        taken = set(TOKEN_COLUMNS) & set(keep)
        if taken:
            raise ValueError(f"rename the columns {sorted(taken)}: token rows use these names")
        if isinstance(df.select(text.alias("v")).schema["v"].dataType, T.ArrayType):
            # the elements one after the other, with a gap that no phrase bridges
            gap = F.array_repeat(F.lit(None).cast("string"), ELEMENT_GAP)
            found = F.flatten(
                F.transform(
                    F.filter(text, lambda e: e.isNotNull()),
                    lambda e: F.concat(F.regexp_extract_all(e, F.lit(TOKEN), F.lit(0)), gap),
                )
            )
        else:
            found = F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))
        rows = df.select(*keep, F.posexplode(found).alias("position", "token")).where("token IS NOT NULL")
        return rows.withColumn("protected", F.lit(False))

    def split_parts(self, df: DataFrame, before: Column, text: Column, after: Column, keep: Sequence[str]) -> DataFrame:
        """The standard tokenizer over three texts, as if a blank stood between them, which no token crosses.

        Rows as of `split`, with `_low` and `_high`: the places of the second text are from the one to before the other.
        """
        none = F.array().cast("array<string>")
        lists = [F.coalesce(F.regexp_extract_all(part, F.lit(TOKEN), F.lit(0)), none) for part in (before, text, after)]
        found = df.select(*keep, *[c.alias(f"_found{n}") for n, c in enumerate(lists)])
        low, own = F.size("_found0"), F.size("_found1")
        found = found.select(
            *keep, low.alias("_low"), (low + own).alias("_high"), F.concat("_found0", "_found1", "_found2").alias("_found")
        )
        rows = found.select(*keep, "_low", "_high", F.posexplode("_found").alias("position", "token"))
        return rows.withColumn("protected", F.lit(False))

    def filter_tokens(self, rows: DataFrame) -> DataFrame:
        """Run the filters over token rows; removed tokens are left as null."""
        for one in self.filters:
            rows = one.step(rows)
        return rows

    def tokens(self, df: DataFrame, text: Column, keep: Sequence[str]) -> DataFrame:
        """Analyze a text column into rows of `keep`, `position`, `token`."""
        return self.kept_tokens(self.split(df, text, keep), keep)

    def kept_tokens(self, rows: DataFrame, keep: Sequence[str]) -> DataFrame:
        """Run the filters over token rows, without those that are removed."""
        rows = self.filter_tokens(rows)
        # A predicate on the token, once pushed below the filters, would repeat their
        # expressions over and over. The one-element explode keeps it above them.
        rows = rows.select(*keep, "position", F.explode(F.array("token")).alias("token"))
        return rows.where(F.col("token").isNotNull())

    def describe(self) -> list[dict]:
        """The chain as plain data, for the index properties."""
        return [{"filter": FILTER_NAMES[type(f)], **asdict(f)} for f in self.filters]

    @classmethod
    def from_description(cls, steps: list[dict]) -> Chain:
        return cls(tuple(_filter_of(step) for step in steps))


def _filter_of(step: dict) -> Filter:
    kind = FILTERS[step["filter"]]
    given = {f.name: step[f.name] for f in fields(kind) if f.name in step}
    return kind(**{name: _tuples(value) for name, value in given.items()})


def _tuples(value):
    return tuple(_tuples(v) for v in value) if isinstance(value, list) else value


ANALYZERS = {
    "standard": Chain((Lowercase(),)),
    "english": Chain((Lowercase(), Possessive(), Stop(), PorterStem())),
    "case_sensitive_text": Chain((LightEnglish(),)),
}


def analyzer(name: str | Chain) -> Chain:
    """A chain by preset name, or the chain itself."""
    if isinstance(name, Chain):
        return name
    if name not in ANALYZERS:
        raise ValueError(f"unknown analyzer {name!r}; known: {sorted(ANALYZERS)}")
    return ANALYZERS[name]


def _column(text: str | Column) -> Column:
    return F.col(text) if isinstance(text, str) else text


def analyze(df: DataFrame, text: str | Column, chain: str | Chain, keep: Sequence[str] = ()) -> DataFrame:
    """Token rows of a text column: `keep`, `position`, `token`."""
    return analyzer(chain).tokens(df, _column(text), keep)


def analyze_stages(
    df: DataFrame, text: str | Column, chain: str | Chain, keep: Sequence[str] = ()
) -> DataFrame:
    """The token stream after every stage: `keep`, `stage_no`, `stage`, `position`, `token`."""
    chain = analyzer(chain)
    rows = chain.split(df, _column(text), keep).withColumn("_stage_0", F.col("token"))
    names = ["standard"]
    for one in chain.filters:
        rows = one.step(rows).withColumn(f"_stage_{len(names)}", F.col("token"))
        names.append(FILTER_NAMES[type(one)])
    stages = [
        F.struct(
            F.lit(n).alias("stage_no"),
            F.lit(name).alias("stage"),
            F.col(f"_stage_{n}").alias("token"),
        )
        for n, name in enumerate(names)
    ]
    rows = rows.select(*keep, "position", F.inline(F.array(*stages)))
    return rows.where(F.col("token").isNotNull()).select(
        *keep, "stage_no", "stage", "position", "token"
    )
