import pytest
from pyspark.sql import functions as F

from wordmill import (
    AsciiFolding,
    Chain,
    KeywordMarker,
    LightEnglish,
    Lowercase,
    PorterStem,
    StemmerOverride,
    Stop,
    analyze,
    analyze_stages,
    analyzer,
)
from wordmill.functions.folding import lower_ascii
from wordmill.functions.text import catch_all, display_date, first_line, hit_path, truncate

# The sample sentence and its tokens, after FIXTURES.md F2.
SENTENCE = "Ye Olde YeLLoWing café beLLows MiCe were sleeping FURIOUSly."
SAMPLE = Chain(
    (
        Lowercase(),
        AsciiFolding(),
        KeywordMarker(("sleeping",)),
        StemmerOverride.of(["mice=>mouse", "were=>was"]),
        Stop(("a", "is", "the", "was")),
        PorterStem(),
    )
)


def tokens(spark, text, chain):
    df = spark.createDataFrame([(text,)], "text string")
    return [(r["position"], r["token"]) for r in analyze(df, "text", chain).orderBy("position").collect()]


def test_sample_sentence(spark):
    assert tokens(spark, SENTENCE, SAMPLE) == [
        (0, "ye"),
        (1, "old"),
        (2, "yellow"),
        (3, "cafe"),
        (4, "bellow"),
        (5, "mouse"),
        (7, "sleeping"),
        (8, "furious"),
    ]


def test_stages(spark):
    df = spark.createDataFrame([(1, SENTENCE)], "id int, text string")
    rows = analyze_stages(df, "text", SAMPLE, ["id"]).collect()
    seen = {}
    for r in rows:
        seen.setdefault((r["stage_no"], r["stage"]), {})[r["position"]] = r["token"]
    assert [name for _, name in sorted(seen)] == [
        "standard",
        "lowercase",
        "asciifolding",
        "keyword_marker",
        "stemmer_override",
        "stop",
        "porter_stem",
    ]
    assert seen[0, "standard"][8] == "FURIOUSly"
    assert seen[4, "stemmer_override"][6] == "was"
    assert 6 not in seen[5, "stop"]
    last = {p: t for p, t in tokens(spark, SENTENCE, SAMPLE)}
    assert seen[6, "porter_stem"] == last


def test_standard_tokenizer(spark):
    found = [t for _, t in tokens(spark, "O'Neil paid 3.14, snake_case 1,000 (über) - e.g. x;y", "standard")]
    assert found == ["o'neil", "paid", "3.14", "snake_case", "1,000", "über", "e.g", "x", "y"]
    assert tokens(spark, "... --- !", "standard") == []
    assert tokens(spark, None, "standard") == []


# Stems by the published algorithm.
PORTER = {
    "caresses": "caress", "ponies": "poni", "ties": "ti", "caress": "caress", "cats": "cat",
    "feed": "feed", "agreed": "agre", "plastered": "plaster", "bled": "bled", "motoring": "motor",
    "sing": "sing", "conflated": "conflat", "troubled": "troubl", "sized": "size", "hopping": "hop",
    "tanned": "tan", "falling": "fall", "hissing": "hiss", "fizzed": "fizz", "failing": "fail",
    "filing": "file", "happy": "happi", "sky": "sky", "relational": "relat", "conditional": "condit",
    "rational": "ration", "valenci": "valenc", "digitizer": "digit", "conformabli": "conform",
    "radicalli": "radic", "differentli": "differ", "vileli": "vile", "analogousli": "analog",
    "vietnamization": "vietnam", "predication": "predic", "operator": "oper", "feudalism": "feudal",
    "decisiveness": "decis", "hopefulness": "hope", "callousness": "callous", "formaliti": "formal",
    "sensitiviti": "sensit", "sensibiliti": "sensibl", "triplicate": "triplic", "formative": "form",
    "formalize": "formal", "electriciti": "electr", "electrical": "electr", "hopeful": "hope",
    "goodness": "good", "revival": "reviv", "allowance": "allow", "inference": "infer",
    "airliner": "airlin", "gyroscopic": "gyroscop", "adjustable": "adjust", "defensible": "defens",
    "irritant": "irrit", "replacement": "replac", "adjustment": "adjust", "dependent": "depend",
    "adoption": "adopt", "communism": "commun", "activate": "activ", "angulariti": "angular",
    "effective": "effect", "bowdlerize": "bowdler", "probate": "probat", "rate": "rate",
    "cease": "ceas", "controll": "control", "roll": "roll", "by": "by", "yes": "ye", "toy": "toi",
}


def test_porter(spark):
    df = spark.createDataFrame([(word,) for word in PORTER], "word string")
    rows = analyze(df, "word", Chain((PorterStem(),)), ["word"]).collect()
    assert {r["word"]: r["token"] for r in rows} == PORTER


def test_filters_after_the_stemmer(spark):
    chain = Chain((Lowercase(), PorterStem(), Stop(("cat",))))
    df = spark.createDataFrame([("Cats running",)], "text string")
    # a predicate on the result must not be repeated inside the stemmer's steps
    found = analyze(df, "text", chain).where("token = 'run'")
    assert [(r["position"], r["token"]) for r in found.collect()] == [(1, "run")]


def test_presets(spark):
    assert tokens(spark, "The fisherman's fishing boats", "english") == [(1, "fisherman"), (2, "fish"), (3, "boat")]
    assert tokens(spark, "Two Cities, glasses, Gas BELLS", "case_sensitive_text") == [
        (0, "Two"),
        (1, "City"),
        (2, "glasse"),
        (3, "Ga"),
        (4, "BELLS"),
    ]
    with pytest.raises(ValueError):
        analyzer("nosuch")


def test_light_overrides(spark):
    chain = Chain((Lowercase(), LightEnglish((("mice", "mouse"), ("gas", "gas")))))
    assert [t for _, t in tokens(spark, "mice gas cats bus dress movies", chain)] == [
        "mouse",
        "gas",
        "cat",
        "bus",
        "dress",
        "movy",
    ]


def test_chain_description_round_trip():
    chain = Chain((*SAMPLE.filters, LightEnglish((("mice", "mouse"),))))
    assert Chain.from_description(chain.describe()) == chain


def test_reserved_column_names(spark):
    with pytest.raises(ValueError):
        analyze(spark.createDataFrame([("a", "b")], "token string, text string"), "text", "standard", ["token"])


def test_folding_and_formatting(spark):
    df = spark.createDataFrame(
        [("Straße ÆON Øre naïve Ångström", "first\nsecond", "x" * 81, "2017-03-02T10:00:00", None)],
        "a string, b string, c string, d string, e string",
    )
    row = df.select(
        lower_ascii(F.col("a")).alias("a"),
        first_line(F.col("b")).alias("b"),
        truncate(F.col("c")).alias("c"),
        truncate(F.col("b")).alias("flat"),
        display_date(F.col("e"), F.col("d")).alias("d"),
        display_date(F.col("e"), F.col("b")).alias("none"),
        hit_path("git", "doc", F.lit(7)).alias("path"),
    ).first()
    assert row["a"] == "strasse aeon ore naive angstrom"
    assert (row["b"], row["flat"]) == ("first", "first second")
    assert row["c"] == "x" * 80 + "..."
    assert (row["d"], row["none"], row["path"]) == ("2017-03-02", None, "/git/doc/7")


def test_catch_all_flattens(spark):
    df = spark.sql("SELECT 1 AS id, array('a b', 'c') AS x, named_struct('n', 'd', 'm', 2) AS s, 3.5D AS f")
    assert df.select(F.expr(catch_all(df.schema, ("id",)))).first()[0] == "a b c d 2 3.5"
