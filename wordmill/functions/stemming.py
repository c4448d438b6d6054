"""Stemmers as Spark expressions.

Porter's algorithm is a list of small steps, each an expression over the word left
by the step before. The caller binds them one after the other with `transform`, so
that the whole stays linear in size; one nested expression would repeat its input
many times over.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Porter (1980). A word is [C](VC)^m[V]; a leading y is upper-cased
# beforehand, so that it counts as a consonant.
CONSONANTS = "[^aeiou][^aeiouy]*"
VOWELS = "[aeiouy][aeiou]*"
MEASURE_OVER_0 = f"^({CONSONANTS})?{VOWELS}{CONSONANTS}"
MEASURE_IS_1 = f"^({CONSONANTS})?{VOWELS}{CONSONANTS}({VOWELS})?$"
MEASURE_OVER_1 = f"^({CONSONANTS})?{VOWELS}{CONSONANTS}{VOWELS}{CONSONANTS}"
HAS_VOWEL = f"^({CONSONANTS})?[aeiouy]"
SHORT_SYLLABLE = f"^{CONSONANTS}[aeiouy][^aeiouwxy]$"
DOUBLE_CONSONANT = "(bb|cc|dd|ff|gg|hh|jj|kk|mm|nn|pp|qq|rr|tt|vv|ww|xx)$"
STEP_2 = {
    "ational": "ate",
    "tional": "tion",
    "enci": "ence",
    "anci": "ance",
    "izer": "ize",
    "abli": "able",
    "alli": "al",
    "entli": "ent",
    "eli": "e",
    "ousli": "ous",
    "ization": "ize",
    "ation": "ate",
    "ator": "ate",
    "alism": "al",
    "iveness": "ive",
    "fulness": "ful",
    "ousness": "ous",
    "aliti": "al",
    "iviti": "ive",
    "biliti": "ble",
}
STEP_3 = {
    "icate": "ic",
    "ative": "",
    "alize": "al",
    "iciti": "ic",
    "ical": "ic",
    "ful": "",
    "ness": "",
}
STEP_4 = [
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment",
    "ent", "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize",
]


def _drop(word: Column, n) -> Column:
    return F.substring(word, F.lit(1), F.length(word) - n)


def _on_suffix(suffixes, change: Callable[[Column, Column, Column], Column]) -> Callable[[Column], Column]:
    """A step that calls `change(word, stem, end)` on words with a listed suffix.

    The search runs from the left, so the longest suffix is the one found. Most words
    are turned away by their last two letters and never reach a regular expression.
    """
    pattern = "(" + "|".join(suffixes) + ")$"
    tails = sorted({suffix[-2:] for suffix in suffixes})

    def step(w: Column) -> Column:
        end = F.regexp_extract(w, pattern, 1)
        listed = F.right(w, F.lit(2)).isin(tails) & w.rlike(pattern)
        return F.when(listed, change(w, _drop(w, F.length(end)), end)).otherwise(w)

    return step


def _swap(endings: dict[str, str]) -> Callable[[Column], Column]:
    """A step that replaces a listed suffix where the stem has measure over 0."""
    table = F.create_map(*[F.lit(x) for pair in endings.items() for x in pair])

    def change(w, stem, end):
        swapped = F.concat(stem, F.try_element_at(table, end))
        return F.when(stem.rlike(MEASURE_OVER_0), swapped).otherwise(w)

    return _on_suffix(endings, change)


def _plural(w: Column) -> Column:
    singular = F.regexp_replace(w, "(?:(ss|i)es|([^s])s)$", "$1$2")
    return F.when(w.endswith("s"), singular).otherwise(w)


def mark_y(w: Column) -> Column:
    """A leading y is a consonant: write it as Y."""
    return F.when(w.startswith("y"), F.overlay(w, F.lit("Y"), 1, 1)).otherwise(w)


def restore_y(stem: Column, word: Column) -> Column:
    return F.when(word.startswith("y"), F.overlay(stem, F.lit("y"), 1, 1)).otherwise(stem)


def _past_tense(w: Column, stem: Column, end: Column) -> Column:
    # a cut word is marked by a final blank for the next step
    return (
        F.when((end != "eed") & stem.rlike(HAS_VOWEL), F.concat(stem, F.lit(" ")))
        .when((end == "eed") & stem.rlike(MEASURE_OVER_0), F.concat(stem, F.lit("ee")))
        .otherwise(w)
    )


def _repair(marked: Column) -> Column:
    w = F.rtrim(marked)
    return (
        F.when(~marked.endswith(" "), marked)
        .when(w.rlike("(at|bl|iz)$"), F.concat(w, F.lit("e")))
        .when(w.rlike(DOUBLE_CONSONANT), _drop(w, 1))
        .when(w.rlike(MEASURE_IS_1) & w.rlike(SHORT_SYLLABLE), F.concat(w, F.lit("e")))
        .otherwise(w)
    )


def _final_y(w: Column) -> Column:
    fits = w.endswith("y") & _drop(w, 1).rlike(HAS_VOWEL)
    return F.when(fits, F.concat(_drop(w, 1), F.lit("i"))).otherwise(w)


def _long_stem(w: Column, stem: Column, end: Column) -> Column:
    fits = stem.rlike(MEASURE_OVER_1) & ((end != "ion") | stem.rlike("[st]$"))
    return F.when(fits, stem).otherwise(w)


def _final_e(w: Column) -> Column:
    stem = _drop(w, 1)
    fits = stem.rlike(MEASURE_OVER_1) | (stem.rlike(MEASURE_IS_1) & ~stem.rlike(SHORT_SYLLABLE))
    return F.when(w.endswith("e") & fits, stem).otherwise(w)


def _final_ll(w: Column) -> Column:
    return F.when(w.endswith("ll") & w.rlike(MEASURE_OVER_1), _drop(w, 1)).otherwise(w)


def porter_steps() -> list[Callable[[Column], Column]]:
    """Porter's steps in order, for words of over two letters."""
    return [
        _plural,
        _on_suffix(["eed", "ed", "ing"], _past_tense),
        _repair,
        _final_y,
        _swap(STEP_2),
        _swap(STEP_3),
        _on_suffix(STEP_4, _long_stem),
        _final_e,
        _final_ll,
    ]


def s_stem(token: Column) -> Column:
    """Plural stripping after Harman (1991): the first rule that applies decides."""
    return (
        F.when(F.length(token) < 3, token)
        .when(token.endswith("ies") & ~token.rlike("[ae]ies$"), F.concat(_drop(token, 3), F.lit("y")))
        .when(token.endswith("es") & ~token.rlike("[aeo]es$"), _drop(token, 1))
        .when(token.endswith("s") & ~token.rlike("[us]s$"), _drop(token, 1))
        .otherwise(token)
    )
