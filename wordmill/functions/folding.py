"""ASCII folding as Spark expressions."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Letters that have no canonical decomposition.
MULTI_LETTER = {
    "ß": "ss",
    "ẞ": "SS",
    "æ": "ae",
    "Æ": "AE",
    "œ": "oe",
    "Œ": "OE",
    "þ": "th",
    "Þ": "TH",
    "ĳ": "ij",
    "Ĳ": "IJ",
}
SINGLE_LETTER = {
    "ø": "o",
    "Ø": "O",
    "đ": "d",
    "Đ": "D",
    "ð": "d",
    "Ð": "D",
    "ħ": "h",
    "Ħ": "H",
    "ı": "i",
    "ł": "l",
    "Ł": "L",
    "ŧ": "t",
    "Ŧ": "T",
}


@lru_cache(maxsize=1)
def single_letter_table() -> tuple[str, str]:
    """The two `translate` strings: accented Latin letters and their base letters.

    Derived by rule: every letter of the Latin blocks whose canonical
    decomposition is one ASCII letter followed only by combining marks.
    """
    table = dict(SINGLE_LETTER)
    for block in (range(0x00C0, 0x0250), range(0x1E00, 0x1F00)):
        for code in block:
            letter = chr(code)
            base, *marks = unicodedata.normalize("NFD", letter)
            if marks and base.isascii() and all(unicodedata.combining(m) for m in marks):
                table[letter] = base
    return "".join(table), "".join(table.values())


def ascii_fold(text: Column) -> Column:
    """Replace accented and special Latin letters by ASCII ones."""
    letters, bases = single_letter_table()
    folded = F.translate(text, letters, bases)
    for letter, spelled in MULTI_LETTER.items():
        folded = F.replace(folded, F.lit(letter), F.lit(spelled))
    # most tokens are plain ASCII already and skip the replacements
    return F.when(F.octet_length(text) == F.char_length(text), text).otherwise(folded)


def lower_ascii(text: Column) -> Column:
    """Normalizer for whole values: lower case and ASCII folding, no tokenizing."""
    return ascii_fold(F.lower(text))
