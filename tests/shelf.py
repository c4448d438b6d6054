"""A small shelf of made-up books, and plain scoring of its fields."""

import math
import re

ROWS = [
    (1, "A Field Book of Mosses", ["ada brook"], "quiet walks through wet woods, with a key to common mosses",
     "2009-05-01", 14, "fernhill"),
    (2, "Knots: Hitches, Bends and Splices", ["tom vane", "lucy marsh"],
     "rope work for small boats and for rigging in rough weather", "2013-10-20", 9, "harbour"),
    (3, "Boats in Winter", ["ole strand"],
     "repair and paint a wooden hull on shore; a guide to tools, timber and tar for boats", "2016-02-11", 31, "harbour"),
    (4, "Gardens in Winter", ["may dunn", "roy pike"], "guide to pruning, paint and a quiet season of repair",
     "2014-11-05", 22, "harbour"),
    (5, "Small Guide to Tides", ["ines cole"], "tables of moon and wind; shore and small boats", "2018-06-30", 5, "fernhill"),
]
SCHEMA = (
    "_id bigint, title string, authors array<string>, summary string, "
    "publish_date string, num_reviews bigint, publisher string"
)
_FIELDS = {"title": 1, "summary": 3}


def words(text):
    return re.findall(r"\w+", text.lower())


def field_words(name):
    """Words of a field by key; `_all` holds the words of every column but the key."""
    if name != "_all":
        return {row[0]: words(row[_FIELDS[name]]) for row in ROWS}
    return {row[0]: words(" ".join(" ".join(c) if isinstance(c, list) else str(c) for c in row[1:])) for row in ROWS}


def bm25(tf, df, n, dl, avgdl):
    return math.log(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / avgdl))


def match(name, text, boost=1.0):
    """Scores by key of a match on one field."""
    held = field_words(name)
    n, avgdl = len(held), sum(map(len, held.values())) / len(held)
    out = {}
    for word in words(text):
        df = sum(word in said for said in held.values())
        for key, said in held.items():
            if word in said:
                out[key] = out.get(key, 0.0) + boost * bm25(said.count(word), df, n, len(said), avgdl)
    return out


def ranked(found, digits=4):
    """(key, rounded score) by score, then key."""
    return sorted(((k, round(s, digits)) for k, s in found.items()), key=lambda x: (-x[1], x[0]))


def best(*parts):
    return {k: max(p.get(k, 0.0) for p in parts) for k in set().union(*parts)}


def most(*parts):
    return {k: sum(p.get(k, 0.0) for p in parts) for k in set().union(*parts)}


def scores(result, key="_id", digits=4):
    """Hits in order as (key, rounded score)."""
    return [(r[key], round(r["score"], digits)) for r in result.hits.collect()]


def as_dict(df, key="_id"):
    return {r[key]: r["score"] for r in df.collect()}
