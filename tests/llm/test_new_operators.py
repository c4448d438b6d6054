"""Piece tables, token counts and collocations, against plain code."""

import hashlib
import random
import re
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece

from wordmill.llm import collocations, counts, middle
from wordmill.llm.queries import PIECES

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_middle(key, text, marks=("<P>", "<M>", "<S>"), rate=50, spm_rate=80, seed=42):
    """n, form, prefix_chars, middle_chars and output of one document."""
    text = text or ""
    units = UNIT.findall(text)
    n = len(units)
    digest = sha(f"{seed}:{'' if key is None else key}")
    h = [int(digest[k : k + 8], 16) for k in (0, 8, 16, 24)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in marks) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    p, m, s = marks
    if h[3] % 100 < spm_rate:
        return n, "spm", len(pre), len(mid), s + suf + p + pre + m + mid
    return n, "psm", len(pre), len(mid), p + pre + s + suf + m + mid


def middle_texts():
    rng = random.Random(3)
    signs = ["a", "été", "漢字", " ", "  ", "\n", "\t\v", "<P", "P>", "<", ">", "<S", "M>", "\x00", "\xa0", "😀"]
    texts = ["".join(rng.choices(signs, k=rng.randrange(12))) for _ in range(400)]
    return [*texts, None, "", " ", "<P>", "a <S> b", "x<M>", "end ", "wörd " * 50_000, "y" * 300_000]


def test_middle_equals_plain_code(spark):
    rows = [(k, text, "x") for k, text in enumerate(middle_texts())]
    rows += [(None, "a null id", "x"), (5, "the same id", None), (5, "the same id", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, output string").selectExpr("*", "output AS form", "1 AS n")
    want = sorted(((r[0], *plain_middle(r[0], r[1])) for r in rows), key=repr)
    made = middle.transform(docs)
    assert sorted((tuple(r) for r in made.collect()), key=repr) == want
    assert {"plain", "psm", "spm"} == {w[2] for w in want}
    back = sorted((tuple(r) for r in middle.restore(made).collect()), key=repr)
    assert back == sorted(((r[0], r[1] or "") for r in rows), key=repr)
    told = sorted((tuple(r) for r in middle.digests(docs).collect()), key=repr)
    texts = sorted((repr((r[0], sha(r[1] or ""))) for r in rows))
    assert told == sorted(((*w[:5], sha(w[5]), r) for w, r in zip(want, [t[-1] for t in told], strict=True)), key=repr)
    assert sorted(repr((t[0], t[-1])) for t in told) == texts


def test_middle_recipes(spark):
    docs = spark.createDataFrame([(k, f"one two {k} three") for k in range(60)], "key string, body string")
    recipe = middle.Recipe(seed=7, rate=100, spm_rate=0, prefix="[pre]", middle="[mid]", suffix="[suf]")
    made = middle.transform(docs, recipe, "key", "body")
    want = {str(k): plain_middle(k, f"one two {k} three", ("[pre]", "[mid]", "[suf]"), 100, 0, 7) for k in range(60)}
    assert {r["key"]: tuple(r)[1:] for r in made.collect()} == want
    assert {r["form"] for r in made.collect()} == {"psm"}
    assert {r["key"]: r["text"] for r in middle.restore(made, recipe, "key").collect()} == {str(k): f"one two {k} three" for k in range(60)}
    for marks in (("", "b", "c"), ("<a>", "<a>", "c"), ("ab", "ba", "c"), ("aa", "b", "c"), ("abc", "b", "d")):
        with pytest.raises(ValueError):
            middle.Recipe(prefix=marks[0], middle=marks[1], suffix=marks[2])


def test_middle_of_nothing(spark, no_docs):
    assert middle.digests(no_docs).collect() == [] and middle.transform(no_docs).collect() == []
    assert middle.restore(middle.transform(no_docs)).collect() == []


def test_restoring_refuses_broken_outputs(spark):
    broken = spark.createDataFrame([(1, "psm", "<P>a<M>b")], "doc_id long, form string, output string")
    with pytest.raises(Exception, match="lacks a sentinel"):
        middle.restore(broken).collect()


# ---- token counts ----------------------------------------------------------------------


def count_texts():
    rng = random.Random(11)
    signs = ["a", "the", "ing", " ", "  ", "\n", "\t", "é", "漢", "😀", "▁", "Александар", "ﬁ", "\xa0", "\x00", "0x", "<s>", "</s>"]
    signs += ["<unk>", "<0x0A>", "1234", "ſ", "é", "​", "།", ".", ",", "\r\n"]
    texts = ["".join(rng.choices(signs, k=rng.randrange(20))) for _ in range(1500)]
    return [*texts, "", " ", "   ", "a" * 5000, "ab" * 3001 + "c", "▁" * 70, "😀" * 90, "x" * 300_000, "word " * 20_000]


def test_counts_equal_the_library():
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    tool = counts.Merger(PIECES)
    for text in count_texts():
        assert tool.count(text) == len(model.encode(text)), text[:80]


def test_counts_do_not_depend_on_the_cuts(monkeypatch):
    cut, whole = counts.Merger(PIECES), counts.Merger(PIECES)
    whole._cut_blanks = False
    monkeypatch.setattr(counts, "TABLE_CHARS", 3)
    small = counts.Merger(PIECES)
    small._units._limit = small._blank_units._limit = 2
    for text in count_texts()[:600]:
        assert cut.count(text) == whole.count(text) == small.count(text)
    assert len(small._units) <= 2 and len(small._blank_units) <= 2


def test_counts_of_odd_rows(spark, odd_docs, no_docs):
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    found = counts.count(odd_docs, PIECES, limit=100)
    assert found.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    want = []
    for r in odd_docs.collect():
        text = r["text"] or ""
        n = len(model.encode(text))
        want.append((r["doc_id"], len(text.encode()), n, n > 100))
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(want, key=repr)
    assert counts.count(no_docs, PIECES).collect() == []


# ---- collocations ----------------------------------------------------------------------


def plain_phrases(rows, least=10, size=2000):
    """The result of `mine` for rows of (lang, text), by plain counting."""
    found = {}
    for lang, text in rows:
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            said = re.findall(r"[^\x20\x09]+", piece)
            for n in (1, 2, 3):
                grams = found.setdefault("und" if lang is None else lang, Counter())
                grams.update(tuple(said[i : i + n]) for i in range(len(said) - n + 1))
    out = []
    for lang, f in found.items():
        total = sum(c for g, c in f.items() if len(g) == 1)
        longest = Counter()
        for g, c in f.items():
            if len(g) == 3 and c >= least:
                for part in (g[:2], g[1:]):
                    longest[part] = max(longest[part], c)
        rows_of = []
        for g, a in f.items():
            if len(g) < 2 or a < least or (longest[g] and 100 * longest[g] >= 50 * a):
                continue
            cuts = [(1000000 * a * a // (f[g[:k]] * f[g[k:]]), k, f[g[:k]], f[g[k:]]) for k in range(1, len(g))]
            score, _, left, right = min(cuts)
            rows_of.append((-score, -a, " ".join(g).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows_of)[:size], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total, -score))
    return sorted(out)


def phrase_rows(rng, n):
    words = ["the", "of", "New", "York", "city", "café", "x\x01", "x", "漢字", "a'b", "y!z"]
    weights = [9, 7, 4, 4, 3, 2, 2, 2, 1, 1, 1]
    rows = []
    for k in range(n):
        said = rng.choices(words, weights, k=rng.randrange(30))
        text = "".join(w + rng.choice([" ", " ", " ", "\t", "  ", ". ", "\n", ";"]) for w in said)
        rows.append((["en", None, "und", "de", ""][k % 5], text))
    return rows


@pytest.mark.parametrize("small", [False, True])
def test_collocations_equal_plain_code(spark, monkeypatch, small):
    rng = random.Random(23)
    rows = phrase_rows(rng, 300) + [("en", None), ("en", ""), (None, " \t "), ("fr", ",,,"), ("en", "long words " * 4000)]
    if small:
        monkeypatch.setattr(collocations, "COUNT_BYTES", 300)
        monkeypatch.setattr(collocations, "FILTER_BITS", 64)
        monkeypatch.setattr(collocations, "PIECE_ROWS", 3)
        monkeypatch.setattr(collocations, "BATCH_ROWS", 7)
    docs = spark.createDataFrame([(k, *r, 1, "z") for k, r in enumerate(rows)], "doc_id long, lang string, text string, f int, w1 string")
    found = collocations.mine(docs, least=4, size=40)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, found.collect())) == plain_phrases(rows, 4, 40)
    assert len(plain_phrases(rows, 4, 40)) > 80


def test_one_word_before_everything(spark, monkeypatch):
    """A third of all phrases begin or end with one word; the pieces of the streams stay even."""
    monkeypatch.setattr(collocations, "PIECE_ROWS", 50)
    rows = [("en", f"hub w{k % 300} hub") for k in range(1500)] + [("en", f"w{k % 300} hub v{k % 7}") for k in range(900)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    assert sorted(map(tuple, collocations.mine(docs, least=3).collect())) == plain_phrases(rows, 3)


def test_products_beyond_64_bits(spark):
    a = 4_000_000_000_000
    row = spark.createDataFrame([(a, a + 1, a)], "f long, l long, r long").select(collocations._score("l", "r"))
    assert row.first()[0] == 1_000_000 * a * a // ((a + 1) * a)


def test_collocations_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, lang string, text string")
    assert collocations.mine(docs).collect() == []
    few = spark.createDataFrame([("en", "one two three")], "lang string, text string")
    assert collocations.mine(few).collect() == []


def test_vocabulary_is_a_parameter():
    assert public_tokenizers.path("piece_bpe_32k.model") == PIECES


def test_an_open_drawing_does_not_hide_the_page():
    from wordmill.llm.html import leaf_blocks

    def texts(page):
        return [block.text for block in leaf_blocks(page)]

    page = "<article><p>one</p><svg><path/><g><text>label</text><p>two</p><p>three</p></article>"
    assert texts(page) == ["one", "two", "three"]
    assert texts("<p>a</p><math><mi>x</mi><div>b</div><SVG><rect/></SVG><p>c") == ["a", "b", "c"]
    assert texts("<p>a</p><svg><title>t</title><path d='<p>'/></svg>tail<p>b</p>")[0] == "a"
    assert texts("<p>a</p><script>if (x) { '<p>no</p>' }</script><p>b</p><script><p>open") == ["a", "b"]
