"""Operators over a whole corpus, against plain code."""

import random

import plain
import pytest
from pyspark.sql import functions as F

from wordmill.llm import jaccard, lattice, links, passages, repeats
from wordmill.llm.queries import PIECES


def near_copies():
    random.seed(5)
    docs = []
    for _ in range(30):
        base = [random.choice("abcdefgh") + str(random.randint(0, 30)) for _ in range(random.choice([0, 1, 3, 4, 5, 6, 12, 30, 80, 200]))]
        for _ in range(random.choice([1, 1, 2, 6, 25])):
            own = list(base)
            for _ in range(random.randint(0, max(1, len(own) // 20))):
                if own:
                    own[random.randrange(len(own))] = "z" + str(random.randint(0, 3))
            docs.append((len(docs) if len(docs) % 9 else None, " ".join(own)))
    return docs + [(500, None), (501, ""), (502, "A B"), (503, "a b"), (503, "a b"), (1, "  ")]


def test_components_of_chains(spark):
    edges = [(k, k + 1) for k in range(0, 40)] + [(100, k) for k in range(101, 130)] + [(7, 7)]
    random.seed(1)
    random.shuffle(edges)
    found = {r.node: r.root for r in links.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {k: 0 for k in range(41)} | {k: 100 for k in range(100, 130)}
    assert links.components(spark.createDataFrame([], "a long, b long")).collect() == []


@pytest.mark.parametrize("pivots", [1, 4])
def test_jaccard_join(spark, monkeypatch, pivots):
    monkeypatch.setattr(jaccard, "PIVOTS", pivots)
    docs = near_copies()
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("point", F.lit("clash"))
    assert sorted(map(tuple, jaccard.join(frame).collect()), key=repr) == plain.components(docs)


def test_one_of_each_component_stays(spark, odd_docs, no_docs):
    docs = [(k, t) for k, (_, t) in enumerate(near_copies())]
    frame = spark.createDataFrame([*docs, *docs[:3]], "doc_id long, text string").withColumn("_point", F.lit(1))
    kept = [r.doc_id for r in jaccard.keep_one(frame).collect()]
    expected = [k for k, _, root in plain.components(docs) if k == root]
    # rows without shingles stay, also repeated ones
    empty = [k for k, t in docs[:3] if not plain.spaced(t)]
    assert sorted(kept) == sorted(expected + empty)
    assert jaccard.keep_one(odd_docs).columns == odd_docs.columns
    assert jaccard.keep_one(no_docs).collect() == [] and jaccard.join(no_docs).collect() == []


def test_odd_docs_link_by_text(spark, odd_docs):
    rows = [tuple(r) for r in jaccard.join(odd_docs).collect()]
    given = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert sorted(rows, key=repr) == plain.components(given)


def test_many_unrelated_documents_in_one_region(spark):
    """Documents of one common passage and own words: far more than the pivots of a round."""
    random.seed(2)
    common = [f"c{k}" for k in range(30)]
    docs = [(k, " ".join(common + [f"w{random.randrange(10**6)}" for _ in range(12)])) for k in range(60)]
    docs += [(100 + k, docs[k][1] + " end") for k in range(3)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert sorted(map(tuple, jaccard.join(frame).collect()), key=repr) == plain.components(docs)


def test_near_copies_are_not_compared_in_all_pairs(spark, monkeypatch):
    """Copies about as far from each other as the radius: what links join is not measured again."""
    random.seed(4)
    base = [f"b{k}" for k in range(150)]
    docs = []
    for k in range(240):
        own = list(base)
        for _ in range(random.randint(1, 4)):
            own[random.randrange(150)] = f"x{random.randrange(10**6)}"
        docs.append((k, " ".join(own)))
    measured = []

    def counted(frame, folder, plainly=jaccard.written):
        out = plainly(frame, folder)
        if "/pairs" in folder:
            measured.append(out.count())
        return out

    monkeypatch.setattr(jaccard, "written", counted)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert sorted(map(tuple, jaccard.join(frame).collect()), key=repr) == plain.components(docs)
    assert sum(measured) < 12 * len(docs)


def repeating_docs():
    random.seed(5)
    parts = ["".join(random.choice("abcdeé \n") for _ in range(random.choice([60, 99, 100, 101, 130, 300]))) for _ in range(12)]
    docs = []
    for k in range(120):
        text = ""
        for _ in range(random.randint(0, 4)):
            own = random.choice(parts)
            if random.random() < 0.4:
                a = random.randrange(len(own))
                own = own[:a] + "X" * random.randint(0, 2) + own[a + 1 :]
            text += own + "".join(random.choice("xyz") for _ in range(random.choice([0, 3, 50])))
        docs.append((k * 3, text))
    return docs + [(1, None), (2, ""), (4, "a" * 99), (5, "a" * 100), (7, "a" * 350), (8, "ab" * 300)]


@pytest.mark.parametrize("block", [20_000, 5])
def test_repeated_strings(spark, monkeypatch, block):
    monkeypatch.setattr(repeats, "BLOCK_ROWS", block)
    docs = repeating_docs()
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("settled", F.lit(0))
    assert sorted(map(tuple, repeats.remove(frame, digest=True).collect())) == plain.removed(docs)


def test_repeats_of_odd_docs(spark, odd_docs, no_docs):
    rows = repeats.remove(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by = {r.doc_id: r for r in rows}
    assert by[1].n_bytes == 0 and bytes(by[2].kept) == b""
    # a run of one letter: the first 100 bytes stay
    assert by[5].n_removed == 300_000 - 1 and by[5].n_spans == 1
    # equal rows are one document, so neither is earlier
    assert [r.n_removed for r in rows if r.doc_id == 6] == [100_000 - 5] * 2
    assert repeats.remove(no_docs).collect() == []
    text = "q".join(map(str, range(80)))
    nulls = spark.createDataFrame([(1, text), (1, text), (None, text), (None, "u" + text)], "doc_id long, text string")
    assert sorted((repr(r.doc_id), r.n_removed) for r in repeats.remove(nulls).collect()) == [("1", 0), ("1", 0), ("None", 229), ("None", 229)]


@pytest.mark.parametrize("frequent", [1 << 20, 3])
def test_scores(spark, monkeypatch, frequent):
    monkeypatch.setattr(lattice, "FREQUENT", frequent)
    docs = [(1, "The the cat"), (2, None), (3, ""), (None, "a b c"), (None, "a b c"), (4, "the the zzz\ncat"), (7, "dog zebra")] * 2
    docs += [(k, f"w{k} the") for k in range(10, 30)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("word", F.lit("clash"))
    rows = sorted(map(tuple, lattice.score(frame, PIECES).collect()), key=repr)
    expected = plain.base_scores(docs)
    assert [r[:5] for r in rows] == [r[:5] for r in expected]
    for row, other in zip(rows, expected, strict=True):
        assert abs(row[5] - other[5]) < 1e-9 * max(1, abs(other[5]))
        assert row[6] < 0


def test_scores_prefer_the_language_of_the_corpus(spark, no_docs):
    random.seed(3)
    syllables = ["th", "en", "er", "on", "ing", "re"]
    docs = [(k, " ".join("".join(random.choice(syllables) for _ in range(random.randint(1, 3))) for _ in range(80))) for k in range(200)]
    alien = " ".join("".join(random.choice("bcdfgjkqvwxz") for _ in range(6)) for _ in range(80))
    frame = spark.createDataFrame([*docs, (1000, alien)], "doc_id long, text string")
    rows = lattice.score(frame, PIECES).toPandas()
    held = rows[rows.held_out & (rows.doc_id < 1000)]
    assert (held.score / held.n_tokens).min() > 2 * (rows.score / rows.n_tokens)[rows.doc_id == 1000].max()
    assert lattice.score(no_docs, PIECES).collect() == []


def test_odd_docs_are_scored(spark, odd_docs):
    rows = sorted(map(tuple, lattice.score(odd_docs, PIECES).collect()), key=repr)
    given = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert [r[:5] for r in rows] == [r[:5] for r in plain.base_scores(given)]


def test_passages(spark):
    random.seed(4)
    words = [f"w{k}" for k in range(4000)]

    def some(n):
        return [random.choice(words) for _ in range(n)]

    shared = [some(60) for _ in range(5)]
    docs, holders = [], {}
    for k in range(150):
        own = some(random.randint(50, 150))
        if k % 2 == 0:
            j = k // 2 % 5
            copy = list(shared[j])
            if k >= 50:
                copy[random.randrange(60)] = "edit"
                del copy[random.randrange(59)]
            own += copy + some(random.randint(0, 60))
            holders.setdefault(j, []).append(k)
        docs.append((k, " ".join(own)))
    frame = spark.createDataFrame([*docs, (900, None), (901, ""), (None, docs[4][1]), (4, docs[4][1])], "doc_id long, text string")
    rows = passages.find(frame).toPandas()
    later = {k for own in holders.values() for k in own[1:]}
    assert set(rows.doc_id.dropna().astype(int)) == later
    assert rows.doc_id.isna().any()
    assert (rows.end_word - rows.start_word >= 45).all() and (rows.identity >= 0.8).all()
    exact = rows[(rows.doc_id < 50) & (rows.ref_id < 50)]
    assert ((exact.end_word - exact.start_word) >= 60).all() and ((exact.end_word - exact.start_word) <= 64).all()
    assert passages.find(frame.where("false")).collect() == []


def test_chains_are_the_best():
    """Against all chains of few matches."""
    import numpy as np

    random.seed(9)

    def value(path):
        total = passages.SEED_WORDS
        for (a, b), (c, d) in zip(path, path[1:], strict=False):
            total += passages.SEED_WORDS - passages.GAP_COST * (c - a + d - b)
        return total

    for _ in range(60):
        points = list({(random.randint(0, 40), random.randint(0, 40)) for _ in range(random.randint(1, 8))})
        best = max(
            value(path)
            for mask in range(1, 1 << len(points))
            if (path := sorted(p for k, p in enumerate(points) if mask >> k & 1))
            and all(a[0] < b[0] and a[1] < b[1] for a, b in zip(path, path[1:], strict=False))
        )
        x, y = np.array([p[0] for p in points]), np.array([p[1] for p in points])
        assert abs(max(map(value, passages.chains(x, y))) - best) < 1e-9


def test_passages_of_stock_lines(spark):
    """Runs of a shared passage stand in many other documents, too: before the earliest holder and between."""
    random.seed(12)

    def some(n):
        return [f"v{random.randrange(10**6)}" for _ in range(n)]

    passage = some(60)
    changed = [w if k % 10 != 7 else "edit" for k, w in enumerate(passage)]
    docs = [(100, some(40) + passage + some(20)), (300, some(10) + passage + some(40)), (400, some(30) + changed + some(9))]
    for k in [*range(40), *range(200, 260)]:
        start = k * 8 % 44
        docs.append((k, some(20) + passage[start : start + random.randint(13, 20)] + some(20)))
    frame = spark.createDataFrame([(k, " ".join(words)) for k, words in docs], "doc_id long, text string")
    found = {(r.doc_id, r.ref_id) for r in passages.find(frame).collect()}
    assert (300, 100) in found and {d for d, _ in found} == {300, 400}


@pytest.mark.parametrize("shared", [0, 20])
def test_recall_by_identity(spark, shared):
    """Passages with a fifth or less of changed words, beside many holders of the changed copy's lines."""
    random.seed(21)

    def some(n):
        return [f"u{random.randrange(10**6)}" for _ in range(n)]

    docs, planted = [], {}
    for every in (5, 6, 10):
        for k in range(20):
            passage = some(60)
            copy = list(passage)
            for block in range(0, 60, every):
                # one word of every block, at its end or anywhere
                copy[block + (every - 1 if k % 2 else random.randrange(every))] = "edit"
            docs.append(some(30) + passage + some(30))
            docs.append(some(25) + copy + some(35))
            planted[len(docs) - 1] = (every, len(docs) - 2)
            for _ in range(shared):
                start = random.randrange(45)
                docs.append(some(20) + passage[start : start + 15] + some(20))
    frame = spark.createDataFrame([(k, " ".join(words)) for k, words in enumerate(docs)], "doc_id long, text string")
    found = {(r.doc_id, r.ref_id) for r in passages.find(frame).collect()}
    missed = [every for key, (every, ref) in planted.items() if (key, ref) not in found]
    assert {every: missed.count(every) for every in set(missed)} == {}
