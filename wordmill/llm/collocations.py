"""Phrases of two and three words that occur together more often than their parts suggest.

The layout follows external n-gram estimation. The words of all texts are counted in order: first
single words, then pairs of words that are frequent by themselves, then triples of frequent pairs.
What is left is one stream of counts, which is kept twice: sorted by the words from the first
(prefix order), where every phrase follows its own beginnings, and sorted by the words from the
last (suffix order), where it follows its own ends. One pass over each carries the counts of the
shorter phrases along: a lockstep merge. No table of phrases is looked up by hash.

A stream is dealt into pieces by ranges of the whole key. Its rows are distinct phrases, so pieces
are even however many phrases begin with one word; a piece gets what holds at its edges from a
table of one row a piece.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wordmill.llm.common import Batches, fused, joined_bytes, lowered, mixed, pieces, scratch, words, written

#: Phrases have up to so many words.
LONGEST = 3
#: Bytes of text that a task counts at once; a longer text is cut between pieces. They hold 2 ** 20
#: words at most, so that a phrase is a number of 60 bits.
COUNT_BYTES = 2 << 20
#: Bits of the filters of frequent words and pairs. They are the only thing broadcast; where they
#: are too few, phrases are counted in vain, and none is lost.
FILTER_BITS = 1 << 25
#: Rows of a piece of a sorted stream.
PIECE_ROWS = 200_000
#: Rows of a batch that a task gives back.
BATCH_ROWS = 50_000

#: The language of rows without one.
NO_LANG = "und"

_CUTS = np.zeros(256, dtype=bool)
_CUTS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_IS_WORD = ~_CUTS
_IS_WORD[[0x20, 0x09]] = False

_NAMES = [f"w{k + 1}" for k in range(LONGEST)]


# ---- counting, in tasks ---------------------------------------------------------------


def _parts(text: bytes, limit: int) -> list[bytes]:
    """A text cut after separators into parts of about `limit` bytes; phrases cross no separator."""
    out = []
    start = 0
    while len(text) - start > limit:
        near = np.flatnonzero(_CUTS[np.frombuffer(text, np.uint8, limit, start)])
        if len(near):
            stop = start + int(near[-1]) + 1
        else:
            rest = np.flatnonzero(_CUTS[np.frombuffer(text, np.uint8, offset=start + limit)])
            if not len(rest):
                break
            stop = start + limit + int(rest[0]) + 1
        out.append(text[start:stop])
        start = stop
    out.append(text[start:])
    return out


def _gathered(batches: Batches, limit: int):
    """Pairs of languages and texts of about `limit` bytes together; null texts are left out."""
    langs, texts, held = [], [], 0
    for batch in pieces(batches, "text", limit):
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if not text:
                continue
            raw = text.encode()
            for part in [raw] if len(raw) <= limit else _parts(raw, limit):
                if held and held + len(part) > limit:
                    yield langs, texts
                    langs, texts, held = [], [], 0
                langs.append(lang)
                texts.append(part)
                held += len(part)
    if texts:
        yield langs, texts


class _Words:
    """The words of some texts in order, as numbers of (language, word)."""

    def __init__(self, langs: list[str], texts: list[bytes]) -> None:
        data, offsets = joined_bytes(pa.array(texts, pa.binary()))
        data = lowered(data)
        starts, ends, first = words(data, offsets, _IS_WORD)
        row = np.repeat(np.arange(len(texts), dtype=np.int32), np.diff(first))
        cuts = np.zeros(len(data) + 1, np.int32)
        np.cumsum(_CUTS[data], out=cuts[1:], dtype=np.int32)
        #: whether the word is followed by the next one in the same piece
        self.joins = (row[1:] == row[:-1]) & (cuts[starts[1:]] == cuts[ends[:-1]])
        sizes = ends - starts
        kept = pa.Array.from_buffers(
            pa.large_binary(),
            len(starts),
            [
                None,
                pa.py_buffer(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64).tobytes()),
                pa.py_buffer(data[_IS_WORD[data]].tobytes()),
            ],
        )
        coded = kept.dictionary_encode()
        lang = pa.array(langs).dictionary_encode()
        n_words = max(len(coded.dictionary), 1)
        both = lang.indices.to_numpy().astype(np.int64)[row] * n_words + coded.indices.to_numpy()
        kinds, self.ids = np.unique(both, return_inverse=True)
        self.ids = self.ids.astype(np.int32)
        self.lang = lang.dictionary.take(pa.array(kinds // n_words))
        self.word = coded.dictionary.take(pa.array(kinds % n_words))

    def hashes(self) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of every word here, and of every (language, word) as `_hashes` makes it."""
        word = _raw_hashes(self.word)
        return word, _chained(_hashes(self.lang, []), word)

    def runs(self, size: int) -> np.ndarray:
        """Places at which `size` words follow each other in one piece."""
        n = len(self.ids) - size + 1
        if n <= 0:
            return np.zeros(0, np.int64)
        ok = np.ones(n, bool)
        for k in range(size - 1):
            ok &= self.joins[k : k + n]
        return np.flatnonzero(ok)


def _hashes(lang: pa.Array, columns: Sequence[pa.Array]) -> np.ndarray:
    """Hashes of phrases of a language, given by columns of words in UTF-8."""
    coded = lang.dictionary_encode()
    out = _raw_hashes(coded.dictionary)[coded.indices.to_numpy()]
    for column in columns:
        out = _chained(out, _raw_hashes(column))
    return out


def _raw_hashes(strings: pa.Array) -> np.ndarray:
    found = map(xxhash.xxh3_64_intdigest, strings.cast(pa.large_binary()).to_pylist())
    return np.fromiter(found, np.uint64, len(strings))


def _chained(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mixed(left * np.uint64(0x9E3779B97F4A7C15) + right)


def _passes(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = (hashes % np.uint64(len(bits) * 64)).astype(np.int64)
    return (bits[at >> 6] >> (at & 63)) & 1 == 1


def _counting(size: int, frequent: Broadcast | None, limit: int):
    """Step: the phrases of `size` words of the texts of a task, counted by sorting.

    `frequent` is the filter of the phrases of one word less; a phrase counts only if its
    beginning and its end pass it.
    """

    def step(batches: Batches) -> Batches:
        for langs, texts in _gathered(batches, limit):
            told = _Words(langs, texts)
            places = told.runs(size)
            if frequent is not None and len(places):
                places = places[_hopeful(told, places, size, frequent.value)]
            phrases, counts = _counted(told, places, size)
            for a in range(0, len(counts), BATCH_ROWS):
                mine = [pa.array(numbers[a : a + BATCH_ROWS]) for numbers in phrases]
                said = [told.word.take(numbers).cast(pa.string()) for numbers in mine]
                yield pa.record_batch(
                    [
                        told.lang.take(mine[0]),
                        pc.binary_join_element_wise(*said, " "),
                        pa.array(counts[a : a + BATCH_ROWS]),
                    ],
                    names=["lang", "phrase", "f"],
                )
            del told, places, phrases, counts
            pa.default_memory_pool().release_unused()

    return step


def _counted(told: _Words, places: np.ndarray, size: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct phrases at the places, as columns of word numbers, and their counts."""
    base = max(len(told.word), 1)
    if base**size < 1 << 63:
        key = told.ids[places].astype(np.int64)
        for k in range(1, size):
            key = key * base + told.ids[places + k]
        key.sort()
        first = np.flatnonzero(np.diff(key, prepend=-1))
        counts = np.diff(first, append=len(key))
        rest, columns = key[first], []
        for _ in range(size):
            rest, last = np.divmod(rest, base)
            columns.insert(0, last)
        return columns, counts
    # a text without separators may hold more words than three of them fit 63 bits
    rows = np.stack([told.ids[places + k] for k in range(size)], axis=1)
    rows, counts = np.unique(rows, axis=0, return_counts=True)
    return list(rows.T), counts


def _hopeful(told: _Words, places: np.ndarray, size: int, bits: np.ndarray) -> np.ndarray:
    """Whether both parts with one word less pass the filter."""
    word, said = told.hashes()
    if size == 2:
        passed = _passes(bits, said)
        return passed[told.ids[places]] & passed[told.ids[places + 1]]
    begins, follow = said[told.ids], word[told.ids]
    ok = np.ones(len(places), bool)
    for shift in (0, 1):
        run = begins[places + shift]
        for k in range(1, size - 1):
            run = _chained(run, follow[places + shift + k])
        ok &= _passes(bits, run)
    return ok


def _bits_set(size: int, n_bits: int):
    """Step: the words of 64 bits of the filter in which phrases of a table set a bit."""

    def step(batches: Batches) -> Batches:
        for batch in batches:
            said = pc.split_pattern(batch.column("phrase"), " ")
            columns = [pc.list_element(said, k) for k in range(size)]
            hashes = _hashes(batch.column("lang"), columns)
            at = (hashes % np.uint64(n_bits)).astype(np.int64)
            yield pa.record_batch(
                [pa.array(at >> 6), pa.array(np.left_shift(np.int64(1), at & 63))], names=["at", "bits"]
            )

    return step


def _filter(spark: SparkSession, counted: DataFrame, size: int) -> Broadcast:
    """The filter of a table of phrases: FILTER_BITS bits, however many phrases there are."""
    steps = [_bits_set(size, FILTER_BITS)]
    rows = fused(counted, ["lang", "phrase"], steps, "at long, bits long")
    found = rows.groupBy("at").agg(F.expr("bit_or(bits)").alias("bits")).toArrow()
    bits = np.zeros(FILTER_BITS // 64, dtype=np.int64)
    bits[found.column("at").to_numpy()] = found.column("bits").to_numpy()
    return spark.sparkContext.broadcast(bits)


def count(docs: DataFrame, least: int = 10, folder: str | None = None) -> DataFrame:
    """The phrases of one to three words with `least` occurrences or more, per language.

    `docs` has `lang` and `text`. Result: lang, n (words), w1, w2, w3 (null beyond n), f. A phrase
    is frequent only if its beginning and its end are, so each order is counted among those that
    pass the filter of the order before. Written to a shared folder, one table an order.
    """
    spark = docs.sparkSession
    folder = folder or scratch(spark)
    told = docs.select(F.coalesce("lang", F.lit(NO_LANG)).alias("lang"), "text")
    out, frequent = [], None
    for size in range(1, LONGEST + 1):
        steps = [_counting(size, frequent, COUNT_BYTES)]
        partial = fused(told, ["lang", "text"], steps, "lang string, phrase string, f long")
        whole = partial.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
        if size == 1:
            # all words are needed for the totals; they are few beside the pairs
            every = written(whole, f"{folder}/words")
            written(every.groupBy("lang").agg(F.sum("f").alias("total")), f"{folder}/totals")
            kept = every.where(F.col("f") >= least)
        else:
            kept = written(whole.where(F.col("f") >= least), f"{folder}/phrases-{size}")
        if frequent is not None:
            frequent.unpersist()
        if size < LONGEST:
            frequent = _filter(spark, kept, size)
        # words hold no blanks
        names = [F.get(F.split("phrase", " "), F.lit(k)).alias(c) for k, c in enumerate(_NAMES)]
        out.append(kept.select("lang", F.lit(size).alias("n"), *names, "f"))
    return out[0].unionByName(out[1]).unionByName(out[2])


# ---- one pass over a sorted stream ------------------------------------------------------


def _passed(stream: DataFrame, order: Sequence[Column], side: str, folder: str, rows: int) -> DataFrame:
    """The stream with what the shorter and the longer phrases of one side say about each row.

    `order` sorts each phrase behind its parts of one and of two words, and the triples of a pair
    by falling count, so that the row after a pair holds its most frequent extension. Adds
    `one_side` and `two_side` (counts of the parts) and `more_side` (count of the extension).
    """
    spark = stream.sparkSession
    dealt = stream.repartitionByRange(max(1, -(-rows // PIECE_ROWS)), *order).sortWithinPartitions(*order)
    # partition and place in it; neither may be made again, so the stream is written
    place = F.monotonically_increasing_id()
    dealt = dealt.withColumn("_at", place).withColumn("_piece", F.shiftright("_at", 33).cast("int"))
    dealt = written(dealt, f"{folder}/{side}")

    def last(size: int) -> Column:
        return F.max_by("f", F.when(F.col("n") == size, F.col("_at")))

    edge = F.when(F.col("n") == LONGEST, F.col("f"))
    # one row a piece
    edges = (
        dealt.groupBy("_piece")
        .agg(last(1).alias("one"), last(2).alias("two"), F.min_by(edge, "_at").alias("more"))
        .orderBy("_piece")
        .collect()
    )
    carried, one, two = [], None, None
    for k, row in enumerate(edges):
        more = edges[k + 1]["more"] if k + 1 < len(edges) else None
        carried.append((row["_piece"], one, two, more))
        one, two = (x if x is not None else y for x, y in ((row["one"], one), (row["two"], two)))
    carry = spark.createDataFrame(carried, "_piece int, _one long, _two long, _more long")
    along = Window.partitionBy("_piece").orderBy("_at")

    def so_far(size: int, name: str) -> Column:
        mine = F.last(F.when(F.col("n") == size, F.col("f")), ignorenulls=True).over(along)
        return F.coalesce(mine, F.col(name))

    follow = F.coalesce(F.lead("n").over(along), F.lit(0))
    more = F.when(follow == 0, F.col("_more")).when(follow == LONGEST, F.lead("f").over(along))
    return (
        # one row a piece
        dealt.join(F.broadcast(carry), "_piece")
        .withColumn(f"one_{side}", so_far(1, "_one"))
        .withColumn(f"two_{side}", so_far(2, "_two"))
        .withColumn(f"more_{side}", F.when(F.col("n") == 2, more))
        .drop("_at", "_piece", "_one", "_two", "_more")
    )


def _score(left: str, right: str) -> Column:
    """floor(1000000 a a / (l r)), in decimals of 38 digits: exact up to counts of 10 ** 15."""
    return F.expr(
        f"(1000000 * CAST(f AS DECIMAL(38, 0)) * f) DIV (CAST({left} AS DECIMAL(38, 0)) * {right})"
    )


def candidates(docs: DataFrame, least: int = 10) -> DataFrame:
    """Every frequent phrase of two or three words with its lowest-scoring cut.

    Result: lang, phrase, a, l, r, n, score and `inside`, the count of its most frequent extension
    by one word (null if none is frequent). Undefined for nothing: a null language is `und`, null
    and empty texts have no words, copies and ties count each time, an empty table has no phrases.
    """
    folder = scratch(docs.sparkSession)
    stream = written(count(docs, least, folder), f"{folder}/stream")
    rows = stream.count()
    falling = F.when(F.col("n") == LONGEST, F.col("f")).desc_nulls_last()
    prefix = [F.col(c).asc_nulls_first() for c in ("lang", "w1", "w2", "n")]
    ahead = _passed(stream, [*prefix, falling, F.col("w3").asc_nulls_first()], "left", folder, rows)
    # the last word, the one before it, and the first of three
    ends = {
        "s1": F.coalesce("w3", "w2", "w1"),
        "s2": F.when(F.col("n") == 2, F.col("w1")).when(F.col("n") == 3, F.col("w2")),
        "s3": F.when(F.col("n") == 3, F.col("w1")),
    }
    suffix = [
        F.col("lang").asc_nulls_first(),
        ends["s1"].asc_nulls_first(),
        ends["s2"].asc_nulls_first(),
        F.col("n").asc(),
        falling,
        ends["s3"].asc_nulls_first(),
    ]
    both = _passed(ahead, suffix, "right", folder, rows).where(F.col("n") > 1)
    first = F.struct(
        _score("one_left", "IF(n = 2, one_right, two_right)").alias("score"),
        F.lit(1).alias("k"),
        F.col("one_left").alias("l"),
        F.when(F.col("n") == 2, F.col("one_right")).otherwise(F.col("two_right")).alias("r"),
    )
    second = F.struct(
        _score("two_left", "one_right").alias("score"),
        F.lit(2).alias("k"),
        F.col("two_left").alias("l"),
        F.col("one_right").alias("r"),
    )
    # the lower score, then the smaller k
    cut = F.when(F.col("n") == 2, first).otherwise(F.least(first, second))
    # a few rows, one a language
    totals = docs.sparkSession.read.schema("lang string, total long").parquet(f"{folder}/totals")
    scored = both.withColumn("cut", cut).join(totals, "lang")
    return scored.select(
        "lang",
        F.concat_ws(" ", *_NAMES).alias("phrase"),
        F.col("f").alias("a"),
        F.col("cut.l").alias("l"),
        F.col("cut.r").alias("r"),
        F.col("total").alias("n"),
        F.col("cut.score").alias("score"),
        F.greatest("more_left", "more_right").alias("inside"),
    )


def mine(docs: DataFrame, least: int = 10, size: int = 2000) -> DataFrame:
    """The first `size` phrases of each language that no extension of half their count holds.

    Result: lang, rank, phrase, a, l, r, n, score; by score, then a, both falling, then phrase.
    See `candidates` for odd inputs.
    """
    alone = candidates(docs, least).where("inside IS NULL OR 100 * inside < 50 * a").drop("inside")
    # every task keeps its own first rows before they are dealt by language
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = alone.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size)
    return ranked.select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
