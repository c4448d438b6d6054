"""Language-model scores from a subword lattice.

Every word is a lattice: all ways to cut it into pieces of an existing vocabulary. The marginal
probability of the word is the sum over all of them, by a forward recursion in log space, many
words in step. The vocabulary's own scores give the first weights of the pieces; one round of
expected counts over all training words (forward and backward) fits them to the corpus.

Words are counted over all training documents. The most frequent words, of a bounded number,
are looked up in the tasks; all other words of the documents meet the word table in a join, so
what is gathered grows with the corpus and nothing unbounded is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordmill.llm.common import (
    IS_SPACE,
    Batches,
    fused,
    joined_bytes,
    kept,
    lowered,
    pieces,
    prefix_hash,
    scratch,
    span_hash,
    words,
    written,
)

#: Words that the tasks look up without a join, at most (some 40 MB).
FREQUENT = 1 << 20
#: Bytes of the longest piece; a vocabulary with a longer one is refused.
LONGEST = 64
#: Added to the expected count of every piece.
SMOOTHING = 0.1
#: Rounds of expected counts.
ROUNDS = 1
_SLOTS = 1 << 20
_LN10 = float(np.log(10))


class Pieces:
    """The pieces of a vocabulary as bytes (a blank marks the start of a word), by hash."""

    def __init__(self, path: str) -> None:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        texts: list[bytes] = [bytes([b]) for b in range(256)]
        known = {t: k for k, t in enumerate(texts)}
        scores = [0.0] * 256
        for i in range(model.get_piece_size()):
            if model.is_control(i) or model.is_unknown(i) or model.is_byte(i):
                continue
            text = model.id_to_piece(i).replace("▁", " ").encode()
            # a blank stands only at the start of a word
            if b" " in text[1:]:
                continue
            if len(text) > LONGEST:
                raise ValueError(f"a piece of {len(text)} bytes: raise lattice.LONGEST")
            if text in known:
                scores[known[text]] = model.get_score(i)
            else:
                known[text] = len(texts)
                texts.append(text)
                scores.append(model.get_score(i))
        self.texts = texts
        self.count = len(texts)
        #: Lengths that occur, in bytes.
        self.lengths = np.unique([len(t) for t in texts])
        # the scores rank the pieces; a rank gives a weight by the law of Zipf
        order = np.argsort(np.argsort(-np.array(scores), kind="stable"), kind="stable")
        weight = 1 / (order + 2.7)
        # single bytes keep every word possible, at a low weight
        weight[:256] *= 0.01
        self.first_weights = np.log(weight / weight.sum())

        data, offsets = joined_bytes(pa.array(texts, pa.binary()))
        hashes = span_hash(prefix_hash(data), offsets[:-1], offsets[1:])
        self._hash = np.zeros(_SLOTS, np.uint64)
        self._id = np.full(_SLOTS, -1, np.int32)
        for k, h in enumerate(hashes.tolist()):
            at = h >> 44
            while self._id[at] >= 0:
                at = (at + 1) % _SLOTS
            self._id[at], self._hash[at] = k, h

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The piece of every hash, or -1."""
        at = (hashes >> np.uint64(44)).astype(np.int64)
        out = self._id[at]
        live = np.flatnonzero((out >= 0) & (self._hash[at] != hashes))
        while len(live):
            at[live] = (at[live] + 1) % _SLOTS
            out[live] = self._id[at[live]]
            live = live[(out[live] >= 0) & (self._hash[at[live]] != hashes[live])]
        return out


@kept
def vocabulary(path: str) -> Pieces:
    """The pieces of a file, read once in each worker."""
    return Pieces(path)


def _spaced(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of all words, each after a blank."""
    data, offsets = joined_bytes(texts)
    n = len(offsets) - 1
    spaced = np.empty(len(data) + n, np.uint8)
    heads = offsets[:-1] + np.arange(n)
    mask = np.ones(len(spaced), bool)
    mask[heads] = False
    spaced[heads] = 32
    spaced[mask] = data
    return spaced, offsets + np.arange(n + 1)


def _length_groups(sizes: np.ndarray) -> Iterator[np.ndarray]:
    """Indices of the words by powers of two of their lengths, so that a group wastes no memory."""
    if not len(sizes):
        return
    level = np.ceil(np.log2(np.maximum(sizes, 8))).astype(int)
    for k in np.unique(level):
        own = np.flatnonzero(level == k)
        step = max(1, (8 << 20) >> int(k) >> 3)
        for a in range(0, len(own), step):
            yield own[a : a + step]


def _log_sum(x: np.ndarray) -> np.ndarray:
    top = x.max(axis=0)
    safe = np.where(np.isfinite(top), top, 0)
    with np.errstate(divide="ignore"):
        return safe + np.log(np.exp(x - safe).sum(axis=0))


def _arcs(
    tool: Pieces, data: np.ndarray, starts: np.ndarray, size: int, sizes: np.ndarray
) -> list[tuple[int, np.ndarray]]:
    """Lengths that fit, rising, with the pieces by [word, place], -1 where there is none."""
    prefix = prefix_hash(data)
    place = starts[:, None] + np.arange(size)
    out = []
    for n in tool.lengths[tool.lengths <= size].tolist():
        ids = np.full((len(starts), size), -1, np.int32)
        fit = np.arange(size) + n <= sizes[:, None]
        at = place[fit]
        ids[fit] = tool.find(span_hash(prefix, at, at + n))
        if n == 1 or (ids >= 0).any():
            out.append((n, ids))
    return out


def forward(tool: Pieces, weights: np.ndarray, texts: pa.Array) -> np.ndarray:
    """Natural logarithm of the marginal probability of every word."""
    data, offsets = _spaced(texts)
    sizes = np.diff(offsets)
    out = np.zeros(len(sizes))
    table = np.append(weights, -np.inf)
    for own in _length_groups(sizes):
        alpha, _ = _ahead(tool, table, data, offsets[own], sizes[own])
        out[own] = alpha[sizes[own], np.arange(len(own))]
    return out


def _ahead(tool: Pieces, table: np.ndarray, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray):
    size = int(sizes.max())
    arcs = _arcs(tool, data, starts, size, sizes)
    alpha = np.full((size + 1, len(starts)), -np.inf)
    alpha[0] = 0
    for end in range(1, size + 1):
        alpha[end] = _log_sum(np.stack([alpha[end - n] + table[ids[:, end - n]] for n, ids in arcs if n <= end]))
    return alpha, arcs


def expected(tool: Pieces, weights: np.ndarray, texts: pa.Array, counts: np.ndarray) -> np.ndarray:
    """Expected uses of every piece in the words, each counted `counts` times."""
    data, offsets = _spaced(texts)
    sizes = np.diff(offsets)
    table = np.append(weights, -np.inf)
    total = np.zeros(tool.count + 1)
    for own in _length_groups(sizes):
        alpha, arcs = _ahead(tool, table, data, offsets[own], sizes[own])
        size = len(alpha) - 1
        beta = np.full_like(alpha, -np.inf)
        beta[sizes[own], np.arange(len(own))] = 0
        for start in range(size - 1, -1, -1):
            ways = [beta[start + n] + table[ids[:, start]] for n, ids in arcs if n <= size - start]
            found = _log_sum(np.stack(ways))
            beta[start] = np.where(start < sizes[own], found, beta[start])
        whole = alpha[sizes[own], np.arange(len(own))]
        for n, ids in arcs:
            ids = ids[:, : size - n + 1]
            log = alpha[: size - n + 1].T + table[ids] + beta[n:].T - whole[:, None]
            use = (np.exp(log) * counts[own, None]).ravel()
            total += np.bincount(np.where(ids < 0, tool.count, ids).ravel(), weights=use, minlength=tool.count + 1)
    return total[:-1]


def _strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The spans as a string column."""
    sizes = ends - starts
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    places = np.repeat(starts - offsets[:-1], sizes) + np.arange(offsets[-1])
    return pa.Array.from_buffers(
        pa.string(), len(starts), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data[places])]
    )


def _text_words(texts: pa.Array):
    """Bytes in lower case, starts, ends, hashes and rows of all words."""
    data, offsets = joined_bytes(texts)
    data = lowered(data)
    starts, ends, first = words(data, offsets, ~IS_SPACE)
    row = np.repeat(np.arange(len(texts)), np.diff(first))
    return data, starts, ends, span_hash(prefix_hash(data), starts, ends), row


def _counting(batches: Batches) -> Batches:
    for batch in pieces(batches, "_text"):
        data, starts, ends, hashes, row = _text_words(batch.column("_text"))
        learn = ~batch.column("held_out").to_numpy(zero_copy_only=False)
        _, first, word = np.unique(hashes, return_index=True, return_inverse=True)
        counts = np.bincount(word, weights=learn[row], minlength=len(first)).astype(np.int64)
        yield pa.record_batch([_strings(data, starts[first], ends[first]), pa.array(counts)], names=["word", "c"])


def _expecting(path: str, weights: Broadcast):
    def step(batches: Batches) -> Batches:
        tool = vocabulary(path)
        total = np.zeros(tool.count)
        for batch in batches:
            total += expected(tool, weights.value, batch.column("word"), batch.column("c").to_numpy().astype(float))
        used = np.flatnonzero(total)
        yield pa.record_batch([pa.array(used), pa.array(total[used])], names=["piece", "uses"])

    return step


def _weighing(path: str, weights: Broadcast):
    def step(batches: Batches) -> Batches:
        tool = vocabulary(path)
        for batch in batches:
            log = forward(tool, weights.value, batch.column("word")) / _LN10
            yield batch.append_column("lp", pa.array(log))

    return step


def _scoring(frequent: Broadcast, log_total: float):
    """Step: per row a head (word null) with the sums of its frequent words, and its other words."""

    def step(batches: Batches) -> Batches:
        known, c, lp = frequent.value
        base = np.log10(c + 0.5) - log_total
        for batch in pieces(batches, "_text"):
            n = batch.num_rows
            data, starts, ends, hashes, row = _text_words(batch.column("_text"))
            values, first, word = np.unique(hashes, return_index=True, return_inverse=True)
            at = np.minimum(np.searchsorted(known, values), max(len(known) - 1, 0))
            hit = known[at] == values if len(known) else np.zeros(len(values), bool)
            near = hit[word]
            entry = at[word[near]]
            sums = [np.bincount(row[near], weights=w[entry], minlength=n) for w in (base, lp)]
            seen = np.bincount(row[near], weights=c[entry] > 0, minlength=n).astype(np.int64)
            # the other words, once per row
            far = np.flatnonzero(~near)
            pair, tf = np.unique(row[far] * max(len(values), 1) + word[far], return_counts=True)
            r, w = pair // max(len(values), 1), pair % max(len(values), 1)
            some = first[w]
            rows = np.concatenate([np.arange(n), r])
            zero, none = np.zeros(len(r)), pa.nulls(n, pa.string())
            yield pa.record_batch(
                [
                    batch.column("_doc").take(pa.array(rows)),
                    batch.column("_h").take(pa.array(rows)),
                    pa.concat_arrays([none, _strings(data, starts[some], ends[some])]),
                    pa.array(np.concatenate([np.bincount(row, minlength=n), tf]).astype(np.int64)),
                    pa.array(np.concatenate([seen, zero.astype(np.int64)])),
                    pa.array(np.concatenate([sums[0], zero])),
                    pa.array(np.concatenate([sums[1], zero])),
                ],
                names=["_doc", "_h", "word", "tf", "known", "base", "lp"],
            )

    return step


def _frequent(counted: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, counts and scores of the words from the least count on that at most FREQUENT words have."""
    tops = counted.groupBy(F.least("c", F.lit(100_000)).alias("c")).agg(F.count("*").alias("n")).collect()
    least, total = 100_001, 0
    for row in sorted(tops, key=lambda r: -r["c"]):
        total += row["n"]
        if total > FREQUENT:
            break
        least = row["c"]
    rows = counted.where(F.col("c") >= least).select("word", "c", "lp").toArrow()
    texts = rows["word"].combine_chunks().cast(pa.binary())
    data, offsets = joined_bytes(texts)
    hashes = span_hash(prefix_hash(data), offsets[:-1], offsets[1:])
    order = np.argsort(hashes)
    return hashes[order], rows["c"].to_numpy()[order], rows["lp"].to_numpy()[order]


def score(
    docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text", rounds: int = ROUNDS
) -> DataFrame:
    """Per row: held_out, n_tokens, n_known, train_tokens, base_score, score (both log10).

    Learns from rows whose crc32 of the id as text is not 1 modulo 5; a null id counts as
    crc32 0 and so is learned from. A null or empty text is its end alone. Repeated rows count
    as often as they occur, and all get the same result.
    """
    spark = docs.sparkSession
    folder = scratch(spark)
    held = F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")), F.lit(0)) % 5 == 1
    texts = docs.select(
        F.col(id_column).alias("_doc"),
        F.xxhash64(text_column).alias("_h"),
        held.alias("held_out"),
        F.col(text_column).alias("_text"),
    )
    counted = fused(texts, ["held_out", "_text"], [_counting], "word string, c long").groupBy("word")
    counted = written(counted.agg(F.sum("c").alias("c")), f"{folder}/counts")
    ends = texts.where("NOT held_out").count()
    sums = counted.agg(F.sum("c"), F.count(F.expr("nullif(c, 0)"))).first()
    total = int(sums[0] or 0) + ends
    distinct = int(sums[1]) + (ends > 0)
    log_total = float(np.log10(total + 0.5 * (distinct + 1)))

    tool = vocabulary(path)
    weights, end = tool.first_weights, float(np.log10(0.5))
    for _ in range(rounds):
        sent = spark.sparkContext.broadcast(weights)
        uses = fused(counted.where("c > 0"), ["word", "c"], [_expecting(path, sent)], "piece long, uses double")
        rows = uses.groupBy("piece").agg(F.sum("uses").alias("uses")).toPandas()
        mass = np.full(tool.count, SMOOTHING)
        mass[rows["piece"].to_numpy(dtype=np.int64)] += rows["uses"].to_numpy(dtype=float)
        # the end of a text is drawn beside the pieces
        weights = np.log(mass / (mass.sum() + ends + SMOOTHING))
        end = float(np.log10((ends + SMOOTHING) / (mass.sum() + ends + SMOOTHING)))
    sent = spark.sparkContext.broadcast(weights)
    weighed = fused(counted, ["word", "c"], [_weighing(path, sent)], "word string, c long, lp double")
    weighed = written(weighed, f"{folder}/words")

    frequent = spark.sparkContext.broadcast(_frequent(weighed))
    kind = docs.schema[id_column].dataType.simpleString()
    schema = f"_doc {kind}, _h long, word string, tf long, known long, base double, lp double"
    rows = written(fused(texts, ["_doc", "_h", "_text"], [_scoring(frequent, log_total)], schema), f"{folder}/rows")
    heads = rows.where("word IS NULL").select("_doc", "_h", "tf", "known", "base", "lp", F.lit(1).alias("k"))
    rest = rows.where("word IS NOT NULL").select("_doc", "_h", "word", "tf")
    rest = rest.join(weighed, "word").select(
        "_doc",
        "_h",
        F.lit(0).cast("long").alias("tf"),
        F.expr("CASE WHEN c > 0 THEN tf ELSE 0L END").alias("known"),
        (F.col("tf") * (F.log10(F.col("c") + 0.5) - log_total)).alias("base"),
        (F.col("tf") * F.col("lp")).alias("lp"),
        F.lit(0).alias("k"),
    )
    # equal rows have equal sums, so the sums of k of them are k times those of one
    summed = heads.unionAll(rest).groupBy("_doc", "_h").agg(
        *(F.sum(c).alias(c) for c in ("tf", "known", "base", "lp", "k"))
    )
    one = summed.withColumn("_row", F.explode(F.sequence(F.lit(1), F.col("k").cast("int"))))
    held = F.coalesce(F.crc32(F.col("_doc").cast("string").cast("binary")), F.lit(0)) % 5 == 1
    end_base = float(np.log10(ends + 0.5)) - log_total
    return one.select(
        F.col("_doc").alias(id_column),
        held.alias("held_out"),
        (F.expr("tf div k") + 1).alias("n_tokens"),
        (F.expr("known div k") + int(ends > 0)).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") / F.col("k") + end_base).alias("base_score"),
        (F.col("lp") / F.col("k") + end).alias("score"),
    )
