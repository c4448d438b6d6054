"""Files of token ids: an adaptive context-mixing range coder over independent blocks.

A block holds whole documents. Its ids are cut into lanes that are coded in step, so that every
operation works on thousands of ids at once; the lanes share one model, which starts empty in
every block. Tables of order 2 and order 1 each name the id that they expect; how far they are
to be trusted is a logistic mix of adaptive probabilities for their confidence, with weights
that are learned on the way, in whole numbers throughout. An id that neither expects is coded by
adaptive counts of order 0. All events go through a range coder per lane.

Layout of a block, little endian: magic, version, CRC-32 of all that follows; numbers of
documents, ids, lanes and the size of the alphabet; document ids and lengths, deflated; lengths
of the lanes in words; the 16-bit words of all lanes. Blocks are rows of a Parquet table (file,
block, first id of the block within its file, payload), so that Spark's writers commit them.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordmill.llm.bpe import _LOOSE_BLANK
from wordmill.llm.common import Batches, fused, kept, pieces

MAGIC, VERSION = b"IDCM", 1
#: Ids of a block, apart from its last document, which is never cut.
BLOCK_IDS = 1 << 20
LANES = 4096
_CONTEXTS = 1 << 18
_HEAD = struct.Struct("<4sHI")
_SIZES = struct.Struct("<IQIII")

_STATE = np.uint64((1 << 56) - 1)
_TOP, _BOTTOM = np.uint64(1 << 40), np.uint64(1 << 24)
_FLAG_BITS, _COUNT_BITS = 16, 20
_SIXTEEN = np.uint64(16)

_LOGIT = np.round(256 * np.log((np.arange(4096) + 0.5) / (4095.5 - np.arange(4096)))).astype(np.int64)
_SQUASH = np.clip(np.round(65536 / (1 + np.exp(-np.arange(-3072, 3073) / 256))), 64, 65472).astype(np.int64)


class _Mixer:
    """The probability of a flag from several adaptive ones, by a learned logistic mix."""

    def __init__(self, sizes: tuple[int, ...]) -> None:
        self.odds = [np.full(n, 32768, np.int64) for n in sizes]
        self.weights = [65536 // len(sizes) + 16384] * len(sizes)

    def probability(self, contexts: list[np.ndarray]) -> np.ndarray:
        self._contexts = contexts
        self._logits = [_LOGIT[odds[c] >> 4] for odds, c in zip(self.odds, contexts, strict=True)]
        total = sum(w * x for w, x in zip(self.weights, self._logits, strict=True)) >> 16
        self._found = _SQUASH[np.clip(total, -3072, 3072) + 3072]
        return self._found

    def learn(self, live: np.ndarray, flags: np.ndarray) -> None:
        error = np.where(flags, 65536, 0)[live] - self._found[live]
        n = max(int(live.sum()), 1)
        for k, (odds, context, logit) in enumerate(zip(self.odds, self._contexts, self._logits, strict=True)):
            step = int((error * logit[live]).sum()) // (n << 8)
            self.weights[k] = min(max(self.weights[k] + step, 0), 1 << 18)
            seen = np.bincount(context[live], minlength=len(odds))
            hits = np.bincount(context[live & flags], minlength=len(odds))
            target = (hits << 16) // np.maximum(seen, 1)
            odds += (target - odds) * seen // (seen + 256)
            np.clip(odds, 64, 65472, out=odds)


class _Model:
    """What the ids so far let expect: tables of order 2 and 1, counts of order 0."""

    def __init__(self, lanes: int, alphabet: int) -> None:
        self.alphabet = alphabet
        self.guess = [np.zeros(_CONTEXTS, np.int64), np.zeros(_CONTEXTS, np.int64)]
        self.trust = [np.zeros(_CONTEXTS, np.int64), np.zeros(_CONTEXTS, np.int64)]
        self.last, self.before = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)
        self.counts = np.zeros(alphabet, np.int64)
        self.both = _Mixer((16, 16, 512))
        self.single = _Mixer((16, 16))
        self.steps = 0
        self._new: list[np.ndarray] = []
        self._refresh()

    def _refresh(self) -> None:
        if self._new:
            self.counts += np.bincount(np.concatenate(self._new), minlength=self.alphabet)
            self._new = []
        room = (1 << _COUNT_BITS) - self.alphabet
        total = max(int(self.counts.sum()), 1)
        share = self.counts * room // total + 1
        share[0] += (1 << _COUNT_BITS) - int(share.sum())
        self.starts = np.concatenate([[0], np.cumsum(share)])

    def expect(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids that orders 2 and 1 expect next in the first n lanes."""
        last, before = self.last[:n], self.before[:n]
        self._at = [((before * 40503 + last) * 2654435761 >> 8) & (_CONTEXTS - 1), last & (_CONTEXTS - 1)]
        self._two, self._one = (g[a] for g, a in zip(self.guess, self._at, strict=True))
        self._t2, self._t1 = (t[a] for t, a in zip(self.trust, self._at, strict=True))
        self._same = self._two == self._one
        return self._two, self._one

    def odds(self) -> tuple[np.ndarray, np.ndarray]:
        """Shares of 65536 for the id of order 2, and for the one of order 1 where it is another."""
        joint = (self._t2 * 16 + self._t1) * 2 + self._same
        two = self.both.probability([self._t2, np.where(self._same, self._t1, 0), joint])
        one = self.single.probability([self._t1, self._t2])
        one = np.where(self._same, 0, np.maximum(((1 << _FLAG_BITS) - two) * one >> _FLAG_BITS, 1))
        return two, one

    def learn(self, ids: np.ndarray) -> None:
        """Take in the ids of one step."""
        n = len(ids)
        hit2, hit1 = ids == self._two, ids == self._one
        everywhere = np.ones(n, bool)
        self.both.learn(everywhere, hit2)
        self.single.learn(~hit2 & ~self._same, hit1)
        for guess, trust, at, hit, old in zip(
            self.guess, self.trust, self._at, (hit2, hit1), (self._t2, self._t1), strict=True
        ):
            fresh = ~hit & (old == 0)
            guess[at[fresh]] = ids[fresh]
            trust[at] = np.where(hit, np.minimum(old + 1, 15), old >> 1)
        self._new.append(ids)
        self.before[:n] = self.last[:n]
        self.last[:n] = ids
        self.steps += 1
        if self.steps & (self.steps - 1) == 0 or self.steps % 32 == 0:
            self._refresh()


class _Writer:
    def __init__(self, lanes: int, words: int) -> None:
        self.low, self.range = np.zeros(lanes, np.uint64), np.full(lanes, _STATE)
        self.out = np.zeros((lanes, words), np.uint16)
        self.size = np.zeros(lanes, np.int64)

    def put(self, lanes: np.ndarray, start: np.ndarray, share: np.ndarray, bits: int) -> None:
        low, span = self.low[lanes], self.range[lanes] >> np.uint64(bits)
        low += span * start.astype(np.uint64)
        span *= share.astype(np.uint64)
        live = np.arange(len(lanes))
        while len(live):
            a, r = low[live], span[live]
            settled = (a ^ (a + r)) < _TOP
            need = settled | (r < _BOTTOM)
            live, a, r, settled = live[need], a[need], r[need], settled[need]
            r = np.where(settled, r, (np.uint64(0) - a) & (_BOTTOM - np.uint64(1)))
            own = lanes[live]
            self.out[own, self.size[own]] = a >> np.uint64(40)
            self.size[own] += 1
            low[live] = (a << _SIXTEEN) & _STATE
            span[live] = r << _SIXTEEN
        self.low[lanes], self.range[lanes] = low, span

    def close(self) -> None:
        lanes = np.arange(len(self.low))
        for _ in range(4):
            self.out[lanes, self.size] = self.low >> np.uint64(40)
            self.low = (self.low << _SIXTEEN) & _STATE
            self.size += 1


class _Reader:
    def __init__(self, words: np.ndarray, sizes: np.ndarray) -> None:
        self.words = np.concatenate([words, np.zeros(4, np.uint16)]).astype(np.uint64)
        self.at = np.cumsum(sizes) - sizes
        lanes = len(sizes)
        self.low, self.range = np.zeros(lanes, np.uint64), np.full(lanes, _STATE)
        self.code = np.zeros(lanes, np.uint64)
        for _ in range(3):
            self.code = (self.code << _SIXTEEN) | self.words[self.at]
            self.at += 1
        # 56 bits of state: three words and a byte; the last word's low half follows
        self.code = (self.code << np.uint64(8)) & _STATE
        self.code |= self.words[self.at] >> np.uint64(8)
        self.half = self.words[self.at] & np.uint64(0xFF)
        self.at += 1

    def value(self, lanes: np.ndarray, bits: int) -> np.ndarray:
        span = self.range[lanes] >> np.uint64(bits)
        found = (self.code[lanes] - self.low[lanes]) // span
        return np.minimum(found, np.uint64((1 << bits) - 1)).astype(np.int64)

    def take(self, lanes: np.ndarray, start: np.ndarray, share: np.ndarray, bits: int) -> None:
        low, span, code = self.low[lanes], self.range[lanes] >> np.uint64(bits), self.code[lanes]
        low += span * start.astype(np.uint64)
        span *= share.astype(np.uint64)
        live = np.arange(len(lanes))
        while len(live):
            a, r = low[live], span[live]
            settled = (a ^ (a + r)) < _TOP
            need = settled | (r < _BOTTOM)
            live, a, r, settled = live[need], a[need], r[need], settled[need]
            r = np.where(settled, r, (np.uint64(0) - a) & (_BOTTOM - np.uint64(1)))
            own = lanes[live]
            word = self.words[np.minimum(self.at[own], len(self.words) - 1)]
            code[live] = ((code[live] << _SIXTEEN) | (self.half[own] << np.uint64(8)) | (word >> np.uint64(8))) & _STATE
            self.half[own] = word & np.uint64(0xFF)
            self.at[own] += 1
            low[live] = (a << _SIXTEEN) & _STATE
            span[live] = r << _SIXTEEN
        self.low[lanes], self.range[lanes], self.code[lanes] = low, span, code


def _lane_sizes(n: int) -> np.ndarray:
    """Ids of every lane; the lanes are neighbouring ranges, the longer ones first."""
    lanes = max(1, min(LANES, n // 16))
    return np.full(lanes, n // lanes) + (np.arange(lanes) < n % lanes)


def encode_ids(ids: np.ndarray, alphabet: int) -> tuple[np.ndarray, np.ndarray]:
    """Lengths of the lanes in words, and the words of all lanes."""
    sizes = _lane_sizes(len(ids))
    first = np.cumsum(sizes) - sizes
    model = _Model(len(sizes), alphabet)
    writer = _Writer(len(sizes), 5 * int(sizes.max(initial=0)) + 8)
    full = 1 << _FLAG_BITS
    for t in range(int(sizes.max(initial=0))):
        n = len(sizes) if t < sizes[-1] else int((sizes > t).sum())
        own = ids[first[:n] + t]
        two, one = model.expect(n)
        lanes = np.arange(n)
        hit, hit1 = own == two, own == one
        first_odds, second_odds = model.odds()
        start = np.where(hit, 0, np.where(hit1, first_odds, first_odds + second_odds))
        share = np.where(hit, first_odds, np.where(hit1, second_odds, full - first_odds - second_odds))
        writer.put(lanes, start, share, _FLAG_BITS)
        left = ~(hit | hit1)
        start = model.starts[own[left]]
        writer.put(lanes[left], start, model.starts[own[left] + 1] - start, _COUNT_BITS)
        model.learn(own)
    writer.close()
    words = writer.out[np.arange(writer.out.shape[1]) < writer.size[:, None]]
    return writer.size, words


def decode_ids(n: int, alphabet: int, lane_words: np.ndarray, words: np.ndarray) -> np.ndarray:
    """The ids again: the same model, driven by what the reader finds."""
    sizes = _lane_sizes(n)
    first = np.cumsum(sizes) - sizes
    out = np.zeros(n, np.int64)
    model = _Model(len(sizes), alphabet)
    reader = _Reader(words, lane_words)
    full = 1 << _FLAG_BITS
    for t in range(int(sizes.max(initial=0))):
        live = len(sizes) if t < sizes[-1] else int((sizes > t).sum())
        two, one = model.expect(live)
        lanes = np.arange(live)
        first_odds, second_odds = model.odds()
        value = reader.value(lanes, _FLAG_BITS)
        hit = value < first_odds
        hit1 = ~hit & (value < first_odds + second_odds)
        start = np.where(hit, 0, np.where(hit1, first_odds, first_odds + second_odds))
        share = np.where(hit, first_odds, np.where(hit1, second_odds, full - first_odds - second_odds))
        reader.take(lanes, start, share, _FLAG_BITS)
        own = np.where(hit, two, one)
        left = lanes[~hit & ~hit1]
        found = np.searchsorted(model.starts, reader.value(left, _COUNT_BITS), side="right") - 1
        own[left] = found
        start = model.starts[found]
        reader.take(left, start, model.starts[found + 1] - start, _COUNT_BITS)
        out[first[:live] + t] = own
        model.learn(own)
    return out


def pack(doc_ids: list[int | None], sizes: np.ndarray, ids: np.ndarray) -> bytes:
    """A block of whole documents."""
    alphabet = int(ids.max(initial=0)) + 1
    lane_words, words = encode_ids(ids.astype(np.int64), alphabet)
    table = np.array([x if x is not None else 0 for x in doc_ids], "<i8").tobytes()
    table += np.array([x is None for x in doc_ids], np.uint8).tobytes() + sizes.astype("<u4").tobytes()
    table = zlib.compress(table)
    body = _SIZES.pack(len(doc_ids), len(ids), len(lane_words), alphabet, len(table))
    body += table + lane_words.astype("<u4").tobytes() + words.astype("<u2").tobytes()
    return _HEAD.pack(MAGIC, VERSION, zlib.crc32(body)) + body


def unpack(raw: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Document ids, lengths and ids of a block. A block that is not whole raises."""
    magic, version, check = _HEAD.unpack_from(raw)
    if magic != MAGIC or version != VERSION:
        raise ValueError("not a block of ids")
    body = memoryview(raw)[_HEAD.size :]
    if zlib.crc32(body) != check:
        raise ValueError("a block of ids is damaged")
    docs, n, lanes, alphabet, size = _SIZES.unpack_from(body)
    at = _SIZES.size
    table = zlib.decompress(body[at : at + size])
    at += size
    lane_words = np.frombuffer(body[at : at + 4 * lanes], "<u4").astype(np.int64)
    words = np.frombuffer(body[at + 4 * lanes :], "<u2")
    keys = np.frombuffer(table[: 8 * docs], "<i8").tolist()
    null = table[8 * docs : 9 * docs]
    sizes = np.frombuffer(table[9 * docs :], "<u4").astype(np.int64)
    ids = decode_ids(n, alphabet, lane_words, words)
    return [None if null[k] else key for k, key in enumerate(keys)], sizes, ids


class Tokens:
    """Ids of many texts by the tokenizers library; units that recur are looked up.

    A blank before a visible character always starts a new token, so the units between such
    blanks can be encoded apart.
    """

    #: Units that are kept; the table is emptied when full (memory bound).
    KEPT = 600_000

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tool = Tokenizer.from_file(path)
        self.tool.no_truncation()
        self.tool.no_padding()
        self._empty()

    def _empty(self) -> None:
        self.known: dict[str, int] = {}
        self.starts = [0]
        self.ids = np.zeros(1 << 16, np.int32)
        self.used = 0

    def _learn(self, units: list[str]) -> None:
        for found in self.tool.encode_batch_fast(units, add_special_tokens=False):
            own = found.ids
            if self.used + len(own) > len(self.ids):
                self.ids = np.concatenate([self.ids, np.zeros(max(len(self.ids), len(own)), np.int32)])
            self.ids[self.used : self.used + len(own)] = own
            self.used += len(own)
            self.starts.append(self.used)
        base = len(self.known)
        self.known.update(zip(units, range(base, base + len(units)), strict=True))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of every text, and all ids."""
        units: list[str] = []
        counts = []
        for text in texts:
            own = text.split(" ")
            if _LOOSE_BLANK(text):
                glued = own[:1]
                for u in own[1:]:
                    if u and not u[0].isspace():
                        glued.append(u)
                    else:
                        glued[-1] += " " + u
                own = glued
            # the first unit of a text has no blank before it
            own = [own[0], *[" " + u for u in own[1:]]]
            units += own
            counts.append(len(own))
        if len(self.known) > self.KEPT:
            self._empty()
        missing = list(dict.fromkeys([u for u in units if u not in self.known]))
        if missing:
            self._learn(missing)
        at = np.fromiter(map(self.known.__getitem__, units), np.int64, len(units))
        starts = np.array(self.starts)
        low, size = starts[at], starts[at + 1] - starts[at]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.ids[np.repeat(low - ends + size, size) + np.arange(total)]
        border = np.cumsum(counts)
        whole = np.concatenate([[0], ends])[np.concatenate([[0], border])]
        return np.diff(whole), ids


@kept
def tokens(path: str) -> Tokens:
    """The tokenizer of a file, made once in each worker."""
    return Tokens(path)


def _with_end(sizes: np.ndarray, ids: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    return sizes + 1, np.insert(ids, np.cumsum(sizes), end_id)


def _coding(path: str, end_id: int):
    """Step: blocks of the rows of a partition, in their order."""

    def blocks(batches: Batches) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
        keys: list = []
        sizes: list[np.ndarray] = []
        ids: list[np.ndarray] = []
        held = 0
        tool = tokens(path)
        for batch in pieces(batches, "_text", 2 << 20):
            own, found = _with_end(*tool.encode([t or "" for t in batch.column("_text").to_pylist()]), end_id)
            keys += batch.column("_id").to_pylist()
            sizes.append(own)
            ids.append(found)
            held += len(found)
            if held >= BLOCK_IDS:
                yield keys, np.concatenate(sizes), np.concatenate(ids)
                keys, sizes, ids, held = [], [], [], 0
        if keys:
            yield keys, np.concatenate(sizes), np.concatenate(ids)

    def step(batches: Batches) -> Batches:
        file, start = TaskContext.get().partitionId(), 0
        for number, (keys, sizes, ids) in enumerate(blocks(batches)):
            yield pa.record_batch(
                [pa.array([v], t) for v, t in (
                    (file, pa.int32()), (number, pa.int32()), (start, pa.int64()), (len(ids), pa.int64()),
                    (pack(keys, sizes, ids), pa.binary()),
                )],
                names=["file", "block", "start", "n_ids", "payload"],
            )
            start += len(ids)

    return step


def write(
    docs: DataFrame, folder: str, path: str, end_id: int = 0, id_column: str = "doc_id", text_column: str = "text"
) -> None:
    """Files of the ids of all documents in ascending order of id (nulls first), each with an end id.

    Documents are dealt by ranges of the id, one file per range. A null or empty text is its end
    id alone. Rows that share an id stand together, in order of their text's hash.
    """
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(F.col(id_column).cast("long").alias("_id"), F.col(text_column).alias("_text"))
    ordered = texts.repartitionByRange(partitions, "_id").sortWithinPartitions("_id", F.xxhash64("_text"))
    schema = "file int, block int, start long, n_ids long, payload binary"
    fused(ordered, ["_id", "_text"], [_coding(path, end_id)], schema).write.parquet(folder)


def _decoding(batches: Batches) -> Batches:
    for batch in batches:
        for base, raw in zip(batch.column("first").to_pylist(), batch.column("payload").to_pylist(), strict=True):
            keys, sizes, ids = unpack(raw)
            offsets = np.concatenate([[0], np.cumsum(sizes)])
            yield pa.record_batch(
                [
                    pa.array(keys, pa.int64()),
                    pa.array(offsets[:-1] + base),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32())),
                ],
                names=["doc_id", "start", "ids"],
            )


def _blocks(spark, folder: str) -> DataFrame:
    """The blocks of a folder, each with the number of ids in all files and blocks before it."""
    rows = spark.read.schema("file int, block int, start long, n_ids long, payload binary").parquet(folder)
    totals = {r["file"]: r["n"] for r in rows.groupBy("file").agg(F.sum("n_ids").alias("n")).collect()}
    first, base = {}, 0
    for file in sorted(totals):
        first[file] = base
        base += totals[file]
    table = spark.createDataFrame(sorted(first.items()), "file int, base long")
    return rows.join(F.broadcast(table), "file").select((F.col("start") + F.col("base")).alias("first"), "payload")


def read(spark, folder: str) -> DataFrame:
    """doc_id, start (number of ids before it in the whole folder) and ids of every document."""
    return fused(_blocks(spark, folder), ["first", "payload"], [_decoding], "doc_id long, start long, ids array<int>")


def _checking(batches: Batches) -> Batches:
    for batch in batches:
        ids = batch.column("ids")
        values = ids.values.to_numpy().astype("<u4")
        bounds = ids.offsets.to_numpy().tolist()
        sums = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(bounds, bounds[1:], strict=False)]
        yield pa.record_batch(
            [
                batch.column("doc_id"),
                batch.column("start"),
                pa.array(np.diff(ids.offsets.to_numpy()).astype(np.int64)),
                pa.array(sums, pa.int64()),
            ],
            names=["doc_id", "start", "n_tokens", "ids_crc32"],
        )


def digests(spark, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and CRC-32 of the ids of every document, from the files alone."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    return fused(_blocks(spark, folder), ["first", "payload"], [_decoding, _checking], schema)
