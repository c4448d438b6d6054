"""Benchmark decontamination by winnowing.

Of every window of neighbouring k-grams the least hash is kept, in the benchmark and in the
documents alike, so two texts that share a long enough run of words share a kept hash. Kept
hashes that meet are extended word by word to both sides; a run of a whole window is a hit.

The benchmark is the stated query set. It is read in blocks of bounded size; each block is sent
to the tasks once and met with every document in one narrow pass, so documents are not shuffled.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordmill.llm.common import (
    Batches,
    fused,
    joined_bytes,
    lowered,
    pieces,
    prefix_hash,
    run_hash,
    same_rows,
    span_hash,
    winnowed,
    words,
)

#: Words of a window; a shorter item is one window.
WINDOW = 13
#: Words of a k-gram.
GRAM = 5
#: Benchmark words that one broadcast holds at most (an item longer than that is a block of its own).
BLOCK_WORDS = 1_000_000

IS_WORD = np.zeros(256, dtype=bool)
IS_WORD[48:58] = IS_WORD[97:123] = IS_WORD[128:] = True

_CUT = np.uint64(2**64 - 1)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, starts and ends of the words of all texts in lower case; first word of every text."""
    data, offsets = joined_bytes(texts)
    data = lowered(data)
    starts, ends, first = words(data, offsets, IS_WORD)
    return span_hash(prefix_hash(data), starts, ends), starts, ends, first


def grams(hashes: np.ndarray, first: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all k-grams; those that would run over the end of a text are the greatest value."""
    out = run_hash(hashes, size)
    for k in range(1, size):
        cross = first[1:-1] - k
        out[cross[(cross >= 0) & (cross < len(out))]] = _CUT
    return out


@dataclass(frozen=True)
class Block:
    """Benchmark items: word hashes, item borders, and fingerprints by window length."""

    ids: list
    hashes: np.ndarray
    first: np.ndarray
    # window length -> (sorted fingerprints, their places among the words)
    prints: dict[int, tuple[np.ndarray, np.ndarray]]


def make_block(ids: list, texts: list[str], window: int, gram: int) -> Block:
    """The fingerprints of the items. Items without words have none."""
    hashes, _, _, first = word_hashes(pa.array(texts, pa.string()))
    by_length = defaultdict(list)
    for k in range(len(ids)):
        size = int(first[k + 1] - first[k])
        if size:
            by_length[min(size, window)].append(k)
    prints = {}
    for length, items in by_length.items():
        size = min(gram, length)
        found, places = [], []
        for k in items:
            own = run_hash(hashes[first[k] : first[k + 1]], size)
            kept = winnowed(own, length - size + 1)
            found.append(own[kept])
            places.append(kept + first[k])
        found, places = np.concatenate(found), np.concatenate(places)
        order = np.argsort(found, kind="stable")
        prints[length] = found[order], places[order]
    return Block(ids, hashes, first, prints)


def blocks(benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM) -> Iterator[Block]:
    """The benchmark, read item by item, in blocks of bounded size."""
    ids, texts, size = [], [], 0
    for row in benchmark.select("item_id", "text").toLocalIterator():
        if not row["text"]:
            continue
        ids.append(row["item_id"])
        texts.append(row["text"])
        size += row["text"].count(" ") + 1
        if size >= BLOCK_WORDS:
            yield make_block(ids, texts, window, gram)
            ids, texts, size = [], [], 0
    if ids:
        yield make_block(ids, texts, window, gram)


def hits(block: Block, hashes: np.ndarray, first: np.ndarray, window: int, gram: int):
    """Runs of document words [start, end) that lie in windows of the block, with their item."""
    out = []
    text_end = first[1:]
    for length, (prints, at) in block.prints.items():
        size = min(gram, length)
        own = grams(hashes, first, size)
        known = np.searchsorted(prints, own)
        maybe = (known < len(prints)) & (prints[np.minimum(known, len(prints) - 1)] == own)
        if not maybe.any():
            continue
        kept = winnowed(own, length - size + 1)
        # a text shorter than a window cannot hold one; windows over a border only add places
        kept = kept[maybe[kept]]
        low = known[kept]
        many = np.searchsorted(prints, own[kept], side="right") - low
        p = np.repeat(kept, many)
        q = at[np.repeat(low, many) + np.arange(len(p)) - np.repeat(np.cumsum(many) - many, many)]
        row = np.searchsorted(text_end, p, side="right")
        item = np.searchsorted(block.first[1:], q, side="right")
        left = np.zeros(len(p), dtype=np.int64)
        right = np.zeros(len(p), dtype=np.int64)
        room = np.minimum(p - first[row], q - block.first[item])
        live = np.arange(len(p))
        for k in range(1, length - size + 1):
            live = live[room[live] >= k]
            live = live[hashes[p[live] - k] == block.hashes[q[live] - k]]
            left[live] = k
        room = np.minimum(first[row + 1] - p, block.first[item + 1] - q)
        live = np.arange(len(p))
        for k in range(length):
            live = live[room[live] > k]
            live = live[hashes[p[live] + k] == block.hashes[q[live] + k]]
            right[live] = k + 1
        whole = left + right >= length
        out.append((p[whole] - left[whole], p[whole] + right[whole], item[whole], row[whole]))
    if not out:
        return tuple(np.zeros(0, dtype=np.int64) for _ in range(4))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _finding(block: Broadcast, id_column: str, text_column: str, window: int, gram: int):
    """Step: words of each text, hit words as ranges, their bytes as ranges, and items."""

    def step(batches: Batches) -> Batches:
        own = block.value
        for batch in pieces(batches, text_column):
            texts = batch.column(text_column)
            hashes, w_start, w_end, first = word_hashes(texts)
            starts, ends, item, row = hits(own, hashes, first, window, gram)
            _, offsets = joined_bytes(texts)
            spans: list[list[tuple[int, int]]] = [[] for _ in range(len(texts))]
            items: list[set] = [set() for _ in range(len(texts))]
            order = np.lexsort((ends, starts))
            for k in order:
                a, b, r = int(starts[k]), int(ends[k]), int(row[k])
                if spans[r] and spans[r][-1][1] >= a:
                    spans[r][-1] = spans[r][-1][0], max(b, spans[r][-1][1])
                else:
                    spans[r].append((a, b))
                if own.ids[item[k]] is not None:
                    items[r].add(str(own.ids[item[k]]))
            # the bytes of the hit words, for callers that cut them out
            cut = [
                [(int(w_start[a] - offsets[r]), int(w_end[b - 1] - offsets[r])) for a, b in own_spans]
                for r, own_spans in enumerate(spans)
            ]
            base = first[:-1]
            yield pa.record_batch(
                [
                    batch.column(id_column),
                    pa.array(np.diff(first).astype(np.int64)),
                    pa.array(
                        [[{"a": a - int(base[r]), "b": b - int(base[r])} for a, b in s] for r, s in enumerate(spans)],
                        pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])),
                    ),
                    pa.array(
                        [[{"a": a, "b": b} for a, b in s] for s in cut],
                        pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])),
                    ),
                    pa.array([sorted(s) for s in items], pa.list_(pa.string())),
                ],
                names=[id_column, "n_words", "hit_words", "hit_bytes", "items"],
            )

    return step


def _report(id_column: str):
    """Step: the union of the hit words, the items, and the verdict."""

    def step(batches: Batches) -> Batches:
        for batch in batches:
            out = []
            for row in batch.select(["n_words", "hit_words", "items"]).to_pylist():
                n_hit = end = 0
                for span in sorted(row["hit_words"], key=lambda s: (s["a"], s["b"])):
                    n_hit += max(0, span["b"] - max(span["a"], end))
                    end = max(end, span["b"])
                items = sorted(set(row["items"]))
                digest = hashlib.sha256(",".join(items).encode()).hexdigest()
                out.append((n_hit, len(items), digest, n_hit > 0 and 20 * n_hit >= row["n_words"]))
            columns = list(zip(*out, strict=True)) if out else [[], [], [], []]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.bool_()]
            yield pa.record_batch(
                [
                    batch.column(id_column),
                    batch.column("n_words"),
                    *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True)),
                ],
                names=[id_column, "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
            )

    return step


_SPANS = "array<struct<a: bigint, b: bigint>>"


def report(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
) -> DataFrame:
    """Per document: n_words, n_hit, n_items, digest of the item ids, contaminated.

    Contaminated: at least one word in twenty is hit. A null or empty text has no words and is
    clean. Repeated rows and null ids get a row each. The blocks of a large benchmark are united
    by id and text, so that no more than the hits of one document meet.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    schema = (
        f"`{id_column}` {kind}, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"
    )
    sent = [docs.sparkSession.sparkContext.broadcast(b) for b in blocks(benchmark, window, gram)]
    if not sent:
        empty = Block([], np.zeros(0, np.uint64), np.zeros(1, np.int64), {})
        sent = [docs.sparkSession.sparkContext.broadcast(empty)]
    if len(sent) == 1:
        step = _finding(sent[0], id_column, text_column, window, gram)
        return fused(docs, [id_column, text_column], [step, _report(id_column)], schema)
    return _united(docs, sent, id_column, text_column, window, gram, schema)


def _united(
    docs: DataFrame,
    sent: list[Broadcast],
    id_column: str,
    text_column: str,
    window: int,
    gram: int,
    schema: str,
    keep_key: bool = False,
) -> DataFrame:
    kind = docs.schema[id_column].dataType.simpleString()
    keyed = docs.select(
        F.struct(F.col(id_column).alias("id"), F.xxhash64(text_column).alias("h")).alias("_key"),
        F.col(text_column).alias("_text"),
    )
    inner = f"_key struct<id: {kind}, h: bigint>, n_words long, hit_words {_SPANS}, hit_bytes {_SPANS}, items array<string>"
    found = None
    for n, block in enumerate(sent):
        one = fused(keyed, ["_key", "_text"], [_finding(block, "_key", "_text", window, gram)], inner)
        one = one.drop("hit_bytes").withColumn("_first", F.lit(int(n == 0)))
        found = one if found is None else found.unionAll(one)
    joined = found.groupBy("_key", "n_words").agg(
        F.flatten(F.collect_set("hit_words")).alias("hit_words"),
        F.flatten(F.collect_set("items")).alias("items"),
        F.sum("_first").alias("_rows"),
    )
    rows = joined.withColumn("_row", F.explode(F.sequence(F.lit(1), F.col("_rows").cast("int"))))
    if keep_key:
        return fused(rows, ["_key", "n_words", "hit_words", "items"], [_report("_key")], schema)
    rows = rows.select(F.col("_key.id").alias(id_column), "n_words", "hit_words", "items")
    return fused(rows, [id_column, "n_words", "hit_words", "items"], [_report(id_column)], schema)


def clean(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
) -> DataFrame:
    """The rows, with all their columns, that `report` does not call contaminated."""
    sent = [docs.sparkSession.sparkContext.broadcast(b) for b in blocks(benchmark, window, gram)]
    if not sent:
        return docs
    if len(sent) == 1:
        find, judge = _finding(sent[0], "_id", "_text", window, gram), _report("_id")

        def step(batches: Batches) -> Batches:
            for batch in pieces(batches, text_column):
                texts = batch.column(text_column)
                own = pa.record_batch([pa.nulls(len(texts), pa.int64()), texts], names=["_id", "_text"])
                for verdict in judge(find(iter([own]))):
                    yield batch.filter(pc.invert(verdict.column("contaminated")))

        return same_rows(docs, [step])
    kind = docs.schema[id_column].dataType.simpleString()
    key = f"_key struct<id: {kind}, h: bigint>"
    schema = f"{key}, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"
    found = _united(docs, sent, id_column, text_column, window, gram, schema, keep_key=True)
    found = found.where("contaminated").select(F.col("_key.id").alias("_id"), F.col("_key.h").alias("_h")).distinct()
    same = docs[id_column].eqNullSafe(found["_id"]) & (F.xxhash64(docs[text_column]) == found["_h"])
    return docs.join(found, same, "left_anti")
