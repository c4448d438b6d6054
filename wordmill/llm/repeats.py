"""Repeated byte strings, found by sorting suffix buckets with difference-cover ranks.

A byte goes if a string of `length` bytes that covers it also starts earlier. Suffixes need to
be sorted only as deep as that, and only where a string can recur:

1. Of every run of 65 neighbouring 36-byte seeds the one with the least hash is marked, so
   equal strings of 100 bytes hold an equal mark at the same place. Marks that occur once need
   no sorting. A mark whose whole surroundings (all strings that can hold it) equal those of an
   earlier one is settled: all strings around it are repeats.
2. What is left are the first occurrences of different surroundings of one seed. Their suffixes
   form buckets: seed and 32 more bytes to the right, or 33 to the left, depending on how much
   of the string lies left of the seed. Buckets of one row are done.
3. A task sorts a block of whole buckets at a time. It first ranks the suffixes at the places of
   a difference cover modulo 7, doubling the depth up to 92 bytes. The rank of a string is then
   the order of its first 8 bytes, the rank of the next cover place, and the last 8 bytes; so
   long ties cost no comparisons of bytes, and memory is bounded by the block. A bucket larger
   than a block is split by the place and the hash of its strings, and reduced by minima.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wordmill.llm.common import (
    Batches,
    fused,
    joined_bytes,
    mixed,
    pieces,
    prefix_hash,
    scratch,
    span_hash,
    winnowed,
    written,
)

#: Bytes of a repeated string.
LENGTH = 100
SEED = 36
#: Seeds of a window: every string of LENGTH bytes holds so many.
SPREAD = LENGTH - SEED + 1
#: Places left of the seed that buckets to the right serve; the rest are served to the left.
RIGHT_PLACES = 33
#: Rows of a block; a larger bucket is split.
BLOCK_ROWS = 20_000
_LEFT, _RIGHT = SPREAD - 1, LENGTH - SEED
_WIDTH = _LEFT + SEED + _RIGHT
#: A difference cover modulo 7: every difference is one of two members.
COVER = (1, 2, 4)
_LAST_ID = (1 << 63) - 1
_POS_BITS = 40


def _keyed(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Own id, id (null: the last of all), 23 bits of the text's hash above the start, and the text."""
    return docs.select(
        F.col(id_column).alias("_doc"),
        F.coalesce(F.col(id_column).cast("long"), F.lit(_LAST_ID)).alias("_id"),
        F.expr(f"shiftleft(xxhash64(`{text_column}`) & 8388607L, {_POS_BITS})").alias("_at"),
        F.col(text_column).alias("_text"),
    )


def _seeding(batches: Batches) -> Batches:
    for batch in pieces(batches, "_text"):
        data, offsets = joined_bytes(batch.column("_text"))
        if len(data) < LENGTH:
            continue
        prefix = prefix_hash(data)
        starts = np.arange(len(data) - SEED + 1)
        hashes = span_hash(prefix, starts, starts + SEED)
        marks = winnowed(hashes, SPREAD)
        row = np.searchsorted(offsets[1:], marks, side="right")
        low = np.maximum(marks - _LEFT, offsets[row])
        high = np.minimum(marks + SEED + _RIGHT, offsets[row + 1])
        fit = (high - low >= LENGTH) & (marks + SEED <= high)
        marks, row, low, high = marks[fit], row[fit], low[fit], high[fit]
        around = mixed(span_hash(prefix, low, high) + ((marks - low) * 256 + (high - marks)).astype(np.uint64))
        at = batch.column("_at").to_numpy()[row] + marks - offsets[row]
        yield pa.record_batch(
            [
                pa.array(hashes[marks].view(np.int64)),
                pa.array(around.view(np.int64)),
                pa.array(batch.column("_id").to_numpy()[row]),
                pa.array(at),
            ],
            names=["seed", "around", "_id", "at"],
        )


def _surroundings(batches: Batches) -> Batches:
    """Step: for every open mark of a text, its two bucket keys and the bytes around it."""
    for batch in batches:
        seeds, ids, ats, lows, sizes, raws, sides = [], [], [], [], [], [], []
        for key, at0, text, marks in zip(
            batch.column("_id").to_pylist(),
            batch.column("_at").to_pylist(),
            batch.column("_text").to_pylist(),
            batch.column("open").to_pylist(),
            strict=True,
        ):
            raw = text.encode()
            for mark in marks:
                place = mark - at0
                low, high = max(0, place - _LEFT), min(len(raw), place + SEED + _RIGHT)
                own = raw[low:high]
                left = place - low
                if high - place >= SEED + 32:
                    seeds.append(own[left : left + SEED + 32])
                    sides.append(0)
                    ids.append(key), ats.append(mark), lows.append(left), sizes.append(len(own)), raws.append(own)
                if left >= RIGHT_PLACES:
                    seeds.append(own[left - RIGHT_PLACES : left + SEED])
                    sides.append(1)
                    ids.append(key), ats.append(mark), lows.append(left), sizes.append(len(own)), raws.append(own)
        data, offsets = joined_bytes(pa.array(seeds, pa.binary()))
        bucket = span_hash(prefix_hash(data), offsets[:-1], offsets[1:]) ^ np.array(sides, np.uint64)
        yield pa.record_batch(
            [
                pa.array(bucket.view(np.int64)),
                pa.array(sides, pa.int8()),
                pa.array(ids, pa.int64()),
                pa.array(ats, pa.int64()),
                pa.array(lows, pa.int32()),
                pa.array(raws, pa.binary()),
            ],
            names=["bucket", "side", "_id", "at", "left", "bytes"],
        )


def _classes(*columns: np.ndarray) -> np.ndarray:
    """Dense ranks of the rows of some columns."""
    out = np.zeros(len(columns[0]), dtype=np.int64)
    for column in columns:
        own = np.unique(column, return_inverse=True)[1]
        out = np.unique(out * (int(own.max(initial=0)) + 1) + own, return_inverse=True)[1]
    return out


def _places(side: int) -> range:
    """Bytes left of the seed in the strings that a side serves."""
    return range(RIGHT_PLACES) if side == 0 else range(RIGHT_PLACES, SPREAD)


def repeated_strings(bucket: np.ndarray, side: np.ndarray, left: np.ndarray, raws: list[bytes]) -> np.ndarray:
    """Marks (row, bytes left of the seed): the string has an equal one in an earlier row of the bucket.

    Rows are in order of bucket, id and start.
    """
    n = len(raws)
    text = np.zeros((n, _WIDTH + 16), dtype=np.uint8)
    for k, raw in enumerate(raws):
        text[k, _LEFT - left[k] : _LEFT - left[k] + len(raw)] = np.frombuffer(raw, np.uint8)
    high = _LEFT - left + np.array([len(raw) for raw in raws])

    eights = np.zeros((n, _WIDTH + 8), dtype=np.uint64)
    for k in range(8):
        eights = (eights << np.uint64(8)) | text[:, k : k + _WIDTH + 8].astype(np.uint64)

    # ranks at the cover places only; steps of multiples of 7 stay within the cover
    cover = np.flatnonzero(np.isin(np.arange(_WIDTH) % 7, COVER))
    slot = np.full(_WIDTH + 8, -1)
    slot[cover] = np.arange(len(cover))
    rank = np.unique(eights[:, cover], return_inverse=True)[1].reshape(n, -1)
    for step in (7, 14, 28, 35):
        further = slot[np.minimum(cover + step, _WIDTH)]
        after = np.where(further >= 0, rank[:, further], 0)
        rank = np.unique(rank * (int(rank.max(initial=0)) + 1) + after, return_inverse=True)[1].reshape(n, -1)
    ahead = np.array([next((k for k in range(4) if (p + k) % 7 in COVER)) for p in range(_WIDTH)])

    out = np.zeros((n, SPREAD), dtype=bool)
    for own in (0, 1):
        rows = np.flatnonzero(side == own)
        if not len(rows):
            continue
        for place in _places(own):
            start = _LEFT - place
            fit = rows[(left[rows] >= place) & (high[rows] >= start + LENGTH)]
            if len(fit) < 2:
                continue
            at = slot[start + ahead[start]]
            found = _classes(bucket[fit], eights[fit, start], rank[fit, at], eights[fit, start + LENGTH - 8])
            first = np.unique(found, return_index=True)[1]
            again = np.ones(len(fit), dtype=bool)
            again[first] = False
            out[fit[again], place] = True
    return out


def _sorting(batches: Batches) -> Batches:
    """Step: whole buckets, a block at a time; rows come in order of bucket, id and start."""
    held: list[pa.RecordBatch] = []
    rows = 0

    def settle(table: pa.Table) -> pa.RecordBatch:
        bucket = table["bucket"].to_numpy()
        ids, ats = table["_id"].to_numpy(), table["at"].to_numpy()
        marks = repeated_strings(
            bucket, table["side"].to_numpy(), table["left"].to_numpy().astype(np.int64), table["bytes"].to_pylist()
        )
        row, place = np.nonzero(marks)
        return pa.record_batch(
            [pa.array(ids[row]), pa.array(ats[row] - place)], names=["_id", "start"]
        )

    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= BLOCK_ROWS:
            table = pa.Table.from_batches(held)
            last = table["bucket"][table.num_rows - 1].as_py()
            cut = int(np.searchsorted(table["bucket"].to_numpy(), last, side="left"))
            if cut:
                yield settle(table.slice(0, cut))
                table = table.slice(cut)
            held, rows = table.to_batches(), table.num_rows
    if rows:
        yield settle(pa.Table.from_batches(held))


def _splitting(batches: Batches) -> Batches:
    """Step: every string of the rows of a split bucket, by place and hash."""
    for batch in batches:
        raws, left = batch.column("bytes").to_pylist(), batch.column("left").to_numpy()
        side, ids, ats = batch.column("side").to_numpy(), batch.column("_id").to_numpy(), batch.column("at").to_numpy()
        data, offsets = joined_bytes(batch.column("bytes"))
        prefix = prefix_hash(data)
        rows, places = [], []
        for k, raw in enumerate(raws):
            own = [p for p in _places(int(side[k])) if p <= left[k] and left[k] - p + LENGTH <= len(raw)]
            rows += [k] * len(own)
            places += own
        rows, places = np.array(rows, np.int64), np.array(places, np.int64)
        start = offsets[rows] + left[rows] - places
        text = span_hash(prefix, start, start + LENGTH)
        # the two halves apart, so that the key has 128 bits
        half = span_hash(prefix, start, start + LENGTH // 2)
        yield pa.record_batch(
            [pa.array(text.view(np.int64)), pa.array(half.view(np.int64)), pa.array(ids[rows]), pa.array(ats[rows] - places)],
            names=["text", "half", "_id", "start"],
        )


def repeated(docs: DataFrame, folder: str) -> DataFrame:
    """(_id, _at, settled, starts) per keyed text with repeats: settled marks, starts of repeated strings."""
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    marks = fused(docs, ["_id", "_at", "_text"], [_seeding], "seed long, around long, _id long, at long")
    whole = Window.partitionBy("seed")
    same = Window.partitionBy("seed", "around").orderBy("_id", "at")
    ranked = marks.select(
        "seed",
        "_id",
        "at",
        F.first("_id").over(same).alias("id0"),
        F.first("at").over(same).alias("at0"),
        (F.min("around").over(whole) != F.max("around").over(whole)).alias("several"),
    )
    # equal rows of the table make equal marks, which are one: none is earlier than the other
    state = ranked.select("_id", "at", F.expr("_id != id0 OR at != at0").alias("settled"), "several")
    state = state.where("settled OR several")
    found = written(
        state.groupBy("_id", F.expr(f"shiftleft(shiftright(at, {_POS_BITS}), {_POS_BITS})").alias("_at")).agg(
            F.collect_set(F.expr("CASE WHEN settled THEN at END")).alias("settled"),
            F.collect_set(F.expr("CASE WHEN NOT settled THEN at END")).alias("open"),
        ),
        f"{folder}/marks",
    )
    open_marks = found.where("size(open) > 0").select("_id", "_at", "open")
    texts = docs.join(open_marks, ["_id", "_at"]).dropDuplicates(["_id", "_at"])
    around = fused(
        texts,
        ["_id", "_at", "_text", "open"],
        [_surroundings],
        "bucket long, side byte, _id long, at long, left int, bytes binary",
    )
    rows = written(around, f"{folder}/around")
    sizes = rows.groupBy("bucket").agg(F.count("*").alias("rows")).where("rows > 1")
    rows = rows.join(sizes, "bucket")
    some = rows.where(F.col("rows") <= BLOCK_ROWS).repartition(partitions, "bucket")
    some = some.sortWithinPartitions("bucket", "_id", "at")
    starts = fused(
        some, ["bucket", "side", "_id", "at", "left", "bytes"], [_sorting], "_id long, start long"
    )
    many = rows.where(F.col("rows") > BLOCK_ROWS)
    strings = fused(
        many, ["side", "_id", "at", "left", "bytes"], [_splitting], "text long, half long, _id long, start long"
    )
    least = strings.groupBy("text", "half").agg(F.min(F.struct("_id", "start")).alias("first"), F.count("*").alias("c"))
    least = least.where("c > 1").drop("c")
    later = strings.join(least, ["text", "half"]).where("_id != first._id OR start != first.start")
    all_starts = starts.unionAll(later.select("_id", "start"))
    at = F.expr(f"shiftleft(shiftright(start, {_POS_BITS}), {_POS_BITS})")
    starts = all_starts.groupBy("_id", at.alias("_at")).agg(F.collect_set("start").alias("starts"))
    starts = written(starts, f"{folder}/starts")
    return found.select("_id", "_at", "settled").join(starts, ["_id", "_at"], "full")


def _spans(settled: list | None, starts: list | None, at0: int, size: int) -> list[tuple[int, int]]:
    """Removed ranges of a text, in order and apart from each other."""
    if settled is None and starts is None:
        return []
    marks = np.array(settled or [], dtype=np.int64) - at0
    own = np.array(starts or [], dtype=np.int64) - at0
    low = np.concatenate([np.maximum(marks - _LEFT, 0), own])
    high = np.concatenate([np.minimum(marks + SEED + _RIGHT, size), own + LENGTH])
    if not len(low):
        return []
    order = np.argsort(low, kind="stable")
    low, reach = low[order], np.maximum.accumulate(high[order])
    new = np.concatenate([[True], low[1:] > reach[:-1]])
    ends = np.append(reach[np.flatnonzero(new)[1:] - 1], reach[-1])
    return list(zip(low[new].tolist(), ends.tolist(), strict=True))


def _cutting(id_column: str, digest: bool):
    def step(batches: Batches) -> Batches:
        for batch in batches:
            columns = defaultdict(list)
            for text, at0, settled, starts in zip(
                *(batch.column(c).to_pylist() for c in ("_text", "_at", "settled", "starts")), strict=True
            ):
                raw = (text or "").encode()
                spans = _spans(settled, starts, at0, len(raw))
                kept, end = [], 0
                for a, b in spans:
                    kept.append(raw[end:a])
                    end = b
                kept = b"".join([*kept, raw[end:]])
                columns["n_bytes"].append(len(raw))
                columns["n_removed"].append(sum(b - a for a, b in spans))
                columns["n_spans"].append(len(spans))
                if digest:
                    columns["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                else:
                    columns["kept"].append(kept)
            yield pa.record_batch(
                [batch.column(id_column), *(pa.array(c) for c in columns.values())], names=[id_column, *columns]
            )

    return step


def remove(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", digest: bool = False) -> DataFrame:
    """Per row: id, n_bytes, n_removed, n_spans, and `kept`, the bytes that stay (or their SHA-256).

    Order is by id, then start. Null ids come last and are one id; rows that share an id are
    ordered by a hash of their text, and equal rows are one document. A null or empty text, and
    any text of fewer than 100 bytes, loses nothing.
    """
    folder = scratch(docs.sparkSession)
    found = repeated(_keyed(docs, id_column, text_column), folder)
    kind = docs.schema[id_column].dataType.simpleString()
    full = _keyed(docs, id_column, text_column).join(found, ["_id", "_at"], "left")
    last = "kept_sha256 string" if digest else "kept binary"
    out = fused(
        full,
        ["_doc", "_at", "_text", "settled", "starts"],
        [_cutting("_doc", digest)],
        f"_doc {kind}, n_bytes long, n_removed long, n_spans long, {last}",
    )
    return out.withColumnRenamed("_doc", id_column)
