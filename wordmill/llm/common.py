"""What the operators share: passes over Arrow batches, words as numpy arrays, shared folders.

Cases that hold for every operator unless it says otherwise: a null text counts as an empty
one; a null id is carried through as an id of its own; further columns of the input, whatever
their names, are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import ctypes
import functools
import gc
import sys
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

Batches = Iterator[pa.RecordBatch]
Step = Callable[[Batches], Batches]

#: Bytes of text that a task works on at a time; a longer text is a piece of its own.
PIECE_BYTES = 1 << 20

#: White space of the word rules: blank and the control characters 9 to 13.
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True

IS_UPPER = np.zeros(256, dtype=bool)
IS_UPPER[65:91] = True


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of a data folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """A new folder below `spark.checkpoint.dir`, which all executors share.

    Where the setting is absent, as in tests on one machine, a temporary folder is set.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="wordmill-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/llm-{uuid.uuid4().hex}"


def written(frame: DataFrame, folder: str) -> DataFrame:
    """The frame, written to a shared folder and read back: its lineage ends there."""
    frame.write.parquet(folder)
    return frame.sparkSession.read.schema(frame.schema).parquet(folder)


#: What workers keep from task to task: functions that are cached, by the module they are in.
_KEPT: list = []


def kept(make: Callable) -> Callable:
    """The function, with its results kept in a worker as long as its own operator runs there."""
    cached = functools.cache(make)
    _KEPT.append(cached)
    return cached


def let_go(steps: Sequence[Step]) -> None:
    """Free what a worker keeps for other operators than the one of these steps.

    A session runs one operator after the other in the same workers, so the tables of all would add up.
    """
    global _POWER, _INVERSE
    modules = {step.__module__ for step in steps}
    held = [cached for cached in _KEPT if cached.__module__ not in modules and cached.cache_info().currsize]
    if held or modules != _LAST_MODULES:
        for cached in held:
            cached.cache_clear()
        _POWER, _INVERSE = _POWER[:1].copy(), _INVERSE[:1].copy()
        _LAST_MODULES.clear()
        _LAST_MODULES.update(modules)
        gc.collect()
        if sys.platform == "linux":
            # freed blocks go back to the system, not to the next table of this process
            ctypes.CDLL(None).malloc_trim(0)


_LAST_MODULES: set[str] = set()


def fused(frame: DataFrame, columns: Sequence[str], steps: Sequence[Step], schema: str) -> DataFrame:
    """One pass of Python over the named columns: every step maps Arrow batches to Arrow batches."""
    chain = tuple(steps)

    def run(batches: Batches) -> Batches:
        let_go(chain)
        for step in chain:
            batches = step(batches)
        yield from batches

    return frame.select(*columns).mapInArrow(run, schema)


def same_rows(frame: DataFrame, steps: Sequence[Step]) -> DataFrame:
    """One pass of Python over all columns, which the steps give back."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema)
    return fused(frame, [f"`{c}`" for c in frame.columns], steps, schema)


def pieces(batches: Batches, column: str, limit: int = PIECE_BYTES) -> Batches:
    """The same rows in batches of a bounded amount of text, so that long texts stand alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        texts = batch.column(column)
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int32)[
            texts.offset : texts.offset + len(texts) + 1
        ]
        start = 0
        while start < len(texts):
            stop = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
            stop = min(max(stop, start + 1), len(texts))
            yield batch.slice(start, stop - start)
            start = stop


def joined_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column in one array, and the offsets of its rows (null: empty)."""
    if texts.null_count:
        texts = texts.fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int32)[
        texts.offset : texts.offset + len(texts) + 1
    ].astype(np.int64)
    data = texts.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def _byte_table() -> np.ndarray:
    return np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)


BYTE_HASH = _byte_table()
BASE = 0x9E3779B97F4A7C15 | 5
_CHUNK = 1 << 20


def _powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64."""
    out = np.full(n, np.uint64(base & (2**64 - 1)))
    if n:
        out[0] = 1
    return np.multiply.accumulate(out, out=out)


_POWER = _powers(BASE, 1)
_INVERSE = _powers(pow(BASE, -1, 2**64), 1)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse; the longest tables so far are kept."""
    global _POWER, _INVERSE
    if len(_POWER) < n:
        _POWER = _powers(BASE, max(n, 1 << 16))
        _INVERSE = _powers(pow(BASE, -1, 2**64), len(_POWER))
    return _POWER[:n], _INVERSE[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit values, so that all bits depend on all bits."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Sums of byte hash * base ** position; `span_hash` reads the hash of any span from them."""
    power, _ = powers(len(data) + 1)
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(BYTE_HASH[data] * power[:-1], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the spans [start, end), equal for equal bytes wherever they stand."""
    _, inverse = powers(len(prefix))
    return mixed((prefix[ends] - prefix[starts]) * inverse[starts])


def words(
    data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of all rows, and the index of the first word of each row.

    A word is a maximal run of bytes that `is_word` marks; words end at the end of a row.
    """
    flags = np.zeros(len(data) + 2, dtype=np.int8)
    flags[1:-1] = is_word[data]
    steps = np.diff(flags)
    starts, ends = np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)
    inner = offsets[1:-1]
    if len(inner) and len(data):
        inner = np.unique(inner[(inner > 0) & (inner < len(data))])
        cut = inner[(flags[inner] == 1) & (flags[inner + 1] == 1)]
        if len(cut):
            starts, ends = np.sort(np.append(starts, cut)), np.sort(np.append(ends, cut))
    return starts, ends, np.searchsorted(starts, offsets)


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case, all other bytes as they are."""
    return np.where(IS_UPPER[data], data + 32, data).astype(np.uint8)


def run_hash(word_hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of `size` neighbouring words, by their first word."""
    n = len(word_hashes) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    for k in range(size):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + word_hashes[k : k + n])
    return out


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The least value of every window of `width` neighbours, by doubling."""
    if len(x) < width:
        return x[:0]
    out, have = x, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def sliding_max(x: np.ndarray, width: int) -> np.ndarray:
    """The greatest value of every window of `width` neighbours."""
    return ~sliding_min(~x, width)


def winnowed(hashes: np.ndarray, width: int) -> np.ndarray:
    """The places whose hash is the least of a window of `width` hashes; ties are all taken.

    Two sequences that share a window share its least hash, so each marks that place. A
    sequence shorter than a window is one window.
    """
    if not len(hashes):
        return np.zeros(0, dtype=np.int64)
    width = min(width, len(hashes))
    least = sliding_min(hashes, width)
    edge = np.zeros(width - 1, dtype=hashes.dtype)
    over = sliding_max(np.concatenate([edge, least, edge]), width)
    return np.flatnonzero(over == hashes)


def rows_of(ends: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The row of each place, given the place where every row ends."""
    return np.searchsorted(ends, places, side="right")


def sample_ids(frame: DataFrame, id_column: str, n: int) -> DataFrame:
    """`n` ids at most, the first by hash: a sample that does not depend on the layout."""
    from pyspark.sql import functions as F

    ids = frame.select(F.col(id_column).alias("_id")).where(F.col(id_column).isNotNull()).distinct()
    return ids.orderBy(F.xxhash64("_id"), "_id").limit(n)
