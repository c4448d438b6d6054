"""Quality rules, with an isolation forest over the rule statistics.

One pass counts what the rules look at. A forest of random splits, in which all good labelled
rows of one half are counted, gives every document the mean depth at which it stands alone; documents that
stand alone early are anomalous. The threshold is calibrated on labelled rows that the forest
has not seen: the one that finds most bad rows among those that reject at most a stated share
of good ones.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordmill.llm.common import Batches, fused, pieces, same_rows, scratch, written

TREES = 200
#: Splits from the root of a tree to its leaves, at most.
LEVELS = 10
#: Share of good labelled rows that the threshold may reject.
GOOD_REJECTED = 0.005

SPACES = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Further statistics of the forest, all counts of characters, lines or words.
MORE = ("n_upper", "n_digits", "n_marks", "n_distinct", "n_lines", "longest_word")
_MARKS = b"!?.,;:\"'()[]{}"
_UPPER = bytes(range(65, 91))
_DIGITS = bytes(range(48, 58))


def _left(raw: bytes, drop: bytes) -> int:
    return len(raw) - len(raw.translate(None, drop))


def count_rules(text: str | None) -> tuple[int, ...]:
    """The counts `COUNTS` and `MORE` of one text; a null text has none of anything."""
    text = text or ""
    raw = text.encode()
    words = raw.split()
    n = len(words)
    repeats = 0
    if n > 3:
        windows = list(zip(words, words[1:], words[2:]))
        if len(set(windows)) < len(windows):
            often = Counter(windows)
            end = 0
            for k, window in enumerate(windows):
                if often[window] > 1:
                    repeats += k + 3 - max(k, end)
                    end = k + 3
    seen: set[str] = set()
    doubled = 0
    lines = text.split("\n")
    for line in lines:
        if line in seen:
            doubled += 1
        elif line and line.strip(" \t\x0b\x0c\r"):
            seen.add(line)
    return (
        n,
        len(text) - _left(raw, SPACES),
        _left(raw, SYMBOLS),
        doubled,
        repeats,
        _left(raw, _UPPER),
        _left(raw, _DIGITS),
        _left(raw, _MARKS),
        len(set(words)),
        len(lines),
        max(map(len, words), default=0),
    )


def features(counts: np.ndarray) -> np.ndarray:
    """Ratios of the counts, one row per document; square roots tell small ratios from none."""
    n, chars, symbols, doubled, repeats, upper, digits, marks, distinct, lines, longest = (
        counts.astype(np.float64).T
    )
    n1, chars1 = np.maximum(n, 1), np.maximum(chars, 1)
    ratios = [symbols / n1, doubled / np.maximum(lines, 1), repeats / n1, upper / chars1, digits / chars1]
    return np.column_stack(
        [*np.sqrt(ratios), chars / n1, np.minimum(marks / n1, 2), np.log1p(n) * (1 - distinct / n1), np.log1p(longest)]
    )


def _mean_depth(n: int) -> float:
    """Mean depth of an unsuccessful search among n rows."""
    if n < 2:
        return 0.0
    return 2 * (math.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n


@dataclass(frozen=True)
class Forest:
    """Trees as arrays: split feature (-1: leaf), split value, children, depth of a leaf."""

    feature: np.ndarray
    split: np.ndarray
    child: np.ndarray
    depth: np.ndarray
    roots: np.ndarray
    unit: float
    threshold: float = 1.0

    def score(self, x: np.ndarray) -> np.ndarray:
        """Anomaly in (0, 1): 2 to the power of minus the mean depth in units of the usual depth."""
        total = np.zeros(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            live = np.flatnonzero(self.feature[at] >= 0)
            while len(live):
                node = at[live]
                right = x[live, self.feature[node]] >= self.split[node]
                at[live] = self.child[node] + right
                live = live[self.feature[at[live]] >= 0]
            total += self.depth[at]
        return np.exp2(-total / len(self.roots) / self.unit)


def planted(
    low: np.ndarray, high: np.ndarray, trees: int = TREES, levels: int = LEVELS, seed: int = 7
) -> tuple[np.ndarray, np.ndarray]:
    """Complete trees, by level from the root: at every node a random feature and a random value.

    Values are drawn from the node's part of the box [low, high] of all rows, not from the
    range of its own rows: parts of the box without rows are cut off early, and what falls
    there stands alone at once. So the splits do not depend on the rows, which are counted after.
    """
    rng = np.random.default_rng(seed)
    wide = np.flatnonzero(high > low)
    under = np.tile(low, (trees, 1, 1))
    over = np.tile(high, (trees, 1, 1))
    feature, split = [], []
    for _ in range(levels if len(wide) else 0):
        f = rng.choice(wide, under.shape[:2])
        where = f[..., None]
        value = rng.uniform(np.take_along_axis(under, where, 2), np.take_along_axis(over, where, 2))
        feature.append(f)
        split.append(value[..., 0])
        left, right = over.copy(), under.copy()
        np.put_along_axis(left, where, value, 2)
        np.put_along_axis(right, where, value, 2)
        shape = (trees, -1, len(low))
        under = np.stack([under, right], 2).reshape(shape)
        over = np.stack([left, over], 2).reshape(shape)
    none = np.zeros((trees, 0))
    return np.hstack([none.astype(int), *feature]), np.hstack([none, *split])


def leaves(feature: np.ndarray, split: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The leaf of every row in every tree, [row, tree], counted over all trees."""
    trees, inner = feature.shape
    own, tree = np.arange(len(x))[:, None], np.arange(trees)
    node = np.zeros((len(x), trees), np.int64)
    for _ in range((inner + 1).bit_length() - 1):
        node = 2 * node + 1 + (x[own, feature[tree, node]] >= split[tree, node])
    return tree * (inner + 1) + node - inner


def grown(feature: np.ndarray, split: np.ndarray, counts: np.ndarray) -> Forest:
    """The forest of the rows that were counted in the leaves; a node of one row at most is a leaf."""
    trees, inner = feature.shape
    held = [counts.reshape(trees, inner + 1)]
    while held[0].shape[1] > 1:
        held.insert(0, held[0].reshape(trees, -1, 2).sum(axis=2))
    level = np.repeat(np.arange(len(held)), [h.shape[1] for h in held])
    own = np.hstack(held)
    nodes = own.shape[1]
    splits = np.zeros(own.shape, bool)
    splits[:, :inner] = own[:, :inner] > 1
    reached = np.ones(own.shape, bool)
    for node in range(1, nodes):
        # a part without rows stays a leaf: what falls there stands alone
        reached[:, node] = splits[:, (node - 1) // 2] & reached[:, (node - 1) // 2]
    number = np.cumsum(reached).reshape(own.shape) - 1
    depth = level + np.vectorize(_mean_depth, otypes=[float])(own)
    left = np.minimum(2 * np.arange(nodes) + 1, nodes - 1)
    features, values = np.full(own.shape, -1), np.zeros(own.shape)
    features[:, :inner], values[:, :inner] = feature, split
    features[~splits] = -1
    return Forest(
        features[reached],
        values[reached],
        number[:, left][reached],
        depth[reached],
        number[:, 0],
        unit=max(_mean_depth(int(own[0, 0])), 1.0),
    )


def kth(scores: DataFrame, k: int) -> float:
    """The k-th least (from 0) of a column `score` of numbers from 0 to 1: exact, by counts of their
    first 16 bits, then of the next 16, and so on; a pass of 65,536 counts at most for each."""
    low, width = 0.0, 1.0
    for _ in range(4):
        step = width / 65536
        inside = scores.where((F.col("score") >= low) & (F.col("score") < low + width) if low + width < 1 else F.col("score") >= low)
        bins = inside.groupBy(F.floor((F.col("score") - low) / step).alias("b")).count().collect()
        for row in sorted(bins, key=lambda r: r["b"]):
            if k < row["count"]:
                break
            k -= row["count"]
        low, width = low + row["b"] * step, step
    # 64 bits hold every number from 2 ** -11 on, so this is the number itself
    return float(scores.where(F.col("score") >= low).agg(F.min("score")).first()[0])


def _counting(id_column: str, text_column: str):
    def step(batches: Batches) -> Batches:
        for batch in pieces(batches, text_column):
            found = np.array(
                [count_rules(t) for t in batch.column(text_column).to_pylist()], dtype=np.int64
            ).reshape(-1, len(COUNTS) + len(MORE))
            columns = [batch.column(c) for c in batch.schema.names if c != text_column]
            names = [c for c in batch.schema.names if c != text_column]
            yield pa.record_batch(
                [*columns, *(pa.array(c) for c in found.T)], names=[*names, *COUNTS, *MORE]
            )

    return step


def _judging(forest: Forest | None, min_words: int, max_repeat_percent: int):
    def step(batches: Batches) -> Batches:
        for batch in batches:
            counts = np.column_stack([batch.column(c).to_numpy() for c in (*COUNTS, *MORE)])
            n, repeats = counts[:, 0], counts[:, 4]
            failed = (n < min_words) | (100 * repeats > max_repeat_percent * n)
            score = np.zeros(len(n)) if forest is None else forest.score(features(counts))
            kept = ~failed if forest is None else ~failed & (score <= forest.threshold)
            names = [c for c in batch.schema.names if c not in MORE]
            yield pa.record_batch(
                [*(batch.column(c) for c in names), pa.array(failed), pa.array(kept), pa.array(score)],
                names=[*names, "base_failed", "kept", "anomaly"],
            )

    return step


_FEATURES = [f"f{n}" for n in range(9)]


def _measuring(min_words: int, max_repeat_percent: int):
    """Step: features of the counted rows that pass the base."""

    def step(batches: Batches) -> Batches:
        for batch in batches:
            counts = np.column_stack([batch.column(c).to_numpy() for c in (*COUNTS, *MORE)])
            passed = (counts[:, 0] >= min_words) & (100 * counts[:, 4] <= max_repeat_percent * counts[:, 0])
            good = batch.column("_quality").to_numpy() == 1
            columns = [good[passed], batch.column("_odd").to_numpy()[passed] == 1, *features(counts)[passed].T]
            yield pa.record_batch([pa.array(c) for c in columns], names=["good", "odd", *_FEATURES])

    return step


def _rows_of(batch: pa.RecordBatch, size: int = 2_000):
    x = np.column_stack([batch.column(c).to_numpy() for c in _FEATURES])
    for start in range(0, len(x), size):
        yield x[start : start + size]


def _settling(feature: np.ndarray, split: np.ndarray):
    """Step: the leaves of a task's rows, with their numbers of rows."""

    def step(batches: Batches) -> Batches:
        total = np.zeros(feature.shape[0] * (feature.shape[1] + 1), np.int64)
        for batch in batches:
            for x in _rows_of(batch):
                total += np.bincount(leaves(feature, split, x).ravel(), minlength=len(total))
        used = np.flatnonzero(total)
        yield pa.record_batch([pa.array(used), pa.array(total[used])], names=["leaf", "n"])

    return step


def _scoring(forest: Forest):
    def step(batches: Batches) -> Batches:
        for batch in batches:
            for x in _rows_of(batch):
                yield pa.record_batch([pa.array(forest.score(x))], names=["score"])

    return step


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    min_words: int = 50,
    max_repeat_percent: int = 50,
) -> Forest | None:
    """Forest and threshold from `labels` (doc_id, quality 0 or 1), for documents that pass the base.

    All labelled documents are used: the good ones of one half, by hash of the id, are counted in
    the trees, those of the other half give the threshold. Rows with null id or quality are no
    labels; of an id that occurs twice the least quality and counts hold. Without enough rows (20
    good ones) there is no forest.
    """
    marks = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    marks = marks.groupBy(F.col("doc_id").alias("_id")).agg(F.min("quality").cast("int").alias("_quality"))
    texts = docs.select(F.col(id_column).alias("_id"), F.col(text_column).alias("_text"))
    counted = [*COUNTS, *MORE]
    kind = docs.schema[id_column].dataType.simpleString()
    # counted where they lie: the counts meet the labels, not the texts
    schema = f"_id {kind}, {', '.join(f'{c} long' for c in counted)}"
    rows = fused(texts, ["_id", "_text"], [_counting("_id", "_text")], schema).join(marks.hint("merge"), "_id")
    rows = rows.groupBy("_id").agg(F.min(F.struct("_quality", *counted)).alias("r")).select("_id", "r.*")
    rows = rows.withColumn("_odd", F.pmod(F.xxhash64("_id"), F.lit(2)).cast("int"))
    schema = f"good boolean, odd boolean, {', '.join(f'{c} double' for c in _FEATURES)}"
    steps = [_measuring(min_words, max_repeat_percent)]
    rows = written(fused(rows, ["_quality", "_odd", *counted], steps, schema), scratch(docs.sparkSession))
    box = [f(c) for f in (F.min, F.max) for c in _FEATURES]
    good, normal, *box = rows.agg(F.count_if("good"), F.count_if(F.expr("good AND NOT odd")), *box).first()
    if good < 20 or not normal:
        return None
    feature, split = planted(np.array(box[:9]), np.array(box[9:]))
    settled = fused(rows.where("good AND NOT odd"), _FEATURES, [_settling(feature, split)], "leaf long, n long")
    settled = settled.groupBy("leaf").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(feature.shape[0] * (feature.shape[1] + 1), np.int64)
    counts[settled["leaf"].to_numpy()] = settled["n"].to_numpy()
    forest = grown(feature, split, counts)
    if good == normal:
        return forest
    scores = fused(rows.where("good AND odd"), _FEATURES, [_scoring(forest)], "score double")
    scores = written(scores, scratch(docs.sparkSession))
    limit = kth(scores, max(0, math.ceil((1 - GOOD_REJECTED) * (good - normal)) - 1))
    return Forest(**{**forest.__dict__, "threshold": limit})


def judge(
    docs: DataFrame,
    forest: Forest | None,
    id_column: str = "doc_id",
    text_column: str = "text",
    min_words: int = 50,
    max_repeat_percent: int = 50,
) -> DataFrame:
    """Counts, base verdict, verdict and anomaly score of every document, in one pass.

    A null or empty text has no words and fails the base. Repeated rows get the same verdict;
    scores equal to the threshold are kept.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    columns = ", ".join(f"{c} long" for c in COUNTS)
    return fused(
        docs,
        [id_column, text_column],
        [_counting(id_column, text_column), _judging(forest, min_words, max_repeat_percent)],
        f"`{id_column}` {kind}, {columns}, base_failed boolean, kept boolean, anomaly double",
    )


def keep(
    docs: DataFrame,
    forest: Forest | None,
    text_column: str = "text",
    min_words: int = 50,
    max_repeat_percent: int = 50,
) -> DataFrame:
    """The rows, with all their columns, that `judge` keeps."""
    count, judged = _counting("", "_text"), _judging(forest, min_words, max_repeat_percent)

    def step(batches: Batches) -> Batches:
        for batch in pieces(batches, text_column):
            texts = pa.record_batch([batch.column(text_column)], names=["_text"])
            for verdict in judged(count(iter([texts]))):
                yield batch.filter(verdict.column("kept"))

    return same_rows(docs, [step])
