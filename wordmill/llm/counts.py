"""Token counts by byte-pair merging over a linked list, with a heap of the adjacent pairs.

A text is a list of symbols, one a character. The pair of neighbours that the vocabulary ranks
first is joined, the leftmost of equals, until no two neighbours make a piece. Every join takes
one symbol away, so the count is the symbols at the start less the joins; ids are never made.
A character that no piece holds counts as its UTF-8 bytes.

Where no piece has two characters next to each other, no join ever crosses the place between
them. Texts are cut before blanks, if the vocabulary allows it, and units again at all such
places; the counts of units and of their parts, which recur, are kept in bounded tables.
"""

from __future__ import annotations

import re
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from wordmill.llm.common import Batches, fused, kept, pieces

#: Units whose counts a worker keeps during a task; the table is emptied when full (memory bound).
TABLE_UNITS = 300_000
#: Longer units are counted every time (memory bound of the table: both bounds multiplied).
TABLE_CHARS = 64

#: The character that stands for a blank in the vocabulary.
BLANK = "▁"

_BITS = 32
_PLACE = (1 << _BITS) - 1


class _Table(dict):
    """Counts by unit, made when they are asked for."""

    def __init__(self, count, limit: int = TABLE_UNITS) -> None:
        super().__init__()
        self._count, self._limit = count, limit

    def __missing__(self, unit: str) -> int:
        found = self._count(unit)
        if len(unit) <= TABLE_CHARS:
            if len(self) >= self._limit:
                self.clear()
            self[unit] = found
        return found


class Merger:
    """Counts tokens as a byte-pair model of the sentencepiece library with byte pieces does."""

    def __init__(self, path: str) -> None:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        if not any(map(model.is_byte, ids)):
            raise ValueError("the model has no byte pieces: runs of unknown characters would be one token")
        if any(map(model.is_unused, ids)):
            raise ValueError("the model has unused pieces, which are cut again after merging")
        scores = {
            model.id_to_piece(i): model.get_score(i)
            for i in ids
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
        }
        order = {score: rank for rank, score in enumerate(sorted(set(scores.values()), reverse=True))}
        self.ranks = {piece: order[score] for piece, score in scores.items()}
        self._single = {piece for piece in scores if len(piece) == 1}
        self.normalize = model.normalize
        #: the characters that stand next to each other in a piece
        self._pairs = {piece[i : i + 2] for piece in scores for i in range(len(piece) - 1)}
        self._cut_blanks = not any(pair[1] == BLANK and pair[0] != BLANK for pair in self._pairs)
        self._cut_lines = not any("\n" in pair for pair in self._pairs) and "\n" not in scores
        self._parts = _Table(self.merge)
        self._units = _Table(self._cut)
        self._blank_units = _Table(lambda unit: self._cut(BLANK + unit))

    def _cut(self, unit: str) -> int:
        """The number of tokens of a unit, from the parts that no piece connects."""
        pairs, parts = self._pairs, self._parts
        total = start = 0
        for end in range(1, len(unit)):
            if unit[end - 1 : end + 1] not in pairs:
                total += parts[unit[start:end]]
                start = end
        return total + parts[unit[start:]]

    def merge(self, text: str) -> int:
        """The number of tokens of a normalized text, in n log n steps for n characters."""
        n = len(text)
        if n == 1:
            return 1 if text in self._single else len(text.encode())
        ranks = self.ranks.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pair: list[int | None] = [ranks(text[i : i + 2]) for i in range(n - 1)]
        pair.append(None)
        heap = [rank << _BITS | i for i, rank in enumerate(pair) if rank is not None]
        heapify(heap)
        joins = 0
        while heap:
            first = heappop(heap)
            left = first & _PLACE
            if pair[left] != first >> _BITS:
                continue  # one of the two has been joined otherwise since
            gone = after[left]
            end = after[gone]
            after[left], pair[gone], pair[left] = end, None, None
            joins += 1
            if end < n:
                before[end] = left
                rank = pair[left] = ranks(text[left : after[end]])
                if rank is not None:
                    heappush(heap, rank << _BITS | left)
            back = before[left]
            if back >= 0:
                rank = pair[back] = ranks(text[back:end])
                if rank is not None:
                    heappush(heap, rank << _BITS | back)
        return n - joins + self._more_bytes(text, after)

    def _more_bytes(self, text: str, after: list[int]) -> int:
        """The bytes beyond the first of characters that stayed alone and are no piece."""
        if self._single.issuperset(text):
            return 0
        more, place = 0, 0
        while place < len(text):
            if after[place] == place + 1 and text[place] not in self._single:
                more += len(text[place].encode()) - 1
            place = after[place]
        return more

    def count(self, text: str) -> int:
        """The number of tokens of a text."""
        text = self.normalize(text)
        if not self._cut_blanks:
            return self.merge(text)
        lines = text.split("\n") if self._cut_lines else [text]
        total = len(lines) - 1
        for line in lines:
            first, *rest = line.split(BLANK)
            if first:
                total += self._units[first]
            if "" in rest:
                blanks = re.findall(f"{BLANK}+[^{BLANK}]*", line[len(first) :])
                total += sum(map(self._units.__getitem__, blanks))
            else:
                total += sum(map(self._blank_units.__getitem__, rest))
        return total

    def forget(self) -> None:
        """Empty the tables."""
        for kept in (self._blank_units, self._units, self._parts):
            kept.clear()


@kept
def merger(path: str) -> Merger:
    """The merger of a file, made once in each worker."""
    return Merger(path)


def count(
    docs: DataFrame, path: str, limit: int = 4096, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """The id column, n_bytes, n_tokens and over_limit (n_tokens > limit) of every row.

    `path` names a byte-pair model of the sentencepiece library. A null text counts as empty, an
    empty text has no tokens. Rows are independent: repeated rows and null ids are kept, further
    columns are not read, an empty table gives an empty result. Texts are counted whole.
    """

    def step(batches: Batches) -> Batches:
        tool = merger(path)
        try:
            for batch in pieces(batches, text_column):
                texts = batch.column(text_column).to_pylist()
                sizes = np.array([len(text.encode()) if text else 0 for text in texts], dtype=np.int64)
                found = np.array([tool.count(text) if text else 0 for text in texts], dtype=np.int64)
                yield pa.record_batch(
                    [batch.column(id_column), pa.array(sizes), pa.array(found), pa.array(found > limit)],
                    names=[id_column, "n_bytes", "n_tokens", "over_limit"],
                )
        finally:
            tool.forget()

    kind = docs.schema[id_column].dataType.simpleString()
    schema = f"`{id_column}` {kind}, n_bytes long, n_tokens long, over_limit boolean"
    return fused(docs, [id_column, text_column], [step], schema)
