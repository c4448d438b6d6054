"""Byte-level BPE: exact encoding by backtracking over longest matches, decoding by offsets.

An encoding is the one that the merge rules give if, and only if, every pair of neighbouring
tokens is compatible: no merge would have crossed the border between them. The encoder takes
the longest token at each place (Aho-Corasick), checks the border against a table of pair
compatibility, and goes back to a shorter token where it fails. Every place is given up at
most once, so the time is linear in the text.

Texts are cut by the pattern of the tokenizer. A blank before a visible character always starts
a new piece, so texts are first cut there and the units, which recur, are kept in a bounded table.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Sequence

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from wordmill.llm.common import Batches, fused, kept, pieces

#: Entries of the table of units in a worker; it is emptied when full (memory bound).
UNIT_TABLE = 300_000
#: Entries of the pair-compatibility table, filled as pairs occur; emptied when full.
PAIR_TABLE = 1_000_000

_FOREVER = 1 << 60
#: A blank that no visible character follows.
_LOOSE_BLANK = re.compile(r" (?!\S)").search


def _byte_of_symbol() -> dict[str, int]:
    """The printable characters by which byte-level vocabularies write the 256 bytes."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Codec:
    """Encoder and decoder of one vocabulary file (a byte-level BPE of the tokenizers library)."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        symbol = _byte_of_symbol()
        vocab = spec["model"]["vocab"]
        added = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.special = added
        self._special = regex.compile("|".join(map(regex.escape, added))) if added else None
        raw = {i: bytes(symbol[c] for c in token) for token, i in vocab.items() if token not in added}
        raw |= {i: text.encode() for text, i in added.items()}

        sizes = np.array([len(raw.get(i, b"")) for i in range(max(raw) + 1)])
        self.offsets = np.concatenate([[0], np.cumsum(sizes)])
        self.blob = np.frombuffer(b"".join(raw.get(i, b"") for i in range(len(sizes))), np.uint8)

        self._size = sizes.tolist()

        self.ids = {raw[i].decode("latin-1"): i for t, i in vocab.items() if t not in added}
        self.longest = max(map(len, self.ids))
        self._match = ahocorasick.Automaton()
        for text, i in self.ids.items():
            self._match.add_word(text, i)
        self._match.make_automaton()
        # the longest token that a token begins with
        self._shorter: list[int | None] = [None] * len(sizes)
        for text, i in self.ids.items():
            self._shorter[i] = next((self.ids[text[:n]] for n in range(len(text) - 1, 0, -1) if text[:n] in self.ids), None)

        self._merge: dict[tuple[int, int], int] = {}
        self._parts: dict[int, tuple[int, int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            parts = vocab[left], vocab[right]
            self._merge[parts] = rank
            self._parts[vocab[left + right]] = (*parts, rank)
        self._fits: dict[tuple[int, int], bool] = {}
        self._units: dict[str, tuple[bytes, str]] = {}
        # tuples of numbers, which the garbage collector passes over
        self._pieces: dict[str, tuple[int, ...]] = {}
        self._cut = regex.compile(public_tokenizers.PATTERN).findall

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """The tokens at one edge while `token` is built up, each with the rank that ends it."""
        out, until = [(token, _FOREVER)], 0
        while token in self._parts:
            until = self._parts[token][2]
            token = self._parts[token][side]
            out.append((token, until))
        return out

    def fits(self, left: int, right: int) -> bool:
        """Whether no merge crosses the border when `left` and `right` are built side by side.

        A crossing merge happens if its rank comes before the merge that takes the token at
        its left away, and not after the one at its right: equal pairs merge from the left.
        """
        found = self._fits.get((left, right))
        if found is None:
            borders = self._edge(right, 0)
            found = not any(
                rank < end_x and rank <= end_y
                for x, end_x in self._edge(left, 1)
                for y, end_y in borders
                if (rank := self._merge.get((x, y))) is not None
            )
            if len(self._fits) >= PAIR_TABLE:
                self._fits.clear()
            self._fits[left, right] = found
        return found

    def _piece(self, text: str) -> list[int]:
        """The tokens of one piece, given as a string of one character per byte."""
        whole = self.ids.get(text)
        if whole is not None:
            return [whole]
        taken: list[int] = []
        last = None
        for _, token in self._match.iter_long(text):
            if last is not None:
                fit = self._fits.get((last, token))
                if not (self.fits(last, token) if fit is None else fit):
                    break
            taken.append(token)
            last = token
        else:
            return taken
        return self._backtrack(text, taken)

    def _backtrack(self, text: str, taken: list[int]) -> list[int]:
        """Go on after the compatible tokens `taken`, trying shorter tokens where a border fails."""
        size, fits, shorter = self._size, self._fits.get, self._shorter
        place, end = sum(size[t] for t in taken), len(text)
        dead: set[int] = set()
        token = self._longest(text, place)
        while place < end:
            last = taken[-1] if taken else None
            while token is not None:
                if place + size[token] not in dead:
                    if last is None:
                        break
                    fit = fits((last, token))
                    if self.fits(last, token) if fit is None else fit:
                        break
                token = shorter[token]
            if token is not None:
                taken.append(token)
                place += size[token]
                if place < end:
                    token = self._longest(text, place)
            else:
                dead.add(place)
                place -= size[taken.pop()]
                token = shorter[last]
        return taken

    def _longest(self, text: str, place: int) -> int | None:
        """The longest token at a place."""
        known = self.ids.get
        rest = text[place : place + self.longest]
        for stop in range(self._match.longest_prefix(rest), 0, -1):
            token = known(rest[:stop])
            if token is not None:
                return token
        return None

    def _unit(self, text: str) -> list[int]:
        """The tokens of a unit: special tokens first, then the pieces of what lies between."""
        if self._special and self._special.search(text):
            out, end = [], 0
            for found in self._special.finditer(text):
                out += self._plain(text[end : found.start()])
                out.append(self.special[found[0]])
                end = found.end()
            return out + self._plain(text[end:])
        return self._plain(text)

    def _plain(self, text: str) -> list[int]:
        out: list[int] = []
        for piece in self._cut(text):
            tokens = self._pieces.get(piece)
            if tokens is None:
                tokens = tuple(self._piece(piece.encode().decode("latin-1")))
                if len(piece) < 100:
                    if len(self._pieces) >= UNIT_TABLE:
                        self._pieces.clear()
                    self._pieces[piece] = tokens
            out += tokens
        return out

    def encode(self, text: str) -> tuple[np.ndarray, str]:
        """The ids of a text, as an array and as decimal numbers joined by commas."""
        units = text.split(" ")
        first, rest = units[0], units[1:]
        if _LOOSE_BLANK(text):
            rest = []
            for u in units[1:]:
                if u and not u[0].isspace():
                    rest.append(u)
                elif rest:
                    rest[-1] += " " + u
                else:
                    first += " " + u
        known = self._units
        found = list(map(known.get, rest))
        # a unit that holds a special token stands in a text that does
        tokens = self._unit if self._special and self._special.search(text) else self._plain
        if None in found:
            for k, (unit, kept) in enumerate(zip(rest, found, strict=True)):
                if kept is None:
                    kept = known.get(unit)
                    if kept is None:
                        if len(known) >= UNIT_TABLE:
                            known.clear()
                        kept = self._packed(tokens(" " + unit))
                        if len(unit) < 200:
                            known[unit] = kept
                    found[k] = kept
        if first:
            found.insert(0, self._packed(tokens(first)))
        ids = np.frombuffer(b"".join([x[0] for x in found]), dtype="<i4")
        return ids, ",".join([x[1] for x in found])

    @staticmethod
    def _packed(ids: list[int]) -> tuple[bytes, str]:
        return array("i", ids).tobytes(), ",".join(map(str, ids))

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of a sequence of ids, gathered from the blob by the offset table."""
        starts = self.offsets[ids]
        sizes = self.offsets[ids + 1] - starts
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        return self.blob[np.repeat(starts - ends + sizes, sizes) + np.arange(total)].tobytes()


@kept
def codec(path: str) -> Codec:
    """The codec of a file, made once in each worker."""
    return Codec(path)


def encoding(path: str, id_column: str, text_column: str):
    """Step: ids of every text, as `ids` and, joined by commas, as `ids_text`."""

    def step(batches: Batches) -> Batches:
        tool = codec(path)
        for batch in pieces(batches, text_column):
            found = [tool.encode(text or "") for text in batch.column(text_column).to_pylist()]
            sizes = np.cumsum([0, *(len(x[0]) for x in found)])
            values = np.concatenate([x[0] for x in found]) if found else np.zeros(0, "<i4")
            ids = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(values, pa.int32()))
            texts = pa.array([x[1] for x in found], pa.large_string())
            yield pa.record_batch(
                [batch.column(id_column), ids, texts], names=[id_column, "ids", "ids_text"]
            )

    return step


def decoding(path: str):
    """Step: adds `decoded`, the text of the column `ids`; bytes that are no UTF-8 become U+FFFD."""

    def step(batches: Batches) -> Batches:
        tool = codec(path)
        for batch in batches:
            ids = batch.column("ids")
            values = ids.values.to_numpy(zero_copy_only=True)
            bounds = ids.offsets.to_numpy()
            texts = [
                tool.decode(values[a:b]).decode("utf-8", "replace")
                for a, b in zip(bounds[:-1], bounds[1:], strict=True)
            ]
            yield batch.append_column("decoded", pa.array(texts, pa.large_string()))

    return step


def _only(columns: Sequence[str]):
    return lambda batches: (
        pa.record_batch(
            [c.cast(pa.string()) if pa.types.is_large_string(c.type) else c for c in map(b.column, columns)],
            names=list(columns),
        )
        for b in batches
    )


def encode(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The id column and `ids` (array<int>) of every row; a null or empty text has no ids.

    Rows are independent: repeated rows and null ids are kept, ties cannot arise.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    steps = [encoding(path, id_column, text_column), _only([id_column, "ids"])]
    return fused(docs, [id_column, text_column], steps, f"`{id_column}` {kind}, ids array<int>")


def decode(coded: DataFrame, path: str, id_column: str = "doc_id") -> DataFrame:
    """The id column and `decoded` (string) of every row of `encode`; null ids arrays are empty."""
    kind = coded.schema[id_column].dataType.simpleString()
    filled = coded.selectExpr(f"`{id_column}`", "coalesce(ids, cast(array() as array<int>)) AS ids")
    steps = [decoding(path), _only([id_column, "decoded"])]
    return fused(filled, [id_column, "ids"], steps, f"`{id_column}` {kind}, decoded string")


def _digest(id_column: str):
    def sha(column: pa.Array) -> list[str]:
        return [hashlib.sha256(text.encode()).hexdigest() for text in column.to_pylist()]

    def step(batches: Batches) -> Batches:
        for batch in batches:
            counts = np.diff(batch.column("ids").offsets.to_numpy()).astype(np.int64)
            yield pa.record_batch(
                [
                    batch.column(id_column),
                    pa.array(counts),
                    pa.array(sha(batch.column("ids_text"))),
                    pa.array(sha(batch.column("decoded"))),
                ],
                names=[id_column, "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return step


def digests(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Counts and digests of `encode` and of `decode` of its ids, made in one pass over the rows."""
    kind = docs.schema[id_column].dataType.simpleString()
    return fused(
        docs,
        [id_column, text_column],
        [encoding(path, id_column, text_column), decoding(path), _digest(id_column)],
        f"`{id_column}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string",
    )
