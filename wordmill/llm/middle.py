"""Fill-in-the-middle by a piece table.

A document is a run of descriptors (row, buffer, start, size) over two buffers that never change:
the texts of the batch and the sentinels. Cutting a document splits its one descriptor, arranging
it permutes the parts and puts descriptors of sentinels between them, and restoring finds the
parts between the sentinels and applies the inverse permutation. Texts are copied only when an
output is wanted as a string; digests are streamed from the buffers, descriptor by descriptor.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from wordmill.llm.common import IS_SPACE, Batches, fused, joined_bytes, pieces, words

TEXT, SENTINEL = 0, 1

#: The parts of a document, by number, and the order in which each form has them.
PREFIX, MIDDLE, SUFFIX = 0, 1, 2
ORDERS = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}
FORMS = ("plain", "psm", "spm")


@dataclass(frozen=True)
class Recipe:
    """How documents are cut and arranged; rates are per cent."""

    seed: int = 42
    rate: int = 50
    spm_rate: int = 80
    prefix: str = "<P>"
    middle: str = "<M>"
    suffix: str = "<S>"

    def __post_init__(self) -> None:
        marks = [self.prefix, self.middle, self.suffix]
        if not all(marks):
            raise ValueError("a sentinel is empty")
        # then no sentinel can arise where a text and a sentinel meet
        for a in range(3):
            for b in range(3):
                overlap = any(marks[b].startswith(marks[a][k:]) for k in range(1, len(marks[a])))
                if overlap or (a != b and marks[a] in marks[b]):
                    raise ValueError("sentinels overlap")

    @property
    def marks(self) -> list[bytes]:
        """The sentinels in UTF-8, by part."""
        return [self.prefix.encode(), self.middle.encode(), self.suffix.encode()]

    def draws(self, key: object) -> list[int]:
        """Four numbers of a document: the first four groups of eight digits of a digest."""
        text = f"{self.seed}:{'' if key is None else key}"
        digest = hashlib.sha256(text.encode()).hexdigest()
        return [int(digest[k : k + 8], 16) for k in range(0, 32, 8)]


class PieceTable:
    """Descriptors over a buffer of texts and a buffer of sentinels, in the order of the rows."""

    def __init__(self, texts: memoryview, sentinels: memoryview, rows, buffers, starts, sizes) -> None:
        self.buffers = texts, sentinels
        self.rows, self.kinds, self.starts, self.sizes = rows, buffers, starts, sizes

    @classmethod
    def whole(cls, texts: memoryview, sentinels: memoryview, offsets: np.ndarray) -> PieceTable:
        """One descriptor a row."""
        n = len(offsets) - 1
        return cls(texts, sentinels, np.arange(n), np.zeros(n, np.int8), offsets[:-1], np.diff(offsets))

    def cut(self, chosen: np.ndarray, first: np.ndarray, second: np.ndarray) -> PieceTable:
        """Split the descriptors of the chosen rows at two places of the text buffer each."""
        times = np.where(chosen, 3, 1)
        rows = np.repeat(self.rows, times)
        at = np.cumsum(times) - times
        starts, ends = np.repeat(self.starts, times), np.repeat(self.starts + self.sizes, times)
        mine = at[chosen]
        ends[mine], starts[mine + 1] = first[chosen], first[chosen]
        ends[mine + 1], starts[mine + 2] = second[chosen], second[chosen]
        return PieceTable(*self.buffers, rows, np.repeat(self.kinds, times), starts, ends - starts)

    def arranged(self, forms: np.ndarray, marks: list[bytes]) -> PieceTable:
        """Permute the three parts of the rows that have a form, a sentinel before each part."""
        base = np.cumsum([0, *map(len, marks)])
        out = []
        times = np.bincount(self.rows, minlength=len(forms))
        first = np.cumsum(times) - times
        places = np.cumsum(np.where(forms == 0, 1, 6)) - np.where(forms == 0, 1, 6)
        plain = np.flatnonzero(forms == 0)
        out.append((places[plain], first[plain], None))
        for code, name in enumerate(FORMS):
            for slot, part in enumerate(ORDERS.get(name, ())):
                mine = np.flatnonzero(forms == code)
                out.append((places[mine] + 2 * slot, mine, part))
                out.append((places[mine] + 2 * slot + 1, first[mine] + part, None))
        total = int(np.where(forms == 0, 1, 6).sum())
        rows, kinds = np.repeat(np.arange(len(forms)), np.where(forms == 0, 1, 6)), np.zeros(total, np.int8)
        starts, sizes = np.zeros(total, np.int64), np.zeros(total, np.int64)
        for at, source, part in out:
            if part is None:
                starts[at], sizes[at] = self.starts[source], self.sizes[source]
            else:
                kinds[at], starts[at], sizes[at] = SENTINEL, base[part], len(marks[part])
        return PieceTable(*self.buffers, rows, kinds, starts, sizes)

    def restored(self, forms: np.ndarray) -> PieceTable:
        """Put the three parts of the rows that have a form back in the order of the text."""
        order = np.arange(len(self.rows))
        times = np.bincount(self.rows, minlength=len(forms))
        first = np.cumsum(times) - times
        for code, name in enumerate(FORMS):
            mine = first[forms == code]
            for part, slot in enumerate(np.argsort(ORDERS[name]) if name in ORDERS else ()):
                order[mine + part] = mine + slot
        return PieceTable(*self.buffers, self.rows, self.kinds[order], self.starts[order], self.sizes[order])

    def streams(self, n: int) -> Iterator[list[memoryview]]:
        """For each of `n` rows the parts of its buffers, in order; nothing is copied."""
        bounds = np.searchsorted(self.rows, np.arange(n + 1)).tolist()
        kinds, starts = self.kinds.tolist(), self.starts.tolist()
        ends = (self.starts + self.sizes).tolist()
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            yield [self.buffers[kinds[k]][starts[k] : ends[k]] for k in range(a, b)]

    def digests(self, n: int) -> list[str]:
        """sha256 of each row, streamed."""
        found = []
        for parts in self.streams(n):
            digest = hashlib.sha256()
            for part in parts:
                digest.update(part)
            found.append(digest.hexdigest())
        return found

    def strings(self, n: int) -> pa.Array:
        return pa.array([b"".join(parts) for parts in self.streams(n)], pa.binary()).cast(pa.string())


def _units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ends of the words, the index of the first word of each row, and the units of each row.

    A unit is a word with the white space before it; white space after the last word is one more.
    """
    _, ends, first = words(data, offsets, ~IS_SPACE)
    n_words = np.diff(first)
    sizes = np.diff(offsets)
    last = IS_SPACE[data[np.maximum(offsets[1:] - 1, 0)]] if len(data) else np.zeros(len(sizes), bool)
    return ends, first, n_words + ((sizes > 0) & last)


def _choices(batch: pa.RecordBatch, id_column: str, text_column: str, recipe: Recipe):
    """The cut table of a batch, and per row: units, form and the two places of the cuts."""
    data, offsets = joined_bytes(batch.column(text_column))
    table = PieceTable.whole(memoryview(data), memoryview(b"".join(recipe.marks)), offsets)
    ends, first, units = _units(data, offsets)
    rows = len(offsets) - 1
    draws = np.array([recipe.draws(k) for k in batch.column(id_column).to_pylist()], np.int64).reshape(rows, 4)
    raw = data.tobytes()
    bounds = offsets.tolist()
    marked = np.array(
        [any(raw.find(m, a, b) >= 0 for m in recipe.marks) for a, b in zip(bounds[:-1], bounds[1:], strict=True)],
        dtype=bool,
    )
    plain = (np.diff(offsets) == 0) | marked | (draws[:, 2] % 100 >= recipe.rate)
    forms = np.where(plain, 0, np.where(draws[:, 3] % 100 < recipe.spm_rate, 2, 1))
    picks = np.sort(draws[:, :2] % (units + 1)[:, None], axis=1)

    def place(k: np.ndarray) -> np.ndarray:
        # the end of the k-th unit: of a word, or of the row
        inner = (k > 0) & (k <= np.diff(first))
        out = np.where(k == 0, offsets[:-1], offsets[1:])
        out[inner] = ends[first[:-1][inner] + k[inner] - 1]
        return out

    starts, stops = place(picks[:, 0]), place(picks[:, 1])
    return table.cut(forms > 0, starts, stops), data, offsets, units, forms, starts, stops


def _arranging(id_column: str, text_column: str, recipe: Recipe, digest: bool):
    """Step: output and form of every row, and the figures about its cuts."""

    def step(batches: Batches) -> Batches:
        for batch in pieces(batches, text_column):
            cut, data, offsets, units, forms, starts, stops = _choices(batch, id_column, text_column, recipe)
            n = len(units)
            done = cut.arranged(forms, recipe.marks)
            # code points: bytes that do not continue one
            points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
            shown = forms > 0
            columns = {
                id_column: batch.column(id_column),
                "n": pa.array(units.astype(np.int64)),
                "form": pa.array([FORMS[f] for f in forms], pa.string()),
                "prefix_chars": pa.array(points[starts] - points[offsets[:-1]], pa.int64(), mask=~shown),
                "middle_chars": pa.array(points[stops] - points[starts], pa.int64(), mask=~shown),
                "output": done.strings(n),
            }
            if digest:
                columns["output_sha256"] = pa.array(done.digests(n), pa.string())
            yield pa.record_batch(list(columns.values()), names=list(columns))

    return step


def _parts(texts: pa.Array, forms: np.ndarray, recipe: Recipe) -> PieceTable:
    """The parts of outputs, found between their sentinels, as a piece table over the outputs."""
    data, offsets = joined_bytes(texts)
    raw, marks = data.tobytes(), recipe.marks
    rows, starts, sizes = [], [], []
    for row, form in enumerate(forms):
        place, end = int(offsets[row]), int(offsets[row + 1])
        order = ORDERS.get(FORMS[form], ())
        edges = []
        for part in order:
            found = raw.find(marks[part], place, end)
            if found < 0:
                raise ValueError(f"an output of form {FORMS[form]} lacks a sentinel")
            edges.append((found, found + len(marks[part])))
            place = edges[-1][1]
        begins = [e[1] for e in edges] or [place]
        stops = [*(e[0] for e in edges[1:]), end]
        rows += [row] * len(begins)
        starts += begins
        sizes += [b - a for a, b in zip(begins, stops, strict=True)]
    kinds = np.zeros(len(rows), np.int8)
    return PieceTable(
        memoryview(data), memoryview(b""), np.array(rows, int), kinds, np.array(starts, int), np.array(sizes, int)
    )


def _codes(forms: pa.Array) -> np.ndarray:
    return np.array([FORMS.index(f) if f is not None else 0 for f in forms.to_pylist()], dtype=int)


def _restoring(recipe: Recipe, digest: bool):
    """Step: the output gives way to the text rebuilt from it, or to the digest of that text."""

    def step(batches: Batches) -> Batches:
        for batch in pieces(batches, "output"):
            forms = _codes(batch.column("form"))
            back = _parts(batch.column("output"), forms, recipe).restored(forms)
            name, made = ("restored_sha256", pa.array(back.digests(len(forms)), pa.string())) if digest else (
                "text", back.strings(len(forms)))
            kept = batch.drop_columns(["output", "form"]) if not digest else batch.drop_columns(["output"])
            yield kept.append_column(name, made)

    return step


_FIGURES = "n long, form string, prefix_chars long, middle_chars long"


def transform(
    docs: DataFrame, recipe: Recipe | None = None, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Every row cut at two units and arranged: id, n, form, prefix_chars, middle_chars, output.

    The cuts and the form come from a digest of the seed and the id, so copies of an id are cut
    alike and no order matters. A null text counts as empty; empty texts and texts that hold a
    sentinel stay plain; a null id is drawn for as an empty string. Rows are independent: repeated
    rows are kept, further columns are not read, an empty table gives an empty result.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    steps = [_arranging(id_column, text_column, recipe or Recipe(), digest=False)]
    return fused(docs, [id_column, text_column], steps, f"`{id_column}` {kind}, {_FIGURES}, output string")


def restore(made: DataFrame, recipe: Recipe | None = None, id_column: str = "doc_id") -> DataFrame:
    """The id column and `text` of every row of `transform`, from `form` and `output` alone."""
    kind = made.schema[id_column].dataType.simpleString()
    steps = [_restoring(recipe or Recipe(), digest=False)]
    return fused(made, [id_column, "form", "output"], steps, f"`{id_column}` {kind}, text string")


def digests(
    docs: DataFrame, recipe: Recipe | None = None, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """The figures of `transform`, with digests of the outputs and of the texts rebuilt from them."""
    recipe = recipe or Recipe()
    kind = docs.schema[id_column].dataType.simpleString()
    steps = [_arranging(id_column, text_column, recipe, digest=True), _restoring(recipe, digest=True)]
    schema = f"`{id_column}` {kind}, {_FIGURES}, output_sha256 string, restored_sha256 string"
    return fused(docs, [id_column, text_column], steps, schema)
