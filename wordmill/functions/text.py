"""Formatting of hit columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def truncate(text: Column, maxlen: int = 80) -> Column:
    """Newlines become spaces; a text over `maxlen` characters is cut and marked."""
    flat = F.translate(text, "\n", " ")
    return F.when(F.length(text) > maxlen, F.concat(F.substring(flat, 1, maxlen), F.lit("..."))).otherwise(flat)


def first_line(text: Column) -> Column:
    return F.substring_index(text, "\n", 1)


def display_date(*candidates: Column) -> Column:
    """The first readable date among the candidates, as yyyy-MM-dd; null if none is."""
    read = [F.try_to_timestamp(c.cast("string")) for c in candidates]
    return F.date_format(F.coalesce(*read), "yyyy-MM-dd")


def hit_path(index: str, doc_type: Column | str, doc_id: Column) -> Column:
    """`/index/type/id`."""
    kind = F.lit(doc_type) if isinstance(doc_type, str) else doc_type
    return F.concat_ws("/", F.lit(""), F.lit(index), kind, doc_id.cast("string"))


def catch_all(schema: T.StructType, skip: tuple[str, ...] = ()) -> str:
    """SQL text that joins every field, in schema order, with arrays flattened."""
    parts = []
    for field in schema:
        if field.name in skip:
            continue
        name = f"`{field.name}`"
        parts.append(_as_text(name, field.dataType))
    return f"concat_ws(' ', {', '.join(parts)})"


def _as_text(path: str, kind: T.DataType) -> str:
    if isinstance(kind, T.StructType):
        inner = [_as_text(f"{path}.`{f.name}`", f.dataType) for f in kind]
        return f"concat_ws(' ', {', '.join(inner)})"
    if isinstance(kind, T.ArrayType):
        return f"array_join(cast({path} as array<string>), ' ')"
    return f"cast({path} as string)"
