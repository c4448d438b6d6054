"""Field mappings: which text of a document is searched, and how it is analyzed."""

from __future__ import annotations

import json
from dataclasses import dataclass, field, replace

from pyspark.sql import types as T

from wordmill.functions.chains import Chain, analyzer
from wordmill.functions.text import catch_all

ALL_FIELD = "_all"


@dataclass(frozen=True)
class FieldSpec:
    """One searchable field.

    `source` is the SQL text of the value (default: the column of the same name), so
    two fields may read one column. Without an `analyzer` the field is a keyword and
    is compared as it is, or after lower-casing and folding if `normalized`.
    """

    name: str
    source: str | None = None
    analyzer: str | Chain | None = "standard"
    boost: float = 1.0
    normalized: bool = False

    @property
    def expression(self) -> str:
        return self.source or ".".join(f"`{part}`" for part in self.name.split("."))

    @property
    def is_text(self) -> bool:
        return self.analyzer is not None

    @property
    def chain(self) -> Chain:
        return analyzer(self.analyzer)

    @property
    def analyzer_name(self) -> str:
        if self.analyzer is None:
            return "lower_ascii" if self.normalized else "keyword"
        return self.analyzer if isinstance(self.analyzer, str) else "custom"


@dataclass(frozen=True)
class Mapping:
    """The fields of an index, its key column and its optional type column."""

    fields: tuple[FieldSpec, ...]
    key: str = "doc_id"
    type_column: str | None = None
    columns: dict[str, str] = field(default_factory=dict)

    def get(self, name: str) -> FieldSpec | None:
        return next((f for f in self.fields if f.name == name), None)

    def field(self, name: str) -> FieldSpec:
        found = self.get(name)
        if found is None:
            raise ValueError(f"no field {name!r}; fields are {[f.name for f in self.fields]}")
        return found

    @property
    def text_fields(self) -> tuple[FieldSpec, ...]:
        return tuple(f for f in self.fields if f.is_text)

    def with_catch_all(self, schema: T.StructType, analyzer: str | Chain = "standard") -> Mapping:
        """Add the `_all` field, which joins every column but the key."""
        spec = FieldSpec(ALL_FIELD, catch_all(schema, skip=(self.key,)), analyzer)
        return replace(self, fields=(*self.fields, spec))

    def schema(self) -> T.StructType:
        """The document schema declared by `columns` (name -> SQL type)."""
        declared = ", ".join(f"`{name}` {kind}" for name, kind in self.columns.items())
        return T.StructType.fromDDL(declared)

    def to_json(self) -> str:
        specs = [
            {
                "name": f.name,
                "source": f.source,
                "analyzer": f.analyzer.describe() if isinstance(f.analyzer, Chain) else f.analyzer,
                "boost": f.boost,
                "normalized": f.normalized,
            }
            for f in self.fields
        ]
        return json.dumps(
            {"fields": specs, "key": self.key, "type_column": self.type_column, "columns": self.columns}
        )

    @classmethod
    def from_json(cls, text: str) -> Mapping:
        data = json.loads(text)
        specs = []
        for spec in data["fields"]:
            if isinstance(spec["analyzer"], list):
                spec["analyzer"] = Chain.from_description(spec["analyzer"])
            specs.append(FieldSpec(**spec))
        return cls(tuple(specs), data["key"], data["type_column"], data["columns"])


def entry_mapping() -> Mapping:
    """The default mapping: boosted content, a case-keeping second reading of it, and
    the id of the document that the entry belongs to."""
    return Mapping(
        fields=(
            FieldSpec("content", analyzer="standard", boost=3.0),
            FieldSpec("content.raw", source="`content`", analyzer="case_sensitive_text"),
            FieldSpec("kb_document_id", analyzer=None),
        ),
        key="_id",
        columns={"_id": "string", "kb_document_id": "string", "content": "string"},
    )
