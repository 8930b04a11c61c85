"""Table declarations: ordered columns with types, keys, lineage and publishing rules."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# A declared type is a Spark type name, or "time" for text in HH:mm:ss.
_STORED = {"time": "string"}


@dataclass(frozen=True)
class TableSpec:
    """One warehouse table. Every operator takes its keys and columns from here or as arguments."""

    name: str
    area: str
    columns: dict[str, str]
    surrogate: str
    natural: tuple[str, ...]
    compare: tuple[str, ...] = ()
    identity: str | None = None
    unknown_text: tuple[str, ...] = ()
    partition: str | None = None
    topic: str | None = None
    topic_key: str | None = None
    lineage: str = "source"
    loaded_at: str = "created_at"
    foreign: tuple[str, ...] = field(default=())

    @property
    def preserved(self) -> tuple[str, ...]:
        """Columns an update keeps from the stored row."""
        ids = (self.identity,) if self.identity else ()
        return (self.surrogate, *ids, self.lineage, self.loaded_at)

    @property
    def qualified(self) -> str:
        return f"{self.area}.{self.name}"

    def schema(self) -> T.StructType:
        ddl = ", ".join(f"`{c}` {_STORED.get(t, t)}" for c, t in self.columns.items())
        return T.StructType.fromDDL(ddl)

    def text_schema(self) -> T.StructType:
        """All columns as text: the shape of CSV cells and of parsed messages."""
        return T.StructType([T.StructField(c, T.StringType()) for c in self.columns])
