"""Table contracts: which columns a table has, under which name, of which type.

Two spellings are in use and both are accepted by :meth:`Contract.from_dict`:

* ``schema.columns`` as a list of ``{name, source, type, nullable, description}`` next to
  ``keys``, ``partitions`` and ``source.filename_glob``;
* ``columns`` as a mapping ``name -> {type, source, default}`` next to ``primary_keys``,
  ``write_mode``, ``source.file_pattern`` and the switches ``options.audit_columns`` and
  ``options.deduplicate_on_keys``.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import types as T

AUDIT_COLUMN = "ingest_ts"

SPARK_TYPES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "integer": T.IntegerType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "float": T.DoubleType(),  # both spellings mean a 64-bit float
    "boolean": T.BooleanType(),
    "date": T.DateType(),
}

_SWITCHES = ("audit_columns", "deduplicate_on_keys")


@dataclass(frozen=True)
class Column:
    name: str
    type: str
    source: str | None = None
    nullable: bool = True
    default: Any = None
    description: str | None = None

    @property
    def spark_type(self) -> T.DataType | None:
        """Type to cast to, or None where the contract names a type we pass through."""
        return SPARK_TYPES.get(self.type.lower())


@dataclass(frozen=True)
class Contract:
    table: str
    columns: tuple[Column, ...] = ()
    keys: tuple[str, ...] = ()
    partitions: tuple[str, ...] = ()
    layer: str | None = None
    source_format: str = "csv"
    location: str | None = None
    glob: str = "*.csv"
    reader_options: Mapping[str, str] = field(default_factory=dict)
    write_mode: str = "merge"
    audit: bool = True
    dedupe: bool = True

    def __post_init__(self) -> None:
        _reject_duplicates("column", (c.name for c in self.columns), self.table)
        headers = (c.source for c in self.columns if c.source)
        _reject_duplicates("source header", headers, self.table)
        if self.write_mode not in ("merge", "overwrite"):
            raise ValueError(f"{self.table}: unknown write mode {self.write_mode!r}")
        if self.write_mode == "merge" and not self.keys:
            raise ValueError(f"{self.table}: write mode 'merge' needs at least one key column")
        if self.columns:
            known = {c.name for c in self.columns}
            for what, names in (("key", self.keys), ("partition", self.partitions)):
                missing = [n for n in names if n not in known]
                if missing:
                    raise ValueError(f"{self.table}: {what} columns {missing} are not declared")

    @classmethod
    def from_dict(cls, cfg: Mapping[str, Any]) -> Contract:
        source = cfg.get("source") or {}
        options = dict(cfg.get("options") or {})
        keys = tuple(cfg.get("keys") or cfg.get("primary_keys") or ())
        columns = (cfg.get("schema") or {}).get("columns") or cfg.get("columns") or ()
        if isinstance(columns, Mapping):
            columns = [{"name": name, **spec} for name, spec in columns.items()]
        return cls(
            table=cfg["table"],
            columns=tuple(
                Column(
                    name=c["name"],
                    type=c["type"],
                    source=c.get("source"),
                    nullable=c.get("nullable", True),
                    default=c.get("default"),
                    description=c.get("description"),
                )
                for c in columns
            ),
            keys=keys,
            partitions=tuple(cfg.get("partitions") or ()),
            layer=cfg.get("layer"),
            source_format=source.get("format", "csv"),
            location=source.get("location_ref"),
            glob=source.get("filename_glob") or source.get("file_pattern") or "*.csv",
            reader_options={k: _option(v) for k, v in options.items() if k not in _SWITCHES},
            write_mode=cfg.get("write_mode") or ("merge" if keys else "overwrite"),
            audit=options.get("audit_columns", True),
            dedupe=options.get("deduplicate_on_keys", True),
        )

    @property
    def required(self) -> list[str]:
        """Columns that must not be NULL: those declared so, and the keys."""
        names = [c.name for c in self.columns if not c.nullable or c.name in self.keys]
        return names + [k for k in self.keys if k not in names]

    @property
    def headers(self) -> list[str]:
        """Header names expected in a source file, in contract order."""
        return [c.source or c.name for c in self.columns if c.source or c.default is None]

    def struct(self, audit: bool | None = None) -> T.StructType:
        """Schema of the stored table, audit column included where the contract asks for it."""
        unknown = [c.name for c in self.columns if c.spark_type is None]
        if unknown:
            raise ValueError(f"{self.table}: no Spark type for columns {unknown}")
        fields = [T.StructField(c.name, c.spark_type, c.nullable) for c in self.columns]
        if self.audit if audit is None else audit:
            fields.append(T.StructField(AUDIT_COLUMN, T.TimestampType()))
        return T.StructType(fields)


def _option(value: Any) -> str:
    return str(value).lower() if isinstance(value, bool) else str(value)


def _reject_duplicates(what: str, names: Iterable[str], table: str) -> None:
    # Spark resolves names without regard to case, so 'A' and 'a' collide as well.
    repeated = [n for n, k in Counter(n.lower() for n in names).items() if k > 1]
    if repeated:
        raise ValueError(f"{table}: {what} names repeat: {repeated}")
