"""SQL statements that store tables: MERGE, CREATE OR REPLACE, CREATE IF NOT EXISTS.

Spark parses a statement and says what it is; its query is run by Spark, and the table it names is
written by the sinks of this library, so that the statement works on tables without a catalog and
without a format that has a MERGE of its own. What such a table cannot do as written raises
``UnsupportedStatement`` before anything is written.

Tables are named by path, as ``delta.`/lake/silver/products` ``. Whatever format a statement
names, tables stored by this library are found there and read as they are; what is new is stored
in the format named, with ``delta`` meaning a published Parquet table. Other paths are read by
Spark as files.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tierforge.sinks.snapshots import newest, published_names, read_snapshot, read_table
from tierforge.sinks.tables import create_or_replace, create_table, upsert_table

# What a table may be declared as, and how it is stored. Fixed values.
_STORED_AS = {"delta": "parquet", "parquet": "parquet", "orc": "orc"}
# A string or a comment, left alone; or a table named by format and path.
_PATH_TABLE = re.compile(
    r"""'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|--[^\n]*|/\*.*?\*/"""
    r"""|\b(?P<fmt>delta|parquet|orc)\s*\.\s*`(?P<path>(?:[^`]|``)+)`""",
    re.DOTALL | re.IGNORECASE,
)


class UnsupportedStatement(ValueError):
    """The statement is sound SQL, but not one that tables of this library can carry out."""


def run_statement(
    spark: SparkSession,
    text: str,
    relations: Mapping[str, DataFrame] | None = None,
    values: Mapping[str, Any] | None = None,
    paths: Mapping[str, str] | None = None,
) -> DataFrame:
    """Run one statement; returns its rows, or those of the table it has written.

    ``{name}`` stands for a DataFrame of ``relations``, ``:name`` for a value, which is bound, and
    within the path of a table ``{name}`` for a text of ``paths``. All other braces are SQL.

    ``MERGE INTO t USING s ON t.k = s.k [AND ...] WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED
    THEN INSERT *`` is an upsert by the keys compared; lists of columns may take the place of the
    stars if both name the same ones and take them from the source under their own names. A source
    key that repeats raises. A target that does not exist is created. With ``WITH SCHEMA EVOLUTION``
    columns that only the source has are added.

    ``CREATE [OR REPLACE] TABLE [IF NOT EXISTS] t [USING f] [PARTITIONED BY (c, ...)] AS query``
    and, with columns in place of a query, ``CREATE TABLE IF NOT EXISTS t (c type, ...)`` store a
    table. A query returns its rows. All else raises.
    """
    statement = _Statement(spark, text, dict(relations or {}), dict(values or {}), dict(paths or {}))
    try:
        return statement.run()
    finally:
        for view in statement.views:
            spark.catalog.dropTempView(view)


class _Statement:
    """A statement whose tables have got names of their own."""

    def __init__(self, spark: SparkSession, text: str, relations: dict, values: dict, paths: dict):
        self.spark, self.values, self.paths = spark, values, paths
        self.views: list[str] = []
        self.tables: dict[str, tuple[str, str]] = {}
        for name, rows in relations.items():
            view = self._view(rows)
            text = text.replace("{" + name + "}", view)
        self.text = _PATH_TABLE.sub(self._named, text)
        self.plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(self.text)

    def run(self) -> DataFrame:
        kind = _kind(self.plan)
        if kind == "MergeIntoTable":
            return self._merge()
        if kind in ("ReplaceTableAsSelect", "CreateTableAsSelect"):
            return self._store()
        if kind == "CreateTable":
            return self._create()
        logical = "org.apache.spark.sql.catalyst.plans.logical."
        for other in ("Command", "ParsedStatement"):
            if self.spark._jvm.java.lang.Class.forName(logical + other).isInstance(self.plan):
                raise UnsupportedStatement(f"{kind} is not a statement this library carries out")
        return self._query(self.text)

    def _view(self, rows: DataFrame) -> str:
        view = f"rows_{uuid.uuid4().hex}"
        rows.createOrReplaceTempView(view)
        self.views.append(view)
        return view

    def _named(self, match: re.Match) -> str:
        """A table given by its path gets a name, behind which are its rows if it is one of ours."""
        if match["path"] is None:
            return match[0]
        path = match["path"].replace("``", "`")
        for name, value in self.paths.items():
            path = path.replace("{" + name + "}", value.rstrip("/"))
        root, _, table = path.rstrip("/").rpartition("/")
        at = newest(self.spark, root, table) if published_names(self.spark, root, table) else None
        if at is None:
            view = f"table_{uuid.uuid4().hex}"
            self.tables[view] = (root, table)
            if match["fmt"].lower() == "delta":
                return view
            # Files of others; as a target, the name still says where.
            return f"{match['fmt']}.`{path.replace('`', '``')}`"
        view = self._view(read_snapshot(self.spark, root, table, at))
        self.tables[view] = (root, table)
        return view

    def _query(self, text: str) -> DataFrame:
        for name, place in self.tables.items():
            if name not in self.views and name in text:
                raise LookupError(f"no table {place[1]} below {place[0]}")
        return self.spark.sql(text, args=self.values)

    def _part(self, node) -> str:
        """The text that a part of the plan was made from."""
        origin = node.origin()
        return self.text[origin.startIndex().get() : origin.stopIndex().get() + 1]

    def _place(self, node) -> tuple[str, str]:
        parts = _strings(node.nameParts() if _kind(node) == "UnresolvedIdentifier" else node.multipartIdentifier())
        if len(parts) == 1 and parts[0] in self.tables:
            return self.tables[parts[0]]
        if len(parts) == 2 and parts[0].lower() in _STORED_AS:
            root, _, table = parts[1].rstrip("/").rpartition("/")
            return root, table
        raise UnsupportedStatement(f"{'.'.join(parts)} is not a table named by its path")

    # --- MERGE ----------------------------------------------------------------------------------

    def _merge(self) -> DataFrame:
        plan = self.plan
        target, target_name = _aliased(plan.targetTable())
        source, source_name = _aliased(plan.sourceTable())
        root, table = self._place(target)
        keys = self._keys(plan.mergeCondition(), target_name, source_name)
        if plan.notMatchedBySourceActions().size():
            raise UnsupportedStatement("WHEN NOT MATCHED BY SOURCE")
        update = self._action(plan.matchedActions(), "Update", "WHEN MATCHED", target_name, source_name)
        insert = self._action(plan.notMatchedActions(), "Insert", "WHEN NOT MATCHED", target_name, source_name)
        text = self._part(source)
        rows = self._query(f"SELECT * FROM {text}" if _kind(source) == "UnresolvedRelation" else text)
        if update is not None or insert is not None:
            on = {k.lower() for k in keys}
            set_by = [{n.lower() for n in names or ()} for names in (update, insert)]
            if not (set_by[0] and on <= set_by[1] and set_by[0] | on == set_by[1]):
                raise UnsupportedStatement("UPDATE and INSERT must set the same columns, keys too")
            rows = rows.select(*insert)
        upsert_table(
            rows, table, root, keys, duplicates="raise", add_columns=plan.withSchemaEvolution()
        )
        return read_table(self.spark, root, table)

    def _keys(self, condition, target: str, source: str) -> list[str]:
        if _kind(condition) == "And":
            return self._keys(condition.left(), target, source) + self._keys(
                condition.right(), target, source
            )
        if _kind(condition) == "EqualTo":
            sides = dict(map(_column, (condition.left(), condition.right())))
            if set(sides) == {target.lower(), source.lower()} and len(set(map(str.lower, sides.values()))) == 1:
                return [sides[target.lower()]]
        raise UnsupportedStatement(
            f"ON {self._part(condition)}: only equal columns of the same name can be compared"
        )

    def _action(self, actions, kind: str, clause: str, target: str, source: str) -> list[str] | None:
        """The columns an action sets; None for all."""
        if actions.size() != 1:
            raise UnsupportedStatement(f"one {clause} THEN {kind.upper()} is needed")
        action = actions.apply(0)
        if action.condition().isDefined() or _kind(action) not in (f"{kind}Action", f"{kind}StarAction"):
            raise UnsupportedStatement(f"{clause}: only {kind.upper()} without a condition")
        if _kind(action) == f"{kind}StarAction":
            return None
        names = []
        for k in range(action.assignments().size()):
            assignment = action.assignments().apply(k)
            (side, name), (other, value) = _column(assignment.key()), _column(assignment.value())
            if side not in ("", target.lower()) or other != source.lower() or name.lower() != value.lower():
                raise UnsupportedStatement(f"{clause}: {name} must be set to the source's {name}")
            names.append(value)
        return names

    # --- CREATE ---------------------------------------------------------------------------------

    def _store(self) -> DataFrame:
        plan = self.plan
        root, table = self._place(plan.name())
        there = newest(self.spark, root, table) is not None
        replace = _kind(plan) == "ReplaceTableAsSelect"
        if replace and not plan.orCreate() and not there:
            raise LookupError(f"no table {table} below {root}")
        if not replace and there:
            if not plan.ignoreIfExists():
                raise ValueError(f"there is a table {table} below {root}")
            return read_table(self.spark, root, table)
        rows = self._query(self._part(plan.query()))
        create_or_replace(rows, table, root, self._format(), self._partitions(rows.columns))
        return read_table(self.spark, root, table)

    def _create(self) -> DataFrame:
        plan = self.plan
        root, table = self._place(plan.name())
        if not plan.ignoreIfExists() and newest(self.spark, root, table) is not None:
            raise ValueError(f"there is a table {table} below {root}")
        fields = []
        for k in range(plan.columns().size()):
            column = plan.columns().apply(k)
            if not column.nullable() or column.defaultValue().isDefined():
                raise UnsupportedStatement(f"{column.name()}: NOT NULL and DEFAULT are not kept")
            kind = T._parse_datatype_json_string(column.dataType().json())
            fields.append(T.StructField(column.name(), kind))
        schema = T.StructType(fields)
        create_table(self.spark, table, root, schema, self._format(), self._partitions(schema.names))
        return read_table(self.spark, root, table)

    def _format(self) -> str:
        spec = self.plan.tableSpec()
        provider = spec.provider().get() if spec.provider().isDefined() else "parquet"
        if provider.lower() not in _STORED_AS:
            raise UnsupportedStatement(f"USING {provider}")
        if spec.location().isDefined():
            raise UnsupportedStatement("LOCATION: the table's name is its path")
        return _STORED_AS[provider.lower()]

    def _partitions(self, columns: list[str]) -> list[str]:
        known, names = {c.lower(): c for c in columns}, []
        transforms = self.plan.partitioning()
        for k in range(transforms.size()):
            transform = transforms.apply(k)
            if _kind(transform) != "IdentityTransform" or transform.describe().strip("`").lower() not in known:
                raise UnsupportedStatement(f"PARTITIONED BY {transform.describe()}")
            names.append(known[transform.describe().strip("`").lower()])
        return names


def _kind(node) -> str:
    return node.getClass().getSimpleName()


def _strings(parts) -> list[str]:
    return [parts.apply(k) for k in range(parts.size())]


def _aliased(node) -> tuple[Any, str]:
    """A relation without its alias, and the name its columns go by."""
    name = None
    if _kind(node) == "SubqueryAlias":
        name, node = node.alias(), node.child()
    if _kind(node) == "UnresolvedRelation":
        return node, name or _strings(node.multipartIdentifier())[-1]
    if name is None or _kind(node) in ("UnresolvedSubqueryColumnAliases", "SubqueryAlias"):
        raise UnsupportedStatement("a MERGE's source needs an alias, without column names")
    return node, name


def _column(node) -> tuple[str, str]:
    """What a column is qualified by, in small letters, and its name."""
    parts = _strings(node.nameParts()) if _kind(node) == "UnresolvedAttribute" else []
    if not parts:
        return "?", "?"
    return (parts[-2].lower() if len(parts) > 1 else ""), parts[-1]


__all__ = ["UnsupportedStatement", "run_statement"]
