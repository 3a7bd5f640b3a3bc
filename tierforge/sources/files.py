"""CSV and table readers."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column as SparkColumn
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierforge.contract import Contract
from tierforge.functions.names import quoted

_RECORD, _REASON = "__csv_record", "__csv_reason"
_ABSENT = {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}


def csv_scan(
    spark: SparkSession,
    path: str | Sequence[str],
    glob: str = "*.csv",
    columns: Sequence[str] | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """All files below ``path`` whose name matches ``glob``, every column a string.

    Spark pairs CSV columns by position. ``enforceSchema=False`` makes it compare each
    file's header with the expected names first, so a file with swapped headers fails
    instead of being read swapped; ``text_sheets`` reads such files by name. The names come
    from ``columns``, else from the files. Given ``columns``, a folder without matching files
    is an empty table.

    Quotes within cells are doubled, as spreadsheet exports write them; ``options`` may say
    otherwise, and are passed to the reader.
    """
    reader = (
        spark.read.option("header", True)
        .option("enforceSchema", False)
        .option("escape", '"')
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .options(**(options or {}))
    )
    if columns is not None:
        reader = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    return reader.csv(path if isinstance(path, str) else list(path))


def csv_quarantine(
    spark: SparkSession,
    path: str | Sequence[str],
    glob: str = "*.csv",
    columns: Sequence[str] = (),
    options: Mapping[str, str] | None = None,
    short: str = "pad",
) -> tuple[DataFrame, DataFrame]:
    """The rows that fit ``columns``, as ``csv_scan`` reads them, and those that do not.

    The latter are ``path, cells, record, reason``: ``surplus cells`` where a row has more cells than
    there are columns and one of the surplus ones holds something (``csv_scan`` would drop it), and,
    with ``short="quarantine"``, ``missing cells`` where it has fewer; ``short="pad"`` fills those with
    NULL. Both frames filter one scan: each record's cells are counted by Spark's parser, and only
    records with another count are looked at again.
    """
    if short not in ("pad", "quarantine"):
        raise ValueError(f"unknown way with short rows: {short!r}")
    if not columns:
        raise ValueError("which columns a row should have must be given")
    options = {k.lower(): v for k, v in (options or {}).items()}
    names = [T.StructField(c, T.StringType()) for c in (*columns, _RECORD)]
    rows = (
        spark.read.schema(T.StructType(names))
        .option("header", True)
        .option("enforceSchema", False)
        .option("escape", '"')
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .options(**options)
        .options(mode="PERMISSIVE", columnNameOfCorruptRecord=_RECORD, columnPruning=False)
        .csv(path if isinstance(path, str) else list(path))
    )
    separator = options.get("sep", options.get("delimiter", ","))
    quote = re.escape(options.get("quote", '"'))
    # A cell is quoted from its first character on, or not at all.
    cell = rf"(^|{re.escape(separator)}){quote}[^{quote}]*+(?:{quote}{quote}[^{quote}]*+)*+{quote}"

    def separators(record: SparkColumn) -> SparkColumn:
        plain = F.regexp_replace(record, cell, "$1")
        return F.regexp_count(plain, F.lit(re.escape(separator)))

    record = quoted(_RECORD)
    # Without empty cells at its end, a record that is too long ends in one that holds something.
    # Spark refuses a query of the records alone, so a cell is always looked at too.
    looked_at = F.length(F.coalesce(quoted(columns[0]), F.lit(""))) >= 0
    surplus = looked_at & (separators(F.rtrim(record, F.lit(separator))) >= len(columns))
    missing = separators(record) < len(columns) - 1
    reason = F.when(record.isNull(), F.lit(None)).when(surplus, "surplus cells")
    if short == "quarantine":
        reason = reason.when(missing, "missing cells")
    marked = rows.withColumn(_REASON, reason)
    cells = [quoted(c) for c in columns]
    bad = marked.where(quoted(_REASON).isNotNull()).select(
        F.col("_metadata.file_path").alias("path"),
        F.array(*cells).alias("cells"),
        record.alias("record"),
        quoted(_REASON).alias("reason"),
    )
    return marked.where(quoted(_REASON).isNull()).select(*cells), bad


def table_scan(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    partition_types: Mapping[str, T.DataType] | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """The table stored at ``path``.

    Partition columns are typed by what their values look like, so that the text ``007``
    would come back as the number 7; ``partition_types`` says what they are.
    """
    table = spark.read.format(fmt).options(**(options or {})).load(path)
    types = partition_types or {}
    if all(f.dataType == types.get(f.name, f.dataType) for f in table.schema):
        return table
    fields = [T.StructField(f.name, types.get(f.name, f.dataType)) for f in table.schema]
    typed = spark.read.format(fmt).options(**(options or {})).schema(T.StructType(fields))
    return typed.load(path)


def read_if_exists(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    partition_types: Mapping[str, T.DataType] | None = None,
) -> DataFrame | None:
    """The table at ``path``, or None where nothing has been written yet."""
    try:
        return table_scan(spark, path, fmt, partition_types)
    except AnalysisException as missing:
        if missing.getCondition() in _ABSENT:
            return None
        raise


def contract_scan(
    spark: SparkSession,
    contract: Contract,
    roots: Mapping[str, str],
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Read a contract's source: ``source.format`` below the root named by ``location_ref``.

    CSV roots hold loose files picked by the contract's glob; for every other format the
    root holds one folder per table.
    """
    root = contract_root(contract, roots)
    if contract.source_format == "csv":
        return csv_scan(spark, root, contract.glob, columns, contract.reader_options)
    return table_scan(
        spark,
        f"{root.rstrip('/')}/{contract.table}",
        contract.source_format,
        {c.name: c.spark_type for c in contract.columns if c.name in contract.partitions},
        contract.reader_options,
    )


def contract_root(contract: Contract, roots: Mapping[str, str]) -> str:
    """The root that a contract's source is below."""
    if contract.location not in roots:
        raise ValueError(f"{contract.table}: no root is given for location {contract.location!r}")
    return roots[contract.location]
