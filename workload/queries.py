"""One query per operator, each over the whole of the given tables.

Where an operator needs keys that match only in part, they come from doubling or shifting a
key of the whole table, never from leaving rows out.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Iterator
from dataclasses import replace

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierforge.contract import Column, Contract
from tierforge.functions import na_to_null, slug
from tierforge.operators import (
    add_audit,
    conform,
    dedupe_on_keys,
    merge_rows,
    split_not_null,
)
from tierforge.plans import (
    bronze_load,
    bronze_rows,
    exported_scan,
    fact_rows,
    load_bronze,
    load_facts,
    load_from_template,
    load_gold,
    load_silver,
    refresh_gold,
    run_statement,
    run_template,
    sales_summary,
    silver_merge,
    spreadsheet_ingest,
    touched_days,
)
from tierforge.scratch import scratch_dir, stage
from tierforge.sinks import (
    create_if_missing,
    export_files,
    export_sheets,
    overwrite,
    read_table,
    upsert_partitions,
    upsert_path,
    upsert_table,
    write_by_contract,
)
from tierforge.sources import (
    contract_scan,
    csv_quarantine,
    csv_scan,
    parse_files,
    table_scan,
    text_sheets,
)
from tierforge.streaming import bronze_stream
from workload.books import pack

Query = Callable[[SparkSession, str], DataFrame]

# A load time that is the same on every run.
LOADED_AT = dt.datetime(2024, 1, 1)

# Tables, columns, source headers and types as the sources of the layers have them.
PRODUCT = Contract.from_dict(
    {
        "table": "dim_product",
        "source": {"format": "csv", "location_ref": "landing", "filename_glob": "*.csv"},
        "schema": {
            "columns": [
                {"name": "product_id", "source": "商品ID", "type": "string", "nullable": False},
                {"name": "product_name", "source": "商品名", "type": "string", "nullable": False},
                {"name": "category", "source": "カテゴリ", "type": "string"},
                {"name": "brand", "source": "メーカー", "type": "string"},
            ]
        },
        "keys": ["product_id"],
        "options": {"header": True, "inferSchema": False},
    }
)
SALES = Contract.from_dict(
    {
        "table": "fact_sales",
        "source": {"format": "csv", "location_ref": "landing"},
        "schema": {
            "columns": [
                {"name": "sales_id", "source": "売上ID", "type": "string", "nullable": False},
                {"name": "product_id", "source": "商品ID", "type": "string", "nullable": False},
                {"name": "quantity", "source": "数量", "type": "int", "nullable": False},
                {"name": "price", "source": "価格", "type": "double", "nullable": False},
                {"name": "sales_date", "source": "売上日", "type": "date", "nullable": False},
            ]
        },
        "keys": ["sales_id"],
        "partitions": ["sales_date"],
    }
)


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _fact_columns() -> list[F.Column]:
    return [
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_shipdate").cast("date").alias("sales_date"),
    ]


def _facts(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, sf, "lineitem").select(*_fact_columns())


def _products(spark: SparkSession, sf: str, factor: int = 1) -> DataFrame:
    return _table(spark, sf, "part").select(
        (F.col("p_partkey") * factor).alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
    )


def _raw_products(spark: SparkSession, sf: str, factor: int = 1) -> DataFrame:
    """All products as the strings a source file holds, under its headers."""
    return _products(spark, sf, factor).select(
        F.col("product_id").cast("string").alias("商品ID"),
        F.col("product_name").alias("商品名"),
        F.col("category").alias("カテゴリ"),
        F.col("brand").alias("メーカー"),
    )


def _raw_sales(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, sf, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("売上ID"),
        F.col("l_partkey").cast("string").alias("商品ID"),
        F.col("l_quantity").cast("string").alias("数量"),
        F.col("l_extendedprice").cast("string").alias("価格"),
        F.col("l_shipdate").cast("date").cast("string").alias("売上日"),
    )


def _write_csv(df: DataFrame, path: str, sep: str = ",") -> None:
    df.write.option("header", True).option("escape", '"').option("sep", sep).csv(path)


# --- gold -------------------------------------------------------------------------------


def gold_sales_summary(spark: SparkSession, sf: str) -> DataFrame:
    return sales_summary(_facts(spark, sf), _products(spark, sf))


def gold_orphan_facts(spark: SparkSession, sf: str) -> DataFrame:
    """With the products' keys doubled, half of the facts have no product."""
    return sales_summary(_facts(spark, sf), _products(spark, sf, 2))


# --- projections and casts --------------------------------------------------------------


def contract_rename_cast(spark: SparkSession, sf: str) -> DataFrame:
    part = _table(spark, sf, "part").select(
        F.col("p_partkey").alias("商品ID"),
        F.col("p_name").alias("商品名"),
        F.col("p_retailprice").cast("string").alias("価格"),
        F.col("p_size").alias("size"),
    )
    contract = Contract.from_dict(
        {
            "table": "product",
            "primary_keys": ["product_id"],
            "columns": {
                "product_id": {"type": "string", "source": "商品ID"},
                "product_name": {"type": "string", "source": "商品名"},
                "price": {"type": "float", "source": "価格"},
                "colour": {"type": "string", "source": "色"},
            },
        }
    )
    return conform(part, contract)


def cast_int_legacy(spark: SparkSession, sf: str) -> DataFrame:
    def text(*parts: str) -> F.Column:
        return F.concat(*(F.col(p) if p.startswith("l_") else F.lit(p) for p in parts))

    columns = {
        "fraction": text("l_partkey", ".75"),
        "padded": text(" -", "l_linenumber", " \t"),
        "only_fraction": text(".", "l_suppkey"),
        "junk": text("l_orderkey", "x"),
        "exponent": text("l_linenumber", "e3"),
        "wide": text("99999999", "l_partkey"),
        "wide_fraction": text("+99999999", "l_partkey", ".5"),
    }
    types = {"wide": "long", "wide_fraction": "long"}
    contract = Contract.from_dict(
        {
            "table": "numbers",
            "columns": {c: {"type": types.get(c, "int")} for c in columns}
            | {"overflow": {"type": "integer"}},
        }
    )
    rows = _table(spark, sf, "lineitem").select(
        *(c.alias(n) for n, c in columns.items()), columns["wide"].alias("overflow")
    )
    return conform(rows, contract)


def cast_date(spark: SparkSession, sf: str) -> DataFrame:
    day = F.col("o_orderdate")
    columns = {
        "plain": F.date_format(day, "yyyy-MM-dd"),
        "short": F.date_format(day, "yyyy-M-d"),
        "with_time": F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss"),
        "slashes": F.date_format(day, "yyyy/MM/dd"),
        "compact": F.date_format(day, "yyyyMMdd"),
        "only_year": F.date_format(day, "yyyy"),
        "junk": F.concat(F.lit("on "), F.date_format(day, "yyyy-MM-dd")),
    }
    contract = Contract.from_dict(
        {"table": "days", "columns": {c: {"type": "date"} for c in columns}}
    )
    rows = _table(spark, sf, "orders").select(
        "o_orderkey", *(c.alias(n) for n, c in columns.items())
    )
    return conform(rows, contract)


def cast_boolean_default(spark: SparkSession, sf: str) -> DataFrame:
    size = F.col("p_size")
    flag = F.when(size < 10, "true").when(size < 20, "no").when(size < 30, "0").when(size < 40, "x")
    contract = Contract.from_dict(
        {
            "table": "flags",
            "columns": {
                "sold": {"type": "boolean"},
                "sold_or_default": {"type": "boolean", "default": True},
                "active_flag": {"type": "boolean", "default": True},
                "stock": {"type": "int", "default": 0},
            },
        }
    )
    rows = _table(spark, sf, "part").select(
        "p_partkey", flag.alias("sold"), flag.alias("sold_or_default")
    )
    return conform(rows, contract)


def unknown_type_passthrough(spark: SparkSession, sf: str) -> DataFrame:
    contract = Contract.from_dict(
        {"table": "part", "columns": {"price": {"type": "money", "source": "p_retailprice"}}}
    )
    return conform(_table(spark, sf, "part"), contract)


def audit_column(spark: SparkSession, sf: str) -> DataFrame:
    rows = add_audit(_table(spark, sf, "part").select("p_partkey"))
    return rows.select(
        "p_partkey",
        F.col("ingest_ts").isNotNull().alias("stamped"),
        (F.col("ingest_ts") == F.current_timestamp()).alias("is_query_time"),
    )


def slug_names(spark: SparkSession, sf: str) -> DataFrame:
    name = F.concat(
        F.lit(" \t"), F.col("p_name"), F.lit("  (売上) #"), F.col("p_size"), F.lit(".v-1 \n")
    )
    short = F.when(F.col("p_size") > 25, F.lit(" 価格 ")).otherwise(F.col("p_brand"))
    return _table(spark, sf, "part").select(
        "p_partkey", slug(name).alias("slug"), slug(short).alias("short")
    )


def na_tokens_to_null(spark: SparkSession, sf: str) -> DataFrame:
    size = F.col("p_size")
    token = (
        F.when(size < 8, "NA")
        .when(size < 16, "n/a")
        .when(size < 24, "#N/A")
        .when(size < 32, "")
        .when(size < 40, "nA")
        .otherwise(F.col("p_name"))
    )
    return na_to_null(_table(spark, sf, "part").select("p_partkey", token.alias("cell"), "p_brand"))


# --- quality, dedupe, merge -------------------------------------------------------------


def not_null_split(spark: SparkSession, sf: str) -> DataFrame:
    rows = _table(spark, sf, "customer").select(
        "c_custkey",
        F.nullif("c_nationkey", F.lit(3)).alias("nation"),
        F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"),
    )
    valid, rejected = split_not_null(rows, ["nation", "segment"])
    return valid.withColumn("missing", F.lit("")).unionByName(
        rejected.withColumn("missing", F.array_join("null_columns", "+")).drop("null_columns")
    )


def not_null_absent_column(spark: SparkSession, sf: str) -> DataFrame:
    """Products without the required name column: every row is rejected for it."""
    raw = _raw_products(spark, sf).drop("商品名")
    valid, rejected = bronze_rows(raw, PRODUCT, at=LOADED_AT)
    missing = F.array_join("null_columns", "+").alias("missing")
    accepted = valid.select("product_id", F.lit("").alias("missing"))
    return accepted.unionByName(rejected.select("product_id", missing))


def not_null_required(spark: SparkSession, sf: str) -> DataFrame:
    """The mode that fails on a missing value, on rows that have none."""
    rows, _ = bronze_rows(_raw_products(spark, sf), PRODUCT, at=LOADED_AT, nulls="fail")
    return rows.drop("ingest_ts")


def conform_case_variants(spark: SparkSession, sf: str) -> DataFrame:
    """Columns in another case than the contract has, two of them with a default."""
    contract = Contract(
        table="parts",
        columns=(
            Column("part_key", "long", source="p_partkey"),
            Column("Size", "int", default=0),
            Column("flag", "boolean", default=True),
        ),
        write_mode="overwrite",
    )
    size = F.nullif("p_size", F.lit(1)).cast("string")
    raw = _table(spark, sf, "part").select(F.col("p_partkey").cast("string"), size.alias("SIZE"))
    return conform(raw.withColumn("Flag", F.lit("F")), contract)


def dedupe_lineitem(spark: SparkSession, sf: str) -> DataFrame:
    return dedupe_on_keys(
        _table(spark, sf, "lineitem"),
        ["l_orderkey", "l_linenumber"],
        ["l_shipdate", "l_partkey", "l_suppkey"],
    )


def _renamed(spark: SparkSession, sf: str) -> DataFrame:
    """All products under doubled keys and changed names: half new, half known."""
    return _products(spark, sf, 2).withColumn("product_name", F.upper("product_name"))


def merge_upsert(spark: SparkSession, sf: str) -> DataFrame:
    return merge_rows(_products(spark, sf), _renamed(spark, sf), ["product_id"])


def merge_target_only_column(spark: SparkSession, sf: str) -> DataFrame:
    source = _renamed(spark, sf).select("product_id", "product_name")
    return merge_rows(_products(spark, sf), source, ["product_id"])


def merge_new_column(spark: SparkSession, sf: str) -> DataFrame:
    target = _products(spark, sf).select("product_id", "product_name")
    source = _renamed(spark, sf).select("product_id", "product_name", "brand")
    return merge_rows(target, source, ["product_id"], add_columns=True)


def merge_composite_key(spark: SparkSession, sf: str) -> DataFrame:
    """One order line on, and one piece more; the source repeats keys, the target does not."""
    lines = _table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity"
    )
    later = lines.withColumn("l_linenumber", F.col("l_linenumber") + 1).withColumn(
        "l_quantity", F.col("l_quantity") + 100
    )
    keys, order = ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey"]
    target = dedupe_on_keys(lines, keys, order)
    return merge_rows(target, later, keys, order_by=order, keys_present=True, colocated=True)


def merge_wider_types(spark: SparkSession, sf: str) -> DataFrame:
    """A source whose keys and sizes are of wider types than the stored table's: the table widens."""
    root, name = scratch_dir(spark, "wider"), f"sizes_{uuid.uuid4().hex}"
    part = _table(spark, sf, "part")
    small = part.select(F.col("p_partkey").cast("int").alias("id"), F.col("p_size").cast("smallint").alias("size"))
    wide = part.select(
        (F.col("p_partkey") * 2 + F.lit(2**40)).alias("id"), (F.col("p_size") / 2).alias("size")
    ).unionByName(part.select((F.col("p_partkey") * 2).alias("id"), F.col("p_retailprice").alias("size")))
    for rows in (small, wide):
        upsert_table(rows, name, root, ["id"], buckets=4)
    return _stored(spark, root, name)


def merge_null_keys(spark: SparkSession, sf: str) -> DataFrame:
    key = F.when(F.col("brand") != "Brand#7", F.col("product_id")).alias("product_id")
    target = _products(spark, sf).select(key, "product_name", "brand")
    source = _renamed(spark, sf).select(key, "product_name", "brand")
    return merge_rows(target, source, ["product_id"])


def merge_first_write(spark: SparkSession, sf: str) -> DataFrame:
    lines = _table(spark, sf, "lineitem").select(
        "l_partkey", "l_shipdate", "l_orderkey", "l_linenumber"
    )
    return merge_rows(None, lines, ["l_partkey"])


def merge_published(spark: SparkSession, sf: str) -> DataFrame:
    """The upsert between stored tables: first write, then a merge into the next snapshot."""
    root = scratch_dir(spark, "merge")
    upsert_path(_products(spark, sf), f"{root}/none", f"{root}/1", ["product_id"])
    upsert_path(_renamed(spark, sf), f"{root}/1", f"{root}/2", ["product_id"])
    return table_scan(spark, f"{root}/2")


def merge_partitions(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines stored by return flag; the upsert, all of one flag, rewrites that partition."""
    path = f"{scratch_dir(spark, 'partitions')}/lines"
    keys = ["l_returnflag", "l_orderkey", "l_linenumber"]
    order = ["l_shipdate", "l_partkey", "l_suppkey"]
    lines = _table(spark, sf, "lineitem").select(*keys, *order, "l_quantity")
    later = lines.withColumns(
        {
            "l_returnflag": F.lit("R"),
            "l_linenumber": F.col("l_linenumber") + 1,
            "l_quantity": F.col("l_quantity") + 100,
        }
    )
    for rows in (lines, later):
        upsert_partitions(rows, path, keys, ["l_returnflag"], order_by=order)
    return table_scan(spark, path)


def upsert_after_restart(spark: SparkSession, sf: str) -> DataFrame:
    """Two loads into one table; in between, the session forgets all it knows of it."""
    root, name = scratch_dir(spark, "restart"), f"products_{uuid.uuid4().hex}"
    for rows in (_products(spark, sf), _renamed(spark, sf)):
        upsert_table(rows, name, root, ["product_id"])
        _forget(spark, name)
    return read_table(spark, root, name)


def merge_by_bucket(spark: SparkSession, sf: str) -> DataFrame:
    """An upsert of a table in buckets, through the view that names it."""
    root, name = scratch_dir(spark, "buckets"), f"products_{uuid.uuid4().hex}"
    for rows in (_products(spark, sf), _renamed(spark, sf)):
        upsert_table(rows, name, root, ["product_id"], buckets=8)
    rows = spark.table(name)
    rows.schema
    return rows


# --- layers -----------------------------------------------------------------------------


def silver_dim_product(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["product_id", "product_name", "category", "brand", "ingest_ts"]
    bronze, _ = bronze_rows(_raw_products(spark, sf, 2), PRODUCT, at=LOADED_AT)
    bronze = bronze.withColumn("product_name", F.upper("product_name"))
    silver, _ = bronze_rows(_raw_products(spark, sf), PRODUCT, at=LOADED_AT)
    return silver_merge(bronze, silver, ["product_id"], columns).drop("ingest_ts")


def silver_fact_sales(spark: SparkSession, sf: str) -> DataFrame:
    dim = _products(spark, sf, 2).withColumn("product_id", F.col("product_id").cast("string"))
    order = ["sales_date", "product_id", "quantity", "price"]
    facts, _ = fact_rows(_raw_sales(spark, sf), SALES, dim, "product_id", order_by=order)
    return facts


def bronze_load_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Files with two versions of every product, half of them known, into a bronze table."""
    root = scratch_dir(spark, "bronze")
    raw = _raw_products(spark, sf, 2)
    shouted = raw.withColumn("商品名", F.upper("商品名"))
    _write_csv(raw, f"{root}/landing/a")
    _write_csv(shouted, f"{root}/landing/b")
    old, _ = bronze_rows(_raw_products(spark, sf), PRODUCT, at=LOADED_AT)
    files = contract_scan(spark, PRODUCT, {"landing": f"{root}/landing"})
    return bronze_load(files, PRODUCT, old, at=LOADED_AT).drop("ingest_ts")


def _stored(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The rows of a table of ours, found by path; its names in the catalog are given up."""
    _forget(spark, name)
    return read_table(spark, root, name)


def _forget(spark: SparkSession, name: str) -> None:
    """Drop a view of ours and the snapshots behind it from the catalog; the files stay."""
    spark.sql(f"DROP VIEW {name}")
    for snapshot in spark.catalog.listTables(pattern=f"{name}__*"):
        spark.sql(f"DROP TABLE {snapshot.name}")


def _named(contract: Contract) -> Contract:
    """The contract under a table name nobody else has."""
    return replace(contract, table=f"{contract.table}_{uuid.uuid4().hex}")


def bronze_stream_load(spark: SparkSession, sf: str) -> DataFrame:
    """The same load in two runs that each see only the files new to them."""
    root = scratch_dir(spark, "stream")
    contract = _named(PRODUCT)
    for name, rows in (
        ("a", _raw_products(spark, sf)),
        ("b", _raw_products(spark, sf, 2).withColumn("商品名", F.upper("商品名"))),
    ):
        _write_csv(rows, f"{root}/landing/{name}")
        query = bronze_stream(
            spark, contract, f"{root}/landing", f"{root}/bronze", f"{root}/progress", at=LOADED_AT
        )
        query.awaitTermination()
    return _stored(spark, f"{root}/bronze", contract.table).drop("ingest_ts")


def layers_end_to_end(spark: SparkSession, sf: str) -> DataFrame:
    """CSV files to bronze, bronze to silver, silver to the gold summary, all stored."""
    root = scratch_dir(spark, "layers")
    _write_csv(_raw_products(spark, sf), f"{root}/products")
    _write_csv(_raw_sales(spark, sf), f"{root}/sales")
    product, sales = _named(PRODUCT), _named(SALES)
    bronze, silver = f"{root}/bronze", f"{root}/silver"
    load_bronze(spark, product, {"landing": f"{root}/products"}, bronze, at=LOADED_AT)
    load_bronze(spark, sales, {"landing": f"{root}/sales"}, bronze, at=LOADED_AT)

    columns = ["product_id", "product_name", "category", "brand", "ingest_ts"]
    load_silver(spark, product, _stored(spark, bronze, product.table), silver, columns)
    dim = _stored(spark, silver, product.table)
    facts = _stored(spark, bronze, sales.table).drop("ingest_ts")
    load_facts(facts, sales, dim, "product_id", silver, keys_unique=True)

    name = f"sales_summary_{uuid.uuid4().hex}"
    load_gold(_stored(spark, silver, sales.table), dim, f"{root}/gold", name)
    return _stored(spark, f"{root}/gold", name)


def load_figures(spark: SparkSession, sf: str) -> DataFrame:
    """What two loads of products did, as they counted it themselves; the second has twice the keys,
    each in two versions, and some without a name."""
    root, contract = scratch_dir(spark, "figures"), _named(PRODUCT)
    later = _raw_products(spark, sf, 2)
    named = F.when(F.col("メーカー") != "Brand#7", F.upper("商品名"))
    told = []
    for raw in (_raw_products(spark, sf), later.unionByName(later.withColumn("商品名", named))):
        figures: dict[str, int] = {}
        load_bronze(spark, contract, {}, root, raw=raw, at=LOADED_AT, figures=figures)
        told += [(len(told) // 4 + 1, what, n) for what, n in sorted(figures.items())]
    return spark.createDataFrame(told, "load int, what string, rows long")


def gold_changed_days(spark: SparkSession, sf: str) -> DataFrame:
    """The gold summary by day, brought up to date after the sales of its last year have moved by a
    day and doubled in price; no other day is written again."""
    path = f"{scratch_dir(spark, 'days')}/summary"
    raw = _table(spark, sf, "lineitem").select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("sales_id"),
                                               *_fact_columns())
    order = ["product_id", "quantity", "price", "sales_date"]
    # What follows reads the facts many times.
    facts, products = stage(dedupe_on_keys(raw, ["sales_id"], order), "facts"), _products(spark, sf)
    refresh_gold(facts, products, path, facts.select("sales_date"))
    last = facts.agg(F.year(F.max("sales_date"))).first()[0]
    moved = facts.where(F.year("sales_date") == last).withColumns(
        {"sales_date": F.date_add("sales_date", 1), "price": 2 * F.col("price")}
    )
    days = touched_days(facts, moved, ["sales_id"])
    refresh_gold(merge_rows(facts, moved, ["sales_id"], order_by=order), products, path, days)
    return table_scan(spark, path)


GOLD_TEXT = """
    WITH known AS (SELECT product_id, category FROM {dim_product} WHERE category IS NOT NULL)
    SELECT sales_date, coalesce(category, 'none') AS category, count(*) AS sales,
           max(price) AS dearest, bool_or(quantity >= :many) AS any_large
    FROM {fact_sales} LEFT JOIN known USING (product_id)
    GROUP BY ALL
"""


def gold_from_template(spark: SparkSession, sf: str) -> DataFrame:
    """Sales by day and category, stored from a statement and a contract alone."""
    root = scratch_dir(spark, "gold")
    contract = _named(
        Contract(table="sales_by_category", partitions=("sales_date",), write_mode="overwrite")
    )
    relations = {"fact_sales": _facts(spark, sf), "dim_product": _products(spark, sf)}
    load_from_template(spark, contract, GOLD_TEXT, root, relations, {"many": 45})
    return _stored(spark, root, contract.table)


def silver_from_template(spark: SparkSession, sf: str) -> DataFrame:
    """Sales by brand, merged twice into a keyed table: the later load wins for its brands."""
    root = scratch_dir(spark, "brands")
    contract = _named(
        Contract(
            table="brand_sales",
            columns=(Column("brand", "string"), Column("sold", "long"), Column("note", "string")),
            keys=("brand",),
        )
    )
    text = """
        SELECT p.brand, SUM(s.quantity) AS sold, :note AS note
        FROM {sales} s JOIN {products} p USING (product_id) GROUP BY p.brand
    """
    sales, products = _facts(spark, sf), _products(spark, sf)
    later = products.withColumn("brand", F.regexp_replace("brand", "1", "9"))
    for rows, note in ((products, "first"), (later, "later")):
        relations = {"sales": sales, "products": rows}
        load_from_template(spark, contract, text, root, relations, {"note": note})
    return _stored(spark, root, contract.table)


def merge_statement(spark: SparkSession, sf: str) -> DataFrame:
    """Parts kept in stock by two statements that merge, the second one from a stored table."""
    paths = {"lake": scratch_dir(spark, "stock")}
    part = {"part": _table(spark, sf, "part")}
    run_statement(
        spark,
        """
        CREATE TABLE IF NOT EXISTS delta.`{lake}/stock`
          (part_id BIGINT, label STRING, size INT, note STRING) USING DELTA
        """,
        paths=paths,
    )
    run_statement(
        spark,
        """
        -- every part, each once
        MERGE INTO delta.`{lake}/stock` AS old
        USING (SELECT p_partkey AS part_id, p_name AS label, p_size AS size, :note AS note
               FROM {part}) AS new
        ON old.part_id = new.part_id
        WHEN MATCHED THEN UPDATE SET *
        WHEN NOT MATCHED THEN INSERT *
        """,
        part,
        {"note": "it's first"},
        paths,
    )
    run_statement(
        spark,
        """
        CREATE OR REPLACE TABLE delta.`{lake}/arrivals` USING DELTA AS
        SELECT 2 * part_id AS part_id, upper(label) AS label, 0 AS size FROM delta.`{lake}/stock`
        """,
        paths=paths,
    )
    return run_statement(
        spark,
        """
        MERGE INTO delta.`{lake}/stock` AS old USING delta.`{lake}/arrivals` AS new
        ON new.part_id = old.part_id
        WHEN MATCHED THEN UPDATE SET old.label = new.label
        WHEN NOT MATCHED THEN INSERT (part_id, label) VALUES (new.part_id, new.label);
        """,
        paths=paths,
    )


def replace_statement(spark: SparkSession, sf: str) -> DataFrame:
    """Sums by ship mode and size, stored by statement; then replaced by what is made of them."""
    paths = {"lake": scratch_dir(spark, "modes")}
    relations = {"lines": _table(spark, sf, "lineitem"), "part": _table(spark, sf, "part")}
    run_statement(
        spark,
        """
        CREATE OR REPLACE TABLE delta.`{lake}/by_flag` USING DELTA PARTITIONED BY (flag) AS
        WITH sold AS (SELECT l_returnflag AS flag, p_size AS size, l_quantity AS quantity
                      FROM {lines} LEFT JOIN {part} ON l_partkey = p_partkey)
        SELECT flag, size, count(*) AS sales, CAST(sum(quantity) AS BIGINT) AS quantity
        FROM sold GROUP BY flag, size
        """,
        relations,
        paths=paths,
    )
    # There is a table already, so this leaves it alone.
    run_statement(
        spark,
        "CREATE TABLE IF NOT EXISTS delta.`{lake}/by_flag` (flag STRING) USING DELTA",
        paths=paths,
    )
    return run_statement(
        spark,
        """
        CREATE OR REPLACE TABLE delta.`{lake}/by_flag` USING DELTA PARTITIONED BY (flag) AS
        SELECT flag, size, sales, quantity, sum(quantity) OVER (PARTITION BY flag) AS of_flag
        FROM delta.`{lake}/by_flag` WHERE sales >= :least
        """,
        values={"least": 2},
        paths=paths,
    )


# --- sources and sinks ------------------------------------------------------------------


def csv_files(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_dir(spark, "csv")
    _write_csv(_raw_products(spark, sf), root)
    rows = csv_scan(spark, root, columns=PRODUCT.headers, options=PRODUCT.reader_options)
    return conform(rows, PRODUCT)


def csv_files_nested(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_dir(spark, "nested")
    _write_csv(_raw_products(spark, sf), f"{root}/Bulgaria")
    _write_csv(_raw_products(spark, sf, 2), f"{root}/Slovenia/north")
    return conform(csv_scan(spark, root), PRODUCT)


def csv_rows_quarantined(spark: SparkSession, sf: str) -> DataFrame:
    """Lines with a cell too many, with empty cells too many, and with one too few: how many are
    accepted, and how many are quarantined for which reason."""
    root = scratch_dir(spark, "ragged")
    size = F.col("p_size")
    key = F.col("p_partkey").cast("string")
    line = (
        F.when(size <= 10, F.concat_ws(",", key, "p_name", "p_brand", F.lit("LOST")))
        .when(size <= 20, F.concat_ws(",", key, "p_name", "p_brand", F.lit(""), F.lit("")))
        .when(size <= 30, F.concat_ws(",", key, "p_name"))
        .otherwise(F.concat_ws(",", key, F.lit('"a,""b"""'), "p_brand"))
    )
    lines = _table(spark, sf, "part").select(line.alias("id,name,brand"))
    _encoded(lines, "utf-8").write.text(root)
    good, bad = csv_quarantine(spark, root, "*.txt", ["id", "name", "brand"], short="quarantine")
    accepted = good.groupBy(F.lit("accepted").alias("outcome")).agg(
        F.count(F.lit(1)).alias("rows"), F.count(F.when(F.col("name") == 'a,"b"', 1)).alias("quoted")
    )
    return accepted.unionByName(
        bad.groupBy(F.col("reason").alias("outcome")).agg(
            F.count(F.lit(1)).alias("rows"),
            F.count(F.when(F.col("record").contains("LOST"), 1)).alias("quoted"),
        )
    )


def sniffed_text(spark: SparkSession, sf: str) -> DataFrame:
    """The products as text under four delimiters, one folder with other columns."""
    root = scratch_dir(spark, "text")
    part = _table(spark, sf, "part").select(
        F.col("p_partkey").cast("string"), "p_name", "p_brand", F.col("p_size").cast("string")
    )
    _write_csv(part, f"{root}/comma")
    _write_csv(part, f"{root}/semicolon", ";")
    _write_csv(part, f"{root}/tab", "\t")
    _write_csv(part.select("p_size", "p_partkey", "p_name"), f"{root}/bar", "|")
    rows, _ = text_sheets(spark, root, "*.csv")
    folder = F.regexp_extract("path", "/([a-z]+)/[^/]*$", 1)
    return rows.select("p_partkey", "p_name", "p_brand", "p_size", folder.alias("folder"))


def _encoded(rows: DataFrame, codec: str, head: str | None = None) -> DataFrame:
    """Semicolon-separated lines as the bytes of an encoding, a header in front of each task's."""
    line = F.array_join(F.array(*rows.columns), ";")
    head = head or ";".join(rows.columns)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines = [head]
        for batch in batches:
            lines += batch.column("line").to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array([x.encode(codec) for x in lines])], ["value"])
            lines = []

    return rows.select(line.alias("line")).mapInArrow(encode, "value binary").select(
        F.col("value").cast("string")
    )


def text_encodings(spark: SparkSession, sf: str) -> DataFrame:
    """The parts as text in five encodings, none of which the files name, and in one that is unclear."""
    root = scratch_dir(spark, "encodings")
    part = _table(spark, sf, "part")
    key = F.col("p_partkey").cast("string").alias("番号")
    kana = part.select(key, F.translate("p_name", "aeiou", "アエイオウ").alias("品名"))
    accents = part.select(
        key.alias("número"), F.concat("p_name", F.lit(" à 5 €"), F.col("p_size")).alias("désigné")
    )
    _encoded(kana, "cp932").write.text(f"{root}/sjis")
    _encoded(kana, "euc_jp").write.text(f"{root}/eucjp")
    _write_csv(kana, f"{root}/utf8", ";")
    kana.write.options(header=True, sep=";", encoding="UTF-16LE").csv(f"{root}/wide")
    _encoded(accents.toDF("numero", "désigné"), "cp1252").write.text(f"{root}/western")
    _encoded(part.select(key.alias("nr"), F.lit("Příliš žluťoučký kůň").alias("text")), "cp1250").write.text(f"{root}/unclear")
    rows, failures = text_sheets(spark, root, "*.{csv,txt}")
    folder = F.regexp_extract("path", "/([a-z0-9]+)/[^/]*$", 1)
    failed = failures.where(F.col("error").startswith("the encoding is unclear"))
    return rows.select(
        folder.alias("folder"),
        F.coalesce("番号", "numero").alias("number"),
        F.coalesce("品名", "désigné").alias("name"),
    ).unionByName(failed.select(folder.alias("folder"), F.lit(None).cast("string").alias("number"),
                                F.lit(None).cast("string").alias("name")).distinct())


def quoted_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Cells over several lines, and quotes that quote nothing, cut into records in parallel."""
    root = scratch_dir(spark, "quoted")
    part = _table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("id"), "p_name", "p_brand")
    lines = F.concat("p_name", F.lit('\n"no",\n'), F.col("p_brand"))
    _write_csv(part.select("id", lines.alias("text")), f"{root}/lines")
    inch = F.concat(F.col("id"), F.lit('" screen')).alias("text")
    _encoded(part.select("id", inch), "utf-8").write.text(f"{root}/inch")
    rows, _ = text_sheets(spark, root, "*.{csv,txt}")
    folder = F.regexp_extract("path", "/([a-z]+)/[^/]*$", 1)
    return rows.select("id", "text", folder.alias("folder"))


def workbook_scan(spark: SparkSession, sf: str) -> DataFrame:
    """The products packed into workbooks, parsed, exported as CSV, and read by contract."""
    dst = scratch_dir(spark, "sheets")
    books = pack(_raw_products(spark, sf), "商品 一覧", "/books/Bulgaria", "products")
    export_sheets(parse_files(books), "/books", dst)
    return conform(exported_scan(spark, dst, "products*.csv", PRODUCT.headers), PRODUCT)


def sheet_files(spark: SparkSession, sf: str) -> DataFrame:
    """The products in workbooks, each sheet written as one plain file; every row read back with what
    the manifest says of its file."""
    dst = scratch_dir(spark, "files")
    books = pack(_raw_products(spark, sf), "商品 list", "/books/Bulgaria", "products")
    manifest = export_files(parse_files(books), "/books", dst)
    files = csv_scan(spark, dst, "products*__list.csv", PRODUCT.headers, {"multiLine": "true"})
    name = F.concat(F.lit("Bulgaria/"), F.substring_index("_metadata.file_path", "/", -1))
    told = manifest.select(F.col("file").alias("name"), "sheet", "status")
    rows = conform(files.select("*", name.alias("name")), PRODUCT)
    return rows.join(told, "name", "left").drop("name")


def workbook_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """What parsing found among sound and cut-off workbooks: rows by sheet and outcome."""
    sound = pack(_raw_products(spark, sf), "Products", "/books", "p").unionByName(
        pack(_table(spark, sf, "supplier"), "Suppliers", "/books/Bulgaria", "s")
    )
    broken = sound.select(
        F.concat(F.lit("books:/cut/"), F.xxhash64("path")).alias("path"),
        F.substring("content", 1, 200).alias("content"),
    )
    found = parse_files(sound.unionByName(broken)).where("kind <> 'row'")
    return found.groupBy("kind", "sheet").agg(
        F.sum("rows").alias("rows"), F.bool_and(F.col("error").isNotNull()).alias("has_error")
    )


def text_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """The whole spreadsheet job on disguised text: files in, manifest and CSV out."""
    src, dst = scratch_dir(spark, "in"), scratch_dir(spark, "out")
    _write_csv(_raw_products(spark, sf), f"{src}/Bulgaria", ";")
    _write_csv(_raw_products(spark, sf, 2), f"{src}/Slovakia", "|")
    manifest = spreadsheet_ingest(spark, src, dst, glob="*.csv")
    exported = conform(exported_scan(spark, dst, columns=PRODUCT.headers), PRODUCT)
    listed = manifest.groupBy(F.concat(F.lit("status "), "status").alias("what")).agg(
        F.sum("rows").alias("rows")
    )
    written = exported.groupBy(F.concat(F.lit("brand "), "brand").alias("what")).agg(
        F.count(F.lit(1)).alias("rows")
    )
    return listed.unionByName(written)


def text_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    """Files of sound text, of a header line alone, and of rows longer than the header: how many
    came out as what, with their rows."""
    src, dst = scratch_dir(spark, "in"), scratch_dir(spark, "out")
    part = _table(spark, sf, "part").select(F.col("p_partkey").cast("string"), "p_name")
    supplier = _table(spark, sf, "supplier").select("s_name")
    _write_csv(part, f"{src}/sound", ";")
    _write_csv(supplier, f"{src}/one")
    head = spark.createDataFrame([("id|name",)], "value string")
    head.coalesce(1).write.text(f"{src}/bare")
    long = part.withColumn("more", F.lit("more"))
    _encoded(long, "utf-8").write.text(f"{src}/long")
    _encoded(long, "utf-8", "id;name").write.text(f"{src}/surplus")
    manifest = spreadsheet_ingest(spark, src, dst, glob="*.{csv,txt}")
    folder = F.regexp_extract("path", "/([a-z]+)/[^/]*$", 1).alias("folder")
    return manifest.groupBy(folder, "status").agg(F.sum("rows").alias("rows"))


def table_scan_write(spark: SparkSession, sf: str) -> DataFrame:
    """Facts stored by day through the contract, read back by path, and summed by day folder."""
    root = scratch_dir(spark, "facts")
    contract = replace(_named(SALES), write_mode="overwrite")
    write_by_contract(conform(_raw_sales(spark, sf), SALES), contract, root)
    _forget(spark, contract.table)
    day = F.regexp_extract(F.col("_metadata.file_path"), "/sales_date=([0-9-]+)/", 1)
    return (
        table_scan(spark, f"{root}/{contract.table}/data-*")
        .select(day.cast("date").alias("folder"), "sales_date", "quantity")
        .groupBy("folder", "sales_date")
        .agg(F.count(F.lit(1)).alias("sales"), F.sum("quantity").alias("quantity"))
    )


def create_then_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    """An empty table made from the contract, then replaced, and read by format and location."""
    root = scratch_dir(spark, "tables")
    path = f"{root}/{PRODUCT.table}"
    create_if_missing(spark, path, PRODUCT.struct())
    before = table_scan(spark, path).count()
    rows, _ = bronze_rows(_raw_products(spark, sf), PRODUCT, at=LOADED_AT)
    overwrite(rows, path, partition_by=["brand"])
    create_if_missing(spark, path, PRODUCT.struct())
    stored = replace(PRODUCT, source_format="parquet", location="bronze", reader_options={})
    return (
        contract_scan(spark, stored, {"bronze": root})
        .drop("ingest_ts")
        .withColumn("rows_before", F.lit(before).cast("bigint"))
    )


def sql_template(spark: SparkSession, sf: str) -> DataFrame:
    return run_template(
        spark,
        """
        -- parts and largest size by brand; the braces in the literal are plain text
        SELECT p_brand AS brand, count(*) AS parts, max(p_size) AS largest,
               count_if(p_size >= :small) AS larger, '{"layer": "gold"}' AS tag
        FROM {products}
        GROUP BY p_brand;
        """,
        {"products": _table(spark, sf, "part")},
        {"small": 5},
    )


QUERIES: dict[str, Query] = {
    "gold_sales_summary": gold_sales_summary,
    "gold_orphan_facts": gold_orphan_facts,
    "contract_rename_cast": contract_rename_cast,
    "cast_int_legacy": cast_int_legacy,
    "cast_date": cast_date,
    "cast_boolean_default": cast_boolean_default,
    "unknown_type_passthrough": unknown_type_passthrough,
    "audit_column": audit_column,
    "slug_names": slug_names,
    "na_tokens_to_null": na_tokens_to_null,
    "not_null_split": not_null_split,
    "not_null_absent_column": not_null_absent_column,
    "not_null_required": not_null_required,
    "conform_case_variants": conform_case_variants,
    "dedupe_on_keys": dedupe_lineitem,
    "merge_upsert": merge_upsert,
    "merge_target_only_column": merge_target_only_column,
    "merge_new_column": merge_new_column,
    "merge_composite_key": merge_composite_key,
    "merge_wider_types": merge_wider_types,
    "merge_null_keys": merge_null_keys,
    "merge_first_write": merge_first_write,
    "merge_published": merge_published,
    "merge_partitions": merge_partitions,
    "merge_by_bucket": merge_by_bucket,
    "upsert_after_restart": upsert_after_restart,
    "silver_dim_product": silver_dim_product,
    "silver_fact_sales": silver_fact_sales,
    "bronze_load": bronze_load_csv,
    "bronze_stream_load": bronze_stream_load,
    "layers_end_to_end": layers_end_to_end,
    "load_figures": load_figures,
    "gold_changed_days": gold_changed_days,
    "gold_from_template": gold_from_template,
    "silver_from_template": silver_from_template,
    "merge_statement": merge_statement,
    "replace_statement": replace_statement,
    "csv_scan": csv_files,
    "csv_scan_nested": csv_files_nested,
    "csv_rows_quarantined": csv_rows_quarantined,
    "sniffed_text_scan": sniffed_text,
    "workbook_scan": workbook_scan,
    "sheet_files": sheet_files,
    "workbook_manifest": workbook_manifest,
    "text_encodings": text_encodings,
    "quoted_lines": quoted_lines,
    "text_ingest": text_ingest,
    "text_outcomes": text_outcomes,
    "table_scan_write": table_scan_write,
    "create_then_overwrite": create_then_overwrite,
    "sql_template": sql_template,
}
