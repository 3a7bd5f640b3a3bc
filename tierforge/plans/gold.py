"""Gold: reporting tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierforge.functions.names import quoted
from tierforge.operators.summary import Sum, summarise_with_lookup
from tierforge.scratch import stage, staging
from tierforge.sinks.layout import is_shuffled, partitioned, rows_by
from tierforge.sinks.snapshots import Snapshot
from tierforge.sinks.tables import create_or_replace
from tierforge.storage import Folder

# The folder of rows without a value. Fixed value.
_NULL = "__HIVE_DEFAULT_PARTITION__"


def sales_summary(fact_sales: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Quantity and revenue per day and product, with the product's name where it is known."""
    return summarise_with_lookup(
        fact_sales,
        dim_product,
        key="product_id",
        group_by=["sales_date"],
        labels=["product_name"],
        sums=[
            Sum("total_qty", F.col("quantity")),
            Sum("gross_revenue", F.col("quantity") * F.col("price")),
        ],
    )


def touched_days(
    target: DataFrame, source: DataFrame, keys: Sequence[str], day: str = "sales_date"
) -> DataFrame:
    """The days on which an upsert of ``source`` changes ``target``: those its rows come to, and those
    that the rows they replace were on."""
    on = [quoted(k) for k in keys]
    replaced = target.select(*on, quoted(day)).join(source.select(*on), list(keys), "left_semi")
    return source.select(quoted(day)).unionByName(replaced.select(quoted(day))).distinct()


def days_of(
    facts: DataFrame, changed: DataFrame, key: str = "product_id", day: str = "sales_date"
) -> DataFrame:
    """The days of the facts that belong to changed rows of a lookup table."""
    return facts.join(changed.select(quoted(key)), key, "left_semi").select(quoted(day)).distinct()


def facts_on(facts: DataFrame, days: DataFrame, day: str = "sales_date") -> DataFrame:
    """The facts of the given days; the first and the last of these bound what is scanned."""
    first, last = days.agg(F.min(quoted(day)), F.max(quoted(day))).first()
    near = facts.where(quoted(day).between(first, last) | quoted(day).isNull())
    known = days.select(quoted(day).alias("__day"))
    return near.join(known, quoted(day).eqNullSafe(quoted("__day")), "left_semi")


def refresh_gold(
    fact_sales: DataFrame, dim_product: DataFrame, path: str, days: DataFrame, day: str = "sales_date"
) -> None:
    """Bring the summary stored by day at ``path`` up to date on the given days, and there only.

    Of facts that are stored by day, no day before the first or after the last of the given ones is
    read, and the summary of other days keeps its files. Days without facts any more lose their folder. The new rows are complete before
    the first folder is replaced; the replacing, folder by folder, is not atomic.
    """
    spark = fact_sales.sparkSession
    with staging(spark):
        wanted = stage(days.select(quoted(day)).distinct(), "days")
        facts = facts_on(fact_sales, wanted, day)
        rows = stage(sales_summary(facts, dim_product), "summary")
        writer = partitioned(rows, "parquet", [day]).mode("overwrite")
        writer.option("partitionOverwriteMode", "dynamic").save(path)
        left = rows.select(quoted(day).alias("__day")).distinct()
        gone = wanted.join(left, quoted(day).eqNullSafe(quoted("__day")), "left_anti")
        folder = Folder(spark, path)
        there = set(folder.names())
        # At most as many as there are folders.
        for value in gone.select(quoted(day).cast("string")).collect():
            name = f"{day}={_NULL if value[0] is None else value[0]}"
            if name in there:
                folder.delete(name)


def load_gold(
    fact_sales: DataFrame, dim_product: DataFrame, root: str, name: str = "sales_summary"
) -> Snapshot:
    """Replace the summary table, stored by day.

    A day has about as many rows as it has products, which the facts tell; so the summary, which takes
    shuffles to make, is made once and dealt to its days without being staged.
    """
    summary, by = sales_summary(fact_sales, dim_product), ["sales_date"]
    # Facts without a product are one more row.
    products = F.approx_count_distinct("product_id") + 1
    expected = None if is_shuffled(fact_sales) else rows_by(fact_sales, by, products)
    return create_or_replace(summary, name, root, partition_by=by, expected=expected)
