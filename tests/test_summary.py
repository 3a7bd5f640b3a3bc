from pyspark.sql import functions as F

from tierforge.operators import Sum, flag_orphans, summarise_with_lookup
from tierforge.plans import sales_summary
from tests.conftest import plan, rows

FACT = "sales_date string, product_id string, quantity int, price double"


def naive(fact, dim):
    return (
        fact.alias("f")
        .join(dim.alias("d"), F.expr("f.product_id = d.product_id"), "left")
        .groupBy("sales_date", "f.product_id", "product_name")
        .agg(F.sum("quantity").alias("total_qty"), F.sum(F.expr("quantity * price")).alias("gross_revenue"))
    )


def test_equals_join_then_group(spark):
    fact = spark.createDataFrame(
        [("d1", "a", 1, 2.0), ("d1", "a", 3, 0.5), ("d2", "a", 1, 1.0), ("d1", "zz", 2, 4.0)]
        + [("d1", None, 5, 1.0), (None, "b", None, 1.0), ("d1", "b", 2, None), ("d3", "r", 7, 1.25)],
        FACT,
    )
    dim = spark.createDataFrame(
        [("a", "A", 1), ("b", None, 2), (None, "N", 3), ("r", "R1", 1), ("r", "R1", 2), ("r", "R2", 3)],
        "product_id string, product_name string, other int",
    )
    ours = sales_summary(fact, dim)
    assert ours.columns == ["sales_date", "product_id", "product_name", "total_qty", "gross_revenue"]
    assert [t for _, t in ours.dtypes] == ["string", "string", "string", "bigint", "double"]
    assert rows(ours) == rows(naive(fact, dim))


def test_facts_are_summed_before_they_meet_the_lookup(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    fact = spark.createDataFrame([("d", "a", 1, 1.0)], FACT)
    dim = spark.createDataFrame([("a", "A")], "product_id string, product_name string")
    text = plan(sales_summary(fact, dim))
    join = text.index("SortMergeJoin")
    # Nothing is aggregated after the join, and below it each side is, map side first.
    assert "HashAggregate" not in text[:join]
    assert text[join:].count("partial_sum") == 2


def test_columns_the_summary_does_not_need_are_not_read(spark, tmp_path):
    spark.createDataFrame([("a", "A", "c", "b")], "product_id string, product_name string, category string, brand string").write.parquet(f"{tmp_path}/d")
    spark.createDataFrame([("d", "a", 1, 1.0, "n")], FACT + ", note string").write.parquet(f"{tmp_path}/f")
    text = sales_summary(spark.read.parquet(f"{tmp_path}/f"), spark.read.parquet(f"{tmp_path}/d"))._jdf.queryExecution().executedPlan().toString()
    assert "note" not in text and "category" not in text and "brand" not in text


def test_repeated_lookup_keys_keep_the_sums_type(spark):
    fact = spark.createDataFrame([("a", 1)], "k string, n int").withColumn("m", F.lit(1.25).cast("decimal(10,2)"))
    dim = spark.createDataFrame([("a", "A"), ("a", "A")], "k string, name string")
    out = summarise_with_lookup(fact, dim, "k", [], ["name"], [Sum("s", F.col("m")), Sum("n", F.col("n"))])
    assert out.schema["s"].dataType.simpleString() == "decimal(20,2)"
    assert [(r.k, r.name, float(r.s), r.n) for r in out.collect()] == [("a", "A", 2.5, 2)]


def test_flag_orphans(spark):
    fact = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "fk string, n int")
    dim = spark.createDataFrame([("a",), ("a",), (None,)], "id string")
    out = flag_orphans(fact, dim, "fk", lookup_key="id")
    assert rows(out) == [("a", 1, False), ("b", 2, True), (None, 3, True)]
