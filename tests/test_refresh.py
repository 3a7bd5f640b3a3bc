import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from tierforge import Contract
from tierforge.operators import are_spread, dedupe_on_keys, merge_rows
from tierforge.plans import (
    days_of,
    load_bronze,
    load_facts,
    load_gold,
    refresh_gold,
    sales_summary,
    touched_days,
)
from tierforge.plans.gold import facts_on
from tierforge.sinks import layout, read_table, upsert_table
from tierforge.sinks.layout import by_partition, rows_by
from tierforge.sources import table_scan
from tests.conftest import SF, plan, rows
from workload import queries

FACT = "sales_id int, sales_date date, product_id int, quantity int, price double"
SUMMARY = ("sales_date", "product_id", "product_name", "total_qty", "gross_revenue")


def day(n):
    return None if n is None else dt.date(2024, 1, n)


@pytest.fixture
def facts(spark):
    sold = [(k, day(1 + k % 4), k % 3, 1 + k, 2.0) for k in range(24)]
    return spark.createDataFrame([*sold, (24, None, 1, 1, 1.0), (25, day(9), 1, 1, 1.0)], FACT)


@pytest.fixture
def products(spark):
    return spark.createDataFrame([(0, "a"), (1, "b")], "product_id int, product_name string")


def stored(spark, path):
    return rows(table_scan(spark, path).select(*SUMMARY))


def files(tmp_path):
    return {p.parent.name: p.name for p in tmp_path.glob("gold/sales_date=*/part-*")}


def test_only_the_changed_days_are_written(spark, tmp_path, facts, products):
    path = f"{tmp_path}/gold"
    refresh_gold(facts, products, path, facts.select("sales_date"))
    assert stored(spark, path) == rows(sales_summary(facts, products).select(*SUMMARY))
    before = files(tmp_path)
    assert len(before) == 6
    # One sale of the 2nd moves to the 3rd, one of no day comes to the 5th, the only one of the 9th too.
    source = spark.createDataFrame(
        [(1, day(3), 1, 9, 1.0), (24, day(5), 1, 1, 1.0), (25, day(5), 0, 1, 1.0)], FACT
    )
    days = touched_days(facts, source, ["sales_id"])
    assert rows(days) == rows(spark.createDataFrame([(day(n),) for n in (2, 3, 5, 9, None)], "d date"))
    changed = merge_rows(facts, source, ["sales_id"])
    for _ in range(2):
        refresh_gold(changed, products, path, days)
        assert stored(spark, path) == rows(sales_summary(changed, products).select(*SUMMARY))
    after = files(tmp_path)
    assert set(before) - set(after) == {"sales_date=2024-01-09", "sales_date=__HIVE_DEFAULT_PARTITION__"}
    assert {d for d in after if before.get(d) != after[d]} == {f"sales_date=2024-01-0{n}" for n in (2, 3, 5)}
    refresh_gold(changed, products, path, days.limit(0))
    assert files(tmp_path) == after


def test_a_product_touches_the_days_it_was_sold_on(spark, tmp_path, facts, products):
    path = f"{tmp_path}/gold"
    refresh_gold(facts, products, path, facts.select("sales_date"))
    before = files(tmp_path)
    renamed = spark.createDataFrame([(2, "c"), (7, "z")], "product_id int, product_name string")
    some = facts.where("product_id <> 2 or sales_date = date'2024-01-01'")
    refresh_gold(some, products, path, facts.select("sales_date"))
    before = files(tmp_path)
    days = days_of(some, renamed)
    assert rows(days) == [(day(1),)]
    refresh_gold(some, products.unionByName(renamed), path, days)
    assert stored(spark, path) == rows(sales_summary(some, products.unionByName(renamed)).select(*SUMMARY))
    assert {d for d, f in files(tmp_path).items() if before[d] != f} == {"sales_date=2024-01-01"}


def test_facts_stored_by_day_are_read_on_the_changed_days_only(spark, tmp_path, facts):
    facts.write.partitionBy("sales_date").parquet(f"{tmp_path}/facts")
    kept = spark.read.parquet(f"{tmp_path}/facts")
    days = spark.createDataFrame([(day(2),), (day(3),), (None,)], "sales_date date")
    some = facts_on(kept, days)
    assert "PartitionFilters: [(((sales_date" in plan(some) and some.count() == 13
    assert facts_on(kept, days.where("sales_date IS NULL")).count() == 1
    assert facts_on(kept, days.limit(0)).count() == 0


def contract(name):
    cfg = {"table": name, "columns": {"id": {"type": "int", "source": "ID"}, "v": {"type": "string", "source": "V"}}}
    return Contract.from_dict(cfg | {"primary_keys": ["id"], "source": {"location_ref": "land"}})


@pytest.mark.parametrize("buckets", [0, 4])
def test_figures_of_upserts(spark, tmp_path, buckets):
    frame = lambda *r: spark.createDataFrame(list(r), "k int, v string")
    root, name = str(tmp_path), f"figures_{buckets}"
    told = []
    loads = [[(1, "a"), (1, "b"), (None, "n")], [(1, "c"), (2, "d"), (3, "e"), (None, "n")], []]
    for load in loads:
        figures = {}
        upsert_table(frame(*load), name, root, ["k"], buckets=buckets, figures=figures)
        told.append(figures)
    # A row without a key matches nothing.
    assert told == [{"inserted": 2, "updated": 0}, {"inserted": 3, "updated": 1}, {"inserted": 0, "updated": 0}]
    assert read_table(spark, root, name).count() == 5


def test_figures_of_a_load_cost_no_job(spark, tmp_path):
    (tmp_path / "land").mkdir()
    (tmp_path / "land/a.csv").write_text("ID,V\n1,a\n1,b\n2,c\nx,d\n3,e,SURPLUS\n")

    def load(name, **options):
        group = f"load {uuid.uuid4().hex}"
        spark.sparkContext.setJobGroup(group, group)
        try:
            load_bronze(spark, contract(name), {"land": f"{tmp_path}/land"}, str(tmp_path), quarantine=True, **options)
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    figures = {}
    assert load("counted", figures=figures) == load("plain")
    assert figures == {"read": 4, "quarantined": 1, "rejected": 1, "inserted": 2, "updated": 0}
    load("counted", figures=figures)
    assert (figures["inserted"], figures["updated"]) == (0, 2)


def test_changed_days_choose_among_equal_keys_once(spark, monkeypatch):
    seen = []

    def noted(facts, *rest):
        seen.append(plan(facts))
        return refresh_gold(facts, *rest)

    monkeypatch.setattr(queries, "refresh_gold", noted)
    queries.gold_changed_days(spark, SF)
    assert len(seen) == 2 and "Window" not in seen[0]
    assert "l_orderkey" not in seen[0] + seen[1]


def test_a_load_reads_its_source_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def read(k):
        seen.add(1)
        return None if k % 10 == 0 else str(k % 50)

    made = spark.range(100).repartition(2).select(read("id").alias("id"), F.col("id").alias("v"))
    c = Contract(table=f"t_{uuid.uuid4().hex}", columns=(), keys=("id",))
    rejected = load_bronze(spark, c, {}, str(tmp_path), raw=made, at=dt.datetime(2024, 1, 1))
    assert seen.value == 100
    assert rows(rejected.select("v")) == rows(spark.range(0, 100, 10))
    # Of two rows of a key the smaller stays.
    stored = read_table(spark, str(tmp_path), c.table).select("id", "v")
    assert rows(stored) == sorted(((str(k), k) for k in range(50) if k % 10), key=repr)


def test_rows_of_spread_keys_are_sorted_once(spark, conf):
    conf(spark__sql__adaptive__enabled="false")
    df = spark.range(40_000).selectExpr("id % 30000 AS k", "id AS v")
    assert are_spread(df, ["k"])
    hot = df.unionByName(spark.range(40_000).selectExpr("7 AS k", "id AS v"))
    assert not are_spread(hot, ["k"]) and not are_spread(df.limit(0), ["k"])
    once, twice = dedupe_on_keys(df, ["k"], spread=True), dedupe_on_keys(df, ["k"])
    assert (plan(once).count("Sort ["), plan(twice).count("Sort [")) == (1, 2)
    assert plan(once).count("Exchange") == 1
    assert rows(once) == rows(twice) == [(k, k) for k in sorted(range(30_000), key=lambda k: repr((k, k)))]


def test_rows_of_a_known_number_are_dealt_without_being_staged(spark, conf):
    conf(spark__sql__adaptive__advisoryPartitionSizeInBytes="4KB")
    df = spark.range(0, 6000, 1, 4).selectExpr("id % 3000 AS id", "IF(id % 3 = 0, 1, id % 7 + 2) AS day", "id AS v")
    made = dedupe_on_keys(df, ["id"], ["v"])
    dealt = by_partition(made, ["day"], rows_by(df, ["day"]))
    assert "Window" in plan(dealt)
    assert rows(dealt) == rows(made)
    # The day that is larger than the others is cut into pieces.
    held = dealt.select("day", F.spark_partition_id().alias("task")).distinct()
    assert held.where("day = 1").count() > 2


def test_facts_and_their_summary_are_counted_without_being_made(spark, tmp_path, facts, products, monkeypatch):
    staged, stage = [], layout.stage
    monkeypatch.setattr(layout, "stage", lambda df, label: staged.append(label) or stage(df, label))
    c = Contract.from_dict(
        {
            "table": f"t_{uuid.uuid4().hex}",
            "source": {"format": "parquet", "location_ref": "r"},
            "columns": {n: {"type": t} for n, t in (f.split() for f in FACT.split(", "))},
            "primary_keys": ["sales_id"],
            "partitions": ["sales_date"],
        }
    )
    facts.write.parquet(f"{tmp_path}/facts")
    kept = table_scan(spark, f"{tmp_path}/facts")
    load_facts(kept, c, products, "product_id", str(tmp_path), keys_unique=True)
    table = read_table(spark, str(tmp_path), c.table)
    assert rows(table.drop("is_orphan").select(*facts.columns)) == rows(facts)
    name = f"t_{uuid.uuid4().hex}"
    load_gold(table, products, str(tmp_path), name)
    assert rows(read_table(spark, str(tmp_path), name).select(*SUMMARY)) == rows(sales_summary(facts, products).select(*SUMMARY))
    assert staged == ["partitions", "partitions"]
