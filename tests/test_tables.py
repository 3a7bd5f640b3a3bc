import datetime as dt
import os
import subprocess
import sys
import uuid
from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierforge import Contract
from tierforge.plans import (
    bronze_load,
    bronze_rows,
    load_bronze,
    load_facts,
    load_gold,
    load_silver,
)
from tierforge.sinks import (
    ConcurrentWrite,
    create_if_missing,
    create_or_replace,
    drop_old,
    merge_into,
    newest,
    overwrite,
    read_table,
    show,
    upsert_native,
    upsert_partitions,
    upsert_path,
    upsert_table,
    write_by_contract,
)
from tierforge.operators import dedupe_on_keys, merge_rows
from tierforge.sinks.layout import by_partition
from tierforge.sinks.snapshots import publish
from tierforge.sources import contract_scan, table_scan
from tierforge.streaming import bronze_stream
from tests.conftest import plan, rows
from workload.queries import PRODUCT, SALES

AT = dt.datetime(2024, 1, 1)


@pytest.fixture
def name():
    return f"t_{uuid.uuid4().hex}"


def contract(name, **options):
    return Contract.from_dict(
        {
            "table": name,
            "source": {"location_ref": "landing", "filename_glob": "p*.csv"},
            "columns": {"id": {"type": "long", "source": "ID"}, "v": {"type": "string", "source": "V"}},
            "primary_keys": ["id"],
            "options": options,
        }
    )


def test_overwrite_by_partition_reads_back_typed_and_pruned(spark, tmp_path):
    df = spark.range(100).selectExpr("id", "date_add(date'2024-01-01', int(id % 3)) AS day")
    overwrite(df, f"{tmp_path}/t", partition_by=["day"])
    overwrite(df, f"{tmp_path}/t", partition_by=["day"])
    back = table_scan(spark, f"{tmp_path}/t")
    assert back.schema["day"].dataType.simpleString() == "date" and back.count() == 100
    one = back.where("day = date'2024-01-02'")
    assert one.count() == 33
    assert "PartitionFilters: [isnotnull(day" in one._jdf.queryExecution().executedPlan().toString()
    # Rows of a day were brought together, so a day is one file rather than one per task.
    assert all(len(list(p.glob("part-*"))) == 1 for p in tmp_path.glob("t/day=*"))


def test_a_hot_partition_is_written_by_several_tasks(spark, conf, tmp_path):
    conf(
        spark__sql__adaptive__advisoryPartitionSizeInBytes="100KB",
        spark__sql__adaptive__rebalancePartitionsSmallPartitionFactor="0.1",
    )
    hot = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5)
    df = spark.range(0, 60_000, 1, 8).select(hot.alias("day"), F.uuid().alias("v"))
    overwrite(df, f"{tmp_path}/t", partition_by=["day"])
    assert len(list(tmp_path.glob("t/day=0/part-*"))) > 4
    assert table_scan(spark, f"{tmp_path}/t").count() == 60_000


def test_small_partitions_are_written_by_all_cores(spark, tmp_path):
    df = spark.range(0, 3000, 1, 4).selectExpr("id", "id % 300 AS day")
    dealt = by_partition(df, ["day"])
    held = dealt.select("day", F.spark_partition_id().alias("task")).distinct()
    by_task = held.groupBy("task").count()
    assert by_task.count() >= 8 and by_task.agg(F.max("count")).first()[0] < 150
    assert held.count() == 300


def test_rows_that_a_shuffle_makes_are_made_once(spark):
    df = spark.range(0, 3000, 1, 4).selectExpr("id % 1000 AS id", "id % 7 AS day", "id AS v")
    made = dedupe_on_keys(df, ["id"], ["v"])
    assert "Window" in plan(made)
    dealt = by_partition(made, ["day"])
    assert "Window" not in plan(dealt) and plan(dealt).count("Exchange") == 1
    assert rows(dealt) == rows(made)


def test_rows_of_few_large_partitions_stay_where_they_are(spark, conf, tmp_path):
    conf(spark__sql__adaptive__advisoryPartitionSizeInBytes="1KB")
    df = spark.range(0, 60_000, 1, 8).selectExpr("id % 3 AS day", "id")
    assert "Exchange" not in plan(by_partition(df, ["day"]))
    overwrite(df, f"{tmp_path}/t", partition_by=["day"])
    assert len(list(tmp_path.glob("t/day=0/part-*"))) == 8
    assert rows(table_scan(spark, f"{tmp_path}/t").select("day", "id")) == rows(df)


def test_layout_of_odd_frames(spark, conf):
    conf(spark__sql__adaptive__advisoryPartitionSizeInBytes="1KB")
    frame = spark.range(500).selectExpr("IF(id % 2 = 0, NULL, 'x') AS `a.b`", "map(id, id) AS m", "id AS __rows")
    dealt = by_partition(frame, ["a.b"])
    assert dealt.columns == frame.columns and dealt.count() == 500
    task = F.spark_partition_id().alias("task")
    assert dealt.select("`a.b`", task).where("`a.b` IS NULL").distinct().count() > 1
    assert by_partition(frame.limit(0), ["a.b"]).count() == 0


def test_overwriting_ones_own_input_is_refused(spark, tmp_path):
    spark.range(5).write.parquet(f"{tmp_path}/t")
    for path in (f"{tmp_path}/t", f"file:{tmp_path}/t/", f"{tmp_path}"):
        with pytest.raises(ValueError, match="refusing"):
            overwrite(table_scan(spark, f"{tmp_path}/t"), path)
    assert table_scan(spark, f"{tmp_path}/t").count() == 5


def test_create_if_missing(spark, tmp_path):
    path = f"{tmp_path}/t"
    create_if_missing(spark, path, PRODUCT.struct())
    assert table_scan(spark, path).dtypes[-1] == ("ingest_ts", "timestamp")
    overwrite(spark.range(3), path)
    create_if_missing(spark, path, PRODUCT.struct())
    assert table_scan(spark, path).count() == 3


def test_replacing_a_table_keeps_the_old_snapshot(spark, name, tmp_path):
    first = create_or_replace(spark.range(3), name, str(tmp_path))
    reader = spark.table(name)
    second = create_or_replace(spark.table(name).where("id > 0"), name, str(tmp_path))
    assert (first.version, second.version) == (1, 2)
    assert (reader.count(), spark.table(name).count()) == (3, 2)


def test_partition_columns_keep_their_type(spark, name, tmp_path):
    df = spark.createDataFrame([("007", 1), ("8", 2), (None, 3)], "code string, id int")
    create_or_replace(df, name, str(tmp_path), partition_by=["code"])
    assert rows(spark.table(name).select("code", "id")) == rows(df)
    upsert_table(df, name, str(tmp_path), ["id"], partition_by=["code"])
    assert rows(spark.table(name).select("code", "id")) == rows(df)
    for i in range(2):
        upsert_path(df, f"{tmp_path}/p{i}", f"{tmp_path}/p{i + 1}", ["id"], partition_by=["code"])
    types = {"code": T.StringType()}
    assert rows(table_scan(spark, f"{tmp_path}/p2", partition_types=types).select("code", "id")) == rows(df)
    cfg = {"table": "p2", "source": {"format": "parquet", "location_ref": "r"}, "partitions": ["code"]}
    stored = Contract.from_dict({**cfg, "columns": {"code": {"type": "string"}, "id": {"type": "int"}}})
    assert rows(contract_scan(spark, stored, {"r": str(tmp_path)}).select("code", "id")) == rows(df)


def test_a_table_without_rows_has_columns(spark, name, tmp_path):
    empty = spark.createDataFrame([], "day date, id int")
    create_or_replace(empty, name, str(tmp_path), partition_by=["day"])
    assert spark.table(name).columns == ["day", "id"] and spark.table(name).count() == 0
    upsert_table(spark.createDataFrame([(AT.date(), 1)], "day date, id int"), name, str(tmp_path), ["id"], partition_by=["day"])
    assert spark.table(name).count() == 1


def test_upsert_table(spark, name, tmp_path):
    rows_ = lambda *r: spark.createDataFrame(list(r), "k int, v string")
    upsert_table(rows_((1, "b"), (1, "a"), (2, "x")), name, str(tmp_path), ["k"])
    upsert_table(rows_((2, "y"), (3, "z")), name, str(tmp_path), ["k"])
    assert rows(spark.table(name)) == [(1, "a"), (2, "y"), (3, "z")]
    with pytest.raises(Exception, match="more than one row"):
        upsert_table(rows_((9, "y"), (9, "z")), name, str(tmp_path), ["k"], duplicates="raise")
    with pytest.raises(ValueError, match="at least one key"):
        upsert_table(rows_((9, "y")), name, str(tmp_path), [])
    assert spark.table(name).count() == 3


def test_upsert_partitions_leaves_the_others_alone(spark, tmp_path):
    path, keys = f"{tmp_path}/t", ["day", "id"]
    frame = lambda *r: spark.createDataFrame(list(r), "day string, id int, v string")
    files = lambda day: {f.name for f in tmp_path.glob(f"t/day={day}/part-*")}
    upsert_partitions(frame(("01", 1, "a"), ("02", 1, "b"), (None, 1, "n")), path, keys, ["day"])
    first, second = files("01"), files("02")
    changes = frame(("02", 1, "B"), ("02", 2, "C"), ("03", 1, "D"), ("03", 1, "E"))
    for _ in range(2):
        upsert_partitions(changes, path, keys, ["day"])
        back = table_scan(spark, path, partition_types={"day": T.StringType()}).select("day", "id", "v")
        expected = [("01", 1, "a"), ("02", 1, "B"), ("02", 2, "C"), ("03", 1, "D"), (None, 1, "n")]
        assert rows(back) == sorted(expected, key=repr)
    assert first == files("01") and not second & files("02")
    upsert_partitions(frame((None, 2, "m"), (None, 1, "o")), path, keys, ["day"])
    back = table_scan(spark, path, partition_types={"day": T.StringType()}).where("day is null")
    assert rows(back.select("id", "v")) == [(1, "n"), (1, "o"), (2, "m")]
    assert first == files("01")
    upsert_partitions(changes.limit(0), path, keys, ["day"])
    assert table_scan(spark, path).count() == 7
    for bad in ([], ["v"]):
        with pytest.raises(ValueError, match="must be among the keys"):
            upsert_partitions(changes, path, keys, bad)


def test_upsert_partitions_by_several_columns(spark, tmp_path):
    path, keys = f"{tmp_path}/t", ["a", "b", "id"]
    frame = lambda *r: spark.createDataFrame(list(r), "a int, b date, id int, v string")
    one, two = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    upsert_partitions(frame(*((a, b, 1, "x") for a in (1, 2) for b in (one, two))), path, keys, ["a", "b"])
    upsert_partitions(frame((1, one, 1, "y"), (2, two, 2, "z")), path, keys, ["a", "b"])
    expected = [(1, one, 1, "y"), (1, two, 1, "x"), (2, one, 1, "x"), (2, two, 1, "x"), (2, two, 2, "z")]
    assert rows(table_scan(spark, path).select("a", "b", "id", "v")) == expected


def test_write_mode_decides(spark, name, tmp_path):
    c = contract(name)
    write_by_contract(spark.createDataFrame([(1, "a")], "id long, v string"), c, str(tmp_path))
    write_by_contract(spark.createDataFrame([(2, "b", 1)], "id long, v string, more int"), c, str(tmp_path))
    assert rows(spark.table(name)) == [(1, "a", None), (2, "b", 1)]
    c = Contract.from_dict({"table": name, "columns": {"id": {"type": "long"}}})
    write_by_contract(spark.range(1), c, str(tmp_path))
    assert rows(spark.table(name)) == [(0,)]


def test_native_upsert_creates_and_then_needs_a_format_with_merge(spark, name):
    table, df = f"native_{name}", spark.createDataFrame([(1, "b", 5), (1, "a", 5)], "id int, v string, p int")
    try:
        upsert_native(df, table, ["id"], fmt="parquet", partition_by=["p"])
        assert rows(spark.table(table)) == [(1, "a", 5)]
        with pytest.raises(Exception, match="MERGE INTO TABLE"):
            upsert_native(df, table, ["id"], fmt="parquet")
        with pytest.raises(ValueError):
            merge_into(df, table, [])
    finally:
        spark.sql(f"DROP TABLE {table}")


def test_names_with_a_database(spark, name, tmp_path):
    create_or_replace(spark.range(2), f"default.{name}", str(tmp_path))
    upsert_table(spark.range(1, 4), f"default.{name}", str(tmp_path), ["id"])
    assert spark.table(f"default.{name}").count() == 4


def write_csv(path, *lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("ID,V\n" + "".join(f"{line}\n" for line in lines), "utf-8")


def test_bronze_load_and_rerun(spark, name, tmp_path):
    write_csv(tmp_path / "in/p1.csv", "1,a", "x,bad", "2,b", "2,a")
    roots, c = {"landing": f"{tmp_path}/in"}, contract(name)
    rejected = load_bronze(spark, c, roots, f"{tmp_path}/bronze", at=AT)
    assert rows(rejected) == [(None, "bad", ["id"])]
    assert rows(spark.table(name)) == [(1, "a", AT), (2, "a", AT)]
    write_csv(tmp_path / "in/sub/p2.csv", "1,c", "3,d")
    (tmp_path / "in/p1.csv").unlink()
    for _ in range(2):
        load_bronze(spark, c, roots, f"{tmp_path}/bronze", at=AT)
        assert rows(spark.table(name).drop("ingest_ts")) == [(1, "c"), (2, "a"), (3, "d")]


def test_switches(spark, name):
    raw = spark.createDataFrame([("1", "a"), ("1", "b")], "ID string, V string")
    valid, _ = bronze_rows(raw, contract(name, audit_columns=False))
    assert valid.columns == ["id", "v"]
    with pytest.raises(Exception, match="more than one row"):
        bronze_load(raw, contract(name, deduplicate_on_keys=False)).collect()


def test_overwrite_contract_replaces_and_dedupes(spark, name, tmp_path):
    c = replace(contract(name), write_mode="overwrite")
    for lines in (["(1, 'a')", "(2, 'b')"], ["('3', 'y')", "('3', 'x')"]):
        raw = spark.sql(f"SELECT string(ID) ID, V FROM VALUES {', '.join(lines)} AS t(ID, V)")
        load_bronze(spark, c, {}, str(tmp_path), raw=raw, at=AT)
    assert rows(spark.table(name)) == rows(bronze_load(raw, c, at=AT)) == [(3, "x", AT)]
    with pytest.raises(ValueError, match="only a merge"):
        bronze_stream(spark, c, "in", "out", "progress")


def test_silver_and_gold(spark, name, tmp_path):
    write_csv(tmp_path / "in/p1.csv", "1,a", "2,b")
    c = contract(name)
    load_bronze(spark, c, {"landing": f"{tmp_path}/in"}, f"{tmp_path}/bronze", at=AT)
    silver = contract(f"{name}_s")
    load_silver(spark, silver, name, f"{tmp_path}/silver", ["id", "v", "ingest_ts"])
    load_silver(spark, silver, name, f"{tmp_path}/silver", ["id", "v", "ingest_ts"])
    dim = spark.table(f"{name}_s").selectExpr("id AS product_id", "v AS product_name")
    fact = spark.createDataFrame(
        [(AT.date(), 1, 2, 3.0), (AT.date(), 9, 1, 1.0)],
        "sales_date date, product_id long, quantity int, price double",
    )
    load_gold(fact, dim, f"{tmp_path}/gold", f"{name}_g")
    back = spark.table(f"{name}_g").select("product_id", "product_name", "total_qty", "gross_revenue")
    assert rows(back) == [(1, "a", 2, 6.0), (9, None, 1, 1.0)]
    assert list(tmp_path.glob(f"gold/{name}_g/*/sales_date=2024-01-01"))


def test_stream_reads_each_file_once(spark, name, tmp_path):
    c = contract(name)

    def run():
        args = (f"{tmp_path}/in", f"{tmp_path}/bronze", f"{tmp_path}/progress")
        query = bronze_stream(spark, c, *args, at=AT)
        query.awaitTermination()
        return sum(p.numInputRows for p in query.recentProgress)

    write_csv(tmp_path / "in/p1.csv", "1,a", "x,bad")
    assert run() > 0
    write_csv(tmp_path / "in/sub/p2.csv", "1,c", "3,d")
    assert run() > 0
    assert run() == 0
    assert rows(spark.table(name).drop("ingest_ts")) == [(1, "c"), (3, "d")]
    kept = spark.read.parquet(f"{tmp_path}/bronze/{name}__rejected")
    assert rows(kept.select("v", "batch")) == [("bad", 0)]
    spark.sql(f"DROP VIEW {name}")  # as a new session would find it, with a new checkpoint
    write_csv(tmp_path / "new/p3.csv", "5,e", "y,worse")
    bronze_stream(spark, c, f"{tmp_path}/new", f"{tmp_path}/bronze", f"{tmp_path}/again", at=AT).awaitTermination()
    assert rows(spark.table(name).drop("ingest_ts")) == [(1, "c"), (3, "d"), (5, "e")]
    kept = spark.read.parquet(f"{tmp_path}/bronze/{name}__rejected")
    assert rows(kept.select("v", "batch")) == [("bad", 0), ("worse", 0)]


def test_a_table_is_found_by_path(spark, name, tmp_path):
    frame = lambda *r: spark.createDataFrame(list(r), "k int, v string")
    for buckets in (0, 4):
        root = f"{tmp_path}/{buckets}"
        for rows_ in ([(1, "a")], [(2, "b")]):
            upsert_table(frame(*rows_), name, root, ["k"], buckets=buckets)
            spark.sql(f"DROP VIEW {name}")
        assert rows(read_table(spark, root, name)) == [(1, "a"), (2, "b")]
        show(spark, root, name)
        assert rows(spark.table(name)) == [(1, "a"), (2, "b")]
    with pytest.raises(LookupError):
        read_table(spark, str(tmp_path), "none")


def test_two_processes_write_one_table(spark, name, tmp_path):
    script = """
import sys
from pyspark.sql import SparkSession
from tierforge import Contract
from tierforge.plans import load_bronze
root, name, key = sys.argv[1:]
spark = (SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false")
         .config("spark.sql.warehouse.dir", root + "/w" + key).getOrCreate())
c = Contract.from_dict({"table": name, "columns": {"id": {"type": "long", "source": "ID"}}, "primary_keys": ["id"]})
load_bronze(spark, c, {}, root, raw=spark.createDataFrame([(key,)], "ID string"))
"""
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for key in "12":
        run = [sys.executable, "-c", script, str(tmp_path), name, key]
        subprocess.run(run, check=True, cwd=repo, capture_output=True, timeout=300)
    assert rows(read_table(spark, str(tmp_path), name).select("id")) == [(1,), (2,)]


def test_a_write_that_started_from_an_older_state_fails(spark, name, tmp_path):
    root = str(tmp_path)
    create_or_replace(spark.range(2), name, root)
    before = newest(spark, root, name)
    upsert_table(spark.range(5, 6), name, root, ["id"])
    with pytest.raises(ConcurrentWrite):
        publish(spark.range(9), root, name, before)
    assert rows(read_table(spark, root, name)) == [(0,), (1,), (5,)]


def test_rows_of_others_are_not_taken_for_no_table(spark, name, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/{name}")
    with pytest.raises(ValueError, match="no published snapshot"):
        upsert_table(spark.range(1), name, str(tmp_path), ["id"])
    assert table_scan(spark, f"{tmp_path}/{name}").count() == 3


def test_a_target_in_buckets_is_not_shuffled(spark, conf, name, tmp_path):
    root = str(tmp_path)
    rows_ = spark.range(400).selectExpr("id", "string(id) AS v", "date_add(date'2024-01-01', int(id % 2)) AS day")
    upsert_table(rows_, name, root, ["id"], buckets=8)
    first = newest(spark, root, name)
    assert (first.buckets, first.keys) == (8, ("id",))
    assert len(list(tmp_path.glob(f"{name}/{first.folder}/part-*"))) == 8
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    for partitions in ("4", "200"):
        conf(spark__sql__shuffle__partitions=partitions)
        target, source = read_table(spark, root, name), rows_.repartition(8, "id")
        shown = plan(merge_rows(target, source, ["id"], duplicates="trust", colocated=True))
        assert shown.count("Exchange") == 1 and "Bucketed: true" in shown
        assert shown.index("Bucketed: true") < shown.index("Exchange")
    one = spark.sql("SELECT 7 AS ID, 'new' AS v, date'2024-02-01' AS day, 1 AS more")
    upsert_table(one, name, root, ["id"], add_columns=True)
    now = newest(spark, root, name)
    assert len(list(tmp_path.glob(f"{name}/{now.folder}/part-*"))) == 8
    back = read_table(spark, root, name)
    assert back.count() == spark.table(name).count() == 400
    assert rows(back.where("id = 7 or id = 8").select("id", "v", "more")) == [(7, "new", 1), (8, "8", None)]
    upsert_table(one.limit(0), name, root, ["id"], add_columns=True)
    assert newest(spark, root, name) == now
    with pytest.raises(ValueError, match="stored by"):
        upsert_table(one, name, root, ["v"], add_columns=True)


def test_buckets_and_partitions(spark, name, tmp_path):
    rows_ = spark.range(40).selectExpr("id", "id % 2 AS side", "'a' AS v")
    upsert_table(rows_, name, str(tmp_path), ["id"], buckets=2, partition_by=["side"])
    upsert_table(rows_.where("id > 30").selectExpr("id", "side", "'b' AS v"), name, str(tmp_path), ["id"])
    back = read_table(spark, str(tmp_path), name)
    assert rows(back.groupBy("v").count()) == [("a", 31), ("b", 9)]
    assert list(tmp_path.glob(f"{name}/data-*/side=1/part-*"))


def test_null_keys_in_buckets(spark, name, tmp_path):
    frame = lambda *r: spark.createDataFrame(list(r), "a long, b string, v int")
    upsert_table(frame((1, None, 1), (1, "x", 1)), name, str(tmp_path), ["a", "b"], buckets=4)
    upsert_table(frame((1, None, 2), (1, "x", 2)), name, str(tmp_path), ["a", "b"])
    assert rows(read_table(spark, str(tmp_path), name)) == [(1, "x", 2), (1, None, 1), (1, None, 2)]


def test_old_snapshots_are_dropped(spark, name, tmp_path):
    for k in range(4):
        create_or_replace(spark.range(k), name, str(tmp_path))
    gone = drop_old(spark, str(tmp_path), name, keep=2)
    assert len(gone) == 2 and len(list(tmp_path.glob(f"{name}/data-*"))) == 2
    assert read_table(spark, str(tmp_path), name).count() == 3
    create_or_replace(spark.range(9), name, str(tmp_path))
    assert newest(spark, str(tmp_path), name).version == 5


def test_upserts_leave_nothing_staged(spark, name, tmp_path):
    scratch = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(scratch.iterdir())
    for _ in range(2):
        upsert_table(spark.range(9), name, str(tmp_path), ["id"], buckets=2)
        upsert_partitions(spark.range(9).selectExpr("id", "id % 2 AS p"), f"{tmp_path}/p", ["id", "p"], ["p"])
    assert set(scratch.iterdir()) == before


def test_an_absent_required_column_rejects_all(spark, name):
    cfg = {"table": name, "columns": {"id": {"type": "long", "source": "ID"}, "qty": {"type": "int"}}, "primary_keys": ["id"]}
    c = Contract.from_dict(cfg)
    c = replace(c, columns=(c.columns[0], replace(c.columns[1], nullable=False)))
    raw = spark.createDataFrame([("1",), ("2",)], "ID string")
    valid, rejected = bronze_rows(raw, c, at=AT)
    assert valid.count() == 0 and rows(rejected.select("id", "null_columns")) == [(1, ["qty"]), (2, ["qty"])]
    with pytest.raises(Exception, match="qty is declared not null"):
        bronze_rows(raw, c, at=AT, nulls="fail")[0].collect()
    with pytest.raises(ValueError, match="unknown way"):
        bronze_rows(raw, c, nulls="maybe")


def test_facts_are_stored_by_contract(spark, name, tmp_path):
    c = replace(SALES, table=name)
    raw = spark.createDataFrame(
        [("1", "p", "2", "3.5", "2024-01-01"), ("2", "q", "1", "1", "2024-01-02"), ("3", "p", None, "1", "2024-01-02")],
        ", ".join(f"`{h}` string" for h in c.headers),
    )
    dim = spark.createDataFrame([("p",)], "product_id string")
    for _ in range(2):
        rejected = load_facts(raw, c, dim, "product_id", str(tmp_path), buckets=2)
        assert rows(rejected.select("sales_id", "null_columns")) == [("3", ["quantity"])]
    back = read_table(spark, str(tmp_path), name)
    assert rows(back.select("sales_id", "is_orphan")) == [("1", False), ("2", True)]
    assert list(tmp_path.glob(f"{name}/data-*/sales_date=2024-01-02"))
