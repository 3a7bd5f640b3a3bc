from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierforge.operators import dedupe_on_keys, key_predicate, merge_rows, require_unique
from tierforge.operators.widening import wider
from tierforge.sinks import newest, read_table, upsert_partitions, upsert_path, upsert_table
from tierforge.sources import table_scan
from tests.conftest import plan, rows

TARGET, SOURCE = "k int, g int, old string, v string", "v string, g int, k int, new string"
key = st.one_of(st.none(), st.integers(0, 4))
word = st.one_of(st.none(), st.sampled_from("abc"))


def model(target, source):
    """The upsert on Python rows: first row per key, then match by equality."""
    first, loose = {}, []
    for v, g, k, new in sorted(source, key=lambda r: [(x is not None, x) for x in (r[0], r[3])]):
        if k is None or g is None:
            loose.append((k, g, None, v, new))
        else:
            first.setdefault((k, g), (v, new))
    out = [
        (k, g, old, *first[k, g]) if (k, g) in first else (k, g, old, v, None)
        for k, g, old, v in target
    ]
    held = {(k, g) for k, g, _, _ in target}
    out += [(k, g, None, *r) for (k, g), r in first.items() if (k, g) not in held]
    return Counter(out + loose)


@settings(max_examples=20, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(key, key, word, word), max_size=25), st.lists(st.tuples(word, key, key, word), max_size=25))
def test_merge_equals_model(spark, target, source):
    t, s = spark.createDataFrame(target, TARGET), spark.createDataFrame(source, SOURCE)
    for colocated in (False, True):
        out = merge_rows(t, s, ["k", "g"], add_columns=True, colocated=colocated)
        assert out.columns == ["k", "g", "old", "v", "new"]
        assert Counter(map(tuple, out.collect())) == model(target, source)


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(key, key, word, word), max_size=25), st.lists(st.tuples(word, key, key, word), max_size=25))
def test_stored_merge_equals_model(spark, tmp_path_factory, target, source):
    root = tmp_path_factory.mktemp("merge")
    spark.createDataFrame(target, TARGET).write.parquet(f"{root}/0")
    s = spark.createDataFrame(source, SOURCE)
    upsert_path(s, f"{root}/0", f"{root}/1", ["k", "g"], add_columns=True)
    assert Counter(map(tuple, table_scan(spark, f"{root}/1").collect())) == model(target, source)


def test_merging_twice_changes_nothing(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    s = spark.createDataFrame([(2, "B"), (3, "C"), (3, "D")], "k int, v string")
    once = merge_rows(t, s, ["k"])
    assert rows(once) == rows(merge_rows(once, s, ["k"])) == [(1, "a"), (2, "B"), (3, "C")]


def test_first_load_is_unique_too(spark):
    s = spark.createDataFrame([(1, "b"), (1, "a"), (None, "x"), (None, "x")], "k int, v string")
    assert rows(merge_rows(None, s, ["k"])) == [(1, "a"), (None, "x"), (None, "x")]


def test_repeated_target_keys_are_all_updated(spark):
    t = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    s = spark.createDataFrame([(1, "z")], "k int, v string")
    assert rows(merge_rows(t, s, ["k"])) == [(1, "z"), (1, "z")]


def test_source_takes_the_targets_types(spark):
    t = spark.createDataFrame([(1, 2.5)], "k bigint, v double")
    s = spark.createDataFrame([(1, 7), (2, 8)], "k int, v int")
    out = merge_rows(t, s, ["k"])
    assert out.schema.simpleString() == "struct<k:bigint,v:double>"
    assert rows(out) == [(1, 7.0), (2, 8.0)]


def test_duplicates_raise_on_request(spark):
    s = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c")], "k int, v string")
    with pytest.raises(Exception, match="more than one row for a key"):
        merge_rows(s, s, ["k"], duplicates="raise").collect()
    assert require_unique(s.where("v <> 'b'"), ["k"]).count() == 2
    with pytest.raises(ValueError):
        merge_rows(s, s, ["k"], duplicates="maybe")


def test_refusals_before_any_job(spark):
    t, s = spark.range(1).toDF("k"), spark.createDataFrame([(1, 2)], "k bigint, n int")
    with pytest.raises(ValueError, match="at least one key"):
        merge_rows(t, s, [])
    with pytest.raises(ValueError, match="lacks key"):
        merge_rows(t, s, ["n"])
    with pytest.raises(ValueError, match="columns the target lacks"):
        merge_rows(t, s, ["k"])


def test_keys_known_to_be_present_take_no_second_scan(spark):
    s = spark.createDataFrame([(1, "b"), (1, "a")], "k int, v string")
    out = merge_rows(None, s, ["k"], keys_present=True)
    assert rows(out) == [(1, "a")] and "Union" not in plan(out)
    out = merge_rows(s.limit(1), s, ["k"], keys_present=True)
    assert plan(out).count("Union") == 1 and plan(out).count("isnull(k") == 0
    assert rows(out) == [(1, "a")]


def test_key_predicate(spark):
    t = spark.createDataFrame([(1, 1), (1, None)], "a int, b int")
    sides = ([F.col(f"{side}.{k}") for k in ("a", "b")] for side in "ts")
    assert t.alias("t").join(t.alias("s"), key_predicate(*sides)).count() == 1


def test_dedupe_order(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 9, "b"), (1, 9, "c"), (None, 1, "n"), (None, 0, "m")], "k int, o int, v string")
    assert rows(dedupe_on_keys(df, ["k"])) == [(1, 5, "a"), (None, 0, "m")]
    assert rows(dedupe_on_keys(df, ["k"], [F.col("o").desc()])) == [(1, 9, "b"), (None, 1, "n")]
    assert rows(dedupe_on_keys(df, ["k", "o", "v"])) == rows(df)
    with pytest.raises(ValueError):
        dedupe_on_keys(df, [])


def test_dedupe_is_limited_before_the_shuffle(spark):
    df = spark.range(10).select((F.col("id") % 2).alias("k"), "id")
    text = plan(dedupe_on_keys(df, ["k"]))
    assert text.index("row_number(), 1, Final") < text.index("Exchange") < text.index("row_number(), 1, Partial")
    text = plan(require_unique(df, ["k"]))
    assert text.index("Exchange") < text.index("row_number(), 2, Partial")


def test_small_source_leaves_the_target_unshuffled(spark, tmp_path):
    spark.range(100_000).selectExpr("id k", "id * 2 v").write.parquet(f"{tmp_path}/t")
    spark.range(10).selectExpr("id + 99995 k", "id v").write.parquet(f"{tmp_path}/s")
    t, s = table_scan(spark, f"{tmp_path}/t"), table_scan(spark, f"{tmp_path}/s")
    text = plan(merge_rows(t, s, ["k"], duplicates="trust"))
    assert "SortMergeJoin" not in text and text.count("BroadcastHashJoin") == 2
    assert "Exchange hashpartitioning" not in text
    assert merge_rows(t, s, ["k"], duplicates="trust").count() == 100_005


def test_a_merge_scans_each_side_twice_at_most(spark, conf, tmp_path):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    spark.range(1000).selectExpr("id k", "id * 2 v").write.parquet(f"{tmp_path}/t")
    spark.range(10).selectExpr("if(id < 2, null, id + 995) k", "id v").write.parquet(f"{tmp_path}/s")
    t, s = table_scan(spark, f"{tmp_path}/t"), table_scan(spark, f"{tmp_path}/s")
    out = merge_rows(t, s, ["k"])
    assert out.count() == 1007
    assert plan(out).count("FileScan") <= 4
    assert plan(out).count("Exchange") <= 4


def test_names_in_another_case(spark):
    t = spark.createDataFrame([(1, "a")], "Id int, Flag string")
    s = spark.createDataFrame([(1, "b", 1), (2, "c", 2)], "ID int, flag string, more int")
    out = merge_rows(t, s, ["id"], add_columns=True)
    assert out.columns == ["Id", "Flag", "more"]
    assert rows(out) == [(1, "b", 1), (2, "c", 2)]
    with pytest.raises(ValueError, match=r"lacks: \['more'\]"):
        merge_rows(t, s, ["id"])


def _skewed(conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__shuffle__partitions="16",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB",
        spark__sql__adaptive__coalescePartitions__enabled="false",
    )


def test_hot_target_key_is_split(spark, conf, tmp_path):
    _skewed(conf)
    hot = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id"))
    spark.range(0, 60_000, 1, 8).select(hot.alias("k"), F.uuid().alias("v")).write.parquet(f"{tmp_path}/t")
    spark.range(30_000).selectExpr("id k", "'new' v").write.parquet(f"{tmp_path}/s")
    t, s = table_scan(spark, f"{tmp_path}/t"), table_scan(spark, f"{tmp_path}/s")
    out = merge_rows(t, s, ["k"], duplicates="trust").select("k", "v")
    # 20001 rows of the hot key, 19999 others, and the 10000 keys the target lacks.
    assert sum(r.v == "new" for r in out.collect()) == 50_000
    assert "SortMergeJoin(skew=true)" in plan(out)


def test_hot_fact_key_is_split_when_flagging_orphans(spark, conf, tmp_path):
    from tierforge.operators import flag_orphans

    _skewed(conf)
    hot = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id"))
    spark.range(0, 60_000, 1, 8).select(hot.alias("k"), F.uuid().alias("v")).write.parquet(f"{tmp_path}/f")
    spark.range(30_000).selectExpr("id k").write.parquet(f"{tmp_path}/d")
    f, d = table_scan(spark, f"{tmp_path}/f"), table_scan(spark, f"{tmp_path}/d")
    out = flag_orphans(f, d, "k", lookup_unique=True)
    assert sum(r.is_orphan for r in out.collect()) == 20_000
    assert "SortMergeJoin(skew=true)" in plan(out)


@pytest.mark.parametrize(
    "a, b, wide",
    [
        ("tinyint", "int", "int"), ("int", "bigint", "bigint"), ("int", "double", "double"),
        ("int", "float", "double"), ("float", "double", "double"), ("bigint", "double", None),
        ("bigint", "decimal(5,2)", "decimal(21,2)"), ("decimal(10,0)", "decimal(5,4)", "decimal(14,4)"),
        ("decimal(38,0)", "decimal(5,4)", None), ("string", "int", None), ("date", "timestamp_ntz", "timestamp_ntz"),
        ("date", "timestamp", None), ("boolean", "int", None), ("void", "date", "date"),
        ("array<int>", "array<bigint>", "array<bigint>"), ("array<int>", "array<string>", None),
        ("map<int,int>", "map<bigint,double>", "map<bigint,double>"),
        ("struct<a:int,b:string>", "struct<A:bigint,b:string>", "struct<a:bigint,b:string>"),
        ("struct<a:int>", "struct<b:int>", None),
    ],
)
def test_wider_types(spark, a, b, wide):
    def of(kind):
        return T.NullType() if kind == "void" else T._parse_datatype_string(f"x {kind}")[0].dataType

    for x, y in ((a, b), (b, a)):
        got = wider(of(x), of(y))
        assert (got and got.simpleString().lower()) == wide


def test_a_merge_widens_or_raises_before_any_job(spark):
    big = 2**40
    t = spark.createDataFrame([(1, 1, 1), (2, 2, 2)], "k int, v int, w smallint")
    s = spark.createDataFrame([(2, big, 0.5), (big, 3, 1.5)], "k bigint, V bigint, w double")
    for colocated in (False, True):
        got = merge_rows(t, s, ["k"], colocated=colocated)
        assert got.dtypes == [("k", "bigint"), ("v", "bigint"), ("w", "double")]
        assert rows(got) == [(1, 1, 1.0), (big, 3, 1.5), (2, big, 0.5)]
    # A narrower source leaves the target's types as they are.
    assert merge_rows(s, t, ["k"]).dtypes == [("k", "bigint"), ("V", "bigint"), ("w", "double")]
    failing = s.withColumn("V", F.raise_error(F.lit("a job ran")).cast("string"))
    with pytest.raises(ValueError, match=r"no type holds .* v \(int, string\)"):
        merge_rows(t, failing, ["k"])


def test_stored_tables_widen(spark, tmp_path):
    frame = lambda kind, *r: spark.createDataFrame(list(r), f"k {kind}, v {kind}")
    big = 2**40
    for buckets in (0, 4):
        name, root = f"wide_{buckets}", str(tmp_path)
        upsert_table(frame("int", (1, 1), (2, 2)), name, root, ["k"], buckets=buckets)
        for _ in range(2):
            upsert_table(frame("bigint", (2, big), (big, 3)), name, root, ["k"])
            upsert_table(frame("smallint", (1, 9)), name, root, ["k"])
        assert rows(read_table(spark, root, name)) == [(1, 9), (big, 3), (2, big)]
        assert newest(spark, root, name).buckets == buckets
    upsert_partitions(frame("int", (1, 1)), f"{tmp_path}/p", ["k", "v"], ["k"])
    with pytest.raises(ValueError, match="all partitions"):
        upsert_partitions(frame("bigint", (1, big)), f"{tmp_path}/p", ["k", "v"], ["k"])
