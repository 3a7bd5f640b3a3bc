import uuid

import pytest

from tierforge.plans import UnsupportedStatement, run_statement
from tierforge.sinks import newest, read_table
from tests.conftest import rows

MERGE = """MERGE INTO delta.`{root}/t` AS old USING {new} AS new ON {on}
WHEN MATCHED THEN {update} WHEN NOT MATCHED THEN {insert}"""


@pytest.fixture
def run(spark, tmp_path):
    def call(text, values=None, **relations):
        return run_statement(spark, text, relations, values, {"root": str(tmp_path)})

    return call


@pytest.fixture
def merge(run):
    def call(new, on="old.id = new.id", update="UPDATE SET *", insert="INSERT *"):
        text = MERGE.replace("{on}", on).replace("{update}", update).replace("{insert}", insert)
        return run(text, new=new)

    return call


def frame(spark, *values, schema="id int, v string"):
    return spark.createDataFrame(list(values), schema)


def test_merge_creates_and_updates(spark, run, merge, tmp_path):
    assert rows(merge(frame(spark, (1, "a"), (2, "b")))) == [(1, "a"), (2, "b")]
    assert rows(merge(frame(spark, (2, "B"), (3, "c")))) == [(1, "a"), (2, "B"), (3, "c")]
    assert newest(spark, str(tmp_path), "t").version == 2
    # As text the table is found wherever a query names its path.
    assert run("SELECT count(*) AS n FROM delta.`{root}/t` x").first()["n"] == 3
    assert run("SELECT v FROM parquet.`{root}/t` WHERE id = :i", {"i": 3}).first()["v"] == "c"


def test_merge_by_several_keys_either_way_round(spark, merge):
    kind = "id int, k string, v string"
    on = "(new.ID = old.id AND old.k = new.k)"
    merge(frame(spark, (1, "x", "a"), (1, "y", "b"), (None, "y", "n"), schema=kind), on)
    got = merge(frame(spark, (1, "y", "B"), (2, "y", "c"), (None, "y", "m"), schema=kind), on)
    assert rows(got) == rows(
        frame(spark, (1, "x", "a"), (1, "y", "B"), (2, "y", "c"), (None, "y", "n"), (None, "y", "m"), schema=kind)
    )


def test_merge_of_listed_columns(spark, merge):
    merge(frame(spark, (1, "a", 1.0), schema="id int, v string, w double"))
    got = merge(
        frame(spark, (1, "A", 9.0), (2, "B", 9.0), schema="id int, v string, w double"),
        update="UPDATE SET old.v = new.v",
        insert="INSERT (id, v) VALUES (new.id, new.v)",
    )
    assert rows(got) == [(1, "A", 1.0), (2, "B", None)]


def test_merge_with_schema_evolution(spark, run, merge):
    merge(frame(spark, (1, "a")))
    wider = frame(spark, (1, "b", True), schema="id int, v string, w boolean")
    with pytest.raises(ValueError, match="the target lacks"):
        merge(wider)
    text = MERGE.replace("MERGE INTO", "MERGE WITH SCHEMA EVOLUTION INTO").replace("{on}", "old.id = new.id")
    got = run(text.replace("{update}", "UPDATE SET *").replace("{insert}", "INSERT *"), new=wider)
    assert rows(got) == [(1, "b", True)]


@pytest.mark.parametrize(
    "change",
    [
        {"on": "old.id = new.id OR old.v = new.v"},
        {"on": "old.id = new.v"},
        {"on": "old.id = 1"},
        {"on": "id = new.id"},
        {"on": "old.id <=> new.id"},
        {"update": "DELETE"},
        {"update": "UPDATE SET old.v = new.v"},
        {"update": "UPDATE SET old.v = upper(new.v)", "insert": "INSERT (id, v) VALUES (new.id, new.v)"},
        {"update": "UPDATE SET old.v = new.v", "insert": "INSERT (v) VALUES (new.v)"},
        {"insert": "INSERT * WHEN NOT MATCHED BY SOURCE THEN DELETE"},
    ],
)
def test_merges_that_cannot_be_carried_out_raise_and_write_nothing(spark, merge, tmp_path, change):
    with pytest.raises(UnsupportedStatement):
        merge(frame(spark, (1, "a")), **change)
    assert newest(spark, str(tmp_path), "t") is None


def test_a_conditional_clause_raises(spark, run):
    text = MERGE.replace("{on}", "old.id = new.id").replace("WHEN MATCHED", "WHEN MATCHED AND new.id > 1")
    with pytest.raises(UnsupportedStatement):
        run(text.replace("{update}", "UPDATE SET *").replace("{insert}", "INSERT *"), new=frame(spark, (1, "a")))


def test_a_source_key_that_repeats_raises(spark, merge):
    with pytest.raises(Exception, match="(?i)repeat|duplicate|more than"):
        merge(frame(spark, (1, "a"), (1, "b")))


def test_create_replace_and_partitions(spark, run, tmp_path):
    day = "CREATE OR REPLACE TABLE delta.`{root}/t` USING DELTA PARTITIONED BY (Day) AS SELECT id, id % 2 AS day FROM {r}"
    assert run(day, r=spark.range(4)).count() == 4
    assert newest(spark, str(tmp_path), "t").partition_by == ("day",)
    # The table may be made of itself.
    run("CREATE OR REPLACE TABLE delta.`{root}/t` AS SELECT id FROM delta.`{root}/t` WHERE day = 1")
    assert rows(read_table(spark, str(tmp_path), "t")) == [(1,), (3,)]
    run("CREATE TABLE IF NOT EXISTS delta.`{root}/t` USING DELTA AS SELECT 7 AS id")
    assert rows(read_table(spark, str(tmp_path), "t")) == [(1,), (3,)]
    with pytest.raises(ValueError, match="there is a table"):
        run("CREATE TABLE delta.`{root}/t` USING DELTA AS SELECT 7 AS id")
    with pytest.raises(LookupError):
        run("REPLACE TABLE delta.`{root}/other` USING DELTA AS SELECT 7 AS id")


def test_create_with_columns_then_merge(spark, run, merge):
    made = run("CREATE TABLE IF NOT EXISTS delta.`{root}/t` (id INT, v STRING, at TIMESTAMP) USING DELTA")
    assert made.dtypes == [("id", "int"), ("v", "string"), ("at", "timestamp")] and made.count() == 0
    assert rows(merge(frame(spark, (1, "a")))) == [(1, "a", None)]
    assert run("CREATE TABLE IF NOT EXISTS delta.`{root}/t` (x INT) USING DELTA").columns == ["id", "v", "at"]


@pytest.mark.parametrize(
    "text",
    [
        "DELETE FROM delta.`{root}/t` WHERE id = 1",
        "UPDATE delta.`{root}/t` SET id = 1",
        "INSERT INTO delta.`{root}/t` SELECT 1",
        "DROP TABLE t",
        "CREATE VIEW v AS SELECT 1",
        "CREATE TABLE t (a INT)",
        "CREATE TABLE delta.`{root}/t` (a INT NOT NULL) USING DELTA",
        "CREATE TABLE delta.`{root}/t` (a INT) USING jdbc",
        "CREATE TABLE delta.`{root}/t` (a INT) USING DELTA PARTITIONED BY (bucket(4, a))",
        "CREATE TABLE delta.`{root}/t` (a INT) USING DELTA LOCATION '/x'",
    ],
)
def test_other_statements_raise(run, text):
    with pytest.raises(UnsupportedStatement):
        run(text)


def test_text_that_only_looks_like_a_table(spark, run):
    got = run("SELECT 'delta.`/x`' AS a, '{\"b\": 1}' AS b -- delta.`/y`\n /* delta.`/z` */")
    assert rows(got) == [("delta.`/x`", '{"b": 1}')]
    with pytest.raises(LookupError, match="no table nowhere"):
        run("SELECT * FROM delta.`{root}/nowhere`")


def test_files_of_others_are_read_and_never_taken_for_a_target(spark, run, merge, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/t")
    assert run("SELECT max(id) AS m FROM parquet.`{root}/t`").first()["m"] == 2
    with pytest.raises(ValueError, match="no published snapshot"):
        merge(frame(spark, (1, "a")))


def test_no_view_is_left_behind(spark, run, merge):
    before = {t.name for t in spark.catalog.listTables() if t.isTemporary}
    merge(frame(spark, (1, "a")))
    with pytest.raises(UnsupportedStatement):
        run("DROP TABLE {r}", r=frame(spark, (uuid.uuid4().int % 100, "a")))
    assert {t.name for t in spark.catalog.listTables() if t.isTemporary} == before
