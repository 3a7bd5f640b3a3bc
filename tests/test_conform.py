import datetime as dt

import pytest

from tierforge import Contract
from tierforge.operators import add_audit, conform, require_not_null, split_not_null
from tests.conftest import rows


def contract(**columns):
    return Contract.from_dict({"table": "t", "columns": columns})


def test_rename_cast_default_in_one_projection(spark):
    df = spark.createDataFrame([("7", "x", "1.5", "keep"), ("?", None, "y", "k2")], "`商品ID` string, `名` string, p string, extra string")
    c = contract(
        id={"type": "int", "source": "商品ID"},
        name={"type": "string", "source": "名", "default": "none"},
        p={"type": "double"},
        active={"type": "boolean", "default": True},
        absent={"type": "date"},
    )
    out = conform(df, c)
    assert out.columns == ["id", "name", "p", "extra", "active"]
    assert rows(out) == [(7, "x", 1.5, "keep", True), (None, "none", None, "k2", True)]
    assert out._jdf.queryExecution().analyzed().toString().count("Project") == 1


def test_names_swap_at_once(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    out = conform(df, contract(b={"type": "int", "source": "a"}, a={"type": "int", "source": "b"}))
    assert out.columns == ["b", "a"] and rows(out) == [(1, 2)]


def test_source_names_are_case_sensitive(spark):
    df = spark.createDataFrame([("1",)], "SKU string")
    assert conform(df, contract(id={"type": "int", "source": "sku"})).columns == ["SKU"]


def test_names_with_dots_and_backticks(spark):
    df = spark.createDataFrame([("1", "2")], "`a.b` string, `c``d` string")
    out = conform(df, contract(x={"type": "int", "source": "a.b"}))
    assert out.columns == ["x", "c`d"] and rows(out) == [(1, "2")]


@pytest.mark.parametrize("other", ["id", "ID"])
def test_rename_onto_an_existing_column_raises(spark, other):
    df = spark.createDataFrame([("1", "2")], f"src string, {other} string")
    with pytest.raises(ValueError, match="would be named"):
        conform(df, contract(id={"type": "int", "source": "src"}))


def test_strict(spark):
    df = spark.createDataFrame([("1", "2")], "b string, a string")
    c = contract(a={"type": "int"}, b={"type": "long"}, d={"type": "string", "default": "z"})
    assert conform(df, c, strict=True).columns == ["a", "b", "d"]
    with pytest.raises(ValueError, match="lacks"):
        conform(df, contract(zz={"type": "int"}), strict=True)
    with pytest.raises(ValueError, match="unknown types"):
        conform(df, contract(a={"type": "money"}), strict=True)
    assert conform(df, contract(a={"type": "money"})).schema["a"].dataType.simpleString() == "string"


def test_audit(spark):
    at = dt.datetime(2024, 5, 6, 7, 8, 9)
    assert add_audit(spark.range(1), at).first().ingest_ts.year == 2024
    assert add_audit(spark.range(3)).select("ingest_ts").distinct().count() == 1


def test_split_and_require_not_null(spark):
    df = spark.createDataFrame([(1, "a", None), (None, None, 1), (2, "b", 2)], "k int, v string, w int")
    valid, rejected = split_not_null(df, ["k", "v"])
    assert rows(valid) == [(1, "a", None), (2, "b", 2)]
    assert rows(rejected) == [(None, None, 1, ["k", "v"])]
    valid, rejected = split_not_null(df, [])
    assert valid.count() == 3 and rejected.count() == 0
    assert require_not_null(valid.where("k is not null"), ["k", "v"]).count() == 2
    with pytest.raises(Exception, match="column v is declared not null"):
        require_not_null(df, ["v"]).collect()
