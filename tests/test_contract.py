import pytest
from pyspark.sql import types as T

from tierforge import Contract

LISTED = {
    "table": "dim_product",
    "layer": "bronze",
    "source": {"format": "csv", "location_ref": "bronze_csv", "filename_glob": "products*.csv"},
    "schema": {
        "columns": [
            {"name": "product_id", "source": "商品ID", "type": "string", "nullable": False},
            {"name": "category", "source": "カテゴリ", "type": "string"},
        ]
    },
    "keys": ["product_id"],
    "partitions": [],
    "options": {"header": True, "inferSchema": False},
}
MAPPED = {
    "table": "dim_product",
    "primary_keys": ["product_id"],
    "write_mode": "merge",
    "source": {"file_pattern": "dim_product*.csv"},
    "columns": {
        "product_id": {"type": "long", "source": "商品ID"},
        "active_flag": {"type": "boolean", "default": True},
    },
    "options": {"audit_columns": False, "deduplicate_on_keys": False},
}


def test_listed_shape():
    c = Contract.from_dict(LISTED)
    assert (c.keys, c.glob, c.write_mode, c.location) == (("product_id",), "products*.csv", "merge", "bronze_csv")
    assert c.reader_options == {"header": "true", "inferSchema": "false"}
    assert c.headers == ["商品ID", "カテゴリ"]
    assert c.required == ["product_id"]
    assert c.audit and c.dedupe
    assert [f.name for f in c.struct()] == ["product_id", "category", "ingest_ts"]


def test_mapped_shape():
    c = Contract.from_dict(MAPPED)
    assert (c.keys, c.glob) == (("product_id",), "dim_product*.csv")
    assert not c.audit and not c.dedupe and c.reader_options == {}
    assert c.headers == ["商品ID"]
    assert c.struct() == T.StructType(
        [T.StructField("product_id", T.LongType()), T.StructField("active_flag", T.BooleanType())]
    )


def test_summary_contract_has_no_keys_and_is_overwritten():
    c = Contract.from_dict({"table": "s", "schema": {"columns": []}, "keys": [], "partitions": ["d"]})
    assert c.write_mode == "overwrite" and c.partitions == ("d",)


@pytest.mark.parametrize(
    "change",
    [
        {"keys": [], "write_mode": "merge"},
        {"keys": ["nope"]},
        {"partitions": ["nope"]},
        {"write_mode": "append"},
        {"schema": {"columns": [{"name": "a", "type": "int"}, {"name": "A", "type": "int"}]}, "keys": ["a"]},
    ],
)
def test_contradictions_raise(change):
    with pytest.raises(ValueError):
        Contract.from_dict({**LISTED, **change})


def test_unknown_type_has_no_struct():
    with pytest.raises(ValueError, match="money"):
        Contract.from_dict({"table": "t", "columns": {"money": {"type": "money"}}}).struct()
