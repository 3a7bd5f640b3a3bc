import pytest

from tierforge import Contract
from tierforge.plans import run_template
from tierforge.plans import load_bronze
from tierforge.sinks import read_table
from tierforge.sources import contract_scan, csv_quarantine, csv_scan, read_if_exists
from tests.conftest import rows

HEADER = "商品ID,商品名\n"


def write(path, text, encoding="utf-8"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding=encoding)


def test_nested_files_marks_quotes_and_blanks(spark, tmp_path):
    write(tmp_path / "products_a.csv", HEADER + '1,"a, ""b"" \\"\n2,\n', "utf-8-sig")
    write(tmp_path / "Bulgaria/north/products_b.csv", HEADER + "3,c\n")
    write(tmp_path / "other.csv", "x\n1\n")
    df = csv_scan(spark, str(tmp_path), "products*.csv")
    assert df.columns == ["商品ID", "商品名"]
    assert rows(df) == [("1", 'a, "b" \\'), ("2", None), ("3", "c")]


def test_swapped_headers_fail(spark, tmp_path):
    write(tmp_path / "a.csv", "a,b\n1,2\n")
    write(tmp_path / "b.csv", "b,a\n1,2\n")
    for columns in (None, ["a", "b"]):
        with pytest.raises(Exception, match="(?i)header"):
            csv_scan(spark, str(tmp_path), columns=columns).collect()


def test_short_rows_are_padded_and_long_ones_cut(spark, tmp_path):
    write(tmp_path / "a.csv", "a,b\n1\n1,2,3\n")
    assert rows(csv_scan(spark, str(tmp_path))) == [("1", "2"), ("1", None)]


def test_rows_that_do_not_fit_are_quarantined_with_a_reason(spark, tmp_path):
    write(tmp_path / "a.csv", 'a;b\n1\n1;2;LOST\n"x;y";"2;"\n3;;;\n4;5;;6\n;\n7;"8\n9";\n', "utf-8-sig")
    options = {"sep": ";", "multiLine": "true"}
    good, bad = csv_quarantine(spark, str(tmp_path), columns=["a", "b"], options=options)
    fitting = [("1", None), ("x;y", "2;"), ("3", None), (None, None), ("7", "8\n9")]
    assert rows(good) == sorted(fitting, key=repr)
    assert rows(bad.select("cells", "record", "reason")) == [
        (["1", "2"], "1;2;LOST", "surplus cells"),
        (["4", "5"], "4;5;;6", "surplus cells"),
    ]
    good, bad = csv_quarantine(spark, str(tmp_path), columns=["a", "b"], options=options, short="quarantine")
    assert rows(good) == sorted(fitting[1:], key=repr)
    assert rows(bad.select("record", "reason").where("reason = 'missing cells'")) == [("1", "missing cells")]
    with pytest.raises(Exception, match="(?i)header"):
        csv_quarantine(spark, str(tmp_path), columns=["b", "a"], options=options)[0].collect()
    for wrong in ({"columns": []}, {"columns": ["a"], "short": "maybe"}):
        with pytest.raises(ValueError):
            csv_quarantine(spark, str(tmp_path), **wrong)


def test_a_load_keeps_what_it_quarantines(spark, tmp_path):
    cfg = {"table": "quarantined_t", "source": {"location_ref": "land"}, "columns": {"a": {"type": "int"}, "b": {"type": "string"}}, "primary_keys": ["a"]}
    write(tmp_path / "land/p.csv", "a,b\n1,x\n2,y,LOST\nz,w\n")
    rejected = load_bronze(spark, Contract.from_dict(cfg), {"land": f"{tmp_path}/land"}, f"{tmp_path}/lake", quarantine=True)
    assert rows(rejected.select("b")) == [("w",)]
    assert rows(read_table(spark, f"{tmp_path}/lake", "quarantined_t").select("a", "b")) == [(1, "x")]
    assert rows(spark.read.parquet(f"{tmp_path}/lake/quarantined_t__quarantined").select("record")) == [("2,y,LOST",)]


def test_no_file_is_an_empty_table_when_the_columns_are_known(spark, tmp_path):
    assert csv_scan(spark, str(tmp_path), columns=["a"]).count() == 0
    with pytest.raises(Exception, match="UNABLE_TO_INFER_SCHEMA"):
        csv_scan(spark, str(tmp_path))


def test_contract_scan(spark, tmp_path):
    cfg = {"table": "t", "source": {"location_ref": "land", "filename_glob": "p*.csv"}, "columns": {"a": {"type": "int"}}, "options": {"sep": ";"}}
    write(tmp_path / "land/p.csv", "a;b\n1;2\n")
    spark.range(2).write.parquet(f"{tmp_path}/lake/t")
    assert rows(contract_scan(spark, Contract.from_dict(cfg), {"land": f"{tmp_path}/land"})) == [("1", "2")]
    cfg = {"table": "t", "source": {"format": "parquet", "location_ref": "lake"}, "columns": {"id": {"type": "long"}}}
    assert contract_scan(spark, Contract.from_dict(cfg), {"lake": f"{tmp_path}/lake/"}).count() == 2
    with pytest.raises(ValueError, match="no root"):
        contract_scan(spark, Contract.from_dict(cfg), {})


def test_read_if_exists(spark, tmp_path):
    assert read_if_exists(spark, f"{tmp_path}/none") is None
    (tmp_path / "empty").mkdir()
    assert read_if_exists(spark, f"{tmp_path}/empty") is None
    with pytest.raises(Exception):
        read_if_exists(spark, f"{tmp_path}/none", "no_such_format")


def test_template(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    text = """-- braces {anywhere} are text
    SELECT t.k, '{"a": {u}}' AS j, :w AS w FROM {rel} t JOIN {rel} u ON t.k = u.k WHERE t.v = :v;"""
    out = run_template(spark, text, {"rel": df}, {"v": "x", "w": "it's {rel}"})
    assert rows(out) == [(1, '{"a": {u}}', "it's {rel}")]
    assert rows(run_template(spark, "SELECT '{x}' AS a")) == [("{x}",)]
    with pytest.raises(Exception, match="PARSE_SYNTAX_ERROR"):
        run_template(spark, "SELECT 1; SELECT 2")
