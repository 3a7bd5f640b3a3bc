import json

import pytest
from pyspark.sql import functions as F

from tierforge.plans import spreadsheet_ingest
from tierforge.sinks import export_files
from tierforge.sources import csv_scan, parse_files, workbook_files
from tests.conftest import rows
from workload.books import workbook_bytes


def listed(manifest):
    name = F.regexp_extract("path", "/src/(.*)", 1)
    return rows(manifest.select(name, "sheet", "rows", "status", "file"))


@pytest.fixture
def src(tmp_path):
    src = tmp_path / "src"
    (src / "Bulgaria").mkdir(parents=True)
    book = workbook_bytes([("Sheet 1", [["id", "v"], ["1", 'a,"b"\nc'], ["2", None]]), ("価格", [["id"], ["7"]]), ("空", [])])
    (src / "p.xlsx").write_bytes(book)
    (src / "Bulgaria/p.xlsm").write_bytes(book)
    (src / "Bulgaria/p.xlsx").write_bytes(workbook_bytes([("Sheet 1", [["id"], ["9"]]), ("Sheet_1", [["id"], ["8"]])]))
    (src / "t.xls").write_text("id;v\n" + "".join(f'{k};"x\n{k}"\n' for k in range(300)))
    (src / "u.xlx").write_text("id|v\n")
    (src / "cut.xlsx").write_bytes(book[:200])
    return src


def test_one_file_a_sheet(spark, conf, src, tmp_path):
    conf(spark__sql__files__maxPartitionBytes="500", spark__sql__files__openCostInBytes="1")
    dst = tmp_path / "dst"
    for _ in range(2):
        manifest = spreadsheet_ingest(spark, str(src), str(dst), one_file=True)
        assert listed(manifest) == sorted(
            [
                ("p.xlsx", "Sheet 1", 2, "ok", "p__Sheet_1.csv"),
                ("p.xlsx", "価格", 1, "ok", "p__sheet.csv"),
                ("p.xlsx", "空", 0, "ok", None),
                ("Bulgaria/p.xlsm", "Sheet 1", 2, "ok", "Bulgaria/p__Sheet_1.csv"),
                ("Bulgaria/p.xlsm", "価格", 1, "ok", "Bulgaria/p__sheet.csv"),
                ("Bulgaria/p.xlsm", "空", 0, "ok", None),
                ("Bulgaria/p.xlsx", "Sheet 1", 1, "ok", "Bulgaria/p.xlsx__Sheet_1.csv"),
                ("Bulgaria/p.xlsx", "Sheet_1", 1, "ok", "Bulgaria/p.xlsx__Sheet_1_1.csv"),
                ("t.xls", None, 300, "text", "t.csv"),
                ("u.xlx", None, 0, "text", "u.csv"),
                ("cut.xlsx", None, None, "failed", None),
            ],
            key=repr,
        )
    files = {p.relative_to(dst).as_posix() for p in dst.rglob("*") if p.is_file() and "_manifests" not in str(p)}
    assert files == {r["file"] for r in manifest.collect() if r["file"]}
    assert (dst / "p__Sheet_1.csv").read_bytes().decode() == '﻿id,v\n1,"a,""b""\nc"\n2,\n'
    assert (dst / "u.csv").read_bytes().decode() == "﻿id,v\n"
    # The rows of a text file keep their order, whatever its splits.
    text = "id,v\n" + "".join(f'{k},"x\n{k}"\n' for k in range(300))
    assert (dst / "t.csv").read_bytes().decode("utf-8-sig") == text
    back = csv_scan(spark, str(dst), "t.csv", options={"multiLine": "true"})
    assert back.count() == 300


def test_first_sheet_only(spark, src, tmp_path):
    manifest = spreadsheet_ingest(spark, str(src), str(tmp_path / "dst"), first_sheet_only=True, one_file=True)
    names = {r["file"] for r in manifest.collect()}
    assert {"p.csv", "Bulgaria/p.csv", "Bulgaria/p.xlsx.csv"} <= names


def test_a_failed_task_leaves_nothing(spark, src, tmp_path):
    dst = tmp_path / "dst"
    files, _ = workbook_files(spark, [f"file:{src}/p.xlsx", f"file:{src}/Bulgaria/p.xlsx"])
    parsed = parse_files(files.repartition(2))
    bad = F.when(F.col("path").contains("Bulgaria"), F.raise_error(F.lit("no"))).otherwise(F.col("error"))
    with pytest.raises(Exception):
        export_files(parsed.withColumn("error", bad.cast("string")), str(src), str(dst))
    assert [p for p in dst.rglob("*") if p.is_file()] == []


def test_what_an_encoding_lacks_fails_its_file_alone(spark, src, tmp_path):
    (src / "k.xlsx").write_bytes(workbook_bytes([("a", [["id"], ["é"]]), ("b", [["id"], ["価格"]])]))
    manifest = spreadsheet_ingest(spark, str(src), str(tmp_path / "dst"), encoding="cp1252", one_file=True)
    got = {r["sheet"]: r for r in manifest.where("path like '%k.xlsx'").collect()}
    assert (got["a"]["status"], got["b"]["status"], got["b"]["file"]) == ("ok", "failed", None)
    assert "encode" in got["b"]["error"]
    assert (tmp_path / "dst/k__a.csv").read_bytes() == "id\né\n".encode("cp1252")
    assert json.loads(next((tmp_path / "dst/_manifests").iterdir()).read_text().splitlines()[0])
