import io
import subprocess
import sys
import zipfile
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tierforge.plans import exported_scan, spreadsheet_ingest
from tierforge.sinks import export_path, export_sheets, newest_run
from tierforge.sources import (
    csv_scan,
    discover,
    layouts,
    parse_files,
    text_sheets,
    workbook_files,
)
from tierforge.sources.ooxml import Workbook, header_names
from tierforge.sources.spreadsheets import split_path
from tests.conftest import plan, rows
from workload.books import Raw, workbook_bytes

STYLES = (
    '<numFmts count="4"><numFmt numFmtId="164" formatCode="yyyy&quot;年&quot;m"/>'
    '<numFmt numFmtId="165" formatCode="[h]:mm"/><numFmt numFmtId="166" formatCode="0.0&quot;days&quot;"/>'
    '<numFmt numFmtId="167" formatCode="[Red]0;d"/></numFmts>'
    "<cellXfs>" + "".join(f'<xf numFmtId="{n}"/>' for n in (0, 14, 164, 165, 166, 167, 21, 46)) + "</cellXfs>"
)


def sheet_rows(content):
    book = Workbook(content)
    return {name: list(book.rows(part)) for name, part in book.sheets}


def test_cell_kinds():
    cells = {
        "shared": (Raw('<c t="s"><v>0</v></c>'), "rich text"),
        "shared blank": (Raw('<c t="s"><v>1</v></c>'), None),
        "inline": (" pad ", " pad "),
        "whole float": (3.0, "3"),
        "whole": (2**60 + 1, str(2**60 + 1)),
        "float": (0.1, "0.1"),
        "exponent": (Raw("<c><v>1E-5</v></c>"), "1e-05"),
        "true": (Raw('<c t="b"><v>1</v></c>'), "True"),
        "false": (Raw('<c t="b"><v>0</v></c>'), "False"),
        "error": (Raw('<c t="e"><v>#DIV/0!</v></c>'), "#N/A"),
        "formula text": (Raw('<c t="str"><f>A1</f><v>x&amp;y</v></c>'), "x&y"),
        "formula number": (Raw("<c><f>1+1</f><v>2</v></c>"), "2"),
        "iso date": (Raw('<c t="d"><v>2024-01-02T03:04:05</v></c>'), "2024-01-02 03:04:05"),
        "date": (Raw('<c s="1"><v>45293</v></c>'), "2024-01-02 00:00:00"),
        "date time": (Raw('<c s="2"><v>45293.5</v></c>'), "2024-01-02 12:00:00"),
        "early date": (Raw('<c s="1"><v>1</v></c>'), "1900-01-01 00:00:00"),
        "time": (Raw('<c s="6"><v>0.75</v></c>'), "18:00:00"),
        "duration": (Raw('<c s="3"><v>1.5</v></c>'), "1 day, 12:00:00"),
        "built-in duration": (Raw('<c s="7"><v>0.5</v></c>'), "12:00:00"),
        "quoted letters": (Raw('<c s="4"><v>1.5</v></c>'), "1.5"),
        "colour": (Raw('<c s="5"><v>5</v></c>'), "5"),
        "blank": (Raw('<c s="1"/>'), None),
    }
    strings = ["<r><t>rich </t></r><r><t>text</t></r><rPh><t>furigana</t></rPh>", "<t></t>"]
    content = workbook_bytes([("s", [[v] for v, _ in cells.values()] + [["end"]])], strings, STYLES)
    got = [r[0] if r else None for r in sheet_rows(content)["s"]]
    assert dict(zip(cells, got)) == {k: e for k, (_, e) in cells.items()}


def test_1904_calendar():
    content = workbook_bytes([("s", [[Raw('<c s="1"><v>0</v></c>')], [Raw('<c s="1"><v>43831</v></c>')]])], styles=STYLES, properties='<workbookPr date1904="1"/>')
    assert sheet_rows(content)["s"] == [["00:00:00"], ["2024-01-02 00:00:00"]]


def test_gaps_and_trailing_blanks():
    rows_ = [["a", None, "c"], [], ["x"], [None, "y"], [None], []]
    assert sheet_rows(workbook_bytes([("s", rows_)]))["s"] == [["a", None, "c"], [], ["x"], [None, "y"]]


def test_header_names():
    assert header_names(["a", None, "a", "a.1", "A"], 6) == ["a", "Unnamed: 1", "a.1", "a.1.1", "A", "Unnamed: 5"]
    assert header_names(["a", "A"], 2, fold_case=True) == ["a", "A.1"]


TEXTS = {
    "semicolon.xls": (b"a;b\n1;2\n", ";", "UTF-8", False, ["a", "b"]),
    "tab.xls": (b"a\tb\r\n1\t2\r\n", "\t", "UTF-8", False, ["a", "b"]),
    "bar.xls": (b"a|b|c\n1|2|3\n", "|", "UTF-8", False, ["a", "b", "c"]),
    "one.xls": (b"\n\nonly\n1\n2\n", ",", "UTF-8", False, ["only"]),
    "latin.xls": ("é;b\n1;ü\n".encode("latin-1"), ";", "ISO-8859-1", False, ["é", "b"]),
    "mark.xls": ("é;b\n1;ü\n".encode("utf-8-sig"), ";", "UTF-8", False, ["é", "b"]),
    "wide.xls": ("a;b\n1;2\n".encode("utf-16"), ";", "UTF-16", True, ["a", "b"]),
    "lines.xls": (b'a,b\n"1\n1",2\n3,4\n', ",", "UTF-8", True, ["a", "b"]),
    "quotes.xls": (b'a,b\n"x ""q""",2\n', ",", "UTF-8", False, ["a", "b"]),
    "late.xls": (b"a;b\n" + b"1;2\n" * 9000 + b"\xff;2\n", ";", "ISO-8859-1", False, ["a", "b"]),
    "comma.xls": (b"a;b\n1,5;2,5\n1,5;2\n", ";", "UTF-8", False, ["a", "b"]),
    "trailing.xls": (b"a;b\n1;2\n" + b"x" * 300_000 + b";2;;\n", ";", "UTF-8", False, ["a", "b"]),
    "bare.xls": (b"a;b\n", ";", "UTF-8", False, ["a", "b"]),
}
NO_TEXTS = {
    "empty.xls": (b"", "no columns"),
    "blank.xls": (b"\n\n", "no columns"),
    "noise.xls": (b"\x00\x01\x02", "neither"),
    "zero.xls": (b"a\x00b\n", "neither"),
    "surplus.xls": (b"a;b\n" + b"1;2\n" * 9 + b"1;2;;3\n", "4 cells under 2"),
    "narrow.xls": (b"id;name\n1;2\n3;4;5\n", "3 cells under 2"),
    "title.xls": (b"title\n1;2\n3;4\n", "split by"),
    "quoted.xls": (b'a;b\n"1\n1";2;3\n', "more cells"),
}


@pytest.fixture
def text_folder(tmp_path):
    for name, (content, *_) in (TEXTS | NO_TEXTS).items():
        (tmp_path / name).write_bytes(content)
    (tmp_path / "book.xlsx").write_bytes(workbook_bytes([("s", [["x"], ["1"]])]))
    return tmp_path


@pytest.mark.parametrize("split", ["128MB", "1KB"])
def test_layouts(spark, conf, text_folder, split):
    conf(spark__sql__files__maxPartitionBytes=split, spark__sql__files__openCostInBytes="1")
    found = {r["path"].rsplit("/", 1)[1]: r for r in layouts(spark, str(text_folder)).collect()}
    assert len(found) == len(TEXTS) + len(NO_TEXTS) + 1
    for name, (_, *layout) in TEXTS.items():
        row = found[name]
        assert row["kind"] == "text", row
        assert [row[c] for c in ("separator", "encoding", "multi_line", "header")] == layout
        assert row["bare"] == (name == "bare.xls")
    for name, (_, error) in NO_TEXTS.items():
        assert found[name]["kind"] == "failed" and error in found[name]["error"], found[name]
    assert found["book.xlsx"]["kind"] == "workbook"


def test_other_encodings(spark, conf, tmp_path):
    conf(spark__sql__legacy__javaCharsets="true")
    (tmp_path / "a.xls").write_bytes("名;値\n東京;1\n".encode("shift-jis"))
    table, _ = text_sheets(spark, str(tmp_path), encoding="Shift_JIS")
    assert rows(table.select("名", "値")) == [("東京", "1")]
    with pytest.raises(LookupError):
        text_sheets(spark, str(tmp_path), encoding="no such")


def test_a_file_is_split_wherever(spark, conf, tmp_path):
    lines = "".join(f"{k};x{k}\n" for k in range(3000))
    (tmp_path / "plain.xls").write_text("n;t\n" + lines)
    (tmp_path / "wide.xls").write_bytes(("n;t\n" + lines).encode("utf-16"))
    conf(spark__sql__files__maxPartitionBytes="4KB", spark__sql__files__openCostInBytes="1")
    for name in ("plain.xls", "wide.xls"):
        table, failures = text_sheets(spark, str(tmp_path), name)
        assert table.select(F.sum("n"), F.countDistinct("t")).first()[1] == 3000
        assert failures.count() == 0


@pytest.fixture
def folder(tmp_path):
    src = tmp_path / "src"
    (src / "Bulgaria" / "north").mkdir(parents=True)
    book = workbook_bytes(
        [
            ("Sheet 1", [["商品ID", "商品名", None], ["1", "a,b"], ["2", "NA", "x"], [], ["3", 'q"t\nnl']]),
            ("価格", [["id"], ["7"]]),
            ("空", []),
        ]
    )
    (src / "products.xlsx").write_bytes(book)
    (src / "Bulgaria" / "products.xlx").write_bytes(book)
    (src / "Bulgaria" / "north" / "semi.xls").write_text("id;名\n1;x\n2;N/A\n", "utf-8")
    (src / "Bulgaria" / "north" / "other [1]+%20.xlx").write_text("id;名\n3;\"y;\nz\"\n", "utf-8")
    (src / "latin.xlsb").write_bytes("id|näme\n5|ü\n".encode("latin-1"))
    (src / "broken.xlsx").write_bytes(book[:300])
    (src / "old.xls").write_bytes(b"\xd0\xcf\x11\xe0" + b"\x00" * 100)
    (src / "noise.xlsm").write_bytes(bytes(range(256)) * 4)
    (src / "ignored.txt").write_text("x\n")
    return src


def workbooks(spark, folder, glob="*.{xlsx,xlsm,xls,xlx,xlsb}"):
    files, _ = workbook_files(spark, [r["path"] for r in discover(spark, str(folder), glob).collect()])
    return files


def findings(spark, folder):
    return parse_files(workbooks(spark, folder))


def test_discovery(spark, conf, folder, tmp_path):
    assert discover(spark, str(folder)).count() == 8
    (tmp_path / "nothing").mkdir()
    assert discover(spark, str(tmp_path / "nothing")).count() == 0
    paths = [r["path"] for r in discover(spark, str(folder)).collect()]
    conf(spark__sql__sources__binaryFile__maxLength="500")
    files, too_long = workbook_files(spark, paths)
    assert files.count() + too_long.count() == 8 and too_long.count() > 0
    assert "LessThanOrEqual(length,500)" in plan(files)
    assert workbook_files(spark, [])[0].count() == 0


def test_parse_files(spark, folder):
    found = findings(spark, folder).withColumn("f", F.substring_index("path", "/", -1))
    cells = found.where("kind = 'row' and f = 'products.xlsx' and sheet_idx = 0").orderBy("row_idx")
    assert [tuple(r.cells) for r in cells.collect()] == [
        ("商品ID", "商品名", "Unnamed: 2"),
        ("1", "a,b", None),
        ("2", None, "x"),
        (None, None, None),
        ("3", 'q"t\nnl', None),
    ]
    sheets = found.where("kind = 'sheet' and f = 'products.xlsx'").select("sheet_idx", "sheet", "rows")
    assert rows(sheets) == [(0, "Sheet 1", 4), (1, "価格", 1), (2, "空", 0)]
    failed = found.where("kind = 'failed'").select("f", F.col("error").isNotNull())
    others = ("latin.xlsb", "other [1]+%20.xlx", "semi.xls", "broken.xlsx", "noise.xlsm", "old.xls")
    assert rows(failed) == sorted(((f, True) for f in others), key=repr)


def test_first_sheet_only(spark, folder):
    files = workbooks(spark, folder, "products.xlsx")
    assert rows(parse_files(files, first_sheet_only=True).select("sheet").distinct()) == [("Sheet 1",)]


def test_a_bad_sheet_fails_the_whole_workbook(spark):
    good = io.BytesIO(workbook_bytes([("a", [["x"], ["1"]]), ("b", [["y"]])]))
    out = io.BytesIO()
    with zipfile.ZipFile(good) as src, zipfile.ZipFile(out, "w") as dst:
        for name in src.namelist():
            data = src.read(name)
            dst.writestr(name, data[:-20] if name.endswith("sheet2.xml") else data)
    files = spark.createDataFrame([("books:/x.xlsx", bytearray(out.getvalue()))], "path string, content binary")
    assert rows(parse_files(files).select("kind")) == [("failed",)]


def test_text_sheets(spark, folder):
    table, failures = text_sheets(spark, str(folder), path_column="file")
    name = F.substring_index("file", "/", -1).alias("f")
    assert rows(table.select("id", "名", "näme", name)) == [
        ("1", "x", None, "semi.xls"),
        ("2", None, None, "semi.xls"),
        ("3", "y;\nz", None, "other [1]+%20.xlx"),
        ("5", None, "ü", "latin.xlsb"),
    ]
    assert rows(failures.select(F.substring_index("path", "/", -1))) == [("noise.xlsm",)]
    assert text_sheets(spark, str(folder), "*.xlsx")[0] is None


def test_ingest(spark, folder, tmp_path):
    dst = str(tmp_path / "dst")
    manifest = spreadsheet_ingest(spark, str(folder), dst)
    listed = manifest.select(F.regexp_extract("path", "/src/(.*)", 1), "sheet", "rows", "status", F.col("error").isNotNull())
    assert rows(listed) == sorted(
        [
            *((f, s, n, "ok", False) for f in ("products.xlsx", "Bulgaria/products.xlx") for s, n in (("Sheet 1", 4), ("価格", 1), ("空", 0))),
            ("Bulgaria/north/semi.xls", None, 2, "text", False),
            ("Bulgaria/north/other [1]+%20.xlx", None, 1, "text", False),
            ("latin.xlsb", None, 1, "text", False),
            ("broken.xlsx", None, None, "failed", True),
            ("noise.xlsm", None, None, "failed", True),
            ("old.xls", None, None, "failed", True),
        ],
        key=repr,
    )
    run = Path(newest_run(spark, dst))
    names = {p.relative_to(run).parent.as_posix() for p in run.rglob("part-*")}
    assert {n for n in names if "findings" not in n} == {
        "export_kind=csv/export_folder=_root/export_file=products.xlsx__0_Sheet_1.csv",
        "export_kind=csv/export_folder=_root/export_file=products.xlsx__1_sheet.csv",
        "export_kind=csv/export_folder=Bulgaria/export_file=products.xlx__0_Sheet_1.csv",
        "export_kind=csv/export_folder=Bulgaria/export_file=products.xlx__1_sheet.csv",
        "export_kind=csv/export_folder=Bulgaria%2Fnorth/export_file=semi.xls.csv",
        "export_kind=csv/export_folder=Bulgaria%2Fnorth/export_file=other %5B1%5D+%2520.xlx.csv",
        "export_kind=csv/export_folder=_root/export_file=latin.xlsb.csv",
    }
    part = next((run / "export_kind=csv/export_folder=_root/export_file=products.xlsx__0_Sheet_1.csv").glob("part-*"))
    assert part.read_bytes().decode("utf-8") == (
        '\ufeff商品ID,商品名,Unnamed: 2\n1,"a,b",\n2,,x\n,,\n3,"q""t\nnl",\n'
    )
    back = exported_scan(spark, dst, "products*Sheet_1.csv")
    assert back.columns == ["商品ID", "商品名", "Unnamed: 2"]
    sheet = [("1", "a,b", None), ("2", None, "x"), (None, None, None), ("3", 'q"t\nnl', None)]
    assert rows(back) == sorted(sheet * 2, key=repr)
    assert rows(csv_scan(spark, export_path(spark, dst, "latin*"), "*")) == [("5", "ü")]


def test_the_newest_run_is_read(spark, tmp_path):
    src, dst = tmp_path / "src", str(tmp_path / "dst")
    src.mkdir()
    with pytest.raises(LookupError):
        export_path(spark, dst)
    (src / "a.xlsx").write_bytes(workbook_bytes([("s", [["x"], ["1"]])]))
    (src / "b.xlsx").write_bytes(workbook_bytes([("s", [["x"], ["2"]])]))
    spreadsheet_ingest(spark, str(src), dst, first_sheet_only=True, encoding="latin-1")
    assert rows(csv_scan(spark, export_path(spark, dst), "*")) == [("1",), ("2",)]
    (src / "a.xlsx").write_bytes(workbook_bytes([("s", [["x"], ["9"]])]))
    (src / "b.xlsx").unlink()
    manifest = spreadsheet_ingest(spark, str(src), dst, first_sheet_only=True, encoding="latin-1")
    assert manifest.count() == 1
    assert rows(csv_scan(spark, export_path(spark, dst), "*")) == [("9",)]
    run = Path(newest_run(spark, dst))
    assert (run / "export_kind=csv/export_folder=_root/export_file=a.xlsx.csv").is_dir()


def test_header_only_text_is_written(spark, tmp_path):
    (tmp_path / "src").mkdir()
    (tmp_path / "src/a.xls").write_text("id;name\n")
    manifest = spreadsheet_ingest(spark, str(tmp_path / "src"), str(tmp_path / "dst"))
    assert rows(manifest.select("rows", "status")) == [(0, "text")]
    back = exported_scan(spark, str(tmp_path / "dst"))
    assert back.columns == ["id", "name"] and back.count() == 0


def test_jobs_do_not_grow_with_layouts(spark, tmp_path):
    def jobs(n):
        src = tmp_path / f"src{n}"
        src.mkdir()
        for k in range(n):
            (src / f"{k}.xls").write_text(f"id{k};name\n1;a\n2;b\n")
        group = f"layouts {n}"
        spark.sparkContext.setJobGroup(group, group)
        try:
            manifest = spreadsheet_ingest(spark, str(src), str(tmp_path / f"dst{n}"))
            assert rows(manifest.select("rows", "status").distinct()) == [(2, "text")]
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    assert jobs(24) == jobs(2)


def test_text_columns_named_like_ours_keep_their_cells(spark, tmp_path):
    src, dst = tmp_path / "src", str(tmp_path / "dst")
    src.mkdir()
    (src / "a.xls").write_text("path;file;export_file;Export_Kind;__path;x\n1;2;3;4;5;6\n7;8;9;10;11;12\n")
    manifest = spreadsheet_ingest(spark, str(src), dst)
    assert rows(manifest.select("rows", "status")) == [(2, "text")]
    back = exported_scan(spark, dst)
    assert back.columns == ["path", "file", "export_file.1", "Export_Kind.1", "__path.1", "x"]
    assert rows(back)[0] == ("1", "2", "3", "4", "5", "6")
    with pytest.raises(ValueError, match="name the path otherwise"):
        text_sheets(spark, str(src))
    assert text_sheets(spark, str(src), path_column="origin")[0].count() == 2


def test_ingest_of_nothing(spark, tmp_path):
    (tmp_path / "src").mkdir()
    assert spreadsheet_ingest(spark, str(tmp_path / "src"), str(tmp_path / "dst")).count() == 0


@pytest.mark.parametrize(
    "root, path, folder, file",
    [
        ("/data/raw", "file:/data/raw/a.xlsx", "_root", "a.xlsx"),
        ("file:///data/raw/", "file:/data/raw/x/y/a b.xlsx", "x/y", "a b.xlsx"),
        ("s3a://bucket/raw", "s3a://bucket/raw/x/raw/a.xlsx", "x/raw", "a.xlsx"),
        ("s3a://bucket", "s3a://bucket/x/a.xlsx", "x", "a.xlsx"),
        ("hdfs://node:8020/", "hdfs://node:8020/a.xlsx", "_root", "a.xlsx"),
    ],
)
def test_split_path(spark, root, path, folder, file):
    df = spark.createDataFrame([(path,)], "path string")
    assert rows(df.select(*split_path(F.col("path"), root))) == [(folder, file)]


def test_split_path_wants_a_plain_root(spark):
    with pytest.raises(ValueError, match="pattern"):
        split_path(F.col("path"), "/lake/*/raw")
    df = spark.createDataFrame([("file:/data/proj/data/x/a.xls",)], "path string")
    assert rows(df.select(*split_path(F.col("path"), "file:/data/proj/data"))) == [("x", "a.xls")]
    with pytest.raises(Exception, match="is not below"):
        df.select(*split_path(F.col("path"), "/other")).collect()


def test_long_sheets_are_exported_in_order_header_first(spark, tmp_path):
    (tmp_path / "src").mkdir()
    for book in "ab":
        sheets = [(f"s{i}", [["n", "t"], *([k, "x" * 50] for k in range(6000))]) for i in range(3)]
        (tmp_path / f"src/{book}.xlsx").write_bytes(workbook_bytes(sheets))
    manifest = spreadsheet_ingest(spark, str(tmp_path / "src"), str(tmp_path / "dst"), encoding="utf-8")
    assert [r.rows for r in manifest.collect()] == [6000] * 6
    files = list((tmp_path / "dst").glob("run-*/export_kind=csv/*/*/part-*"))
    assert len(files) == 6
    for f in files:
        assert [line.split(",")[0] for line in f.read_text().splitlines()] == ["n", *map(str, range(6000))]


def test_unknown_encoding(spark, tmp_path):
    with pytest.raises(ValueError, match="cp932"):
        export_sheets(parse_files(workbook_files(spark, [])[0]), "/x", str(tmp_path), encoding="cp932")


def test_parsing_needs_no_shuffle(spark, folder):
    assert "Exchange" not in plan(findings(spark, folder))


def test_the_parser_runs_where_the_package_is_not_installed(tmp_path):
    from pyspark import cloudpickle

    from tierforge.sources import spreadsheets

    (tmp_path / "parser").write_bytes(cloudpickle.dumps(spreadsheets._parser(False)))
    (tmp_path / "book").write_bytes(workbook_bytes([("s", [["a"], ["1"], ["2"]])]))
    script = """
import pickle, pandas as pd
parse = pickle.load(open("parser", "rb"))
files = pd.DataFrame({"path": ["a", "b", "c"], "content": [open("book", "rb").read(), b"x;y\\n1;2", b""]})
out = pd.concat(parse([files]))
print(*out["kind"])
try:
    import tierforge
except ImportError:
    print("alone")
"""
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, capture_output=True, text=True, env={})
    assert done.stdout.split() == ["sheet", "row", "row", "row", "failed", "failed", "alone"], done.stderr
