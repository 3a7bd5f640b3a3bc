import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from tierforge.sources import text_sheets
from tierforge.sources.delimited import layouts, text_rows
from tierforge.sources.encodings import byte_counts, judged
from tierforge.sources.records import Way, open_after, records, split_starts, unclosed
from tests.conftest import rows

JAPANESE = "商品名;価格\n東京のりんご;上下１００円\nおいしいカレーライス;200\n"
FRENCH = "Désignation;Prix\nœufs frais de la forêt;2 €\nCafé à la crème;1,5\n"
GERMAN = "Straße;Größe\nMüller;ä\nSchön und grün;12\n"
SPANISH = "Año;País\nEspañol;México\n¿Qué?;Perú\n"
RUSSIAN = "Название;Цена\nСвежее молоко и хлеб;100\nКартофель отварной с маслом;200\n"
CZECH = "Název;Cena\nPříliš žluťoučký kůň;100\núpěl ďábelské ódy;2\n"
POLISH = "Zażółć gęślą jaźń;1\nPchnąć w tę łódź jeża;2\n"
GREEK = "Όνομα;Τιμή\nΦρέσκο γάλα και ψωμί;100\nΠατάτες με βούτυρο;20\n"
CHINESE = "产品名称;价格\n新鲜的牛奶和面包;100\n土豆和黄油;200\n"
KOREAN = "제품명;가격\n신선한 우유와 빵;100\n감자와 버터;200\n"
HEBREW = "שם המוצר;מחיר\nחלב טרי ולחם;100\nתפוחי אדמה עם חמאה;200\n"


@pytest.mark.parametrize(
    "text, codec, name",
    [
        (JAPANESE, "cp932", "Shift_JIS"),
        (JAPANESE, "euc_jp", "EUC-JP"),
        (JAPANESE, "utf-16-le", "UTF-16LE"),
        (JAPANESE, "utf-16-be", "UTF-16BE"),
        (FRENCH, "cp1252", "windows-1252"),
        (FRENCH, "utf-16-le", "UTF-16LE"),
        (GERMAN, "latin-1", "ISO-8859-1"),
        (GERMAN, "utf-16-be", "UTF-16BE"),
        (SPANISH, "cp1252", "ISO-8859-1"),
        (RUSSIAN, "cp1251", "windows-1251"),
        (RUSSIAN, "koi8_r", None),
        (RUSSIAN, "iso8859_5", None),
        (RUSSIAN, "mac_cyrillic", None),
        (RUSSIAN, "cp866", None),
        (CZECH, "cp1250", None),
        (POLISH, "cp1250", None),
        (GREEK, "cp1253", None),
        (HEBREW, "cp1255", None),
        (CHINESE, "gbk", None),
        (CHINESE, "big5", None),
        (KOREAN, "euc_kr", None),
    ],
)
@pytest.mark.parametrize("cut", [False, True])
def test_judgement(text, codec, name, cut):
    data = text.encode(codec, "ignore")
    lines = data.split(b"\n")
    if not cut:
        assert judged(byte_counts(data, True)) == name
    else:
        # As tasks see it: some lines each, without the end of the last one.
        counts = byte_counts(b"\n".join(lines[:2]), True)
        counts.update(byte_counts(b"\n".join(lines[2:]), False))
        assert judged(counts) == name


@pytest.mark.parametrize("data", [b"", b"plain", b"\x00\x01\x02", b"a\x00b\n", bytes(range(256)) * 4, b"\xff\xfe\xfd" * 50])
def test_no_text(data):
    assert judged(byte_counts(data, True)) is None


FILES = {
    "sjis": (JAPANESE * 40, "cp932"),
    "euc": (JAPANESE * 40, "euc_jp"),
    "wide_le": (JAPANESE * 40, "utf-16-le"),
    "wide_be": (FRENCH * 40, "utf-16-be"),
    "utf8": (JAPANESE * 40, "utf-8"),
    "french": (FRENCH * 40, "cp1252"),
    "german": (GERMAN * 40, "latin-1"),
    "russian": (RUSSIAN * 40, "cp1251"),
    "czech": (CZECH * 40, "cp1250"),
    "chinese": (CHINESE * 40, "gbk"),
}


@pytest.mark.parametrize("split", ["128MB", "500"])
def test_files_are_read_as_what_they_are_or_not_at_all(spark, conf, tmp_path, split):
    conf(spark__sql__files__maxPartitionBytes=split, spark__sql__files__openCostInBytes="1")
    for name, (text, codec) in FILES.items():
        (tmp_path / f"{name}.xls").write_bytes(text.encode(codec))
    found = layouts(spark, str(tmp_path))
    name = F.regexp_extract("path", r"/([a-z0-9_]+)\.xls$", 1)
    got = {}
    for r in text_rows(spark, found).select(name.alias("name"), "header", "cells").collect():
        got.setdefault(r["name"], []).append(r["cells"])
        head = next(csv.reader(io.StringIO(FILES[r["name"]][0]), delimiter=";"))
        assert r["header"] == head
    assert set(got) == set(FILES) - {"czech", "chinese"}
    for n, cells in got.items():
        wanted = list(csv.reader(io.StringIO(FILES[n][0]), delimiter=";"))[1:]
        assert sorted(cells) == sorted(wanted), n
    failed = found.where("kind = 'failed'").select(name, "error")
    assert rows(failed) == [(n, "the encoding is unclear; it can be given") for n in ("chinese", "czech")]


def test_a_given_encoding_is_not_judged(spark, tmp_path):
    (tmp_path / "a.xls").write_bytes(CHINESE.encode("gbk"))
    table, failures = text_sheets(spark, str(tmp_path), encoding="gbk")
    assert failures.count() == 0
    assert rows(table.select("产品名称", "价格")) == [("土豆和黄油", "200"), ("新鲜的牛奶和面包", "100")]


@pytest.mark.parametrize(
    "line, before, after",
    [
        ("a;b", (False, True), (False, True)),
        ('"a;b', (False, True), (True, False)),
        ('a;"b', (False, True), (True, False)),
        ('5" screen;b', (False, True), (False, False)),
        ('a;5" screen;"b', (False, True), (True, True)),
        ('"a ""b""";"c', (False, True), (True, True)),
        ('";"', (False, True), (False, True)),
        ('""', (False, True), (False, True)),
        ('"""', (False, True), (True, False)),
        ('"x"y;"z', (False, True), (True, True)),
    ],
)
def test_state_after_a_line(line, before, after):
    if line == ";":
        return
    assert tuple(open_after(line, b, ";") for b in before) == after, line


def written(cells):
    out = io.StringIO()
    csv.writer(out, delimiter=";", lineterminator="\n").writerows(cells)
    return out.getvalue()


def invented(n, seed=1):
    draw = random.Random(seed)
    words = ["plain", "two\nlines", 'say "hi"', "a;b", "\n\n", "é", '"', "x" * 40, 'q"\n";"']
    return [["id", "text", "more"]] + [
        [str(k), draw.choice(words) + draw.choice(words), draw.choice(words)] for k in range(n)
    ]


@pytest.mark.parametrize("split", ["128MB", "4KB", "300"])
@pytest.mark.parametrize("codec", ["utf-8", "cp1252", "cp932"])
def test_records_are_the_same_at_any_split(spark, conf, tmp_path, split, codec):
    conf(spark__sql__files__maxPartitionBytes=split, spark__sql__files__openCostInBytes="1")
    cells = invented(400)
    if codec == "cp932":
        cells = [[c.replace("é", "カ") for c in r] for r in cells]
    (tmp_path / "a.xls").write_bytes(written(cells).encode(codec))
    (tmp_path / "b.xls").write_bytes(written(invented(3, 2)).encode("utf-8"))
    table, failures = text_sheets(spark, str(tmp_path), "a.xls")
    assert failures.count() == 0
    assert rows(table.select("id", "text", "more")) == sorted((tuple(r) for r in cells[1:]), key=repr)


@pytest.mark.parametrize("split", ["128MB", "2KB"])
def test_one_odd_quote_changes_no_other_row(spark, conf, tmp_path, split):
    conf(spark__sql__files__maxPartitionBytes=split, spark__sql__files__openCostInBytes="1")
    lines = [f"{k};name {k}" for k in range(1000)]
    lines[500] = '500;5" screen'
    (tmp_path / "a.xls").write_text("id;name\n" + "\n".join(lines) + "\n")
    table, failures = text_sheets(spark, str(tmp_path))
    assert failures.count() == 0
    assert rows(table.select("id", "name")) == sorted((tuple(x.split(";")) for x in lines), key=repr)


def test_a_large_file_with_quoted_lines_has_many_tasks(spark, conf, tmp_path):
    conf(spark__sql__files__maxPartitionBytes="64KB", spark__sql__files__openCostInBytes="1")
    (tmp_path / "a.xls").write_text(written([["id", "text"]] + [[str(k), "two\nlines"] for k in range(40_000)]))
    ways = {f"file:{tmp_path}/a.xls": Way(";", "UTF-8", True)}
    starts = split_starts(spark, ways)
    cut = records(spark, ways, starts)
    assert cut.rdd.getNumPartitions() > 8
    assert cut.count() == 40_000
    # Half of the splits start within a quoted cell; only what lies over their ends is shuffled.
    assert 0 < len(starts) < cut.rdd.getNumPartitions()


def test_a_cell_that_is_never_closed_fails_its_file_alone(spark, conf, tmp_path):
    conf(spark__sql__files__maxPartitionBytes="1KB", spark__sql__files__openCostInBytes="1")
    (tmp_path / "bad.xls").write_text('id;name\n1;"never\n' + "2;x\n" * 2000)
    (tmp_path / "good.xls").write_text('id;name\n1;"two\nlines"\n')
    assert unclosed(spark, {f"file:{tmp_path}/bad.xls": Way(";", "UTF-8", True)}) == [f"file:{tmp_path}/bad.xls"]
    table, failures = text_sheets(spark, str(tmp_path))
    assert rows(table.select("id", "name")) == [("1", "two\nlines")]
    assert rows(failures.select("error")) == [("a quoted cell is not closed",)]


def test_old_and_mixed_line_ends(spark, tmp_path):
    (tmp_path / "a.xls").write_bytes(b'id;name\r\n1;"two\r\nlines"\r\n2;x\r\n')
    (tmp_path / "b.xls").write_bytes(b'id;name\r3;"two\rlines"\r4;x\r')
    table, _ = text_sheets(spark, str(tmp_path))
    assert rows(table.select("id", "name")) == [("1", "two\nlines"), ("2", "x"), ("3", "two\nlines"), ("4", "x")]
