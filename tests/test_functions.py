
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierforge.functions import NA_TOKENS, cast_leniently, csv_line, na_to_null, slug
from tests.conftest import rows

TEXTS = [
    "1", "x", " 7 ", "3.9", "-3.9", "+5", "", None, "99999999999", "1e3", ".5", "5.", "0x1", "\t9",
    "12f", "2147483647", "2147483648", "-2147483648", "-2147483649", "2147483647.99", ".", "+", "-",
    "+.", "-.5", "00012", "--1", "1 2", "9223372036854775807", "9223372036854775808",
    "-9223372036854775808", "-9223372036854775809", "000000000000000000000000012", "９", "1\n",
    "\x7f3\x7f", "1.2.3", "1.x", "NaN", "inf", "-Infinity", "1d", "1e400", "1e", "0x1p3",
    "t", "TRUE", "yes", "Y", "no", "n", "f", "0", " false ", "tr", "on",
    "2024-01-02", "2024/01/02", "2024-1-2", "20240102", "2024-01-02T03:04:05", "2024", "2024-02-30",
]
TYPES = {
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "string": T.StringType(),
}


def both_casts(spark, texts, name):
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        legacy = df.select("v", F.col("v").cast(name)).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    ours = df.select("v", cast_leniently(F.col("v"), T.StringType(), TYPES[name])).collect()
    return [repr(tuple(r)) for r in ours], [repr(tuple(r)) for r in legacy]


@pytest.mark.parametrize("name", TYPES)
def test_text_casts_equal_those_without_ansi(spark, name):
    ours, legacy = both_casts(spark, TEXTS, name)
    assert ours == legacy


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="0123456789+-. eEdf\t", max_size=22), min_size=50, max_size=200))
def test_number_casts_on_generated_text(spark, texts):
    for name in ("int", "bigint"):
        ours, legacy = both_casts(spark, texts, name)
        assert ours == legacy


def test_casts_between_numbers(spark):
    df = spark.createDataFrame([(3.9, 2**40)], "d double, l bigint")
    out = df.select(
        cast_leniently(F.col("d"), T.DoubleType(), T.IntegerType()),
        cast_leniently(F.col("l"), T.LongType(), T.IntegerType()),
        cast_leniently(F.col("l"), T.LongType(), T.StringType()),
    )
    assert rows(out) == [(3, None, str(2**40))]


def test_slug(spark):
    slugs = {
        " My  Sheet ": "My_Sheet",
        "売上 2024": "_2024",
        "価格": "sheet",
        "": "sheet",
        None: "sheet",
        "a　b": "a_b",
        "x/y:z": "xyz",
        "v-1.2_ok": "v-1.2_ok",
        "\x1ctab\t": "tab",
        "a\x85b": "a_b",
        "__": "__",
        "-": "-",
    }
    df = spark.createDataFrame([(n,) for n in slugs], "n string")
    assert [r[0] for r in df.select(slug(F.col("n"))).collect()] == list(slugs.values())


def test_na_tokens(spark):
    df = spark.createDataFrame([(t, t, 1) for t in [*NA_TOKENS, "na", "0", None]], "a string, b string, c int")
    assert rows(na_to_null(df, ["a"]).where("a is not null").select("a", "c")) == [("0", 1), ("na", 1)]
    assert na_to_null(df, ["a"]).where("b is null").count() == 1
    assert na_to_null(df).where("b is null").count() == len(NA_TOKENS) + 1


def test_csv_line(spark):
    cells = [["a", None, "b,c"], ['say "x"', "l1\nl2", " pad "], [""], [None], ["", ""], []]
    df = spark.createDataFrame([(c,) for c in cells], "c array<string>")
    assert [r[0] for r in df.select(csv_line(F.col("c"))).collect()] == [
        'a,,"b,c"',
        '"say ""x""","l1\nl2", pad ',
        '""',
        '""',
        ",",
        "",
    ]
