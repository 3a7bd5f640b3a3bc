import pytest
from pyspark.sql import types as T

LONG = "lorem ipsum dolor sit amet " * 20_000

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("source", T.StringType()),
        # Names that operators use for columns of their own.
        *[T.StructField(n, T.StringType()) for n in ("size", "shard", "slot", "w", "row", "keep")],
        *[T.StructField(n, T.StringType()) for n in ("spans", "items", "word", "key", "low", "n")],
    ]
)


@pytest.fixture(scope="session")
def docs_of(spark):
    """A frame of documents from ``(doc_id, text, source)``, with clashing extra columns."""

    def make(rows, parts=3):
        extra = ("x",) * (len(DOCS) - 3)
        frame = spark.createDataFrame([(*r, *extra) for r in rows], DOCS)
        return frame.repartition(parts) if rows else frame

    return make


@pytest.fixture(scope="session")
def stored(spark, tmp_path_factory):
    """A frame as a stored table."""

    def store(df):
        path = str(tmp_path_factory.mktemp("stored") / "t")
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    return store


#: Nulls, empty and blank texts, a very long one, ties, repeated rows and a repeated id.
NASTY = [
    (1, None, "a"),
    (2, "", "a"),
    (3, " \t\n\x0b\x0c\r ", None),
    (4, "one", "b"),
    (5, "one", "b"),
    (6, LONG, "b"),
    (7, LONG, "c"),
    (8, "été œuvre ſ K 🎉 word", "c"),
    (9, "a b c d e f g h i j k l m n o p", "c"),
    (9, "a b c d e f g h i j k l m n o p", "c"),
    (10, "z a b c d e f g h i j k l m n o p q", None),
    (11, "quite another text\nwith two lines\nwith two lines", "a"),
    (11, "and one more under the same id", "a"),
    (None, "a b c d e f g h i j k l m n o p", "a"),
]
