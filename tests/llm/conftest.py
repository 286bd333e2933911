import pytest
from pyspark.sql import types as T

# Names that the operators use inside.
CLASHING = [
    "place", "node", "key", "label", "measures", "found", "entities", "group", "shard", "slot", "piece", "signature",
    "digest", "a", "b", "value", "limit", "word", "n", "attempts", "kept_id", "size", "law", "row", "cluster",
]
DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
])
WIDE = T.StructType(DOCUMENTS.fields + [T.StructField(c, T.StringType()) for c in CLASHING])

PROSE = " ".join(f"word{i % 37}x{i} and" for i in range(60))
LONG = " ".join(f"w{i}" for i in range(30_000))
TEXTS = [
    (1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "one"), (6, PROSE), (7, PROSE), (7, PROSE),
    (8, PROSE + " tail"), (9, LONG), (10, LONG + " end"), (11, "?!... 123"), (12, "mail a.b@c.org, 10.1.2.3"),
    (13, "a b c d"), (14, "A B c d"), (15, "x" * 5000), (None, PROSE), (None, None), (16, PROSE.upper()),
    (17, "résumé naïve œuvre 日本語 текст " * 30),
]


def rows(texts=TEXTS):
    langs, sources = ["en", None, "fr"], ["s1", "s2", None]
    return [
        (i, t, langs[k % 3], sources[k % 3], None if t is None else len(t)) for k, (i, t) in enumerate(texts)
    ]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """NULLs everywhere, empty and long texts, repeated rows, and clashing columns."""
    filler = [f"c{i}" for i in range(len(CLASHING))]
    return spark.createDataFrame([(*r, *filler) for r in rows()], WIDE)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], WIDE)


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
