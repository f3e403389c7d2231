import pytest
from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"

#: Documents with further columns whose names the operators use inside.
SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("row", T.LongType()),
        T.StructField("key", T.StringType()),
        T.StructField("spans", T.StringType()),
        T.StructField("part", T.IntegerType()),
        T.StructField("grp", T.IntegerType()),
        T.StructField("n", T.IntegerType()),
    ]
)
LONG = " ".join(f"wort{k % 4001}é{k}" for k in range(30_000))
TEXTS = [
    (1, None),
    (2, ""),
    (3, "  \n\t "),
    (4, "one two three"),
    (5, "one two three"),
    (5, "one two three"),
    (6, LONG),
    (None, "A text without an id, but with enough words to be looked at closely."),
    (7, "x"),
    (8, "!!! ... ???"),
    (None, None),
    (9, "naïve café 中文 🙂 “quoted” \x00 zero"),
]


@pytest.fixture(scope="session")
def odd(spark):
    rows = [(f"s{k}", i, t, None, "k", "s", 0, 0, 0) for k, (i, t) in enumerate(TEXTS)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
