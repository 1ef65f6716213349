import pytest
from pyspark.sql import functions as F


@pytest.fixture
def docs(spark):
    """Nulls, empty, blank, short and long texts, ties, repeated rows, copies,
    near copies, and extra columns whose names the operators use inside."""
    line = " ".join(f"w{i}" for i in range(40))
    near = line.replace("w39", "other")
    rows = [(1, line), (2, line), (2, line), (3, near), (4, None), (5, ""), (6, " \t\n"), (7, "one two"), (8, "One TWO"),
            (9, " ".join(["again"] * 60)), (10, " ".join(f"x{i % 977}" for i in range(30_000))),
            (11, "p q r " + line + " s t u"), (None, line), (None, None), (12, "a b c d e"), (13, "a b c d f"),
            (14, "été naïve 日本語 \U0001F600")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for clash in ("id", "n", "node", "key", "page", "lane", "start", "token", "label", "anchor"):
        df = df.withColumn(clash, F.lit("clash"))
    return df


@pytest.fixture
def no_docs(docs):
    return docs.where("1 = 0")
