import pytest
from pyspark.sql import functions as F


@pytest.fixture(scope="session")
def docs(spark):
    """Documents of the smallest table plus awkward rows, with an extra column of a clashing name."""
    from sentsift.llm.common import read
    base = read(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text")
    odd = spark.createDataFrame([
        (900001, "A b c"), (900002, None), (900003, ""), (900004, " \t\n"), (900005, "a B C"),
        (900006, "x y " * 3000), (900007, "word " * 40 + "end"), (900008, "▁ <s> \u00e9\U0001d4b3 \\l[")],
        "doc_id long, text string")
    return base.unionByName(odd).withColumn("n", F.lit("clash")).withColumn("key", F.lit(1))


@pytest.fixture(scope="session")
def rows(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string")
