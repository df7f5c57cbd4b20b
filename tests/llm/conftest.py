import public_tokenizers
import pytest
from pyspark.sql import types as T

from odd_data import CLASHING, ODD_TEXTS

from docferry.llm.common import ship


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture(scope="session")
def byte_bpe():
    return public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="session")
def odd_documents(spark):
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), *(T.StructField(c, T.StringType()) for c in CLASHING)])
    return spark.createDataFrame([(*r, *("clash" for _ in CLASHING)) for r in ODD_TEXTS], schema).repartition(3)


@pytest.fixture(scope="session")
def no_documents(spark, odd_documents):
    return spark.createDataFrame([], odd_documents.schema)
