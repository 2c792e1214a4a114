"""Rows that every operator must take: nulls, empty and long texts, ties, repeats, clashing names."""
import pytest
from pyspark.sql import functions as F

from llm_rows import CLASHES, documents, messy_rows


@pytest.fixture(scope="session")
def messy(spark):
    df = spark.createDataFrame(messy_rows(), "doc_id long, text string, source string")
    return df.select("*", *[F.lit(f"x-{c}").alias(c) for c in CLASHES])


@pytest.fixture(scope="session")
def nothing(messy):
    return messy.limit(0)


@pytest.fixture(scope="session")
def make(spark):
    return lambda texts: documents(spark, texts)
