import random

import pytest


@pytest.fixture(scope="session")
def documents(spark, sf_small):
    return spark.read.parquet(f"{sf_small}/documents.parquet").cache()


@pytest.fixture
def rng():
    return random.Random(7)
