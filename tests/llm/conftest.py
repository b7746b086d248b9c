from __future__ import annotations

import pytest
from llm_samples import CLASHES, SCHEMA, odd_rows


@pytest.fixture(scope="session")
def odd(spark):
    from pyspark.sql import functions as F

    frame = spark.createDataFrame(odd_rows(), SCHEMA)
    return frame.withColumns({c: F.lit("x") for c in CLASHES})


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.limit(0)
