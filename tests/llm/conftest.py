"""Small tables with the cases that every operator has to bear."""

import pytest
from pyspark.sql import DataFrame, SparkSession

LONG = " ".join(f"w{i % 997}x{i % 31}" for i in range(30_000))
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, print binary, tie long, key long, q string, component_id long, size long, verdict string"


@pytest.fixture(scope="session")
def odd(spark: SparkSession) -> DataFrame:
    """Nulls in any column, empty and long texts, ties, repeated rows, columns with the names of inner ones."""
    prose = "the quick brown fox jumps over the lazy dog and runs far away from all that it has ever known in its long life".split()
    body = " ".join(prose + prose[::-1] + [f"{a}{b}" for a in "abc" for b in range(12)])
    texts = [(1, None), (2, ""), (3, " \n\t "), (4, body), (5, body), (5, body), (None, body), (None, None), (6, LONG), (6, "one word"), (7, "x"), (8, body + " tail")]
    rows = [(i, t, None if i == 7 else "en", None if i in (4, None) else f"s{(i or 0) % 3}", None if t is None else len(t), None, None, 1, "q", 0, 9, "v") for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def nothing(odd: DataFrame) -> DataFrame:
    return odd.where("false")
