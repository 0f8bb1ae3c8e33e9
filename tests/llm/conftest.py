from __future__ import annotations

import pytest

SCHEMA = "doc_id long, text string, source string, labels string, score double, n_words long, _x int"


@pytest.fixture
def odd(spark):  # noqa: ANN001, ANN201
    """Nulls in any column, empty and long texts, repeated rows, ties, and columns with clashing names."""
    long_ = " ".join(f"word{i % 977}" for i in range(30_000))
    rows = [
        (1, "Plain text here.", "a", "x", 0.5, 3, 1),
        (1, "Plain text here.", "a", "x", 0.5, 3, 1),
        (2, None, None, None, None, None, None),
        (None, "no id at all", "b", "y", 1.0, 1, 2),
        (None, "no id at all", "b", "y", 1.0, 1, 2),
        (3, "", "a", "", 0.0, 0, 0),
        (4, " \n\t \r\n", "a", "", 0.0, 0, 0),
        (5, long_, "c", "z", 0.1, 9, 3),
        (6, "naïve Ünïcode     \U0001f600 ＡＢ", None, "z", 0.1, 9, 3),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture
def stored(spark, tmp_path):  # noqa: ANN001, ANN201
    """Operators that number rows read a stored table."""

    def store(df):  # noqa: ANN001, ANN202
        path = str(tmp_path / f"t{len(list(tmp_path.iterdir()))}")
        df.write.parquet(path)
        return spark.read.parquet(path)

    return store
