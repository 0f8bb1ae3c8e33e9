"""Helpers that the training-data operators share."""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.staging import fresh_path, removed

#: Bytes of A-Z become a-z; all others stay. For bytes.translate().
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))

#: As LOWER, but every byte outside [0-9A-Za-z] and below 0x80 becomes a space: bytes.split() then gives the words
#: `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` of the lower-cased text.
ALNUM = bytes((LOWER[c] if c >= 128 or chr(c).isalnum() else 32) for c in range(256))


#: The tables staged in this thread since noted() began, if it did.
_NOTED: ContextVar[list[str] | None] = ContextVar("noted", default=None)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Writes df as Parquet into the shared folder and reads it again. Cuts the lineage; lost executors cost nothing. The
    result's staged_at says where."""
    spark, path = df.sparkSession, fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    if (held := _NOTED.get()) is not None:
        held.append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_at = path
    return out


#: Bytes of an Arrow batch of long rows (texts, sets of shingles).
ARROW_BYTES = 4 << 20


@contextmanager
def small_batches(spark: SparkSession, size: int = ARROW_BYTES) -> Iterator[None]:
    """What is run inside hands rows to Python in batches of so many bytes, or of the session's own size if that is smaller.
    Spark's default is a number of rows, which long rows make batches of tens of MB of, twice for a task: in the executor and
    in its Python worker."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    if before is None or not before.isdigit() or int(before) > size:
        spark.conf.set(key, str(size))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


@contextmanager
def noted() -> Iterator[list[str]]:
    """A list that takes the paths of what is staged inside, by this thread alone, for clear()."""
    held: list[str] = []
    before = _NOTED.set(held)
    try:
        yield held
    finally:
        _NOTED.reset(before)


def clear(spark: SparkSession, paths: list[str]) -> None:
    """Removes staged tables that nothing reads any more."""
    for path in paths:
        removed(spark, path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Plans that give the same rows in the same partitions and order each time they are read.
_FIXED = re.compile(r"^[\s:+|\-]*(Project|Filter|Relation|LogicalRelation|LocalRelation|Union|LocalLimit 0)\b")


def _is_fixed(df: DataFrame) -> bool:
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return all(_FIXED.match(line) for line in plan.splitlines() if line.strip())


def with_row_id(df: DataFrame, name: str = "_row") -> DataFrame:
    """A key for each row, so that null and repeated ids stay apart. It holds as long as each reading gives the same rows in
    the same partitions and order, as columns of a scan or of a staged table do; any other input is staged first."""
    if not _is_fixed(df):
        df = staged(df, "rows")
    return df.withColumn(name, F.monotonically_increasing_id())


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
