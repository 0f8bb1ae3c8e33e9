"""Packet tables and streams, run instructions, detector configurations (SRC-1, SRC-4, SRC-5, SRC-9)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import DETECTOR, PACKET, RUN_INSTRUCTION


def read_packets(spark: SparkSession, path: str) -> DataFrame:
    """One row for each datagram, with its arrival order `seq`."""
    return spark.read.schema(PACKET).parquet(path)


def stream_packets(spark: SparkSession, path: str, files_per_trigger: int = 64) -> DataFrame:
    return spark.readStream.schema(PACKET).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def stream_run_instructions(spark: SparkSession, path: str, files_per_trigger: int = 64) -> DataFrame:
    """In file order."""
    return spark.readStream.schema(RUN_INSTRUCTION).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def read_detectors(spark: SparkSession, path: str) -> DataFrame:
    """The configuration table; malformed files and missing keys are errors."""
    df = spark.read.schema(DETECTOR).option("multiLine", True).option("mode", "FAILFAST").json(path)

    def required(name: str) -> Column:
        said = F.raise_error(F.lit(f"detector configuration without {name}"))
        return F.when(F.col(name).isNotNull(), F.col(name)).otherwise(said.cast(df.schema[name].dataType)).alias(name)

    return df.select(*[required(f.name) for f in DETECTOR.fields])


def resolve_detector(detectors: DataFrame, prefix: str) -> DataFrame:
    """The one detector whose name starts with prefix; none and several are different errors."""
    found = detectors.where(F.col("detector_name").startswith(prefix))
    names = [r[0] for r in found.select("detector_name").limit(2).collect()]
    if not names:
        raise LookupError(f"no detector starts with {prefix!r}")
    if len(names) > 1:
        raise LookupError(f"several detectors start with {prefix!r}")
    return found
