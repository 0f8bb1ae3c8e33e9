"""The frame archive: a Parquet table by module, folder and file of pulses (SRC-6 .. SRC-8, SNK-1, SNK-2)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import file_base, folder_base
from ..operators.frames import latest_per_key
from ..operators.images import assemble_images, module_spine
from ..schemas import FILE_PULSES, FOLDER_PULSES, PACKETS
from .staging import removed

PARTITIONS = ["module_id", "folder_base", "file_base"]


def with_partitions(frames: DataFrame) -> DataFrame:
    return frames.withColumns({"folder_base": folder_base("pulse_id"), "file_base": file_base("pulse_id")})


def write_archive(frames: DataFrame, path: str) -> None:
    """Upserts frames by (module_id, pulse_id), the last write (seq) wins. Only the partitions touched are written: their
    rows are read, merged and put in place of the old ones, so a replay changes nothing and other files stay as they are.
    The merged rows are written next to the archive first, for a partition cannot be read and overwritten at once."""
    spark = frames.sparkSession
    new = with_partitions(frames)
    if exists(spark, path):
        old = spark.read.parquet(path)
        touched = new.select(*PARTITIONS).distinct()
        old = old.join(touched, PARTITIONS, "left_semi").select(*[F.col(c).cast(new.schema[c].dataType).alias(c) for c in new.columns])
        new = old.unionByName(new)
    merged = latest_per_key(new)
    held = f"{path.rstrip('/')}._merged-{uuid.uuid4().hex}"
    merged.write.parquet(held)
    merged = spark.read.parquet(held)
    # one task for each partition's file, sorted so that row groups have narrow pulse ranges
    merged = merged.repartition(*PARTITIONS).sortWithinPartitions(*PARTITIONS, "pulse_id")
    merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*PARTITIONS).parquet(path)
    removed(spark, held)


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(p) and len(fs.listStatus(p)) > 0


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def scan_pulse_range(archive: DataFrame, start: int, stop: int) -> DataFrame:
    """Frames of the pulses start .. stop, both included. The same range is said of the partition columns, which prunes
    folders and files; Parquet's statistics prune row groups."""
    df = archive.where(F.col("pulse_id").between(start, stop))
    for name, size in (("folder_base", FOLDER_PULSES), ("file_base", FILE_PULSES)):
        if name in archive.columns:
            df = df.where(F.col(name).between(start // size * size, stop // size * size))
    return df


def point_lookup(archive: DataFrame, pulse_id: int, n_modules: int, expected: int = PACKETS[1]) -> tuple[DataFrame, DataFrame]:
    """(image, frames) of one pulse: the folded image, and a row for each module, absent ones with nulls. Pixels of
    incomplete frames are kept."""
    spark = archive.sparkSession
    frames = scan_pulse_range(archive, pulse_id, pulse_id)
    spine = module_spine(spark.range(pulse_id, pulse_id + 1).withColumnRenamed("id", "pulse_id"), n_modules)
    each = spine.join(frames, ["pulse_id", "module_id"], "left")
    return assemble_images(each, n_modules, expected), each


def _numbers(spark: SparkSession, path: str, name: str) -> list[int]:
    """The values of a partition column that have a folder in `path`, newest first."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    names = [x.getPath().getName() for x in fs.listStatus(p) if x.isDirectory()]
    found = [n.removeprefix(f"{name}=") for n in names if n.startswith(f"{name}=")]
    return sorted((int(n) for n in found if n.lstrip("-").isdigit()), reverse=True)


def latest_pulse(spark: SparkSession, path: str, module_id: int = 0, closed_only: bool = True, offset: int = 0) -> DataFrame:
    """(latest_file): the newest file's first pulse of a module, the open one aside; offset 0 is that file, -1000 the one
    before; null without one. The archive's folders tell: names alone are read, of the newest folder and, where it has but
    one file, of the one before. No pointer file is kept."""
    found: list[int] = []
    folder = f"{path}/module_id={module_id}"
    for base in _numbers(spark, folder, "folder_base"):
        found += _numbers(spark, f"{folder}/folder_base={base}", "file_base")
        if len(found) > closed_only:
            break
    latest = found[int(closed_only)] + offset if len(found) > closed_only else None
    return spark.createDataFrame([(latest,)], "latest_file bigint")


publish_latest = latest_pulse
