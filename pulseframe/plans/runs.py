"""Runs: instructions joined to images, and run output (JN-7, SNK-4, SNK-5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import image_n_bytes, pixel_type
from ..operators.frames import writer_shard


def runs_with_images(instructions: DataFrame, images: DataFrame) -> DataFrame:
    """Instructions with their image's metadata, by pulse."""
    return instructions.join(images, "pulse_id")


def run_rows(instructions: DataFrame) -> DataFrame:
    """What a run's file says of each image, with the pixel type and the bytes of an image."""
    return instructions.withColumns({"pixel_type": pixel_type("bits_per_pixel"), "image_bytes": image_n_bytes("image_y_size", "image_x_size", "bits_per_pixel")})


def write_runs(rows: DataFrame, out: str, n_writers: int = 8) -> None:
    """Writes rows by run; runs already there are replaced, others stay. Images are dealt to writers by index, and inside a
    file they stand in that order."""
    dealt = writer_shard(rows, n_writers).sortWithinPartitions("run_id", "i_image")
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(out)


#: Run numbers whose rows are kept together by write_run_blocks().
BLOCK_RUNS = 1000


def with_block(rows: DataFrame) -> DataFrame:
    return rows.withColumn("run_block", F.floor(F.col("run_id") / BLOCK_RUNS))


def write_run_blocks(rows: DataFrame, out: str, n_writers: int = 8) -> None:
    """Writes rows by blocks of BLOCK_RUNS run numbers, for many small runs: blocks already there are replaced, so rows must
    be all of their blocks', others stay. Images are dealt to writers by index; in a file runs and images stand in order."""
    dealt = with_block(rows).repartition("run_block", F.pmod("i_image", F.lit(n_writers))).sortWithinPartitions("run_block", "run_id", "i_image")
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_block").parquet(out)


def write_stats(lines: DataFrame, out: str, mode: str = "append") -> None:
    """Lines of statistics (column `line`) as text."""
    lines.select(F.col("line").alias("value")).write.mode(mode).text(out)
