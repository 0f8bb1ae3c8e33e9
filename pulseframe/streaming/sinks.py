"""Stream sinks: the archive, image metadata, live streams, runs, statistics (ST-8, SNK-1, SNK-4 .. SNK-6)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..functions.scalars import live_header_json
from ..operators.frames import latest_per_key, thin
from ..plans.runs import run_rows, with_block, write_run_blocks
from ..sources.archive import exists, write_archive
from ..sources.staging import removed
from .runs import run_lifecycle, written


def archive_sink(frames: DataFrame, path: str) -> DataStreamWriter:
    """Each batch is merged by key, so a replayed batch changes nothing."""
    return frames.writeStream.foreachBatch(lambda df, _: write_archive(df.where(~F.col("bad")).drop("bad"), path))


def publish_images(images: DataFrame, path: str) -> DataStreamWriter:
    """Image metadata as a Parquet stream."""
    return images.writeStream.format("parquet").option("path", path).outputMode("append")


def live_messages(images: DataFrame, factor: int, data: str = "data") -> DataFrame:
    """(key, header, data): every image's header; pixels for one in `factor`, eight zero bytes for the others."""
    kept = thin(images, factor, [data])
    header = live_header_json(F.col("has_data"), "n_modules")
    return kept.select(F.col("pulse_id").alias("key"), header.alias("header"), F.coalesce(data, F.lit(bytes(8))).alias("data"))


def live_sink(images: DataFrame, out: str, live_factor: int = 1, reduced_factor: int = 10) -> DataStreamWriter:
    """Three streams from one pass over each batch: full, reduced, and pulse numbers alone. A folder for each batch makes a
    replay overwrite what it wrote before."""

    def write(df: DataFrame, batch: int) -> None:
        df.persist()
        try:
            live_messages(df, live_factor).write.mode("overwrite").parquet(f"{out}/live/batch={batch}")
            live_messages(df, reduced_factor).write.mode("overwrite").parquet(f"{out}/reduced/batch={batch}")
            df.select("pulse_id").write.mode("overwrite").parquet(f"{out}/pulses/batch={batch}")
        finally:
            df.unpersist()

    return images.writeStream.foreachBatch(write)


#: What a run's file says of the size of its images.
_SIZES = ("image_y_size", "image_x_size", "bits_per_pixel")


def run_sink(instructions: DataFrame, out: str, n_writers: int = 8, mode: str = "index", strict: bool = False) -> DataStreamWriter:
    """Runs as they come, from instructions as run_lifecycle() takes them, with the sizes of their images. The lifecycle is a
    stateful step of the same stream: images of a run that is not open are not written. Of instructions for one image of a
    run the latest by seq counts, in a batch and over batches, so a replayed batch changes nothing. Rows are kept
    in files by blocks of run numbers, not in a folder for each run; blocks that a batch adds to are read, merged and replaced.
    When a run closes, a row in `out`/_closed says so, see closed_runs()."""
    events = written(run_lifecycle(instructions, mode, strict, _SIZES))

    def write(df: DataFrame, batch: int) -> None:
        spark = df.sparkSession
        df.persist()
        try:
            rows = run_rows(df.drop("event"))
            if exists(spark, f"{out}/runs"):
                blocks = with_block(rows).select("run_block").distinct()
                old = spark.read.parquet(f"{out}/runs").join(blocks, "run_block", "left_semi")
                rows = old.select(*[F.col(c).cast(rows.schema[c].dataType).alias(c) for c in rows.columns]).unionByName(rows)
            held = f"{out.rstrip('/')}._merged-{uuid.uuid4().hex}"
            latest_per_key(rows, ("run_id", "i_image")).write.parquet(held)
            write_run_blocks(spark.read.parquet(held), f"{out}/runs", n_writers)
            removed(spark, held)
            # after the rows, so that a run that is said to be closed is whole
            closed = df.where(F.col("event").isin("close", "open+close")).groupBy("run_id").agg(F.max("n_images").alias("n_images"), F.max("seq").alias("seq"))
            closed.write.mode("overwrite").parquet(f"{out}/_closed/batch={batch}")
        finally:
            df.unpersist()

    return events.writeStream.foreachBatch(write)


def closed_runs(spark: SparkSession, out: str) -> DataFrame:
    """(run_id, n_images): the runs that run_sink() has written to their end, one row each."""
    held = [p for p in (f"{out}/_closed",) if exists(spark, p)]
    rows = spark.read.parquet(f"{held[0]}/batch=*") if held else spark.createDataFrame([], "run_id bigint, n_images bigint, seq bigint")
    return rows.groupBy("run_id").agg(F.max_by("n_images", "seq").alias("n_images"))


def stats_sink(lines: DataFrame, out: str) -> DataStreamWriter:
    return lines.writeStream.foreachBatch(lambda df, n: df.select(F.col("line").alias("value")).write.mode("overwrite").text(f"{out}/batch={n}"))
