"""Statistics: time windows, count buckets, write latencies, runs (AGG-3 .. AGG-7, AGG-10, AGG-11, WIN-3, WIN-4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import div, file_base, image_n_bytes, repetition_rate
from ..schemas import PACKETS, STATS_COUNT, STATS_WINDOW
from .ordering import running_index


def frame_stats(frames: DataFrame, interval: str = STATS_WINDOW, interval_ms: int = 10_000, expected: int = PACKETS[1], keys: tuple[str, ...] = ("module_id",)) -> DataFrame:
    """Frames, missing packets, corrupted frames, bad frames and the repetition rate of each window. All frames count, bad
    ones too; only frames with fewer packets than expected are corrupted. Needs recv_ts and bad."""
    out = frames.groupBy(*keys, F.window("recv_ts", interval).alias("w")).agg(
        F.count("*").alias("n_frames"),
        F.sum(F.greatest(F.lit(expected) - F.col("n_recv_packets"), F.lit(0))).cast("bigint").alias("n_missed_packets"),
        F.count_if(F.col("n_recv_packets") < expected).alias("n_corrupted_frames"),
        F.count_if(F.col("bad")).alias("n_bad_frames"),
    )
    return out.select(*keys, F.col("w.start").alias("window_start"), "n_frames", "n_missed_packets", "n_corrupted_frames", "n_bad_frames", repetition_rate("n_frames", interval_ms).alias("repetition_rate"))


def image_index(images: DataFrame, out: str = "i_image", keys: list[str] | None = None) -> DataFrame:
    """Dense 0 .. n-1 in pulse order, numbered file by file."""
    return running_index(images, ["pulse_id"], out, file_base("pulse_id"), keys)


def count_buckets(df: DataFrame, modulo: int = STATS_COUNT, order: str = "pulse_id", keys: list[str] | None = None, share: Column | None = None) -> DataFrame:
    """df with `bucket`: runs of `modulo` rows along the order. Rows after the last full run are left out."""
    keys = keys or []
    df = running_index(df, [order], "_i", file_base(order) if share is None else share, keys).withColumn("bucket", div("_i", modulo)).drop("_i")
    full = df.groupBy(*keys, "bucket").agg(F.count("*").alias("_n")).where(F.col("_n") == modulo).drop("_n")
    return df.join(full, [*keys, "bucket"], "left_semi")


def bucket_stats(images: DataFrame, modulo: int = STATS_COUNT, keys: list[str] | None = None) -> DataFrame:
    """Images, bad images and lost pulses of each full run of images, in one aggregation after the numbering."""
    keys = keys or []
    numbered = running_index(images, ["pulse_id"], "_i", file_base("pulse_id"), keys)
    out = numbered.groupBy(*keys, div("_i", modulo).alias("bucket")).agg(F.count("*").alias("n_images"), F.count_if(~F.col("is_good_image")).alias("n_corrupted_images"), F.sum("n_lost_pulses").cast("bigint").alias("n_lost_pulses"))
    return out.where(F.col("n_images") == modulo)


def assembler_stats(images: DataFrame, modulo: int = STATS_COUNT) -> DataFrame:
    return bucket_stats(images, modulo)


def stream_stats(images: DataFrame, stream_name: str, modulo: int = STATS_COUNT) -> DataFrame:
    return bucket_stats(images, modulo).drop("n_lost_pulses").withColumn("stream_name", F.lit(stream_name))


def archive_write_stats(writes: DataFrame, modulo: int = STATS_COUNT) -> DataFrame:
    """Average (a whole number, as a double) and longest write of each full run of a module's writes; needs write_us."""
    numbered = running_index(writes, ["pulse_id"], "_i", file_base("pulse_id"), ["module_id"])
    out = numbered.groupBy("module_id", div("_i", modulo).alias("bucket")).agg(F.count("*").alias("n_writes"), div(F.sum("write_us"), F.count("*")).cast("double").alias("avg_write_us"), F.max("write_us").cast("bigint").alias("max_write_us"))
    return out.where(F.col("n_writes") == modulo)


def run_write_stats(writes: DataFrame) -> DataFrame:
    """Images, write times, bytes and MiB a second of each run."""
    out = writes.groupBy("run_id").agg(
        F.count("*").alias("n_images"),
        F.avg("write_us").alias("avg_write_us"),
        F.max("write_us").cast("bigint").alias("max_write_us"),
        F.sum(image_n_bytes("image_y_size", "image_x_size", "bits_per_pixel")).cast("bigint").alias("n_bytes"),
    )
    per_image = F.col("n_bytes") / F.col("n_images") / (1 << 20)
    return out.withColumn("mib_per_s", F.try_divide(per_image, F.col("avg_write_us") / 1e6))


def write_latency_summary(writes: DataFrame, every: int = 100, order: str = "i_image", keys: list[str] | None = None) -> DataFrame:
    """Number, average, shortest and longest of each `every` writes, the last ones too."""
    keys = keys if keys is not None else ["run_id"]
    bucket = div(order, every)
    return writes.groupBy(*keys, bucket.alias("bucket")).agg(F.count("*").alias("n_writes"), F.avg("write_us").alias("avg_write_us"), F.min("write_us").cast("bigint").alias("min_write_us"), F.max("write_us").cast("bigint").alias("max_write_us"))


def run_summary(instructions: DataFrame) -> DataFrame:
    """First and last pulse, images received and expected, bad images, and whether the last image has come."""
    return instructions.groupBy("run_id").agg(
        F.count("*").alias("n_received"),
        F.max("n_images").cast("bigint").alias("n_expected"),
        F.min("pulse_id").alias("first_pulse"),
        F.max("pulse_id").alias("last_pulse"),
        F.count_if(~F.col("is_good_image")).alias("n_bad"),
        (F.max("i_image") + 1 == F.max("n_images")).alias("is_complete"),
    )

