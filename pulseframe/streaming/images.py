"""Image assembly, late data, payload joins and time statistics on streams (ST-3 .. ST-6). Built-in operators only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import pulse_event_time, repetition_rate
from ..operators.images import fold, slots
from ..schemas import PACKETS, PULSE_MS, RING_PULSES, STATS_WINDOW, SYNC_OFFSET

SKEW = f"{SYNC_OFFSET * PULSE_MS} milliseconds"
RING = f"{RING_PULSES * PULSE_MS} milliseconds"


def with_event_time(df: DataFrame, delay: str = RING) -> DataFrame:
    """df with the pulse's event time and a watermark; rows behind it are dropped by what follows."""
    return df.withColumn("event_time", pulse_event_time("pulse_id")).withWatermark("event_time", delay)


def stream_images(frames: DataFrame, n_modules: int, expected: int = PACKETS[1], check_daq_rec: bool = True, aligned_only: bool = True, delay: str = SKEW, keys: tuple[str, ...] = ("pulse_id",)) -> DataFrame:
    """(event_time, keys, frame_index, daq_rec, is_good_image) from a stream of accepted frames; keys holds pulse_id and
    whatever else tells images apart, as in the batch form. State is a pulse's slots, one for each of the modules
    0 .. n_modules-1: a frame fills its module's slot unless one written later (seq) is there, and other modules have none.
    A pulse is final once the watermark, the skew that modules may have, has passed it; with aligned_only pulses that lack a
    module are left out."""
    by = ("event_time", *keys)
    held = slots(with_event_time(frames, delay), n_modules, by)
    each = [F.col(f"_m{m}").isNotNull() for m in range(n_modules)]
    there = each[0]
    for x in each[1:]:
        there = there & x if aligned_only else there | x
    return fold(held.where(there), n_modules, by, expected, check_daq_rec).drop("n_good_modules")


def stream_attach_pixels(images: DataFrame, payload: DataFrame, delay: str = RING) -> DataFrame:
    """Image metadata joined to payloads by pulse; what is not met within the ring's ten seconds is dropped. Both inputs
    have pulse_id; event times are made here."""
    a = with_event_time(images.drop("event_time"), delay).alias("i")
    b = with_event_time(payload.drop("event_time"), delay).alias("p")
    # equal event times bound the state on both sides
    on = (F.col("i.pulse_id") == F.col("p.pulse_id")) & (F.col("i.event_time") == F.col("p.event_time"))
    return a.join(b, on).select("i.*", *[F.col(f"p.{c}") for c in payload.columns if c not in ("pulse_id", "event_time")])


def stream_frame_stats(frames: DataFrame, interval: str = STATS_WINDOW, interval_ms: int = 10_000, expected: int = PACKETS[1], delay: str = STATS_WINDOW) -> DataFrame:
    """Statistics of aligned windows over recv_ts. (A receiver's own windows start at its last report; these start on the
    clock, so that modules and restarts agree.)"""
    frames = frames.withColumn("recv_ts", F.col("recv_ts").cast("timestamp"))
    out = frames.withWatermark("recv_ts", delay).groupBy("module_id", F.window("recv_ts", interval).alias("w")).agg(
        F.count("*").alias("n_frames"),
        F.sum(F.greatest(F.lit(expected) - F.col("n_recv_packets"), F.lit(0))).cast("bigint").alias("n_missed_packets"),
        F.count_if(F.col("n_recv_packets") < expected).alias("n_corrupted_frames"),
        F.count_if(F.col("bad")).alias("n_bad_frames"),
    )
    return out.select("module_id", F.col("w.start").alias("window_start"), "n_frames", "n_missed_packets", "n_corrupted_frames", "n_bad_frames", repetition_rate("n_frames", interval_ms).alias("repetition_rate"))
