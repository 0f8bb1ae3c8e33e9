"""Explicit schemas and the fixed values of the data model. Nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values of the data model.
FOLDER_PULSES = 100_000  # pulses of an archive folder
FILE_PULSES = 1_000  # pulses of an archive file
BLOCK_PULSES = 100  # pulses of a read block; steps divide it
RING_PULSES = 1_000  # pulses a live consumer can still see
PULSE_MS = 10  # machine rate 100 Hz
MODULE_Y, MODULE_X = 512, 1024
MODULE_BYTES = MODULE_Y * MODULE_X * 2
PACKETS = {1: 128, 2: 4096}  # packets of a frame, by dialect
PACKET_BYTES = 8192
DATAGRAM_BYTES = 48 + PACKET_BYTES
MAX_PULSE_GAP = 1_000
STATS_WINDOW = "10 seconds"
STATS_COUNT = 1_000
SYNC_OFFSET, SYNC_ROUNDS = 100, 3
MARKER = 0xBE

PACKET = T.StructType([
    T.StructField("seq", T.LongType()),
    T.StructField("module_id", T.IntegerType()),
    T.StructField("framenum", T.LongType()),
    T.StructField("exptime", T.LongType()),
    T.StructField("packetnum", T.IntegerType()),
    T.StructField("bunchid", T.DoubleType()),
    T.StructField("timestamp", T.LongType()),
    T.StructField("x_coord", T.IntegerType()),
    T.StructField("y_coord", T.IntegerType()),
    T.StructField("z_coord", T.IntegerType()),
    T.StructField("debug", T.LongType()),
    T.StructField("round_robin", T.IntegerType()),
    T.StructField("detector_type", T.ShortType()),
    T.StructField("header_version", T.ShortType()),
    T.StructField("data", T.BinaryType()),
])

FRAME = T.StructType([
    T.StructField("seq", T.LongType()),
    T.StructField("module_id", T.IntegerType()),
    T.StructField("pulse_id", T.LongType()),
    T.StructField("frame_index", T.LongType()),
    T.StructField("daq_rec", T.LongType()),
    T.StructField("n_recv_packets", T.LongType()),
])

IMAGE = T.StructType([
    T.StructField("pulse_id", T.LongType()),
    T.StructField("frame_index", T.LongType()),
    T.StructField("daq_rec", T.LongType()),
    T.StructField("is_good_image", T.BooleanType()),
])

RUN_INSTRUCTION = T.StructType([
    T.StructField("image_metadata", IMAGE),
    T.StructField("run_id", T.LongType()),
    T.StructField("i_image", T.LongType()),
    T.StructField("n_images", T.LongType()),
    T.StructField("image_y_size", T.LongType()),
    T.StructField("image_x_size", T.LongType()),
    T.StructField("bits_per_pixel", T.IntegerType()),
])

DETECTOR = T.StructType([
    T.StructField("streamvis_stream", T.StringType()),
    T.StructField("streamvis_rate", T.IntegerType()),
    T.StructField("live_stream", T.StringType()),
    T.StructField("live_rate", T.IntegerType()),
    T.StructField("pedestal_file", T.StringType()),
    T.StructField("gain_file", T.StringType()),
    T.StructField("detector_name", T.StringType()),
    T.StructField("n_modules", T.IntegerType()),
    T.StructField("start_udp_port", T.IntegerType()),
    T.StructField("buffer_folder", T.StringType()),
])
