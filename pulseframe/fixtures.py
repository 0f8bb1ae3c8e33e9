"""Views over the driver's tables that play the roles of frames, packets, runs and payloads. The SQL runs in Spark and in
DuckDB; the DataFrame functions read the tables and apply it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators.ordering import running_index

N_MODULES, EXPECTED, PACKETS = 4, 128, 8

FRAMES = """
    select event_id as seq, ts as recv_ts,
           cast(event_id % 4 as int) as module_id,
           cast(floor(event_id / 4) as bigint) + 1 as pulse_id,
           cast(floor(event_id / 4) as bigint) + 1
             + case when event_type = 'error' and value > 150 then 1 else 0 end as frame_index,
           cast(case when event_type = 'signup' and value > 200 then 2 else 1 end as bigint) as daq_rec,
           cast(case when value < 1.0 then 127 else 128 end as bigint) as n_recv_packets
    from {events} where value <= 250"""

PACKET_ROWS = """
    select f.module_id, f.pulse_id, f.frame_index as framenum, f.daq_rec as debug,
           p.packetnum, f.seq * 8 + p.packetnum as seq
    from {frames} f
    cross join (values (0),(1),(2),(3),(4),(5),(6),(7)) as p(packetnum)
    where (f.seq * 31 + p.packetnum * 17) % 97 <> 0"""

RUNS_SQL = """
    select conv_id as run_id, turn as i_image,
           count(*) over (partition by conv_id) as n_images,
           row_number() over (order by conv_id, turn) as pulse_id,
           512 as image_y_size, 1024 as image_x_size,
           case conv_id % 3 when 0 then 8 when 1 then 16 else 32 end as bits_per_pixel,
           1000 + (conv_id * 7 + turn * 13) % 500 as write_us
    from conversations"""

PAYLOAD = """
    select cast(vec_id % 4 as int) as module_id,
           cast(floor(vec_id / 4) as bigint) + 1 as pulse_id,
           embedding as pixels
    from {embeddings} where vec_id % 37 <> 0"""


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(FRAMES, events=_table(spark, sf_dir, "events"))


#: Frames of which one in 41 came again: with another module's slot left empty in its stead, or with a packet less.
REPEATED = """
    select seq, module_id, pulse_id, frame_index, daq_rec, n_recv_packets from {frames}
    where seq % 43 <> 1
    union all
    select seq + 1000000000, module_id, pulse_id, frame_index, daq_rec, case when seq % 3 = 0 then 127 else 128 end
    from {frames} where seq % 41 = 0 or seq % 43 = 0"""


def repeated_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(REPEATED, frames=frames(spark, sf_dir))


#: Frames of which module 3's last quarter comes from a counter that has jumped ahead.
DRIFTED = """
    select seq, module_id, case when module_id = 3 and pulse_id > (select max(pulse_id) - floor((max(pulse_id) - min(pulse_id)) / 4) from {frames})
                                then pulse_id + 1000000 else pulse_id end as pulse_id from {frames}"""


def drifted(frames: DataFrame) -> DataFrame:
    return frames.sparkSession.sql(DRIFTED, frames=frames)


def packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cross join with eight constants is an explode here."""
    f = frames(spark, sf_dir).withColumn("packetnum", F.explode(F.sequence(F.lit(0), F.lit(PACKETS - 1))))
    kept = f.where((F.col("seq") * 31 + F.col("packetnum") * 17) % 97 != 0)
    return kept.select("module_id", "pulse_id", F.col("frame_index").alias("framenum"), F.col("daq_rec").alias("debug"), "packetnum", (F.col("seq") * PACKETS + F.col("packetnum")).alias("seq"))


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The global row number is counted by shares of conv_id, not in one window."""
    c = _table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("run_id"), F.col("turn").alias("i_image"))
    n = c.groupBy("run_id").agg(F.count("*").alias("n_images"))
    c = running_index(c, ["run_id", "i_image"], "_i", F.floor(F.col("run_id") / 1000)).join(n, "run_id")
    bits = F.when(F.col("run_id") % 3 == 0, 8).when(F.col("run_id") % 3 == 1, 16).otherwise(32)
    return c.select("run_id", "i_image", "n_images", (F.col("_i") + 1).alias("pulse_id"), F.lit(512).alias("image_y_size"), F.lit(1024).alias("image_x_size"), bits.alias("bits_per_pixel"), (1000 + (F.col("run_id") * 7 + F.col("i_image") * 13) % 500).alias("write_us"))


def payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(PAYLOAD, embeddings=_table(spark, sf_dir, "embeddings"))


def export(images: DataFrame) -> DataFrame:
    """A damaged copy of images."""
    return images.where("pulse_id % 101 <> 0").select(
        "pulse_id",
        F.when(F.col("pulse_id") % 97 == 0, F.col("frame_index") + 1).otherwise(F.col("frame_index")).alias("frame_index"),
        "daq_rec",
        F.when(F.col("pulse_id") % 89 == 0, ~F.col("is_good_image")).otherwise(F.col("is_good_image")).alias("is_good_image"),
    )
