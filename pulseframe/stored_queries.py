"""Registered queries of the operators that read or write stored tables and streams, each with the SQL of its batch form.

A query writes the rows of a fixture view into a new folder of the shared directory, runs the operator over it, and returns
what the operator gave or wrote. Streams run until their input is used up.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from . import fixtures as fx
from .functions import pixels as px
from .functions import scalars as sc
from .operators import frames as fr
from .plans import pixels as xp
from .plans import runs as ru
from .queries import E, FOLD, M, P, _accepted, _images, _sync, query
from .schemas import DETECTOR, FRAME, PACKET, RUN_INSTRUCTION
from .sources import archive as ar
from .sources import buffer_files as bf
from .sources import tables as tb
from .sources.staging import fresh_path
from .streaming import assembler as sa
from .streaming import frames as sf
from .streaming import images as si
from .streaming import runs as sr
from .streaming import sinks as sk

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Far beyond all pulses and times of the fixtures: what moves a watermark past them.
END_PULSE, END_TIME = 10**11, "2200-01-01 00:00:00"


def _stored(spark: SparkSession, *parts: DataFrame) -> str:
    """A folder with the parts, written one after the other, so that a stream finds them in this order."""
    path = fresh_path(spark, "stored")
    for part in parts:
        part.write.mode("append").parquet(path)
    return path


def _run(writer: DataStreamWriter, spark: SparkSession) -> None:
    """Runs a stream until its input is used up. State of any size needs the state store that keeps it on disk."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    spark.conf.set(key, ROCKSDB)
    try:
        q = writer.option("checkpointLocation", fresh_path(spark, "stream")).trigger(availableNow=True).start()
        q.awaitTermination()
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def _run_timed(writer: DataStreamWriter, spark: SparkSession, seconds: int = 300) -> None:
    """As _run, for a stream with processing-time timers, which has another batch to run for ever: until a batch has had no
    input after others had some. An error if no batch ends for so many seconds."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    spark.conf.set(key, ROCKSDB)
    q = writer.option("checkpointLocation", fresh_path(spark, "stream")).trigger(processingTime="50 milliseconds").start()
    try:
        end, last = time.time() + seconds, None
        while time.time() < end and q.isActive:
            rows, batch = [p["numInputRows"] for p in q.recentProgress], (q.lastProgress or {}).get("batchId")
            if batch != last:
                end, last = time.time() + seconds, batch
            if any(rows) and len(rows) > 2 and not any(rows[-2:]):
                return
            time.sleep(0.2)
        raise q.exception() or TimeoutError(f"no batch of the stream ended within {seconds} s")
    finally:
        q.stop()
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def _drained(stream: DataFrame, run=_run) -> DataFrame:  # noqa: ANN001
    """What a stream gives in append mode, as a table."""
    spark, path = stream.sparkSession, fresh_path(stream.sparkSession, "drained")
    run(stream.writeStream.format("parquet").option("path", path), spark)
    return spark.read.schema(stream.schema).parquet(path)


def _source(spark: SparkSession, df: DataFrame, *later: DataFrame, files: int | None = None) -> DataFrame:
    """df, and what comes after it, as a stream: so many files a batch, or all in one, however many they are."""
    path, rows = _stored(spark, df, *later), spark.readStream.schema(df.schema)
    return (rows.option("maxFilesPerTrigger", files) if files else rows).parquet(path)


#: Rows of a batch of a stream, about: batches get more with the input, not larger.
BATCH_ROWS = 2_000_000


def _batches(rows: DataFrame, column: str, least: int, most: int = BATCH_ROWS) -> tuple[list[DataFrame], int, int]:
    """The rows, written once and read again, in batches by even steps of a column, its first and last value; a batch is one
    file. At least `least` batches, so that few rows are cut, too."""
    rows = rows.sparkSession.read.schema(rows.schema).parquet(_stored(rows.sparkSession, rows))
    low, high, n = rows.agg(F.coalesce(F.min(column), F.lit(0)), F.coalesce(F.max(column), F.lit(0)), F.count("*")).first()
    parts = max(least, -(-n // most))
    at = F.least(F.floor((F.col(column) - low) * parts / (high - low + 1)), F.lit(parts - 1))
    return [rows.where(at == i).repartition(1) for i in range(parts)], low, high


def _packet_table(spark: SparkSession, d: str) -> DataFrame:
    """The fixture's packets in the schema of a packet table, with two bytes of payload."""
    p = fx.packets(spark, d).withColumns({"bunchid": F.col("pulse_id").cast("double"), "data": _bytes(F.col("seq") % 256, F.col("packetnum"))})
    named = {f.name: F.col(f.name) if f.name in p.columns else F.lit(None) for f in PACKET.fields}
    return p.select(*[named[f.name].cast(f.dataType).alias(f.name) for f in PACKET.fields])


def _bytes(*values: F.Column) -> F.Column:
    return F.unhex(F.concat(*[F.lpad(F.hex(v.cast("bigint")), 2, "0") for v in values]))


_DATA = "lpad(to_hex(seq % 256), 2, '0') || lpad(to_hex(packetnum), 2, '0')"

#: Half of the pulses, about their middle.
_LOW, _HIGH = "(select min(pulse_id) + (max(pulse_id) - min(pulse_id)) // 4 from frames)", "(select max(pulse_id) - (max(pulse_id) - min(pulse_id)) // 4 from frames)"

# --- sources ---------------------------------------------------------------------------------------------------------


@query("select module_id, pulse_id, framenum, debug, packetnum, seq from packets", "packets")
def src1_packets(spark: SparkSession, d: str) -> DataFrame:
    p = tb.read_packets(spark, _stored(spark, _packet_table(spark, d)))
    return p.select("module_id", F.col("bunchid").cast("bigint").alias("pulse_id"), "framenum", "debug", "packetnum", "seq")


@query("select module_id, framenum, packetnum, seq from packets", "packets")
def src1_stream(spark: SparkSession, d: str) -> DataFrame:
    return _drained(tb.stream_packets(spark, _stored(spark, _packet_table(spark, d)), 2).select("module_id", "framenum", "packetnum", "seq"))


def _datagrams(spark: SparkSession, d: str) -> DataFrame:
    """(seq, raw): one datagram for each frame, one byte short where a packet is missing."""
    f = fx.frames(spark, d)
    little = lambda v, n: F.array_join(F.reverse(F.regexp_extract_all(F.lpad(F.hex(v.cast("bigint")), 2 * n, "0"), F.lit("(..)"))), "")
    zero = lambda n: F.lit("00" * n)
    head = [little(F.col("frame_index"), 8), zero(4), little(F.col("seq") % 8, 4), little(F.col("pulse_id"), 8), zero(8), little(F.col("module_id"), 2), zero(6), little(F.col("daq_rec"), 4), zero(4)]
    size = F.when(F.col("n_recv_packets") == E, 8192).otherwise(8191)
    return f.select("seq", F.rpad(F.unhex(F.concat(*head)), 48 + size, _bytes(F.col("seq") % 256)).alias("raw"))


@query("select seq, frame_index as framenum, (seq % 8)::int as packetnum, pulse_id as bunchid, module_id, daq_rec as debug, lpad(to_hex(seq % 256), 2, '0') as last_byte, 8192 as n_bytes from frames where n_recv_packets = 128", "frames")
def src2_decode(spark: SparkSession, d: str) -> DataFrame:
    got = px.decode_packets(_datagrams(spark, d), dialect=2)
    return got.select("seq", "framenum", "packetnum", "bunchid", "module_id", "debug", F.lower(F.hex(F.substring("data", 8192, 1))).alias("last_byte"), F.length("data").alias("n_bytes")).withColumn("last_byte", F.upper("last_byte"))


_DETECTORS = "select 'JF' || lpad(n_nationkey::varchar, 2, '0') || 'T04' as detector_name, n_name as pedestal_file, n_regionkey::int as live_rate, 4 as n_modules from nation"


def _detector_files(spark: SparkSession, d: str) -> DataFrame:
    """One configuration file for each nation."""
    n = fx._table(spark, d, "nation")
    named = {
        "detector_name": F.concat(F.lit("JF"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0"), F.lit("T04")),
        "pedestal_file": F.col("n_name"),
        "live_rate": F.col("n_regionkey"),
        "n_modules": F.lit(4),
    }
    rows = n.select(*[named.get(f.name, F.lit("1")).cast(f.dataType).alias(f.name) for f in DETECTOR.fields])
    path = fresh_path(spark, "detectors")
    rows.write.option("maxRecordsPerFile", 1).json(path)
    return tb.read_detectors(spark, path).select("detector_name", "pedestal_file", "live_rate", "n_modules")


@query(_DETECTORS)
def src4_detectors(spark: SparkSession, d: str) -> DataFrame:
    return _detector_files(spark, d)


@query(f"select * from ({_DETECTORS}) where detector_name like 'JF07%'")
def src9_resolve(spark: SparkSession, d: str) -> DataFrame:
    return tb.resolve_detector(_detector_files(spark, d), "JF07")


@query(f"select module_id, pulse_id, frame_index, daq_rec, n_recv_packets, lpad(to_hex(seq % 256), 2, '0') || '00' as payload from frames where pulse_id between {_LOW} and {_HIGH}", "frames")
def src3_buffer_files(spark: SparkSession, d: str) -> DataFrame:
    """All frames written as files by tasks, and a range of them loaded."""
    root, frames = fresh_path(spark, "buffer"), fx.frames(spark, d).withColumn("payload", _bytes(F.col("seq") % 256))
    bf.write_buffer_files(frames, root, 2)
    low, high = frames.agg(F.coalesce(F.min("pulse_id"), F.lit(0)), F.coalesce(F.max("pulse_id"), F.lit(0))).first()
    got = bf.import_buffer_files(spark, root, M, low + (high - low) // 4, high - (high - low) // 4, 2)
    return got.withColumn("payload", F.hex("payload"))


@query("select run_id, i_image, n_images, pulse_id, bits_per_pixel from runs", "runs")
def src5_instructions(spark: SparkSession, d: str) -> DataFrame:
    r = fx.runs(spark, d)
    meta = F.struct("pulse_id", F.col("pulse_id").alias("frame_index"), F.lit(1).cast("bigint").alias("daq_rec"), F.lit(True).alias("is_good_image")).alias("image_metadata")
    rows = r.select(meta, *[F.col(f.name).cast(f.dataType).alias(f.name) for f in RUN_INSTRUCTION.fields[1:]])
    got = _drained(tb.stream_run_instructions(spark, _stored(spark, rows), 2))
    return got.select("run_id", "i_image", "n_images", "image_metadata.pulse_id", "bits_per_pixel")


def _archive_path(spark: SparkSession, d: str) -> str:
    """The fixture's frames written into an archive, and then those that came again over them."""
    path = fresh_path(spark, "archive")
    ar.write_archive(fx.frames(spark, d).select(*FRAME.names), path)
    ar.write_archive(fx.repeated_frames(spark, d), path)
    return path


def _archive(spark: SparkSession, d: str) -> DataFrame:
    return ar.read_archive(spark, _archive_path(spark, d))


_ARCHIVED = "(select arg_max(a, a.seq) as a from (select seq, module_id, pulse_id, frame_index, daq_rec, n_recv_packets from frames union all select * from repeated) a group by a.module_id, a.pulse_id)"


@query(f"select a.seq, a.module_id, a.pulse_id, a.frame_index, a.daq_rec, a.n_recv_packets from {_ARCHIVED}", "repeated")
def snk1_archive(spark: SparkSession, d: str) -> DataFrame:
    return _archive(spark, d).select(*FRAME.names)


@query(f"select a.seq, a.module_id, a.pulse_id, a.n_recv_packets from {_ARCHIVED} where a.pulse_id between {_LOW} and {_HIGH}", "repeated")
def src6_scan_range(spark: SparkSession, d: str) -> DataFrame:
    a = _archive(spark, d)
    low, high = a.agg(F.coalesce(F.min("pulse_id"), F.lit(0)), F.coalesce(F.max("pulse_id"), F.lit(0))).first()
    return ar.scan_pulse_range(a, low + (high - low) // 4, high - (high - low) // 4).select("seq", "module_id", "pulse_id", "n_recv_packets")


@query(
    f"""select s.pulse_id, s.module_id, f.a.frame_index as frame_index, f.a.n_recv_packets as n_recv_packets, coalesce(f.a.n_recv_packets = 128, false) as is_complete
       from (select {_LOW} as pulse_id, unnest(range(0, 4))::int as module_id) s left join {_ARCHIVED} f on s.pulse_id = f.a.pulse_id and s.module_id = f.a.module_id where s.pulse_id is not null""",
    "repeated",
)
def src7_point_lookup(spark: SparkSession, d: str) -> DataFrame:
    """The modules of one pulse, a quarter of the way along the archive; none of an empty one."""
    a = _archive(spark, d)
    low, high = a.agg(F.min("pulse_id"), F.max("pulse_id")).first()
    each = ar.point_lookup(a, 0 if low is None else low + (high - low) // 4, M, E)[1].where(F.lit(low is not None))
    return each.select("pulse_id", "module_id", "frame_index", "n_recv_packets", F.coalesce(fr.complete(E), F.lit(False)).alias("is_complete"))


_FILES = "(select distinct pulse_id // 1000 * 1000 as b from frames where module_id = {})"


@query(
    f"""select 0 as module_id, true as closed_only, (select max(b) from {_FILES.format(0)} where b < (select max(b) from {_FILES.format(0)})) as latest_file
       union all select 1, false, (select max(b) from {_FILES.format(1)}) union all select 2, true, (select max(b) - 1000 from {_FILES.format(2)} where b < (select max(b) from {_FILES.format(2)}))
       union all select 3, false, (select max(b) - 2000 from {_FILES.format(3)})""",
    "frames",
)
def src8_latest_pulse(spark: SparkSession, d: str) -> DataFrame:
    """The newest closed or open file, and ones before it, of each module."""
    path = _archive_path(spark, d)
    asked = [(0, True, 0), (1, False, 0), (2, True, -1000), (3, False, -2000)]
    rows = [ar.latest_pulse(spark, path, m, closed, offset).select(F.lit(m).alias("module_id"), F.lit(closed).alias("closed_only"), "latest_file") for m, closed, offset in asked]
    return rows[0].union(rows[1]).union(rows[2]).union(rows[3])


# --- bytes and pixels, filters ---------------------------------------------------------------------------------------


@query(
    f"""select module_id, frame_no::bigint as frame_no, string_agg(coalesce(v, '0000'), '' order by i) as payload from
       (select g.module_id, g.frame_no, i, arg_max({_DATA}, b.seq) as v from (select distinct module_id, frame_no from bounded) g cross join (select unnest(range(0, 8)) as i)
        left join bounded b on b.module_id = g.module_id and b.frame_no = g.frame_no and b.packetnum = i group by all) group by all""",
    "bounded",
)
def prj19_payload_bytes(spark: SparkSession, d: str) -> DataFrame:
    p = fr.frame_boundaries(fx.packets(spark, d), P).withColumn("data", _bytes(F.col("seq") % 256, F.col("packetnum")))
    return px.assemble_payload(p, ["module_id", "frame_no"], P, 2).withColumn("payload", F.hex("payload"))


@query("select seq, i as pos, (seq * (i + 1) * 7919 % 65536)::bigint as value from frames cross join (select unnest(range(0, 4)) as i)", "frames")
def prj21_pixels(spark: SparkSession, d: str) -> DataFrame:
    def two(i: int) -> F.Column:
        v = F.col("seq") * (i + 1) * 7919 % 65536
        return _bytes(v % 256, F.floor(v / 256))

    got = px.pixels(fx.frames(spark, d).select("seq", F.concat(*map(two, range(4))).alias("payload")))
    return got.select("seq", F.posexplode("pixels").alias("pos", "value")).select("seq", F.col("pos").cast("bigint").alias("pos"), F.col("value").cast("bigint").alias("value"))


@query("select seq, 8240 as n_bytes from frames where n_recv_packets = 128", "frames")
def flt1_valid_datagram(spark: SparkSession, d: str) -> DataFrame:
    return fr.valid_datagram(_datagrams(spark, d)).select("seq", F.length("raw").alias("n_bytes"))


@query("select seq, module_id from frames where seq % 190 <> 0", "frames")
def flt4_present(spark: SparkSession, d: str) -> DataFrame:
    marked = fx.frames(spark, d).withColumn("marker", F.when(F.col("seq") % 190 == 0, 0).otherwise(0xBE))
    return fr.present(marked).select("seq", "module_id")


# --- streams ---------------------------------------------------------------------------------------------------------

_STREAM_FRAMES = """select module_id, seq, pulse_id, frame_index, daq_rec, n_recv_packets, n_distinct_packets,
    frame_index <> lag(frame_index, 1, 0) over w + 1 or pulse_id - lag(pulse_id, 1, 0) over w <= 0 or pulse_id - lag(pulse_id, 1, 0) over w > 1000 as bad
    from (select * from assembled a where last_packet = 7 or frame_no < (select max(frame_no) from assembled b where b.module_id = a.module_id)) window w as (partition by module_id order by seq)"""


def _packet_stream(spark: SparkSession, d: str, *last: DataFrame) -> DataFrame:
    """Packets in their order of arrival, in four batches or more, and what comes last."""
    p = _packet_table(spark, d).withColumn("pulse_id", F.col("bunchid").cast("bigint"))
    return _source(spark, *_batches(p, "seq", 4, 4 * BATCH_ROWS)[0], *last, files=1)


@query(_STREAM_FRAMES, "assembled")
def st1_stream_frames(spark: SparkSession, d: str) -> DataFrame:
    return _drained(sf.stream_frames(_packet_stream(spark, d), P))


@query(
    f"""select module_id, min(seq) as seq, payload from (select b.module_id, b.frame_no, min(b.seq) as seq, max(z.payload) as payload from bounded b
       join (select module_id, frame_no, string_agg(coalesce(v, '0000'), '' order by i) as payload from
              (select g.module_id, g.frame_no, i, arg_max({_DATA}, b.seq) as v from (select distinct module_id, frame_no from bounded) g cross join (select unnest(range(0, 8)) as i)
               left join bounded b on b.module_id = g.module_id and b.frame_no = g.frame_no and b.packetnum = i group by all) group by all) z on z.module_id = b.module_id and z.frame_no = b.frame_no
       group by all) x where exists (select 1 from assembled a where a.module_id = x.module_id and a.frame_no = x.frame_no
         and (a.last_packet = 7 or a.frame_no < (select max(frame_no) from assembled c where c.module_id = a.module_id))) group by module_id, x.frame_no, payload""",
    "assembled",
)
def st1_stream_payload(spark: SparkSession, d: str) -> DataFrame:
    got = _drained(sf.stream_frames(_packet_stream(spark, d), P, packet_bytes=2))
    return got.select("module_id", "seq", F.hex("payload").alias("payload"))


@query(_STREAM_FRAMES[: _STREAM_FRAMES.index("from (select * from assembled a")] + "from assembled window w as (partition by module_id order by seq)", "assembled")
def st1_stream_silent(spark: SparkSession, d: str) -> DataFrame:
    """Modules that fall silent give their open frames: a last batch of another module lets their timers fire."""
    last = _packet_table(spark, d).limit(1).withColumns({"module_id": F.lit(99), "packetnum": F.lit(0), "pulse_id": F.lit(0).cast("bigint")})
    got = _drained(sf.stream_frames(_packet_stream(spark, d, last), P, silent_ms=1, emit_open=True), _run_timed)
    return got.where("module_id < 99").select("module_id", "seq", "pulse_id", "frame_index", "daq_rec", "n_recv_packets", "n_distinct_packets", "bad")


@query("select detector_name, seq + shift as seq, module_id, bad from flagged cross join (values ('JF01', 0), ('JF02', 500)) as n(detector_name, shift)", "flagged")
def st2_stream_guard(spark: SparkSession, d: str) -> DataFrame:
    """Two detectors whose frames come between one another's."""
    frames = fx.frames(spark, d).select(*FRAME.names)
    both = [frames.withColumns({"detector_name": F.lit(n), "seq": F.col("seq") + shift}) for n, shift in (("JF01", 0), ("JF02", 500))]
    parts = _batches(both[0].unionByName(both[1]), "seq", 1, 4 * BATCH_ROWS)[0]
    return _drained(sf.stream_guard(_source(spark, *parts, files=1), keys=("detector_name", "module_id"))).select("detector_name", "seq", "module_id", "bad")


def _end(spark: SparkSession, like: DataFrame, **values: object) -> DataFrame:
    """One row beyond all others."""
    return spark.range(1).select(*[F.lit(values.get(f.name, 0 if f.dataType.typeName() in ("long", "integer") else None)).cast(f.dataType).alias(f.name) for f in like.schema.fields])


_ALIGNED = "select i.pulse_id, i.frame_index, i.daq_rec, i.is_good_image from (" + FOLD.format(frames="accepted") + ") i join aligned a on i.pulse_id = a.pulse_id"


@query(
    f"""select detector_name, i.pulse_id, case when n_good_modules > 0 then i.frame_index + shift else 0 end as frame_index, i.daq_rec, i.is_good_image from ({FOLD.format(frames="repeated")}) i
       cross join (values ('JF01', 0), ('JF02', 1)) as n(detector_name, shift) where (select count(distinct module_id) from repeated r where r.pulse_id = i.pulse_id) = 4""",
    "repeated",
)
def st3_stream_images(spark: SparkSession, d: str) -> DataFrame:
    """Two detectors in one stream, frames that came again with other contents, and a module that is none of theirs."""
    r = fx.repeated_frames(spark, d)
    foreign = r.where("module_id = 2").withColumns({"module_id": F.lit(9), "daq_rec": F.lit(7).cast("bigint")})
    each = [r.unionByName(foreign).withColumns({"detector_name": F.lit(n), "frame_index": F.col("frame_index") + i}) for i, n in enumerate(("JF01", "JF02"))]
    rows = each[0].unionByName(each[1])
    got = _drained(si.stream_images(_source(spark, rows, _end(spark, rows, pulse_id=END_PULSE)), M, E, keys=("detector_name", "pulse_id")))
    return got.drop("event_time")


def _assembled(spark: SparkSession, d: str, **options: int) -> DataFrame:
    """Accepted frames as a stream in three batches or more, a module behind the others in each, to the synchroniser's events."""
    frames = _accepted(spark, d).select(F.lit("JF01").alias("detector_name"), *FRAME.names)
    sent = frames.withColumn("sent", F.col("pulse_id") + F.when(F.col("module_id") == 1, 40).otherwise(0))
    parts = [p.drop("sent") for p in _batches(sent, "sent", 3)[0]]
    return sa.stream_sync(_source(spark, *parts, _end(spark, frames, pulse_id=END_PULSE).coalesce(1), files=1), M, E, **options)


@query(f"select s.pulse_id, n_lost_pulses, violation, frame_index, daq_rec, is_good_image from {_sync(100, 3)} s join ({FOLD.format(frames='accepted')}) i using (pulse_id) where met", "accepted")
def agg8_stream_sync(spark: SparkSession, d: str) -> DataFrame:
    return _drained(_assembled(spark, d)).where("event = 'aligned'").select("pulse_id", "n_lost_pulses", "violation", "frame_index", "daq_rec", "is_good_image")


@query(f"select detector_name, pulse_id, began as violation from {_sync(1, 1)} where began is not null", "accepted")
def agg9_stream_violations(spark: SparkSession, d: str) -> DataFrame:
    return _drained(_assembled(spark, d, limit=1, rounds=1)).where("event <> 'aligned'").select("detector_name", "pulse_id", "violation")


@query(_ALIGNED, "accepted", "aligned")
def st4_late_frames(spark: SparkSession, d: str) -> DataFrame:
    """All frames once more, as complete as can be, when the watermark has passed them: they change nothing."""
    frames = _accepted(spark, d).select(*FRAME.names).coalesce(1)
    late = frames.withColumns({"n_recv_packets": F.lit(E).cast("bigint"), "daq_rec": F.lit(9).cast("bigint")})
    ends = [_end(spark, frames, pulse_id=END_PULSE + i, module_id=i).coalesce(1) for i in range(2)]
    got = _drained(si.stream_images(_source(spark, frames, *ends, late, files=1), M, E))
    return got.select("pulse_id", "frame_index", "daq_rec", "is_good_image")


@query("select i.pulse_id, i.is_good_image, p.module_id, cast(p.pixels[1] as double) as first_pixel from images i join payload p on i.pulse_id = p.pulse_id", "images", "payload")
def st5_stream_pixels(spark: SparkSession, d: str) -> DataFrame:
    images, payload = _source(spark, _images(spark, d)), _source(spark, fx.payload(spark, d))
    return _drained(si.stream_attach_pixels(images, payload)).select("pulse_id", "is_good_image", "module_id", F.col("pixels")[0].cast("double").alias("first_pixel"))


@query(
    """select module_id, date_trunc('day', recv_ts)::timestamp as window_start, count(*) as n_frames, sum(greatest(128 - n_recv_packets, 0))::bigint as n_missed_packets,
       count(*) filter (n_recv_packets < 128) as n_corrupted_frames, count(*) filter (bad) as n_bad_frames, (count(*) * 1000 + 250) // 86400000 as repetition_rate from flagged group by all""",
    "flagged",
)
def st6_stream_stats(spark: SparkSession, d: str) -> DataFrame:
    flagged = fr.flag_sequence(fx.frames(spark, d).withColumn("recv_ts", F.col("recv_ts").cast("timestamp")))
    got = _drained(si.stream_frame_stats(_source(spark, flagged, _end(spark, flagged, recv_ts=END_TIME)), "1 day", 86_400_000, E))
    return got.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query(
    f"""select bucket, count(*) as n_images, count(*) filter (not is_good_image) as n_corrupted_images, sum(n_lost_pulses)::bigint as n_lost_pulses
       from (select is_good_image, n_lost_pulses, (row_number() over (order by s.pulse_id) - 1) // 100 as bucket from {_sync(100, 3)} s join ({FOLD.format(frames='accepted')}) i using (pulse_id) where met)
       group by bucket having count(*) = 100""",
    "accepted",
)
def st7_stream_counts(spark: SparkSession, d: str) -> DataFrame:
    """Of the assembler's images, each with what was lost before it: two stateful steps in one stream."""
    images = _assembled(spark, d).where("event = 'aligned'")
    return _drained(sf.stream_count_stats(images, 100)).drop("detector_name")


@query(
    """select 'live' as stream, pulse_id, true as has_data from images union all select 'reduced', pulse_id, pulse_id % 10 = 0 from images union all select 'pulses', pulse_id, null from images""",
    "images",
)
def st8_live_sink(spark: SparkSession, d: str) -> DataFrame:
    out = fresh_path(spark, "live")
    named = _images(spark, d).withColumns({"pedestal_file": F.lit("p"), "gain_file": F.lit("g"), "detector_name": F.lit("JF01"), "n_modules": F.lit(M), "data": F.lit(b"pixels")})
    _run(sk.live_sink(_source(spark, named), out), spark)
    sent = [spark.read.parquet(f"{out}/{s}").select(F.lit(s).alias("stream"), F.col("key").alias("pulse_id"), (F.col("data") == F.lit(b"pixels")).alias("has_data")) for s in ("live", "reduced")]
    pulses = spark.read.parquet(f"{out}/pulses").select(F.lit("pulses").alias("stream"), "pulse_id", F.lit(None).cast("boolean").alias("has_data"))
    return sent[0].unionByName(sent[1]).unionByName(pulses)


_SHUFFLED = "select 'JF' || (run_id // 8 % 4)::varchar as detector_name, pulse_id * 2 + case when pulse_id % 5 = 0 then 9 else 0 end as seq, * from runs"


def _instructions(spark: SparkSession, d: str) -> DataFrame:
    """Run instructions of four detectors, one in five of them late, so that runs mix."""
    late = F.when(F.col("pulse_id") % 5 == 0, 9).otherwise(0)
    return fx.runs(spark, d).withColumns({"detector_name": F.concat(F.lit("JF"), (F.floor(F.col("run_id") / 8) % 4).cast("string")), "seq": F.col("pulse_id") * 2 + late})


@query(
    f"""select * from (with s as ({_SHUFFLED}),
       o as (select *, sum((i_image = 0)::int) over (partition by detector_name order by seq rows unbounded preceding) as seg from s),
       r as (select *, first_value(run_id) over (partition by detector_name, seg order by seq) as current from o),
       c as (select *, seg > 0 and run_id = current as own from r),
       e as (select *, coalesce(bool_or(own and i_image + 1 = n_images) over (partition by detector_name, seg order by seq rows between unbounded preceding and 1 preceding), false) as ended from c)
       select detector_name, seq, run_id, i_image, case when i_image = 0 then case when n_images = 1 then 'open+close' else 'open' end
         when not own or ended then 'rejected' when i_image + 1 = n_images then 'close' else 'write' end as event from e)""",
    "runs",
)
def st9_run_lifecycle(spark: SparkSession, d: str) -> DataFrame:
    got = _drained(sr.run_lifecycle(_source(spark, _instructions(spark, d))))
    return got.select("detector_name", "seq", "run_id", "i_image", "event")


@query(
    f"""select * from (with s as (select *, case when i_image = 0 then 1 when i_image + 1 = n_images then 2 else 0 end as op_code from ({_SHUFFLED})),
       o as (select *, coalesce(sum((op_code = 2)::int) over (partition by detector_name order by seq rows between unbounded preceding and 1 preceding), 0) as seg from s),
       f as (select *, min(seq) filter (op_code = 1) over (partition by detector_name, seg) as began, min_by(run_id, seq) filter (op_code = 1) over (partition by detector_name, seg) as current from o)
       select detector_name, seq, run_id, op_code, case when op_code = 2 then case when began < seq then 'close' else 'reset' end when op_code = 1 then case when seq = began then 'open' else 'ignored' end
         when began < seq and run_id = current then 'write' else 'ignored' end as event from f)""",
    "runs",
)
def st9b_op_codes(spark: SparkSession, d: str) -> DataFrame:
    code = F.when(F.col("i_image") == 0, 1).when(F.col("i_image") + 1 == F.col("n_images"), 2).otherwise(0)
    rows = _instructions(spark, d).withColumn("op_code", code)
    got = _drained(sr.run_lifecycle(_source(spark, rows), "op_code"))
    return got.join(rows.select("detector_name", "seq", "op_code"), ["detector_name", "seq"]).select("detector_name", "seq", "run_id", "op_code", "event")


# --- sinks -----------------------------------------------------------------------------------------------------------


@query("select seq, module_id, pulse_id, frame_index from accepted", "accepted")
def snk1_archive_stream(spark: SparkSession, d: str) -> DataFrame:
    path = fresh_path(spark, "archive")
    flagged = fr.flag_sequence(fx.frames(spark, d).select(*FRAME.names))
    _run(sk.archive_sink(_source(spark, flagged), path), spark)
    return ar.read_archive(spark, path).select("seq", "module_id", "pulse_id", "frame_index")


_RUN_ROWS = "select run_id, i_image, pulse_id, 'uint' || bits_per_pixel::varchar as pixel_type, ((512 * 1024 * bits_per_pixel) // 8)::bigint as image_bytes from runs"


def _read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select(F.col("run_id").cast("bigint").alias("run_id"), "i_image", "pulse_id", "pixel_type", "image_bytes")


@query(_RUN_ROWS.replace("select run_id,", "select run_id // 50 as run_id,"), "runs")
def snk4_write_runs(spark: SparkSession, d: str) -> DataFrame:
    """Written twice, first with other pulses: runs are replaced. Fifty conversations are a run here."""
    path, rows = fresh_path(spark, "runs"), ru.run_rows(fx.runs(spark, d).withColumn("run_id", F.floor(F.col("run_id") / 50)))
    ru.write_runs(rows.withColumn("pulse_id", F.lit(0).cast("bigint")), path, 2)
    ru.write_runs(rows, path, 2)
    return _read_runs(spark, path)


_AGAIN = f"""select detector_name, seq * 4 as seq, run_id, i_image, n_images, pulse_id, bits_per_pixel from ({_SHUFFLED}) union all
             select detector_name, seq * 4 + 1, run_id, i_image, n_images, pulse_id, 32 from ({_SHUFFLED}) where pulse_id % 7 = 0"""
_EVENTS_OF = lambda source: f"""(with s as ({source}),
       o as (select *, sum((i_image = 0)::int) over (partition by detector_name order by seq rows unbounded preceding) as seg from s),
       r as (select *, first_value(run_id) over (partition by detector_name, seg order by seq) as current from o),
       c as (select *, seg > 0 and run_id = current as own from r),
       e as (select *, coalesce(bool_or(own and i_image + 1 = n_images) over (partition by detector_name, seg order by seq rows between unbounded preceding and 1 preceding), false) as ended from c)
       select *, case when i_image = 0 then case when n_images = 1 then 'open+close' else 'open' end
         when not own or ended then 'rejected' when i_image + 1 = n_images then 'close' else 'write' end as event from e)"""  # noqa: E731


def _run_output(spark: SparkSession, d: str) -> str:
    """Instructions of four detectors, some late and so rejected, some that came again with other sizes, in two batches."""
    rows = _instructions(spark, d).withColumn("seq", F.col("seq") * 4)
    again = rows.where("pulse_id % 7 = 0").withColumns({"seq": F.col("seq") + 1, "bits_per_pixel": F.lit(32)})
    rows, path = rows.unionByName(again), fresh_path(spark, "runs")
    parts = _batches(rows, "seq", 2)[0]
    _run(sk.run_sink(_source(spark, *parts, files=1), path, 1), spark)
    return path


@query(
    f"""select run_id, i_image, arg_max(pulse_id, seq) as pulse_id, 'uint' || arg_max(bits_per_pixel, seq)::varchar as pixel_type, ((512 * 1024 * arg_max(bits_per_pixel, seq)) // 8)::bigint as image_bytes
       from {_EVENTS_OF(_AGAIN)} where event <> 'rejected' group by run_id, i_image""",
    "runs",
)
def snk4_run_sink(spark: SparkSession, d: str) -> DataFrame:
    """What stands in the runs' files, as it was written."""
    return _read_runs(spark, f"{_run_output(spark, d)}/runs")


@query(f"select run_id, max(n_images) as n_images from {_EVENTS_OF(_AGAIN)} where event in ('close', 'open+close') group by run_id", "runs")
def snk4_closed_runs(spark: SparkSession, d: str) -> DataFrame:
    return sk.closed_runs(spark, _run_output(spark, d))


@query("select pulse_id, ('0x' || substr(md5(pulse_id::varchar || ':7'), 1, 8))::bigint % 10 = 0 as has_data from images", "images")
def flt10_hashed(spark: SparkSession, d: str) -> DataFrame:
    """A random share of the images, the same one over any number of partitions."""
    return fr.thin(_images(spark, d).repartition(5), 10, [], seed=7).select("pulse_id", "has_data")


_LINES = """select 'jf_frames,module=M' || module_id::varchar || ' n_frames=' || count(*)::varchar || 'i ' || (max(seq) * 1000)::varchar as line from frames group by module_id, pulse_id // 1000"""


def _lines(spark: SparkSession, d: str) -> DataFrame:
    g = fx.frames(spark, d).groupBy("module_id", sc.div("pulse_id", 1000).alias("w")).agg(F.count("*").alias("n"), F.max("seq").alias("last"))
    return g.select(sc.line_protocol("jf_frames", {"module": F.concat(F.lit("M"), F.col("module_id").cast("string"))}, {"n_frames": ("n", True)}, F.col("last") * 1000).alias("line"))


@query(_LINES, "frames")
def snk5_write_stats(spark: SparkSession, d: str) -> DataFrame:
    path = fresh_path(spark, "lines")
    ru.write_stats(_lines(spark, d), path)
    return spark.read.text(path).withColumnRenamed("value", "line")


@query(_LINES, "frames")
def snk5_stats_sink(spark: SparkSession, d: str) -> DataFrame:
    path = fresh_path(spark, "lines")
    _run(sk.stats_sink(_source(spark, _lines(spark, d)), path), spark)
    return spark.read.option("recursiveFileLookup", True).text(path).withColumnRenamed("value", "line")


def _pixel_archive(spark: SparkSession, d: str) -> str:
    """The fixture's frames with two bytes of pixels, and those that came again over them, as an archive."""
    path = fresh_path(spark, "pixels")
    pixels = lambda df: df.select(*FRAME.names).withColumn("payload", _bytes(F.col("seq") % 251, F.col("module_id")))
    xp.write_pixel_archive(pixels(fx.frames(spark, d)), path)
    xp.write_pixel_archive(pixels(fx.repeated_frames(spark, d)), path)
    return path


def _ends(spark: SparkSession, d: str) -> tuple[int, int]:
    """A range without the first pulse, and beyond the last."""
    low, high = fx.frames(spark, d).agg(F.coalesce(F.min("pulse_id"), F.lit(0)), F.coalesce(F.max("pulse_id"), F.lit(0))).first()
    return low + 1, high + 5


_IMAGES = f"""select requested_pulse_id, coalesce(i.pulse_id, 0) as pulse_id, coalesce(frame_index, 0)::bigint as frame_index, coalesce(daq_rec, 0)::bigint as daq_rec,
    coalesce(is_good_image, false)::int as is_good_frame, requested_pulse_id - (select min(pulse_id) + 1 from frames) as write_index,
    coalesce({" || ".join(f"coalesce(x{m}, '0000')" for m in range(4))}, '00000000' || '00000000') as image
    from (select unnest(range((select min(pulse_id) + 1 from frames), (select max(pulse_id) + 6 from frames))) as requested_pulse_id) g
    left join ({FOLD.format(frames="(select a.seq, a.module_id, a.pulse_id, a.frame_index, a.daq_rec, a.n_recv_packets from " + _ARCHIVED + ")")}) i on i.pulse_id = requested_pulse_id
    left join (select a.pulse_id as p, {", ".join(f"max(lpad(to_hex(a.seq % 251), 2, '0') || '0{m}') filter (a.module_id = {m}) as x{m}" for m in range(4))} from {_ARCHIVED} group by a.pulse_id) z on p = requested_pulse_id"""


@query(_IMAGES, "repeated")
def snk3_export_pixels(spark: SparkSession, d: str) -> DataFrame:
    """What stands in the written images: metadata and pixels of every pulse of the range."""
    out, (low, high) = fresh_path(spark, "export"), _ends(spark, d)
    xp.export_pixels(spark, _pixel_archive(spark, d), M, low, high, out, 1, E, "JF01", payload=2)
    return spark.read.parquet(f"{out}/images").drop("digest").withColumn("image", F.hex("image"))


@query("select 'JF01' as detector_name, 4 as n_modules, (select min(pulse_id) + 1 from frames) as start, (select max(pulse_id) + 5 from frames) as stop, 1::bigint as step, count(*) as n_images from (select unnest(range((select min(pulse_id) + 1 from frames), (select max(pulse_id) + 6 from frames))))", "frames")
def snk3_export_general(spark: SparkSession, d: str) -> DataFrame:
    out, (low, high) = fresh_path(spark, "export"), _ends(spark, d)
    xp.export_pixels(spark, _pixel_archive(spark, d), M, low, high, out, 1, E, "JF01", payload=2)
    return spark.read.parquet(f"{out}/general").withColumn("n_images", F.lit(spark.read.parquet(f"{out}/images").count()))


@query(
    f"""select requested_pulse_id as pulse_id, unnest(case when requested_pulse_id % 97 = 0 then ['module 1'] when requested_pulse_id % 89 = 0 then ['frame_index', 'module 0', 'module 1', 'module 2', 'module 3'] end) as field
       from ({_IMAGES}) where requested_pulse_id % 97 = 0 or requested_pulse_id % 89 = 0""",
    "repeated",
)
def jn6_verify_pixels(spark: SparkSession, d: str) -> DataFrame:
    """An export that was damaged and signed anew: a module's pixels here, a whole image and its frame index there."""
    path, out, (low, high) = _pixel_archive(spark, d), fresh_path(spark, "export"), _ends(spark, d)
    xp.export_pixels(spark, path, M, low, high, out, 1, E, "JF01", payload=2)
    e, p = spark.read.parquet(f"{out}/images"), F.col("requested_pulse_id")
    one = F.concat(F.substring("image", 1, 2), F.lit(b"\xff\xff"), F.substring("image", 5, 4))
    image = F.when(p % 97 == 0, one).when(p % 89 == 0, F.lit(b"\xff" * 8)).otherwise(F.col("image"))
    bad = e.withColumns({"image": image, "frame_index": F.col("frame_index") + F.when((p % 97 != 0) & (p % 89 == 0), 1).otherwise(0), "digest": F.when((p % 97 == 0) | (p % 89 == 0), F.sha2(image, 256)).otherwise(F.col("digest"))})
    return xp.verify_pixels(bad, spark, path, M, E, payload=2).select("pulse_id", "field")


@query("select pulse_id, frame_index, daq_rec, is_good_image from images", "images")
def snk6_publish_images(spark: SparkSession, d: str) -> DataFrame:
    path = fresh_path(spark, "published")
    _run(sk.publish_images(_source(spark, _images(spark, d).select("pulse_id", "frame_index", "daq_rec", "is_good_image")), path), spark)
    return spark.read.parquet(path)
