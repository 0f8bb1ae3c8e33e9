"""Registered queries of the operators, each with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fixtures as fx
from .functions import pixels as px
from .functions import scalars as sc
from .operators import frames as fr
from .operators import images as im
from .operators import stats as st
from .operators import sync as sy
from .plans import historical as hi
from .plans import runs as ru

M, E, P = fx.N_MODULES, fx.EXPECTED, fx.PACKETS
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

#: Images from frames: the last frame of each module's slot, then the fold by pulse.
FOLD = """select pulse_id, coalesce(arg_min(frame_index, module_id) filter (ok), 0) as frame_index, coalesce(arg_min(daq_rec, module_id) filter (ok), 0) as daq_rec,
                 coalesce(count(distinct module_id) filter (ok) = 4 and min(frame_index) filter (ok) = max(frame_index) filter (ok)
                   and min(daq_rec) filter (ok) = max(daq_rec) filter (ok), false) as is_good_image,
                 count(distinct module_id) filter (ok) as n_good_modules
                 from (select pulse_id, module_id, arg_max(frame_index, seq) as frame_index, arg_max(daq_rec, seq) as daq_rec, arg_max(n_recv_packets, seq) = 128 as ok from {frames} group by pulse_id, module_id) group by pulse_id"""

#: SQL of the fixture views and of the operators that others build on.
VIEWS = {
    "frames": fx.FRAMES.format(events="events"),
    "flagged": """select *, frame_index <> lag(frame_index, 1, 0) over w + 1 or pulse_id - lag(pulse_id, 1, 0) over w <= 0
                   or pulse_id - lag(pulse_id, 1, 0) over w > 1000 as bad from frames window w as (partition by module_id order by seq)""",
    "accepted": "select * from flagged where not bad",
    "packets": fx.PACKET_ROWS.format(frames="frames"),
    "bounded": """select *, sum(case when n is null or n <> framenum or l = 7 then 1 else 0 end) over (partition by module_id order by seq rows unbounded preceding) as frame_no
                  from (select *, lag(framenum) over w as n, lag(packetnum) over w as l from packets window w as (partition by module_id order by seq))""",
    "assembled": """select module_id, frame_no, arg_min(pulse_id, seq) as pulse_id, arg_min(framenum, seq) as frame_index, arg_min(debug, seq) as daq_rec,
                    count(*) as n_recv_packets, count(distinct packetnum) as n_distinct_packets, min(seq) as seq, arg_max(packetnum, seq) as last_packet from bounded group by module_id, frame_no""",
    "drifted": fx.DRIFTED.format(frames="accepted"),
    "images": FOLD.format(frames="frames"),
    "repeated": fx.REPEATED.format(frames="frames"),
    "aligned": "select pulse_id from accepted group by pulse_id having count(distinct module_id) = 4",
    "lost": """select goal as pulse_id, max(n) as n_lost_pulses from
               (select goal, module_id, count(distinct pulse_id) filter (pulse_id < goal) as n from
                 (select a.pulse_id, a.module_id, (select min(s.pulse_id) from aligned s where s.pulse_id >= a.pulse_id) as goal from accepted a)
                where goal is not null group by goal, module_id) group by goal""",
    "runs": fx.RUNS_SQL,
    "payload": fx.PAYLOAD.format(embeddings="embeddings"),
    "export": """select pulse_id, case when pulse_id % 97 = 0 then frame_index + 1 else frame_index end as frame_index, daq_rec,
                 case when pulse_id % 89 = 0 then not is_good_image else is_good_image end as is_good_image from images where pulse_id % 101 <> 0""",
}
NEEDS = {"repeated": ["frames"], "flagged": ["frames"], "accepted": ["flagged"], "packets": ["frames"], "bounded": ["packets"], "assembled": ["bounded"], "images": ["frames"], "aligned": ["accepted"], "drifted": ["accepted"], "lost": ["accepted", "aligned"], "export": ["images"]}


def _with(*views: str) -> str:
    names: list[str] = []

    def add(v: str) -> None:
        for x in NEEDS.get(v, []):
            add(x)
        if v not in names:
            names.append(v)

    for v in views:
        add(v)
    return "with " + ", ".join(f"{v} as ({VIEWS[v]})" for v in names) + " "


def query(sql: str | None = None, *views: str) -> Callable:
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = (_with(*views) if views else "") + sql
        return f

    return add


def _sync(limit: int, rounds: int, view: str = "accepted") -> str:
    """The synchroniser pulse by pulse, as a recursion: first and number of the notices that each module holds, and after a
    pulse that all have a fresh start. began: what goes wrong at this pulse, if nothing did since that start."""
    ms = range(4)
    each = lambda f: ", ".join(f(m) for m in ms)
    all_ = lambda f: " and ".join(f(m) for m in ms)
    return f"""(with recursive p as (select row_number() over (order by pulse_id) as n, pulse_id as p, {each(lambda m: f"bool_or(module_id = {m}) as b{m}")} from {view} group by pulse_id),
        w as (select 0::bigint as n, {each(lambda m: f"null::bigint as f{m}, 0::bigint as s{m}")}, 0::bigint as lost, 0 as tries, null::varchar as wrong, null::varchar as began, null::bigint as pulse_id, false as met
          union all
          select n, {each(lambda m: f"case when moved and not b{m} then null when moved then p else g{m} end, case when moved then b{m}::bigint else t{m} end")},
            lost + case when moved then greatest({each(lambda m: f"t{m} - b{m}::bigint")}) else 0 end, tries + moved::int, coalesce(wrong, new), case when wrong is null then new end, p, {all_(lambda m: f"b{m}")}
          from (select *, case when moved and tries + 1 > {rounds} then 'rounds' when moved and p - oldest > {limit} then 'offset' end as new from
            (select *, {all_(lambda m: f"g{m} is not null")} and oldest < p as moved from
              (select *, least({each(lambda m: f"g{m}")}) as oldest from
                (select p.*, {each(lambda m: f"case when b{m} then coalesce(case when not met then f{m} end, p) when not met then f{m} end as g{m}, case when met then 0 else s{m} end + b{m}::bigint as t{m}")},
                   case when met then 0 else lost end as lost, case when met then 0 else tries end as tries, case when met then null else wrong end as wrong from w join p on p.n = w.n + 1)))))
        select 'JF01' as detector_name, pulse_id, lost as n_lost_pulses, wrong as violation, began, met from w)"""


def _images(spark: SparkSession, d: str) -> DataFrame:
    return im.assemble_images(fx.frames(spark, d), M, E)


def _accepted(spark: SparkSession, d: str) -> DataFrame:
    return fr.accepted(fx.frames(spark, d))


#: A range that leaves out the first twentieth of the pulses and goes beyond the last, on a step grid: of the table's own
#: pulses, so that it grows with the table.
def _range(spark: SparkSession, d: str, step: int) -> tuple[int, int]:
    low, high = fx.frames(spark, d).agg(F.coalesce(F.min("pulse_id"), F.lit(0)), F.coalesce(F.max("pulse_id"), F.lit(0))).first()
    low = low + (high - low) // 20
    return -(-low // step) * step, high // step * step + step


def _bounds(step: int, source: str = "frames") -> str:
    low = f"(select coalesce(min(pulse_id) + (max(pulse_id) - min(pulse_id)) // 20, 0) from {source})"
    high = f"(select coalesce(max(pulse_id), 0) from {source})"
    return f"({low} + {step - 1}) // {step} * {step} as low, {high} // {step} * {step} + {step} as high"


def _in_range(step: int) -> str:
    return f"pulse_id between (select low from (select {_bounds(step)})) and (select high from (select {_bounds(step)})) and pulse_id % {step} = 0"


@query(FOLD.format(frames=f"(select * from accepted where {_in_range(5)})"), "accepted")
def image_range(spark: SparkSession, d: str) -> DataFrame:
    """Flagship: the images of a pulse range at a step, from guarded frames."""
    return hi.guarded_images(fx.frames(spark, d), M, *_range(spark, d, 5), 5, E)


# --- scalar functions ------------------------------------------------------------------------------------------------


@query(
    """select seq, pulse_id // 100000 * 100000 as folder_base, pulse_id // 1000 * 1000 as file_base, pulse_id % 1000 as frame_offset,
       'root/M' || lpad(module_id::varchar, 2, '0') || '/' || (pulse_id // 100000 * 100000)::varchar || '/' || (pulse_id // 1000 * 1000)::varchar || '.bin' as path,
       'root/' || (pulse_id // 100000 * 100000)::varchar || '/' || (pulse_id // 1000 * 1000)::varchar || '.bin' as image_path,
       case when seq % 150 < 10 then 'M0' else 'M' end || (seq % 150)::varchar as name, pulse_id // 100 as block_id, pulse_id // 100 * 100 as block_start, pulse_id // 100 * 100 + 99 as block_stop from frames""",
    "frames",
)
def prj1_5_paths(spark: SparkSession, d: str) -> DataFrame:
    return fx.frames(spark, d).select(
        "seq", sc.folder_base("pulse_id").alias("folder_base"), sc.file_base("pulse_id").alias("file_base"), sc.frame_offset_in_file("pulse_id").alias("frame_offset"),
        sc.archive_path("root", "pulse_id", "module_id").alias("path"), sc.archive_path("root", "pulse_id").alias("image_path"), sc.module_name(F.col("seq") % 150).alias("name"),
        sc.block_id("pulse_id").alias("block_id"), sc.block_start("pulse_id").alias("block_start"), sc.block_stop("pulse_id").alias("block_stop"),
    )


@query("select seq, epoch_ms(pulse_id * 10) as event_time from frames", "frames")
def prj6_event_time(spark: SparkSession, d: str) -> DataFrame:
    return fx.frames(spark, d).select("seq", sc.pulse_event_time("pulse_id").cast("timestamp_ntz").alias("event_time"))


@query(
    """select c_custkey, name as detector_name, cast(substr(name, 6, 2) as int) as n_modules, c_custkey * 1000 as pulse_id from
       (select c_custkey, 'JF' || lpad((c_custkey % 20)::varchar, 2, '0') || 'T' || lpad((c_custkey % 32 + 1)::varchar, 2, '0') || 'V03' as name from customer)"""
)
def prj7_9_names(spark: SparkSession, d: str) -> DataFrame:
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    key = F.col("c_custkey")
    c = fx._table(spark, d, "customer").select("c_custkey", F.concat(F.lit("/a/b/JF"), two(key % 20), F.lit("T"), two(key % 32 + 1), F.lit("V03")).alias("path"), F.concat(F.lit("/x/M00/0/"), (key * 1000).cast("string"), F.lit(".bin")).alias("file"))
    return c.select("c_custkey", sc.detector_name("path").alias("detector_name"), sc.n_modules_from_name(sc.detector_name("path")).alias("n_modules"), sc.pulse_from_path("file").alias("pulse_id"))


@query("select seq, pulse_id, framenum as frame_index, debug as daq_rec, module_id from packets", "packets")
def prj10_frame_meta(spark: SparkSession, d: str) -> DataFrame:
    return fx.packets(spark, d).withColumn("bunchid", F.col("pulse_id") + F.lit(0.75)).select("seq", *sc.packet_to_frame_meta())


@query("select run_id, i_image, ((512 * 1024 * bits_per_pixel) // 8)::bigint as n_bytes, 'uint' || bits_per_pixel::varchar as pixel_type from runs", "runs")
def prj11_12_image_bytes(spark: SparkSession, d: str) -> DataFrame:
    return fx.runs(spark, d).select("run_id", "i_image", sc.image_n_bytes("image_y_size", "image_x_size", "bits_per_pixel").alias("n_bytes"), sc.pixel_type("bits_per_pixel").alias("pixel_type"))


@query(
    """select pulse_id, '{"frame":' || frame_index || ',"is_good_frame":' || is_good_image::int || ',"daq_rec":' || daq_rec || ',"pulse_id":' || pulse_id
       || ',"pedestal_file":"p.h5","gain_file":"g.h5","detector_name":"JF01T04V01","htype":"array-1.0","type":"uint16","shape":'
       || case when pulse_id % 10 = 0 then '[2048,1024]' else '[2,2]' end || '}' as header from images""",
    "images",
)
def prj13_14_live_header(spark: SparkSession, d: str) -> DataFrame:
    named = _images(spark, d).withColumns({"pedestal_file": F.lit("p.h5"), "gain_file": F.lit("g.h5"), "detector_name": F.lit("JF01T04V01")})
    return named.select("pulse_id", sc.live_header_json(F.col("pulse_id") % 10 == 0, M).alias("header"))


@query(
    """select run_id, i_image, (a + s - 1) // s * s as start, b // s * s as stop, 1 + (b // s * s) // s - ((a + s - 1) // s * s) // s as n_pulses from
       (select run_id, i_image, pulse_id as a, pulse_id + 100 + i_image as b, case pulse_id % 3 when 0 then 1 when 1 then 5 else 20 end as s from runs)""",
    "runs",
)
def prj15_16_ranges(spark: SparkSession, d: str) -> DataFrame:
    step = F.when(F.col("pulse_id") % 3 == 0, 1).when(F.col("pulse_id") % 3 == 1, 5).otherwise(20)
    r = fx.runs(spark, d).select("run_id", "i_image", F.col("pulse_id").alias("a"), (F.col("pulse_id") + 100 + F.col("i_image")).alias("b"), step.alias("s"))
    start, stop = sc.align_range("a", "b", "s")
    r = r.withColumns({"start": start, "stop": stop})
    return r.select("run_id", "i_image", "start", "stop", sc.n_pulses_in_range("start", "stop", "s").alias("n_pulses"))


@query(
    """select module_id, (pulse_id // 1000) as w, 'jf_frames,detector=JF01,module=M' || module_id::varchar || ' n_frames=' || count(*)::varchar || 'i,n_missed=' || sum(128 - n_recv_packets)::varchar || 'i '
       || (max(seq) * 1000)::varchar as line, (count(*) * 1000 + 250) // 10000 as rate, cast(null as bigint) as no_rate from frames group by module_id, pulse_id // 1000""",
    "frames",
)
def prj17_18_line_protocol(spark: SparkSession, d: str) -> DataFrame:
    g = fx.frames(spark, d).groupBy("module_id", sc.div("pulse_id", 1000).alias("w")).agg(F.count("*").alias("n"), F.sum(128 - F.col("n_recv_packets")).alias("missed"), F.max("seq").alias("last"))
    line = sc.line_protocol("jf_frames", {"detector": F.lit("JF01"), "module": F.concat(F.lit("M"), F.col("module_id").cast("string"))}, {"n_frames": ("n", True), "n_missed": ("missed", True)}, F.col("last") * 1000)
    return g.select("module_id", "w", line.alias("line"), sc.repetition_rate("n", 10_000).alias("rate"), sc.repetition_rate("n", 0).alias("no_rate"))


@query(
    """select module_id, frame_no::bigint as frame_no, i as pos, coalesce(arg_max(v, seq), 0)::int as value from
       (select module_id, frame_no, unnest(range(0, 16)) as i, packetnum, seq from bounded) b
       left join lateral (select case when i // 2 = packetnum then seq % 1000 + i % 2 end as v) on true group by module_id, frame_no, i""",
    "bounded",
)
def prj19_payload(spark: SparkSession, d: str) -> DataFrame:
    """Payloads of two elements a packet. Two frames of one number, the first without its last packet, are one; of a packet
    that comes twice in it the last counts."""
    packets = fr.frame_boundaries(fx.packets(spark, d), P)
    data = F.array((F.col("seq") % 1000).cast("int"), (F.col("seq") % 1000 + 1).cast("int"))
    held = packets.groupBy("module_id", "frame_no").agg(F.array_sort(F.collect_list(F.struct("seq", "packetnum", data.alias("data")))).alias("p"))
    return held.select("module_id", "frame_no", F.posexplode(px.payload_array("p", P, 2)).alias("pos", "value")).withColumn("pos", F.col("pos").cast("bigint"))


@query(
    """select p.pulse_id, m * n + i as pos, coalesce(x.pixels[i + 1], 0)::float as value from (select distinct pulse_id from payload) p
       cross join (select unnest(range(0, 4)) as m) cross join (select len(pixels) as n from payload limit 1) cross join (select unnest(range(0, (select len(pixels) from payload limit 1))) as i)
       left join payload x on x.pulse_id = p.pulse_id and x.module_id = m""",
    "payload",
)
def prj20_stack_modules(spark: SparkSession, d: str) -> DataFrame:
    p = fx.payload(spark, d)
    one = p.select(F.size("pixels")).first()
    return px.stack_modules(p, M, one[0] if one else 0).select("pulse_id", F.posexplode("image").alias("pos", "value")).select("pulse_id", F.col("pos").cast("bigint").alias("pos"), F.col("value").cast("float").alias("value"))


# --- filters ---------------------------------------------------------------------------------------------------------


@query("select seq, module_id, pulse_id from frames where n_recv_packets = 128", "frames")
def flt2_complete(spark: SparkSession, d: str) -> DataFrame:
    return fr.complete_frames(fx.frames(spark, d), E).select("seq", "module_id", "pulse_id")


@query("select seq, module_id, pulse_id from accepted", "accepted")
def flt3_sequence_ok(spark: SparkSession, d: str) -> DataFrame:
    return _accepted(spark, d).select("seq", "module_id", "pulse_id")


@query(f"select pulse_id, frame_index, is_good_image from images where {_in_range(20)}", "images")
def flt6_7_range_step(spark: SparkSession, d: str) -> DataFrame:
    return hi.images_in_range(fx.frames(spark, d), M, *_range(spark, d, 20), 20, E).select("pulse_id", "frame_index", "is_good_image")


@query("select run_id, i_image from runs where i_image % 3 = 1", "runs")
def flt8_writer_shard(spark: SparkSession, d: str) -> DataFrame:
    return fr.writer_shard(fx.runs(spark, d), 3, 1).select("run_id", "i_image")


@query("select run_id, i_image from runs where run_id = 7", "runs")
def flt9_run_guard(spark: SparkSession, d: str) -> DataFrame:
    return fr.run_id_guard(fx.runs(spark, d), 7).select("run_id", "i_image")


@query("select pulse_id, frame_index, pulse_id % 10 = 0 as has_data, case when pulse_id % 10 = 0 then daq_rec end as daq_rec from images", "images")
def flt10_thin(spark: SparkSession, d: str) -> DataFrame:
    return fr.thin(_images(spark, d), 10, ["daq_rec"]).select("pulse_id", "frame_index", "has_data", "daq_rec")


# --- joins -----------------------------------------------------------------------------------------------------------


@query("select pulse_id from aligned", "aligned")
def jn1_align(spark: SparkSession, d: str) -> DataFrame:
    return im.align_modules(_accepted(spark, d), M)


@query("select f.module_id, f.pulse_id, f.frame_index from frames f join (select module_id, pulse_id from accepted where (seq * 31 + module_id * 17) % 97 <> 0) n on f.module_id = n.module_id and f.pulse_id = n.pulse_id", "accepted")
def jn2_notices(spark: SparkSession, d: str) -> DataFrame:
    """One notice in 97 was lost on its way."""
    notices = _accepted(spark, d).where("(seq * 31 + module_id * 17) % 97 <> 0")
    return im.frames_for_notices(notices, fx.frames(spark, d)).select("module_id", "pulse_id", "frame_index")


@query("select i.pulse_id, i.is_good_image, p.module_id, cast(p.pixels[1] as double) as first_pixel from images i join payload p on i.pulse_id = p.pulse_id where i.is_good_image", "images", "payload")
def jn3_attach_pixels(spark: SparkSession, d: str) -> DataFrame:
    good = _images(spark, d).where("is_good_image")
    return im.attach_pixels(good, fx.payload(spark, d)).select("pulse_id", "is_good_image", "module_id", F.col("pixels")[0].cast("double").alias("first_pixel"))


@query("select p.pulse_id, m::int as module_id, f.n_recv_packets from (select distinct pulse_id from frames) p cross join (select unnest(range(0, 4)) as m) left join frames f on f.pulse_id = p.pulse_id and f.module_id = m", "frames")
def jn4_spine(spark: SparkSession, d: str) -> DataFrame:
    frames = fx.frames(spark, d)
    return im.module_spine(frames.select("pulse_id").distinct(), M).join(frames.select("pulse_id", "module_id", "n_recv_packets"), ["pulse_id", "module_id"], "left")


@query("select pulse_id, 'JF' || (pulse_id % 25)::varchar as detector_name, n_name as pedestal_file from images join nation on n_nationkey = pulse_id % 25", "images")
def jn5_detector(spark: SparkSession, d: str) -> DataFrame:
    detectors = fx._table(spark, d, "nation").select(F.concat(F.lit("JF"), F.col("n_nationkey").cast("string")).alias("detector_name"), F.col("n_name").alias("pedestal_file"))
    images = _images(spark, d).withColumn("detector_name", F.concat(F.lit("JF"), (F.col("pulse_id") % 25).cast("string")))
    return im.with_detector(images, detectors).select("pulse_id", "detector_name", "pedestal_file")


@query(
    """select e.pulse_id, f.field, f.expected, f.got from export e left join images i on e.pulse_id = i.pulse_id,
       lateral (values ('frame_index', i.frame_index::varchar, e.frame_index::varchar), ('daq_rec', i.daq_rec::varchar, e.daq_rec::varchar), ('is_good_image', i.is_good_image::varchar, e.is_good_image::varchar)) as f(field, expected, got)
       where f.expected is distinct from f.got""",
    "export",
)
def jn6_reconcile(spark: SparkSession, d: str) -> DataFrame:
    images = _images(spark, d)
    return im.reconcile(fx.export(images), images)


@query("select run_id, i_image, i.pulse_id, i.frame_index, i.is_good_image from runs r join images i on r.pulse_id = i.pulse_id", "runs", "images")
def jn7_runs_images(spark: SparkSession, d: str) -> DataFrame:
    return ru.runs_with_images(fx.runs(spark, d), _images(spark, d)).select("run_id", "i_image", "pulse_id", "frame_index", "is_good_image")


@query("select p.pulse_id, m::int as module_id from (select distinct pulse_id from frames) p cross join (select unnest(range(0, 4)) as m) where not exists (select 1 from frames f where f.pulse_id = p.pulse_id and f.module_id = m)", "frames")
def jn8_missing(spark: SparkSession, d: str) -> DataFrame:
    frames = fx.frames(spark, d)
    return im.missing_frames(im.module_spine(frames.select("pulse_id").distinct(), M), frames)


# --- aggregations ----------------------------------------------------------------------------------------------------

_ASSEMBLED = """select module_id, frame_no::bigint as frame_no, pulse_id, frame_index, daq_rec, n_recv_packets, n_distinct_packets, seq from assembled a"""


@query(_ASSEMBLED + " where last_packet = 7 or frame_no < (select max(frame_no) from assembled b where b.module_id = a.module_id)", "assembled")
def agg1_frames(spark: SparkSession, d: str) -> DataFrame:
    got = fr.packets_to_frames(fx.packets(spark, d), P, numbered=True)
    return got.select("module_id", "frame_no", *[c for c in got.columns if c not in ("module_id", "frame_no")])


@query(_ASSEMBLED, "assembled")
def agg1_frames_open(spark: SparkSession, d: str) -> DataFrame:
    return fr.packets_to_frames(fx.packets(spark, d), P, emit_open=True, numbered=True)


@query("select * from images", "images")
def agg2_images(spark: SparkSession, d: str) -> DataFrame:
    return _images(spark, d)


@query(FOLD.format(frames="repeated"), "repeated")
def agg2_repeated(spark: SparkSession, d: str) -> DataFrame:
    """Frames that came twice, some of them in the place of a module that is missing."""
    return im.assemble_images(fx.repeated_frames(spark, d), M, E)


@query(
    """select module_id, date_trunc('day', recv_ts)::timestamp as window_start, count(*) as n_frames, sum(greatest(128 - n_recv_packets, 0))::bigint as n_missed_packets,
       count(*) filter (n_recv_packets < 128) as n_corrupted_frames, count(*) filter (bad) as n_bad_frames, (count(*) * 1000 + 250) // 86400000 as repetition_rate from flagged group by all""",
    "flagged",
)
def agg3_frame_stats(spark: SparkSession, d: str) -> DataFrame:
    flagged = fr.flag_sequence(fx.frames(spark, d))
    return st.frame_stats(flagged, "1 day", 86_400_000, E).withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


_NUMBERED = "(select i.pulse_id, is_good_image, n_lost_pulses, (row_number() over (order by i.pulse_id) - 1) // 100 as bucket from images i join lost l on i.pulse_id = l.pulse_id)"


def _synced(spark: SparkSession, d: str) -> DataFrame:
    return _images(spark, d).join(im.sync_loss(_accepted(spark, d), M), "pulse_id")


@query(f"select bucket, count(*) as n_images, count(*) filter (not is_good_image) as n_corrupted_images, sum(n_lost_pulses)::bigint as n_lost_pulses from {_NUMBERED} group by bucket having count(*) = 100", "images", "lost")
def agg4_assembler_stats(spark: SparkSession, d: str) -> DataFrame:
    return st.assembler_stats(_synced(spark, d), 100)


@query(f"select bucket, count(*) as n_images, count(*) filter (not is_good_image) as n_corrupted_images, 'live' as stream_name from {_NUMBERED} group by bucket having count(*) = 100", "images", "lost")
def agg5_stream_stats(spark: SparkSession, d: str) -> DataFrame:
    return st.stream_stats(_synced(spark, d), "live", 100)


@query(
    """select module_id, bucket, count(*) as n_writes, (sum(us) // count(*))::double as avg_write_us, max(us)::bigint as max_write_us from
       (select module_id, 100 + (seq * 37) % 900 as us, (row_number() over (partition by module_id order by pulse_id) - 1) // 100 as bucket from frames) group by all having count(*) = 100""",
    "frames",
)
def agg6_archive_writes(spark: SparkSession, d: str) -> DataFrame:
    return st.archive_write_stats(fx.frames(spark, d).withColumn("write_us", 100 + (F.col("seq") * 37) % 900), 100)


@query(
    """select run_id, count(*) as n_images, avg(write_us) as avg_write_us, max(write_us)::bigint as max_write_us, sum(512 * 1024 * bits_per_pixel // 8)::bigint as n_bytes,
       sum(512 * 1024 * bits_per_pixel // 8) / count(*) / 1048576.0 / (avg(write_us) / 1e6) as mib_per_s from runs group by run_id""",
    "runs",
)
def agg7_run_writes(spark: SparkSession, d: str) -> DataFrame:
    return st.run_write_stats(fx.runs(spark, d))


@query("select pulse_id, n_lost_pulses from lost", "lost")
def agg8_sync_loss(spark: SparkSession, d: str) -> DataFrame:
    return im.sync_loss(_accepted(spark, d), M)


@query(f"select detector_name, pulse_id, n_lost_pulses, violation from {_sync(100, 3)} where met", "accepted")
def agg8_sync_exact(spark: SparkSession, d: str) -> DataFrame:
    return sy.sync_pulses(_accepted(spark, d).withColumn("detector_name", F.lit("JF01")), M)


@query(f"select detector_name, pulse_id, began as violation from {_sync(1, 1)} where began is not null", "accepted")
def agg9_sync_violations(spark: SparkSession, d: str) -> DataFrame:
    return sy.sync_violations(_accepted(spark, d).withColumn("detector_name", F.lit("JF01")), M, limit=1, rounds=1)


@query(f"select detector_name, pulse_id, began as violation from {_sync(100, 3, 'drifted')} where began is not null", "drifted")
def agg9_open_tail(spark: SparkSession, d: str) -> DataFrame:
    """A module whose counter jumps ahead for good: the modules never align again."""
    return sy.sync_violations(fx.drifted(_accepted(spark, d)).withColumn("detector_name", F.lit("JF01")), M)


@query("select run_id, i_image // 4 as bucket, count(*) as n_writes, avg(write_us) as avg_write_us, min(write_us)::bigint as min_write_us, max(write_us)::bigint as max_write_us from runs group by all", "runs")
def agg10_write_latency(spark: SparkSession, d: str) -> DataFrame:
    return st.write_latency_summary(fx.runs(spark, d), 4)


@query(
    """select run_id, count(*) as n_received, max(n_images)::bigint as n_expected, min(r.pulse_id) as first_pulse, max(r.pulse_id) as last_pulse, count(*) filter (not is_good_image) as n_bad,
       max(i_image) + 1 = max(n_images) as is_complete from runs r join images i on r.pulse_id = i.pulse_id group by run_id""",
    "runs", "images",
)
def agg11_run_summary(spark: SparkSession, d: str) -> DataFrame:
    return st.run_summary(ru.runs_with_images(fx.runs(spark, d), _images(spark, d)))


# --- windows, sorts, sinks -------------------------------------------------------------------------------------------


@query("select seq, module_id, bad from flagged", "flagged")
def win1_flag_sequence(spark: SparkSession, d: str) -> DataFrame:
    return fr.flag_sequence(fx.frames(spark, d)).select("seq", "module_id", "bad")


@query("select seq, module_id, frame_no::bigint as frame_no from bounded", "bounded")
def win2_boundaries(spark: SparkSession, d: str) -> DataFrame:
    return fr.frame_boundaries(fx.packets(spark, d), P).select("seq", "module_id", "frame_no")


@query("select pulse_id, row_number() over (order by pulse_id) - 1 as i_image from images where is_good_image", "images")
def win3_image_index(spark: SparkSession, d: str) -> DataFrame:
    return st.image_index(_images(spark, d).where("is_good_image")).select("pulse_id", "i_image")


@query("select * from (select pulse_id, b as bucket from (select pulse_id, (row_number() over (order by pulse_id) - 1) // 100 as b, count(*) over () as n from images)  where (b + 1) * 100 <= n)", "images")
def win4_count_buckets(spark: SparkSession, d: str) -> DataFrame:
    return st.count_buckets(_images(spark, d), 100).select("pulse_id", "bucket")


@query("select module_id, pulse_id, seq from (select *, max(pulse_id) over (partition by module_id) as newest from frames) where pulse_id > newest - 1000", "frames")
def win5_recent(spark: SparkSession, d: str) -> DataFrame:
    return fr.recent_frames(fx.frames(spark, d)).select("module_id", "pulse_id", "seq")


@query("select module_id, p as pulse_id, seq, frame_index from (select *, pulse_id // 3 as p, row_number() over (partition by module_id, pulse_id // 3 order by seq desc) as r from frames) where r = 1", "frames")
def win6_latest(spark: SparkSession, d: str) -> DataFrame:
    """Pulses are written over in threes."""
    again = fx.frames(spark, d).withColumn("pulse_id", sc.div("pulse_id", 3))
    return fr.latest_per_key(again).select("module_id", "pulse_id", "seq", "frame_index")


@query("select pulse_id, frame_index, daq_rec, is_good_image, n_good_modules from images order by pulse_id", "images")
def srt1_ordered(spark: SparkSession, d: str) -> DataFrame:
    return hi.ordered(_images(spark, d))


@query("select max(pulse_id) as newest from frames", "frames")
def srt2_newest(spark: SparkSession, d: str) -> DataFrame:
    return hi.newest(fx.frames(spark, d))


@query(
    f"""select p as requested_pulse_id, coalesce(pulse_id, 0) as pulse_id, coalesce(frame_index, 0) as frame_index, coalesce(daq_rec, 0) as daq_rec, coalesce(is_good_image::int, 0) as is_good_frame, (p - low) // 4 as write_index
       from (select unnest(range(low, high + 1, 4)) as p, low from (select {_bounds(4)})) left join images on p = pulse_id""",
    "images",
)
def snk3_export_range(spark: SparkSession, d: str) -> DataFrame:
    """A range that goes on beyond the last pulse."""
    return hi.export_rows(fx.frames(spark, d), M, *_range(spark, d, 4), 4, E)


@query(
    """select run_id, i_image, pulse_id, 'uint' || bits_per_pixel::varchar as pixel_type, ((512 * 1024 * bits_per_pixel) // 8)::bigint as image_bytes from runs""",
    "runs",
)
def snk4_run_rows(spark: SparkSession, d: str) -> DataFrame:
    return ru.run_rows(fx.runs(spark, d)).select("run_id", "i_image", "pulse_id", "pixel_type", "image_bytes")
