"""Packets and module frames: filters, sequence guard, packet sessions, upserts (FLT, WIN-1, WIN-2, WIN-5, WIN-6, AGG-1)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import DATAGRAM_BYTES, MARKER, MAX_PULSE_GAP, PACKETS, RING_PULSES
from .ordering import row_before, running_index, running_sum


def valid_datagram(df: DataFrame, raw_col: str = "raw", size: int = DATAGRAM_BYTES) -> DataFrame:
    return df.where(F.length(raw_col) == size)


def complete(expected: int = PACKETS[1]) -> Column:
    """Equality: a duplicate packet makes a frame incomplete too."""
    return F.col("n_recv_packets") == expected


def complete_frames(frames: DataFrame, expected: int = PACKETS[1]) -> DataFrame:
    return frames.where(complete(expected))


def present(df: DataFrame, marker_col: str = "marker") -> DataFrame:
    return df.where(F.col(marker_col) == MARKER)


def pulse_range(df: DataFrame, start: int, stop: int) -> DataFrame:
    """Both ends are included."""
    return df.where(F.col("pulse_id").between(start, stop))


def pulse_step(df: DataFrame, step: int) -> DataFrame:
    return df.where(F.col("pulse_id") % step == 0)


def writer_shard(df: DataFrame, n_writers: int, i_writer: int | None = None) -> DataFrame:
    """The rows of one writer, or all, dealt to n_writers partitions by image index."""
    shard = F.pmod("i_image", F.lit(n_writers))
    return df.repartition(n_writers, shard) if i_writer is None else df.where(shard == i_writer)


def run_id_guard(df: DataFrame, run_id: int, strict: bool = False) -> DataFrame:
    """Rows of the current run; in strict mode a row of another run is an error."""
    if not strict:
        return df.where(F.col("run_id") == run_id)
    said = F.concat(F.lit("row of another run: "), F.col("run_id").cast("string"))
    return df.withColumn("run_id", F.when(F.col("run_id") == run_id, F.col("run_id")).otherwise(F.raise_error(said).cast("bigint")))


def thin(df: DataFrame, factor: int, data_cols: list[str], seed: int | None = None, flag: str = "has_data") -> DataFrame:
    """Metadata stays for all rows; data stays for one in `factor`: those on the pulse grid, or with a seed a random share of
    the pulses. Which pulses these are is told by a hash of pulse and seed, so a replay, or another partitioning, keeps the
    same ones, and all modules of a pulse go the same way."""
    if factor <= 1:
        kept = F.lit(True)
    elif seed is None:
        kept = F.pmod("pulse_id", F.lit(factor)) == 0
    else:
        digest = F.md5(F.concat_ws(":", F.col("pulse_id").cast("string"), F.lit(str(seed))))
        kept = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % factor == 0
    df = df.withColumn(flag, kept)
    return df.withColumns({c: F.when(F.col(flag), F.col(c)) for c in data_cols})


#: Rows of a module's arrival order that one task puts in order, about.
SHARE_ROWS = 200_000


def _share(rows: int = SHARE_ROWS) -> Column:
    return F.floor(F.col("seq") / rows)


def flag_sequence(frames: DataFrame, max_gap: int = MAX_PULSE_GAP, allow_repeat: bool = False, keys: tuple[str, ...] = ("module_id",), share: int = SHARE_ROWS) -> DataFrame:
    """frames with `bad`: the frame index does not follow the one before, or the pulse goes back or jumps by more than
    max_gap; a repeated pulse is bad unless allowed. What goes before the first frame is 0, and a bad frame counts as the
    one before like any other. Arrival order is cut into shares, so a module is no task of its own."""
    df = row_before(frames, ["frame_index", "pulse_id"], "_before", _share(share), keys=list(keys))
    index, pulse = F.coalesce("_before.frame_index", F.lit(0)), F.coalesce("_before.pulse_id", F.lit(0))
    step = F.col("pulse_id") - pulse
    low = step < 0 if allow_repeat else step <= 0
    bad = (F.col("frame_index") != index + 1) | low | (step > max_gap)
    return df.withColumn("bad", bad).select(*frames.columns, "bad")


def accepted(frames: DataFrame, **guard: object) -> DataFrame:
    """Only these are archived and announced."""
    return flag_sequence(frames, **guard).where(~F.col("bad")).drop("bad")


def accepted_in_range(frames: DataFrame, start: int, stop: int, max_gap: int = MAX_PULSE_GAP, **guard: object) -> DataFrame:
    """accepted(frames) between two pulses, without reading the whole table. The row before an accepted frame is at most
    max_gap pulses older, so it arrived no earlier than the first frame of the range widened by that; whatever arrived from
    there to the range's last frame is looked at, of any pulse, and nothing else. Its two ends come from a scan that the
    pulse range prunes."""
    low = start - max_gap
    ends = frames.where(F.col("pulse_id").between(low, stop)).agg(F.min("seq"), F.max("seq")).first()
    part = frames.where(F.col("seq") <= F.lit(ends[1]).cast("bigint"))
    if low > 0:  # else the frame that starts the count may be in it
        part = part.where(F.col("seq") >= F.lit(ends[0]).cast("bigint"))
    return pulse_range(accepted(part, max_gap=max_gap, **guard), start, stop)


def frame_boundaries(packets: DataFrame, expected: int = PACKETS[1], keys: tuple[str, ...] = ("module_id",), share: int = SHARE_ROWS) -> DataFrame:
    """packets with frame_no: a frame starts where framenum changes or after a frame's last packet. Arrival order is cut
    into shares, as in flag_sequence."""
    df = row_before(packets, ["framenum", "packetnum"], "_before", _share(share), keys=list(keys))
    num, last = F.col("_before.framenum"), F.col("_before.packetnum")
    new = num.isNull() | (num != F.col("framenum")) | (last == expected - 1)
    df = df.withColumn("_new", F.coalesce(new, F.lit(True)).cast("bigint"))
    return running_sum(df, "_new", "frame_no", keys=list(keys)).select(*packets.columns, "frame_no")


def split_modules(packets: DataFrame, per_module: int = PACKETS[1]) -> DataFrame:
    """The second dialect's packets as those of its modules: packet numbers run on over the modules."""
    n = F.col("packetnum")
    return packets.withColumns({"module_id": F.floor(n / per_module).cast("int"), "packetnum": n % per_module})


def packets_to_frames(packets: DataFrame, expected: int = PACKETS[1], dialect: int = 1, emit_open: bool = False, keys: tuple[str, ...] = ("module_id",), share: int = SHARE_ROWS, numbered: bool = False) -> DataFrame:
    """(keys, pulse_id, frame_index, daq_rec, n_recv_packets, n_distinct_packets, seq): packets with pulse_id, framenum,
    debug, packetnum and seq, put together frame by frame. Metadata is that of the first packet seen, in the second dialect
    of the last. A frame that nothing closes is given only with emit_open; pulse 0 means no frame. seq is the arrival of its
    first packet; with numbered there is frame_no, its number in the module's arrival order from 1, too.

    Packets are shuffled once, by share of the arrival order, and put together there. A share's first and last frame, one row
    for each share, tell which frames go on over its ends, and which is a module's open one."""
    found = packets.where((F.col("packetnum") >= 0) & (F.col("packetnum") < expected))
    by = [*keys, "_share"]
    inside = Window.partitionBy(*by).orderBy("seq")
    df = found.select(*by[:-1], _share(share).alias("_share"), "seq", "pulse_id", "framenum", "debug", "packetnum")
    df = df.withColumn("_before", F.lag(F.struct("framenum", "packetnum")).over(inside))
    new = F.col("_before").isNotNull() & ((F.col("_before.framenum") != F.col("framenum")) | (F.col("_before.packetnum") == expected - 1))
    df = df.withColumn("_part", F.sum(new.cast("int")).over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    # packet numbers that a frame has, 62 to a word
    words = [f"_w{i}" for i in range(-(-expected // 62))]
    pick = F.min_by if dialect == 1 else F.max_by
    bits = [F.bit_or(F.when(F.floor(F.col("packetnum") / 62) == i, F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("packetnum") % 62).cast("int"))).otherwise(F.lit(0).cast("bigint"))).alias(w) for i, w in enumerate(words)]
    # numbers only, which are aggregated without a sort
    parts = df.groupBy(*by, "_part").agg(
        F.count("*").alias("_n"),
        F.min("seq").alias("_first"),
        F.max("seq").alias("_last"),
        F.min_by("framenum", "seq").alias("_first_num"),
        F.max_by("framenum", "seq").alias("_last_num"),
        F.max_by("packetnum", "seq").alias("_last_packet"),
        *[pick(c, "seq").alias(c) for c in ("pulse_id", "framenum", "debug")],
        *bits,
    )
    edge = F.struct("_part", "_first", "_first_num", "_last_num", "_last_packet")
    ends = parts.groupBy(*by).agg(F.min_by(edge, "_part").alias("_a"), F.max_by(edge, "_part").alias("_z"))
    along = Window.partitionBy(*keys).orderBy("_share")
    before = F.lag("_z").over(along)
    ends = ends.withColumn("_on", F.coalesce((before["_last_num"] == F.col("_a._first_num")) & (before["_last_packet"] != expected - 1), F.lit(False)))
    # where the frame that a share ends with begins
    root = F.last(F.when(~F.col("_on") | (F.col("_z._part") > 0), F.col("_z._first")), ignorenulls=True).over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ends = ends.withColumns({"_root": root, "_open": F.lead("_share").over(along).isNull()})
    ends = ends.withColumn("_root_before", F.lag("_root").over(along))
    first = F.struct(F.col("_a._part").alias("_part"), F.when(F.col("_on"), F.col("_root_before")).otherwise(F.col("_a._first")).alias("_root"), ((F.col("_z._part") == 0) & F.col("_open")).alias("_open"))
    last = F.struct(F.col("_z._part").alias("_part"), "_root", "_open")
    edges = ends.select(*by, F.explode(F.when(F.col("_z._part") > 0, F.array(first, last)).otherwise(F.array(first))).alias("_e")).select(*by, "_e.*")
    each = parts.join(edges, [*by, "_part"], "left").withColumn("_root", F.coalesce("_root", "_first"))
    by_arrival = "_first" if dialect == 1 else "_last"
    frames = each.groupBy(*keys, "_root").agg(
        *[pick(c, by_arrival).alias(c) for c in ("pulse_id", "framenum", "debug")],
        F.sum("_n").alias("n_recv_packets"),
        F.max_by("_last_packet", "_last").alias("_last_packet"),
        F.bool_or(F.coalesce("_open", F.lit(False))).alias("_open"),
        *[F.bit_or(w).alias(w) for w in words],
    )
    distinct = F.bit_count(words[0])
    for w in words[1:]:
        distinct = distinct + F.bit_count(w)
    out = frames.select(*keys, "pulse_id", F.col("framenum").alias("frame_index"), F.col("debug").alias("daq_rec"), "n_recv_packets", distinct.cast("bigint").alias("n_distinct_packets"), F.col("_root").alias("seq"), "_open", (F.col("_last_packet") == expected - 1).alias("_whole"))
    if numbered:
        out = running_index(out, ["seq"], "frame_no", _share(share), list(keys)).withColumn("frame_no", F.col("frame_no") + 1)
    out = out.where(F.col("pulse_id") > 0)
    return (out if emit_open else out.where(F.col("_whole") | ~F.col("_open"))).drop("_open", "_whole")


def recent_frames(frames: DataFrame, n_pulses: int = RING_PULSES, keys: tuple[str, ...] = ("module_id",)) -> DataFrame:
    """What a live consumer can still see: the last n_pulses pulses of each module, the last write of each."""
    newest = frames.groupBy(*keys).agg(F.max("pulse_id").alias("_max"))
    return latest_per_key(frames.join(newest, list(keys)).where(F.col("pulse_id") > F.col("_max") - n_pulses).drop("_max"), (*keys, "pulse_id"))


def latest_per_key(frames: DataFrame, keys: tuple[str, ...] = ("module_id", "pulse_id")) -> DataFrame:
    """The last write wins. An aggregate rather than a window: it combines before the shuffle and needs no sort."""
    row = F.max_by(F.struct(*frames.columns), "seq").alias("_row")
    return frames.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(row).select("_row.*")
