"""Images from module frames: fold, alignment, spines, losses in their set form,
reconciliation (AGG-2, AGG-8, JN-1 .. JN-8); for the exact form see sync.py."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import PACKETS


def slots(frames: DataFrame, n_modules: int, keys: tuple[str, ...]) -> DataFrame:
    """(keys, _m0, _m1, ...): the slot of each of the modules 0 .. n_modules-1, null if it has sent nothing. Of several
    frames of a module the last written (seq, where there is one) counts, whatever the order they come in."""
    order = F.struct(*[F.col(c) for c in ("seq",) if c in frames.columns], "n_recv_packets", "frame_index", "daq_rec")
    slot = F.when(F.col("module_id").between(0, n_modules - 1), F.col("module_id"))
    return frames.groupBy(*keys).agg(*[F.max(F.when(slot == m, order)).alias(f"_m{m}") for m in range(n_modules)])


def fold(slotted: DataFrame, n_modules: int, keys: tuple[str, ...], expected: int = PACKETS[1], check_daq_rec: bool = True, trust_source: bool = False) -> DataFrame:
    """Images from slots, see assemble_images()."""
    ok = [F.coalesce(F.col(f"_m{m}.n_recv_packets") == expected, F.lit(False)) for m in range(n_modules)]
    # null where a module is not complete
    index, rec = ([F.when(o, F.col(f"_m{m}.{c}")) for m, o in enumerate(ok)] for c in ("frame_index", "daq_rec"))
    same = lambda xs: F.array_min(F.array(*xs)) == F.array_max(F.array(*xs))
    agreed = same(index) & same(rec) if check_daq_rec else same(index)
    zero = F.lit(0).cast("bigint")
    good = sum((o.cast("bigint") for o in ok[1:]), ok[0].cast("bigint"))
    return slotted.select(
        *keys,
        F.coalesce(*index, zero).cast("bigint").alias("frame_index"),
        F.coalesce(*rec, zero).cast("bigint").alias("daq_rec"),
        (F.lit(True) if trust_source else F.coalesce((good == n_modules) & agreed, F.lit(False))).alias("is_good_image"),
        good.alias("n_good_modules"),
    )


def assemble_images(frames: DataFrame, n_modules: int, expected: int = PACKETS[1], check_daq_rec: bool = True, keys: tuple[str, ...] = ("pulse_id",), trust_source: bool = False) -> DataFrame:
    """(keys, frame_index, daq_rec, is_good_image, n_good_modules): frames folded by pulse. A module has one slot: of
    several frames the last written (seq, where there is one) counts. Metadata is that of the lowest complete module, zeros
    without one; an image is good if all of the modules 0 .. n_modules-1 are complete and agree. trust_source takes every
    image for good, as the second dialect's receiver does.

    Slots are filled before the shuffle as far as one task sees a pulse, and images are folded from at most n_modules slots
    on the same partitioning: one shuffle."""
    return fold(slots(frames, n_modules, keys), n_modules, keys, expected, check_daq_rec, trust_source)


def align_modules(frames: DataFrame, n_modules: int, keys: tuple[str, ...] = ("pulse_id",)) -> DataFrame:
    """The pulses that all modules have. One row for each module first, so the count needs no expansion."""
    return frames.select(*keys, "module_id").distinct().groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") == n_modules).drop("_n")


def frames_for_notices(notices: DataFrame, frames: DataFrame, strict: bool = False) -> DataFrame:
    """The frames that notices of (module_id, pulse_id) point at; a slot written again since then has another pulse and
    is skipped, or in strict mode an error."""
    keys = ["module_id", "pulse_id"]
    if not strict:
        return notices.select(*keys).join(frames, keys)
    met = notices.select(*keys).join(frames.withColumn("_there", F.lit(True)), keys, "left")
    said = F.concat(F.lit("no frame for the notice of pulse "), F.col("pulse_id").cast("string"))
    return met.withColumn("pulse_id", F.when(F.col("_there"), F.col("pulse_id")).otherwise(F.raise_error(said).cast("bigint"))).drop("_there")


def attach_pixels(images: DataFrame, payload: DataFrame, how: str = "inner") -> DataFrame:
    """Payloads join last, after all filters on metadata."""
    return images.join(payload, "pulse_id", how)


def module_spine(pulses: DataFrame, n_modules: int) -> DataFrame:
    """(pulse_id, module_id) for every module of every pulse: an explode, not a join."""
    return pulses.select("pulse_id", F.explode(F.sequence(F.lit(0), F.lit(n_modules - 1))).alias("module_id"))


def with_detector(df: DataFrame, detectors: DataFrame, most: int = 10_000) -> DataFrame:
    """df with its detector's configuration; the table is broadcast while it is as small as it should be."""
    small = detectors.limit(most + 1).count() <= most
    return df.join(F.broadcast(detectors) if small else detectors, "detector_name")


def missing_frames(spine: DataFrame, archive: DataFrame) -> DataFrame:
    return spine.join(archive, ["pulse_id", "module_id"], "left_anti")


def reconcile(export: DataFrame, rebuilt: DataFrame, fields: tuple[str, ...] = ("frame_index", "daq_rec", "is_good_image"), payload: str | None = None) -> DataFrame:
    """(pulse_id, field, expected, got): one row for each field of an exported image that is not what the archive gives;
    a pulse that the archive lacks differs in all fields. Payloads compare by SHA-256."""
    names = [*fields, *([payload] if payload else [])]

    def said(side: str, name: str):  # noqa: ANN202
        c = F.col(f"{side}.{name}")
        return F.sha2(c, 256) if name == payload else c.cast("string")

    both = export.alias("e").join(rebuilt.alias("r"), F.col("e.pulse_id") == F.col("r.pulse_id"), "left")
    rows = F.array(*[F.struct(F.lit(n).alias("field"), said("r", n).alias("expected"), said("e", n).alias("got")) for n in names])
    return both.select(F.col("e.pulse_id").alias("pulse_id"), F.explode(rows).alias("d")).where(~F.col("d.expected").eqNullSafe(F.col("d.got"))).select("pulse_id", "d.*")


def sync_loss(frames: DataFrame, n_modules: int, share: int = 1000) -> DataFrame:
    """(pulse_id, n_lost_pulses), set form: for each pulse that all modules have, the most pulses that one module has
    strictly between it and the aligned pulse before. Equal to the exact form where one round brings all together.

    One aggregation gives each pulse's modules. The aligned pulse at or after it is found by a backward fill over shares of
    the pulse axis: inside a share by a window, across shares from a table with one row for each share."""
    has = [F.bool_or(F.col("module_id") == m) for m in range(n_modules)]
    each = frames.where(F.col("module_id").between(0, n_modules - 1)).groupBy("pulse_id").agg(*[h.alias(f"_h{m}") for m, h in enumerate(has)])
    names = [f"_h{m}" for m in range(n_modules)]
    full = F.col(names[0])
    for h in names[1:]:
        full = full & F.col(h)
    marked = each.select("pulse_id", *names, F.floor(F.col("pulse_id") / share).alias("_share"), F.when(full, F.col("pulse_id")).alias("_sync"))
    firsts = marked.groupBy("_share").agg(F.min("_sync").alias("_first"))
    after = Window.orderBy("_share").rowsBetween(1, Window.unboundedFollowing)
    firsts = firsts.select("_share", F.min("_first").over(after).alias("_after"))
    inside = Window.partitionBy("_share").orderBy(F.desc("pulse_id")).rowsBetween(Window.unboundedPreceding, 0)
    goal = marked.withColumn("_in", F.min("_sync").over(inside)).join(firsts, "_share").withColumn("_goal", F.coalesce("_in", "_after"))
    before = goal.where("_goal is not null").groupBy(F.col("_goal").alias("pulse_id")).agg(*[F.count_if(F.col(h) & (F.col("pulse_id") < F.col("_goal"))).alias(h) for h in names])
    return before.select("pulse_id", F.array_max(F.array(*names)).alias("n_lost_pulses"))
