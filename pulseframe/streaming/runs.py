"""Run lifecycle (ST-9, ST-9b)."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

# Op codes.
START, WRITE, STOP = 1, 0, 2


class _Run(StatefulProcessor):
    def __init__(self, mode: str, strict: bool, carried: tuple[str, ...]):
        self.mode, self.strict, self.carried = mode, strict, carried

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.run = handle.getValueState("run", "run_id bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: ANN001, N802, N803
        pdf = pd.concat(list(rows)).sort_values("seq", kind="stable")
        current = self.run.get()[0] if self.run.exists() else None
        events = []
        # runs of instructions are handled one by one: each depends on what the one before left open
        for r in pdf.itertuples(index=False):
            if self.mode == "op_code":
                current, event = self._op_code(current, r)
            else:
                current, event = self._index(current, r)
            events.append(event)
        if current is None:
            self.run.clear()
        else:
            self.run.update((current,))
        pdf["event"] = events
        yield pdf[["detector_name", "seq", "run_id", "i_image", "n_images", "pulse_id", *self.carried, "event"]]

    def _index(self, current: int | None, r) -> tuple[int | None, str]:  # noqa: ANN001
        if r.i_image == 0:
            current = r.run_id
            event = "open"
        elif current != r.run_id:
            if self.strict:
                raise ValueError(f"image of run {r.run_id} while run {current} is open")
            return current, "rejected"
        else:
            event = "write"
        if r.i_image + 1 == r.n_images:
            return None, "open+close" if event == "open" else "close"
        return current, event

    def _op_code(self, current: int | None, r) -> tuple[int | None, str]:  # noqa: ANN001
        if r.op_code == STOP:
            return None, "close" if current is not None else "reset"
        if r.op_code == START:
            return (r.run_id, "open") if current is None else (current, "ignored")
        return current, "write" if current == r.run_id and r.op_code == WRITE else "ignored"

    def close(self) -> None:
        pass


def run_lifecycle(instructions: DataFrame, mode: str = "index", strict: bool = False, carried: tuple[str, ...] = ()) -> DataFrame:
    """Instructions (detector_name, seq, run_id, i_image, n_images, pulse_id; op_code in that mode) with `event`: open,
    write, close, open+close, or rejected for an image of a run that is not open (an error in strict mode). With op_code:
    1 opens, 0 writes, 2 closes and always resets; what is out of sequence is ignored. carried: other columns that stay."""
    op = F.col("op_code").cast("int") if mode == "op_code" else F.lit(-1)
    rows = instructions.select("detector_name", *[F.col(c).cast("bigint") for c in ("seq", "run_id", "i_image", "n_images", "pulse_id")], *carried, op.alias("op_code"))
    extra = "".join(f", {c} {instructions.schema[c].dataType.simpleString()}" for c in carried)
    schema = f"detector_name string, seq bigint, run_id bigint, i_image bigint, n_images bigint, pulse_id bigint{extra}, event string"
    return rows.groupBy("detector_name").transformWithStateInPandas(_Run(mode, strict, carried), schema, "Append", "None")


def written(events: DataFrame) -> DataFrame:
    """The instructions whose images belong into their run's file."""
    return events.where(F.col("event").isin("open", "write", "close", "open+close"))
