"""Live sequence operators: rain accumulation and damped integration of readings that arrive out of order.

A recurrence needs its rows in event-time order, which a stream does not deliver. Rows are held in the state of their
series until the watermark has passed them: from then on nothing older is accepted, so their order is final. They are
then taken in (time, tie) order, the recurrence goes on from the values kept at the last of them, and every row leaves
the state exactly once (append mode). An event-time timer at the oldest held row wakes a series that gets no new rows.

State per series: the rows inside the watermark and one row of carried values, whatever the length of the history. The
rows of one series in a micro-batch meet in one task, as the recurrence demands; ``maxFilesPerTrigger`` or the offsets a
trigger takes bound them. Start the query inside ``state.rocksdb_state``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions import features as fx
from ..operators.motion import DAMPING
from ..operators.sequence import duration_us

# rows whose decay is computed in one step: 0.95 ** -256 is 5e5, far from overflow
_BLOCK = 256


def damped(x: np.ndarray, before: float, damping: float) -> np.ndarray:
    """y_n = damping * (y_(n-1) + x_n), from y = ``before``."""
    out = np.empty(len(x))
    for at in range(0, len(x), _BLOCK):
        part = x[at:at + _BLOCK]
        decay = damping ** np.arange(1, len(part) + 1)
        out[at:at + _BLOCK] = y = decay * (before + np.cumsum(part * damping / decay))
        before = y[-1]
    return out


class OrderedSeries(StatefulProcessor):
    """Holds rows ``(us, tie, values)`` until the watermark, then hands them over in order.

    Subclasses turn the ready rows and the carried values into output columns (``step``).
    """

    values: Sequence[str] = ()
    carried = 0

    def __init__(self, key: str, tie_col: str):
        self.key, self.tie_col = key, tie_col

    def init(self, handle: StatefulProcessorHandle) -> None:
        columns = "".join(f", v{k} double" for k in range(len(self.values)))
        self.handle = handle
        self.held = handle.getListState("held", "us long, tie long" + columns)
        self.timer = handle.getValueState("timer", "at long")
        self.last = handle.getValueState("last", "us long" + "".join(f", c{k} double" for k in range(self.carried)))

    def step(self, us: np.ndarray, last_us: int | None, values: np.ndarray, carry: list[float]) -> tuple[dict, list[float]]:
        raise NotImplementedError

    def _advance(self, key, rows: np.ndarray, watermark_ms: int) -> pd.DataFrame | None:
        """Emit the rows that the watermark has passed, keep the others."""
        us = rows["us"]
        ready = us <= watermark_ms * 1000
        later = rows[~ready]
        self.held.put([tuple(r.tolist()) for r in later]) if len(later) else self.held.clear()
        if len(later):
            wake = max(int(later["us"].min()) // 1000, watermark_ms + 1)
            if not self.timer.exists() or self.timer.get()[0] != wake:
                self.handle.registerTimer(wake)
                self.timer.update((wake,))
        if not ready.any():
            return None
        rows = np.sort(rows[ready], order=["us", "tie"])
        last = self.last.get() if self.last.exists() else None
        columns = np.array([rows[f"v{k}"] for k in range(len(self.values))])
        out, carry = self.step(rows["us"], None if last is None else last[0], columns, list(last[1:]) if last is not None else [0.0] * self.carried)
        self.last.update((int(rows["us"][-1]), *map(float, carry)))
        return pd.DataFrame({self.key: key[0], "us": rows["us"], self.tie_col: rows["tie"], **out})

    def _held_rows(self) -> list[tuple]:
        return [tuple(np.nan if v is None else v for v in r) for r in self.held.get()] if self.held.exists() else []

    def _records(self, rows: list[tuple]) -> np.ndarray:
        return np.array(rows, dtype=[("us", "i8"), ("tie", "i8")] + [(f"v{k}", "f8") for k in range(len(self.values))])

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        new = [self._records(self._held_rows())]
        for chunk in rows:
            part = np.zeros(len(chunk), new[0].dtype)
            part["us"] = chunk["us"]
            part["tie"] = chunk[self.tie_col]
            for k, c in enumerate(self.values):
                part[f"v{k}"] = chunk[c].astype("float64")
            new.append(part)
        out = self._advance(key, np.concatenate(new), timerValues.getCurrentWatermarkInMs())
        if out is not None:
            yield out

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        rows = self._records(self._held_rows())
        if len(rows):
            out = self._advance(key, rows, timerValues.getCurrentWatermarkInMs())
            if out is not None:
                yield out

    def close(self) -> None:
        pass


def _dt(us: np.ndarray, last_us: int | None) -> np.ndarray:
    return np.diff(us, prepend=us[0] if last_us is None else last_us) / 1e6


class RainSeries(OrderedSeries):
    values, carried = ("intensity",), 1

    def __init__(self, key: str, tie_col: str, reset_us: int | None):
        super().__init__(key, tie_col)
        self.reset_us = reset_us

    def step(self, us, last_us, values, carry):
        dt = _dt(us, last_us)
        if self.reset_us:
            period = us // self.reset_us
            new = np.diff(period, prepend=period[0] if last_us is None else last_us // self.reset_us) != 0
            dt = np.where(new, 0.0, dt)
        else:
            new = np.zeros(len(us), bool)
        total = np.nan_to_num(values[0] / 3600.0 * dt)
        starts = np.flatnonzero(np.append(True, new[1:]))
        parts = np.split(total, starts[1:])
        first = 0.0 if new[0] else carry[0]
        sums = np.concatenate([np.cumsum(p) + (first if k == 0 else 0.0) for k, p in enumerate(parts)])
        return {"dt": dt, "accumulated": sums}, [sums[-1]]


class MotionSeries(OrderedSeries):
    values, carried = ("acc_x", "acc_y", "acc_z"), 6

    def __init__(self, key: str, tie_col: str, damping: float, base: Sequence[float]):
        super().__init__(key, tie_col)
        self.damping, self.base = damping, tuple(base)

    def step(self, us, last_us, values, carry):
        dt = _dt(us, last_us)
        out, after = {"dt": dt}, [0.0] * 6
        for k, axis in enumerate("xyz"):
            v = damped(np.nan_to_num((values[k] - self.base[k]) * dt), carry[k], self.damping)
            d = carry[3 + k] + np.cumsum(v * dt)
            out[f"vel_{axis}"], out[f"disp_{axis}"] = v, d
            after[k], after[3 + k] = v[-1], d[-1]
        return {c: out[c] for c in ("dt", "vel_x", "vel_y", "vel_z", "disp_x", "disp_y", "disp_z")}, after


def _series(df: DataFrame, processor: OrderedSeries, out: str, watermark: str, time_col: str) -> DataFrame:
    key, tie_col = processor.key, processor.tie_col
    kind = df.schema[key].dataType.simpleString()
    # times travel as microseconds: pandas would hand them over as wall-clock times of the session's zone
    rows = (df.withWatermark(time_col, watermark).where(F.col(time_col).isNotNull())
            .select(key, time_col, F.unix_micros(time_col).alias("us"), F.coalesce(F.col(tie_col).cast("long"), F.lit(0)).alias(tie_col), *processor.values))
    done = rows.groupBy(key).transformWithStateInPandas(processor, f"`{key}` {kind}, us long, `{tie_col}` long, {out}", "append", "eventTime")
    return done.select(key, F.timestamp_micros("us").alias(time_col), *[c for c in done.columns if c not in (key, "us")])


def rain_accumulation_stream(df: DataFrame, key: str = "sensor_id", reset: str | None = None, watermark: str = "10 seconds",
                             time_col: str = "event_time", tie_col: str = "msg_id") -> DataFrame:
    """Running rainfall in mm per sensor, row by row as the watermark passes: the batch ``rain_accumulation`` of the same rows.

    ``reset`` (e.g. '60 seconds') restarts the total, and the first dt, every period of event time. A missing intensity
    adds nothing.
    """
    return _series(df, RainSeries(key, tie_col, duration_us(reset) if reset else None), "dt double, accumulated double", watermark, time_col)


def integrate_damped_stream(df: DataFrame, key: str = "sensor_id", damping: float = DAMPING, base: Sequence[float] = fx.BASE_ACCELERATION,
                            watermark: str = "10 seconds", time_col: str = "event_time", tie_col: str = "msg_id") -> DataFrame:
    """Velocity and displacement per axis as the watermark passes: the batch ``integrate_damped`` of the same rows."""
    columns = ", ".join(f"{c} double" for c in ("dt", "vel_x", "vel_y", "vel_z", "disp_x", "disp_y", "disp_z"))
    return _series(df, MotionSeries(key, tie_col, float(damping), base), columns, watermark, time_col)
