"""Streaming forward fill: carry the last known value of a series across micro-batches.

A window function cannot see earlier micro-batches, so the last non-null
value per series and its time live in Spark's state store (``applyInPandasWithState``).
Use it on an append-mode stream (each row final once), e.g. the closed
windows of the append job read back as a stream.

``forward_fill_windows`` fills in the same query that closes the windows: rows
are taken in event-time order whatever order they come in (``ordered``).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout

from .ordered import OrderedSeries


def forward_fill_stream(df: DataFrame, keys: Sequence[str], cols: Sequence[str], time_col: str,
                        suffix: str = "_filled") -> DataFrame:
    """Add ``<c>_filled`` per series: the newest non-null value at or before the row's time.

    State holds, per column, the newest non-null value and its time. A row
    older than that time neither takes the state's value nor replaces it; it
    is filled from older rows of its own micro-batch, or stays NULL.
    """
    keys, cols = list(keys), list(cols)
    out_fields = list(df.schema.fields) + [T.StructField(f"{c}{suffix}", T.DoubleType(), True) for c in cols]
    out_schema = T.StructType(out_fields)
    state_schema = T.StructType([f for c in cols for f in (T.StructField(f"last_{c}", T.DoubleType(), True),
                                                           T.StructField(f"time_{c}", T.LongType(), True))])
    names = [f.name for f in df.schema.fields]

    def fill(key, pdfs: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        known = list(state.get) if state.exists else [None, None] * len(cols)
        chunks = [p for p in pdfs if len(p)]
        if not chunks:
            return
        pdf = pd.concat(chunks, ignore_index=True).sort_values(time_col, kind="stable", ignore_index=True)
        micros = pdf[time_col].astype("datetime64[us]").astype("int64")
        for i, c in enumerate(cols):
            value, at = known[2 * i], known[2 * i + 1]
            own = pdf[c].astype("float64")
            filled, since = own.ffill(), micros.where(own.notna()).ffill()
            if at is not None:
                # the state stands in wherever it is not older than the batch's own value
                state_wins = (micros >= at) & own.isna() & (since.isna() | (since < at))
                filled = filled.mask(state_wins, value)
            pdf[f"{c}{suffix}"] = filled
            if own.notna().any():
                last = own.last_valid_index()
                if at is None or micros[last] >= at:
                    known[2 * i], known[2 * i + 1] = float(own[last]), int(micros[last])
        state.update(tuple(known))
        yield pdf[names + [f"{c}{suffix}" for c in cols]]

    return df.groupBy(*keys).applyInPandasWithState(
        fill, out_schema, state_schema, "append", GroupStateTimeout.NoTimeout)


class FillSeries(OrderedSeries):
    """Rows in event-time order, each value replaced by the newest one so far."""

    def __init__(self, key: str, tie_col: str, cols: Sequence[str], suffix: str):
        super().__init__(key, tie_col)
        self.values, self.carried, self.suffix = tuple(cols), len(cols), suffix

    def step(self, us, last_us, values, carry):
        before = [np.nan if last_us is None or c is None else c for c in carry]
        out, after = {}, []
        for k, c in enumerate(self.values):
            own = values[k]
            at = np.maximum.accumulate(np.where(np.isnan(own), -1, np.arange(len(own))))
            filled = np.where(at >= 0, own[at], before[k])
            out[c], out[c + self.suffix] = own, filled
            after.append(filled[-1])
        return out, after


def forward_fill_windows(windows: DataFrame, key: str, cols: Sequence[str], suffix: str = "_filled") -> DataFrame:
    """``window_start, key, <c>, <c>_filled`` of closed windows (append mode, with their ``window`` column).

    A second stateful operator after the one that closes the windows: it sees them when the watermark passes, holds
    nothing longer, and carries one row of values per series. Start it inside ``state.rocksdb_state``.
    """
    cols = list(cols)
    rows = windows.select(key, F.window_time("window").alias("t"), F.unix_micros("window.start").alias("us"), F.lit(0).cast("long").alias("tie"),
                          *[F.col(c).cast("double").alias(c) for c in cols])
    kind = windows.schema[key].dataType.simpleString()
    out = ", ".join(f"`{c}` double, `{c}{suffix}` double" for c in cols)
    done = rows.groupBy(key).transformWithStateInPandas(FillSeries(key, "tie", cols, suffix), f"`{key}` {kind}, us long, tie long, {out}",
                                                        "append", "eventTime")
    # NaN stands for a missing value on the way
    return done.select(F.timestamp_micros("us").alias("window_start"), key,
                       *[F.when(~F.isnan(n), F.col(n)).alias(n) for c in cols for n in (c, f"{c}{suffix}")])
