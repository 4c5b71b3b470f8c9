"""Dashboard-side value handling as columns: threshold bands, value mapping, sink defaults."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Panel thresholds (base colour, then (step, colour) ascending).
RAIN_STEPS = ("green", ((30.0, "yellow"), (50.0, "red")))
VIBRATION_STEPS = ("green", ((0.3, "yellow"), (0.5, "red")))
INVERSE_VELOCITY_STEPS = ("green", ((10.0, "red"),))
ALERT_STEPS = ("green", ((2.0, "yellow"), (3.0, "red")))
CPU_STEPS = ("green", ((70.0, "yellow"), (90.0, "red")))
MEMORY_STEPS = ("green", ((0.7, "yellow"), (0.9, "red")))
ALERT_TEXT = {1: "NORMAL", 2: "WARNING", 3: "DANGER"}
NULL_TEXT = "N/A"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def threshold_band(x, steps: tuple[str, Sequence[tuple[float, str]]], direction: str = "up") -> Column:
    """Colour band of a value; NULL stays NULL.

    ``direction="up"`` (panel default): the highest step the value reaches
    (``value >= step``) gives the colour. ``"down"``: the lowest step the value
    is below (``value < step``) gives it, e.g. inverse velocity, where small
    values are the dangerous ones.
    """
    base, levels = steps
    x = _c(x)
    out = F.lit(base)
    if direction == "up":
        for limit, colour in sorted(levels):
            out = F.when(x >= F.lit(limit), F.lit(colour)).otherwise(out)
    elif direction == "down":
        for limit, colour in sorted(levels, reverse=True):
            out = F.when(x < F.lit(limit), F.lit(colour)).otherwise(out)
    else:
        raise ValueError(f"direction must be 'up' or 'down', not {direction!r}")
    return F.when(x.isNotNull(), out)


def value_text(x, mapping: dict = ALERT_TEXT, null_text: str = NULL_TEXT) -> Column:
    """Map values to display text; unmapped values print as themselves, NULL as ``null_text``."""
    x = _c(x)
    out = x.cast("string")
    for k, text in reversed(list(mapping.items())):
        out = F.when(x == F.lit(k), F.lit(text)).otherwise(out)
    return F.when(x.isNull(), F.lit(null_text)).otherwise(out)


def tag_default(x, default: str = "unknown") -> Column:
    """Empty or missing tag -> ``default``."""
    return F.coalesce(F.nullif(_c(x), F.lit("")), F.lit(default))


def field_default(x, default: float = 0.0) -> Column:
    """Missing field -> ``default`` (NaN stays NaN, as in the reference sink)."""
    return F.coalesce(_c(x), F.lit(default))


def sink_defaults(df, tag: str = "cluster_id", fields: Sequence[str] = (), default_tag: str = "unknown",
                  default_field: float = 0.0):
    """Point defaults of the time-series sink: empty tag -> 'unknown', missing field -> 0."""
    return df.withColumns({tag: tag_default(tag, default_tag),
                           **{f: field_default(f, default_field) for f in fields}})
