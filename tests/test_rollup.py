"""Roll-ups equal the reducers over points; views stay current over upserts and read only their range."""

import random
import re
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from scarp.operators import rollup as ru
from scarp.operators import series as se
from scarp.streaming import views as vw
from scarp.streaming.sink import read_latest

T0 = datetime(2024, 1, 1)
LONG = "time timestamp_ntz, cluster_id string, field string, value double"


def as_rows(df):
    return sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=lambda r: [(x is None, str(type(x)), x if x is not None else 0) for x in r])


def by_series(df):
    """Rows in the order of their series, so that rounding of values cannot change it."""
    return [tuple(r[c] for c in sorted(df.columns)) for r in df.orderBy("cluster_id", "field").collect()]


def close(a, b):
    return len(a) == len(b) and all(x == y or (isinstance(x, float) and isinstance(y, float) and abs(x - y) < 1e-9)
                                    for r, s in zip(a, b) for x, y in zip(r, s))


def test_panels_from_states_equal_panels_from_points(spark):
    rnd = random.Random(3)
    rows = []
    for series in range(40):
        at = 0
        for _ in range(rnd.choice([1, 1, 2, 3, 7, 60])):
            at += rnd.choice([1, 1, 2, 5, 9, 40, 400, 90_000])
            rows.append((T0 + timedelta(seconds=at), f"c{series}", "f", rnd.choice([None, *[float(rnd.randrange(0, 5)) for _ in range(5)]])))
    long = spark.createDataFrame(rows, LONG)
    want = by_series(se.panel_stats(long, exact=True))
    for levels in (("10 seconds",), ("10 seconds", "5 minutes"), ru.LEVELS, ("1 day",)):
        assert close(by_series(ru.panel_of(ru.rolled(long, *levels))), want), levels


def test_window_means_from_states(spark):
    rnd = random.Random(4)
    rows = [(T0 + timedelta(seconds=s), "c", f, rnd.choice([None, round(rnd.uniform(-9, 9), 4)])) for s in range(300) for f in "ab"]
    long = spark.createDataFrame(rows, LONG)
    for every, levels in (("10 seconds", ("10 seconds",)), ("5 minutes", ("10 seconds", "5 minutes"))):
        got = as_rows(ru.window_means(ru.rolled(long, *levels), every))
        assert got == as_rows(se.aggregate_window(long.where("value IS NOT NULL"), every, fn="exact_mean").select("time", "cluster_id", "field", "value"))


def alerts(spark, rows):
    full = [((t, t + timedelta(seconds=1)), c, inv, v, None, rain, None, None, None, level) for t, c, inv, v, rain, level in rows]
    return spark.createDataFrame(full, "window struct<start:timestamp,end:timestamp>, cluster_id string, inv_velocity double, avg_velocity double, "
                                       "max_vibration double, rain_intensity double, pore_pressure double, last_gnss_x double, last_gnss_y double, alert_level int")


def test_views_follow_upserts(spark, tmpdir_local):
    rnd = random.Random(6)
    points, views = f"{tmpdir_local}/p", f"{tmpdir_local}/v"
    job = vw.ViewsWriter(points, views)
    for batch in range(6):
        # each batch brings new seconds and newer versions of old ones, over two days
        seconds = [batch * 40 + k for k in range(40)] + [rnd.randrange(0, batch * 40 + 1) for _ in range(5)]
        rows = [(T0 + timedelta(hours=23, minutes=58, seconds=s), c, rnd.uniform(1, 9), None, float(rnd.randrange(3)), rnd.randrange(1, 4))
                for s in set(seconds) for c in ("c1", "c2") if rnd.random() < 0.8]
        job(alerts(spark, rows), batch)
        if batch == 3:
            job(alerts(spark, rows), batch)                        # a replayed batch
    latest = read_latest(spark, points)
    long = se.points_long(latest.drop("date"), keep_nulls=True)
    want = by_series(se.panel_stats(long, exact=True))
    for every in vw.LEVELS:
        assert close(by_series(ru.panel_of(vw.read_rollup(spark, views, every))), want)
    newest = {r.cluster_id: (r.time, r.alert_level) for r in vw.read_newest(spark, views).collect()}
    for c, (t, level) in newest.items():
        best = latest.where(F.col("cluster_id") == c).orderBy(F.desc("time")).first()
        assert (t, level) == (best.time, best.alert_level)
    assert {r.cluster_id for r in vw.read_tags(spark, views).collect()} == {"c1", "c2"}


def test_views_read_no_points_and_only_their_days(spark, tmpdir_local):
    points, views = f"{tmpdir_local}/p", f"{tmpdir_local}/v"
    job = vw.ViewsWriter(points, views)
    for day in range(3):
        job(alerts(spark, [(T0 + timedelta(days=day), f"c{day}", 5.0, 0.2, None, 1)]), day)
    recent = vw.read_newest(spark, views, "1 day")
    assert {r.cluster_id for r in recent.collect()} == {"c1", "c2"}
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert any("date" in f for f in re.findall(r"PartitionFilters: \[[^\]]*\]", plan))
    panel = ru.panel_of(vw.read_rollup(spark, views, "5 minutes"))
    read = {f.split(tmpdir_local)[1].split("/")[1] for f in panel.inputFiles()}
    assert read == {"v"} and all("/rollup_5_minutes/" in f for f in panel.inputFiles())
