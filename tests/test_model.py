"""Alert ladders and inverse velocity at their boundaries."""

from decimal import Decimal

from pyspark.sql import functions as F

from scarp.functions import model


def _eval(spark, rows, schema, *cols):
    return spark.createDataFrame(rows, schema).select(*cols).collect()


def test_inverse_velocity_floor_and_default(spark):
    rows = [(0.2,), (1e-5,), (2e-5,), (1e-6,), (None,), (0.0,)]
    out = [r[0] for r in _eval(spark, rows, "v double", model.inverse_velocity("v"))]
    assert out[0] == 5.0
    assert out[1] == 1000.0          # exactly the floor is not above it
    assert abs(out[2] - 50000.0) < 1e-6
    assert out[3] == 1000.0
    assert out[4] == 1000.0          # NULL speed -> default
    assert out[5] == 1000.0


def test_alert_level_ladder_boundaries(spark):
    rows = [
        (10.0, 0.0, 0.0),    # inv exactly 10 -> not danger
        (9.999, 0.0, 0.0),   # danger
        (100.0, 50.0, 0.0),  # rain exactly 50 -> normal
        (100.0, 50.01, 0.0),  # heavy rain
        (100.0, 0.0, 0.5),   # vibration exactly 0.5 -> normal
        (100.0, 0.0, 0.51),  # vibration
        (100.0, None, None),  # NULL comparisons fall through
        (5.0, 80.0, 0.9),    # danger wins
    ]
    got = _eval(spark, rows, "inv double, rain double, vib double",
                model.alert_level("inv", "rain", "vib").alias("l"),
                model.alert_message(model.alert_level("inv", "rain", "vib")).alias("m"),
                model.alert_text("inv", "rain").alias("t"))
    assert [r.l for r in got] == [1, 3, 1, 2, 1, 2, 1, 3]
    assert got[1].m == model.DANGER_TEXT and got[3].m == model.HIGH_RISK_TEXT and got[0].m == "NORMAL"
    assert got[3].t == model.HEAVY_RAIN_TEXT and got[5].t == "NORMAL" and got[7].t == model.DANGER_TEXT


def test_nan_speed_is_not_danger(spark):
    df = spark.createDataFrame([(float("nan"),)], "v double")
    r = df.select(model.inverse_velocity("v").alias("inv")).select(
        "inv", model.alert_level("inv", F.lit(None).cast("double"), F.lit(None).cast("double")).alias("l")).first()
    assert r.l == 1


def test_core_output_decimal_casts_do_not_fail(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00", "NORMAL", 1e12, 0.123456, float("nan"), 1.0)],
                               "t string, alert_level string, inv_velocity double, avg_velocity double, "
                               "last_gnss_x double, rain_intensity double")
    r = model.core_output(df, time_col="t").first()
    assert r.inv_velocity is None            # overflow of decimal(10,2) -> NULL, not an error
    assert r.avg_velocity == Decimal("0.12346")
    assert r.last_gnss_x is None             # NaN -> NULL


def test_scale_conf_sizes_partitions():
    from scarp.session import scale_conf
    c = scale_conf(100 * 2**40, 8000)
    assert c["spark.sql.shuffle.partitions"] == str(4 * 8000)      # bounded by the cores, not by the volume
    assert scale_conf(100 * 2**40, 8000, streaming=True)["spark.sql.shuffle.partitions"] == "8000"
    assert scale_conf(10, 8)["spark.sql.shuffle.partitions"] == "16"
