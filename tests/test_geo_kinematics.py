"""Distances and the 12 features against values computed outside Spark."""
import math
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from trackwise.functions.geo import geodesic_m, haversine_m
from trackwise.operators.kinematics import FEATURE_COLUMNS, kinematic_features


def vincenty(lat1, lon1, lat2, lon2):
    a, f = 6378137.0, 1 / 298.257223563
    b = a * (1 - f)
    L = math.radians(lon2 - lon1)
    U1, U2 = math.atan((1 - f) * math.tan(math.radians(lat1))), math.atan((1 - f) * math.tan(math.radians(lat2)))
    sU1, cU1, sU2, cU2 = math.sin(U1), math.cos(U1), math.sin(U2), math.cos(U2)
    lam = L
    for _ in range(200):
        sl, cl = math.sin(lam), math.cos(lam)
        ss = math.sqrt((cU2 * sl) ** 2 + (cU1 * sU2 - sU1 * cU2 * cl) ** 2)
        if ss == 0:
            return 0.0
        cs = sU1 * sU2 + cU1 * cU2 * cl
        sig = math.atan2(ss, cs)
        sa = cU1 * cU2 * sl / ss
        c2a = 1 - sa * sa
        c2sm = cs - 2 * sU1 * sU2 / c2a if c2a else 0.0
        C = f / 16 * c2a * (4 + f * (4 - 3 * c2a))
        lp = lam
        lam = L + (1 - C) * f * sa * (sig + C * ss * (c2sm + C * cs * (-1 + 2 * c2sm * c2sm)))
        if abs(lam - lp) < 1e-13:
            break
    u2 = c2a * (a * a - b * b) / (b * b)
    A = 1 + u2 / 16384 * (4096 + u2 * (-768 + u2 * (320 - 175 * u2)))
    B = u2 / 1024 * (256 + u2 * (-128 + u2 * (74 - 47 * u2)))
    ds = B * ss * (c2sm + B / 4 * (cs * (-1 + 2 * c2sm ** 2) - B / 6 * c2sm * (-3 + 4 * ss ** 2) * (-3 + 4 * c2sm ** 2)))
    return b * A * (sig - ds)


def test_geodesic_close_to_vincenty(spark):
    pairs = [(39.9, 116.3, 39.9 + d, 116.3 + e) for d, e in
             [(1e-5, 0), (0, 1e-4), (0.001, 0.002), (0.05, -0.03), (0.5, 0.5), (3.0, -4.0), (-7.0, 2.0)]]
    df = spark.createDataFrame(pairs, "a double, b double, c double, d double")
    got = [r[0] for r in df.select(geodesic_m("a", "b", "c", "d")).collect()]
    for (a, b, c, d), g in zip(pairs, got):
        ref = vincenty(a, b, c, d)
        assert abs(g - ref) <= 2e-6 * ref + 1e-6


def test_geodesic_zero(spark):
    df = spark.createDataFrame([(39.9, 116.3)], "a double, b double")
    assert df.select(geodesic_m("a", "b", "a", "b")).first()[0] == 0.0


def test_haversine_value(spark):
    df = spark.createDataFrame([(39.9, 116.3, 39.901, 116.3)], "a double, b double, c double, d double")
    assert df.select(haversine_m("a", "b", "c", "d")).first()[0] == pytest.approx(111.19492664, rel=1e-9)


def _points(spark, rows, uid="t"):
    t0 = datetime(2024, 1, 1)
    data = [(uid, t0 + timedelta(seconds=s), lat, lon, "bus") for lat, lon, s in rows]
    return spark.createDataFrame(data, "unique_id string, ts timestamp_ntz, lat double, lon double, "
                                       "transport_mode string")


GOLDEN = [
    ([(39.9, 116.3, 0), (39.901, 116.3, 10), (39.902, 116.3, 20), (39.903, 116.3, 25)],
     [333.584780, 22.238985, 11.119493, 11.119493, 14.825990, 27.476248, 1.482599, 0, 0, 0, 0, 0.494200]),
    ([(39.9, 116.3, 0), (39.901, 116.3, 10), (39.901, 116.302, 30)],
     [281.802182, 11.119493, 8.530363, 11.119493, 9.824928, 1.675898, 0.172609, 0, 0.172609, 0, 0, 0.086304]),
]


@pytest.mark.parametrize("rows,expected", GOLDEN)
def test_kinematic_golden(spark, rows, expected):
    f = kinematic_features(_points(spark, rows)).collect()
    assert len(f) == 1
    got = [f[0][c] for c in FEATURE_COLUMNS]
    assert got == pytest.approx(expected, abs=1e-6)


def test_two_points_no_row(spark):
    assert kinematic_features(_points(spark, [(39.9, 116.3, 0), (39.91, 116.3, 10)])).count() == 0


def test_same_timestamp_all_zero(spark):
    f = kinematic_features(_points(spark, [(39.9, 116.3, 0), (39.91, 116.3, 0), (39.92, 116.3, 0)])).first()
    assert [f[c] for c in FEATURE_COLUMNS] == [0.0] * 12
