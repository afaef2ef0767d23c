import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from faultline.functions import motion as m
from faultline.functions.cells import cell_id, half_angle, level_for_radius, with_cover
from faultline.functions.geo import (
    EARTH_RADIUS_KM,
    HALF_CIRCUMFERENCE_KM,
    haversine_km,
    slc_km,
    valid_coords,
    with_unit_vector,
)
from faultline.functions.values import number, plain_number, size_mb, ts

LAT = st.floats(-90, 90)
LON = st.floats(-180, 180)


def exact_km(lat1, lon1, lat2, lon2):
    p1, p2, d = math.radians(lat1), math.radians(lat2), math.radians(lon2 - lon1)
    y = math.hypot(
        math.cos(p2) * math.sin(d),
        math.cos(p1) * math.sin(p2) - math.sin(p1) * math.cos(p2) * math.cos(d),
    )
    x = math.sin(p1) * math.sin(p2) + math.cos(p1) * math.cos(p2) * math.cos(d)
    return EARTH_RADIUS_KM * math.atan2(y, x)


def distances(spark, points, f=haversine_km):
    df = spark.createDataFrame(points, "a double, b double, c double, d double")
    return [r[0] for r in df.select(f(*(F.col(x) for x in "abcd"))).collect()]


@pytest.mark.parametrize("f", [haversine_km, slc_km])
def test_distance_of_equal_points_is_zero(spark, f):
    points = [(lat, lon, lat, lon) for lat in range(-90, 91, 7) for lon in range(-180, 181, 13)]
    got = distances(spark, [tuple(map(float, p)) for p in points], f)
    assert all(not math.isnan(km) and km < 0.2 for km in got)
    if f is haversine_km:
        assert set(got) == {0.0}


def test_antipodes(spark):
    points = [(lat / 10, lon / 7, -lat / 10, lon / 7 + 180) for lat in range(-900, 901, 37) for lon in range(0, 900, 41)]
    for f in (haversine_km, slc_km):
        assert all(abs(km - HALF_CIRCUMFERENCE_KM) < 1e-3 for km in distances(spark, points, f))
    assert round(HALF_CIRCUMFERENCE_KM, 3) == 20015.087


def test_null_coordinate_gives_null(spark):
    full = (1.0, 2.0, 3.0, 4.0)
    points = [tuple(None if i == j else v for j, v in enumerate(full)) for i in range(4)]
    assert distances(spark, points) == [None] * 4
    assert distances(spark, points, slc_km) == [None] * 4


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(LAT, LON, LAT, LON), min_size=20, max_size=60))
def test_distance_is_symmetric_bounded_and_right(spark, points):
    there = distances(spark, points)
    back = distances(spark, [(c, d, a, b) for a, b, c, d in points])
    for p, km, reverse in zip(points, there, back):
        assert abs(km - reverse) < 1e-3
        assert 0 <= km <= HALF_CIRCUMFERENCE_KM + 1e-6
        assert abs(km - exact_km(*p)) < 1e-3


def test_bounds_are_inclusive(spark):
    rows = [(90.0, 180.0), (-90.0, -180.0), (90.0001, 0.0), (0.0, 180.0001), (-90.0001, 0.0), (None, 0.0), (math.nan, 0.0)]
    df = spark.createDataFrame(rows, "lat double, lon double")
    kept = df.filter(valid_coords(F.col("lat"), F.col("lon"))).collect()
    assert [tuple(r) for r in kept] == rows[:2]


POLES_AND_SEAM = [(90.0, 7.0), (-90.0, 3.0), (0.0, 180.0), (0.0, -180.0), (45.0, 45.0), (35.26438968, 45.0), (0.0, 0.0)]


@pytest.mark.parametrize("km", [0.5, 30, 500, 5000, 9990, 12000, 20000, HALF_CIRCUMFERENCE_KM])
def test_cover_holds_every_point_in_reach(spark, km):
    """No cell of a point in reach is missing from the cover, none twice."""
    radius = km / EARTH_RADIUS_KM
    level = level_for_radius(radius)
    sites = [(i, *p) for i, p in enumerate(POLES_AND_SEAM)]
    near = []
    for i, lat, lon in sites:
        for step in range(400):
            # Directions around the site at up to the full radius, by the direct formula.
            share = [1.0, 0.999999, 0.7, 0.2][step % 4]
            bearing, d = step * 2.399, radius * share
            p1, l1 = math.radians(lat), math.radians(lon)
            p2 = math.asin(max(-1, min(1, math.sin(p1) * math.cos(d) + math.cos(p1) * math.sin(d) * math.cos(bearing))))
            l2 = l1 + math.atan2(math.sin(bearing) * math.sin(d) * math.cos(p1), math.cos(d) - math.sin(p1) * math.sin(p2))
            near.append((i, math.degrees(p2), math.degrees(l2)))
    s = with_unit_vector(spark.createDataFrame(sites, "id int, lat double, lon double"), "lat", "lon", "_s")
    cover = with_cover(s, "_s", radius).select("id", "cell")
    p = with_unit_vector(spark.createDataFrame(near, "id int, lat double, lon double"), "lat", "lon", "_e")
    p = p.withColumn("cell", cell_id("_e", level))
    assert p.join(cover, ["id", "cell"], "left_anti").count() == 0
    assert cover.count() == cover.distinct().count()
    assert cover.groupBy("id").count().agg(F.max("count")).first()[0] <= 64


def all_cells(spark, level):
    side = 1 << level
    return spark.range(6 * side * side).selectExpr(
        f"id div {side * side} AS face", f"id div {side} % {side} AS i", f"id % {side} AS j"
    )


def test_half_angle_bounds_the_distance_to_the_centre(spark):
    from faultline.functions.cells import MAX_LEVEL, centre

    assert half_angle(MAX_LEVEL) > 0
    for level in (0, 1, 3):
        cells = all_cells(spark, level)
        x, y, z = centre(level)
        cells = cells.selectExpr("face", "i", "j", f"{x} AS cx", f"{y} AS cy", f"{z} AS cz")
        side = 1 << level
        corner = cells.selectExpr(
            "*", "explode(transform(sequence(0, 3), n -> named_struct('a', i + n % 2, 'b', j + n div 2))) AS c"
        ).selectExpr("*", f"2 * c.a / {side}D - 1 AS u", f"2 * c.b / {side}D - 1 AS v", "1 - 2 * (face % 2) AS s")
        dot = """(cx * if(face < 2, s, u) + cy * CASE WHEN face < 2 THEN u WHEN face < 4 THEN s ELSE v END
                 + cz * if(face < 4, v, s)) / sqrt(1 + u * u + v * v)"""
        assert math.acos(corner.agg(F.expr(f"min({dot})")).first()[0]) <= half_angle(level) + 1e-12


def test_cells_of_centres_are_their_own(spark):
    from faultline.functions.cells import centre, pack

    for level in (0, 2, 4):
        cells = all_cells(spark, level)
        c = centre(level)
        cells = cells.selectExpr("*", *[f"{e} AS _e{a}" for e, a in zip(c, "xyz")])
        assert cells.filter(pack(level) != cell_id("_e", level)).count() == 0


def test_class_bounds(spark):
    values = [(0.0999,), (0.1,), (0.9999,), (1.0,), (None,), (math.nan,)]
    df = spark.createDataFrame(values, "v double")

    def labels(policy):
        label = m.intensity_label(F.col("v"), null_policy=policy)
        return [tuple(r) for r in df.select(label, m.high_flag(label)).collect()]

    known = [("Low", False), ("Moderate", False), ("Moderate", False), ("High", True)]
    assert labels("null") == known + [(None, False)] * 2
    assert labels("reference") == known + [("High", True)] * 2
    with pytest.raises(ValueError):
        labels("other")


def test_motion(spark):
    df = spark.createDataFrame([(6.0, 10.0, 8.0), (6.0, 10.0, None)], "mag double, km double, depth double")
    args = F.col("mag"), F.col("km"), F.col("depth")
    (pgv, pgd), (no_pgv, no_pgd) = df.select(m.pgv(*args), m.pgd(*args)).collect()
    assert math.isclose(pgv, math.exp(-2.5 + 0.8 * 6 - 1.2 * math.log(11) - 0.005 * 8))
    assert math.isclose(pgd, math.exp(-3.0 + 0.9 * 6 - 1.3 * math.log(11) - 0.006 * 8))
    assert no_pgv is None and no_pgd is None


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(0, 10), min_size=5, max_size=50))
def test_label_is_monotone(spark, values):
    df = spark.createDataFrame([(float(v),) for v in sorted(values)], "v double")
    rank = {"Low": 0, "Moderate": 1, "High": 2}
    labels = [rank[r[0]] for r in df.select(m.intensity_label(F.col("v"))).collect()]
    assert labels == sorted(labels)


def test_values(spark):
    df = spark.createDataFrame(
        [("2025-12-12T08:30:52.000Z",), ("2025-12-12 10:32:50",), ("bad",), (None,)], "t string"
    )
    got = [r[0] for r in df.select(ts(F.col("t")).cast("string")).collect()]
    assert got == ["2025-12-12 08:30:52", "2025-12-12 10:32:50", None, None]
    texts = ["1.5", " -2 ", "+.5", "1e3", "x", "1d", "0x10", "", "1.", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(number(F.col("t"))).collect()]
    assert got == [1.5, -2.0, 0.5, 1000.0, None, None, None, None, 1.0, None]
    shown = {"2.0E-4": "0.0002", "1.0E7": "10000000.0", "12.3": "12.3", "1.0E-7": "1.0E-7", "8": "8", "1.25E8": "125000000.0",
             "1.23456789012345E-4": "0.000123456789012345", "-1.2345678901234567E-4": "-0.00012345678901234567",
             "9.007199254740993E14": "900719925474099.3", "+5e3": "5000.0", "1E400": "1E400", "x": "x"}
    df = spark.createDataFrame([(t,) for t in shown], "t string")
    assert [r[0] for r in df.select(plain_number(F.col("t"))).collect()] == list(shown.values())
    assert spark.range(1).select(size_mb(F.lit(1572864))).first()[0] == 1.5
