import math
import random

import pytest
from pyspark.sql import functions as F

from faultline.functions.geo import HALF_CIRCUMFERENCE_KM, haversine_km, with_unit_vector
from faultline.operators.distance_join import proximity, within_distance
from faultline.operators.hotkeys import salted_join
from faultline.operators.nearest import SiteIndex, _with_leaf, build_site_index, nearest_site, rank_sites

SITE = "site_id int, site_lat double, site_lon double"
EVENT = "event_id int, lat double, lon double"
EDGES = [(90.0, 10.0), (90.0, -70.0), (-90.0, 0.0), (0.0, 180.0), (0.0, -180.0), (0.0, 0.0), (45.0, 45.0), (35.26438968, 45.0)]


def spread(rng, n):
    """Points over the sphere, poles and seam included, a third in one spot."""
    out = list(EDGES)
    while len(out) < n:
        if len(out) % 3:
            out.append((math.degrees(math.asin(rng.uniform(-1, 1))), rng.uniform(-180, 180)))
        else:
            out.append((48 + rng.random() / 10, 2 + rng.random() / 10))
    return out


@pytest.fixture(scope="module")
def world(spark):
    rng = random.Random(5)
    sites = [(i, *p) for i, p in enumerate(spread(rng, 90))]
    sites += [(100 + i, *p) for i, p in enumerate(EDGES)]  # same points, higher ids
    events = [(i, *p) for i, p in enumerate(spread(rng, 150))]
    e, s = spark.createDataFrame(events, EVENT), spark.createDataFrame(sites, SITE)
    pairs = [(a, b) for a in events for b in sites]
    df = spark.createDataFrame([(a[0], a[1], a[2], b[0], b[1], b[2]) for a, b in pairs], f"{EVENT}, {SITE}")
    km = haversine_km(*(F.col(c) for c in ("lat", "lon", "site_lat", "site_lon")))
    brute = {(r.event_id, r.site_id): r.km for r in df.withColumn("km", km).collect()}
    return e.cache(), s.cache(), brute


def found(pairs):
    rows = [(r.event_id, r.site_id) for r in pairs.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("strategy", ["broadcast", "grid"])
@pytest.mark.parametrize("km", [0.0, 1.0, 500.0, 5000.0, 12000.0, 20000.0])
def test_within_distance_equals_brute_force(world, km, strategy):
    e, s, brute = world
    want = {pair for pair, d in brute.items() if d < km}
    assert found(within_distance(e, s, km, strategy, hot_rows=10)) == want


def test_all_pairs_at_any_distance(world):
    e, s, brute = world
    assert found(within_distance(e, s, 2 * HALF_CIRCUMFERENCE_KM)) == set(brute)


def best(brute, k):
    by_event = {}
    for (event, site), d in brute.items():
        by_event.setdefault(event, []).append((round(d, 6), site))
    return {event: [site for _, site in sorted(options)[:k]] for event, options in by_event.items()}


@pytest.mark.parametrize("few", [0, 4096])
@pytest.mark.parametrize("strategy, per_cell, per_row", [("broadcast", None, 4096), ("grid", 4, 4096), ("broadcast", 4, 2)])
def test_nearest_equals_brute_force(world, strategy, per_cell, per_row, few):
    """A small per_cell takes the index through several rounds; a small per_row
    spreads the candidates of a cell over several rows."""
    e, s, brute = world
    index = build_site_index(s, per_cell=per_cell, per_row=per_row, few_sites=few)
    assert index.split == (per_row == 2)
    rows = nearest_site(e, index, strategy=strategy, hot_rows=10).collect()
    assert {r.event_id: [r.site_id] for r in rows} == best(brute, 1)
    assert all(abs(r.distance_km - brute[r.event_id, r.site_id]) < 1e-9 for r in rows)


@pytest.mark.parametrize("k, few", [(2, 0), (7, 0), (7, 4096)])
def test_rank_equals_brute_force(world, k, few):
    e, s, brute = world
    got = {}
    for r in rank_sites(e, build_site_index(s, k, few_sites=few), k).orderBy("event_id", "rank").collect():
        got.setdefault(r.event_id, []).append(r.site_id)
        assert r.rank == len(got[r.event_id])
    assert got == best(brute, k)
    with pytest.raises(ValueError):
        rank_sites(e, build_site_index(s, 1), k)


def test_more_sites_wanted_than_there_are(spark):
    e = spark.createDataFrame([(1, 0.0, 0.0)], EVENT)
    s = spark.createDataFrame([(1, 1.0, 0.0), (2, 0.0, 0.5)], SITE)
    assert [r.site_id for r in rank_sites(e, s, 5).orderBy("rank").collect()] == [2, 1]


def test_dense_sites_are_split(spark):
    """A third of the sites in a tenth of a degree, events in it, near it and far."""
    rng = random.Random(9)
    spots = spread(rng, 1500)
    s = spark.createDataFrame([(i, *p) for i, p in enumerate(spots)], SITE)
    events = [(i, lat + rng.uniform(-1, 1) * (i % 2), lon + rng.uniform(-1, 1) * (i % 2))
              for i, (lat, lon) in enumerate(rng.sample(spots[8:], 60))]
    index = build_site_index(s)
    assert len(index.levels) > 3 and not index.split
    assert index.cells.agg(F.max(F.size("sites"))).first()[0] <= 64
    got = {r.event_id: r.site_id for r in nearest_site(spark.createDataFrame(events, EVENT), index).collect()}

    def vector(lat, lon):
        p, l = math.radians(lat), math.radians(lon)
        return math.cos(p) * math.cos(l), math.cos(p) * math.sin(l), math.sin(p)

    where = [vector(*p) for p in spots]
    for i, lat, lon in events:
        v = vector(lat, lon)
        chord = [math.dist(v, w) for w in where]
        assert chord[got[i]] <= min(chord) + 1e-9


def test_ties_take_the_lower_id(spark):
    e = spark.createDataFrame([(1, 10.0, 20.0)], EVENT)
    s = spark.createDataFrame([(9, 10.0, 21.0), (4, 10.0, 19.0), (6, 10.0, 21.0)], SITE)
    assert nearest_site(e, s).first().site_id == 4
    same = spark.createDataFrame([(9, 10.0, 20.0), (4, 10.0, 20.0)], SITE)
    row = nearest_site(e, same).first()
    assert (row.site_id, row.distance_km) == (4, 0.0)


def test_no_sites_and_no_coordinates(spark):
    e = spark.createDataFrame([(1, 10.0, 20.0), (2, None, 1.0)], EVENT)
    none = spark.createDataFrame([], SITE)
    assert nearest_site(e, none).count() == 0 and within_distance(e, none, 100.0).count() == 0
    s = spark.createDataFrame([(1, 10.0, 20.0), (2, None, 5.0)], SITE)
    assert [r.event_id for r in nearest_site(e, s).collect()] == [1]
    assert found(within_distance(e, s, 30000.0)) == {(1, 1)}


def test_one_row_per_event_id(spark):
    e = spark.createDataFrame([(1, 10.0, 20.0), (1, 50.0, 20.0), (None, 0.0, 0.0), (None, 1.0, 1.0)], EVENT)
    s = spark.createDataFrame([(1, 11.0, 20.0), (2, 50.0, 20.1)], SITE)
    assert nearest_site(e, s).count() == 4  # every row is an event
    found = nearest_site(e, s, ids_unique=False).collect()  # rows of one id are one event, rows without stay apart
    assert sorted((r.event_id or 0, r.site_id) for r in found) == [(0, 1), (0, 1), (1, 2)]


def test_events_without_id_and_split_cells(spark):
    """With its candidates in several rows a cell still gives each row of events its own nearest site."""
    e = spark.createDataFrame([(None, 0.0, 0.0), (None, 0.0, 0.0), (7, 0.0, 0.1), (7, 0.0, -0.1)], EVENT)
    s = spark.createDataFrame([(i, 0.01 * (i % 7), 0.01 * (i // 7)) for i in range(49)], SITE)
    index = build_site_index(s, per_cell=4, per_row=2)
    found = nearest_site(e, index).collect()
    assert sorted((r.event_id or 0, r.site_id) for r in found) == [(0, 0), (0, 0), (7, 0), (7, 42)]


def test_strategy_is_checked(spark, world):
    e, s, _ = world
    with pytest.raises(ValueError, match="limit"):
        within_distance(e, s, 100.0, "broadcast", broadcast_bytes=10)
    with pytest.raises(ValueError, match="strategy"):
        within_distance(e, s, 100.0, "cross")
    with pytest.raises(ValueError, match="both have"):
        within_distance(e.withColumn("site_id", F.lit(1)), s, 100.0)
    with pytest.raises(ValueError, match="limit"):
        nearest_site(e, s, strategy="broadcast", broadcast_bytes=10)
    # Over the limit, auto goes the other way and finds the same.
    small = within_distance(e, s, 300.0, broadcast_bytes=10)
    assert found(small) == found(within_distance(e, s, 300.0))
    assert "BroadcastNestedLoopJoin" not in small._jdf.queryExecution().executedPlan().toString()


def test_no_cross_join_and_no_python_in_plans(world):
    e, s, _ = world
    for df in (within_distance(e, s, 20000.0), nearest_site(e, s), nearest_site(e, s, strategy="grid")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        for word in ("NestedLoop", "Cartesian", "Python"):
            assert word not in plan


def test_broadcast_lookup_does_not_shuffle_events(world):
    """Nor does it make an event several rows: the map of inner cells gives its one key."""
    e, s, _ = world
    index = build_site_index(s)
    assert isinstance(index, SiteIndex) and len(index.levels) > 1
    assert "Generate" not in nearest_site(e, index)._jdf.queryExecution().executedPlan().toString()
    far = nearest_site(e, index, broadcast_bytes=0)  # a map over the limit: one key for each level
    assert "Generate" in far._jdf.queryExecution().executedPlan().toString()
    assert {(r.event_id, r.site_id) for r in far.collect()} == {(r.event_id, r.site_id) for r in nearest_site(e, index).collect()}
    df = nearest_site(e, index, ids_unique=True)
    assert "hashpartitioning" not in df._jdf.queryExecution().executedPlan().toString()


def test_salted_join_pairs_once_with_both_sides_hot(spark):
    left = spark.range(200).selectExpr("id AS a", "if(id % 3 = 0, 0, id % 7) AS k")
    left = left.unionByName(left.filter("a < 50"))  # identical copies
    right = spark.range(90).selectExpr("id AS b", "if(id % 3 = 0, 0, id % 9) AS k")
    want = sorted(map(tuple, left.join(right, "k").select("k", "a", "b").collect()))
    for hot in (1, 7, 40, 10_000):
        got = salted_join(left, right, "k", hot).select("k", "a", "b").collect()
        assert sorted(map(tuple, got)) == want


def test_proximity_columns(spark):
    e = spark.createDataFrame([("q", 1.0, 1.0, 4.0, "r")], "event_id string, lat double, lon double, magnitude double, region string")
    s = spark.createDataFrame([("a", "name", 1.0, 1.5)], "site_id string, site_name string, site_lat double, site_lon double")
    row = proximity(e, s, 100.0).first()
    assert row.asDict().keys() == {"analysis_time", "airport_name", "magnitude", "region", "dist_km", "event_id", "site_id"}
    assert abs(row.dist_km - 55.589) < 0.01


@pytest.mark.parametrize("k", [1, 2])
def test_few_candidates_beside_clustered_sites(spark, k):
    rng = random.Random(11)
    spots = [(rng.uniform(-80, 80), rng.uniform(-180, 180)) for _ in range(6)]
    sites = [(i, spots[i % 6][0] + rng.random() / 10, spots[i % 6][1] + rng.random() / 10) for i in range(1200)]
    s = spark.createDataFrame(sites, SITE)
    index = build_site_index(s, k, few_sites=0)
    size = index.cells.agg(F.avg(F.size("sites")), F.max(F.size("sites"))).first()
    # With the rivals of the centre alone 11.8 and 401 for k=1, 15.2 and 404 for k=2.
    assert size[0] <= 5 * k and size[1] <= 200
    events = [(i, *spots[i % 6]) for i in range(6)] + [(10 + i, a + rng.random() / 10, o + rng.random() / 10) for i, (a, o) in enumerate(spots * 9)]
    events += [(100 + i, *p) for i, p in enumerate(spread(rng, 60))]
    e = spark.createDataFrame(events, EVENT)
    got = {(r.event_id, r["rank"]): r.site_id for r in rank_sites(e, index, k).collect()}
    km = F.round(haversine_km(*(F.col(c) for c in ("lat", "lon", "site_lat", "site_lon"))), 6)
    near = e.crossJoin(s).groupBy("event_id").agg(F.slice(F.array_sort(F.collect_list(F.struct(km.alias("km"), "site_id"))), 1, k).alias("best"))
    assert got == {(r.event_id, n): b.site_id for r in near.collect() for n, b in enumerate(r.best, 1)}


@pytest.mark.parametrize("strategy", ["broadcast", "grid"])
def test_tasks_grow_with_the_pairs(spark, world, strategy, tmp_path):
    """Few bytes can make many pairs: no task gets many more than ``task_pairs``, a cell of all pairs too."""
    e = spark.range(300).selectExpr("cast(id AS int) AS event_id", "10 + id / 1e5 AS lat", "id / 1e5 AS lon").coalesce(1)
    s = spark.range(200).selectExpr("cast(id AS int) AS site_id", "10 + id / 1e5 AS site_lat", "id / 1e5 AS site_lon")
    within_distance(e, s, 50.0, strategy, task_pairs=2000).write.parquet(f"{tmp_path}/pairs")
    tasks = spark.read.parquet(f"{tmp_path}/pairs").groupBy(F.input_file_name()).count().collect()
    assert sum(t["count"] for t in tasks) == 60_000
    assert len(tasks) > 10 and max(t["count"] for t in tasks) <= 12_000
    e, s, brute = world
    assert found(within_distance(e, s, 5000.0, strategy, task_pairs=50)) == {p for p, d in brute.items() if d < 5000.0}


def test_leaves_far_from_a_cluster_do_not_meet_all_its_sites(spark, tmp_path):
    """Pairs of a leaf and a site are written before they are pruned one by one; groups of sites are pruned before that."""
    rng = random.Random(12)
    spots = [(rng.uniform(-80, 80), rng.uniform(-180, 180)) for _ in range(3)]
    sites = [(i, spots[i % 3][0] + rng.random() / 10, spots[i % 3][1] + rng.random() / 10) for i in range(1500)]
    build_site_index(spark.createDataFrame(sites, SITE), few_sites=0, path=f"{tmp_path}/index")
    assert spark.read.parquet(f"{tmp_path}/index/met").count() <= 150 * len(sites)


def test_a_map_too_large_costs_keys_only_where_leaves_are_deep(spark):
    """Of the map of inner cells as many levels are broadcast as fit; events beside the deepest ones keep one key."""
    rng = random.Random(13)
    spot = 40.02, 60.02
    sites = [(i, spot[0] + rng.random() / 10, spot[1] + rng.random() / 10) for i in range(400)]
    index = build_site_index(spark.createDataFrame(sites, SITE), few_sites=0)
    places = [*spread(rng, 40), *((spot[0] + rng.random() / 10, spot[1] + rng.random() / 10) for _ in range(40))]
    e = spark.createDataFrame([(i, *p) for i, p in enumerate(places)], EVENT)
    want = {r.event_id: r.site_id for r in nearest_site(e, index).collect()}
    sizes = [index.inner_size[n] for n in sorted(index.inner_size)]
    deepest = sorted(index.inner_size)[-1]
    for limit in (0, sum(sizes[:-1]), sum(sizes)):
        assert {r.event_id: r.site_id for r in nearest_site(e, index, strategy="grid", broadcast_bytes=limit).collect()} == want
    spots = with_unit_vector(e, "lat", "lon", "_e")
    keys = _with_leaf(spots, index, sum(sizes[:-1])).groupBy("event_id").count().collect()
    assert all(r["count"] == 1 for r in keys if r.event_id < 30)
    assert max(r["count"] for r in keys) == len([n for n in index.levels if n > deepest])
