"""Pairs of events and sites closer than a threshold."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.cells import cell_id, level_for_radius, with_cover
from ..functions.geo import DISTANCES, EARTH_RADIUS_KM, chord_squared, with_unit_vector
from ..session import stage
from .hotkeys import BROADCAST_BYTES, HOT_ROWS, TASK_PAIRS, key_sizes, measured, pairs_of, salted_join, tasks_for

STRATEGIES = ("auto", "broadcast", "grid")


def choose(strategy: str, size: int, limit: int) -> bool:
    """Whether to broadcast a side of ``size`` bytes."""
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}, not {strategy!r}")
    if strategy == "broadcast" and size > limit:
        raise ValueError(f"the sites need {size} bytes, over the broadcast limit of {limit}")
    return strategy != "grid" and size <= limit


def within_distance(
    events: DataFrame,
    sites: DataFrame,
    km: float,
    strategy: str = "auto",
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_rows: int = HOT_ROWS,
    method: str = "haversine",
    task_pairs: int = TASK_PAIRS,
) -> DataFrame:
    """All (event, site) pairs with distance_km < ``km``.

    Events need lat and lon, sites site_lat and site_lon; all other columns are
    carried. Each site is listed under every cell its circle touches and each
    event lies in one cell, so an equi-join on the cell meets every pair once;
    the exact distance decides. Sites are broadcast when their measured size
    allows, which leaves events where they are; else both sides are shuffled by
    cell with hot cells cut up. ``events`` may be a stream; the listed sites are
    then written out once, not made again for every micro-batch. Pairs grow with the
    product of both sides, so the pairs of cells are counted first and events dealt
    over tasks of about ``task_pairs`` each; a stream keeps the splits of its source.

    ``method`` is the distance: "haversine" or "slc".
    """
    shared = set(events.columns) & set(sites.columns)
    if shared:
        raise ValueError(f"events and sites both have {sorted(shared)}")
    radius = min(km / EARTH_RADIUS_KM, math.pi)
    here = sites.dropna(subset=["site_lat", "site_lon"])
    here = with_cover(with_unit_vector(here, "site_lat", "site_lon", "_s"), "_s", radius)
    if events.isStreaming:
        here = stage(here)
    there = with_unit_vector(events.dropna(subset=["lat", "lon"]), "lat", "lon", "_e")
    there = there.withColumn("cell", cell_id("_e", level_for_radius(radius)))
    size = 0 if strategy == "grid" else measured(here)[1]
    if choose(strategy, size, broadcast_bytes):
        if not events.isStreaming:
            tasks = tasks_for(there, pairs_of(key_sizes(there, here, "cell")), task_pairs)
            there = there.repartition(tasks) if tasks else there
        pairs = there.join(F.broadcast(here), "cell")
    elif events.isStreaming:
        # A micro-batch is bounded by the source's rate limit; no counting pass.
        pairs = there.join(here, "cell")
    else:
        pairs = salted_join(there, here, "cell", hot_rows, task_pairs)
    # Tests on the chord first; the slack leaves the edge to the exact one, so that most
    # pairs take the distance once. coalesce keeps Spark from testing the vectors for NULL in the scan.
    limit, chord = 4 * math.sin(radius / 2) ** 2, chord_squared("_e", "_s")
    distance = DISTANCES[method](F.col("lat"), F.col("lon"), F.col("site_lat"), F.col("site_lon"))
    inside = F.expr(f"{chord} < {limit - 1e-12!r}D") if limit > 2e-12 else F.lit(False)
    near = F.expr(f"{chord} <= {limit + 1e-12!r}D") & (inside | (distance < km))
    return (
        pairs.filter(F.coalesce(near, F.lit(False)))
        .withColumn("distance_km", distance)
        .select(*events.columns, *sites.columns, "distance_km")
    )


def proximity(events: DataFrame, sites: DataFrame, km: float, **how) -> DataFrame:
    """Proximity rows: when analysed, which site, which event, how far."""
    return within_distance(events, sites, km, **how).select(
        F.current_timestamp().alias("analysis_time"),
        F.col("site_name").alias("airport_name"),
        "magnitude",
        "region",
        F.col("distance_km").alias("dist_km"),
        "event_id",
        "site_id",
    )
