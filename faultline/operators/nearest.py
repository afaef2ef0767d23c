"""Nearest sites of each event.

Which sites can be nearest to a point of a given cell depends on the sites
alone. So the sites are turned once into a table of cells with the few
candidates each can have, and events look up their one cell: no cross join, no
sort of all pairs, and in the broadcast case no shuffle of events.

The cells are the leaves of a quadtree whose inner cells hold many sites. A small
map of the inner cells tells an event which leaf it lies in.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.cells import (
    FACES,
    MAX_LEVEL,
    centre,
    coarser,
    fine_cell,
    half_angle,
    half_angle_sql,
    pack,
    unpacked,
    with_all_cells,
    with_child_cells,
    with_near_cells,
)
from ..functions.geo import DISTANCES, EARTH_RADIUS_KM, chord_squared, dot, with_unit_vector
from ..session import scratch_dir, stage
from .distance_join import choose
from .hotkeys import BROADCAST_BYTES, HOT_ROWS, TASK_PAIRS, salted_join, tasks_for

CELL = ["face", "i", "j"]
LEAF = ["face", "level", "i", "j"]
SITE = ["site_id", "site_lat", "site_lon", "_sx", "_sy", "_sz"]
SEED_PAIRS = 200_000_000
ROW_SITES = 4096
#: Up to so many sites the index is built from coarse cells down, in fewer and lighter jobs.
FEW_SITES = 4096
#: Levels of cells that one row of the map of inner cells spans.
STRIDE = 4
#: Levels above a leaf's of the cells in which it meets sites.
COARSE = 2
#: Sites that leaves meet as one group, at most, unless they share a finest cell.
GROUP_SITES = 32
#: Times that leaves with too many candidates are cut, and by how many levels.
CUTS, CUT_LEVELS = 3, 2
#: Half angles around a cell's centre within which cells count as beside it.
BESIDE = 0.8
# Sites whose distances differ by less than this many radians (6 m) both stay
# candidates; wider than rounding and than the 1e-6 km used to break ties.
_MARGIN = 1e-9


@dataclass(frozen=True)
class SiteIndex:
    """``cells``: one row per leaf with an array of candidate ``sites``.

    ``inner`` has, for inner cells of every STRIDE-th level, the level of the leaf
    around each cell STRIDE levels below, or -1 where the leaf is deeper still.
    """

    cells: DataFrame
    inner: DataFrame
    levels: tuple[int, ...]
    k: int
    size: int
    inner_size: dict[int, int]  # bytes by level of the inner cells
    split: bool  # some cell has its candidates in several rows


def _prune(pairs: DataFrame, level: int, k: int, cells: int) -> DataFrame:
    """Drops (cell, site) pairs with k sites nearer all over the cell.

    The nearest of each of k groups of sites makes k sites within some angle of
    the centre, so sites more than 2 h beyond that are out, h being the cell's
    half angle. Hash aggregation without a sort. ``cells`` bounds the number of
    cells, hence what is broadcast.
    """
    pairs = pairs.selectExpr("*", *[f"{c} AS _c{a}" for c, a in zip(centre(level), "xyz")])
    pairs = pairs.selectExpr("*", f"{dot('_c', '_s')} AS _dot")
    top = pairs.groupBy(*CELL, *([F.expr(f"pmod(xxhash64(site_id), {k})")] if k > 1 else []))
    top = top.agg(F.max("_dot").alias("_top"))
    if k > 1:
        top = top.groupBy(*CELL).agg(F.expr(f"if(count(*) = {k}, min(_top), -1D)").alias("_top"))
    # 1e-7 covers rounding in acos.
    reach = f"least(acos(least(_top, 1D)) + {2 * half_angle(level) + 1e-7!r}D, pi())"
    floor = top.selectExpr(*CELL, f"cos({reach}) - 1e-15D AS _floor")
    return pairs.join(_few(floor, cells), CELL).filter("_dot >= _floor").drop("_floor")


def _prune_dense(pairs: DataFrame, level: int, k: int, cells: int) -> DataFrame:
    """The same with an exact test against the k sites nearest to the centre.

    Far from a dense group of sites all of them are about equally far, yet most
    lie behind others. With r nearer the centre c, every point p of the cell is
    nearer to r than to s when p.(r - s) > 0 over the whole cap of radius h
    around c, that is when (c.v) cos h - |v - (c.v) c| sin h > 0, v = r - s.
    """
    w = Window.partitionBy(*CELL).orderBy(F.desc("_dot"), "site_id")
    rivals = (
        pairs.withColumn("_rn", F.row_number().over(w))
        .filter(F.col("_rn") <= k)
        .groupBy(*CELL)
        .agg(F.collect_list(F.struct("_sx", "_sy", "_sz")).alias("_rivals"))
    )
    h = half_angle(level)
    along = f"({dot('_c', 'r._s')} - _dot)"
    apart = f"({chord_squared('r._s', '_s')})"
    not_beaten = (
        f"exists(_rivals, r -> {along} * {math.cos(h)!r}D"
        f" - sqrt(greatest(0D, {apart} - {along} * {along})) * {math.sin(h)!r}D <= {_MARGIN}D)"
    )
    return pairs.join(_few(rivals, cells * k), CELL).filter(not_beaten)


def _few(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows * 96 <= BROADCAST_BYTES else df


def _start_level(sites: int) -> int:
    """Level to start at: a few cells per site, within a budget of (cell, site)
    pairs and never below 24 cells."""
    cells = max(FACES, min(8 * sites, SEED_PAIRS // max(sites, 1)))
    return max(1, round(math.log2(cells / FACES) / 2))


def _leaves(points: DataFrame, k: int, per_leaf: int) -> tuple[DataFrame, DataFrame]:
    """(face, level, i, j): a partition of the sphere, with each cell's centre and reach; and the cells with sites of every level.

    A cell is cut if it or a cell beside it has a child with more than ``per_leaf``
    sites; so cells are no larger than about their distance from dense sites. Sites are
    counted by their finest cell first, then every cell above it; both counts are
    combined before they are shuffled.
    """
    fine = points.select(*fine_cell("_s")).groupBy("face", "i", "j").agg(F.count(F.lit(1)).alias("_n"))
    above = fine.select("face", F.explode(F.sequence(F.lit(0), F.lit(MAX_LEVEL))).alias("level"), "i", "j", "_n")
    i, j = coarser("level")
    counts = above.groupBy("face", "level", F.expr(i).alias("i"), F.expr(j).alias("j")).agg(F.sum("_n").alias("_n"))
    # With the centre of the cell above, written out: the search for cells would otherwise work it out many times.
    up = ["face", "level - 1 AS level", "shiftright(i, 1) AS i", "shiftright(j, 1) AS j"]
    higher = f"transform(array(named_struct('face', face, 'level', level - 1, 'i', shiftright(i, 1), 'j', shiftright(j, 1))), u -> {_centre_of('u')})[0]"
    counts = stage(counts.selectExpr("*", f"if(_n > {per_leaf} AND level > 0, {higher}, null) AS _up"))
    full = counts.filter("_up IS NOT NULL").selectExpr(*up, "_up.*").dropDuplicates(LEAF)
    counts = counts.drop("_up")
    beside = with_near_cells(full, "_c", "_radius", "level").select("cell")
    beside = beside.distinct().selectExpr(*unpacked("cell")).selectExpr("*", "explode(sequence(0, level)) AS _up")
    inner = beside.selectExpr("face", "level - _up AS level", "shiftright(i, _up) AS i", "shiftright(j, _up) AS j")
    inner = inner.unionByName(counts.filter(F.col("_n") > per_leaf).filter("level = 0").select(*LEAF)).distinct()
    below = with_child_cells(inner).withColumn("level", F.col("level") + 1)
    faces = points.sparkSession.range(6).selectExpr("id AS face", "0 AS level", "0L AS i", "0L AS j")
    cells = below.unionByName(faces).join(inner, LEAF, "left_anti")
    parents = counts.selectExpr("face", "level + 1 AS level", "i AS _pi", "j AS _pj", "_n AS _above")
    cells = cells.selectExpr("*", "shiftright(i, 1) AS _pi", "shiftright(j, 1) AS _pj")
    cells = cells.join(parents, ["face", "level", "_pi", "_pj"], "left").join(counts, LEAF, "left")
    cells = cells.select(*LEAF, F.coalesce("_n", F.lit(0)).alias("_n"), F.coalesce("_above", F.lit(0)).alias("_above"))
    cells = cells.selectExpr(
        *LEAF, f"greatest(level - {COARSE}, 0) AS _at", f"{_reach(k)} AS _reach",
        *[f"{c} AS _c{a}" for c, a in zip(centre("level"), "xyz")],
    )
    return cells, counts


def _centre_of(cell: str) -> str:
    """SQL for the centre of the struct ``cell``, and how far from it cells count as beside it."""
    x, y, z = (re.sub(r"\b(face|level|i|j)\b", rf"{cell}.\1", c) for c in centre("level"))
    radius = f"{BESIDE} * {half_angle_sql(f'{cell}.level')}"
    return f"named_struct('_cx', {x}, '_cy', {y}, '_cz', {z}, '_radius', {radius})"


def _reach(k: int) -> str:
    """SQL for the angle around a leaf's centre within which all its candidates lie.

    Some k sites lie within some angle of the centre: in the leaf itself, in its
    parent, or else in a cell beside that. From any point of the leaf, half an angle h
    away at most, they are within h more, and so is each of its k nearest sites.
    """
    h, parent = half_angle_sql("level"), half_angle_sql("(level - 1)")
    known = f"CASE WHEN level = 0 THEN pi() WHEN _n >= {k} THEN {h} WHEN _above >= {k} THEN 2 * {parent}"
    return f"least(pi(), {known} ELSE {BESIDE + 3} * {parent} END + 2 * {h} + 1e-9D)"


def _groups(points: DataFrame, counts: DataFrame, levels: tuple[int, int], group_sites: int) -> DataFrame:
    """Groups of sites that leaves meet as one: (group, level, face, i, j, _from, _to, _sx, _sy, _sz, _rho, sites).

    A group is a cell with ``group_sites`` at most and all cells with sites below it. One
    of its sites stands for it, the others are no further than the chord _rho from that.
    A leaf that meets sites in cells of a level between _from and _to takes this group;
    for each such level the groups hold every site once.
    """
    first, last = (max(n - COARSE, 0) for n in levels)
    large = F.col("_n") > group_sites
    above = counts.filter(large).filter(f"level < {MAX_LEVEL}")
    above = above.selectExpr("face", "level + 1 AS level", "i AS _pi", "j AS _pj")
    small = counts.filter(~large | (F.col("level") == MAX_LEVEL)).selectExpr(*LEAF, "shiftright(i, 1) AS _pi", "shiftright(j, 1) AS _pj")
    tops = small.join(above, ["face", "level", "_pi", "_pj"]).select(*LEAF).unionByName(small.filter("level = 0").select(*LEAF))
    tops = stage(tops.select("level", pack("level").alias("cell")))
    some = tops.agg(F.count(F.lit(1)), F.min("level"), F.max("level")).first()
    each = points.select(*SITE, *fine_cell("_s")).withColumn("level", F.explode(F.sequence(F.lit(some[1]), F.lit(some[2]))))
    each = each.withColumn("cell", pack("level", "face", *coarser("level")))
    each = each.join(_few(tops.select("cell"), some[0]), "cell").withColumnRenamed("level", "_top").drop("cell")
    each = each.withColumn("level", F.explode(F.sequence("_top", F.greatest("_top", F.lit(last)))))
    group = pack("level", "face", *coarser("level")).alias("group")
    mean = [F.avg(f"_s{a}").alias(f"_m{a}") for a in "xyz"]
    found = each.groupBy(group, "_top").agg(F.collect_list(F.struct(*SITE)).alias("sites"), *mean)
    middle = f"array_max(transform(sites, s -> struct({dot('_m', 's._s')} AS d, s._sx, s._sy, s._sz)))"
    found = found.selectExpr("group", "_top", "sites", f"inline(array({middle}))").drop("d")
    found = found.selectExpr("*", f"sqrt(array_max(transform(sites, s -> {chord_squared('_s', 's._s')}))) * (1 + 1e-9D) + 1e-12D AS _rho")
    found = found.selectExpr(*unpacked("group"), "*")
    return found.withColumns({"_from": F.when(F.col("level") == F.col("_top"), F.lit(first)).otherwise(F.col("level")), "_to": F.least("level", F.lit(last))}).drop("_top").filter("_from <= _to")


def _wide(rho: str) -> str:
    """SQL for the angle of a chord, rounded up."""
    return f"(2 * asin(least(1D, {rho} / 2)) + 1e-12D)"


def _pairs(leaves: DataFrame, groups: DataFrame) -> DataFrame:
    """(leaf, group) for every group with a site within a leaf's reach; they meet in cells COARSE levels above the leaf's.

    Cells are exploded on both sides, where Spark takes a table for as small as before.
    """
    around = leaves.withColumn("_leaf", F.struct("face", "i", "j"))
    around = with_near_cells(around, "_c", "_reach", "_at").drop("_at")
    spots = groups.drop("sites").withColumnRenamed("level", "_level").withColumn("_at", F.explode(F.sequence("_from", "_to")))
    up = (f"shiftright({c}, _level - _at)" for c in "ij")
    spots = spots.select("group", "_sx", "_sy", "_sz", "_rho", pack("_at", "face", *up).alias("cell"))
    near = f"{dot('_c', '_s')} >= cos(least(_reach + {_wide('_rho')}, pi())) - 1e-15D"
    met = around.join(spots.hint("merge"), "cell").filter(near)
    return met.select("_leaf.face", "level", "_leaf.i", "_leaf.j", "group", "_sx", "_sy", "_sz", "_rho")


def _spelled_out(near: DataFrame, groups: DataFrame) -> DataFrame:
    """(leaf, site) of the (leaf, group) pairs left, without the sites that are too far from the leaf's centre by ``_floor``."""
    tasks = tasks_for(near, near.count() * GROUP_SITES, TASK_PAIRS >> 4)
    near = near.select(*LEAF, "group", "_floor", *(F.expr(c).alias(f"_c{a}") for c, a in zip(centre("level"), "xyz")))
    near = near.repartition(tasks, "group") if tasks else near
    met = near.join(groups.select("group", "sites"), "group").selectExpr("*", "inline(sites)")
    return met.filter(f"{dot('_c', '_s')} >= _floor").select(*LEAF, *SITE)


def _measured(pairs: DataFrame) -> DataFrame:
    """``pairs`` with the leaf's half angle and ends and where the site lies, both in the face's own axes.

    A generator, as Spark would otherwise work all of it out anew wherever a filter uses it.
    """
    c = centre("level")
    made = {
        "_dot": " + ".join(f"{x} * _s{a}" for x, a in zip(c, "xyz")),
        "_h": half_angle_sql("level"),
        "_o": "(1 - 2 * (face % 2)) * CASE WHEN face < 2 THEN _sx WHEN face < 4 THEN _sy ELSE _sz END",
        "_p": "if(face < 2, _sy, _sx)",
        "_q": "if(face < 4, _sz, _sy)",
    }
    made |= {f"_{e}{n}": f"(2D * {x} + {2 * n}) / shiftleft(1L, level) - 1" for x, e in (("i", "u"), ("j", "v")) for n in (0, 1)}
    fields = ", ".join(f"'{name}', {value}" for name, value in made.items())
    return pairs.selectExpr("*", f"inline_outer(array(named_struct({fields})))")


def _pruned(pairs: DataFrame, k: int, kept: list[str] = SITE, rho: str | None = None) -> DataFrame:
    """Drops (leaf, site) pairs with k sites nearer all over the leaf; adds the centre's ``_floor``.

    The nearest of each of k groups of sites makes k rivals, once for the leaf's centre
    and once for each corner. Those of the centre lie within some angle of it, so sites
    more than 2 h beyond that are out. Of the others, many lie behind the rivals of one
    of these points. Every point p of the leaf is a sum of its corners with weights
    above zero, so r is nearer to all of it than s when p.(r - s) > 0 at the corners.
    There p is (1, u, v) in the face's own axes.

    With ``rho`` a row is a group of sites, known by its first column in ``kept``: a site
    and the chord within which the others lie. It goes if all of them would: seen from p
    at an angle t, p.s is no more than |p| w (sin t + w) above that of the site, w being
    the chord's angle, and t is h at most above that of the centre.
    """
    at = ["_dot", *(f"_o + {u} * _p + {v} * _q" for u in ("_u0", "_u1") for v in ("_v0", "_v1"))]
    # Column by column, so that it is a hash aggregate; all of them take the same row.
    nearest = [F.max_by(c, F.expr(at[n])).alias(f"{c}{n}") for n in range(len(at)) for c in ("_o", "_p", "_q")]
    across = [f"least(_{e}0 * ({{r}}{c} - _{c}), _{e}1 * ({{r}}{c} - _{c}))" for e, c in (("u", "p"), ("v", "q"))]
    nearer = f"{{r}}o - _o + {' + '.join(across)} > _margin"
    # 1e-7 covers rounding in acos.
    floor = f"cos(least(acos(least(_floor, 1D)) + 2 * {half_angle_sql('level')} + 1e-7D, pi())) - 1e-15D"
    top = _measured(pairs)
    if k == 1:  # in columns, as functions of arrays are interpreted
        top = top.groupBy(*LEAF).agg(F.max("_dot").alias("_floor"), *nearest).withColumn("_floor", F.expr(floor))
        beaten = " OR ".join(f"({nearer.format(r='_@')})".replace("_@o", f"_o{n}").replace("_@p", f"_p{n}").replace("_@q", f"_q{n}") for n in range(len(at)))
    else:
        rivals = [F.collect_list(F.struct(*(F.col(f"_{c}{n}").alias(c) for c in "opq"))) for n in range(len(at))]
        top = top.groupBy(*LEAF, F.expr(f"pmod(xxhash64({kept[0]}), {k})").alias("_group")).agg(F.max("_dot").alias("_dot"), *nearest)
        top = top.groupBy(*LEAF).agg(F.min("_dot").alias("_floor"), F.array(*rivals).alias("_rivals"))
        # With fewer groups than k a leaf keeps all it has.
        few = f"size(_rivals[0]) < {k}"
        top = top.selectExpr(*LEAF, f"if({few}, null, _rivals) AS _rivals", f"if({few}, -2D, {floor}) AS _floor")
        beaten = f"_rivals IS NOT NULL AND exists(_rivals, g -> forall(g, r -> {nearer.format(r='r.')}))"
    # The same difference of angles is less of a dot product near the site; 4e-15 covers rounding.
    margin = f"2 * {_MARGIN}D * (_h + sqrt(greatest(0D, 2 - 2 * _dot)) + {rho or '0D'}) + 4e-15D"
    if rho:
        longest = "sqrt(1 + greatest(_u0 * _u0, _u1 * _u1) + greatest(_v0 * _v0, _v1 * _v1))"
        margin += f" + {longest} * {_wide(rho)} * least(1D, acos(least(1D, _dot)) + 1e-7D + _h + {_wide(rho)})"
        inside = f"_dot >= cos(least(acos(least(1D, greatest(-1D, _floor))) + {_wide(rho)}, pi())) - 1e-15D OR _floor < -1"
    else:
        inside = "_dot >= _floor"
    # What follows from leaf and site is worked out again behind the join, not carried through it. In a file the pairs
    # are a small part of their size in memory: Spark would broadcast them.
    near = _measured(pairs.join(top.hint("merge"), LEAF)).filter(inside)
    near = near.selectExpr("*", f"inline_outer(array(named_struct('_margin', {margin})))")
    return near.filter(f"NOT ({beaten})").select(*LEAF, *kept, "_floor")


def _leaf_rows(pairs: DataFrame, per_row: int | None) -> DataFrame:
    """(cell, sites); candidates of a cell with more than ``per_row`` are dealt out over several rows."""
    chunk = F.pmod(F.xxhash64(*SITE), F.greatest(F.lit(1), F.ceil(F.col("_n") / per_row))) if per_row else F.lit(0)
    return (
        pairs.withColumn("cell", pack("level"))
        .groupBy("cell", chunk.alias("_chunk"))
        .agg(F.collect_list(F.struct(*SITE)).alias("sites"))
        .select("cell", "sites")
    )


def _inner(leaves: DataFrame) -> DataFrame:
    """The map of inner cells: (cell, levels), levels having one entry for each cell STRIDE levels below."""
    base = f"(greatest(0, level - 1) div {STRIDE} * {STRIDE})"
    rest = f"cast({base} + {STRIDE} - level AS int)"
    side = f"shiftleft(1L, {rest})"
    each = leaves.selectExpr("face", "level", "i", "j", f"cast({base} AS int) AS _base", f"explode(sequence(0L, {side} * {side} - 1)) AS _n")
    shallow = each.selectExpr(
        "face", "_base", f"shiftleft(i, {STRIDE} + _base - level) + _n div shiftleft(1L, {STRIDE} + _base - level) AS i",
        f"shiftleft(j, {STRIDE} + _base - level) + _n % shiftleft(1L, {STRIDE} + _base - level) AS j", "level AS _level",
    )
    above = leaves.selectExpr("face", "level", "i", "j", f"explode(sequence(0, level, {STRIDE})) AS _at").filter("_at > 0 AND _at < level")
    above = above.selectExpr("face", f"_at - {STRIDE} AS _base", "shiftright(i, level - _at) AS i", "shiftright(j, level - _at) AS j", "-1 AS _level")
    entries = shallow.unionByName(above.distinct())
    cell = pack("_base", "face", f"shiftright(i, {STRIDE})", f"shiftright(j, {STRIDE})").alias("cell")
    place = f"(i % {1 << STRIDE}) * {1 << STRIDE} + j % {1 << STRIDE}"
    listed = entries.groupBy(cell).agg(F.array_sort(F.collect_list(F.struct(F.expr(place).alias("at"), F.col("_level").cast("byte").alias("level")))).alias("_all"))
    return listed.select("cell", F.transform("_all", lambda x: x["level"]).alias("levels"))


@dataclass
class _Built:
    """Leaves so far: tables of (cell, sites), their levels, bytes and number."""

    rows: list[DataFrame] = field(default_factory=list)
    levels: list[int] = field(default_factory=list)
    size: int = 0
    cells: int = 0
    split: bool = False


def _top_down(points: DataFrame, n: int, k: int, per_cell: int, per_row: int, root: str) -> _Built:
    """Starts from coarse cells with all sites each and quarters those with more than ``per_cell`` candidates.

    Children inherit only their parent's. Cells that stay full are left at the deepest
    level, or earlier once they multiply.
    """
    points = points.repartition(points.sparkSession.sparkContext.defaultParallelism, "site_id")
    level = _start_level(n)
    pairs, cells = with_all_cells(points, level), FACES << 2 * level
    built = _Built()
    first, fullness = level, math.inf
    full = F.col("_n") > per_cell
    while True:
        kept = _prune(pairs, level, k, cells)
        if level > first:
            kept = _prune_dense(kept, level, k, cells)
        kept = stage(kept.select(*CELL, *SITE), f"{root}/pairs-{level}")
        counts = kept.groupBy(*CELL).agg(
            F.count(F.lit(1)).alias("_n"),
            F.sum(F.octet_length(F.col("site_id").cast("string")) + 96).alias("_bytes"),
        )
        seen = counts.agg(
            F.count(F.lit(1)).alias("cells"),
            F.count_if(full).alias("full"),
            F.coalesce(F.sum(F.when(full, F.col("_n"))), F.lit(0)).alias("pairs"),
            F.coalesce(F.max("_n"), F.lit(0)).alias("most"),
            F.sum(F.col("_bytes") + 64).alias("bytes"),
            F.sum(F.when(~full, F.col("_bytes") + 64)).alias("leaf_bytes"),
        ).first()
        stuck = seen.pairs > 0.8 * fullness * seen.full
        last = not seen.full or level == MAX_LEVEL or (stuck and seen.pairs > 64 * n)
        leaf, rest = kept, None
        if not last:
            counted = kept.join(counts.drop("_bytes"), CELL)
            leaf, rest = counted.filter(~full).drop("_n"), counted.filter(full).drop("_n")
        if seen.cells > (0 if last else seen.full):
            crowded = last and seen.most > per_row
            if crowded:
                leaf, built.split = kept.join(counts.drop("_bytes"), CELL), True
            rows = _leaf_rows(leaf.withColumn("level", F.lit(level)), per_row if crowded else None)
            built.rows.append(rows)
            built.levels.append(level)
            built.size += seen.bytes if last else seen.leaf_bytes
            built.cells += seen.cells
        if last:
            return built
        # Few pairs left, or nothing gained by the last step: take a longer one.
        room = SEED_PAIRS if stuck else SEED_PAIRS // 100
        step = 3 if seen.pairs << 6 <= room and level + 3 <= MAX_LEVEL else 1
        pairs, cells, level = with_child_cells(rest, step), seen.full << 2 * step, level + step
        fullness = seen.pairs / seen.full


def _bottom_up(points: DataFrame, k: int, per_cell: int, per_row: int, per_leaf: int, root: str, group_sites: int = GROUP_SITES) -> _Built:
    """Counts sites by fine cells; the leaves are the largest cells with few sites in them and beside them.

    A leaf meets groups of the sites around it, as far as a candidate can lie. Groups of
    which k other sites beat all over the leaf are dropped, the rest is spelled out and
    pruned again, site by site: a leaf far from many sites doesn't meet all of them. Leaves beside dense sites
    may still have more than ``per_cell`` candidates; they are cut CUTS times at most,
    children inherit only their parent's. So the number of jobs doesn't grow with the
    density.
    """
    leaves, counts = _leaves(points, k, per_leaf)
    leaves = stage(leaves, f"{root}/leaves")
    depth = leaves.agg(F.min("level"), F.max("level")).first()
    points = points.repartition(points.sparkSession.sparkContext.defaultParallelism, "site_id")
    groups = stage(_groups(points, counts, depth, group_sites), f"{root}/groups")
    seen = stage(_pairs(leaves, groups), f"{root}/seen")
    near = stage(_pruned(seen, k, ["group"], "_rho"), f"{root}/near")
    met = stage(_spelled_out(near, groups), f"{root}/met")
    pairs = stage(_pruned(met, k).drop("_floor"), f"{root}/pairs-0")
    built, cut = _Built(), 0
    while True:
        counts = pairs.groupBy(*LEAF).agg(
            F.count(F.lit(1)).alias("_n"),
            (F.sum(F.octet_length(F.col("site_id").cast("string")) + 96) + 64).alias("_bytes"),
        )
        deep = (F.col("level") > MAX_LEVEL - CUT_LEVELS) | (F.lit(cut) == CUTS)
        full = (F.col("_n") > per_cell) & ~deep
        seen = counts.agg(
            F.count_if(full).alias("full"),
            F.count_if(~full).alias("cells"),
            F.coalesce(F.max(F.when(~full, F.col("_n"))), F.lit(0)).alias("most"),
            F.coalesce(F.sum(F.when(~full, F.col("_bytes"))), F.lit(0)).alias("bytes"),
            F.collect_set(F.when(~full, F.col("level"))).alias("levels"),  # at most MAX_LEVEL + 1
        ).first()
        leaf, rest = pairs, None
        if seen.full or seen.most > per_row:
            counted = pairs.join(counts.drop("_bytes"), LEAF)
            leaf, rest = counted.filter(~full), counted.filter(full).select(*LEAF, *SITE)
        rows = _leaf_rows(leaf, per_row if seen.most > per_row else None)
        built.rows.append(rows)
        built.levels += seen.levels
        built.size, built.cells = built.size + seen.bytes, built.cells + seen.cells
        built.split |= seen.most > per_row
        if not seen.full:
            return built
        children = with_child_cells(rest, CUT_LEVELS).withColumn("level", F.col("level") + CUT_LEVELS)
        cut += 1
        pairs = stage(_pruned(stage(children, f"{root}/met-{cut}"), k).drop("_floor"), f"{root}/pairs-{cut}")


def build_site_index(
    sites: DataFrame,
    k: int = 1,
    per_cell: int | None = None,
    per_row: int = ROW_SITES,
    path: str | None = None,
    per_leaf: int | None = None,
    few_sites: int = FEW_SITES,
) -> SiteIndex:
    """Candidate table for the ``k`` nearest sites (site_id, site_lat, site_lon).

    Dense areas get small cells, empty ones stay coarse. More than ``few_sites`` sites
    are taken bottom-up, in a number of jobs that doesn't depend on how they lie; few
    are taken from coarse cells down. Cells that stay full, as around a point that
    many sites are equally far from, keep all their candidates, ``per_row`` to a row.
    The driver sees counts only.
    """
    per_cell = per_cell or 16 + 8 * k
    root = path or scratch_dir(sites.sparkSession)
    points = sites.select("site_id", "site_lat", "site_lon").dropna(subset=["site_lat", "site_lon"])
    points = points.filter(~F.isnan("site_lat") & ~F.isnan("site_lon"))
    # Of sites at one point only the k lowest ids can matter.
    if k == 1:
        points = points.groupBy("site_lat", "site_lon").agg(F.min("site_id").alias("site_id"))
    else:
        at = Window.partitionBy("site_lat", "site_lon").orderBy("site_id")
        points = points.withColumn("_rn", F.row_number().over(at)).filter(F.col("_rn") <= k).drop("_rn")
    points = stage(with_unit_vector(points, "site_lat", "site_lon", "_s"), f"{root}/points")
    n = points.count()
    if n > few_sites:
        built = _bottom_up(points, k, per_cell, per_row, max(k, per_leaf or 2 + 2 * k), root)
    else:
        built = _top_down(points, n, k, per_cell, per_row, root)
    if not built.rows:
        built.rows.append(_leaf_rows(points.withColumns({c: F.lit(0) for c in LEAF}), None))
    cells = stage(reduce(DataFrame.unionByName, built.rows), f"{root}/cells")
    inner = stage(_inner(cells.selectExpr(*unpacked("cell")).distinct()), f"{root}/inner")
    inner_rows = inner.selectExpr(*unpacked("cell")).groupBy("level").count().collect()  # a row per STRIDE levels
    inner_size = {r.level: r["count"] * ((1 << 2 * STRIDE) + 64) for r in inner_rows}
    return SiteIndex(cells, inner, tuple(sorted(set(built.levels))) or (0,), k, built.size, inner_size, built.split)


def _with_leaf(spots: DataFrame, index: SiteIndex, broadcast_bytes: int) -> DataFrame:
    """``spots`` (with unit vector ``_e``) with the ``cell`` of the leaf they lie in.

    The leaf's level is read off the map of inner cells, STRIDE levels at a time: one
    join with one key for each row, no row more. From the level on at which the map is too
    large to broadcast, it is left aside, and a row in cells that deep gets a key for
    every level that leaves have there.
    """
    kept, spots = spots.columns, spots.select("*", *fine_cell("_e"))
    if len(index.levels) == 1:
        return spots.select(*kept, pack(str(index.levels[0]), "face", *coarser(str(index.levels[0]))).alias("cell"))
    spots = spots.withColumn("_level", F.lit(-1).cast("byte"))
    size, deep = 0, list(index.levels)
    for base in range(0, max(index.levels), STRIDE):
        size += index.inner_size.get(base, 0)
        if size > broadcast_bytes:
            break
        at = [f"shiftright({c}, {MAX_LEVEL - base - STRIDE}) % {1 << STRIDE}" for c in "ij"]
        spots = spots.withColumn("_key", F.when(F.col("_level") < 0, pack(str(base), "face", *coarser(str(base)))))
        down = index.inner.filter(f"cell div {1 << 2 * MAX_LEVEL} % 32 = {base}").select(F.col("cell").alias("_key"), F.col("levels").alias("_down"))
        level = f"if(_level < 0, get(_down, cast({at[0]} * {1 << STRIDE} + {at[1]} AS int)), _level)"
        spots = spots.join(F.broadcast(down), "_key", "left").selectExpr(*kept, "face", "i", "j", f"{level} AS _level")
        deep = [n for n in deep if n > base + STRIDE]
    level = "cast(_level AS int)"
    cell = pack(level, "face", *coarser(level))
    if deep:
        keys = F.array(*(pack(str(n), "face", *coarser(str(n))) for n in deep))
        cell = F.explode(F.when(F.col("_level") < 0, keys).otherwise(F.array(cell)))
    return spots.select(*kept, cell.alias("cell"))


def rank_sites(
    events: DataFrame,
    sites: DataFrame | SiteIndex,
    k: int = 1,
    strategy: str = "auto",
    ids_unique: bool = True,
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_rows: int = HOT_ROWS,
    method: str = "haversine",
) -> DataFrame:
    """The ``k`` nearest sites per event, ties by lower site_id.

    Events need event_id, lat and lon. Adds site_id, site_lat, site_lon,
    distance_km and rank. Every row is an event of its own and ranked where it
    is found. ``ids_unique=False`` ranks rows that share an event_id together, at
    the cost of a shuffle; rows without an id stay apart. ``method`` is the
    distance that is given, "haversine" or "slc"; both order sites alike.
    """
    index = sites if isinstance(sites, SiteIndex) else build_site_index(sites, k)
    if index.k < k:
        raise ValueError(f"the index holds candidates for k={index.k}, not {k}")
    across = index.split or not ids_unique  # candidates of an event come in several rows
    if across and events.isStreaming:
        raise ValueError("ranking across rows of an event: use foreachBatch or ids_unique")
    kept = [*events.columns, "_row"] if across else events.columns
    spots = with_unit_vector(events.dropna(subset=["lat", "lon"]), "lat", "lon", "_e")
    if across:
        spots = spots.withColumn("_row", F.monotonically_increasing_id())
    spots = _with_leaf(spots, index, broadcast_bytes)
    if choose(strategy, index.size, broadcast_bytes):
        found = spots.join(F.broadcast(index.cells), "cell")
    elif events.isStreaming:
        found = spots.join(index.cells, "cell")
    else:
        found = salted_join(spots, index.cells, "cell", hot_rows)

    # Arithmetic for all candidates; distances, rounded so that equal ones tie,
    # only for those as near as the best. A chord can round to just over 2.
    chord = chord_squared("_e", "s._s")
    chords = f"transform(sites, s -> {chord})"
    worst = f"array_min({chords})" if k == 1 else f"array_max(slice(sort_array({chords}), 1, {k}))"
    km = f"{2 * EARTH_RADIUS_KM}D * asin(least(1D, sqrt({chord}) / 2))"
    options = F.expr(
        f"transform(filter(sites, s -> {chord} <= _limit), s -> named_struct("
        f"'km', round({km}, 6), 'site_id', s.site_id,"
        " 'site_lat', s.site_lat, 'site_lon', s.site_lon))"
    )
    ranked = found.selectExpr("*", f"{worst} + {_MARGIN}D AS _limit")
    if k == 1:
        ranked = ranked.select(*kept, F.array_min(options).alias("_best"), F.lit(0).alias("_pos"))
    else:
        ranked = ranked.select(*kept, F.posexplode(F.slice(F.array_sort(options), 1, k)).alias("_pos", "_best"))
    ranked = ranked.select(*kept, "_best.*", (F.col("_pos") + 1).alias("rank"))
    if across:
        # An event without an id, or one of a split cell, is known by its row.
        alone = F.lit(True) if ids_unique else F.col("event_id").isNull()
        w = Window.partitionBy("event_id", F.when(alone, F.col("_row"))).orderBy("km", "site_id")
        ranked = ranked.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    return ranked.drop("_row").withColumn(
        "distance_km",
        DISTANCES[method](F.col("lat"), F.col("lon"), F.col("site_lat"), F.col("site_lon")),
    ).drop("km")


def nearest_site(events: DataFrame, sites: DataFrame | SiteIndex, **how) -> DataFrame:
    """One site per event: the nearest, ties by lower site_id."""
    return rank_sites(events, sites, 1, **how).drop("rank")
