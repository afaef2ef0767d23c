"""Equal-angle cells on the six faces of a cube around the sphere.

A point on the unit sphere is projected onto the cube face it points at and
each face is halved in both directions per level. There are no poles and no
180-degree seam, so joins on cells need no special cases.

Points are three columns with a common prefix (``_ex``, ``_ey``, ``_ez`` for
prefix ``_e``); cells are the columns face, i, j or one packed bigint.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_LEVEL = 24
FACES = 6
_SPAN = 1 << MAX_LEVEL
# Per face: the outward coordinate and the two across it.
_AXES = [(s + a, p, q) for a, p, q in ("xyz", "yxz", "zxy") for s in ("", "-")]


def half_angle(level: int) -> float:
    """Upper bound in radians on the angle from a cell's centre to its corners."""
    return 2 * math.atan(math.sqrt(0.5) / (1 << level))


def _pack(face: str, i: str, j: str, level: int | str) -> str:
    return f"(({face} * 32L + {level}) * {_SPAN}L + {i}) * {_SPAN}L + {j}"


def pack(level: int | str, face: str = "face", i: str = "i", j: str = "j") -> Column:
    """face, i, j as one bigint; cells of different levels never collide. ``level`` may be a column's name."""
    return F.expr(_pack(face, i, j, level))


def unpacked(cell: str) -> list[str]:
    """SQL for face, level, i and j of a packed cell."""
    top = f"{cell} div {_SPAN * _SPAN}"
    return [f"{top} div 32 AS face", f"cast({top} % 32 AS int) AS level", f"{cell} div {_SPAN} % {_SPAN} AS i", f"{cell} % {_SPAN} AS j"]


def half_angle_sql(level: str) -> str:
    """``half_angle`` of a column of levels."""
    return f"(2 * atan({math.sqrt(0.5)!r}D / shiftleft(1L, {level})))"


def cell_id(prefix: str, level: int) -> Column:
    """Packed cell holding a point."""
    side = 1 << level
    x, y, z = (prefix + a for a in "xyz")

    def on(face: int, out: str, p: str, q: str) -> str:
        # +1 falls on the last cell, not past it.
        step = f"least(floor(({{}} / abs({out}) + 1) * {side / 2}D), {side - 1}L)"
        return _pack(f"if({out} > 0, {face}, {face + 1})", step.format(p), step.format(q), level)

    return F.expr(
        f"CASE WHEN abs({x}) >= abs({y}) AND abs({x}) >= abs({z}) THEN {on(0, x, y, z)}"
        f" WHEN abs({y}) >= abs({z}) THEN {on(2, y, x, z)} ELSE {on(4, z, x, y)} END"
    )


def centre(level: int | str) -> tuple[str, str, str]:
    """SQL for the unit vector through the centre of cell (face, i, j); ``level`` may be a column's name."""
    side = f"shiftleft(1L, {level})" if isinstance(level, str) else f"{float(1 << level)}D"
    u, v = f"((2 * i + 1) / {side} - 1)", f"((2 * j + 1) / {side} - 1)"
    sign = "(1 - 2 * (face % 2))"
    length = f"sqrt(1 + {u} * {u} + {v} * {v})"
    return (
        f"if(face < 2, {sign}, {u}) / {length}",
        f"CASE WHEN face < 2 THEN {u} WHEN face < 4 THEN {sign} ELSE {v} END / {length}",
        f"if(face < 4, {v}, {sign}) / {length}",
    )


def with_all_cells(df: DataFrame, level: int) -> DataFrame:
    """Each row once per cell of a level; columns face, i, j."""
    side = 1 << level
    return df.selectExpr("*", f"explode(sequence(0L, {FACES * side * side - 1}L)) AS _n").selectExpr(
        *df.columns, f"_n div {side * side} AS face", f"_n div {side} % {side} AS i", f"_n % {side} AS j"
    )


def fine_cell(prefix: str) -> list[Column]:
    """face, i, j of the finest cell holding a point; shifting i and j gives its coarser ones."""
    x, y, z = (prefix + a for a in "xyz")
    tests = f"CASE WHEN abs({x}) >= abs({y}) AND abs({x}) >= abs({z}) THEN {{}} WHEN abs({y}) >= abs({z}) THEN {{}} ELSE {{}} END"
    face = tests.format(*(f"if({a} > 0, {f}L, {f + 1}L)" for f, a in ((0, x), (2, y), (4, z))))

    def step(p: str, out: str) -> str:
        return f"least(floor(({p} / abs({out}) + 1) * {_SPAN / 2}D), {_SPAN - 1}L)"

    i = tests.format(step(y, x), step(x, y), step(x, z))
    j = tests.format(step(z, x), step(z, y), step(y, z))
    return [F.expr(e).alias(name) for e, name in ((face, "face"), (i, "i"), (j, "j"))]


def coarser(levels: str) -> tuple[str, str]:
    """SQL for i and j of the cell at level ``levels`` around the finest cell (i, j)."""
    return f"shiftright(i, {MAX_LEVEL} - {levels})", f"shiftright(j, {MAX_LEVEL} - {levels})"


def with_child_cells(df: DataFrame, levels: int = 1) -> DataFrame:
    """Each row once per cell ``levels`` below its own."""
    rest = [c for c in df.columns if c not in ("i", "j")]
    side = 1 << levels
    return df.selectExpr("*", f"explode(sequence(0L, {side * side - 1}L)) AS _n").selectExpr(
        *rest, f"i * {side} + _n div {side} AS i", f"j * {side} + _n % {side} AS j"
    )


def level_for_radius(radius: float) -> int:
    """Level whose cells are about as wide as ``radius`` (radians)."""
    if radius <= 0:
        return MAX_LEVEL
    return max(0, min(MAX_LEVEL, round(math.log2(2 / radius))))


def with_cover(df: DataFrame, prefix: str, radius: float) -> DataFrame:
    """Each row once per cell that meets the cap of ``radius`` around its point.

    One narrow pass, ten to fifty cells a row at any radius. Adds ``cell``.
    """
    return _covered(df, prefix, f"{radius!r}D", str(level_for_radius(radius)))


def with_near_cells(df: DataFrame, prefix: str, radius: str, level: str) -> DataFrame:
    """The same for columns of radii and of levels of cells."""
    return _covered(df, prefix, radius, level)


def _covered(df: DataFrame, prefix: str, radius: str, level: str) -> DataFrame:
    """On a face the cap spans a range of angles in each direction; the cells of
    that box are listed and those out of reach dropped."""
    faces = ", ".join(
        f"named_struct('_face', {face}L, '_d', {out.replace(a := out[-1], prefix + a)},"
        f" '_p', {prefix}{p}, '_q', {prefix}{q})"
        for face, (out, p, q) in enumerate(_AXES)
    )
    rest = [c for c in df.columns if c not in ("face", "i", "j")]
    # Outer explodes: the arrays are never empty, and Spark would otherwise
    # compute each one twice to filter on its size.
    out = (
        df.selectExpr(*rest, f"inline_outer(array({faces}))")
        .withColumnRenamed("_face", "face")
        .filter(f"{_meets_face('_p', '_d', '_q', radius)} AND {_meets_face('_q', '_d', '_p', radius)}")
        .selectExpr("*", f"explode_outer({_steps('_p', '_d', '_q', radius, level)}) AS i")
        .selectExpr("*", f"explode_outer({_steps('_q', '_d', '_p', radius, level)}) AS j")
    )
    reach = f"({radius} + {half_angle_sql(level)} + 1e-9D)"
    dot = " + ".join(f"{c} * {prefix}{a}" for c, a in zip(centre(level), "xyz"))
    # The slack covers rounding in the dot product.
    out = out.filter(f"{reach} >= pi() OR {dot} >= cos({reach}) - 1e-15D")
    return out.select(*rest, pack(level).alias("cell"))


def _spread(axis: str, radius: str) -> str:
    """SQL for the angle a cap spans to each side, seen along ``axis``.

    That is asin(sin(radius) / cos(latitude over the axis)), or everything if
    the cap holds the axis.
    """
    width = f"sqrt(greatest(0D, 1 - {axis} * {axis}))"
    narrow = f"{radius} < pi() / 2 AND sin({radius}) < {width}"
    return f"if({narrow}, asin(sin({radius}) / {width}) + 1e-9D, pi())"


def _meets_face(t: str, out: str, axis: str, radius: str) -> str:
    """A face spans 45 degrees to each side, the cap's centre lies at atan2(t, out)."""
    return f"abs(atan2({t}, {out})) <= pi() / 4 + {_spread(axis, radius)}"


def _steps(t: str, out: str, axis: str, radius: str, level: str) -> str:
    """SQL for the cell numbers a cap spans along one direction of a face it meets."""
    side = f"shiftleft(1L, {level})"

    def step(sign: str) -> str:
        angle = f"atan2({t}, {out}) {sign} {_spread(axis, radius)}"
        angle = f"greatest(least({angle}, pi() / 4), -pi() / 4)"
        n = f"floor((tan({angle}) + 1) * ({side} / 2))"
        return f"greatest(0L, least({n}, {side} - 1))"

    return f"sequence({step('-')}, {step('+')})"
