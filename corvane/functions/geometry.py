"""Boxes, tiles and polygons as expressions over columns and arrays."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

POINT = "struct<x:double,y:double>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), value evaluated once."""
    return F.transform(F.array(value), body).getItem(0)


def box_area(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.greatest(F.lit(0), x2 - x1) * F.greatest(F.lit(0), y2 - y1)


def intersection(a: tuple[Column, ...], b: tuple[Column, ...]) -> Column:
    w = F.least(a[2], b[2]) - F.greatest(a[0], b[0])
    h = F.least(a[3], b[3]) - F.greatest(a[1], b[1])
    return F.greatest(F.lit(0), w) * F.greatest(F.lit(0), h)


def iou(a: tuple[Column, ...], b: tuple[Column, ...]) -> Column:
    """Intersection over union in double; 0 where the union is not positive."""
    i = intersection(a, b).cast("double")
    u = box_area(*a).cast("double") + box_area(*b).cast("double") - i
    return F.when(u > 0, i / u).otherwise(F.lit(0.0))


def tile_step(size: Column, overlap: Column) -> Column:
    return F.greatest(F.lit(1), F.rint(size * (1 - overlap)).cast("int"))


def axis_starts(length: Column, size: Column, step: Column) -> Column:
    return F.when(length <= size, F.array(F.lit(0))).otherwise(F.array_distinct(F.concat(F.sequence(F.lit(0), F.greatest(length - size, F.lit(0)), step), F.array(length - size))))


def tile_windows(width: Column, height: Column, size: Column, overlap: Column) -> Column:
    """array<struct<x0,y0,x1,y1>>, rows first, clipped to the extent."""
    step = tile_step(size, overlap)
    xs, ys = axis_starts(width, size, step), axis_starts(height, size, step)
    return F.flatten(F.transform(ys, lambda y: F.transform(xs, lambda x: F.struct(x.alias("x0"), y.alias("y0"), F.least(x + size, width).alias("x1"), F.least(y + size, height).alias("y1")))))


def points(flat: Column) -> Column:
    """Flat coordinates x, y, x, y, ... as points."""
    return F.transform(F.sequence(F.lit(0), (F.size(flat) / 2).cast("int") - 1), lambda i: F.struct(F.get(flat, 2 * i).alias("x"), F.get(flat, 2 * i + 1).alias("y")))


def points_area(pts: Column) -> Column:
    """Shoelace area; 0 for fewer than three points."""

    def of(p: Column) -> Column:
        n = F.size(p)
        term = lambda acc, i: acc + F.get(p, i)["x"] * F.get(p, (i + 1) % n)["y"] - F.get(p, (i + 1) % n)["x"] * F.get(p, i)["y"]
        return F.when(n < 3, F.lit(0.0)).otherwise(F.abs(F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0.0), term)) / 2)

    return let(pts, of)


def polygon_area(flat: Column) -> Column:
    return points_area(points(flat))


def evens(flat: Column) -> Column:
    return F.filter(flat, lambda _, i: i % 2 == 0)


def odds(flat: Column) -> Column:
    return F.filter(flat, lambda _, i: i % 2 == 1)


def polygon_bbox(flat: Column, width: Column, height: Column) -> Column:
    """struct<x,y,w,h> of the polygon within the extent."""
    within = lambda v, top: F.least(F.greatest(v, F.lit(0.0)), top.cast("double"))
    x0, x1 = within(F.array_min(evens(flat)), width), within(F.array_max(evens(flat)), width)
    y0, y1 = within(F.array_min(odds(flat)), height), within(F.array_max(odds(flat)), height)
    return F.struct(x0.alias("x"), y0.alias("y"), (x1 - x0).alias("w"), (y1 - y0).alias("h"))


def largest_polygon(polygons: Column) -> Column:
    """struct<area,index,polygon> of the largest polygon, the first one on ties."""
    best = F.array_max(F.transform(polygons, lambda p, i: F.struct(polygon_area(p).alias("area"), (-i).alias("back"))))
    return let(best, lambda b: F.struct(b["area"].alias("area"), (-b["back"]).alias("index"), F.get(polygons, -b["back"]).alias("polygon")))


def clip_edge(pts: Column, axis: str, bound: Column, keep_above: bool) -> Column:
    """One pass of polygon clipping: the part of a closed polygon on one side (inclusive) of an axis-parallel line."""
    other = "y" if axis == "x" else "x"
    inside = lambda p: (p[axis] >= bound) if keep_above else (p[axis] <= bound)

    def crossing(a: Column, b: Column) -> Column:
        d = b[axis] - a[axis]
        flat = F.abs(d) < 1e-9
        # A segment parallel to the line keeps the coordinate of its start.
        across = F.when(flat, a[other]).otherwise(a[other] + (bound - a[axis]) / F.when(flat, F.lit(1.0)).otherwise(d) * (b[other] - a[other]))
        cut = {axis: bound.cast("double"), other: across}
        return F.struct(cut["x"].alias("x"), cut["y"].alias("y"))

    def of(p: Column) -> Column:
        def corner(cur: Column, i: Column) -> Column:
            prev = F.when(i == 0, F.get(p, F.size(p) - 1)).otherwise(F.get(p, i - 1))
            here, there = inside(cur), inside(prev)
            return F.when(here & there, F.array(cur)).when(here, F.array(crossing(prev, cur), cur)).when(there, F.array(crossing(prev, cur))).otherwise(F.slice(F.array(cur), 1, 0))

        return F.flatten(F.transform(p, corner))

    return let(pts, of)


def clip_polygon(pts: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """The part of a closed polygon inside a window: left, right, top and bottom edge in turn, then all coordinates held inside."""
    lo, hi = {"x": x0, "y": y0}, {"x": x1, "y": y1}
    for axis in ("x", "y"):
        pts = clip_edge(pts, axis, lo[axis].cast("double"), True)
        pts = clip_edge(pts, axis, hi[axis].cast("double"), False)
    held = lambda q, a: F.least(F.greatest(q[a], lo[a].cast("double")), hi[a].cast("double"))
    return F.transform(pts, lambda q: F.struct(held(q, "x").alias("x"), held(q, "y").alias("y")))


def registered(spark) -> None:
    """The same expressions as SQL functions of the session."""
    spark.sql("create or replace temporary function hamming(a bigint, b bigint) returns int return cast(bit_count(a ^ b) as int)")
    spark.sql(
        "create or replace temporary function box_iou(ax1 double, ay1 double, ax2 double, ay2 double, bx1 double, by1 double, bx2 double, by2 double) returns double return "
        "case when greatest(0, ax2-ax1)*greatest(0, ay2-ay1) + greatest(0, bx2-bx1)*greatest(0, by2-by1) - greatest(0, least(ax2,bx2)-greatest(ax1,bx1))*greatest(0, least(ay2,by2)-greatest(ay1,by1)) > 0 "
        "then greatest(0, least(ax2,bx2)-greatest(ax1,bx1))*greatest(0, least(ay2,by2)-greatest(ay1,by1)) / (greatest(0, ax2-ax1)*greatest(0, ay2-ay1) + greatest(0, bx2-bx1)*greatest(0, by2-by1) - greatest(0, least(ax2,bx2)-greatest(ax1,bx1))*greatest(0, least(ay2,by2)-greatest(ay1,by1))) else 0.0d end"
    )
