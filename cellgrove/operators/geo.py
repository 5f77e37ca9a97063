"""Vector geometry as rows: ring edges, segments and points.

Point-in-polygon and distance joins are equi-joins on grid buckets with an exact test behind them, so
they shuffle on a key of many values and never compare all pairs."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .names import free_names


def edges_from_rings(rings: DataFrame, unit: str = "unit_id", ring: str = "ring", points: str = "points") -> DataFrame:
    """unit, ring, seq, x1, y1, x2, y2 of rings given as arrays of (x, y), open or closed. Rings of fewer
    than three distinct points are dropped."""
    p = F.col(points)
    closed = F.when(p[0] == F.element_at(p, -1), p).otherwise(F.concat(p, F.slice(p, 1, 1)))
    ok = rings.where(F.size(F.array_distinct(points)) >= 3).withColumn("__p", closed)
    each = ok.select(unit, ring, F.posexplode(F.arrays_zip(F.slice("__p", F.lit(1), F.size("__p") - 1).alias("a"), F.slice("__p", F.lit(2), F.size("__p") - 1).alias("b"))).alias("seq", "e"))
    return each.select(unit, ring, "seq", F.col("e.a.x").alias("x1"), F.col("e.a.y").alias("y1"), F.col("e.b.x").alias("x2"), F.col("e.b.y").alias("y2"))


def points_in_polygons(points: DataFrame, edges: DataFrame, unit: str, x: str = "x", y: str = "y", band: float = 1.0, border: str = "even-odd") -> DataFrame:
    """(columns of points, unit) for every unit a point is inside, by the even-odd rule.

    A ray to the right crosses an edge if the edge spans the point's y; edges are dealt into horizontal
    bands of height ``band``, points fall into one, so edges meet only points of their own rows. The number
    of crossings is aggregated map-side for each place, not each point: repeated points and further columns are
    joined back. Holes and multi-part units follow from the rule.

    ``border``: what of places exactly on an edge: "even-odd" leaves them to the rule, "intersects" takes all of
    them in, "within" none.
    """
    n = free_names(["unit", "px", "py", "band", "in"], [unit, *points.columns])
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    flat = edges if border != "even-odd" else edges.where("y1 <> y2")
    # edges and places have columns of this function alone until the points come back
    e = flat.select(F.col(unit).alias("unit"), *(F.col(c).alias(f"e{c}") for c in ("x1", "y1", "x2", "y2")), F.explode(F.sequence(F.floor(low / band), F.floor(high / band))).alias("band"))
    places = points.select(F.col(x).alias("px"), F.col(y).alias("py")).where("px is not null and py is not null").distinct()
    x1, y1, x2, y2, px, py = map(F.col, ("ex1", "ey1", "ex2", "ey2", "px", "py"))
    crossing = ((y1 > py) != (y2 > py)) & (px < (x2 - x1) * (py - y1) / F.nullif(y2 - y1, F.lit(0.0)) + x1)
    turn = (x2 - x1) * (py - y1) - (y2 - y1) * (px - x1)
    on = (turn == 0) & px.between(F.least(x1, x2), F.greatest(x1, x2)) & py.between(F.least(y1, y2), F.greatest(y1, y2))
    met = places.withColumn("band", F.floor(py / band)).join(e, "band")
    met = met.where(crossing) if border == "even-odd" else met.where(F.coalesce(crossing, F.lit(False)) | on)
    odd = F.count_if(F.coalesce(crossing, F.lit(False))) % 2 == 1
    inside = {"even-odd": odd, "intersects": odd | F.max(on), "within": odd & ~F.max(on)}[border]
    found = met.groupBy("px", "py", "unit").agg(inside.alias("in")).where("in").select(*(F.col(c).alias(n[c]) for c in ("px", "py", "unit")))
    return points.join(found, (points[x] == F.col(n["px"])) & (points[y] == F.col(n["py"]))).select(*(points[c] for c in points.columns), F.col(n["unit"]).alias(unit))


def cells_in_polygons(cells: DataFrame, edges: DataFrame, unit: str = "unit_id", x0: float = 0.0, y0: float = 0.0, size: float = 1.0) -> DataFrame:
    """(unit, row, col) of the distinct cells whose centre is inside the unit."""
    centres = cells.select("row", "col").distinct().withColumns({"x": F.lit(x0) + (F.col("col") + 0.5) * size, "y": F.lit(y0) + (F.col("row") + 0.5) * size})
    return points_in_polygons(centres, edges, unit, band=size).select(unit, "row", "col")


def squared_distance(px: Column, py: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """From a point to a segment."""
    dx, dy = x2 - x1, y2 - y1
    length = dx * dx + dy * dy
    t = F.when(length == 0, F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((px - x1) * dx + (py - y1) * dy) / F.nullif(length, F.lit(0.0)))))
    ex, ey = px - (x1 + t * dx), py - (y1 + t * dy)
    return ex * ex + ey * ey


def _span(a: str, b: str) -> Column:
    return F.abs(F.col(b) - F.col(a))


def within_distance(points: DataFrame, segments: DataFrame, radius: Column | float, x: str = "x", y: str = "y", bucket: float | None = None) -> DataFrame:
    """All (point, segment) pairs at most ``radius`` apart (a number, or a column of the segments).

    Segments are cut into parts of a bucket's side at most and dealt to every square bucket that the grown
    bounding box of a part touches, points to their own; the join is on the bucket, the exact distance decides. A
    pair is taken where the point meets the part that is nearest to it, so it appears once. ``bucket`` is the radius
    (1, a cell, at least) unless given, and where radii differ the power of two above each: a part touches nine
    buckets or so whatever the radius. A long segment has many parts: where segments share their ends and pairs are
    only summed up, ``by_shape`` goes before.
    """
    n = free_names(["r", "size", "parts", "part", "bx", "by"], [*points.columns, *segments.columns])
    s = segments.withColumn(n["r"], radius if isinstance(radius, Column) else F.lit(float(radius))).where(F.col(n["r"]).isNotNull())
    if bucket is None and isinstance(radius, Column):
        s = s.withColumn(n["size"], F.pow(F.lit(2.0), F.ceil(F.log2(F.greatest(F.col(n["r"]).cast("double"), F.lit(1.0))))))
        # one size for each power of two at most: a few dozen rows
        sizes = [row[0] for row in s.select(n["size"]).distinct().collect()] or [1.0]
    else:
        sizes = [float(bucket or max(float(radius), 1.0))]
        s = s.withColumn(n["size"], F.lit(sizes[0]))
    s = s.withColumn(n["parts"], F.greatest(F.lit(1.0), F.ceil(F.greatest(_span("x1", "x2"), _span("y1", "y2")) / F.col(n["size"])).cast("double")))
    s = s.withColumn(n["part"], F.explode(F.sequence(F.lit(0), F.col(n["parts"]).cast("int") - 1)))
    # a hair more than the radius: the cut points are rounded
    r = F.col(n["r"]) * (1 + 1e-9) + F.col(n["size"]) * 1e-9
    for axis in ("x", "y"):
        a, b = (F.col(f"{axis}1") + (F.col(f"{axis}2") - F.col(f"{axis}1")) * (F.col(n["part"]) + k) / F.col(n["parts"]) for k in (0, 1))
        s = s.withColumn(n[f"b{axis}"], F.explode(F.sequence(F.floor((F.least(a, b) - r) / F.col(n["size"])), F.floor((F.greatest(a, b) + r) / F.col(n["size"])))))
    p = points.withColumn(n["size"], F.explode(F.array(*map(F.lit, sizes))))
    p = p.withColumns({n["bx"]: F.floor(F.col(x) / F.col(n["size"])), n["by"]: F.floor(F.col(y) / F.col(n["size"]))})
    near = squared_distance(F.col(x), F.col(y), F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2")) <= F.col(n["r"]) * F.col(n["r"])
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    along = F.coalesce(((F.col(x) - F.col("x1")) * dx + (F.col(y) - F.col("y1")) * dy) / F.nullif(dx * dx + dy * dy, F.lit(0.0)), F.lit(0.0))
    own = F.greatest(F.lit(0.0), F.least(F.col(n["parts"]) - 1, F.floor(along * F.col(n["parts"])).cast("double")))
    return p.join(s, [n["size"], n["bx"], n["by"]]).where(near & (F.col(n["part"]) == own)).drop(n["size"], n["bx"], n["by"], n["r"], n["part"], n["parts"])


def by_shape(segments: DataFrame, *more: str, **figures: Column) -> DataFrame:
    """x1, y1, x2, y2, ``more`` columns that tell shapes apart, and ``figures``, aggregates of a shape's segments: one row
    for each shape, so that a distance join meets it once, however many segments have it."""
    ends = ["x1", "y1", "x2", "y2", *more]
    return segments.groupBy(*ends).agg(*(c.alias(n) for n, c in figures.items())) if figures else segments.select(*ends).distinct()


def near_any(points: DataFrame, segments: DataFrame, radius: Column | float, **how) -> DataFrame:
    """The points with a segment within the radius, each once (a dissolved buffer)."""
    n = free_names(["r"], [*points.columns, *segments.columns])["r"]
    shapes = by_shape(segments.withColumn(n, radius if isinstance(radius, Column) else F.lit(float(radius))), n)
    return within_distance(points, shapes, F.col(n) if isinstance(radius, Column) else radius, **how).select(*points.columns).distinct()


def bounds(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Bounding box of edges or segments (x1, y1, x2, y2)."""
    return df.groupBy(*(by or [])).agg(F.min(F.least("x1", "x2")).alias("x_min"), F.min(F.least("y1", "y2")).alias("y_min"), F.max(F.greatest("x1", "x2")).alias("x_max"), F.max(F.greatest("y1", "y2")).alias("y_max"))


def overlaps(a: str, b: str) -> Column:
    """Strict overlap of two boxes (columns prefixed a, b): boxes that only touch don't overlap."""
    c = lambda p, n: F.col(f"{p}{n}")
    return (c(a, "x_min") < c(b, "x_max")) & (c(a, "x_max") > c(b, "x_min")) & (c(a, "y_min") < c(b, "y_max")) & (c(a, "y_max") > c(b, "y_min"))


def area_and_centroid(edges: DataFrame, unit: str = "unit_id", ring: str = "ring") -> DataFrame:
    """Shoelace area and centroid per unit. Rings may run either way round: one whose first corner lies inside an
    odd number of the unit's other rings is a hole and is taken off."""
    cross = F.col("x1") * F.col("y2") - F.col("x2") * F.col("y1")
    one = edges.groupBy(unit, ring).agg(F.sum(cross).alias("__a"), F.sum((F.col("x1") + F.col("x2")) * cross).alias("__x"), F.sum((F.col("y1") + F.col("y2")) * cross).alias("__y"), F.min_by(F.struct("x1", "y1"), "seq").alias("__p"))
    # the rings of one unit meet through its key only, as corners against edges
    other = edges.select(F.col(unit).alias("__u"), F.col(ring).alias("__ring"), F.col("x1").alias("__x1"), F.col("y1").alias("__y1"), F.col("x2").alias("__x2"), F.col("y2").alias("__y2")).where("__y1 <> __y2")
    several = one.join(one.groupBy(unit).agg(F.count("*").alias("__rings")).where("__rings > 1"), unit)
    py, px = F.col("__p.y1"), F.col("__p.x1")
    crossing = ((F.col("__y1") > py) != (F.col("__y2") > py)) & (px < (F.col("__x2") - F.col("__x1")) * (py - F.col("__y1")) / (F.col("__y2") - F.col("__y1")) + F.col("__x1"))
    n = several.join(other, (F.col(unit) == F.col("__u")) & (F.col(ring) != F.col("__ring")) & crossing).groupBy(unit, ring).agg(F.count("*").alias("__n"))
    signed = one.join(n, [unit, ring], "left").withColumn("__s", F.signum("__a") * F.when(F.col("__n") % 2 == 1, -1).otherwise(1))
    s = signed.groupBy(unit).agg(*(F.sum(F.col(c) * F.col("__s")).alias(c) for c in ("__a", "__x", "__y")))
    return s.select(unit, F.abs(F.col("__a") / 2).alias("area"), F.try_divide(F.col("__x"), 3 * F.col("__a")).alias("cx"), F.try_divide(F.col("__y"), 3 * F.col("__a")).alias("cy"))


def exists_near(units: DataFrame, cell_zone: DataFrame, near: DataFrame, unit: str = "unit_id") -> DataFrame:
    """Units with at least one cell near a feature."""
    return units.join(cell_zone.join(near.select("row", "col"), ["row", "col"], "left_semi").select(unit), unit, "left_semi")


def _simplify(x: list[float], y: list[float], tolerance: float) -> list[int]:
    """Indices that Douglas-Peucker keeps, by an explicit stack."""
    keep, stack = {0, len(x) - 1}, [(0, len(x) - 1)]
    while stack:
        a, b = stack.pop()
        dx, dy = x[b] - x[a], y[b] - y[a]
        norm = (dx * dx + dy * dy) ** 0.5
        best, at = tolerance, -1
        for i in range(a + 1, b):
            d = abs(dx * (y[i] - y[a]) - dy * (x[i] - x[a])) / norm if norm else ((x[i] - x[a]) ** 2 + (y[i] - y[a]) ** 2) ** 0.5
            if d > best:
                best, at = d, i
        if at >= 0:
            keep.add(at)
            stack += [(a, at), (at, b)]
    return sorted(keep)


def simplify_rings(rings: DataFrame, tolerance: float, points: str = "points") -> DataFrame:
    """Rings (arrays of (x, y)) with vertices closer than the tolerance to their chord left out. A ring of
    fewer than four remaining points keeps its own."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for ps in pdf[points]:
                xs, ys = [p["x"] for p in ps], [p["y"] for p in ps]
                kept = _simplify(xs, ys, tolerance) if len(ps) > 4 else range(len(ps))
                out.append([dict(x=xs[i], y=ys[i]) for i in (kept if len(kept) >= 4 else range(len(ps)))])
            yield pdf.assign(**{points: out})

    return rings.mapInPandas(run, rings.schema)


def _arcs(ps: list[tuple[float, float]], junctions: list[int]) -> Iterator[list[int]]:
    """Indices of the arcs of an open ring between junctions, each from its smaller end."""
    n = len(ps)
    cuts = sorted(junctions) or [min(range(n), key=ps.__getitem__)]
    if len(cuts) == 1:  # a ring of one arc is cut again at the point farthest from its start
        a = ps[cuts[0]]
        cuts = sorted({cuts[0], max(range(n), key=lambda i: ((ps[i][0] - a[0]) ** 2 + (ps[i][1] - a[1]) ** 2, ps[i]))})
    for a, b in zip(cuts, [*cuts[1:], cuts[0] + n], strict=True):
        at = [i % n for i in range(a, b + 1)]
        if ps[at[-1]] < ps[at[0]] or (ps[at[-1]] == ps[at[0]] and ps[at[-2]] < ps[at[1]]):
            at.reverse()
        yield at


def _simplify_arcs(ps: list[tuple[float, float]], junctions: list[int], tolerance: float) -> list[int]:
    """Indices kept of an open ring: every arc between junctions for itself, seen from its smaller end."""
    keep = set()
    for at in _arcs(ps, junctions):
        keep.update(at[i] for i in _simplify([ps[i][0] for i in at], [ps[i][1] for i in at], tolerance))
    return sorted(keep)


def _with_joints(rings: DataFrame, keys: tuple[str, ...], points: str) -> DataFrame:
    """Rings without a closing point, and the places (__joints) of points where more than two lines meet."""
    p = F.col(points)
    opened = rings.withColumn(points, F.when((F.size(p) > 1) & (p[0] == F.element_at(p, -1)), F.slice(p, F.lit(1), F.size(p) - 1)).otherwise(p))
    n = F.size(points)
    at = lambda i: F.try_element_at(F.col(points), F.pmod(i, n) + 1)
    corners = opened.select(*keys, points, F.posexplode(points).alias("__i", "__p")).select(*keys, "__i", "__p", F.explode(F.array(at(F.col("__i") - 1), at(F.col("__i") + 1))).alias("__beside"))
    # a handful of lines meet in a point
    joints = corners.groupBy("__p").agg(F.count_distinct("__beside").alias("__n")).where("__n > 2").select("__p")
    own = corners.join(joints, "__p", "left_semi").groupBy(*keys).agg(F.collect_set("__i").alias("__joints"))
    return opened.join(own, list(keys), "left").select(*rings.columns, "__joints")


def simplify_shared(rings: DataFrame, tolerance: float, keys: tuple[str, ...] = ("unit_id", "ring"), points: str = "points") -> DataFrame:
    """The same for rings that share borders: neighbours keep the same points of a common border, so no gaps open.

    Points where more than two lines meet stay; between them a border is simplified from the same end by whoever has
    it. ``keys`` name a ring. A ring of fewer than three remaining points keeps its own."""
    each = _with_joints(rings, keys, points)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for ps, joints in zip(pdf[points], pdf["__joints"], strict=True):
                xy = [(q["x"], q["y"]) for q in ps]
                kept = _simplify_arcs(xy, [] if joints is None else [int(i) for i in joints], tolerance) if len(xy) > 3 else range(len(xy))
                out.append([dict(x=xy[i][0], y=xy[i][1]) for i in (kept if len(kept) >= 3 else range(len(xy)))])
            yield pdf.drop(columns="__joints").assign(**{points: out})

    return each.mapInPandas(run, rings.schema)


def _importance(x: list[float], y: list[float]) -> list[float]:
    """For each point of a line the tolerance from which on Douglas-Peucker leaves it out; the ends never go. A point
    goes with those that it was found between at the latest, so what a greater tolerance keeps a smaller one keeps too."""
    out, stack = [float("inf")] * len(x), [(0, len(x) - 1, float("inf"))]
    while stack:
        a, b, most = stack.pop()
        dx, dy = x[b] - x[a], y[b] - y[a]
        norm = (dx * dx + dy * dy) ** 0.5
        best, at = -1.0, -1
        for i in range(a + 1, b):
            d = abs(dx * (y[i] - y[a]) - dy * (x[i] - x[a])) / norm if norm else ((x[i] - x[a]) ** 2 + (y[i] - y[a]) ** 2) ** 0.5
            if d > best:
                best, at = d, i
        if at >= 0:
            out[at] = most = min(best, most)
            stack += [(a, at, most), (at, b, most)]
    return out


def vertex_tolerances(rings: DataFrame, keys: tuple[str, ...] = ("unit_id", "ring"), points: str = "points") -> DataFrame:
    """keys, place, x, y, goes: the tolerance from which on ``simplify_shared`` leaves a vertex out. Computed once, it gives
    every simplification: a vertex stays where ``goes`` is greater. Neighbours agree on the vertices of a shared border.
    The three of a ring that go last never go."""
    each = _with_joints(rings, keys, points)
    kinds = ", ".join(f"`{k}` {rings.schema[k].dataType.simpleString()}" for k in keys)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.to_dict("records"):
                ps = [(q["x"], q["y"]) for q in r[points]]
                joints = [] if r["__joints"] is None else [int(i) for i in r["__joints"]]
                goes = [float("inf")] * len(ps)
                if len(ps) > 3:
                    for at in _arcs(ps, joints):
                        for i, t in zip(at, _importance([ps[i][0] for i in at], [ps[i][1] for i in at]), strict=True):
                            goes[i] = t
                    for i in sorted(range(len(ps)), key=lambda i: (-goes[i], i))[:3]:
                        goes[i] = float("inf")
                yield pd.DataFrame({**{k: [r[k]] * len(ps) for k in keys}, "place": range(len(ps)), "x": [p[0] for p in ps], "y": [p[1] for p in ps], "goes": goes})

    return each.mapInPandas(run, f"{kinds}, place int, x double, y double, goes double")


def _layer_cut(sized: DataFrame, budget: int, ranges: int = 1024) -> float:
    """The greatest tolerance whose vertices are the first too many, from above; 0 if all fit. Bytes are summed in ranges
    of tolerances, a fixed number of rows, and again within the range that the budget ends in."""
    fixed = F.sum(F.when(F.col("goes") == float("inf"), F.col("__bytes")))
    low, high, above = sized.agg(F.min(F.when(F.col("goes") < float("inf"), F.col("goes"))), F.max(F.when(F.col("goes") < float("inf"), F.col("goes"))), fixed).first()
    above = above or 0
    while low is not None:
        place = F.lit(0) if low == high else F.least(F.floor((F.col("goes") - low) / (high - low) * ranges), F.lit(ranges - 1))
        found = sized.where(F.col("goes").between(low, high)).groupBy(place.alias("range")).agg(F.sum("__bytes").alias("n"), F.min("goes").alias("low"), F.max("goes").alias("high")).collect()
        low = None
        for r in sorted(found, key=lambda r: -r.range):
            if above + r.n > budget:
                if r.low == r.high:
                    return r.low
                low, high = r.low, r.high
                break
            above += r.n
    return 0.0


def simplify_to_budget(vertices: DataFrame, budget: int, of: list[str], keys: tuple[str, ...] = ("unit_id", "ring"), digits: int = 6) -> DataFrame:
    """keys, tolerance, points: rings of ``vertex_tolerances`` at the smallest tolerance at which all coordinates of one
    value of ``of`` take at most ``budget`` bytes as text (``[x,y],`` with so many digits after the point). With an empty
    ``of`` the whole layer has one tolerance, and shared borders stay shared. Vertices that never go stay beyond a budget
    too."""
    size = F.length(F.format_string(f"[%.{digits}f,%.{digits}f],", "x", "y"))
    sized = vertices.withColumn("__bytes", size)
    if of:
        # a feature's tolerances in order, from above: what goes later weighs on all smaller ones
        upto = F.sum("__bytes").over(Window.partitionBy(*of).orderBy(F.col("goes").desc()))
        over = sized.groupBy(*of, "goes").agg(F.sum("__bytes").alias("__bytes")).withColumn("__over", (upto > budget) & (F.col("goes") < float("inf")))
        cut = over.groupBy(*of).agg(F.coalesce(F.max(F.when(F.col("__over"), F.col("goes"))), F.lit(0.0)).alias("tolerance"))
        kept = vertices.join(cut, of)
    else:
        kept = vertices.withColumn("tolerance", F.lit(_layer_cut(sized, budget)))
    p = F.sort_array(F.collect_list(F.struct("place", "x", "y")))
    rings = kept.where("goes > tolerance").groupBy(*keys, "tolerance").agg(F.transform(p, lambda q: F.struct(q.x.alias("x"), q.y.alias("y"))).alias("points"))
    return rings.select(*keys, "tolerance", "points")


def first_by(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("__n = 1").drop("__n")
