"""Polygon overlay, dissolve, repair and buffers, by sweeping horizontal slabs.

Edges are dealt into horizontal bands by key; a task cuts a band at every corner and crossing, so that no two edges
meet within a slab. There the edges have an order, and what lies between two of them is a trapezoid that is inside or
outside as a whole. The sides of the trapezoids that are inside, joined again along their edges, are the result: rows
``by``, side, x1, y1 (lower end), x2, y2 (upper end), left (whether the inside is to the right of it), low and high
(its place among the sides beside its lower and its upper end). They are edges
like any others for the even-odd rule; areas are sums over them, and ``rings`` chains them.

All sides that end at one height of one key are matched in pairs in order of x: between two matched ends exactly one of
below and above is inside, so the line between them is border too. That makes every side the successor of one other,
and pointer jumping, a join a round, finds the rings and the places of sides in them, however long they are.

Defined results: edges with a null coordinate and flat edges are left out (flat borders come back in rings);
coincident edges cancel or join exactly; points where rings touch part them; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources import Workspace, stored
from .names import free_names

#: What is inside, by the number of layers that hold a place: any of them, both of two, or the first without the second.
RULES = ("any", "both", "minus")
#: Edges whose pairs are tested for crossings at once.
LOT = 512


def _crossings(e: np.ndarray, low: float, high: float) -> np.ndarray:
    """Heights at which two of the edges (x1, y1, x2, y2, from low to high) cross between ``low`` and ``high``."""
    found = [np.zeros(0)]
    left, right = np.minimum(e[:, 0], e[:, 2]), np.maximum(e[:, 0], e[:, 2])
    slope = (e[:, 2] - e[:, 0]) / (e[:, 3] - e[:, 1])
    base = e[:, 0] - slope * e[:, 1]
    for a in range(0, len(e), LOT):
        b = slice(a, a + LOT)
        beside = (left[b, None] <= right[None]) & (left[None] <= right[b, None]) & (e[b, 1, None] < e[None, :, 3]) & (e[None, :, 1] < e[b, 3, None])
        i, j = np.nonzero(beside & (np.arange(len(e))[None] > np.arange(a, min(a + LOT, len(e)))[:, None]))
        i += a
        apart = slope[i] - slope[j]
        i, j, apart = i[apart != 0], j[apart != 0], apart[apart != 0]
        y = (base[j] - base[i]) / apart
        found.append(y[(y > np.maximum(e[i, 1], e[j, 1])) & (y < np.minimum(e[i, 3], e[j, 3])) & (y > low) & (y < high)])
    return np.concatenate(found)


def _at(e: np.ndarray, y: np.ndarray) -> np.ndarray:
    """x of edges at heights, exact at their ends."""
    x = e[:, 0] + (y - e[:, 1]) * ((e[:, 2] - e[:, 0]) / (e[:, 3] - e[:, 1]))
    return np.where(y == e[:, 1], e[:, 0], np.where(y == e[:, 3], e[:, 2], x))


def sweep(edges: np.ndarray, layer: np.ndarray, rule: str, low: float, high: float, eps: float) -> np.ndarray:
    """Sides (x1, y1, x2, y2, left, order among the sides of the lowest and of the highest slab) of what is inside between
    two heights. ``layer``: the layer's number from 0 of each
    edge (x1, y1, x2, y2); a layer holds a place by the even-odd rule."""
    flip = edges[:, 1] > edges[:, 3]
    e = np.where(flip[:, None], edges[:, [2, 3, 0, 1]], edges)
    keep = (e[:, 1] < e[:, 3]) & (e[:, 3] > low) & (e[:, 1] < high)
    e, layer = e[keep], layer[keep]
    if not len(e):
        return np.zeros((0, 7))
    heights = np.unique(np.concatenate([np.clip(e[:, [1, 3]].ravel(), low, high), _crossings(e, low, high)]))
    begin, end = np.searchsorted(heights, np.maximum(e[:, 1], low)), np.searchsorted(heights, np.minimum(e[:, 3], high))
    n = end - begin
    own = np.repeat(np.arange(len(e)), n)
    slab = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + begin[own]
    x = _at(e[own], (heights[slab] + heights[slab + 1]) / 2)
    # in or out of its own layer: every other edge of a layer enters it
    order = np.lexsort((x, layer[own], slab))
    new = np.ones(len(order), bool)
    s, f = slab[order], layer[own][order]
    new[1:] = (s[1:] != s[:-1]) | (f[1:] != f[:-1])
    place = np.arange(len(order)) - np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    step = np.empty(len(order), np.int64)
    step[order] = np.where(place % 2 == 0, 1, -1)
    if rule == "minus":
        step = np.where(layer[own] == 0, step, -2 * step)
    order = np.lexsort((x, slab))
    own, slab, x, step = own[order], slab[order], x[order], step[order]
    total = np.cumsum(step)  # each slab ends at 0
    inside = total >= 1 if rule == "any" else total == (2 if rule == "both" else 1)
    # edges that coincide count together
    last = np.ones(len(x), bool)
    last[:-1] = (slab[1:] != slab[:-1]) | (x[1:] - x[:-1] > eps)
    own, slab, inside = own[last], slab[last], inside[last]
    before = np.append(False, inside[:-1]) & np.append(False, slab[1:] == slab[:-1])
    turn = inside != before
    own, slab, left = own[turn], slab[turn], inside[turn]
    # one side for as long as an edge stays one
    rank = np.lexsort((slab, left, own))
    own, slab, left = own[rank], slab[rank], left[rank]
    first = np.ones(len(own), bool)
    first[1:] = (own[1:] != own[:-1]) | (left[1:] != left[:-1]) | (slab[1:] != slab[:-1] + 1)
    a = np.flatnonzero(first)
    b = np.append(a[1:], len(own)) - 1 if len(a) else a
    y1, y2 = heights[slab[a]], heights[slab[b] + 1]
    return np.column_stack([_at(e[own[a]], y1), y1, _at(e[own[a]], y2), y2, left[a], rank[a], rank[b]])


def sides(edges: DataFrame, by: list[str], layer: str | None = None, rule: str = "any", band: float = 1.0, eps: float = 1e-9) -> DataFrame:
    """Sides of what is inside, for each key. Edges (x1, y1, x2, y2) of one value of ``layer`` are one even-odd figure;
    without a layer all edges of a key are. For "both" and "minus" the layers are 0 and 1. ``band`` bounds what a task
    holds: the edges of one key between two multiples of it."""
    if rule not in RULES:
        raise ValueError(f"rule is one of {RULES}")
    xy = ["x1", "y1", "x2", "y2"]
    inner = free_names(["band", "layer", "side", "left"], by)
    e = edges.select(*by, *(F.col(c).cast("double").alias(c) for c in xy), (F.col(layer) if layer else F.lit(0)).alias(inner["layer"])).dropna(subset=xy).where("y1 <> y2")
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    e = e.withColumn(inner["band"], F.explode(F.sequence(F.floor(low / band), F.ceil(high / band) - 1)))
    kinds = {c: edges.schema[c].dataType.simpleString() for c in by}
    keys = [*by, inner["band"]]

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        code = pdf[inner["layer"]].to_numpy() if rule != "any" else pd.factorize(pdf[inner["layer"]])[0]
        return _rows(pdf[xy].to_numpy(), code.astype(np.int64), rule, int(key[-1]), band, eps, dict(zip(by, key, strict=False)))

    return e.groupBy(*keys).applyInPandas(run, _schema(kinds))


def _schema(by: dict[str, str]) -> str:
    return ", ".join([*(f"`{c}` {kind}" for c, kind in by.items()), "side string, x1 double, y1 double, x2 double, y2 double, left boolean, low long, high long"])


def _rows(edges: np.ndarray, layer: np.ndarray, rule: str, k: int, band: float, eps: float, by: dict) -> pd.DataFrame:
    found = sweep(edges, layer, rule, k * band, (k + 1) * band, eps)
    n = len(found)
    own = {c: np.array([v] * n, object) for c, v in by.items()} | {"side": np.array([f"{k}.{i}" for i in range(n)], object)}
    columns = {c: found[:, i] for i, c in enumerate(("x1", "y1", "x2", "y2"))}
    return pd.DataFrame(own | columns | {"left": found[:, 4] > 0, "low": found[:, 5].astype(np.int64), "high": found[:, 6].astype(np.int64)})


def overlay(a: DataFrame, b: DataFrame, a_unit: str, b_unit: str, rule: str = "both", band: float = 1.0) -> DataFrame:
    """Sides of the overlap (or of a without b) of every pair of units whose boxes overlap in some band, by a_unit and
    b_unit. Only such pairs meet: boxes are dealt into bands, one row for each unit and band."""
    xy, low, high = ["x1", "y1", "x2", "y2"], F.least("y1", "y2"), F.greatest("y1", "y2")

    def dealt(df: DataFrame, unit: str) -> DataFrame:
        e = df.select(F.col(unit).alias("unit"), *xy).dropna(subset=xy).where("y1 <> y2")
        return e.withColumn("band", F.explode(F.sequence(F.floor(low / band), F.ceil(high / band) - 1)))

    one, two = dealt(a, a_unit), dealt(b, b_unit)
    box = lambda df, p: df.groupBy("band", F.col("unit").alias(f"{p}unit")).agg(F.min(F.least("x1", "x2")).alias(f"{p}from"), F.max(F.greatest("x1", "x2")).alias(f"{p}to"))
    pairs = box(one, "a_").join(box(two, "b_"), "band").where("a_from < b_to and b_from < a_to").select("band", "a_unit", "b_unit")
    met = [e.withColumnRenamed("unit", f"{p}unit").join(pairs, ["band", f"{p}unit"]).select("a_unit", "b_unit", "band", *xy, F.lit(k).alias("layer")) for k, (e, p) in enumerate(((one, "a_"), (two, "b_")))]
    # an edge comes once for each band of the pair; cut to the band it isn't dealt again
    cut = met[0].unionByName(met[1])
    kinds = {"a_unit": a.schema[a_unit].dataType.simpleString(), "b_unit": b.schema[b_unit].dataType.simpleString()}

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        return _rows(pdf[xy].to_numpy(float), pdf["layer"].to_numpy(), rule, int(key[-1]), band, 1e-9, {"a_unit": key[0], "b_unit": key[1]})

    return cut.groupBy("a_unit", "b_unit", "band").applyInPandas(run, _schema(kinds)).withColumnsRenamed({"a_unit": a_unit, "b_unit": b_unit if b_unit != a_unit else f"{b_unit}_2"})


def area(by: list[str], sides: DataFrame) -> DataFrame:
    """by, area: right sides less left ones, whose trapezoids to x = 0 have the mean of their ends as width."""
    part = (F.col("x1") + F.col("x2")) / 2 * (F.col("y2") - F.col("y1"))
    return sides.groupBy(*by).agg(F.sum(F.when(F.col("left"), -part).otherwise(part)).alias("area"))


def _successors(sides: DataFrame, by: list[str]) -> DataFrame:
    """by, side, next: sides in the order of a walk with the inside to the left (right sides go up, left ones down)."""
    ends = F.array(
        F.struct(F.col("y1").alias("y"), F.col("x1").alias("x"), F.lit(1).alias("bottom"), F.col("left").alias("arrive"), F.col("low").alias("rank"), (~F.col("left")).alias("right")),
        F.struct(F.col("y2").alias("y"), F.col("x2").alias("x"), F.lit(0).alias("bottom"), (~F.col("left")).alias("arrive"), F.col("high").alias("rank"), (~F.col("left")).alias("right")),
    )
    e = sides.select(*by, "side", F.explode(ends).alias("e")).select(*by, "side", "e.*")
    level = Window.partitionBy(*by, "y")
    # ends from below have the order of their slab, ends from above that of theirs: x is rounded and may not
    e = e.withColumn("x", F.max("x").over(Window.partitionBy(*by, "y", "bottom").orderBy("rank")))
    # where several ends meet, each sector of the inside keeps to itself, so that figures that touch there stay apart:
    # what is open to the left closes first, then pairs from below, then from above, then what stays open to the right
    spot = Window.partitionBy(*by, "y", "bottom", "x")
    e = e.withColumns({"met": F.count("*").over(spot), "i": F.row_number().over(spot.orderBy("rank")), "open": F.first("right").over(spot.orderBy("rank")).cast("int")})
    rest = F.col("met") - F.col("open")
    turn = F.when((F.col("open") == 1) & (F.col("i") == 1), 0).when((rest % 2 == 1) & (F.col("i") == F.col("met")), 3).otherwise(1 + F.col("bottom"))
    n = F.row_number().over(level.orderBy("x", turn, "bottom", "rank"))
    e = e.withColumn("pair", F.floor((n - 1) / 2))
    # each pair holds one end where a side is left and one where the next begins
    each = e.groupBy(*by, "y", "pair").agg(F.max(F.when(F.col("arrive"), F.col("side"))).alias("side"), F.max(F.when(~F.col("arrive"), F.col("side"))).alias("next"))
    return each.select(*by, "side", "next")


def rings(sides: DataFrame, by: list[str]) -> DataFrame:
    """by, ring (its least side), hole, points (array of (x, y), closed, the inside to the left) and signed_area of
    ``sides``, written to the shared folder.

    Every round is written; there are as many as the logarithm of the longest ring, and only the last one stays while
    they go on. Corners on straight lines are left out."""
    own, keys = _keyed(sides, by)
    with Workspace(sides.sparkSession) as work:
        return stored(_chained(own, list(keys), work).withColumnsRenamed(keys), "rings")


def _keyed(df: DataFrame, by: list[str]) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with keys of other names than any column here, and what they were called."""
    keys = {f"key_{i}": c for i, c in enumerate(by)}
    return df.withColumnsRenamed({c: k for k, c in keys.items()}), keys


def _chained(sides: DataFrame, by: list[str], work: Workspace) -> DataFrame:
    sides = work.put("sides", sides)
    on = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in by]
    link = work.put("links", _successors(sides, by).withColumns({"ring": F.col("side"), "jump": F.col("next")}))
    # the least side of the next 1, 2, 4, ... sides, until it is the same all around
    while True:
        far = link.select(*by, F.col("side").alias("at"), F.col("ring").alias("theirs"), F.col("jump").alias("beyond"))
        both = link.alias("l").join(far.alias("r"), [*on, F.col("l.jump") == F.col("r.at")])
        out = work.put("links", both.select(*(F.col(f"l.{c}") for c in by), "l.side", "l.next", F.least("l.ring", "r.theirs").alias("ring"), F.col("r.beyond").alias("jump"), (F.col("l.ring") != F.least("l.ring", "r.theirs")).alias("changed")))
        going = out.where("changed").limit(1).count() > 0
        link = out.drop("changed")
        if not going:
            break
    # how many sides are before each, counted back from the ring's first side by doubled jumps
    rank = work.put("ranks", link.select(*by, "side", "ring", F.when(F.col("next") != F.col("ring"), F.col("next")).alias("jump"), F.when(F.col("next") != F.col("ring"), 1).otherwise(0).alias("left_over")))
    while rank.where("jump is not null").limit(1).count() > 0:
        far = rank.select(*by, F.col("side").alias("at"), F.col("jump").alias("beyond"), F.col("left_over").alias("more"))
        both = rank.alias("l").join(far.alias("r"), [*on, F.col("l.jump") == F.col("r.at")], "left")
        rank = work.put("ranks", both.select(*(F.col(f"l.{c}") for c in by), "l.side", "l.ring", F.col("r.beyond").alias("jump"), (F.col("l.left_over") + F.coalesce("r.more", F.lit(0))).alias("left_over")))
    joined = sides.alias("l").join(rank.alias("r"), [*on, F.col("l.side") == F.col("r.side")]).select("l.*", "r.ring", "r.left_over")
    point = lambda k: F.struct(F.col(f"x{k}").alias("x"), F.col(f"y{k}").alias("y"))
    ends = F.when(F.col("left"), F.array(point(2), point(1))).otherwise(F.array(point(1), point(2)))
    each = joined.select(*by, "ring", F.struct((-F.col("left_over")).alias("place"), ends.alias("ends")).alias("s"))
    whole = each.groupBy(*by, "ring").agg(F.flatten(F.transform(F.sort_array(F.collect_list("s")), lambda s: s.ends)).alias("points"))
    # without corners that are met twice or lie on a straight line
    p = F.col("points")
    last = lambda i: F.element_at(p, F.when(i == 0, -1).otherwise(i))
    unlike = F.filter(p, lambda q, i: F.abs(q.x - last(i).x) + F.abs(q.y - last(i).y) > 1e-9)
    whole = whole.withColumn("points", unlike)
    n = F.size("points")
    turn = lambda a, q, b: (q.x - a.x) * (b.y - q.y) - (q.y - a.y) * (b.x - q.x)
    at = lambda i: F.element_at(F.col("points"), F.pmod(i, n).cast("int") + 1)
    corners = F.filter(p, lambda q, i: F.abs(turn(at(i - 1), q, at(i + 1))) > 1e-9 * (F.abs(q.x - at(i - 1).x) + F.abs(q.y - at(i - 1).y)) * (F.abs(at(i + 1).x - q.x) + F.abs(at(i + 1).y - q.y)))
    whole = whole.withColumn("points", corners).where(F.size("points") >= 3)
    doubled = F.aggregate(F.sequence(F.lit(0), F.size("points") - 1), F.lit(0.0), lambda s, i: s + at(i).x * at(i + 1).y - at(i + 1).x * at(i).y)
    return whole.select(*by, "ring", (doubled < 0).alias("hole"), F.concat(p, F.slice(p, 1, 1)).alias("points"), (doubled / 2).alias("signed_area"))


def nested(found: DataFrame, by: list[str], band: float = 1.0) -> DataFrame:
    """``rings`` with ``shell``: the outer ring that a hole is cut from (its own name for an outer ring).

    A hole lies in the smallest outer ring of its key that holds it; holes meet the edges of outer rings by bands."""
    from .geo import edges_from_rings, points_in_polygons

    found, keys = _keyed(found, by)
    name = F.to_json(F.struct(*keys, "ring"))
    outer = found.where("not hole").withColumn("name", name)
    edges = edges_from_rings(outer, "name", "ring")
    # the middle of a hole's first edge, moved into the hole (which a walk keeps to its right) by a hair
    a, b = F.col("points")[0], F.col("points")[1]
    dx, dy = b.x - a.x, b.y - a.y
    hair = 1e-7
    spots = found.where("hole").select(*keys, F.col("ring").alias("inner"), ((a.x + b.x) / 2 + dy * hair).alias("x"), ((a.y + b.y) / 2 - dx * hair).alias("y"))
    held = points_in_polygons(spots, edges, "name", band=band)
    own = outer.select("name", *(F.col(c).alias(f"{c}_outer") for c in keys), F.col("ring").alias("shell"), F.col("signed_area").alias("size"))
    held = held.join(own, "name").where(_all(F.col(c).eqNullSafe(F.col(f"{c}_outer")) for c in keys))
    least = held.groupBy(*keys, F.col("inner").alias("ring")).agg(F.min_by("shell", "size").alias("shell"))
    same = [*(F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in keys), F.col("l.ring") == F.col("r.ring")]
    return found.alias("l").join(least.alias("r"), same, "left").select("l.*", F.when(~F.col("l.hole"), F.col("l.ring")).otherwise(F.col("r.shell")).alias("shell")).withColumnsRenamed(keys)


def _all(conditions) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out


def capsules(segments: DataFrame, radius: Column | float, key: str, quarter: int = 8) -> DataFrame:
    """key, x1, y1, x2, y2: the outline of each segment's buffer, as an even-odd figure: two half circles of
    ``quarter`` chords a quarter, whose corners are on the circle, and the straight lines between them. What is inside is
    within the radius; what is within cos(45 deg / quarter) of it is inside."""
    r = radius if isinstance(radius, Column) else F.lit(float(radius))
    inner = free_names(["r", "turn", "p"], [key])
    s = segments.withColumns({inner["r"]: r, inner["turn"]: F.atan2(F.col("y2") - F.col("y1"), F.col("x2") - F.col("x1"))}).where(F.col(inner["r"]) > 0)
    corner = lambda k, end, base: F.struct((F.col(f"x{end}") + F.col(inner["r"]) * F.cos(F.col(inner["turn"]) + base + k * (F.pi() / (2 * quarter)))).alias("x"), (F.col(f"y{end}") + F.col(inner["r"]) * F.sin(F.col(inner["turn"]) + base + k * (F.pi() / (2 * quarter)))).alias("y"))
    steps = F.sequence(F.lit(0), F.lit(2 * quarter))
    p = F.concat(F.transform(steps, lambda k: corner(k, 2, -F.pi() / 2)), F.transform(steps, lambda k: corner(k, 1, F.pi() / 2)))
    s = s.select(key, p.alias(inner["p"]))
    each = s.select(key, F.explode(F.arrays_zip(F.col(inner["p"]).alias("a"), F.concat(F.slice(inner["p"], F.lit(2), F.size(inner["p"]) - 1), F.slice(inner["p"], 1, 1)).alias("b"))).alias("e"))
    return each.select(key, F.col("e.a.x").alias("x1"), F.col("e.a.y").alias("y1"), F.col("e.b.x").alias("x2"), F.col("e.b.y").alias("y2"))
