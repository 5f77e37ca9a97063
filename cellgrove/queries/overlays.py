"""Exact polygon overlay, dissolve, repair, buffers and ring assembly."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import rnd
from ..operators import geo, grid, planar
from ..sources import vector_tiles
from . import fixtures as fx

query, FUNCTIONS, SQL = fx.collector()

_INSIDE = {"any": "n >= 1", "both": "n = 2", "minus": "n = 1"}


def slabs(source: str, by: str, rule: str, value: str = "sum((nx - x) * (hi - lo))") -> str:
    """SQL: ``value`` (an area) per key of the edges in ``source`` (by, layer, x1, y1, x2, y2), slab by slab between all
    heights at which an edge ends or crosses another."""
    step = "1" if rule != "minus" else "CASE WHEN layer = 0 THEN 1 ELSE -2 END"
    cross = "((b.x1 - b.s * b.y1) - (a.x1 - a.s * a.y1)) / (a.s - b.s)"
    return f""", e0 AS (SELECT {by} AS k, layer, row_number() OVER () AS id, CASE WHEN y1 < y2 THEN x1 ELSE x2 END AS x1, least(y1, y2) AS y1, CASE WHEN y1 < y2 THEN x2 ELSE x1 END AS x2, greatest(y1, y2) AS y2 FROM ({source}) WHERE y1 <> y2),
    e1 AS (SELECT *, (x2 - x1) / (y2 - y1) AS s FROM e0),
    c AS (SELECT a.k, {cross} AS y, greatest(a.y1, b.y1) AS lo, least(a.y2, b.y2) AS hi FROM e1 a JOIN e1 b ON a.k = b.k AND a.id < b.id AND a.s <> b.s AND a.y1 < b.y2 AND b.y1 < a.y2),
    ev AS (SELECT k, y1 AS y FROM e1 UNION SELECT k, y2 FROM e1 UNION SELECT k, y FROM c WHERE y > lo AND y < hi),
    slab AS (SELECT k, y AS lo, lead(y) OVER (PARTITION BY k ORDER BY y) AS hi FROM ev),
    xs AS (SELECT slab.k, lo, hi, layer, x1 + ((lo + hi) / 2 - y1) * s AS x FROM slab JOIN e1 ON slab.k = e1.k AND y1 <= lo AND y2 >= hi),
    st AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY k, lo, layer ORDER BY x) % 2 = 1 THEN 1 ELSE -1 END * {step} AS step FROM xs),
    su AS (SELECT k, lo, hi, x, sum(step) OVER (PARTITION BY k, lo ORDER BY x ROWS UNBOUNDED PRECEDING) AS n, lead(x) OVER (PARTITION BY k, lo ORDER BY x) AS nx FROM st),
    areas AS (SELECT k, {value} AS area FROM su WHERE {_INSIDE[rule]} GROUP BY k)"""


_PAIRS = """SELECT u.unit_id || '/' || p.piece AS pair, 0 AS layer, u.x1, u.y1, u.x2, u.y2 FROM edges u, (SELECT DISTINCT piece FROM isochrones) p
  UNION ALL SELECT u.unit_id || '/' || p.piece, 1, p.x1, p.y1, p.x2, p.y2 FROM isochrones p, (SELECT DISTINCT unit_id FROM edges) u"""
_BY_PAIR = " SELECT split_part(k, '/', 1) AS unit_id, split_part(k, '/', 2) AS piece, round_even(area * 1e6, 0) / 1e6 AS area FROM areas WHERE area > 1e-7"


def _pairs(s, d, rule):
    out = planar.area(["unit_id", "piece"], planar.overlay(fx.edges(s, d), fx.isochrones(s, d), "unit_id", "piece", rule, band=5.0))
    return out.where("area > 1e-7").select("unit_id", "piece", rnd(F.col("area"), 6).alias("area"))


@query("j08_overlay_area", slabs(_PAIRS, "pair", "both") + _BY_PAIR, "edges", "isochrones")
def _(s, d):
    """Area of unit and isochrone, pair by pair."""
    return _pairs(s, d, "both")


_FOUND = "SELECT split_part(piece, ':', 2) AS cutoff, piece AS layer, x1, y1, x2, y2 FROM isochrones"


@query("z13_dissolve_rings", slabs(_FOUND, "cutoff", "any") + " SELECT k AS cutoff, round_even(area * 1e6, 0) / 1e6 AS area FROM areas", "isochrones")
def _(s, d):
    """Isochrones of one cutoff as one figure, in rings: what overlaps counts once."""
    pieces = fx.isochrones(s, d).withColumn("cutoff", F.split("piece", ":")[1])
    whole = planar.rings(planar.sides(pieces, ["cutoff"], "piece", band=5.0), ["cutoff"])
    return whole.groupBy("cutoff").agg(rnd(F.sum("signed_area"), 6).alias("area"))


@query("j08_overlay_of_dissolved", slabs(_FOUND, "cutoff", "any") + " SELECT k AS cutoff, round_even(area * 1e6, 0) / 1e6 AS area FROM areas", "isochrones")
def _(s, d):
    """Overlay of figures that were dissolved before: each cutoff's figure with itself is the figure."""
    pieces = fx.isochrones(s, d).withColumn("cutoff", F.split("piece", ":")[1])
    whole = planar.sides(pieces, ["cutoff"], "piece", band=5.0)
    both = planar.overlay(whole, whole, "cutoff", "cutoff", band=5.0).where("cutoff = cutoff_2")
    return planar.area(["cutoff"], both).select("cutoff", rnd(F.col("area"), 6).alias("area"))


_TIES = "SELECT a.unit_id, 0 AS layer, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2 FROM (SELECT *, ([0, 2, 1, 3])[k + 1] AS i FROM corners) a JOIN (SELECT *, ([0, 2, 1, 3])[k + 1] AS i FROM corners) b ON a.unit_id = b.unit_id AND a.ring = b.ring AND b.i = (a.i + 1) % 4"


@query("p15_repair_rings", slabs(_TIES, "unit_id", "any") + " SELECT k AS unit_id, round_even(area * 1e6, 0) / 1e6 AS area FROM areas", "corners")
def _(s, d):
    """Rings with two corners exchanged cross themselves; repaired they keep their even-odd area."""
    p = F.col("points")
    ties = fx.rings(s, d).withColumn("points", F.array(p[0], p[2], p[1], p[3]))
    fixed = planar.rings(planar.sides(geo.edges_from_rings(ties), ["unit_id"], band=5.0), ["unit_id"])
    return fixed.groupBy("unit_id").agg(rnd(F.sum("signed_area"), 6).alias("area"))


_CORNER = "({x}{e} + 1.5e0 * {f}(turn + {b} * pi() / 2 + {k} * pi() / 8))"


def _capsule_sql() -> str:
    """The outline of each border's buffer: corner i of eighteen, nine around either end."""
    at = lambda axis, f, i: f"CASE WHEN {i} < 9 THEN {_CORNER.format(x=axis, e=2, f=f, b=-1, k=i)} ELSE {_CORNER.format(x=axis, e=1, f=f, b=1, k=f'({i} - 9)')} END"
    j = "((i + 1) % 18)"
    return f"SELECT unit_id, ring || '.' || seq AS layer, {at('x', 'cos', 'i')} AS x1, {at('y', 'sin', 'i')} AS y1, {at('x', 'cos', j)} AS x2, {at('y', 'sin', j)} AS y2 FROM (SELECT *, atan2(y2 - y1, x2 - x1) AS turn FROM edges), range(18) t(i)"


@query("g06_buffer_outline", slabs(_capsule_sql(), "unit_id", "any") + " SELECT k AS unit_id, round_even(area * 1e6, 0) / 1e6 AS area FROM areas", "edges")
def _(s, d):
    """The strip along each unit's border, as rings."""
    borders = fx.edges(s, d).withColumn("part", F.to_json(F.struct("unit_id", "ring", "seq")))
    around = planar.capsules(borders, 1.5, "part", quarter=4).withColumn("unit_id", F.get_json_object("part", "$.unit_id"))
    strips = planar.rings(planar.sides(around, ["unit_id"], "part", band=5.0), ["unit_id"])
    return strips.groupBy("unit_id").agg(rnd(F.sum("signed_area"), 6).alias("area"))


_PATCHES = """, wet AS (SELECT row, col FROM hazard WHERE rp = 100 AND depth > 0.4e0),
comp(row, col, lab) USING KEY (row, col) AS (
  SELECT row, col, row * 1000 + col FROM wet
  UNION
  SELECT n.row, n.col, min(c.lab) FROM comp c JOIN wet n ON abs(n.row - c.row) + abs(n.col - c.col) = 1 JOIN recurring.comp AS o ON o.row = n.row AND o.col = n.col WHERE c.lab < o.lab GROUP BY n.row, n.col)
SELECT count(*) AS cells, CAST(min(col) AS DOUBLE) AS x_min, CAST(min(row) AS DOUBLE) AS y_min, CAST(max(col) + 1 AS DOUBLE) AS x_max, CAST(max(row) + 1 AS DOUBLE) AS y_max FROM comp GROUP BY lab"""


@query("r11_rings")
def _(s, d):
    """Flooded patches as polygons with holes: a row for each outer ring, with the cells it holds less its holes."""
    wet = fx.hazard(s, d).where("rp = 100 and depth > 0.4D").withColumn("value", F.lit(1))
    found = planar.rings(planar.sides(grid.polygonise(wet.select("row", "col", "value")), ["value"], band=4.0), ["value"])
    found = planar.nested(found, ["value"], band=4.0)
    x, y = F.transform("points", lambda p: p.x), F.transform("points", lambda p: p.y)
    box = [F.when(~F.col("hole"), f(c)) for f in (F.array_min, F.array_max) for c in (x, y)]
    out = found.groupBy("shell").agg(F.sum("signed_area").cast("long").alias("cells"), *(F.max(b).alias(n) for b, n in zip(box, ("x_min", "y_min", "x_max", "y_max"), strict=True)))
    return out.drop("shell")


SQL["r11_rings"] = fx.with_sql(_PATCHES, "hazard").replace("WITH ", "WITH RECURSIVE ", 1)


_TILED = """, m AS (SELECT unit_id, zoom, (x1 + 180e0) / 360 * pow(2, zoom) AS x1, (1 - asinh(tan(radians(y1 / 2))) / pi()) / 2 * pow(2, zoom) AS y1,
      (x2 + 180e0) / 360 * pow(2, zoom) AS x2, (1 - asinh(tan(radians(y2 / 2))) / pi()) / 2 * pow(2, zoom) AS y2 FROM edges, (SELECT unnest([2, 4, 6]) AS zoom)),
    reached AS (SELECT unit_id, zoom, tx, ty FROM (SELECT unit_id, zoom, floor(min(least(x1, x2)))::BIGINT AS xa, floor(max(greatest(x1, x2)))::BIGINT AS xb, floor(min(least(y1, y2)))::BIGINT AS ya, floor(max(greatest(y1, y2)))::BIGINT AS yb FROM m GROUP BY unit_id, zoom), LATERAL (SELECT unnest(range(xa, xb + 1)) AS tx), LATERAL (SELECT unnest(range(ya, yb + 1)) AS ty)),
    both_layers AS (SELECT concat_ws('/', zoom, tx, ty, unit_id) AS k4, 0 AS layer, x1, y1, x2, y2 FROM m JOIN reached USING (unit_id, zoom)
      UNION ALL SELECT concat_ws('/', zoom, tx, ty, unit_id), 1, tx + c, ty, tx + c, ty + 1 FROM reached, (SELECT unnest([0, 1]) AS c))"""


@query(
    "k05_vector_tiles",
    _TILED + slabs("SELECT * FROM both_layers", "k4", "both") + " SELECT CAST(split_part(k, '/', 1) AS INTEGER) AS zoom, CAST(split_part(k, '/', 2) AS INTEGER) AS x, CAST(split_part(k, '/', 3) AS INTEGER) AS y, split_part(k, '/', 4) AS unit_id FROM areas WHERE area > 1e-3",
    "edges",
)
def _(s, d):
    """Which unit is in which tile, of tiles at three zooms, decoded."""
    half = F.transform("points", lambda p: F.struct(p.x.alias("x"), (p.y / 2).alias("y")))
    made = vector_tiles.tiles(fx.rings(s, d).select("unit_id", "ring", half.alias("points")), (2, 4, 6))
    return vector_tiles.features(made).where("area > 1e-3").select("zoom", "x", "y", F.col("name").alias("unit_id"))
