"""Rasters as cell tables (row, col, value). Alignment is arithmetic on indices and an equi-join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def block_sum(cells: DataFrame, s: int, value: str = "value", by: list[str] | None = None) -> DataFrame:
    """Sums of s x s blocks; blocks at the edges are partial."""
    return cells.groupBy(*(by or []), F.floor(F.col("row") / s).cast("int").alias("row"), F.floor(F.col("col") / s).cast("int").alias("col")).agg(F.sum(value).alias(value))


def block_sum_trimmed(cells: DataFrame, s: int, height: int, width: int, value: str = "value") -> DataFrame:
    """The same without the ragged edge."""
    return block_sum(cells.where((F.col("row") < height // s * s) & (F.col("col") < width // s * s)), s, value)


def block_mean(cells: DataFrame, s: int, value: str = "value") -> DataFrame:
    return cells.groupBy(F.floor(F.col("row") / s).cast("int").alias("row"), F.floor(F.col("col") / s).cast("int").alias("col")).agg(F.avg(value).alias(value))


def downsample_nearest(cells: DataFrame, s: int) -> DataFrame:
    """Every s-th cell, the one at the centre of its block."""
    return cells.where((F.col("row") % s == s // 2) & (F.col("col") % s == s // 2)).withColumns({"row": F.floor(F.col("row") / s).cast("int"), "col": F.floor(F.col("col") / s).cast("int")})


def upsample_nearest(cells: DataFrame, s: int) -> DataFrame:
    steps = F.sequence(F.lit(0), F.lit(s - 1))
    out = cells.withColumn("__r", F.explode(steps)).withColumn("__c", F.explode(steps))
    return out.withColumns({"row": F.col("row") * s + F.col("__r"), "col": F.col("col") * s + F.col("__c")}).drop("__r", "__c")


def _zoomed(spark, old: int, new: int, name: str) -> tuple[DataFrame, Column]:
    """Indices 0 .. new - 1 and the place on the old axis of each, with the first and last cells aligned."""
    step = (old - 1) / (new - 1) if new > 1 else 0.0
    return spark.range(new).select(F.col("id").cast("int").alias(name)), F.col(name) * F.lit(step)


def zoom_nearest(cells: DataFrame, shape: tuple[int, int], to: tuple[int, int], value: str = "value") -> DataFrame:
    """A raster of ``shape`` (rows, columns) at another size, corners aligned: the nearest cell of each place."""
    spark = cells.sparkSession
    (rows, y), (cols, x) = _zoomed(spark, shape[0], to[0], "row"), _zoomed(spark, shape[1], to[1], "col")
    rows = rows.withColumn("__r", F.floor(y + 0.5).cast("int"))
    cols = cols.withColumn("__c", F.floor(x + 0.5).cast("int"))
    # an axis at a time: the cells are joined with rows, then with columns, never a grid with a grid
    at = cells.select(F.col("row").alias("__r"), F.col("col").alias("__c"), value).join(rows, "__r").join(cols, "__c")
    return at.select("row", "col", value)


def zoom_linear(cells: DataFrame, shape: tuple[int, int], to: tuple[int, int], value: str = "value") -> DataFrame:
    """The same by linear interpolation along both axes; cells that are absent drop out of the weights."""
    spark = cells.sparkSession
    axes = []
    for old, new, name, own in ((shape[0], to[0], "row", "__r"), (shape[1], to[1], "col", "__c")):
        axis, at = _zoomed(spark, old, new, name)
        two = F.array(F.struct(F.floor(at).cast("int").alias("i"), (1 - (at - F.floor(at))).alias("w")), F.struct((F.floor(at).cast("int") + 1).alias("i"), (at - F.floor(at)).alias("w")))
        axes.append(axis.select(name, F.explode(two).alias("k")).where("k.w > 0").select(name, F.col("k.i").alias(own), F.col("k.w").alias(f"{own}_w")))
    met = cells.where(F.col(value).isNotNull()).select(F.col("row").alias("__r"), F.col("col").alias("__c"), value).join(axes[0], "__r").join(axes[1], "__c")
    w = F.col("__r_w") * F.col("__c_w")
    return met.groupBy("row", "col").agg((F.sum(w * F.col(value)) / F.sum(w)).alias(value))


def zoom_flag(cells: DataFrame, shape: tuple[int, int], to: tuple[int, int], value: str = "value") -> DataFrame:
    """A mask at another size: whether the nearest cell is above one half."""
    return zoom_nearest(cells, shape, to, value).withColumn(value, F.col(value).cast("double") > 0.5)


def reclassify(cells: DataFrame, mapping: dict[int, int], value: str = "value") -> DataFrame:
    """By a map; what it lacks becomes 0."""
    m = F.create_map(*(F.lit(x) for kv in mapping.items() for x in kv))
    return cells.withColumn(value, F.coalesce(F.try_element_at(m, F.col(value).cast("int")), F.lit(0)))


def multiply(a: DataFrame, b: DataFrame, value: str = "value") -> DataFrame:
    """Cells of both, values multiplied."""
    return a.select("row", "col", F.col(value).alias("__a")).join(b.select("row", "col", F.col(value).alias("__b")), ["row", "col"]).select("row", "col", (F.col("__a") * F.col("__b")).alias(value))


def subtract_clamped(a: DataFrame, b: DataFrame, value: str = "value") -> DataFrame:
    """a - b, at least 0; a cell that b lacks keeps a."""
    return a.select("row", "col", F.col(value).alias("__a")).join(b.select("row", "col", F.col(value).alias("__b")), ["row", "col"], "left").select("row", "col", F.greatest(F.col("__a") - F.coalesce("__b", F.lit(0)), F.lit(0)).alias(value))


def stack_sum(cells: DataFrame, value: str = "value") -> DataFrame:
    """Sum of any number of layers, cell by cell."""
    return cells.groupBy("row", "col").agg(F.sum(value).alias(value))


def stack_max(cells: DataFrame, value: str = "value") -> DataFrame:
    """Painter's order from low to high: the highest value of a cell wins."""
    return cells.groupBy("row", "col").agg(F.max(value).alias(value))


def stack_mode(cells: DataFrame, value: str = "value") -> DataFrame:
    """Most frequent value of a cell; of ties the smallest."""
    n = cells.groupBy("row", "col", value).agg(F.count("*").alias("__n"))
    return n.groupBy("row", "col").agg(F.max(F.struct("__n", (-F.col(value)).alias("__v"))).alias("__m")).select("row", "col", (-F.col("__m.__v")).alias(value))


def mosaic(tiles: DataFrame, order: str, value: str = "value") -> DataFrame:
    """Overlapping tiles as one raster: the first in order with a value wins."""
    ok = tiles.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    return ok.groupBy("row", "col").agg(F.min_by(value, order).alias(value))


def index_of(x: Column, origin: float, size: float) -> Column:
    """Index of the cell that holds a coordinate."""
    return F.floor((x - origin) / size).cast("int")


def sample(points: DataFrame, cells: DataFrame, x0: float = 0.0, y0: float = 0.0, size: float = 1.0, value: str = "value", empty=None) -> DataFrame:
    """The value of the cell under each point, ``empty`` outside the raster."""
    p = points.withColumns({"row": index_of(F.col("y"), y0, size), "col": index_of(F.col("x"), x0, size)})
    out = p.join(cells.select("row", "col", value), ["row", "col"], "left")
    return out if empty is None else out.withColumn(value, F.coalesce(value, F.lit(empty)))


def regrid_nearest(target: DataFrame, source: DataFrame, target_size: float, source_size: float, value: str = "value", target_origin: tuple[float, float] = (0.0, 0.0), source_origin: tuple[float, float] = (0.0, 0.0)) -> DataFrame:
    """Each target cell gets the value of the source cell under its centre (null outside)."""
    y = F.lit(target_origin[0]) + (F.col("row") + 0.5) * target_size
    x = F.lit(target_origin[1]) + (F.col("col") + 0.5) * target_size
    t = target.select("row", "col").withColumns({"__r": index_of(y, source_origin[0], source_size), "__c": index_of(x, source_origin[1], source_size)})
    return t.join(source.select(F.col("row").alias("__r"), F.col("col").alias("__c"), value), ["__r", "__c"], "left").select("row", "col", value)


def regrid_bilinear(target: DataFrame, source: DataFrame, target_size: float, source_size: float, value: str = "value") -> DataFrame:
    """Weighted mean of the (up to four) source cells around each target centre; missing neighbours drop
    out of the weights."""
    v = (F.col("row") + 0.5) * target_size / source_size - 0.5
    u = (F.col("col") + 0.5) * target_size / source_size - 0.5
    t = target.select("row", "col", F.floor(v).cast("int").alias("__r"), F.floor(u).cast("int").alias("__c"), (v - F.floor(v)).alias("__v"), (u - F.floor(u)).alias("__u"))
    corner = lambda i, j: F.struct((F.col("__r") + i).alias("r"), (F.col("__c") + j).alias("c"), ((F.col("__v") if i else 1 - F.col("__v")) * (F.col("__u") if j else 1 - F.col("__u"))).alias("w"))
    each = t.select("row", "col", F.explode(F.array(corner(0, 0), corner(0, 1), corner(1, 0), corner(1, 1))).alias("k")).where("k.w > 0")
    s = source.select(F.col("row").alias("__sr"), F.col("col").alias("__sc"), F.col(value).alias("__s")).where("__s is not null")
    met = each.join(s, (F.col("k.r") == F.col("__sr")) & (F.col("k.c") == F.col("__sc")))
    return met.groupBy("row", "col").agg((F.sum(F.col("k.w") * F.col("__s")) / F.sum("k.w")).alias(value))


def clip(cells: DataFrame, cell_zone: DataFrame) -> DataFrame:
    """The cells inside any unit."""
    return cells.join(cell_zone.select("row", "col").distinct(), ["row", "col"], "left_semi")


def histogram(cells: DataFrame, value: str = "value") -> DataFrame:
    return cells.groupBy(value).agg(F.count("*").alias("n"))


def to_tiles(cells: DataFrame, size: int = 256, value: str = "value") -> DataFrame:
    """Storage form: one row per tile with its cells as arrays, prunable by tile_row and tile_col."""
    return cells.groupBy(F.floor(F.col("row") / size).cast("int").alias("tile_row"), F.floor(F.col("col") / size).cast("int").alias("tile_col")).agg(F.sort_array(F.collect_list(F.struct("row", "col", value))).alias("cells"))


def from_tiles(tiles: DataFrame, window: tuple[int, int, int, int] | None = None, size: int = 256) -> DataFrame:
    """Cells of tiles; a window (row, col, height, width) prunes tiles before cells."""
    if window:
        r, c, h, w = window
        tiles = tiles.where(F.col("tile_row").between(r // size, (r + h - 1) // size) & F.col("tile_col").between(c // size, (c + w - 1) // size))
    out = tiles.select(F.inline("cells"))
    return out.where(F.col("row").between(r, r + h - 1) & F.col("col").between(c, c + w - 1)) if window else out


def polygonise(cells: DataFrame, value: str = "value", size: float = 1.0) -> DataFrame:
    """value, x1, y1, x2, y2: the outline of each value's cells as edges, straight ones in one piece. By the even-odd
    rule they hold exactly those cells (all of one value together; holes follow from the rule).

    A side is kept if the cell across has another value or is absent: two sides of one value cancel in one
    aggregation, without looking at neighbours. Sides that go on from each other are joined by gaps and islands."""
    side = lambda flat, line, at: F.struct(F.lit(flat).alias("flat"), line.alias("line"), at.alias("at"))
    r, c = F.col("row"), F.col("col")
    sides = F.array(side(True, r, c), side(True, r + 1, c), side(False, c, r), side(False, c + 1, r))
    each = cells.where(F.col(value).isNotNull()).select(F.col(value).alias("__v"), F.explode(sides).alias("s")).select("__v", "s.flat", "s.line", "s.at")
    outer = each.groupBy("__v", "flat", "line", "at").agg(F.count("*").alias("n")).where("n = 1")
    w = Window.partitionBy("__v", "flat", "line").orderBy("at")
    runs = outer.withColumn("run", F.col("at") - F.row_number().over(w)).groupBy("__v", "flat", "line", "run").agg(F.min("at").alias("a"), (F.max("at") + 1).alias("b"))
    end = lambda along, across: (F.when(F.col("flat"), F.col(along)).otherwise(F.col(across)) * F.lit(float(size)))
    return runs.select(F.col("__v").alias(value), end("a", "line").alias("x1"), end("line", "a").alias("y1"), end("b", "line").alias("x2"), end("line", "b").alias("y2"))
