"""Readers and writers, over files that the queries write to the shared folder first."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources import catalogue, copies, geoparquet, netcdf, new_path, raster, stored, tabular, tiff, vector
from . import fixtures as fx

query, FUNCTIONS, SQL = fx.collector()


@query("s01_catalogue_resources", "SELECT 'N' || CAST(n_nationkey AS VARCHAR) AS id, 'adm' || CAST(n_nationkey % 4 AS VARCHAR) || '.shp' AS name FROM nation WHERE n_nationkey % 5 <> 0")
def _(s, d):
    n = F.col("n_nationkey")
    resource = F.array(F.struct(F.concat(F.lit("adm"), (n % 4).cast("string"), F.lit(".shp")).alias("name"), F.lit("SHP").alias("format"), F.lit("http://x/y").alias("url")))
    body = F.to_json(F.struct((n % 5 != 0).alias("success"), F.struct(F.concat(F.lit("N"), n.cast("string")).alias("id"), resource.alias("resources")).alias("result")))
    return catalogue.resources(fx.table(s, d, "nation").select(body.alias("body")), strict=False).select("id", "name")


@query("s02_resource_classifier", "SELECT n_nationkey, n_nationkey % 5 IN (0, 1, 2, 3) AS boundary FROM nation")
def _(s, d):
    k = F.col("n_nationkey") % 5
    name = F.when(k == 1, "Admin units").otherwise("notes")
    kind = F.when(k == 0, "GeoJSON").when(k == 4, "PDF")
    url = F.when(k == 2, "http://x/Y.ZIP").when(k == 3, "http://x/shape_geopackage?id=1").otherwise("http://x/y")
    return fx.table(s, d, "nation").select("n_nationkey", catalogue.is_boundary(name, kind, url).alias("boundary"))


@query("s03_level_of_file_name", "SELECT p_partkey, CASE WHEN p_partkey % 4 = 3 OR p_size % 7 > 2 THEN NULL ELSE CAST(p_size % 7 AS INTEGER) END AS level FROM part")
def _(s, d):
    k = F.col("p_partkey") % 4
    n = (F.col("p_size") % 7).cast("string")
    name = F.when(k == 0, F.concat(F.lit("rwa_adm"), n, F.lit("_2020.shp"))).when(k == 1, F.concat(F.lit("x_admbndp"), n, F.lit(".shp"))).when(k == 2, F.concat(F.lit("admin"), n, F.lit(".shp"))).otherwise(F.concat(F.lit("roads"), n, F.lit(".shp")))
    return fx.table(s, d, "part").select("p_partkey", catalogue.admin_level(name).alias("level"))


@query("k03_s04_geojson_round_trip", "SELECT unit_id, ring, count(*) AS edges, min(x1) AS x_min, max(y1) AS y_max FROM edges GROUP BY unit_id, ring", "edges")
def _(s, d):
    path = new_path(s, "geojson")
    lines = tabular.geojson_lines(fx.rings(s, d), "unit_id", [])
    features = lines.agg(F.concat(F.lit('{"type":"FeatureCollection","features":['), F.array_join(F.collect_list("value"), ","), F.lit("]}")).alias("value"))  # 25 units
    features.write.text(path)
    from ..operators.geo import edges_from_rings

    e = edges_from_rings(vector.geojson_rings(s, path, "unit_id"), "unit_id")
    return e.groupBy("unit_id", "ring").agg(F.count("*").alias("edges"), F.min("x1").alias("x_min"), F.max("y1").alias("y_max"))


@query("s12_s13_csv_level_fallback", "SELECT unit_id, n, 'ADM1' AS level FROM units", "units")
def _(s, d):
    path = new_path(s, "csv")
    fx.units(s, d).select("unit_id", "n").write.option("header", True).csv(f"{path}/X_ADM1_access.csv")
    level, df = tabular.with_fallback(s, path + "/X_{level}_access.csv", schema="unit_id string, n long")
    return df.withColumn("level", F.lit(level))


@query("s16_tagged_features", "SELECT p_partkey FROM part WHERE (p_type = 'ECONOMY' OR regexp_matches(p_name, 'ring|bolt')) AND p_size BETWEEN 5 AND 30 AND p_brand <> 'Brand#2'")
def _(s, d):
    from ..operators.table import tag_is, tag_is_not, tag_matches

    p = fx.table(s, d, "part")
    return p.where((tag_is(F.col("p_type"), "ECONOMY") | tag_matches(F.col("p_name"), "ring|bolt")) & F.col("p_size").between(5, 30) & tag_is_not(F.col("p_brand"), "Brand#2")).select("p_partkey")


@query("s17_count_response", "SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN o_custkey WHEN 1 THEN o_custkey + 1 WHEN 2 THEN o_custkey + 2 ELSE 0 END AS n FROM orders")
def _(s, d):
    k, c = F.col("o_orderkey") % 4, F.col("o_custkey")
    one = lambda v: F.concat(F.lit('[{"timestamp":"2024-01-01","value":1},{"timestamp":"2025-01-01","value":'), v.cast("string"), F.lit("}]"))
    body = F.when(k == 0, F.concat(F.lit('{"result":'), one(c), F.lit("}"))).when(k == 1, F.concat(F.lit('{"groupByResult":[{"result":'), one(c + 1), F.lit("}]}"))).when(k == 2, F.concat(F.lit('{"value":'), (c + 2).cast("string"), F.lit("}"))).otherwise(F.lit("{}"))
    return fx.table(s, d, "orders").select("o_orderkey", catalogue.latest_count(body).alias("n"))


@query("s18_listing_links", "SELECT DISTINCT h AS href FROM (SELECT unnest(regexp_extract_all(html, 'href=\"([^\"]+)\"', 1)) AS h FROM pages) WHERE regexp_matches(h, '^/[a-z]')")
def _(s, d):
    return catalogue.links(fx.table(s, d, "pages"), "^/[a-z]")


@query("s20_needed_bins", "SELECT DISTINCT sex, age FROM pop_bins WHERE age <= 10 OR age >= 65", "pop_bins")
def _(s, d):
    return fx.pop_bins(s, d).where(fx.is_in("dep_dependents")).select("sex", "age").distinct()


@query("s24_country_dimension", "SELECT 'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS iso3, r_name AS region, lower(n_name) AS hdx_country FROM nation JOIN region ON n_regionkey = r_regionkey")
def _(s, d):
    """The country file: three lines a country, every other value in quotes."""
    n = fx.table(s, d, "nation").join(fx.table(s, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    quote = F.when(F.col("n_nationkey") % 2 == 0, "'").otherwise("")
    code = F.concat(F.lit("N"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0"))
    lines = F.array(F.concat(code, F.lit(":")), F.concat(F.lit("  region: "), quote, F.col("r_name"), quote), F.concat(F.lit("  hdx_country: "), F.lower("n_name")))
    text = n.select(F.posexplode(lines).alias("k", "value"), "n_nationkey").select((F.col("n_nationkey") * 3 + F.col("k")).alias("n"), "value")
    return catalogue.country_dimension(s, text)


@query("k01_k02_partitioned_output", "SELECT unit_id, n, country AS region, 'ADM1' AS level, 'coping' AS dataset, 'RWA' AS country FROM units", "units")
def _(s, d):
    path = new_path(s, "output")
    tabular.write_indicator(fx.units(s, d).select("unit_id", "n", F.col("country").alias("region")), path, "RWA", "ADM1", "coping")
    return s.read.parquet(path)


_MANIFEST = "m AS (SELECT p_name || CAST(p_partkey AS VARCHAR) AS path, CAST(p_size AS BIGINT) AS size, p_partkey FROM part)"


@query("k06_upload_skips_same_size", f"WITH {_MANIFEST} SELECT path, size FROM m WHERE p_partkey % 3 <> 0")
def _(s, d):
    p = fx.table(s, d, "part").select(F.concat("p_name", F.col("p_partkey").cast("string")).alias("path"), F.col("p_size").cast("long").alias("size"), "p_partkey")
    remote = p.where("p_partkey % 3 <> 1").select("path", F.when(F.col("p_partkey") % 3 == 0, F.col("size")).otherwise(F.col("size") + 1).alias("size"))
    return tabular.to_upload(p.select("path", "size"), remote)


@query("k06_upload_check", f"WITH {_MANIFEST} SELECT path, size, CASE WHEN p_partkey % 3 = 2 THEN size + 1 END AS remote_size FROM m WHERE p_partkey % 3 <> 0")
def _(s, d):
    p = fx.table(s, d, "part").select(F.concat("p_name", F.col("p_partkey").cast("string")).alias("path"), F.col("p_size").cast("long").alias("size"), "p_partkey")
    remote = p.where("p_partkey % 3 <> 1").select("path", F.when(F.col("p_partkey") % 3 == 0, F.col("size")).otherwise(F.col("size") + 1).alias("size"))
    return tabular.not_uploaded(p.select("path", "size"), remote)


@query("k08_published_audit", "SELECT unit_id AS country, CASE WHEN n % 3 = 0 THEN 0 WHEN n % 3 = 1 THEN 4 ELSE 2 END AS found, 4 AS expected, CASE WHEN n % 3 = 0 THEN 'none' WHEN n % 3 = 1 THEN 'all' ELSE 'partial' END AS status FROM units", "units")
def _(s, d):
    kinds = F.explode(F.array(*map(F.lit, ("access", "coping", "rai", "facilities")))).alias("type")
    expected = fx.units(s, d).select(F.col("unit_id").alias("country"), "n", kinds)
    k = F.col("n") % 3
    published = expected.where((k == 1) | (k == 2) & F.col("type").isin("access", "rai")).withColumn("level", F.explode(F.array(F.lit("ADM1"), F.when(F.col("type") == "access", "ADM2").otherwise("ADM0")))).drop("n")
    return tabular.audit(expected.drop("n"), published, ["ADM2", "ADM1"])


@query("k09_cleanup", "SELECT CASE WHEN p_partkey % 2 = 0 THEN 'data/X/Temporary/' ELSE 'data/X/' END || CAST(p_partkey AS VARCHAR) AS path FROM part WHERE p_partkey % 2 = 0 OR p_partkey % 3 = 0")
def _(s, d):
    k = F.col("p_partkey")
    folder = F.when(k % 2 == 0, "data/X/Temporary/").when(k % 3 == 0, "data/X/").otherwise("data/X/Output/")
    return tabular.cleanup(fx.table(s, d, "part").select(F.concat(folder, k.cast("string")).alias("path")))


@query("k10_incremental_groups", "SELECT unit_id, rp FROM units, (SELECT unnest([10, 50, 100, 500]) AS rp) WHERE NOT (rp = 50 OR n % 4 = 0 AND rp = 10)", "units")
def _(s, d):
    wanted = fx.units(s, d).select("unit_id", "n", F.explode(F.array(*map(F.lit, fx.RETURN_PERIODS))).alias("rp"))
    existing = wanted.where("rp = 50 or n % 4 = 0 and rp = 10")
    return tabular.missing_groups(wanted.drop("n"), existing, ["unit_id", "rp"])


@query("k04_s06_geotiff_round_trip", "SELECT 'RP' || CAST(rp AS VARCHAR) AS raster, row, col, CAST(CAST(depth AS FLOAT) AS DOUBLE) AS value FROM hazard", "hazard")
def _(s, d):
    """A GeoTIFF for each return period and back."""
    cells = fx.hazard(s, d).select(F.concat(F.lit("RP"), F.col("rp").cast("string")).alias("raster"), "row", "col", F.col("depth").alias("value"))
    files = stored(raster.geotiffs(cells, x0=10.0, y0=20.0, dx=0.5, dy=0.5))
    return raster.tiff_cells(files, "raster").select("raster", "row", "col", "value")


@query(
    "s10_netcdf_months",
    "SELECT CAST((year(o_orderdate) - 1991) * 12 + month(o_orderdate) - 1 AS INTEGER) AS month, CAST(o_orderkey % 20 AS INTEGER) AS row, CAST(o_custkey % 30 AS INTEGER) AS col, CAST(count(*) AS DOUBLE) AS value FROM orders GROUP BY ALL",
)
def _(s, d):
    """A file a year with twelve bands, read by slabs as one series of months."""
    import numpy as np
    import pandas as pd

    o = fx.table(s, d, "orders")
    cells = o.groupBy(F.year("o_orderdate").alias("year"), (F.month("o_orderdate") - 1).alias("step"), (F.col("o_orderkey") % 20).cast("int").alias("row"), (F.col("o_custkey") % 30).cast("int").alias("col")).agg(F.count("*").alias("n"))

    def file(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        bands = np.full((12, 20, 30), -1, "i4")
        bands[pdf["step"], pdf["row"], pdf["col"]] = pdf["n"]
        return pd.DataFrame({"name": [f"orders_{key[0]}.nc"], "content": [netcdf.written({"orders": bands}, {"orders": {"_FillValue": -1}})]})

    folder = new_path(s, "netcdf")
    tiff.landed(cells.groupBy("year").applyInPandas(file, "name string, content binary"), folder, "name")
    got = netcdf.cells(netcdf.slabs(s, folder, "orders")).withColumn("year", F.regexp_extract("file", r"(\d{4})", 1).cast("int"))
    return raster.month_index(got.withColumn("band", F.col("step") + 1)).select("month", "row", "col", "value")


def bumpy_rings(s, d):
    """The units' rings with a small bump on every edge: what simplification takes away."""
    e = fx.edges(s, d)
    bump = F.lit(0.001) * (1 + F.col("seq"))
    two = F.array(F.struct("seq", F.lit(0).alias("k"), F.col("x1").alias("x"), F.col("y1").alias("y")), F.struct("seq", F.lit(1).alias("k"), ((F.col("x1") + F.col("x2")) / 2 + bump).alias("x"), ((F.col("y1") + F.col("y2")) / 2 + bump).alias("y")))
    p = F.sort_array(F.flatten(F.collect_list(two)))
    return e.groupBy("unit_id", "ring").agg(F.transform(p, lambda q: F.struct(q.x.alias("x"), q.y.alias("y"))).alias("points"))


def _zipped(pdf):
    """name, content: a zipped shapefile of rings (unit_id, ring, points), a record for each."""
    import io
    import struct
    import zipfile

    import pandas as pd

    shapes, rows = b"", b""
    for n, r in enumerate(pdf.sort_values(["unit_id", "ring"]).itertuples(), 1):
        p = [(q["x"], q["y"]) for q in r.points] + [(r.points[0]["x"], r.points[0]["y"])]
        xs, ys = zip(*p, strict=True)
        body = struct.pack("<I4d2II", 5, min(xs), min(ys), max(xs), max(ys), 1, len(p), 0) + b"".join(struct.pack("<2d", *q) for q in p)
        shapes += struct.pack(">2I", n, len(body) // 2) + body
        rows += b" " + f"{r.unit_id}:{r.ring}".ljust(20).encode()
    head = struct.pack(">7I", 9994, 0, 0, 0, 0, 0, 50 + len(shapes) // 2) + struct.pack("<2I", 1000, 5) + b"\0" * 64
    field = b"name".ljust(11, b"\0") + b"C" + b"\0" * 4 + bytes([20, 0]) + b"\0" * 14
    table = struct.pack("<4BIHH", 3, 24, 1, 1, len(pdf), 32 + 32 + 1, 21) + b"\0" * 20 + field + b"\r" + rows + b"\x1a"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("x_adm1_units.shp", head + shapes)
        z.writestr("x_adm1_units.dbf", table)
    return pd.DataFrame({"name": [f"{pdf['part'].iloc[0]}.zip"], "content": [out.getvalue()]})


@query(
    "s03_shapefile_to_geojson",
    "SELECT unit_id, ring, 1 AS level, 4 AS edges, min(least(x1, x2)) AS x_min, max(greatest(y1, y2)) AS y_max FROM edges GROUP BY unit_id, ring",
    "edges",
)
def _(s, d):
    """Zipped shapefiles, read, simplified with shared borders, written as GeoJSON and read again."""
    from ..operators import geo

    folder, out = new_path(s, "shapefiles"), new_path(s, "geojson")
    parts = bumpy_rings(s, d).withColumn("part", F.concat(F.lit("p"), (F.crc32(F.col("unit_id")) % 3).cast("string")))
    tiff.landed(parts.groupBy("part").applyInPandas(_zipped, "name string, content binary"), folder, "name")
    read = vector.zipped_shapefiles(s, folder).select("level", F.split(F.col("properties")["name"], ":").alias("n"), "points")
    own = read.select("level", F.col("n")[0].alias("unit_id"), F.col("n")[1].cast("int").alias("ring"), "points")
    simple = geo.simplify_shared(own, 0.1)
    named = simple.select(F.concat_ws(":", "unit_id", "ring", "level").alias("name"), F.lit(0).alias("ring"), "points")
    tabular.geojson_lines(named, "name", []).write.text(out)
    e = geo.edges_from_rings(vector.geojson_rings(s, out, "name", lines=True), "name").withColumn("n", F.split("name", ":"))
    keys = [F.col("n")[0].alias("unit_id"), F.col("n")[1].cast("int").alias("ring"), F.col("n")[2].cast("int").alias("level")]
    return e.groupBy(*keys).agg(F.count("*").cast("int").alias("edges"), F.min(F.least("x1", "x2")).alias("x_min"), F.max(F.greatest("y1", "y2")).alias("y_max"))


@query("g05_byte_budget", "SELECT unit_id, count(*) FILTER (WHERE seq = 0) AS rings, count(*) AS points, sum(x1) AS xs, sum(y1) AS ys FROM edges GROUP BY unit_id", "edges")
def _(s, d):
    """The layer at the smallest tolerance at which its coordinates fit the bytes of its corners: all bumps go, no corner."""
    from ..operators import geo

    budget = fx.edges(s, d).agg(F.sum(F.length(F.format_string("[%.6f,%.6f],", "x1", "y1")))).first()[0]
    whole = geo.simplify_to_budget(geo.vertex_tolerances(bumpy_rings(s, d)), budget, [])
    p = whole.select("unit_id", "ring", F.posexplode("points").alias("k", "p"))
    return p.groupBy("unit_id").agg(F.count(F.when(F.col("k") == 0, 1)).alias("rings"), F.count("*").alias("points"), F.sum("p.x").alias("xs"), F.sum("p.y").alias("ys"))


@query(
    "s15_geoparquet_box",
    """SELECT unit_id, ring, count(*) AS points, min(least(x1, x2)) AS x_min, max(greatest(y1, y2)) AS y_max FROM edges
    WHERE unit_id IN (SELECT unit_id FROM edges GROUP BY unit_id HAVING min(x1) <= 55 AND max(x1) >= 25 AND min(y1) <= 41 AND max(y1) >= 5) GROUP BY unit_id, ring""",
    "edges",
)
def _(s, d):
    """Units whose boxes meet a box, from GeoParquet files."""
    folder = new_path(s, "geoparquet")
    geoparquet.write(geoparquet.features(fx.rings(s, d)), folder, size=20.0, rows=4, files=2)
    parts = vector.wkb_parts(geoparquet.read(s, folder, (25.0, 5.0, 55.0, 41.0)).select("unit_id", "geometry"))
    x, y = F.transform("points", lambda p: p.x), F.transform("points", lambda p: p.y)
    return parts.select("unit_id", F.col("part").alias("ring"), (F.size("points") - 1).cast("long").alias("points"), F.array_min(x).alias("x_min"), F.array_max(y).alias("y_max"))


_BIN = "sex || '_' || CAST(age AS VARCHAR) || '.tif'"


@query("s20_cached_bins", f"SELECT {_BIN} AS file, CASE WHEN age < 5 THEN 'same' ELSE 'copied' END AS status, count(*) AS cells, sum(value) AS total FROM (SELECT sex, age, row, col, sum(value) AS value FROM pop_bins WHERE age <= 10 OR age >= 65 GROUP BY ALL) GROUP BY sex, age", "pop_bins")
def _(s, d):
    """Rasters of the bins that an indicator needs, each fetched once, those in the cache not again; read from the cache."""
    source, cache = new_path(s, "remote"), new_path(s, "cache")
    name = F.concat_ws("", "sex", F.lit("_"), F.col("age").cast("string"), F.lit(".tif"))
    cells = fx.pop_bins(s, d).groupBy(name.alias("raster"), "sex", "age", "row", "col").agg(F.sum("value").alias("value"))
    tiff.landed(tiff.geotiffs(cells, (100, 100), 0.0, 0.0, 1.0, 1.0, dtype="f8"), source)
    needed = fx.pop_bins(s, d).where(fx.is_in("dep_dependents"))  # a row for every item: repeats are fetched once
    copies.mirrored(needed.where("age < 5").select(name.alias("path")), source, cache)
    done = copies.mirrored(needed.select(name.alias("path")), source, cache)
    held = tiff.cells(tiff.blocks(s, cache)).groupBy("raster").agg(F.count("*").alias("cells"), F.sum("value").alias("total"))
    return done.join(held, F.col("path") == F.col("raster")).select(F.col("path").alias("file"), "status", "cells", "total")


@query("k06_upload", "SELECT 'out/' || n_name || '.csv' AS path, CAST(octet_length(encode(n_name || repeat('x', CAST(n_nationkey AS INTEGER)))) AS BIGINT) AS size, CASE WHEN n_nationkey % 3 = 0 THEN 'same' ELSE 'copied' END AS status FROM nation UNION ALL SELECT 'lost.csv', NULL, 'failed'")
def _(s, d):
    """Files to a store that has some in their size, some in another; one that doesn't exist fails alone."""
    local, remote = new_path(s, "local"), new_path(s, "store")
    n = fx.table(s, d, "nation")
    path, text = F.concat(F.lit("out/"), "n_name", F.lit(".csv")), F.concat("n_name", F.repeat(F.lit("x"), F.col("n_nationkey").cast("int")))
    tiff.landed(n.select(path.alias("name"), text.cast("binary").alias("content")), local, "name")
    old = F.when(F.col("n_nationkey") % 3 == 0, text).otherwise(F.lit("old"))
    tiff.landed(n.where("n_nationkey % 3 < 2").select(path.alias("name"), old.cast("binary").alias("content")), remote, "name")
    files = n.select(path.alias("path")).unionByName(n.select(F.lit("lost.csv").alias("path")))
    return copies.mirrored(files, local, remote).select("path", "size", "status")


def _package(pdf):
    """name, content: a GeoPackage with one layer, a polygon for each unit."""
    import contextlib
    import sqlite3

    import pandas as pd

    with contextlib.closing(sqlite3.connect(":memory:")) as db:
        db.execute("CREATE TABLE units (fid INTEGER PRIMARY KEY, unit_id TEXT, geom BLOB)")
        for unit, own in pdf.sort_values("ring").groupby("unit_id"):
            db.execute("INSERT INTO units (unit_id, geom) VALUES (?, ?)", (unit, b"GP\0\1\0\0\0\0" + geoparquet.polygon_wkb([list(p) for p in own["points"]])))
        db.commit()
        return pd.DataFrame({"name": [f"{pdf['part'].iloc[0]}.gpkg"], "content": [bytes(db.serialize())]})


@query("s05_geopackage", "SELECT unit_id, ring, count(*) AS points, sum(x1) AS xs, sum(y1) AS ys FROM edges GROUP BY unit_id, ring", "edges")
def _(s, d):
    folder = new_path(s, "packages")
    parts = fx.rings(s, d).withColumn("part", F.concat(F.lit("p"), (F.crc32(F.col("unit_id")) % 3).cast("string")))
    tiff.landed(parts.groupBy("part").applyInPandas(_package, "name string, content binary"), folder, "name")
    read = vector.wkb_parts(vector.geopackage(s, folder, "units", "unit_id string"))
    p = read.select("unit_id", F.col("part").alias("ring"), F.explode(F.slice("points", F.lit(1), F.size("points") - 1)).alias("p"))
    return p.groupBy("unit_id", "ring").agg(F.count("*").alias("points"), F.sum("p.x").alias("xs"), F.sum("p.y").alias("ys"))


def _workbook(pdf):
    """name, content: a workbook whose second sheet has a row for each year."""
    import io
    import zipfile

    import pandas as pd

    m = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rows = "".join(f'<row><c r="A{k}"><v>{r.year}</v></c><c r="C{k}"><v>{r.fatalities}</v></c></row>' for k, r in enumerate(pdf.sort_values("year").itertuples(), 2))
    head = '<row><c r="A1" t="s"><v>0</v></c><c r="B1" t="s"><v>1</v></c><c r="C1" t="s"><v>2</v></c></row>'
    links = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("xl/workbook.xml", f'<workbook {m} xmlns:r="{links}"><sheets><sheet name="Notes" sheetId="1" r:id="rId1"/><sheet name="Data" sheetId="2" r:id="rId2"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId2" Target="worksheets/sheet1.xml"/><Relationship Id="rId1" Target="worksheets/sheet2.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f"<sst {m}><si><t> Year </t></si><si><t>Notes</t></si><si><t>Fatalities</t></si></sst>")
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {m}><sheetData>{head}{rows}</sheetData></worksheet>")
    return pd.DataFrame({"name": [f"{pdf['unit_id'].iloc[0]}.xlsx"], "content": [out.getvalue()]})


@query("s11_worksheets", "SELECT year, CAST(sum(fatalities) AS BIGINT) AS fatalities, count(DISTINCT unit_id) AS files FROM conflict GROUP BY year", "conflict")
def _(s, d):
    """A workbook for each unit with its yearly sums, all read and added up."""
    folder = new_path(s, "workbooks")
    sums = fx.conflict(s, d).groupBy("unit_id", "year").agg(F.sum("fatalities").alias("fatalities"))
    tiff.landed(sums.groupBy("unit_id").applyInPandas(_workbook, "name string, content binary"), folder, "name")
    rows = tabular.worksheet(s, folder, "Data", ["Year", "Fatalities"], {"Year": "year", "Fatalities": "fatalities"})
    return rows.groupBy(F.col("year").cast("int").alias("year")).agg(F.sum(F.col("fatalities").cast("long")).alias("fatalities"), F.count("*").alias("files"))
