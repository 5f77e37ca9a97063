"""GeoParquet files and box queries."""

import glob
import json

import pyarrow.parquet as pq
import pytest

from cellgrove.sources import geoparquet, vector


def squares(spark, n=40):
    rows = [(f"u{i}.{j}", 0, [dict(x=i + a, y=j + b) for a, b in ((0.1, 0.1), (0.9, 0.1), (0.9, 0.9), (0.1, 0.9))]) for i in range(n) for j in range(n)]
    rows.append(("u0.0", 1, [dict(x=a, y=a * a) for a in (0.3, 0.4, 0.5)]))
    return spark.createDataFrame(rows, "unit_id string, ring int, points array<struct<x: double, y: double>>")


def test_a_box_reads_few_row_groups(spark, tmp_path):
    folder = f"file://{tmp_path}/g"
    geoparquet.write(geoparquet.features(squares(spark)), folder, rows=50, files=3)
    box = (3.2, 30.5, 6.0, 33.5)
    got = geoparquet.read(spark, folder, box)
    assert {r.unit_id for r in got.collect()} == {f"u{i}.{j}" for i in (3, 4, 5) for j in (30, 31, 32, 33)}
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    got = geoparquet.read(spark, folder, box)
    assert "PushedFilters" in (plan := got._jdf.queryExecution().toString()) and "LessThanOrEqual(bbox.xmin,6.0)" in plan
    # by their statistics, which is what Spark skips by, few groups can hold a row of the box
    total = may = 0
    for path in glob.glob(f"{tmp_path}/g/*.parquet"):
        meta = pq.ParquetFile(path).metadata
        assert json.loads(meta.metadata[b"geo"])["columns"]["geometry"]["covering"]["bbox"]["xmin"] == ["bbox", "xmin"]
        for k in range(meta.num_row_groups):
            s = {meta.row_group(k).column(c).path_in_schema: meta.row_group(k).column(c).statistics for c in range(meta.num_columns)}
            total += 1
            may += s["bbox.xmin"].min <= box[2] and s["bbox.xmax"].max >= box[0] and s["bbox.ymin"].min <= box[3] and s["bbox.ymax"].max >= box[1]
    assert total >= 32 and may <= 4


def test_rings_come_back(spark, tmp_path):
    folder = f"file://{tmp_path}/g"
    geoparquet.write(geoparquet.features(squares(spark, 2)), folder)
    parts = vector.wkb_parts(geoparquet.read(spark, folder).select("unit_id", "geometry")).where("unit_id = 'u0.0'").orderBy("part").collect()
    assert [len(r.points) for r in parts] == [5, 4] and parts[1].points[1].y == 0.4 * 0.4


def test_what_is_refused(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/plain")
    with pytest.raises(ValueError, match="no geo metadata"):
        geoparquet.read(spark, f"file://{tmp_path}/plain")
    (tmp_path / "none").mkdir()
    with pytest.raises(FileNotFoundError):
        geoparquet.read(spark, f"file://{tmp_path}/none")
