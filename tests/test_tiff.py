"""GeoTIFFs by blocks."""

import numpy as np
import pytest

from cellgrove.sources import raster, tiff


def lzw(data):
    """Nine-bit codes with a clear code before the table grows."""
    codes = []
    for k in range(0, len(data), 100):
        codes += [256, *data[k : k + 100]]
    bits = "".join(f"{c:09b}" for c in [*codes, 257])
    bits += "0" * (-len(bits) % 8)
    return int(bits, 2).to_bytes(len(bits) // 8, "big")


def band(h, w, dtype):
    rng = np.random.default_rng(3)
    return (rng.integers(0, 200, (h, w)) if np.dtype(dtype).kind != "f" else rng.normal(0, 1e3, (h, w))).astype(dtype)


def whole(data, n=1, window=None):
    read = lambda at, size: data[at : at + size]
    rows = tiff.block_rows("x.tif", read, window, n)
    out = np.full((rows["image_height"].max(), rows["image_width"].max()), np.nan)
    for b in rows.itertuples():
        out[b.row : b.row + b.height, b.col : b.col + b.width] = tiff.decoded(b, read(b.at, b.size))
    return out, rows


@pytest.mark.parametrize("dtype", ["u1", "i2", "u4", "f4", "f8"])
@pytest.mark.parametrize("tiled", [True, False])
@pytest.mark.parametrize("predictor", [1, 2, 3])
def test_round_trip(dtype, tiled, predictor):
    if (np.dtype(dtype).kind == "f") != (predictor == 3) and predictor != 1:
        return  # differencing is of whole numbers, the floating-point kind of others
    b = band(70, 50, dtype)
    data = tiff.encoded(b, 5.0, 9.0, 0.5, 0.25, block=(16, 32), tiled=tiled, predictor=predictor)
    out, rows = whole(data)
    assert np.array_equal(out, b.astype(float))
    assert (rows["x0"][0], rows["y0"][0], rows["dx"][0], rows["dy"][0]) == (5.0, 9.0, 0.5, 0.25)
    if predictor < 3:
        assert np.array_equal(raster.read_tiff(data)[0], b)


def test_lzw_big_files_bands_and_no_data(monkeypatch):
    b = band(40, 30, "u2")
    data = bytearray(tiff.encoded(b, 0, 0, 1, 1, block=(40, 30), tiled=False, packed=False))
    coded = lzw(b.tobytes())
    rows = tiff.block_rows("x", lambda at, n: bytes(data[at : at + n]))
    row = next(rows.assign(packing=5).itertuples())
    assert np.array_equal(tiff.decoded(row, coded), b.astype(float))
    with pytest.raises(ValueError, match="compression 7"):
        tiff.decoded(next(rows.assign(packing=7).itertuples()), coded)

    stack = np.stack([b, b + 1, b + 2]).astype("f4")
    data = tiff.encoded(stack, 0, 0, 1, 1, nodata=float(stack[1, 0, 0]), block=(16, 16))
    out, _ = whole(data, 2)
    assert np.isnan(out[0, 0]) and np.array_equal(np.nan_to_num(out, nan=stack[1, 0, 0]), stack[1].astype(float))
    with pytest.raises(ValueError, match="3 bands"):
        whole(data, 4)

    monkeypatch.setattr(tiff, "CLASSIC", 0)
    data = tiff.encoded(stack, 1.0, 2.0, 3.0, 4.0, nodata=-1.0, block=(16, 16))
    assert data[:4] == b"II+\0"
    out, rows = whole(data, 3)
    assert np.array_equal(out, stack[2].astype(float)) and (rows["x0"][0], rows["dy"][0], rows["nodata"][0]) == (1.0, 4.0, -1.0)


def test_window_reads_its_blocks_only(spark, tmp_path):
    b = band(64, 96, "f8")
    data = bytearray(tiff.encoded(b, 0, 0, 1, 1, block=(16, 16)))
    window = (20, 40, 20, 10)
    used = tiff.block_rows("x", lambda at, n: bytes(data[at : at + n]), window)
    assert len(used) == 2 * 2 and len(whole(bytes(data))[1]) == 24
    for r in whole(bytes(data))[1].itertuples():
        if r.block not in set(used["block"]):
            data[r.at : r.at + r.size] = b"?" * r.size  # what isn't needed can't be read
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.tif").write_bytes(data)
    found = tiff.blocks(spark, f"file://{tmp_path}/a", window)
    assert found.count() == 4
    got = {(r.row, r.col): r.value for r in tiff.cells(found, window, task_bytes=500).collect()}
    assert got == {(r, c): b[r, c] for r in range(20, 40) for c in range(40, 50)}
    assert tiff.cells(tiff.blocks(spark, f"file://{tmp_path}/a", (1000, 1000, 5, 5))).count() == 0


@pytest.mark.parametrize("shape", [(10, 12), (64, 96), (100, 40), (1, 1)])
def test_reduced_is_the_weighted_mean(spark, tmp_path, shape):
    b = band(64, 96, "f8")
    b[3:9, 5:60] = -1
    (tmp_path / "x.tif").write_bytes(tiff.encoded(b, 0, 0, 1, 1, nodata=-1, block=(16, 32)))
    got = {(r.row, r.col): r.value for r in tiff.reduced(tiff.blocks(spark, f"file://{tmp_path}"), shape, task_bytes=5_000).collect()}
    v = np.where(b == -1, np.nan, b)
    w = [np.array([[max(0.0, 1 - abs(i - ((t + 0.5) * n / m - 0.5)) / max(1.0, n / m)) for i in range(n)] for t in range(m)]) for n, m in zip(b.shape, shape, strict=True)]
    total, weight = w[0] @ np.nan_to_num(v) @ w[1].T, w[0] @ ~np.isnan(v) @ w[1].T
    assert set(got) == set(zip(*map(np.ndarray.tolist, np.nonzero(weight)), strict=True))
    assert all(np.isclose(x, total[k] / weight[k]) for k, x in got.items())


def test_rasters_by_strips(spark, tmp_path):
    rows = [(name, r, c, float(r * 10 + c)) for name in ("a.tif", "b.tif") for r in (0, 5, 33) for c in range(7)] + [("a.tif", 99, 0, 1.0)]
    files = tiff.geotiffs(spark.createDataFrame(rows, "raster string, row int, col int, value double"), (40, 7), 1.0, 2.0, 0.5, 0.5, rows=8)
    paths = tiff.landed(files, f"file://{tmp_path}/out")
    assert [p.rsplit("/", 1)[1] for p in paths] == ["a.tif", "b.tif"]
    got = sorted((r.raster, r.row, r.col, r.value) for r in tiff.cells(tiff.blocks(spark, f"file://{tmp_path}/out")).collect())
    assert got == sorted(rows[:-1])
