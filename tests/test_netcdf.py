"""Classic NetCDF by slabs."""

import numpy as np
import pytest

from cellgrove.sources import netcdf


def series(kind, steps=12, h=5, w=7):
    rng = np.random.default_rng(4)
    return (rng.integers(-300, 300, (steps, h, w)) if kind == "i2" else rng.normal(0, 1, (steps, h, w))).astype(kind)


@pytest.mark.parametrize("record", [True, False])
@pytest.mark.parametrize("kind", ["i2", "f4", "f8"])
@pytest.mark.parametrize("several", [True, False])
def test_cells(spark, tmp_path, record, kind, several):
    v = series(kind)
    data = {"spei": v} | ({"other": series("i2", w=7) + 1} if several else {})
    fill = float(v[2, 1, 1])
    (tmp_path / "1991.nc").write_bytes(netcdf.written(data, {"spei": {"_FillValue": fill, "scale_factor": 2.0, "add_offset": 1.0}}, record))
    found = netcdf.slabs(spark, f"file://{tmp_path}", "spei").where("step >= 2")
    assert found.count() == 10
    got = {(r.step, r.row, r.col): r.value for r in netcdf.cells(found, task_bytes=100).collect()}
    want = {(t, i, j): float(v[t, i, j]) * 2 + 1 for t in range(2, 12) for i in range(5) for j in range(7) if float(v[t, i, j]) != fill}
    assert got == want


def test_what_is_not_read(tmp_path):
    data = netcdf.written({"spei": series("f4")})
    read = lambda at, n: data[at : at + n]
    with pytest.raises(ValueError, match="no variable"):
        netcdf.slab_rows("x", read, "rain")
    with pytest.raises(ValueError, match="classic"):
        netcdf.slab_rows("x", lambda at, n: b"\x89HDF\r\n\x1a\n"[at : at + n], "spei")
    with pytest.raises(ValueError, match="ends within"):
        netcdf.slab_rows("x", lambda at, n: data[:40][at : at + n], "spei")
    # a slab's bytes alone are read
    rows, seen = netcdf.slab_rows("x", read, "spei"), []
    assert len(rows) == 12 and rows["size"].eq(5 * 7 * 4).all() and rows["at"].diff().dropna().eq(140).all()
    assert not seen
