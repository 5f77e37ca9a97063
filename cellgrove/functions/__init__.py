"""Column expressions. Everything here stays inside whole-stage code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rnd(x: Column, digits: int = 0) -> Column:
    """Half-to-even rounding of the scaled double: rint(x * 10^d) / 10^d, as numpy rounds."""
    return F.rint(x * F.lit(10.0**digits)) / F.lit(10.0**digits) if digits else F.rint(x)


def whole(x: Column) -> Column:
    """Rounded to a long; nulls and infinities are 0."""
    return F.rint(clean(x)).cast("long")


def clean(x: Column) -> Column:
    """A number that can be summed: text is read (0 if it isn't a number), null, NaN, infinities are 0."""
    d = x.try_cast("double")
    return F.when(d.isNull() | F.isnan(d) | (F.abs(d) == F.lit(float("inf"))), F.lit(0.0)).otherwise(d)


def nan_to_null(x: Column) -> Column:
    return F.when(~F.isnan(x), x)


def ratio(a: Column, b: Column, scale: float = 100.0, digits: int | None = 2, empty: float | None = 0.0) -> Column:
    """a / b * scale, rounded; ``empty`` where b is 0 or null, or a is null."""
    r = F.try_divide(a.cast("double"), b.cast("double")) * F.lit(scale)
    r = r if digits is None else rnd(r, digits)
    return r if empty is None else F.coalesce(r, F.lit(float(empty)))


def geometric_mean(a: Column, b: Column) -> Column:
    """Square root of the product; null where the product is negative."""
    p = a * b
    return F.when(p >= 0, F.sqrt(p))


def row_mean(*columns: Column) -> Column:
    """Mean of the values that aren't null; null if all are."""
    n = sum((c.isNotNull().cast("int") for c in columns), F.lit(0))
    total = sum((F.coalesce(c.cast("double"), F.lit(0.0)) for c in columns), F.lit(0.0))
    return F.when(n > 0, total / n)


def row_sum(*columns: Column) -> Column:
    return sum((F.coalesce(c.cast("double"), F.lit(0.0)) for c in columns), F.lit(0.0))


# ---- classes (fixed values)


def storm_class(category: Column) -> Column:
    """Saffir-Simpson 1 -> 1, 2 and 3 -> 2, 4 and 5 -> 3, else 0."""
    return F.when(category == 1, 1).when(category.isin(2, 3), 2).when(category.isin(4, 5), 3).otherwise(0)


def drought_class(months: Column, bounds: tuple[int, int, int] = (18, 36, 54)) -> Column:
    """Event months: none 0, up to each bound 1, 2, 3, beyond 4."""
    out = F.when(F.coalesce(months, F.lit(0)) <= 0, 0)
    for k, b in enumerate(bounds, 1):
        out = out.when(months <= b, k)
    return out.otherwise(4)


def settlement_class(code: Column) -> Column:
    """11, 12, 13 rural (1); 21, 22, 23, 30 urban (2); everything else no data (0)."""
    return F.when(code.isin(11, 12, 13), 1).when(code.isin(21, 22, 23, 30), 2).otherwise(0)


def exceeds(x: Column, threshold: float) -> Column:
    """1 where x is above the threshold; 0 elsewhere, nulls and NaN included."""
    return F.when(~F.isnan(x) & (x > F.lit(threshold)), 1).otherwise(0)


# ---- geographic scalars


def pixel_metres(degrees: Column | float) -> Column:
    """Size of a geographic pixel for travel costs: 111,000 m a degree."""
    return (degrees if isinstance(degrees, Column) else F.lit(float(degrees))) * F.lit(111000.0)


def pixel_metres_at(degrees: Column | float, latitude: Column) -> Column:
    """Size of a geographic pixel for block sums: 111,320 m a degree times cos(latitude within 60)."""
    d = degrees if isinstance(degrees, Column) else F.lit(float(degrees))
    return d * F.lit(111320.0) * F.cos(F.radians(F.greatest(F.lit(-60.0), F.least(F.lit(60.0), latitude))))


def footprint_cells(x_min: Column, y_min: Column, x_max: Column, y_max: Column, size: float) -> Column:
    """Cells of a bounding box at a resolution, both sides rounded up."""
    return F.ceil((x_max - x_min) / F.lit(size)) * F.ceil((y_max - y_min) / F.lit(size))


def analysis_scale(cells: float, pixel_m: float, cap: float = 10_000_000, target_m: float = 500.0) -> float:
    """By how much a grid is coarsened before path search: 1 within the cap."""
    return 1.0 if cells <= cap else max((cells / cap) ** 0.5, target_m / pixel_m)


def analysis_scale_of(cells: Column, pixel_m: float, cap: float = 10_000_000, target_m: float = 500.0) -> Column:
    """The same of a column."""
    return F.when(cells <= cap, F.lit(1.0)).otherwise(F.greatest(F.sqrt(cells / F.lit(cap)), F.lit(target_m / pixel_m)))


def pixel_km2(latitude: Column, width: float, height: float) -> Column:
    """Area of a cell of so many degrees at a latitude."""
    return F.lit(abs(width) * 111.32) * F.cos(F.radians(latitude)) * F.lit(abs(height) * 111.32)


def utm_zone(longitude: Column, latitude: Column) -> Column:
    """EPSG code of the UTM zone, the zone kept within 1 to 60."""
    zone = F.least(F.lit(60), F.greatest(F.lit(1), (F.floor((longitude + 180) / 6) + 1).cast("int")))
    return F.when(latitude >= 0, F.lit(32600)).otherwise(F.lit(32700)) + zone


def utm_forward(longitude: Column, latitude: Column, zone: int) -> tuple[Column, Column]:
    """Easting and northing (northern hemisphere's false origin) on WGS 84, series to order e^6 and A^6."""
    a, f, k0 = 6378137.0, 1 / 298.257223563, 0.9996
    e2 = f * (2 - f)
    ep2 = e2 / (1 - e2)
    phi, lam = F.radians(latitude), F.radians(longitude - F.lit(zone * 6.0 - 183.0))
    s, c = F.sin(phi), F.cos(phi)
    n = F.lit(a) / F.sqrt(1 - e2 * s * s)
    t, cc, A = F.tan(phi) * F.tan(phi), ep2 * c * c, lam * c
    m = a * (
        (1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256) * phi
        - (3 * e2 / 8 + 3 * e2**2 / 32 + 45 * e2**3 / 1024) * F.sin(2 * phi)
        + (15 * e2**2 / 256 + 45 * e2**3 / 1024) * F.sin(4 * phi)
        - (35 * e2**3 / 3072) * F.sin(6 * phi)
    )
    A2 = A * A
    x = k0 * n * (A + (1 - t + cc) * A2 * A / 6 + (5 - 18 * t + t * t + 72 * cc - 58 * ep2) * A2 * A2 * A / 120) + 500000.0
    y = k0 * (m + n * F.tan(phi) * (A2 / 2 + (5 - t + 9 * cc + 4 * cc * cc) * A2 * A2 / 24 + (61 - 58 * t + t * t + 600 * cc - 330 * ep2) * A2 * A2 * A2 / 720))
    return x, y


def mollweide_forward(longitude: Column, latitude: Column, steps: int = 12) -> tuple[Column, Column]:
    """World Mollweide on the authalic-radius sphere of the settlement grid, by Newton steps."""
    r = 6378137.0
    phi = F.radians(latitude)
    target = F.lit(3.141592653589793) * F.sin(phi)

    def step(theta: Column, _: Column) -> Column:
        slope = 2 + 2 * F.cos(2 * theta)
        return F.when(slope > 1e-9, theta - (2 * theta + F.sin(2 * theta) - target) / slope).otherwise(theta)

    # a fold keeps the expression small: unrolled steps would each repeat all earlier ones
    theta = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), phi.cast("double"), step)
    return F.lit(r * 2 * 2**0.5 / 3.141592653589793) * F.radians(longitude) * F.cos(theta), F.lit(r * 2**0.5) * F.sin(theta)


def tile_xyz(longitude: Column, latitude: Column, zoom: int) -> tuple[Column, Column]:
    """Column and row of the web-map tile at a zoom level."""
    n = float(1 << zoom)
    lat = F.radians(F.greatest(F.lit(-85.0511287798066), F.least(F.lit(85.0511287798066), latitude)))
    x = F.floor((longitude + 180.0) / 360.0 * n)
    y = F.floor((1.0 - F.log(F.tan(lat) + 1 / F.cos(lat)) / 3.141592653589793) / 2.0 * n)
    inside = lambda v: F.greatest(F.lit(0), F.least(F.lit(int(n) - 1), v)).cast("long")
    return inside(x), inside(y)
