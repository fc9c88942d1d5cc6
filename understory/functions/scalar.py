"""Scalar functions as column expressions: they stay inside code generation."""

from __future__ import annotations

import math

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from ..model import QUALITY


def p_dist(a: Column, b: Column) -> Column:
    """Euclidean distance of two arrays of equal length; other lengths are an error."""
    d = F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))
    return F.when(F.size(a) == F.size(b), d).otherwise(F.raise_error(F.lit("points differ in their number of coordinates")).cast("double"))


def point_circle_distance(x: Column, y: Column, cx: Column, cy: Column, r: Column) -> Column:
    return F.abs(F.sqrt((x - cx) * (x - cx) + (y - cy) * (y - cy)) - r)


def point_center_angle(x: Column, y: Column, cx: Column, cy: Column) -> Column:
    """Degrees from -180 to 180."""
    return F.degrees(F.atan2(y - cy, x - cx))


def angle_bin(degrees: Column, width: float = 10.0) -> Column:
    return F.floor(F.when(degrees < 0, degrees + 360).otherwise(degrees) / width)


def cell(v: Column, size: float, start: float = 0.0) -> Column:
    """Integer grid key; boundaries belong to the upper cell."""
    return F.floor((v - F.lit(float(start))) / F.lit(float(size))).cast("long")


def cell_centre(key: Column, size: float, start: float = 0.0) -> Column:
    return key * F.lit(float(size)) + F.lit(float(start) + size / 2)


def finite(v: Column) -> Column:
    """NULL for NaN and infinities."""
    v = v.cast("double")
    return F.when(F.isnan(v) | (F.abs(v) == F.lit(math.inf)), None).otherwise(v)


def non_negative(v: Column) -> Column:
    """Negative codes mean missing."""
    v = finite(v)
    return F.when(v >= 0, v)


def identity_seed(seed: int, dimension: Column, instance: Column) -> Column:
    text = F.concat(dimension, F.lit(":"), instance.cast("string"))
    codes = F.transform(F.split(text, ""), lambda c: F.ascii(c).cast("long"))
    return F.aggregate(codes, F.lit(seed % 2147483647).cast("long"), lambda s, b: (s * 131 + b) % 2147483647)


def quality_label(code: Column, dbh: Column) -> Column:
    named = F.coalesce(*[F.when(code == k, v) for k, v in QUALITY.items()], F.lit("measurement_unavailable"))
    return F.when(dbh.isNull(), "dbh_unavailable").otherwise(named)


def edge_weight(d: Column, verticality: Column, sphericity: Column, linearity: Column, v_w: float, s_w: float, l_w: float, voxel: float) -> Column:
    w = d * d + ((1 - verticality) * v_w + sphericity * s_w + linearity * l_w) * voxel
    return F.when(w < 0, F.lit(1e-5 * voxel)).otherwise(w)


def geojson_polygon(ring: Column) -> Column:
    """GeoJSON text of an array of (x, y) structs: closed, millimetres."""
    closed = F.concat(ring, F.slice(ring, 1, 1))
    points = F.transform(closed, lambda p: F.format_string("[%.3f,%.3f]", p["x"], p["y"]))
    return F.when(F.size(ring) > 0, F.concat(F.lit('{"type":"Polygon","coordinates":[['), F.array_join(points, ","), F.lit("]]}")))


def ring_area(ring: Column) -> Column:
    """Shoelace area, shifted to the first vertex; fewer than three vertices have none."""
    n = F.size(ring)
    steps = F.transform(F.sequence(F.lit(1), n), lambda i: (F.element_at(ring, i)["x"] - ring[0]["x"]) * (F.element_at(ring, i % n + 1)["y"] - ring[0]["y"]) - (F.element_at(ring, i % n + 1)["x"] - ring[0]["x"]) * (F.element_at(ring, i)["y"] - ring[0]["y"]))
    return F.when(n >= 3, F.abs(F.aggregate(steps, F.lit(0.0), lambda s, x: s + x)) / 2)


def in_ring(x: Column, y: Column, ring: list[tuple[float, float]]) -> Column:
    """Even-odd rule on a literal ring."""
    odd = F.lit(False)
    for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
        if y1 != y2:
            odd = odd != (((y > y1) != (y > y2)) & (x < (x2 - x1) * (y - y1) / (y2 - y1) + x1))
    return odd


def in_polygons(x: Column, y: Column, polygons) -> Column:
    """Is (x, y) in one of the polygons? A polygon is a list of rings, the outer one and its holes."""
    out = F.lit(False)
    for rings in polygons:
        odd = F.lit(False)
        for r in rings:
            odd = odd != in_ring(x, y, list(r))
        out = out | odd
    return out


def polygons_area(polygons) -> float:
    """Area of the union of the polygons: holes are left out and what several cover counts once. Between the heights at
    which edges begin, end or cross, the union is made of trapezoids, measured at their middle."""
    edges = [(i, *(a + b if a[1] < b[1] else b + a)) for i, rings in enumerate(polygons) for r in rings for a, b in zip(map(tuple, r), [*map(tuple, r[1:]), tuple(r[0])]) if a[1] != b[1]]
    at = {y for _, _, y0, _, y1 in edges for y in (y0, y1)}
    for j, (_, ax, ay, bx, by) in enumerate(edges):
        for _, cx, cy, dx, dy in edges[:j]:
            det = (bx - ax) * (dy - cy) - (by - ay) * (dx - cx)
            if det:
                t, u = ((cx - ax) * (dy - cy) - (cy - ay) * (dx - cx)) / det, ((cx - ax) * (by - ay) - (cy - ay) * (bx - ax)) / det
                if 0 < t < 1 and 0 <= u <= 1:
                    at.add(ay + t * (by - ay))
    total, ys = 0.0, sorted(at)
    for low, high in zip(ys, ys[1:]):
        mid, inside, start = (low + high) / 2, set(), 0.0
        for x, i in sorted((x0 + (mid - y0) / (y1 - y0) * (x1 - x0), i) for i, x0, y0, x1, y1 in edges if y0 < mid < y1):
            was = bool(inside)
            inside ^= {i}
            if inside and not was:
                start = x
            elif was and not inside:
                total += (x - start) * (high - low)
    return total


def utm_to_wgs84(x: Column, y: Column, epsg: int) -> tuple[Column, Column]:
    """(longitude, latitude) of UTM coordinates on WGS 84 (EPSG 326zz north, 327zz south), by the inverse series."""
    if not (32601 <= epsg <= 32660 or 32701 <= epsg <= 32760):
        raise ValueError(f"EPSG {epsg} isn't UTM on WGS 84")
    zone, south = epsg % 100, epsg >= 32700
    a, f, k0 = 6378137.0, 1 / 298.257223563, 0.9996
    n = f / (2 - f)
    big = a / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    beta = (n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96, n**2 / 48 + n**3 / 15, 17 * n**3 / 480)
    delta = (2 * n - 2 * n**2 / 3 - 2 * n**3, 7 * n**2 / 3 - 8 * n**3 / 5, 56 * n**3 / 15)
    xi = (y - (10_000_000.0 if south else 0.0)) / (k0 * big)
    eta = (x - 500_000.0) / (k0 * big)
    xi1, eta1 = xi, eta
    for j, b in enumerate(beta, 1):
        xi1 = xi1 - b * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        eta1 = eta1 - b * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    chi = F.asin(F.sin(xi1) / F.cosh(eta1))
    lat = chi
    for j, d in enumerate(delta, 1):
        lat = lat + d * F.sin(2 * j * chi)
    return F.degrees(F.atan2(F.sinh(eta1), F.cos(xi1))) + (zone * 6 - 183), F.degrees(lat)


def register(spark: SparkSession) -> None:
    """SQL names for the functions."""
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION p_dist(a ARRAY<DOUBLE>, b ARRAY<DOUBLE>) RETURNS DOUBLE RETURN sqrt(aggregate(zip_with(a, b, (x, y) -> (x - y) * (x - y)), 0D, (s, x) -> s + x))")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION point_circle_distance(x DOUBLE, y DOUBLE, cx DOUBLE, cy DOUBLE, r DOUBLE) RETURNS DOUBLE RETURN abs(sqrt((x - cx) * (x - cx) + (y - cy) * (y - cy)) - r)")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION point_center_angle(x DOUBLE, y DOUBLE, cx DOUBLE, cy DOUBLE) RETURNS DOUBLE RETURN degrees(atan2(y - cy, x - cx))")
