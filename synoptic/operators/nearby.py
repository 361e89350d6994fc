"""Problem 6: points near other points, and regions that contain points.

`points_within` covers each point's disc by cells of a cubic grid over the earth (WGS84 positions in km), so poles and the
date line are like any other place. The cover is adaptive: coarse cells (edge = the radius) everywhere; where a coarse
cell holds more than DENSE points, its 64 sub-cells take its place. A sub-cell that lies wholly in the disc joins on the
cell alone and its points are accepted at once; only cells that the disc's rim crosses get the exact distance.

`points_in_regions` covers polygons in the same way: quadtree cells over longitude and latitude that lie inside a polygon
accept by equality; a cell on its border has the few edges that touch it and a point of which it is known on which side it
lies, from where an exact test counts crossings, in the JVM.

Nulls, NaN, impossible coordinates and (0, 0) leave a point out. Longitudes above 180 count on eastward. Points at the
same place are near one another. Repeated rows of one id count once. Empty tables give empty results.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from synoptic.runtime import Scratch

#: A coarse cell with more points is split.
DENSE = 32
SPLIT = 4
#: The least edge of a cell: 2^20 of them reach from the middle of the earth to its surface.
LEAST_KM = 0.0065
#: WGS84, in km.
EQUATOR, ECCENTRICITY2 = 6378.137, 6.69437999014e-3


def usable(lat: Column, lon: Column) -> Column:
    return F.coalesce(~F.isnan(lat) & ~F.isnan(lon) & lat.between(-90, 90) & (lon >= -180) & (lon <= 360) & ~((lat == 0) & (lon == 0)), F.lit(False))


def position(lat: Column, lon: Column) -> list[Column]:
    """x, y, z in km on the ellipsoid."""
    phi, lam = F.radians(lat), F.radians(lon)
    n = F.lit(EQUATOR) / F.sqrt(1 - F.lit(ECCENTRICITY2) * F.sin(phi) * F.sin(phi))
    return [(n * F.cos(phi) * F.cos(lam)).alias("x"), (n * F.cos(phi) * F.sin(lam)).alias("y"), (n * (1 - ECCENTRICITY2) * F.sin(phi)).alias("z")]


def _nearest2(cell: list[Column], edge: float) -> Column:
    """Square of the distance from (x, y, z) to the nearest place of a cell."""
    gaps = [F.greatest(c * edge - F.col(a), F.col(a) - (c + 1) * edge, F.lit(0.0)) for c, a in zip(cell, "xyz", strict=True)]
    return sum((g * g for g in gaps[1:]), gaps[0] * gaps[0])


def _farthest2(cell: list[Column], edge: float) -> Column:
    gaps = [F.greatest((c + 1) * edge - F.col(a), F.col(a) - c * edge) for c, a in zip(cell, "xyz", strict=True)]
    return sum((g * g for g in gaps[1:]), gaps[0] * gaps[0])


def _cell_id(cell: list[Column]) -> Column:
    """Cells lie within 2^20 of the middle along each axis, for edges over LEAST_KM."""
    low = [(c + F.lit(1 << 20)).cast("bigint") for c in cell]
    return F.shiftleft(low[0], 42).bitwiseOR(F.shiftleft(low[1], 21)).bitwiseOR(low[2])


def _around(cell: list[Column], reach: int) -> Column:
    """All cells from -reach to +reach along each axis, as an array of structs."""
    def span(c: Column) -> Column:
        return F.sequence((c - reach).cast("int"), (c + reach).cast("int"))

    return F.flatten(F.transform(span(cell[0]), lambda i: F.flatten(F.transform(span(cell[1]), lambda j: F.transform(span(cell[2]), lambda k: F.struct(i.alias("i"), j.alias("j"), k.alias("k")))))))


def own_cell(km: float) -> Column:
    """The cell of edge `km` that holds (x, y, z)."""
    return _cell_id([F.floor(F.col(a) / km) for a in "xyz"])


def near_cells(points: DataFrame, km: float, edge: float | None = None) -> DataFrame:
    """Each row of (..., x, y, z) once for each cell of an edge (`km` or more; `km` where it is not given) that has places
    within `km` of it, as `cell`."""
    edge = edge or km
    if edge < max(LEAST_KM, km):
        raise ValueError(f"cells of {edge} km: their numbers hold for {LEAST_KM} km or more, and they may not be under {km}")
    out = points.withColumn("c", F.explode(_around([F.floor(F.col(a) / edge) for a in "xyz"], 1)))
    box = [F.col("c.i"), F.col("c.j"), F.col("c.k")]
    return out.where(_nearest2(box, edge) <= km * km).withColumn("cell", _cell_id(box)).drop("c")


def points_within(points: DataFrame, key: str, lat: str, lon: str, km: float) -> DataFrame:
    """(a, b), a < b: ids of points at most `km` apart on the ground (as a chord of the ellipsoid, which is shorter than
    the way along the ground by under 1e-7 at 10 km)."""
    if km / SPLIT < LEAST_KM:
        raise ValueError(f"cells of {km / SPLIT} km: their numbers hold for {LEAST_KM} km or more")
    edge, fine = km, km / SPLIT
    valid = points.where(F.col(key).isNotNull() & usable(F.col(lat), F.col(lon))).groupBy(F.col(key).alias("id")).agg(F.min(F.struct(F.col(lat).alias("lat"), F.col(lon).alias("lon"))).alias("p"))
    at = valid.select("id", *position(F.col("p.lat"), F.col("p.lon")))
    coarse = [F.floor(F.col(a) / edge) for a in "xyz"]
    small = [F.floor(F.col(a) / fine) for a in "xyz"]
    placed = at.withColumn("cell", _cell_id(coarse))
    # At most SPLIT^3 sub-cells a cell, of which a surface passes through a quarter: only those that hold points are probed.
    subs = placed.groupBy("cell", *[c.cast("int").alias(n) for c, n in zip(small, "ijk", strict=True)]).agg(F.count("*").alias("n"))
    filled = subs.groupBy("cell").agg((F.sum("n") > DENSE).alias("dense"), F.collect_list(F.struct("i", "j", "k")).alias("subs")).withColumn("subs", F.when(F.col("dense"), F.col("subs")))

    probes = at.select("id", "x", "y", "z", F.explode(_around(coarse, 1)).alias("c")).select("id", "x", "y", "z", "c.i", "c.j", "c.k")
    box = [F.col("i"), F.col("j"), F.col("k")]
    r2 = km * km
    probes = probes.where(_nearest2(box, edge) <= r2).withColumn("cell", _cell_id(box)).join(filled, "cell")

    def joined(left: DataFrame, right: DataFrame) -> DataFrame:
        other = right.select("cell", F.col("id").alias("b"), F.col("x").alias("x2"), F.col("y").alias("y2"), F.col("z").alias("z2"))
        gaps = [(F.col(a) - F.col(a + "2")) * (F.col(a) - F.col(a + "2")) for a in "xyz"]
        return left.join(other, "cell").where((F.col("id") < F.col("b")) & (F.col("inside") | (sum(gaps[1:], gaps[0]) <= r2))).select(F.col("id").alias("a"), "b")

    sparse = joined(probes.where("not dense").select("id", "x", "y", "z", "cell", F.lit(False).alias("inside")), placed)
    finer = probes.where("dense").select("id", "x", "y", "z", F.explode("subs").alias("c")).select("id", "x", "y", "z", "c.i", "c.j", "c.k")
    finer = finer.where(_nearest2(box, fine) <= r2).select("id", "x", "y", "z", _cell_id(box).alias("cell"), (_farthest2(box, fine) <= r2).alias("inside"))
    return sparse.union(joined(finer, at.withColumn("cell", _cell_id(small))))


_EDGE = T.StructType([T.StructField(c, T.DoubleType()) for c in ("x1", "y1", "x2", "y2")])
_CELL = T.StructType([T.StructField("cell", T.LongType()), T.StructField("level", T.IntegerType()), T.StructField("inside", T.BooleanType()), T.StructField("rx", T.DoubleType()), T.StructField("ry", T.DoubleType()), T.StructField("edges", T.ArrayType(_EDGE))])
#: A border cell with more edges is split further, down to a level; and where in a cell its reference point lies (off the
#: places at which corners tend to be).
MANY_EDGES, DEEPEST = 16, 22
REFERENCE = 0.51371, 0.48713


def _touching(e: np.ndarray, x0: float, y0: float, side: float) -> np.ndarray:
    """Which edges (x1, y1, x2, y2) touch a box, by clipping."""
    low, high = np.zeros(len(e)), np.ones(len(e))
    for d, start, lo in ((e[:, 2] - e[:, 0], e[:, 0], x0), (e[:, 3] - e[:, 1], e[:, 1], y0)):
        flat = d == 0
        safe = np.where(flat, 1.0, d)
        t0, t1 = (lo - start) / safe, (lo + side - start) / safe
        low = np.where(flat, low, np.maximum(low, np.minimum(t0, t1)))
        high = np.where(flat, np.where((start < lo) | (start > lo + side), -1.0, high), np.minimum(high, np.maximum(t0, t1)))
    return low <= high


def _crossed(e: np.ndarray, xa: float, ya: float, xb: float, yb: float) -> int:
    """How many edges the way from a along the parallel and then along the meridian to b crosses."""
    count = 0
    for u1, v1, u2, v2, at, start, end in ((e[:, 0], e[:, 1], e[:, 2], e[:, 3], ya, xa, xb), (e[:, 1], e[:, 0], e[:, 3], e[:, 2], xb, ya, yb)):
        hit = (v1 > at) != (v2 > at)
        where = (u2[hit] - u1[hit]) * (at - v1[hit]) / (v2[hit] - v1[hit]) + u1[hit]
        count += int(((where > min(start, end)) & (where <= max(start, end))).sum())
    return count


@F.pandas_udf(T.ArrayType(_CELL))
def polygon_cover(rings: pd.Series, max_level: pd.Series) -> pd.Series:
    """Quadtree cells over the world (level 0: one cell of 360 degrees) that cover a polygon [[lon, lat], ...]. An inner cell
    is not split; one on the border is until max_level, and further while it has many edges. A border cell has the edges
    that touch it and a reference point (rx, ry), which `inside` speaks of: a point of the cell is on the same side if the
    way to it crosses an even number of those edges. Work is shared from cell to cell: a cell looks at its parent's edges
    only."""

    def cover(ring, deepest: int) -> list[dict]:
        pts = np.array([(float(p[0]), float(p[1])) for p in ring] if ring is not None else [], float).reshape(-1, 2)
        if len(pts) < 3:
            return []
        edges = np.c_[pts, np.roll(pts, -1, axis=0)]
        # The world's corner lies outside every polygon.
        todo, out = [(0, 0, 0, edges, bool(_crossed(edges, -180.0, -180.0, -180 + 360 * REFERENCE[0], -180 + 360 * REFERENCE[1]) % 2))], []
        while todo:
            level, i, j, e, inside = todo.pop()
            side = 360.0 / (1 << level)
            rx, ry = -180 + (i + REFERENCE[0]) * side, -180 + (j + REFERENCE[1]) * side
            if not len(e):
                if inside:
                    out.append({"cell": (i << 24) | j, "level": level, "inside": True, "rx": None, "ry": None, "edges": None})
            elif level < deepest or (len(e) > MANY_EDGES and level < DEEPEST):
                half = side / 2
                for a, b in ((2 * i, 2 * j), (2 * i + 1, 2 * j), (2 * i, 2 * j + 1), (2 * i + 1, 2 * j + 1)):
                    x, y = -180 + (a + REFERENCE[0]) * half, -180 + (b + REFERENCE[1]) * half
                    todo.append((level + 1, a, b, e[_touching(e, -180 + a * half, -180 + b * half, half)], inside ^ bool(_crossed(e, rx, ry, x, y) % 2)))
            else:
                out.append({"cell": (i << 24) | j, "level": level, "inside": inside, "rx": rx, "ry": ry, "edges": [dict(zip(("x1", "y1", "x2", "y2"), map(float, row), strict=True)) for row in e]})
        return out

    return pd.Series([cover(r, int(m)) for r, m in zip(rings, max_level, strict=True)])


def _on_other_side(edges: Column, rx: Column, ry: Column, px: Column, py: Column) -> Column:
    """Whether the way from (rx, ry) to (px, py) crosses an odd number of edges."""
    def crossing(u1, v1, u2, v2, at, start, end) -> Column:  # noqa: ANN001
        where = (u2 - u1) * (at - v1) / F.nullif(v2 - v1, F.lit(0.0)) + u1
        return ((v1 > at) != (v2 > at)) & (where > F.least(start, end)) & (where <= F.greatest(start, end))

    along = F.filter(edges, lambda e: crossing(e["x1"], e["y1"], e["x2"], e["y2"], ry, rx, px))
    up = F.filter(edges, lambda e: crossing(e["y1"], e["x1"], e["y2"], e["x2"], px, ry, py))
    return (F.size(along) + F.size(up)) % 2 == 1


def points_in_regions(points: DataFrame, key: str, lat: str, lon: str, regions: DataFrame, region: str, ring: str, max_level: int = 12, name: str = "regions") -> DataFrame:
    """(id, region): the regions that hold each point. `ring` is an array of [lon, lat] within -180..180; a region across
    the date line is given as two rows. Of a point on a border it is not defined on which side it lies."""
    wrapped = F.pmod(F.col(lon) + 180, F.lit(360.0)) - 180
    at = points.where(F.col(key).isNotNull() & usable(F.col(lat), F.col(lon))).select(F.col(key).alias("id"), wrapped.alias("px"), F.col(lat).alias("py")).distinct()
    given = regions.where(F.col(region).isNotNull() & F.col(ring).isNotNull()).select(F.col(region).alias("region"), F.col(ring).alias("ring"))
    cells = Scratch(points.sparkSession, name).write(given.select("region", F.explode(polygon_cover("ring", F.lit(max_level))).alias("c")).select("region", "c.*"))
    levels = sorted(r["level"] for r in cells.select("level").distinct().collect())  # at most DEEPEST + 1
    steps = F.array(*[F.struct(F.lit(v).alias("level"), F.floor((F.col("px") + 180) / 360 * (1 << v)).alias("i"), F.floor((F.col("py") + 180) / 360 * (1 << v)).alias("j")) for v in levels or [0]])
    keyed = at.select("id", "px", "py", F.explode(steps).alias("s")).select("id", "px", "py", F.col("s.level").alias("level"), F.shiftleft(F.col("s.i"), 24).bitwiseOR(F.col("s.j")).alias("cell"))
    met = keyed.join(cells, ["level", "cell"])
    held = F.when(F.col("edges").isNull(), F.lit(True)).otherwise(F.col("inside") != _on_other_side(F.col("edges"), F.col("rx"), F.col("ry"), F.col("px"), F.col("py")))
    return met.where(held).select("id", "region").distinct()


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance on a sphere of the earth's mean radius."""
    h = F.pow(F.sin(F.radians(lat2 - lat1) / 2), F.lit(2.0)) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), F.lit(2.0))
    return F.lit(2 * 6371.0088) * F.asin(F.least(F.lit(1.0), F.sqrt(h)))


