"""Zones, grids, and the statistics of cells in zones.

A zone layer has zone_id, name, uf and rings (array of arrays of struct<x, y>); a grid is its origin, and the side of a
cell; cell (i, j) covers [x0 + i r, x0 + (i + 1) r) by [y0 + j r, y0 + (j + 1) r).
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from geohealth.functions import geodesy
from geohealth.sources.scratch import stored

#: A long edge is split so that its box never spans more cells than this in either direction.
EDGE_CELLS = 64


@dataclass(frozen=True)
class Grid:
    x0: float
    y0: float
    r: float


def zone_edges(zones: DataFrame) -> DataFrame:
    """zone_id and the two ends of each edge of each ring; open rings are closed."""
    ring = zones.select("zone_id", F.explode("rings").alias("p")).where(F.size("p") > 2)
    after = F.concat(F.slice("p", 2, F.size("p") - 1), F.slice("p", 1, 1))
    edge = ring.select("zone_id", F.explode(F.arrays_zip(F.col("p").alias("a"), after.alias("b"))).alias("e"))
    ends = edge.select("zone_id", F.col("e.a.x").alias("x1"), F.col("e.a.y").alias("y1"), F.col("e.b.x").alias("x2"), F.col("e.b.y").alias("y2"))
    return ends.where((F.col("x1") != F.col("x2")) | (F.col("y1") != F.col("y2")))


def _cell(v: Column, origin: float, r: float) -> Column:
    return F.floor((v - origin) / r).cast("int")


def touched_cells(edges: DataFrame, grid: Grid) -> DataFrame:
    """Distinct zone_id, i, j of the cells that an edge passes through."""
    parts = F.greatest(F.lit(1), F.ceil(F.greatest(F.abs(F.col("x2") - F.col("x1")), F.abs(F.col("y2") - F.col("y1"))) / (EDGE_CELLS * grid.r)).cast("int"))
    cut = edges.withColumn("_n", parts).withColumn("_k", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    at = lambda a, b, k: F.col(a) + (F.col(b) - F.col(a)) * k / F.col("_n")
    cut = cut.select("zone_id", *[at(a, b, F.col("_k") + d).alias(n) for a, b, d, n in (("x1", "x2", 0, "x1"), ("y1", "y2", 0, "y1"), ("x1", "x2", 1, "x2"), ("y1", "y2", 1, "y2"))])
    span = lambda a, b, o: F.sequence(_cell(F.least(a, b), o, grid.r), _cell(F.greatest(a, b), o, grid.r))
    box = cut.withColumn("i", F.explode(span("x1", "x2", grid.x0))).withColumn("j", F.explode(span("y1", "y2", grid.y0)))
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    cx, cy = grid.x0 + (F.col("i") + 0.5) * grid.r, grid.y0 + (F.col("j") + 0.5) * grid.r
    near = F.abs(dx * (cy - F.col("y1")) - dy * (cx - F.col("x1"))) <= (F.abs(dx) + F.abs(dy)) * (grid.r / 2)
    return box.where(near).select("zone_id", "i", "j").distinct()


def inner_cells(edges: DataFrame, grid: Grid) -> DataFrame:
    """zone_id, i, j of the cells whose centre is inside: between an odd crossing of the row and the next, so holes are out."""
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    rows = edges.withColumn("j", F.explode(F.sequence(_cell(low, grid.y0, grid.r), _cell(high, grid.y0, grid.r))))
    cy = grid.y0 + (F.col("j") + 0.5) * grid.r
    hit = rows.where((low <= cy) & (cy < high)).withColumn("x", F.col("x1") + (cy - F.col("y1")) * (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1")))
    order = Window.partitionBy("zone_id", "j").orderBy("x")
    spans = hit.withColumn("_n", F.row_number().over(order)).withColumn("_to", F.lead("x").over(order)).where((F.col("_n") % 2 == 1) & F.col("_to").isNotNull())
    first = F.ceil((F.col("x") - grid.x0) / grid.r - 0.5).cast("int")
    last = F.ceil((F.col("_to") - grid.x0) / grid.r - 0.5).cast("int") - 1
    return spans.where(first <= last).select("zone_id", F.explode(F.sequence(first, last)).alias("i"), "j")


def zone_cells(zones: DataFrame, grid: Grid, all_touched: bool = True) -> DataFrame:
    """zone_id, i, j: cells that the zone touches, or those with their centre in it. Edges go to rows and cells by
    arithmetic, so no zone is compared with a cell that it isn't near."""
    edges = zone_edges(zones)
    inside = inner_cells(edges, grid)
    return inside.union(touched_cells(edges, grid)).distinct() if all_touched else inside


def within_bbox(df: DataFrame, west: float, south: float, east: float, north: float, x: str = "lon", y: str = "lat") -> DataFrame:
    """Rows in the box, its sides included."""
    return df.where(F.col(x).between(west, east) & F.col(y).between(south, north))


def extent(zones: DataFrame) -> DataFrame:
    """Total bounds of a layer: xmin, ymin, xmax, ymax."""
    p = zones.select(F.explode(F.flatten("rings")).alias("p"))
    return p.agg(F.min("p.x").alias("xmin"), F.min("p.y").alias("ymin"), F.max("p.x").alias("xmax"), F.max("p.y").alias("ymax"))


def envelope(zones: DataFrame) -> DataFrame:
    """The extent and, as footprint, its closed box as GeoJSON."""
    return extent(zones).withColumn("footprint", geodesy.box_geojson(*[F.col(c) for c in ("xmin", "ymin", "xmax", "ymax")]))


@dataclass(frozen=True)
class CellSpan:
    """Cells i0 .. i1 by j0 .. j1."""

    i0: int
    i1: int
    j0: int
    j1: int


def cell_span(zones: DataFrame, grid: Grid) -> CellSpan | None:
    """The cells of the layer's box, those that a border touches included; None without any point. One row comes back."""
    b = extent(zones).first()
    if b["xmin"] is None:
        return None
    at = lambda v, o: math.floor((v - o) / grid.r)
    return CellSpan(at(b["xmin"], grid.x0) - 1, at(b["xmax"], grid.x0) + 1, at(b["ymin"], grid.y0) - 1, at(b["ymax"], grid.y0) + 1)


def align_grids(tables: Sequence[tuple[DataFrame, Grid]], by: Sequence[str] = ("day",)) -> DataFrame:
    """Cell tables of different origin and step on one grid: by, i, j, lon, lat (centres) and value_0, value_1, ...

    The grid covers the union of the tables' extents with as many whole cells of the first table's step as fit, stretched
    to its sides. A target cell takes, of each table, the value of the cell that holds its centre: it works out that
    cell's numbers, and the join is on equality. Every cell has a row for each combination of `by` in any of the tables,
    with NULL where a table has no such cell. Without any cell there are no rows.
    """
    spans = [df.agg(*[f(c).alias(n + c) for c in "ij" for n, f in (("lo", F.min), ("hi", F.max))]).first() for df, _ in tables]  # a row a table
    known = [(s, g) for s, (_, g) in zip(spans, tables) if s["loi"] is not None]
    spark, names = tables[0][0].sparkSession, [f"value_{k}" for k in range(len(tables))]
    if not known:
        empty = [F.lit(None).cast("int").alias(c) for c in "ij"] + [F.lit(None).cast("double").alias(c) for c in ("lon", "lat", *names)]
        return tables[0][0].where(F.lit(False)).select(*by, *empty)
    west, east = min(g.x0 + s["loi"] * g.r for s, g in known), max(g.x0 + (s["hii"] + 1) * g.r for s, g in known)
    south, north = min(g.y0 + s["loj"] * g.r for s, g in known), max(g.y0 + (s["hij"] + 1) * g.r for s, g in known)
    step = tables[0][1].r
    # a step that fits but for rounding counts; there is one cell at least
    columns, rows = (max(1, math.floor(x / step + 1e-9)) for x in (east - west, north - south))
    dx, dy = (east - west) / columns, (north - south) / rows
    target = spark.range(columns * rows).select((F.col("id") % columns).cast("int").alias("i"), F.floor(F.col("id") / columns).cast("int").alias("j"))
    target = target.withColumn("lon", west + (F.col("i") + 0.5) * dx).withColumn("lat", south + (F.col("j") + 0.5) * dy)
    if by:
        line = reduce(DataFrame.unionByName, [df.select(*by) for df, _ in tables]).distinct().agg(F.collect_list(F.struct(*by)).alias("_line"))  # one row
        target = target.join(F.broadcast(line)).withColumn("_at", F.explode("_line")).select("_at.*", "i", "j", "lon", "lat")
    for name, (df, grid) in zip(names, tables):
        source = df.select(*[F.col(c).alias(f"_{c}") for c in by], F.col("i").alias("_i"), F.col("j").alias("_j"), F.col("value").cast("double").alias(name))
        on = [(_cell(F.col("lon"), grid.x0, grid.r) == F.col("_i")), (_cell(F.col("lat"), grid.y0, grid.r) == F.col("_j")), *[F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]]
        target = target.join(source, reduce(lambda a, b: a & b, on), "left").drop("_i", "_j", *[f"_{c}" for c in by])
    return target.select(*by, "i", "j", "lon", "lat", *names)


def snap_to_grid(df: DataFrame, grid: Grid, x: str = "lon", y: str = "lat") -> DataFrame:
    """Cell numbers i, j of points."""
    return df.withColumn("i", _cell(F.col(x), grid.x0, grid.r)).withColumn("j", _cell(F.col(y), grid.y0, grid.r))


def as_multi(rings: Column) -> Column:
    """A polygon as a collection of one."""
    return F.array(rings)


STATS = {"max": F.max, "min": F.min, "mean": F.avg}


def cell_period_stats(cells: DataFrame, stats: list[str]) -> DataFrame:
    """period_start, i, j and a column for each statistic of value over the days; missing values are skipped."""
    return cells.groupBy("period_start", "i", "j").agg(*[STATS[s]("value").alias(s) for s in stats])


def every_zone(stats: DataFrame, layer: DataFrame, by: list[str]) -> DataFrame:
    """stats with a row for each zone of the layer and each of the combinations of `by` that occur; NULL where there were no cells.

    The statistics, a row a zone and period, are stored first: the timeline of combinations comes from them without the
    cells being read again. It is put into one row, so each zone spreads it in place.
    """
    zones = layer.select("zone_id").distinct()
    if by:
        stats = stored(stats, "zone-stats")
        line = stats.select(*by).distinct().agg(F.collect_list(F.struct(*by)).alias("_line"))  # one row
        zones = zones.join(F.broadcast(line)).withColumn("_at", F.explode("_line")).select("zone_id", "_at.*")
    return zones.join(stats, ["zone_id", *by], "left")


def zonal_stats(surface: DataFrame, members: DataFrame, stat: str, value: str = "value", by: list[str] | None = None, layer: DataFrame | None = None) -> DataFrame:
    """zone_id (and the columns in `by`) with the statistic over the zone's cells; a zone without any value has NULL if `by` is empty.

    With a layer every zone of it has a row, in each combination of `by` too, also if it has no member cells.
    """
    keys = ["zone_id", *(by or [])]
    joined = members.join(surface, ["i", "j"], "inner" if by else "left")
    out = joined.groupBy(*keys).agg(STATS[stat](value).alias(stat))
    return out if layer is None else every_zone(out, layer, by or [])


def period_indicator(cells: DataFrame, members: DataFrame, stats: list[str], layer: DataFrame | None = None) -> DataFrame:
    """zone_id, period_start and the two-level statistics: zone maximum of cell maxima, zone mean of cell means, and so on.

    With a layer every zone of it has a row in every period, NULL where it has no valid cell.
    """
    surface = cell_period_stats(cells, stats)
    out = surface.join(members, ["i", "j"]).groupBy("zone_id", "period_start").agg(*[STATS[s](s).alias(s) for s in stats])
    return out if layer is None else every_zone(out, layer, ["period_start"])


def daily_zone_max(cells: DataFrame, members: DataFrame) -> DataFrame:
    return cells.join(members, ["i", "j"]).groupBy("zone_id", "day").agg(F.max("value").alias("value"))
