"""Grid coordinates, grid -> region mapping (point in polygon), profiles.

Point-in-polygon plan (``points_in_polygons``): a hierarchical cell index.

1. polygons: a bounding box per polygon and its rings in pieces of at most
   ``PIECE_EDGES`` edges, a row each, so no task builds arrays of a whole
   polygon; the box is cut into square cells of the coarsest side (``tile``
   times ``FAN ** (LEVELS - 1)``) and a cell has a row for each piece in it;
2. a cell keeps the edges that touch it, and of those right of it only the
   heights where they start or end an odd number of times: a rightward ray
   crosses all of them as often, odd or even, as there are such heights at or
   below it (an edge's two ends switch it on and off; neighbours in a ring
   cancel).  A cell that no edge touches lies wholly inside or outside its
   polygon, and its points need no ray cast.  A cell touched by at most
   ``LEAF_EDGES`` edges is a leaf.  Any other is cut into ``FAN ** 2`` cells of
   the next level, down to ``tile``: small cells only along dense boundaries.
   Rows of a cell are packed to about ``PIECE_EDGES`` edges at each level;
3. the index is one row per (level, cell) with an array of the polygons there;
   points look their cell up once per level in an outer join on unique keys.
   No row fans out in a join, so points need no id and never meet as pairs,
   and a point keeps only its hits from one join to the next;
   both sides are shuffled by cell, where AQE splits a crowded cell;
4. a point in a whole cell is a hit; in a leaf the even-odd count and the
   on-boundary test over the leaf's few edges decide -- exact, strict *within*;
5. hits explode outer: one row per containing polygon, one with NULL codes for
   a point inside none.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..catalogue import EMD_CD, EMD_NM, HJD_CD, HJD_NM
from ..functions.geometry import chain_edges, strictly_within, tm_to_lonlat

#: Side of the finest cells, sides' ratio of neighbouring levels, levels, and
#: edges that a cell may hold without being cut further, and about the most
#: edges in a row of a cell that is cut (at least LEAF_EDGES).
DEFAULT_TILE_DEG = 0.0125
FAN = 4
LEVELS = 4
LEAF_EDGES = 16
PIECE_EDGES = 1024


def grid_from_rows(rows: DataFrame, keys=()) -> DataFrame:
    """2-D coordinates, one input row per grid row ``(y, lat array, lon array)``
    -> (grid_idx, lat, lon) with row-major ``grid_idx = y * nx + x``.
    ``keys`` name columns that tell several grids apart."""
    ex = rows.select(*keys, "y", F.size("lat").alias("nx"),
                     F.posexplode(F.arrays_zip("lat", "lon")).alias("x", "p"))
    return ex.select(*keys, (F.col("y").cast("long") * F.col("nx") + F.col("x")).alias("grid_idx"),
                     F.col("p.lat").alias("lat"), F.col("p.lon").alias("lon"))


def grid_from_axes(axes: DataFrame, keys=(), partitions: int | None = None) -> DataFrame:
    """1-D axes ``(lat array, lon array)``, one record per grid -> the mesh,
    latitude outer and longitude inner: ``grid_idx = i * n_lon + j``.

    Two generators, no join.  The latitude rows are redistributed before
    the inner explode so one large grid is produced by many tasks.
    ``keys`` name columns that tell several grids apart.
    """
    spark = axes.sparkSession
    partitions = partitions or spark.sparkContext.defaultParallelism
    rows = (axes.select(*keys, F.posexplode("lat").alias("i", "lat"), F.col("lon"))
                .repartition(partitions, *keys, "i"))
    ex = rows.select(*keys, "i", "lat", F.size("lon").alias("n_lon"), F.posexplode("lon").alias("j", "lon"))
    return ex.select(*keys, (F.col("i").cast("long") * F.col("n_lon") + F.col("j")).alias("grid_idx"),
                     "lat", "lon")


def reproject_rings(polys: DataFrame, rings_col: str = "rings") -> DataFrame:
    """Polygon vertices from the projected CRS (EPSG:5179) to lon/lat,
    vertices only.  With an ``epsg`` column, rows already in lon/lat (4326)
    are left as they are, like a layer whose CRS needs no conversion."""
    def ring_ll(ring):
        def pt(p):
            lon, lat = tm_to_lonlat(p["x"], p["y"])
            return F.struct(lon.alias("x"), lat.alias("y"))
        return F.transform(ring, pt)
    moved = F.transform(F.col(rings_col), ring_ll)
    if "epsg" in polys.columns:
        moved = F.when(F.col("epsg") == F.lit(4326), F.col(rings_col)).otherwise(moved)
    return polys.withColumn(rings_col, moved)


def _prepared(polys: DataFrame, code_col: str, name_col: str) -> DataFrame:
    """(pid, code, name, box, k, edges): the rings of each polygon in pieces."""
    def bound(pick, axis: str) -> Column:
        none = F.lit(None).cast("double")
        return F.aggregate("rings", none, lambda a, r: F.aggregate(r, a, lambda b, p: pick(b, p[axis].cast("double"))))

    boxed = polys.where(~F.exists("rings", lambda r: r.isNull())).select(
        F.monotonically_increasing_id().alias("pid"), F.col(code_col).alias("code"), F.col(name_col).alias("name"), "rings",
        bound(F.least, "x").alias("minx"), bound(F.greatest, "x").alias("maxx"),
        bound(F.least, "y").alias("miny"), bound(F.greatest, "y").alias("maxy"))
    box = ["minx", "maxx", "miny", "maxy"]
    # the id in a step of its own: beside a generator it would number rings
    rings = boxed.select("pid", "code", "name", *box, F.explode("rings").alias("ring")).where(F.size("ring") >= 2)
    n = F.size("ring")
    points = F.transform(F.sequence(F.lit(1), n, F.lit(PIECE_EDGES)), lambda i: F.concat(
        F.slice("ring", i, F.lit(PIECE_EDGES + 1)), F.when(i + PIECE_EDGES > n, F.slice("ring", 1, 1)).otherwise(F.slice("ring", 1, 0))))
    pieces = rings.select("pid", "code", "name", *box, F.explode(points).alias("points"))
    pieces = pieces.withColumn("k", F.monotonically_increasing_id())
    return pieces.repartition("pid", "k").select("pid", "code", "name", *box, "k", chain_edges(F.col("points")).alias("edges"))


def _cell(v: Column, side: float) -> Column:
    return F.floor(v / F.lit(side)).cast("long")


def _odd(values: Column) -> Column:
    """The values that occur an odd number of times."""
    none = F.array().cast("array<double>")
    return F.aggregate(F.array_sort(values), none, lambda acc, y: F.when(
        F.try_element_at(acc, F.lit(-1)) == y, F.slice(acc, F.lit(1), F.size(acc) - 1)).otherwise(F.concat(acc, F.array(y))))


_CELL = ["pid", "level", "ix", "iy"]


def _classified(cells: DataFrame, side: float, level: int) -> DataFrame:
    """Rows of kind ``new`` hold the edges and heights of a row of the cell
    they were cut from: give them their own, pack the rows of a cell, and give
    a kind: whole, leaf or cut.  Cells outside their polygon go; finished cells
    pass."""
    ix, iy, new = F.col("ix"), F.col("iy"), F.col("kind") == "new"

    def spans(a: Column, b: Column, at: Column) -> Column:
        return (_cell(F.least(a, b), side) <= at) & (_cell(F.greatest(a, b), side) >= at)

    touching = F.filter("edges", lambda e: spans(e["x1"], e["x2"], ix) & spans(e["y1"], e["y2"], iy))
    right = F.filter("edges", lambda e: _cell(F.least(e["x1"], e["x2"]), side) > ix)
    heights = _odd(F.concat("ys", F.flatten(F.transform(right, lambda e: F.array(e["y1"], e["y2"])))))
    own = F.when(new, F.struct(touching.alias("edges"), heights.alias("ys"))).otherwise(F.struct("edges", "ys"))
    # a generator: Catalyst would otherwise repeat these arrays in every use
    own = cells.select(*_CELL, "code", "name", "k", "kind", F.inline(F.array(own))).where((F.size("edges") > 0) | (F.size("ys") > 0))
    # the finest cells hold their edges in one row, as a leaf does
    last = level == LEVELS - 1
    so_far = F.sum(F.size("edges")).over(Window.partitionBy(*_CELL).orderBy("k").rowsBetween(Window.unboundedPreceding, 0))
    part = F.lit(0) if last else F.greatest(F.floor((so_far - 1) / PIECE_EDGES), F.lit(0))
    rows = own.withColumns({"n": F.sum(F.size("edges")).over(Window.partitionBy(*_CELL)), "part": part})
    packed = rows.groupBy(*_CELL, "code", "name", "kind", "n", "part").agg(
        F.min("k").alias("k"), F.flatten(F.collect_list("edges")).alias("edges"), F.flatten(F.collect_list("ys")).alias("ys"))
    packed = packed.withColumn("ys", F.when(new, _odd(F.col("ys"))).otherwise(F.col("ys")))
    n, middle = F.col("n"), iy * F.lit(side) + F.lit(side / 2)
    inside = F.size(F.filter("ys", lambda y: y <= middle)) % 2 == 1
    small = F.lit(last) | (n <= LEAF_EDGES)
    kind = F.when(~new, F.col("kind")).when(n == 0, F.when(inside, F.lit("whole"))).when(small, F.lit("leaf")).otherwise(F.lit("cut"))
    return packed.withColumn("kind", kind).where(F.col("kind").isNotNull())


def cell_index(prepared: DataFrame, tile: float) -> DataFrame:
    """(key, here): per cell (level, ix, iy) the polygons that hold it as a
    whole cell or a leaf."""
    side = tile * FAN ** (LEVELS - 1)
    rest = ["pid", "code", "name", "k", "edges"]
    rows = prepared.select(*rest, "minx", "maxx", F.explode(F.sequence(_cell(F.col("miny"), side), _cell(F.col("maxy"), side))).alias("iy"))
    cells = rows.select(*rest, F.array().cast("array<double>").alias("ys"), F.lit(0).alias("level"), F.lit("new").alias("kind"), "iy",
                        F.explode(F.sequence(_cell(F.col("minx"), side), _cell(F.col("maxx"), side))).alias("ix"))
    fan = F.sequence(F.lit(0), F.lit(FAN - 1))
    for level in range(LEVELS):
        cells = _classified(cells, side, level)
        children = F.flatten(F.transform(fan, lambda j: F.transform(fan, lambda k: F.struct(
            F.lit(level + 1).alias("level"), (F.col("ix") * FAN + j).alias("ix"), (F.col("iy") * FAN + k).alias("iy"), F.lit("new").alias("kind")))))
        next_ = F.when(F.col("kind") == "cut", children).otherwise(F.array(F.struct("level", "ix", "iy", "kind")))
        cells = cells.select(*rest, "ys", F.inline(next_))
        side = side / FAN
    entry = F.struct("code", "name", (F.col("kind") == "whole").alias("whole"), "edges", "ys")
    return cells.groupBy(F.struct("level", "ix", "iy").alias("key")).agg(F.collect_list(entry).alias("here"))


def points_in_polygons(points: DataFrame, polys: DataFrame, code_col: str, name_col: str,
                       x_col: str = "lon", y_col: str = "lat", tile: float = DEFAULT_TILE_DEG,
                       out_code: str | None = None, out_name: str | None = None) -> DataFrame:
    """Left spatial join, predicate strict ``within``.

    ``polys`` has ``rings array<array<struct<x,y>>>`` in the points' CRS
    (use ``reproject_rings`` first when it is projected).  Output: every
    point column plus ``out_code``/``out_name`` (default: the polygon column
    names).  A point with a missing coordinate lies in no polygon.
    """
    out_code, out_name = out_code or code_col, out_name or name_col
    px, py = F.col(f"p.`{x_col}`"), F.col(f"p.`{y_col}`")
    usable = ~F.isnan(px) & ~F.isnan(py) & (F.abs(px) < 1e9) & (F.abs(py) < 1e9)
    # one index, its exchange reused by every level's lookup.  Never broadcast:
    # its arrays take many times the compressed size that Catalyst goes by, and
    # a task would hold all of it, once for each level
    index = cell_index(_prepared(polys, code_col, name_col), tile).hint("merge")
    out, hits = points.select(F.struct("*").alias("p")), []
    for k in range(LEVELS):
        side = tile * FAN ** (LEVELS - 1 - k)
        at = F.when(usable, F.struct(F.lit(k).alias("level"), _cell(px, side).alias("ix"), _cell(py, side).alias("iy")))
        found = F.filter("here", lambda p: p["whole"] | strictly_within(px, py, p["edges"], p["ys"]))
        hit = F.transform(F.coalesce(found, F.array()), lambda p: F.struct(p["code"].alias("code"), p["name"].alias("name")))
        out = out.join(index, at == F.col("key"), "left").select("p", *hits, hit.alias(f"hit{k}"))
        hits.append(f"hit{k}")
    out = out.select("p", F.explode_outer(F.concat(*hits)).alias("hit"))
    return out.select(*[F.col(f"p.`{c}`") for c in points.columns], F.col("hit.code").alias(out_code), F.col("hit.name").alias(out_name))


def build_mapping(points: DataFrame, polys: DataFrame, code_col: str, name_col: str,
                  out_code: str = HJD_CD, out_name: str = HJD_NM, **kw) -> DataFrame:
    """grid_idx, lat, lon, <code>, <name> -- one system's mapping table."""
    m = points_in_polygons(points.select("grid_idx", "lat", "lon"), polys, code_col, name_col,
                           out_code=out_code, out_name=out_name, **kw)
    return m.select("grid_idx", "lat", "lon", out_code, out_name)


def unified_mapping(hjd: DataFrame, bjd: DataFrame) -> DataFrame:
    """Full outer join on grid_idx; lat/lon come from the HJD side."""
    b = bjd.select("grid_idx", EMD_CD, EMD_NM)
    return hjd.select("grid_idx", "lat", "lon", HJD_CD, HJD_NM).join(b, "grid_idx", "full_outer")


def mapping_profile(mapping: DataFrame) -> DataFrame:
    """Cell counts: total, mapped per system, both, only one, unmapped."""
    cols = set(mapping.columns)
    h = F.col(HJD_CD).isNotNull() if HJD_CD in cols else F.lit(False)
    b = F.col(EMD_CD).isNotNull() if EMD_CD in cols else F.lit(False)
    return mapping.agg(
        F.count(F.lit(1)).alias("cells"),
        F.count_if(h).alias("mapped_hjd"),
        F.count_if(b).alias("mapped_bjd"),
        F.count_if(h & b).alias("mapped_both"),
        F.count_if(h & ~b).alias("hjd_only"),
        F.count_if(~h & b).alias("bjd_only"),
        F.count_if(~h & ~b).alias("unmapped"))


def region_density(mapping: DataFrame, code_col: str = HJD_CD) -> DataFrame:
    """Cells per region (mapped cells only)."""
    return (mapping.where(F.col(code_col).isNotNull())
                   .groupBy(code_col).agg(F.count(F.lit(1)).alias("cells")))


def union_layers(layers) -> DataFrame:
    """Region layers (e.g. one per province) as one polygon table."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), layers)
