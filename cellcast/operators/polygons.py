"""Polygons with holes and parts: points inside them (J6) and cells clipped by them.

A cell is all rows of its id: each row has an outer ring and, optionally, holes.
A point is inside a cell if a ray from it meets the edges of all its rings an odd
number of times; nothing here asks which ring an edge came from.

*Point in cell.*  Edges, not rings, are dealt to the square buckets they touch, so
a ring of 100,000 vertices is spread over as many buckets and tasks.  Each bucket
has a reference point whose side is known for every cell near it; a point walks to
the reference along x, then along y, inside its own bucket, and changes side with
every edge it meets.  Only the bucket's own edges matter.  Buckets with more edges
than ``max_edges`` keep them in several rows; points there are counted row by row
and summed.

*Clipping.*  A ring is cut by half-planes, one after the other, as a fold of
column expressions: first to the strip of a grid column, then to each cell of that
strip.  What a ring keeps gives a signed area and moments; holes count negative;
sums over all rings of the region are the area and the centroid of the cell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

POINT_TYPE = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
RING_TYPE = T.ArrayType(POINT_TYPE)

#: Where in a bucket its reference point lies; the first that is on no vertex's x is taken.
_REFERENCES = (0.5, 0.381966011250105, 0.618033988749895, 0.7236067977499789, 0.276393202250021, 0.4142135623730951)


def closed_ring(ring: Column) -> Column:
    """The ring with its first point repeated at the end, if it is not there already."""
    open_end = F.get(ring, 0) != F.try_element_at(ring, F.lit(-1))
    return F.when(open_end, F.concat(ring, F.slice(ring, 1, 1))).otherwise(ring)


def polygon_edges(cells: DataFrame, id_col: str, ring_col: str = "ring", holes_col: str | None = None) -> DataFrame:
    """(cell_id, ax, ay, bx, by): every edge of every ring, parts and holes alike."""
    rings = F.array(F.col(ring_col).cast(RING_TYPE))
    if holes_col:
        holes = F.col(holes_col).cast(T.ArrayType(RING_TYPE))
        rings = F.concat(rings, F.coalesce(holes, F.array().cast(T.ArrayType(RING_TYPE))))
    flat = cells.select(F.col(id_col).alias("cell_id"), F.explode(rings).alias("ring")).where("size(ring) > 2")
    flat = flat.select("cell_id", closed_ring(F.col("ring")).alias("ring"))
    ends = F.arrays_zip(
        F.slice("ring", 1, F.size("ring") - 1).alias("a"), F.slice("ring", 2, F.size("ring") - 1).alias("b")
    )
    return flat.select("cell_id", F.explode(ends).alias("e")).select(
        "cell_id",
        F.col("e.a.x").alias("ax"),
        F.col("e.a.y").alias("ay"),
        F.col("e.b.x").alias("bx"),
        F.col("e.b.y").alias("by"),
    )


def _side(e, x: Column, y: Column) -> Column:
    """Sign of the side of edge ``e`` that (x, y) is on; a point on it counts as a little to its right."""
    cross = (e["bx"] - e["ax"]) * (y - e["ay"]) - (e["by"] - e["ay"]) * (x - e["ax"])
    return F.when(cross != 0, F.signum(cross)).otherwise(-F.signum(e["by"] - e["ay"]))


def _beyond_x(e, x: Column, y: Column) -> Column:
    """Whether edge ``e`` meets the level of y to the right of x (edges that straddle y)."""
    return _side(e, x, y) * F.signum(e["by"] - e["ay"]) > 0


def _beyond_y(e, x: Column, y: Column) -> Column:
    """Whether edge ``e`` meets the upright at x above y (edges that straddle x)."""
    return _side(e, x, y) * F.signum(e["bx"] - e["ax"]) < 0


def _changes(e, px: Column, py: Column, cx: Column, cy: Column) -> Column:
    """How often the way (px, py) - (cx, py) - (cx, cy) meets edge ``e``."""
    level = ((e["ay"] > py) != (e["by"] > py)) & (_beyond_x(e, px, py) != _beyond_x(e, cx, py))
    upright = ((e["ax"] > cx) != (e["bx"] > cx)) & (_beyond_y(e, cx, py) != _beyond_y(e, cx, cy))
    return level.cast("int") + upright.cast("int")


def _on_edge(e, px: Column, py: Column) -> Column:
    cross = (e["bx"] - e["ax"]) * (py - e["ay"]) - (e["by"] - e["ay"]) * (px - e["ax"])
    in_x = px.between(F.least(e["ax"], e["bx"]), F.greatest(e["ax"], e["bx"]))
    in_y = py.between(F.least(e["ay"], e["by"]), F.greatest(e["ay"], e["by"]))
    return (cross == 0) & in_x & in_y


def _reference(edges: DataFrame, bucket: float) -> float:
    """A place in the bucket where no vertex has the reference points' x."""

    def clash(f: float) -> Column:
        return F.count_if(F.col("ax") == _centre(F.floor(F.col("ax") / bucket), bucket, f))

    counts = edges.agg(*[clash(f).alias(f"c{i}") for i, f in enumerate(_REFERENCES)]).first()
    free = [f for f, n in zip(_REFERENCES, counts) if not n]
    if not free:
        raise ValueError("Every reference line of the bucket grid runs through a vertex; choose another bucket size.")
    return free[0]


def _centre(number: Column, bucket: float, f: float) -> Column:
    return (number + F.lit(f)) * F.lit(bucket)


def edge_buckets(edges: DataFrame, bucket: float) -> DataFrame:
    """Each edge in every bucket (kx, ky) it touches, row by row of buckets."""
    low, high = F.least("ay", "by"), F.greatest("ay", "by")
    rows = edges.select(
        "*", F.explode(F.sequence(F.floor(low / bucket), F.floor(high / bucket))).alias("ky")
    )
    # The part of the edge in this row of buckets, a little widened against rounding.
    bottom, top = F.col("ky") * bucket, (F.col("ky") + 1) * bucket
    slope = F.try_divide(F.col("bx") - F.col("ax"), F.col("by") - F.col("ay"))

    def x_at(y: Column) -> Column:
        y = F.least(F.greatest(y, low), high)
        return F.when(slope.isNull(), F.col("ax")).otherwise(F.col("ax") + (y - F.col("ay")) * slope)

    flat = F.col("ay") == F.col("by")
    one, two = F.when(flat, F.col("ax")).otherwise(x_at(bottom)), F.when(flat, F.col("bx")).otherwise(x_at(top))
    slack = F.lit(bucket * 1e-9) + F.greatest(F.abs(one), F.abs(two)) * 1e-12
    left = F.floor((F.least(one, two) - slack) / bucket)
    right = F.floor((F.greatest(one, two) + slack) / bucket)
    return rows.select("*", F.explode(F.sequence(left, right)).alias("kx"))


def _inside_references(edges: DataFrame, bucket: float, f: float) -> DataFrame:
    """(cell_id, kx, ky) of the buckets whose reference point is inside the cell."""
    low, high = F.least("ay", "by"), F.greatest("ay", "by")
    rows = edges.select(
        "*", F.explode(F.sequence(F.floor(low / bucket), F.floor(high / bucket))).alias("ky")
    )
    cy = _centre(F.col("ky"), bucket, f)
    e = {c: F.col(c) for c in ("ax", "ay", "bx", "by")}
    rows = rows.where((F.col("ay") > cy) != (F.col("by") > cy))
    x = F.col("ax") + (cy - F.col("ay")) * (F.col("bx") - F.col("ax")) / (F.col("by") - F.col("ay"))
    near = F.floor(x / bucket - f)
    # The last bucket whose reference the edge passes on the right, by the same test that points use.
    last = F.coalesce(
        *[F.when(_beyond_x(e, _centre(near + d, bucket, f), cy), near + d) for d in (1, 0, -1)], near - 2
    )
    met = rows.select("cell_id", "ky", last.alias("last")).groupBy("cell_id", "ky", "last").agg(F.count("*").alias("n"))
    row = Window.partitionBy("cell_id", "ky").orderBy(F.col("last").desc())
    so_far = F.sum("n").over(row.rowsBetween(Window.unboundedPreceding, 0))
    runs = met.select("cell_id", "ky", "last", so_far.alias("n"), F.lead("last").over(row).alias("next"))
    runs = runs.where("n % 2 = 1 and next is not null and next < last")
    return runs.select("cell_id", "ky", F.explode(F.sequence(F.col("next") + 1, F.col("last"))).alias("kx"))


def edge_index(edges: DataFrame, bucket: float, f: float, max_edges: int) -> tuple[DataFrame, DataFrame]:
    """(sparse, dense): edges and known sides of each bucket.

    sparse: one row per bucket, ``cells`` an array of (cell_id, inside, edges) with
    at most ``max_edges`` edges in all.  dense: rows of at most about that many
    edges of one cell, for the buckets that hold more.
    """
    dealt = edge_buckets(edges, bucket)
    e = F.struct("ax", "ay", "bx", "by")
    sizes = dealt.groupBy("kx", "ky").agg(F.count("*").alias("n")).where(F.col("n") > max_edges)
    known = _inside_references(edges, bucket, f).select("cell_id", "kx", "ky", F.lit(1).alias("inside"), F.lit(None).cast("struct<ax:double,ay:double,bx:double,by:double>").alias("e"))
    entries = dealt.select("cell_id", "kx", "ky", F.lit(0).alias("inside"), e.alias("e")).unionByName(known)
    few = entries.join(sizes, ["kx", "ky"], "left_anti")
    sparse = few.groupBy("kx", "ky", "cell_id").agg(F.max("inside").alias("inside"), F.collect_list("e").alias("edges"))
    sparse = sparse.groupBy("kx", "ky").agg(F.collect_list(F.struct("cell_id", "inside", "edges")).alias("cells"))
    many = entries.join(sizes, ["kx", "ky"])
    chunk = F.pmod(F.xxhash64("e"), F.floor(F.col("n") / max_edges) + 1)
    dense = many.groupBy("kx", "ky", "cell_id", chunk.alias("chunk")).agg(
        F.sum("inside").alias("inside"), F.collect_list("e").alias("edges")
    )
    return sparse, dense


def point_in_polygon(
    points: DataFrame,
    cells: DataFrame,
    x_col: str,
    y_col: str,
    id_col: str = "grid_id",
    ring_col: str = "ring",
    bucket: float = 10000.0,
    output_col: str = "grid_id",
    holes_col: str | None = None,
    max_edges: int = 1024,
) -> DataFrame:
    """J6 (inner, strict ``within``): points in no cell, on an edge or in a hole are dropped.

    Cells do not overlap, so at most one contains a point; where they do, the
    smallest id is given.  The bucket grid changes only the speed: a bucket
    should hold a few cells.
    """
    edges = polygon_edges(cells, id_col, ring_col, holes_col)
    f = _reference(edges, bucket)
    sparse, dense = edge_index(edges, bucket, f, max_edges)
    px, py = F.col(x_col).cast("double"), F.col(y_col).cast("double")
    kx, ky = F.floor(px / bucket), F.floor(py / bucket)
    keyed = points.withColumn("_kx", kx).withColumn("_ky", ky)
    at = (px, py, _centre(F.col("_kx"), bucket, f), _centre(F.col("_ky"), bucket, f))

    def inside(edges_of: Column, known: Column) -> Column:
        met = F.aggregate(edges_of, F.lit(0), lambda n, e: n + _changes(e, *at))
        return (((met + known) % 2) == 1) & ~F.exists(edges_of, lambda e: _on_edge(e, px, py))

    key = lambda d: d.withColumnRenamed("kx", "_kx").withColumnRenamed("ky", "_ky")
    joined = keyed.join(key(sparse.withColumnRenamed("cells", "_cells")), ["_kx", "_ky"])
    hits = F.filter(F.col("_cells"), lambda c: inside(c["edges"], c["inside"]))
    found = F.array_min(F.transform(hits, lambda c: c["cell_id"]))
    plain = joined.withColumn(output_col, found).where(F.col(output_col).isNotNull())
    columns = [c for c in points.columns if c != output_col] + [output_col]
    plain = plain.select(columns)

    # Points of dense buckets: crossings are summed over the bucket's rows of edges.
    crowded = dense.select("kx", "ky").distinct()
    some = keyed.join(key(crowded), ["_kx", "_ky"], "left_semi")
    some = some.withColumn("_point", F.monotonically_increasing_id())
    pieces = some.join(key(dense.select("kx", "ky", "cell_id", "edges", F.col("inside").alias("_known"))), ["_kx", "_ky"])
    payload = F.struct(*[F.col(c) for c in points.columns if c != output_col])
    met = F.aggregate("edges", F.lit(0), lambda n, e: n + _changes(e, *at)) + F.col("_known")
    edge = F.exists("edges", lambda e: _on_edge(e, px, py))
    sums = (
        pieces.select("_point", "cell_id", payload.alias("_row"), met.alias("_met"), edge.alias("_edge"))
        .groupBy("_point", "cell_id")
        .agg(F.sum("_met").alias("_met"), F.max("_edge").alias("_edge"), F.any_value("_row").alias("_row"))
        .where("_met % 2 = 1 and not _edge")
        .groupBy("_point")
        .agg(F.min("cell_id").alias(output_col), F.any_value("_row").alias("_row"))
    )
    return plain.unionByName(sums.select("_row.*", output_col))


# --------------------------------------------------------------------------- #
# J10
# --------------------------------------------------------------------------- #
def _cut_ring(df: DataFrame, axis: str, bound: Column, keep_above: bool) -> DataFrame:
    """One half-plane of the fold: what ``ring`` (open) has on one side of an axis-parallel line."""
    other = "y" if axis == "x" else "x"

    def kept(p):
        return p[axis] >= bound if keep_above else p[axis] <= bound

    def meet(p, q):
        t = (bound - p[axis]) / (q[axis] - p[axis])
        across = p[other] + (q[other] - p[other]) * t
        x, y = (bound, across) if axis == "x" else (across, bound)
        return F.struct(x.alias("x"), y.alias("y"))

    ring = F.col("ring")

    def step(cur, i):
        prev = F.get(ring, F.when(i == 0, F.size(ring) - 1).otherwise(i - 1))
        return (
            F.when(kept(cur) & kept(prev), F.array(cur))
            .when(kept(cur), F.array(meet(prev, cur), cur))
            .when(kept(prev), F.array(meet(prev, cur)))
            .otherwise(F.array().cast(RING_TYPE))
        )

    return df.withColumn("ring", F.flatten(F.transform(ring, step))).where("size(ring) > 2")


def ring_moments(ring: Column) -> Column:
    """(area, mx, my): signed area and first moments of an open or closed ring, about the ring's first point."""
    origin = F.get(ring, 0)

    def add(acc, i):
        p, q = F.get(ring, i), F.get(ring, F.when(i == F.size(ring) - 1, 0).otherwise(i + 1))
        px, py = p["x"] - origin["x"], p["y"] - origin["y"]
        qx, qy = q["x"] - origin["x"], q["y"] - origin["y"]
        cross = px * qy - qx * py
        return F.struct(
            (acc["area"] + cross / 2).alias("area"),
            (acc["mx"] + (px + qx) * cross / 6).alias("mx"),
            (acc["my"] + (py + qy) * cross / 6).alias("my"),
        )

    zero = F.struct(*[F.lit(0.0).alias(c) for c in ("area", "mx", "my")])
    places = F.when(F.size(ring) > 0, F.sequence(F.lit(0), F.size(ring) - 1))
    about = F.aggregate(places, zero, add)
    return F.transform(
        F.array(about),
        lambda m: F.struct(
            m["area"].alias("area"),
            (m["mx"] + m["area"] * origin["x"]).alias("mx"),
            (m["my"] + m["area"] * origin["y"]).alias("my"),
        ),
    )[0]


def clip_cells(
    cells: DataFrame,
    region: DataFrame,
    key_col: str = "cell_key",
    region_ring: str = "ring",
    holes_col: str | None = None,
) -> DataFrame:
    """One row per cell that shares area with the region.

    ``cells`` are axis-parallel (``x0, y0, x1, y1``); ``region`` has a row per
    part, with its outer ring and, optionally, holes.  Columns: ``grid_key``,
    ``area``, ``centroid_x``, ``centroid_y``, ``pieces`` (ring, hole: what each
    ring keeps in the cell; parts of a ring that the cell separates stay joined by
    edges without width on the cell's border).
    """
    empty = F.array().cast(T.ArrayType(RING_TYPE))
    holes = F.coalesce(F.col(holes_col).cast(T.ArrayType(RING_TYPE)), empty) if holes_col else empty
    outer = F.struct(F.col(region_ring).cast(RING_TYPE).alias("ring"), F.lit(False).alias("hole"))
    all_rings = F.concat(F.array(outer), F.transform(holes, lambda h: F.struct(h.alias("ring"), F.lit(True).alias("hole"))))
    rings = region.select(F.explode(all_rings).alias("r")).select("r.ring", "r.hole").where("size(ring) > 2")
    closed = F.get("ring", 0) == F.try_element_at("ring", F.lit(-1))
    rings = rings.withColumn("ring", F.when(closed, F.slice("ring", 1, F.size("ring") - 1)).otherwise(F.col("ring")))
    # Outer rings count positive and holes negative, whichever way they turn.
    turn = F.signum(ring_moments(F.col("ring"))["area"])
    rings = rings.withColumn("sign", F.when(F.col("hole"), -turn).otherwise(turn)).where("sign <> 0")
    xs = F.transform("ring", lambda p: p["x"])
    rings = rings.withColumn("rx0", F.array_min(xs)).withColumn("rx1", F.array_max(xs))

    # Grid columns, each with the strips of the rings that reach into it.
    columns = cells.select("x0", "x1").distinct().withColumn("strip", F.monotonically_increasing_id())
    meet = (F.col("x1") > F.col("rx0")) & (F.col("x0") < F.col("rx1"))
    width = columns.agg(F.max(F.col("x1") - F.col("x0"))).first()[0]
    if width is None:
        width = 1.0
    near = F.sequence(F.floor((F.col("rx0") - width) / width), F.floor(F.col("rx1") / width))
    strips = (
        rings.withColumn("near", F.explode(near))
        .join(columns.withColumn("near", F.floor(F.col("x0") / width)), "near")
        .where(meet)
        .drop("near", "rx0", "rx1", "strip")
    )
    strips = _cut_ring(strips, "x", F.col("x0"), True)
    strips = _cut_ring(strips, "x", F.col("x1"), False)
    ys = F.transform("ring", lambda p: p["y"])
    strips = strips.withColumn("ry0", F.array_min(ys)).withColumn("ry1", F.array_max(ys))

    pairs = cells.select(F.col(key_col).alias("grid_key"), "x0", "y0", "x1", "y1").join(strips, ["x0", "x1"])
    pairs = pairs.where((F.col("y1") > F.col("ry0")) & (F.col("y0") < F.col("ry1")))
    pairs = _cut_ring(pairs, "y", F.col("y0"), True)
    pairs = _cut_ring(pairs, "y", F.col("y1"), False)
    pairs = pairs.withColumn("m", ring_moments(F.col("ring")))
    sums = pairs.groupBy("grid_key").agg(
        F.sum(F.col("m.area") * F.col("sign")).alias("area"),
        F.sum(F.col("m.mx") * F.col("sign")).alias("mx"),
        F.sum(F.col("m.my") * F.col("sign")).alias("my"),
        F.collect_list(F.struct("ring", "hole")).alias("pieces"),
        F.any_value((F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0"))).alias("whole"),
    )
    # Less than rounding leaves of a cell is no area: a hole as large as the cell, a touching border.
    return sums.where(F.col("area") > F.col("whole") * 1e-12).select(
        "grid_key",
        "area",
        (F.col("mx") / F.col("area")).alias("centroid_x"),
        (F.col("my") / F.col("area")).alias("centroid_y"),
        "pieces",
    )
