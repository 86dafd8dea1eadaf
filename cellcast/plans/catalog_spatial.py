"""Catalog: spatial operators bound to ``embeddings`` (points) and ``part`` (pixels)."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellcast.functions import geo as G
from cellcast.operators import ranking as R
from cellcast.operators import spatial as S
from cellcast.operators.windows import sequential_ids
from cellcast.plans.catalog import register, table


def r10(c):
    return F.round(F.col(c) if isinstance(c, str) else c, 10)


def embedding_points(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    return e.select(
        "vec_id",
        "label",
        F.col("embedding")[0].cast("double").alias("x"),
        F.col("embedding")[1].cast("double").alias("y"),
        F.col("embedding")[2].cast("double").alias("z"),
    )


SQL_POINTS = """pts AS (SELECT vec_id, label, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y,
                      CAST(embedding[3] AS DOUBLE) AS z FROM embeddings)"""

# --------------------------------------------------------------------------- #
# J7 / F16 -- nearest centroid (centroids = per-label means of the points)
# --------------------------------------------------------------------------- #
NEAREST_MAX = 0.25


@register(
    "nearest_cell",
    f"""WITH {SQL_POINTS},
cen AS (SELECT label AS cell_id, AVG(x) AS cx, AVG(y) AS cy FROM pts GROUP BY label),
d AS (SELECT p.vec_id, c.cell_id, SQRT((p.x - c.cx) * (p.x - c.cx) + (p.y - c.cy) * (p.y - c.cy)) AS dist
      FROM pts p CROSS JOIN cen c),
b AS (SELECT vec_id, arg_min(cell_id, struct_pack(dd := dist, cc := cell_id)) AS cell_id, MIN(dist) AS dist FROM d GROUP BY vec_id)
SELECT vec_id, CASE WHEN dist <= {NEAREST_MAX} THEN cell_id END AS grid_id,
       ROUND(CASE WHEN dist <= {NEAREST_MAX} THEN dist END, 10) AS assignment_distance_m
FROM b""",
)
def q_nearest_cell(spark, sf_dir):
    pts = embedding_points(spark, sf_dir)
    cen = pts.groupBy(F.col("label").alias("cell_id")).agg(F.avg("x").alias("cx"), F.avg("y").alias("cy"))
    out = S.nearest_cell(pts.select("vec_id", "x", "y"), cen, "x", "y", "cell_id", "cx", "cy", NEAREST_MAX)
    return out.select("vec_id", "grid_id", r10("assignment_distance_m").alias("assignment_distance_m"))


# --------------------------------------------------------------------------- #
# J6 / J9 / W12 -- points strictly within generated square cells
# --------------------------------------------------------------------------- #
CELL_SIZE = 0.05


def _bounds(df: DataFrame, x: str, y: str):
    r = df.agg(F.min(x), F.min(y), F.max(x), F.max(y)).first()
    return float(r[0]), float(r[1]), float(r[2]), float(r[3])


@register(
    "point_in_cell",
    f"""WITH {SQL_POINTS},
bb AS (SELECT MIN(x) AS x0, MIN(y) AS y0, MAX(x) AS x1, MAX(y) AS y1 FROM pts),
dims AS (SELECT x0, y0, CAST(CEIL((x1 - x0) / {CELL_SIZE}) AS BIGINT) AS nx, CAST(CEIL((y1 - y0) / {CELL_SIZE}) AS BIGINT) AS ny FROM bb),
cells AS (SELECT ix, iy, dims.x0 + ix * {CELL_SIZE} AS cx0, dims.y0 + iy * {CELL_SIZE} AS cy0,
                 dims.x0 + (ix + 1) * {CELL_SIZE} AS cx1, dims.y0 + (iy + 1) * {CELL_SIZE} AS cy1
          FROM dims, (SELECT UNNEST(range((SELECT nx FROM dims))) AS ix) a, (SELECT UNNEST(range((SELECT ny FROM dims))) AS iy) b),
ids AS (SELECT *, printf('CA-%05d', ROW_NUMBER() OVER (ORDER BY ix, iy)) AS grid_id FROM cells)
SELECT p.vec_id, i.grid_id FROM pts p JOIN ids i ON p.x > i.cx0 AND p.x < i.cx1 AND p.y > i.cy0 AND p.y < i.cy1""",
)
def q_point_in_cell(spark, sf_dir):
    pts = embedding_points(spark, sf_dir)
    x0, y0, x1, y1 = _bounds(pts, "x", "y")
    grid = S.generate_grid(spark, x0, y0, x1, y1, CELL_SIZE)
    return S.point_in_polygon(pts.select("vec_id", "x", "y"), grid, "x", "y", "grid_id", "ring", CELL_SIZE).select(
        "vec_id", "grid_id"
    )


# --------------------------------------------------------------------------- #
# J11 / A14 / A15 -- zonal mean and mode over a pixel table (part)
# --------------------------------------------------------------------------- #
ZONE_X0, ZONE_Y0, ZONE_X1, ZONE_Y1, ZONE_SIZE = 0.1, 8.90005, 12.6, 21.5, 2.5


def part_pixels(spark, sf_dir) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(
        (F.col("p_size") / F.lit(4.0)).alias("x"),
        (F.col("p_retailprice") / F.lit(100.0)).alias("y"),
        F.col("p_retailprice").alias("price"),
        F.substring("p_brand", 7, 10).try_cast("int").alias("brand"),
    )


SQL_ZONES = f"""
px AS (SELECT p_size / 4.0 AS x, p_retailprice / 100.0 AS y, p_retailprice AS price,
              TRY_CAST(substr(p_brand, 7) AS INTEGER) AS brand FROM part),
dims AS (SELECT CAST(CEIL(({ZONE_X1} - {ZONE_X0}) / {ZONE_SIZE}) AS BIGINT) AS nx, CAST(CEIL(({ZONE_Y1} - {ZONE_Y0}) / {ZONE_SIZE}) AS BIGINT) AS ny),
cells AS (SELECT ix, iy, {ZONE_X0} + ix * {ZONE_SIZE} AS cx0, {ZONE_Y0} + iy * {ZONE_SIZE} AS cy0,
                 {ZONE_X0} + (ix + 1) * {ZONE_SIZE} AS cx1, {ZONE_Y0} + (iy + 1) * {ZONE_SIZE} AS cy1
          FROM (SELECT UNNEST(range((SELECT nx FROM dims))) AS ix) a, (SELECT UNNEST(range((SELECT ny FROM dims))) AS iy) b),
ids AS (SELECT *, printf('CA-%05d', ROW_NUMBER() OVER (ORDER BY ix, iy)) AS grid_id FROM cells),
hit AS (SELECT i.grid_id, px.price, px.brand FROM px JOIN ids i
        ON px.x > i.cx0 AND px.x < i.cx1 AND px.y > i.cy0 AND px.y < i.cy1)"""


@register(
    "zonal_mean",
    f"""WITH {SQL_ZONES.strip()},
m AS (SELECT grid_id, AVG(price) AS price_mean FROM hit WHERE price IS NOT NULL AND NOT isnan(price) GROUP BY grid_id)
SELECT ids.grid_id, ROUND(m.price_mean, 6) AS price_mean FROM ids LEFT JOIN m ON m.grid_id = ids.grid_id""",
)
def q_zonal_mean(spark, sf_dir):
    grid = S.generate_grid(spark, ZONE_X0, ZONE_Y0, ZONE_X1, ZONE_Y1, ZONE_SIZE)
    out = S.zonal_statistics(part_pixels(spark, sf_dir), grid, "x", "y", "price", None, None, "grid_id", "ring", ZONE_SIZE)
    return out.withColumn("price_mean", F.round("price_mean", 6))


@register(
    "zonal_mode",
    f"""WITH {SQL_ZONES.strip()},
c AS (SELECT grid_id, brand, COUNT(*) AS n FROM hit WHERE brand IS NOT NULL AND brand <> 0 GROUP BY grid_id, brand),
m AS (SELECT grid_id, arg_max(brand, struct_pack(nn := n, nb := -brand)) AS brand_mode FROM c GROUP BY grid_id)
SELECT ids.grid_id, m.brand_mode FROM ids LEFT JOIN m ON m.grid_id = ids.grid_id""",
)
def q_zonal_mode(spark, sf_dir):
    grid = S.generate_grid(spark, ZONE_X0, ZONE_Y0, ZONE_X1, ZONE_Y1, ZONE_SIZE)
    return S.zonal_statistics(part_pixels(spark, sf_dir), grid, "x", "y", None, "brand", 0, "grid_id", "ring", ZONE_SIZE)


# --------------------------------------------------------------------------- #
# F14 -- Albers forward and inverse; F15 / A25 -- map clusters
# --------------------------------------------------------------------------- #
def lat_lon(spark, sf_dir) -> DataFrame:
    pts = embedding_points(spark, sf_dir)
    return pts.select(
        "vec_id",
        (F.lit(32.5) + (F.col("x") + F.lit(0.5)) * F.lit(9.5)).alias("lat"),
        (F.lit(-124.4) + (F.col("y") + F.lit(0.5)) * F.lit(10.3)).alias("lon"),
        "z",
    )


SQL_LATLON = f"""{SQL_POINTS},
ll AS (SELECT vec_id, 32.5 + (x + 0.5) * 9.5 AS lat, -124.4 + (y + 0.5) * 10.3 AS lon, z FROM pts)"""


def _sql_albers() -> str:
    """The same Albers formulas as ``functions.geo`` written as SQL text."""
    e2, e, n, c, rho0, a = G._E2, G._E, G._N, G._C, G._RHO0, G._A
    lam0, fe, fn = G._LAM0, G._FE, G._FN

    def q(s):
        return f"({1 - e2!r} * ({s} / (1.0 - {e2!r} * {s} * {s}) - {1 / (2 * e)!r} * LN((1.0 - {e!r} * {s}) / (1.0 + {e!r} * {s}))))"

    fwd = f"""
fw AS (SELECT vec_id, lat, lon, {a!r} * SQRT({c!r} - {n!r} * {q('SIN(RADIANS(lat))')}) / {n!r} AS rho,
              {n!r} * (RADIANS(lon) - {lam0!r}) AS theta FROM ll),
xy AS (SELECT vec_id, lat, lon, {fe!r} + rho * SIN(theta) AS x, {fn!r} + {rho0!r} - rho * COS(theta) AS y FROM fw),
iv0 AS (SELECT vec_id, lat, lon, x, y, x - {fe!r} AS dx, {rho0!r} - (y - {fn!r}) AS dy FROM xy),
iv1 AS (SELECT *, SQRT(dx * dx + dy * dy) AS rr, ATAN2(dx, dy) AS th FROM iv0),
iv2 AS (SELECT *, ({c!r} - rr * rr * {n * n!r} / {a * a!r}) / {n!r} AS qq FROM iv1),
it0 AS (SELECT *, ASIN(qq / 2.0) AS phi FROM iv2)"""
    steps = []
    for i in range(6):
        s = "SIN(phi)"
        one = f"(1.0 - {e2!r} * {s} * {s})"
        upd = (
            f"phi + {one} * {one} / (2.0 * COS(phi)) * (qq / {1 - e2!r} - {s} / {one} + "
            f"{1 / (2 * e)!r} * LN((1.0 - {e!r} * {s}) / (1.0 + {e!r} * {s})))"
        )
        cols = "vec_id, lat, lon, x, y, rr, th, qq"
        steps.append(f"it{i + 1} AS (SELECT {cols}, {upd} AS phi FROM it{i})")
    return fwd + ",\n" + ",\n".join(steps)


@register(
    "project_albers",
    f"""WITH {SQL_LATLON}, {_sql_albers().strip()}
SELECT vec_id, ROUND(x, 4) AS x, ROUND(y, 4) AS y,
       ROUND(DEGREES({G._LAM0!r} + th / {G._N!r}), 8) AS lon_back, ROUND(DEGREES(phi), 8) AS lat_back
FROM it6""",
)
def q_project_albers(spark, sf_dir):
    ll = lat_lon(spark, sf_dir)
    x, y = G.albers_xy(F.col("lon"), F.col("lat"))
    projected = ll.select("vec_id", x.alias("x"), y.alias("y"))
    back = G.albers_inverse(projected, "x", "y", "lon_b", "lat_b", 6)
    return back.select(
        "vec_id",
        F.round("x", 4).alias("x"),
        F.round("y", 4).alias("y"),
        F.round("lon_b", 8).alias("lon_back"),
        F.round("lat_b", 8).alias("lat_back"),
    )


CLUSTER_ZOOM = 6


def _sql_mercator(zoom: int) -> str:
    r = G.EARTH_RADIUS
    k = 0.5 / (math.pi * r)
    scale = 256.0 * 2.0**zoom
    lat = f"GREATEST(LEAST(lat, {G.MAX_MERCATOR_LATITUDE!r}), {-G.MAX_MERCATOR_LATITUDE!r})"
    s = f"SIN(RADIANS({lat}))"
    my = f"({r!r} * LN((1.0 + {s}) / (1.0 - {s})) / 2.0)"
    mx = f"({r!r} * RADIANS(lon))"
    return f"{scale!r} * ({k!r} * {mx} + 0.5) AS px, {scale!r} * (-1.0 * {k!r} * {my} + 0.5) AS py"


@register(
    "web_mercator_clusters",
    f"""WITH {SQL_LATLON},
pr AS (SELECT *, (RANK() OVER (ORDER BY z) - 1 + (COUNT(*) OVER (PARTITION BY z) + 1) / 2.0) / COUNT(*) OVER () * 100 AS risk_score FROM ll),
pp AS (SELECT *, {_sql_mercator(CLUSTER_ZOOM)} FROM pr),
g AS (SELECT FLOOR(px / {S.cluster_pixels(CLUSTER_ZOOM)}) AS cx, FLOOR(py / {S.cluster_pixels(CLUSTER_ZOOM)}) AS cy,
             AVG(risk_score) AS average_score, AVG(lat) AS lat, AVG(lon) AS lng, COUNT(*) AS count FROM pp GROUP BY 1, 2)
SELECT CAST(cx AS BIGINT) AS cx, CAST(cy AS BIGINT) AS cy, ROUND(average_score, 6) AS average_score,
       ROUND(lat, 6) AS lat, ROUND(lng, 6) AS lng, count,
       CASE WHEN average_score >= 99 THEN 'Extreme' WHEN average_score >= 95 THEN 'High'
            WHEN average_score >= 90 THEN 'Medium' ELSE 'Low' END AS risk_level
FROM g""",
)
def q_web_mercator_clusters(spark, sf_dir):
    ll = lat_lon(spark, sf_dir).withColumn("_all", F.lit(1))
    pins = R.average_percentile(ll, ["_all"], "z", "_pct").select(
        F.col("lat"), F.col("lon").alias("lng"), (F.col("_pct") * 100).alias("risk_score")
    )
    out = S.pin_clusters(pins, CLUSTER_ZOOM, "lat", "lng", "risk_score")
    return out.select(
        F.col("cx").cast("long").alias("cx"),
        F.col("cy").cast("long").alias("cy"),
        F.round("average_score", 6).alias("average_score"),
        F.round("lat", 6).alias("lat"),
        F.round("lng", 6).alias("lng"),
        "count",
        "risk_level",
    )


# --------------------------------------------------------------------------- #
# J6 / S8 -- points within cells that have a square hole
# --------------------------------------------------------------------------- #
@register(
    "point_in_holed_cell",
    f"""WITH {SQL_POINTS},
bb AS (SELECT MIN(x) AS x0, MIN(y) AS y0, MAX(x) AS x1, MAX(y) AS y1 FROM pts),
dims AS (SELECT x0, y0, CAST(CEIL((x1 - x0) / {CELL_SIZE}) AS BIGINT) AS nx, CAST(CEIL((y1 - y0) / {CELL_SIZE}) AS BIGINT) AS ny FROM bb),
cells AS (SELECT ix, iy, dims.x0 + ix * {CELL_SIZE} AS cx0, dims.y0 + iy * {CELL_SIZE} AS cy0,
                 dims.x0 + (ix + 1) * {CELL_SIZE} AS cx1, dims.y0 + (iy + 1) * {CELL_SIZE} AS cy1
          FROM dims, (SELECT UNNEST(range((SELECT nx FROM dims))) AS ix) a, (SELECT UNNEST(range((SELECT ny FROM dims))) AS iy) b),
ids AS (SELECT *, cx0 + {CELL_SIZE} / 4 AS hx0, cx1 - {CELL_SIZE} / 4 AS hx1, cy0 + {CELL_SIZE} / 4 AS hy0,
               cy1 - {CELL_SIZE} / 4 AS hy1, printf('CA-%05d', ROW_NUMBER() OVER (ORDER BY ix, iy)) AS grid_id FROM cells)
SELECT p.vec_id, i.grid_id FROM pts p JOIN ids i ON p.x > i.cx0 AND p.x < i.cx1 AND p.y > i.cy0 AND p.y < i.cy1
WHERE NOT (p.x BETWEEN i.hx0 AND i.hx1 AND p.y BETWEEN i.hy0 AND i.hy1)""",
)
def q_point_in_holed_cell(spark, sf_dir):
    pts = embedding_points(spark, sf_dir)
    x0, y0, x1, y1 = _bounds(pts, "x", "y")
    grid = S.generate_grid(spark, x0, y0, x1, y1, CELL_SIZE)
    inset = F.lit(CELL_SIZE) / 4
    hole = S.box_ring(F.col("x0") + inset, F.col("y0") + inset, F.col("x1") - inset, F.col("y1") - inset)
    grid = grid.withColumn("holes", F.array(hole))
    found = S.point_in_polygon(
        pts.select("vec_id", "x", "y"), grid, "x", "y", "grid_id", "ring", CELL_SIZE, holes_col="holes"
    )
    return found.select("vec_id", "grid_id")


# --------------------------------------------------------------------------- #
# J10 -- clip generated cells to a region derived from the data
# --------------------------------------------------------------------------- #
CLIP_SIZE = 0.02


def _clip_sql(part: str, hole: bool) -> str:
    """Area and centroid of every cell by Green's theorem, edge by edge.

    Each edge, cut where it crosses the cell's bottom and top, bounds a trapezoid
    above the cell's bottom; ``part`` defines ``ring`` (r, i, x, y): open rings.
    """
    inner = """, holes AS (SELECT 1 AS r, i, mx + (x - mx) / 4 AS x, my + (y - my) / 4 AS y FROM ring, mid),
rings AS (SELECT 0 AS r, i, x, y FROM ring UNION ALL SELECT r, i, x, y FROM holes)""" if hole else """,
rings AS (SELECT 0 AS r, i, x, y FROM ring)"""
    return f"""WITH {SQL_POINTS}, {part}{inner},
seg AS (SELECT r, x AS ax, y AS ay,
               COALESCE(LEAD(x) OVER (PARTITION BY r ORDER BY i), FIRST_VALUE(x) OVER (PARTITION BY r ORDER BY i)) AS ex,
               COALESCE(LEAD(y) OVER (PARTITION BY r ORDER BY i), FIRST_VALUE(y) OVER (PARTITION BY r ORDER BY i)) AS ey FROM rings),
turn AS (SELECT r, SIGN(SUM(ax * ey - ex * ay)) * CASE WHEN r = 0 THEN 1 ELSE -1 END AS s FROM seg GROUP BY r),
bb AS (SELECT MIN(x) AS x0, MIN(y) AS y0, MAX(x) AS x1, MAX(y) AS y1 FROM ring),
dims AS (SELECT x0, y0, CAST(CEIL((x1 - x0) / {CLIP_SIZE}) AS BIGINT) AS nx, CAST(CEIL((y1 - y0) / {CLIP_SIZE}) AS BIGINT) AS ny FROM bb),
cells AS (SELECT ix, iy, dims.x0 + ix * {CLIP_SIZE} AS cx0, dims.y0 + iy * {CLIP_SIZE} AS cy0,
                 dims.x0 + (ix + 1) * {CLIP_SIZE} AS cx1, dims.y0 + (iy + 1) * {CLIP_SIZE} AS cy1
          FROM dims, (SELECT UNNEST(range((SELECT nx FROM dims))) AS ix) a, (SELECT UNNEST(range((SELECT ny FROM dims))) AS iy) b),
lr AS (SELECT c.*, t.s * CASE WHEN ax < ex THEN -1 ELSE 1 END AS s,
              GREATEST(LEAST(ax, ex), cx0) AS xl, LEAST(GREATEST(ax, ex), cx1) AS xr,
              ax, ay, (ey - ay) / (ex - ax) AS m
       FROM cells c JOIN seg ON ax <> ex AND LEAST(ax, ex) < cx1 AND GREATEST(ax, ex) > cx0 JOIN turn t ON t.r = seg.r),
cut AS (SELECT *, CASE WHEN m = 0 THEN xl ELSE LEAST(GREATEST(ax + (cy0 - ay) / m, xl), xr) END AS u,
                  CASE WHEN m = 0 THEN xl ELSE LEAST(GREATEST(ax + (cy1 - ay) / m, xl), xr) END AS v FROM lr),
bits AS (SELECT *, UNNEST([xl, LEAST(u, v), GREATEST(u, v)]) AS p, UNNEST([LEAST(u, v), GREATEST(u, v), xr]) AS q FROM cut),
ends AS (SELECT *, LEAST(GREATEST(ay + (p - ax) * m, cy0), cy1) AS yp, LEAST(GREATEST(ay + (q - ax) * m, cy0), cy1) AS yq
         FROM bits WHERE p < q),
sums AS (SELECT ix, iy, ANY_VALUE(cx0) AS cx0, ANY_VALUE(cy0) AS cy0,
                SUM(s * (q - p) * (yp + yq - 2 * cy0) / 2) AS a,
                SUM(s * (q - p) * ((p - cx0) * (2 * (yp - cy0) + (yq - cy0)) + (q - cx0) * ((yp - cy0) + 2 * (yq - cy0))) / 6) AS mx,
                SUM(s * (q - p) * ((yp - cy0) * (yp - cy0) + (yp - cy0) * (yq - cy0) + (yq - cy0) * (yq - cy0)) / 6) AS my
         FROM ends GROUP BY ix, iy)
SELECT printf('CA-%05d', ROW_NUMBER() OVER (ORDER BY ix, iy)) AS grid_id, ROUND(a, 10) AS area,
       ROUND(cx0 + mx / a, 6) AS centroid_x, ROUND(cy0 + my / a, 6) AS centroid_y
FROM sums WHERE a > {CLIP_SIZE} * {CLIP_SIZE} * 1e-9"""


STAR_SQL = """
cen AS (SELECT label, AVG(x) AS x, AVG(y) AS y FROM pts GROUP BY label),
mid AS (SELECT AVG(x) AS mx, AVG(y) AS my FROM cen),
ring AS (SELECT ROW_NUMBER() OVER (ORDER BY ATAN2(y - my, x - mx), x, y) AS i, x, y FROM cen, mid)"""


def star_region(spark, sf_dir, hole: bool) -> DataFrame:
    """Per-label centroids of the points joined in angle order around their mean
    (star-shaped, generally concave); with ``hole`` a quarter of its size is left out."""
    cen = embedding_points(spark, sf_dir).groupBy("label").agg(F.avg("x").alias("x"), F.avg("y").alias("y"))
    mx, my = cen.agg(F.avg("x"), F.avg("y")).first()  # two scalars
    angle = F.atan2(F.col("y") - F.lit(my), F.col("x") - F.lit(mx))
    turned = cen.agg(F.array_sort(F.collect_list(F.struct(angle.alias("ang"), "x", "y"))).alias("r"))
    ring = F.transform("r", lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y")))

    def shrunk(p):
        x, y = F.lit(mx) + (p["x"] - F.lit(mx)) / 4, F.lit(my) + (p["y"] - F.lit(my)) / 4
        return F.struct(x.alias("x"), y.alias("y"))

    holes = F.array(F.transform("r", shrunk)) if hole else F.array(F.slice(ring, 1, 0))
    return turned.select(ring.alias("ring"), holes.alias("holes"))


def clipped_grid(spark, region: DataFrame) -> DataFrame:
    """Cells over the region's box, clipped, with ids in (ix, iy) order of what is left."""
    b = region.select(F.explode("ring").alias("p")).agg(
        F.min("p.x"), F.min("p.y"), F.max("p.x"), F.max("p.y")
    ).first()
    grid = S.generate_grid(spark, *[float(v) for v in b], CLIP_SIZE).drop("grid_id")
    grid = grid.withColumn("cell_key", F.struct("ix", "iy"))
    clipped = S.clip_cells(grid, region, "cell_key", "ring", "holes").where(F.col("area") > CLIP_SIZE * CLIP_SIZE * 1e-9)
    return sequential_ids(clipped.select("*", "grid_key.*"), ("ix", "iy"), "grid_id").select(
        "grid_id", F.round("area", 10).alias("area"), F.round("centroid_x", 6).alias("centroid_x"),
        F.round("centroid_y", 6).alias("centroid_y"),
    )


@register("clip_cells", _clip_sql(STAR_SQL, False))
def q_clip_cells(spark, sf_dir):
    return clipped_grid(spark, star_region(spark, sf_dir, False))


@register("clip_cells_hole", _clip_sql(STAR_SQL, True))
def q_clip_cells_hole(spark, sf_dir):
    return clipped_grid(spark, star_region(spark, sf_dir, True))


# --------------------------------------------------------------------------- #
# J7 -- every point to the nearest of many clustered centroids
# --------------------------------------------------------------------------- #
CLUSTER_MAX = 0.05


@register(
    "nearest_clustered",
    f"""WITH {SQL_POINTS},
cen AS (SELECT vec_id AS cell_id, x * x * x AS cx, y * y * y AS cy FROM pts),
d AS (SELECT p.vec_id, c.cell_id, SQRT((p.x - c.cx) * (p.x - c.cx) + (p.y - c.cy) * (p.y - c.cy)) AS dist
      FROM pts p JOIN cen c ON c.cx BETWEEN p.x - {CLUSTER_MAX} AND p.x + {CLUSTER_MAX} AND c.cy BETWEEN p.y - {CLUSTER_MAX} AND p.y + {CLUSTER_MAX}),
b AS (SELECT vec_id, arg_min(cell_id, struct_pack(dd := dist, cc := cell_id)) AS cell_id, MIN(dist) AS dist
      FROM d WHERE dist <= {CLUSTER_MAX} GROUP BY vec_id)
SELECT p.vec_id, b.cell_id AS grid_id, ROUND(b.dist, 10) AS assignment_distance_m FROM pts p LEFT JOIN b ON b.vec_id = p.vec_id""",
)
def q_nearest_clustered(spark, sf_dir):
    """Cubed coordinates crowd around the origin, so squares there split."""
    pts = embedding_points(spark, sf_dir)
    cube = lambda c: F.col(c) * F.col(c) * F.col(c)
    cen = pts.select(F.col("vec_id").alias("cell_id"), cube("x").alias("cx"), cube("y").alias("cy"))
    out = S.nearest_cell(pts.select("vec_id", "x", "y"), cen, "x", "y", "cell_id", "cx", "cy", CLUSTER_MAX, max_candidates=16)
    return out.select("vec_id", "grid_id", r10("assignment_distance_m").alias("assignment_distance_m"))
