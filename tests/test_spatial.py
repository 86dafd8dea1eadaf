"""Spatial operators: borders, equidistance, bucket exactness, clipping, projection."""

import math
import random

import pytest
from pyspark.sql import functions as F

from cellcast.functions import geo as G
from cellcast.operators import spatial as S


def test_within_excludes_borders_and_handles_left_edge(spark):
    grid = S.generate_grid(spark, 0.0, 0.0, 2.0, 1.0, 1.0)
    pts = spark.createDataFrame(
        [(1, 0.5, 0.5), (2, 1.0, 0.5), (3, 1.5, 0.25), (4, 0.0, 0.5), (5, 2.5, 0.5), (6, 0.5, 1.0)], "pid int, x double, y double"
    )
    out = {r["pid"]: r["grid_id"] for r in S.point_in_polygon(pts, grid, "x", "y", bucket=0.7).collect()}
    assert out == {1: "CA-00001", 3: "CA-00002"}


def test_concave_polygon(spark):
    # U shape: the notch (1..2, 1..3) is outside
    ring = [(0, 0), (3, 0), (3, 3), (2, 3), (2, 1), (1, 1), (1, 3), (0, 3), (0, 0)]
    cells = spark.createDataFrame([("u", [{"x": float(a), "y": float(b)} for a, b in ring])], "grid_id string, ring array<struct<x:double,y:double>>")
    pts = spark.createDataFrame([(1, 0.5, 2.0), (2, 1.5, 2.0), (3, 2.5, 2.5), (4, 1.5, 0.5)], "pid int, x double, y double")
    out = {r["pid"] for r in S.point_in_polygon(pts, cells, "x", "y", bucket=1.0).collect()}
    assert out == {1, 3, 4}


def test_nearest_matches_brute_force_and_max_distance(spark):
    rng = random.Random(3)
    cells = [(f"c{i}", rng.uniform(0, 100), rng.uniform(0, 100)) for i in range(40)]
    pts = [(i, rng.uniform(-5, 105), rng.uniform(-5, 105)) for i in range(300)]
    cdf = spark.createDataFrame(cells, "grid_id string, x double, y double")
    pdf = spark.createDataFrame(pts, "pid int, px double, py double")
    out = {r["pid"]: r for r in S.nearest_cell(pdf, cdf, "px", "py", max_distance=12.0).collect()}
    for pid, px, py in pts:
        d, cid = min((math.hypot(px - x, py - y), c) for c, x, y in cells)
        if d <= 12.0:
            assert out[pid]["grid_id"] == cid
            assert out[pid]["assignment_distance_m"] == pytest.approx(d)
        else:
            assert out[pid]["grid_id"] is None
    with pytest.raises(ValueError, match="more than"):
        S.enforce_all_assigned(S.nearest_cell(pdf, cdf, "px", "py", max_distance=1.0), max_distance=1.0)


def test_equidistant_centroids_pick_smallest_id(spark):
    cdf = spark.createDataFrame([("b", 0.0, 0.0), ("a", 2.0, 0.0)], "grid_id string, x double, y double")
    pdf = spark.createDataFrame([(1, 1.0, 0.0)], "pid int, px double, py double")
    assert S.nearest_cell(pdf, cdf, "px", "py", max_distance=5.0).first()["grid_id"] == "a"


def test_zonal_mode_tie_lowest_and_empty_cell_null(spark):
    grid = S.generate_grid(spark, 0.0, 0.0, 2.0, 1.0, 1.0)
    px = spark.createDataFrame(
        [(0.2, 0.5, 3), (0.4, 0.5, 1), (0.6, 0.5, 3), (0.8, 0.5, 1), (0.9, 0.9, None), (0.3, 0.3, -9999)],
        "x double, y double, value int",
    )
    out = {r["grid_id"]: r for r in S.zonal_statistics(px, grid, mean_col="value", mode_col="value", nodata=-9999, bucket=1.0).collect()}
    assert out["CA-00001"]["value_mode"] == 1
    assert out["CA-00001"]["value_mean"] == 2.0
    assert out["CA-00002"]["value_mode"] is None and out["CA-00002"]["value_mean"] is None


def test_clip_areas_sum_to_region_area(spark):
    ring = [(0.1, 0.1), (2.9, 0.2), (1.5, 1.4), (2.8, 2.9), (0.2, 2.7), (0.1, 0.1)]  # concave
    region = spark.createDataFrame([([{"x": a, "y": b} for a, b in ring],)], "ring array<struct<x:double,y:double>>")
    grid = S.generate_grid(spark, 0.0, 0.0, 3.0, 3.0, 0.5).withColumn("cell_key", F.col("ix") * 1000 + F.col("iy"))
    clipped = S.clip_cells(grid, region, "cell_key")
    total = clipped.agg(F.sum("area")).first()[0]
    xs, ys = [p[0] for p in ring], [p[1] for p in ring]
    area = abs(sum(xs[i] * ys[i + 1] - xs[i + 1] * ys[i] for i in range(len(ring) - 1))) / 2
    assert total == pytest.approx(area, rel=1e-9)


def test_albers_round_trip(spark):
    df = spark.createDataFrame([(-122.4194, 37.7749), (-114.13, 32.53)], "lon double, lat double")
    x, y = G.albers_xy(F.col("lon"), F.col("lat"))
    back = G.albers_inverse(df.select("lon", "lat", x.alias("x"), y.alias("y")), "x", "y", "lon2", "lat2")
    for r in back.collect():
        assert r["lon2"] == pytest.approx(r["lon"], abs=1e-9)
        assert r["lat2"] == pytest.approx(r["lat"], abs=1e-9)
        px, py = G.albers_xy_py(r["lon"], r["lat"])
        assert r["x"] == pytest.approx(px, abs=1e-6) and r["y"] == pytest.approx(py, abs=1e-6)


def test_cluster_sizes_by_zoom():
    assert [S.cluster_pixels(z) for z in (3, 5, 6, 7, 8, 9)] == [110, 110, 90, 72, 52, 0]


def _ring(points):
    return [{"x": float(a), "y": float(b)} for a, b in points]


RING = "array<struct<x:double,y:double>>"


def _box(x0, y0, x1, y1):
    return _ring([(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)])


def test_point_in_a_hole_is_outside(spark):
    cells = spark.createDataFrame(
        [("a", _box(0, 0, 10, 10), [_box(4, 4, 6, 6)]), ("a", _box(20, 0, 30, 10), None), ("b", _box(4.5, 4.5, 5.5, 5.5), [])],
        f"grid_id string, ring {RING}, holes array<{RING}>",
    )
    pts = spark.createDataFrame(
        [(1, 5.0, 4.2), (2, 3.0, 5.0), (3, 25.0, 5.0), (4, 15.0, 5.0), (5, 5.0, 5.0), (6, 4.0, 5.0), (7, None, 1.0)],
        "pid int, x double, y double",
    )
    for bucket, most in ((1.0, 1024), (3.0, 1), (100.0, 2)):
        found = S.point_in_polygon(pts, cells, "x", "y", bucket=bucket, holes_col="holes", max_edges=most)
        assert {r["pid"]: r["grid_id"] for r in found.collect()} == {2: "a", 3: "a", 5: "b"}


def _even_odd(rings, x, y):
    inside = False
    for ring in rings:
        for (ax, ay), (bx, by) in zip(ring, ring[1:]):
            if (ay > y) != (by > y) and x < ax + (y - ay) * (bx - ax) / (by - ay):
                inside = not inside
    return inside


def test_long_ring_is_spread_over_buckets(spark):
    """A jagged ring with a hole against the plain even-odd rule, at several bucket sizes."""
    from cellcast.operators import polygons

    rng = random.Random(5)

    def star(n, low, high):
        out = [((r := rng.uniform(low, high)) * math.cos(2 * math.pi * i / n), r * math.sin(2 * math.pi * i / n)) for i in range(n)]
        return [*out, out[0]]

    outer, hole = star(3000, 60, 100), star(500, 10, 40)
    cells = spark.createDataFrame([("c", _ring(outer), [_ring(hole)])], f"grid_id string, ring {RING}, holes array<{RING}>")
    pts = [(i, rng.uniform(-105, 105), rng.uniform(-105, 105)) for i in range(1500)]
    df = spark.createDataFrame(pts, "pid int, x double, y double").repartition(3)
    want = {i for i, x, y in pts if _even_odd([outer, hole], x, y)}
    for bucket, most in ((7.0, 1024), (50.0, 64)):
        found = S.point_in_polygon(df, cells, "x", "y", bucket=bucket, holes_col="holes", max_edges=most)
        assert {r["pid"] for r in found.collect()} == want
    sparse, dense = polygons.edge_index(polygons.polygon_edges(cells, "grid_id", "ring", "holes"), 7.0, 0.5, 1024)
    assert sparse.count() > 300 and dense.count() == 0
    assert sparse.selectExpr("max(size(cells[0].edges))").first()[0] < 200


def test_vertices_on_reference_lines_and_points_level_with_vertices(spark):
    cells = spark.createDataFrame([("d", _ring([(0.5, 0), (1, 0.5), (0.5, 1), (0, 0.5), (0.5, 0)]))], f"grid_id string, ring {RING}")
    pts = [(i, (i % 33) / 32, (i // 33) / 32) for i in range(33 * 33)]  # exact in binary
    df = spark.createDataFrame(pts, "pid int, x double, y double")
    want = {i for i, x, y in pts if abs(x - 0.5) + abs(y - 0.5) < 0.5}
    for bucket in (1.0, 0.25):
        assert {r["pid"] for r in S.point_in_polygon(df, cells, "x", "y", bucket=bucket).collect()} == want


def test_nearest_in_dense_clusters_matches_brute_force(spark):
    rng = random.Random(9)
    cells = [(f"c{i:04d}", rng.gauss(50, 0.01 if i % 3 else 30), rng.gauss(50, 0.01 if i % 3 else 30)) for i in range(900)]
    cells += [(f"d{i}", 50.0, 50.0) for i in range(40)]
    pts = [(i, rng.gauss(50, 5), rng.gauss(50, 5)) for i in range(200)] + [(200 + i, rng.gauss(50, 0.01), rng.gauss(50, 0.01)) for i in range(100)]
    pts += [(400, None, 1.0), (401, 1e6, 1e6), (402, 50.0, 50.0)]
    cdf = spark.createDataFrame(cells, "grid_id string, x double, y double")
    pdf = spark.createDataFrame(pts, "pid int, px double, py double")
    for most in (4, 2000):
        out = {r["pid"]: r for r in S.nearest_cell(pdf, cdf, "px", "py", max_distance=20.0, max_candidates=most).collect()}
        assert len(out) == len(pts)
        for pid, px, py in pts:
            d, cid = min((math.hypot(px - x, py - y), c) for c, x, y in cells) if px is not None else (1e9, None)
            assert out[pid]["grid_id"] == (cid if d <= 20 else None), (most, pid)
            if d <= 20:
                assert out[pid]["assignment_distance_m"] == pytest.approx(d)
    assert S.nearest_cell(pdf, cdf.limit(0), "px", "py").where("grid_id is not null").count() == 0


def test_quadtree_lists_are_short(spark):
    from cellcast.operators.nearest import quadtree

    rng = random.Random(2)
    rows = [(str(i), rng.gauss(0, 1e-4), rng.gauss(0, 1e-4)) for i in range(600)] + [("x", 5.0, 5.0)]
    levels = quadtree(spark.createDataFrame(rows, "cell_id string, cx double, cy double"), 1.0, 10)
    assert len(levels) > 4
    assert max(t.selectExpr("max(size(cells))").first()[0] or 0 for t in levels) <= 10
    assert sum(t.selectExpr("sum(size(cells))").first()[0] or 0 for t in levels) == 601


def test_clip_two_parts_and_a_hole(spark):
    region = spark.createDataFrame(
        [(_box(0.1, 0.1, 2.9, 2.9), [_ring(reversed([(1.2, 1.2), (1.8, 1.2), (1.8, 1.8), (1.2, 1.8)]))]),
         (_ring([(3.2, 0.2), (3.8, 0.2), (3.2, 0.8)]), None), (_box(2.95, 0.1, 3.1, 0.9), [])],
        f"ring {RING}, holes array<{RING}>",
    )
    grid = S.generate_grid(spark, 0.0, 0.0, 4.0, 3.0, 1.0)
    out = {r["grid_key"]: r for r in S.clip_cells(grid.withColumn("k", F.col("ix") * 10 + F.col("iy")), region, "k", "ring", "holes").collect()}
    areas = {k: r["area"] for k, r in out.items()}
    assert set(areas) == {0, 1, 2, 10, 11, 12, 20, 21, 22, 30}
    assert areas[11] == pytest.approx(1 - 0.36) and areas[0] == pytest.approx(0.81) and areas[1] == pytest.approx(0.9)
    assert areas[20] == pytest.approx(0.81 + 0.05 * 0.8) and areas[30] == pytest.approx(0.18 + 0.1 * 0.8)
    assert (out[11]["centroid_x"], out[11]["centroid_y"]) == (pytest.approx(1.5), pytest.approx(1.5))
    assert out[30]["centroid_x"] == pytest.approx((0.18 * 3.4 + 0.08 * 3.05) / 0.26)
    assert [p["hole"] for p in out[11]["pieces"]].count(True) == 1
    assert S.clip_cells(grid.withColumn("k", F.col("ix")), region.limit(0), "k").count() == 0
