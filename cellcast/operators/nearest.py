"""Nearest cell within a maximum distance (J7) through an adaptive quadtree.

The plane is cut into squares as wide as the maximum distance.  A square with at
most ``max_candidates`` centroids lists them; one with more is split into sixteen
(two levels of a quadtree at once), and so on, so no list is longer.  A centroid within the distance lies in a
point's own square or one of the eight around it, and those nine are laid out per
square: a point needs one equi-join.  Where all nine are lists, the nearest
listed centroid is the answer.  Where some are split, their children are looked
at level by level, nearest first: a square whose nearest edge is farther than the
best distance known so far is left out, so few are followed, whatever the density.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellcast.fixed_values import MAX_ASSIGN_DISTANCE_METRES
from cellcast.session import cut_lineage

#: Bits of a coordinate that one split looks at, and splits at most: squares of the last
#: level are 2^-40 of the distance wide.
_BITS = 2
_LEVELS = 20


def quadtree(centroids: DataFrame, side: float, max_candidates: int) -> list[DataFrame]:
    """Squares by level: (bx, by, split, x0, y0, x1, y1, cells).

    The box is that of the centroids inside; ``cells`` is null in split squares.
    Centroids at one place count once, by their smallest id.
    """
    rest = centroids.groupBy("cx", "cy").agg(F.min("cell_id").alias("cell_id"))
    levels = []
    while True:
        width = side / (1 << (_BITS * len(levels)))
        dealt = rest.withColumn("bx", F.floor(F.col("cx") / width)).withColumn("by", F.floor(F.col("cy") / width))
        # A list is built only where it is short: sizes come first.
        box = dealt.groupBy("bx", "by").agg(
            F.count("*").alias("n"), F.min("cx").alias("x0"), F.min("cy").alias("y0"), F.max("cx").alias("x1"), F.max("cy").alias("y1")
        )
        box = cut_lineage(box, "squares")
        last = len(levels) == _LEVELS
        many = F.lit(False) if last else F.col("n") > max_candidates
        full = box.where(many).select("bx", "by")
        lists = (
            dealt.join(full, ["bx", "by"], "left_anti")
            .groupBy("bx", "by")
            .agg(F.collect_list(F.struct("cell_id", "cx", "cy")).alias("cells"))
        )
        squares = box.withColumn("split", many).drop("n").join(lists, ["bx", "by"], "left")
        levels.append(cut_lineage(squares.select("bx", "by", "split", "x0", "y0", "x1", "y1", "cells"), "quadtree"))
        if not levels[-1].where("split").limit(1).count():
            return levels
        rest = cut_lineage(dealt.join(full, ["bx", "by"], "left_semi").select("cx", "cy", "cell_id"), "centroids")


def _nearest_edge(s: Column, px: Column, py: Column) -> Column:
    dx = F.greatest(s["x0"] - px, px - s["x1"], F.lit(0.0))
    dy = F.greatest(s["y0"] - py, py - s["y1"], F.lit(0.0))
    return F.hypot(dx, dy)


def _farthest_edge(s: Column, px: Column, py: Column) -> Column:
    dx = F.greatest(F.abs(px - s["x0"]), F.abs(px - s["x1"]))
    dy = F.greatest(F.abs(py - s["y0"]), F.abs(py - s["y1"]))
    return F.hypot(dx, dy)


def _best_listed(squares: Column, px: Column, py: Column) -> Column:
    """Smallest (distance, id) in the lists of an array of squares."""
    lists = F.transform(
        F.filter(squares, lambda s: ~s["split"]),
        lambda s: F.array_min(
            F.transform(s["cells"], lambda c: F.struct(F.hypot(px - c["cx"], py - c["cy"]).alias("d"), c["cell_id"].alias("id")))
        ),
    )
    return F.array_min(lists)


def _open(squares: Column, best: Column, px: Column, py: Column, limit: float) -> Column:
    """Split squares that may still hold something nearer than all that is known.

    ``limit * 1e-12`` keeps squares that rounding puts just outside.
    """
    split = F.filter(squares, lambda s: s["split"])
    within = F.array_min(F.transform(split, lambda s: _farthest_edge(s, px, py)))
    bound = F.least(F.coalesce(best["d"], F.lit(float("inf"))), F.coalesce(within, F.lit(float("inf"))), F.lit(float(limit)))
    kept = F.filter(split, lambda s: _nearest_edge(s, px, py) <= bound * (1 + 1e-12) + limit * 1e-12)
    return F.transform(kept, lambda s: F.struct(s["bx"].alias("bx"), s["by"].alias("by")))


def nearest_cell(
    points: DataFrame,
    cells: DataFrame,
    x_col: str,
    y_col: str,
    cell_id_col: str = "grid_id",
    cell_x_col: str = "x",
    cell_y_col: str = "y",
    max_distance: float = MAX_ASSIGN_DISTANCE_METRES,
    output_col: str = "grid_id",
    distance_col: str = "assignment_distance_m",
    max_candidates: int = 64,
) -> DataFrame:
    """Nearest centroid for every point; null when none lies within ``max_distance``.

    Exact at every density.  Equidistant centroids give the smallest id.  Use
    :func:`enforce_all_assigned` to raise for points without a cell.
    """
    centroids = cells.select(
        F.col(cell_id_col).alias("cell_id"),
        F.col(cell_x_col).cast("double").alias("cx"),
        F.col(cell_y_col).cast("double").alias("cy"),
    ).where("cx is not null and cy is not null")
    levels = quadtree(centroids, max_distance, max_candidates)
    square = F.struct("bx", "by", "split", "x0", "y0", "x1", "y1", "cells")
    around = F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx in (-1, 0, 1) for dy in (-1, 0, 1)])
    spread = levels[0].select(square.alias("s"), F.explode(around).alias("o"))
    nine = spread.groupBy((F.col("s.bx") + F.col("o.dx")).alias("_kx"), (F.col("s.by") + F.col("o.dy")).alias("_ky")).agg(
        F.collect_list("s").alias("_squares")
    )
    px, py = F.col(x_col).cast("double"), F.col(y_col).cast("double")
    keyed = points.withColumn("_kx", F.floor(px / max_distance)).withColumn("_ky", F.floor(py / max_distance))
    base = keyed.join(nine, ["_kx", "_ky"], "left").withColumn("_best", _best_listed(F.col("_squares"), px, py))
    base = base.withColumn("_open", _open(F.col("_squares"), F.col("_best"), px, py, max_distance))

    def finish(df: DataFrame) -> DataFrame:
        within = F.col("_best.d") <= F.lit(max_distance)
        return df.select(
            *[c for c in points.columns if c not in (output_col, distance_col)],
            F.when(within, F.col("_best.id")).alias(output_col),
            F.when(within, F.col("_best.d")).alias(distance_col),
        )

    if len(levels) == 1:
        return finish(base)
    some = F.coalesce(F.size("_open") > 0, F.lit(False))
    done = finish(base.where(~some))
    # Points near split squares, numbered once; only their place and frontier go down the levels.
    crowd = cut_lineage(
        base.where(some).drop("_kx", "_ky", "_squares").withColumn("_point", F.monotonically_increasing_id()), "crowd"
    )
    frontier = crowd.select("_point", px.alias("px"), py.alias("py"), "_best", F.explode("_open").alias("_at"))
    best = crowd.select("_point", "_best")
    for depth in range(1, len(levels)):
        # A square's children are those of the next level whose numbers, without the last bits, are its own.
        children = levels[depth].select(
            F.shiftright("bx", _BITS).alias("ux"), F.shiftright("by", _BITS).alias("uy"), square.alias("s")
        )
        at = frontier.select("_point", "px", "py", "_best", F.col("_at.bx").alias("ux"), F.col("_at.by").alias("uy"))
        met = at.join(children, ["ux", "uy"]).groupBy("_point").agg(
            F.any_value("px").alias("px"), F.any_value("py").alias("py"), F.min("_best").alias("_known"), F.collect_list("s").alias("_squares")
        )
        x, y = F.col("px"), F.col("py")
        met = met.withColumn("_best", F.array_min(F.filter(F.array("_known", _best_listed(F.col("_squares"), x, y)), lambda b: b.isNotNull())))
        met = met.withColumn("_open", _open(F.col("_squares"), F.col("_best"), x, y, max_distance))
        met = cut_lineage(met.select("_point", "px", "py", "_best", "_open"), "frontier")
        best = best.unionByName(met.select("_point", "_best"))
        frontier = met.select("_point", "px", "py", "_best", F.explode("_open").alias("_at"))
    best = best.where("_best is not null").groupBy("_point").agg(F.min("_best").alias("_best"))
    return done.unionByName(finish(crowd.drop("_best", "_open").join(best, "_point", "left")))


def enforce_all_assigned(assigned: DataFrame, output_col: str = "grid_id", max_distance: float = MAX_ASSIGN_DISTANCE_METRES) -> None:
    n = assigned.agg(F.count_if(F.col(output_col).isNull())).first()[0]
    if n:
        raise ValueError(f"{n:,} points lie more than {max_distance / 1000:g} km from the nearest cell centroid.")
