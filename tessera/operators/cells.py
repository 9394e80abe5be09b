"""Cell index for questions about a radius: which points have how many others within ``eps``.

Points (``z`` array of coordinates, ``w`` rows that share them) lie in cells of side
``eps / sqrt(d)``, shrunk a little so that two points of one cell are never farther apart than
``eps``. Only occupied cells are ever listed:

* ``near_cells`` walks from each cell to its neighbours one coordinate at a time and keeps a
  step only if some occupied cell begins that way, so empty space costs nothing;
* ``tally`` holds a point against the tight box of a cell. A box wholly within ``eps`` counts
  by its total, one beyond it is dropped, and only a box that the radius cuts is opened, into
  smaller cells and in the end into its points. A group that has ``enough`` is opened no further.

Distances are sums in coordinate order, and rounding is monotone, so the verdict on a box is
the verdict on each of its points: results equal those over all pairs.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored

LEAF = 32            # a box of so many distinct points, or fewer, opens into points at once
SPLIT = 4            # sides of a cell over sides of the cells it opens into
DEEPEST = 12         # SPLIT ** DEEPEST parts of a side: closer points are opened one by one


def spread(df: DataFrame) -> DataFrame:
    """``df`` for a join by shuffle: what grows with the cells or points is never sent whole through the driver."""
    return df.hint("merge")


def cell_side(eps: float, d: int) -> float:
    return eps / math.sqrt(d) * (1 - 1e-6)


def cell_of(d: int, side: float, level: int = 0, shift: tuple = ()) -> str:
    """SQL text of the cell's integer coordinates as one array; a cell of the next level lies in one of this level."""
    part = side / SPLIT ** level
    z = [f"z[{i}] + {shift[i]!r}D" if shift else f"z[{i}]" for i in range(d)]
    return f"array({', '.join(f'floor(({x}) / {part!r}D)' for x in z)})"


def shifted_cells(points: DataFrame, d: int, side: float) -> DataFrame:
    """``points`` once per shifted grid, with its cell there: half a side along each axis, and along all."""
    half = side / 2
    shifts = [tuple(half if i == j else 0.0 for i in range(d)) for j in range(d)] + [(half,) * d]
    grids = ", ".join(f"struct({s} AS grid, {cell_of(d, side, 0, shift)} AS at)" for s, shift in enumerate(shifts))
    return points.selectExpr("*", f"inline(array({grids}))")


def boxes(points: DataFrame, d: int, side: float, level: int = 0) -> DataFrame:
    """Occupied cells: ``node``, tight box ``lo`` to ``hi``, ``n`` rows, ``m`` distinct points."""
    lo, hi = (f"array({', '.join(f'{end}(z[{i}])' for i in range(d))})" for end in ("min", "max"))
    return points.groupBy(F.expr(cell_of(d, side, level)).alias("node")).agg(
        F.expr(lo).alias("lo"), F.expr(hi).alias("hi"), F.sum("w").alias("n"), F.count(F.lit(1)).alias("m"))


def _squares(terms) -> str:
    """Sum of squares in the order of the coordinates."""
    return " + ".join(f"{t} * {t}" for t in terms)


def nearest2(d: int, lo: str = "z", hi: str = "z") -> Column:
    """Least squared distance between the box ``lo`` to ``hi`` of a query (a point: ``z``) and that of a node."""
    return F.expr(_squares(f"greatest(node_lo[{i}] - {hi}[{i}], {lo}[{i}] - node_hi[{i}], 0D)" for i in range(d)))


def farthest2(d: int, lo: str = "z", hi: str = "z") -> Column:
    return F.expr(_squares(f"greatest(abs({hi}[{i}] - node_lo[{i}]), abs(node_hi[{i}] - {lo}[{i}]))" for i in range(d)))


def near_cells(queries: DataFrame, cells: DataFrame, d: int, reach: int | None = None) -> DataFrame:
    """``(cell, near)``: for each distinct ``cell`` of ``queries`` the occupied ``node`` cells that a
    ball of radius ``eps`` around one of its points can touch, or those at most ``reach`` steps off."""
    top = reach or math.isqrt(d) + 1
    steps = f"explode(sequence({-top}, {top})) AS step"
    out = queries.select("cell").distinct().selectExpr("cell", "cast(array() AS array<bigint>) AS near", "0 AS gap")
    for i in range(d):
        out = (out.selectExpr("*", steps)
                  .selectExpr("cell", f"concat(near, array(cell[{i}] + step)) AS near", "gap + greatest(abs(step) - 1, 0) * greatest(abs(step) - 1, 0) AS gap")
                  .filter(f"gap <= {d}"))
        begins = cells.selectExpr("node AS near") if i == d - 1 else cells.selectExpr(f"slice(node, 1, {i + 1}) AS near").distinct()
        out = out.join(spread(begins), "near", "left_semi")
    return out.select("cell", "near")


def tally(asked: DataFrame, points: DataFrame, d: int, side: float, eps: float, enough: int) -> DataFrame:
    """``(group, n)``: rows of ``points`` within ``eps``, summed over the queries of a group.

    ``asked`` holds ``group``, ``z`` and the ``near`` cell to look into. ``n`` is exact below
    ``enough``; a group that reaches it may stop there. Groups that find nothing are absent.
    """
    eps2 = F.lit(eps * eps)

    def judged(rows: DataFrame) -> DataFrame:
        kept = rows.withColumn("inside", farthest2(d) <= eps2).filter(F.col("inside") | (nearest2(d) <= eps2))
        return stored(kept.select("group", "z", "node", "n", "m", "inside"))

    def as_nodes(found: DataFrame, *more: str) -> DataFrame:
        return found.select(*more, "node", F.col("lo").alias("node_lo"), F.col("hi").alias("node_hi"), "n", "m")

    seen = judged(asked.join(spread(as_nodes(boxes(points, d, side))), F.col("near") == F.col("node")))
    found, level = seen.filter("inside").select("group", "n"), 0
    while True:
        total = found.groupBy("group").agg(F.sum("n").alias("n"))
        cut = seen.filter(~F.col("inside")).join(spread(total.filter(F.col("n") >= enough)), "group", "left_anti").select("group", "z", F.col("node").alias("up"), "m")
        if cut.isEmpty():
            return total
        leaf = (F.col("m") <= LEAF) | F.lit(level >= DEEPEST)
        here = points.withColumn("up", F.expr(cell_of(d, side, level)))
        ones = here.select("up", F.col("up").alias("node"), F.col("z").alias("node_lo"), F.col("z").alias("node_hi"), F.col("w").alias("n"), F.lit(1).cast("bigint").alias("m"))
        opened = cut.filter(leaf).drop("m").join(spread(ones), "up")
        if level < DEEPEST:
            inner = here.join(spread(cut.filter(~leaf).select("up").distinct()), "up", "left_semi")
            parts = as_nodes(boxes(inner, d, side, level + 1)).withColumn("up", F.expr(f"transform(node, c -> floor(c / {SPLIT}))"))
            opened = opened.unionByName(cut.filter(~leaf).drop("m").join(spread(parts), "up"))
        seen, level = judged(opened), level + 1
        found = found.unionByName(seen.filter("inside").select("group", "n"))


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for each end of the edges ``(a, b)``: the smallest node it is connected to.

    Large and small stars in turn: a round hangs each node's neighbours below the smallest of them,
    which takes a number of rounds logarithmic in the size, not in the diameter.
    """
    edges = stored(edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    both = lambda e: e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    while True:
        # large star: neighbours above a node hang below the least of it and its neighbours
        around = both(edges)
        least = around.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
        large = around.join(spread(least), "a").filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        # small star: a node and its neighbours below it hang below the least of them
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(spread(low), "a").select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(low.select("a", F.col("low").alias("b")))
        after = stored(small.filter("a != b").distinct())
        if after.exceptAll(edges).isEmpty() and edges.exceptAll(after).isEmpty():
            stars = after.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node")
            roots = stars.select(F.col("root").alias("node"), "root").distinct()
            return stars.unionByName(roots)
        edges = after
