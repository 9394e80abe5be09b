"""Density outliers and clusters (O1, O2, F4): exact DBSCAN over a cell index.

A row is core when at least ``min_samples`` rows, itself included, lie within ``eps``;
border when it is not core but a core row does; noise otherwise.

1. standardise (population sd, 0 -> 1) and collapse equal vectors into one weighted point,
   so a hot duplicate is one row;
2. a cell of side ``eps / sqrt(d)`` that holds ``min_samples`` rows is all core, with no
   distance computed; so is such a cell of a grid shifted by half a side;
3. the points left, which lie in thin cells, count the rows around them (``cells.tally``),
   first in the cells next to theirs, then those still short of ``min_samples`` in all cells
   within reach; they stop at ``min_samples``;
4. non-core points look for one core point the same way; without one they are noise.

Clusters: the core points of a cell belong together, and so do the cells that share a cell of
a shifted grid, which joins up dense regions by a distinct and no pairs. What is left are
pairs of cells of different components: the boxes decide most of them, and the rest are
opened at their border, one answer for each pair of components being enough.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .cells import boxes, cell_of, cell_side, components, farthest2, near_cells, nearest2, shifted_cells, spread, tally
from .encode import fit_standard_scaler


def _scaled(df: DataFrame, columns: Sequence[str], id_col: str) -> DataFrame:
    """``(id, z)``, read by every step below: written once to the shared folder.

    A row without a coordinate has no neighbours to count: an error, not a dropped row.
    """
    stats = fit_standard_scaler(df, columns)
    known = {c: F.coalesce(F.col(c).cast("double"), F.raise_error(F.lit(f"NULL coordinate in {c}")).cast("double")) for c in columns}
    return stored(df.select(id_col, F.array(*[(known[c] - F.lit(m)) / F.lit(s) for c, (m, s) in stats.items()]).alias("z")))


def _asked(queries: DataFrame, cells: DataFrame, d: int, reach: int | None = None) -> DataFrame:
    return queries.join(spread(near_cells(queries, cells, d, reach)), "cell").select(F.col("z").alias("group"), "z", "near")


def _point_flags(scaled: DataFrame, d: int, eps: float, min_samples: int) -> DataFrame:
    """``(z, w, cell, is_core)`` of each distinct point."""
    side = cell_side(eps, d)
    points = stored(scaled.groupBy("z").agg(F.count(F.lit(1)).alias("w")).withColumn("cell", F.expr(cell_of(d, side))))
    cells = stored(boxes(points, d, side).select("node", "n"))
    sparse = stored(points.join(spread(cells.filter(F.col("n") < min_samples).select(F.col("node").alias("cell"))), "cell", "left_semi").select("z", "w", "cell"))
    full = shifted_cells(points, d, side).groupBy("grid", "at").agg(F.sum("w").alias("n")).filter(F.col("n") >= min_samples)
    proven = shifted_cells(sparse, d, side).join(spread(full), ["grid", "at"], "left_semi").select("z").distinct()
    rest = stored(sparse.join(spread(proven), "z", "left_anti"))
    short = rest
    for reach in (1, None):
        if short.isEmpty():
            break
        counted = tally(_asked(short, cells, d, reach), points, d, side, eps, min_samples)
        reached = counted.filter(F.col("n") >= min_samples).select(F.col("group").alias("z"))
        short = stored(short.join(spread(reached), "z", "left_anti"))
    missed = short.select("z", F.lit(False).alias("__core"))
    flagged = points.join(spread(missed), "z", "left").select("z", "w", "cell", F.coalesce("__core", F.lit(True)).alias("is_core"))
    return stored(flagged)


def dbscan_flags(df: DataFrame, columns: Sequence[str], eps: float = 2.5, min_samples: int = 5,
                 id_col: str = "row_id") -> DataFrame:
    """``(id, is_core, is_noise)`` for every row of ``df``."""
    d, side = len(columns), cell_side(eps, len(columns))
    scaled = _scaled(df, columns, id_col)
    flags = _point_flags(scaled, d, eps, min_samples)
    core = flags.filter("is_core").select("z", "w")
    found = tally(_asked(flags.filter("NOT is_core"), boxes(core, d, side), d), core, d, side, eps, 1)
    border = found.select(F.col("group").alias("z"), F.lit(True).alias("__b"))
    flags = flags.join(spread(border), "z", "left").select("z", "is_core", (~F.col("is_core") & F.col("__b").isNull()).alias("is_noise"))
    return scaled.join(spread(flags), "z").select(id_col, "is_core", "is_noise")


def dbscan_filter(df: DataFrame, columns: Sequence[str], eps: float = 2.5, min_samples: int = 5,
                  id_col: str = "row_id") -> DataFrame:
    """O1 + F4: drop the noise rows (``detect_outliers_dbscan``)."""
    flags = dbscan_flags(df, columns, eps, min_samples, id_col)
    keep = flags.filter(~F.col("is_noise")).select(id_col)
    return df.join(spread(keep), id_col, "left_semi")


def _core_components(core: DataFrame, cells: DataFrame, d: int, side: float, eps: float) -> DataFrame:
    """``(cell, root)`` of the cells that hold core points; ``cells`` are their boxes."""
    both = shifted_cells(core.select("z", "cell"), d, side)
    # a cell of a shifted grid hangs its cells below the least of them
    met = both.select("cell", "grid", "at").distinct()
    edges = met.join(spread(met.groupBy("grid", "at").agg(F.min("cell").alias("low"))), ["grid", "at"]).select(F.col("cell").alias("a"), F.col("low").alias("b"))
    root = _rooted(cells.select(F.col("node").alias("cell")), components(edges))
    # cells of different components: by their boxes, then by their points
    side_a = cells.select(F.col("node").alias("cell"), F.col("lo").alias("lo"), F.col("hi").alias("hi"), F.col("m").alias("m_a")).join(spread(root), "cell")
    side_b = cells.select(F.col("node").alias("near"), F.col("lo").alias("node_lo"), F.col("hi").alias("node_hi"), F.col("m").alias("m_b")).join(
        spread(root.select(F.col("cell").alias("near"), F.col("root").alias("other"))), "near")
    pairs = near_cells(side_a, cells, d).join(spread(side_a), "cell").join(spread(side_b), "near").filter(F.col("root") != F.col("other"))
    # each pair of cells from the side with fewer points (ties: the lesser cell)
    pairs = pairs.filter((F.col("m_a") < F.col("m_b")) | ((F.col("m_a") == F.col("m_b")) & (F.col("cell") < F.col("near"))))
    pairs = stored(pairs.filter(nearest2(d, "lo", "hi") <= eps * eps).select(
        F.struct(F.least("root", "other").alias("a"), F.greatest("root", "other").alias("b")).alias("group"), "cell", "near",
        (farthest2(d, "lo", "hi") <= eps * eps).alias("sure")))
    sure = pairs.filter("sure").select("group").distinct()
    asked = pairs.join(spread(sure), "group", "left_anti").join(spread(core.select("z", "cell")), "cell").select("group", "z", "near")
    links = sure.unionByName(tally(asked, core, d, side, eps, 1).select("group")).select("group.a", "group.b")
    top = _rooted(root.select(F.col("root").alias("cell")).distinct(), components(links))
    return stored(root.join(spread(top.select(F.col("cell").alias("root"), F.col("root").alias("top"))), "root").select("cell", F.col("top").alias("root")))


def _rooted(cells: DataFrame, found: DataFrame) -> DataFrame:
    """A root for each cell: its component's, or itself where it has no edge."""
    return stored(cells.join(spread(found.withColumnRenamed("node", "cell")), "cell", "left").select("cell", F.coalesce("root", "cell").alias("root")))


def dbscan_clusters(df: DataFrame, columns: Sequence[str], eps: float = 2.5, min_samples: int = 5,
                    id_col: str = "row_id") -> DataFrame:
    """O2: ``(id, cluster_id)`` for every row; ids are integers from 0.

    A cluster is named by the smallest id of its core rows; noise is -1. A border row within
    ``eps`` of several clusters goes to the one with the smallest name, which is the one a scan
    of the rows in id order reaches first.
    """
    d, side = len(columns), cell_side(eps, len(columns))
    scaled = _scaled(df, columns, id_col)
    flags = _point_flags(scaled, d, eps, min_samples)
    core = stored(flags.filter("is_core").select("z", "w", "cell"))
    cells = stored(boxes(core, d, side))
    root = _core_components(core, cells, d, side, eps)
    of_core = core.select("z", "cell").join(spread(root), "cell").select("z", "root")
    names = stored(scaled.join(spread(of_core), "z").groupBy("root").agg(F.min(id_col).alias("cluster_id")))
    named = stored(root.join(spread(names), "root").select("cell", "cluster_id"))
    near = near_cells(flags.filter("NOT is_core"), cells, d).join(spread(named.withColumnRenamed("cell", "near")), "near")
    asked = flags.filter("NOT is_core").join(spread(near), "cell").select(F.struct("z", "cluster_id").alias("group"), "z", "near")
    border = tally(asked, core, d, side, eps, 1).groupBy(F.col("group.z").alias("z")).agg(F.min("group.cluster_id").alias("cluster_id"))
    placed = core.select("z", "cell").join(spread(named), "cell").select("z", "cluster_id").unionByName(border)
    return scaled.join(spread(placed), "z", "left").select(id_col, F.coalesce("cluster_id", F.lit(-1)).cast("bigint").alias("cluster_id"))
