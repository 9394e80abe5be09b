"""Cell index, components and DBSCAN clusters against all pairs in plain numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from tessera.operators import cells as CE
from tessera.operators.outliers import dbscan_clusters, dbscan_flags


def plain_dbscan(x, eps, m):
    """Noise -1; a cluster is named by its first core row; a border row goes to its smallest name."""
    sd = x.std(0)
    sd[sd == 0] = 1.0
    z = (x - x.mean(0)) / sd
    near = sum((z[:, None, i] - z[None, :, i]) ** 2 for i in range(x.shape[1])) <= eps * eps
    core = near.sum(1) >= m
    name = np.full(len(x), -1)
    for i in np.flatnonzero(core):
        if name[i] < 0:
            todo, name[i] = [i], i
            while todo:
                for j in np.flatnonzero(near[todo.pop()] & core & (name < 0)):
                    name[j] = i
                    todo.append(j)
    for i in np.flatnonzero(~core):
        of = name[near[i] & core]
        name[i] = of.min() if len(of) else -1
    return core, name


def table(spark, x):
    names = [f"c{i}" for i in range(x.shape[1])]
    rows = [(i, *map(float, r)) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, "row_id long, " + ", ".join(f"{n} double" for n in names)), names


def shapes(kind):
    g = np.random.default_rng(5)
    if kind == "dense blobs, ring and copies":   # cells with far more points than a leaf
        blobs = np.concatenate([g.normal(c, 0.25, (220, 2)) for c in ((0, 0), (1.3, 0.2), (4, 4))])
        angle = np.arange(90) * 2 * np.pi / 90
        ring = np.stack([4 + 2.0 * np.cos(angle), 4 + 2.0 * np.sin(angle)], 1)
        return np.concatenate([blobs, ring, np.repeat([[8.0, -3.0]], 40, 0), g.uniform(-4, 9, (60, 2))]), 0.12, 6
    if kind == "four axes, thin":
        return np.concatenate([g.normal(0, 1, (150, 4)), g.normal(3, 0.3, (50, 4))]), 0.6, 4
    return np.round(np.cumsum(np.ones((60, 1)), 0) * 0.5, 6), 0.06, 2   # a chain whose steps are close to eps


@pytest.mark.parametrize("kind", ["dense blobs, ring and copies", "four axes, thin", "chain"])
def test_clusters_equal_plain_dbscan(spark, kind):
    x, eps, m = shapes(kind)
    core, name = plain_dbscan(x, eps, m)
    df, cols = table(spark, x)
    got = {r.row_id: r.cluster_id for r in dbscan_clusters(df, cols, eps, m).collect()}
    assert [got[i] for i in range(len(x))] == name.tolist()
    if kind != "chain":
        assert len(set(name[name >= 0])) > 1
        flags = {r.row_id: (r.is_core, r.is_noise) for r in dbscan_flags(df, cols, eps, m).collect()}
        assert [flags[i] for i in range(len(x))] == list(zip(core.tolist(), (name < 0).tolist()))


def test_tally_is_exact_below_enough_and_opens_hot_cells(spark):
    g = np.random.default_rng(1)
    z = g.uniform(0, 1, (3000, 2))                       # about 3,000 points in four cells
    eps, side = 1.0, CE.cell_side(1.0, 2)
    pts = spark.createDataFrame([(r.tolist(), 1) for r in z], "z array<double>, w long").cache()
    ask = [[1.6, 0.5], [-0.9, -0.2], [3.0, 3.0], [0.5, 0.5]]
    asked = spark.createDataFrame([(i, a) for i, a in enumerate(ask)], "group int, z array<double>").withColumn("cell", F.expr(CE.cell_of(2, side)))
    near = CE.near_cells(asked, CE.boxes(pts, 2, side), 2)
    asked = asked.join(near, "cell").select("group", "z", "near")
    true = [int((((z - a) ** 2).sum(1) <= eps * eps).sum()) for a in ask]
    whole = {r.group: r.n for r in CE.tally(asked, pts, 2, side, eps, 10 ** 9).collect()}
    assert [whole.get(i, 0) for i in range(4)] == true and true[2] == 0 and min(true[0], true[1]) > 0
    short = {r.group: r.n for r in CE.tally(asked, pts, 2, side, eps, 5).collect()}
    assert all(min(short.get(i, 0), 5) == min(t, 5) for i, t in enumerate(true))


def test_components_of_paths_stars_and_loops(spark):
    path = [(i, i + 1) for i in range(0, 64)]
    star = [(100, 100 + i) for i in range(1, 40)]
    edges = spark.createDataFrame(path + star + [(200, 201), (201, 200), (300, 300)], "a long, b long").repartition(5)
    got = {r.node: r.root for r in CE.components(edges).collect()}
    assert got == {**{i: 0 for i in range(65)}, **{100 + i: 100 for i in range(40)}, 200: 200, 201: 200}


def test_edges_of_the_contract(spark):
    empty, cols = table(spark, np.zeros((0, 2)))
    assert dbscan_clusters(empty, cols).count() == 0
    same, cols = table(spark, np.ones((7, 2)))            # no spread: one point of weight seven
    assert {r.cluster_id for r in dbscan_clusters(same, cols, 0.5, 5).collect()} == {0}
    assert {r.cluster_id for r in dbscan_clusters(same, cols, 0.5, 8).collect()} == {-1}
    with pytest.raises(Exception, match="NULL coordinate"):
        dbscan_clusters(same.withColumn("c0", F.lit(None).cast("double")), cols).count()


def test_cells_are_joined_by_shuffle(spark):
    """Tables of cells and points grow with the rows: none is sent whole through the driver, however small it looks."""
    x, eps, m = shapes("four axes, thin")
    df, cols = table(spark, x)
    d, side = len(cols), CE.cell_side(eps, len(cols))
    points = df.select(F.array(*cols).alias("z"), F.lit(1).cast("bigint").alias("w")).withColumn("cell", F.expr(CE.cell_of(d, side)))
    near = CE.near_cells(points, CE.boxes(points, d, side), d)
    for plan in (near, dbscan_flags(df, cols, eps, m), dbscan_clusters(df, cols, eps, m)):
        plan.collect()
        assert "BroadcastHashJoin" not in plan._jdf.queryExecution().executedPlan().toString()
