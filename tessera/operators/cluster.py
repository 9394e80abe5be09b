"""Clustering feature (K1, A5) and 2-D PCA projection data (K2)."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import numeric_columns
from .encode import apply_standard_scaler, fit_standard_scaler

# The reference's preferred clustering columns.
CLUSTER_COLUMNS = ("age", "education_num", "hours_per_week", "capital_gain")

#: Squared distances that a task holds at once.
HELD_DISTANCES = 1 << 18
#: A centre that moves no farther has come to rest (``tol`` of Spark's KMeans).
REST = 1e-4


@dataclass
class KMeansFit:
    """The centres of one restart and its training cost."""

    centers: np.ndarray
    cost: float
    rounds: int

    @property
    def summary(self) -> SimpleNamespace:
        return SimpleNamespace(trainingCost=self.cost, numIter=self.rounds)

    def clusterCenters(self) -> list[np.ndarray]:
        return list(self.centers)

    def nearest(self, columns: Sequence[str]):
        """Column expression over the coordinates: index of the nearest centre, the first of equals."""
        far = ", ".join("(" + " + ".join(f"(`{c}` - {float(v)!r}D) * (`{c}` - {float(v)!r}D)" for c, v in zip(columns, center)) + ")" for center in self.centers)
        return F.expr(f"cast(array_position(array({far}), least({far})) - 1 AS int)" if len(self.centers) > 1 else "0")


def _point_blocks(df: DataFrame, features_col: str):
    """The vectors as one array for each Arrow batch, persisted."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = batch.column(0).flatten().to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()), pa.array([batch.num_rows], pa.int32())], names=["x", "n"])

    packed = df.select(vector_to_array(features_col).alias("x")).mapInArrow(pack, "x binary, n int")
    return packed.rdd.map(lambda r: np.frombuffer(r["x"]).reshape(r["n"], -1)).persist(StorageLevel.MEMORY_AND_DISK)


def _nearest_sums(x: np.ndarray, centers: list[np.ndarray]) -> list[np.ndarray]:
    """For each set of centres a row per centre: sums of the coordinates of its points, their number, and (in the first row)
    the squared distances of all points. Products of matrices: a point and a centre cost a few operations."""
    ends = np.cumsum([len(c) for c in centers])
    every = np.concatenate(centers)
    middle = every.mean(axis=0)
    at = every - middle
    length = (at * at).sum(axis=1)[:, None]
    out, cost = np.zeros((len(at), x.shape[1] + 2)), np.zeros(len(centers))
    step = max(1, HELD_DISTANCES // len(at))
    for first in range(0, len(x), step):
        own = x[first:first + step]
        moved = np.ascontiguousarray((own - middle).T)
        part = length - 2.0 * (at @ moved)
        size = float((moved * moved).sum())
        chosen = np.empty_like(part)
        for r, end in enumerate(ends):
            far = part[end - len(centers[r]):end]
            best = far.min(axis=0)
            hit = far == best
            if np.count_nonzero(hit) != len(own):  # equally near centres: the first
                hit &= np.cumsum(hit, axis=0) == 1
            chosen[end - len(centers[r]):end] = hit
            cost[r] += best.sum() + size
        out[:, :-2] += chosen @ own
        out[:, -2] += chosen.sum(axis=1)
    found = np.split(out, ends[:-1])
    for sums, c in zip(found, cost):
        sums[0, -1] = max(c, 0.0)
    return found


def _sums(blocks, centers: list[np.ndarray]) -> list[np.ndarray]:
    """``_nearest_sums`` over all points, in one pass."""
    def add(a, b):
        return [x + y for x, y in zip(a, b)] if a and b else a or b

    return blocks.mapPartitions(lambda part: [reduce(add, (_nearest_sums(x, centers) for x in part), [])]).treeReduce(add)


def _lloyd(blocks, starts: list[np.ndarray], max_iter: int) -> list[KMeansFit]:
    """Lloyd's rounds of all restarts in the same passes; one that has come to rest takes no part in the next."""
    fits = [KMeansFit(c, 0.0, 0) for c in starts]
    moving = list(range(len(fits))) if max_iter else []
    while moving:
        centers = [fits[r].centers for r in moving]
        found, still = _sums(blocks, centers), []
        for r, old, s in zip(moving, centers, found):
            n = s[:, -2:-1]
            new = np.where(n > 0, s[:, :-2] / np.maximum(n, 1), old)  # a centre without points stays
            fits[r] = KMeansFit(new, float(s[:, -1].sum()), fits[r].rounds + 1)
            if ((new - old) ** 2).sum(axis=1).max() > REST * REST and fits[r].rounds < max_iter:
                still.append(r)
        moving = still
    return fits


def kmeans_best_of(df: DataFrame, features_col: str, k: int = 5, restarts: int = 10, seed: int = 42,
                   max_iter: int = 300, parallelism: int = 2) -> KMeansFit:
    """k-means with ``restarts`` seeds, keeping the lowest training cost (ties
    to the lower seed; Spark has no ``n_init``). Each seed starts from the centres of
    Spark's k-means||; then all restarts move in the same passes over one persisted copy
    of the points, so a round costs one scan, not one for each restart.
    The cost is that of the last round's assignment, as in Spark's summary."""
    from concurrent.futures import ThreadPoolExecutor
    x = df.select(features_col)

    def start(r):
        # by rows: the other solver looks at the sparsity of the whole table first
        m = KMeans(k=k, seed=seed + r, featuresCol=features_col, maxIter=0, initMode="k-means||", solver="row").fit(x)
        return np.array(m.clusterCenters())

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        starts = list(pool.map(start, range(restarts)))
    blocks = _point_blocks(x, features_col)
    fits = _lloyd(blocks, starts, max_iter)
    blocks.unpersist()
    return fits[min(range(restarts), key=lambda r: (fits[r].cost, r))]


def add_clustering_features(df: DataFrame, n_clusters: int = 5, id_col: str = "row_id", seed: int = 42,
                            restarts: int = 10, out_col: str = "cluster_feature",
                            exclude: Sequence[str] = ("label",)) -> DataFrame:
    """K1: scaled clustering columns (or all numeric), best-of-restarts
    k-means, cluster id added. Ids are relabelled by centre order (first
    coordinate, then the next...) so they do not depend on the seed."""
    cols = [c for c in CLUSTER_COLUMNS if c in df.columns] or numeric_columns(df, (id_col, *exclude))
    stats = fit_standard_scaler(df, cols)
    scaled = [f"{c}__km" for c in cols]
    z = apply_standard_scaler(df, stats, suffix="__km")
    model = kmeans_best_of(VectorAssembler(inputCols=scaled, outputCol="__kmv").transform(z), "__kmv", n_clusters, restarts, seed)
    model.centers = np.array(sorted(tuple(c) for c in model.centers))
    return z.withColumn(out_col, model.nearest(scaled)).drop(*scaled)


def cluster_distribution(df: DataFrame, col: str = "cluster_feature") -> DataFrame:
    """A5: rows per cluster."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))


def pca_2d(df: DataFrame, columns: Sequence[str], cluster_col: str | None = None, id_col: str = "row_id",
           sample_n: int | None = None, seed: int = 42) -> DataFrame:
    """K2: scale, centre, first two principal components, tagged by cluster.

    Spark's PCA does not centre on transform, so the scaled columns are
    centred first. Signs are fixed so the largest-magnitude loading of each
    component is positive. ``sample_n`` keeps a repeatable hashed sample
    (the reference plots at most 3000 rows); None projects every row.
    """
    from .ordinal import sample_rows
    stats = fit_standard_scaler(df, columns)
    z = apply_standard_scaler(df, stats, suffix="__p")
    z = VectorAssembler(inputCols=[f"{c}__p" for c in columns], outputCol="__pv").transform(z)
    model = PCA(k=2, inputCol="__pv", outputCol="__pc").fit(z)
    pc = model.pc.toArray()
    signs = [1.0 if pc[abs(pc[:, j]).argmax(), j] >= 0 else -1.0 for j in range(2)]
    out = model.transform(z)
    arr = vector_to_array("__pc")
    keep = [id_col] + ([cluster_col] if cluster_col else [])
    out = out.select(*keep, (arr[0] * signs[0]).alias("pc1"), (arr[1] * signs[1]).alias("pc2"))
    return sample_rows(out, sample_n, id_col, seed) if sample_n else out
