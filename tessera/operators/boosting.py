"""Histogram gradient boosting of many models in one pass (M6, M7, H1).

All candidates and folds of a search grow in step: a pass over the rows adds up, for every
model and every node under work, sums of gradient, hessian and rows by (feature, bin), and a
reducer per (model, block of nodes) returns only the best splits. Nothing else reaches the
driver, whose state is the trees. Features are binned once, from approximate quantiles. Growth
follows the preset: by depth (``depth``), best leaf first up to a number of leaves (``leaf``), or
one split for a whole level (``symmetric``); each has its own L2 term, column sample per tree
and row sample.

A table of up to ``TASK_CELLS`` binned values goes to as many tasks as there are cores, or models
if those are fewer; each grows its share of the models alone, over all rows, so that no pass is a
job. The trees are the same, but for the order in which sums are added up.

The rows of a larger table stay in Spark partitions, persisted as one block of arrays each; a pass is an RDD
job because it is imperative work on such blocks, a few thousand times over. The first pass of a
round adds the trees of the round before and keeps the margins, so each tree is applied to the
rows once; every ``STORE_ROUNDS`` rounds they go to a checkpoint in the shared folder, so that
a lost executor recomputes few rounds. With a patience the loss on the validation rows comes
with the first pass of a round, and a model whose loss has not fallen for that many rounds stops and keeps its best rounds.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

MAX_BINS = 32
STORE_ROUNDS = 10
#: Nodes whose histograms travel as one array; rows of one block.
NODE_BLOCK, BLOCK_ROWS = 32, 131_072
#: Blocks of a smaller table, none under ``LEAST_ROWS`` rows: a pass costs little more than a task for each block.
LEAST_BLOCKS, LEAST_ROWS = 12, 8_192
#: Binned values (rows by features, a byte each) that a task holds to grow a model alone.
TASK_CELLS = 1 << 24


@dataclass(frozen=True)
class Booster:
    """One model to train. ``fold``: the fold it leaves out (None: none)."""

    rounds: int
    rate: float
    growth: str = "depth"
    depth: int = 6
    leaves: int = 31
    l2: float = 0.0
    least_hessian: float = 1e-3
    least_rows: int = 1
    rows: float = 1.0
    columns: float = 1.0
    patience: int | None = None
    fold: int | None = None
    seed: int = 42


class Tree:
    """Nodes as lists; ``feature`` -1 marks a leaf. ``bin``: the last bin that goes left."""

    def __init__(self):
        self.feature, self.bin, self.left, self.right, self.value, self.rows = [], [], [], [], [], []

    def add(self, value: float, rows: float) -> int:
        for name, v in (("feature", -1), ("bin", 0), ("left", -1), ("right", -1), ("value", value), ("rows", rows)):
            getattr(self, name).append(v)
        return len(self.feature) - 1

    def split(self, node: int, feature: int, cut: int, left: tuple[float, float], right: tuple[float, float]) -> tuple[int, int]:
        self.feature[node], self.bin[node] = feature, cut
        self.left[node], self.right[node] = self.add(*left), self.add(*right)
        return self.left[node], self.right[node]

    def arrays(self) -> tuple[np.ndarray, ...]:
        return tuple(np.array(x) for x in (self.feature, self.bin, self.left, self.right, self.value))


def leaf_of(arrays: tuple[np.ndarray, ...], x: np.ndarray, at: np.ndarray | None = None) -> np.ndarray:
    """The leaf of each row; ``x`` holds bins, or values if the second array holds thresholds. ``at``: nodes to go on from, changed in place."""
    feature, cut, left, right, _ = arrays
    at = np.zeros(len(x), np.int64) if at is None else at
    live = np.flatnonzero(feature[at] >= 0)
    while len(live):
        n = at[live]
        at[live] = np.where(x[live, feature[n]] <= cut[n], left[n], right[n])
        live = live[feature[at[live]] >= 0]
    return at


def _uniform(ids: np.ndarray, seed: int) -> np.ndarray:
    """A number in [0, 1) by row id and seed: the same in every pass and on every executor."""
    x = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64((seed * 0xD1B54A32D192ED03) & (2 ** 64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) / 2.0 ** 53


def gradients(margin: np.ndarray, label: np.ndarray, task: str) -> tuple[np.ndarray, np.ndarray]:
    if task != "classification":
        return margin - label, np.ones_like(margin)
    p = 1 / (1 + np.exp(-margin))
    return p - label, p * (1 - p)


def _loss(margin: np.ndarray, label: np.ndarray, task: str) -> float:
    if task != "classification":
        return float(((margin - label) ** 2).sum())
    return float((np.maximum(margin, 0) - margin * label + np.log1p(np.exp(-np.abs(margin)))).sum())


def best_splits(hist: np.ndarray, b: Booster, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gains (nodes, features, bins) of splitting after each bin, and the left sums behind them. ``hist``: (..., 3)."""
    left = hist.cumsum(axis=2)
    total = left[:, :, -1:, :]
    right = total - left
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = sum(side * s[..., 0] ** 2 / (s[..., 1] + b.l2) for side, s in ((1, left), (1, right), (-1, total)))
    sound = (np.minimum(left[..., 1], right[..., 1]) >= b.least_hessian) & (np.minimum(left[..., 2], right[..., 2]) >= b.least_rows) & allowed[None, :, None]
    return np.where(sound, gain, -np.inf), left


def _value(sums, l2: float) -> float:
    return float(-sums[0] / (sums[1] + l2)) if sums[1] + l2 > 0 else 0.0


class _Grower:
    """One tree under work: which nodes need splits, and what to do with them."""

    def __init__(self, b: Booster, allowed: np.ndarray):
        self.b, self.allowed, self.tree, self.known, self.done = b, allowed, Tree(), {}, False
        self.tree.add(0.0, 0.0)
        self.open = [0]

    def take(self, found: dict[int, tuple]) -> None:
        """``found``: node -> (gain, feature, bin, left sums, total sums)."""
        b, t = self.b, self.tree
        if 0 in found and self.known == {}:
            t.value[0], t.rows[0] = _value(found[0][4], b.l2), float(found[0][4][2])
        if b.growth == "leaf":
            return self._leafwise(found)
        opened = []
        for node, (gain, feature, cut, left, total) in sorted(found.items()):
            if gain > 1e-12:
                right = total - left
                opened += t.split(node, feature, cut, (_value(left, b.l2), left[2]), (_value(right, b.l2), right[2]))
        self.known[len(self.known)] = True
        self.open = opened
        self.done = not opened or len(self.known) >= b.depth

    def _leafwise(self, found: dict[int, tuple]) -> None:
        """Best first over the nodes known so far. Where an unknown gain could matter, the best known leaves are split
        ahead of their turn and all unknown children asked for at once; in the end only splits in their turn stay."""
        self.known |= found
        t, b = self.tree, self.b
        leaves, inner = {0}, []
        while len(leaves) < b.leaves and all(k in self.known for k in leaves):
            best = max(leaves, key=lambda k: (self.known[k][0], -k))
            if not self.known[best][0] > 1e-12:
                break
            inner.append(best)
            leaves = leaves - {best} | set(self._children(best))
        if len(leaves) >= b.leaves or all(k in self.known for k in leaves):
            self.tree, self.done = _pruned(t, set(inner)), True
            return
        ahead = sorted((k for k in range(len(t.feature)) if t.feature[k] < 0 and k in self.known and self.known[k][0] > 1e-12), key=lambda k: -self.known[k][0])
        for k in ahead[:b.leaves]:
            self._children(k)
        self.open = [k for k in range(len(t.feature)) if t.feature[k] < 0 and k not in self.known]

    def _children(self, node: int) -> tuple[int, int]:
        t, b = self.tree, self.b
        if t.feature[node] < 0:
            _, feature, cut, left, total = self.known[node]
            right = total - left
            t.split(node, feature, cut, (_value(left, b.l2), float(left[2])), (_value(right, b.l2), float(right[2])))
        return t.left[node], t.right[node]


def _pruned(tree: Tree, inner: set[int]) -> Tree:
    """The tree that splits at the nodes ``inner`` alone."""
    out, todo = Tree(), [(0, 0)]
    out.add(tree.value[0], tree.rows[0])
    while todo:
        old, new = todo.pop()
        if old in inner:
            ends = tree.left[old], tree.right[old]
            todo += zip(ends, out.split(new, tree.feature[old], tree.bin[old], *((tree.value[k], tree.rows[k]) for k in ends)))
    return out


def bin_edges(df: DataFrame, features_col: str, bins: int = MAX_BINS) -> list[np.ndarray]:
    """Cut points by feature from approximate quantiles of ``df``; a value goes left of a cut it does not exceed."""
    x = df.select(vector_to_array(features_col).alias("x"))
    first = x.first()
    if first is None:
        return []
    probs = [k / bins for k in range(1, bins)]
    names = [f"f{k}" for k in range(len(first["x"]))]
    cuts = x.select(*[F.col("x")[k].alias(n) for k, n in enumerate(names)]).approxQuantile(names, probs, 0.25 / bins)
    return [np.unique(np.array(c, np.float64)) for c in cuts]


def _n_blocks(rows: int) -> int:
    return max(1, -(-rows // BLOCK_ROWS), min(LEAST_BLOCKS, -(-rows // LEAST_ROWS)))


def _blocks(df: DataFrame, edges: list[np.ndarray], features_col: str, label_col: str, partitions: int):
    rows = df.select(F.col(label_col).cast("double"), F.col("_fold").cast("int"), F.col("_val"), F.xxhash64("row_id"), vector_to_array(features_col)).repartition(partitions)

    def pack(rows):
        rows = list(zip(*rows)) or [[], [], [], [], []]
        x = np.array([list(v)[:len(edges)] for v in rows[4]], np.float64).reshape(len(rows[0]), len(edges))
        bins = np.zeros(x.shape, np.uint8, order="F")  # a pass reads it by feature
        for k, e in enumerate(edges):
            bins[:, k] = np.searchsorted(e, x[:, k], "left")
        yield {"y": np.array(rows[0], np.float64), "fold": np.array(rows[1], np.int64), "val": np.array(rows[2], bool), "id": np.array(rows[3], np.int64), "x": bins}
    return rows.rdd.mapPartitions(pack)


def fit_many(df: DataFrame, boosters: Sequence[Booster], task: str = "classification", features_col: str = "features_tree", label_col: str = "label",
             val: DataFrame | None = None, fold_col: str | None = None, bins: int = MAX_BINS, name: str = "booster") -> list["BoostedTrees"]:
    """Trains all ``boosters`` over ``df`` in one run of passes; ``fold_col`` numbers the folds that they leave out."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    sc = spark.sparkContext
    fold = F.col(fold_col) if fold_col else F.lit(-1)
    rows = df.withColumn("_fold", fold).withColumn("_val", F.lit(False)).select("row_id", label_col, features_col, "_fold", "_val")
    edges = bin_edges(df, features_col, bins)
    if val is not None:
        rows = rows.unionByName(val.withColumn("_fold", F.lit(-1)).withColumn("_val", F.lit(True)).select("row_id", label_col, features_col, "_fold", "_val"))
    total = rows.count()
    base = _blocks(rows, edges, features_col, label_col, _n_blocks(total)).persist(StorageLevel.MEMORY_AND_DISK)
    n_features, m = len(edges), len(boosters)
    use = [b.fold for b in boosters]

    def totals(blocks):
        for k in blocks:
            own = np.array([~k["val"] if f is None else ~k["val"] & (k["fold"] != f) for f in use], bool).reshape(m, -1)
            yield own.sum(axis=1), (own * k["y"]).sum(axis=1)
    parts = base.mapPartitions(totals).collect()
    n, positive = sum(p[0] for p in parts), sum(p[1] for p in parts)
    mean = np.where(n > 0, positive / np.maximum(n, 1), 0.5 if task == "classification" else 0.0)
    start = np.log(np.clip(mean, 1e-6, 1 - 1e-6) / np.clip(1 - mean, 1e-6, 1)) if task == "classification" else mean
    stopped = [n[j] == 0 or b.rounds == 0 or n_features == 0 for j, b in enumerate(boosters)]
    if total * n_features <= TASK_CELLS:
        models, losses = _grown_in_tasks(base, boosters, stopped, start, val is not None, task, n_features, bins)
    else:
        rows = _Spread(base, boosters, start, task, n_features, bins)
        models, losses = _grown(boosters, stopped, val is not None, n_features, rows)
        rows.close()
    base.unpersist()
    out = []
    for j, b in enumerate(boosters):
        keep = int(np.argmin(losses[j])) + 1 if losses[j] else len(models[j])
        out.append(BoostedTrees([to_thresholds(t, edges) for t in models[j][:keep]], float(start[j]), task, features_col, name, n_features, len(models[j])))
    return out


def _grown(boosters: Sequence[Booster], stopped: list[bool], judging: bool, n_features: int, rows) -> tuple[list[list[Tree]], list[list[float]]]:
    """Trees and validation losses of each model. ``rows`` finds the best splits of the nodes under work and adds finished trees to the margins."""
    stopped = list(stopped)
    models: list[list[Tree]] = [[] for _ in boosters]
    losses: list[list[float]] = [[] for _ in boosters]
    for r in range(max((b.rounds for b in boosters), default=0) + 1):
        live = [j for j, b in enumerate(boosters) if not stopped[j] and r < b.rounds]
        judged = [j for j, b in enumerate(boosters) if not stopped[j] and b.patience and judging and 0 < r <= b.rounds]
        if not live and not judged:
            break
        growers = {}
        for j in live:
            some = np.random.default_rng([boosters[j].seed, r])
            allowed = np.zeros(n_features, bool)
            allowed[some.permutation(n_features)[:max(1, round(boosters[j].columns * n_features))]] = True
            growers[j] = _Grower(boosters[j], allowed)
        first = True
        while first or any(not g.done for g in growers.values()):
            work = {j: (g.tree.arrays(), list(g.open), g.allowed) for j, g in growers.items() if not g.done}
            found = rows.best(work, judged if first else [], r)
            for j in judged if first else []:
                losses[j].append(found.pop(("loss", j)))
            if first:
                for j in judged:
                    if len(losses[j]) - 1 - int(np.argmin(losses[j])) >= boosters[j].patience:
                        stopped[j] = True
                        growers.pop(j, None)
            for j, g in growers.items():
                if not g.done:
                    g.take({k: found[j, k] for k in g.open if (j, k) in found})
            first = False
        grown = []
        for j, g in growers.items():
            b = boosters[j]
            g.tree.value = [v * b.rate for v in g.tree.value]
            models[j].append(g.tree)
            grown.append((j, g.tree.arrays()))
        rows.add(grown, r)
    return models, losses


class _Spread:
    """The rows of all models in Spark partitions: a pass is a job."""

    def __init__(self, base, boosters: Sequence[Booster], start: np.ndarray, task: str, n_features: int, bins: int):
        self.boosters, self.task, self.n_features, self.bins = boosters, task, n_features, bins
        self.state = base.map(lambda k: k | {"m": np.repeat(start[:, None], len(k["y"]), axis=1)}).persist(StorageLevel.MEMORY_AND_DISK)
        self.before = None  # the margins of the round before, until the first pass has made those of this one

    def best(self, work: dict, judged: list[int], r: int) -> dict:
        found = _pass(self.state, self.boosters, work, judged, r, self.task, self.n_features, self.bins)
        self._drop()
        return found

    def add(self, grown: list[tuple[int, tuple]], r: int) -> None:
        self.before, self.state = self.state, self.state.map(lambda k: k | {"m": _added(k, grown)}).persist(StorageLevel.MEMORY_AND_DISK)
        if (r + 1) % STORE_ROUNDS == 0:
            self.state.checkpoint()

    def _drop(self) -> None:
        if self.before is not None:
            self.before.unpersist()
            self.before = None

    def close(self) -> None:
        self._drop()
        self.state.unpersist()


class _Held:
    """The rows of one model in a task's memory, without those of the fold it leaves out. A row's node and gradients are kept between passes."""

    def __init__(self, blocks: list[dict], b: Booster, start: float, task: str, n_features: int, bins: int):
        self.b, self.task, self.n_features, self.bins, self.round = b, task, n_features, bins, -1
        self.train, self.val = [], []
        for k in blocks:
            own = ~k["val"] if b.fold is None else ~k["val"] & (k["fold"] != b.fold)
            for to, some in ((self.train, own), (self.val, k["val"])):
                if some.any():
                    to.append({"y": k["y"][some], "id": k["id"][some], "x": np.asfortranarray(k["x"][some]), "m": np.full(some.sum(), start)})

    def best(self, work: dict, judged: list[int], r: int) -> dict:
        found = {("loss", 0): sum(_loss(k["m"], k["y"], self.task) for k in self.val)} if judged else {}
        if not work:
            return found
        if r != self.round:
            self.round = r
            for k in self.train:
                k["g"], k["h"] = gradients(k["m"], k["y"], self.task)
                k["at"] = np.zeros(len(k["y"]), np.int64)
                k["in"] = _uniform(k["id"], self.b.seed * 1_000_003 + r) < self.b.rows if self.b.rows < 1 else True
        arrays, nodes, allowed = work[0]
        place = np.full(len(arrays[0]), -1)
        place[nodes] = np.arange(len(nodes))
        sums = np.zeros((len(nodes), self.n_features, self.bins, 3))
        for k in self.train:
            at = place[leaf_of(arrays, k["x"], k["at"])]
            own = np.flatnonzero((at >= 0) & k["in"])
            sums += _sums(at[own], k["x"], own, k["g"][own], k["h"][own], sums.shape[:3], allowed)
        split = [_best(((0, c), sums[c:c + NODE_BLOCK]), [self.b], work, self.bins) for c in range(0, len(nodes), NODE_BLOCK)]
        return found | _joined(split, [self.b], work, self.bins)

    def add(self, grown: list[tuple[int, tuple]], r: int) -> None:
        for _, arrays in grown:
            for k in self.train + self.val:
                k["m"] += arrays[4][leaf_of(arrays, k["x"])]


def _grown_in_tasks(base, boosters: Sequence[Booster], stopped: list[bool], start: np.ndarray, judging: bool, task: str, n_features: int, bins: int):
    """``_grown`` of each model by itself, in the task that has all blocks; the longest models are dealt first, each to the task with the least work."""
    tasks = min(len(boosters), base.context.defaultParallelism)
    share: list[list[int]] = [[] for _ in range(tasks)]
    load = [0] * tasks
    passes = [b.rounds * (6 if b.growth == "leaf" else b.depth) for b in boosters]
    for j in sorted(range(len(boosters)), key=lambda j: -passes[j]):
        t = load.index(min(load))
        share[t].append(j)
        load[t] += passes[j]

    def grow(pairs):
        held: dict[int, list] = {}
        for t, block in pairs:
            held.setdefault(t, []).append(block)
        for t, blocks in held.items():
            blocks = [k for _, k in sorted(blocks, key=lambda x: x[0])]
            for j in share[t]:
                b = boosters[j]
                yield j, [got[0] for got in _grown([b], [stopped[j]], judging, n_features, _Held(blocks, b, start[j], task, n_features, bins))]

    dealt = base.mapPartitionsWithIndex(lambda i, blocks: ((t, (i, k)) for k in blocks for t in range(tasks))).partitionBy(tasks, lambda t: t)
    found = dict(dealt.mapPartitions(grow).collect())
    return [found[j][0] for j in range(len(boosters))], [found[j][1] for j in range(len(boosters))]


def _added(block: dict, grown: list[tuple[int, tuple]]) -> np.ndarray:
    margins = block["m"].copy()
    for j, arrays in grown:
        margins[j] += arrays[4][leaf_of(arrays, block["x"])]
    return margins


def _sums(at: np.ndarray, bins: np.ndarray, rows: np.ndarray, g: np.ndarray, h: np.ndarray, shape: tuple[int, int, int], use: np.ndarray) -> np.ndarray:
    """(nodes, features, bins, 3): gradient, hessian and rows of ``rows``, which lie in the nodes ``at``. The first feature, which gives
    the totals of a node, and those in ``use`` are counted, the others stay 0."""
    out = np.zeros((*shape, 3))
    nodes, features, width = shape
    start = at * width
    for f in range(features):
        if f and not use[f]:
            continue
        cell = start + (bins[:, f] if len(rows) == len(bins) else bins[:, f][rows])
        for i, w in enumerate((g, h, None)):
            out[:, f, :, i] = np.bincount(cell, w, nodes * width).reshape(nodes, width)
    return out


def _pass(state, boosters, work: dict, judged: list[int], r: int, task: str, n_features: int, bins: int) -> dict:
    """Best splits of the nodes under work, and losses on the validation rows: one job."""
    def histograms(blocks):
        for k in blocks:
            margins = k["m"]
            for j in judged:
                yield (j, -1), _loss(margins[j][k["val"]], k["y"][k["val"]], task)
            for j, (arrays, nodes, allowed) in work.items():
                b = boosters[j]
                own = ~k["val"] if b.fold is None else ~k["val"] & (k["fold"] != b.fold)
                if b.rows < 1:
                    own = own & (_uniform(k["id"], b.seed * 1_000_003 + r) < b.rows)
                place = np.full(len(arrays[0]), -1)
                place[nodes] = np.arange(len(nodes))
                at = place[leaf_of(arrays, k["x"])]
                own = np.flatnonzero(own & (at >= 0))
                g, h = gradients(margins[j][own], k["y"][own], task)
                sums = _sums(at[own], k["x"], own, g, h, (len(nodes), n_features, bins), allowed)
                for block in range(0, len(nodes), NODE_BLOCK):
                    yield (j, block), sums[block:block + NODE_BLOCK]

    sums = state.mapPartitions(histograms)
    if state.getNumPartitions() > 1:
        sums = sums.reduceByKey(lambda a, b: a + b, min(state.getNumPartitions(), max(1, len(work))))
    return _joined(sums.map(lambda item: _best(item, boosters, work, bins)).collect(), boosters, work, bins)


def _best(item, boosters, work: dict, bins: int):
    """Best splits of a block of nodes from its sums; of a symmetric tree, the block's gains and left sums."""
    (j, block), hist = item
    if block < 0:
        return item
    b, (_, nodes, allowed) = boosters[j], work[j]
    gain, left = best_splits(hist, b, allowed)
    total = hist[:, 0].sum(axis=1)
    if b.growth == "symmetric":
        return (j, block), (np.where(np.isfinite(gain), gain, 0.0).sum(axis=0), left, total)
    flat = gain.reshape(len(gain), -1)
    top = flat.argmax(axis=1)
    return (j, block), [(nodes[block + i], (float(flat[i, c]), int(c // bins), int(c % bins), left[i].reshape(-1, 3)[c], total[i])) for i, c in enumerate(top.tolist())]


def _joined(items, boosters, work: dict, bins: int) -> dict:
    found, levels = {}, {}
    for (j, block), got in items:
        if block < 0:
            found["loss", j] = got
        elif boosters[j].growth == "symmetric":
            levels.setdefault(j, []).append((block, got))
        else:
            found |= {(j, node): split for node, split in got}
    for j, blocks in levels.items():  # one split for all nodes of the level: gains add up over its blocks
        gain = sum(g for _, (g, _, _) in blocks)
        c = int(gain.argmax())
        for block, (_, left, total) in blocks:
            for i in range(len(total)):
                found[j, work[j][1][block + i]] = (float(gain.flat[c]), c // bins, c % bins, left[i].reshape(-1, 3)[c], total[i])
    return found


def to_thresholds(tree: Tree, edges: list[np.ndarray]) -> list[tuple]:
    """A node table as ``trees.extract_nodes`` gives it: (id, feature, threshold, left, right, value, rows, value)."""
    out = []
    for k, f in enumerate(tree.feature):
        inner = f >= 0
        cut = float(edges[f][tree.bin[k]]) if inner and tree.bin[k] < len(edges[f]) else (float("inf") if inner else 0.0)
        out.append((k, int(f), cut, int(tree.left[k]), int(tree.right[k]), float(tree.value[k]), float(tree.rows[k]), float(tree.value[k])))
    return out


class BoostedTrees:
    """A fitted booster: node tables whose values add up to the margin over ``base``."""

    def __init__(self, tables: list, base: float, task: str, features_col: str, name: str, n_features: int, trained: int):
        self.tables, self.base, self.task, self.featuresCol, self.name = tables, base, task, features_col, name
        self.n_features, self.trained_rounds = n_features, trained

    @property
    def getNumTrees(self) -> int:
        return len(self.tables)

    def named(self, name: str) -> "BoostedTrees":
        return BoostedTrees(self.tables, self.base, self.task, self.featuresCol, name, self.n_features, self.trained_rounds)

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for arrays in self._arrays():
            out += arrays[4][leaf_of(arrays, x)]
        return out

    def _arrays(self):
        return [tuple(np.array([n[k] for n in t], np.float64 if k in (2, 5) else np.int64) for k in (1, 2, 3, 4, 5)) for t in self.tables]

    def feature_importances(self, n: int) -> list[float]:
        """Share of the rows that each feature splits, over all trees."""
        total = np.zeros(n)
        for t in self.tables:
            for node in t:
                if node[1] >= 0:
                    total[node[1]] += node[6]
        return (total / total.sum() if total.sum() else total).tolist()

    def transform(self, df: DataFrame) -> DataFrame:
        arrays, base = self._arrays(), self.base

        @F.pandas_udf("double")
        def margin(x: pd.Series) -> pd.Series:
            if not len(x):
                return pd.Series([], dtype="float64")
            v, out = np.vstack(x.to_numpy()), np.full(len(x), base)
            for a in arrays:
                out += a[4][leaf_of(a, v)]
            return pd.Series(out)

        m = margin(vector_to_array(self.featuresCol))
        if self.task != "classification":
            return df.withColumn(f"pred_{self.name}", m)
        out = df.withColumn("_margin", m)
        p = 1 / (1 + F.exp(-F.col("_margin")))
        return out.withColumns({f"raw_{self.name}": array_to_vector(F.array(-F.col("_margin"), F.col("_margin"))),
                                f"prob_{self.name}": array_to_vector(F.array(1 - p, p)),
                                f"pred_{self.name}": (F.col("_margin") > 0).cast("double")}).drop("_margin")
