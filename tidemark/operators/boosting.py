"""Gradient boosting that goes on: one leaf-wise tree a round on kept residuals.

Rows are binned once (bytes, at most ``max_bins`` bins a feature) and stored in
blocks with their target, hold-out flag and score.  A round grows one tree:

* a pass over the blocks gives, for some leaves, the sums of residuals and the
  row counts per (feature, bin); tasks send one partial sum each, which is added
  up in a tree of reducers, so the driver gets one histogram a leaf (its size
  depends on features and bins, never on rows);
* of two sibling leaves only the smaller one is summed, the other is the parent
  less the sibling;
* growth is best first: the leaf with the largest gain is split next, up to
  ``num_leaves``.  All leaves that may still be chosen are summed in one pass,
  so a tree takes about as many passes as it is deep.

Where one task has all blocks there is nothing to add up, and it grows the
trees of several rounds itself, by the same functions.

Every pass also measures the hold-out error of the trees so far.  Boosting
stops when ``patience`` rounds have not beaten the best one; no tree is ever
fitted twice, and all draws depend on (seed, round) alone, so boosting that is
taken up again gives the trees of one long run.  Scores are folded into the
blocks every ``fold`` rounds and written to the shared folder, which bounds
both the work of a pass and the lineage.

The result is MLlib's own boosted-tree model, so saving, loading, scoring and
importances need no Python.
"""

from __future__ import annotations

import pickle
import uuid
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import fs_delete, map_arrow, scratch_dir

BLOCK_ROWS = 1 << 16
#: Partial sums that one reducer adds up.
FAN_IN = 64
_BLOCK = "part int, seq int, n int, x binary, y binary, held binary, score binary"


@dataclass
class Tree:
    """Nodes by number; a leaf has feature -1.  Rows whose bin is at most ``bin`` go left."""

    feature: list[int] = field(default_factory=lambda: [-1])
    bin: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [0])
    right: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])
    gain: list[float] = field(default_factory=lambda: [0.0])
    rows: list[int] = field(default_factory=lambda: [0])

    def split(self, node: int, feature: int, cut: int, gain: float) -> tuple[int, int]:
        self.feature[node], self.bin[node], self.gain[node] = feature, cut, gain
        for side in (self.left, self.right):
            for a, v in ((self.feature, -1), (self.bin, 0), (self.left, 0), (self.right, 0), (self.value, 0.0), (self.gain, 0.0), (self.rows, 0)):
                a.append(v)
            side[node] = len(self.feature) - 1
        return self.left[node], self.right[node]

    def arrays(self) -> tuple:
        return tuple(np.array(a) for a in (self.feature, self.bin, self.left, self.right, self.value))


@dataclass(frozen=True)
class GrowParams:
    num_leaves: int = 31
    min_rows: int = 20
    step: float = 0.1
    feature_fraction: float = 0.8
    bagging_fraction: float = 0.8
    bagging_every: int = 5
    max_depth: int = 0  # 0: no limit
    max_bins: int = 64
    seed: int = 42
    fold: int = 10


def leaf_of(x: np.ndarray, tree: tuple) -> np.ndarray:
    """The node at which each row (column of ``x``) ends."""
    feature, cut, left, right = tree[:4]
    at = np.zeros(x.shape[1], np.int32)
    rows = np.arange(x.shape[1])
    while len(rows):
        node = at[rows]
        f = feature[node]
        rows, node, f = rows[f >= 0], node[f >= 0], f[f >= 0]
        at[rows] = np.where(x[f, rows] <= cut[node], left[node], right[node])
    return at


def bagged(n: int, part: int, seq: int, rnd: int, p: GrowParams) -> np.ndarray:
    """The rows of a block that a round's tree is grown on."""
    if p.bagging_fraction >= 1:
        return np.ones(n, bool)
    return np.random.default_rng((p.seed, rnd // p.bagging_every, part, seq)).random(n) < p.bagging_fraction


def chosen_features(n: int, rnd: int, p: GrowParams) -> np.ndarray:
    """The features that a round's tree may use."""
    return np.sort(np.random.default_rng((p.seed, 1 << 20, rnd)).permutation(n)[: max(1, round(p.feature_fraction * n))])


def cut_points(df: DataFrame, columns: list[str], max_bins: int) -> list[np.ndarray]:
    """Ascending cuts per column: its values where there are at most ``max_bins``, else approximate quantiles."""
    # one binary buffer a column; approx_count_distinct would put over a thousand columns each into the plan
    counts = df.agg(*[F.hll_sketch_estimate(F.hll_sketch_agg(F.col(c).cast("string"), 12)).alias(c) for c in columns]).first()
    few = [c for c in columns if (counts[c] or 0) <= max_bins]
    sets = df.agg(*[F.sort_array(F.collect_set(c)).alias(c) for c in few]).first() if few else {}  # max_bins values each
    many = [c for c in columns if c not in few]
    quantiles = dict(zip(many, df.approxQuantile(many, [i / max_bins for i in range(1, max_bins)], 0.001))) if many else {}
    return [np.unique(np.array(sets[c][:-1] if c in few else quantiles[c], float)) for c in columns]


def binned(df: DataFrame, columns: list[str], target: str, held: str, cuts: list[np.ndarray], rows: int) -> DataFrame:
    """Blocks of binned rows; bin b holds values in ``(cuts[b-1], cuts[b]]``, NaN the last one."""
    slim = df.select(*[F.col(c).cast("double") for c in columns], F.col(target).cast("double").alias("__y"), F.col(held).cast("boolean").alias("__h"))

    def build(batches):
        part, seq, kept, size = TaskContext.get().partitionId(), 0, [], 0
        for b in batches:
            cols = [c.to_numpy(zero_copy_only=False) for c in b.columns]
            x = np.stack([np.searchsorted(cut, c, "left") for cut, c in zip(cuts, cols)]).astype(np.uint8)
            kept.append((x, cols[-2].astype(float), cols[-1].astype(bool)))
            size += b.num_rows
            if size >= BLOCK_ROWS:
                yield block(part, seq, kept)
                seq, kept, size = seq + 1, [], 0
        if size:
            yield block(part, seq, kept)

    def block(part, seq, kept):
        x = np.concatenate([k[0] for k in kept], axis=1)
        y, h = (np.concatenate([k[i] for k in kept]) for i in (1, 2))
        return pa.RecordBatch.from_pylist([{"part": part, "seq": seq, "n": len(y), "x": x.tobytes(), "y": y.tobytes(), "held": h.tobytes(), "score": np.zeros(len(y)).tobytes()}],
                                          schema=pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("n", pa.int32())] + [(c, pa.binary()) for c in ("x", "y", "held", "score")]))

    return map_arrow(slim.repartition(max(1, -(-rows // (4 * BLOCK_ROWS)))), build, _BLOCK)


def _arrays(row: dict, n_features: int):
    return (np.frombuffer(row["x"], np.uint8).reshape(n_features, row["n"]), np.frombuffer(row["y"]), np.frombuffer(row["held"], bool), np.frombuffer(row["score"]))


def sums_of(x, rest, held, place, tree: Tree, wanted: list[int], features: np.ndarray, rnd: int, p: GrowParams) -> np.ndarray:
    """``(2, leaf, feature, bin)``: sums of residuals and rows of one block's drawn training rows in the wanted leaves."""
    out = np.zeros((2, len(wanted), len(features), p.max_bins))
    if not wanted:
        return out
    slot = np.full(len(tree.feature), -1)
    slot[wanted] = np.arange(len(wanted))
    mine = slot[leaf_of(x, tree.arrays())]
    rows = np.flatnonzero((mine >= 0) & ~held & bagged(len(rest), *place, rnd, p))
    at, g, size = mine[rows] * p.max_bins, rest[rows], len(wanted) * p.max_bins
    for j, c in enumerate(features):
        key = at + x[c, rows]
        out[0, :, j] = np.bincount(key, g, size).reshape(-1, p.max_bins)
        out[1, :, j] = np.bincount(key, minlength=size).reshape(-1, p.max_bins)
    return out


def decided(errors: list[float], patience: int | None) -> bool:
    """Whether ``patience`` rounds have not beaten the best one."""
    measured = [(e, i) for i, e in enumerate(errors) if e == e]
    return bool(patience and measured) and len(errors) - 1 - min(measured)[1] >= patience


class Grower:
    """Best-first growth of one tree; ``sums(tree, leaves)`` gives the leaves' histograms."""

    def __init__(self, sums, params: GrowParams, features: np.ndarray, cuts: np.ndarray):
        self.sums, self.params, self.features, self.cuts = sums, params, features, cuts

    def tree(self, root: np.ndarray) -> Tree:
        """The tree from its root's histogram on."""
        full, known, depth = Tree(), {0: self.best(root)}, {0: 0}  # full: every split that was looked at; known: its histogram and best split
        full.rows[0] = int(root[1, 0].sum())
        while True:
            order, missing = self._best_first(full, known)
            if not missing:
                return self._taken(full, order, known)
            small = {}
            for n in missing:
                _, gain, c, cut, left = known[n]
                a, b = full.split(n, int(self.features[c]), cut, gain)
                depth[a] = depth[b] = depth[n] + 1
                full.rows[a], full.rows[b] = left, full.rows[n] - left
                small[n] = (a, b) if left <= full.rows[n] - left else (b, a)
            hist = self.sums(full, [small[n][0] for n in missing])
            for i, n in enumerate(missing):
                less, more = small[n]
                for child, h in ((less, hist[:, i]), (more, known[n][0] - hist[:, i])):
                    found = self.best(h)
                    deepest = self.params.max_depth and depth[child] >= self.params.max_depth
                    known[child] = (h, 0.0, *found[2:]) if deepest else found
                known[n] = (None, *known[n][1:])  # its histogram isn't needed again

    def best(self, hist: np.ndarray) -> tuple:
        """``(histogram, gain, feature, cut, rows on the left)`` of the best split (gain 0: none)."""
        g, n = np.cumsum(hist[0], axis=1), np.cumsum(hist[1], axis=1)
        all_g, all_n = g[0, -1], n[0, -1]
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = g**2 / n + (all_g - g) ** 2 / (all_n - n) - all_g**2 / all_n
        ok = (n >= self.params.min_rows) & (all_n - n >= self.params.min_rows) & (np.arange(g.shape[1])[None, :] < self.cuts[:, None])
        gain = np.where(ok, gain, 0.0)
        at = int(np.argmax(gain))
        c, cut = divmod(at, g.shape[1])
        best = float(gain[c, cut])
        return (hist, best if best > 1e-9 else 0.0, c, cut, int(n[c, cut]))

    def _best_first(self, full: Tree, known: dict) -> tuple[list[int], list[int]]:
        """The nodes that best-first growth splits, as far as known, and the leaves it may need looked into."""
        import heapq

        heap, order = [(-known[0][1], 0)], []
        while heap and len(order) < self.params.num_leaves - 1:
            gain, node = heapq.heappop(heap)
            if gain == 0:
                return order, []
            if full.feature[node] < 0:  # not looked into yet: nor are, perhaps, others that may follow
                left = self.params.num_leaves - 1 - len(order)
                others = sorted([(gain, node), *heap])[:left]
                return order, [n for g, n in others if g < 0 and full.feature[n] < 0]
            order.append(node)
            for child in (full.left[node], full.right[node]):
                heapq.heappush(heap, (-known[child][1], child))
        return order, []

    def _taken(self, full: Tree, order: list[int], known: dict) -> Tree:
        """The tree of the chosen splits; a leaf's value is its mean residual."""
        tree, number = Tree(), {0: 0}
        tree.rows[0] = full.rows[0]
        means = {n: self._mean(known[n][0]) for n in known if known[n][0] is not None}
        for n in order:
            a, b = tree.split(number[n], full.feature[n], full.bin[n], full.gain[n])
            for new, old in ((a, full.left[n]), (b, full.right[n])):
                number[old], tree.rows[new] = new, full.rows[old]
        for old, new in number.items():
            if tree.feature[new] < 0:
                tree.value[new] = means[old] if old in means else self._below(full, known, old)
        return tree

    @staticmethod
    def _mean(hist: np.ndarray) -> float:
        n = hist[1, 0].sum()
        return float(hist[0, 0].sum() / n) if n else 0.0

    def _below(self, full: Tree, known: dict, node: int) -> float:
        """The mean residual of a node that was looked into but not split: from its children."""
        sums = np.zeros(2)
        stack = [node]
        while stack:
            n = stack.pop()
            if known[n][0] is not None:
                sums += (known[n][0][0, 0].sum(), known[n][0][1, 0].sum())
            else:
                stack += [full.left[n], full.right[n]]
        return float(sums[0] / sums[1]) if sums[1] else 0.0


class Boosting:
    """The state of a run: trees, hold-out errors and the blocks with their scores."""

    def __init__(self, df: DataFrame, columns: list[str], target: str, held: str, params: GrowParams = GrowParams(), trees: list[Tree] | None = None):
        """``df``: one row an example; ``held`` marks the hold-out.  ``trees``: those of an earlier run, to go on with."""
        self.spark, self.params, self.columns = df.sparkSession, params, list(columns)
        train = df.where(~F.col(held))
        one = train.agg(F.count("*").alias("n"), F.avg(F.col(target).cast("double")).alias("mean")).first()
        if not one.n:
            raise ValueError("no rows to train on")
        self.base = one.mean
        self.cuts = cut_points(train, self.columns, params.max_bins)
        self.trees: list[Tree] = list(trees or [])
        self.errors: list[float] = []  # by number of trees - 1; NaN where it wasn't measured
        self._path, self.folded, self.blocks = None, 0, None
        self._store(binned(df, self.columns, target, held, self.cuts, df.count()))

    # -- state
    def _store(self, blocks: DataFrame) -> None:
        """Write the blocks and read them back; the folder that they replace goes."""
        old, path = self._path, scratch_dir(self.spark, "boosting")
        blocks.write.mode("overwrite").parquet(path)
        if self.blocks is not None:
            self.blocks.unpersist()
        self.blocks = self.spark.read.schema(_BLOCK).parquet(path).persist()
        self.tasks, self._path = self.blocks.rdd.getNumPartitions(), path
        if old:
            fs_delete(self.spark, old)

    def _fold(self) -> None:
        f, new, p, base = len(self.columns), [t.arrays() for t in self.trees[self.folded:]], self.params, self.base if not self.folded else 0.0

        def add(batches):
            for b in batches:
                rows = b.to_pylist()
                for r in rows:
                    x, _, _, score = _arrays(r, f)
                    r["score"] = (score + base + sum(p.step * t[4][leaf_of(x, t)] for t in new)).tobytes()
                yield pa.RecordBatch.from_pylist(rows, schema=b.schema)

        self._store(map_arrow(self.blocks, add, _BLOCK))
        self.folded = len(self.trees)

    def close(self) -> None:
        self.blocks.unpersist()
        fs_delete(self.spark, self._path)

    # -- passes
    def _pass(self, tree: Tree, wanted: list[int], features: np.ndarray, rnd: int) -> tuple[np.ndarray, np.ndarray]:
        """``(histograms, errors)`` of the wanted leaves: sums and counts (leaf, feature, bin); hold-out squared error and rows."""
        f, bins, p = len(self.columns), self.params.max_bins, self.params
        new, base = [t.arrays() for t in self.trees[self.folded:]], self.base if not self.folded else 0.0
        shape = (2, len(wanted), len(features), bins)

        def measure(batches):
            total, errors = np.zeros(shape), np.zeros(2)
            for b in batches:
                for r in b.to_pylist():
                    x, y, held, score = _arrays(r, f)
                    rest = y - score - base
                    for t in new:
                        rest = rest - p.step * t[4][leaf_of(x, t)]
                    errors += (float(np.square(rest[held]).sum()), held.sum())
                    total += sums_of(x, rest, held, (r["part"], r["seq"]), tree, wanted, features, rnd, p)
            yield pa.RecordBatch.from_arrays([pa.array([np.concatenate([total.ravel(), errors]).tobytes()], pa.binary())], ["sums"])

        def add(batches):
            total = None
            for b in batches:
                for v in b.column(0).to_pylist():
                    v = np.frombuffer(v)
                    total = v if total is None else total + v
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

        out, tasks = map_arrow(self.blocks, measure, "sums binary"), self.tasks
        while tasks > FAN_IN:
            tasks = -(-tasks // FAN_IN)
            out = map_arrow(out.repartition(tasks), add, "sums binary")
        total = sum(np.frombuffer(bytes(r.sums)) for r in out.collect())
        return total[:-2].reshape(shape), total[-2:]

    def _note(self, errors: np.ndarray) -> None:
        while len(self.errors) < len(self.trees):
            self.errors.append(float("nan"))
        if self.trees:
            self.errors[len(self.trees) - 1] = float(errors[0] / errors[1]) if errors[1] else float("nan")

    # -- growing
    def grow(self, patience: int | None = None) -> bool:
        """Note the hold-out error of the trees so far and, unless that decides the run, add one tree."""
        rnd = len(self.trees)
        if rnd - self.folded >= self.params.fold:
            self._fold()
        features = chosen_features(len(self.columns), rnd, self.params)
        root, errors = self._pass(Tree(), [0], features, rnd)
        self._note(errors)
        if decided(self.errors, patience):
            return False
        cuts = np.array([len(self.cuts[c]) for c in features])
        grower = Grower(lambda tree, leaves: self._pass(tree, leaves, features, rnd)[0], self.params, features, cuts)
        self.trees.append(grower.tree(root[:, 0]))
        return True

    def _grow_in_task(self, rounds: int, patience: int | None) -> bool:
        """As ``rounds`` calls of ``grow``, in the one task that has all blocks (``BLOCK_ROWS * 4`` rows at most)."""
        if len(self.trees) - self.folded >= self.params.fold:
            self._fold()
        f, p, n_cuts, first = len(self.columns), self.params, np.array([len(c) for c in self.cuts]), len(self.trees)
        new, base, known = [t.arrays() for t in self.trees[self.folded:]], self.base if not self.folded else 0.0, list(self.errors)

        def grow(batches):
            blocks = []
            for b in batches:
                for r in b.to_pylist():
                    x, y, held, score = _arrays(r, f)
                    blocks.append([x, y - score - base - sum(p.step * t[4][leaf_of(x, t)] for t in new), held, (r["part"], r["seq"])])
            errors, trees = list(known), []
            for rnd in range(first, first + rounds):
                sse, n = (sum(v) for v in zip(*((float(np.square(rest[held]).sum()), int(held.sum())) for _, rest, held, _ in blocks)))
                if rnd:
                    errors[rnd - 1:] = [sse / n if n else float("nan")]
                if decided(errors, patience):
                    break
                features = chosen_features(f, rnd, p)
                sums = lambda tree, leaves: sum(sums_of(x, rest, held, at, tree, leaves, features, rnd, p) for x, rest, held, at in blocks)  # noqa: B023, E731
                tree = Grower(sums, p, features, n_cuts[features]).tree(sums(Tree(), [0])[:, 0])
                trees.append(tree)
                for b in blocks:
                    b[1] = b[1] - p.step * np.array(tree.value)[leaf_of(b[0], tree.arrays())]
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps((errors, [vars(t) for t in trees]))], pa.binary())], ["found"])

        errors, trees = pickle.loads(map_arrow(self.blocks, grow, "found binary").first().found)
        self.trees += [Tree(**t) for t in trees]
        self.errors = errors
        return len(trees) == rounds

    def best(self) -> int:
        """Rounds of the best measured prefix (all rounds where there is no hold-out)."""
        measured = [(e, i + 1) for i, e in enumerate(self.errors) if e == e]
        return min(measured)[1] if measured else len(self.trees)

    def run(self, max_rounds: int, patience: int | None = None) -> int:
        """Add trees up to ``max_rounds`` in all; with ``patience``, until so many rounds haven't beaten the best.  Returns the best rounds."""
        going = True
        while going and len(self.trees) < max_rounds:
            if self.tasks == 1:  # no sums to exchange
                going = self._grow_in_task(min(self.params.fold, max_rounds - len(self.trees)), patience)
            else:
                going = self.grow(patience)
        if going and self.trees:
            self._note(self._pass(Tree(), [], np.zeros(0, int), 0)[1])
        return self.best() if patience else len(self.trees)

    # -- result
    def model(self, rounds: int | None = None, features_col: str = "features", prediction_col: str = "prediction") -> GBTRegressionModel:
        """The first ``rounds`` trees as MLlib's model: the mean is in the first tree, which has weight 1."""
        sc = self.spark.sparkContext
        jvm, gateway = sc._jvm, sc._gateway
        trees = self.trees[: rounds if rounds is not None else len(self.trees)] or [Tree()]
        ml = jvm.org.apache.spark.ml
        built = gateway.new_array(ml.regression.DecisionTreeRegressionModel, len(trees))
        weights = gateway.new_array(jvm.double, len(trees))

        def node(t: Tree, n: int, scale: float, add: float):
            stats = gateway.new_array(jvm.double, 3)
            stats[0] = float(t.rows[n])
            calc = jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator(stats, t.rows[n])
            value = float(add + scale * t.value[n])
            if t.feature[n] < 0:
                return ml.tree.LeafNode(value, 0.0, calc)
            split = ml.tree.ContinuousSplit(t.feature[n], float(self.cuts[t.feature[n]][t.bin[n]]))
            gain = t.gain[n] / max(1, t.rows[n])  # MLlib keeps gains a row
            return ml.tree.InternalNode(value, 0.0, float(gain), node(t, t.left[n], scale, add), node(t, t.right[n], scale, add), split, calc)

        for i, t in enumerate(trees):
            root = node(t, 0, self.params.step, self.base) if i == 0 else node(t, 0, 1.0, 0.0)
            built[i] = ml.regression.DecisionTreeRegressionModel(f"dtr_{uuid.uuid4().hex[:12]}", root, len(self.columns))
            weights[i] = 1.0 if i == 0 else self.params.step
        out = GBTRegressionModel(ml.regression.GBTRegressionModel(f"GBTRegressor_{uuid.uuid4().hex[:12]}", built, weights, len(self.columns)))
        return out.setFeaturesCol(features_col).setPredictionCol(prediction_col)

    def split_gains(self) -> DataFrame:
        """The first tree's root, feature by feature: best cut, rows on its left and gain (all training rows that its bag has)."""
        features = np.arange(len(self.columns))
        hist = self._pass(Tree(), [0], features, len(self.trees))[0][:, 0]
        rows = []
        for c, name in enumerate(self.columns):
            _, gain, _, cut, left = Grower(None, self.params, features[c:c + 1], np.array([len(self.cuts[c])])).best(hist[:, c:c + 1])
            rows.append((name, float(self.cuts[c][cut]) if gain else None, left if gain else None, gain))
        return self.spark.createDataFrame(rows, "feature string, cut double, rows_left long, gain double")
