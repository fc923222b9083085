"""Regularised gradient boosting for squared error over histograms of binned features.

Every feature is cut once at exact quantiles of the training rows, and rows become a compact table of
blocks (a byte a feature).  A level of a tree is one aggregate: gradients and row counts by node,
feature and bin, summed in the tasks and then across them; only that table, whose size is set by depth,
features and bins, reaches the driver.  A split is chosen by second-order gain with an L2 penalty on
leaf weights; missing values go to the side that gains more; each tree draws rows and features.

Gradients are summed as whole numbers, so a result does not depend on the order of the rows.  Tasks
remember the predictions of their blocks from round to round, and a task that does not have them (a
lost executor, another worker) works them out from the trees so far.
"""

from __future__ import annotations

import uuid
from collections import OrderedDict
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, Broadcast, StorageLevel, TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tripmeter.models.coding import MISSING, Codes, Coding, combinations, completed, halves, propose, united
from tripmeter.operators.quantiles import exact_quantiles
from tripmeter.session import scratch_path

BLOCK_ROWS = 1 << 17
#: Tasks whose histograms are added at the driver at once; more are added up in tasks first.
DIRECT_TASKS = 8
#: Rounds after which the trees so far are sent anew; in between a task is sent the later ones.
RESEND = 10
#: Blocks whose predictions a worker remembers.
REMEMBERED = 64
_remembered: OrderedDict[tuple, tuple[int, np.ndarray]] = OrderedDict()
#: Where the rows of these blocks are: number of the tree, level, place in the level.
_places: OrderedDict[tuple, tuple[int, int, np.ndarray]] = OrderedDict()


@dataclass
class Tree:
    """Nodes in level order (children of i are 2i+1, 2i+2); ``feature`` is -1 at leaves, ``cut`` a bin, ``threshold`` its edge."""

    feature: np.ndarray
    cut: np.ndarray
    missing_left: np.ndarray
    weight: np.ndarray
    gain: np.ndarray
    threshold: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> Tree:
        n = (1 << (depth + 1)) - 1
        return cls(np.full(n, -1), np.zeros(n, int), np.zeros(n, bool), np.zeros(n), np.zeros(n), np.full(n, np.nan))

    def nodes_of(self, rows: np.ndarray | Codes, levels: int, bins: bool = True) -> np.ndarray:
        """The node of each row after ``levels`` splits; rows hold codes, bins or plain values."""
        if isinstance(rows, Codes):
            return rows.nodes_of(self, levels)
        at = np.zeros(len(rows), np.int64)
        every = np.arange(len(rows))
        for _ in range(levels):
            feature = self.feature[at]
            inner = feature >= 0
            value = rows[every, np.maximum(feature, 0)]
            absent = value == MISSING if bins else np.isnan(value)
            left = np.where(absent, self.missing_left[at], value <= (self.cut[at] if bins else self.threshold[at]))
            at = np.where(inner, 2 * at + 2 - left, at)
        return at

    def above(self, level: int) -> Tree:
        """The nodes above a level: what a task needs to lead rows to it."""
        n = (1 << level) - 1
        return Tree(self.feature[:n], self.cut[:n], self.missing_left[:n], self.weight[:n], self.gain[:n], self.threshold[:n])

    @property
    def depth(self) -> int:
        return (len(self.feature) + 1).bit_length() - 2


@dataclass(frozen=True)
class Boosting:
    """Settings; without penalty, row and feature shares it is plain gradient boosting."""

    rounds: int = 100
    depth: int = 3
    learning_rate: float = 0.1
    l2: float = 0.0
    least_rows: float = 1.0
    row_share: float = 1.0
    feature_share: float = 1.0
    bins: int = 64
    seed: int = 42
    features: str = "features"
    target: str = "ATD"
    key: str = "trip_key"

    def fit(self, rows: DataFrame, path: str | None = None, made: Binned | None = None) -> Boosted:
        """A model of all ``rows`` (feature vector, target, key), or of ``made`` from them; ``path`` is a new folder that all executors share."""
        own = made or binned_rows(rows, self.features, self.target, self.key, self.bins, path)
        if not own.n:
            return Boosted(0.0, [], self.features)
        if own.alone:
            # All rows are one block, so every level would be a job of one task: one task does all rounds.
            base, scale, edges = own.base, own.scale, own.edges
            trees = own.blocks.mapPartitions(lambda found: [self._rounds_of(list(found), base, scale, edges)]).first()
        else:
            trees = self._rounds(own)
        if not made:
            own.release()
        return Boosted(own.base, trees, self.features)

    def _columns(self, number: int, width: int) -> np.ndarray:
        """The features that a tree draws."""
        drawn = np.random.default_rng([self.seed, number]).permutation(width)
        return np.sort(drawn[: max(1, round(self.feature_share * width))])

    def _rounds_of(self, blocks: list[tuple], base: float, scale: float, edges: list[np.ndarray]) -> list[Tree]:
        """All rounds over the blocks of one task."""
        coding = Coding.of_blocks([rows for rows, _, _ in blocks], edges)
        codes = [Codes(coding, coding.encode(rows)) for rows, _, _ in blocks]
        trees: list[Tree] = []
        sums = [np.full(len(rows), base) for rows, _, _ in blocks]
        for number in range(self.rounds):
            wholes = [np.rint((s - y) * scale) for s, (_, y, _) in zip(sums, blocks, strict=True)]
            places: list[np.ndarray] = []

            def table(tree: Tree, level: int, wanted: np.ndarray, number=number, wholes=wholes, places=places) -> np.ndarray:
                rank, out = ranks(wanted, level), 0
                for i, (c, (_, _, keys)) in enumerate(zip(codes, blocks, strict=True)):
                    if not level:
                        places.append(c.begin(drawn_rows(keys, number, self.seed, self.row_share)))
                    else:
                        places[i] = c.step(places[i], coding.moves(tree, level - 1))
                    out = out + c.histogram(places[i], rank, len(wanted), wholes[i])
                return out

            tree = self._tree(table, self._columns(number, len(edges)), scale, edges, coding)
            for c, value in zip(codes, sums, strict=True):
                value += tree.weight[c.nodes_of(tree, tree.depth)]
            trees.append(tree)
        return trees

    def _rounds(self, made: Binned) -> list[Tree]:
        """All rounds, every level a job over all blocks."""
        run, trees = uuid.uuid4().hex, []
        blocks, coding, base, scale = made.blocks, made.coding, made.base, made.scale
        earlier = blocks.context.broadcast([])
        for number in range(self.rounds):
            if number and number % RESEND == 0:
                earlier.unpersist()
                earlier = blocks.context.broadcast(list(trees))
            later = trees[number - number % RESEND:]

            def table(tree: Tree, level: int, wanted: np.ndarray, number=number, earlier=earlier, later=later) -> np.ndarray:
                def histogram(found: Iterator) -> Iterator[np.ndarray]:
                    out, rank = np.zeros((len(wanted), coding.starts[-1], 2), np.int64), ranks(wanted, level)
                    moves = [coding.moves(tree, i) for i in range(level)]
                    for name, values, target, keys in found:
                        codes = Codes(coding, values)
                        value = predictions((run, name), codes, base, number, earlier, later)
                        known = _places.pop((run, name), None)
                        if known is None or known[0] != number or known[1] > level:
                            known = number, 0, codes.begin(drawn_rows(keys, number, self.seed, self.row_share))
                        at = known[2]
                        for move in moves[known[1]:]:
                            at = codes.step(at, move)
                        remember(_places, (run, name), (number, level, at))
                        out += codes.histogram(at, rank, len(wanted), np.rint((value - target) * scale))
                    yield out

                return added(blocks.mapPartitions(histogram))

            trees.append(self._tree(table, self._columns(number, len(made.edges)), scale, made.edges, coding))
        earlier.unpersist()
        return trees

    def _tree(
        self, table_of: Callable[[Tree, int, np.ndarray], np.ndarray], columns: np.ndarray, scale: float, edges: list[np.ndarray], coding: Coding
    ) -> Tree:
        """One tree, level by level; ``table_of`` sums some places of a level over all rows."""
        tree = Tree.empty(self.depth)
        sums = np.zeros((len(tree.feature), 2))
        codes = None
        for level in range(self.depth):
            first, count = (1 << level) - 1, 1 << level
            wanted, parents = halves(tree, level, sums[:, 1])
            codes = completed(level, table_of(tree, level, wanted), wanted, parents, codes)
            table = np.stack([coding.feature(codes, c, self.bins + 2) for c in columns], axis=1)
            total = table[:, 0].sum(axis=1) / np.array([scale, 1.0])
            if not level:
                sums[0] = total[0]
            gain, feature, cut, missing_left, left = best_splits(table, scale, self.l2, self.least_rows)
            for i in range(count):
                node = first + i
                if gain[i] > 1e-9 and (level == 0 or tree.feature[(node - 1) // 2] >= 0):
                    tree.feature[node], tree.cut[node], tree.missing_left[node] = columns[feature[i]], cut[i], missing_left[i]
                    own = edges[columns[feature[i]]]
                    tree.threshold[node] = own[cut[i]] if cut[i] < len(own) else np.inf
                    tree.gain[node] = gain[i]
                    sums[2 * node + 1] = left[i]
                    sums[2 * node + 2] = sums[node] - left[i]
            if not (tree.feature[first:first + count] >= 0).any():
                break
        tree.weight = np.where(
            (tree.feature < 0) & (sums[:, 1] > 0), -self.learning_rate * sums[:, 0] / np.maximum(sums[:, 1] + self.l2, 1e-300), 0.0
        )
        return tree


def ranks(wanted: np.ndarray, level: int) -> np.ndarray:
    """The number of each place of a level among the wanted ones, or -1; the last is no place."""
    out = np.full((1 << level) + 1, -1, np.int64)
    out[wanted] = np.arange(len(wanted))
    return out


def added(tables: RDD) -> np.ndarray:
    """The sum of all tables, at the driver."""
    return tables.reduce(np.add) if tables.getNumPartitions() <= DIRECT_TASKS else tables.treeReduce(np.add, 2)


def remember(memory: OrderedDict, name: tuple, value: object, most: int = 0) -> None:
    memory[name] = value
    while len(memory) > (most or REMEMBERED):
        memory.popitem(last=False)


@dataclass
class Binned:
    """Binned rows, kept: coded blocks ``(name, codes, targets, key hashes)``, or one block of bins where all rows are ``alone`` in it."""

    blocks: RDD | None
    edges: list[np.ndarray]
    coding: Coding | None
    n: int
    base: float
    scale: float
    alone: bool

    def release(self) -> None:
        """Keep the rows no longer."""
        if self.blocks is not None:
            self.blocks.unpersist()


def binned_rows(rows: DataFrame, features: str, target: str, key: str, bins: int, path: str | None = None) -> Binned:
    """All ``rows`` cut at exact quantiles, stored at ``path`` and kept for the models of the same settings."""
    spark = rows.sparkSession
    path = path or scratch_path(spark, "boosting")
    edges = bin_edges(rows, features, bins)
    # Millionths are summed as whole numbers: the mean does not depend on the order of the rows either.
    millionths = F.round(F.col(target) * 1_000_000).cast("decimal(38,0)")
    n, total, far = rows.agg(F.count("*"), F.sum(millionths), F.max(F.abs(F.col(target)))).first()
    if not n:
        return Binned(None, edges, None, 0, 0.0, 1.0, True)
    # Whole numbers per unit of gradient, so that no sum leaves 62 bits.
    scale = 2.0 ** min(20, 61 - int(n).bit_length() - int(2 * far + 2).bit_length())
    base, width = int(total) / n / 1_000_000, len(edges)
    # A wave of tasks with several blocks each: a level adds up one table a task.
    tasks = max(1, min(-(-n // BLOCK_ROWS), rows.rdd.getNumPartitions(), spark.sparkContext.defaultParallelism))
    most = BLOCK_ROWS
    frame = rows.select(
        vector_to_array(features).alias("x"), F.col(target).cast("double").alias("y"), F.xxhash64(key).alias("k")
    ).coalesce(tasks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, made = TaskContext.get().partitionId(), [], 0

        def block() -> pa.RecordBatch:
            parts = [np.concatenate(p).tobytes() for p in zip(*held, strict=True)]
            return pa.RecordBatch.from_arrays([pa.array([f"{part}-{made}"]), *[pa.array([p], pa.binary()) for p in parts]], names=["name", "bins", "y", "k"])

        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, width)
            held.append((binned(x, edges), batch.column(1).to_numpy(), batch.column(2).to_numpy()))
            if sum(len(h[0]) for h in held) >= most:
                yield block()
                held, made = [], made + 1
        if held:
            yield block()

    frame.mapInArrow(run, "name string, bins binary, y binary, k binary").write.mode("overwrite").parquet(path)
    stored = spark.read.parquet(path)

    def parts_of(r: Row) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return np.frombuffer(r[1], np.uint8).reshape(-1, width), np.frombuffer(r[2], np.float64), np.frombuffer(r[3], np.uint64)

    if tasks == 1 and n <= BLOCK_ROWS:
        return Binned(stored.coalesce(1).rdd.map(parts_of).persist(), edges, None, n, base, scale, True)
    groups = propose(parts_of(stored.first())[0])
    found = stored.rdd.map(lambda r: [combinations(parts_of(r)[0], g) for g in groups]).reduce(
        lambda a, b: [united(x, y) for x, y in zip(a, b, strict=True)]
    )
    coding = Coding.of(groups, found, edges)

    def coded(r: Row) -> tuple[str, np.ndarray, np.ndarray, np.ndarray]:
        rows, target, keys = parts_of(r)
        return r[0], coding.encode(rows), target, keys

    # Names go with the blocks, so what workers remember of one holds wherever it is dealt.
    blocks = stored.repartition(tasks).rdd.map(coded).persist(StorageLevel.MEMORY_AND_DISK)
    return Binned(blocks, edges, coding, n, base, scale, False)


def bin_edges(rows: DataFrame, features: str, bins: int) -> list[np.ndarray]:
    """Upper ends of each feature's bins: its distinct quantiles; none where all values are missing."""
    width = rows.select(F.size(vector_to_array(features)).alias("n")).agg(F.max("n")).first()[0] or 0
    long = rows.select(F.posexplode(vector_to_array(features)).alias("feature", "value"))
    found = exact_quantiles(long, "value", [i / bins for i in range(bins)], ["feature"]).collect()
    edges = {r["feature"]: np.unique(np.array(r["q"])) for r in found}
    return [edges.get(i, np.zeros(0)) for i in range(width)]


def binned(values: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    out = np.empty(values.shape, np.uint8)
    for i, own in enumerate(edges):
        out[:, i] = np.where(np.isnan(values[:, i]), MISSING, np.searchsorted(own, values[:, i], side="left"))
    return out


def row_hashes(keys: np.ndarray, number: int, seed: int) -> np.ndarray:
    """A hash of each row's key for one tree."""
    h = keys ^ np.uint64((seed * 0x9E3779B97F4A7C15 + number * 0xD1B54A32D192ED03) & 0xFFFFFFFFFFFFFFFF)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F)
    return h ^ (h >> np.uint64(32))


def drawn_rows(keys: np.ndarray, number: int, seed: int, share: float) -> np.ndarray:
    """Which rows a tree draws, by a hash of the row's key."""
    if share >= 1:
        return np.ones(len(keys), bool)
    return row_hashes(keys, number, seed) < np.uint64(int(share * 2**63) * 2)


def predictions(block: tuple, rows: np.ndarray | Codes, base: float, rounds: int, earlier: Broadcast, later: list[Tree]) -> np.ndarray:
    """Sum of all trees for the rows of a block, from what this worker remembers of it."""
    done, value = _remembered.pop(block, (0, np.full(len(rows), base)))
    sent = rounds - len(later)
    for tree in (earlier.value[done:] if done < sent else []) + later[max(0, done - sent):]:
        value = value + tree.weight[tree.nodes_of(rows, tree.depth)]
    remember(_remembered, block, (rounds, value))
    return value


def best_splits(table: np.ndarray, scale: float, l2: float, least_rows: float) -> tuple[np.ndarray, ...]:
    """For each node: gain, column, cut, side of missing values, and gradient and rows on the left; ties by column, then cut."""
    gradient, rows = table[..., 0] / scale, table[..., 1].astype(float)
    absent = np.stack([gradient[..., -1], rows[..., -1]], -1)[:, :, None, None, :]
    below = np.stack([gradient[..., :-1].cumsum(-1), rows[..., :-1].cumsum(-1)], -1)[:, :, :, None, :]
    # Last axis but one: missing values on the left, or on the right.
    left = below + absent * np.array([1.0, 0.0])[:, None]
    total = np.stack([gradient.sum(-1), rows.sum(-1)], -1)[:, :, None, None, :]
    right = total - left

    def score(x: np.ndarray) -> np.ndarray:
        return x[..., 0] ** 2 / np.maximum(x[..., 1] + l2, 1e-300)

    gain = 0.5 * (score(left) + score(right) - score(total))
    gain[(left[..., 1] < max(least_rows, 1)) | (right[..., 1] < max(least_rows, 1))] = -np.inf
    flat = gain.reshape(len(gain), -1)
    # Equal up to rounding counts as equal, so the first one stands for all.
    near = flat >= flat.max(axis=1, keepdims=True) * (1 - 1e-12) - 1e-12
    at = np.where(np.isfinite(flat.max(axis=1)), near.argmax(axis=1), 0)
    column, rest = np.divmod(at, 2 * below.shape[2])
    cut, side = np.divmod(rest, 2)
    every = np.arange(len(gain))
    return gain.reshape(len(gain), -1)[every, at], column, cut, side == 0, left[every, column, cut, side]


@dataclass
class Boosted:
    """A trained model: ``transform`` adds ``prediction`` to rows with the feature vector."""

    base: float
    trees: list[Tree] = field(repr=False)
    features: str = "features"

    def predict(self, values: np.ndarray) -> np.ndarray:
        out = np.full(len(values), self.base)
        for tree in self.trees:
            out += tree.weight[tree.nodes_of(values, tree.depth, bins=False)]
        return out

    def transform(self, rows: DataFrame) -> DataFrame:
        predict = self.predict

        @F.pandas_udf("double")
        def prediction(x: pd.Series) -> pd.Series:
            return pd.Series(predict(np.stack(x.to_numpy())) if len(x) else np.zeros(0))

        return rows.withColumn("prediction", prediction(vector_to_array(self.features)))

    def nodes(self, spark: SparkSession) -> DataFrame:
        """``tree, node, feature, threshold, missing_left, weight, gain``: the model as a table (its size is set by rounds and depth)."""
        rows = [
            (t, i, int(tree.feature[i]), float(tree.threshold[i]), bool(tree.missing_left[i]), float(tree.weight[i]), float(tree.gain[i]))
            for t, tree in enumerate(self.trees) for i in range(len(tree.feature))
            if i == 0 or tree.feature[(i - 1) // 2] >= 0
        ]
        schema = "tree int, node int, feature int, threshold double, missing_left boolean, weight double, gain double"
        return spark.createDataFrame(rows, schema)

    def save(self, spark: SparkSession, path: str) -> None:
        """Replace what is stored at ``path`` by the nodes and a row with base and depth."""
        depth = self.trees[0].depth if self.trees else 0
        head = spark.createDataFrame([(self.base, depth, len(self.trees), self.features)], "base double, depth int, trees int, features string")
        self.nodes(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        head.coalesce(1).write.mode("overwrite").parquet(f"{path}/model")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Boosted:
        head = spark.read.parquet(f"{path}/model").first()
        trees = [Tree.empty(head["depth"]) for _ in range(head["trees"])]
        for t, i, feature, threshold, missing_left, weight, gain in spark.read.parquet(f"{path}/nodes").collect():
            tree = trees[t]
            tree.feature[i], tree.threshold[i], tree.missing_left[i], tree.weight[i], tree.gain[i] = feature, threshold, missing_left, weight, gain
        return cls(head["base"], trees, head["features"])
