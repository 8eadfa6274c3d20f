"""Gradient boosting for several classes at once: every round grows one regression tree per class on the gradients of the softmax loss.

Features are cut into bins once. A level of all trees of a round is one pass: tasks add counts, gradients and curvatures up by
(class, node, feature, bin), Spark sums these small tables, and the driver picks the splits. The sums on both sides of the last splits are also those of the
leaves, so leaf values, a Newton step each, need no pass of their own. Scores are not stored: tasks compute them from the trees grown so far, and
every KEEP rounds they are written with the rows. Up to ONE_TASK values, whose bins are a few megabytes, a pass would be all overhead: one task then grows
all rounds on the same blocks, with the same sums and splits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dailypanel.operators.lookup import settle
from dailypanel.session import ship

BINS, KEEP = 32, 25
#: Rows that a task should have at least.
TASK_ROWS = 20_000
#: Rows x features x classes up to which one task grows all rounds: seconds of work, and bins and scores of a few dozen megabytes.
ONE_TASK = 24_000_000


@dataclass(frozen=True)
class Round:
    """One tree per class as arrays over a full binary tree: at an inner node, bins up to ``cut`` of ``feature`` go left."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray

    def descend(self, bins: np.ndarray, levels: int) -> np.ndarray:
        """The node that each row (first axis) has reached in each class's tree after ``levels`` steps."""
        out = np.empty((len(self.feature), len(bins)), np.int64)
        for tree, (feature, cut) in enumerate(zip(self.feature, self.cut)):
            node = np.zeros(len(bins), np.int8 if levels < 6 else np.int64)
            for level in range(levels):
                first, right = 2 ** level - 1, np.zeros(len(bins), bool)
                for k in range(first, 2 * first + 1):
                    right |= (node == k - first) & (bins[:, feature[k]] > cut[k])
                node = 2 * node + right
            out[tree] = node
        return out.T + (2 ** levels - 1)

    def scores(self, bins: np.ndarray) -> np.ndarray:
        depth = self.value.shape[1].bit_length() - 1
        return self.value[np.arange(len(self.value)), self.descend(bins, depth) - (2 ** depth - 1)]


def chances(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def binned(features: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.column_stack([np.searchsorted(e, features[:, k], "left") for k, e in enumerate(edges)]).astype(np.int16)


def _matrix(lists: pa.Array, width: int, kind: type) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(-1, width)


@dataclass(frozen=True)
class BoostedClasses:
    """A fitted model: ``transform`` adds ``probability`` (an array) and ``prediction``, the most likely class, the lowest of equals."""

    edges: list[np.ndarray]
    start: np.ndarray
    rounds: list[Round]

    def scores(self, bins: np.ndarray) -> np.ndarray:
        return sum((r.scores(bins) for r in self.rounds), np.tile(self.start, (len(bins), 1)))

    def transform(self, rows: DataFrame) -> DataFrame:
        ship(rows.sparkSession)
        model = self

        @F.arrow_udf("array<double>")
        def probability(features: pa.Array) -> pa.Array:
            x = _matrix(features, len(model.edges), float)
            return pa.array(list(chances(model.scores(binned(x, model.edges)))), pa.list_(pa.float64()))

        scored = rows.withColumn("probability", probability(vector_to_array("features")))
        return scored.withColumn("prediction", (F.array_position("probability", F.array_max("probability")) - 1).cast("double"))


#: Rows travel as blocks: the bytes of their bins, feature by feature, of their labels and of their scores, class by class.
BLOCK = pa.schema([(c, pa.binary()) for c in ("bins", "label", "base")])


def _block(bins: np.ndarray, label: np.ndarray, base: np.ndarray) -> pa.RecordBatch:
    parts = bins.T.astype(np.uint8), label.astype(np.int32), base.T.astype(float)
    return pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()) for x in parts], schema=BLOCK)


def _blocks(batches: Iterator[pa.RecordBatch], features: int, classes: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for batch in batches:
        for bins, label, base in zip(*(batch.column(c) for c in ("bins", "label", "base"))):
            at = np.frombuffer(bins.as_buffer(), np.uint8).reshape(features, -1).T
            yield at, np.frombuffer(label.as_buffer(), np.int32), np.frombuffer(base.as_buffer(), float).reshape(classes, -1).T


def _add(total: np.ndarray, bins: np.ndarray, label: np.ndarray, scores: np.ndarray, now: Round, level: int) -> None:
    """Add counts, gradients and curvatures of one block's rows to ``total``, of shape (3, classes, nodes of the level, features, BINS)."""
    _, classes, width, features, _ = total.shape
    p = chances(scores)
    g, h = (np.eye(classes)[label] - p).T.copy(), (p * (1 - p)).T.copy()
    node = (now.descend(bins, level) - (width - 1)) * BINS
    for k in range(classes):
        for f in range(features):
            cell = node[:, k] + bins[:, f]
            for total_of, weight in zip(total, (None, g[k], h[k])):
                total_of[k, :, f] += np.bincount(cell, weight, width * BINS).reshape(width, BINS)


def _sums(start: np.ndarray, rounds: list[Round], now: Round, level: int, features: int) -> Callable:
    """For mapInArrow over blocks: (cell, n, g, h) of one level of the trees of ``now``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = len(start)
        total = np.zeros((3, classes, 2 ** level, features, BINS))
        for bins, label, base in _blocks(batches, features, classes):
            _add(total, bins, label, sum((r.scores(bins) for r in rounds), base), now, level)
        total = total.reshape(3, -1)
        cell = np.flatnonzero(total[0])
        yield pa.RecordBatch.from_arrays([pa.array(cell), *[pa.array(t[cell]) for t in total]], ["cell", "n", "g", "h"])

    return run


def _all_rounds(model: SoftmaxBoosting, features: int, classes: int) -> Callable:
    """For mapInArrow over all blocks in one task: feature, cut and value of every round, as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = [(bins, label, base.copy()) for bins, label, base in _blocks(batches, features, classes)]

        def sums(now: Round, level: int) -> np.ndarray:
            total = np.zeros((3, classes, 2 ** level, features, BINS))
            for block in blocks:
                _add(total, *block, now, level)
            return total

        for _ in range(model.rounds):
            now = model.grown(sums, classes)
            for bins, _, scores in blocks:
                scores += now.scores(bins)
            parts = now.feature.astype(np.int64), now.cut.astype(np.int64), now.value
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in parts], ["feature", "cut", "value"])

    return run


def _rescored(rounds: list[Round], features: int, classes: int) -> Callable:
    """For mapInArrow over blocks: the same with the scores of ``rounds`` added to base."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bins, label, base in _blocks(batches, features, classes):
            yield _block(bins, label, sum((r.scores(bins) for r in rounds), base))

    return run


def best_splits(n: np.ndarray, g: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """For sums of shape (..., features, bins): the feature and the last left bin of the split that lowers the squared error of the gradients most.

    Of equal ones the first feature and bin; where nothing is won all rows go left (bin BINS - 1)."""
    left_n, left_g = n.cumsum(-1), g.cumsum(-1)
    all_n, all_g = left_n[..., -1:], left_g[..., -1:]
    right_n, right_g = all_n - left_n, all_g - left_g
    gain = left_g ** 2 / np.maximum(left_n, 1) + right_g ** 2 / np.maximum(right_n, 1) - all_g ** 2 / np.maximum(all_n, 1)
    gain = np.where((left_n >= least) & (right_n >= least), np.round(gain, 9), 0.0)
    flat = gain.reshape(*gain.shape[:-2], -1)
    at = flat.argmax(-1)
    won = np.take_along_axis(flat, at[..., None], -1)[..., 0] > 0
    return np.where(won, at // BINS, 0), np.where(won, at % BINS, BINS - 1)


@dataclass(frozen=True)
class SoftmaxBoosting:
    """The estimator. Labels are 0, 1, ...; rows need ``features`` and ``label`` without gaps, as ``assembled`` gives them.

    The driver holds the trees and, for each level, classes x nodes x features x BINS sums, whatever the rows."""

    rounds: int = 100
    depth: int = 3
    step: float = 0.1
    least: int = 1

    def fit(self, rows: DataFrame) -> BoostedClasses:
        ship(rows.sparkSession)
        table = rows.select(vector_to_array("features").alias("x"), F.col("label").cast("int").alias("label"))
        counts = {r["label"]: r["n"] for r in table.groupBy("label").agg(F.count("*").alias("n")).collect()}
        if not counts:
            raise ValueError("there are no rows to fit")
        classes = max(counts) + 1
        seen = np.array([counts.get(k, 0) for k in range(classes)])
        start = np.log(np.maximum(seen, 1e-9) / seen.sum())
        edges = _edges(table)
        # a pass over a small table is mostly the cost of its tasks
        # and of the sums that they hand on, as many from every task
        tasks = min(1 + int(seen.sum()) // TASK_ROWS, 2 * rows.sparkSession.sparkContext.defaultParallelism)
        rows = settle(self._prepared(table.coalesce(tasks), edges, start))
        if int(seen.sum()) * len(edges) * classes <= ONE_TASK:
            found = rows.coalesce(1).mapInArrow(_all_rounds(self, len(edges), classes), "feature binary, cut binary, value binary").collect()
            kinds = {"feature": np.int64, "cut": np.int64, "value": float}
            return BoostedClasses(edges, start, [Round(*(np.frombuffer(r[c], kind).reshape(classes, -1) for c, kind in kinds.items())) for r in found])
        grown, kept = [], []
        for _ in range(self.rounds):
            grown.append(self.grown(self._passes(rows, start, grown, len(edges)), classes))
            if len(grown) == KEEP:
                rows = settle(rows.mapInArrow(_rescored(grown, len(edges), classes), rows.schema))
                kept, grown = kept + grown, []
        return BoostedClasses(edges, start, kept + grown)

    def _prepared(self, table: DataFrame, edges: list[np.ndarray], start: np.ndarray) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    label = batch.column("label").to_numpy(zero_copy_only=False)
                    yield _block(binned(_matrix(batch.column("x"), len(edges), float), edges), label, np.tile(start, (batch.num_rows, 1)))

        return table.mapInArrow(run, "bins binary, label binary, base binary")

    def _passes(self, rows: DataFrame, start: np.ndarray, grown: list[Round], features: int) -> Callable:
        """The sums of a level of ``now``, by a pass over the blocks."""
        classes, grown = len(start), list(grown)

        def sums(now: Round, level: int) -> np.ndarray:
            total = np.zeros((3, classes * 2 ** level * features * BINS))
            found = rows.mapInArrow(_sums(start, grown, now, level, features), "cell long, n double, g double, h double")
            found = found.groupBy("cell").agg(F.sum("n").alias("n"), F.sum("g").alias("g"), F.sum("h").alias("h")).toArrow()
            total[:, found.column("cell").to_numpy()] = [found.column(c).to_numpy() for c in ("n", "g", "h")]
            return total.reshape(3, classes, 2 ** level, features, BINS)

        return sums

    def grown(self, sums: Callable, classes: int) -> Round:
        """The trees of one round; ``sums`` gives those of a level."""
        inner = 2 ** self.depth - 1
        now = Round(np.zeros((classes, inner), int), np.full((classes, inner), BINS - 1), np.zeros((classes, inner + 1)))
        for level in range(self.depth):
            width, first = 2 ** level, 2 ** level - 1
            n, g, h = sums(now, level)
            feature, cut = best_splits(n, g, self.least)
            now.feature[:, first:first + width], now.cut[:, first:first + width] = feature, cut
        # the sums beside the last cuts are those of the leaves
        for k in range(classes):
            for node in range(width):
                f, c = feature[k, node], cut[k, node] + 1
                for side, bins in ((0, slice(0, c)), (1, slice(c, BINS))):
                    weight = h[k, node, f, bins].sum()
                    pull = g[k, node, f, bins].sum()
                    now.value[k, 2 * node + side] = self.step * (classes - 1) / classes * pull / weight if weight > 1e-12 else 0.0
        return now


def _edges(table: DataFrame) -> list[np.ndarray]:
    """Up to BINS - 1 upper ends of bins for each feature, from its approximate quantiles: one pass, a short list per feature."""
    width = table.select(F.size("x").alias("k")).first()["k"]
    shares = F.lit([k / BINS for k in range(1, BINS)])
    row = table.agg(*[F.percentile_approx(F.col("x")[k], shares, 10_000).alias(f"q{k}") for k in range(width)]).first()
    return [np.unique(np.array(q, float)) for q in row]
