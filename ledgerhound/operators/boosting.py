"""Boosted trees grown leaf by leaf on gradient histograms (O-62), and their exact Shapley values (O-82).

Training rows are binned once and kept as blocks of small integers with a margin per row. A tree grows best-first: of all its leaves
the one whose split gains most is split next, until ``num_leaves``. Split gains come from histograms, the sums of gradient, Hessian and
rows by (leaf, input, bin): one aggregate over the blocks, combined in the partitions and then as a tree. Only the smaller child of
a split is summed; its sibling is the parent less it. Splits of a leaf don't depend on the order, so one aggregate serves every leaf that the
search could reach with what it knows so far, and a tree takes about as many aggregates as it has levels.

Histograms are added up and stay in the executors, dealt by groups of inputs; the driver gets each leaf's best split of every group, a few numbers,
and holds the model, never rows or histograms. Up to ``ONE_TASK_ROWS`` there is one partition, and nothing to exchange: its task
grows all trees leaf by leaf and keeps each leaf's rows, so it sums no leaf that isn't split. This is the one place that works on an RDD: each step is a small sum over cached arrays, thousands of
times, where planning a query would cost more than the sum.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import RDD, StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a block, and of a partition of blocks; bins of an input.
BLOCK_ROWS = 16_384
PARTITION_ROWS = 65_536
BINS = 255
#: Rows up to which one task grows all trees: exchanging histograms costs more than their sums there. It holds a byte for each row and input.
ONE_TASK_ROWS = 1_048_576
#: Fewer rows of a leaf are added up for all inputs together: there a call for each input costs more than its sums.
FEW_ROWS = 1_024
#: Joint bins of inputs of few bins that are added up as one column, in one task.
JOINT_BINS = 256
#: Inputs whose histograms one task adds up.
GROUP_INPUTS = 16
#: Conditions of a leaf up to which the patterns that rows pass are counted: there are two to the power of them.
COUNTED_CONDITIONS = 12
#: A child needs this much Hessian.
LEAST_HESSIAN = 1e-3
#: Trees between two checkpoints of the blocks.
CHECKPOINT_TREES = 20
NODES = "tree int, node int, input int, at double, left int, right int, value double, gain double, cover double"


@dataclass
class Tree:
    """Arrays over nodes; a leaf has left = -1. Rows with input <= at go left; cover: training rows."""
    input: np.ndarray
    at: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    gain: np.ndarray
    cover: np.ndarray

    def margin(self, x: np.ndarray) -> np.ndarray:
        node, rows = np.zeros(len(x), np.int64), np.arange(len(x))
        while len(rows):
            here = node[rows]
            rows = rows[self.left[here] >= 0]
            here = node[rows]
            node[rows] = np.where(x[rows, self.input[here]] <= self.at[here], self.left[here], self.right[here])
        return self.value[node]


@dataclass
class BoostedTrees:
    base: float
    trees: list[Tree] = field(default_factory=list)

    def margin(self, x: np.ndarray) -> np.ndarray:
        return self.base + sum((t.margin(x) for t in self.trees), np.zeros(len(x)))

    def frame(self, spark: SparkSession) -> DataFrame:
        """The model as a table; tree -1 holds the base."""
        rows = [(-1, 0, 0, 0.0, -1, -1, float(self.base), 0.0, 0.0)]
        for k, t in enumerate(self.trees):
            rows += [(k, i, int(t.input[i]), float(t.at[i]), int(t.left[i]), int(t.right[i]), float(t.value[i]), float(t.gain[i]), float(t.cover[i]))
                     for i in range(len(t.left))]
        return spark.createDataFrame(rows, NODES)

    @staticmethod
    def read(saved: DataFrame) -> BoostedTrees:
        """The model of a ``frame``; bounded by the model's size."""
        nodes = saved.toPandas().sort_values(["tree", "node"])
        trees = [Tree(*[g[c].to_numpy() for c in ("input", "at", "left", "right", "value", "gain", "cover")]) for k, g in nodes.groupby("tree") if k >= 0]
        return BoostedTrees(float(nodes.loc[nodes.tree == -1, "value"].iloc[0]), trees)

    def gains(self, n_inputs: int) -> np.ndarray:
        out = np.zeros(n_inputs)
        for t in self.trees:
            np.add.at(out, t.input[t.left >= 0], t.gain[t.left >= 0])
        return out


def bin_edges(rows: DataFrame, n_inputs: int, bins: int = BINS) -> list[np.ndarray]:
    """Ascending edges of each input's bins: a value is in the first bin whose edge it doesn't exceed. Quantiles of the rows."""
    at = [(k + 1) / bins for k in range(bins)]
    values = rows.select(F.posexplode(vector_to_array("features")).alias("input", "value"))
    found = values.groupBy("input").agg(F.percentile_approx("value", at, 20 * bins).alias("edges")).collect()  # a row for each input
    out = [np.zeros(1)] * n_inputs
    for r in found:
        out[r["input"]] = np.unique(np.array(r["edges"], float))
    return out


def _blocks(edges: list[np.ndarray], base: float, label: str):
    def run(rows: Iterator) -> Iterator[tuple[np.ndarray, ...]]:
        def block(part: list) -> tuple[np.ndarray, ...]:
            x = np.array([r.x for r in part], float).reshape(len(part), -1)
            binned = np.stack([np.minimum(np.searchsorted(e, x[:, k], side="left"), len(e) - 1) for k, e in enumerate(edges)], 1)
            return binned.astype(np.uint8), np.array([r[label] for r in part], float), np.array([r.w for r in part], float), np.full(len(part), base)
        part: list = []
        for r in rows:
            part.append(r)
            if len(part) == BLOCK_ROWS:
                yield block(part)
                part = []
        if part:
            yield block(part)
    return run


@dataclass
class Node:
    """A node of a growing tree: its sums of gradients, Hessians and rows, and the best split of its rows (``below``: rows that go left)."""
    total: np.ndarray
    input: int = -1
    bin: int = -1
    gain: float = 0.0
    below: float = 0.0
    left: int = -1
    right: int = -1


class Slots:
    """The histogram slots of consecutive inputs, one for each bin: histograms are arrays (3, slot) of gradients, Hessians and rows."""

    def __init__(self, edges: list[np.ndarray], least_rows: int, start: int = 0) -> None:
        self.least_rows, self.start, self.end = least_rows, start, start + len(edges)
        self.sizes = np.array([len(e) for e in edges])
        self.first = np.cumsum(self.sizes) - self.sizes
        self.width = int(self.sizes.sum())
        self.input_of = np.repeat(np.arange(len(edges)), self.sizes)
        self.is_last = np.zeros(self.width, bool)
        self.is_last[self.first + self.sizes - 1] = True

    def best(self, hist: np.ndarray) -> Node:
        """The node of a histogram, with its best split if one gains."""
        sums = np.cumsum(hist, axis=1)
        total = sums[:, self.sizes[0] - 1].copy()
        start = np.where(self.first > 0, sums[:, self.first - 1], 0.0)  # before each input's first bin
        rows = sums[2] - np.repeat(start[2], self.sizes)
        ok = np.flatnonzero((rows >= self.least_rows) & (rows <= total[2] - self.least_rows) & ~self.is_last)
        owner = self.input_of[ok]
        g, h = sums[0, ok] - start[0, owner], sums[1, ok] - start[1, owner]
        over_g, over_h = total[0] - g, total[1] - h
        enough = np.minimum(h, over_h) >= LEAST_HESSIAN
        node = Node(total)
        if enough.any():
            ok, g, h, over_g, over_h = (x[enough] for x in (ok, g, h, over_g, over_h))
            gain = g * g / h + over_g * over_g / over_h - total[0] ** 2 / total[1]
            at = int(np.argmax(gain))
            if gain[at] > 1e-12:
                f = int(self.input_of[ok[at]])
                node.input, node.bin, node.gain, node.below = self.start + f, int(ok[at] - self.first[f]), float(gain[at]), float(rows[ok[at]])
        return node

    def add(self, out: np.ndarray, bins: np.ndarray, where: np.ndarray, g: np.ndarray, h: np.ndarray) -> None:
        """Adds rows, each to the histogram ``where`` of ``out`` (3, histograms one after the other)."""
        at = (bins[:, self.start:self.end] + (self.first + (where * self.width)[:, None])).ravel()
        times = self.end - self.start
        out[0] += np.bincount(at, np.repeat(g, times), out.shape[1])
        out[1] += np.bincount(at, np.repeat(h, times), out.shape[1])
        out[2] += np.bincount(at, minlength=out.shape[1])


def summed(blocks: Iterator, groups: list[Slots], walk: tuple | None, slot: np.ndarray, n: int) -> list[np.ndarray]:
    """For each group of inputs the ``n`` histograms (histogram, 3, slot) of some blocks' rows; ``slot``: the histogram of each leaf, or -1."""
    out = [np.zeros((3, n * s.width)) for s in groups]
    for bins, y, w, margin in blocks:
        where = slot[leaf_of(bins, *walk)] if walk else np.zeros(len(y), np.int64)
        rows = np.flatnonzero(where >= 0)
        p = 1 / (1 + np.exp(-margin[rows]))
        g, h = w[rows] * (p - y[rows]), w[rows] * p * (1 - p)
        for s, o in zip(groups, out, strict=True):
            s.add(o, bins[rows], where[rows], g, h)
    return [np.ascontiguousarray(o.reshape(3, n, s.width).transpose(1, 0, 2)) for s, o in zip(groups, out, strict=True)]


@dataclass
class Joint:
    """Inputs that are added up as one column: a bin of it is a bin of each of them. ``share`` (joint bin, slot): which joint bins a slot adds up,
    None for a single input, whose bins are its slots."""
    column: np.ndarray
    size: int
    slots: slice | np.ndarray
    share: np.ndarray | None


def joined(columns: np.ndarray, slots: Slots) -> list[Joint]:
    """All inputs' columns, those of few bins joined as long as ``JOINT_BINS`` hold: adding up costs by columns, most where all rows meet in a few bins."""
    members: list[list[int]] = []
    for f in np.argsort(-slots.sizes, kind="stable").tolist():
        home = next((m for m in reversed(members) if np.prod(slots.sizes[m]) * slots.sizes[f] <= JOINT_BINS), None)
        if home is None:
            members.append([f])
        else:
            home.append(f)
    out = []
    for m in members:
        sizes = slots.sizes[m]
        size = int(np.prod(sizes))
        if len(m) == 1:
            out.append(Joint(columns[m[0]], size, slice(slots.first[m[0]], slots.first[m[0]] + size), None))
            continue
        column = np.ravel_multi_index([columns[f] for f in m], sizes).astype(np.uint8 if size <= 256 else np.uint16)
        share = [(np.unravel_index(np.arange(size), sizes)[k][:, None] == np.arange(s)).astype(float) for k, s in enumerate(sizes)]
        out.append(Joint(column, size, np.concatenate([slots.first[f] + np.arange(slots.sizes[f]) for f in m]), np.concatenate(share, axis=1)))
    return out


class OwnHistograms:
    """The histograms and rows of a tree's leaves, all rows being in one partition."""
    at_once = 1  # a round costs nothing here, so no leaf is split before the search is sure of it

    def __init__(self, edges: list[np.ndarray], least_rows: int, blocks: list[tuple[np.ndarray, ...]]) -> None:
        bins, self.y, self.w, self.margin = (np.concatenate(parts) for parts in zip(*blocks, strict=True))
        self.slots, self.columns = Slots(edges, least_rows), np.ascontiguousarray(bins.T)
        self.joints = joined(self.columns, self.slots)
        self.kept, self.rows = {}, {}

    def root(self) -> Node:
        p = 1 / (1 + np.exp(-self.margin))
        self.g, self.h = self.w * (p - self.y), self.w * p * (1 - p)
        self.rows = {0: np.arange(len(self.y))}
        self.kept = {0: self._summed(self.rows[0])}
        return self.slots.best(self.kept[0])

    def _summed(self, rows: np.ndarray) -> np.ndarray:
        """The histogram of some rows; a piece of them stays in the cache while each column's bins are added up."""
        out = np.zeros((3, self.slots.width))
        sums = [out[:, j.slots] if j.share is None else np.zeros((3, j.size)) for j in self.joints] if len(rows) >= FEW_ROWS else []
        for start in range(0, len(rows), BLOCK_ROWS):
            piece = slice(start, start + BLOCK_ROWS)
            part = piece if len(rows) == len(self.y) else rows[piece]  # a root's rows lie in order
            g, h = self.g[part], self.h[part]
            if not sums:
                at = (self.columns[:, part] + self.slots.first[:, None]).ravel()
                out[0] += np.bincount(at, np.tile(g, len(self.columns)), self.slots.width)
                out[1] += np.bincount(at, np.tile(h, len(self.columns)), self.slots.width)
                out[2] += np.bincount(at, minlength=self.slots.width)
                continue
            for joint, own in zip(self.joints, sums, strict=True):
                bins = joint.column[part].astype(np.intp)
                own[0] += np.bincount(bins, g, joint.size)
                own[1] += np.bincount(bins, h, joint.size)
                own[2] += np.bincount(bins, minlength=joint.size)
        for joint, own in zip(self.joints, sums, strict=True) if sums else ():
            if joint.share is not None:
                out[:, joint.slots] = own @ joint.share
        return out

    def split(self, nodes: list[Node], families: list[tuple[int, int, int]]) -> dict[int, Node]:
        for parent, _, _ in families:
            node, rows = nodes[parent], self.rows.pop(parent)
            left = self.columns[node.input, rows] <= node.bin
            self.rows[node.left], self.rows[node.right] = rows[left], rows[~left]
        sums = [self._summed(self.rows[child]) for _, child, _ in families]
        return {k: self.slots.best(h) for k, h in children(self.kept, sums, families)}

    def learn(self, order: list[int], values: np.ndarray) -> None:
        """Adds its leaf's value to the margin of each row; ``order``: the nodes that the values are of."""
        for k, value in zip(order, values, strict=True):
            if k in self.rows:
                self.margin[self.rows[k]] += value


def children(kept: dict[int, np.ndarray], sums: np.ndarray | list[np.ndarray], families: list[tuple[int, int, int]]) -> Iterator[tuple[int, np.ndarray]]:
    """(node, histogram) of both children in each (parent, summed child, other child); ``kept`` gets them and loses the parents."""
    for (parent, child, other), hist in zip(families, sums, strict=True):
        kept[child], kept[other] = hist, kept.pop(parent) - hist
        yield from ((child, hist), (other, kept[other]))


class SpreadHistograms:
    """The histograms of a tree's leaves over the blocks of many partitions, kept in the executors by groups of inputs."""
    at_once = None  # a round is dear, so it serves every leaf that the search may split

    def __init__(self, edges: list[np.ndarray], least_rows: int) -> None:
        self.groups = [Slots(edges[k:k + GROUP_INPUTS], least_rows, k) for k in range(0, len(edges), GROUP_INPUTS)]
        self.blocks, self.kept = None, []

    def over(self, blocks: RDD) -> SpreadHistograms:
        self.clear()
        self.blocks = blocks
        return self

    def clear(self) -> None:
        for rdd in self.kept:
            rdd.unpersist()
        self.kept = []

    def _sums(self, walk: tuple | None, slot: np.ndarray, n: int) -> RDD:
        """One (group, histograms) in each partition."""
        groups = self.groups
        return self.blocks.mapPartitions(lambda own: enumerate(summed(own, groups, walk, slot, n))) \
            .reduceByKey(np.add, len(groups), lambda k: k)

    def _best(self, found: RDD) -> dict[int, Node]:
        """Of each node the best split of all groups, on a tie of the first one. ``found``: (group, all histograms, those of new nodes)."""
        groups = self.groups
        self.kept.append(found.persist(StorageLevel.MEMORY_AND_DISK))
        splits = self.kept[-1].map(lambda x: (x[0], [(k, groups[x[0]].best(x[1][k])) for k in x[2]])).collect()
        out: dict[int, Node] = {}
        for _, nodes in sorted(splits, key=lambda x: x[0]):
            for k, node in nodes:
                if k not in out:
                    out[k] = node
                elif node.gain > out[k].gain:
                    node.total = out[k].total
                    out[k] = node
        return out

    def root(self) -> Node:
        return self._best(self._sums(None, np.zeros(1, np.int64), 1).map(lambda x: (x[0], {0: x[1][0]}, [0])))[0]

    def split(self, nodes: list[Node], families: list[tuple[int, int, int]]) -> dict[int, Node]:
        walk = tuple(np.array([getattr(n, c) for n in nodes]) for c in ("input", "bin", "left", "right"))
        slot = np.full(len(nodes), -1)
        slot[[c for _, c, _ in families]] = np.arange(len(families))

        def step(pair: tuple) -> tuple:
            (group, kept, _), (_, sums) = pair
            kept = dict(kept)
            return group, kept, [k for k, _ in children(kept, sums, families)]
        return self._best(self.kept[-1].zip(self._sums(walk, slot, len(families))).map(step))


class Grower:
    """Grows one tree after the other over histograms."""

    def __init__(self, edges: list[np.ndarray], num_leaves: int) -> None:
        self.edges, self.num_leaves = edges, num_leaves

    def search(self, nodes: list[Node]) -> tuple[list[int], list[int]]:
        """(nodes that best-first growth splits, those of them whose children aren't known yet)."""
        heap = [(-nodes[0].gain, 0)] if nodes[0].gain > 0 else []
        chosen, open_ = [], []
        while heap and len(chosen) < self.num_leaves - 1:
            k = heapq.heappop(heap)[1]
            chosen.append(k)
            if nodes[k].left < 0:
                open_.append(k)
            else:
                for c in (nodes[k].left, nodes[k].right):
                    if nodes[c].gain > 0:
                        heapq.heappush(heap, (-nodes[c].gain, c))
        return chosen, open_

    def grow(self, histograms: OwnHistograms | SpreadHistograms, rate: float) -> tuple[Tree, tuple[np.ndarray, ...], list[int]] | None:
        """A tree, its form over bins, and the place of each of its nodes in the search; None if no split gains."""
        nodes = [histograms.root()]
        while True:
            chosen, open_ = self.search(nodes)
            if not chosen:
                return None
            if not open_:
                break
            families = []
            for k in open_[:histograms.at_once]:
                node = nodes[k]
                node.left, node.right = len(nodes), len(nodes) + 1
                nodes += [Node(node.total), Node(node.total)]
                families.append((k, node.left, node.right) if 2 * node.below <= node.total[2] else (k, node.right, node.left))
            for k, node in histograms.split(nodes, families).items():
                nodes[k] = node
        order = self._order(nodes, set(chosen))
        place = {k: i for i, k in enumerate(order)}
        inner = np.array([k in set(chosen) for k in order])
        at = lambda name: np.array([place[getattr(nodes[k], name)] if i else -1 for k, i in zip(order, inner, strict=True)])
        value = np.array([-nodes[k].total[0] / nodes[k].total[1] * rate for k in order])
        inputs = np.array([nodes[k].input if i else 0 for k, i in zip(order, inner, strict=True)])
        bins = np.array([nodes[k].bin if i else 0 for k, i in zip(order, inner, strict=True)])
        left, right = at("left"), at("right")
        tree = Tree(inputs, np.array([self.edges[f][b] if i else 0.0 for f, b, i in zip(inputs, bins, inner, strict=True)]), left, right, value,
                    np.array([nodes[k].gain if i else 0.0 for k, i in zip(order, inner, strict=True)]), np.array([nodes[k].total[2] for k in order]))
        return tree, (inputs, bins, left, right, value), order

    def _order(self, nodes: list[Node], chosen: set[int]) -> list[int]:
        out = [0]
        for k in out:
            if k in chosen:
                out += [nodes[k].left, nodes[k].right]
        return out


def leaf_of(bins: np.ndarray, inputs: np.ndarray, at: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The leaf of each row of bins."""
    node, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
    while len(rows):
        rows = rows[left[node[rows]] >= 0]
        here = node[rows]
        node[rows] = np.where(bins[rows, inputs[here]] <= at[here], left[here], right[here])
    return node


def fit(train: DataFrame, label: str, n_trees: int, rate: float, num_leaves: int, least_rows: int, bins: int = BINS) -> BoostedTrees:
    """``train``: features (vector), ``label`` 0 or 1, weight w. Fewer trees where none gains any more; only the base for one class or no row."""
    sizes = train.select(vector_to_array("features").alias("x"), label, "w")
    row = sizes.agg(F.max(F.size("x")), F.sum(F.col("w") * F.col(label)), F.sum("w"), F.count(F.lit(1))).first()
    n_inputs, positive, total = row[0] or 0, float(row[1] or 0.0), float(row[2] or 0.0)
    if not 0 < positive < total or not n_inputs:
        return BoostedTrees(float(np.log(max(positive, 1e-9) / max(total - positive, 1e-9))) if total else 0.0)
    model = BoostedTrees(float(np.log(positive / (total - positive))))
    edges = bin_edges(train, n_inputs, bins)
    grower = Grower(edges, num_leaves)
    one = row[3] <= ONE_TASK_ROWS
    # A round is one task a partition, so not more than the rows need. Rows of one partition are binned where they are: their blocks are the smaller load.
    dealt = sizes if one else sizes.repartition(-(-row[3] // PARTITION_ROWS))
    blocks = dealt.rdd.mapPartitions(_blocks(edges, model.base, label))
    model.trees += _grown_in_one(blocks.coalesce(1, shuffle=True), grower, n_trees, rate, least_rows) if one \
        else _grown_spread(blocks, grower, n_trees, rate, least_rows)
    return model


def _grown_in_one(blocks: RDD, grower: Grower, n_trees: int, rate: float, least_rows: int) -> list[Tree]:
    """Trees over the rows of one partition, grown by its task."""
    def run(own: Iterator) -> Iterator[Tree]:
        histograms = OwnHistograms(grower.edges, least_rows, list(own))
        for _ in range(n_trees):
            grown = grower.grow(histograms, rate)
            if grown is None:
                return
            tree, binned, order = grown
            yield tree
            histograms.learn(order, binned[4])
    return blocks.mapPartitions(run).collect()


def _grown_spread(blocks: RDD, grower: Grower, n_trees: int, rate: float, least_rows: int) -> list[Tree]:
    """Trees over the rows of many partitions, each grown in rounds."""
    out, old, blocks = [], None, blocks.persist(StorageLevel.MEMORY_AND_DISK)
    histograms = SpreadHistograms(grower.edges, least_rows)
    for k in range(n_trees):
        if k and k % CHECKPOINT_TREES == 0:
            blocks.checkpoint()
        grown = grower.grow(histograms.over(blocks), rate)  # its first sum also brings the margins up to date
        if old is not None:
            old.unpersist()
        if grown is None:
            break
        tree, binned, _ = grown
        out.append(tree)
        old, blocks = blocks, blocks.map(_updated(binned)).persist(StorageLevel.MEMORY_AND_DISK)
    histograms.clear()
    for rdd in (old, blocks):
        if rdd is not None:
            rdd.unpersist()
    return out


def _updated(binned: tuple[np.ndarray, ...]):
    def run(block: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
        bins, y, w, margin = block
        return bins, y, w, margin + binned[4][leaf_of(bins, *binned[:4])]
    return run


def score(model: BoostedTrees, rows: DataFrame, name: str) -> DataFrame:
    """``rows`` (with features) and a column ``name``: the probability of label 1."""
    shared = rows.sparkSession.sparkContext.broadcast(model)  # bounded by trees and leaves

    @F.pandas_udf("double")
    def probability(x: pd.Series) -> pd.Series:
        if not len(x):
            return pd.Series([], dtype="float64")
        return pd.Series(1 / (1 + np.exp(-shared.value.margin(np.stack(x.to_list())))))

    return rows.withColumn(name, probability(vector_to_array("features")))


# Shapley values.

@dataclass
class Path:
    """The conditions on the way to a leaf, one for each input: low < x <= high; ``pass_``: the share of training rows that pass without knowing it."""
    value: float
    input: np.ndarray
    low: np.ndarray
    high: np.ndarray
    pass_: np.ndarray


def leaf_paths(tree: Tree) -> list[Path]:
    out, stack = [], [(0, {})]
    while stack:
        node, met = stack.pop()
        if tree.left[node] < 0:
            out.append(Path(float(tree.value[node]), np.array(list(met), np.int64), *[np.array([m[k] for m in met.values()], float) for k in range(3)]))
            continue
        f, at = int(tree.input[node]), float(tree.at[node])
        for child, low, high in ((tree.left[node], -np.inf, at), (tree.right[node], at, np.inf)):
            old = met.get(f, (-np.inf, np.inf, 1.0))
            stack.append((int(child), met | {f: (max(old[0], low), min(old[1], high), old[2] * float(tree.cover[child] / tree.cover[node]))}))
    return out


def pattern_values(passed: np.ndarray, share: np.ndarray) -> np.ndarray:
    """(pattern, condition): each condition's Shapley value for a leaf of value 1. ``passed``: which conditions hold; ``share``: of rows, for unknown ones.

    The weight of all subsets of one size is a polynomial's coefficient: it is extended by every condition, and unwound
    by the one whose value is wanted.
    """
    n, d = passed.shape
    weight = np.zeros((d + 1, n))
    weight[0] = 1.0
    passed, share = np.ascontiguousarray(passed.T), share[:, None]
    one = passed.astype(float)
    for k in range(d):
        size = k + 1
        i = np.arange(size)[:, None]
        old = weight[:size].copy()
        weight[:size] = old * share[k] * (size - i) / (size + 1)
        weight[1:size + 1] += old * one[k] * (i + 1) / (size + 1)
    total, carry = np.zeros((d, n)), weight[d]
    for i in range(d - 1, -1, -1):  # unwound by each condition
        with_it = carry * (d + 1) / (i + 1)
        total += np.where(passed, with_it, weight[i] * (d + 1) / (share * (d - i)))
        carry = weight[i] - with_it * share * (d - i) / (d + 1)
    return (total * (one - share)).T


def expected_margin(model: BoostedTrees) -> float:
    """The margin with no input known: what Shapley values are measured from."""
    return model.base + sum(float((t.value * t.cover)[t.left < 0].sum() / t.cover[0]) for t in model.trees)


def shapley_values(model: BoostedTrees, x: np.ndarray) -> np.ndarray:
    """(row, input): exact path-dependent Shapley values of the margin; with ``expected_margin`` they add up to the margin."""
    out, columns = np.zeros((x.shape[1], len(x))), np.ascontiguousarray(x.T)
    for tree in model.trees:
        for p in leaf_paths(tree):
            if not len(p.input):
                continue
            code = np.zeros(len(x), np.int64)  # rows that pass the same conditions get the same values
            for k, f in enumerate(p.input):
                if k and k % 30 == 0:  # before the bits run out
                    code = np.unique(code, return_inverse=True)[1]
                held = (columns[f] > p.low[k]) & (columns[f] <= p.high[k])
                code = code * 2 + held
            if len(p.input) <= COUNTED_CONDITIONS:  # few patterns are counted, which needs no sort
                found = np.flatnonzero(np.bincount(code, minlength=1 << len(p.input)))
                place = np.zeros(1 << len(p.input), np.int64)
                place[found] = np.arange(len(found))
                of, passed = place[code], (found[:, None] >> np.arange(len(p.input))[::-1]) & 1 == 1
            else:
                _, first, of = np.unique(code, return_index=True, return_inverse=True)
                passed = ((columns[p.input][:, first] > p.low[:, None]) & (columns[p.input][:, first] <= p.high[:, None])).T
            values = np.ascontiguousarray((pattern_values(passed, p.pass_) * p.value).T)
            for k, f in enumerate(p.input):
                out[f] += values[k][of]
    return out.T
