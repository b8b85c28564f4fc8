"""Gradient-boosted trees for small feature matrices: fitted on a matrix or over a dataset, applied inside tasks.

Logistic loss, second-order splits over quantile bins, trees of a fixed depth stored as complete binary
trees in arrays, so that a forest is a few kilobytes to broadcast and scores a matrix in ``depth`` steps a tree.

A level of a tree needs only sums over the rows for each node, feature and bin. ``grow`` asks for these sums, so the
rows may be one matrix (``fit_block``) or the blocks of a Spark dataset (``fit_frame``), which never leave their
tasks. Derivatives are rounded to 2 ** -20, whose sums are exact in any order: the trees do not depend on the blocks.
``fit`` is the plain form for a small matrix, with interpolated quantiles and derivatives as they are.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BINS = 32
#: Trees after which the margins of a dataset's rows are kept anew.
KEEP_EVERY = 10
#: Rows of a block, and blocks' rows that a task of ``fit_frame`` works on at least.
BLOCK_ROWS = 20_000
_GRID = float(1 << 20)


class Forest(NamedTuple):
    feature: np.ndarray    # trees x inner nodes
    cut: np.ndarray        # trees x inner nodes: right if the value is greater
    leaf: np.ndarray       # trees x leaves
    start: float


def fit(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 32,
        least: float = 1.0, penalty: float = 1.0) -> Forest:
    """``least``: least sum of second derivatives on either side of a split."""
    rows, width = x.shape
    mean = (y.sum() + 0.5) / (rows + 1)
    start = float(np.log(mean / (1 - mean)))
    if not rows or not width:
        return Forest(*(np.zeros((0, 1)) for _ in range(3)), start)
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(width)]
    binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)])
    margin = np.full(rows, start)
    inner = (1 << depth) - 1
    feature, cut, leaf = np.zeros((trees, inner), np.int64), np.zeros((trees, inner)), np.zeros((trees, inner + 1))
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        grad, curve = p - y, np.maximum(p * (1 - p), 1e-9)
        node = np.zeros(rows, dtype=np.int64)
        for level in range(depth):
            nodes = 1 << level
            best = np.full(nodes, 1e-9)
            pick, at = np.zeros(nodes, np.int64), np.full(nodes, bins + 1)
            for j in range(width):
                slot = node * (bins + 1) + binned[j]
                g, h = (np.bincount(slot, v, nodes * (bins + 1)).reshape(nodes, -1) for v in (grad, curve))
                gl, hl = g.cumsum(axis=1)[:, :-1], h.cumsum(axis=1)[:, :-1]
                ga, ha = g.sum(axis=1, keepdims=True), h.sum(axis=1, keepdims=True)
                gain = gl ** 2 / (hl + penalty) + (ga - gl) ** 2 / (ha - hl + penalty) - ga ** 2 / (ha + penalty)
                gain[(hl < least) | (ha - hl < least)] = 0
                gain[:, len(cuts[j]):] = 0
                k = gain.argmax(axis=1)
                top = gain[np.arange(nodes), k]
                better = top > best
                best[better], pick[better], at[better] = top[better], j, k[better]
            first = nodes - 1
            feature[t, first:first + nodes] = pick
            cut[t, first:first + nodes] = [cuts[j][k] if k < len(cuts[j]) else np.inf
                                           for j, k in zip(pick, at, strict=True)]
            node = node * 2 + (binned[pick[node], np.arange(rows)] > at[node])
        g, h = np.bincount(node, grad, inner + 1), np.bincount(node, curve, inner + 1)
        leaf[t] = -rate * g / (h + penalty)
        margin += leaf[t][node]
    return Forest(feature, cut, leaf, start)


class Block(NamedTuple):
    group: str
    binned: np.ndarray     # features x rows, uint8
    label: np.ndarray
    margin: np.ndarray     # of the first ``trees`` trees
    trees: int


class Growing(NamedTuple):
    feature: np.ndarray
    bin: np.ndarray        # right if the value's bin is greater
    leaf: np.ndarray
    start: float


def _binned(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)]).astype(np.uint8)


def _node(binned: np.ndarray, forest: Growing, tree: int, level: int) -> np.ndarray:
    """Place of each row among the nodes of a level."""
    node = np.zeros(binned.shape[1], dtype=np.int64)
    row = np.arange(len(node))
    for above in range(level):
        at = (1 << above) - 1 + node
        node = node * 2 + (binned[forest.feature[tree][at], row] > forest.bin[tree][at])
    return node


def _advanced(block: Block, forest: Growing, trees: int, depth: int) -> Block:
    margin = block.margin
    for t in range(block.trees, trees):
        margin = margin + forest.leaf[t][_node(block.binned, forest, t, depth)]
    return block._replace(margin=margin, trees=trees)


def _sums(block: Block, forest: Growing, tree: int, level: int, depth: int) -> np.ndarray:
    """Sums of the first and second derivatives: 2 x features x nodes x bins."""
    margin = _advanced(block, forest, tree, depth).margin
    p = 1 / (1 + np.exp(-margin))
    parts = np.rint((p - block.label) * _GRID) / _GRID, np.maximum(np.rint(p * (1 - p) * _GRID), 1) / _GRID
    node, nodes = _node(block.binned, forest, tree, level) * (BINS + 1), 1 << level
    return np.stack([[np.bincount(node + own, v, nodes * (BINS + 1)).reshape(nodes, -1) for own in block.binned]
                     for v in parts])


def grow(total: Callable, keep: Callable, groups: dict[str, tuple[int, int, list[np.ndarray]]], trees: int = 60,
         depth: int = 3, rate: float = 0.2, least: float = 1.0, penalty: float = 1.0) -> dict[str, Forest]:
    """A forest for each group of rows, given their number, that of label 1, and the features' cuts. ``total`` gives
    each group's sums for a level of a tree, ``keep`` hears of a finished tree. ``least``: least sum of second
    derivatives on either side of a split."""
    inner = (1 << depth) - 1
    growing = {}
    for name, (rows, positive, _) in groups.items():
        mean = (positive + 0.5) / (rows + 1)
        growing[name] = Growing(np.zeros((trees, inner), np.int64), np.full((trees, inner), BINS + 1),
                                np.zeros((trees, inner + 1)), float(np.log(mean / (1 - mean))))
    for t in range(trees):
        for level in range(depth):
            found, nodes = total(growing, t, level, depth), 1 << level
            for name, forest in growing.items():
                best, pick, at = np.full(nodes, 1e-9), np.zeros(nodes, np.int64), np.full(nodes, BINS + 1)
                g, h = found[name]
                ga, ha = g[0].sum(axis=1), h[0].sum(axis=1)
                low_g, low_h = ga.copy(), ha.copy()  # of the rows that go left: all, where there is no split
                for j, cuts in enumerate(groups[name][2]):
                    gl, hl = g[j].cumsum(axis=1)[:, :-1], h[j].cumsum(axis=1)[:, :-1]
                    gr, hr = ga[:, None] - gl, ha[:, None] - hl
                    gain = gl ** 2 / (hl + penalty) + gr ** 2 / (hr + penalty) - (ga ** 2 / (ha + penalty))[:, None]
                    gain[(hl < least) | (hr < least)] = 0
                    gain[:, len(cuts):] = 0
                    k = gain.argmax(axis=1)
                    top, node = gain[np.arange(nodes), k], np.arange(nodes)
                    better = top > best
                    best[better], pick[better], at[better] = top[better], j, k[better]
                    low_g[better], low_h[better] = gl[node, k][better], hl[node, k][better]
                first = nodes - 1
                forest.feature[t, first:first + nodes], forest.bin[t, first:first + nodes] = pick, at
                if level == depth - 1:
                    forest.leaf[t, 0::2] = -rate * low_g / (low_h + penalty)
                    forest.leaf[t, 1::2] = -rate * (ga - low_g) / (ha - low_h + penalty)
        keep(growing, t + 1, depth)
    out = {}
    for name, forest in growing.items():
        cuts = groups[name][2]
        cut = np.array([[cuts[j][k] if k < len(cuts[j]) else np.inf for j, k in zip(*pair, strict=True)]
                        for pair in zip(forest.feature, forest.bin, strict=True)]).reshape(trees, inner)
        out[name] = Forest(forest.feature, cut, forest.leaf, forest.start)
    return out


def fit_block(x: np.ndarray, y: np.ndarray, trees: int = 60, **options) -> Forest:
    """What ``fit_frame`` finds, for rows at hand."""
    rows, width = x.shape
    if not rows or not width:
        mean = (y.sum() + 0.5) / (rows + 1)
        return Forest(*(np.zeros((0, 1)) for _ in range(3)), float(np.log(mean / (1 - mean))))
    places = np.linspace(0, 1, BINS + 1)[1:-1]
    cuts = [np.unique(np.quantile(x[:, j], places, method="inverted_cdf")) for j in range(width)]
    groups = {"": (rows, int(y.sum()), cuts)}
    mean = (groups[""][1] + 0.5) / (rows + 1)
    block = [Block("", _binned(x, cuts), y, np.full(rows, float(np.log(mean / (1 - mean)))), 0)]

    def keep(growing, done, depth):
        block[0] = _advanced(block[0], growing[""], done, depth)

    return grow(lambda growing, t, level, depth: {"": _sums(block[0], growing[""], t, level, depth)}, keep, groups,
                trees, **options)[""]


def cuts_of(rows: DataFrame) -> dict[str, list[np.ndarray]]:
    """For each ``group`` of ``rows`` and each of its ``features`` the values at the quantiles of ``BINS`` bins, exactly.
    Equal values are counted before they are put in order."""
    values = (rows.select("group", F.posexplode("features").alias("feature", "value"))
              .groupBy("group", "feature", "value").agg(F.count(F.lit(1)).alias("n")))
    whole = Window.partitionBy("group", "feature")
    upto = F.sum("n").over(whole.orderBy("value").rowsBetween(Window.unboundedPreceding, 0))
    values = values.select("group", "feature", "value", "n", upto.alias("upto"), F.sum("n").over(whole).alias("all"))
    # the value at place i of BINS is the first that i / BINS of the rows do not exceed
    passed = F.least(F.lit(BINS - 1), F.expr(f"upto * {BINS} div all")) > F.expr(f"(upto - n) * {BINS} div all")
    found = (values.groupBy("group", "feature").agg(F.sort_array(F.collect_list(F.when(passed, F.col("value")))).alias("cuts"))
             .orderBy("group", "feature").collect())  # less than BINS values each
    out: dict[str, list[np.ndarray]] = {}
    for r in found:
        out.setdefault(r["group"], []).append(np.array(r["cuts"], dtype=np.float64))
    return out


def fit_frame(rows: DataFrame, trees: int = 60, depth: int = 3, **options) -> dict[str, Forest]:
    """A forest for each ``group`` of ``rows`` (``group``, ``label`` boolean, ``features``), from all of them. Read three
    times and kept as bins; a level of all groups' trees is one job, of which each task gives sums of fixed size."""
    counts = {r["group"]: (r["n"], r["positive"]) for r in rows.groupBy("group").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("label").alias("positive")).collect()}
    cuts = cuts_of(rows)
    groups = {name: (*counts[name], cuts[name]) for name in sorted(counts)}
    if not groups:
        return {}
    context = rows.sparkSession.sparkContext
    shared = context.broadcast({name: (cut, float(np.log((p + 0.5) / (n + 0.5 - p)))) for name, (n, p, cut) in groups.items()})

    def packed(batches):
        for batch in batches:
            names = np.array(batch.column("group").to_pylist(), dtype=object)
            label = np.array(batch.column("label").to_pylist(), dtype=bool)
            lists = batch.column("features")
            x = lists.flatten().to_numpy(zero_copy_only=False).reshape(len(names), -1) if len(names) else None
            for name in sorted(set(names)):
                own = names == name
                binned = _binned(x[own], shared.value[name][0])
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([binned.tobytes()], pa.binary()),
                                                  pa.array([label[own].tobytes()], pa.binary())], names=["group", "binned", "label"])

    def block(row):
        label = np.frombuffer(row["label"], dtype=bool).astype(np.float64)
        return Block(row["group"], np.frombuffer(row["binned"], dtype=np.uint8).reshape(-1, len(label)), label,
                     np.full(len(label), shared.value[row["group"]][1]), 0)

    parts = max(1, sum(n for n, _ in counts.values()) // BLOCK_ROWS)
    blocks = rows.select("group", "label", "features").mapInArrow(packed, "group string, binned binary, label binary").rdd
    if parts < blocks.getNumPartitions():
        blocks = blocks.coalesce(parts)
    blocks = blocks.map(block)
    level_of = StorageLevel.MEMORY_AND_DISK
    kept = [blocks.persist(level_of)]

    def total(growing, t, level, depth):
        now = context.broadcast(growing)

        def sums(own):
            out = {}
            for b in own:
                s = _sums(b, now.value[b.group], t, level, depth)
                out[b.group] = out[b.group] + s if b.group in out else s
            return [out]

        found = kept[0].mapPartitions(sums).treeReduce(_together)
        now.unpersist()
        return found

    def keep(growing, done, depth):
        if done % KEEP_EVERY == 0 and done < trees:
            now, old = context.broadcast(growing), kept[0]
            kept[0] = old.map(lambda b: _advanced(b, now.value[b.group], done, depth)).persist(level_of)
            kept[0].count()
            old.unpersist()

    out = grow(total, keep, groups, trees, depth, **options)
    kept[0].unpersist()
    return out


def _together(a: dict[str, np.ndarray], b: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    return {k: a[k] + b[k] if k in a and k in b else a.get(k, b.get(k)) for k in {**a, **b}}


def predict(forest: Forest, x: np.ndarray) -> np.ndarray:
    """Probability of label 1 of each row."""
    margin = np.full(len(x), forest.start)
    row = np.arange(len(x))
    for feature, cut, leaf in zip(forest.feature, forest.cut, forest.leaf, strict=True):
        node = np.zeros(len(x), dtype=np.int64)
        while len(x) and node[0] < len(feature):
            node = 2 * node + 1 + (x[row, feature[node]] > cut[node])
        margin += leaf[node - len(feature)] if len(x) else 0
    return 1 / (1 + np.exp(-np.clip(margin, -50, 50)))
