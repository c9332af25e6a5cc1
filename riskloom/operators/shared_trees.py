"""Boosted trees of all folds, grown level by level in the same passes over binned rows."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.plans.materialize import delete, discard, materialize
from riskloom.session import shared_dir

#: Bins of an input at most and rows (by a hash of the id) whose values place their edges, both as the estimator does; widest vector; rows of a block.
BINS, EDGE_ROWS, MOST_INPUTS, BLOCK = 32, 20_000, 1024, 16384
#: Numbers that a task sums in one pass, rows of a task, and rounds after which the margins are checkpointed, so that their lineage stays short.
MOST_CELLS, TASK_ROWS, CHECKPOINT_EVERY = 1 << 20, 500_000, 25
#: Rows times inputs up to which each model is grown in one task.
ALONE = 1 << 26


@dataclass(frozen=True)
class Trees:
    """Boosting of the log loss by trees of at most `depth` levels that split by variance, each on a share `bag` of the rows, later trees weighted
    by `step`. A node looks at a share `columns` of the inputs."""

    trees: int
    depth: int
    columns: float
    min_rows: int
    bag: float
    step: float
    positive_weight: float = 1.0


def share_of(columns: str) -> float | None:
    """The share that a text such as "0.8" or "all" stands for; None for other strategies."""
    if columns == "all":
        return 1.0
    try:
        share = float(columns)
    except ValueError:
        return None
    return share if "." in columns and 0 < share <= 1 else None


def _leaf(x: np.ndarray, feature: np.ndarray, cut: np.ndarray, levels: int) -> np.ndarray:
    """Place of every column of `x` (inputs, rows) on a level of a tree; nodes are numbered from the root, the children of k being 2k + 1 and 2k + 2."""
    n, flat = x.shape[1], x.ravel()
    if not levels:
        return np.zeros(n, np.intp)
    own = np.arange(n)
    at = 1 + (x[feature[0]] > cut[0]).astype(np.intp)
    from_row = feature * n
    for _ in range(levels - 1):
        at = 2 * at + 1 + (flat.take(from_row.take(at) + own) > cut.take(at))
    return at - ((1 << levels) - 1)


class GrownTrees:
    """Trees as arrays (tree, node); a node that is not split sends every row left, so every row ends at one of 2**depth leaves."""

    def __init__(self, feature: np.ndarray, cut: np.ndarray, leaves: np.ndarray, weights: np.ndarray, gains: np.ndarray):
        self.feature, self.cut, self.leaves, self.weights, self.gains = feature, cut, leaves, weights, gains
        self.depth = leaves.shape[1].bit_length() - 1

    @property
    def featureImportances(self) -> DenseVector:
        """Mean over the trees of each input's share in the gain of a tree's splits, in all one."""
        each = self.gains.sum(axis=1, keepdims=True)
        share = np.divide(self.gains, each, out=np.zeros_like(self.gains), where=each > 0).sum(axis=0)
        return Vectors.dense(share / share.sum() if share.sum() else share)

    def leaf_tables(self) -> tuple[np.ndarray, np.ndarray]:
        """Leaf values of all trees in one array, times the weight of their tree, and the place at which each tree's leaves begin."""
        return (self.leaves * self.weights[:, None]).ravel(), np.arange(len(self.leaves)) * self.leaves.shape[1]

    def reached(self, vectors: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
        """(first row, leaves by row and tree) of parts of the rows, so that memory does not grow with rows x trees."""
        if not len(vectors):
            return
        x = vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), -1)
        for start in range(0, len(x), 1024):
            part = np.ascontiguousarray(x[start : start + 1024].T)
            yield start, np.stack([_leaf(part, f, c, self.depth) for f, c in zip(self.feature, self.cut)], axis=1)

    def transform(self, df: DataFrame) -> DataFrame:
        """`df` and `probability`, a vector of the two labels' probabilities."""
        values, starts = self.leaf_tables()

        @F.arrow_udf("double")
        def positive(vectors: pa.Array) -> pa.Array:
            margin = np.zeros(len(vectors))
            for start, at in self.reached(vectors):
                margin[start : start + len(at)] = values[starts + at].sum(axis=1)
            return pa.array(1.0 / (1.0 + np.exp(np.clip(-2.0 * margin, -700, 700))))

        p = positive(vector_to_array("features"))
        return df.withColumn("_p", p).withColumn("probability", array_to_vector(F.array(1.0 - F.col("_p"), F.col("_p")))).drop("_p")


class _Layout:
    """Where the cells of an input's bins lie: for each node and bin the rows by label, then the sums of the residuals. Inputs of one size lie together."""

    def __init__(self, bins: Sequence[int]):
        self.inputs = len(bins)
        sizes = [1 << (max(2, b) - 1).bit_length() for b in bins]  # few sizes, so that rows are placed once for each
        self.groups = [(size, [i for i, s in enumerate(sizes) if s == size]) for size in sorted(set(sizes))]
        self.cells = sum(size * len(members) for size, members in self.groups) * 4

    def add(self, total: np.ndarray, x: np.ndarray, slot: np.ndarray, y: np.ndarray, residual: np.ndarray, slots: int) -> None:
        """Add rows to the cells; those in the slot behind the last one belong to no asked node."""
        at = 0
        for size, members in self.groups:
            base, m = (2 * slot + y) * size, (slots + 1) * 2 * size
            kept = slots * 2 * size
            for i in members:
                key = base + x[i]
                total[at : at + kept] += np.bincount(key, minlength=m)[:kept]
                total[at + kept : at + 2 * kept] += np.bincount(key, residual, m)[:kept]
                at += 2 * kept

    def tables(self, total: np.ndarray, slots: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(inputs, rows by input, node, label and bin, summed residuals by input, node and bin) for each size of inputs."""
        at = 0
        for size, members in self.groups:
            m = slots * 2 * size * 2 * len(members)
            both = total[at : at + m].reshape(len(members), 2, slots, 2, size)
            at += m
            yield np.array(members), both[:, 0], both[:, 1].sum(axis=2)


class _Growing:
    """One tree of one model while it grows; cuts are bin numbers."""

    def __init__(self, model: int, tree: int, seed: int, spec: Trees, inputs: int):
        self.model, self.tree, self.seed, self.spec = model, tree, seed, spec
        nodes = (2 << spec.depth) - 1
        self.feature, self.cut, self.value = np.zeros(nodes, np.intp), np.full(nodes, BINS, np.uint8), np.zeros(nodes)
        self.open, self.gains = [0], np.zeros(inputs)

    def take(self, nodes: Sequence[int], sums: np.ndarray, layout: _Layout) -> None:
        """Split `nodes` of one level by their summed cells where that lowers the variance."""
        spec, k = self.spec, len(nodes)
        picked = max(1, ceil(spec.columns * layout.inputs))
        asked = np.random.default_rng((self.tree, self.seed, nodes[0])).random((k, layout.inputs)).argsort(axis=1).argsort(axis=1) < picked
        best: list[tuple | None] = [None] * k
        for members, counts, s in layout.tables(sums, k):
            n, w = counts.sum(axis=2), counts[:, :, 0] + spec.positive_weight * counts[:, :, 1]
            left_n, left_w, left_s = (v.cumsum(axis=2) for v in (n, w, s))
            all_n, all_w, all_s = (v[:, :, -1:] for v in (left_n, left_w, left_s))
            if nodes[0] == 0:
                self.value[0] = all_s[0, 0, 0] / all_w[0, 0, 0] if all_w[0, 0, 0] else 0.0
            right_n, right_w, right_s = all_n - left_n, all_w - left_w, all_s - left_s
            fits = (np.minimum(left_n, right_n) >= max(1, spec.min_rows)) & asked.T[members][:, :, None]
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(fits, left_s**2 / left_w + right_s**2 / right_w - all_s**2 / all_w, -np.inf)
            places = gain.transpose(1, 0, 2).reshape(k, -1).argmax(axis=1)
            for i, place in enumerate(places.tolist()):
                f, at = divmod(place, gain.shape[2])
                found = gain[f, i, at]
                if found > (best[i][0] if best[i] else 1e-12 * all_w[f, i, 0]):
                    sides = ((left_s[f, i, at] / left_w[f, i, at], left_n[f, i, at]), (right_s[f, i, at] / right_w[f, i, at], right_n[f, i, at]))
                    best[i] = (found, members[f], at, sides)
        for node, found in zip(nodes, best):
            if found is not None:
                gain, self.feature[node], self.cut[node], sides = found
                self.gains[found[1]] += gain
                for child, (value, n) in zip((2 * node + 1, 2 * node + 2), sides):
                    self.value[child] = value
                    if n >= 2 * max(1, spec.min_rows) and 2 * child + 1 < len(self.feature):
                        self.open.append(child)

    def finish(self) -> None:
        """Values of nodes that are not split go down to the last level."""
        for node in range(len(self.value) // 2):
            if self.cut[node] == BINS:
                self.value[2 * node + 1 : 2 * node + 3] = self.value[node]

    @property
    def leaves(self) -> np.ndarray:
        return self.value[len(self.value) // 2 :]


def _edges(values: np.ndarray) -> np.ndarray:
    """At most BINS - 1 edges between values, each half way to the next value."""
    distinct = np.unique(values)
    if len(distinct) > BINS:
        ranks = np.sort(values)[(np.arange(1, BINS) * len(values)) // BINS]
        at = np.unique(np.searchsorted(distinct, ranks))
        at = at[at > 0]
    else:
        at = np.arange(1, len(distinct))
    return (distinct[at - 1] + distinct[at]) / 2


def _draw(hashes: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """16 even bits per row, drawn by the row's hash, the tree and the model's seed, whatever the partitions."""
    a, b = np.random.default_rng((tree, seed, 7)).integers(0, 1 << 63, 2, np.uint64)
    z = (hashes ^ b) * (2 * a + np.uint64(1))
    z ^= z >> np.uint64(32)
    z *= np.uint64(0x9E3779B97F4A7C15)
    return z >> np.uint64(48)


@dataclass
class Block:
    """Rows of one fold: bins by view, input and row; labels; hashes of the ids; margins by model and row. Views and margins of a model that does not
    see the fold are left out."""

    fold: int
    x: np.ndarray
    y: np.ndarray
    h: np.ndarray
    margin: np.ndarray


def _parts(rows: int, slots: int) -> int:
    """Tasks of a pass: one per slot, more of them for many rows, fewer for few."""
    return min(slots, ceil(rows / BLOCK)) if rows <= slots * TASK_ROWS else slots * ceil(rows / (slots * TASK_ROWS))


def binned_blocks(
    rows: DataFrame, views: Sequence[Callable[[DataFrame], DataFrame]], held: Sequence[int | None], label: str, fold: str, id: str, n: int, models: Sequence[int | None],
) -> tuple[RDD, list[list[np.ndarray]], DataFrame] | None:
    """Blocks of rows with every input as a bin number, the edges of the bins by view, and the written table behind the blocks; None if vectors are too
    wide or values unknown.

    A view gives the rows `features` that may depend on the fold. Like the estimator's, edges come from a bounded number of rows, here those with the
    smallest hashes of the id, outside the view's fold `held` (None: a view of several models, edges from any fold); all rows are binned and counted.
    """
    wide = rows.withColumn("_grown_id", F.xxhash64(id))
    for v, view in enumerate(views):
        kept = [F.col(f"`{c}`") for c in wide.columns]
        wide = view(wide).select(*kept, vector_to_array("features").alias(f"_grown_x{v}"))
    xs = [f"_grown_x{v}" for v in range(len(views))]
    wide = wide.select(F.col(label).cast("int").alias("_y"), F.col(fold).cast("int").alias("_f"), F.col("_grown_id").alias("_h"), *xs)
    first = wide.first()
    inputs = len(first[xs[0]])
    if not 0 < inputs <= MOST_INPUTS:
        return None
    few = min(EDGE_ROWS, max(1024, (1 << 23) // (inputs * len(views))))
    least = int(-(2**63) + min(1.0, few / n) * (2**64 - 1)) if n > few else 2**63 - 1
    taken = wide.where(F.col("_h") <= least).select("_f", *xs).toArrow()
    folds = taken.column("_f").to_numpy()
    values = [taken.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(folds), -1) for c in xs]
    if not len(folds) or not all(np.isfinite(v).all() for v in values):
        return None
    edges = []
    for v, j in zip(values, held):
        outside = v[folds != j] if j is not None and (folds != j).any() else v
        edges.append([_edges(column) for column in outside.T])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            f = batch.column("_f").to_numpy()
            for j in np.unique(f):
                mine = batch.filter(pa.array(f == j))
                for start in range(0, mine.num_rows, BLOCK):
                    part = mine.slice(start, BLOCK)
                    x = np.empty((len(xs), inputs, part.num_rows), np.uint8)
                    for v, c in enumerate(xs):
                        dense = part.column(c).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, inputs)
                        for i, cuts in enumerate(edges[v]):
                            x[v, i] = np.searchsorted(cuts, dense[:, i])
                    y, h = part.column("_y").to_numpy().astype(np.uint8), part.column("_h").to_numpy()
                    columns = [pa.array([int(j)], pa.int32()), *[pa.array([b.tobytes()], pa.binary()) for b in (x, y, h)]]
                    yield pa.RecordBatch.from_arrays(columns, names=["f", "x", "y", "h"])

    parts = _parts(n, rows.sparkSession.sparkContext.defaultParallelism)
    table = materialize(wide.mapInArrow(run, "f int, x binary, y binary, h binary").repartition(parts), "binned")
    count = len(xs)

    def block(row) -> Block:
        y, h = np.frombuffer(row["y"], np.uint8), np.frombuffer(row["h"], np.uint64)
        x = np.frombuffer(row["x"], np.uint8).reshape(count, inputs, len(y))
        seeing = [k for k, j in enumerate(models) if j is None or j != row["f"]]
        return Block(row["f"], x if count == 1 else x[seeing], y, h, np.zeros((len(seeing), len(y))))

    return table.coalesce(parts).rdd.map(block), edges, table


def _asked(growing: Sequence[_Growing], layout: _Layout) -> Iterator[list[tuple[_Growing, list[int]]]]:
    """The open nodes of all growing trees, dealt out to passes that sum at most MOST_CELLS numbers (one node at least)."""
    most = max(1, MOST_CELLS // layout.cells)
    part, free = [], most
    for g in growing:
        nodes, g.open = g.open, []
        while nodes:
            if not free:
                yield part
                part, free = [], most
            part.append((g, nodes[:free]))
            nodes, free = nodes[free:], free - len(part[-1][1])
    if part:
        yield part


def _pass(kept: _Kept | _Here, asked: Sequence[tuple[_Growing, list[int]]], layout: _Layout, spec: Trees, held: Sequence[int | None]) -> list[np.ndarray]:
    """Summed cells of the asked nodes, from one pass over all blocks."""
    level = (asked[0][1][0] + 1).bit_length() - 1
    trees = []
    for g, nodes in asked:
        spot = np.full(1 << level, len(nodes), np.intp)
        spot[np.array(nodes) - ((1 << level) - 1)] = np.arange(len(nodes))
        trees.append((g.model, g.tree, g.seed, g.feature[: (1 << level) - 1], g.cut[: (1 << level) - 1], spot, len(nodes)))

    def run(part: Iterable[Block]) -> Iterator[list[np.ndarray]]:
        totals = [np.zeros(layout.cells * t[-1]) for t in trees]
        for b in part:
            seeing = [k for k, j in enumerate(held) if j is None or j != b.fold]
            label = b.y.astype(np.intp)
            sign = 2.0 * label - 1.0
            pull = sign * np.where(label == 1, spec.positive_weight, 1.0)
            for i, (model, tree, seed, feature, cut, spot, slots) in enumerate(trees):
                if model not in seeing:
                    continue
                place = seeing.index(model)
                x = b.x[place if len(b.x) > 1 else 0]
                slot = spot.take(_leaf(x, feature, cut, level))
                if spec.bag < 1:
                    slot[_draw(b.h, tree, seed) >= int(spec.bag * (1 << 16))] = slots
                residual = pull if not tree else pull * 4.0 / (1.0 + np.exp(np.clip(2.0 * sign * b.margin[place], -700, 700)))
                layout.add(totals[i], x, slot, label, residual, slots)
        yield totals

    found: list[np.ndarray] | None = None
    for totals in kept.asked(run):  # a list per task
        found = totals if found is None else [a + b for a, b in zip(found, totals)]
    return found


def _raise(grown: Sequence[tuple], held: Sequence[int | None]) -> Callable[[Block], Block]:
    """Gives a block the margins after one more tree of each model (feature, cut, leaves times weight)."""

    def add(b: Block) -> Block:
        seeing = [k for k, j in enumerate(held) if j is None or j != b.fold]
        margin = np.empty_like(b.margin)
        for place, k in enumerate(seeing):
            feature, cut, leaves = grown[k]
            margin[place] = b.margin[place] + leaves.take(_leaf(b.x[place if len(b.x) > 1 else 0], feature, cut, len(leaves).bit_length() - 1))
        return Block(b.fold, b.x, b.y, b.h, margin)

    return add


class _Here:
    """Blocks of one model in the task that grows it."""

    def __init__(self, blocks: Sequence[Block]):
        self.blocks = blocks

    def asked(self, run: Callable) -> list:
        return list(run(self.blocks))

    def replace(self, change: Callable[[Block], Block]) -> None:
        self.blocks = [change(b) for b in self.blocks]


class _Kept:
    """Blocks of all models, held in memory as far as there is room; every few rounds a checkpoint cuts their lineage and the one before is deleted."""

    def __init__(self, spark: SparkSession, blocks: RDD):
        self.spark, self.now, self.old, self.rounds, self.file = spark, blocks.persist(StorageLevel.MEMORY_AND_DISK), None, 0, None
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(shared_dir(spark))

    def replace(self, change: Callable[[Block], Block]) -> None:
        """The new blocks are made by the next pass, after which the old ones go."""
        self.rounds += 1
        self.old, self.now = self.now, self.now.map(change).persist(StorageLevel.MEMORY_AND_DISK)
        if self.rounds % CHECKPOINT_EVERY == 0:
            self.now.checkpoint()

    def asked(self, run: Callable) -> list:
        found = self.now.mapPartitions(run).collect()
        if self.old is not None:
            self.old.unpersist()
            self.old = None
            if self.rounds % CHECKPOINT_EVERY == 0:
                last, self.file = self.file, self.now.getCheckpointFile()
                if last:
                    delete(self.spark, last)
        return found

    def end(self) -> None:
        for blocks in (self.old, self.now):
            if blocks is not None:
                blocks.unpersist()
        if self.file:
            delete(self.spark, self.file)


def _boost(kept: _Kept | _Here, layout: _Layout, spec: Trees, held: Sequence[int | None], seeds: Sequence[int]) -> list[list[_Growing]]:
    """The trees of each model."""
    grown: list[list[_Growing]] = [[] for _ in held]
    for t in range(spec.trees):
        if t:
            weight = spec.step if t > 1 else 1.0
            kept.replace(_raise([(g[-1].feature, g[-1].cut, g[-1].leaves * weight) for g in grown], held))
        new = [_Growing(k, t, seed, spec, layout.inputs) for k, seed in enumerate(seeds)]
        for _ in range(spec.depth):
            for asked in list(_asked(new, layout)):
                for (g, nodes), sums in zip(asked, _pass(kept, asked, layout, spec, held)):
                    g.take(nodes, sums, layout)
        for g in new:
            g.finish()
            grown[g.model].append(g)
    return grown


def _merged(blocks: Sequence[Block]) -> list[Block]:
    """The same rows of one model in blocks of about BLOCK."""
    blocks = sorted(blocks, key=lambda b: (b.fold, b.h.tolist()[:1]))  # whatever the order in which they come
    out, at = [], 0
    while at < len(blocks):
        part, size = [], 0
        while at < len(blocks) and (not part or size + len(blocks[at].y) <= BLOCK):
            part.append(blocks[at])
            size += len(blocks[at].y)
            at += 1
        x, margin = (np.concatenate([getattr(b, c) for b in part], axis=-1) for c in ("x", "margin"))
        y, h = (np.concatenate([getattr(b, c) for b in part]) for c in ("y", "h"))
        out.append(Block(-1, x, y, h, margin))
    return out


def _boost_alone(blocks: RDD, layout: _Layout, spec: Trees, held: Sequence[int | None]) -> list[list[_Growing]]:
    """The trees of each model, grown in a task of its own: for few rows, where a pass costs more in starting tasks than in work."""

    def own(b: Block) -> Iterator[tuple[int, Block]]:
        seeing = [k for k, j in enumerate(held) if j is None or j != b.fold]
        for place, k in enumerate(seeing):
            at = place if len(b.x) > 1 else 0
            yield k, Block(b.fold, b.x[at : at + 1], b.y, b.h, b.margin[place : place + 1])

    def run(part: Iterator[tuple[int, Block]]) -> Iterator[tuple[int, list[_Growing]]]:
        mine: dict[int, list[Block]] = {}
        for k, b in part:
            mine.setdefault(k, []).append(b)
        for k, found in mine.items():
            yield k, _boost(_Here(_merged(found)), layout, spec, [None], [k])[0]

    grown = dict(blocks.flatMap(own).partitionBy(len(held), int).mapPartitions(run).collect())
    return [grown[k] for k in range(len(held))]


def grow(blocks: RDD, edges: list[list[np.ndarray]], table: DataFrame, rows: int, spec: Trees, held: Sequence[int | None]) -> list[GrownTrees]:
    """A model per entry of `held`, the fold that it does not see (None: it sees all rows). There is a view per model, or one for all."""
    inputs = len(edges[0])
    layout = _Layout([1 + max(len(view[i]) for view in edges) for i in range(inputs)])
    weights = np.concatenate(([1.0], np.full(spec.trees - 1, spec.step)))
    if rows * inputs <= ALONE:
        grown = _boost_alone(blocks, layout, spec, held)
    else:
        kept = _Kept(table.sparkSession, blocks)
        try:
            grown = _boost(kept, layout, spec, held, range(len(held)))
        finally:
            kept.end()
    discard(table)

    def model(k: int) -> GrownTrees:
        cuts = edges[k if len(edges) > 1 else 0]
        real = [[cuts[f][c] if c < len(cuts[f]) else np.inf for f, c in zip(g.feature, g.cut)] for g in grown[k]]
        return GrownTrees(np.stack([g.feature for g in grown[k]]), np.array(real), np.stack([g.leaves for g in grown[k]]), weights, np.stack([g.gains for g in grown[k]]))

    return [model(k) for k in range(len(held))]
