"""Random forest over many rows, by the rules of MLlib's: features in at most 32 bins, a Poisson(1) draw for each row and tree, a random
set of features for each node, the best Gini gain, sibling leaves of one class joined. The result is a model of MLlib's class.

Rows are binned once. Neighbours with equal bins and label become a run, whose draw is Poisson(its rows): the sum of its rows' own
draws. Every tree gets a level deeper in one pass, in which a task adds up the counts of a node, feature, bin and class in arrays."""

from __future__ import annotations

import math
import sys
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetpulse.session import materialize, use_checkpoint_dir

MAX_BINS = 32
#: Rows the split points come from, on average.
SAMPLE_ROWS = 10_000
LONGEST_RUN = 16
BLOCK_ROWS = 1 << 19
#: Runs counted at a time, so that their cells stay in the processor's cache.
PIECE = 1 << 15
REDRAW = 255
LEAST_IMPURITY = 2.0**-52

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no install


# ---- bins and runs ----


def thresholds(values: np.ndarray, weights: np.ndarray, most: int) -> np.ndarray:
    """Split points midway between distinct values: all of them, or those next to equal shares of the weight."""
    distinct, place = np.unique(values, return_inverse=True)
    middles = (distinct[1:] + distinct[:-1]) / 2
    if len(middles) <= most:
        return middles
    reached = np.cumsum(np.bincount(place, weights))
    stride = target = reached[-1] / (most + 1)
    chosen = []
    for i in range(len(middles)):
        if abs(reached[i] - target) < abs(reached[i + 1] - target):
            chosen.append(i)
            target += stride
    return middles[chosen]


def run_starts(bins: np.ndarray, label: np.ndarray) -> np.ndarray:
    """First rows of the runs of equal bins and label, of LONGEST_RUN rows at most."""
    new = np.ones(len(label), bool)
    new[1:] = label[1:] != label[:-1]
    for row in bins:
        new[1:] |= row[1:] != row[:-1]
    first = np.flatnonzero(new)
    at = np.arange(len(label)) - np.repeat(first, np.diff(first, append=len(label)))
    return np.flatnonzero(at % LONGEST_RUN == 0)


def checked(column: pa.ChunkedArray | pa.Array, name: str) -> np.ndarray:
    values = column.to_numpy(zero_copy_only=False)
    if column.null_count or not np.isfinite(values).all():
        raise ValueError(f"{name} has nulls, NaN or infinite values")
    return values


PACKED = "block long, runs long, weights map<long, double>, data binary"


def packed(cuts: Sequence[np.ndarray], names: Sequence[str]):
    """Batches of features, label and weight, as blocks of runs: bins by feature, label and rows of each run, compressed; and the
    weight of each class, which must be the same in all its rows."""
    types = pa.schema([("block", pa.int64()), ("runs", pa.int64()), ("weights", pa.map_(pa.int64(), pa.float64())), ("data", pa.binary())])

    def block(number: int, parts: list[np.ndarray], weights: dict[int, float]) -> pa.RecordBatch:
        rows = np.concatenate(parts, axis=1)
        start = run_starts(rows[:-1], rows[-1])
        sizes = np.diff(start, append=rows.shape[1]).astype(np.uint8)
        data = pa.compress(np.vstack([rows[:, start], sizes]).tobytes(), "zstd", asbytes=True)
        row = {"block": number, "runs": len(start), "weights": list(weights.items()), "data": data}
        return pa.RecordBatch.from_pylist([row], types)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, parts, held, weights = TaskContext.get().partitionId() << 32, [], 0, {}
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                piece = batch.slice(at, BLOCK_ROWS)
                label, weight = (checked(piece.column(len(cuts) + i), names[len(cuts) + i]) for i in range(2))
                if ((label < 0) | (label != np.floor(label)) | (label > 99)).any():
                    raise ValueError(f"{names[len(cuts)]} must be whole numbers from 0 to 99")
                classes, first, of = np.unique(label.astype(int), return_index=True, return_inverse=True)
                if any(weights.setdefault(int(c), float(w)) != w for c, w in zip(classes, weight[first], strict=True)) or (weight != weight[first][of]).any():
                    raise ValueError(f"{names[-1]} must be the same in all rows of a class")
                values = (checked(piece.column(i), names[i]) for i in range(len(cuts)))
                bins = [np.searchsorted(cut, v).astype(np.uint8) for cut, v in zip(cuts, values, strict=True)]
                if parts and held + len(label) > BLOCK_ROWS:
                    yield block(number, parts, weights)
                    number, parts, held = number + 1, [], 0
                parts.append(np.vstack([*bins, label.astype(np.uint8)]))
                held += len(label)
        if parts:
            yield block(number, parts, weights)

    return pack


def unpacked(data: bytes, runs: int, features: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rows = np.frombuffer(pa.decompress(data, (features + 2) * runs, "zstd", asbytes=True), np.uint8).reshape(features + 2, runs)
    return rows[:-2], rows[-2], rows[-1]


# ---- draws ----


def poisson_tables() -> tuple[np.ndarray, np.ndarray]:
    """Cumulated shares of 0, 1, ... by run length; and the value of each 16-bit number, REDRAW where more than one is possible."""
    k = np.arange(100)
    logs = np.cumsum(np.log(np.maximum(k, 1)))
    shares = np.cumsum([np.exp(k * math.log(m) - m - logs) for m in range(1, LONGEST_RUN + 1)], axis=1)
    edges = np.arange(65537) / 65536
    low = np.array([np.searchsorted(c, edges[:-1], "right") for c in shares])
    high = np.array([np.searchsorted(c, edges[1:], "left") for c in shares])
    return shares, np.where(low == high, low, REDRAW).astype(np.uint8).ravel()


def draws(sizes: np.ndarray, tables: tuple[np.ndarray, np.ndarray], *seed: int) -> np.ndarray:
    """How often each run's rows are drawn, all together. sizes: rows of each run, as int64."""
    shares, table = tables
    source = np.random.Generator(np.random.SFC64(seed))
    number = source.integers(0, 1 << 64, (len(sizes) + 3) // 4, dtype=np.uint64).view(np.uint16)[: len(sizes)]
    out = table.take(((sizes - 1) << 16) + number, mode="wrap")
    again = np.flatnonzero(out == REDRAW)
    exact = (number[again] + source.random(len(again))) / 65536
    for size in np.unique(sizes[again]):
        some = sizes[again] == size
        out[again[some]] = np.searchsorted(shares[size - 1], exact[some], "right")
    return out


# ---- trees ----


@dataclass
class Tree:
    """Nodes are numbered by place: the children of n are 2 n + 1 and 2 n + 2."""

    splits: dict[int, tuple[int, int]] = field(default_factory=dict)  # feature, last bin that goes left
    counts: dict[int, np.ndarray] = field(default_factory=dict)  # rows drawn of each class
    gains: dict[int, float] = field(default_factory=dict)
    open: dict[int, np.ndarray] = field(default_factory=dict)  # nodes of the level, with the features they may split by


def impurity(weights: np.ndarray) -> np.ndarray:
    """Gini, over the last axis; 0 without weight."""
    whole = weights.sum(-1)
    with np.errstate(invalid="ignore", divide="ignore"):
        return np.where(whole > 0, 1.0 - ((weights / whole[..., None]) ** 2).sum(-1), 0.0)


def node_features(seed: int, tree: int, node: int, features: int) -> np.ndarray:
    some = math.ceil(math.sqrt(features))
    return np.random.Generator(np.random.PCG64([seed, 1, tree, node])).choice(features, some, replace=False)


def add_counts(into: np.ndarray, cells: np.ndarray, chosen: np.ndarray, at: np.ndarray, drawn: np.ndarray) -> None:
    """Adds up the draws of the runs at by chosen feature and cell. Stretches of one cell, long where values change slowly, are added
    at once, as differences of running sums."""
    some, width = into.shape
    values, last = np.empty((some, len(at)), cells.dtype), np.ones((some, len(at)), bool)
    for out, f in zip(values, chosen, strict=True):
        cells[f].take(at, out=out, mode="wrap")
    np.not_equal(values[:, 1:], values[:, :-1], out=last[:, :-1])
    reached = np.cumsum(drawn.take(at, mode="wrap"), dtype=np.int64)
    ends = np.flatnonzero(last)
    k = np.arange(some).repeat(np.count_nonzero(last, axis=1))
    sums = reached.take(ends - k * len(at), mode="wrap") + k * reached[-1]
    sums[1:] -= sums[:-1].copy()
    into += np.bincount(values.ravel().take(ends, mode="wrap") + k * width, sums, into.size).reshape(into.shape)


def level_sums(rows: Iterator, trees: list[Tree], features: int, classes: int, seed: int) -> Iterator[tuple[int, np.ndarray]]:
    """Of each tree with open nodes, the draws by open node, its features, bin and class."""
    tables = poisson_tables()
    sums = {t: [np.zeros((len(chosen), MAX_BINS * classes)) for chosen in tree.open.values()] for t, tree in enumerate(trees) if tree.open}
    for row in rows:
        bins, label, sizes = unpacked(row["data"], row["runs"], features)
        cells = bins.astype(np.uint8 if MAX_BINS * classes <= 256 else np.uint16) * classes + label
        sizes = sizes.astype(np.int64)
        for t, into in sums.items():
            tree = trees[t]
            drawn = draws(sizes, tables, seed, 0, row["block"], t)
            slots = {node: k for k, node in enumerate(tree.open)}
            todo = [(0, np.flatnonzero(drawn != 0))]
            while todo:
                node, at = todo.pop()
                if not len(at):
                    continue
                if node in slots:
                    for i in range(0, len(at), PIECE):
                        add_counts(into[slots[node]], cells, tree.open[node], at[i : i + PIECE], drawn)
                elif node in tree.splits:
                    f, last = tree.splits[node]
                    left = bins[f].take(at, mode="wrap") <= last
                    todo += [(2 * node + 1, at[left]), (2 * node + 2, at[~left])]
    for t, into in sums.items():
        yield t, np.stack(into)


def best_splits(sums: np.ndarray, chosen: np.ndarray, cuts: Sequence[int], weights: np.ndarray) -> list[tuple]:
    """Of each node: its counts, the best gain, and the feature, bin and counts on the left of that split. sums: by node, chosen feature,
    bin and class; cuts: a feature's split points. Of equal gains the first chosen feature and the least bin wins."""
    left = sums.cumsum(2)
    whole, left = left[:, :, -1:], left[:, :, :-1]
    right = whole - left
    lw, rw, ww = left * weights, right * weights, whole * weights
    share = lw.sum(-1) / np.maximum(ww.sum(-1), np.finfo(float).tiny)
    gain = impurity(ww) - share * impurity(lw) - (1 - share) * impurity(rw)
    real = np.arange(gain.shape[2]) < np.asarray(cuts)[chosen][:, :, None]
    gain = np.where(real & (left.sum(-1) > 0) & (right.sum(-1) > 0), gain, -np.inf)
    out = []
    for node, flat in enumerate(gain.reshape(len(gain), -1)):
        k, last = divmod(int(flat.argmax()), gain.shape[2])
        out.append((whole[node, 0, 0], float(gain[node, k, last]), int(chosen[node, k]), last, left[node, k, last]))
    return out


def grow(blocks: DataFrame, cuts: list[np.ndarray], weights: np.ndarray, trees: int, depth: int, seed: int) -> list[Tree]:
    """A pass over the blocks for each level. The driver holds the trees, whose size does not depend on the rows."""
    features, classes, sizes = len(cuts), len(weights), [len(cut) for cut in cuts]
    forest = [Tree(open={0: node_features(seed, t, 0, features)}) for t in range(trees)]
    parts = max(1, min(trees, 2 * blocks.sparkSession.sparkContext.defaultParallelism))
    for level in range(depth):
        if not any(tree.open for tree in forest):
            break
        now = [Tree(splits=tree.splits, open=tree.open) for tree in forest]

        def best(item, now=now):
            chosen = np.array(list(now[item[0]].open.values()))
            return item[0], best_splits(item[1].reshape(*chosen.shape, MAX_BINS, classes), chosen, sizes, weights)

        added = blocks.rdd.mapPartitions(lambda rows, now=now: level_sums(rows, now, features, classes, seed)).reduceByKey(np.add, parts)
        for t, found in added.map(best).collect():
            tree, nodes = forest[t], list(forest[t].open)
            tree.open = {}
            for node, (counts, gain, feature, last, left) in zip(nodes, found, strict=True):
                tree.counts[node] = counts
                if gain <= 0:
                    continue
                tree.splits[node], tree.gains[node] = (feature, last), gain
                for child, own in ((2 * node + 1, left), (2 * node + 2, counts - left)):
                    tree.counts[child] = own
                    if level + 1 < depth and impurity(own * weights) >= LEAST_IMPURITY:
                        tree.open[child] = node_features(seed, t, child, features)
    return forest


def stored_nodes(tree: Tree, cuts: Sequence[np.ndarray], weights: np.ndarray) -> list[dict]:
    """Nodes from the root down, left before right, as MLlib stores them; two leaves of one class become one leaf."""

    def kept(node: int) -> dict:
        stats = tree.counts[node] * weights
        own = {"node": node, "class": int(stats.argmax()), "stats": stats, "below": None}
        if node in tree.splits:
            below = kept(2 * node + 1), kept(2 * node + 2)
            if any(x["below"] for x in below) or below[0]["class"] != below[1]["class"]:
                own["below"] = below
        return own

    out: list[dict] = []

    def number(own: dict) -> int:
        at, node = len(out), own["node"]
        row = {"id": at, "prediction": float(own["class"]), "impurity": float(impurity(own["stats"])), "impurityStats": own["stats"].tolist()}
        out.append(row | {"rawCount": int(tree.counts[node].sum()), "gain": -1.0, "leftChild": -1, "rightChild": -1})
        out[at]["split"] = {"featureIndex": -1, "leftCategoriesOrThreshold": [], "numCategories": -1}
        if own["below"]:
            feature, last = tree.splits[node]
            out[at]["split"] = {"featureIndex": feature, "leftCategoriesOrThreshold": [float(cuts[feature][last])], "numCategories": -1}
            out[at] |= {"gain": tree.gains[node], "leftChild": number(own["below"][0])}
            out[at]["rightChild"] = number(own["below"][1])
        return at

    number(kept(0))
    return out


def as_model(forest: list[Tree], cuts: list[np.ndarray], weights: np.ndarray, settings: RandomForestClassifier, like: DataFrame) -> RandomForestClassificationModel:
    """MLlib has no public way to make a model of given nodes but to load one: a forest of single leaves with these settings is stored,
    its nodes are replaced, and it is loaded."""
    spark = like.sparkSession
    use_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/trees-{uuid.uuid4()}"
    zero = Vectors.sparse(len(cuts), [], [])
    bare = [(zero, float(c), 1.0) for c in range(len(weights))]
    columns = [settings.getFeaturesCol(), settings.getLabelCol(), settings.getWeightCol()]
    settings.fit(spark.createDataFrame(bare, columns).coalesce(1)).write().save(folder)
    schema = spark.read.parquet(f"{folder}/data").schema
    rows = [{"treeID": t, "nodeData": row} for t, tree in enumerate(forest) for row in stored_nodes(tree, cuts, weights)]
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(f"{folder}/data")
    return RandomForestClassificationModel.load(folder)


def fit(train: DataFrame, features: Sequence[str], settings: RandomForestClassifier, rows: int) -> RandomForestClassificationModel:
    """A model of settings' trees, depth, seed and columns. rows: of train; the weight column has one value for each class."""
    if not rows:
        raise ValueError("no rows to fit a forest on")
    label, weight, seed = settings.getLabelCol(), settings.getWeightCol(), settings.getSeed()
    names = [*features, label, weight]
    values = train.select(*[F.col(f"`{name}`").cast("double").alias(name) for name in names])
    part = min(1.0, SAMPLE_ROWS / rows)
    sample = (values if part == 1.0 else values.sample(False, part, seed)).toArrow()
    cuts = [thresholds(checked(sample[name], name), checked(sample[weight], weight), min(MAX_BINS, rows) - 1) for name in features]
    blocks = materialize(values.mapInArrow(packed(cuts, names), PACKED))
    found = blocks.select(F.explode("weights").alias("class", "weight")).groupBy("class").agg(F.min("weight"), F.max("weight")).collect()
    weights = np.ones(max(c for c, _, _ in found) + 1)
    for c, least, most in found:
        if least != most:
            raise ValueError(f"{weight} must be the same in all rows of a class")
        weights[c] = least
    forest = grow(blocks, cuts, weights, settings.getNumTrees(), settings.getMaxDepth(), seed)
    return as_model(forest, cuts, weights, settings, train)
