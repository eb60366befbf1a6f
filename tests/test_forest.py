"""The forest against plain loops over the rows, given the same draws and features."""

import math

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from assetpulse.operators import forest, model

DEPTH, TREES, SEED, FEATURES = 4, 3, 5, ["a", "b", "c", "d", "e"]


def frame(spark, rows=700, classes=2, seed=1):
    """Values that change slowly, over three partitions; e is the same in every row."""
    random = np.random.default_rng(seed)
    values = np.stack([random.integers(0, 60, rows // 4).repeat(4), random.normal(size=rows // 2).repeat(2).round(2), random.integers(0, 3, rows), np.arange(rows) // 9, np.full(rows, 7)])
    label = (values[0] > 30) ^ (random.random(rows) < 0.2)
    label = label * random.integers(1, classes, rows) if classes > 2 else label * 1
    data = [(*map(float, column), int(y)) for column, y in zip(values.T, label, strict=True)]
    return spark.createDataFrame(spark.sparkContext.parallelize(data, 3), "a double, b double, c double, d double, e double, failure_event int").cache()


def blocks_of(df):
    """Cuts of all rows, and the rows as blocks, for class weights of 1.0 and 3.0 (class 1)."""
    rows = df.collect()
    weight = np.array([3.0 if r["failure_event"] == 1 else 1.0 for r in rows])
    cuts = [forest.thresholds(np.array([r[name] for r in rows]), weight, 31) for name in FEATURES]
    names = [*FEATURES, "failure_event", "weight"]
    weighted = df.withColumn("weight", F.when(F.col("failure_event") == 1, 3.0).otherwise(1.0))
    values = weighted.select(*[F.col(name).cast("double") for name in names])
    return cuts, values.mapInArrow(forest.packed(cuts, names), forest.PACKED).cache()


def check_by_loops(tree, rows, weights, cuts, seed, t):
    """Counts of every node of tree, and that its split is one of the best or none is any good. rows: (bins, label, draw)."""
    seen = []

    def gini(counts):
        whole = sum(c * w for c, w in zip(counts, weights, strict=True))
        return (1 - sum((c * w / whole) ** 2 for c, w in zip(counts, weights, strict=True))) if whole else 0.0, whole

    def counted(some):
        return [sum(n for _, y, n in some if y == c) for c in range(len(weights))]

    def check(node, some, depth):
        seen.append(node)
        counts, gains = counted(some), {}
        assert tree.counts[node].tolist() == counts
        own, whole = gini(counts)
        for f in forest.node_features(seed, t, node, len(cuts)) if depth < DEPTH else []:
            for last in range(len(cuts[f])):
                sides = [x for x in some if x[0][f] <= last], [x for x in some if x[0][f] > last]
                if all(sum(map(lambda x: x[2], side)) for side in sides):
                    (li, lw), (ri, rw) = (gini(counted(side)) for side in sides)
                    gains[int(f), last] = own - lw / whole * li - rw / whole * ri
        best = max(gains.values(), default=0.0)
        if node not in tree.splits:
            assert best < 1e-9
            return
        f, last = tree.splits[node]
        assert tree.gains[node] == pytest.approx(best, abs=1e-9) == gains[f, last]
        check(2 * node + 1, [x for x in some if x[0][f] <= last], depth + 1)
        check(2 * node + 2, [x for x in some if x[0][f] > last], depth + 1)

    check(0, rows, 0)
    assert set(seen) == set(tree.counts) and len(seen) > 9


@pytest.mark.parametrize("classes", [2, 9])
def test_trees_equal_plain_loops(spark, classes):
    df = frame(spark, classes=classes)
    cuts, blocks = blocks_of(df)
    stored = blocks.collect()
    assert len(stored) == 3 and sum(r["runs"] for r in stored) < df.count()
    assert {c: w for r in stored for c, w in r["weights"].items()} == {c: 3.0 if c == 1 else 1.0 for c in range(classes)}
    weights = np.array([3.0 if c == 1 else 1.0 for c in range(classes)])
    trees = forest.grow(blocks, cuts, weights, TREES, DEPTH, SEED)
    tables = forest.poisson_tables()
    for t, tree in enumerate(trees):
        rows = []
        for r in stored:
            bins, label, sizes = forest.unpacked(r["data"], r["runs"], len(FEATURES))
            drawn = forest.draws(sizes.astype(np.int64), tables, SEED, 0, r["block"], t)
            rows += [(b, int(y), int(n)) for b, y, n in zip(bins.T, label, drawn, strict=True)]
        check_by_loops(tree, rows, weights, cuts, SEED, t)


def test_runs_keep_every_row(spark):
    df = frame(spark)
    cuts, blocks = blocks_of(df)
    seen = []
    for r in blocks.orderBy("block").collect():
        bins, label, sizes = forest.unpacked(r["data"], r["runs"], len(FEATURES))
        assert sizes.max() <= forest.LONGEST_RUN
        seen += [(*b, y) for b, y, n in zip(bins.T.tolist(), label.tolist(), sizes.tolist(), strict=True) for _ in range(n)]
    rows = df.collect()
    want = [(*(int(np.searchsorted(cut, r[name])) for cut, name in zip(cuts, FEATURES, strict=True)), r["failure_event"]) for r in rows]
    assert seen == want
    one = np.zeros((2, 100), np.uint8)
    assert np.diff(forest.run_starts(one, one[0]), append=100).tolist() == [forest.LONGEST_RUN] * (100 // forest.LONGEST_RUN) + [100 % forest.LONGEST_RUN]


def test_draws_are_poisson():
    tables = forest.poisson_tables()
    for size in (1, 2, forest.LONGEST_RUN):
        drawn = forest.draws(np.full(400_000, size, np.int64), tables, 1, 2)
        shares = np.bincount(drawn, minlength=4)[:4] / len(drawn)
        assert shares == pytest.approx([math.exp(-size) * size**k / math.factorial(k) for k in range(4)], abs=0.004)
        assert (drawn.mean(), drawn.var()) == (pytest.approx(size, rel=0.01), pytest.approx(size, rel=0.02))
    again = np.full(1000, 3, np.int64)
    assert (forest.draws(again, tables, 1, 2) == forest.draws(again, tables, 1, 2)).all()
    assert (forest.draws(again, tables, 1, 2) != forest.draws(again, tables, 1, 3)).any()
    edge = np.flatnonzero(tables[1][:65536] == forest.REDRAW)  # numbers that leave the value open
    assert 5 < len(edge) < 40


def test_thresholds():
    assert forest.thresholds(np.array([3.0, 1.0, 3.0, 2.0]), np.ones(4), 31).tolist() == [1.5, 2.5]
    assert forest.thresholds(np.ones(4), np.ones(4), 31).tolist() == []
    even = forest.thresholds(np.arange(3200.0), np.ones(3200), 31)
    assert even.tolist() == [100 * k - 0.5 for k in range(1, 32)]
    heavy = forest.thresholds(np.arange(100.0), np.where(np.arange(100) < 50, 9.0, 1.0), 9)
    assert len(heavy) == 9 and (heavy < 50).all()


def test_model_scores_as_its_trees(spark):
    df = frame(spark)
    cuts, blocks = blocks_of(df)
    weights = np.array([1.0, 3.0])
    trees = forest.grow(blocks, cuts, weights, TREES, DEPTH, SEED)
    settings = RandomForestClassifier(labelCol="failure_event", weightCol="weight", numTrees=TREES, maxDepth=DEPTH, seed=SEED)
    made = forest.as_model(trees, cuts, weights, settings, df)
    assert (made.numFeatures, made.numClasses, made.getNumTrees, made.getOrDefault("maxDepth"), made.getLabelCol()) == (5, 2, TREES, DEPTH, "failure_event")
    for row in df.collect()[::20]:
        shares = []
        for tree in trees:
            node = 0
            while node in tree.splits:
                f, last = tree.splits[node]
                node = 2 * node + 1 + (row[FEATURES[f]] > cuts[f][last])

            def classes(n, tree=tree):
                return classes(2 * n + 1) | classes(2 * n + 2) if n in tree.splits else {int((tree.counts[n] * weights).argmax())}

            while node and len(classes((node - 1) // 2)) == 1:  # leaves of one class are one leaf
                node = (node - 1) // 2
            shares.append((own := tree.counts[node] * weights) / own.sum())
        found = made.predictProbability(Vectors.dense([row[name] for name in FEATURES])).toArray()
        assert found.tolist() == pytest.approx(np.mean(shares, axis=0).tolist())


def test_rows_that_no_forest_takes(spark):
    rows = frame(spark).withColumn("customer_asset_identifier", F.lit(1)).withColumn("date", F.current_date())
    for bad in (
        rows.withColumn("a", F.expr("CASE WHEN c = 1 THEN NULL ELSE a END")),
        rows.withColumn("a", F.expr("CASE WHEN c = 1 THEN double('inf') ELSE a END")),
        rows.withColumn("failure_event", F.expr("CASE WHEN c = 1 THEN NULL ELSE failure_event END")),
        rows.withColumn("failure_event", F.expr("CASE WHEN c = 1 THEN -1 ELSE failure_event END")),
        rows.withColumn("failure_event", F.expr("failure_event + 0.5")),
        rows.filter("a < 0"),
        rows.withColumn("a", F.lit("text")),
    ):
        with pytest.raises(Exception):  # noqa: B017
            model.fit_forest(bad, trees=2, depth=2)
    settings = RandomForestClassifier(labelCol="failure_event", weightCol="b", numTrees=2)
    with pytest.raises(Exception, match="same in all rows"):
        forest.fit(frame(spark), ["a", "c"], settings, 700)
