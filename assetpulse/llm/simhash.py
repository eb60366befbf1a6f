"""SimHash near duplicates with a Gray-order hierarchical index."""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetpulse.llm.common import UPPER, LOWER, connected_components, table
from assetpulse.session import materialize

#: The 64 bits as six blocks; two fingerprints with at most four differing bits agree on two blocks at least.
BLOCKS = [(0, 11), (11, 11), (22, 11), (33, 11), (44, 10), (54, 10)]


def fingerprints(docs: DataFrame, shingle: int = 4, row: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, columns of row, fp (signed 64 bits). Null or blank text: zero; fewer words than a shingle: the whole sequence."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import re

        import xxhash

        words = re.compile("[^\\x20\\x09-\\x0d]+")
        lower = str.maketrans(UPPER, LOWER)

        def one(text: str | None) -> int:
            found = words.findall((text or "").translate(lower))
            if not found:
                return 0
            count, total = np.zeros(64, "int64"), 0
            n = max(1, len(found) - shingle + 1)
            for low in range(0, n, 4096):
                part = [xxhash.xxh64_intdigest(" ".join(found[i : i + shingle]).encode(), seed=42) for i in range(low, min(n, low + 4096))]
                bits = np.unpackbits(np.array(part, "<u8").view("u1").reshape(-1, 8), axis=1, bitorder="little")
                count += bits.sum(axis=0, dtype="int64")
                total += len(part)
            return int(np.packbits(count * 2 > total, bitorder="little").view("<i8")[0])

        for batch in batches:
            yield batch.drop(columns="text").assign(doc_id=batch["doc_id"].astype("Int64"), fp=[one(t) for t in batch["text"]])

    own = docs.select("doc_id", *row)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema if f.name != "doc_id")
    return docs.select("doc_id", *row, "text").mapInPandas(scan, ", ".join(filter(None, ["doc_id long", schema, "fp long"])))


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Place of each word in the reflected Gray sequence."""
    x = x.copy()
    for s in (1, 2, 4, 8, 16, 32):
        x ^= x >> np.uint64(s)
    return x


#: Rows of a node, level by level; the last level are the rows themselves.
RUNS = (1024, 128, 16, 4, 1)


class GrayTree:
    """Nodes over rows sorted by key, then Gray rank: each level cuts a key's rows into runs of Gray neighbours. A node keeps the
    mask of the bits that all its rows share, and their pattern."""

    def __init__(self, key: np.ndarray, fp: np.ndarray) -> None:
        self.fp = fp
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        sizes = np.diff(np.r_[first, len(key)])
        self.starts, self.masks, self.patterns = [first], [], []  # the top level has one node per key
        for run in RUNS:
            parts = -(-sizes // run)
            upto = np.cumsum(parts) - parts
            self.starts.append(np.repeat(first, parts) + (np.arange(parts.sum()) - np.repeat(upto, parts)) * run)
        for starts in self.starts:
            both, any_ = np.bitwise_and.reduceat(fp, starts), np.bitwise_or.reduceat(fp, starts)
            self.masks.append(both | ~any_)
            self.patterns.append(both)

    def children(self, level: int) -> tuple[np.ndarray, np.ndarray]:
        """First child of each node, and how many it has."""
        below = np.searchsorted(self.starts[level + 1], np.r_[self.starts[level], len(self.fp)])
        return below[:-1], np.diff(below)

    def differ(self, level: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """On how many bits that both share each pair of nodes differs: what all their rows differ by at least."""
        masks, patterns = self.masks[level], self.patterns[level]
        return np.bitwise_count((patterns[a] ^ patterns[b]) & masks[a] & masks[b])


def near_pairs(key: np.ndarray, fp: np.ndarray, bits: int, seen: list | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row pairs of equal key within bits of each other; rows come sorted by key, then Gray rank.

    A pair of nodes goes on to its children only while the differences on the bits shared on both sides, which add up on the
    way down, stay within the limit; else all pairs below it are pruned. The frontier is worked in blocks, depth first.
    seen collects (level, pairs of nodes met, pairs kept)."""
    if not len(key):
        return
    tree = GrayTree(key, fp)
    below = [tree.children(level) for level in range(len(RUNS))]
    tops = np.flatnonzero(np.diff(np.r_[tree.starts[0], len(key)]) > 1)
    stack = [(tops[i : i + 65536], tops[i : i + 65536], 0) for i in range(0, len(tops), 65536)]
    while stack:
        a, b, level = stack.pop()
        first, count = below[level]
        ways = np.cumsum(count[a] * count[b])
        for low in range(0, int(ways[-1]) if len(ways) else 0, 1_000_000):
            at = np.arange(low, min(int(ways[-1]), low + 1_000_000))
            p = np.searchsorted(ways, at, side="right")
            k = at - (ways[p] - (count[a] * count[b])[p])
            x, y = first[a[p]] + k // count[b[p]], first[b[p]] + k % count[b[p]]
            once = x < y if level + 1 == len(RUNS) else x <= y
            x, y = x[once], y[once]
            keep = tree.differ(level + 1, x, y) <= bits
            if seen is not None:
                seen.append((level + 1, len(x), int(keep.sum())))
            x, y = x[keep], y[keep]
            if not len(x):
                continue
            if level + 1 == len(RUNS):
                yield tree.starts[-1][x], tree.starts[-1][y]
            else:
                stack.append((x, y, level + 1))


def cell_keys(width: int) -> list[str]:
    """SQL keys of width bits, one per table: two fingerprints with at most four differing bits agree on the whole key in one
    table at least. Up to 12 bits are taken from each of five blocks, of which one is free of differences; up to 20 from
    each two of six blocks, of which two are."""
    if width <= 12:
        return [f"shiftrightunsigned(fp, {at}) & {2**width - 1}L" for at in (0, 13, 26, 39, 52)][: 5 if width else 1]
    high, low = width - width // 2, width // 2
    pairs = itertools.combinations(BLOCKS, 2)
    return [f"(shiftrightunsigned(fp, {i}) & {2**high - 1}L) * {2**low}L + (shiftrightunsigned(fp, {j}) & {2**low - 1}L)" for (i, _), (j, _) in pairs]


def links(distinct: DataFrame, bits: int, cell_rows: int = 8_192) -> DataFrame:
    """(a, b) fingerprints whose components are those of all pairs within bits (at most 4).

    Rows meet in cells of about cell_rows rows, at every size of the input: cell keys take a bit more from the fingerprint for each
    doubling of the rows. Within a cell the Gray-order tree finds the pairs. Keys with over twice cell_rows rows are dealt
    into cells of pairs of parts, so that no task gets a whole hot key. A cell emits a star per component, not its pairs."""
    rows = distinct.count()
    width = min(20, max(0, math.ceil(math.log2(max(1, rows) / cell_rows))))
    keys = [f"struct({t} AS t, {key} AS k)" for t, key in enumerate(cell_keys(width))]
    entries = distinct.selectExpr("fp", f"explode(array({', '.join(keys)})) AS e").selectExpr("fp", "e.t", "e.k")
    hot = materialize(entries.groupBy("t", "k").count().where(F.col("count") > 2 * cell_rows).selectExpr("t", "k", f"ceil(count / {cell_rows}) AS m"))
    dealt = entries.join(hot, ["t", "k"], "left").selectExpr("fp", "t", "k", "coalesce(m, 1L) AS m").selectExpr("*", "pmod(xxhash64(fp), m) AS c")
    cells = dealt.selectExpr("fp", "t", "k", "explode(transform(sequence(0L, m - 1), o -> least(o, c) * 65536 + greatest(o, c))) AS cell")
    parts = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranked = cells.withColumn("key", F.xxhash64("t", "k", "cell")).select("key", "fp").repartition(parts, "key").sortWithinPartitions("key")

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def search(key: np.ndarray, fp: np.ndarray) -> pd.DataFrame:
            order = np.lexsort((gray_rank(fp), key))
            key, fp = key[order], fp[order]
            root = np.arange(len(fp))

            def top(x: np.ndarray) -> np.ndarray:
                while (root[x] != x).any():
                    x = root[x]
                return x

            for i, j in near_pairs(key, fp, bits):
                while True:
                    ri, rj = top(i), top(j)
                    open_ = ri != rj
                    if not open_.any():
                        break
                    i, j, ri, rj = i[open_], j[open_], ri[open_], rj[open_]
                    np.minimum.at(root, np.maximum(ri, rj), np.minimum(ri, rj))
            up = top(np.arange(len(fp)))
            own = np.flatnonzero(up != np.arange(len(fp)))
            return pd.DataFrame({"a": fp[own].view("int64"), "b": fp[up[own]].view("int64")})

        rest = None
        for batch in batches:
            batch = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            key = batch["key"].to_numpy()
            end = int(np.searchsorted(key, key[-1])) if len(key) else 0
            rest, batch = batch.iloc[end:], batch.iloc[:end]
            if len(batch):
                yield search(batch["key"].to_numpy(), batch["fp"].to_numpy("int64").view("uint64"))
        if rest is not None and len(rest):
            yield search(rest["key"].to_numpy(), rest["fp"].to_numpy("int64").view("uint64"))

    return ranked.mapInPandas(find, "a long, b long").distinct()


def near_groups(docs: DataFrame, shingle: int = 4, bits: int = 4, row: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, fingerprint, component_id: the smallest doc_id reachable over links of at most bits (4 or fewer).

    Where columns row are named that tell rows apart, both ids are structs (no_id, doc_id, *row): the least of a component is
    one row, and a row without id only if all are."""
    if bits > 4:
        raise ValueError("the cell keys cover at most 4 differing bits")
    rows = fingerprints(docs, shingle, row)
    if row:
        rows = rows.select(F.struct(F.isnull("doc_id").alias("no_id"), "doc_id", *row).alias("doc_id"), "fp")
    rows = materialize(rows)
    distinct = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = connected_components(links(distinct, bits))
    rooted = distinct.join(roots, distinct["fp"] == roots["node"], "left").selectExpr("fp", "least", "coalesce(root, fp) AS root")
    best = materialize(rooted.groupBy("root").agg(F.min("least").alias("component_id")))
    final = materialize(materialize(rooted).join(best, "root").select("fp", "component_id"))
    return rows.join(final, "fp").selectExpr("doc_id", "lpad(lower(hex(fp)), 16, '0') AS fingerprint", "component_id")


def op8_simhash(spark, sf_dir):
    return near_groups(table(spark, sf_dir, "documents"))
