"""Near-duplicate vectors: a navigable small-world graph per shard; the beam is widened until audits pass."""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetpulse.llm.common import connected_components, table
from assetpulse.session import materialize

VALID = "embedding IS NOT NULL AND size(embedding) > 0 AND forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('inf')) AND exists(embedding, x -> x <> 0)"

#: Partitions that the meetings of shards are dealt to, at most; each then holds several, one after the other.
MOST_PARTITIONS = 20_000


class Links:
    """Neighbour lists of one level, in one array: those of node i are `to[start[i]:start[i + 1]]`."""

    def __init__(self, nodes: int, pairs: np.ndarray | None = None) -> None:
        self.nodes, self.pairs = nodes, np.zeros((0, 2), "int32") if pairs is None else pairs
        self.start, self.to = np.zeros(nodes + 1, "int64"), np.zeros(0, "int32")
        self.add(np.zeros((0, 2), "int32"))

    def add(self, pairs: np.ndarray) -> None:
        """Links from the first to the second column. None is ever dropped: without one a node may be out of reach."""
        self.pairs = np.concatenate([self.pairs, pairs.astype("int32")])
        self.start = np.append(0, np.bincount(self.pairs[:, 0], minlength=self.nodes).cumsum())
        self.to = self.pairs[np.argsort(self.pairs[:, 0], kind="stable"), 1]

    def of(self, rows: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, neighbour) for each neighbour of each node."""
        counts = self.start[nodes + 1] - self.start[nodes]
        first = np.cumsum(counts) - counts
        return np.repeat(rows, counts), self.to[np.repeat(self.start[nodes] - first, counts) + np.arange(counts.sum())]


class Graph:
    """Hierarchical small-world graph over unit vectors, built and searched for many rows at a time.

    A node is on level l with probability 8**-l. Its links on a level are up to half of width neighbours chosen apart from
    each other (each nearer to the node than to those chosen before) and else the nearest; links go both ways. The
    search walks by single-precision cosines; links between vectors are decided on the double-precision ones of exact."""

    def __init__(self, x: np.ndarray, width: int = 8, beam: int = 48, layers: list[np.ndarray] | None = None) -> None:
        self.exact, self.width = x, width
        self.x = x.astype("float32")
        rng = np.random.default_rng(11)
        level = np.minimum(np.floor(-np.log(rng.random(len(x)) + 1e-12) / np.log(8)).astype(int), 4)
        self.entry = int(np.flatnonzero(level == level.max())[0])
        self.layers = [Links(len(x), pairs) for pairs in layers or []]
        for at in range(int(level.max()), -1, -1) if layers is None else ():
            nodes = np.flatnonzero(level >= at)
            self.layers.append(Links(len(x)))
            done = 1
            while done < len(nodes):
                batch = nodes[done : done + min(done, 256)]
                ids, sims = self.search(self.x[batch], min(beam, done), int(nodes[0]), len(self.layers))
                self.join(batch, ids, sims)
                done += len(batch)

    def pack(self) -> list[np.ndarray]:
        return [layer.pairs for layer in self.layers]

    def join(self, rows: np.ndarray, ids: np.ndarray, sims: np.ndarray) -> None:
        near = self.x[np.maximum(ids, 0)]
        cross = np.einsum("qcd,qed->qce", near, near)
        taken = np.zeros(ids.shape, bool)
        for c in range(ids.shape[1]):
            closest = np.where(taken, cross[:, c], -2).max(axis=1)
            taken[:, c] = (ids[:, c] >= 0) & (sims[:, c] > closest) & (taken.sum(axis=1) < self.width // 2)
        order = np.argsort(-(sims + np.where(taken, 4, 0) - np.where(ids < 0, 9, 0)), axis=1, kind="stable")[:, : self.width]
        best = np.take_along_axis(ids, order, axis=1)
        pairs = np.stack([np.repeat(rows, best.shape[1]), best.ravel()], axis=1)
        pairs = pairs[pairs[:, 1] >= 0]
        self.layers[-1].add(np.concatenate([pairs, pairs[:, ::-1]]))

    def search(self, q: np.ndarray, beam: int, entry: int | None = None, layers: int | None = None, opened: int = 4) -> tuple[np.ndarray, np.ndarray]:
        """(ids, cosines) of the beam, best first; -1 where it is not full."""
        ids = np.full((len(q), 1), self.entry if entry is None else entry)
        sims = np.einsum("qcd,qd->qc", self.x[ids], q)
        use, n = self.layers[: layers or len(self.layers)], len(self.x)
        for depth, links in enumerate(use):
            size = beam if depth == len(use) - 1 else 4
            ids, sims = ids[:, :size], sims[:, :size]
            seen = np.zeros(len(q) * n, bool)
            seen[(np.arange(len(q))[:, None] * n + np.maximum(ids, 0)).ravel()] = True
            fresh = ids >= 0
            while True:  # each row opens its best few unopened nodes; only nodes new to a row are measured
                r, c = np.nonzero(fresh & (np.cumsum(fresh, axis=1) <= opened))
                if not len(r):
                    break
                fresh[r, c] = False
                row, step = links.of(r, ids[r, c])
                key = np.unique(row * n + step)
                key = key[~seen[key]]
                if not len(key):
                    continue
                seen[key] = True
                row, node = key // n, key % n
                live, start, count = np.unique(row, return_index=True, return_counts=True)
                line, place = np.repeat(np.arange(len(live)), count), np.arange(len(key)) - np.repeat(start, count)
                where, more = np.full((len(live), count.max()), -1), np.full((len(live), count.max()), -9.0)
                where[line, place] = node
                more[line, place] = np.einsum("nd,nd->n", self.x[node], q[row])
                if ids.shape[1] < size:
                    pad = ((0, 0), (0, size - ids.shape[1]))
                    ids, sims, fresh = np.pad(ids, pad, constant_values=-1), np.pad(sims, pad, constant_values=-9.0), np.pad(fresh, pad)
                all_ids, all_sims, all_fresh = np.concatenate([ids[live], where], 1), np.concatenate([sims[live], more], 1), np.concatenate([fresh[live], where >= 0], 1)
                order = np.argsort(-all_sims, axis=1, kind="stable")[:, :size]
                ids[live], sims[live], fresh[live] = (np.take_along_axis(v, order, axis=1) for v in (all_ids, all_sims, all_fresh))
        return ids, sims


def units(vectors: list) -> np.ndarray:
    x = np.array(vectors, float)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x**2).sum(axis=1, keepdims=True))


class Forest:
    """Components of numbered nodes, joined many pairs at a time; a root is its component's least number."""

    def __init__(self, nodes: int) -> None:
        self.up = np.arange(nodes)

    def top(self, x: np.ndarray) -> np.ndarray:
        while (self.up[x] != x).any():
            x = self.up[x]
        return x

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            ra, rb = self.top(a), self.top(b)
            apart = ra != rb
            if not apart.any():
                return
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            np.minimum.at(self.up, np.maximum(ra, rb), np.minimum(ra, rb))


class Meeting:
    """The vectors of one shard that ask, and the shard that is asked, by its graph. Every pair of vectors meets once: of two
    shards one asks the other, and a shard asks itself. What is found counts for both ends."""

    def __init__(self, graph: Graph, ids: np.ndarray, counts: np.ndarray, asked: pd.DataFrame, least: float) -> None:
        self.graph, self.ids, self.counts, self.least = graph, ids, counts, least
        self.q, self.nodes = units(asked["embedding"].tolist()), asked["node"].to_numpy("int64")
        self.n, self.probe = asked["n"].to_numpy("int64"), asked["probe"].to_numpy(bool)
        place = pd.Series(np.arange(len(ids)), ids)
        self.own = place.reindex(self.nodes).fillna(-1).to_numpy("int64")  # a row's place in the asked shard, if it is its own

    def exactly(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All links of the rows in the shard, by comparison."""
        r, p = np.nonzero(self.q[rows] @ self.graph.exact.T >= self.least)
        r = rows[r]
        other = self.own[r] != p
        return r[other], p[other]

    def search(self, beam: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, place in the shard) of the links found, and the rows whose whole beam is near; theirs are left to exactly."""
        found, wide = [(np.zeros(0, "int64"), np.zeros(0, "int64"))], np.zeros(len(self.q), bool)
        for low in range(0, len(self.q), 256):
            q = self.q[low : low + 256]
            ids, sims = self.graph.search(q.astype("float32"), beam)
            near = (ids >= 0) & (sims >= self.least - 1e-4)  # beyond the rounding of single precision
            wide[low : low + 256] = near.sum(axis=1) >= beam
            r, c = np.nonzero(near & ~wide[low : low + 256, None])
            p = ids[r, c]
            sure = (np.einsum("nd,nd->n", self.graph.exact[p], q[r]) >= self.least) & (self.own[low + r] != p)
            found.append((low + r[sure], p[sure]))
        return *(np.concatenate(part) for part in zip(*found, strict=True)), wide

    def audit(self, r: np.ndarray, p: np.ndarray, wide: np.ndarray) -> tuple[int, int, int]:
        """(probes with links, those of them whose links were all found, their links). Rows left to exactly do not count."""
        rows = np.flatnonzero(self.probe & ~wide)
        there = np.zeros(len(self.q), "int64")
        for low in range(0, len(rows), 256):
            there += np.bincount(self.exactly(rows[low : low + 256])[0], minlength=len(self.q))
        got = np.bincount(r, minlength=len(self.q))
        linked = rows[there[rows] > 0]
        return len(linked), int((got[linked] >= there[linked]).sum()), int(there[linked].sum())

    def results(self, beam: int, exact: bool, audit_only: bool) -> Iterator[pd.DataFrame]:
        size = len(self.ids)
        r, p, wide = (np.zeros(0, "int64"), np.zeros(0, "int64"), np.ones(len(self.q), bool)) if exact else self.search(beam)
        linked, whole, links = self.audit(r, p, wide)
        yield pd.DataFrame({"kind": "audit", "a": [linked], "b": [whole], "n": [links]})
        if audit_only:
            return
        here, there = np.zeros(len(self.q), "int64"), np.zeros(size, "int64")  # links of the rows, and of the shard's vectors
        forest, at_home = Forest(size + len(self.q)), (self.own >= 0).all()
        seen = [(r, p)]
        wide_at = np.zeros(size, bool)
        wide_at[self.own[wide & (self.own >= 0)]] = True
        for low in range(0, int(wide.sum()), 256):
            a, b = self.exactly(np.flatnonzero(wide)[low : low + 256])
            forest.join(size + a, b)
            if at_home:  # two rows left to exactly find each other; other pairs are put with the rest
                both = wide_at[b]
                here += np.bincount(a[both], self.counts[b[both]], len(self.q)).astype("int64")
                seen.append((a[~both], b[~both]))
            else:
                here += np.bincount(a, self.counts[b], len(self.q)).astype("int64")
                there += np.bincount(b, self.n[a], size).astype("int64")
        r, p = (np.concatenate(part) for part in zip(*seen, strict=True))
        if at_home:  # a pair may have been found from either end or from both
            x, y = np.minimum(self.own[r], p), np.maximum(self.own[r], p)
            x, y = np.divmod(np.unique(x * size + y), size)
            there += (np.bincount(x, self.counts[y], size) + np.bincount(y, self.counts[x], size)).astype("int64")
            forest.join(x, y)
            forest.join(size + np.arange(len(self.q)), self.own)
        else:
            here += np.bincount(r, self.counts[p], len(self.q)).astype("int64")
            there += np.bincount(p, self.n[r], size).astype("int64")
            forest.join(size + r, p)
        names = np.concatenate([self.ids, self.nodes])
        for nodes, totals in ((self.nodes, here), (self.ids, there)):
            yield pd.DataFrame({"kind": "links", "a": nodes[totals > 0], "b": -1, "n": totals[totals > 0]})
        tops = names[forest.top(np.arange(len(names)))]
        yield pd.DataFrame({"kind": "edge", "a": names[tops != names], "b": tops[tops != names], "n": 0})


def sharded(nodes: DataFrame, shard_vectors: int) -> DataFrame:
    """nodes with dim, shard and the number of shards of their length: as many as it takes for shard_vectors in each.

    The table of lengths is broadcast here and in meetings: n different lengths take at least n * n / 2 components, so it has at
    most the square root of twice the table's components."""
    sizes = nodes.groupBy(F.size("embedding").alias("dim")).agg(F.ceil(F.count("*") / shard_vectors).alias("shards"))
    known = nodes.withColumn("dim", F.size("embedding")).join(F.broadcast(sizes), "dim")
    return known.withColumn("shard", F.expr("pmod(xxhash64(node), shards)"))


def shard_graphs(nodes: DataFrame) -> DataFrame:
    """(dim, shards, shard, graph): one row per shard, its graph and vectors as bytes. Shards are dealt to a task each."""

    def packed(frame: pd.DataFrame) -> pd.DataFrame:
        held = io.BytesIO()
        layers = Graph(units(frame["embedding"].tolist())).pack()
        np.savez(held, *layers, ids=frame["node"].to_numpy("int64"), counts=frame["n"].to_numpy("int64"), x=np.stack(frame["embedding"].tolist()))
        first = frame.iloc[0]
        return pd.DataFrame({"dim": [first["dim"]], "shards": [first["shards"]], "shard": [first["shard"]], "graph": [held.getvalue()]})

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, held = None, []
        for batch in batches:
            for key, rows in batch.groupby(["dim", "shard"], sort=False):
                if key != at and held:
                    yield packed(pd.concat(held))
                    held = []
                at = key
                held.append(rows)
        if held:
            yield packed(pd.concat(held))

    total = nodes.select("dim", "shards").distinct().agg(F.sum("shards")).first()[0] or 1
    parts = min(int(total), MOST_PARTITIONS)
    dealt = nodes.select("dim", "shards", "shard", "node", "n", "embedding").repartitionById(parts, F.expr(f"int((dim + shard) % {parts})"))
    return dealt.sortWithinPartitions("dim", "shard", "node").mapInPandas(build, "dim int, shards long, shard long, graph binary")


def meetings(nodes: DataFrame, graphs: DataFrame) -> DataFrame:
    """Rows of (meeting, ask, ...): an asked shard's graph, then the vectors that ask it, a partition for each meeting. Shard s asks
    the shards s, s + 1, ... half way round the circle, so that each two meet once and all ask equally many."""
    half, skipped = "(shards div 2)", "shards % 2 = 0 AND way = shards div 2 AND {} >= shards div 2"
    ways = f"explode(sequence(0L, {half})) AS way"
    lengths = graphs.groupBy("dim").agg(F.max(F.expr(f"shards * ({half} + 1)")).alias("held"))
    start = F.broadcast(lengths.selectExpr("dim", "coalesce(sum(held) OVER (ORDER BY dim ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0L) AS base"))
    meeting = f"base + asker * ({half} + 1) + way AS meeting"
    asks = nodes.selectExpr("*", "shard AS asker", ways).where(f"NOT ({skipped.format('asker')})").join(start, "dim")
    asked = graphs.selectExpr("*", ways).withColumn("asker", F.expr("pmod(shard - way, shards)")).where(f"NOT ({skipped.format('asker')})").join(start, "dim")
    kind = nodes.schema["embedding"].dataType.simpleString()
    dealt = asks.selectExpr(meeting, "1 AS ask", "node", "n", "embedding", "probe", "CAST(NULL AS BINARY) AS graph").union(
        asked.selectExpr(meeting, "0 AS ask", "0L AS node", "0L AS n", f"CAST(NULL AS {kind}) AS embedding", "false AS probe", "graph")
    )
    parts = min(int(lengths.agg(F.sum("held")).first()[0] or 1), MOST_PARTITIONS)
    return dealt.repartitionById(parts, F.expr(f"int(meeting % {parts})")).sortWithinPartitions("meeting", "ask", "node")


def searched(dealt: DataFrame, least: float, beam: int, exact: bool, audit_only: bool = False) -> DataFrame:
    """(kind, a, b, n): link counts of nodes, edges that join components, and audits, of all meetings."""

    def answer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, known, held = None, None, []

        def closed() -> Iterator[pd.DataFrame]:
            if held and known is not None:
                packed = np.load(io.BytesIO(known))
                layers = [packed[f"arr_{i}"] for i in range(sum(name.startswith("arr_") for name in packed))]
                graph = Graph(units(packed["x"].tolist()), layers=layers)
                yield from Meeting(graph, packed["ids"], packed["counts"], pd.concat(held), least).results(beam, exact, audit_only)

        for batch in batches:
            for meeting, rows in batch.groupby("meeting", sort=False):
                if meeting != at:
                    yield from closed()
                    at, known, held = meeting, None, []
                if rows["ask"].iloc[0] == 0:
                    known = rows["graph"].iloc[0]
                    rows = rows.iloc[1:]
                if len(rows):
                    held.append(rows.drop(columns="graph"))
        yield from closed()

    return dealt.mapInPandas(answer, "kind string, a long, b long, n long")


def audited(found: DataFrame) -> dict[str, int]:
    sums = [F.coalesce(F.sum(column), F.lit(0)).alias(name) for column, name in (("a", "linked"), ("b", "whole"), ("n", "links"))]
    return found.where("kind = 'audit'").agg(*sums).first().asDict()


def near_vectors(
    vectors: DataFrame, least: float = 0.95, shard_vectors: int = 8192, recall: float = 0.99, probes: int = 32, least_links: int = 100, beam: int = 32
) -> DataFrame:
    """vec_id, n_links, component_id, kept. Equal vectors are one node with a multiplicity; invalid ones link with nothing.

    Shards hold about shard_vectors nodes, whatever their number; a graph is built per shard. Every node meets every shard,
    asking it or asked by it. One node in `probes` is also compared exactly with each shard it asks: of those with links, the share
    `recall` must have found all. With fewer than least_links such links in all, more nodes are probed, up to all;
    where the share is not reached, the beam is doubled and the search done again; a beam wider than a shard gives way to
    exact comparison. A node whose whole beam is linked is always compared exactly. Cosines are of doubles. Vectors of
    another length meet only their like. A vector's null vec_id never names a component with other ids."""
    rows = materialize(vectors.select("vec_id", "embedding").withColumn("row", F.monotonically_increasing_id()))
    distinct = rows.where(VALID).groupBy("embedding").agg(F.min("row").alias("node"), F.count("*").alias("n"), F.min("vec_id").alias("least_id"))
    nodes = sharded(materialize(distinct), shard_vectors)
    graphs = materialize(shard_graphs(nodes))
    exact = False
    while True:
        probed = nodes.withColumn("probe", F.expr(f"pmod(xxhash64(node, 'probe'), {probes}) = 0"))
        found = materialize(searched(meetings(probed, graphs), least, beam, exact))
        audit = audited(found)
        while audit["links"] < least_links and probes > 1 and not exact:
            probes = max(1, probes // 8)
            some = nodes.where(f"pmod(xxhash64(node, 'probe'), {probes}) = 0").withColumn("probe", F.lit(True))
            audit = audited(searched(meetings(some, graphs), least, beam, exact, audit_only=True))
        if exact or audit["whole"] >= recall * audit["linked"]:
            break
        beam, exact = beam * 2, beam > shard_vectors
    links = found.where("kind = 'links'").groupBy("a").agg(F.sum("n").alias("links"))
    roots = connected_components(found.where("kind = 'edge'").select("a", "b"))
    known = nodes.select("node", "embedding", "n", "least_id").join(links.withColumnRenamed("a", "node"), "node", "left").join(roots, "node", "left")
    known = materialize(known.selectExpr("embedding", "least_id", "n - 1 + coalesce(links, 0) AS n_links", "coalesce(root, node) AS root"))
    best = materialize(known.groupBy("root").agg(F.min("least_id").alias("component_id")))
    final = materialize(known.join(best, "root").select("embedding", "n_links", "component_id"))
    joined = rows.join(final, "embedding", "left")
    return joined.selectExpr("vec_id", "coalesce(n_links, 0L) AS n_links", "coalesce(component_id, vec_id) AS component_id", "vec_id <=> coalesce(component_id, vec_id) AS kept")


def op9_vectors(spark, sf_dir):
    return near_vectors(table(spark, sf_dir, "embeddings"))
