"""WARC round trip and near-duplicate vectors against brute force."""

import base64
import gzip
import hashlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.errors import PySparkException

from assetpulse.llm import queries as llm
from assetpulse.llm import vectors, warc

SF = "/root/testdata/sf0.001"


def test_warc(spark, tmp_path):
    got = {r["page_id"]: tuple(r)[1:] for r in llm.all_queries()["op6_warc"](spark, SF).collect()}
    rows = {r["page_id"]: (r["html"] or "").encode() for r in pq.read_table(f"{SF}/pages.parquet").to_pylist()}
    first = {}
    for i in sorted(rows):
        first.setdefault(rows[i], i)
    assert got == {
        i: (len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "response" if first[p] == i else "revisit", None if first[p] == i else first[p])
        for i, p in rows.items()
    }
    noise = "".join(map(chr, np.random.default_rng(3).integers(1, 900, 20_000)))
    odd = [(1, "u v", noise), (2, None, noise), (2, None, None), (None, "x", ""), (None, "x", "solo")]
    df = spark.createDataFrame(odd, "page_id long, url string, html string")
    warc.write_archives(df, str(tmp_path / "a"))
    for size in (1000, 1 << 20):
        read = warc.read_archives(spark, str(tmp_path / "a"), size).collect()
        assert sorted(r["headers"]["WARC-Type"] for r in read) == ["response"] * 3 + ["revisit"] * 2
        assert {bytes(r["payload"]).decode() for r in read} == {noise, "", "solo"}


def test_warc_payloads_are_verified(spark, tmp_path):
    """A payload that is not what its header says fails the job; empty tables and long payloads pass."""
    long = "x é " * 300_000
    df = spark.createDataFrame([(1, "u", "one"), (2, "u", long), (3, "u", long)], "page_id long, url string, html string")
    warc.write_archives(df, str(tmp_path / "a"))
    got = {r["headers"]["WARC-Record-ID"]: (r["payload_bytes"], r["payload_digest"]) for r in warc.read_archives(spark, str(tmp_path / "a"), 4096).collect()}
    sizes = [len(t.encode()) for t in ("one", long, long)]
    assert [got[f"<urn:page:{i}>"][0] for i in (1, 2, 3)] == sizes and got["<urn:page:2>"] == got["<urn:page:3>"]
    (tmp_path / "b").mkdir()
    record = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Payload-Digest: sha1:AAAA\r\nContent-Length: 10\r\n\r\nH 200\r\n\r\nx\r\n\r\n"
    (tmp_path / "b" / "1").write_bytes(gzip.compress(record))
    with pytest.raises(PySparkException, match="not the one of the header"):
        warc.read_archives(spark, str(tmp_path / "b")).collect()
    warc.write_archives(df.limit(0), str(tmp_path / "c"))
    assert warc.read_archives(spark, str(tmp_path / "c")).collect() == []


def linked(rows):
    """vec_id -> (n_links, component_id, kept) by comparing all with all."""
    x = {i: np.array(v, float) for i, v in rows if v and None not in v and np.isfinite(v).all() and np.any(v)}
    out, ids = {i: (0, i, True) for i, _ in rows}, list(x)
    for dim in {len(v) for v in x.values()}:
        own = [i for i in ids if len(x[i]) == dim]
        m = np.array([x[i] / np.linalg.norm(x[i]) for i in own])
        near = m @ m.T >= 0.95
        root = np.arange(len(own))
        while True:
            least = np.where(near, np.array(own)[root][None, :], np.iinfo("int64").max).min(axis=1)
            again = np.array([own.index(v) for v in least])
            if (again == root).all():
                break
            root = again
        out |= {i: (int(n) - 1, own[r], i == own[r]) for i, n, r in zip(own, near.sum(axis=1), root, strict=True)}
    return out


def as_links(df):
    rows = df.collect()
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in rows}
    assert len(got) == len(rows)
    return got


def paired(n, dim, seed):
    """n vectors in pairs of cosine above 0.95, ids shuffled."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n // 2, dim))
    y = x + rng.normal(size=x.shape) * 0.2
    ids = rng.permutation(n).tolist()
    return [(i, v.tolist()) for i, v in zip(ids, np.concatenate([x, y]), strict=True)]


def test_vectors(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in pq.read_table("/root/testdata/sf0.1/embeddings.parquet").to_pylist()]
    assert as_links(llm.all_queries()["op9_vectors"](spark, "/root/testdata/sf0.1")) == linked(rows)
    odd = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [1.0, float("nan")]), (6, [1.0, 0.0]), (7, [1.0, 0.0]), (8, [3.0, 0.1]), (9, [1.0]), (10, [2.0])]
    df = spark.createDataFrame([(*r, 5, 6) for r in odd], "vec_id long, embedding array<float>, node long, row long")
    got = as_links(vectors.near_vectors(df))
    assert got == linked(odd) and got[8] == (2, 6, False) and got[10] == (1, 9, False)
    assert vectors.near_vectors(df.limit(0)).count() == 0
    again = vectors.near_vectors(spark.createDataFrame([(1, [1.0, 0.0]), (1, [1.0, 0.0]), (None, [1.0, 0.01]), (None, None)], "vec_id long, embedding array<double>"))
    assert sorted((r["vec_id"] or 0, r["n_links"], r["component_id"]) for r in again.collect()) == [(0, 0, None), (0, 2, 1), (1, 2, 1), (1, 2, 1)]


@pytest.mark.parametrize("shard_vectors", [700, 1500, 5000])
def test_pairs_count_for_both_ends(spark, shard_vectors):
    """Whichever end finds the other, in an even and an odd number of shards and in one."""
    rows = paired(4000, 24, shard_vectors)
    got = as_links(vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), shard_vectors=shard_vectors))
    want = linked(rows)
    members = {}
    for i, (_, component, _) in got.items():
        members.setdefault(component, []).append(i)
    assert all(sorted(m)[0] == c and (len(m) == 1 or sorted(got[i][0] for i in m) == [1, 1]) for c, m in members.items())
    assert sum(got[i] == want[i] for i in want) >= 0.99 * len(rows)


def test_beams_widen_until_audits_pass(spark):
    """Clusters larger than the first beam, over several shards: a beam of 2 misses links; every audit sees that."""
    rng = np.random.default_rng(8)
    x = np.repeat(rng.normal(size=(60, 16)), 30, axis=0) + rng.normal(size=(1800, 16)) * 0.12
    rows = [(int(i), v.tolist()) for i, v in zip(rng.permutation(1800), x, strict=True)]
    got, want = as_links(vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), shard_vectors=400, beam=2)), linked(rows)
    assert sum(got[i][1] == want[i][1] for i in want) >= 0.99 * len(rows)
    assert sum(v[0] for v in got.values()) >= 0.98 * sum(v[0] for v in want.values())
    assert sum(v[0] for v in got.values()) % 2 == 0 and all(got[i][0] <= want[i][0] for i in want)


def test_graph_recall():
    rng = np.random.default_rng(5)
    x = np.repeat(rng.normal(size=(300, 32)), 8, axis=0) + rng.normal(size=(2400, 32)) * 0.05
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    truth = x[:200] @ x.T >= 0.95
    ids, sims = vectors.Graph(x).search(x[:200], 512)
    assert (sims >= 0.95).sum() >= 0.9 * truth.sum()
