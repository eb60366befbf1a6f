"""Operators against brute force on the smallest tables and on odd rows."""

import hashlib
import os
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
import xxhash

from assetpulse.llm import exact_dedup, mixing, packing, quality, simhash
from assetpulse.llm import queries as llm
from assetpulse.llm.common import LOWER, UPPER, connected_components

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables absent")
ODD = [(1, None), (2, ""), (3, "A b"), (3, "A b"), (4, "a B"), (None, "x"), (9, "long word\n" * 3000), (10, "LONG word\n" * 3000)]


@pytest.fixture(scope="module")
def docs():
    return pq.read_table(f"{SF_DIR}/documents.parquet").to_pylist()


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "en", "src1", 7, "clash") for i, t in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, keep_id string")


def lower(text):
    return (text or "").translate(str.maketrans(UPPER, LOWER))


def roots(pairs, nodes):
    up = {n: n for n in nodes}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def test_components(spark):
    pairs = [(i, i + 1) for i in range(20)] + [(50, 40), (40, 50), (41, 40), (7, 7)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    want = roots(pairs, {x for p in pairs for x in p})
    assert got == {n: r for n, r in want.items() if n != r}


@pytest.mark.parametrize("bits", [64, 3])
def test_exact_groups(spark, docs, odd, bits):
    for df, rows in ((odd, ODD), (spark.read.parquet(f"{SF_DIR}/documents.parquet"), [(r["doc_id"], r["text"]) for r in docs])):
        groups = {}
        for i, t in rows:
            groups.setdefault(lower(t), []).append(i)
        want = []
        for i, t in rows:
            ids = groups[lower(t)]
            keep = max((x for x in ids if x is not None), default=None)
            want.append((i, keep, len(ids), i == keep, hashlib.sha256(lower(t).encode()).hexdigest()))
        got = [tuple(r)[:5] for r in exact_dedup.exact_groups(df, hash_bits=bits).collect()]
        assert sorted(got, key=repr) == sorted(want, key=repr)
    assert exact_dedup.exact_groups(odd.limit(0)).count() == 0


def fingerprint(text):
    import re

    words = re.findall("[^\\x20\\x09-\\x0d]+", lower(text))
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(words[i : i + 4]).encode(), seed=42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash(spark, docs, odd):
    for df, rows in ((odd, ODD), (spark.read.parquet(f"{SF_DIR}/documents.parquet"), [(r["doc_id"], r["text"]) for r in docs])):
        prints = [(i, fingerprint(t)) for i, t in rows]
        near = [(a, b) for _, a in prints for _, b in prints if (a ^ b).bit_count() <= 4]
        root = roots(near, {f for _, f in prints})
        least = {}
        for i, f in prints:
            least.setdefault(root[f], []).append(i)
        want = [(i, f"{f:016x}", min((x for x in least[root[f]] if x is not None), default=None)) for i, f in prints]
        assert sorted(map(tuple, simhash.near_groups(df).collect()), key=repr) == sorted(want, key=repr)


def gray_sorted(fp, key=None):
    key = np.zeros(len(fp), int) if key is None else key
    order = np.lexsort((simhash.gray_rank(fp), key))
    return key[order], fp[order]


def test_near_pairs_is_complete():
    rng = np.random.default_rng(1)
    fp = rng.integers(0, 2**63, 60, "uint64").repeat(50)
    for _ in range(3):
        fp = fp ^ (np.uint64(1) << rng.integers(0, 64, len(fp)).astype("uint64"))
    for keys in (1, 3, 1000):
        key, own = gray_sorted(fp, rng.integers(0, keys, len(fp)))
        got = sorted(zip(*map(np.ndarray.tolist, map(np.concatenate, zip(*simhash.near_pairs(key, own, 4), strict=True))), strict=True))
        near = (np.bitwise_count(own[:, None] ^ own[None, :]) <= 4) & (key[:, None] == key[None, :])
        assert got == [(a, b) for a, b in zip(*map(np.ndarray.tolist, np.nonzero(near)), strict=True) if a < b]
    assert list(simhash.near_pairs(np.zeros(0, int), np.zeros(0, "uint64"), 4)) == []


def test_the_tree_prunes(spark):
    """At sf0.1 most of the pairs of runs are pruned before their rows are compared."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    fp = np.unique(np.array([r["fp"] for r in simhash.fingerprints(docs).select("fp").distinct().collect()], "int64").view("uint64"))
    seen = []
    pairs = sum(len(i) for i, _ in simhash.near_pairs(*gray_sorted(fp), 4, seen))
    met, kept = sum(m for level, m, _ in seen if level < len(simhash.RUNS)), sum(k for level, _, k in seen if level < len(simhash.RUNS))
    compared = sum(m for level, m, _ in seen if level == len(simhash.RUNS))
    assert kept < 0.5 * met and compared < len(fp) ** 2 / 2 / 3 and pairs > 0


def test_cell_keys_cover_four_differences(spark):
    rng = np.random.default_rng(2)
    a = rng.integers(-(2**63), 2**63 - 1, 400)
    b = a.copy()
    for row in range(400):
        for bit in rng.choice(64, 4, replace=False):
            b[row] ^= np.int64(-(2**63)) if bit == 63 else np.int64(1 << bit)
    for width in (0, 5, 12, 13, 20):
        keys = simhash.cell_keys(width)
        both = [spark.createDataFrame([(int(v),) for v in side], "fp long").selectExpr(*[f"{k} AS k{n}" for n, k in enumerate(keys)]).collect() for side in (a, b)]
        assert all(any(p == q for p, q in zip(x, y, strict=True)) for x, y in zip(*both, strict=True))
        assert len(keys) == (1 if width == 0 else 5 if width <= 12 else 15) and all(0 <= v < 2**width for row in both[0] for v in row)


def test_links_are_the_same_in_cells_of_any_size(spark):
    """One cell, many, keys of two blocks, and hot keys that are dealt into pairs of parts."""
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**62, 60).repeat(20)
    for _ in range(4):
        base = base ^ (1 << rng.integers(0, 62, len(base)))
    values = sorted({int(v) for v in base} | {i ^ (i << 3) for i in range(300)})
    df = spark.createDataFrame([(v,) for v in values], "fp long")
    near = np.array(values)
    near = np.argwhere(np.triu(np.bitwise_count(near[:, None] ^ near[None, :]) <= 4, 1))
    want = {(n, r) for n, r in roots([(values[a], values[b]) for a, b in near], values).items() if n != r}
    for rows in (16_384, 100, 16, 1):
        got = {tuple(r) for r in connected_components(simhash.links(df, 4, cell_rows=rows)).collect()}
        assert got == want, rows


def test_pack(spark, docs, odd):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    model = Tokenizer.from_file(path)
    for df, rows in ((odd, ODD), (spark.read.parquet(f"{SF_DIR}/documents.parquet"), [(r["doc_id"], r["text"]) for r in docs])):
        want = []
        for i, t in rows:
            ids = [*model.encode(t or "", add_special_tokens=False).ids, 1]
            for n, at in enumerate(range(0, len(ids), 4096)):
                part = ids[at : at + 4096]
                want.append((i, n, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
        got = packing.pack(packing.pieces_of(df, path)).collect()
        assert sorted([tuple(r)[:5] for r in got], key=repr) == sorted(want, key=repr)
        bins = {}
        for r in got:
            bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        for places in bins.values():
            at = 0
            for offset, length in sorted(places):
                assert offset == at
                at += length
            assert at <= 4096
        assert len(bins) <= 1.03 * -(-sum(w[3] for w in want) // 4096) + 1


def test_pack_of_no_rows_and_of_clashing_columns(spark, odd):
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    assert packing.pack(packing.pieces_of(odd.limit(0), path)).collect() == []
    wide = odd.selectExpr("*", "1 AS piece", "2 AS sequence_id", "3 AS _group", "4 AS ids")
    got, want = (sorted(map(tuple, packing.pack(packing.pieces_of(df, path, with_ids=False)).select("doc_id", "piece", "start", "length", "ids_crc32").collect()), key=repr) for df in (wide, odd))
    assert got == want and len(got) >= len(ODD)


def test_rows_of_one_id_are_dealt_over_groups(spark):
    """Null or repeated ids do not meet in one group, and weights of all three capacities keep the sequence count."""
    for one in (None, 7):
        rows = [(one, 0, 0, 50 + i % 400, i) for i in range(2000)]
        pieces = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long")
        got = packing.pack(pieces, group_rows=200, weights=packing.WEIGHTS).collect()
        sizes = {}
        for r in got:
            sizes[r["sequence_id"] >> 32] = sizes.get(r["sequence_id"] >> 32, 0) + 1
        assert len(got) == 2000 and len(sizes) == 11 and max(sizes.values()) < 300
    lengths = np.random.default_rng(3).integers(1, 3000, 2000)
    count = {w: packing.place(lengths, (4096, 4096, 4096.0**2), w, "norm")[0].max() + 1 for w in ((1.0, 0.0, 0.0), packing.WEIGHTS)}
    assert count[packing.WEIGHTS] <= 1.01 * count[1.0, 0.0, 0.0]


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_every_capacity_holds(rule):
    lengths = np.random.default_rng(2).integers(1, 90, 400)
    bins, _ = packing.place(lengths, (100, 3, 5000), (1, 0.5, 0.5), rule)
    for b in np.unique(bins):
        own = lengths[bins == b]
        assert len(own) == 1 or (own.sum() <= 100 and len(own) <= 3 and (own**2).sum() <= 5000)


def test_quality(spark, odd):
    rows = llm.all_queries()["op5_quality"](spark, "/root/testdata/sf0.01").collect()
    truth = {r["doc_id"]: r["quality"] for r in pq.read_table("/root/testdata/sf0.01/labels.parquet").to_pylist()}
    held = [r for r in rows if r["held_out"] and r["doc_id"] in truth]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) > 0.9
    model = quality.fit(np.zeros((0, len(quality.features("")))), np.zeros(0))
    scored = quality.score(odd.withColumn("quality_score", odd["n_chars"]), model).collect()
    assert len(scored) == len(ODD) and all(r["quality_score"] == 0.5 for r in scored)
    model = quality.fit(np.array([quality.features(t) for _, t in ODD] * 20), np.array([0.0, 0, 1, 1, 1, 0, 1, 0] * 20))
    by_text = {}
    for r in quality.score(odd, model).collect():
        by_text.setdefault(r["text"] or "", set()).add(r["quality_score"])
    assert all(len(v) == 1 and 0 < min(v) < 1 for v in by_text.values())


def test_quality_learns_from_a_bounded_sample(spark):
    """Repeated ids bring one row each, conflicting labels none; the least hash decides who is in the sample."""
    docs = spark.createDataFrame([(i % 40, f"word{i} text. " * (1 + i % 7)) for i in range(4000)] + [(None, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(4, 1), (6, 0), (None, 1), (8, 7)], "doc_id long, quality int")
    seen = []
    original, quality.fit = quality.fit, lambda x, y, **_: seen.append((x.shape, y.tolist()))
    try:
        for rows in (2, 1000):
            quality.train(docs, labels, sample_rows=rows)
        quality.train(docs, labels.limit(0))
    finally:
        quality.fit = original
    ids = [i for i in range(40) if zlib.crc32(str(i).encode()) % 3 != 1 and i != 4]
    assert seen[0][0][0] == 2 and seen[1] == ((len(ids), 14), [float(i % 2) for i in ids]) and seen[2][0] == (0, 14)


def test_quality_tables_add_up():
    """A score is the base and one entry of each table at the row's bins."""
    rng = np.random.default_rng(7)
    x = rng.normal(size=(400, 5))
    model = quality.fit(x, (x[:, 0] + x[:, 1] * x[:, 2] > 0).astype(float))
    for row, got in zip(x[:50], quality.predict(model, x[:50]), strict=True):
        code = [int((c <= v).sum()) for c, v in zip(model["cuts"], row, strict=True)]
        total = model["base"] + sum(t[k] for t, k in zip(model["one"], code, strict=True))
        small = [k * model["coarse"] // model["bins"] for k in code]
        total += sum(cells[small[a] * model["coarse"] + small[b]] for a, b, cells in model["two"])
        assert got == pytest.approx(1 / (1 + np.exp(-total)))
    assert ((quality.predict(model, x) >= 0.5) == (x[:, 0] + x[:, 1] * x[:, 2] > 0)).mean() > 0.9


def test_mix(spark, odd):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    everything = mixing.mix(docs, mixing.LEVELS, {}, share=1.0, epochs=1)
    assert everything.count() == docs.count() == everything.select("doc_id").distinct().count()
    half = mixing.mix(docs, mixing.LEVELS, {}, share=0.5, epochs=1).selectExpr(f"sum({mixing.TOKENS}) AS t").first()["t"]
    total = docs.selectExpr(f"sum({mixing.TOKENS}) AS t").first()["t"]
    assert 0.5 * total <= half <= 0.8 * total  # a leaf's last row may run over its budget
    assert mixing.mix(odd, mixing.LEVELS, {}, share=1.0, epochs=1).count() == len(ODD)
    assert mixing.mix(odd.limit(0), mixing.LEVELS, {}).count() == 0


def test_mix_takes_sources_of_any_name(spark):
    names = ["", None, "wiki", "github", "src", "src1x", "src3", "src09", "src12", "src99999999999"]
    rows = [(i, "words " * 40, "en", s) for i, s in enumerate(names * 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    domains = {r["source"]: r["d"] for r in df.selectExpr("source", f"{mixing.LEVELS['domain']} AS d").collect()}
    assert domains == {s: {"src3": "web", "src09": "web", "src12": "curated", "src99999999999": "curated"}.get(s, "other") for s in names}
    assert mixing.mix(df, mixing.LEVELS, {}, share=1.0, epochs=1).count() == len(rows)


def test_mix_without_broadcast_and_with_clashing_names(spark):
    """The salted join gives the same rows; columns named like the operator's own pass through."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").selectExpr("*", "doc_id AS _h", "'x' AS e", "1 AS _range", "lang AS _leaf", "2 AS t")
    want, got = (sorted(mixing.mix(docs, mixing.LEVELS, {}, broadcast_rows=most).collect(), key=repr) for most in (100_000, 0))
    assert want == got and want and all(r["_h"] == r["doc_id"] and r["e"] == "x" for r in got)


def test_shortage_goes_to_siblings_first(spark):
    leaves = spark.createDataFrame([("a", "x", 10), ("a", "y", 100), ("b", "x", 100)], "d string, s string, tokens long")
    got = {(r["d"], r["s"]): r["budget"] for r in mixing.budgets(leaves, ["d", "s"], {}, 120.0, 1).collect()}
    assert got == {("a", "x"): 10, ("a", "y"): 50, ("b", "x"): 60}


def test_weights_are_of_paths(spark):
    """A name means its own level and, with a whole path, its own place; a source named like a language has no part in it."""
    leaves = spark.createDataFrame([("a", "en", 1000), ("a", "x", 1000), ("en", "en", 1000), ("en", "x", 1000)], "d string, s string, tokens long")

    def of(weights):
        return {(r["d"], r["s"]): r["budget"] for r in mixing.budgets(leaves, ["d", "s"], weights, 120.0, 1).collect()}

    assert of({("en",): 2.0}) == {("a", "en"): 20, ("a", "x"): 20, ("en", "en"): 40, ("en", "x"): 40}
    assert of({("*", "en"): 2.0}) == {("a", "en"): 40, ("a", "x"): 20, ("en", "en"): 40, ("en", "x"): 20}
    assert of({("*", "en"): 2.0, ("a", "en"): 5.0}) == {("a", "en"): 50, ("a", "x"): 10, ("en", "en"): 40, ("en", "x"): 20}


def test_mix_takes_seeded_prefixes(spark):
    """Two epochs by plain code: whole epochs first, then, of the rows in the order of their hash, those that begin within
    what is left of the leaf's budget."""
    rows = [(i, "word " * (1 + i % 40), "en", f"src{i % 3}", 0) for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    tokens = {r[0]: max(1, -(-len(r[1]) // 4)) for r in rows}
    weights = {("web",): 1.0, ("*", "*", "src1"): 6.0}
    leaves = {s: sum(tokens[r[0]] for r in rows if r[3] == s) for s in ("src0", "src1", "src2")}
    for share in (0.3, 0.9, 1.4):
        got = {}
        for r in mixing.mix(df, mixing.LEVELS, weights, share=share, epochs=2).collect():
            got.setdefault(r["source"], []).append((r["doc_id"], r["_epoch"]))
        plan = spark.createDataFrame([("web", "en", s, t) for s, t in leaves.items()], "d string, l string, s string, tokens long")
        budget = {r["s"]: r["budget"] for r in mixing.budgets(plan, ["d", "l", "s"], weights, share * sum(tokens.values()), 2).collect()}
        hashes = {}
        for full in range(3):
            hashes |= {(full, r["doc_id"]): r["h"] for r in df.selectExpr("doc_id", f"xxhash64(7, {full}L, doc_id, text) AS h").collect()}
        for source, total in leaves.items():
            full = min(2, int(budget[source] // total))
            left, at = budget[source] - int(budget[source] // total) * total, 0
            want = [(i, e) for i in tokens for e in range(full) if rows[i][3] == source]
            ids = sorted((i for i in tokens if rows[i][3] == source), key=lambda i: ((hashes[full, i] >> 52) % 4096, hashes[full, i] & (2**52 - 1), i))
            for i in ids:
                if at >= left:
                    break
                want.append((i, full))
                at += tokens[i]
            assert sorted(got.get(source, [])) == sorted(want), (share, source)


def test_word_ids_match_the_tokenizer_on_odd_texts():
    import public_tokenizers

    odd = [
        None, "", " ", "\n\n", "a", "<|EndOfText|> <|endoftext|>. x<|startoftext|>y", "Ünï²³ 12a. é\u0301 ÉCOLE!!! İstanbul ſ",
        "it's we'll. don't!!`x` ` `` a`b", "x\u00a0y\x85z.  q", "日本語。 test,", "ﬁ ŉ", "ª º. µ!", "\x0b\x0c\r\n a", "word.\x00", "ÿß. ßß!", "<| a", "word " * 3000,
    ]
    words = packing.WordIds(public_tokenizers.path("word_bpe_49k.json"))
    words.GROUP_CHARS = 20  # several groups
    for text, got in zip(odd, words.encode(odd), strict=True):
        assert np.frombuffer(got, "<u4").tolist() == words.model.encode(text or "", add_special_tokens=False).ids, text
