"""Token counts, spelling variants and vector codes against the library and brute force."""

import hashlib
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from oracle_check import compare, connect
from tokenizers import Tokenizer

from assetpulse.llm import queries as llm
from assetpulse.llm import spelling, token_counts, vector_codes
from assetpulse.llm.common import LOWER, UPPER

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables absent")
PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = ["'", " ", "\n", "\t", "s", "t", "r", "e", "v", "l", "m", "d", "a", "1", "!", "é", "中", "\xa0", "　", "😀", "<|endoftext|>", "the ", "ing", "'re", "'ll", "́", "٣", "\x85", "\x00"]
RUN = re.compile("[A-Za-zÀ-ÿ]+")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def tables():
    return token_counts.compile_merges(PATH)


def lengths(library, texts):
    return [len(e.ids) for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_counts_of_random_texts(library, tables):
    rng = random.Random(5)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randrange(60))) for _ in range(5000)]
    texts += [None, "", " ", "a" * 9000, " " * 500 + "x", "'" * 99, "Ünï" * 3000, "x " * 40000]
    want = lengths(library, texts)
    counter = token_counts.TokenCounter(tables, PATH)
    assert counter.count(texts) == want
    small = token_counts.TokenCounter(tables, PATH, slab=37, limit=200)  # slabs end anywhere, all is forgotten often
    small.pairs.limit = 50
    assert small.count(texts[:1500]) == want[:1500]


def test_scan_equals_reading_one_by_one():
    rng = np.random.default_rng(3)
    after, emitted = token_counts.cutting_tables()
    for size in (1, 63, 64, 65, 1000, 5000):
        symbols = rng.integers(1, 13, size).astype("uint8")
        state, want = 0, []
        for symbol in symbols:
            want.append(emitted[symbol, state])
            state = after[symbol, state]
        assert token_counts.scan(symbols, after, emitted).tolist() == want
        assert token_counts.scan(symbols, after, emitted, chunk=7).tolist() == want


def test_token_counts_query(spark, library):
    docs = pq.read_table(f"{SF_DIR}/documents.parquet").to_pylist()
    got = llm.all_queries()["op11_token_counts"](spark, SF_DIR).collect()
    want = {r["doc_id"]: (len((r["text"] or "").encode()), n, n > 1024) for r, n in zip(docs, lengths(library, [r["text"] for r in docs]), strict=True)}
    assert len(got) == len(docs) and {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in got} == want


def test_token_counts_of_odd_rows(spark, library):
    rows = [(1, None, 0), (1, "", 0), (None, "it's", 0), (None, "it's", 0), (7, "é" * 50_000 + "<|endoftext|>", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens long")
    got = sorted((r["doc_id"] or 0, r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in token_counts.token_counts(df, PATH).collect())
    n = lengths(library, [rows[4][1]])[0]
    assert got == sorted([(1, 0, 0, False), (1, 0, 0, False), (0, 4, 2, False), (0, 4, 2, False), (7, 100_013, n, n > 1024)])
    assert token_counts.token_counts(df.limit(0), PATH).collect() == []


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def spelled(rows, least_n=5, garble=199):
    counts = Counter()
    for doc, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(str.maketrans(UPPER, LOWER))
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % garble == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= least_n}
    by_size = {}
    for w in words:
        by_size.setdefault(len(w), []).append(w)
    forms, out = {}, {}
    for w, n in words.items():
        others = [o for size in (len(w) - 1, len(w), len(w) + 1) for o in by_size.get(size, []) if near(w, o)]
        best = min(others, key=lambda o: (-words[o], o), default=None)
        forms[w] = best if best and words[best] >= 5 * n else None
        out[w] = [n, len(others), words[best] if forms[w] else None]
    for w in words:
        root = w
        while forms[root]:
            root = forms[root]
        out[w] = (forms[w], root, *out[w])
    return out


def as_dict(df):
    rows = df.collect()
    assert df.columns[:6] == ["word", "form", "root", "n", "n_near", "form_n"]
    assert len(rows) == len({r["word"] for r in rows})
    return {r["word"]: tuple(r)[1:] for r in rows}


def test_spelling_query(spark):
    docs = [(r["doc_id"], r["text"]) for r in pq.read_table(f"{SF_DIR}/documents.parquet").to_pylist()]
    want = spelled(docs)
    assert as_dict(llm.all_queries()["op12_spelling"](spark, SF_DIR)) == want and any(v[0] for v in want.values())


@pytest.mark.parametrize("cell_words", [5, 40])
def test_spelling_in_many_cells(spark, cell_words):
    """Small cells: upper trees, box searches across cells, and cells held in parts (anagrams share a vector)."""
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randrange(6, 9))) for _ in range(250)]
    words += [w[:3] + rng.choice("abcdeé") + w[4:] for w in words] + [w[:2] + w[3:] for w in words] + ["".join(rng.sample("abcdef", 6)) for _ in range(80)]
    rows = [(i, " ".join([w.upper() if i % 3 else w] * rng.choice([1, 1, 5, 30, 200]))) for i, w in enumerate(words)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert as_dict(spelling.spelling_groups(df, cell_words=cell_words, sample=60, least_n=1)) == spelled(rows, least_n=1)


def test_spelling_of_odd_rows(spark):
    rows = [(1, None, "x"), (2, "", "x"), (None, "Abcdef×÷ " * 7, "x"), (3, "abcdefg " * 40, "x"), (3, "abcdefg " * 40, "x"), (4, "ÀBCDEF " * 5, "x"), (5, "z" * 30_000 + " " + "z" * 30_000, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, word string")
    assert as_dict(spelling.spelling_groups(df, least_n=2)) == spelled([r[:2] for r in rows], least_n=2)
    assert spelling.spelling_groups(df.limit(0)).collect() == []


def test_exact_products():
    rng = np.random.default_rng(2)
    for reach, bits in ((2**12, 5), (2**27, 12), (2**27, 20), (2**28, 3)):
        x, y = rng.integers(-reach, reach, (50, 8)), rng.integers(-reach, reach, (7, 8))
        assert sum(l.astype("int64") << (bits * i) for i, l in enumerate(vector_codes.limbs(x, bits))).tolist() == x.tolist()
        assert vector_codes.exact_dots(x, y, bits).tolist() == (x.astype(object) @ y.astype(object).T).tolist()
    with pytest.raises(ValueError):
        vector_codes.exact_dots(x, y, 26)


def coded(rows, parts=8, entries=16, rounds=6):
    """vec_id -> (code, error, label_error, digest), in plain Python."""
    kept = [(i, l, [int(np.floor(4096 * np.float64(v))) for v in e]) for i, e, l in rows if e is not None and all(v is not None and np.isfinite(v) for v in e)]
    w = len(kept[0][2]) // parts
    order = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[2]))[:entries]
    books = [[r[2][p * w : p * w + w] for r in order] for p in range(parts)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), k) for k, c in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for _, _, x in kept:
                own = x[p * w : p * w + w]
                groups.setdefault(nearest(p, own)[1], []).append(own)
            for k, group in groups.items():
                books[p][k] = [sum(c) // len(group) for c in zip(*group, strict=True)]
    digest = hashlib.sha256(",".join(str(v) for book in books for c in book for v in c).encode()).hexdigest()
    found = [(i, l, [nearest(p, x[p * w : p * w + w]) for p in range(parts)]) for i, l, x in kept]
    errors = Counter()
    for _, l, f in found:
        errors[l] += sum(d for d, _ in f)
    return sorted((repr(i), "".join(f"{k:02x}" for _, k in f), sum(d for d, _ in f), errors[l], digest) for i, l, f in found)


def test_vector_codes_of_odd_rows(spark):
    rng = np.random.default_rng(4)
    rows = [(int(i), [float(v) for v in rng.normal(0, 3, 16)], int(i) % 3 or None) for i in rng.permutation(60)]
    rows += [rows[0], (rows[1][0], [9000.5] * 16, None), (None, [-1e-9] * 16, 7), (None, None, 1), (70, [None] * 16, 1), (71, [float("nan")] * 16, 1), (72, [float("inf")] * 16, 1)]
    df = spark.createDataFrame([(*r, "c") for r in rows], "vec_id long, embedding array<double>, label int, code string")
    for some in (df, df.where("vec_id < 5")):
        plain = [(r["vec_id"], r["embedding"], r["label"]) for r in some.collect()]
        got = sorted((repr(r["vec_id"]), *tuple(r)[1:]) for r in vector_codes.vector_codes(some).collect())
        assert got == coded(plain)
    assert vector_codes.vector_codes(df.where("false")).collect() == []
    for bad in ([1.0] * 7, [1e12] * 16):
        with pytest.raises(ValueError):
            vector_codes.vector_codes(df.union(spark.createDataFrame([(99, bad, 1, "c")], df.schema)))


def test_vector_codes_query_equals_sql(spark):
    line = compare(spark, "op13_vector_codes", llm.all_queries()["op13_vector_codes"], llm.all_sql()["op13_vector_codes"], connect(SF_DIR), SF_DIR)
    assert line.startswith("ok"), line
