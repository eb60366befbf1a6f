"""Spelling variants: words one edit apart, found in k-d trees over letter-count vectors."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetpulse.llm.common import ascii_lower, table
from assetpulse.session import materialize

RUN = "([a-z\\\\u00C0-\\\\u00FF]+)"

#: Place in the count vector of each Latin-1 code: a-z, then the 64 codes from À.
LETTERS = np.zeros(256, "int64")
LETTERS[ord("a") : ord("z") + 1] = np.arange(26)
LETTERS[0xC0:] = 26 + np.arange(64)

SAME, LONGER = 1, 2


def word_counts(docs: DataFrame, least_size: int = 6, least_n: int = 5, garble: int = 199) -> DataFrame:
    """word, n over the runs of letters in whole texts, A-Z lower-cased. Where garble divides the CRC of `<doc_id>:<run>`, one
    letter of the run is left out (a null doc_id reads as empty). Counts are combined before the shuffle."""
    runs = docs.selectExpr("coalesce(cast(doc_id AS string), '') AS id", f"explode(regexp_extract_all({ascii_lower()}, '{RUN}', 1)) AS run")
    drawn = runs.where(f"length(run) >= {least_size}").selectExpr("run", "crc32(cast(concat(id, ':', run) AS binary)) AS h")
    cut = "concat(substring(run, 1, int(h % length(run))), substring(run, int(h % length(run)) + 2))"
    words = drawn.selectExpr(f"CASE WHEN h % {garble} = 0 THEN {cut} ELSE run END AS word").where(f"length(word) >= {least_size}")
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_n)


def codes_of(words: list[str]) -> np.ndarray:
    """Latin-1 codes of words of one length, a row each."""
    return np.frombuffer("".join(words).encode("latin-1"), "uint8").reshape(len(words), -1)


def letter_counts(codes: np.ndarray) -> np.ndarray:
    rows = np.repeat(np.arange(len(codes)) * 90, codes.shape[1])
    return np.bincount(rows + LETTERS[codes].ravel(), minlength=len(codes) * 90).reshape(len(codes), 90)


class KdTree:
    """Splits count vectors by one letter's count at a time, the one that varies most, at its median, down to leaf rows or
    vectors that no count tells apart. `rows` of a leaf are those it was built from."""

    def __init__(self, counts: np.ndarray, leaf: float) -> None:
        self.nodes: list[tuple[int, int, int, int]] = []  # letter, largest count on the left, left node, right node; leaves: -1, number
        self.rows: list[np.ndarray] = []
        waiting = [(np.arange(len(counts)), -1, 0)]
        while waiting:
            rows, parent, side = waiting.pop()
            here = len(self.nodes)
            if parent >= 0:
                letter, cut, *children = self.nodes[parent]
                children[side] = here
                self.nodes[parent] = (letter, cut, *children)
            own = counts[rows]
            spread = own.var(axis=0) if len(rows) > leaf else np.zeros(1)
            if not spread.max() > 0:
                self.nodes.append((-1, len(self.rows), -1, -1))
                self.rows.append(rows)
                continue
            letter = int(spread.argmax())
            values = own[:, letter]
            cut = min(int(np.median(values)), int(values.max()) - 1)
            self.nodes.append((letter, cut, -1, -1))
            waiting += [(rows[values <= cut], here, 0), (rows[values > cut], here, 1)]

    def reach(self, asked: np.ndarray, up: int, down: int) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, rows of asked): the leaves whose box holds some vector that exceeds the asked one by at most up and falls
        short of it by at most down, over all letters. Whole groups of asked rows go down the tree together."""
        rows = np.arange(len(asked))
        none = np.zeros(len(asked), "int64")
        stack = [(0, rows, none, none, {}, {})]
        while stack:
            node, rows, more, less, low, high = stack.pop()
            letter, cut, left, right = self.nodes[node]
            if letter < 0:
                yield cut, rows
                continue
            values = asked[rows, letter]
            fall = less + np.maximum(values - cut, 0) - (np.maximum(values - high[letter], 0) if letter in high else 0)
            rise = more + np.maximum(cut + 1 - values, 0) - (np.maximum(low[letter] - values, 0) if letter in low else 0)
            near = fall <= down
            if near.any():
                stack.append((left, rows[near], more[near], fall[near], low, high | {letter: cut}))
            near = rise <= up
            if near.any():
                stack.append((right, rows[near], rise[near], less[near], low | {letter: cut + 1}, high))


class WordIndex:
    """Words of one length, each once, in a k-d tree."""

    def __init__(self, words: list[str], leaf: int = 64) -> None:
        self.codes = codes_of(words)
        self.counts = letter_counts(self.codes).astype("float64")
        self.tree = KdTree(self.counts, leaf)

    def near(self, asked: list[str], kind: int) -> tuple[np.ndarray, np.ndarray]:
        """(rows of asked, rows of the index) one edit apart. SAME: words as long, one letter replaced; LONGER: the index's
        words have one letter more. A leaf's vectors within the distance (two unlike counts; one) are then compared in order."""
        codes = codes_of(asked)
        counts = letter_counts(codes)
        exact, squares = counts.astype("float64"), (counts**2).sum(axis=1)
        found = [(np.zeros(0, "int64"), np.zeros(0, "int64"))]
        for leaf, rows in self.tree.reach(counts, 1, 1 if kind == SAME else 0):
            held = self.tree.rows[leaf]
            own = self.counts[held]
            for low in range(0, len(rows), 4096):
                some = rows[low : low + 4096]
                distance = squares[some][:, None] + (own**2).sum(axis=1)[None, :] - 2 * (exact[some] @ own.T)
                a, b = np.nonzero(distance == (2 if kind == SAME else 1))
                a, b = some[a], held[b]
                ok = one_replaced(codes[a], self.codes[b]) if kind == SAME else one_added(codes[a], self.codes[b])
                found.append((a[ok], b[ok]))
        return tuple(np.concatenate(part) for part in zip(*found, strict=True))


def one_replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a != b).sum(axis=1) == 1


def one_added(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether b is a with one letter put in: the common head and the common tail cover a."""
    head = np.cumprod(a == b[:, :-1], axis=1, dtype="int64").sum(axis=1)
    tail = np.cumprod((a == b[:, 1:])[:, ::-1], axis=1, dtype="int64").sum(axis=1)
    return head + tail >= a.shape[1]


def upper_trees(words: DataFrame, cell_words: int, sample: int) -> dict[int, KdTree]:
    """For each length of more than cell_words words a tree that deals them into cells of about that many. It is fitted on
    about 32 words a cell, by hash, at most sample words a length; every word is dealt and asked by it."""
    many = words.groupBy("size").agg(F.count("*").alias("words")).where(F.col("words") > cell_words)
    wanted = many.selectExpr("size", "words", f"least(words, {sample}, 32 * ceil(words / {cell_words})) AS wanted")
    drawn = words.join(wanted, "size").where("pmod(xxhash64(word), words) < wanted").select("size", "words", "wanted", "word").collect()
    trees = {}
    for size in {r["size"] for r in drawn}:
        rows = [r for r in drawn if r["size"] == size]
        counts = letter_counts(codes_of([r["word"] for r in rows]))
        trees[size] = KdTree(counts, cell_words * len(rows) / rows[0]["words"])
    return trees


def full_cells(words: DataFrame, trees: dict[int, KdTree], cell_words: int) -> dict[tuple[int, int], int]:
    """In how many parts a cell of over twice cell_words words is held (words of equal letters cannot be told apart by a
    tree). There are at most as many cells as the trees, which the driver holds, have leaves."""

    def own(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for size, part in batch.groupby("size", sort=False):
                for cell, rows in trees[size].reach(letter_counts(codes_of(part["word"].tolist())), 0, 0):
                    yield pd.DataFrame({"size": [size], "cell": [cell], "words": [len(rows)]})

    split = words.where(F.col("size").isin(list(trees))).select("size", "word")
    held = split.mapInPandas(own, "size int, cell int, words long").groupBy("size", "cell").agg(F.sum("words").alias("words"))
    return {(r["size"], r["cell"]): -(-r["words"] // cell_words) for r in held.where(F.col("words") > 2 * cell_words).collect()}


def near_words(words: DataFrame, cell_words: int = 2048, sample: int = 20_000) -> DataFrame:
    """(word, other, other_n) for words(word, n, size) one edit apart, both ways. A word is held in its own cell and asks every cell
    its box search reaches among the words of its length and of the next. A cell of over twice cell_words words is held in
    parts by hash, each asked by all that ask the cell, so that no task holds more."""
    session = words.sparkSession
    uppers = upper_trees(words, cell_words, sample)
    known = session.sparkContext.broadcast((uppers, full_cells(words, uppers, cell_words)))

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trees, full = known.value
        for batch in batches:
            for size, group in batch.groupby("size", sort=False):
                counts = letter_counts(codes_of(group["word"].tolist()))
                for role, target, up, down in ((0, size, 0, 0), (SAME, size, 1, 1), (LONGER, size + 1, 1, 0)):
                    tree = trees.get(target)
                    for cell, rows in tree.reach(counts, up, down) if tree else [(0, np.arange(len(group)))]:
                        own, parts = group.iloc[rows], full.get((target, cell), 1)
                        hashed = own["word"].map(lambda w: zlib.crc32(w.encode())).to_numpy() % parts if parts > 1 and role == 0 else 0
                        for part in range(1 if role == 0 else parts):
                            yield pd.DataFrame({"target": target, "cell": cell, "part": hashed if role == 0 else part, "role": role, "word": own["word"], "n": own["n"]})

    dealt = words.mapInPandas(deal, "target int, cell int, part int, role int, word string, n long")
    tasks = int(session.conf.get("spark.sql.shuffle.partitions"))
    sorted_ = dealt.repartition(tasks, "target", "cell", "part").sortWithinPartitions("target", "cell", "part", "role")

    def answer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, held, index, named = None, [], None, None
        for batch in batches:
            for key, rows in batch.groupby(["target", "cell", "part"], sort=False):
                if key != at:
                    at, held, index = key, [], None
                own = rows[rows["role"] == 0]
                if len(own):
                    held.append(own)
                for kind in (SAME, LONGER):
                    asked = rows[rows["role"] == kind]
                    if not len(asked) or not held:
                        continue  # a cell without words
                    if index is None:
                        named = pd.concat(held)
                        index = WordIndex(named["word"].tolist())
                    a, b = index.near(asked["word"].tolist(), kind)
                    left, right = asked.iloc[a], named.iloc[b]
                    yield pd.DataFrame({"word": left["word"].to_numpy(), "other": right["word"].to_numpy(), "other_n": right["n"].to_numpy()})
                    if kind == LONGER:  # words of one length find each other from both ends
                        yield pd.DataFrame({"word": right["word"].to_numpy(), "other": left["word"].to_numpy(), "other_n": left["n"].to_numpy()})

    return sorted_.mapInPandas(answer, "word string, other string, other_n long")


def last_forms(formed: DataFrame) -> DataFrame:
    """(word, root) of words with a form. Every round doubles the steps followed; a form has at least several times its
    word's count, so chains are short and never closed."""
    state = formed.where("form IS NOT NULL").selectExpr("word", "form AS root", "true AS moved")
    while True:
        state = materialize(state)
        if state.where("moved").isEmpty():
            return state.drop("moved")
        later = state.selectExpr("word AS root", "root AS next")
        state = state.join(later, "root", "left").selectExpr("word", "coalesce(next, root) AS root", "next IS NOT NULL AS moved")


def spelling_groups(docs: DataFrame, ratio: int = 5, cell_words: int = 2048, sample: int = 20_000, **counted: int) -> DataFrame:
    """word, form, root, n, n_near, form_n of each word counted by word_counts.

    A word's form is the near word of largest n (ties: smallest) if that is at least ratio times the word's n. Null and empty texts
    have no words, a run of any length is one word, repeated rows count again, an empty table gives no rows. Only doc_id and
    text are read, so other columns may have any name."""
    words = materialize(word_counts(docs, **counted).withColumn("size", F.length("word")))
    near = near_words(words, cell_words, sample).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best")
    )
    joined = words.join(near, "word", "left")
    good = f"-best.less >= {ratio} * n"
    formed = materialize(joined.selectExpr(
        "word", f"CASE WHEN {good} THEN best.other END AS form", "n", "coalesce(n_near, 0L) AS n_near", f"CASE WHEN {good} THEN -best.less END AS form_n",
    ))
    return formed.join(last_forms(formed), "word", "left").selectExpr("word", "form", "coalesce(root, word) AS root", "n", "n_near", "form_n")


def op12_spelling(spark, sf_dir):
    return spelling_groups(table(spark, sf_dir, "documents"))
