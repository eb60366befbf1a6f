"""Token counts by two deterministic transducers: one cuts a text into pretokens, one counts the byte pairs' tokens in them."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetpulse.llm.common import table

#: Marks inside joined texts, as surrogates cannot occur in a decoded string: end of a text, a special token.
END, SPECIAL = "\ud800", "\ud801"

#: Symbol classes of the cutting transducer.
PAD, CUT, SPACE, WHITE, DIGIT, SIGN, QUOTE, LETTER, SINGLE, LETTER_R, LETTER_V, LETTER_L, LETTER_E = range(13)
#: Its states: nothing read, runs of letters, digits, signs, white space (by its last character), a quote that opens a
#: pretoken, a quote and r, v or l, and a finished contraction.
FRESH, IN_LETTERS, IN_DIGITS, IN_SIGNS, AFTER_SPACE, AFTER_WHITE, AFTER_QUOTE, QUOTE_R, QUOTE_V, QUOTE_L, CLOSED = range(11)
#: What a transition emits: a pretoken starts here, or one started at the symbol before.
HERE, BEFORE = 1, 2


def cutting_step(state: int, symbol: int) -> tuple[int, int]:
    """Next state and output for the pattern 's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+ ."""
    late = 0
    if symbol == PAD:
        return state, 0
    if state in (QUOTE_R, QUOTE_V, QUOTE_L):
        if symbol == (LETTER_L if state == QUOTE_L else LETTER_E):
            return CLOSED, 0
        state, late = IN_LETTERS, BEFORE  # the quote stood alone, a run of letters started after it
    if symbol == CUT:
        return FRESH, HERE | late
    white, letter = symbol in (SPACE, WHITE), symbol >= LETTER
    if state in (AFTER_SPACE, AFTER_WHITE):
        if white:
            return (AFTER_SPACE if symbol == SPACE else AFTER_WHITE), 0
        late = BEFORE  # the last white space is a pretoken of its own or opens the next one
        if state == AFTER_SPACE:
            return (IN_LETTERS if letter else IN_DIGITS if symbol == DIGIT else IN_SIGNS), late
    if state == AFTER_QUOTE:
        if symbol in (SIGN, QUOTE):
            return IN_SIGNS, 0
        if symbol in (SINGLE, LETTER_R, LETTER_V, LETTER_L):
            return {SINGLE: CLOSED, LETTER_R: QUOTE_R, LETTER_V: QUOTE_V, LETTER_L: QUOTE_L}[symbol], 0
    if (state == IN_LETTERS and letter) or (state == IN_DIGITS and symbol == DIGIT) or (state == IN_SIGNS and symbol in (SIGN, QUOTE)):
        return state, late
    opened = {SPACE: AFTER_SPACE, WHITE: AFTER_WHITE, DIGIT: IN_DIGITS, SIGN: IN_SIGNS, QUOTE: AFTER_QUOTE}
    return opened.get(symbol, IN_LETTERS), HERE | late


def cutting_tables() -> tuple[np.ndarray, np.ndarray]:
    """Next states and outputs by (symbol, state)."""
    steps = np.array([[cutting_step(state, symbol) for state in range(11)] for symbol in range(13)], "uint8")
    return np.ascontiguousarray(steps[:, :, 0]), np.ascontiguousarray(steps[:, :, 1])


def scan(symbols: np.ndarray, after: np.ndarray, emitted: np.ndarray, chunk: int = 64) -> np.ndarray:
    """The transducer's outputs over the symbols, read from the state FRESH. Each chunk's map from its first to its last
    state is worked out for every state, all chunks in step; the maps are composed by a prefix scan of log2(chunks) rounds;
    then every chunk is read again from the state in which it starts."""
    rows = -(-len(symbols) // chunk)
    grid = np.zeros(rows * chunk, "uint8")
    grid[: len(symbols)] = symbols
    grid = np.ascontiguousarray(grid.reshape(rows, chunk).T)
    states = after.shape[1]
    flat = after.ravel()
    wide = grid.astype("uint16") * states
    maps = np.tile(np.arange(states, dtype="uint8"), (rows, 1))
    for line in wide:
        maps = flat[line[:, None] + maps]
    reach = 1
    while reach < rows:
        maps[reach:] = np.take_along_axis(maps[reach:], maps[:-reach].copy(), axis=1)
        reach *= 2
    state = np.concatenate([[FRESH], maps[:-1, FRESH]]).astype("uint8")
    out, told = np.empty_like(grid), emitted.ravel()
    for k, line in enumerate(wide):
        at = line + state
        out[k], state = told[at], flat[at]
    return out.T.reshape(-1)[: len(symbols)]


def compile_merges(path: str) -> dict:
    """Trie and merge tables of a byte-level BPE file, a size fixed by its vocabulary. Raises ValueError for settings that
    the transducers do not follow."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, cutter = spec["model"], spec["pre_tokenizer"] or {}
    plain = model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
    plain = plain and spec["normalizer"] is None and cutter.get("type") == "ByteLevel" and cutter.get("use_regex", True) and not cutter["add_prefix_space"]
    odd = [t for t in spec["added_tokens"] if t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]]
    if not plain or odd:
        raise ValueError("only plain byte-level BPE without normaliser, prefix space or stripping special tokens")
    printable = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in printable]
    byte_of = {chr(b): b for b in printable} | {chr(256 + n): b for n, b in enumerate(others)}
    special = [t["content"] for t in spec["added_tokens"]]
    ids = {token: n for token, n in model["vocab"].items() if token not in special}
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    rank, made = {}, {}
    for n, (a, b) in enumerate(merges):
        a, b, both = ids[a], ids[b], ids[a + b]
        if made.get(a, (-1,))[0] >= n or made.get(b, (-1,))[0] >= n or both in made:
            raise ValueError("merges must build each token once, parts first")
        rank[a, b], made[both] = n, (n, a, b)
    children, token_at, inner = {}, [-1], [False]
    for token, n in ids.items():
        node = 0
        for c in token:
            key = node << 8 | byte_of[c]
            inner[node] = True
            if key not in children:
                children[key] = len(token_at)
                token_at.append(-1)
                inner.append(False)
            node = children[key]
        token_at[node] = n
    if any(byte not in children or token_at[children[byte]] < 0 for byte in range(256)):
        raise ValueError("every byte must be a token")
    return {"rank": rank, "made": made, "children": children, "token_at": token_at, "inner": inner, "special": special}


class PairTransducer:
    """Counts the tokens of a pretoken's UTF-8 bytes, one transition a byte.

    A merge sequence is the right one exactly if each two neighbours are what their joined bytes give. So each prefix has
    one last token that fits the one before it, and a state need only keep the starts of tokens still open: for each, the
    trie node its bytes have reached, the token before it, and its token count less the prefix's. A transition carries the
    change of the prefix's count (a longer last token may lower it). States and transitions are made when first met; at
    limit states all are forgotten, which changes no count."""

    def __init__(self, tables: dict, limit: int = 300_000) -> None:
        self.rank, self.made, self.children = tables["rank"], tables["made"], tables["children"]
        self.token_at, self.inner, self.limit = tables["token_at"], tables["inner"], limit
        self.pairs: dict[tuple[int, int], bool] = {}
        self.forget()

    def forget(self) -> None:
        self.states = [((0, -1, 0),)]
        self.numbers = {self.states[0]: 0}
        self.steps: dict[int, tuple[int, int]] = {}
        self.pairs.clear()

    def edge(self, token: int, side: int) -> list[tuple[int, float]]:
        """Tokens that are at the left (1) or right (2) end of token while it is built, each with the rank that ends it."""
        out, ends = [], float("inf")
        while True:
            out.append((token, ends))
            if token not in self.made:
                return out
            ends, token = self.made[token][0], self.made[token][side]

    def fits(self, a: int, b: int) -> bool:
        """Whether bytes of a and b together give a, b: no merge across the border comes before one that uses up its parts. Of
        equal ranks the left one comes first."""
        known = self.pairs.get((a, b))
        if known is None:
            right, left = self.edge(a, 2), self.edge(b, 1)
            known = self.pairs[a, b] = not any((n := self.rank.get((x, y))) is not None and n < x_ends and n <= y_ends for x, x_ends in right for y, y_ends in left)
        return known

    def compile(self, state: int, byte: int) -> tuple[int, int]:
        grown, found, change = [], -1, 0
        for node, before, behind in self.states[state]:
            child = self.children.get(node << 8 | byte)
            if child is None:
                continue
            token = self.token_at[child]
            if found < 0 <= token and (before < 0 or self.fits(before, token)):
                found, change = token, behind + 1
            if self.inner[child]:
                grown.append((child, before, behind))
        reached = (*[(node, before, behind - change) for node, before, behind in grown], (0, found, 0))
        number = self.numbers.setdefault(reached, len(self.states))
        if number == len(self.states):
            self.states.append(reached)
        step = self.steps[state << 8 | byte] = number, change
        return step

    def count(self, data: bytes) -> int:
        state = total = 0
        for byte in data:
            state, change = self.steps.get(state << 8 | byte) or self.compile(state, byte)
            total += change
        if len(self.states) > self.limit:
            self.forget()
        return total


class TokenCounter:
    """Counts of whole texts. Texts are joined and read in slabs of about slab characters, a long one in several: a slab's last
    pretoken is carried into the next. Counts of up to limit pretokens of at most 64 characters are remembered."""

    def __init__(self, tables: dict, path: str, slab: int = 4_000_000, limit: int = 500_000) -> None:
        from tokenizers import Tokenizer

        self.probe = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        self.after, self.emitted = cutting_tables()
        self.pairs, self.slab, self.limit = PairTransducer(tables), slab, limit
        special = sorted(map(re.escape, filter(None, tables["special"])), key=len, reverse=True)
        self.special = re.compile("|".join(special)) if special else None
        self.classes = np.full(0x110000, 255, "uint8")
        fixed = {END: CUT, SPECIAL: CUT, " ": SPACE, "'": QUOTE, "s": SINGLE, "t": SINGLE, "m": SINGLE, "d": SINGLE, "r": LETTER_R, "v": LETTER_V, "l": LETTER_L, "e": LETTER_E}
        for c, symbol in fixed.items():
            self.classes[ord(c)] = symbol
        self.known: dict[str, int] = {}

    def symbols(self, codes: np.ndarray) -> np.ndarray:
        """Classes of the code points; one not met before is asked of the library, next to a letter, a digit and a sign."""
        out = self.classes[codes]
        for code in np.unique(codes[out == 255]).tolist():
            joins = [symbol for other, symbol in (("a", LETTER), ("1", DIGIT), ("!", SIGN)) if len(self.probe(other + chr(code))) == 1]
            self.classes[code] = joins[0] if joins else WHITE
        return self.classes[codes]

    def learn(self, words: list[str]) -> None:
        if len(self.known) > self.limit:
            self.known.clear()
        self.known |= {END: 0, SPECIAL: 1}
        for word in set(words).difference(self.known):
            if len(word) <= 64:
                self.known[word] = self.pairs.count(word.encode())

    def words(self, joined: str) -> list[str]:
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
        out = scan(self.symbols(codes), self.after, self.emitted)
        starts = (out & HERE) > 0
        starts[:-1] |= (out[1:] & BEFORE) > 0
        cuts = [*np.flatnonzero(starts).tolist(), len(joined)]
        return [joined[a:b] for a, b in pairwise(cuts)]

    def slabs(self, texts: list[str | None]) -> Iterator[str]:
        held, size = [], 0
        for text in texts:
            text = text or ""
            text = (self.special.sub(SPECIAL, text) if self.special else text) + END
            for low in range(0, len(text), self.slab):
                held.append(text[low : low + self.slab])
                size += len(held[-1])
                if size >= self.slab:
                    yield "".join(held)
                    held, size = [], 0
        yield "".join(held)

    def count(self, texts: list[str | None]) -> list[int]:
        """Tokens of each text; null is empty."""
        totals, running, rest = [], 0, ""
        for slab in self.slabs(texts):
            *words, rest = self.words(rest + slab) or [""]
            running = self.add(words, running, totals)
        self.add([rest] if rest else [], running, totals)
        return totals

    def add(self, words: list[str], running: int, totals: list[int]) -> int:
        """Adds up the words' counts; every END closes a text. Returns the open text's count."""
        self.learn(words)
        counts = [n if n is not None else self.pairs.count(w.encode()) for w, n in zip(words, map(self.known.get, words), strict=True)]
        sums = np.concatenate([[running], counts]).astype("int64").cumsum()
        ends = np.array([i for i, w in enumerate(words) if w == END], "int64")
        upto = sums[ends + 1]
        totals.extend(np.diff(upto, prepend=0).tolist())
        return int(sums[-1] - (upto[-1] if len(ends) else 0))


def token_counts(docs: DataFrame, path: str, limit: int = 1024) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of each row; null text is empty. A special token's string in a text is one token,
    as the library takes it by default. Null and repeated ids keep their rows; other columns are left out. The tables are
    compiled once and sent to the tasks; their size is the vocabulary's."""
    tables = docs.sparkSession.sparkContext.broadcast(compile_merges(path))

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = TokenCounter(tables.value, path)
        for batch in batches:
            yield pd.Series(counter.count(batch.tolist()), dtype="int64")

    counted = docs.select("doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"), count("text").alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def op11_token_counts(spark, sf_dir):
    import public_tokenizers

    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
