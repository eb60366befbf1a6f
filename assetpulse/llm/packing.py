"""Packing of tokenised pieces into sequences by vector best fit."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetpulse.llm.common import table
from assetpulse.session import materialize


#: Of tokens, documents and attention cost (tokens squared) in the best-fit score: those of the query and of the pipeline.
WEIGHTS = (1.0, 0.5, 0.5)


class WordIds:
    """Token ids of texts, as little-endian bytes. Tokens of this vocabulary never span white space, so each distinct word
    is encoded once per task and looked up afterwards; at most about limit words are held. A group of texts is split and
    its words numbered in Arrow; its ids are then taken from one array over the distinct words.

    The vocabulary is lower case and takes marks apart from letters: texts of Latin-1 letters are lower-cased whole (but
    those that may spell a special token, which is case sensitive), and a word that ends in marks is put together from the
    part before, where that ends in a letter or digit, and the marks. Words of lower-case letters alone need neither
    normaliser nor pattern; their last token, and no other, carries the end-of-word suffix."""

    MARKS, BETWEEN, LETTERS, SUFFIX = ".,;:!?$&%*#|", "`", "[a-zß-öø-ÿ]+", "</w>"
    GROUP_CHARS = 8_000_000

    def __init__(self, tokenizer: str, limit: int = 1_000_000) -> None:
        import os
        import re

        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.model, self.limit, self.known = Tokenizer.from_file(tokenizer), limit, {}
        (self.between,) = self.model.encode(self.BETWEEN, add_special_tokens=False).ids
        self.letters, self.plain = re.compile(self.LETTERS).fullmatch, Tokenizer.from_file(tokenizer)
        self.plain.normalizer = normalizers.Sequence([])
        bytes_only = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.CharDelimiterSplit(" "), bytes_only])
        vocabulary = self.model.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[n for token, n in vocabulary.items() if token.endswith(self.SUFFIX)]] = True

    @staticmethod
    def clean(text: str | None) -> str:
        text = (text or "").replace("\n", " ").replace("\t", " ")
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:  # lower-casing of other letters is left to the tokenizer
            return text
        return text if "<|" in text else text.lower()

    def learn(self, words: list[str]) -> None:
        cores, parts = set(), []
        for word in words:
            core = word.rstrip(self.MARKS)
            if len(core) < len(word) and core and core[-1].isalnum():
                tail = word[len(core) :]
                parts.append((word, core, tail))
                cores.add(core)
                cores.add(tail)
            else:
                cores.add(word)
        new = cores.difference(self.known)
        letters = list(filter(self.letters, new))
        for low in range(0, len(letters), 4096):  # one call for many words
            some = letters[low : low + 4096]
            ids = np.array(self.plain.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, "<u4")
            stops = (np.flatnonzero(self.ends[ids]) + 1) * 4
            data, at = ids.tobytes(), 0
            for word, end in zip(some, stops.tolist(), strict=True):
                self.known[word] = data[at:end]
                at = end
        new.difference_update(letters)
        apart = [w for w in new if self.BETWEEN not in w]
        for low in range(0, len(apart), 4096):  # likewise, with a mark of one token between them
            some = apart[low : low + 4096]
            joined = f" {self.BETWEEN} ".join(some)
            ids = np.array(self.model.encode_batch_fast([joined], add_special_tokens=False)[0].ids, "<u4")
            stops = np.append(np.flatnonzero(ids == self.between), len(ids)) * 4
            data, at = ids.tobytes(), 0
            for word, end in zip(some, stops.tolist(), strict=True):
                self.known[word] = data[at:end]
                at = end + 4
        for word in new.difference(apart):
            self.known[word] = np.array(self.model.encode(word, add_special_tokens=False).ids, "<u4").tobytes()
        for word, core, tail in parts:
            self.known[word] = self.known[core] + self.known[tail]

    def group(self, texts: list[str]) -> Iterator[bytes]:
        import pyarrow as pa
        import pyarrow.compute as pc

        lists = pc.split_pattern(pa.array(texts, "string"), " ")
        coded = lists.values.dictionary_encode()
        words, codes = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        if len(self.known) > self.limit:
            self.known.clear()
        self.learn([w for w in words if w not in self.known])
        own = [self.known[w] for w in words]
        flat, sizes = np.frombuffer(b"".join(own), "<u4"), np.fromiter(map(len, own), "int64", len(own)) // 4
        first = np.cumsum(sizes) - sizes
        counts = sizes[codes]
        upto = np.append(0, np.cumsum(counts))
        ids = flat[np.repeat(first[codes] - upto[:-1], counts) + np.arange(upto[-1])]
        places = upto[lists.offsets.to_numpy()].tolist()
        for low, high in zip(places, places[1:], strict=False):
            yield ids[low:high].tobytes()

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        held, size = [], 0
        for text in map(self.clean, texts):
            held.append(text)
            size += len(text)
            if size > self.GROUP_CHARS:
                yield from self.group(held)
                held, size = [], 0
        if held:
            yield from self.group(held)


def pieces_of(docs: DataFrame, tokenizer: str, max_tokens: int = 4096, end_id: int = 1, with_ids: bool = True) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 and, if asked, ids. Null text is empty: the end id alone."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zlib

        words, end = WordIds(tokenizer), np.array([end_id], "<u4").tobytes()
        names = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids]
        for batch in batches:
            out = []
            for doc, data in zip(batch["doc_id"].tolist(), words.encode(batch["text"].tolist()), strict=True):
                data += end
                for n, at in enumerate(range(0, len(data), 4 * max_tokens)):
                    ids = data[at : at + 4 * max_tokens]
                    row = (doc, n, at // 4, len(ids) // 4, zlib.crc32(ids))
                    out.append((*row, np.frombuffer(ids, "<u4").astype("int64")) if with_ids else row)
            frame = pd.DataFrame(out, columns=names)
            frame["doc_id"] = frame["doc_id"].astype("Int64")
            yield frame

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<long>" * with_ids
    return docs.select("doc_id", "text").mapInPandas(cut, schema)


def place(lengths: np.ndarray, capacity: tuple[float, float, float], weights: tuple[float, float, float], rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece; longest first into the open bin that the rule ranks best, else a new one.

    A piece takes (tokens, one document, tokens squared); a bin admits it only if all three capacities hold. Rule norm:
    least weighted norm of what is left; dot: largest weighted product of residual and demand.
    """
    bins, offsets = np.zeros(len(lengths), "int64"), np.zeros(len(lengths), "int64")
    left, made = [np.zeros(len(lengths)) for _ in capacity], 0
    for i in np.argsort(-lengths, kind="stable"):
        need = (float(lengths[i]), 1.0, float(lengths[i]) ** 2)
        fits = np.flatnonzero((left[0][:made] >= need[0]) & (left[1][:made] >= need[1]) & (left[2][:made] >= need[2]))
        if len(fits):
            score = np.zeros(len(fits))
            for rest, n, cap, w in zip(left, need, capacity, weights, strict=True):
                if w:
                    own = rest[fits]
                    score += w * ((own - n) / cap) ** 2 if rule == "norm" else -w * own / cap * n / cap
            chosen = fits[np.argmin(score)]
        else:
            chosen, made = made, made + 1
            for rest, cap in zip(left, capacity, strict=True):
                rest[chosen] = cap
        bins[i], offsets[i] = chosen, capacity[0] - left[0][chosen]
        for rest, n in zip(left, need, strict=True):
            rest[chosen] -= n
    return bins, offsets


def pack(pieces: DataFrame, max_tokens: int = 4096, max_docs: int = 4096, max_cost: float | None = None,
         weights: tuple[float, float, float] = (1.0, 0.0, 0.0), rule: str = "norm", group_rows: int = 8192) -> DataFrame:
    """Adds sequence_id and offset. Pieces are dealt by a hash of their row number, whatever their ids, into groups of
    about group_rows, each packed by itself: a group leaves a few bins part full, whatever the size of the input. The groups grow in number, not in size."""
    kept = materialize(pieces)
    groups = kept.count() // group_rows + 1
    capacity = (max_tokens, max_docs, max_cost or float(max_tokens) ** 2)

    def fill(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", "doc_id", "piece"], ascending=[False, True, True]).reset_index(drop=True)
        bins, offsets = place(frame["length"].to_numpy(), capacity, weights, rule)
        return frame.assign(sequence_id=frame["_group"].to_numpy("int64") * 2**32 + bins, offset=offsets).drop(columns="_group")

    dealt = kept.withColumn("_group", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema) + ", sequence_id long, offset long"
    return dealt.groupBy("_group").applyInPandas(fill, schema)


def op2_pack(spark, sf_dir):
    import public_tokenizers

    return pack(pieces_of(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), with_ids=False), weights=WEIGHTS)
