"""Quality classifier: a generalised additive model with pairwise interactions over binned features."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetpulse.llm.common import table


def features(text: str | None) -> list[float]:
    """Shares and lengths over the whole text; an empty text gives zeros."""
    text = text or ""
    words, lines = text.split(), text.split("\n")
    n, w, k = max(1, len(text)), max(1, len(words)), max(1, len(lines))
    distinct = set(words)
    repeats = sum(a == b for a, b in zip(words, words[1:], strict=False))
    marks = sum(map(text.count, "!#$%&*|"))
    return [
        float(np.log1p(len(words))), len(distinct) / w, repeats / w, marks / n, text.count("|") / w, text.count("!") / w,
        sum(map(str.isupper, words)) / w, sum(map(str.istitle, words)) / w, len("".join(words)) / w, len(set(lines)) / k,
        w / k, (text.count(".") + text.count(",")) / w, sum(map(text.count, "0123456789")) / n, max(map(len, words), default=0) / 20.0,
    ]


def fit(x: np.ndarray, y: np.ndarray, bins: int = 32, rounds: int = 150, rate: float = 0.1, pairs: int = 6, coarse: int = 8) -> dict:
    """Cyclic boosting: in each round every feature's table takes one shallow tree's step (eight leaves over its bins);
    afterwards the pairs with the largest gain on the residual get coarse two-way tables, boosted in the same way."""
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) if len(c) else np.zeros(0) for c in x.T]
    coded = np.stack([np.searchsorted(c, v, side="right") for c, v in zip(cuts, x.T, strict=True)], axis=1)
    mean = float(np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3))
    score = np.full(len(y), np.log(mean / (1 - mean)))
    model = {"cuts": cuts, "base": float(np.log(mean / (1 - mean))), "one": [np.zeros(bins) for _ in cuts], "two": []}

    def step(code: np.ndarray, size: int) -> np.ndarray:
        p = 1 / (1 + np.exp(-score))
        g, h = np.bincount(code, y - p, size), np.bincount(code, p * (1 - p), size)
        return rate * g / (h + 1.0)

    def tree(code: np.ndarray) -> np.ndarray:
        p = 1 / (1 + np.exp(-score))
        g, h = np.bincount(code, y - p, bins), np.bincount(code, p * (1 - p), bins) + 1e-9
        edges = [0, bins]
        for _ in range(7):
            gain, best = 0.0, None
            for a, b in zip(edges, edges[1:], strict=False):
                gc, hc = np.cumsum(g[a:b]), np.cumsum(h[a:b])
                if b - a > 1:
                    v = gc[:-1] ** 2 / (hc[:-1] + 1) + (gc[-1] - gc[:-1]) ** 2 / (hc[-1] - hc[:-1] + 1) - gc[-1] ** 2 / (hc[-1] + 1)
                    if v.max() > gain:
                        gain, best = v.max(), a + 1 + int(v.argmax())
            if best is None:
                break
            edges = sorted([*edges, best])
        out = np.zeros(bins)
        for a, b in zip(edges, edges[1:], strict=False):
            out[a:b] = rate * g[a:b].sum() / (h[a:b].sum() + 1.0)
        return out

    if len(y):
        for _ in range(rounds):
            for f, code in enumerate(coded.T):
                delta = tree(code)
                model["one"][f] += delta
                score += delta[code]
        ranked = []
        small = coded * coarse // bins
        for a in range(x.shape[1]):
            for b in range(a):
                code = small[:, a] * coarse + small[:, b]
                p = 1 / (1 + np.exp(-score))
                g, h = np.bincount(code, y - p, coarse**2), np.bincount(code, p * (1 - p), coarse**2)
                ranked.append((float((g**2 / (h + 1)).sum()), a, b))
        chosen = [(a, b, np.zeros(coarse**2)) for _, a, b in sorted(ranked, reverse=True)[:pairs]]
        for _ in range(rounds // 3):
            for a, b, cells in chosen:
                code = small[:, a] * coarse + small[:, b]
                delta = step(code, coarse**2)
                cells += delta
                score += delta[code]
        model["two"] = chosen
    return model | {"bins": bins, "coarse": coarse}


def predict(model: dict, x: np.ndarray) -> np.ndarray:
    """Sum of the tables' entries at each row's bins, as a probability."""
    coded = np.stack([np.searchsorted(c, v, side="right") for c, v in zip(model["cuts"], x.T, strict=True)], axis=1)
    score = np.full(len(x), model["base"])
    for f, entries in enumerate(model["one"]):
        score += entries[coded[:, f]]
    small = coded * model["coarse"] // model["bins"]
    for a, b, cells in model["two"]:
        score += cells[small[:, a] * model["coarse"] + small[:, b]]
    return 1 / (1 + np.exp(-score))


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = 8000) -> dict:
    """Fits on at most sample_rows labelled ids (least hash first) that are not held out, one document of each.

    An id with both labels is left out, as are labels other than 0 and 1 and null ids; of documents that share an id the one
    with the least features counts. At most sample_rows rows of features come to the driver, whatever repeats."""
    known = labels.where("quality IN (0, 1) AND crc32(cast(cast(doc_id AS string) AS binary)) % 3 <> 1")
    agreed = known.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("other")).where("quality = other")
    picked = agreed.select("doc_id", "quality").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "x": [features(t) for t in b["text"]], "y": b["quality"].astype(float)})

    found = docs.select("doc_id", "text").join(picked, "doc_id").select("doc_id", "text", "quality").mapInPandas(extract, "doc_id long, x array<double>, y double")
    rows = sorted(found.groupBy("doc_id").agg(F.min("x").alias("x"), F.first("y").alias("y")).collect(), key=lambda r: r["doc_id"])
    width = len(features(""))
    return fit(np.array([r["x"] for r in rows], float).reshape(-1, width), np.array([r["y"] for r in rows], float))


def score(docs: DataFrame, model: dict) -> DataFrame:
    """docs with the column quality_score, a column of that name being replaced. Null and empty texts score as the empty
    text; repeated rows score alike."""
    known = docs.sparkSession.sparkContext.broadcast(model)  # a few kB of tables

    @F.pandas_udf("double")
    def rate(texts: pd.Series) -> pd.Series:
        return pd.Series(predict(known.value, np.array([features(t) for t in texts], float).reshape(len(texts), -1)))

    return docs.withColumn("quality_score", rate("text"))


def op5_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    scored = score(docs.select("doc_id", "text"), train(docs, table(spark, sf_dir, "labels")))
    return scored.selectExpr(
        "doc_id", "coalesce(crc32(cast(cast(doc_id AS string) AS binary)) % 3 = 1, false) AS held_out",
        "quality_score AS score", "cast(quality_score >= 0.5 AS int) AS predicted",
    )
