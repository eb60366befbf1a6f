"""Secret scan with corpus-wide ownership frequency."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetpulse.llm.common import table
from assetpulse.session import materialize

# The base kinds, in the order that breaks ties, with the least length of what must be long enough.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST = {"assign": 6, "access": 20, "hex": 24}
#: Wider candidates; whether one counts is decided by who else has it.
WIDE = r"[A-Za-z0-9+/_=-]{20,}"


def overlaps(spans: list[tuple[int, int]]) -> Callable[[int, int], bool]:
    """Whether a span meets one of the given; the given ones are merged and sorted once, then searched by halves."""
    merged: list[list[int]] = []
    for a, b in sorted(spans):
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    starts = [a for a, _ in merged]

    def covered(start: int, stop: int) -> bool:
        at = bisect_left(starts, stop) - 1  # the last that begins before stop
        return at >= 0 and merged[at][1] > start

    return covered


def scan(docs: DataFrame, owner: str, repository: str) -> DataFrame:
    """One row per document: doc_id, owner, repository, found array of (kind, start, stop, hash, live). Null text is empty.

    live: at least 20 characters with digits and letters and 10 different characters, none of the usual placeholders."""

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash

        kinds = {"assign": re.compile(ASSIGN, re.I | re.A), "access": re.compile(ACCESS), "hex": re.compile("[0-9a-f]{24,}"), "wide": re.compile(WIDE)}
        words = ("password", "passwd", "secret", "token", "apikey", "api_key")

        def one(text: str | None) -> list[dict]:
            text, out, taken = text or "", [], []
            low = text.lower()
            for kind, pattern in kinds.items():
                if kind == "assign" and not any(w in low for w in words) or kind == "access" and "AKIA" not in text:
                    continue
                if kind == "wide":
                    covered = overlaps(taken)
                for m in pattern.finditer(text):
                    value = m[2] if kind == "assign" else m[0]
                    if kind != "wide":
                        if len(value) < LEAST[kind]:
                            continue
                        taken.append(m.span())
                    elif covered(m.start(), m.end()):
                        continue
                    live = len(value) >= 20 and len(set(value)) >= 10 and bool(re.search("[0-9]", value)) and bool(re.search("[A-Za-z]", value))
                    live = live and not re.search("example|placeholder|changeme|your|test", value, re.I)
                    if kind != "wide" or live:
                        out.append({"kind": kind, "start": m.start(), "stop": m.end(), "hash": xxhash.xxh3_128_hexdigest(value), "live": live})
            return out

        for b in batches:
            yield b.drop(columns="text").assign(doc_id=b["doc_id"].astype("Int64"), found=[one(t) for t in b["text"]])

    rows = docs.select("doc_id", F.expr(owner).cast("string").alias("owner"), F.expr(repository).cast("string").alias("repository"), "text")
    return rows.mapInPandas(find, "doc_id long, owner string, repository string, found array<struct<kind string, start long, stop long, hash string, live boolean>>")


def ownership(docs: DataFrame, owner: str, repository: str, copied_owners: int = 3, copied_repositories: int = 3) -> DataFrame:
    """One row per document: doc_id, spans array of (start, rank, kind, stop, class, owners, repositories, occurrences).

    class: copied where the hash occurs with copied_owners owners or in copied_repositories repositories or more, else live
    where it looks live, else plain. Wide candidates are kept as kind live where their class is live. Counts are of distinct
    owners, of distinct repositories (each with its owner) and of all occurrences over the whole corpus; repeated rows keep a
    row each; null owners count as one owner."""
    rows = materialize(scan(docs, owner, repository).withColumn("row", F.monotonically_increasing_id()))
    each = rows.select("row", "owner", "repository", F.explode("found").alias("f")).select("row", "owner", "repository", "f.*")
    places = each.groupBy("hash", F.coalesce("owner", F.lit("")).alias("owner"), F.coalesce("repository", F.lit("")).alias("repository")).agg(F.count("*").alias("n"))
    owners = places.groupBy("hash", "owner").agg(F.count("*").alias("repos"), F.sum("n").alias("n"))
    stats = materialize(owners.groupBy("hash").agg(F.count("*").alias("owners"), F.sum("repos").alias("repositories"), F.sum("n").alias("occurrences")))
    found = each.drop("owner", "repository").join(stats, "hash")
    rank = "CASE kind WHEN 'assign' THEN 0 WHEN 'access' THEN 1 WHEN 'hex' THEN 2 ELSE 3 END"
    group = f"CASE WHEN owners >= {copied_owners} OR repositories >= {copied_repositories} THEN 'copied' WHEN live THEN 'live' ELSE 'plain' END"
    counts = "owners, repositories, occurrences"
    found = found.selectExpr("row", "kind", "start", "stop", f"{rank} AS rank", f"{group} AS class", *counts.split(", ")).where("kind <> 'wide' OR class = 'live'")
    found = found.selectExpr("row", f"struct(start, rank, CASE WHEN kind = 'wide' THEN 'live' ELSE kind END AS kind, stop, class, {counts}) AS s")
    lists = found.groupBy("row").agg(F.sort_array(F.collect_list("s")).alias("spans"))
    kind = "array<struct<start long, rank int, kind string, stop long, class string, owners long, repositories long, occurrences long>>"
    return rows.select("row", "doc_id").join(lists, "row", "left").select("doc_id", F.coalesce("spans", F.array().cast(kind)).alias("spans"))


def op1_secrets(spark, sf_dir):
    """Owner is the source; a repository is a source's part in one language. The counts are by span, in the order of spans."""
    found = ownership(table(spark, sf_dir, "documents"), "source", "concat_ws('/', source, lang)")
    text = "array_join(transform({}, s -> concat(s.kind, ':', s.start, ':', s.stop)), ',')"
    return found.selectExpr(
        "doc_id", *[f"cast(size(filter(spans, s -> s.kind = '{k}')) AS long) AS n_{k}" for k in LEAST],
        f"sha2({text.format('filter(spans, s -> s.rank < 3)')}, 256) AS base_sha256", f"{text.format('spans')} AS spans",
        *[f"cast(size(filter(spans, s -> s.class = '{c}')) AS long) AS n_{c}" for c in ("live", "copied")],
        *[f"transform(spans, s -> s.{c}) AS {c}" for c in ("owners", "repositories", "occurrences")],
    )
