"""Product codes of vectors over whole numbers: nearest entries by limb-split matrix products that are exact."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetpulse.llm.common import table
from assetpulse.session import materialize

#: Bits of a limb. A product of two limbs stays below 2**24, so a float64 sum over up to 2**29 components is exact.
LIMB_BITS = 12

KEPT = "embedding IS NOT NULL AND forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('inf'))"


def limbs(x: np.ndarray, bits: int = LIMB_BITS) -> list[np.ndarray]:
    """x as float64 limbs, lowest first: x = sum(limb[i] * 2**(bits * i)). All but the last lie in [0, 2**bits); the last,
    which carries the sign, in [-2**bits, 2**bits)."""
    out, rest = [], x
    while True:
        if not rest.size or (rest.min() >= -(1 << bits) and rest.max() < 1 << bits):
            return [*out, rest.astype("float64")]
        out.append((rest & ((1 << bits) - 1)).astype("float64"))
        rest = rest >> bits


def exact_dots(x: np.ndarray, y: np.ndarray, bits: int = LIMB_BITS) -> np.ndarray:
    """Dot products of the int64 rows of x with those of y. Every float64 product of two limb matrices stays below 2**53,
    so it is exact; the limbs' products are put together in int64."""
    if 2 * bits + max(1, x.shape[1]).bit_length() > 53:
        raise ValueError(f"limbs of {bits} bits are too wide for {x.shape[1]} components")
    total = np.zeros((len(x), len(y)), "int64")
    right = limbs(y, bits)
    for i, a in enumerate(limbs(x, bits)):
        for j, b in enumerate(right):
            total += (a @ b.T).astype("int64") << (bits * (i + j))
    return total


def nearest(x: np.ndarray, book: np.ndarray, bits: int = LIMB_BITS) -> tuple[np.ndarray, np.ndarray]:
    """First nearest entry of each row and its squared distance."""
    distance = (x * x).sum(axis=1)[:, None] - 2 * exact_dots(x, book, bits) + (book * book).sum(axis=1)[None, :]
    chosen = distance.argmin(axis=1)
    return chosen, distance[np.arange(len(x)), chosen]


def in_parts(cells, books: np.ndarray) -> np.ndarray:
    """An Arrow list column as (rows, parts, components)."""
    return cells.flatten().to_numpy(zero_copy_only=False).reshape(len(cells), books.shape[0], books.shape[2])


def assigned(batches: Iterator, books: np.ndarray) -> Iterator[tuple]:
    """(batch, its vectors in parts, chosen entries, squared distances), the last two by part."""
    for batch in batches:
        if batch.num_rows:
            x = in_parts(batch.column("cells"), books)
            found = [nearest(x[:, p], book) for p, book in enumerate(books)]
            yield batch, x, np.stack([f[0] for f in found], axis=1), np.stack([f[1] for f in found], axis=1)


def moved(books: np.ndarray) -> Callable[[Iterator], Iterator]:
    """Per task and entry: how many parts chose it, and their componentwise sums."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        parts, size, width = books.shape
        counts, sums = np.zeros((parts, size), "int64"), np.zeros((parts, size, width), "int64")
        for _, x, chosen, _ in assigned(batches, books):
            for p in range(parts):
                counts[p] += np.bincount(chosen[:, p], minlength=size)
                np.add.at(sums[p], chosen[:, p], x[:, p])
        part, entry = np.nonzero(counts)
        rows = {"part": part, "entry": entry, "n": counts[part, entry], "total": list(sums[part, entry])}
        yield pa.RecordBatch.from_pydict(rows, pa.schema([("part", pa.int64()), ("entry", pa.int64()), ("n", pa.int64()), ("total", pa.list_(pa.int64()))]))

    return run


def coded(books: np.ndarray) -> Callable[[Iterator], Iterator]:
    """vec_id, label, code, error."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch, _, chosen, distance in assigned(batches, books):
            code = [bytes(row).hex() for row in chosen.astype("uint8")]
            columns = [batch.column("vec_id"), batch.column("label"), pa.array(code, "string"), pa.array(distance.sum(axis=1), "int64")]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "label", "code", "error"])

    return run


def vector_codes(vectors: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of each vector without null or non-finite components.

    Components become floor(scale * x). A part's codebook starts as that part of the `entries` least vec_ids (a null id comes
    last; rows that share an id go by their components, so all copies may be among them; fewer rows give fewer entries). Each
    round reads the vectors once, adds up by entry within its tasks, and brings parts x entries sums to the driver. Entries are
    replaced by floor(sum / count), unused ones stay. Repeated rows give repeated results; no rows give none. Vectors of unlike
    lengths, of a length that parts does not divide, or too large for exact 64-bit distances raise ValueError."""
    if not 0 < entries <= 256:
        raise ValueError("an entry's index has two hex digits")
    rows = vectors.where(KEPT).selectExpr(
        "vec_id", "label", f"transform(embedding, x -> floor({scale} * double(x))) AS cells",
        f"coalesce(array_max(transform(embedding, x -> abs({scale} * double(x)))), 0D) AS reach",
    )
    least, most, reach = rows.agg(F.min(F.size("cells")), F.max(F.size("cells")), F.max("reach")).first()
    dim = most or 0
    if least != most or dim % parts:
        raise ValueError(f"vectors of {least} to {most} components; all must have one length that {parts} divides")
    if 4.0 * ((reach or 0.0) + 1) ** 2 * max(dim, 1) >= 2.0**63:
        raise ValueError("components are too large for exact 64-bit distances")
    kept = rows.drop("reach")
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "cells").limit(entries).select("cells").collect()
    books = np.array([r["cells"] for r in first], "int64").reshape(len(first), parts, dim // parts).transpose(1, 0, 2)
    for _ in range(rounds):
        totals = kept.select("cells").mapInArrow(moved(books), "part long, entry long, n long, total array<long>")
        cells = totals.selectExpr("part", "entry", "n", "posexplode_outer(total) AS (at, v)")
        sums = cells.groupBy("part", "entry", "at").agg(F.sum("n").alias("n"), F.sum("v").alias("v"))
        books = books.copy()
        for r in sums.where("at IS NOT NULL").collect():  # parts x entries x components of a part
            books[r["part"], r["entry"], r["at"]] = r["v"] // r["n"]
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    kinds = {f.name: f.dataType.simpleString() for f in kept.schema}
    out = materialize(kept.mapInArrow(coded(books), f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long"))
    by_label = out.groupBy(F.col("label").alias("of_label")).agg(F.sum("error").alias("label_error"))
    joined = out.join(by_label, F.col("label").eqNullSafe(F.col("of_label")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def op13_vector_codes(spark, sf_dir):
    return vector_codes(table(spark, sf_dir, "embeddings"))


def sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """The same codes from one row per component, distances by subtraction."""
    steps = [
        "kept AS MATERIALIZED (SELECT vec_id, label, row_number() OVER () AS r, embedding AS e FROM embeddings"
        " WHERE embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND coalesce(isfinite(x), false))))",
        f"cells AS MATERIALIZED (SELECT r, (i - 1) // (len(e) // {parts}) AS part, (i - 1) % (len(e) // {parts}) AS pos, "
        "CAST(floor(4096 * CAST(e[i] AS DOUBLE)) AS BIGINT) AS v FROM (SELECT r, e, unnest(range(1, len(e) + 1)) AS i FROM kept))",
        "starts AS (SELECT r, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept)",
        f"b0 AS MATERIALIZED (SELECT part, entry, pos, v FROM cells JOIN starts USING (r) WHERE entry < {entries})",
    ]
    for k in range(rounds + 1):
        steps.append(
            f"d{k} AS MATERIALIZED (SELECT c.r, c.part, b.entry, sum((c.v - b.v) * (c.v - b.v)) AS d FROM cells c JOIN b{k} b "
            "ON c.part = b.part AND c.pos = b.pos GROUP BY ALL)"
        )
        steps.append(f"a{k} AS MATERIALIZED (SELECT r, part, min(d) AS d, arg_min(entry, struct_pack(d := d, entry := entry)) AS entry FROM d{k} GROUP BY ALL)")
        if k < rounds:
            floor = "(sum(v) - ((sum(v) % count(*) + count(*)) % count(*))) // count(*)"
            steps.append(f"m{k} AS (SELECT part, entry, pos, {floor} AS v FROM cells JOIN a{k} USING (r, part) GROUP BY ALL)")
            steps.append(f"b{k + 1} AS MATERIALIZED (SELECT part, entry, pos, CAST(coalesce(m.v, b.v) AS BIGINT) AS v FROM b{k} b LEFT JOIN m{k} m USING (part, entry, pos))")
    steps.append(f"digest AS (SELECT sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY part, entry, pos)) AS h FROM b{rounds})")
    steps.append(f"done AS (SELECT r, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d) AS error FROM a{rounds} GROUP BY r)")
    return (
        f"WITH {', '.join(steps)} SELECT vec_id, code, CAST(error AS BIGINT) AS error, "
        "CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256 FROM kept JOIN done USING (r), digest"
    )
