"""Product codes of vectors, in integers only: nearest entries are found over Walsh-Hadamard coefficients.

Every component becomes ``floor(256 * x)``.  A vector is cut into ``PARTS`` equal parts, each with a codebook of at most
``ENTRIES`` entries.  To find a part's nearest entry, parts and entries are padded with zeros to a power of two ``m`` and
transformed by the Walsh-Hadamard transform, whose rows are taken in order of sequency (number of sign changes).  The
squared differences of the coefficients are sums of non-negative terms that add up to exactly ``m`` times the
squared distance, so they are added coefficient by coefficient, and an entry goes as soon as its sum is *above* the full sum of the
entry that led after the first coefficients.  Ties stay to the end, where the lower index wins.  No floating point takes part.

Each round is one pass over the vectors: tasks add up counts and sums per (part, entry, position), at most
``PARTS * ENTRIES * length`` numbers a task, which meet in a grouped sum; only that sum (one codebook) comes to the driver and
goes out again.  Vectors are never shuffled.

Defined results: rows are dropped whose vector is null, empty, or holds null or non-finite components.  The first codebook is made of the smallest
kept ids: an id given more than once counts once, with its lexicographically smallest vector; null ids are no first
entries, but their rows are coded like all others.  With fewer than ``ENTRIES`` ids the codebook is smaller; with none (all ids
null) nothing can be coded, and a ``ValueError`` says so, as it does for vectors of different lengths or a length that
``PARTS`` does not divide.  Repeated rows stay.  Large components are worked out in Python integers instead of 64 bits, with the same
results (``error`` and ``label_error`` are null where 64 bits cannot hold them); beyond 2^80 a ``ValueError`` names the bound.
"""

from __future__ import annotations

from decimal import Decimal
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from treeflat.llm.common import released, ship, staged

ship(__name__)

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
#: Coefficients that are looked at for all entries before the first ones go.
LEAD = 2
#: Vectors that are compared together.
BLOCK = 4096
_LARGEST = 2.0**80


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce((F.size(vector) > 0) & finite, F.lit(False))


def quantised(values: np.ndarray) -> np.ndarray:
    """floor(256 * x): 64-bit integers, or Python integers where these would not do."""
    scaled = np.floor(values.astype(np.float64) * SCALE)  # a power of two: exact
    most = float(np.abs(scaled).max(initial=0.0))
    if most >= _LARGEST * SCALE:
        raise ValueError("components beyond 2^80 are not supported")
    if most < 2.0**62:
        return scaled.astype(np.int64)
    return np.array([int(x) for x in scaled.ravel()], object).reshape(scaled.shape)


def sequency_order(m: int) -> list[int]:
    """Rows of the Hadamard matrix of size ``m`` by their number of sign changes."""
    signs = [[bin(i & j).count("1") & 1 for j in range(m)] for i in range(m)]
    return sorted(range(m), key=lambda i: sum(a != b for a, b in zip(signs[i], signs[i][1:])))


def transformed(parts: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard coefficients of each row, zero-padded, in order of sequency."""
    m = 1
    while m < parts.shape[1]:
        m *= 2
    x = np.zeros((len(parts), m), parts.dtype)
    x[:, : parts.shape[1]] = parts
    half = 1
    while half < m:
        y = x.reshape(len(x), m // (2 * half), 2, half)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], 2).reshape(len(x), m)
        half *= 2
    return x[:, sequency_order(m)]


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the nearest entry, squared distance) of every row of ``parts``; ties to the lower index."""
    m = 1
    while m < parts.shape[1]:
        m *= 2
    spread = max((int(np.abs(a).max()) for a in (parts, entries) if a.size), default=0)
    if m * m * (2 * spread) ** 2 >= 2**62 and parts.dtype != object:
        parts = parts.astype(object)
    if parts.dtype == object or entries.dtype == object:
        parts, entries = parts.astype(object), entries.astype(object)
    codes, found = np.zeros(len(parts), np.int64), np.zeros(len(parts), parts.dtype)
    c = transformed(entries)
    for low in range(0, len(parts), BLOCK):
        x = transformed(parts[low : low + BLOCK])
        lead = min(LEAD, m)
        sums = ((x[:, None, :lead] - c[None, :, :lead]) ** 2).sum(2)
        first = sums.argmin(1)
        bound = ((x - c[first]) ** 2).sum(1)
        row, entry = np.nonzero(sums <= bound[:, None])  # by row, then by entry
        left = sums[row, entry]
        for k in range(lead, m):
            left = left + (x[row, k] - c[entry, k]) ** 2
            stay = left <= bound[row]
            row, entry, left = row[stay], entry[stay], left[stay]
        starts = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
        least = np.minimum.reduceat(left, starts)
        best = np.flatnonzero(left == np.repeat(least, np.diff(np.append(starts, len(row)))))
        _, lowest = np.unique(row[best], return_index=True)
        codes[low : low + len(x)] = entry[best[lowest]]
        found[low : low + len(x)] = least // m
    return codes, found


def _matrix(column: pa.Array, length: int) -> np.ndarray:
    if len(column) and not (np.diff(np.asarray(column.offsets)) == length).all():
        raise ValueError(f"vectors of different lengths; the one of the smallest id has {length} components")
    return quantised(np.asarray(column.flatten()).reshape(len(column), length))


def first_codebooks(kept: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> list[np.ndarray]:
    """One matrix per part: that part of the smallest ids' vectors."""
    ids = [r["vec_id"] for r in kept.filter("vec_id IS NOT NULL").select("vec_id").distinct().orderBy("vec_id").limit(entries).collect()]
    if not ids:
        raise ValueError("no vector with an id: no codebook")
    rows = kept.filter(F.col("vec_id").isin(ids)).groupBy("vec_id").agg(F.min("vector").alias("vector"), F.min(F.size("vector")).alias("least"), F.max(F.size("vector")).alias("most"))
    found = sorted(rows.collect(), key=lambda r: r["vec_id"])  # at most ENTRIES
    if len({n for r in found for n in (r["least"], r["most"])}) > 1 or found[0]["most"] % parts:
        raise ValueError(f"vectors must have one length that {parts} divides")
    vectors = quantised(np.array([r["vector"] for r in found], np.float64))
    return [np.ascontiguousarray(p) for p in np.split(vectors, parts, axis=1)]


def improved(kept: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """The codebooks after one round: each used entry is the floor of the mean of its parts."""
    sent = kept.sparkSession.sparkContext.broadcast(books)  # one codebook

    def run(batches):
        books = sent.value
        width = books[0].shape[1]
        sums = [np.zeros(b.shape, object) for b in books]
        counts = [np.zeros(len(b), np.int64) for b in books]
        for batch in batches:
            x = _matrix(batch.column(1), width * len(books))
            for p, book in enumerate(books):
                part = x[:, p * width : (p + 1) * width]
                codes, _ = nearest(part, book)
                counts[p] += np.bincount(codes, minlength=len(book))
                order = np.argsort(codes, kind="stable")
                used, starts = np.unique(codes[order], return_index=True)
                if len(used):
                    # the batch's sums in 64 bits where they fit; the task's in Python integers
                    rows = part[order] if part.dtype == object or len(part) * int(np.abs(part).max()) < 2**62 else part[order].astype(object)
                    sums[p][used] += np.add.reduceat(rows, starts, axis=0).astype(object)
        at = [(p, e, k) for p, b in enumerate(books) for e in np.flatnonzero(counts[p]).tolist() for k in range(width)]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([p for p, _, _ in at], pa.int32()), pa.array([e for _, e, _ in at], pa.int32()), pa.array([k for _, _, k in at], pa.int32()),
                pa.array([int(counts[p][e]) for p, e, _ in at], pa.int64()), pa.array([Decimal(int(sums[p][e, k])) for p, e, k in at], pa.decimal128(38, 0)),
            ],
            ["part", "entry", "position", "n", "total"],
        )

    partial = kept.mapInArrow(released(run), "part int, entry int, position int, n long, total decimal(38,0)")
    out = [b.copy() for b in books]
    for r in partial.groupBy("part", "entry", "position").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect():  # one codebook
        mean = int(r["total"]) // r["n"]
        if out[r["part"]].dtype != object and abs(mean) >= 2**62:
            out[r["part"]] = out[r["part"]].astype(object)
        out[r["part"]][r["entry"], r["position"]] = mean
    return out


def codebooks_digest(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(int(v)) for b in books for v in b.ravel()).encode()).hexdigest()


def encoded(kept: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """vec_id, label, code, error of every kept row."""
    sent = kept.sparkSession.sparkContext.broadcast(books)  # one codebook

    def run(batches):
        books = sent.value
        width = books[0].shape[1]
        for batch in batches:
            x = _matrix(batch.column(1), width * len(books))
            codes, errors = np.zeros((len(x), len(books)), np.uint8), np.zeros(len(x), object)
            for p, book in enumerate(books):
                found, distance = nearest(x[:, p * width : (p + 1) * width], book)
                codes[:, p] = found
                errors += distance.astype(object)
            hexes = codes.tobytes().hex()
            wide = 2 * len(books)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(2), pa.array([hexes[k * wide : (k + 1) * wide] for k in range(len(x))], pa.string()),
                    pa.array([int(e) if e < 2**63 else None for e in errors], pa.int64()),
                ],
                ["vec_id", "label", "code", "error"],
            )

    label = kept.schema["label"].dataType.simpleString()
    return kept.mapInArrow(released(run), f"vec_id long, label {label}, code string, error long")


def vector_codes(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every usable row of ``vectors``."""
    if not 0 < entries <= 256:
        raise ValueError("an index has two hex digits: 1 to 256 entries")
    columns = vectors.select(F.col(f"`{key}`").cast("long").alias("vec_id"), F.col(f"`{vector}`").alias("vector"), F.col(f"`{label}`").alias("label"))
    kept = columns.filter(usable(F.col("vector")))
    if kept.isEmpty():
        return kept.select("vec_id", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"), F.lit(0).cast("long").alias("label_error"), F.lit("").alias("codebooks_sha256"))
    books = first_codebooks(kept, parts, entries)
    for _ in range(rounds):
        books = improved(kept, books)
    rows = staged(encoded(kept, books), "vector-codes")
    # the sums are written first: the join may broadcast them if small, and split a label that holds many rows if not
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    complete = F.count("error") == F.count(F.lit(1))
    sums = rows.groupBy("label").agg(F.when(complete & (total < F.lit(Decimal(2**63))), total).cast("long").alias("label_error"))
    sums = staged(sums.select(F.col("label").alias("of"), "label_error"), "vector-label-errors")
    return rows.join(sums, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", "code", "error", "label_error", F.lit(codebooks_digest(books)).alias("codebooks_sha256")
    )
