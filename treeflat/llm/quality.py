"""Quality scores: random-indexing word vectors, pooled per document, and a two-layer network.

Units.  Each word of a text (by white space) gives three units, each hashed to a fixed number of rows: the lower-cased word, its
shape (runs of upper case, lower case, digits; other marks as they are), and how it repeats what came before (the word before, the
one before that, a pair of words that the text had already).

Random indexing.  A unit's index vector has ``NONZERO`` entries of +1 or -1 at places given by its hash.  A unit's word
vector is the sum of the index vectors of the units around it over *all* documents: tasks add up whole numbers in a table of fixed size,
which Spark sums by unit.  The table (``UNITS`` x ``DIMENSION``) is all that is collected and broadcast, whatever the corpus.

Pooling.  A document is the mean of its units' normed vectors, kind by kind.

Network.  ``HIDDEN`` tanh units and one output, trained with Adam on at most ``TRAIN_ROWS`` labelled documents (the smallest hashes of the
id); a fifth of them, kept from training, sets the temperature by which the output is divided.

Defined results: null and empty texts pool to zero and are scored like others; without labels of both kinds the score is the
share of label 1 (0.5 without labels); null labels and null ids are not learned from; rows given twice are scored twice.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from treeflat.llm.common import keyed, ship, staged
from treeflat.llm.words import LOWER, PIECE, SPACE, hashes, mix, raw, slices, split

ship(__name__)

WORDS, SHAPES, REPEATS = 8192, 2048, 8
UNITS = WORDS + SHAPES + REPEATS
DIMENSION, NONZERO = 32, 2
TRAIN_ROWS = 12_000
HIDDEN, EPOCHS, BATCH, RATE, DECAY = 32, 60, 128, 3e-3, 1e-4
THRESHOLD = 0.3

#: Classes of bytes for shapes: X upper case, x lower case and what is outside ASCII, 9 digits, marks stay.
_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[65:91], _CLASS[97:123], _CLASS[48:58], _CLASS[128:] = ord("X"), ord("x"), ord("9"), ord("x")
_UNIT_HASH = mix(np.arange(1, UNITS + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
#: Places and signs of the index vectors.
PLACES = np.stack([(_UNIT_HASH >> np.uint64(8 * k)) % np.uint64(DIMENSION) for k in range(NONZERO)], 1).astype(np.int64)
SIGNS = np.stack([1 - 2 * ((_UNIT_HASH >> np.uint64(40 + k)) & np.uint64(1)).astype(np.int64) for k in range(NONZERO)], 1)


def _pieces(column: pa.Array):
    """(first row, bounds, bytes, whether the row goes on) of texts, long ones cut at white space into pieces of about ``PIECE`` bytes; short ones together."""
    data, at = raw(column)
    n, first = len(at) - 1, 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(at, at[first] + PIECE, "right")) - 1)
        low, high = int(at[first]), int(at[last])
        while True:
            end = min(high, low + 2 * PIECE)
            if end < high:
                space = np.flatnonzero(SPACE[data[low:end]])
                if len(space):
                    end = low + int(space[-1]) + 1
                else:  # a very long word
                    further = np.flatnonzero(SPACE[data[end:high]])
                    end = end + int(further[0]) + 1 if len(further) else high
            yield first, np.clip(at[first : last + 1] - low, 0, end - low), data[low:end], end < high
            low = end
            if low >= high:
                break
        first = last


def units(column: pa.Array):
    """(first row, words per row, word units, shape units, repeat units, units of the word before) for runs of rows.

    A long text comes in several pieces; the pairs of words that it had already, its last two words and the units of the last one go on
    from piece to piece (at most 8 bytes a distinct pair), so the units are those of the text read in one.
    """
    none = np.zeros(0, np.uint64)
    had, last_words, last_units = none, none, None
    for first, bounds, data, more in _pieces(column):
        starts, ends = split(data, bounds, SPACE)
        counts = np.diff(np.searchsorted(starts, bounds))
        lower = hashes(LOWER[data], starts, ends)
        kind = _CLASS[data]
        # of a run of one class only the first byte counts
        fresh = np.empty(len(kind), bool)
        fresh[:1] = True
        fresh[1:] = kind[1:] != kind[:-1]
        fresh[starts] = True
        step = np.concatenate([[0], np.cumsum(fresh)])
        shape = hashes(kind[fresh], step[starts], step[ends]) if len(starts) else np.zeros(0, np.uint64)
        row = np.repeat(np.arange(len(counts)), counts)
        n = len(lower)
        repeats = np.zeros(n, np.int64)
        if n:
            # the last words of the piece before stand in front, for what is compared with the word before
            back = len(last_words)
            line, whose = np.concatenate([last_words, lower]), np.concatenate([np.zeros(back, row.dtype), row])
            seen = np.zeros(back + n, np.int64)
            seen[1:] += (line[1:] == line[:-1]) & (whose[1:] == whose[:-1])
            seen[2:] += 2 * ((line[2:] == line[:-2]) & (whose[2:] == whose[:-2]))
            pair = (mix(line[1:] + np.uint64(3) * line[:-1]) ^ (whose[1:].astype(np.uint64) << np.uint64(44)))[max(back - 1, 0) :]
            order = np.argsort(pair, kind="stable")
            again = np.isin(pair, had) if len(had) else np.zeros(len(pair), bool)
            again[order[1:]] |= pair[order[1:]] == pair[order[:-1]]
            at = max(back, 1)
            seen[at:] += 4 * (again & (whose[at:] == whose[at - 1 : -1]))
            repeats = seen[back:]
            if more:
                had, last_words = np.union1d(had, pair), line[-2:]
        kinds = (lower % np.uint64(WORDS)).astype(np.int64), WORDS + (shape % np.uint64(SHAPES)).astype(np.int64), WORDS + SHAPES + repeats
        yield first, counts, *kinds, last_units
        if not more:
            had, last_words, last_units = none, none, None
        elif n:
            last_units = [int(k[-1]) for k in kinds]


def add_contexts(table: np.ndarray, counts: np.ndarray, words: np.ndarray, shapes: np.ndarray, repeats: np.ndarray, before: list[int] | None = None) -> None:
    """Add to each unit's row of ``table`` (flat) the index vectors of the units around it; ``before``: units of the word before the first."""
    row = np.repeat(np.arange(len(counts)), counts)
    same = row[1:] == row[:-1]
    of, context = [words, shapes, repeats, shapes], [shapes, repeats, shapes, words]
    for kind in (words, shapes, repeats):
        a, b = kind[:-1][same], kind[1:][same]
        of += [a, b]
        context += [b, a]
    if before is not None and len(words):
        for unit, kind in zip(before, (words, shapes, repeats)):
            of += [np.array([unit]), kind[:1]]
            context += [kind[:1], np.array([unit])]
    of, context = np.concatenate(of), np.concatenate(context)
    for k in range(NONZERO):
        table += np.bincount(of * DIMENSION + PLACES[context, k], SIGNS[context, k], len(table)).astype(np.int64)


def word_vectors(docs: DataFrame, key: str = "doc_id", text: str = "text") -> np.ndarray:
    """The normed vectors of all units, learned from every document."""

    def run(batches):
        table = np.zeros(UNITS * DIMENSION, np.int64)
        for b in batches:
            for _, *found in units(b.column(1)):
                add_contexts(table, *found)
        table = table.reshape(UNITS, DIMENSION)
        used = np.flatnonzero(table.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(used), *(pa.array(table[used, d]) for d in range(DIMENSION))], ["unit", *(f"v{d}" for d in range(DIMENSION))])

    each = keyed(docs, key, text).mapInArrow(run, "unit long, " + ", ".join(f"v{d} long" for d in range(DIMENSION)))
    summed = each.groupBy("unit").agg(*[F.sum(f"v{d}").alias(f"v{d}") for d in range(DIMENSION)]).toArrow()  # at most UNITS rows
    out = np.zeros((UNITS, DIMENSION), np.float32)
    if summed.num_rows:
        vectors = np.stack([summed.column(f"v{d}").to_numpy() for d in range(DIMENSION)], 1).astype(np.float64)
        out[summed.column("unit").to_numpy()] = vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
    return out


def pooled(column: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """A row per text: the means of its units' vectors, kind by kind."""
    out = np.zeros((len(column), 3 * DIMENSION), np.float64)
    words_of = np.zeros(len(column))
    for first, counts, *kinds, _ in units(column):
        rows = np.flatnonzero(counts)
        if not len(rows):
            continue
        at = slices(counts)[:-1][rows]
        for k, unit in enumerate(kinds):
            out[first + rows, k * DIMENSION : (k + 1) * DIMENSION] += np.add.reduceat(vectors[unit], at, axis=0)
        words_of[first + rows] += counts[rows]
    return out / np.maximum(words_of, 1)[:, None]


class Network:
    """Standardised inputs, a tanh layer, one output divided by a temperature."""

    def __init__(self, x: np.ndarray, y: np.ndarray, seed: int = 0):
        rng = np.random.default_rng(seed)
        order = rng.permutation(len(x))
        held = max(1, len(x) // 5)
        check, fit = order[:held], order[held:]
        self.mean, self.scale = x[fit].mean(0), x[fit].std(0) + 1e-6
        z = self._inputs(x)
        shapes = [(x.shape[1], HIDDEN), (HIDDEN,), (HIDDEN,), ()]
        p = [rng.normal(0, 1 / np.sqrt(x.shape[1]), shapes[0]), np.zeros(HIDDEN), rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(())]
        m, v, step = [np.zeros(s) for s in shapes], [np.zeros(s) for s in shapes], 0
        for _ in range(EPOCHS):
            rng.shuffle(fit)
            for a in range(0, len(fit), BATCH):
                b = fit[a : a + BATCH]
                h = np.tanh(z[b] @ p[0] + p[1])
                d = (self._sigmoid(h @ p[2] + p[3]) - y[b]) / len(b)
                back = np.outer(d, p[2]) * (1 - h * h)
                gradient = [z[b].T @ back + DECAY * p[0], back.sum(0), h.T @ d + DECAY * p[2], d.sum()]
                step += 1
                for k, g in enumerate(gradient):
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    p[k] = p[k] - RATE * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
        self.p, self.temperature = p, 1.0
        logits = self.logits(x[check])
        # the temperature with the least log loss on the rows kept from training
        candidates = np.exp(np.linspace(np.log(0.25), np.log(8), 141))
        losses = [np.mean(np.logaddexp(0, np.where(y[check] > 0.5, -1, 1) * logits / t)) for t in candidates]
        self.temperature = float(candidates[int(np.argmin(losses))])

    @staticmethod
    def _sigmoid(x: np.ndarray) -> np.ndarray:
        return 0.5 * (1 + np.tanh(0.5 * x))

    def _inputs(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8)

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(self._inputs(x) @ self.p[0] + self.p[1]) @ self.p[2] + self.p[3]

    def scores(self, x: np.ndarray) -> np.ndarray:
        return self._sigmoid(self.logits(x) / self.temperature)


class Constant:
    """The score of all documents where labels of both kinds are wanting."""

    def __init__(self, value: float):
        self.value = value

    def scores(self, x: np.ndarray) -> np.ndarray:
        return np.full(len(x), self.value)


def train(docs: DataFrame, labels: DataFrame, vectors: np.ndarray, key: str = "doc_id", text: str = "text", label: str = "quality"):
    """A network fitted on at most ``TRAIN_ROWS`` of ``labels`` (key, label)."""
    sent = docs.sparkSession.sparkContext.broadcast(vectors)
    known = labels.select(F.col(key).cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")).filter("doc_id IS NOT NULL AND y IN (0, 1)")
    chosen = known.groupBy("doc_id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_ROWS)
    rows = staged(keyed(docs, key, text).join(F.broadcast(chosen), "doc_id").select("y", "text"), "quality-rows")  # TRAIN_ROWS bounds what is broadcast

    def run(batches):
        for b in batches:
            x = pooled(b.column(1), sent.value)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(x[:, k]) for k in range(x.shape[1]))], ["y", *(f"x{k}" for k in range(x.shape[1]))])

    got = rows.mapInArrow(run, "y int, " + ", ".join(f"x{k} double" for k in range(3 * DIMENSION))).toArrow()
    y = got.column("y").to_numpy().astype(np.float64)
    if len(y) < 10 or y.min() == y.max():
        return Constant(float(y.mean()) if len(y) else 0.5)
    x = np.stack([got.column(f"x{k}").to_numpy() for k in range(3 * DIMENSION)], 1)
    order = np.lexsort((*x.T[:4], y))  # the order of arrival must not matter
    return Network(x[order], y[order])


def score(docs: DataFrame, vectors: np.ndarray, model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, score, predicted for every row."""
    sent = docs.sparkSession.sparkContext.broadcast((vectors, model))

    def run(batches):
        vectors, model = sent.value
        for b in batches:
            s = np.clip(model.scores(pooled(b.column(1), vectors)), 0.0, 1.0)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s), pa.array((s >= THRESHOLD).astype(np.int32))], ["doc_id", "score", "predicted"])

    return keyed(docs, key, text).mapInArrow(run, "doc_id long, score double, predicted int")
