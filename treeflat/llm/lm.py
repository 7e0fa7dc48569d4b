"""N-gram language model: interpolated modified Kneser-Ney, counted in Spark, kept as sorted hash arrays, scored by memory map.

Counting.  Texts are read ``SHARES`` times; each pass counts the n-grams whose last word but one falls into its share of the words, so
contexts and suffixes are whole within a pass, and its shuffle files go before the next one writes its own.  Tasks send n-grams as compressed blocks, one for
each range of hashes, those of the highest order by their context, so a context's followers meet in one task.  A range is merged by one task,
which writes its files and sends on the suffixes with continuation counts, which are the n-grams of the order below, and from there on down
the statistics of contexts (total, and how many followers have count 1, 2, 3 or more).  Words and the contexts of lower orders are merged after
the passes.  The number of ranges follows from the bytes of the texts and the order, so what a task holds is bounded by that and the
different followers of one context; hot n-grams come once per block.

Model.  p_k(w|h) = max(c - D(c), 0) / total(h) + gamma(h) p_(k-1)(w|h'), down to the uniform 1/(V+1); c is the count for the highest
order and the number of different words before the n-gram below it; the three discounts of an order come from its counts of counts.

Files.  Followers stand under their context, 48 bits of their hash each; contexts that were seen once are keys with one follower.  Below the highest
order, an n-gram that does not end a text is a context of the order above: only counts above 1 and ends of texts have files.  Counts take one byte;
larger ones stand, whole, in a file of their own.

Scoring.  Workers map the files of the shared folder, at most ``MAPS`` at a time, and look up sorted queries; nothing is loaded whole, documents are not
shuffled.  The shared folder must be a mounted path (``file:``), since memory maps need one.

Tokens.  A-Z is lower-cased; words are runs without white space; one end token closes a text.  Defined results: null and empty texts are
their end token; null ids are scored; rows given twice are counted and scored twice; without training text V and N are 0 and each token has
probability 1.
"""

from __future__ import annotations

from contextlib import contextmanager
from functools import reduce
import os
import struct
from urllib.parse import urlparse
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
import zstandard

from treeflat.llm.common import fresh_folder, keyed, released, ship, staged
from treeflat.llm.words import mix, slices, word_hashes

ship(__name__)

#: Text bytes for each range of n-gram hashes, for two words in an n-gram; fewer in proportion for more words.
RANGE_BYTES = 24 * 1024 * 1024
#: Tokens that are looked up together, and that are counted before a task sends them on.
LOOK_UP, COUNT_UP = 1_000_000, 3_000_000
#: Files that a worker keeps mapped.
MAPS = 4096
#: Passes over the texts: more take less disk while training and more time.
SHARES = 2
#: Counts from here on do not fit into a byte.
LARGE = np.uint64(2**8 - 1)
BEGIN, END = np.uint64(0x6A09E667F3BCC909), np.uint64(0xBB67AE8584CAA73B)
_STEP = np.uint64(0xD6E8FEB86659FD93)
_GRAMS, _CONTEXTS, _STATS = 0, 1, 2
_BLOCKS = "kind int, level int, part long, block binary"


def gram_hash(words: list[np.ndarray]) -> np.ndarray:
    """One hash for each row of the word columns, the first word first."""
    out = np.full(len(words[0]) if words else 1, np.uint64(len(words)))
    for column in words:
        out = mix(out * _STEP + column)
    return out


def grams(counts: np.ndarray, words: np.ndarray, order: int) -> tuple[list[np.ndarray], np.ndarray]:
    """(word columns of the n-gram that ends at each token, tokens per row); begin markers stand before a text."""
    lengths = counts + order
    at = slices(lengths)
    padded = np.full(int(at[-1]), BEGIN, np.uint64)
    inner = np.arange(len(words)) - np.repeat(slices(counts)[:-1], counts)
    padded[np.repeat(at[:-1] + order - 1, counts) + inner] = words
    if len(counts):
        padded[at[1:] - 1] = END
    tokens = counts + 1
    first = np.repeat(at[:-1], tokens) + np.arange(int(tokens.sum())) - np.repeat(slices(tokens)[:-1], tokens)
    return [padded[first + k] for k in range(order)], tokens


def _merge(keys: np.ndarray, columns: list[np.ndarray], sums: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """Rows with equal keys made one, in the order of the keys."""
    order = np.argsort(keys)
    keys = keys[order]
    if not len(keys):
        return keys, columns, sums
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[first], [c[order][first] for c in columns], [np.add.reduceat(s[order], first) for s in sums]


def _by(keys: np.ndarray, words: np.ndarray) -> np.ndarray:
    """The order of rows by key, then word: one sort of numbers of 64 bits after the other, which is faster than a sort by two columns."""
    order = np.argsort(keys)
    rank = np.cumsum(np.r_[False, np.diff(keys[order]) != 0]).astype(np.uint64)
    bits = np.uint64(max(1, int(rank[-1]).bit_length()))
    joint = rank << (np.uint64(64) - bits) | words[order] >> bits
    out = order[np.argsort(joint)]
    joint, words = np.sort(joint), words[out]
    if ((joint[1:] == joint[:-1]) & (words[1:] < words[:-1])).any():  # words that differ in their last bits only
        out = out[np.lexsort((words, joint))]
    return out


def _planes(column: np.ndarray, width: int) -> bytes:
    """Byte by byte: the high bytes are mostly zeros, which compress to nothing."""
    return column.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T.tobytes()


def _column(body: bytes, at: int, n: int, width: int) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(body, np.uint8, width * n, at).reshape(width, n).T).view(f"<u{width}").reshape(n).astype(np.uint64)


def _steps(column: np.ndarray) -> np.ndarray:
    """Differences of a sorted column, the first value first."""
    return np.diff(column, prepend=column.dtype.type(0))


def _pack(words: list[np.ndarray], sums: list[np.ndarray]) -> bytes:
    """Rows sorted by their words; each different word once (as steps), then places in that list."""
    if len(words) > 1:
        known, places = np.unique(np.concatenate(words), return_inverse=True)
        columns = list(places.reshape(len(words), -1).astype(np.uint32))
        bits = max(1, len(known).bit_length())
        if bits * len(columns) <= 64:
            joint = columns[0].astype(np.uint64)
            for c in columns[1:]:
                joint = joint << np.uint64(bits) | c
            order = np.argsort(joint)
        else:
            order = np.lexsort(columns[::-1])
        columns = [c[order] for c in columns]
        columns[0] = _steps(columns[0])
    else:
        order, columns = np.argsort(words[0], kind="stable"), []
        known = words[0][order]
    body = _planes(_steps(known), 8) + b"".join(_planes(c, 4) for c in columns) + b"".join(_planes(s[order], 8) for s in sums)
    head = struct.pack("<4I", len(words[0]), len(known), len(words), len(sums))
    return head + zstandard.ZstdCompressor(level=1).compress(body)


def _unpack(block: bytes) -> tuple[list[np.ndarray], list[np.ndarray]]:
    n, size, width, count = struct.unpack("<4I", block[:16])
    body = zstandard.ZstdDecompressor().decompress(block[16:])
    known, at = np.cumsum(_column(body, 0, size, 8), dtype=np.uint64), 8 * size
    if width == 1:
        words = [known]
    else:
        words = []
        for k in range(width):
            places = _column(body, at, n, 4)
            words.append(known[(np.cumsum(places) if k == 0 else places).astype(np.int64)])
            at += 4 * n
    sums = []
    for _ in range(count):
        sums.append(_column(body, at, n, 8))
        at += 8 * n
    return words, sums


def _blocks(kind: int, level: int, keys: np.ndarray, words: list[np.ndarray], sums: list[np.ndarray], parts: int):
    """One block for each range of keys; the keys must be sorted."""
    cuts = np.searchsorted(keys, _edges(parts))
    for p in range(parts):
        a, b = int(cuts[p]), int(cuts[p + 1]) if p + 1 < parts else len(keys)
        if b > a:
            yield kind, level, p, _pack([w[a:b] for w in words], [s[a:b] for s in sums])


def _edges(parts: int) -> np.ndarray:
    return np.array([(p << 64) // parts for p in range(parts)], np.uint64)


def _share(words: np.ndarray, shares: int) -> np.ndarray:
    return ((words >> np.uint64(32)) * np.uint64(shares) >> np.uint64(32)).astype(np.int64)


def _ranges(keys: np.ndarray, parts: int) -> np.ndarray:
    return np.searchsorted(_edges(parts), keys, "right") - 1


def _batches(rows):
    for kind, level, part, block in rows:
        yield pa.RecordBatch.from_arrays([pa.array([kind], pa.int32()), pa.array([level], pa.int32()), pa.array([part], pa.int64()), pa.array([block], pa.binary())], ["kind", "level", "part", "block"])


def _write(folder: str, name: str, array: np.ndarray) -> None:
    """A file that appears whole; a repeated task writes the same bytes again."""
    draft = f"{folder}/.{name}-{uuid.uuid4().hex}"
    array.tofile(draft)
    os.replace(draft, f"{folder}/{name}")


def _write_counts(folder: str, name: str, counts: np.ndarray) -> None:
    """A byte each; from ``LARGE`` on, place and count stand in a file beside."""
    _write(folder, name, np.minimum(counts, LARGE).astype(np.uint8))
    large = np.flatnonzero(counts >= LARGE)
    if len(large):
        _write(folder, f"{name}-large", np.stack([large.astype(np.uint64), counts[large]]))


def _count(order: int, parts: int, share: int, shares: int):
    def run(batches):
        def send(held):
            columns = [np.concatenate([h[k] for h in held]) for k in range(order)]
            keys, columns, (n,) = _merge(gram_hash(columns), columns, [np.ones(len(columns[0]), np.uint64)])
            if order == 1:
                yield from _batches(_blocks(_GRAMS, 1, keys, columns, [n, n], parts))
                return
            part = _ranges(gram_hash(columns[:-1]), parts)
            by = np.argsort(part.astype(np.uint16 if parts <= 65536 else np.int64), kind="stable")
            cuts = np.searchsorted(part[by], np.arange(parts + 1))
            for p in np.flatnonzero(np.diff(cuts)):
                own = by[cuts[p] : cuts[p + 1]]
                yield from _batches([(_GRAMS, order, int(p), _pack([c[own] for c in columns], [n[own]]))])

        held, size = [], 0
        for b in batches:
            for _, counts, words in word_hashes(b.column(0)):
                with np.errstate(over="ignore"):
                    columns, _ = grams(counts, words, order)
                if order > 1:
                    mine = _share(columns[-2], shares) == share
                    columns = [c[mine] for c in columns]
                held.append(columns)
                size += len(columns[0])
                if size >= COUNT_UP:
                    with np.errstate(over="ignore"):
                        yield from send(held)
                    held, size = [], 0
        if held:
            with np.errstate(over="ignore"):
                yield from send(held)

    return run


def _statistics(level: int, counts: np.ndarray, raw: np.ndarray) -> bytes:
    values = [len(counts), int(counts.sum()), *(int((counts == c).sum()) for c in (1, 2, 3, 4)), int(raw.sum())]
    return struct.pack("<7q", *values)


def _write_contexts(folder: str, name: str, keys: np.ndarray, sums: list[np.ndarray], once: np.ndarray) -> None:
    _write(folder, f"once-{name}", keys[once])
    _write(folder, f"contexts-{name}", keys[~once])
    _write_counts(folder, f"stats-{name}", np.stack([c[~once] for c in sums], 1).reshape(-1))


def _kinds(counts: np.ndarray) -> list[np.ndarray]:
    """What a context sums up over its followers."""
    return [counts, *(o.astype(np.uint64) for o in (counts == 1, counts == 2, counts > 2))]


def _tails(words: np.ndarray) -> np.ndarray:
    """The 48 bits of a follower that are kept, highest first."""
    return np.stack([words >> np.uint64(48), (words >> np.uint64(32)) & np.uint64(0xFFFF), (words >> np.uint64(16)) & np.uint64(0xFFFF)], 1).astype(np.uint16)


def _reduce(parts: int, folder: str, order: int, share: int, last: bool):
    """Merge the blocks of each range, write its files, send on contexts and suffixes; words and contexts wait for the last round."""

    def top(name: str, words: list[np.ndarray], sums: list[np.ndarray]):
        """The n-grams of the highest order, sorted by context and follower."""
        context = gram_hash(words[:-1])
        by = _by(context, words[-1])
        context, words = context[by], [w[by] for w in words]
        new = np.r_[True, context[1:] != context[:-1]]
        first = np.flatnonzero(new | np.r_[True, words[-1][1:] != words[-1][:-1]])
        counts = np.add.reduceat(sums[0][by], first)
        context, words, starts = context[first], [w[first] for w in words], np.flatnonzero(new[first])
        stats = [np.add.reduceat(c, starts) for c in _kinds(counts)]
        once = stats[0] == 1
        _write_contexts(folder, name, context[starts], stats, once)
        often = np.repeat(~once, np.diff(np.r_[starts, len(counts)]))
        _write(folder, f"followers-{name}", np.concatenate([_tails(words[-1][~often]), _tails(words[-1][often])]))
        _write_counts(folder, f"counts-{name}", counts[often])
        lengths = np.diff(np.r_[starts, len(counts)])[~once]
        _write(folder, f"starts-{name}", slices(lengths).astype(np.uint32))
        return words, counts, counts

    def merged(kind: int, level: int, part: int, held: list[bytes]):
        pieces = [_unpack(b) for b in held]
        words = [np.concatenate([w[k] for w, _ in pieces]) for k in range(len(pieces[0][0]))]
        sums = [np.concatenate([s[k] for _, s in pieces]) for k in range(len(pieces[0][1]))]
        del pieces
        held.clear()
        if kind == _CONTEXTS:
            keys, _, sums = _merge(words[0], [], sums)
            _write_contexts(folder, f"{level}-{part}", keys, sums, sums[0] == 1)
            return
        name = f"{level}-{share * parts + part}"
        if level == order > 1:
            words, counts, raw = top(name, words, sums)
        else:
            keys, words, (counts, raw) = _merge(gram_hash(words), words, sums)
            own = slice(None) if level == 1 else (counts > 1) | (words[-1] == END)
            _write(folder, f"keys-{name}", keys[own])
            _write_counts(folder, f"counts-{name}", counts[own])
        yield _STATS, level, part, _statistics(level, counts, raw)
        if level == 1:
            _write_counts(folder, f"raw-{part}", raw)
            return
        if level < order:
            context, _, sums = _merge(gram_hash(words[:-1]), [], _kinds(counts))
            yield from _blocks(_CONTEXTS, level, context, [context], sums, parts)
        suffix, columns, sums = _merge(gram_hash(words[1:]), words[1:], [np.ones(len(counts), np.uint64), raw])
        yield from _blocks(_GRAMS, level - 1, suffix, columns, sums, parts)

    def run(batches):
        at, held = None, []
        for b in batches:
            for row in b.to_pylist():
                key = (row["kind"], row["level"], row["part"])
                if row["kind"] == _STATS or not last and (row["kind"] == _CONTEXTS or row["level"] == 1):
                    yield from _batches([(*key, row["block"])])
                    continue
                if at is not None and key != at:
                    with np.errstate(over="ignore"):
                        yield from _batches(merged(*at, held))
                    held = []
                at = key
                held.append(row["block"])
        if held:
            with np.errstate(over="ignore"):
                yield from _batches(merged(*at, held))

    return run


def _discounts(n: list[int]) -> list[float]:
    """D1, D2, D3+ from the counts of counts; absent ones fall back to a plain absolute discount of 0.75 a step."""
    n1, n2, n3, n4 = n
    if not (n1 and n2):
        return [0.75, 0.75, 0.75]
    y = n1 / (n1 + 2 * n2)
    out = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 2 - 3 * y * n3 / n2]
    return [min(max(d, 0.0), float(k + 1)) for k, d in enumerate(out)]


@contextmanager
def _shuffles_removed(spark):
    """Spark removes the shuffle files of a job as the job ends: what the next one needs is staged."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def train(docs: DataFrame, order: int = 3, key: str = "doc_id", text: str = "text", folder: str | None = None) -> dict:
    """Count the texts of ``docs``; returns the small description that scoring needs (folder, ranges, totals, discounts)."""
    spark = docs.sparkSession
    place = urlparse(folder or fresh_folder(spark, "lm"))
    if place.scheme not in ("", "file"):
        raise ValueError("memory maps need a shared folder that is mounted as a path (file:)")
    os.makedirs(place.path, exist_ok=True)
    texts = keyed(docs, key, text).select("text")
    size = texts.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    shares = SHARES if order > 1 else 1
    parts = max(4, -(-size * max(order, 2) // (2 * RANGE_BYTES * shares)))

    def round_of(blocks: DataFrame, share: int, last: bool) -> DataFrame:
        return blocks.repartition(parts, "kind", "level", "part").sortWithinPartitions("kind", "level", "part").mapInArrow(released(_reduce(parts, place.path, order, share, last)), _BLOCKS)

    rest = []
    with _shuffles_removed(spark):
        for share in range(shares):
            chain = texts.mapInArrow(released(_count(order, parts, share, shares)), _BLOCKS)
            for _ in range(order - 1):
                chain = round_of(chain, share, False)
            rest.append(staged(chain, "lm-rest"))
        found = round_of(reduce(DataFrame.unionByName, rest), 0, True).collect()  # seven numbers for each range and order
    totals = {k: [0] * 7 for k in range(1, order + 1)}
    for r in found:
        if r["kind"] == _STATS:
            totals[r["level"]] = [a + b for a, b in zip(totals[r["level"]], struct.unpack("<7q", r["block"]))]
    return {
        "folder": place.path,
        "order": order,
        "parts": parts,
        "shares": shares,
        "vocabulary": totals[1][0],
        "tokens": totals[1][6],
        "discounts": {k: _discounts(t[2:6]) for k, t in totals.items()},
        "root": (totals[1][1], totals[1][2], totals[1][3], totals[1][0] - totals[1][2] - totals[1][3]),
    }


def _tail(rows: np.ndarray) -> np.ndarray:
    a, b, c = (rows[:, k].astype(np.uint64) for k in range(3))
    return a << np.uint64(32) | b << np.uint64(16) | c


class Model:
    """The files of a model, mapped when first asked for."""

    def __init__(self, model: dict):
        self.model = model
        self.edges = _edges(model["parts"])
        self.maps: dict[str, np.ndarray | None] = {}

    def _file(self, name: str, kind=np.uint64) -> np.ndarray | None:
        if name in self.maps:
            self.maps[name] = self.maps.pop(name)  # the last one used stands last
        else:
            path = f"{self.model['folder']}/{name}"
            self.maps[name] = np.asarray(np.memmap(path, kind, "r")) if os.path.exists(path) and os.path.getsize(path) else None
            if len(self.maps) > MAPS:
                del self.maps[next(iter(self.maps))]
        return self.maps[name]

    def _counts(self, name: str, at: np.ndarray) -> np.ndarray:
        """The counts at these places of a file."""
        out = self._file(name, np.uint8)[at].astype(np.float64)
        large = np.flatnonzero(out == LARGE)
        if len(large):
            places, counts = self._file(f"{name}-large").reshape(2, -1)
            out[large] = counts[np.searchsorted(places, at[large].astype(np.uint64))]
        return out

    def _dealt(self, keys: np.ndarray, share: np.ndarray | None = None):
        """(part, places in ``keys``) for every part that keys fall into, the places in the order of their keys."""
        order = np.argsort(keys)
        part = np.searchsorted(self.edges, keys[order], "right") - 1
        if share is not None:
            part += share[order] * self.model["parts"]
            by = np.argsort(part.astype(np.uint16 if self.model["parts"] * self.model["shares"] <= 65536 else np.int64), kind="stable")
            order, part = order[by], part[by]
        edges = np.flatnonzero(np.r_[True, part[1:] != part[:-1], True])
        for a, b in zip(edges[:-1], edges[1:]):
            yield int(part[a]), order[a:b]

    def _hits(self, name: str, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places in sorted ``keys``, places in the file) of the keys that the file has."""
        known = self._file(name)
        if known is None:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        hit = np.flatnonzero(known[at] == keys)
        return hit, at[hit]

    def words(self, keys: np.ndarray) -> np.ndarray:
        """Continuation counts (counts, for order 1) and counts of words."""
        out = np.zeros((2, len(keys)))
        for p, own in self._dealt(keys):
            hit, at = self._hits(f"keys-1-{p}", keys[own])
            if len(hit):
                out[0, own[hit]], out[1, own[hit]] = self._counts(f"counts-1-{p}", at), self._counts(f"raw-{p}", at)
        return out

    def contexts(self, level: int, keys: np.ndarray, share: np.ndarray | None = None, followers: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(total, followers with count 1, 2, 3 or more; count of the follower, if asked for) of contexts; zeros where unknown."""
        out, counts = np.zeros((4, len(keys))), np.zeros(len(keys))
        for p, own in self._dealt(keys, share):
            name = f"{level}-{p}"
            hit, at = self._hits(f"once-{name}", keys[own])
            out[:2, own[hit]] = 1.0
            often, place = self._hits(f"contexts-{name}", keys[own])
            for k in range(4 if len(often) else 0):
                out[k, own[often]] = self._counts(f"stats-{name}", 4 * place + k)
            if followers is None or not (len(hit) or len(often)):
                continue
            tails = self._file(f"followers-{name}", np.uint16).reshape(-1, 3)
            counts[own[hit]] = _tail(tails[at]) == followers[own[hit]] >> np.uint64(16)
            if not len(often):
                continue
            who = own[often]
            seen = self._file(f"once-{name}")
            starts = self._file(f"starts-{name}", np.uint32)
            skip = 0 if seen is None else len(seen)
            low, high = starts[place].astype(np.int64) + skip, starts[place + 1].astype(np.int64) + skip
            end, wanted = high.copy(), followers[who] >> np.uint64(16)
            left = np.arange(len(who))
            while len(left):  # all segments are halved together
                middle = (low[left] + high[left]) // 2
                less = _tail(tails[middle]) < wanted[left]
                low[left[less]], high[left[~less]] = middle[less] + 1, middle[~less]
                left = left[low[left] < high[left]]
            inside = np.flatnonzero(low < end)
            inside = inside[_tail(tails[low[inside]]) == wanted[inside]]
            counts[who[inside]] = self._counts(f"counts-{name}", low[inside] - skip)
        return out, counts

    def counts(self, level: int, columns: list[np.ndarray], total: np.ndarray) -> np.ndarray:
        """Continuation counts below the highest order; ``total`` is the n-gram's as a context of the order above."""
        out = (total > 0).astype(np.float64)
        asked = np.flatnonzero((total > 1) | (columns[-1] == END))  # an n-gram has no more words before it than its followers have together
        columns = [c[asked] for c in columns]
        keys = gram_hash(columns)
        for p, own in self._dealt(keys, _share(columns[-2], self.model["shares"])):
            hit, at = self._hits(f"keys-{level}-{p}", keys[own])
            if len(hit):
                out[asked[own[hit]]] = self._counts(f"counts-{level}-{p}", at)
        return out

    def _step(self, level: int, counts: np.ndarray, total, ones, twos, more, lower: np.ndarray) -> np.ndarray:
        d1, d2, d3 = self.model["discounts"][level]
        discount = np.array([0.0, d1, d2, d3])[np.minimum(counts, 3).astype(np.int64)]
        known = np.maximum(total, 1)
        p = np.maximum(counts - discount, 0) / known + (d1 * ones + d2 * twos + d3 * more) / known * lower
        return np.where(total > 0, p, lower)

    def score(self, columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(log10 probability, count of the word in training) of every token."""
        order = self.model["order"]
        keys, back = np.unique(gram_hash(columns[-1:]), return_inverse=True)
        continuation, raw = self.words(keys)[:, back]
        p = np.full(len(raw), 1.0 / (self.model["vocabulary"] + 1))
        p = self._step(1, continuation, *(np.full(len(raw), float(x)) for x in self.model["root"]), p)
        found = {}
        for level in range(2, order + 1):
            gram, top = columns[order - level :], level == order
            if top:
                found[level] = self.contexts(level, gram_hash(gram[:-1]), _share(gram[-2], self.model["shares"]), gram[-1])
            else:
                keys, back = np.unique(gram_hash(gram[:-1]), return_inverse=True)
                found[level] = self.contexts(level, keys)[0][:, back], None
        inside = columns[-1] != END
        for level in range(2, order + 1):
            stats, counts = found[level]
            if level < order:  # an n-gram inside a text is the next token's context of the order above
                counts = self.counts(level, columns[order - level :], np.where(inside, np.r_[found[level + 1][0][0, 1:], 0.0], 0.0))
            p = self._step(level, counts, *stats, p)
        return np.log10(p), raw


def score(docs: DataFrame, model: dict, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score, perplexity for every row."""
    schema = "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double"

    def run(batches):
        files = Model(model)
        n, v = model["tokens"], model["vocabulary"]

        def scored(ids, held):
            counts, words = np.concatenate([c for c, _ in held]), np.concatenate([w for _, w in held])
            with np.errstate(over="ignore"):
                columns, tokens = grams(counts, words, model["order"])
                logs, raw = files.score(columns)
            at = slices(tokens)[:-1]
            base = np.add.reduceat(np.log10((raw + 1) / (n + v + 1)), at)
            total = np.add.reduceat(logs, at)
            known = np.add.reduceat((raw > 0).astype(np.int64), at)
            return pa.RecordBatch.from_arrays(
                [ids, pa.array(tokens), pa.array(known), pa.array(np.full(len(tokens), n)), pa.array(base), pa.array(total), pa.array(10.0 ** np.minimum(-total / tokens, 300.0))],
                ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"],
            )

        for b in batches:
            held, size, start, end = [], 0, 0, 0
            for first, counts, words in word_hashes(b.column(1)):
                held.append((counts, words))
                size, end = size + len(words), first + len(counts)
                if size >= LOOK_UP:
                    yield scored(b.column(0).slice(start, end - start), held)
                    held, size, start = [], 0, end
            if held:
                yield scored(b.column(0).slice(start, end - start), held)

    return keyed(docs, key, text).mapInArrow(released(run), schema)
