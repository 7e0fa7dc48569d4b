"""Benchmark decontamination by greedy string tiling.

Words are runs of letters and digits of any script, case-folded after compatibility composition (NFKC), so case, punctuation and invisible
format characters do not hide a passage; letters of scripts that are written without blanks are words of their own.  Seeds are the Karp-Rabin hashes of
``MIN_MATCH`` words in a row that a document shares with a benchmark item.  Seeds in a row on one diagonal are a common
run; the longest run whose words are all unmarked becomes a tile and its words are marked in both texts, a run that is partly
marked is cut down and goes back, until no run of ``MIN_MATCH`` words is left.  The share of the item's words under
tiles is its coverage: the order of the tiles does not matter, so reordered passages count in full.  An item's words under any
shared seed bound its coverage; only items whose bound suffices are tiled, so a stem that many items share costs once each, however
often a document repeats it.

The benchmark is worked through in blocks of about ``BLOCK_BYTES`` (each broadcast, one pass over the documents per block), so
what is broadcast is bounded whatever its size.  Documents are not shuffled.

Defined results: null and empty texts match nothing; items with fewer than ``MIN_MATCH`` words are not looked for; equal
(item_id, text) rows count once, a row of documents given twice gives its rows twice; null ids are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
import heapq
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from treeflat.llm.common import keyed, released, ship
from treeflat.llm.words import NOT_WORD, raw, slices, windows, word_hashes

ship(__name__)

MIN_MATCH = 5
#: Least share of an item's words under tiles.
COVERAGE = 0.8
BLOCK_BYTES = 8 * 1024 * 1024
#: Bytes of text that are folded together (a longer text by itself).
FOLD_BYTES = 4 * 1024 * 1024
_FORMAT = regex.compile(r"\p{Cf}+")
_APART = regex.compile(r"[^\x00-\x7F\p{L}\p{N}\p{M}]+")  # the ASCII ones are in NOT_WORD
_ALONE = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}\p{Tibetan}\p{Tai_Le}\p{Javanese}\p{Balinese}]\p{M}*")


def fold(text: bytes) -> bytes:
    """UTF-8 in which words are told apart by the bytes of ``NOT_WORD`` alone."""
    if text.isascii():
        return text  # the byte tables do it
    s = unicodedata.normalize("NFKC", _FORMAT.sub("", text.decode("utf-8", "replace"))).casefold()
    # case folding can leave decomposed letters
    s = unicodedata.normalize("NFC", s)
    return _ALONE.sub(r" \g<0> ", _APART.sub(" ", s)).encode("utf-8", "replace")


def folded_words(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """:func:`word_hashes` of the folded texts, about ``FOLD_BYTES`` at a time."""
    _, at = raw(column)
    n, low = len(at) - 1, 0
    while low < n:
        high = max(low + 1, int(np.searchsorted(at, at[low] + FOLD_BYTES, "right")) - 1)
        texts = column.slice(low, high - low).cast(pa.large_binary()).to_pylist()
        folded = pa.array([fold(t or b"") for t in texts], pa.large_binary())
        for first, counts, words in word_hashes(folded.cast(pa.large_string()), NOT_WORD):
            yield low + first, counts, words
        low = high


class Block:
    """Items of the benchmark with their seeds in sorted order."""

    def __init__(self, items: list[tuple[int | None, str]]):
        self.ids = [i for i, _ in items]
        column = pa.array([t for _, t in items], pa.large_string())
        found = list(folded_words(column))
        counts = np.concatenate([c for _, c, _ in found]) if found else np.zeros(0, np.int64)
        words = np.concatenate([w for _, _, w in found]) if found else np.zeros(0, np.uint64)
        self.lengths = counts
        seeds, have = windows(words, counts, MIN_MATCH)
        item = np.repeat(np.arange(len(counts)), have)
        place = np.arange(len(seeds)) - np.repeat(slices(have)[:-1], have)
        order = np.argsort(seeds, kind="stable")
        self.seeds, self.item, self.place = seeds[order], item[order], place[order]


def tiles(i: np.ndarray, j: np.ndarray, n: int) -> tuple[int, int, int]:
    """(words of the item under tiles, number of tiles, longest tile) from the seed pairs at i in the text and j in the item of ``n`` words."""
    order = np.lexsort((i, i - j))
    i, j = i[order], j[order]
    new = np.flatnonzero(np.r_[True, (np.diff(i - j) != 0) | (np.diff(i) != 1)])
    lengths = np.diff(np.r_[new, len(i)]) + MIN_MATCH - 1
    heap = [(-int(k), int(a), int(b)) for k, a, b in zip(lengths, i[new], j[new])]
    heapq.heapify(heap)
    in_text: set[int] = set()
    in_item = np.zeros(n, bool)
    count = longest = 0
    while heap:
        k, a, b = heapq.heappop(heap)
        k = -k
        free = [not in_item[b + x] and (a + x) not in in_text for x in range(k)]
        if all(free):
            in_item[b : b + k] = True
            in_text.update(range(a, a + k))
            count, longest = count + 1, max(longest, k)
            if in_item.all():
                break
            continue
        x = 0
        while x < k:  # what is left between marked words goes back
            y = x
            while y < k and free[y]:
                y += 1
            if y - x >= MIN_MATCH:
                heapq.heappush(heap, (x - y, a + x, b + x))
            x = y + 1
    return int(in_item.sum()), count, longest


def _spread(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """``n`` numbers in a row from each ``first`` on."""
    return np.repeat(first, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


def matches(column: pa.Array, block: Block, coverage: float) -> Iterator[tuple[int, int, int, int, int]]:
    """(row, item, covered words, tiles, longest tile) for every pair that reaches ``coverage``."""
    if not len(block.seeds):
        return
    for first, counts, words in folded_words(column):
        seeds, have = windows(words, counts, MIN_MATCH)
        at = np.searchsorted(block.seeds, seeds)
        hit = np.flatnonzero(block.seeds[np.minimum(at, len(block.seeds) - 1)] == seeds)
        if not len(hit):
            continue
        starts = slices(have)
        row = np.searchsorted(starts, hit, "right") - 1
        low, high = at[hit], np.searchsorted(block.seeds, seeds[hit], "right")
        edges = np.flatnonzero(np.r_[True, np.diff(row) != 0, True])
        for a, b in zip(edges[:-1], edges[1:]):
            r = row[a]
            by_seed = np.argsort(low[a:b], kind="stable")
            seed, place_of, often = np.unique(low[a:b][by_seed], return_index=True, return_counts=True)
            text_at = (hit[a:b] - starts[r])[by_seed]
            # every seed once, with the items that hold it: where a seed stands in the text does not matter yet
            n = high[a:b][by_seed][place_of] - seed
            held, entry = np.repeat(np.arange(len(seed)), n), _spread(seed, n)
            order = np.lexsort((block.place[entry], block.item[entry]))
            held, items, place = held[order], block.item[entry[order]], block.place[entry[order]]
            new = np.flatnonzero(np.r_[True, np.diff(items) != 0])
            ends = np.r_[new[1:], len(items)]
            step = np.r_[np.diff(place), MIN_MATCH]
            step[ends - 1] = MIN_MATCH
            most = np.add.reduceat(np.minimum(step, MIN_MATCH), new)  # words under any shared seed: no tiling covers more
            lengths = block.lengths[items[new]]
            for k in np.flatnonzero(most >= coverage * lengths):
                own = slice(new[k], ends[k])
                times = often[held[own]]
                i = text_at[_spread(place_of[held[own]], times)]
                covered, count, longest = tiles(i, np.repeat(place[own], times), int(lengths[k]))
                if covered >= coverage * lengths[k]:
                    yield first + int(r), int(items[new[k]]), covered, count, longest


def blocks(benchmark: DataFrame, item: str = "item_id", text: str = "text") -> Iterator[Block]:
    """The benchmark, about ``BLOCK_BYTES`` at a time."""
    rows = keyed(benchmark, item, text).filter("text IS NOT NULL").distinct()
    size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    count = size // BLOCK_BYTES + 1
    for b in range(count):
        got = rows.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(count)) == b).orderBy("doc_id", "text").collect()
        if got:
            yield Block([(r["doc_id"], r["text"]) for r in got])


def contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", coverage: float = COVERAGE) -> DataFrame:
    """The (document, item) pairs that reach the coverage: doc_id, item_id, item_words, covered_words, coverage, tiles, longest_tile."""
    schema = "doc_id long, item_id long, item_words int, covered_words int, coverage double, tiles int, longest_tile int"
    found = []
    for block in blocks(benchmark):
        sent = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches, sent=sent):
            block = sent.value
            for b in batches:
                rows = list(matches(b.column(1), block, coverage))
                row, item, covered, count, longest = (np.array(x, np.int64) for x in zip(*rows)) if rows else [np.zeros(0, np.int64)] * 5
                words = block.lengths[item]
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column(0).take(pa.array(row)),
                        pa.array([block.ids[x] for x in item], pa.int64()),
                        *(pa.array(x.astype(np.int32)) for x in (words, covered)),
                        pa.array(covered / np.maximum(words, 1)),
                        *(pa.array(x.astype(np.int32)) for x in (count, longest)),
                    ],
                    ["doc_id", "item_id", "item_words", "covered_words", "coverage", "tiles", "longest_tile"],
                )

        found.append(keyed(docs, key, text).mapInArrow(run, schema))
    return reduce(DataFrame.unionByName, found) if found else docs.sparkSession.createDataFrame([], schema)


def _clean(sent, coverage: float):
    def run(batches):
        for texts in batches:
            out = np.ones(len(texts), bool)
            for row, *_ in matches(texts, sent.value, coverage):
                out[row] = False
            yield pa.array(out)

    @F.arrow_udf("boolean")
    def clean(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from released(run)(batches)

    return clean


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", coverage: float = COVERAGE) -> DataFrame:
    """``docs`` without the rows that hold an item: decided row by row, all columns kept, nothing shuffled."""
    for block in blocks(benchmark):
        sent = docs.sparkSession.sparkContext.broadcast(block)
        docs = docs.filter(_clean(sent, coverage)(F.col(f"`{text}`").cast("string")))
    return docs
