"""Token counts of whole texts by a map-side lookup in two tiers; no pre-token is ever shuffled.

A text is cut into *pre-tokens*: before each run of blanks and before each line feed.  The vocabulary has no piece that
reaches over such a place (looked up when the model is loaded; a line feed is no cut if some piece holds one), so
merges on either side do not meet and the counts of the pre-tokens add up to the count of the text.

* Tier 1 is a hash table of frequent pre-tokens and their token counts, made on the driver from a bounded sample
  (``SAMPLE_ROWS`` documents of at most ``SAMPLE_BYTES``) and broadcast: at most ``TABLE_ENTRIES`` entries of 17 bytes at
  half load.  Its key is the pre-token itself, up to 15 bytes packed with the length into two words: no
  fingerprint, so no false match.  All pre-tokens of a batch are looked up at once with numpy.
* Tier 2 is the task's own cache: what tier 1 lacks is encoded once by the library and kept under its bytes, up to
  ``CACHE_ENTRIES``; then the cache starts anew.  Pre-tokens over ``CACHED_BYTES`` go to the library each time.

The sample decides how often tier 1 answers, never what the answer is.  A model for which the cuts do not hold
(another normaliser, pieces over blanks) has whole texts encoded: slower, the same counts.

Defined results: a null text counts as empty: 0 bytes, 0 tokens.  Rows with null or repeated ids stay as they are, one result row
each; other columns are not looked at.  Texts are counted whole, in pieces of about ``PIECE`` bytes.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from treeflat.llm.common import keyed, released, ship
from treeflat.llm.words import PIECE, mix, raw

ship(__name__)

#: Bounds of the sample that fills tier 1.
SAMPLE_ROWS = 1_000
SAMPLE_BYTES = 16 * 1024
#: Bound of what is broadcast.
TABLE_ENTRIES = 1 << 15
#: Bounds of a task's cache.
CACHE_ENTRIES = 200_000
CACHED_BYTES = 128
#: A text with more tokens is over the limit.
LIMIT = 4096
_PACKED = 15  # bytes that fit beside their length
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(8)] + [2**64 - 1], np.uint64)
_BLANK = "▁"


class Model:
    """The library's model and what its vocabulary allows."""

    def __init__(self, proto: bytes):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_proto=proto)
        pieces = [self.library.id_to_piece(i) for i in range(self.library.vocab_size())]
        probe = "  ﬁ①  Å\t é "
        kept = self.library.decode(self.library.encode(probe)) == probe and "".join(self.library.encode("  a  a ", out_type=str)) == "▁▁▁a▁▁a▁"
        self.cuts = kept and not any(a != _BLANK and b == _BLANK for p in pieces for a, b in zip(p, p[1:]))
        self.line_cuts = self.cuts and not any("\n" in p for p in pieces)

    def counts(self, texts: list[str]) -> list[int]:
        return [len(ids) for ids in self.library.encode(texts, num_threads=1)]


def pre_tokens(data: np.ndarray, firsts: np.ndarray, line_cuts: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(where each begins, from where it is encoded, its end, tokens to take off) of the pre-tokens in ``data``.

    ``firsts``: where texts begin.  The library puts a blank before what it encodes.  So a pre-token is encoded without its first blank; the
    first one of a text as it is, since its blank is the library's; one that begins with a line feed as it is too, less the blank's token.
    """
    n = len(data)
    plain = data == 0x20
    wide = np.zeros(n, bool)  # the blank mark itself, written in a text
    if n > 2:
        wide[:-2] = (data[:-2] == 0xE2) & (data[1:-1] == 0x96) & (data[2:] == 0x81)
    after = np.zeros(n, bool)
    after[1:] = plain[:-1]
    after[3:] |= wide[:-3]
    cut = (plain | wide) & ~after
    line = data == 0x0A if line_cuts else np.zeros(n, bool)
    cut |= line
    first = np.zeros(n, bool)
    first[firsts] = True
    starts = np.flatnonzero(cut | first)
    ends = np.append(starts[1:], n)
    opening = np.where(first[starts], 0, np.where(plain[starts], 1, np.where(wide[starts], 3, 0)))
    return starts, starts + opening, ends, (line[starts] & ~first[starts]).astype(np.int64)


def packed(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans of at most 15 bytes with their length as two 64-bit words: different spans differ."""
    padded = np.concatenate([data, np.zeros(16, np.uint8)])
    eight = np.ndarray(len(padded) - 7, "<u8", padded, strides=(1,))
    low = eight[starts] & _MASKS[np.minimum(lengths, 8)]
    high = eight[starts + 8] & _MASKS[np.maximum(lengths - 8, 0)]
    return low, high | (lengths.astype(np.uint64) << np.uint64(56))


class Frequent:
    """Open addressing over three arrays; an entry with count 0 is free."""

    def __init__(self, low: np.ndarray, high: np.ndarray, counts: np.ndarray):
        size = 16
        while size < 2 * len(low):
            size *= 2
        self.low, self.high, self.counts = np.zeros(size, np.uint64), np.zeros(size, np.uint64), np.zeros(size, np.uint8)
        for a, b, c, at in zip(low, high, counts, self._slot(low, high)):
            while self.counts[at]:
                at = (at + 1) % size
            self.low[at], self.high[at], self.counts[at] = a, b, c

    def _slot(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return (mix(low ^ mix(high)) & np.uint64(len(self.low) - 1)).astype(np.int64)

    def find(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Token counts; 0 where there is no entry."""
        out = np.zeros(len(low), np.int64)
        open_, slot = np.arange(len(low)), self._slot(low, high)
        while len(open_):
            here = self.counts[slot]
            same = (self.low[slot] == low[open_]) & (self.high[slot] == high[open_])
            out[open_[same]] = here[same]
            further = ~same & (here > 0)
            open_, slot = open_[further], (slot[further] + 1) % len(self.low)
        return out


class Cache:
    """Tier 2: counts by the pre-token's bytes, within a task."""

    def __init__(self, model: Model):
        self.model, self.known = model, {b"": 1}  # a blank by itself

    def counts(self, spans: list[bytes]) -> list[int]:
        if len(self.known) > CACHE_ENTRIES:
            self.known = {b"": 1}
        fresh = list(dict.fromkeys(s for s in spans if s not in self.known))
        got = dict(zip(fresh, self.model.counts([s.decode() for s in fresh]))) if fresh else {}
        out = [self.known[s] if s in self.known else got[s] for s in spans]
        self.known.update((s, c) for s, c in got.items() if len(s) <= CACHED_BYTES)
        return out


def _pieces(data: np.ndarray, at: np.ndarray, line_cuts: bool) -> Iterator[tuple[int, int, int, int]]:
    """(first row, row after the last, from byte, to byte): runs of rows, or parts of a long text that end before a cut."""
    n, first = len(at) - 1, 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(at, at[first] + PIECE, "right")) - 1)
        low, high = int(at[first]), int(at[last])
        while high - low > 2 * PIECE:  # one long text
            end, places = low + PIECE, np.zeros(0, np.int64)
            while not len(places) and end < high:
                start, end = end, min(high, end + PIECE)
                part, before = data[start:end], data[start - 1 : end - 1]
                ok = (part == 0x20) & (before != 0x20) & (before != 0x81)
                places = np.flatnonzero(ok | (part == 0x0A) if line_cuts else ok)
            if not len(places):
                break
            yield first, last, low, start + int(places[0])
            low = start + int(places[0])
        yield first, last, low, high
        first = last


def _add_counts(out: np.ndarray, data: np.ndarray, at: np.ndarray, model: Model, frequent: Frequent, cache: Cache) -> None:
    for first, last, low, high in _pieces(data, at, model.line_cuts):
        if high == low:
            continue
        part, bounds = data[low:high], at[first : last + 1] - low
        begins = bounds[:-1][(bounds[:-1] >= 0) & (bounds[:-1] < bounds[1:])]  # empty texts have no pre-token
        starts, encoded, ends, off = pre_tokens(part, begins, model.line_cuts)
        lengths = ends - encoded
        counts = np.zeros(len(starts), np.int64)
        short = np.flatnonzero(lengths <= _PACKED)
        if len(short):
            a, b = packed(part, encoded[short], lengths[short])
            counts[short] = frequent.find(a, b)
            missed = np.flatnonzero(counts[short] == 0)
            if len(missed):
                keys, which = np.unique(np.stack([a[missed], b[missed]], 1).view([("a", np.uint64), ("b", np.uint64)]).ravel(), return_inverse=True)
                one = np.empty(len(keys), np.int64)
                one[which] = short[missed]
                counts[short[missed]] = np.array(cache.counts([part[encoded[k] : ends[k]].tobytes() for k in one]), np.int64)[which]
        long = np.flatnonzero(lengths > _PACKED)
        if len(long):
            counts[long] = cache.counts([part[encoded[k] : ends[k]].tobytes() for k in long])
        rows = np.searchsorted(at[first : last + 1], starts + low, "right") - 1 + first
        np.add.at(out, rows, counts - off)


def frequent_table(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> Frequent:
    """Tier 1 from the sample; empty where no text is short enough for the sample."""
    rows = docs.count()
    share = min(1.0, max(0.01, 3 * SAMPLE_ROWS / max(rows, 1)))
    sample = keyed(docs, key, text).filter(F.octet_length("text").between(1, SAMPLE_BYTES)).sample(share, seed=11).limit(SAMPLE_ROWS)
    seen: Counter[bytes] = Counter()
    for r in sample.collect():  # at most SAMPLE_ROWS * SAMPLE_BYTES
        data = np.frombuffer(r["text"].encode(), np.uint8)
        _, starts, ends, _ = pre_tokens(data, np.zeros(1, np.int64), model.line_cuts)
        seen.update(data[a:b].tobytes() for a, b in zip(starts, ends) if b - a <= _PACKED)
    spans = [s for s, _ in seen.most_common(TABLE_ENTRIES)]
    lengths = np.array([len(s) for s in spans], np.int64)
    data = np.frombuffer(b"".join(spans), np.uint8)
    low, high = packed(data, np.cumsum(lengths) - lengths, lengths)
    return Frequent(low, high, np.array(Cache(model).counts(spans), np.uint8))


def token_counts(docs: DataFrame, proto: bytes, key: str = "doc_id", text: str = "text", limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row; ``proto`` is the content of the model's file."""
    model = Model(proto)
    frequent = frequent_table(docs, model, key, text) if model.cuts else None
    sent = docs.sparkSession.sparkContext.broadcast((proto, frequent))  # the model file and at most TABLE_ENTRIES entries

    def run(batches):
        proto, frequent = sent.value
        model = Model(proto)
        cache = Cache(model)
        for batch in batches:
            counts = np.zeros(batch.num_rows, np.int64)
            data, at = raw(batch.column(1))
            if frequent is not None:
                _add_counts(counts, data, at, model, frequent, cache)
            else:
                for k, t in enumerate(batch.column(1)):
                    counts[k] = model.counts([t.as_py() or ""])[0]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(at)), pa.array(counts), pa.array(counts > limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"]
            )

    return keyed(docs, key, text).mapInArrow(released(run), "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
