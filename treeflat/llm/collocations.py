"""Phrase collocations per language, by Rabin-Karp fingerprints; only frequent phrases ever become text.

Words lie in pieces (texts cut at ``BREAK`` bytes); a phrase is a run of words of one piece.  For sizes 1, 2, ... ``max_words`` one pass
over the texts fingerprints every run of that size: numpy prefix polynomials modulo 2^64 over the bytes give the words' hashes, and prefix
polynomials over these give the runs', so a run costs a difference and a product.  Tasks add up equal fingerprints before the shuffle, which brings
together (fingerprint, count, pointer, least and greatest check); the check is a second polynomial, modulo a prime.  A pointer is one number: 32 bits
of the hash of a row (its holder) and the place in its text where the phrase begins; the smallest wins, so that pointers gather in few rows.

A run of ``size`` words can be frequent only if both runs of ``size - 1`` words in it are.  Their fingerprints go out as bit tables of at most
``MAX_FILTER_BYTES``, whatever the input; a false positive costs a row of shuffle and changes no result.

Frequent fingerprints (count of at least ``least``) become text: rows that may hold a pointer are joined with their pointers, the words at
each are cut out, and their fingerprint compared (another row with the same holder does not pass).  Where least and greatest check differ, different phrases share a fingerprint: these
are counted again by their texts, which settles the collision.  So a wrong count needs phrases of one language that agree in 64 bits and in a number below 2^31.

Scores, ties and the dropping of phrases that a longer one accounts for are joins and aggregates over the frequent phrases only, in decimals.

Defined results: a null text has no words; a null language is ``und``, together with rows that say so.  Rows given twice count twice, null
ids as any.  Counts may have up to 15 digits.  Texts may be of any length: they are read in windows that overlap by ``size - 1`` words.
"""

from __future__ import annotations

from collections.abc import Iterator
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from treeflat.llm.common import released, ship, staged
from treeflat.llm.words import LOWER, PIECE, _powers_to, hashes, mix, raw, split

ship(__name__)

#: Bytes that end a piece, and those that only part words.
BREAK = np.zeros(256, bool)
BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
APART = BREAK.copy()
APART[[0x20, 0x09]] = True
#: Bound of each bit table that goes to the tasks.
MAX_FILTER_BYTES = 16 * 1024 * 1024
#: Rows that a task collects before it adds them up.
BUFFER_ROWS = 1 << 20
#: Tests take fewer bits to make fingerprints collide.
FINGERPRINT_BITS = 64
#: Parts of a language that are ranked apart first.
RANK_PARTS = 64
NO_LANGUAGE = "und"
_PRIME, _STEP = (1 << 31) - 1, 1_103_515_245
_BITMAP_BITS = 32768  # of one bitmap of Spark's bitmap functions
_prime_powers: list[np.ndarray] = []


def _prime_powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the check's base and of its inverse, modulo the prime."""
    if not _prime_powers or len(_prime_powers[0]) <= n:
        tables = []
        for base in (_STEP, pow(_STEP, -1, _PRIME)):
            table = np.ones(1, np.uint64)
            while len(table) <= max(n, PIECE):
                table = np.concatenate([table, table * np.uint64(pow(base, len(table), _PRIME)) % np.uint64(_PRIME)])
            tables.append(table)
        _prime_powers[:] = tables
    return _prime_powers[0], _prime_powers[1]


def _checks(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    prime = np.uint64(_PRIME)
    up, down = _prime_powers_to(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)] % prime, out=sums[1:])
    return (sums[ends] - sums[starts]) % prime * down[starts] % prime


class Words:
    """The words of one stretch of texts, and fingerprints of runs of them."""

    def __init__(self, part: np.ndarray, bounds: np.ndarray, languages: np.ndarray):
        self.starts, self.ends = split(part, bounds, APART)
        lower = LOWER[part]
        self.rows = np.searchsorted(bounds, self.starts, "right") - 1
        breaks = np.zeros(len(part) + 1, np.int64)
        np.cumsum(BREAK[part], out=breaks[1:])
        # linked[i]: word i + 1 follows in the same piece
        self.linked = (self.rows[1:] == self.rows[:-1]) & (breaks[self.starts[1:]] == breaks[self.ends[:-1]])
        self.languages = languages[self.rows]
        up, self.down = _powers_to(max(len(part), len(self.starts)))
        self.sums = np.zeros(len(self.starts) + 1, np.uint64)
        np.cumsum(hashes(lower, self.starts, self.ends) * up[: len(self.starts)], out=self.sums[1:])
        self.checks = _checks(lower, self.starts, self.ends)

    def fingerprints(self, size: int) -> np.ndarray:
        """Of the run from each word on that has ``size`` words after it in this stretch, whether or not they are in one piece."""
        n = max(len(self.starts) - size + 1, 0)
        runs = mix(mix((self.sums[size : size + n] - self.sums[:n]) * self.down[:n] + np.uint64(size)) ^ self.languages[:n])
        return runs & np.uint64((1 << FINGERPRINT_BITS) - 1)

    def whole(self, size: int) -> np.ndarray:
        """Whether the run from each word on lies in one piece."""
        n = max(len(self.starts) - size + 1, 0)
        ok = np.ones(n, bool)
        for k in range(size - 1):
            ok &= self.linked[k : k + n]
        return ok

    def run_checks(self, size: int, at: np.ndarray) -> np.ndarray:
        prime = np.uint64(_PRIME)
        out = self.languages[at] % prime
        for k in range(size):
            out = (out * np.uint64(48_271) + self.checks[at + k]) % prime
        return out


def stretches(column: pa.Array, languages: np.ndarray, size: int) -> Iterator[tuple[Words, np.ndarray, np.ndarray, np.ndarray]]:
    """(words, row of each, the stretch's bytes, where each row's text begins in them): every run of ``size`` words is whole in exactly one."""
    data, at = raw(column)
    n, first = len(at) - 1, 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(at, at[first] + PIECE, "right")) - 1)
        low, high = int(at[first]), int(at[last])
        if high - low <= 2 * PIECE:
            part, bounds = data[low:high], at[first : last + 1] - low
            yield Words(part, bounds, languages[first:last]), np.arange(first, last), part, bounds[:-1]
        else:  # one long text
            begin, width = low, PIECE
            while begin < high:
                end = min(high, begin + width)
                if end < high:
                    gaps = np.flatnonzero(APART[data[begin:end]])
                    end = begin + int(gaps[-1]) + 1 if len(gaps) else begin
                part = data[begin:end]
                words = Words(part, np.array([0, len(part)]), languages[first:last])
                if end < high and len(words.starts) < 2 * size:  # words longer than the window
                    width *= 2
                    continue
                yield words, np.arange(first, last), part, np.array([low - begin])
                # the last size - 1 words begin no whole run here: the next stretch begins with them
                begin, width = high if end == high else begin + int(words.starts[len(words.starts) - size + 1]) if size > 1 else end, PIECE
        first = last


def _slots(fingerprints: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64(half - 1)
    return (fingerprints & mask).astype(np.int64), ((fingerprints >> np.uint64(32)) & mask).astype(np.int64) + half


class Filter:
    """A bit table over fingerprints: two slots each."""

    def __init__(self, half: int, bits: np.ndarray):
        self.half, self.bits = half, bits

    def __call__(self, fingerprints: np.ndarray) -> np.ndarray:
        a, b = _slots(fingerprints, self.half)
        return ((self.bits[a >> 3] >> (a & 7).astype(np.uint8)) & (self.bits[b >> 3] >> (b & 7).astype(np.uint8)) & 1).astype(bool)


def bit_filter(rows: DataFrame, name: str) -> Filter:
    """Of the longs in a column; 16 bits a row up to the bound, then fuller."""
    count, half = rows.count(), _BITMAP_BITS
    while half < 8 * count and half < MAX_FILTER_BYTES * 4:
        half *= 2
    mask, h = F.lit(half - 1).cast("long"), F.col(name)
    slots = rows.select(F.explode(F.array(h.bitwiseAND(mask) + 1, F.shiftrightunsigned(h, 32).bitwiseAND(mask) + (half + 1))).alias("slot"))
    maps = slots.groupBy(F.bitmap_bucket_number("slot").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"))
    bits = np.zeros(2 * half // 8, np.uint8)
    for r in maps.toLocalIterator():  # at most MAX_FILTER_BYTES in all
        begin = (r["bucket"] - 1) * (_BITMAP_BITS // 8)
        bits[begin : begin + _BITMAP_BITS // 8] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return Filter(half, bits)


def _added(columns: list[np.ndarray]) -> list[np.ndarray]:
    """Equal fingerprints (and languages, where given) added up: smallest pointer, least and greatest check."""
    fingerprint, n, pointer, low, high, *language = columns
    order = np.lexsort((fingerprint, *language)) if language else np.argsort(fingerprint)
    keys = [c[order] for c in (fingerprint, *language)]
    fresh = np.ones(len(order), bool)
    fresh[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in keys])
    at = np.flatnonzero(fresh)
    if not len(at):
        return columns
    reduced = [np.add.reduceat(n[order], at), np.minimum.reduceat(pointer[order], at), np.minimum.reduceat(low[order], at), np.maximum.reduceat(high[order], at)]
    return [keys[0][at], *reduced, *(c[at] for c in keys[1:])]


def _texts(docs: DataFrame, key: str, text: str, lang: str) -> DataFrame:
    """The operator's own columns; ``holder`` is 32 bits of the row's hash."""
    own = docs.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit(NO_LANGUAGE)).alias("lang"), F.col(f"`{text}`").cast("string").alias("text"), F.col(f"`{key}`").cast("string").alias("id"))
    return own.filter("text IS NOT NULL").select("lang", "text", F.xxhash64("lang").alias("language"), F.shiftrightunsigned(F.xxhash64("id", "lang", "text"), 32).alias("holder"))


def _longs(column: pa.Array) -> np.ndarray:
    return np.asarray(column).astype(np.int64)


def counted(texts: DataFrame, size: int, parts: Filter | None) -> DataFrame:
    """fp, n, pointer, low, high of every run of ``size`` words whose parts pass the filter; runs of one word also have ``lang``."""
    sent = texts.sparkSession.sparkContext.broadcast(parts)  # at most MAX_FILTER_BYTES

    def run(batches):
        parts, names, pending, rows = sent.value, {}, [], 0

        def out(columns):
            for k in range(0, len(columns[0]), 1 << 16):
                fp, n, pointer, low, high, *language = (c[k : k + (1 << 16)] for c in columns)
                arrays = [pa.array(fp.view(np.int64)), pa.array(n), pa.array(pointer), pa.array(low), pa.array(high)]
                arrays += [pa.array([names[x] for x in c.tolist()], pa.string()) for c in language]
                yield pa.RecordBatch.from_arrays(arrays, schema)

        schema = ["fp", "n", "pointer", "low", "high", *["lang"] * (size == 1)]
        for batch in batches:
            language, holders = _longs(batch.column(2)), _longs(batch.column(3))
            if size == 1:
                distinct, one = np.unique(language, return_index=True)
                names.update((int(h), batch.column(0)[int(k)].as_py()) for h, k in zip(distinct, one) if int(h) not in names)
            for words, at, _, begins in stretches(batch.column(1), language.view(np.uint64), size):
                found = words.whole(size)
                if parts is not None and len(found):
                    passed = parts(words.fingerprints(size - 1))
                    found &= passed[: len(found)] & passed[1 : len(found) + 1]
                i = np.flatnonzero(found)
                if not len(i):
                    continue
                row = words.rows[i]
                pointers = (holders[at[row]] << 31) | (words.starts[i] - begins[row])
                checks = words.run_checks(size, i).astype(np.int32)
                named = [words.languages[i].view(np.int64)] * (size == 1)
                pending.append(_added([words.fingerprints(size)[i], np.ones(len(i), np.int64), pointers, checks, checks, *named]))
                rows += len(pending[-1][0])
                if rows >= BUFFER_ROWS:
                    pending = [_added([np.concatenate(c) for c in zip(*pending)])]
                    rows = len(pending[0][0])
                    if rows >= BUFFER_ROWS // 2:
                        yield from out(pending[0])
                        pending, rows = [], 0
        if pending:
            yield from out(_added([np.concatenate(c) for c in zip(*pending)]))

    partial = texts.mapInArrow(released(run), "fp long, n long, pointer long, low int, high int" + (", lang string" if size == 1 else ""))
    return partial.groupBy(*["lang"] * (size == 1), "fp").agg(
        F.sum("n").alias("n"), F.min("pointer").alias("pointer"), F.min("low").alias("low"), F.max("high").alias("high")
    )


def _phrase(text: bytes) -> str:
    words = LOWER[np.frombuffer(text, np.uint8)].tobytes().replace(b"\t", b" ").split(b" ")
    return " ".join(w.decode(errors="replace") for w in words if w)  # at a pointer of another row a character may be cut


def _run_pattern(size: int) -> re.Pattern:
    word = rb"[^\x20\x09.,;:!?\x0A-\x0D]+"
    return re.compile(word + (rb"[\x20\x09]+" + word) * (size - 1))


def at_pointers(texts: DataFrame, found: DataFrame) -> DataFrame:
    """lang, size, phrase, n: the words at each pointer of ``found`` (size, fp, n, pointer)."""
    place = F.col("pointer").bitwiseAND(F.lit(0x7FFFFFFF)).alias("place")
    pointers = found.groupBy(F.shiftright("pointer", 31).alias("holder")).agg(F.collect_list(F.struct("size", "fp", "n", place)).alias("pointers"))  # at most the runs of one text
    pointers = staged(pointers, "phrase-pointers")
    holders = bit_filter(pointers.select("holder"), "holder")
    sent = texts.sparkSession.sparkContext.broadcast(holders)  # at most MAX_FILTER_BYTES

    def holding(batches):
        for batch in batches:
            keep = pa.array(sent.value(_longs(batch.column(3)).view(np.uint64)))
            yield batch.filter(keep)

    # only texts with a pointer travel
    rows = texts.mapInArrow(holding, texts.schema).join(pointers, "holder").select("lang", "text", "language", "pointers")

    def cut(batches):
        patterns: dict[int, re.Pattern] = {}
        for batch in batches:
            items = []
            for lang, text, language, pointers in zip(*(c for c in batch.columns)):
                data = text.as_py().encode()
                for p in pointers.as_py():
                    here = patterns.setdefault(p["size"], _run_pattern(p["size"])).match(data, p["place"])
                    if here:
                        items.append((lang.as_py(), language.as_py(), p["size"], p["fp"], p["n"], _phrase(here[0])))
            for size in sorted({x[2] for x in items}):
                own = [x for x in items if x[2] == size]
                phrases = pa.array([x[5] for x in own], pa.string())
                same = np.zeros(len(own), bool)  # the text has the fingerprint: else another row has this row's hash
                for words, at, _, _ in stretches(phrases, np.array([x[1] for x in own], np.int64).view(np.uint64), size):
                    i = np.flatnonzero(words.whole(size))
                    row = at[words.rows[i]]
                    same[row] = words.fingerprints(size)[i].view(np.int64) == np.array([x[3] for x in own], np.int64)[row]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[0] for x in own], pa.string()), pa.array([size] * len(own), pa.int32()), phrases, pa.array([x[4] for x in own], pa.int64())], ["lang", "size", "phrase", "n"]
                ).filter(pa.array(same))

    # rows given twice give the same phrase twice
    return rows.mapInArrow(released(cut), "lang string, size int, phrase string, n long").distinct()


def by_text(texts: DataFrame, collided: DataFrame, sizes: list[int]) -> DataFrame:
    """lang, size, phrase, n of every phrase that has one of the fingerprints ``collided`` (size, fp), counted by its text."""
    sent = texts.sparkSession.sparkContext.broadcast(bit_filter(collided.select("fp"), "fp"))

    def run(batches):
        counts: dict[tuple, int] = {}

        def out():
            rows = [(*k, n) for k, n in counts.items()]
            counts.clear()
            columns = list(zip(*rows)) if rows else [()] * 5
            types = [pa.int32(), pa.int64(), pa.string(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["size", "fp", "lang", "phrase", "n"])

        for batch in batches:
            language = _longs(batch.column(2)).view(np.uint64)
            for size in sizes:
                for words, at, part, _ in stretches(batch.column(1), language, size):
                    fps = words.fingerprints(size)
                    for i in np.flatnonzero(words.whole(size) & sent.value(fps)).tolist():
                        phrase = _phrase(part[words.starts[i] : words.ends[i + size - 1]].tobytes())
                        k = (size, int(fps[i].astype(np.int64)), batch.column(0)[int(at[words.rows[i]])].as_py(), phrase)
                        counts[k] = counts.get(k, 0) + 1
                    if len(counts) > 100_000:
                        yield out()
        yield out()

    again = texts.mapInArrow(released(run), "size int, fp long, lang string, phrase string, n long")
    return again.groupBy("size", "fp", "lang", "phrase").agg(F.sum("n").alias("n")).join(collided, ["size", "fp"], "left_semi").groupBy("lang", "size", "phrase").agg(F.sum("n").alias("n"))


def frequent_phrases(texts: DataFrame, max_words: int, least: int) -> tuple[DataFrame, DataFrame]:
    """(lang, size, phrase, n of all phrases that occur at least ``least`` times; lang and its number of words)."""
    parts, levels, totals = None, [], None
    for size in range(1, max_words + 1):
        level = staged(counted(texts, size, parts), f"phrases-{size}")
        if size == 1:
            totals = staged(level.groupBy("lang").agg(F.sum("n").alias("words")), "phrase-totals")
        levels.append(level.filter(F.col("n") >= least).select(F.lit(size).alias("size"), "fp", "n", "pointer", "low", "high"))
        if size < max_words:
            parts = bit_filter(levels[-1].select("fp"), "fp")
    found = levels[0]
    for level in levels[1:]:
        found = found.unionByName(level)
    collided = found.filter("low <> high").select("size", "fp").distinct()
    phrases = at_pointers(texts, found.filter("low = high"))
    if not collided.isEmpty():
        again = by_text(texts, staged(collided, "phrase-collisions"), list(range(1, max_words + 1)))
        phrases = phrases.unionByName(again.filter(F.col("n") >= least))
    return staged(phrases, "phrases"), totals


def collocations(
    docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", max_words: int = 3, least: int = 10, share: int = 50, top: int = 2000
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's ``top`` phrases of 2 to ``max_words`` words.

    ``a``, ``l`` and ``r`` count the phrase, its first part and its rest at the cut with the lowest score, ``n`` the language's words.  Phrases
    go that lie in a longer one with at least ``share`` percent of their count.
    """
    phrases, totals = frequent_phrases(_texts(docs, key, text, lang), max_words, least)
    words = F.split("phrase", " ")
    longer = phrases.filter("size > 1").withColumn("words", words)
    run = lambda i, k: F.array_join(F.slice("words", i, k), " ")
    cuts = longer.select("lang", "phrase", "size", F.col("n").alias("a"), "words", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "size", "a", "k", run(F.lit(1), F.col("k")).alias("left"), run(F.col("k") + 1, F.col("size") - F.col("k")).alias("right"))
    counts = lambda part, n: phrases.select("lang", F.col("phrase").alias(part), F.col("n").alias(n))
    cuts = cuts.join(counts("left", "l"), ["lang", "left"]).join(counts("right", "r"), ["lang", "right"])
    score = F.expr("(CAST(1000000 AS DECIMAL(7,0)) * (CAST(a AS DECIMAL(15,0)) * CAST(a AS DECIMAL(15,0)))) div (CAST(l AS DECIMAL(15,0)) * CAST(r AS DECIMAL(15,0)))")
    scored = cuts.groupBy("lang", "phrase", "size", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    scored = scored.select("lang", "phrase", "size", "a", "cut.l", "cut.r", "cut.score")
    if max_words > 2:
        shorter = longer.filter("size > 2").select("lang", "n", "words", "size", F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("k"))
        within = shorter.select("lang", "n", "words", "k", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("k") + 1)).alias("i")).select("lang", "n", run(F.col("i"), F.col("k")).alias("phrase"))
        scored = scored.join(within.groupBy("lang", "phrase").agg(F.max("n").alias("longest")), ["lang", "phrase"], "left").filter(F.col("longest").isNull() | (100 * F.col("longest") < share * F.col("a")))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))  # a language's phrases never meet in one task; at most RANK_PARTS * top do
    first = scored.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).filter(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    return ranked.join(F.broadcast(totals) if totals.count() <= 10_000 else totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", F.col("words").alias("n"), "score")
