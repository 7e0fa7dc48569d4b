"""Language identification by compression.

Each language has a zstandard raw-content dictionary: lower-cased texts of labelled documents, end to end.  A text is
lower-cased and cut into the fewest equal windows of at most ``WINDOW_BYTES``; each window is compressed by itself with each dictionary, and
the language with the smallest sum of frames over the whole text is chosen.  The margin is the lead of the smallest sum over the second
smallest as a share of the second; where it is under ``MIN_MARGIN`` (or a tie) the choice is *rejected*: still reported, with ``rejected``
true.  A dictionary saves its share of every window, so the margin of a text does not sink with its length.

Fitting takes a bounded sample: at most ``SAMPLE_ROWS`` documents of a language (texts up to ``SAMPLE_BYTES``; the smallest hash
of each residue of the id's hash), cut together at ``DICTIONARY_BYTES``.  Where these do not fill the dictionary, passages of longer texts do:
up to ``PASSAGES`` a text, evenly spread over it, from the text with the smallest hash of each of ``LONG_ROWS`` residues.  Everything else reads every whole text.

Defined results: null text and text without a letter is ``und`` with score 0 and rejected; an empty training set predicts ``und``
for all; ties go to the language with more documents, then by name.  With one learned language every text with a letter gets it, score 1.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import regex
import zstandard

from pyspark.sql import Column, DataFrame, functions as F

from treeflat.llm.common import keyed, released, ship

ship(__name__)

SAMPLE_ROWS = 400
#: Longer texts are taken into a dictionary only as passages, and only where the others do not fill it.
SAMPLE_BYTES = 12 * 1024
DICTIONARY_BYTES = 96 * 1024
#: A passage has so many characters (at most SAMPLE_BYTES in UTF-8); so many of a text fill a dictionary.
PASSAGE = SAMPLE_BYTES // 4
PASSAGES = DICTIONARY_BYTES // PASSAGE
LONG_ROWS = 32
#: Most bytes that are compressed in one piece: few against a dictionary and the compressor's window.
WINDOW_BYTES = 32 * 1024
#: Least lead of the smallest size over the second, as a share of the second.
MIN_MARGIN = 0.004
#: Put before each text: zstandard stores blocks that it cannot shorten, and texts of a few words would tie.
_PAD = b"\0" * 64
UNDETERMINED = "und"
_LETTER = regex.compile(r"\p{L}")


def fit(labelled: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> dict[str, tuple[bytes, int]]:
    """Dictionary content and number of documents by language, from the rows with a language and a text."""
    rows = labelled.select(F.col(lang).cast("string").alias("lang"), F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    rows = rows.filter(F.col("lang").isNotNull() & (F.octet_length("text") > 0))
    fits = F.octet_length("text") <= SAMPLE_BYTES
    h = F.when(fits, F.xxhash64("doc_id", "text"))
    # the smallest hash of each residue: a partial aggregate, so a hot language never meets in one task
    taken = rows.groupBy("lang", F.pmod(F.xxhash64("doc_id"), F.lit(SAMPLE_ROWS)).alias("slot")).agg(
        F.min(F.when(fits, F.struct(h.alias("h"), "text"))).alias("best"), F.count(F.lit(1)).alias("n"), F.count_if(~fits).alias("long")
    )
    contents: dict[str, bytes] = {}
    counts: dict[str, int] = {}
    longer: set[str] = set()
    for r in sorted(taken.collect(), key=lambda r: (r["lang"], r["slot"])):  # at most SAMPLE_ROWS a language
        counts[r["lang"]] = counts.get(r["lang"], 0) + r["n"]
        contents.setdefault(r["lang"], b"")
        if r["long"]:
            longer.add(r["lang"])
        if r["best"] is not None:
            _fill(contents, r["lang"], r["best"]["text"])
    short = [lang for lang in sorted(longer) if len(contents[lang]) < DICTIONARY_BYTES]
    if short:
        for lang, passage in _passages(rows.filter(F.col("lang").isin(short) & ~fits)):
            _fill(contents, lang, passage)
    return {lang: (content, counts[lang]) for lang, content in contents.items() if content}


def _fill(contents: dict[str, bytes], lang: str, text: str) -> None:
    have = contents[lang]
    if len(have) < DICTIONARY_BYTES:
        contents[lang] = have + _folded(text)[: DICTIONARY_BYTES - len(have)] + b"\n"


def _passages(rows: DataFrame) -> list[tuple[str, str]]:
    """(language, passage) of long texts: the first passages of all chosen texts, then the second ones, and so on."""
    length, passage = F.char_length("text"), F.lit(PASSAGE)
    count = F.least(F.lit(PASSAGES), F.greatest(F.lit(1), (length / passage).cast("int")))
    starts = F.transform(F.sequence(F.lit(0), count - 1), lambda k: (k.cast("long") * (length - passage) / F.greatest(count - 1, F.lit(1))).cast("int"))
    cut = F.transform(starts, lambda at: F.substring(F.col("text"), F.greatest(at, F.lit(0)) + 1, passage))
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(LONG_ROWS)).alias("slot")
    chosen = rows.select("lang", slot, F.xxhash64("doc_id", "text").alias("h"), cut.alias("cut")).groupBy("lang", "slot").agg(F.min(F.struct("h", "cut")).alias("best"))
    got = [(k, r["lang"], r["slot"], text) for r in chosen.collect() for k, text in enumerate(r["best"]["cut"])]  # at most LONG_ROWS * PASSAGES a language
    return [(lang, text) for _, lang, _, text in sorted(got)]


def _folded(text: str) -> bytes:
    return text.lower().encode("utf-8", "surrogatepass")


def _compressors(model: dict[str, tuple[bytes, int]]) -> list[tuple[str, zstandard.ZstdCompressor]]:
    """In the order in which ties are decided: more documents first, then by name."""
    out = []
    parameters = zstandard.ZstdCompressionParameters(
        format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_checksum=0, write_content_size=0, write_dict_id=0,
        window_log=18, chain_log=16, hash_log=16, search_log=4, min_match=4, strategy=zstandard.STRATEGY_LAZY,
    )
    for lang in sorted(model, key=lambda x: (-model[x][1], x)):
        d = zstandard.ZstdCompressionDict(model[lang][0], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(compression_params=parameters)
        out.append((lang, zstandard.ZstdCompressor(dict_data=d, compression_params=parameters)))
    return out


def _windows(data: bytes) -> list[bytes]:
    """The whole of ``data`` in the fewest windows of at most ``WINDOW_BYTES``, equal but for a byte."""
    count = -(-len(data) // WINDOW_BYTES)
    cuts = [k * len(data) // count for k in range(count + 1)]
    return [data[a:b] for a, b in zip(cuts, cuts[1:])]


def classify(compressors, text: str | None) -> tuple[str, float, float, bool]:
    """(language, score, margin, rejected) of one text."""
    if text is None or not compressors or _LETTER.search(text) is None:
        return UNDETERMINED, 0.0, 0.0, True
    windows = [_PAD + w for w in _windows(_folded(text))]
    sizes = sorted((sum(len(c.compress(w)) for w in windows), order) for order, (_, c) in enumerate(compressors))
    best = compressors[sizes[0][1]][0]
    if len(sizes) == 1:
        return best, 1.0, 1.0, False
    margin = (sizes[1][0] - sizes[0][0]) / sizes[1][0]
    return best, margin / (margin + MIN_MARGIN), margin, margin < MIN_MARGIN


def predict(docs: DataFrame, model: dict[str, tuple[bytes, int]], key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, lang_pred, score, margin, rejected for every row."""
    import pyarrow as pa

    sent = docs.sparkSession.sparkContext.broadcast(model)  # at most DICTIONARY_BYTES a language

    def run(batches):
        compressors = _compressors(sent.value)
        for b in batches:
            got = [classify(compressors, t.as_py()) for t in b.column(1)]
            langs, scores, margins, rejected = zip(*got) if got else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(margins, pa.float64()), pa.array(rejected, pa.bool_())],
                ["doc_id", "lang_pred", "score", "margin", "rejected"],
            )

    return keyed(docs, key, text).mapInArrow(released(run), "doc_id long, lang_pred string, score double, margin double, rejected boolean")


def keep_identified(docs: DataFrame, model: dict[str, tuple[bytes, int]], text: str = "text") -> DataFrame:
    """``docs`` without the rows whose language is rejected: decided row by row, no shuffle, all columns kept."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def accepted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        compressors = _compressors(sent.value)
        for s in batches:
            yield pd.Series([not classify(compressors, t)[3] for t in s], dtype=bool)

    return docs.filter(accepted(F.col(f"`{text}`").cast("string")))


def training_rows(docs: DataFrame, held_out: Column, lang: str = "lang") -> DataFrame:
    return docs.filter(~held_out & F.col(lang).isNotNull())
