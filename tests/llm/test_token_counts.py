"""Token counts against the library on whole texts."""

import random

import public_tokenizers
from pyspark.sql import functions as F
import pytest
import sentencepiece

from tests.llm.conftest import LONG, ROWS
from treeflat.llm import token_counts as tc

PATH = public_tokenizers.path("piece_bpe_32k.model")
PROTO = open(PATH, "rb").read()
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
ODD = ["", " ", "  ", "\n", " \n ", "\n\n\n", "a ", " a", "a  b", "a\nb", "a \nb", "\ta", "▁", "a▁b", " ▁a", "▁ a", "a▁▁ b", "<s> </s> <unk> <0x0A>", "\x00", "a\x00 a", "\r\n", "a b", "a b", "日本語のテキスト" * 40,
       "𝔘𝔫𝔦 é é ﬁ ①", "x" * 500, "averyveryverylongwordindeed " * 30, "é" * 8 + " " + "é" * 7 + "a", "…▁\n▁…", " " * 40, "1234567 12 3", "▁" * 9, "0" * 15 + " " + "0" * 16]


def want(rows, limit=tc.LIMIT):
    out = []
    for i, t in rows:
        n = len(LIBRARY.encode(t or ""))
        out.append((i, len((t or "").encode()), n, n > limit))
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_counts(docs, empty):
    assert got(tc.token_counts(docs, PROTO)) == want(ROWS)
    assert any(r[3] for r in want(ROWS))
    assert tc.token_counts(empty, PROTO).count() == 0


@pytest.mark.parametrize("table,cache", [(1, 3), (1 << 15, 200_000)])
def test_odd_texts(spark, monkeypatch, table, cache):
    """Whatever the tiers hold, and for texts longer than a piece."""
    monkeypatch.setattr(tc, "TABLE_ENTRIES", table)
    monkeypatch.setattr(tc, "CACHE_ENTRIES", cache)
    monkeypatch.setattr(tc, "PIECE", 300)
    draw = random.Random(5)
    glued = ["".join(draw.choices(ODD + ["a", " ", "\n", "the ", "▁", "."], k=draw.randint(1, 60))) for _ in range(120)]
    rows = [(k, t) for k, t in enumerate(ODD + glued + [None, LONG])]
    assert got(tc.token_counts(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), PROTO)) == want(rows)


def test_model_without_cuts(docs, monkeypatch):
    monkeypatch.setattr(tc.Model, "counts", tc.Model.counts)
    plain = tc.Model.__init__

    def whole(self, proto):
        plain(self, proto)
        self.cuts = self.line_cuts = False

    monkeypatch.setattr(tc.Model, "__init__", whole)
    assert got(tc.token_counts(docs, PROTO)) == want(ROWS)


def test_no_exchange_and_no_match_of_neighbours(spark):
    model = tc.Model(PROTO)
    assert model.cuts and model.line_cuts
    table = tc.frequent_table(spark.createDataFrame([(1, "aa aa b \x00 \x00\x00")], "doc_id long, text string"), model)
    import numpy as np

    spans = [b"aa", b"b", b"", b"\x00", b"\x00\x00", b"\x00\x00\x00", b"c"]
    data, lengths = np.frombuffer(b"".join(spans), np.uint8), np.array([len(s) for s in spans])
    found = table.find(*tc.packed(data, np.cumsum(lengths) - lengths, lengths))
    assert found[-2:].tolist() == [0, 0] and found[0] == len(LIBRARY.encode("aa")) and found[3] == len(LIBRARY.encode("\x00"))
    plan = tc.token_counts(spark.range(5).select(F.col("id").alias("doc_id"), F.lit("t").alias("text")), PROTO)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
